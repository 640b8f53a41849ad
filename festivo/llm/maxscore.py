"""Exact top-k inner products by MaxScore over shards of postings."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from festivo.sources.tables import read_table

TOP = 20
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
WARM_ROWS = 512  # rows of a shard scored in full first, for a threshold to prune with
SCALE = 64.0

PACKED = "rows int, dim int, ids binary, parts binary"
_PACKED_TYPES = [("rows", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("parts", pa.binary())]


def _pack(size: int):
    """Rows (vec_id, embedding) packed to blobs of up to ``size`` vectors of equal length; unusable vectors fall away."""

    def blob(ids: np.ndarray, parts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([len(ids)], pa.int32()), pa.array([parts.shape[1]], pa.int32()), pa.array([ids.astype(np.int64).tobytes()], pa.binary()), pa.array([np.ascontiguousarray(parts).tobytes()], pa.binary())],
            ["rows", "dim", "ids", "parts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}  # by length of the vectors
        for batch in batches:
            for vec_id, x in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
                if vec_id is None or not x.is_valid or x.values.null_count:
                    continue
                v = np.asarray(x.values, np.float64)
                if not np.isfinite(v).all():
                    continue
                own = held.setdefault(len(v), [])
                own.append((vec_id, np.floor(SCALE * v)))
                if len(own) == size:
                    yield blob(np.array([i for i, _ in own]), np.stack([p for _, p in own]))
                    own.clear()
        for own in held.values():
            if own:
                yield blob(np.array([i for i, _ in own]), np.stack([p for _, p in own]))

    return run


def shard_top(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, vec_id, score) of each query's k best rows of one shard, ties to the smaller vec_id.

    A query's terms are its components. A term's bound is the most it can add to any score, from the shard's
    largest and smallest posting. Terms are ordered by bound; those of the smallest bounds whose sum stays below the
    query's threshold are non-essential: a row must meet an essential term to compete. The essential postings are
    traversed for all rows; the others are probed, largest bound first, for the rows that can still reach the threshold. The
    threshold is the k-th best score of the shard's first rows, scored in full. Rows that can only equal it stay.
    """
    n, dim = rows.shape
    if q.shape[1] != dim:  # missing components count as zeros
        wide = max(dim, q.shape[1])
        q, rows = np.pad(q, ((0, 0), (0, wide - q.shape[1]))), np.pad(rows, ((0, 0), (0, wide - dim)))
    warm = min(n, WARM_ROWS)
    exact = q @ rows[:warm].T
    exact[q_ids[:, None] == ids[None, :warm]] = -np.inf
    threshold = np.partition(exact, warm - k, axis=1)[:, warm - k] if warm >= k else np.full(len(q), -np.inf)
    found_q, found_d = np.nonzero((exact >= threshold[:, None]) & np.isfinite(exact))
    results = [(found_q, found_d, exact[found_q, found_d])]
    if n > warm:
        rest = rows[warm:]
        bounds = np.maximum(np.maximum(q * rest.max(0), q * rest.min(0)), 0)
        order = np.argsort(bounds, axis=1)
        sums = np.cumsum(np.take_along_axis(bounds, order, 1), axis=1)
        skipped = (sums < threshold[:, None]).sum(1)  # how many terms are non-essential
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(q.shape[1])[None, :], 1)
        score = np.where(place >= skipped[:, None], q, 0) @ rest.T
        left = np.where(skipped > 0, np.take_along_axis(sums, np.maximum(skipped - 1, 0)[:, None], 1)[:, 0], 0.0)
        at_q, at_d = np.nonzero(score + left[:, None] >= threshold[:, None])
        own = q_ids[at_q] == ids[warm:][at_d]
        at_q, at_d = at_q[~own], at_d[~own]
        score = score[at_q, at_d]
        done_q, done_d, done_s = [], [], []
        term = skipped[at_q] - 1
        while len(at_q):
            over = term < 0
            if over.any():
                done_q.append(at_q[over]), done_d.append(at_d[over]), done_s.append(score[over])
                at_q, at_d, score, term = at_q[~over], at_d[~over], score[~over], term[~over]
                continue
            column = order[at_q, term]
            score = score + q[at_q, column] * rest[at_d, column]
            term = term - 1
            ahead = np.where(term >= 0, sums[at_q, np.maximum(term, 0)], 0.0)
            stays = score + ahead >= threshold[at_q]
            at_q, at_d, score, term = at_q[stays], at_d[stays], score[stays], term[stays]
        if done_q:
            results.append((np.concatenate(done_q), np.concatenate(done_d) + warm, np.concatenate(done_s)))
    at_q, at_d, score = (np.concatenate(x) for x in zip(*results, strict=True))
    best = np.lexsort((ids[at_d], -score, at_q))
    at_q, at_d, score = at_q[best], at_d[best], score[best]
    rank = np.arange(len(at_q)) - np.searchsorted(at_q, at_q)
    top = rank < k
    return at_q[top], ids[at_d[top]], score[top].astype(np.int64)


def top_inner_products(queries: DataFrame, rows: DataFrame, k: int = TOP) -> DataFrame:
    """The k rows of ``rows(vec_id, embedding)`` of the highest integer inner product with each row of ``queries``.

    Components are floor(64 * x). Shards of SHARD_ROWS vectors are packed where they are read, without a shuffle, and meet the queries
    in blocks of BLOCK_QUERIES by an equality join on the block's number; each pair gives at most k rows a query, and
    a ranking per query merges the shards. Null vectors, null ids and vectors with null or non-finite components take no
    part; a query's own vec_id is no candidate. Repeated rows are candidates each; a repeated query is asked once. Vectors
    of unequal lengths count missing components as zeros. An empty table gives an empty result. Sums are exact below 2^53.
    """
    spark = rows.sparkSession
    columns = [F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")]
    queries = queries.select(*columns).where("vec_id is not null and embedding is not null").distinct()
    n_blocks = max(1, math.ceil(queries.count() / BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_blocks)).cast("int")
    pack = _pack(1 << 30)

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        blobs = pa.Table.from_batches(list(pack(iter(table.to_batches()))), pa.schema(_PACKED_TYPES))
        return blobs.append_column("block", pa.array([key[0].as_py()] * blobs.num_rows, pa.int32()))

    asked = queries.withColumn("block", block).groupBy("block").applyInArrow(packed, f"{PACKED}, block int")
    asked = asked.select("block", *[F.col(c).alias(f"q_{c}") for c in ("rows", "dim", "ids", "parts")])
    shards = rows.select(*columns).mapInArrow(_pack(SHARD_ROWS), PACKED)
    pairs = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).join(asked, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                ids, q_ids = np.frombuffer(x["ids"], np.int64), np.frombuffer(x["q_ids"], np.int64)
                parts = np.frombuffer(x["parts"], np.float64).reshape(x["rows"], x["dim"])
                asked = np.frombuffer(x["q_parts"], np.float64).reshape(x["q_rows"], x["q_dim"])
                at, vec, score = shard_top(q_ids, asked, ids, parts, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_maxscore_top_k(spark: SparkSession, root: str) -> DataFrame:
    rows = read_table(spark, root, "embeddings")
    return top_inner_products(rows.where("vec_id % 20 = 0"), rows)


SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS parts FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, v.vec_id AS vec_id, CAST(list_inner_product(q.parts, v.parts) AS BIGINT) AS score
    FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
