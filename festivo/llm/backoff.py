"""Language-model scores by stupid backoff, counts gathered from the whole corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .minhash import word_hashes

ORDER = 3
ALPHA = 0.4
UNSEEN = 0.5  # count taken for a word that no other document has
KEY_BITS = 52  # of an n-gram's hash; raise to 64 beyond some 10^10 distinct n-grams
CHUNK_BYTES = 8 << 20  # text of the documents that are exploded together
BUCKET_KEYS = 2_000_000  # n-grams of one partition of the count table, about
KEYS_PER_BYTE = 0.35
_MIX = np.uint64(0x9E3779B97F4A7C15)


def ngrams(text: str | None, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams of the text's words, for n from 1 to ``order``; never 0, which is kept for the number of words."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    out, mixed = [], np.zeros(len(h), np.uint64)
    for n in range(1, order + 1):
        size = max(0, len(h) - n + 1)
        mixed = (mixed[:size] ^ h[n - 1 : n - 1 + size]) * _MIX + np.uint64(n)
        mixed ^= mixed >> np.uint64(31)
        out.append(np.maximum((mixed * _MIX) >> np.uint64(64 - KEY_BITS), np.uint64(1)))
    return out


def chunk_counts(texts: list[str | None], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of some texts and their counts; n-gram 0 counts all words."""
    grams = [ngrams(t, order) for t in texts]
    keys, counts = np.unique(np.concatenate([k for g in grams for k in g] + [np.empty(0, np.uint64)]), return_counts=True)
    words = sum(len(g[0]) for g in grams)
    return np.concatenate((np.zeros(1, np.uint64), keys)), np.concatenate(([words], counts))


def places(values: np.ndarray) -> tuple[np.ndarray, int]:
    """The place of each value among the sorted distinct ones, and their number: one sort, no search of each value."""
    if not len(values):
        return np.empty(0, np.int32), 0
    order = np.argsort(values)
    ordered = values[order]
    ranks = np.concatenate([np.zeros(1, np.int32), np.cumsum(ordered[1:] != ordered[:-1], dtype=np.int32)])
    out = np.empty(len(values), np.int32)
    out[order] = ranks
    return out, int(ranks[-1]) + 1


def planes(values: np.ndarray) -> bytes:
    """Integers as planes of their bytes, which the shuffle's compression makes small."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def document_score(found: np.ndarray, n: int, order: int, totals: np.ndarray) -> float | None:
    """Mean log score of the ``n`` words of a document, its own n-grams taken off the totals; ``found`` has their places in these."""
    if not n:
        return None
    own, inverse, counts = np.unique(found, return_inverse=True, return_counts=True)
    others = (totals[own] - counts)[inverse].astype(np.float64)
    seen = np.split(others, np.cumsum([max(0, n - k) for k in range(order - 1)]))
    score = np.log(np.maximum(seen[0], UNSEEN) / max(1, totals[0] - n))
    for k in range(1, order):
        there = seen[k] > 0
        context = seen[k - 1][: len(there)]
        score[k:] = np.where(there, np.log(np.maximum(seen[k], 1) / np.maximum(context, 1)), math.log(ALPHA) + score[k:])
    return float(score.mean())


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words and score of every row of ``docs(doc_id, text)``: the mean log stupid-backoff score of its words.

    A word's score after the ``order`` - 1 words before it is count(n-gram) / count(context) over all other documents,
    or ALPHA times the score after one word less where no other document has the n-gram; the last resort is the word's
    share of all words. Counts are taken over all documents. Words are those of ``word_hashes``.

    Documents are exploded to n-grams in chunks by a hash of the row; equal n-grams of a chunk are added up before the shuffle,
    so a frequent word is one entry a chunk. The count table is partitioned by ranges of the n-gram's hash. Each partition adds
    up the chunks' counts after one sort and sends every chunk the totals of its own n-grams in the order of the keys, where they are joined
    with the n-grams of the documents and summed per document. The documents' shuffle serves both passes.

    A text that is null, empty or without words has 0 words and a null score. A null doc_id is passed on; repeated
    rows are documents each; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_chunks = max(1, math.ceil(size / CHUNK_BYTES))
    n_buckets = max(1, math.ceil(size * KEYS_PER_BYTE / BUCKET_KEYS))
    width = -(-(1 << KEY_BITS) // n_buckets)
    chunked = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)))

    def explode(key: tuple, table: pa.Table) -> pa.Table:
        keys, counts = chunk_counts(table.column("text").to_pylist(), order)
        bucket = (keys // np.uint64(width)).astype(np.int64)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        ends = np.append(starts[1:], len(keys))
        gaps = np.diff(keys, prepend=np.uint64(0))
        gaps[starts] = keys[starts] - bucket[starts].astype(np.uint64) * np.uint64(width)
        return pa.table(
            {
                "chunk": pa.array([key[0].as_py()] * len(starts), pa.int64()),
                "bucket": pa.array(bucket[starts]),
                "gaps": pa.array([planes(gaps[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()),
                "counts": pa.array([planes(counts[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary()),
            }
        )

    def total(key: tuple, table: pa.Table) -> pa.Table:
        keys = [np.cumsum(from_planes(x)) for x in table.column("gaps").to_pylist()]
        counts = np.concatenate([from_planes(x) for x in table.column("counts").to_pylist()])
        found, n = places(np.concatenate(keys))
        totals = np.bincount(found, counts, n).astype(np.uint64)
        parts = np.split(totals[found], np.cumsum([len(k) for k in keys])[:-1])
        return pa.table(
            {"chunk": table.column("chunk"), "bucket": table.column("bucket"), "totals": pa.array([planes(p) for p in parts], pa.binary())}
        )

    def summed(key: tuple, own: pa.Table, sums: pa.Table) -> pa.Table:
        grams = [ngrams(t, order) for t in own.column("text").to_pylist()]
        words = [len(g[0]) for g in grams]
        ends = np.cumsum([0, *[sum(map(len, g)) for g in grams]])
        flat = np.concatenate([k for g in grams for k in g])
        del grams
        found, _ = places(flat)
        found += 1  # the number of words is before all n-grams
        by_bucket = sorted(zip(sums.column("bucket").to_pylist(), sums.column("totals").to_pylist(), strict=True))
        totals = np.concatenate([from_planes(x) for _, x in by_bucket]).astype(np.int64)
        scores = [document_score(found[a:b], n, order, totals) for a, b, n in zip(ends[:-1], ends[1:], words, strict=True)]
        return pa.table({"doc_id": own.column("doc_id"), "n_words": pa.array(words, pa.int64()), "score": pa.array(scores, pa.float64())})

    exploded = chunked.groupBy("chunk").applyInArrow(explode, "chunk long, bucket long, gaps binary, counts binary")
    totals = exploded.groupBy("bucket").applyInArrow(total, "chunk long, bucket long, totals binary")
    return chunked.groupBy("chunk").cogroup(totals.groupBy("chunk")).applyInArrow(summed, "doc_id long, n_words long, score double")


def op9_stupid_backoff(spark: SparkSession, root: str) -> DataFrame:
    return score_documents(read_table(spark, root, "documents")).withColumn("score", F.round("score", 6))


SQL = """
WITH words AS (
    SELECT doc_id, unnest(list) AS c, generate_subscripts(list, 1) AS i FROM (
        SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS list FROM documents)
), placed AS (
    SELECT *, lag(c, 1) OVER w AS b, lag(c, 2) OVER w AS a FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), counted AS (
    SELECT *, count(*) OVER () - count(*) OVER (PARTITION BY doc_id) AS n0,
        count(*) OVER (PARTITION BY c) - count(*) OVER (PARTITION BY doc_id, c) AS n1,
        count(*) OVER (PARTITION BY b, c) - count(*) OVER (PARTITION BY doc_id, b, c) AS n2,
        count(*) OVER (PARTITION BY a, b, c) - count(*) OVER (PARTITION BY doc_id, a, b, c) AS n3
    FROM placed
), chained AS (
    SELECT *, lag(n1) OVER w AS before1, lag(n2) OVER w AS before2 FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), first_level AS (
    SELECT *, ln(greatest(n1, 0.5) / greatest(1, n0)) AS s1 FROM chained
), second_level AS (
    SELECT *, CASE WHEN i < 2 THEN s1 WHEN n2 > 0 THEN ln(n2 / before1) ELSE ln(0.4) + s1 END AS s2 FROM first_level
), third_level AS (
    SELECT *, CASE WHEN i < 3 THEN s2 WHEN n3 > 0 THEN ln(n3 / before2) ELSE ln(0.4) + s2 END AS s3 FROM second_level
), scored AS (
    SELECT doc_id, count(*) AS n_words, round(avg(s3), 6) AS score FROM third_level GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, score FROM documents d LEFT JOIN scored USING (doc_id)
"""
