"""Compression of vectors to one byte a part: codebooks by Lloyd's rounds, nearest entries by Orchard's search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import Scratch, received, share
from .vectors import floors

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
BATCH_ROWS = 32_768  # vectors searched together in a task
HEAD = 12  # entries of a list that rows walk one by one
SALTS = 16  # rows of a label meet its total under so many keys


@dataclass
class Codebook:
    """Entries of one part, and for every entry all others sorted by distance from it."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        norms = (self.entries**2).sum(1)
        gaps = norms[:, None] + norms[None, :] - 2 * self.entries @ self.entries.T
        self.lists = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, 1)
        self.axis = int(np.argmax(self.entries.var(0))) if self.entries.shape[1] else -1
        self.along = np.argsort(self.entries[:, self.axis], kind="stable") if self.axis >= 0 else np.arange(len(self.entries))

    def start(self, x: np.ndarray) -> np.ndarray:
        """An entry to start from: the next one along the component that varies most."""
        if self.axis < 0:
            return np.zeros(len(x), np.int64)
        at = np.searchsorted(self.entries[self.along, self.axis], x[:, self.axis])
        return self.along[np.minimum(at, len(self.along) - 1)]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row and its squared distance, ties to the lower index.

        A row walks its current entry's list and marks what it visits. An entry that is nearer, or as near with a lower index,
        becomes the current one, and its list is walked from the head. The walk ends at an entry more than twice as far from
        the current one as the row is: by the triangle inequality none from there on is as near. The heads of the lists
        are walked by all rows together, an entry a step; rows that come to the same place beyond a head probe what is left
        of its list within their reach together.
        """
        n, m = len(x), len(self.entries)
        current, place = self.start(x), np.zeros(n, np.int64)
        distance = ((x - self.entries[current]) ** 2).sum(1)
        visited = np.zeros((n, m), bool)
        visited[np.arange(n), current] = True
        norms = (self.entries**2).sum(1)

        def in_reach(rows: np.ndarray) -> np.ndarray:
            rows = rows[place[rows] < m]
            return rows[self.gaps[current[rows], place[rows]] <= 4 * distance[rows]]

        def move(rows: np.ndarray, found: np.ndarray, least: np.ndarray) -> np.ndarray:
            better = (least < distance[rows]) | ((least == distance[rows]) & (found < current[rows]))
            moved = rows[better]
            current[moved], distance[moved], place[moved] = found[better], least[better], 0
            return moved

        walking = np.arange(n)
        while len(walking):
            beyond = []
            while len(walking := in_reach(walking)):
                far = place[walking] >= HEAD
                beyond.append(walking[far])
                walking = walking[~far]
                listed = self.lists[current[walking], place[walking]]
                place[walking] += 1
                unseen = ~visited[walking, listed]
                rows, listed = walking[unseen], listed[unseen]
                visited[rows, listed] = True
                away = x[rows] - self.entries[listed]
                move(rows, listed, np.einsum("ij,ij->i", away, away))
            walking = np.concatenate(beyond) if beyond else walking
            walking = walking[np.argsort(current[walking], kind="stable")]
            begins = np.flatnonzero(np.diff(current[walking], prepend=-1))
            jumped = []
            for begin, end in zip(begins, np.append(begins, len(walking))[1:], strict=True):
                rows = walking[begin:end]
                at, reach = current[rows[0]], 4 * distance[rows]
                stop = int(np.searchsorted(self.gaps[at], reach.max(), side="right"))
                listed = self.lists[at, HEAD:stop]
                wanted = ~visited[rows[:, None], listed] & (self.gaps[at, HEAD:stop] <= reach[:, None])
                place[rows] = m
                visited[rows[:, None], listed] |= wanted
                own = x[rows]
                probed = (own**2).sum(1)[:, None] + norms[listed] - 2 * own @ self.entries[listed].T
                probed[~wanted] = np.inf
                least = probed.min(1, initial=np.inf)
                jumped.append(move(rows, np.where(probed == least[:, None], listed, m).min(1, initial=m), least))
            walking = np.concatenate(jumped) if jumped else walking[:0]
        return current, distance


def _batches(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Usable rows and their components, some BATCH_ROWS at a time."""
    held: list[pa.RecordBatch] = []

    def out() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        kept, parts = floors(table.column("embedding").chunk(0), SCALE, dim)
        return table.take(kept), parts

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= BATCH_ROWS:
            yield out()
            held = []
    if held:
        yield out()


def _usable(rows: DataFrame) -> DataFrame:
    finite = "embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    return rows.select(F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>")).where(finite)


def fit(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[Codebook]:
    """Codebooks of ``rows(vec_id, label, embedding)``: the parts of the smallest vec_ids, moved by ``rounds`` rounds over all rows.

    A round assigns every part to its nearest entry and replaces each entry by the componentwise floor of its
    parts' mean. Tasks add up their own sums; Spark adds those by (part, entry, component), so the driver receives
    one number per component of the codebooks, whatever the size of the table. Equal vec_ids are ordered by their vectors;
    rows with a null vec_id are counted but never begin an entry. Vectors are filled with zeros up to the longest length, rounded up
    to a multiple of ``parts``. Without usable rows with an id there is no codebook.
    """
    usable = _usable(rows)
    seeds = usable.where("vec_id IS NOT NULL").orderBy("vec_id", "embedding").limit(entries).select("embedding").collect()
    if not seeds:
        return []
    longest = usable.agg(F.max(F.size("embedding"))).first()[0]
    width = -(-longest // parts)
    dim = width * parts
    first = floors(pa.array([r.embedding for r in seeds], pa.list_(pa.float64())), SCALE, dim)[1]
    books = [Codebook(first[:, p * width : (p + 1) * width]) for p in range(parts)]
    spark = rows.sparkSession
    for _ in range(rounds):
        shared = share(spark, books)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = received(shared)
            size = len(books[0].entries)
            total, count = np.zeros((parts, size, width), np.int64), np.zeros((parts, size), np.int64)
            for _, x in _batches(batches, dim):
                for p, book in enumerate(books):
                    own = x[:, p * width : (p + 1) * width]
                    at, _ = book.nearest(own)
                    order = np.argsort(at, kind="stable")
                    begins = np.flatnonzero(np.diff(at[order], prepend=-1))
                    if len(begins):
                        count[p] += np.bincount(at, minlength=size)
                        total[p, at[order][begins]] += np.add.reduceat(own[order].astype(np.int64), begins)
            p, e = np.nonzero(count)
            columns = [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "total"])

        partial = usable.select("embedding").mapInArrow(sums, "part int, entry int, n long, total array<long>")
        exploded = partial.select("part", "entry", "n", F.posexplode_outer("total").alias("place", "total"))
        moved = exploded.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).where("place IS NOT NULL")
        tables = [b.entries.copy() for b in books]
        for r in moved.toLocalIterator():
            tables[r.part][r.entry, r.place] = r.total // r.n
        books = [Codebook(t) for t in tables]
        shared.destroy()
    return books


def encode(rows: DataFrame, books: list[Codebook]) -> DataFrame:
    """(vec_id, label, code, error) of every usable row: one byte a part, and the squared distances summed over the parts.

    ``label`` keeps its type. Repeated rows give equal rows; null vectors and those with null or non-finite components fall away; other
    columns are not read. Without codebooks there are no rows.
    """
    usable = _usable(rows)
    schema = f"vec_id long, label {usable.schema['label'].dataType.simpleString()}, code binary, error long"
    if not books:
        return rows.sparkSession.createDataFrame([], schema)
    shared = share(rows.sparkSession, books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = received(shared)
        width = books[0].entries.shape[1]
        for table, x in _batches(batches, width * len(books)):
            found = [book.nearest(x[:, p * width : (p + 1) * width]) for p, book in enumerate(books)]
            codes = np.stack([at for at, _ in found], 1).astype(np.uint8)
            error = np.sum([d for _, d in found], 0).astype(np.int64)
            batch = pa.table({"vec_id": table.column("vec_id"), "label": table.column("label"), "code": pa.array([c.tobytes() for c in codes], pa.binary()), "error": pa.array(error)})
            yield from batch.to_batches()

    return usable.mapInArrow(run, schema)


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error summed over the rows of an equal label (nulls together). Rows of a label are spread over SALTS keys."""
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.select(F.col("label").alias("_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt_of"))
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(totals, F.col("label").eqNullSafe(F.col("_label")) & (F.col("_salt") == F.col("_salt_of")))
    return joined.select(*coded.columns, "label_error")


def components_digest(books: list[Codebook]) -> str:
    """SHA-256 of all entries' components as decimal integers, by part, entry and place, joined by commas."""
    numbers = (str(int(c)) for book in books for entry in book.entries for c in entry)
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def op12_orchard_codes(spark: SparkSession, root: str) -> DataFrame:
    rows = read_table(spark, root, "embeddings")
    books = fit(rows)
    coded = Scratch(spark, "vector_codes").keep(encode(rows, books))
    digest = F.lit(components_digest(books)).alias("codebooks_sha256")
    return with_label_errors(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest)


def _sql() -> str:
    """Assignments and moves written out round by round over all pairs of parts and entries."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (
    SELECT vec_id, label, part, x, CAST(min((xx + ee - 2 * list_inner_product(x, e)) * 256 + entry) AS BIGINT) AS low
    FROM parts JOIN book{r} USING (part) GROUP BY vec_id, label, part, x
)"""
        )
        if r < ROUNDS:
            steps.append(
                f"""sums{r} AS (
    SELECT part, low % 256 AS entry, place, floor(sum(c) / count(*)) AS c
    FROM (SELECT part, low, unnest(x) AS c, generate_subscripts(x, 1) AS place FROM near{r}) GROUP BY ALL
), means{r} AS (
    SELECT part, entry, list(c ORDER BY place) AS e FROM sums{r} GROUP BY part, entry
), book{r + 1} AS MATERIALIZED (
    SELECT part, entry, e, list_inner_product(e, e) AS ee
    FROM (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN means{r} m ON m.part = b.part AND m.entry = b.entry)
)"""
            )
    return f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
    SELECT vec_id, label, part, x, list_inner_product(x, x) AS xx FROM (
        SELECT vec_id, label, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS x
        FROM kept, (SELECT unnest(range({PARTS})) AS part)
    )
), book0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS e, xx AS ee
    FROM parts QUALIFY entry < {ENTRIES}
), {", ".join(steps)}, coded AS (
    SELECT vec_id, label, string_agg(printf('%02x', low % 256), '' ORDER BY part) AS code,
        CAST(sum(low // 256) AS BIGINT) AS error
    FROM near{ROUNDS} GROUP BY vec_id, label
), digest AS (
    SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
    FROM (SELECT part, entry, unnest(e) AS c, generate_subscripts(e, 1) AS place FROM book{ROUNDS})
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded, digest
"""


SQL = _sql()
