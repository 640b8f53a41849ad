"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from festivo.sources.tables import read_table

from .common import Scratch, slices
from .graph import connected_components

WIDTH = 5
BANDS, ROWS = 24, 5
HASHES = 128  # the first BANDS * ROWS of them make the bands; all of them make the signature
BITS = 4  # bits kept of each minimum: 16 minima to a long
LANES = 64 // BITS
MARGIN = 5.0  # standard errors below the threshold at which an estimate still goes to the exact check


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; a shorter text is one shingle, no words none."""
    if not text:
        return np.empty(0, np.uint64)
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    take = min(width, len(h))
    mixed = np.full(n, take, np.uint64)
    for i in range(take):
        mixed = (mixed ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each of the HASHES hash functions over a set."""
    factors = np.random.default_rng(20240229).integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    for start in range(0, len(folded), 2048):
        np.minimum(low, (factors[:, None] * folded[None, start : start + 2048]).min(1), out=low)
    return low


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima, LANES of them to a 64-bit word."""
    kept = (low & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(-1, LANES)
    return np.bitwise_or.reduce(kept << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS)), axis=1)


SIGNED = "doc_id long, n_shingles int, d1 long, d2 long, sig array<long>, bands array<long>"


def _signatures(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, digests, sigs, bands = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, width)
                sizes.append(len(s))
                if not len(s):
                    digests.append((None, None))
                    sigs.append(None)
                    bands.append(None)
                    continue
                low = minima(s)
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist())
                sigs.append(packed(low).view(np.int64))
                blocks = low[: BANDS * ROWS].reshape(BANDS, ROWS)
                bands.append(np.array([xxhash.xxh3_64_intdigest(b.tobytes()) for b in blocks], np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int32()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array(sigs, pa.list_(pa.int64())),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "d1", "d2", "sig", "bands"],
            )

    return run


def estimate(a: str, b: str) -> Column:
    """Similarity estimated from two packed signatures: equal lanes by bit counts, corrected for chance collisions."""
    ones = sum(1 << (BITS * i) for i in range(LANES))
    mask = F.lit(ones - (1 << 64) if ones >= 1 << 63 else ones)

    def differing(i: int) -> Column:
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(mask))

    unequal = reduce(lambda x, y: x + y, [differing(i) for i in range(HASHES // LANES)])
    chance = 2.0**-BITS
    return ((HASHES - unequal) / HASHES - chance) / (1 - chance)


def _shingle_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, width) for t in batch.column("text").to_pylist()]
            owner = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(owner), pa.array(np.concatenate(sets).view(np.int64))], ["rep", "shingle"])

    return run


def _confirm(percent: int, width: int):
    """Exact check of pairs on their full sets; the pairs come with both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: dict[int, list] = {}

        def sets(doc_id: int, text: str) -> np.ndarray:
            seen = recent.get(doc_id)
            if seen is None or seen[0] != text:
                if len(recent) > 64:
                    recent.clear()
                seen = recent[doc_id] = [text, shingle_set(text, width)]
            return seen[1]

        for batch in batches:
            good = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True):
                x, y = sets(a, ta), sets(b, tb)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(bool(shared) and 100 * shared >= percent * (len(x) + len(y) - shared))
            kept = batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH, scratch: Scratch | None = None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |A & B| >= percent * |A | B| on their shingle sets. Equal sets are first folded
    into their smallest doc_id by hash aggregation, so copies never meet in a band. Bands of the minima then give the
    candidates. Shingles that one candidate document alone has bound what it can share with any other; pairs whose bound
    is below the threshold are no candidates. In every bucket each document is first tried against one leader only, the
    one with the smallest part of such shingles; the links confirmed so far make components, and only documents of a bucket whose
    components differ are compared with each other, in the first bucket that they share, which leaves out no link that could
    still join two components.
    Estimates from the packed low bits, taken ``MARGIN`` standard errors below the threshold, go to the check on full sets.

    Texts that are null, empty or without words have an empty set and are linked with nothing; so are rows with a null
    doc_id, whose component_id is null; both are kept. Rows with equal doc_id are one node. Other columns are ignored.
    A link at the threshold is missed by all bands with probability (1 - 0.85^5)^24 < 1e-6; below it, no link is made.
    Set elements are 64-bit hashes of the shingles.
    """
    scratch = scratch or Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = scratch.keep(docs.mapInArrow(_signatures(width), SIGNED))
    usable = signed.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    firsts = usable.join(classes, ["d1", "d2"]).where("doc_id = rep")
    buckets = scratch.keep(firsts.select("rep", F.posexplode("bands").alias("band", "key")))
    spans = buckets.groupBy("band", "key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    crowded = scratch.keep(buckets.join(spans.select("band", "key"), ["band", "key"]))
    texts = scratch.keep(docs.join(crowded.select(F.col("rep").alias("doc_id")).distinct(), "doc_id"))
    singles = texts.mapInArrow(_shingle_rows(width), "rep long, shingle long").groupBy("shingle").agg(F.count("*").alias("n"), F.min("rep").alias("rep"))
    own = singles.where("n = 1").groupBy("rep").agg(F.count("*").cast("int").alias("own"))
    marks = F.expr("transform(bands, (b, i) -> cast(xxhash64(b, i) & 2147483647 as int))").alias("marks")
    about = scratch.keep(firsts.select("rep", "n_shingles", "sig", marks).join(own, "rep", "left").fillna(0, ["own"]))
    shared = crowded.join(about, "rep")
    heads = shared.groupBy("band", "key").agg(F.min(F.struct((F.col("own") / F.col("n_shingles")).alias("part"), "rep")).alias("lead"))
    shared = scratch.keep(shared.join(heads.select("band", "key", F.col("lead.rep").alias("lead")), ["band", "key"]))

    def confirmed(pairs: DataFrame) -> DataFrame:
        a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        return pairs.distinct().join(b, "b").join(a, "a").mapInArrow(_confirm(percent, width), "a long, b long")

    threshold = percent / 100
    p = threshold + (1 - threshold) * 2.0**-BITS
    least = threshold - MARGIN * (p * (1 - p) / HASHES) ** 0.5 / (1 - 2.0**-BITS)

    def close(x: str) -> Column:
        """Whether a pair, one side's columns with the prefix x, may reach the threshold."""
        u, v = F.expr(f"{x}n_shingles - {x}own"), F.expr("n_shingles - own")
        bound = F.least(u, v) * 100 >= (F.greatest(u, v) + F.col(f"{x}own") + F.col("own")) * percent
        return bound & (estimate(f"{x}sig", "sig") >= least)

    def side(rows: DataFrame, x: str, *more: str) -> DataFrame:
        return rows.select("band", "key", *[F.col(c).alias(f"{x}{c}") for c in ("rep", "n_shingles", "own", "sig", *more)])

    stars = shared.where("rep <> lead").join(side(shared.where("rep = lead"), "x_"), ["band", "key"]).where(close("x_"))
    first_links = scratch.keep(confirmed(stars.select(F.col("lead").alias("a"), F.col("rep").alias("b"))))
    labels = connected_components(first_links, scratch)

    members = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("component", "rep")).drop("component")
    tops = members.where("rep = lead").select("band", "key", F.col("label").alias("lead_label")).distinct()
    members = scratch.keep(members.join(tops, ["band", "key"]))
    strays = side(members.where("label <> lead_label"), "x_", "label", "marks")
    met_before = F.arrays_overlap(F.slice("x_marks", 1, F.col("band")), F.slice("marks", 1, F.col("band")))
    rest = (
        strays.join(members, ["band", "key"])
        .where("x_label <> label and (label = lead_label or x_rep < rep) and rep <> lead")
        .where(close("x_") & ~met_before)
        .select(F.least("x_rep", "rep").alias("a"), F.greatest("x_rep", "rep").alias("b"))
    )
    links = scratch.keep(first_links.unionAll(confirmed(rest)))
    components = connected_components(links, scratch)
    grouped = classes.join(components.withColumnRenamed("node", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    return signed.join(grouped, ["d1", "d2"], "left").select(
        "doc_id",
        F.col("n_shingles").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component_id", "doc_id"), F.lit(True)).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, percent: int = 85, width: int = WIDTH, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which ``near_duplicates`` keeps the document: one of each group.

    Rows repeated with one doc_id leave one row, that of the smallest text hash. Rows with a null doc_id all stay.
    """
    kept = near_duplicates(docs, percent, width, scratch).where("kept and doc_id is not null")
    ids = kept.select(F.col("doc_id").alias("key")).distinct()
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"), F.col("doc_id").cast("long").alias("key"))
    order = Window.partitionBy("key").orderBy(F.xxhash64("given.text"))
    one = given.join(ids, "key", "left_semi").withColumn("place", F.row_number().over(order)).where("place = 1")
    return one.select(*[F.col("given").getField(c).alias(c) for c in docs.columns]).unionAll(docs.where(F.col("doc_id").isNull()))


def op6_minhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(read_table(spark, root, "documents"))
