"""Removal of long repeated byte strings: Burrows-Wheeler transforms of shards, merged by interleave refinement."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from festivo.sources.tables import read_table

from .common import Scratch, row_key, slices

LENGTH = 400  # bytes of a repeated string
STEP = 40  # bytes of a symbol; LENGTH is a multiple
GRAM = 32  # bytes of an anchor
SIDE = LENGTH // 2
SLICE = 1 << 20
BIN_BYTES = 1 << 20  # segments that one group compares, on average; an anchor with more is compared by whole strings
SHARD_BYTES = 1 << 18
_RNG = np.random.default_rng(400)
_TABLE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of all runs of n bytes, by doubling."""
    out, have, total = _TABLE[data], 1, None
    taken = 0
    while True:
        if n & have:
            if total is None:
                total = out
            else:
                size = len(data) - taken - have + 1
                total = total[:size] * np.uint64(pow(_BASE, have, 1 << 64)) + out[taken : taken + size]
            taken += have
        if taken == n:
            return total
        size = len(data) - 2 * have + 1
        out = out[:size] * np.uint64(pow(_BASE, have, 1 << 64)) + out[have : have + size]
        have *= 2


def anchored_runs(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, last start, anchor place, anchor hash) of the runs of LENGTH-byte strings that share an anchor.

    A string's anchor is its GRAM-byte run of the smallest hash, the leftmost among equals, so equal strings have equal
    anchors at equal places. ``ends`` are the ends of the texts in ``data``; no string crosses one.
    """
    none = np.empty(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, np.empty(0, np.uint64)
    grams = gram_hashes(data, GRAM)
    mixed = (grams ^ (grams >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    bits = np.uint64(max(24, int(len(data)).bit_length()))
    low = ((mixed >> bits) << bits) | np.arange(len(mixed), dtype=np.uint64)
    span, have = LENGTH - GRAM + 1, 1
    while have * 2 <= span:
        low = np.minimum(low[: len(low) - have], low[have:])
        have *= 2
    rest = span - have
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    at = (low & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    whole = np.zeros(len(at) + 1, np.int64)  # starts from which a text has LENGTH bytes left
    fits = ends - starts >= LENGTH
    np.add.at(whole, starts[fits], 1)
    np.add.at(whole, ends[fits] - LENGTH + 1, -1)
    inside = np.cumsum(whole)[:-1] > 0
    new = inside.copy()
    new[1:] &= (at[1:] != at[:-1]) | ~inside[:-1]
    first_of_text = starts[fits]
    new[first_of_text] = True
    first = np.flatnonzero(new)
    text_end = ends[np.searchsorted(ends, first, side="right")] - LENGTH
    last = np.minimum(np.append(first[1:] - 1, len(at) - 1), text_end)
    return first, last, at[first], mixed[at[first]]


RUNS = "doc_id long, row long, lo int, n int, pre int, anchor long, c1 long, c2 long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in batch.column("text").to_pylist()]
        joined = b"".join(raw)
        data = np.frombuffer(joined, np.uint8)
        ends = np.cumsum([len(r) for r in raw])
        first, last, at, anchor = anchored_runs(data, ends)
        owner = np.searchsorted(ends, first, side="right")
        digests = b"".join([xxhash.xxh3_128_digest(joined[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
        halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
        picked = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(picked),
                batch.column("row").take(picked),
                pa.array((first - (ends - [len(r) for r in raw])[owner]).astype(np.int32)),
                pa.array((last - first + 1).astype(np.int32)),
                pa.array((at - first).astype(np.int32)),
                pa.array(anchor.view(np.int64)),
                pa.array(np.ascontiguousarray(halves[:, 0])),
                pa.array(np.ascontiguousarray(halves[:, 1])),
            ],
            ["doc_id", "row", "lo", "n", "pre", "anchor", "c1", "c2"],
        )


class Shard:
    """Suffixes of some segments in the order of their first LENGTH bytes, with their Burrows-Wheeler transform.

    A segment is read as STEP strings, one a phase, of symbols of STEP bytes and an end mark; a string's end is followed by its
    own beginning. So every byte place is a suffix, and LENGTH bytes are LENGTH / STEP symbols.
    """

    def __init__(self, symbols: np.ndarray, following: np.ndarray) -> None:
        rank, jump, have, kept = symbols.astype(np.int64), following, 1, {}
        depth = LENGTH // STEP

        def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1]

        done, after = None, np.arange(len(symbols))
        while True:
            if depth & have:
                done = rank if done is None else paired(done, rank[after])
                after = jump[after]
            if have * 2 > depth:
                break
            rank, jump, have = paired(rank, rank[jump]), jump[jump], have * 2
        self.suffixes = np.argsort(done, kind="stable")
        before = np.empty_like(following)
        before[following] = np.arange(len(following))
        self.transform = symbols[before[self.suffixes]]


def interleave(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the shards' transforms: (shard, place in the shard's order) of every suffix in the merged order, and the number of
    symbols it has in common with the suffix before it, LENGTH / STEP at most.

    The interleave starts as one shard after the other. In each round, every suffix's preceding symbol is read from its shard's
    transform in the order of the interleave, and the interleave is dealt stably by those symbols: after k rounds
    it is right for the first k symbols, and places where they change begin blocks (Holt and McMillan 2014). No suffix is sorted again.
    """
    sizes = [len(s.suffixes) for s in shards]
    transform = np.concatenate([s.transform for s in shards])
    source = np.repeat(np.arange(len(shards), dtype=np.uint16), sizes)
    block = np.zeros(len(source), np.int64)
    common = np.full(len(source), LENGTH // STEP, np.int32)
    if len(common):
        common[0] = 0
    for k in range(LENGTH // STEP):
        read = np.empty(len(source), np.int64)
        read[np.argsort(source, kind="stable")] = np.arange(len(source))
        symbol = transform[read]
        order = np.argsort(symbol, kind="stable")
        source, symbol, block = source[order], symbol[order], block[order]
        edge = np.zeros(len(source), bool)
        edge[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(edge)
        common[edge] = np.minimum(common[edge], k)
    read = np.empty(len(source), np.int64)
    read[np.argsort(source, kind="stable")] = np.arange(len(source))
    return source, read - (np.cumsum(sizes) - sizes)[source], common


def repeated_starts(segments: list[bytes]) -> list[np.ndarray]:
    """For each segment, which of its LENGTH-byte strings also start elsewhere in the segments."""
    lengths = np.array([len(s) for s in segments])
    data = np.frombuffer(b"".join(segments), np.uint8)
    hashes = gram_hashes(data, STEP)
    marks = STEP  # an end mark for each phase
    counts = lengths - STEP + 1
    begins = np.cumsum(counts + marks) - (counts + marks)
    sources = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(segments)), counts + marks)
    offset = np.arange(len(owner)) - begins[owner]
    is_mark = offset >= counts[owner]
    phase = np.where(is_mark, offset - counts[owner], offset % STEP)
    follows = np.where(is_mark, phase, np.where(offset + STEP < counts[owner], offset + STEP, counts[owner] + phase))
    following = begins[owner] + follows
    symbols = np.zeros(len(owner), np.int64)
    real = ~is_mark
    symbols[real] = np.unique(hashes[sources[owner[real]] + offset[real]], return_inverse=True)[1] + 1
    shards, bounds = [], [0]
    group = (np.cumsum(lengths) - lengths) // SHARD_BYTES
    for g in np.split(np.arange(len(segments)), np.flatnonzero(np.diff(group)) + 1):
        a, b = begins[g[0]], begins[g[-1]] + counts[g[-1]] + marks
        shards.append(Shard(symbols[a:b], following[a:b] - a))
        bounds.append(b)
    source, place, common = interleave(shards)
    suffix = np.empty(len(source), np.int64)
    for k, shard in enumerate(shards):
        mine = source == k
        suffix[mine] = shard.suffixes[place[mine]] + bounds[k]
    same = common >= LENGTH // STEP  # with the suffix before
    twice = same.copy()
    twice[:-1] |= same[1:]
    flags = np.zeros(len(owner), bool)
    flags[suffix] = twice
    return [flags[b : b + max(0, n - LENGTH + 1)] for b, n in zip(begins, lengths, strict=True)]


FOUND = "anchor long, c1 long, c2 long, lo int, hi int"


def _bins(key: tuple, table: pa.Table) -> pa.Table:
    """Runs of repeated strings in the segments of a bin, as first and last start within the segment."""
    segments, pre, anchor = table.column("segment").to_pylist(), table.column("pre").to_numpy(), table.column("anchor").to_numpy()
    # A string that holds its anchor has SIDE bytes on one side of the anchor's start; a segment none of whose sides is met again is out.
    left = np.array([xxhash.xxh3_64_intdigest(s[max(0, p - SIDE) : p]) if p >= SIDE else i for i, (s, p) in enumerate(zip(segments, pre, strict=True))], np.uint64)
    right = np.array([xxhash.xxh3_64_intdigest(s[p : p + SIDE]) for s, p in zip(segments, pre, strict=True)], np.uint64)
    stays = np.zeros(len(segments), bool)
    for side, there in ((left, pre >= SIDE), (right, np.array([len(s) - p >= SIDE for s, p in zip(segments, pre, strict=True)]))):
        both = (side ^ (anchor.view(np.uint64) * np.uint64(_BASE)))[there]
        _, inverse, counts = np.unique(both, return_inverse=True, return_counts=True)
        stays[np.flatnonzero(there)[counts[inverse] > 1]] = True
    chosen = np.flatnonzero(stays)
    rows = []
    if len(chosen):
        for i, flags in zip(chosen, repeated_starts([segments[i] for i in chosen]), strict=True):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).reshape(-1, 2)
            rows += [(i, int(a), int(b) - 1) for a, b in edges]
    picked = pa.array([r[0] for r in rows], pa.int64())
    return pa.table(
        {c: table.column(c).take(picked) for c in ("anchor", "c1", "c2")} | {"lo": pa.array([r[1] for r in rows], pa.int32()), "hi": pa.array([r[2] for r in rows], pa.int32())}
    )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        rows = []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            data = text.encode("utf-8", "surrogatepass")
            rows += [(w["anchor"], w["c1"], w["c2"], w["pre"], w["n"], data[w["lo"] : w["lo"] + w["n"] + LENGTH - 1]) for w in wanted]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["anchor", "c1", "c2", "pre", "n", "segment"])


WINDOWS = "anchor long, c1 long, c2 long, at int, w1 long, w2 long"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """128-bit digest of every LENGTH-byte string of the segments."""
    for batch in slices(batches, "segment", SLICE // 8):
        segments, n = batch.column("segment").to_pylist(), batch.column("n").to_numpy()
        digests = b"".join([xxhash.xxh3_128_digest(s[i : i + LENGTH]) for s, k in zip(segments, n.tolist(), strict=True) for i in range(k)])
        halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
        picked = pa.array(np.repeat(np.arange(len(n)), n))
        at = np.arange(len(halves)) - np.repeat(np.cumsum(n) - n, n)
        found = [pa.array(at.astype(np.int32)), *[pa.array(np.ascontiguousarray(halves[:, i])) for i in (0, 1)]]
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(picked) for c in ("anchor", "c1", "c2")], *found], ["anchor", "c1", "c2", "at", "w1", "w2"])


def _repeated_windows(segments: DataFrame) -> DataFrame:
    """Runs of repeated strings in segments of anchors too frequent for one group: strings are counted, with map-side sums."""
    windows = segments.mapInArrow(_windows, WINDOWS)
    repeated = windows.groupBy("w1", "w2").agg(F.count("*").alias("times")).where("times > 1").select("w1", "w2")
    order = Window.partitionBy("anchor", "c1", "c2").orderBy("at")  # a segment has fewer than LENGTH strings
    runs = windows.join(repeated, ["w1", "w2"]).withColumn("island", F.col("at") - F.row_number().over(order))
    return runs.groupBy("anchor", "c1", "c2", "island").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).drop("island")


def repeated_spans(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, row and spans (first and last start) of the LENGTH-byte strings of ``docs(doc_id, text)`` that start more than once.

    Equal strings have equal anchors, so strings are compared within an anchor only. Runs of strings with one anchor are segments;
    equal segments are folded by hash aggregation, and all strings of a folded segment repeat. Where an anchor has several
    distinct segments, their suffix order decides: bins of anchors are cut into shards, each shard's Burrows-Wheeler transform is made,
    and merging the transforms gives the common prefixes and so the repeated intervals. An anchor whose distinct segments exceed a bin
    (the edge of a passage that very many texts share) has its strings counted by digest instead, so no group is unbounded.
    """
    scratch = scratch or Scratch(docs.sparkSession, "repeats")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", row_key("doc_id", "text"))
    long_texts = docs.where(F.octet_length("text") >= LENGTH)
    runs = scratch.keep(long_texts.mapInArrow(_runs, RUNS))
    kinds = ["anchor", "c1", "c2"]
    classes = runs.groupBy(*kinds, "n", "pre").agg(F.count("*").alias("times"), F.first("row").alias("row"), F.first("lo").alias("lo"))
    several = classes.groupBy("anchor").agg(F.count("*").alias("m"), F.sum("times").alias("t")).where("t > 1 or m > 1").select("anchor", "m")
    classes = scratch.keep(classes.join(several, "anchor"))
    # The strings of one segment share one anchor place, so no two of them are equal.
    open_classes = classes.where("m > 1")
    bytes_of = F.sum(F.col("n") + LENGTH - 1)
    size = open_classes.agg(bytes_of).first()[0] or 0
    n_bins = max(1, math.ceil(size / BIN_BYTES))
    heavy = scratch.keep(open_classes.groupBy("anchor").agg(bytes_of.alias("size")).where(F.col("size") > BIN_BYTES).select("anchor"))

    def segments(of: DataFrame) -> DataFrame:
        wanted = of.groupBy("row").agg(F.collect_list(F.struct(*kinds, "pre", "n", "lo")).alias("wanted"))
        texts = long_texts.select("row", "text").join(wanted, "row").dropDuplicates(["row"]).select("text", "wanted")
        return texts.mapInArrow(_segments, "anchor long, c1 long, c2 long, pre int, n int, segment binary")

    binned = segments(open_classes.join(heavy, "anchor", "left_anti")).withColumn("bin", F.pmod(F.xxhash64("anchor"), F.lit(n_bins)))
    merged = binned.groupBy("bin").applyInArrow(_bins, FOUND)
    if heavy.first():
        merged = merged.unionAll(_repeated_windows(segments(open_classes.join(heavy, "anchor"))).select(*merged.columns))
    folded = classes.where("times > 1").select(*kinds, F.lit(0).alias("lo"), (F.col("n") - 1).alias("hi"))
    ranges = folded.unionAll(merged.join(folded.select(*kinds), kinds, "left_anti")).withColumnsRenamed({"lo": "a", "hi": "b"})
    return (
        runs.select("doc_id", "row", "lo", *kinds)
        .join(ranges, kinds)
        .select("doc_id", "row", F.struct((F.col("lo") + F.col("a")).alias("a"), (F.col("lo") + F.col("b")).alias("b")).alias("span"))
        .groupBy("doc_id", "row")
        .agg(F.collect_list("span").alias("spans"))
    )


def without_repeats(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (bytes) of every row of ``docs(doc_id, text)``.

    Every byte covered by a LENGTH-byte string that starts anywhere else too is removed, as judged on the input. A null text counts as
    empty. Rows repeated with the same id and text each count as a place where their strings start; a null doc_id is
    treated like any other value. Other columns are not read.
    """
    spans = repeated_spans(docs, scratch).select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "spans")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("row", row_key("doc_id", "text"))
    joined = docs.join(spans, (F.col("row") == F.col("_row")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = (text or "").encode("utf-8", "surrogatepass")
                edges = np.zeros(len(data) + 1, np.int64)
                for s in found or ():
                    edges[s["a"]] += 1
                    edges[s["b"] + LENGTH] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if found else data
                n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((len(data), int(gone.sum()), n_spans, kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op4_suffix_repeats(spark: SparkSession, root: str) -> DataFrame:
    found = without_repeats(read_table(spark, root, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
