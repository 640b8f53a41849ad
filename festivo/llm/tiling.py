"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import received, share, slices
from .minhash import word_hashes

LEAST_TOKENS = 5  # shortest tile, and length of a seed
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20  # benchmark text that is broadcast at once

Tile = tuple[int, int, int]  # place in the item, place in the document, tokens


def seed_hashes(h: np.ndarray, n: int = LEAST_TOKENS) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``n`` tokens."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    base = np.uint64(0x5851F42D4C957F2D)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = out * base + h[i : len(h) - n + 1 + i]
    return out


def greedy_tiles(item: np.ndarray, doc: np.ndarray, at_item: np.ndarray, at_doc: np.ndarray, least: int = LEAST_TOKENS) -> list[Tile]:
    """Non-overlapping common runs of at least ``least`` tokens, the longest first, ties to the earliest in the item and then in
    the document. ``at_item`` and ``at_doc`` are the places of equal seeds.

    Seeds that follow each other on a diagonal are one match. A match that lies over marked tokens is cut to its
    unmarked runs, which wait for their turn by length.
    """
    real = np.ones(len(at_item), bool)
    for i in range(least):
        real &= item[at_item + i] == doc[at_doc + i]
    at_item, at_doc = at_item[real], at_doc[real]
    if not len(at_item):
        return []
    order = np.lexsort((at_item, at_doc - at_item))
    i, j = at_item[order], at_doc[order]
    first = np.ones(len(i), bool)
    first[1:] = (i[1:] != i[:-1] + 1) | (j[1:] != j[:-1] + 1)
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(i))) + least - 1
    heap = [(-int(n), int(a), int(b)) for n, a, b in zip(lengths, i[starts], j[starts], strict=True)]
    heapq.heapify(heap)
    free_item, free_doc, tiles = np.ones(len(item), bool), np.ones(len(doc), bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        free = free_item[a : a + n] & free_doc[b : b + n]
        if free.all():
            free_item[a : a + n] = free_doc[b : b + n] = False
            tiles.append((a, b, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
        for s, e in edges.reshape(-1, 2):
            if e - s >= least:
                heapq.heappush(heap, (-int(e - s), a + int(s), b + int(s)))
    return tiles


class SeedIndex:
    """Sorted seeds of a block of benchmark items and where they occur."""

    def __init__(self, items: list[tuple[int, str]], least: int) -> None:
        self.least = least
        self.ids = [i for i, _ in items]
        self.tokens = [word_hashes(t) for _, t in items]
        seeds = [seed_hashes(h, least) for h in self.tokens]
        flat = np.concatenate(seeds) if seeds else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(seeds)), [len(s) for s in seeds])
        place = np.concatenate([np.arange(len(s)) for s in seeds]) if seeds else np.empty(0, np.int64)
        order = np.argsort(flat, kind="stable")
        self.seeds, self.starts, self.counts = np.unique(flat[order], return_index=True, return_counts=True)
        self.item, self.place = item[order], place[order]

    def tiled(self, text: str | None, coverage: float) -> list[tuple[int, int, int, int]]:
        """(item number, tiles, covered tokens, tokens) of the items that the text covers to the given share."""
        if not text or not len(self.seeds):
            return []
        doc = word_hashes(text)
        seeds = seed_hashes(doc, self.least)
        at = np.minimum(np.searchsorted(self.seeds, seeds), len(self.seeds) - 1)
        hits = np.flatnonzero(self.seeds[at] == seeds)
        if not len(hits):
            return []
        row = at[hits]
        counts = self.counts[row]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        where = np.repeat(self.starts[row], counts) + within
        item, at_item, at_doc = self.item[where], self.place[where], np.repeat(hits, counts)
        order = np.argsort(item, kind="stable")
        item, at_item, at_doc = item[order], at_item[order], at_doc[order]
        found = []
        for part in np.split(np.arange(len(item)), np.flatnonzero(np.diff(item)) + 1):
            k = int(item[part[0]])
            tokens = self.tokens[k]
            coverable = np.zeros(len(tokens) + 1, np.int64)
            np.add.at(coverable, at_item[part], 1)
            np.add.at(coverable, at_item[part] + self.least, -1)
            if (np.cumsum(coverable)[:-1] > 0).sum() < coverage * len(tokens):
                continue
            tiles = greedy_tiles(tokens, doc, at_item[part], at_doc[part], self.least)
            covered = sum(n for _, _, n in tiles)
            if covered and covered >= coverage * len(tokens):
                found.append((k, len(tiles), covered, len(tokens)))
        return found


def index_blocks(benchmark: DataFrame, least: int = LEAST_TOKENS, block_bytes: int = BLOCK_BYTES) -> Iterator[SeedIndex]:
    """Indexes over the benchmark in blocks of about ``block_bytes`` of text, so that each can be broadcast at any size of the benchmark."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("item_id is not null and text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).distinct().orderBy("item_id", "text")
        yield SeedIndex([tuple(r) for r in block.collect()], least)


def contamination(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST_TOKENS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, n_tiles, covered_tokens, item_tokens and coverage of every pair in which tiles of the document's text
    cover at least that share of the item.

    Tokens are the lower-cased words between white space. Seeds of ``least`` tokens are joined with the broadcast
    block of the benchmark where the documents are read; there is no shuffle. Null and empty texts, and items of
    fewer than ``least`` tokens, match nothing. Rows with a null doc_id or item_id give no pairs; repeated documents
    give repeated rows; repeated items count once. Other columns are not read.
    """
    schema = "doc_id long, item_id long, n_tiles int, covered_tokens int, item_tokens int, coverage double"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where("doc_id is not null and text is not null")
    parts = []
    for index in index_blocks(benchmark, least, block_bytes):
        shared = share(docs.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = received(shared)
            for batch in slices(batches, "text"):
                out = [
                    (d, index.ids[k], n, c, m, c / m)
                    for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True)
                    for k, n, c, m in index.tiled(t, coverage)
                ]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64())
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], ["doc_id", "item_id", "n_tiles", "covered_tokens", "item_tokens", "coverage"])

        parts.append(rows.mapInArrow(run, schema))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return found


def without_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST_TOKENS) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text covers no benchmark item; rows with null texts stay."""
    for index in index_blocks(benchmark, least):
        shared = share(docs.sparkSession, index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = received(shared)
            for batch in slices(batches, "text"):
                yield batch.filter(pa.array([not index.tiled(t, coverage) for t in batch.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op7_greedy_tiling(spark: SparkSession, root: str) -> DataFrame:
    return contamination(read_table(spark, root, "documents"), read_table(spark, root, "benchmark"))
