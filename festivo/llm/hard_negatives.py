"""Hard negatives by bounds along spanning trees of the anchors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from festivo.sources.tables import read_table

from .common import Scratch, received, share
from .vectors import floors

POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95  # a negative scores from LOW to HIGH hundredths of its positive
SCALE = 256.0
BLOCK_ANCHORS = 512  # anchors of one label in a spanning tree
GROUP_BYTES = 32 << 20  # anchors sent to all tasks at a time
SHARD_ROWS = 2048
WIDER = 1 + 1e-12  # what rounding may take from a bound

FOUND = "chunk long, place int, anchor_id long, vec_id long, score long"
MINED = "chunk long, place int, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long"


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, length): a minimum spanning tree by Prim's rule, parents before children, rooted at the vector nearest to the mean.

    ``length`` bounds the distance between a vector and its parent from above; equal vectors are at distance 0.
    """
    n = len(vectors)
    root = int(((vectors - vectors.mean(0)) ** 2).sum(1).argmin())
    order, parent, length = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, reach = np.full(n, root), np.full(n, np.inf)
    outside = np.ones(n, bool)
    at = root
    for i in range(n):
        order[i], outside[at] = at, False
        away = ((vectors - vectors[at]) ** 2).sum(1)
        closer = outside & (away < reach)
        nearest[closer], reach[closer] = at, away[closer]
        if i + 1 < n:
            at = int(np.where(outside, reach, np.inf).argmin())
            parent[at], length[at] = nearest[at], math.sqrt(reach[at]) * WIDER
    return order, parent, length


class Anchors:
    """A block of anchors of one label: their vectors, their spanning tree, and once they are known, their positives."""

    def __init__(self, label: pa.Scalar, chunk: int, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.label, self.chunk, self.ids, self.vectors = label, chunk, ids, vectors
        self.order, self.parent, self.length = spanning_tree(vectors)
        self.positive_ids = np.zeros((len(ids), 0), np.int64)
        self.positive_scores = np.zeros((len(ids), 0), np.int64)

    def batch(self, place: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        """Rows about the anchors at ``place``, with the block's name."""
        named = {"label": pa.repeat(self.label, len(place)), "chunk": np.full(len(place), self.chunk), "place": place.astype(np.int32), "anchor_id": self.ids[place]}
        return pa.RecordBatch.from_pydict(named | columns)


class Shard:
    """Candidates sorted by label, with their norms."""

    def __init__(self, ids: np.ndarray, labels: list, vectors: np.ndarray) -> None:
        places: dict[object, list[int]] = {}
        for i, label in enumerate(labels):
            places.setdefault(label, []).append(i)
        order = np.array([i for own in places.values() for i in own], np.int64)
        self.ids, self.vectors = ids[order], vectors[order]
        self.norms = np.sqrt((self.vectors**2).sum(1)) * WIDER
        ends = np.cumsum([len(own) for own in places.values()])
        self.ranges = {label: (int(end) - len(own), int(end)) for (label, own), end in zip(places.items(), ends, strict=True)}

    def without(self, label: object) -> Shard:
        """The candidates of other labels, those of the label moved out."""
        if label not in self.ranges:
            return self
        begin, end = self.ranges[label]
        other = object.__new__(Shard)
        other.ids, other.vectors, other.norms = (np.concatenate([x[:begin], x[end:]]) for x in (self.ids, self.vectors, self.norms))
        return other

    def only(self, label: object) -> Shard:
        begin, end = self.ranges.get(label, (0, 0))
        other = object.__new__(Shard)
        other.ids, other.vectors, other.norms = self.ids[begin:end], self.vectors[begin:end], self.norms[begin:end]
        return other


def bounded_scores(anchors: Anchors, shard: Shard, window, take) -> int:
    """Walk the tree from the root; ``take(i, places, scores, *window)`` gets the exact scores of the candidates that may lie in ``window(i)``.

    The score of a child differs from its parent's by at most the edge's length times the candidate's norm. A candidate whose
    bounds miss the child's window is left at its bounds, from which the child's own children go on; the others are scored
    anew. Returns how many scores were computed.
    """
    vectors, candidates = anchors.vectors, shard.vectors
    dim = max(vectors.shape[1], candidates.shape[1])
    vectors, candidates = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) if x.shape[1] < dim else x for x in (vectors, candidates))
    low, high = np.empty((2, len(vectors), len(candidates)))
    done = 0
    for i in anchors.order:
        if anchors.parent[i] < 0:
            low[i], high[i] = -np.inf, np.inf
        else:
            slack = anchors.length[i] * shard.norms
            np.subtract(low[anchors.parent[i]], slack, out=low[i])
            np.add(high[anchors.parent[i]], slack, out=high[i])
        least, most = window(i)
        places = np.flatnonzero((high[i] >= least) & (low[i] <= most)) if anchors.parent[i] >= 0 else np.arange(len(candidates))
        scores = candidates[places] @ vectors[i]
        low[i, places] = high[i, places] = scores
        done += len(places)
        own = shard.ids[places] != anchors.ids[i]
        take(i, places[own], scores[own], least, most)
    return done


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(ids) > 4 * k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for start in range(0, batch.num_rows, SHARD_ROWS):
            piece = batch.slice(start, SHARD_ROWS)
            kept, parts = floors(piece.column("embedding"), SCALE)
            if len(kept):
                piece = piece.take(pa.array(kept))
                yield Shard(np.asarray(piece.column("vec_id"), np.int64), piece.column("label").to_pylist(), parts)


def _positives(shared, k: int):
    """Each anchor's k best rows of its own label among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [cloudpickle.loads(b) for b in received(shared)]
        held = [[(np.zeros(0, np.int64), np.zeros(0))] * len(b.ids) for b in blocks]
        for shard in _shards(batches):
            for block, found in zip(blocks, held, strict=True):
                own = shard.only(block.label.as_py())
                if not len(own.ids):
                    continue

                def window(i: int) -> tuple[float, float]:
                    return (found[i][1][-1] if len(found[i][1]) == k else -np.inf), np.inf

                def take(i: int, places: np.ndarray, scores: np.ndarray, lowest: float, highest: float) -> None:
                    places, scores = places[scores >= lowest], scores[scores >= lowest]
                    if len(places):
                        ids, scores = np.concatenate([found[i][0], own.ids[places]]), np.concatenate([found[i][1], scores])
                        top = best(ids, scores, k)
                        found[i] = ids[top], scores[top]

                bounded_scores(block, own, window, take)
        for block, found in zip(blocks, held, strict=True):
            place = np.repeat(np.arange(len(found)), [len(ids) for ids, _ in found])
            ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
            yield block.batch(place, {"vec_id": ids, "score": scores.astype(np.int64)})

    return run


def _negatives(shared, k: int, low: int, high: int):
    """For each anchor and positive, the k best rows of other labels in the positive's window among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [cloudpickle.loads(b) for b in received(shared)]
        windows = [(-(-low * b.positive_scores // 100), high * b.positive_scores // 100) for b in blocks]
        held = [[[(np.zeros(0, np.int64), np.zeros(0))] * b.positive_scores.shape[1] for _ in b.ids] for b in blocks]
        for shard in _shards(batches):
            for block, (least, most), found in zip(blocks, windows, held, strict=True):
                others = shard.without(block.label.as_py())
                if not len(others.ids):
                    continue
                usable = (block.positive_ids >= -(1 << 62)) & (least <= most)

                def window(i: int) -> tuple[float, float]:
                    open_ = np.flatnonzero(usable[i])
                    floor = [max(least[i, n], found[i][n][1][-1]) if len(found[i][n][1]) == k else least[i, n] for n in open_]
                    return min(floor, default=np.inf), max(most[i, open_], default=-np.inf)

                def take(i: int, places: np.ndarray, scores: np.ndarray, lowest: float, highest: float) -> None:
                    inside = (scores >= lowest) & (scores <= highest)
                    places, scores = places[inside], scores[inside]
                    if not len(places):
                        return
                    order = np.lexsort((others.ids[places], -scores))
                    ids, scores = others.ids[places][order], scores[order]
                    for n in np.flatnonzero(usable[i]):
                        begin = int(np.searchsorted(-scores, -most[i, n], side="left"))
                        end = begin + int(np.searchsorted(-scores[begin : begin + k], -least[i, n], side="right"))
                        if end > begin:
                            joint = np.concatenate([found[i][n][0], ids[begin:end]]), np.concatenate([found[i][n][1], scores[begin:end]])
                            top = best(*joint, k)
                            found[i][n] = joint[0][top], joint[1][top]

                bounded_scores(block, others, window, take)
        for block, found in zip(blocks, held, strict=True):
            flat = [(i, n, *f) for i, own in enumerate(found) for n, f in enumerate(own) if len(f[0])]
            if not flat:
                continue
            sizes = [len(ids) for _, _, ids, _ in flat]
            place, nth = np.repeat([i for i, *_ in flat], sizes), np.repeat([n for _, n, *_ in flat], sizes)
            positive = {"nth": nth.astype(np.int32), "positive_id": block.positive_ids[place, nth], "positive_score": block.positive_scores[place, nth]}
            negative = {"negative_id": np.concatenate([f[2] for f in flat]), "negative_score": np.concatenate([f[3] for f in flat]).astype(np.int64)}
            yield block.batch(place, positive | negative)

    return run


def _pack_block(key: tuple, table: pa.Table) -> pa.Table:
    """One block as a blob; a block has about BLOCK_ANCHORS rows."""
    kept, parts = floors(table.column("embedding").combine_chunks(), SCALE)
    table = table.take(pa.array(kept))
    label, chunk = key
    blob = cloudpickle.dumps(Anchors(label, chunk.as_py(), np.asarray(table.column("vec_id"), np.int64), parts))
    return pa.table({"label": pa.repeat(label, 1), "chunk": pa.repeat(chunk, 1), "blob": pa.array([blob], pa.binary())})


def _with_positives(key: tuple, blocks: pa.Table, found: pa.Table) -> pa.Table:
    """A block's blob with its anchors' positives, best first; missing ones have no window."""
    anchors = cloudpickle.loads(blocks.column("blob")[0].as_py())
    width = max(np.asarray(found.column("rank")).max(initial=0), 0) if found.num_rows else 0
    anchors.positive_ids = np.full((len(anchors.ids), width), np.iinfo(np.int64).min)
    anchors.positive_scores = np.zeros((len(anchors.ids), width), np.int64)
    if found.num_rows:
        at = np.asarray(found.column("place")), np.asarray(found.column("rank")) - 1
        anchors.positive_ids[at], anchors.positive_scores[at] = np.asarray(found.column("vec_id")), np.asarray(found.column("score"))
    return pa.table({"label": blocks.column("label"), "chunk": blocks.column("chunk"), "blob": pa.array([cloudpickle.dumps(anchors)], pa.binary())})


def hard_negatives(anchors: DataFrame, rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors among ``rows(vec_id, label, embedding)``.

    Scores are integer inner products of floor(256 * x). Positives are an anchor's best rows of its own label, negatives of a
    positive the best rows of other labels that score from ``low`` to ``high`` hundredths of it; ties go to smaller vec_ids.
    Anchors of a label are cut into blocks, each with its spanning tree. Blocks go to all tasks in groups of up to GROUP_BYTES, so
    neither the table nor all anchors are ever sent; every group reads the table twice, once for positives and once for negatives, and
    returns a few rows an anchor and task, which a ranking merges.

    Rows with a null vec_id, label or vector, or with null or non-finite components take no part. A row with the anchor's vec_id is
    none of its candidates. Repeated rows are candidates each; a repeated anchor is asked once. Shorter vectors are filled with
    zeros. Anchors without positives, and positives without a row in their window, give no rows; so does an empty table.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard_negatives")
    columns = [F.col("vec_id").cast("long"), "label", F.col("embedding").cast("array<double>")]
    finite = "NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    asked = anchors.select(*columns).where(f"vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND {finite}").distinct()
    asked = scratch.keep(asked)
    rows = rows.select(*columns).where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    size = asked.agg(F.count("*"), F.max(F.size("embedding"))).first()
    groups = max(1, math.ceil(size[0] * (size[1] or 1) * 8 / GROUP_BYTES))
    chunks = asked.groupBy("label").agg(F.ceil(F.count("*") / BLOCK_ANCHORS).alias("chunks"))
    blocks = asked.join(chunks, "label").withColumn("chunk", F.pmod(F.xxhash64("vec_id", "embedding"), "chunks"))
    label = f"label {asked.schema['label'].dataType.simpleString()}"
    blob = f"{label}, chunk long, blob binary"
    blocks = blocks.select("label", "chunk", "vec_id", "embedding").groupBy("label", "chunk").applyInArrow(_pack_block, blob)
    blocks = scratch.keep(blocks.withColumn("part", F.pmod(F.xxhash64("label", "chunk"), F.lit(groups))))
    results = Scratch(spark, "hard_negatives_found")
    for part in range(groups):
        own = blocks.where(F.col("part") == part).drop("part")
        shared = share(spark, [bytes(r.blob) for r in own.toLocalIterator()])
        best_first = Window.partitionBy("label", "chunk", "place").orderBy(F.desc("score"), "vec_id")
        found = rows.mapInArrow(_positives(shared, positives), f"{label}, {FOUND}").withColumn("rank", F.row_number().over(best_first))
        found = scratch.keep(found.where(F.col("rank") <= positives).select("label", "chunk", "place", "rank", "vec_id", "score"))
        shared.destroy()
        ready = own.groupBy("label", "chunk").cogroup(found.groupBy("label", "chunk")).applyInArrow(_with_positives, blob)
        shared = share(spark, [bytes(r.blob) for r in ready.toLocalIterator()])
        best_first = Window.partitionBy("label", "chunk", "place", "nth").orderBy(F.desc("negative_score"), "negative_id")
        mined = rows.mapInArrow(_negatives(shared, negatives, low, high), f"{label}, {MINED}").withColumn("rank", F.row_number().over(best_first))
        mined = mined.where(F.col("rank") <= negatives)
        kept = results.keep(mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        shared.destroy()
    return spark.read.schema(kept.schema).parquet(f"{results.root}/*")


def op11_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    rows = read_table(spark, root, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows.where("vec_id % 50 = 0"), rows)


SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, a.label = c.label AS alike, c.vec_id, CAST(list_inner_product(a.parts, c.parts) AS BIGINT) AS score
    FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
), ranked AS (
    SELECT anchor_id, positive_id, positive_score, n.vec_id AS negative_id, n.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
    FROM positives JOIN scored n USING (anchor_id)
    WHERE NOT n.alike AND 100 * n.score BETWEEN {LOW} * positive_score AND {HIGH} * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= {NEGATIVES}
"""
