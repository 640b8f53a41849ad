"""Toxicity from averaged subword embeddings and a linear softmax."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import crc_remainder, slices

SIZES = (3, 4, 5, 6)  # bytes of a subword
BUCKET_BITS = 18
DIM = 8
SAMPLE = {1: 1500, 0: 4000}  # documents learnt from by label, in expectation
STEPS, BATCH, RATE, DECAY = 1200, 32, 0.02, 1e-4
GAIN = 50.0  # scale of the averaged vector: a passage of few toxic words moves the average little
THRESHOLD = 0.7
SLICE = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def subwords(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all subwords of all texts, and the number of the text that each belongs to.

    A subword is a run of SIZES bytes of the lower-cased text in which white space may only be the first or last byte, so
    that beginnings and ends of words have subwords of their own.
    """
    raw = [b" " + t.lower().encode("utf-8", "surrogatepass") + b" " if t else b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    text_at = np.repeat(np.arange(len(raw), dtype=np.int32), [len(r) for r in raw])
    blanks = np.concatenate(([0], np.cumsum(_SPACE[data])))
    key = data.astype(np.uint64)
    places, buckets = [], []
    for size in range(2, max(SIZES) + 1):
        n = len(data) - size + 1
        if n <= 0:
            break
        key = (key[:n] << np.uint64(8)) | data[size - 1 :]
        if size in SIZES:
            at = np.flatnonzero(blanks[size - 1 : size - 1 + n] == blanks[1 : n + 1])
            places.append(at)
            mixed = (key[at] ^ np.uint64(size << 56)) * np.uint64(0x9E3779B97F4A7C15)
            buckets.append((mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))
    if not places:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(buckets), text_at[np.concatenate(places)]


@dataclass
class Model:
    vectors: np.ndarray  # bucket x DIM
    weights: np.ndarray  # DIM x 2
    bias: np.ndarray  # 2

    def subword_scores(self) -> np.ndarray:
        """What a subword adds to the log odds of the toxic class, before averaging."""
        return (GAIN * self.vectors @ (self.weights[:, 1] - self.weights[:, 0])).astype(np.float32)

    def offset(self) -> float:
        return float(self.bias[1] - self.bias[0])


def train(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, seed: int = 1) -> Model:
    """Fit subword vectors and softmax together by Adam on the cross-entropy. ``bags``: distinct buckets and their shares."""
    rng = np.random.default_rng(seed)
    params = [
        rng.normal(0, 0.05, (1 << BUCKET_BITS, DIM)).astype(np.float32),
        rng.normal(0, 0.5, (DIM, 2)).astype(np.float32),
        np.zeros(2, np.float32),
    ]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    while step < STEPS:
        order = rng.permutation(len(bags))
        for start in range(0, len(order), BATCH):
            rate = RATE * max(0.0, 1 - step / STEPS)
            chosen = order[start : start + BATCH]
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] for i in chosen]) * np.float32(GAIN)
            sizes = np.array([len(bags[i][0]) for i in chosen])
            starts = np.cumsum(sizes) - sizes
            rows = params[0][ids]
            means = np.add.reduceat(rows * share[:, None], starts, axis=0)
            logits = means @ params[1] + params[2]
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), toxic[chosen]] -= 1
            p /= len(chosen)
            back = (p @ params[1].T).astype(np.float32)
            touched, inverse = np.unique(ids, return_inverse=True)
            spread = np.repeat(back, sizes, axis=0) * share[:, None]
            grad = np.stack([np.bincount(inverse, spread[:, d], len(touched)) for d in range(DIM)], 1).astype(np.float32)
            step += 1
            for k, (where, g) in enumerate(((touched, grad + DECAY * params[0][touched]), (slice(None), means.T @ p), (slice(None), p.sum(0)))):
                m, v = moments[k]
                m[where] = 0.9 * m[where] + 0.1 * g
                v[where] = 0.999 * v[where] + 0.001 * g * g
                params[k][where] -= rate * (m[where] / (1 - 0.9**step)) / (np.sqrt(v[where] / (1 - 0.999**step)) + 1e-8)
    return Model(*params)


def learn(docs: DataFrame, labels: DataFrame, sample: dict[int, int] | None = None) -> Model:
    """Fit a model on ``docs(doc_id, text)`` labelled by ``labels(doc_id, toxic)``.

    About ``sample[label]`` labelled documents of either class are drawn by a hash of the id; every other label is ignored. Subword
    bags of whole texts are made by Spark (a count beyond 32767 is taken as that); the driver fits on those of the bounded sample. Rows with a null id or label
    take no part. With a class missing, the model scores every text 0.5.
    """
    labels = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id is not null and toxic in (0, 1)").distinct()
    there = {r[0]: r[1] for r in labels.groupBy("toxic").count().collect()}
    if len(there) < 2:
        return Model(np.zeros((1 << BUCKET_BITS, DIM), np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32))
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = [min(1.0, (sample or SAMPLE)[k] / there[k]) for k in (0, 1)]
    chosen = labels.where(drawn < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    chosen = F.broadcast(chosen)  # as many rows as the sample, by construction
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(chosen, "doc_id").select("doc_id", "text", "toxic")

    def counted(batches):
        for batch in slices(batches, "text", SLICE):
            ids, owner = subwords(batch.column("text").to_pylist())
            order = np.argsort(owner, kind="stable")
            ends = np.cumsum(np.bincount(owner, minlength=batch.num_rows))
            found = [np.unique(x, return_counts=True) for x in np.split(ids[order], ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array([k for k, _ in found], pa.list_(pa.int32())), pa.array([np.minimum(c, 32767).astype(np.int16) for _, c in found], pa.list_(pa.int16()))],
                ["doc_id", "toxic", "ids", "n"],
            )

    seen = rows.mapInArrow(counted, "doc_id long, toxic int, ids array<int>, n array<short>").where("size(ids) > 0").toArrow()
    if not seen.num_rows:
        return Model(np.zeros((1 << BUCKET_BITS, DIM), np.float32), np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32))
    seen = seen.take(pa.compute.sort_indices(seen.select(["doc_id", "toxic"]), [("doc_id", "ascending"), ("toxic", "ascending")]))
    counts = [np.asarray(x.values, np.float32) for x in seen.column("n")]
    bags = [(np.asarray(x.values), n / n.sum()) for x, n in zip(seen.column("ids"), counts, strict=True)]
    return train(bags, seen.column("toxic").to_numpy().astype(np.int64))


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row of ``docs(doc_id, text)``, over the whole text, in one pass without a shuffle.

    A null or empty text has no subwords and gets the model's offset alone. A null doc_id is passed on; repeated
    rows get equal scores; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.subword_scores(), model.offset()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, offset = shared.value
        for batch in slices(batches, "text", SLICE):
            ids, owner = subwords(batch.column("text").to_pylist())
            sizes = np.bincount(owner, minlength=batch.num_rows)
            sums = np.bincount(owner, scores[ids], minlength=batch.num_rows)
            odds = sums / np.maximum(sizes, 1) + offset
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")


def op1_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    labels = read_table(spark, root, "labels").where(crc_remainder("doc_id", 3) != 1)
    scored = score_texts(docs, learn(docs, labels))
    held = F.coalesce(crc_remainder("doc_id", 3) == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
