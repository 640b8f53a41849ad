"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import crc_remainder, received, share, slices

ORDER = 4
SYMBOL_BITS = 15  # ORDER symbols fit one 64-bit key
SAMPLE_DOCS = 3000  # documents learnt from per language, in expectation
CALIBRATE = 5  # every fifth sampled document, by hash, sets the rejection limits instead of the counts
REJECT_SIGMAS = 8.0
REJECT_FLOOR = 0.5  # nats a character above the usual cross-entropy that are always accepted
SLICE = 1 << 18
PLACES = 1 << 16  # characters that are looked up together, so that a long text takes no more memory than a short one
OTHER = 1  # symbol of letters that the sample lacks; 0 is everything that is no letter
_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def letter_table() -> np.ndarray:
    """For every code point its lower-case letter, or 0."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def symbols(texts: list[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts in a row, each text led by ORDER - 1 zeros, runs of zeros folded; and the texts' starts."""
    raw = [codes(t) if t else np.empty(0, np.uint32) for t in texts]
    lengths = np.array([len(r) for r in raw], np.int64)
    flat = table[np.concatenate(raw)] if len(raw) else np.empty(0, table.dtype)
    owner = np.repeat(np.arange(len(raw)), lengths)
    first = np.zeros(len(flat), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    keep = np.ones(len(flat), bool)
    keep[1:] = (flat[1:] != 0) | (flat[:-1] != 0)
    keep[first & (flat == 0)] = False  # the lead is blank already
    flat, owner = flat[keep], owner[keep]
    sizes = np.bincount(owner, minlength=len(raw))
    starts = np.cumsum(sizes + ORDER - 1) - (sizes + ORDER - 1)
    out = np.zeros(int((sizes + ORDER - 1).sum()), np.uint64)
    out[np.arange(len(flat)) + (owner + 1) * (ORDER - 1)] = flat
    return out, starts


def keys(sym: np.ndarray) -> np.ndarray:
    """The ORDER-gram ending at each place, packed into one integer (places before ORDER - 1 are left out)."""
    n = len(sym) - ORDER + 1
    out = np.zeros(max(n, 0), np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(SYMBOL_BITS)) | sym[i : i + n]
    return out


def last(key: np.ndarray, n: int) -> np.ndarray:
    return key & np.uint64((1 << (SYMBOL_BITS * n)) - 1)


class HashArray:
    """A sorted array of hashed keys beside the rows of values, one column a language."""

    def __init__(self, key: np.ndarray, values: np.ndarray) -> None:
        hashed = key * _MIX
        order = np.argsort(hashed)
        self.hashed, self.values = hashed[order], values[order]

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers, and whether the key is there."""
        if not len(self.hashed):
            return np.zeros(len(key), np.int64), np.zeros(len(key), bool)
        hashed = key * _MIX
        at = np.minimum(np.searchsorted(self.hashed, hashed), len(self.hashed) - 1)
        return at, self.hashed[at] == hashed


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # code point -> symbol
    unigram: np.ndarray  # symbol x language, log probability
    grams: dict[int, HashArray]  # order -> log probability
    backoff: dict[int, HashArray]  # order -> log weight of the lower order after a context
    usual: np.ndarray | None = None  # cross-entropy that documents of the language have
    spread: np.ndarray | None = None  # its standard deviation over one character
    sharpness: float = 1.0

    def log_prob(self, key: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 1:
            return self.unigram[last(key, 1).astype(np.int64)]
        at, hit = self.grams[n].find(last(key, n))
        out = self.grams[n].values[at] if len(self.grams[n].hashed) else np.zeros((len(key), len(self.languages)), np.float32)
        if not hit.all():
            miss = key[~hit]
            lower = self.log_prob(miss, n - 1)
            ctx, known = self.backoff[n].find(last(miss, n) >> np.uint64(SYMBOL_BITS))
            if known.any():
                lower = lower.copy()
                lower[known] += self.backoff[n].values[ctx[known]]
            out[~hit] = lower
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy a character by text and language, and the number of characters."""
        sym, starts = symbols(texts, self.table)
        key = keys(sym)
        ends = np.append(starts[1:], len(sym))
        sizes = ends - starts - (ORDER - 1)
        inside = np.ones(len(key), bool)  # a key that ends in a text's lead belongs to no text
        lead = (starts[1:, None] + np.arange(ORDER - 1) - (ORDER - 1)).ravel()
        inside[lead] = False
        key = key[inside]
        total = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(sizes)
        begins = (np.cumsum(sizes) - sizes)[full]
        for a in range(0, len(key), PLACES):
            logs = self.log_prob(key[a : a + PLACES]).astype(np.float64)
            first, stop = np.searchsorted(begins, a, side="right") - 1, np.searchsorted(begins, a + len(logs))
            total[full[first:stop]] += np.add.reduceat(logs, np.maximum(begins[first:stop] - a, 0), axis=0)
        return -total / np.maximum(sizes, 1)[:, None], sizes

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, rejected) of each text; ``und`` without letters or without a learnt language."""
        if not self.languages:
            return [("und", 0.0, True)] * len(texts)
        cross, sizes = self.entropies(texts)
        best = cross.argmin(1)
        scaled = np.exp(-self.sharpness * (cross - cross.min(1, keepdims=True)))
        scores = scaled[np.arange(len(best)), best] / scaled.sum(1)
        limit = self.usual[best] + REJECT_FLOOR + REJECT_SIGMAS * self.spread[best] / np.sqrt(np.maximum(sizes, 1))
        odd = cross.min(1) > limit
        return [("und", 0.0, True) if not n else (self.languages[b], float(s), bool(o)) for n, b, s, o in zip(sizes, best, scores, odd, strict=True)]


def kneser_ney(counts: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray, languages: list[str], n_symbols: int) -> Model:
    """Tables of interpolated Kneser-Ney probabilities from each language's ORDER-gram keys and counts."""
    n_lang = len(languages)
    by_order: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):  # lower orders count the distinct left neighbours
        by_order[n] = [np.unique(last(k, n), return_counts=True) for k, _ in by_order[n + 1]]
    unigram = np.full((n_symbols, n_lang), 1.0 / n_symbols)
    for j, (k, c) in enumerate(by_order[1]):
        share = np.zeros(n_symbols)
        share[k.astype(np.int64)] = c
        total = share.sum()
        d = 0.75
        unigram[:, j] = np.maximum(share - d, 0) / total + d * (share > 0).sum() / total / n_symbols
    model = Model(languages, table, np.log(unigram).astype(np.float32), {}, {})
    for n in range(2, ORDER + 1):
        union = np.unique(np.concatenate([k for k, _ in by_order[n]]))
        contexts = np.unique(union >> np.uint64(SYMBOL_BITS))
        lower = np.exp(model.log_prob(union, n - 1).astype(np.float64))
        probs, weights = np.zeros((len(union), n_lang)), np.ones((len(contexts), n_lang))
        for j, (k, c) in enumerate(by_order[n]):
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            ctx = np.searchsorted(contexts, k >> np.uint64(SYMBOL_BITS))
            total = np.bincount(ctx, c, len(contexts))
            types = np.bincount(ctx, minlength=len(contexts))
            weights[:, j] = np.where(total > 0, d * types / np.maximum(total, 1), 1.0)
            probs[np.searchsorted(union, k), j] = np.maximum(c - d, 0) / total[ctx]
        where = np.searchsorted(contexts, union >> np.uint64(SYMBOL_BITS))
        model.grams[n] = HashArray(union, np.log(probs + weights[where] * lower).astype(np.float32))
        model.backoff[n] = HashArray(contexts, np.log(weights).astype(np.float32))
    return model


def learn(rows: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit the models and their rejection limits on ``rows(doc_id, text, lang)``, about ``sample_docs`` of them a language.

    The sample is drawn by a hash of the id, so it is the same at every run; counting is done by Spark, and the
    driver holds only the tables of a sample of bounded size.
    """
    spark = rows.sparkSession
    rows = rows.where("lang is not null and text is not null and doc_id is not null")
    there = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(there)
    if not languages:
        return Model([], np.zeros(1, np.uint32), np.zeros((1, 0)), {}, {})
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(min(1.0, sample_docs / there[k])))])
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.where(drawn < share[F.col("lang")]).withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATE)))
    letters = letter_table()
    shared_letters = spark.sparkContext.broadcast(letters)

    def seen(batches):
        for batch in batches:
            found = [np.unique(shared_letters.value[codes(t)]) for t in batch.column("text").to_pylist() if t]
            found = np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], ["code"])

    used = sorted(r[0] for r in rows.select("text").mapInArrow(seen, "code long").distinct().collect() if r[0])[: (1 << SYMBOL_BITS) - 2]
    ids = np.zeros(0x110000, np.uint32)
    ids[letters > 0] = OTHER
    rank = np.full(0x110000, OTHER, np.uint32)
    rank[used] = np.arange(len(used)) + OTHER + 1
    ids[letters > 0] = rank[letters[letters > 0]]
    table = spark.sparkContext.broadcast(ids)

    def count(batches):
        for batch in slices(batches, "text", SLICE):
            langs = batch.column("lang").to_pylist()
            texts = batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                out = []
                for t in (t for t, x in zip(texts, langs, strict=True) if x == lang):
                    out.append(keys(symbols([t], table.value)[0]))
                k, c = np.unique(np.concatenate(out), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k)), pa.array(k.view(np.int64)), pa.array(c.astype(np.int64))], ["lang", "key", "n"])

    grams = rows.where("part > 0").select("text", "lang").mapInArrow(count, "lang string, key long, n long")
    counted = grams.groupBy("lang", "key").agg(F.sum("n").alias("n")).toPandas()
    counts = []
    for lang in languages:
        own = counted[counted["lang"] == lang].sort_values("key")
        counts.append((own["key"].to_numpy().astype(np.uint64), own["n"].to_numpy().astype(np.int64)))
    languages, counts = zip(*[(x, c) for x, c in zip(languages, counts, strict=True) if len(c[0])], strict=True) if any(len(c[0]) for c in counts) else ((), ())
    if not languages:
        return Model([], np.zeros(1, np.uint32), np.zeros((1, 0)), {}, {})
    model = kneser_ney(list(counts), ids, list(languages), len(used) + 2)
    _calibrate(model, rows)
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    """Set the usual cross-entropy, its spread and the sharpness of the score from sampled documents not counted."""
    shared = share(rows.sparkSession, model)

    def measure(batches):
        model = received(shared)
        for batch in slices(batches, "text", SLICE):
            cross, sizes = model.entropies(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array(sizes.astype(np.int64)), pa.array(list(cross), pa.list_(pa.float64()))], ["lang", "n", "cross"]
            )

    seen = rows.where("part = 0").select("text", "lang").mapInArrow(measure, "lang string, n long, cross array<double>").where("n > 0").toPandas()
    n_lang = len(model.languages)
    model.usual, model.spread = np.full(n_lang, 3.0), np.full(n_lang, 3.0)
    for j, lang in enumerate(model.languages):
        own = seen[seen["lang"] == lang]
        if len(own) < 5:
            continue
        own_cross, n = np.array([c[j] for c in own["cross"]]), own["n"].to_numpy()
        model.usual[j] = np.average(own_cross, weights=n)
        model.spread[j] = max(np.sqrt(np.mean(n * (own_cross - model.usual[j]) ** 2)), 0.5)
    known = seen[seen["lang"].isin(model.languages)]
    if len(known):
        cross = np.array(known["cross"].tolist())
        right = np.array([model.languages.index(x) for x in known["lang"]])
        gaps = cross - cross.min(1, keepdims=True)
        best = []
        for t in (1.0, 2.0, 4.0, 8.0, 16.0, 32.0):
            logs = -t * gaps - np.log(np.exp(-t * gaps).sum(1, keepdims=True))
            best.append((logs[np.arange(len(right)), right].mean(), t))
        model.sharpness = max(best)[1]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of each row of ``docs(doc_id, text)``, in one pass without a shuffle.

    The language with the lowest cross-entropy a character wins; score is its share among the languages. A text that is
    null or has no letter is ``und`` with score 0. A document is rejected when it is ``und``, or when its cross-entropy lies
    more than REJECT_FLOOR plus REJECT_SIGMAS standard deviations (at its length) above what calibration documents of that
    language show. Ties go to the language first in order; a null doc_id is passed on; other columns are not read.
    """
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        for batch in slices(batches, "text", SLICE):
            found = model.predict(batch.column("text").to_pylist())
            columns = list(zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64()), pa.array(columns[2], pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows whose language may be learnt: those whose crc32 remainder modulo 4 is not 2."""
    return docs.where(crc_remainder("doc_id", 4) != 2).select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))


def op8_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = read_table(spark, root, "documents")
    found = identify(docs, learn(training_rows(docs)))
    held = F.coalesce(crc_remainder("doc_id", 4) == 2, F.lit(False))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not reject."""
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = received(shared)
        for batch in slices(batches, "text", SLICE):
            found = model.predict(batch.column("text").to_pylist())
            yield batch.filter(pa.array([not rejected for _, _, rejected in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
