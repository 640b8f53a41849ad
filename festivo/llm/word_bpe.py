"""Byte-level BPE of a tokenizer file in batched numpy rounds: all words of a batch are merged together in one flat array."""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import received, share, slices

SLICE = 2 << 20  # bytes of text whose words are looked up and merged together
STORE_IDS = 4 << 20  # ids of known words that a task keeps; beyond it, it starts anew
NO_RANK = np.iinfo(np.int32).max


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the ranges (start, length), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class Merges:
    """Pairs of tokens as sorted keys with their ranks and results."""

    def __init__(self, merges: list[tuple[int, int, int]], ranks: np.ndarray, tokens: dict[int, bytes], byte_ids: list[int]) -> None:
        self.size = max(tokens) + 1
        left, right, made = (np.array(c, np.int64) for c in (zip(*merges, strict=True) if merges else ([], [], [])))
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], ranks[order].astype(np.int32), made[order].astype(np.int32)
        self.byte_ids = np.array(byte_ids, np.int32)
        self.inside = np.zeros((256, 256), bool)  # adjacent bytes that some token holds
        for c in set(made.tolist()):
            b = np.frombuffer(tokens[c], np.uint8)
            self.inside[b[:-1], b[1:]] = True

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair among the sorted keys, -1 where the pair has no merge."""
        if not len(self.keys):
            return np.full(len(left), -1)
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, at, -1)

    def merge(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and offsets of the encodings of the words ``data[offsets[i]:offsets[i + 1]]``, and the words to be merged one by one instead.

        A word is cut where no token holds the two adjacent bytes; nothing can be merged across such a place. A round
        takes the lowest rank of each piece and merges all pairs of that rank in it, in a run of equal symbols every other
        one from the left, as the merges one by one would do: a pair with the new symbol has a higher rank. Where it has not, the order of
        the merges may count, and the word is among the last result. Pieces without a pair leave the arrays, so that later rounds touch what
        is left of the longest ones.
        """
        n = len(data)
        symbols = self.byte_ids[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        if n > 1:
            cut[1:n] |= ~self.inside[data[:-1], data[1:]]
        kept = np.ones(n, bool)  # which bytes begin a symbol of the result
        place = np.arange(n)
        result = symbols.copy()
        last = cut[1:].copy()  # the symbol ends its piece
        at = np.full(n, -1)
        doubtful = [np.empty(0, np.int64)]
        pairs = np.flatnonzero(~last)
        at[pairs] = self.lookup(symbols[pairs], symbols[pairs + 1])
        while len(place):
            rank = np.where(at >= 0, self.ranks[at] if len(self.ranks) else NO_RANK, NO_RANK)
            begins = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            sizes = np.diff(np.append(begins, len(place)))
            low = np.minimum.reduceat(rank, begins)
            done = low == NO_RANK
            if done.any():
                stays = np.repeat(~done, sizes)
                result[place[~stays]] = symbols[~stays]
                place, symbols, last, at, rank = place[stays], symbols[stays], last[stays], at[stays], rank[stays]
                sizes, low = sizes[~done], low[~done]
                if not len(place):
                    break
            low = np.repeat(low, sizes)
            hits = np.flatnonzero(rank == low)
            # A run of adjacent hits is a run of one symbol: take every other one.
            run = np.concatenate([[True], np.diff(hits) != 1]) | np.concatenate([[True], last[hits[:-1]]])
            first = np.flatnonzero(run)
            hits = hits[(np.arange(len(hits)) - np.repeat(first, np.diff(np.append(first, len(hits))))) % 2 == 0]
            # Of two hits side by side the left one is merged first: its pair with the first half of the other.
            beside = hits[:-1][(np.diff(hits) == 2) & ~last[hits[:-1] + 1]]
            between = self.lookup(self.made[at[beside]], symbols[beside + 2])
            beside, between = beside[between >= 0], between[between >= 0]
            doubtful.append(place[beside[self.ranks[between] <= low[beside]]])
            symbols[hits] = self.made[at[hits]]
            last[hits] = last[hits + 1]
            stays = np.ones(len(place), bool)
            stays[hits + 1] = False
            kept[place[hits + 1]] = False
            moved = np.cumsum(stays) - 1
            changed = moved[hits]
            place, symbols, last, at, low = place[stays], symbols[stays], last[stays], at[stays], low[stays]
            changed = np.concatenate([changed, changed[changed > 0] - 1])
            changed = changed[~last[changed]]
            at[moved[hits]] = -1
            at[changed] = self.lookup(symbols[changed], symbols[changed + 1])
            changed = changed[at[changed] >= 0]
            doubtful.append(place[changed[self.ranks[at[changed]] <= low[changed]]])
        counts = np.concatenate([[0], np.cumsum(kept)])
        return result[kept], counts[offsets], np.unique(np.searchsorted(offsets, np.concatenate(doubtful), side="right") - 1)


class Vocabulary(Merges):
    """Merges in the order of their ranks, the bytes of every token, and the tokens matched before all else."""

    def __init__(self, merges: list[tuple[int, int, int]], tokens: dict[int, bytes], byte_ids: list[int], added: dict[str, int], pattern: str) -> None:
        super().__init__(merges, np.arange(len(merges)), tokens, byte_ids)
        first = np.full(self.size, -1)
        first[byte_ids] = -2
        for rank, (a, b, c) in enumerate(merges):
            if first[a] == -1 or first[b] == -1 or first[c] != -1:
                raise ValueError("merges must make each token once, after its parts")
            first[c] = rank
        self.lengths = np.zeros(self.size, np.int64)
        for i, b in tokens.items():
            self.lengths[i] = len(b)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(self.size)), np.uint8)
        self.added, self.pattern = added, pattern


class Encoder:
    """Encodes slices of texts, with a bounded store of the ids of words met before."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.added = regex.compile("|".join(map(regex.escape, sorted(vocabulary.added, key=len, reverse=True)))) if vocabulary.added else None
        self.clear()

    def clear(self) -> None:
        self.known = {word: i for i, word in enumerate(self.v.added)}
        self.ids = np.array(list(self.v.added.values()), np.int32)
        self.offsets = np.arange(len(self.ids) + 1)

    def split(self, text: str) -> list[str]:
        """Words of a text; added tokens are found first, and the text between them is split on its own."""
        if self.added is None:
            return self.words.findall(text)
        found, start = [], 0
        for match in self.added.finditer(text):
            found += self.words.findall(text[start : match.start()])
            found.append(match.group())
            start = match.end()
        return found + self.words.findall(text[start:] if start else text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts."""
        if len(self.ids) > STORE_IDS:
            self.clear()
        words, counts = [], [0]
        for text in texts:
            words += self.split(text)
            counts.append(len(words))
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if new:
            raw = [w.encode("utf-8", "surrogatepass") for w in new]
            ends = np.cumsum([0, *map(len, raw)])
            ids, offsets, _ = self.v.merge(np.frombuffer(b"".join(raw), np.uint8), ends)
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + offsets[1:]])
            self.ids = np.concatenate([self.ids, ids])
        codes = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        lengths = self.offsets[codes + 1] - self.offsets[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[gather(self.offsets[codes], lengths)], ends[counts]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of the ids: the tokens' bytes one after the other, with U+FFFD for bytes that are not UTF-8."""
        lengths = self.v.lengths[ids]
        data = self.v.bytes[gather(self.v.starts[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[offsets].tolist()
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def read_vocabulary(path: str, pattern: str = public_tokenizers.PATTERN, special: bool = True) -> Vocabulary:
    """Vocabulary of a byte-level BPE file of the tokenizers library; ``special=False`` treats its special tokens as ordinary text."""
    with open(path, encoding="utf-8") as text:
        file = json.load(text)
    model, splitter = file["model"], file["pre_tokenizer"] or {}
    plain = file["normalizer"] is None and file["post_processor"] is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True)
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
    added = [t for t in file["added_tokens"] if special or not t["special"]]
    if model["type"] != "BPE" or not plain or splitter["add_prefix_space"] or any(model.get(o) for o in options):
        raise ValueError("not a plain byte-level BPE file")
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens with conditions are not supported")
    characters, ids = byte_characters(), model["vocab"]
    byte_of = {c: b for b, c in enumerate(characters)}
    tokens = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
    tokens |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    return Vocabulary(merges, tokens, [ids[c] for c in characters], {t["content"]: t["id"] for t in added}, pattern)


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN, special: bool = True) -> DataFrame:
    """doc_id, ids and decoded text of every row of ``docs(doc_id, text)``, over whole texts, in one pass without a shuffle.

    ``ids`` is binary: little-endian unsigned 32-bit integers, one after the other. A special token of the file is recognised in a
    text unless ``special`` is false. A null or empty text has no ids and decodes to an empty text. A null doc_id is
    passed on; repeated rows give equal rows; other columns are not read; an empty table gives an empty table. A long text is one
    slice of its own: memory is a few dozen times its bytes.
    """
    shared = share(docs.sparkSession, read_vocabulary(path or public_tokenizers.path("byte_bpe_50k.json"), pattern, special))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(received(shared))
        for batch in slices(batches, "text", SLICE):
            ids, offsets = encoder.encode([t or "" for t in batch.column("text").to_pylist()])
            decoded = encoder.decode(ids, offsets)
            data, ends = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
            packed = pa.array([data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), packed, pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """The query's columns from the operator's ids and texts."""
    n_tokens = F.expr("octet_length(ids) div 4").cast("long")
    return encoded.select("doc_id", n_tokens.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_batched_bpe(spark: SparkSession, root: str) -> DataFrame:
    return digests(encode_documents(read_table(spark, root, "documents")))
