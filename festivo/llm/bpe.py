"""Byte-level BPE by tree reduction: encodings of halves are joined at their boundary."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from festivo.sources.tables import read_table

from .common import received, share, slices
from .word_bpe import Merges

LEAF_BYTES = 48  # a part of a long piece up to this long is merged directly
PIECE_BYTES = 256  # new pieces up to this long are merged together, longer ones by halves
LEAF_CHARS = 4096  # a text up to this long is split by the pattern directly
CACHE_WORDS = 1 << 17  # pieces of a generation of the cache; two are held
GROUP = 1 << 16  # pieces that are looked up together
TOKENS = 1 << 20  # tokens that are decoded together
SLICE = 1 << 20
# Characters that decide a match beyond its own end: the pattern looks ahead one character past a run of white space, and
# a contraction is three characters long.
LOOK = 4

Ids = tuple[int, ...]


def all_merges(ranks: dict[bytes, int]) -> Merges | None:
    """Every pair of tokens that makes a token; None where a byte has no rank."""
    if any(bytes([b]) not in ranks for b in range(256)):
        return None
    halves = ((token[:k], token[k:], i) for token, i in ranks.items() for k in range(1, len(token)))
    found = [(ranks[a], ranks[b], i) for a, b, i in halves if a in ranks and b in ranks]
    return Merges(found, np.array([i for _, _, i in found], np.int64), {i: b for b, i in ranks.items()}, [ranks[bytes([b])] for b in range(256)])


class Tokenizer:
    """Ranks of a byte-level vocabulary, the pattern that splits a text into pieces, and a bounded cache of pieces.

    The cache and ``pack`` hold the ids of a piece as the bytes of 32-bit integers.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, merges: Merges | None = None) -> None:
        self.ranks, self.pattern, self.merges = ranks, regex.compile(pattern), merges
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.tokens = pa.array([self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)], pa.binary())
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # Pieces: the monoid of encodings of byte strings.

    def merge(self, data: bytes) -> Ids:
        """Encode a short byte string: merge the adjacent pair of lowest rank, leftmost first, until none has a rank."""
        get, none = self.ranks.get, 1 << 62
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return tuple([self.ranks[p] for p in parts])

    def encode_bytes(self, data: bytes) -> Ids:
        """Encode one piece: halves recursively, then join."""
        whole = self.ranks.get(data)
        if whole is not None:
            return (whole,)
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        middle = len(data) // 2
        return self.join(self.encode_bytes(data[:middle]), self.encode_bytes(data[middle:]))

    def join(self, left: Ids, right: Ids) -> Ids:
        """Encoding of the concatenation of two encoded strings.

        A window of tokens around the boundary is encoded anew and grows until its first token is the left neighbour's and its
        last token the right neighbour's own. Whether a sequence of tokens is the encoding of its bytes depends on
        adjacent pairs alone; every adjacent pair of the result then lies within the left encoding, the window's or the
        right one, which are encodings, so the tokens outside the window are final.
        """
        if not left or not right:
            return left or right
        reach = 2
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            window = b"".join(self.bytes_of[t] for t in chain(left[a:], right[:b]))
            found = self.merge(window) if len(window) <= 4 * LEAF_BYTES else self.merge_long(window)
            if (a == 0 or found[0] == left[a]) and (b == len(right) or found[-1] == right[b - 1]):
                return left[:a] + found + right[b:]
            reach *= 2

    def merge_long(self, data: bytes) -> Ids:
        """The merges of ``merge`` with a heap of pairs and a linked list, for long windows."""
        import heapq

        n = len(data)
        after, before, alive, end = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n, list(range(1, n + 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                rank = self.ranks.get(data[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            rank, i, stop = heapq.heappop(heap)
            if not alive[i] or after[i] >= n or end[after[i]] != stop:
                continue
            j = after[i]
            alive[j], end[i], after[i] = False, stop, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return tuple(self.ranks[data[i : end[i]]] for i in range(n) if alive[i])

    # Texts: the monoid of splits into pieces.

    def split(self, text: str) -> list[str]:
        """Pieces of a text: halves recursively, then join."""
        if len(text) <= LEAF_CHARS:
            return self.pattern.findall(text)
        middle = len(text) // 2
        return self.join_pieces(self.split(text[:middle]), self.split(text[middle:]))

    def join_pieces(self, left: list[str], right: list[str]) -> list[str]:
        """Pieces of the concatenation of two split texts.

        A piece starts where the one before it ends, and depends on no more than LOOK characters past its end. So pieces of
        the left that end LOOK characters before its end stay. The window from there is split anew and grows to the right until
        one of its pieces, LOOK characters before the window's end, ends where a piece of the right ends: the pieces after it
        stay as well.
        """
        keep, tail = len(left), 0
        while keep and tail < LOOK:
            keep -= 1
            tail += len(left[keep])
        reach = 2
        while True:
            taken = right[:reach]
            window = "".join(chain(left[keep:], taken))
            found = self.pattern.findall(window)
            if reach >= len(right):
                return left[:keep] + found
            ends, at = {}, tail
            for k, piece in enumerate(taken):
                at += len(piece)
                ends[at] = k + 1
            at = 0
            for k, piece in enumerate(found):
                at += len(piece)
                if at > len(window) - LOOK:
                    break
                if at in ends:
                    return left[:keep] + found[: k + 1] + right[ends[at] :]
            reach *= 4

    def encode_new(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of pieces that the cache does not hold: short ones that are no token are merged all together where the order is the same."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        together = [b for b in raw if self.merges and len(b) <= PIECE_BYTES and b not in self.ranks]
        if together:
            ids, ends, doubtful = self.merges.merge(np.frombuffer(b"".join(together), np.uint8), np.cumsum([0, *map(len, together)]))
            data, ends = ids.astype(np.int32).tobytes(), (ends * 4).tolist()
            merged = dict(zip(together, map(data.__getitem__, map(slice, ends[:-1], ends[1:])), strict=True))
            for i in doubtful.tolist():
                del merged[together[i]]
        else:
            merged = {}
        return (merged[b] if b in merged else np.array(self.encode_bytes(b), np.int32).tobytes() for b in raw)

    def pack(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece. A piece of the older generation moves to the new one, which becomes the older one when it is full: frequent
        pieces stay, and a text of many rare ones takes no more memory than two generations."""
        out, step = [], min(GROUP, CACHE_WORDS)
        for start in range(0, len(pieces), step):
            group = pieces[start : start + step]
            wanted = set(group)
            missing = wanted.difference(self.cache)
            if len(self.cache) + len(missing) > CACHE_WORDS:
                self.cache, self.older, missing = {}, self.cache, wanted
            new = list(missing.difference(self.older))
            self.cache |= {p: self.older[p] for p in missing.difference(new)}
            self.cache |= zip(new, self.encode_new(new), strict=True)
            out += map(self.cache.__getitem__, group)
            for piece in new:
                if len(piece) > 64:
                    del self.cache[piece]
        return out

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts."""
        pieces, ends = [], [0]
        for text in texts:
            pieces += self.split(text)
            ends.append(len(pieces))
        packed = self.pack(pieces)
        data = [b"".join(packed[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return np.frombuffer(b"".join(data), np.int32), np.cumsum([0, *[len(d) // 4 for d in data]])

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        return self.encode_all([text])[0].tolist()

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids, some tokens at a time."""
        parts = []
        for start in range(0, len(ids), TOKENS):
            taken = self.tokens.take(pa.array(ids[start : start + TOKENS]))
            _, ends, data = taken.buffers()
            ends = np.frombuffer(ends, np.int32)
            parts.append(data.to_pybytes()[ends[0] : ends[len(taken)]] if data else b"")
        return b"".join(parts)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, ids and decoded bytes of every row of ``docs(doc_id, text)``, over whole texts, in one pass without a shuffle.

    A null text is encoded as an empty one. A null doc_id is passed on; repeated rows give equal rows; other columns are not read.
    """
    ranks = read_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    shared = share(docs.sparkSession, (ranks, pattern, all_merges(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(*received(shared))
        for batch in slices(batches, "text", SLICE):
            ids, offsets = tokenizer.encode_all([t or "" for t in batch.column("text").to_pylist()])
            decoded = [tokenizer.decode(ids[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, pa.array(decoded, pa.binary())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """The query's columns from the operator's ids and bytes."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_byte_bpe(spark: SparkSession, root: str) -> DataFrame:
    return digests(encode_documents(read_table(spark, root, "documents")))
