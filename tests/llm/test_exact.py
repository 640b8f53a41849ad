"""Operators with exact results, against brute force on small tables."""

from __future__ import annotations

import collections
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken

sys.path.insert(0, str(Path(__file__).resolve().parent))

from frames import documents, prose

from festivo.llm import backoff, bpe, maxscore, repeats

LONG = [(1, prose(1, 300)), (2, None), (3, ""), (4, " "), (None, prose(1, 300)), (1, prose(1, 300)), (5, "é" * 900), (6, "short")]


def tiktoken_encoding() -> tiktoken.Encoding:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark):
    texts = ["Hello, wörld!\n\n  x", "a" * 20_000, "日本語" * 3000, " \t\n" * 500, "<|endoftext|> 123456 don't", "ab" * 5000 + "!" * 7000, None, ""]
    docs = documents(spark, [*enumerate(texts), (None, "nothing"), (0, texts[0])])
    got = bpe.encode_documents(docs).collect()
    enc = tiktoken_encoding()
    assert len(got) == len(texts) + 2
    for row in got:
        text = "nothing" if row.doc_id is None else texts[row.doc_id] or ""
        assert list(row.ids) == enc.encode_ordinary(text)
        assert bytes(row.decoded) == text.encode()
    digests = {r.doc_id: r for r in bpe.digests(bpe.encode_documents(docs)).collect()}
    assert digests[6].n_tokens == 0 and digests[6].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert digests[1].ids_sha256 == hashlib.sha256(",".join(map(str, enc.encode_ordinary(texts[1]))).encode()).hexdigest()


def test_bpe_holds_two_generations_of_pieces(monkeypatch):
    """A text of more pieces than the cache may hold, with frequent ones among them."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    tokenizer = bpe.Tokenizer(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    text = " often".join(f" rare{chr(97 + i % 26)}q{i:x}z" for i in range(2000))
    assert tokenizer.encode(text) == tiktoken_encoding().encode_ordinary(text)
    assert max(len(tokenizer.cache), len(tokenizer.older)) <= 50
    assert " often" in tokenizer.cache or " often" in tokenizer.older


def brute_repeats(texts: list[str | None], length: int = 400) -> list[tuple]:
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(d[p : p + length] for d in data for p in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def passages() -> list[tuple]:
    shared, other = prose(70, 120), prose(71, 90)
    rows = [(100 + i, prose(200 + i, 30) + shared + prose(300 + i, 40)) for i in range(20)]
    rows += [(150, other + prose(5, 80) + other), (151, "z" * 1500), (152, shared[:399]), (153, "q" + shared[:400]), (154, "y" * 399 + "x")]
    return rows + LONG


@pytest.mark.parametrize("bin_bytes", [repeats.BIN_BYTES, 3000])
def test_repeats_equal_brute_force(spark, monkeypatch, bin_bytes):
    """The small bins make the edges of the shared passage exceed a bin, so that their strings are counted by digest."""
    monkeypatch.setattr(repeats, "BIN_BYTES", bin_bytes)
    monkeypatch.setattr(repeats, "SHARD_BYTES", 2000)
    rows = passages()
    got = repeats.without_repeats(documents(spark, rows)).collect()
    found = [(r.doc_id, (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())) for r in got]
    wanted = list(zip([i for i, _ in rows], brute_repeats([t for _, t in rows]), strict=True))
    assert collections.Counter(found) == collections.Counter(wanted)


def test_shards_merge_to_the_order_of_all_suffixes(monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 700)
    segments = [(prose(k, 60) + prose(9, 100) + prose(k + 50, 20)).encode() for k in range(6)] + [prose(3, 160).encode()]
    seen = collections.Counter(s[p : p + 400] for s in segments for p in range(len(s) - 399))
    for s, flags in zip(segments, repeats.repeated_starts(segments), strict=True):
        assert flags.tolist() == [seen[s[p : p + 400]] > 1 for p in range(len(s) - 399)]


def brute_top(vectors: dict, queries: list, k: int) -> list[tuple]:
    out = []
    for q in queries:
        scores = sorted((-int(np.dot(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize("n", [1, 15, 700])
def test_maxscore_equals_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 64)
    monkeypatch.setattr(maxscore, "WARM_ROWS", 24)
    monkeypatch.setattr(maxscore, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(3)
    raw = {i: rng.normal(0, 0.3, 8).round(1).tolist() for i in range(n)}
    for i in range(5, n, 11):
        raw[i] = raw[i - 5]
    bad = [(1001, None, "a"), (1020, [0.1, None], "a"), (1040, [float("nan")] * 8, "a"), (1060, [float("inf")] * 8, "a"), (None, [1.0] * 8, "a")]
    rows = spark.createDataFrame([(i, v, "a") for i, v in raw.items()] + bad, "vec_id long, embedding array<float>, rank string").repartition(3)
    got = maxscore.top_inner_products(rows.where("vec_id % 20 = 0"), rows, 20)
    vectors = {i: np.floor(64.0 * np.array(v, np.float32).astype(float)).astype(np.int64) for i, v in raw.items()}
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect())) == sorted(brute_top(vectors, range(0, n, 20), 20))


def test_backoff_equals_relational_counts(spark):
    texts = {1: "a b c a b d", 2: "A b c", 3: "x y", 4: None, 5: "", 6: "b c a b"}
    docs = documents(spark, list(texts.items()))
    got = {r.doc_id: r for r in backoff.score_documents(docs).collect()}
    lists = {i: (t or "").lower().split() for i, t in texts.items()}

    def grams(i: int, n: int) -> collections.Counter:
        return collections.Counter(tuple(lists[i][p : p + n]) for p in range(len(lists[i]) - n + 1))

    for i, listed in lists.items():
        if not listed:
            assert got[i].n_words == 0 and got[i].score is None
            continue
        counts = collections.Counter()
        for j in lists:
            if j != i:
                for n in (1, 2, 3):
                    counts.update(grams(j, n))
        total = sum(c for g, c in counts.items() if len(g) == 1)
        logs = []
        for p, w in enumerate(listed):
            s = np.log(max(counts[(w,)], 0.5) / max(1, total))
            for n in (2, 3):
                if p >= n - 1:
                    g = tuple(listed[p - n + 1 : p + 1])
                    s = np.log(counts[g] / counts[g[:-1]]) if counts[g] else np.log(0.4) + s
            logs.append(s)
        assert got[i].n_words == len(listed)
        assert got[i].score == pytest.approx(np.mean(logs), abs=1e-9)


def test_empty_tables(spark):
    docs = documents(spark, [(1, "x")]).where("doc_id < 0")
    assert bpe.digests(bpe.encode_documents(docs)).count() == 0
    assert repeats.without_repeats(docs).count() == 0
    assert backoff.score_documents(docs).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert maxscore.top_inner_products(vectors, vectors).count() == 0


def test_bpe_merges_pieces_together_in_tiktokens_order():
    """Vocabularies whose tokens come before their parts too: where the order of merges counts, pieces are merged one by one."""
    rng = random.Random(11)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        words = sorted({"".join(rng.choices("abc", k=rng.randint(2, 5))) for _ in range(25)})
        rng.shuffle(words)
        ranks |= {w.encode(): 256 + i for i, w in enumerate(words)}
        tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN, bpe.all_merges(ranks))
        enc = tiktoken.Encoding("mixed", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        texts = [" ".join("".join(rng.choices("abc", k=rng.randint(1, 20))) for _ in range(8)) for _ in range(20)] + ["", "ab" * 200]
        ids, offsets = tokenizer.encode_all(texts)
        for text, a, b in zip(texts, offsets[:-1], offsets[1:], strict=True):
            assert ids[a:b].tolist() == enc.encode_ordinary(text)
            assert tokenizer.decode(ids[a:b]) == text.encode()


def test_new_pieces_are_merged_together(monkeypatch):
    """No merge of short pieces one by one, which took most of the encoder's time."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    tokenizer = bpe.Tokenizer(ranks, public_tokenizers.PATTERN, bpe.all_merges(ranks))
    monkeypatch.setattr(tokenizer, "merge", None)
    text = prose(3, 400) + " qzxv zzyzxq 日本語テキスト"
    assert tokenizer.encode(text) == tiktoken_encoding().encode_ordinary(text)


def test_backoff_finds_places_by_one_sort():
    """Totals and scores search no n-gram one by one."""
    values = np.array([7, 3, 7, 2**52, 3, 0], np.uint64)
    found, n = backoff.places(values)
    assert found.tolist() == [2, 1, 2, 3, 1, 0] and n == 4
    assert backoff.places(np.empty(0, np.uint64))[1] == 0
