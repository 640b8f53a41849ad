"""Hard negatives, vector codes and batched BPE, against brute force, SQL and the tokenizers library."""

from __future__ import annotations

import collections
import hashlib
import random
import sys
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from frames import documents, prose

from festivo.llm import hard_negatives as hn, registry, vector_codes as vc, word_bpe

SF = "/root/testdata/sf0.01"
VECTORS = "vec_id long, embedding array<float>, label int, rank string, place int, code string"


def vectors(spark, rows: list[tuple]):
    """(vec_id, vector, label) rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows], VECTORS).repartition(3)


def some_vectors(n: int, dim: int = 8) -> list[tuple]:
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(0.3, 0.4, dim).round(2).tolist(), int(rng.integers(3))) for i in range(n)]
    for i in range(5, n, 9):  # ties
        rows[i] = (i, rows[i - 5][1], rows[i - 3][2])
    return rows


BAD = [(90001, None, 1), (90050, [0.1, None], 1), (90100, [float("nan")] * 8, 1), (90150, [float("inf")] * 8, 2), (None, [1.0] * 8, 1), (90200, [1.0] * 8, None)]


def brute_negatives(rows: list[tuple], anchors: list[int], positives: int = 5, negatives: int = 3) -> list[tuple]:
    parts = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64), label) for i, v, label in rows]
    out = []
    for anchor, vector, label in parts:
        if anchor not in anchors:
            continue
        scored = sorted((-int(vector @ v), i, other == label) for i, v, other in parts if i != anchor)
        for low, positive, _ in [s for s in scored if s[2]][:positives]:
            found = [(i, -s) for s, i, alike in scored if not alike and 50 * -low <= 100 * -s <= 95 * -low][:negatives]
            out += [(anchor, positive, rank, i, -low, s) for rank, (i, s) in enumerate(found, 1)]
    return out


def mined(df) -> list[tuple]:
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, df.select(names).collect()))


@pytest.mark.parametrize("n", [1, 40, 600])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, n):
    monkeypatch.setattr(hn, "SHARD_ROWS", 32)
    monkeypatch.setattr(hn, "BLOCK_ANCHORS", 5)
    monkeypatch.setattr(hn, "GROUP_BYTES", 600)
    rows = some_vectors(n)
    df = vectors(spark, rows + BAD)
    anchors = list(range(0, n, 10))
    got = hn.hard_negatives(df.where("vec_id % 10 = 0"), df)
    assert mined(got) == sorted(brute_negatives(rows, anchors))


def test_repeated_rows_are_candidates_and_repeated_anchors_asked_once(spark):
    rows = some_vectors(60)
    again = [rows[3], rows[3], rows[20], (7, rows[7][1] + [0.0], rows[7][2])]
    df = vectors(spark, rows + again)
    wanted = brute_negatives(rows + [rows[3], rows[3], rows[20], rows[7]], [])
    assert wanted == []
    got = hn.hard_negatives(vectors(spark, [rows[0], rows[0]]), df)
    assert mined(got) == sorted(brute_negatives([*rows, rows[3], rows[3], rows[20], rows[7]], [0]))


def test_bounds_leave_out_what_cannot_reach_a_window():
    """Anchors of tight clusters: the walk scores few candidates anew, and misses none of the window."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-200, 200, 32).astype(float)
    anchors = hn.Anchors(None, 0, np.arange(100, 140), centre + rng.integers(-2, 3, (40, 32)))
    shard = hn.Shard(np.arange(2000), [1] * 2000, rng.integers(-200, 200, (2000, 32)).astype(float))
    exact = anchors.vectors @ shard.vectors.T
    floor = np.partition(exact, -20, axis=1)[:, -20]
    seen = {}

    def take(i, places, scores, *_):
        seen[i] = set(places[scores >= floor[i]])

    done = hn.bounded_scores(anchors, shard, lambda i: (floor[i], np.inf), take)
    assert done < 0.2 * exact.size
    assert all(seen[i] == set(np.flatnonzero(exact[i] >= floor[i])) for i in range(40))


def test_spanning_tree_is_minimal_and_ordered():
    rng = np.random.default_rng(5)
    points = rng.integers(-9, 9, (30, 3)).astype(float)
    points[4] = points[9]
    order, parent, length = hn.spanning_tree(points)
    place = {int(p): k for k, p in enumerate(order)}
    assert sorted(order) == list(range(30)) and sum(parent < 0) == 1
    assert all(parent[i] < 0 or place[int(parent[i])] < place[i] for i in range(30))
    away = np.sqrt(((points[:, None] - points) ** 2).sum(2))
    edges = sorted((away[a, b], a, b) for a in range(30) for b in range(a))
    root, total = list(range(30)), 0.0  # Kruskal's rule
    for d, a, b in edges:
        while root[a] != a:
            a = root[a]
        while root[b] != b:
            b = root[b]
        if a != b:
            root[a], total = b, total + d
    assert length.sum() == pytest.approx(total)


def brute_codes(rows: list[tuple], entries: int, rounds: int = 4) -> tuple[dict, list]:
    x = {i: np.floor(1024 * np.array(v, np.float32).astype(float)).astype(np.int64) for i, v, _ in rows}
    width = len(rows[0][1]) // 4
    ids = sorted(x)
    cut = {i: [v[p * width : (p + 1) * width] for p in range(4)] for i, v in x.items()}
    books = [[cut[i][p] for i in ids[:entries]] for p in range(4)]

    def assign(p, v):
        return min((int(((v - e) ** 2).sum()), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        sums = [collections.defaultdict(list) for _ in range(4)]
        for i in ids:
            for p in range(4):
                sums[p][assign(p, cut[i][p])[1]].append(cut[i][p])
        for p in range(4):
            for k, members in sums[p].items():
                books[p][k] = np.array([sum(int(m[c]) for m in members) // len(members) for c in range(width)])
    out = {}
    for i in ids:
        found = [assign(p, cut[i][p]) for p in range(4)]
        out[i] = "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)
    return out, books


@pytest.mark.parametrize("n", [1, 30, 400])
def test_codes_equal_brute_force(spark, n):
    rows = some_vectors(n, 16)
    df = vectors(spark, rows + [r for r in BAD if r[0] is not None and r[1] is not None and r[2] is not None and len(r[1]) != 16][:3])
    books = vc.fit(df, entries=64)
    wanted, tables = brute_codes(rows, 64)
    coded = vc.with_label_errors(vc.encode(df, books))
    got = {r.vec_id: (bytes(r.code).hex(), r.error) for r in coded.collect()}
    assert got == wanted
    assert [b.entries.astype(int).tolist() for b in books] == [[e.tolist() for e in t] for t in tables]
    sums = collections.Counter()
    for i, _, label in rows:
        sums[label] += wanted[i][1]
    assert {r.label: r.label_error for r in coded.collect()} == dict(sums)


def test_orchard_search_finds_the_nearest_entry_and_breaks_ties():
    rng = np.random.default_rng(4)
    for dim, m in ((2, 60), (16, 200), (0, 3), (3, 5)):
        entries = rng.integers(-6, 7, (m, dim)).astype(float)
        x = rng.integers(-8, 9, (500, dim)).astype(float)
        at, away = vc.Codebook(entries).nearest(x)
        full = ((x[:, None] - entries) ** 2).sum(2)
        assert (at == full.argmin(1)).all() and (away == full.min(1)).all()


def test_codes_of_odd_rows(spark):
    """Null labels are one label, null ids never begin an entry, short vectors are filled, repeated rows are rows."""
    rows = [(1, [0.5, 0.5, 0.5, 0.5], None), (2, [0.5], None), (None, [9.0, 9.0, 9.0, 9.0], None), (2, [0.5], 3), (5, [0.1] * 6, 3)]
    df = vectors(spark, rows)
    books = vc.fit(df)
    assert len(books) == 4 and books[0].entries.shape == (4, 2)
    got = vc.with_label_errors(vc.encode(df, books)).collect()
    assert len(got) == 5
    errors = {None: sum(r.error for r in got if r.label is None), 3: sum(r.error for r in got if r.label == 3)}
    assert all(r.label_error == errors[r.label] for r in got)
    assert vc.encode(df.where("vec_id < 0"), vc.fit(df.where("vec_id < 0"))).count() == 0


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_orchard_codes"])
def test_query_equals_its_sql(spark, name):
    got = registry.QUERIES[name](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    wanted = con.sql(registry.SQL[name])
    assert sorted(map(tuple, got.select(*wanted.columns).collect())) == sorted(wanted.fetchall())


LONG_WORDS = ["a" * 50_000, "ab" * 9_000 + "!" * 777, "日本語" * 3_000, " " * 9_000 + "x", "".join(random.Random(3).choices("abcdefghij", k=60_000))]
TEXTS = ["Hello, wörld!\n\n  x", " \t\n" * 500, "a <|endoftext|>b  <|endoftext|><|endoftext|>", "don't DON'T 123456 ½", "", None, "İ \x85\x1c", *LONG_WORDS]


def library(special: bool = True) -> tokenizers.Tokenizer:
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = not special
    return tokenizer


@pytest.mark.parametrize("special", [True, False])
def test_batched_bpe_equals_the_library(spark, special):
    docs = documents(spark, [*enumerate(TEXTS), (None, "nothing"), (0, TEXTS[0])])
    got = word_bpe.encode_documents(docs, special=special).collect()
    tokenizer = library(special)
    assert len(got) == len(TEXTS) + 2
    for row in got:
        ids = tokenizer.encode(("nothing" if row.doc_id is None else TEXTS[row.doc_id]) or "", add_special_tokens=False).ids
        assert np.frombuffer(row.ids, "<u4").tolist() == ids
        assert row.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_batched_bpe_digests_and_store(spark, monkeypatch):
    """A tiny store and tiny slices: words are merged again and again, with the same result."""
    monkeypatch.setattr(word_bpe, "STORE_IDS", 50)
    monkeypatch.setattr(word_bpe, "SLICE", 300)
    texts = [prose(k, 80) + " 日本 " + prose(k + 1, 9) for k in range(30)] + TEXTS[:8]
    docs = documents(spark, [*enumerate(texts)])
    tokenizer = library()
    for row in word_bpe.digests(word_bpe.encode_documents(docs)).collect():
        ids = tokenizer.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((texts[row.doc_id] or "").encode()).hexdigest()


def test_batched_bpe_of_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    wanted = dict(zip(texts, library().encode_batch(list(texts.values()), add_special_tokens=False), strict=True))
    got = registry.QUERIES["op13_batched_bpe"](spark, SF).collect()
    assert len(got) == len(texts)
    for row in got:
        assert row.ids_sha256 == hashlib.sha256(np.array(wanted[row.doc_id].ids, "<u4").tobytes()).hexdigest()


def test_decoding_of_partial_characters():
    encoder = word_bpe.Encoder(word_bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")))
    ids, offsets = encoder.encode(["日本x"])
    tokenizer = library()
    for k in range(len(ids) + 1):
        assert encoder.decode(ids[:k], np.array([0, k])) == [tokenizer.decode(ids[:k].tolist(), skip_special_tokens=False)]


def test_empty_tables_of_vectors_and_words(spark):
    empty = vectors(spark, some_vectors(3)).where("vec_id < 0")
    assert hn.hard_negatives(empty, empty).count() == 0
    assert vc.fit(empty) == []
    docs = documents(spark, [(1, "x")]).where(F.lit(False))
    assert word_bpe.digests(word_bpe.encode_documents(docs)).count() == 0
