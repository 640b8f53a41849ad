"""Near-duplicate documents and lines, and benchmark passages, against brute force."""

from __future__ import annotations

import random
import re
import sys
from itertools import combinations
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from frames import documents, prose, words

from festivo.llm import graph, lines, minhash, tiling
from festivo.llm.common import Scratch


def components(ids, links) -> dict:
    top = {i: i for i in ids}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        top[high] = low
    return {i: find(i) for i in ids}


def edited(seed: int, base: list[str], edits: int) -> list[str]:
    rng, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = f"edit{rng.randrange(10**6)}"
    return out


def near_rows() -> list[tuple]:
    base, rows = words(1, 400), []
    rows += [(10 + i, " ".join(edited(i, base, i % 9))) for i in range(40)]
    rows += [(100 + i, " ".join(base).upper() + ("\n\t" if i % 2 else " ")) for i in range(5)]
    rows += [(200 + i, prose(500 + i, 60)) for i in range(30)]
    chain = words(2, 300)
    for i in range(12):
        chain = [*chain[20:], *words(900 + i, 20)]
        rows.append((300 + i, " ".join(chain)))
    rows += [(400, "one two"), (401, "One  Two"), (402, "one two three"), (403, ""), (404, None), (405, " \n"), (406, ""), (None, " ".join(base))]
    return rows


def shingles(text: str | None) -> frozenset:
    listed = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not listed:
        return frozenset()
    return frozenset(tuple(listed[i : i + 5]) for i in range(max(1, len(listed) - 4)))


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    sets = {i: shingles(t) for i, t in rows if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    wanted = components(sets, links)
    assert len(set(wanted.values())) < len(wanted) - 40
    got = minhash.near_duplicates(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), wanted[r.doc_id], wanted[r.doc_id] == r.doc_id), r.doc_id


def test_one_document_of_each_group_stays_with_all_columns(spark):
    docs = documents(spark, near_rows() + [(10, near_rows()[0][1])])
    kept = minhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert len(named) == len(set(named)) and {403, 404, 405, 406, 400, 402} <= set(named) and 401 not in named and None in ids


def test_packed_estimate_is_close(spark):
    a, b = words(5, 3000, 10**6), words(6, 3000, 10**6)
    left, right = " ".join(a + b[:600]), " ".join(a + b[600:1200])
    sets = [minhash.shingle_set(t) for t in (left, right)]
    sigs = [minhash.packed(minhash.minima(s) & ((1 << minhash.BITS) - 1)) for s in sets]
    frame = spark.createDataFrame([tuple([int(v) for v in s.view("int64")] for s in sigs)], "a array<long>, b array<long>")
    true = len(set(sets[0]) & set(sets[1])) / len(set(sets[0]) | set(sets[1]))
    assert abs(frame.select(minhash.estimate("a", "b")).first()[0] - true) < 0.15


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)] + [(7, 7)]
    frame = spark.createDataFrame(links + links[:5] + [(None, 3)], "a long, b long")
    got = {r.node: r.component for r in graph.connected_components(frame, Scratch(spark, "test")).collect()}
    wanted = components({i for l in links for i in l}, links)
    assert got == {i: c for i, c in wanted.items() if any(i in l and l[0] != l[1] for l in links)}
    assert graph.connected_components(frame.where("a < 0"), Scratch(spark, "test")).count() == 0


def line_rows() -> list[tuple]:
    base = re.sub("[0-9]", lambda m: "klmnopqrst"[int(m[0])], prose(77, 60))
    changed = base.split()
    changed[20] = "altogether"
    near = [base, f"{base} extra", base, f"{base} other", " ".join(changed), base.replace(" ", ", ")]
    rows = [(i, f"{prose(i, 30, 10**6)}\n{line}!\nshort\n{prose(i + 50, 30, 10**6)}") for i, line in enumerate(near)]
    chairs = [(30 + k, f"Price of the blue chair is {n}\nOf.\n---\n") for k, n in enumerate((100, 250, 100))]
    return rows + chairs + [(20, f"{base.upper()}\n\n{base}\nshort"), (21, None), (22, ""), (23, "short\nshort"), (None, base), (24, f"{base}\n"), (25, f"{base} 7"), (24, f"{base}\n")]


def levenshtein(a: str, b: str) -> int:
    while a and b and a[0] == b[0]:  # what they begin and end with alike costs nothing
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_lines_equal_brute_force(spark):
    """Links are recomputed over all pairs from the definition alone; near lines of the rows differ in one word."""
    rows = line_rows()
    docs = documents(spark, rows)
    texts = {(i, p): re.sub(r"[^a-z0-9]+", " ", s.lower()).strip() for i, t in rows if i is not None and t for p, s in enumerate(t.split("\n"))}
    texts = {k: s for k, s in texts.items() if s}
    links = []
    for a, b in combinations(sorted(texts), 2):
        x, y = texts[a], texts[b]
        alike = min(len(x), len(y)) >= lines.MIN_CHARS and re.findall("[0-9]+", x) == re.findall("[0-9]+", y)
        if x == y or alike and 1 - levenshtein(x, y) / max(len(x), len(y)) >= lines.SIMILARITY:
            links.append((a, b))
    wanted = components(sorted(texts), links)
    assert any(texts[a] != texts[b] for a, b in links)
    got = lines.without_repeated_lines(docs)
    assert got.columns == [*docs.columns, "_n_lines", "_n_removed"]
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        text = dict(rows)[r.doc_id]
        assert (r.row, r.score, r.bin, r._key) == ("x", 0.5, 3, None)
        if r.doc_id is None or text is None:
            assert r.text == text and r._n_removed == 0
            continue
        kept = [s for p, s in enumerate(text.split("\n")) if wanted.get((r.doc_id, p), (r.doc_id, p)) == (r.doc_id, p)]
        assert r.text == "\n".join(kept) and r._n_removed == r._n_lines - len(kept)
    by = {r.doc_id: r.text for r in found}
    assert [by[30], by[31], by[32]] == ["Price of the blue chair is 100\nOf.\n---\n", "Price of the blue chair is 250\n---\n", "---\n"]
    again = lines.without_repeated_lines(got)
    assert again.columns == got.columns and {r._n_removed for r in again.collect()} == {0}


@pytest.mark.parametrize("n_words", [8, 12, 30, 120])
def test_lines_of_one_changed_word_are_found(spark, n_words):
    """Recall over lines of which a copy has one word replaced; unrelated lines all stay."""
    rng = random.Random(n_words)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, pairs = [], 120
    for k in range(pairs):
        line = ["".join(rng.choices(letters, k=rng.randrange(4, 9))) for _ in range(n_words)]
        copy = list(line)
        copy[rng.randrange(n_words)] = "".join(rng.choices(letters, k=5))
        rows += [(k, " ".join(line)), (pairs + k, " ".join(copy))]
    got = {r.doc_id: r._n_removed for r in lines.without_repeated_lines(documents(spark, rows)).collect()}
    close = [k for k in range(pairs) if n_words > 8 or 1 - levenshtein(dict(rows)[k], dict(rows)[pairs + k]) / max(len(dict(rows)[k]), len(dict(rows)[pairs + k])) >= lines.SIMILARITY]
    assert not any(got[k] for k in range(pairs))
    assert sum(got[pairs + k] for k in close) >= 0.9 * len(close) > 0


@pytest.mark.parametrize(("n_words", "changes"), [(30, 3), (75, 6), (75, 10)])
def test_lines_of_several_changed_words_are_found(spark, n_words, changes):
    """Recall over lines whose changes are spread over all blocks; unrelated lines all stay."""
    rng = random.Random(n_words + changes)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, pairs = [], 100
    for k in range(pairs):
        line = ["".join(rng.choices(letters, k=rng.randrange(4, 9))) for _ in range(n_words)]
        copy = list(line)
        for i in rng.sample(range(n_words), changes):
            copy[i] = "".join(rng.choices(letters, k=5))
        rows += [(k, " ".join(line)), (pairs + k, " ".join(copy))]
    text = dict(rows)
    close = [k for k in range(pairs) if 1 - levenshtein(text[k], text[pairs + k]) / max(len(text[k]), len(text[pairs + k])) >= lines.SIMILARITY]
    got = {r.doc_id: r._n_removed for r in lines.without_repeated_lines(documents(spark, rows)).collect()}
    assert len(close) > 90 and not any(got[k] for k in range(pairs))
    assert sum(got[pairs + k] for k in close) >= 0.95 * len(close)


@pytest.mark.parametrize("n_words", [3, 5])
def test_short_lines_with_a_changed_letter_are_found(spark, n_words):
    """Links of lines of few words: the blocks that a changed word leaves alone may hold one word or none."""
    rng = random.Random(n_words)
    letters, pairs, rows = "abcdefghijklmnopqrstuvwxyz", 60, []
    for k in range(pairs):
        line = ["".join(rng.choices(letters, k=rng.randrange(7, 10))) for _ in range(n_words)]
        copy = list(line)
        copy[k % n_words] = copy[k % n_words][:-1] + ("a" if copy[k % n_words][-1] != "a" else "b")
        rows += [(k, " ".join(line)), (pairs + k, " ".join(copy))]
    rows = [(i, t) for i, t in rows if len(t) >= lines.MIN_CHARS]
    got = {r.doc_id: r._n_removed for r in lines.without_repeated_lines(documents(spark, rows)).collect()}
    assert {i: n for i, n in got.items()} == {i: int(i >= pairs) for i, _ in rows}


def test_simhash_blocks_are_majorities_of_word_bits(spark):
    line = "alpha beta gamma delta alpha epsilon zeta 12"
    got = lines.distinct_lines(lines.occurrences(documents(spark, [(1, line), (2, line)]).select("doc_id", "text"))).collect()
    assert len(got) == 1 and got[0].n == 2 and (got[0].doc_id, got[0].place) == (1, 0)
    hashed = [r[0] & (2**64 - 1) for r in spark.createDataFrame([(w,) for w in line.split()], "w string").selectExpr("xxhash64(w)").collect()]
    places = {p: 15 + p for p in (*range(lines.LANES), *range(32, 32 + lines.LANES))}  # bit of the word's hash -> bit of the block
    for block in range(lines.BLOCKS):
        mine = [h for h in hashed if h >> 62 == block]
        assert got[0][f"n{block}"] == len(mine)
        assert got[0][f"b{block}"] == sum(1 << k for p, k in places.items() if 2 * sum(h >> p & 1 for h in mine) > len(mine))


def test_sketches_and_middles_keep_every_link_of_a_bucket(spark):
    """All pairs of one bucket: the sketches part most unrelated lines, and what passes is linked as the edit distance has it."""
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghiklmnoprstué", k=rng.randrange(2, 9))) for _ in range(9)) for _ in range(40)]
    for t in texts[:20]:
        copy = list(t)
        for _ in range(rng.randrange(1, 12)):
            copy[rng.randrange(len(copy))] = rng.choice("xyz ")
        texts += ["".join(copy), t[5:] + t[:5], f"{t}{t[:4]}", t[:1]]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, norm string")
    drawn = rows.join(lines.sketches(rows), "id", "left").na.fill(0).withColumn("chars", F.length("norm"))
    pairs = drawn.join(drawn.select(*[F.col(c).alias(f"x_{c}") for c in drawn.columns]), F.col("x_id") < F.col("id"))
    passed = pairs.where(lines.may_be_near("x_", lines.SIMILARITY)).select("id", "x_id", "norm", "x_norm")
    got = {(r.x_id, r.id) for r in lines.near_texts(passed, "norm", "x_norm", lines.SIMILARITY).collect()}
    wanted = {(i, j) for i, j in combinations(range(len(texts)), 2) if 1 - levenshtein(texts[i], texts[j]) / max(len(texts[i]), len(texts[j])) >= lines.SIMILARITY - 1e-9}
    assert got == wanted and len(wanted) > 40
    assert passed.count() < 0.2 * pairs.count()


def test_no_step_is_worked_out_twice(spark):
    """A pair's common start and end are looked for once, and a line is normalised once, however often later steps mention them."""

    def plan(frame) -> str:
        return frame._jdf.queryExecution().executedPlan().toString()

    lists = spark.createDataFrame([(1, "a b", "a c")], "id long, norm string, x_norm string").repartition(2)
    confirmed = plan(lines.near_texts(lists, "norm", "x_norm", lines.SIMILARITY))
    assert 0 < confirmed.count("aggregate(") <= 2 and 0 < confirmed.count("levenshtein(") <= 3
    assert plan(lines.occurrences(documents(spark, [(1, "a")]).select("doc_id", "text"))).count("regexp_replace(") == 1
    odd = ["Ⓐ ⓑ", "١٢", "İ", "\u0301", "Ⅻ", "_-—", "ªº", "²", "\U0001d400", "-", " "]
    got = lines.occurrences(documents(spark, [(1, "\n".join(odd))]).select("doc_id", "text")).collect()
    assert {r.place for r in got} == {1, 2, 3, 4, 6, 7, 8}


def test_a_very_long_line(spark):
    line = prose(5, 20_000)
    got = lines.without_repeated_lines(documents(spark, [(1, line), (2, f"{line} "), (3, "x\n" * 5000)]))
    assert {r.doc_id: (r._n_lines, r._n_removed) for r in got.collect()} == {1: (1, 0), 2: (1, 1), 3: (5001, 4999)}


def brute_tiles(item: list[str], doc: list[str], least: int) -> list[int]:
    """Lengths of the tiles, from the definition: the longest unmarked common run again and again."""
    free_item, free_doc, found = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        n, i, j = best[0], -best[1], -best[2]
        if n < least:
            return found
        free_item[i : i + n] = free_doc[j : j + n] = [False] * n
        found.append(n)


def test_tiles_equal_brute_force(spark):
    rng = random.Random(8)
    items = {k: words(40 + k, 60, 12 if k == 3 else 400) for k in range(5)}
    docs = []
    for k, item in items.items():
        cut = rng.randrange(20, 40)
        docs.append((10 + k, " ".join([*words(k, 30), *item[cut:], *words(k + 9, 10), *item[:cut], *words(k, 5)]).title()))
        docs.append((20 + k, " ".join([*words(k, 30), *item[:20], *words(k + 9, 40)])))
    docs += [(30, None), (31, ""), (None, " ".join(items[0])), (10, docs[0][1]), (32, " ".join(items[1] * 3))]
    bench = spark.createDataFrame([(k, " ".join(v), "x") for k, v in items.items()] + [(0, " ".join(items[0]), "x"), (8, None, "x"), (9, "a b", "x"), (None, "a b c d e f", "x")], "item_id long, text string, doc_id string")
    frame = documents(spark, docs)
    got = tiling.contamination(frame, bench, block_bytes=400).collect()
    wanted = []
    for i, text in docs:
        if i is None or not text:
            continue
        for k, item in items.items():
            found = brute_tiles(item, text.lower().split(), 5)
            if sum(found) >= 0.5 * len(item):
                wanted.append((i, k, len(found), sum(found), len(item)))
    assert sorted((r.doc_id, r.item_id, r.n_tiles, r.covered_tokens, r.item_tokens) for r in got) == sorted(wanted)
    assert {10, 11, 12, 13, 14} <= {w[0] for w in wanted} and not {20, 21, 22, 24} & {w[0] for w in wanted}
    kept = tiling.without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {30, 31, 20} <= set(ids) and not {10, 14, 32, None} & set(ids)


def test_near_duplicates_keep_columns_of_any_name(spark):
    text = prose(3, 40)
    rows = [(1, text, "a", 7, "k"), (2, text, "b", 8, "k"), (3, prose(4, 40), "c", 9, "k"), (3, prose(4, 40), "c", 9, "k"), (None, text, "d", 10, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id string, _row int, key string")
    got = minhash.without_near_duplicates(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r._id, r._row, r.key) for r in got.collect()) == [(0, "d", 10, "k"), (1, "a", 7, "k"), (3, "c", 9, "k")]


@pytest.mark.parametrize("empty", ["docs", "benchmark"])
def test_empty_tables(spark, empty):
    docs = documents(spark, [(1, prose(1, 50))])
    bench = spark.createDataFrame([(1, prose(1, 50))], "item_id long, text string")
    if empty == "docs":
        docs = docs.where("doc_id < 0")
        assert minhash.near_duplicates(docs).count() == 0
        assert lines.without_repeated_lines(docs).count() == 0
    else:
        bench = bench.where("item_id < 0")
    assert tiling.contamination(docs, bench).count() == 0
    assert tiling.without_contaminated(docs, bench).count() == (empty == "benchmark")
