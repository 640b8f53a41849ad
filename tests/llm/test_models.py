"""Learnt operators on small tables of their own, page text, and the pipeline."""

from __future__ import annotations

import random
import sys
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from frames import documents, prose

import corpus_pipeline
from festivo.llm import html_text, language, registry, toxicity
from festivo.llm.common import slices

ROOT = "/root/testdata/sf0.001"


def test_toxicity_sees_misspellings(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "STEPS", 250)
    rng = random.Random(1)
    rows = [(i, prose(i, 40) + (" " + rng.choice(["horridword", "vilephrase"]) + " ") * (2 * (i % 2)) + prose(i + 1000, 20)) for i in range(240)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)] + [(None, 1), (3, None), (0, 7)], "doc_id long, toxic int")
    model = toxicity.learn(documents(spark, rows), labels)
    probes = [(1, prose(9001, 50) + " horridwordd horriddword"), (2, prose(9002, 50)), (3, None), (4, ""), (None, "x"), (1, prose(9001, 50) + " horridwordd horriddword"), (5, prose(9003, 50) + " vilephrases")]
    got = toxicity.score_texts(documents(spark, probes), model).collect()
    scores = {r.doc_id: r.score for r in got}
    assert len(got) == len(probes) and all(0 <= r.score <= 1 for r in got)
    assert min(scores[1], scores[5]) > 0.5 > scores[2]
    assert scores[3] == scores[4]


def test_toxicity_without_a_class_or_rows(spark):
    docs = documents(spark, [(1, "a b c"), (2, None)])
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_texts(docs, toxicity.learn(docs, labels)).collect()} == {0.5}
    assert toxicity.score_texts(docs.where("doc_id < 0"), toxicity.learn(docs, labels.where("doc_id < 0"))).count() == 0


TONGUES = {"aa": "kalu mirena toba sifu ledano", "bb": "strong brith thwack glym frosk", "cc": "ουρανος θαλασσα βουνο δεντρο ποταμι"}


def spoken(lang: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(TONGUES[lang].split()) for _ in range(n))


def test_language_and_rejection(spark):
    rows = [(i, spoken(lang, i, 30), lang) for i, lang in enumerate(sorted(TONGUES) * 60)] + [(900, None, "aa"), (901, "kalu", None), (None, "kalu toba", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.learn(docs)
    probes = [(lang, spoken(lang, 10_000 + k, 12)) for k, lang in enumerate(sorted(TONGUES) * 4)]
    asked = [*[(k, t) for k, (_, t) in enumerate(probes)], (50, None), (51, ""), (52, "12 34 !?"), (53, "qqxzj zzqvx jjqxz wqzxj vvqzx " * 20), (None, spoken("aa", 1, 9))]
    got = {r.doc_id: r for r in language.identify(documents(spark, asked), model).collect()}
    assert [got[k].lang_pred for k in range(len(probes))] == [lang for lang, _ in probes]
    assert not any(got[k].rejected for k in range(len(probes)))
    assert all((got[k].lang_pred, got[k].score, got[k].rejected) == ("und", 0.0, True) for k in (50, 51, 52))
    assert got[53].rejected and got[None].lang_pred == "aa"
    frame = documents(spark, asked)
    kept = language.accepted(frame, model)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} == {*range(len(probes)), None}
    assert language.identify(frame.where("doc_id < 0"), model).count() == 0


def test_language_memory_is_bounded(spark, monkeypatch):
    """Two million letters, in one text or in many, take a few times their own size at most; parts of any size give the same entropies."""
    rows = [(i, spoken(lang, i, 30), lang) for i, lang in enumerate(sorted(TONGUES) * 60)]
    model = language.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["", None, *[spoken(lang, k, 1 + 7 * k) for k, lang in enumerate(sorted(TONGUES) * 3)], "9", "k", spoken("aa", 1, 40)]
    whole, sizes = model.entropies(texts)
    for places in (1, 5, 64):
        monkeypatch.setattr(language, "PLACES", places, raising=False)
        parts, counted = model.entropies(texts)
        assert (counted == sizes).all() and np.allclose(parts, whole, rtol=1e-12, atol=0)
    monkeypatch.undo()
    text = spoken("aa", 3, 330_000)
    batch = pa.RecordBatch.from_pydict({"text": [text[k : k + 2000] for k in range(0, len(text), 2000)]})
    for groups, most in (([[text]], 70), ([b.column("text").to_pylist() for b in slices(iter([batch]), "text", language.SLICE)], 30)):
        tracemalloc.start()
        for group in groups:
            model.predict(group)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most * len(text), peak / len(text)


@pytest.mark.skipif(not Path(ROOT).exists(), reason="no test tables")
def test_held_out_accuracy(spark):
    """The smallest table: languages of held-out documents whose language is given."""
    import pyarrow.parquet as pq

    found = registry.QUERIES["op8_language_id"](spark, ROOT).toPandas()
    docs = pq.read_table(f"{ROOT}/documents.parquet", columns=["doc_id", "lang"]).to_pandas().dropna()
    held = found[found.held_out & (found.lang_pred != "und")].merge(docs, on="doc_id")
    assert len(found) == pq.read_metadata(f"{ROOT}/documents.parquet").num_rows
    assert (held.lang_pred == held.lang).mean() > 0.9


PAGE = """<html><head><title>T</title><style>p {}</style><script>var x = "<p>no</p>";</script></head><body>
<nav><a href=/>Home</a> <a href=/n>News, all</a></nav>
<div class="page"><article><h1>A &amp; B</h1><p>First   paragraph, with commas, and&nbsp;words enough to count as text, surely.
<p>Second paragraph, also long, with <b>bold</b> words, commas, and &lt;marks&gt; to keep, all of it.</p>
<div class="advert">Buy now, cheap, today, only here!</div><form><input><p>Subscribe, please, to our letter</p></form></article></div>
<aside class="sidebar"><p>Related, things, to read, next, week</p></aside>
<div class="comments"><p>A reader, who comments, at some length, on the article, above.</p></div><footer>Copyright, us</footer></body></html>"""


def test_html_text(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<p>", "x"), (1, "u", PAGE, "x"), (4, "u", "<div>" * 3000 + "deep" + "</div>" * 10, "x"), (5, "u", "<script>" + "a<b " * 5000, "x")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    wanted = "A & B\nFirst paragraph, with commas, and words enough to count as text, surely.\nSecond paragraph, also long, with bold words, commas, and <marks> to keep, all of it."
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and [r.text for r in got if r.page_id == 1] == [wanted, wanted]
    assert by[1].n_chars == len(wanted) and by[2].text == by[3].text == by[5].text == "" and by[2].n_chars == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


LONG = "A sentence that is long enough, with commas, to count as the text of an article, surely. " * 3
#: Pages without an article element, or with names in it that could mean something else, and their text.
BARE = [
    (f"<body><nav><a href=/>Home</a></nav><h1>Headline</h1><div><p>{LONG}</p><p>Short.</p><h2>Next</h2><p>{LONG}</p></div><div class=footer>Copyright</div></body>", ["Headline", LONG, "Short.", "Next", LONG]),
    (f"<body><div id=wrap><h1>Up</h1><div class=x><div><p>{LONG}</p><p>{LONG}</p></div></div></div></body>", ["Up", LONG, LONG]),
    (f"<article><h1>H</h1><p class=share-price>{LONG}</p><div class='search-history'><p>{LONG}</p></div><div class='share-links'><a href=1>Mail this</a></div><div class='ad-slot'>{LONG}</div></article>", ["H", LONG, LONG]),
    (f"<table><tr><td><p>{LONG}<td><p>{LONG}</table>", [LONG, LONG]),
    (f"<div><h1>One</h1><p>{LONG}<ul><li>a <b>b<li>c</ul><p>last", ["One", LONG, "a b", "c", "last"]),
    (f"<div><p title='a > b' class=\"x\">{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
]


@pytest.mark.parametrize("page, wanted", BARE)
def test_page_text_without_an_article_element(page, wanted):
    assert html_text.main_text(page).split("\n") == [" ".join(w.split()) for w in wanted]


@pytest.mark.parametrize("piece", ["<b>x", '<a "', "<a b='", "<!", "</3", "<p><td><b>", "<li><ul><b>", "</script ", "<div class=share>x", "<!--"])
def test_malformed_pages_take_linear_time(piece):
    import time

    start = time.perf_counter()
    html_text.main_text("<div>" + piece * 100_000)
    assert time.perf_counter() - start < 20


@pytest.mark.skipif(not Path(ROOT).exists(), reason="no test tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "decontamination", "encoding"]
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    result = corpus_pipeline.run(spark, ROOT)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = result.collect()
    assert {r.doc_id for r in rows} <= ids and len({r.doc_id for r in rows}) == len(rows) > 0.3 * len(ids)


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in registry.QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(registry.SQL) <= set(registry.QUERIES)
