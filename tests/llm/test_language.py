"""Language identification: paths by brute force, spans of mixed texts, scripts, held-out accuracy, odd rows."""

import itertools
import zlib

import numpy as np
import pytest

from fathom.llm import language
from fathom.llm.queries import queries

SENTENCES = {
    "en": ["the house of the old man stands by the river", "she would have been there with us", "they thought that nothing was lost"],
    "de": ["das haus des alten mannes steht am fluss", "sie wäre gern mit uns dort gewesen", "sie dachten dass nichts verloren sei"],
    "ru": ["дом старого человека стоит у реки", "она была бы там с нами", "они думали что ничего не потеряно"],
    "bg": ["къщата на стария човек стои до реката", "тя щеше да бъде там с нас", "те мислеха че нищо не е изгубено"],
    "el": ["το σπίτι του γέρου στέκεται στο ποτάμι", "θα ήταν εκεί μαζί μας"],
    "th": ["บ้านของชายชราตั้งอยู่ริมแม่น้ำ", "เธอคงจะอยู่ที่นั่นกับเรา"],
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, lang, t) for i, (lang, t) in enumerate((lang, t) for _ in range(10) for lang, every in SENTENCES.items() for t in every)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, lang string, text string"))


def told(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in language.predict(docs, model).collect()}


def best_path(scores, penalty):
    n, k = scores.shape
    every = itertools.product(range(k), repeat=n)
    return max(sum(scores[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:])) for p in every)


def test_paths_are_the_best_ones():
    rng = np.random.default_rng(3)
    for penalty in (0.0, 0.7, 2.0):
        counts = np.array([0, 5, 1, 7, 0, 3])
        scores = rng.normal(size=(counts.sum(), 3)).round(1)
        labels = language.viterbi(scores, counts, penalty)
        at = 0
        for n in counts:
            own, path = scores[at : at + n], labels[at : at + n]
            got = sum(own[i, x] for i, x in enumerate(path)) - penalty * sum(path[1:] != path[:-1])
            assert n == 0 or got == pytest.approx(best_path(own, penalty))
            at += n


def test_ties_keep_the_first_label():
    assert language.viterbi(np.zeros((4, 3)), np.array([3, 1]), 1.0).tolist() == [0] * 4


def test_spans_of_a_mixed_text(spark, model):
    parts = [SENTENCES["en"][0], SENTENCES["de"][1], SENTENCES["ru"][2], SENTENCES["el"][0]]
    text = ". ".join(parts)
    row = told(spark, model, [text])[0]
    assert [s.lang for s in row.spans] == ["en", "de", "ru", "el"]
    assert [text[s.start : s.end] for s in row.spans] == parts


def test_a_foreign_name_stays_in_its_sentence(spark, model):
    row = told(spark, model, ["the house of the old haus stands by the river"])[0]
    assert [(s.lang, s.start, s.end) for s in row.spans] == [("en", 0, 45)]


def test_scripts_narrow_candidates(spark, model):
    own = {name: {model.languages[k] for k in np.flatnonzero(row)} for name, row in zip([*language.SCRIPTS, "other"], model.own)}
    assert own["latin"] == {"en", "de"} and own["cyrillic"] == {"ru", "bg"} and own["thai"] == {"th"} and own["han"] == set()
    rows = told(spark, model, ["Ωμέγα", "ไม่มี", "ъгъл", "漢字"])
    assert [rows[i].lang_pred for i in range(3)] == ["el", "th", "bg"]
    assert rows[3].lang_pred == model.languages[0]  # no evidence: the language with most texts


def test_odd_rows(spark, model):
    long = SENTENCES["de"][0] + " "
    texts = [None, "", " 12 — 34 !?\n", "́", "x", "ß" * 40_000, long * 30_000, "漢" * 400_000 + "a", "1 Haus 2"]
    rows = told(spark, model, texts)
    for i in range(4):
        assert (rows[i].lang_pred, rows[i].score, rows[i].spans) == ("und", 0.0, [])
    assert all(rows[i].lang_pred in model.languages and 0 <= rows[i].score <= 1 for i in range(4, 9))
    assert [(s.start, s.end) for s in rows[6].spans] == [(0, len(long * 30_000) - 1)] and rows[6].lang_pred == "de"
    assert [(s.start, s.end) for s in rows[8].spans] == [(2, 6)]
    assert rows[7].spans[-1].end == 400_001


def test_a_row_for_every_row_and_clashing_columns(spark, model):
    names = "doc_id long, text string, lang string, lang_pred string, score string, spans string, drawn string, rate string, bucket string"
    rows = [(i, t, "zz", *["z"] * 6) for i, t in [(1, "the old man"), (1, "the old man"), (None, "das haus"), (None, None)]]
    docs = spark.createDataFrame(rows, names)
    got = language.predict(docs, model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "de"), (0, "und"), (1, "en"), (1, "en")]
    assert language.predict(docs.limit(0), model).count() == 0
    assert language.fit(docs).languages == ("zz",)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, None, "abc"), (2, "en", None)], "doc_id long, lang string, text string")
    model = language.fit(docs)
    assert model.languages == () and [r.lang_pred for r in language.predict(docs, model).collect()] == ["und", "und"]


def test_batches_change_nothing(spark, model):
    texts = [s for every in SENTENCES.values() for s in every] * 20
    one = {k: (r.lang_pred, round(r.score, 9)) for k, r in told(spark, model, texts).items()}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(7)
    assert {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in language.predict(docs, model).collect()} == one


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries()["op11_language"](spark, sf).collect()
    assert len(rows) == len(langs) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) >= 0.98
