"""Prefix-free parsing and collocations against plain counting."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fathom.llm import collocations as C


def pieces_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain_counts(rows):
    out = Counter()
    for lang, text in rows:
        for w in pieces_of(text):
            for n in range(1, 5):
                out.update((lang or "und", " ".join(w[i : i + n])) for i in range(len(w) - n + 1))
    return out


def plain_ranks(rows, least, top, covered=80):
    f = {k: n for k, n in plain_counts(rows).items() if n >= least}
    sizes, found = Counter(), {}
    for lang, text in rows:
        sizes[lang or "und"] += sum(map(len, pieces_of(text)))
    for (lang, phrase), a in f.items():
        w = phrase.split(" ")
        cuts = [(2_000_000 * a // (f[lang, " ".join(w[:k])] + f[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        longer = (n for (other, p), n in f.items() if other == lang and p.count(" ") > phrase.count(" ") and f" {phrase} " in f" {p} ")
        if cuts and not any(100 * n >= covered * a for n in longer):
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, phrase.encode(), f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, sizes[lang], -s)
        for lang, every in found.items()
        for i, (s, a, p, left, right) in enumerate(sorted(every)[:top])
    }


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, "z", 1) for lang, text in rows], "lang string, text string, phrase string, n long")


def invented(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["É", "日本", "Straße", "a b"]
    lines = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(15)]
    rows = []
    for _ in range(n):
        parts = [rng.choice(lines) if rng.random() < 0.7 else " \t".join(rng.choices(words, k=9)) for _ in range(rng.randint(0, 12))]
        rows.append((rng.choice(["en", "fr", None]), rng.choice([". ", ", ", " ", "\n", "\x0b"]).join(parts)))
    return rows


def test_every_occurrence_is_counted_once(spark):
    rows = invented(1)
    counts = {(r.lang, r.phrase): r.n for r in C.phrase_counts(C.parse(frame(spark, rows)), 1).collect()}
    assert counts == dict(plain_counts(rows))


@pytest.mark.parametrize("slice_bytes", [40, 333])
def test_cut_texts_count_alike(slice_bytes, monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(C, "LONGEST", 9)
    rows = [*invented(2, 30), ("en", "one two three " * 200), ("en", "x" * 700 + " y z " + "é" * 400 + "\t.q r s t u"), ("en", None), ("en", "")]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": [lang or "und" for lang, _ in rows], "text": [t for _, t in rows]})
    got = Counter()
    for out in C._parsed(iter([batch])):
        for lang, chunk, owned in zip(*(out.column(k).to_pylist() for k in range(3))):
            w = chunk.split(" ")
            assert 1 <= owned <= len(w) <= max(owned + C.OVERLAP, 1)
            for n in range(1, 5):
                got.update((lang, " ".join(w[i : i + n])) for i in range(min(owned, len(w) - n + 1)))
    assert got == plain_counts(rows)


def test_equal_passages_share_chunks(spark):
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(400))
    rows = [("en", f"begin{i} {passage} end{i}") for i in range(50)]
    found = C.parse(frame(spark, rows))
    assert found.count() < 250 and found.agg(F.sum(F.col("owned") * F.col("times"))).first()[0] == 50 * 402


def test_ranks_equal_plain_ones(spark):
    rows = invented(3, 200)
    got = {tuple(r) for r in C.collocations(frame(spark, rows), least=5, top=40).collect()}
    assert got == plain_ranks(rows, 5, 40)


@pytest.mark.parametrize(("seed", "room"), [(5, 0.01), (6, 1), (7, 3)])
def test_few_phrases_are_spelt_and_ranks_stay(spark, monkeypatch, seed, room):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(60)]
    rows = invented(seed, 200)
    rows += [("en", " ".join(x for i in rng.choices(range(60), [60 / (k + 1) for k in range(60)], k=30) for x in words[i : i + rng.choice([1, 1, 3])])) for _ in range(400)]
    plain, given = C.rank, []
    monkeypatch.setattr(C, "rank", lambda counts, top, covered: given.append(counts) or plain(counts, top, covered))
    monkeypatch.setattr(C, "ROOM", room)
    got = {tuple(r) for r in C.collocations(frame(spark, rows), least=5, top=25).collect()}
    assert got == plain_ranks(rows, 5, 25)
    f = {k: n for k, n in plain_counts(rows).items() if n >= 5}
    assert given[0].filter("lang = 'en'").count() < 0.8 * sum(lang == "en" for lang, _ in f)
    assert all(f[r.lang, r.phrase] == r.n for counts in given for r in counts.collect())
    assert room >= 1 or len(given) > 1


def test_phrases_without_all_parts_are_not_ranked(spark):
    f = [("a", 50), ("b", 50), ("c", 50), ("a b", 40), ("a b c", 31)]
    rows = C.rank(spark.createDataFrame([("en", p, n) for p, n in f], "lang string, phrase string, n long")).collect()
    assert [(r.phrase, r.score) for r in rows] == [("a b", 800_000)]


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    rows = invented(4, 60)
    want = {tuple(r) for r in C.collocations(frame(spark, rows), least=4).collect()}
    monkeypatch.setattr(C, "_filter", lambda spark, keys: spark.sparkContext.broadcast(C.np.full(C.FILTER_BITS // 8, 255, C.np.uint8)))
    assert {tuple(r) for r in C.collocations(frame(spark, rows), least=4).collect()} == want


def test_counts_beyond_64_bits(spark):
    big = 2_000_000_000_000_000
    rows = [("en", "a", 4 * big), ("en", "b", big), ("en", "a b", big)]
    got = C.rank(spark.createDataFrame(rows, "lang string, phrase string, n long")).collect()
    assert [(r.phrase, r.a, r.l, r.r, r.score) for r in got] == [("a b", big, 4 * big, big, 400_000)]


def test_covered_phrases_and_ties(spark):
    f = [("a", 50), ("b", 50), ("c", 50), ("d", 50), ("a b", 40), ("b c", 50), ("a b c", 40), ("é x", 30), ("é", 60), ("x", 60), ("z x", 30), ("z", 60)]
    rows = C.rank(spark.createDataFrame([("en", p, n) for p, n in f], "lang string, phrase string, n long")).orderBy("rank").collect()
    assert [(r.phrase, r.score) for r in rows] == [("a b c", 800_000), ("z x", 500_000), ("é x", 500_000)]


def test_empty_tables_and_texts(spark):
    assert C.collocations(frame(spark, [])).count() == 0
    assert C.collocations(frame(spark, [(None, None), ("en", ""), ("en", " .,\t\n")])).count() == 0
    rows = C.collocations(frame(spark, [(None, "New York!")] * 30)).collect()
    assert [tuple(r) for r in rows] == [("und", 1, "new york", 30, 30, 30, 60, 1_000_000)]
