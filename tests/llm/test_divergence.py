"""K2-trees and the divergence of sources against plain sums."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from fathom.llm import divergence as D


def plain_audit(rows, least=10, top=10):
    in_docs, counts, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", (text or "").translate({c: c + 32 for c in range(65, 91)})
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)
        groups.add((lang, source))
        in_docs.update((lang, t) for t in set(found))
        counts.update((lang, source, t) for t in found)
    kept = {}
    for (lang, t), n in in_docs.items():
        if n >= least:
            kept.setdefault(lang, []).append(t)
    total, own, of = Counter(), Counter(), Counter()
    for (lang, source, t), n in counts.items():
        if in_docs[lang, t] >= least:
            total[lang] += n
            own[lang, source] += n
            of[lang, t] += n

    def share(c, n, lang):
        return 1 + 1_000_000_000 * (c + 2) // (n + 2 * len(kept[lang]))

    def f(p, q):
        return (p - q) ** 2 // (p + q)

    out = set()
    for lang, source in groups:
        terms = kept.get(lang, [])
        p = {t: share(counts[lang, source, t], own[lang, source], lang) for t in terms}
        others = []
        for _, other in (g for g in groups if g[0] == lang and g[1] != source):
            value = sum(f(p[t], share(counts[lang, other, t], own[lang, other], lang)) for t in terms)
            others.append((-value, other.encode(), other))
        told = []
        for t in terms:
            q = share(of[lang, t], total[lang], lang)
            if counts[lang, source, t] and p[t] > q:
                told.append((-f(p[t], q), t.encode(), t))
        out |= {(lang, source, "pair", x, -v, i + 1) for i, (v, _, x) in enumerate(sorted(others))}
        out |= {(lang, source, "term", x, -v, i + 1) for i, (v, _, x) in enumerate(sorted(told)[:top])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z", 1, "z") for r in rows], "lang string, source string, text string, item string, n long, term string")


def invented(seed, n=300, sources=9):
    rng = random.Random(seed)
    words = [f"Wo{c}" for c in "abcdefghijklmnop"] + ["É", "日本", "x_y", "don't", "a1b", "zß"]
    rows = []
    for _ in range(n):
        s = rng.choice([*range(sources), 0, 0, None])
        some = words[: 4 + 2 * (s or 0)]
        rows.append((rng.choice(["en", "fr", None]), None if s is None else f"s{s}", " ".join(rng.choices(some, k=rng.randint(0, 30)))))
    return rows + [("en", "quiet", None), ("en", "quiet2", "12 34"), ("xx", "a", "rare"), ("xx", "b", "words"), ("one", "a", "alone " * 40)]


def test_trees_hold_their_places():
    rng = np.random.default_rng(1)
    for levels in (1, 3, 6):
        places = np.unique(rng.integers(0, 1 << levels, (20, 2)), axis=0)
        tree = D.Tree(places[:, 0], places[:, 1], levels)
        assert int(tree.bits[-1].sum()) == len(places)
        node, row, column = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        for level in range(levels):
            q = np.tile(np.arange(4), len(node))
            below = tree.child(level, np.repeat(node, 4), q)
            row, column, node = np.repeat(row, 4) * 2 + q // 2, np.repeat(column, 4) * 2 + q % 2, below
            row, column, node = row[below >= 0], column[below >= 0], node[below >= 0]
        leaf = tree.order[node]
        assert (places[leaf] == np.stack([row, column], 1)).all() and len(leaf) == len(places)


@pytest.mark.parametrize("same", [True, False])
def test_joint_descent_equals_plain_sums(same, monkeypatch):
    monkeypatch.setattr(D, "FRONTIER", 50)
    rng = np.random.default_rng(2)
    for _ in range(20):
        shape, terms = (int(rng.integers(1, 9)), int(rng.integers(1, 9))), int(rng.integers(1, 70))
        shape = (shape[0], shape[0]) if same else shape
        tables, strips, empty = [], [], []
        for n in shape:
            table = np.where(rng.random((n, terms)) < 0.2, rng.integers(1, 10**9, (n, terms)), 0)
            none = rng.integers(1, 1000, n)
            row, column = np.nonzero(table)
            tables.append(np.where(table > 0, table, none[:, None]))
            strips.append([row, column, table[row, column]])
            empty.append(none)
        if same:
            tables[1], strips[1], empty[1] = tables[0], strips[0], empty[0]
        a, b, value, visited = D.block_sums(*strips, tuple(empty), same)
        got = {(x, y): (v, n) for x, y, v, n in zip(a.tolist(), b.tolist(), value.tolist(), visited.tolist())}
        for i in range(shape[0]):
            for j in range(i + 1 if same else 0, shape[1]):
                p, q = tables[0][i], tables[1][j]
                v, n = got.get((i, j), (0, 0))
                blank = (empty[0][i] - empty[1][j]) ** 2 // (empty[0][i] + empty[1][j])
                assert v + (terms - n) * blank == int(((p - q) ** 2 // (p + q)).sum())
                held = set(strips[0][1][strips[0][0] == i]) | set(strips[1][1][strips[1][0] == j])
                assert n == len(held)


def test_audit_equals_plain_sums(spark):
    rows = invented(3)
    assert {tuple(r) for r in D.audit(frame(spark, rows)).collect()} == plain_audit(rows)


@pytest.mark.parametrize("width, block", [(4, 20), (1, 7), (256, 1)])
def test_many_blocks_and_strips(spark, width, block):
    rows = invented(4, sources=14)
    assert {tuple(r) for r in D.audit(frame(spark, rows), width=width, block=block).collect()} == plain_audit(rows)


def test_texts_cut_inside_a_row(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(D, "SLICE_BYTES", 16)
    monkeypatch.setattr(D, "HELD", 3)
    texts = ["the cat the dog " * 9, "Élan élan " * 5, "x" * 50 + " y", "the end"]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 4, "source": ["s"] * 4, "text": texts})
    counts, docs = Counter(), Counter()
    for out in D._counted(iter([batch])):
        for r in out.to_pylist():
            counts[r["term"]] += r["n"]
            docs[r["term"]] += r["docs"]
    found = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate({c: c + 32 for c in range(65, 91)})) for t in texts]
    assert counts == Counter(w for every in found for w in every) and docs == Counter(w for every in found for w in set(every))


def test_exact_shares_of_large_counts(spark):
    rows = [(10**15, 10**16, 3), (0, 0, 5), (7, 9, 0), (None, 4, 1)]
    got = [r[0] for r in spark.createDataFrame(rows, "n long, own long, kept long").select(D.share("n", "own", "kept")).collect()]
    assert got == [1 + 10**9 * (10**15 + 2) // (10**16 + 6), 1 + 10**9 * 2 // 10, 0, 1 + 10**9 * 2 // 6]


def test_empty_tables(spark):
    assert D.audit(frame(spark, [])).count() == 0
    rows = [(None, None, None), ("en", "a", ""), ("en", "b", None)]
    assert {tuple(r) for r in D.audit(frame(spark, rows)).collect()} == plain_audit(rows)
