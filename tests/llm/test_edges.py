"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import numpy as np
import pytest

from fathom.llm import bpe, caps, minhash, packing, pii, quality, topk, toxicity, url_filters, warc
from fathom.llm.queries import vocabulary

RANKS = "byte_bpe_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"
CLASH = ", node string, component string, score string, host string, spans string, n string, print string, ids string"
LONG = "lorem ipsum dolor " * 20_000
TEXTS = [None, "", " \n\t ", "one", "Two words.", "a@b.co +1 (319) 555-5132 4111 1111 1111 1111", "x" * 50_000, LONG, "ÄÖ 日本 😀"]


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, *["z"] * 8) for i, t in zip(ids, texts)], "doc_id long, text string" + CLASH)


def document_operators(spark):
    labels = spark.createDataFrame([(3, 0, 1), (4, 1, None), (None, 1, 1), (5, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    return {
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels)),
        "pii": pii.find,
        "sanitise": pii.sanitise,
        "minhash": lambda d: minhash.near_duplicates(d, width=3, percent=85),
        "bpe": lambda d: bpe.decode(bpe.encode(d, vocabulary(RANKS)), vocabulary(RANKS)),
        "quality": lambda d: quality.score(d, quality.fit(d)),
    }


@pytest.mark.parametrize("name", ["toxicity", "pii", "sanitise", "minhash", "bpe", "quality"])
def test_a_row_for_every_row(spark, name):
    run = document_operators(spark)[name]
    ids = [*range(len(TEXTS)), 3, 3, None, None]
    rows = run(docs(spark, [*TEXTS, "one", "other text", "no id", None], ids)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((i is None, i or 0) for i in ids)
    assert run(docs(spark, [])).count() == 0
    assert run(docs(spark, [None, None])).count() == 2


def test_minhash_defined_cases(spark):
    rows = minhash.near_duplicates(docs(spark, [None, "", "A b", "a  B", "a b c", "a b c", "x"], [1, 2, 9, 5, 7, None, 8]), width=3, percent=85).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (9, 1, 5, False), (5, 1, 5, True), (7, 1, 7, True), (None, 1, None, True), (8, 1, 8, True)}


def test_packing_covers_every_row(spark):
    rows = packing.pack(docs(spark, TEXTS), vocabulary(TOKENIZER)).collect()
    parts, sequences = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        parts.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(parts) == set(range(len(TEXTS)))
    for pieces in parts.values():
        assert sum(n for _, n, _ in pieces) == pieces[0][2]
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 1024
    assert packing.pack(docs(spark, []), vocabulary(TOKENIZER)).count() == 0


def test_differencing_is_near_equal():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 257, 700).tolist()
    windows = packing.fill_windows(sizes, 1024)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    loads = [sum(sizes[i] for i in w) for w in windows]
    assert max(loads) <= 1024 and len(windows) <= sum(sizes) / 1024 * 1.02 + 1 and max(loads) - min(loads) < 16
    assert packing.fill_windows([], 8) == []
    assert len(packing.fill_windows([5, 5, 5], 8)) == 3


def pages(spark, rows):
    return spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, rule string, first string")


def test_urls(spark):
    urls = {
        1: ("http://Sub.Example.ORG/es/1", "sub.example.org", "/es/1", "example.org/es/", "block"),
        2: ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
        3: ("http://example.org/en/2?q", "example.org", "/en/2", "org/", "allow"),
        4: ("http://notexample.org", "notexample.org", "", None, "allow"),
        5: ("http://a.com/de/x", "a.com", "/de/x", "com/de/", "block"),
        6: ("http://a.net/ads/x", "a.net", "/ads/x", None, "block"),
        7: (None, "", "", None, "allow"),
        8: ("no scheme", "", "", None, "allow"),
        9: ("x://com/fr/?a=://b.org/", "com", "/fr/", "com/fr/", "allow"),
        10: ("http://org:80/", "org:80", "/", None, "allow"),
    }
    rows = url_filters.judge_urls(pages(spark, [(i, u[0], None) for i, u in urls.items()] + [(1, urls[1][0], None)])).collect()
    assert len(rows) == 11
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.page_id][1:]
    assert url_filters.judge_urls(pages(spark, [])).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    rule = url_filters.site_rule("block", "my-site.example", "/a/pref")
    assert rule.tokens == ("my", "site", "example", "a")
    assert url_filters.judge_urls(pages(spark, [(1, "http://x.my-site.example/a/prefix", None)]), (rule,)).first().rule == rule.name


def test_archives(spark):
    html = ["<p>same</p>", "<p>same</p>", None, "", LONG, "<p>same</p>", "ü" * 3]
    rows = [(i, f"http://x/{i}\n", h) for i, h in enumerate(html)] + [(0, None, html[0]), (None, "http://n", "<p>same</p>"), (None, None, "alone")]
    out = warc.read_archives(warc.write_archives(pages(spark, rows * 1))).collect()
    assert len(out) == len(rows)
    got = sorted((r.page_id if r.page_id is not None else -1, r.record_type, r.refers_to) for r in out)
    want = [(-1, "response", None), (-1, "revisit", 0), (0, "response", None), (0, "response", None), (1, "revisit", 0), (2, "response", None)]
    want += [(3, "revisit", 2), (4, "response", None), (5, "revisit", 0), (6, "response", None)]
    assert got == sorted(want, key=lambda x: (x[0], x[1]))
    for r in out:
        if r.record_type == "response" and r.page_id is not None:
            assert bytes(r.payload) == (html[r.page_id] or "").encode()
    small = warc.read_archives(warc.write_archives(pages(spark, rows), revisit_from=20))
    assert small.filter("record_type = 'revisit'").count() == 0
    assert warc.read_archives(warc.write_archives(pages(spark, []))).count() == 0


def test_archives_begin_with_their_dictionary():
    records = [b"WARC/1.1\r\nrecord %d of many that look alike and repeat themselves\r\n" % i * 40 for i in range(200)]
    body = warc._archive(records, 3)
    assert body[:4] == (0x184D2A5D).to_bytes(4, "little")
    assert list(warc._records(body)) == records
    for few in (records[:2], [b"WARC/1.1\r\n"]):  # too few to train on
        small = warc._archive(few, 3)
        assert small[:4] == body[:4] and list(warc._records(small)) == few


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 0, "z") for r in rows], "vec_id long, embedding array<float>, label int, node string")


ODD = [
    (50, [1.0, 0.0]),
    (100, [0.5, 0.5]),
    (1, [1.0, 0.0]),
    (2, [0.0, 0.0]),
    (3, None),
    (4, [None, 1.0]),
    (5, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]),
    (7, []),
    (8, [1.0, 0.0, 0.0]),
    (9, [2.0, 0.02]),
    (None, [1.0, 0.0]),
]


def test_top_k_defined_cases(spark):
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(vectors(spark, ODD), 2).collect()]
    assert sorted(got) == [(50, 1, 9, 131072), (50, 2, 1, 65536), (100, 1, 9, 66176), (100, 2, 1, 32768)]
    assert topk.top_k(vectors(spark, [])).count() == 0
    assert topk.top_k(vectors(spark, ODD[2:])).count() == 0


def test_caps_defined_cases(spark):
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near_duplicates(vectors(spark, ODD)).collect()}
    linked = {1: (2, 1, True), 50: (2, 1, False), 9: (2, 1, False)}
    assert got == {v: linked.get(v, (0, v, True)) for v, _ in ODD}
    assert caps.near_duplicates(vectors(spark, [])).count() == 0


def test_revisits_beyond_the_broadcast(spark, monkeypatch):
    rows = [(i, "http://a/", f"page {i % 5}", ) for i in range(40)]
    whole = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages(spark, rows))).collect())
    monkeypatch.setattr(warc, "BROADCAST_PAYLOADS", 0)
    again = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(warc.write_archives(pages(spark, rows))).collect())
    assert whole == again == [(i, "response" if i < 5 else "revisit", None if i < 5 else i % 5) for i in range(40)]


def test_tokens_of_patterns():
    of = url_filters.literal_tokens
    assert of("/cgi-bin/") == ("cgi", "bin") and of(r"/wp-login\.php") == ("wp", "login")
    assert of(r"(?:\A|\.)adserver\.") == ("adserver",) and of(r"/Login(?:/|\z)") == ("login",)
    assert of("/x[/]abc/") == of("/a|/b/") == of("/ab+c/") == of("/foo(?:/|x)") == of("/abc/?de") == of(r"\x2Fads") == ()


def test_candidates_equal_every_rule(spark, monkeypatch):
    import random
    import re

    draw = random.Random(7)
    words = [f"w{i}" for i in range(400)]
    forms = ("/{0}/", "/{0}-{1}/", "/{0}", r"{0}\.{1}", "/{0}(?:/|\\z)", "/{0}?/{1}/", "(?:{0}|{1})/", "/[{0}]/{1}")
    rules = tuple(
        url_filters.pattern_rule(f"r{i:04}", "block", draw.choice(forms).format(draw.choice(words), draw.choice(words))) for i in range(1000)
    )
    urls = [(i, "http://h.example/" + "".join(draw.choice(words) + draw.choice("/-.x") for _ in range(4)), None) for i in range(60)]

    def by_all(url: str) -> str | None:
        rest = url.split("://")[1]
        return min((r.name for r in rules if re.search(r.pattern.replace(r"\z", r"\Z"), rest)), default=None)

    want = {i: by_all(u) for i, u, _ in urls}
    assert {r.page_id: r.pattern for r in url_filters.judge_urls(pages(spark, urls), rules).collect()} == want
    monkeypatch.setattr(url_filters, "MAP_TOKENS", 10**6)
    assert {r.page_id: r.pattern for r in url_filters.judge_urls(pages(spark, urls), rules).collect()} == want
    monkeypatch.setattr(url_filters, "MAP_TOKENS", 0)
    monkeypatch.setattr(url_filters, "BROADCAST_TOKENS", 0)
    assert {r.page_id: r.pattern for r in url_filters.judge_urls(pages(spark, urls), rules).collect()} == want


def test_rules_without_tokens_and_long_urls(spark, monkeypatch):
    """A rule without a literal token runs on every URL, a URL of a megabyte is judged whole, and no URL is shuffled for a short list."""
    rules = (*url_filters.PRODUCTION, url_filters.pattern_rule("digits", "block", "[0-9]{9}"), url_filters.pattern_rule("end", "allow", "z+/?$"))
    urls = {
        1: "http://a.example/" + "p/" * 500_000 + "ads/x", 2: "http://a.example/" + "p/" * 500_000 + "123456789", 3: None, 4: "", 5: "http:///", 6: "http://a.com/zz/",
        7: "http://" + "s." * 200_000 + "example.org/es/1", 8: "http://a.example/ok",
    }
    df = pages(spark, [(i, u, None) for i, u in urls.items()])
    want = {
        1: (None, "block", "ads"), 2: (None, "block", "digits"), 3: (None, "allow", None), 4: (None, "allow", None), 5: (None, "allow", None),
        6: ("com/", "allow", None) if any(r.name == "com/" for r in rules) else (None, "allow", "end"), 7: ("example.org/es/", "block", None), 8: (None, "allow", None),
    }
    out = url_filters.judge_urls(df, rules)
    assert {r.page_id: (r.rule, r.verdict, r.pattern) for r in out.collect()} == want
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for tokens in (url_filters.BROADCAST_TOKENS, 0):
        monkeypatch.setattr(url_filters, "MAP_TOKENS", 0)
        monkeypatch.setattr(url_filters, "BROADCAST_TOKENS", tokens)
        assert {r.page_id: (r.rule, r.verdict, r.pattern) for r in url_filters.judge_urls(df, rules).collect()} == want
    none = url_filters.judge_urls(df, (rules[-1],))
    assert {r.page_id: r.pattern for r in none.collect() if r.pattern} == {6: "end"}
