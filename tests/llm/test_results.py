"""Operators against brute force, round trips and held-out labels."""

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from fathom.llm import bpe, caps, minhash, packing, pii, quality, topk, toxicity
from fathom.llm._stage import connected_components
from fathom.llm.queries import queries, vocabulary

RANKS = "byte_bpe_50k.tiktoken"


def naive_segments(x):
    """All maximal segments by their definition: split at the best one and go on on both sides."""
    best = max(((sum(x[b:e]), b - e, b, e) for b in range(len(x)) for e in range(b + 1, len(x) + 1)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    _, _, b, e = best
    return naive_segments(x[:b]) + [(b, e)] + [(s + e, t + e) for s, t in naive_segments(x[e:])]


def test_segments_against_their_definition():
    rng = random.Random(5)
    for _ in range(300):
        x = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 7 for _ in range(rng.randint(0, 14))]
        assert [(b, e) for b, e, _ in toxicity.segments(np.array(x))] == naive_segments(x)


def test_toxicity_on_held_out_labels(spark):
    rows = queries()["op1_toxicity"](spark, "/root/testdata/sf0.01").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) / len(held) >= 0.93


def test_quality_keeps_the_good(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = [(r.score >= 0.5, labels[r.doc_id]) for r in quality.score(docs, quality.fit(docs)).collect() if r.doc_id in labels]
    assert sum(k for k, y in rows if y == 1) / sum(y == 1 for _, y in rows) >= 0.99
    assert sum(k for k, y in rows if y == 0) / sum(y == 0 for _, y in rows) <= 0.4


def base_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for kind, pattern in pii.PLAIN.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 16 <= len(d) <= 19 and luhn(d),
                "phone": 8 <= len(d) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_entities_against_the_plain_patterns(spark):
    rng = random.Random(3)
    bits = ["a", "B", "7", "12", "255", "256", "@", ".", "-", "+", " ", "(", ")", "a@b.c", "x_y", "4111 1111 1111 1111", "é", "😀", "1.2.3.4"]
    bits += ["+1 (319) 555-5132", "\n", "%", "00000", "4111111111111111", "mail.com"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for i in range(1500)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for r in pii.find(frame).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == base_spans(texts[r.doc_id])


def naive_disclosing(texts, reach=None, support=3, generalise=0.6, remove=0.9):
    """Of each text, term -> kind, by counting the texts that hold each term, each entity and both (the term within reach)."""
    word = re.compile(r"(?<![^\W_])[^\W\d_][^\W_]{2,63}(?![^\W_])")
    terms = [set(word.findall(t.lower())) for t in texts]

    def name(t, k, b, e):
        return (k, re.sub("[^0-9]", "", t[b:e]) if k != "email" else t[b:e].lower())

    def near(t):
        spans = base_spans(t)
        free = [m for m in word.finditer(t) if not any(b < m.end() and m.start() < e for _, b, e in spans)]
        return {(m[0].lower(), name(t, k, b, e)) for k, b, e in spans for m in free if m.start() >= b - reach and m.end() <= e + reach}

    pairs = [near(t) if reach is not None else None for t in texts]
    held = [{name(t, *s) for s in base_spans(t)} for t in texts]
    n, out = len(texts), [{} for _ in texts]
    for entity in set().union(*held):
        with_e = sum(entity in h for h in held)
        for term in set().union(*(t for t, h in zip(terms, held) if entity in h)):
            both = sum(entity in h and term in t if p is None else (term, entity) in p for t, h, p in zip(terms, held, pairs))
            with_t = sum(term in t for t in terms)
            if both >= support and n > with_e:
                share = math.log(both * n / (with_t * with_e)) / math.log(n / with_e)
                if share >= generalise:
                    for own, h in zip(out, held):
                        if entity in h or both >= 0.5 * with_t:
                            own[term] = max(own.get(term, ""), "remove" if share >= remove else "generalise")
    return out


@pytest.mark.parametrize("reach", [None, 20])
def test_disclosing_terms_against_counting(spark, monkeypatch, reach):
    monkeypatch.setattr(pii, "CHUNK", 10)  # several chunks a text
    monkeypatch.setattr(pii, "CHUNKS", pii.CHUNKS.replace("500", "10"))
    rng = random.Random(11)
    who = [f"w{i}@x.org" for i in range(6)] + ["4111 1111 1111 1111", "+1 (319) 555-5132"]
    words = [f"term{i}" for i in range(60)]
    for _ in range(2):
        texts = []
        for _ in range(150):
            bits = rng.choices(words, k=6)
            if rng.random() < 0.4:
                k = rng.randrange(len(who))
                bits += [who[k], f"friend{k}", *([f"Near{k}"] if rng.random() < 0.7 else [])]
            elif rng.random() < 0.1:
                bits.append(f"near{rng.randrange(len(who))}")
            rng.shuffle(bits)
            texts.append("; ".join(bits))
        texts += texts[:9]
        want = naive_disclosing(texts, reach)
        assert {"remove", "generalise"} <= {k for own in want for k in own.values()}
        for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), reach).collect():
            spans = base_spans(texts[r.doc_id])
            own = want[r.doc_id]
            places = [(own[m[0].lower()], *m.span()) for m in re.finditer(r"[a-zA-Z]+[0-9]+", texts[r.doc_id]) if m[0].lower() in own]
            outside = [p for p in places if not any(b < p[2] and p[1] < e for _, b, e in spans)]
            assert [(t.kind, t.start, t.end) for t in r.terms] == sorted(outside)


def test_disclosing_terms_go_from_every_text(spark):
    texts = [f"call Zebulon about bob@x.org today {i}" for i in range(4)] + [f"today other words {i}" for i in range(36)] + ["Zebulon again"]
    want = naive_disclosing(texts, 48)
    assert want[40]["zebulon"] == "remove" and "today" not in want[0]
    clean = {r.doc_id: r.text for r in pii.sanitise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert re.sub(" +", " ", clean[0]) == " [EMAIL] today 0" and clean[5] == texts[5] and clean[40] == " again"


def test_personal_data_of_long_texts(spark):
    """Thousands of entities in one text take seconds, and places hold across chunks."""
    import time

    lists = [
        "".join(f"person{i} wrote{i}@mail{i}.com, " for i in range(8000)),
        " ".join(f"see é{i}.10.0.{i % 256} or a{i}@b.co" for i in range(3000)),
        "\U0001f600 word " * 3000 + "x@y.zz",
        "1.2.3.4," * 3000,
    ]
    begun = time.perf_counter()
    frame = spark.createDataFrame(list(enumerate(lists)), "doc_id long, text string")
    for r in pii.find(frame).collect():
        assert [(s.kind, s.start, s.end) for s in r.base] == base_spans(lists[r.doc_id])
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert clean[0].count("[EMAIL]") == 8000 and clean[2] == lists[2][:-6] + "[EMAIL]" and clean[3] == "[IP]," * 3000
    assert time.perf_counter() - begun < 60


def test_encoding_against_tiktoken(spark):
    import public_tokenizers
    import tiktoken

    ranks = {t: i for i, t in enumerate(bpe.load_ranks(vocabulary(RANKS)))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    bits = ["a", "s", "'", "'s", "'ll", "'re", "'ve", " ", "  ", "\n", "\t", "é", "1", "²", "!", "日本", "😀", "\x1c", "\x85", "\r\n", "٣", "Hello", "unbelievable"]
    texts = {i: "".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for i in range(2000)}
    encoded = bpe.encode(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), vocabulary(RANKS))
    for r in bpe.decode(encoded, vocabulary(RANKS)).collect():
        assert r.ids == other.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded) == texts[r.doc_id].encode()


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(2).integers(0, 2**63, 5000).astype(np.uint64)
    index = bpe.PerfectHash(keys)
    assert index.find(keys).tolist() == list(range(5000)) and sorted(index.value.tolist()) == list(range(5000))
    assert (index.find(keys + np.uint64(1)) == -1).all()


def brute_near(texts, width, percent):
    sets = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    ids = sorted(sets)
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("crowd", [64, 2])
def test_near_duplicates_against_all_pairs(spark, crowd):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    shared = rng.choices(words, k=60)
    texts = {}
    for g in range(12):
        base = shared + rng.choices(words, k=rng.randint(5, 60))
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randint(0, 5)):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts[len(texts)] = " ".join(own)
    texts[len(texts)] = None
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame, 3, 85, crowd=crowd).collect()}
    assert got == brute_near(texts, 3, 85)


def test_components_in_rounds(spark, monkeypatch):
    from fathom.llm import _stage

    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(130)] + [(500 + i, 501 + i) for i in range(20)]
    frame = spark.createDataFrame(edges, "a long, b long")
    one = sorted(map(tuple, connected_components(frame).collect()))
    monkeypatch.setattr(_stage, "ONE_TASK_EDGES", 5)
    assert sorted(map(tuple, connected_components(frame).collect())) == one


def cloud(n=600, width=64, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width))
    for i in range(0, n, 3):  # partners at a cosine just above and below 0.9
        x[i + 1] = x[i] + rng.standard_normal(width) * rng.uniform(0.3, 0.55)
    return x.astype(np.float32)


def test_caps_against_all_pairs(spark):
    x = cloud()
    x[5] = x[4]
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    y = x.astype(float)
    cosine = y @ y.T / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None, :]
    links = (cosine >= 0.9).sum(axis=1) - 1
    got = {r.vec_id: r for r in caps.near_duplicates(frame).collect()}
    assert all(got[i].n_links <= links[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.99 * links.sum() > 0


@pytest.mark.parametrize("corpus", [50_000, 250_000, 1_000_000])
def test_caps_find_pairs_whatever_the_corpus(corpus):
    """Pairs at cosines from 0.9 on share a filter of the code that a corpus of this size gets."""
    directions = math.ceil(math.sqrt(corpus * 48 / caps.VECTORS_PER_FILTER))
    code = caps.ProductCode(64, *caps.code_for(64, directions, 0.9))
    assert code.directions == directions
    for cosine in (0.9, 0.925, 0.95):
        assert caps.shared(code, *caps.pairs_at(cosine, 64, 1000, 3)) >= 0.99
    rows, _ = code.decode(caps.pairs_at(0.9, 64, 300, 4)[0])
    assert np.bincount(rows, minlength=300).min() >= caps.FILTERS_AT_LEAST


def alike(length):
    """Two words of letters a and b that a polynomial modulo 2**64 cannot tell apart, and nothing in common."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(length))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_long_words_are_told_apart(spark):
    import os

    import tiktoken

    import public_tokenizers

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    rng = random.Random(2)
    one, two = alike(2048)
    texts = [one, two, f"x {one} y", f"x {two} y", *("".join(rng.choices("ab", k=2048)) for _ in range(40))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ranks = {t: i for i, t in enumerate(bpe.load_ranks(vocabulary(RANKS)))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.ids == other.encode_ordinary(texts[r.doc_id]) for r in bpe.encode(frame, vocabulary(RANKS)).collect())
    classes = minhash.near_duplicates(frame, 1, 85)
    assert all(r.component_id == r.doc_id for r in classes.collect())
    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    for r in packing.pack(frame, vocabulary("byte_bpe_50k.json")).collect():
        ids = whole.encode(texts[r.doc_id], add_special_tokens=False).ids + [0]
        assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.start : r.start + r.length]


def test_stored_answers_of_the_same_hash_are_not_taken(monkeypatch):
    monkeypatch.setattr(bpe, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    resolve = lambda keys, pieces: [list(p) for p in pieces]
    encoder = bpe.Encoder(resolve, slots=8)
    for text in (b"abc abd abc xyz", b"q abe abc", b"zzzzz abd"):
        ids, counts = encoder.encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert bytes(ids.tolist()) == text and counts.tolist() == [len(text)]


def test_packing_like_the_library_with_its_special_strings(spark):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 3, f"  {end}  x's {end}'s", "a <|endoftext b", f"long {'text, ' * 600_000}{end} end", "<|endof", "text|>", None]
    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in packing.pack(frame, vocabulary("byte_bpe_50k.json")).collect():
        got.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    for i, t in enumerate(texts):
        assert [x for _, ids in sorted(got[i]) for x in ids] == whole.encode(t or "", add_special_tokens=False).ids + [0]


def test_long_texts_are_cut_between_pre_tokens():
    rng = random.Random(6)
    bits = ["a", "word", " ", "  ", "\n", "'s", "'", "12", "!", "日本", "。", "é", "\u00a0", "😀"]
    for _ in range(200):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 80))).encode()
        data = np.frombuffer(text, np.uint8)
        starts, _ = bpe.pre_tokens(data, np.array([0, len(text)]))
        ranges = list(bpe.cut_places(data, 24))
        assert [b for b, _ in ranges][1:] == [e for _, e in ranges][:-1] and ranges[0][0] == 0 and ranges[-1][1] == len(text)
        assert {b for b, _ in ranges} <= set(starts.tolist()) | {0}
        joined = [b + s for b, e in ranges for s in bpe.pre_tokens(data[b:e], np.array([0, e - b]))[0].tolist()]
        assert joined == starts.tolist()


def test_crowded_filters_are_dealt_into_cells(spark, monkeypatch):
    monkeypatch.setattr(caps, "CELL_ROWS", 16)
    rng = np.random.default_rng(1)
    x = rng.standard_normal(32) + 0.02 * rng.standard_normal((120, 32))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>")
    rows = caps.near_duplicates(frame).collect()
    assert all(r.n_links == 119 and r.component_id == 0 for r in rows)


def test_top_k_prunes_and_stays_exact(spark):
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.standard_normal((3000, 16)) * (1 + np.arange(3000)[:, None] // 1000))
    ids = np.arange(3000)
    got = topk.best_of_shard(ids[:40], x[:40], ids, x, 5)
    for q in range(40):
        scores = x @ x[q]
        scores[q] = -np.inf
        order = np.lexsort((ids, -scores))[:5]
        assert [(v, s) for a, v, s in got if a == q] == [(int(i), int(scores[i])) for i in order]


def test_pack_digests(spark, tiny):
    """ids of every piece against the tokenizers library."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    docs = {r.doc_id: whole.encode(r.text or "", add_special_tokens=False).ids + [0] for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in queries()["op5_packing"](spark, tiny).collect():
        ids = np.array(docs[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(ids) == r.ids_crc32 and r.doc_tokens == len(docs[r.doc_id])


def test_bpe_digests(spark, tiny):
    import public_tokenizers
    import tiktoken

    with open(vocabulary(RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    for r in queries()["op8_bpe"](spark, tiny).collect():
        ids = other.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("width, corpus", [(w, n) for w in (1, 2, 3, 8, 16) for n in (50_000, 1_000_000)] + [(384, 50_000)])
def test_caps_find_pairs_of_any_width(width, corpus):
    """Narrow vectors get smaller codes, so that their pairs share filters too."""
    directions = math.ceil(math.sqrt(corpus * 48 / caps.VECTORS_PER_FILTER))
    code = caps.ProductCode(width, *caps.code_for(width, directions, 0.9))
    for cosine in (0.9, 0.95) if width > 1 else (1.0,):
        assert caps.shared(code, *caps.pairs_at(cosine, width, 1000, 3)) >= 0.99


@pytest.mark.parametrize("width", [1, 2, 5, 8])
def test_links_of_narrow_vectors_against_all_pairs(spark, width):
    x = np.random.default_rng(width).standard_normal((1500, width))
    ids = np.arange(1500) // 2 if width == 5 else np.arange(1500)  # repeated rows too
    x = x[ids]
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    rows = caps.near_duplicates(frame).collect()
    close = units @ units.T >= 0.9
    assert len(rows) == 1500 and sum(r.n_links for r in rows) >= 0.99 * (close.sum() - 1500)
    want = sorted((int(i), int(n)) for i, n in zip(ids, close.sum(axis=1) - 1))
    assert all(got[1] <= most[1] for got, most in zip(sorted((r.vec_id, r.n_links) for r in rows), want))


def test_top_k_of_large_components(spark):
    """Scores beyond doubles, and beyond 64 bits, against Python's integers."""
    rng = np.random.default_rng(9)
    x = [[float(v) for v in rng.integers(-9, 9, 3)] for _ in range(100)]
    for i, size in ((0, 9e6), (7, 3e7), (50, 2.0**40), (60, 1e18), (61, -1e18), (99, 1e300)):
        x[i] = [size, 1.5, -size / 3]
    whole = [[math.floor(int(v) * 256 if abs(v) >= 2**53 else v * 256) for v in row] for row in x]
    clamp = lambda s: max(-(2**63), min(2**63 - 1, s))
    frame = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = {}
    for r in topk.top_k(frame, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in (0, 50):
        scores = sorted(((-clamp(sum(a * b for a, b in zip(whole[q], v))), i) for i, v in enumerate(whole) if i != q))[:5]
        assert got[q] == [(i, -s) for s, i in scores]


def test_long_texts_in_chunks(spark):
    """A text of 16 million characters: its chunks join to it, at the places that they say, in time that grows with it."""
    from pyspark.sql import functions as F

    unit = "Write to ann@example.org, or ring +1 (319) 555-5132; é日 card 4111 1111 1111 1111. "
    text = unit * (16_000_000 // len(unit))
    frame = spark.createDataFrame([(0, text), (1, unit), (2, ""), (3, unit * 30)], "doc_id long, text string")
    chunks = frame.select("doc_id", F.inline(pii._chunks(F.col("text")))).orderBy("doc_id", "at").collect()
    for i, whole in ((0, text), (1, unit), (2, ""), (3, unit * 30)):
        own = [c for c in chunks if c.doc_id == i]
        assert "".join(c.text for c in own) == whole
        at = 0
        for c in own:
            assert c.at == at and (len(c.text) < pii.LARGE)
            at += len(c.text)


def test_evidence_is_least_without_segments():
    for size in (1e-10, 0.0043, 1.0, 50.0):
        model = toxicity.Model(np.zeros(0, np.uint64), np.zeros(0), 0.2, rate=1.0, size=size)
        none = {toxicity.evidence(model, n, []) for n in (0, 1, 50, 5000)}
        assert len(none) == 1
        assert all(toxicity.evidence(model, n, [x]) >= max(none) for n in (1, 50, 5000, 10**9) for x in (1e-9, 0.1, 3.0, 40.0))


def test_empty_texts_score_least(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(-1, ""), (-2, None), (-3, "hello"), (-4, "zq " * 50), (-5, "zq " * 5000)], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.score(docs.unionByName(odd), model).collect()}
    assert len({scores[i] for i in (-1, -2, -3, -4, -5)}) == 1 and scores[-1] == min(scores.values())


def test_odds_law_and_curve_against_plain_ones(spark):
    """Stems' log-odds against counting; the law and the curve against drawn values."""
    rng = np.random.default_rng(4)
    x = -np.log(-np.log(rng.random(4000)) / (0.02 * 100)) / 1.7  # best of 100 words under rate 1.7, size 0.02
    rate, size = toxicity._fit_law(np.full(4000, 100.0), x)
    assert abs(rate - 1.7) < 0.12 and abs(math.log(size / 0.02)) < 0.3
    z = rng.normal(size=6000)
    slope, offset = toxicity._fit_curve(z, (rng.random(6000) < 1 / (1 + np.exp(-(2 * z - 1)))).astype(float))
    assert abs(slope - 2) < 0.2 and abs(offset + 1) < 0.2

    texts = [("badly nice", 1)] * 30 + [("badly", 1)] * 10 + [("nice words", 0)] * 50 + [("badly words", 0)] * 2
    frame = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, toxic int")
    table = dict(toxicity._odds(frame, 3.0, 2.0, 4.0))
    n_bad, n_good = 40, 52

    def odds(bad, good):
        held = 0.5 + 2.0 * (bad + good) / (n_bad + n_good)
        return math.log((bad + held) / (n_bad + 2.0)) - math.log((good + held) / (n_good + 2.0))

    import pyarrow as pa

    from fathom.llm._text import utf8_buffers

    for stem, counts in (("badly", (40, 2)), ("nice", (30, 50)), ("words", (0, 52))):
        token = int(toxicity._tokens(*utf8_buffers(pa.array([stem])))[1][0])
        spread = math.sqrt(sum(1 / (c + 0.5 + 2.0 * sum(counts) / (n_bad + n_good)) for c in counts))
        assert (token in table) == (abs(odds(*counts)) / spread >= 3.0)
        if token in table:
            assert abs(table[token] - odds(*counts)) < 1e-9
