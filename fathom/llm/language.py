"""Language of a text by its spans: script ranges, scores of words, a switching penalty.

A word is a run of letters of one script. The script leaves the languages that were seen
to write it; the word's character n-grams score those by how much oftener a language
uses them than languages do on the average. A text is then a row of words with a score
for every language, and Viterbi's algorithm labels it: staying in a language is free,
switching costs a penalty, so that a foreign name stays inside its sentence and a
foreign sentence becomes a span of its own. The language with most letters is the text's.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._text import BASE, BASE_INVERSE, SPACE, by_key, code_points, mix, powers, row_slices, utf8_buffers

#: Labelled texts of a language that the model learns from at most, about, taken by a hash of doc_id beyond it.
LABELLED_TEXTS = 4_000
#: Hash buckets of n-grams; a model has a float for each bucket and language, and is sent to all workers.
BUCKETS = 1 << 17
#: Characters of the longest n-gram, and scores are divided by it, as the n-grams of a place overlap.
ORDER = 3
#: Characters of a word in scripts without spaces, and of any word; longer runs are cut.
PIECE, LONGEST = 4, 40
#: Bytes of text handled at once, and numbers (words times languages) labelled at once.
SLICE_BYTES, CELLS = 500_000, 6_000_000
#: Share of a language's letters from which on a script is one of its own.
OWN_SCRIPT = 0.01
#: What a language loses on a word in a script that is not its own but another's.
FOREIGN = 50.0
#: What a word needs beside its own evidence to begin a span of another language, in natural logarithms.
PENALTY = 8.0

# The blocks of the Unicode standard that hold the scripts' letters.
SCRIPTS = {
    "latin": [(0x0041, 0x024F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF5A)],
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F), (0xFB13, 0xFB17)],
    "hebrew": [(0x0590, 0x05FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F), (0xA8E0, 0xA8FF)],
    "bengali": [(0x0980, 0x09FF)],
    "gurmukhi": [(0x0A00, 0x0A7F)],
    "gujarati": [(0x0A80, 0x0AFF)],
    "oriya": [(0x0B00, 0x0B7F)],
    "tamil": [(0x0B80, 0x0BFF)],
    "telugu": [(0x0C00, 0x0C7F)],
    "kannada": [(0x0C80, 0x0CFF)],
    "malayalam": [(0x0D00, 0x0D7F)],
    "sinhala": [(0x0D80, 0x0DFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF)],
    "thai": [(0x0E00, 0x0E7F)],
    "lao": [(0x0E80, 0x0EFF)],
    "tibetan": [(0x0F00, 0x0FFF)],
    "burmese": [(0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)],
    "khmer": [(0x1780, 0x17FF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9D)],
    "han": [(0x2E80, 0x2FDF), (0x3005, 0x3007), (0x3100, 0x312F), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
}
WITHOUT_SPACES = ("thai", "lao", "tibetan", "burmese", "khmer", "kana", "han")
OTHER = len(SCRIPTS)


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every code point: itself lower-cased, whether it is a letter, whether a mark, and its script."""
    fold, letter, mark = np.arange(0x200000, dtype=np.uint32), np.zeros(0x200000, bool), np.zeros(0x200000, bool)
    script = np.full(0x200000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            letter[c] = True
            low = chr(c).lower()
            fold[c] = ord(low) if len(low) == 1 else c
        elif kind == "M":
            mark[c] = True
    for k, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            script[first : last + 1] = k
    return fold, letter, mark, script


@dataclass(frozen=True)
class Model:
    """Languages, most frequent first; scores of buckets, and the scripts' languages (scripts by languages)."""

    languages: tuple[str, ...]
    scores: np.ndarray
    own: np.ndarray


@dataclass(frozen=True)
class Words:
    """Words of some rows: row, first and last code point in it, letters, script; and where the letters' n-grams fall."""

    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    letters: np.ndarray
    script: np.ndarray
    first: np.ndarray
    grams: list[np.ndarray]
    edges: list[np.ndarray]


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, first byte, byte after the last): rows together up to a slice, longer ones cut.

    Where a row is cut depends on that row alone: after white space if the last 4,096 bytes
    have any, else before a character.
    """
    for r, to in row_slices(offsets, SLICE_BYTES):
        s, end = int(offsets[r]), int(offsets[to])
        while end - s > SLICE_BYTES:
            e = s + SLICE_BYTES
            space = np.flatnonzero(SPACE[data[e - 4096 : e]])
            if len(space):
                e += int(space[-1]) + 1 - 4096
            while data[e] & 0xC0 == 0x80:
                e -= 1
            yield r, to, s, e
            s = e
        yield r, to, s, end


def _words(data: np.ndarray, offsets: np.ndarray) -> Words | None:
    """The words of rows of UTF-8, with the buckets of their n-grams."""
    fold, letter, mark, script = _classes()
    points, rows = code_points(data, offsets)
    n = len(points)
    if not n:
        return None
    part, letters, marks = fold[points], letter[points], mark[points]
    kind = script[points]
    if marks.any():  # a mark is of the script of what it stands on
        kind = kind[np.maximum.accumulate(np.where(marks, 0, np.arange(n)))]
    inside = letters | marks
    edge = np.ones(n + 1, dtype=bool)
    edge[1:n] = (kind[1:] != kind[:-1]) | (inside[1:] != inside[:-1])
    edge[rows] = True
    bounds = np.flatnonzero(edge)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    width = np.full(OTHER + 1, LONGEST)
    width[[list(SCRIPTS).index(s) for s in WITHOUT_SPACES]] = PIECE
    edge[:n] |= place % width[kind] == 0
    bounds = np.flatnonzero(edge)
    known = inside[bounds[:-1]] & (np.add.reduceat(letters, bounds[:-1], dtype=np.int64) > 0)
    starts, ends = bounds[:-1][known], bounds[1:][known]
    if not len(starts):
        return None
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.repeat(starts - first, size) + np.arange(int(size.sum()))
    begin = np.repeat(starts, size)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
    back = powers(BASE_INVERSE, n + 1)

    def bucket(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
        return (mix((total[b] - total[a]) * back[a] + np.uint64(salt)) & np.uint64(BUCKETS - 1)).astype(np.int64)

    grams = [bucket(np.maximum(begin, at + 1 - k), at + 1, 2 * k) for k in range(1, ORDER + 1)]
    ends_of = [bucket(np.maximum(starts, ends - k), ends, 2 * k + 1) for k in range(2, ORDER + 1)] + [bucket(starts, ends, 1)]
    row = np.searchsorted(rows, starts, side="right") - 1
    count = np.add.reduceat(letters[at], first, dtype=np.int64)
    return Words(row, starts - rows[row], ends - rows[row], count, kind[starts], first, grams, ends_of)


def _word_scores(model: Model, words: Words) -> np.ndarray:
    """A score for every word and language."""
    own = sum(model.scores[g] for g in words.grams)
    out = np.add.reduceat(own, words.first, axis=0) + sum(model.scores[g] for g in words.edges)
    mine = model.own[words.script]
    return out / ORDER - np.where(mine | ~mine.any(axis=1, keepdims=True), 0, FOREIGN).astype(np.float32)


def viterbi(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """Labels of the best path of every row, staying free and switching at a ``penalty``.

    ``scores`` has the rows' words one after the other, ``counts`` the words of each row.
    All rows take their steps together; ties stay, and go to the first label.
    """
    n, k = scores.shape
    labels = np.zeros(n, np.int64)
    begin = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    size, begin = counts[order], begin[order]
    size, begin = size[size > 0], begin[size > 0]
    if not len(size):
        return labels
    active = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
    switched, came = np.zeros((n, k), bool), np.zeros(n, np.int32)
    value = scores[begin].astype(np.float64)
    for t in range(1, int(size[0])):
        a = int(active[t])
        held, at = value[:a], begin[:a] + t
        best = held.argmax(axis=1)
        jump = np.take_along_axis(held, best[:, None], 1) - penalty
        came[at] = best
        switched[at] = jump > held
        value[:a] = np.maximum(held, jump) + scores[at]
    now = value.argmax(axis=1)
    for t in range(int(size[0]) - 1, -1, -1):
        a = int(active[t])
        at = begin[:a] + t
        labels[at] = now[:a]
        now[:a] = np.where(switched[at, now[:a]], came[at], now[:a])
    return labels


def _learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n): n-grams of a language's texts by bucket; letters by script as -1 - script."""
    for batch in batches:
        for (lang,), rows in by_key(batch, ("lang",)):
            data, offsets = utf8_buffers(rows.column(1))
            grams, letters = np.zeros(BUCKETS, np.int64), np.zeros(OTHER + 1, np.int64)
            for r, to, s, e in _parts(data, offsets):
                words = _words(data[s:e], np.clip(offsets[r : to + 1], s, e) - s)
                if words is not None:
                    for g in (*words.grams, *words.edges):
                        grams += np.bincount(g, minlength=BUCKETS)
                    np.add.at(letters, words.script, words.letters)
            some, scripts = np.flatnonzero(grams), np.flatnonzero(letters)
            at, n = np.concatenate([some, -1 - scripts]), np.concatenate([grams[some], letters[scripts]])
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n)], names=["lang", "bucket", "n"])


def fit(docs: DataFrame, learn: Column | None = None) -> Model:
    """Learn from ``text`` and ``lang`` of the rows that ``learn`` marks (default: all) and that have both.

    Every language with such a row is learnt, from about LABELLED_TEXTS of its texts at
    most, drawn by a hash of doc_id and text. A language whose texts hold no letter is
    learnt too, but nothing speaks for it. The driver and every worker hold BUCKETS
    numbers for each language, whatever the input's size.
    """
    rows = docs.filter(F.coalesce(learn, F.lit(False))) if learn is not None else docs
    rows = rows.filter("text is not null and lang is not null").select("lang", "text", F.xxhash64("doc_id", "text").alias("drawn"))
    sizes = sorted(((r["count"], r.lang) for r in rows.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    names = tuple(lang for _, lang in sizes)
    rates = rows.sparkSession.createDataFrame([(lang, min(1.0, LABELLED_TEXTS / n)) for n, lang in sizes], "lang string, rate double")
    drawn = F.pmod("drawn", F.lit(1_000_000)) < F.col("rate") * 1_000_000
    taken = rows.join(F.broadcast(rates), "lang").filter(drawn).select("lang", "text")
    found = taken.mapInArrow(_learnt, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    at = {lang: k for k, lang in enumerate(names)}
    grams, letters = np.zeros((BUCKETS, len(names))), np.zeros((OTHER + 1, len(names)))
    lang = np.array([at[x] for x in found.column(0).to_pylist()], np.int64)
    bucket, n = (found.column(k).to_numpy() for k in (1, 2))
    grams[bucket[bucket >= 0], lang[bucket >= 0]] = n[bucket >= 0]
    letters[-1 - bucket[bucket < 0], lang[bucket < 0]] = n[bucket < 0]
    each = grams.sum(axis=0)
    rate = (grams / np.maximum(each, 1)).mean(axis=1, keepdims=True) if names else grams
    scores = np.log((grams + 0.5) / (rate * each + 0.5)).astype(np.float32)
    return Model(names, scores, letters >= OWN_SCRIPT * np.maximum(letters.sum(axis=0), 1))


def _judged(model: Model, words: list[Words], scores: list[np.ndarray], rows: int, penalty: float) -> tuple[list, list, list]:
    """Language, score and spans of each of ``rows`` rows."""
    row = np.concatenate([w.row for w in words]) if words else np.zeros(0, np.int64)
    start, end, size = (np.concatenate([getattr(w, k) for w in words]) if words else row for k in ("start", "end", "letters"))
    table = np.concatenate(scores) if scores else np.zeros((0, len(model.languages)), np.float32)
    counts = np.bincount(row, minlength=rows)
    label = viterbi(table, counts, penalty)
    k = len(model.languages)
    share = np.bincount(row * k + label, weights=size, minlength=rows * k).reshape(rows, k)
    best = share.argmax(axis=1)
    mine = np.flatnonzero(label == best[row])
    evidence = np.zeros((rows, k))
    some, first = np.unique(row[mine], return_index=True)
    if len(mine):
        evidence[some] = np.add.reduceat(table[mine], first, axis=0)
    sure = np.exp(evidence - evidence.max(axis=1, keepdims=True))
    sure /= sure.sum(axis=1, keepdims=True)
    each = np.arange(rows)
    score = share[each, best] / np.maximum(share.sum(axis=1), 1) * sure[each, best]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (label[1:] != label[:-1])
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(row))[: len(begins)] - 1
    spans: list[list[dict]] = [[] for _ in range(rows)]
    for r, b, e, x in zip(row[begins].tolist(), start[begins].tolist(), end[lasts].tolist(), label[begins].tolist()):
        spans[r].append({"start": b, "end": e, "lang": model.languages[x]})
    langs = [model.languages[b] if c else "und" for b, c in zip(best.tolist(), counts.tolist())]
    return langs, np.where(counts > 0, score, 0.0).tolist(), spans


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """Label every whole text of ``docs`` (``doc_id``, ``text``).

    Returns doc_id, lang_pred, score (0 to 1: the letters' share of that language, times
    how sure its own words are of it) and spans (start, end in code points, end exclusive;
    lang): marks, digits and spaces between two words of a language are inside its span.
    Null texts and those without a letter are ``und`` with score 0 and no spans, as all
    are if no language was learnt. Where nothing speaks for a language, and in ties, the
    one with most learnt texts counts. Rows may repeat; other columns are not read; an
    empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score", "spans"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(1))
            n = batch.num_rows
            langs, scores, spans = [], [], []
            words, tables, cells, done = [], [], 0, 0
            before, last = 0, -1

            def close(to: int) -> None:
                nonlocal words, tables, cells, done
                for out, more in zip((langs, scores, spans), _judged(m, words, tables, to - done, penalty)):
                    out += more
                words, tables, cells, done = [], [], 0, to

            for r, to, s, e in _parts(data, offsets) if m.languages else ():
                if r != last and cells > CELLS:
                    close(r)
                own = np.clip(offsets[r : to + 1], s, e) - s
                found = _words(data[s:e], own)
                before = before if r == last else 0  # code points of a long row that earlier slices had
                if found is not None:
                    table = _word_scores(m, found)
                    words.append(Words(found.row + r - done, found.start + before, found.end + before, found.letters, found.script, *[None] * 3))
                    tables.append(table)
                    cells += table.size
                before, last = before + int(((data[s:e] & 0xC0) != 0x80).sum()), r
            if m.languages:
                close(n)
            else:
                langs, scores, spans = ["und"] * n, [0.0] * n, [[]] * n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(spans, kind)], names=names)

    key = docs.schema["doc_id"].dataType.simpleString()
    out = "lang_pred string, score double, spans array<struct<start: long, end: long, lang: string>>"
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, " + out)
