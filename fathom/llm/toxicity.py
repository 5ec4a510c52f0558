"""Toxic passages as maximum-scoring segments of token log-odds.

A token is a whole word; what the training does not know of it is taken from its
stem, its first characters, so that inflections count together. Scripts without
spaces, and very long runs, are cut into character n-grams, one from every character.
Training counts the toxic and the clean labelled texts that hold each stem and each
word; the log-odds have a Dirichlet prior centred on the rate in both classes
together. Stems keep them that are sure of their sign, and words that surely differ
from what their stem gives them. A text is then a row of
scores, every word paying a small price, and one linear scan finds all maximal
segments. Under an extreme-value law fitted to the clean texts' best segments, a
segment's score becomes a significance that allows for the text's length; the
significance of the best segment and of all others that stand out gives the
text's score.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import cut
from fathom.llm._text import BASE, BASE_INVERSE, SLICE_BYTES, code_points, cuts, mix, powers, row_slices, utf8_buffers

#: Labelled rows that a model is fitted to at most, about, taken by a hash of doc_id beyond it.
LABELLED_ROWS = 2_000_000
#: Of those, rows that fit the extreme-value law and the final curve, at most about this many.
CALIBRATION_ROWS = 20_000
#: Stems and words of a model (16 bytes each, sent to all workers): with more, half as many labelled rows are taken.
MODEL_TOKENS = 4_000_000
#: Labels up to which they are broadcast to the texts (16 bytes each).
BROADCAST_LABELS = 2_000_000
#: Characters of a stem, and of an n-gram and its stem in scripts without spaces and in longer runs than LONGEST.
STEM, GRAM, GRAM_STEM, LONG_GRAM, LONGEST = 4, 4, 2, 8, 40
#: A passage is significant where a clean text holds such a one with chance 1/100 at most.
SIGNIFICANT = math.log(100)
#: Evidence of a text without any segment; a text that a clean one reaches has more.
NO_EVIDENCE = -4.0

#: Thai, Lao, Burmese, Khmer, kana and Han; symbols are added below.
WITHOUT_SPACES = (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9D), (0x20000, 0x3FFFF),
)


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: itself lower-cased, or a space for marks and controls; whether it stands without spaces."""
    fold, solid = np.arange(0x200000, dtype=np.uint32), np.zeros(0x200000, dtype=bool)
    for first, last in WITHOUT_SPACES:
        solid[first : last + 1] = True
    for c in range(0x20000):
        kind, low = unicodedata.category(chr(c)), chr(c).lower()
        if kind[0] in "PZ" or kind == "Cc" or c < 128 and not chr(c).isalnum():
            fold[c], solid[c] = 0x20, False
        elif kind[0] == "S":
            solid[c] = True
        elif len(low) == 1:
            fold[c] = ord(low)
    return fold, solid


FOLD, SOLID = _classes()


@dataclass(frozen=True)
class Model:
    """Sorted hashes with their scores, the price of a word, the law's parameters and the curve."""

    tokens: np.ndarray
    scores: np.ndarray
    price: float
    rate: float = 1.0
    size: float = 1.0
    slope: float = 1.0
    offset: float = 0.0


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), by one scan over the positive scores."""
    total = np.concatenate([[0.0], np.cumsum(scores)])
    begin, end, low, high, link = [], [], [], [], []
    for p in np.flatnonzero(scores > 0).tolist():
        b, left, right = p, total[p], total[p + 1]
        j = len(low) - 1
        while True:
            while j >= 0 and low[j] >= left:
                j = link[j]
            if j < 0 or high[j] >= right:
                break
            b, left = begin[j], low[j]
            back = link[j]
            del begin[j:], end[j:], low[j:], high[j:], link[j:]
            j = back
        for column, value in ((begin, b), (end, p + 1), (low, left), (high, right), (link, j)):
            column.append(value)
    return [(b, e, float(h - lo)) for b, e, lo, h in zip(begin, end, low, high)]


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of all tokens and of their stems, and the number of tokens of each row."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    words, stems = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for s, e in cuts(data, offsets, SLICE_BYTES):
        points, rows = code_points(data[s:e], np.clip(offsets, s, e) - s)
        part = FOLD[points]
        n = len(part)
        gap, solid = part == 0x20, SOLID[part]
        edge = np.ones(n + 1, dtype=bool)
        edge[1:n] = gap[1:] | gap[:-1] | (solid[1:] != solid[:-1])
        edge[rows] = True
        bounds = np.flatnonzero(edge)
        length = np.repeat(np.diff(bounds), np.diff(bounds))
        starts = np.flatnonzero(~gap & (edge[:n] | solid | (length > LONGEST)))
        run_end = np.repeat(bounds[1:], np.diff(bounds))[starts]
        alone = solid[starts]
        width = np.where(alone, GRAM, np.where(length[starts] > LONGEST, LONG_GRAM, LONGEST))
        ends = np.minimum(run_end, starts + width)
        short = np.minimum(ends, starts + np.where(alone, GRAM_STEM, STEM))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=total[1:])
        back = powers(BASE_INVERSE, n)[starts]
        words.append(mix((total[ends] - total[starts]) * back + (ends - starts).astype(np.uint64)))
        stems.append(mix((total[short] - total[starts]) * back))
        counts += np.bincount(np.searchsorted(rows, starts, side="right") - 1, minlength=len(counts))
    return np.concatenate(words), np.concatenate(stems), counts


def _values(model: Model, words: np.ndarray, stems: np.ndarray) -> np.ndarray:
    """The score of every word: its own where the model has one, else its stem's, else none."""
    scores = np.zeros(len(words))
    if len(model.tokens):
        for keys in (stems, words):
            at = np.minimum(np.searchsorted(model.tokens, keys), len(model.tokens) - 1)
            scores = np.where(model.tokens[at] == keys, model.scores[at], scores)
    return scores


def _scored_rows(model: Model, column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int, float]]]]:
    """(row, words, segments) for every row of a text column."""
    data, offsets = utf8_buffers(column)
    for s, e in row_slices(offsets):
        words, stems, counts = _tokens(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])
        scores = _values(model, words, stems) - model.price
        ends = np.cumsum(counts)
        for row, end, n in zip(range(s, e), ends.tolist(), counts.tolist()):
            own = scores[end - n : end]
            yield row, n, segments(own) if n and own.max() > 0 else []


def significant(model: Model, n_words: int, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """The segments that stand out of what a clean text of this length reaches, with their significance."""
    least = math.log(model.size * max(n_words, 1))
    return [(b, e, model.rate * x - least) for b, e, x in found if model.rate * x - least >= SIGNIFICANT]


def _fit_law(n_words: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """rate and size of P(best < x) = exp(-size * n * exp(-rate * x)), by profile likelihood."""
    if not len(best):
        return 1.0, 1.0
    fits = []
    for rate in np.geomspace(0.05, 10, 80):
        size = len(best) / np.sum(n_words * np.exp(-rate * best))
        fits.append((len(best) * math.log(size * rate) + np.sum(np.log(n_words) - rate * best), rate, size))
    _, rate, size = max(fits)
    return float(rate), float(size)


def _fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """slope and offset of a logistic curve, slightly held back, by Newton steps."""
    w = np.zeros(2)
    design = np.column_stack([x, np.ones(len(x))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + 0.01 * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def evidence(model: Model, n_words: int, scores: list[float]) -> float:
    """The best segment's significance, below zero if a clean text reaches it, and all others' above zero; damped.

    A text without any segment has NO_EVIDENCE, whatever its length, and no text has less.
    """
    if not scores:
        return NO_EVIDENCE
    least = math.log(model.size * max(n_words, 1))
    excess = sorted(model.rate * x - least for x in scores)
    total = excess[-1] + sum(max(x, 0.0) for x in excess[:-1])
    return max(NO_EVIDENCE, math.copysign(math.log1p(abs(total)), total))


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one row per labelled document, toxic if any of its labels is; other values are left out."""
    return labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic) for the rows with ``known_labels``: broadcasting them up to a checked number."""
    known = F.broadcast(labels) if labels.count() <= BROADCAST_LABELS else labels
    return docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "toxic")


def fit(docs: DataFrame, labels: DataFrame, sure: float = 3.0, price: float = 0.2, prior: float = 2.0, apart: float = 4.0) -> Model:
    """Learn from the labelled texts: ``labels`` has doc_id and toxic (1 or 0; others are ignored).

    Counts cover every labelled text up to LABELLED_ROWS; the law and the curve are fitted to
    about CALIBRATION_ROWS of them at most, taken by a hash of doc_id. Every stem whose
    log-odds are ``sure`` standard deviations from zero, and every word that is ``apart``
    from its stem, is in the model. Without texts of both classes no word scores and
    every text gets the prior share of toxic ones.
    """
    labels = known_labels(labels)
    n_labels = labels.count()
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(1)), F.lit(1_000_000))
    taken = min(1_000_000, int(1_000_000 * LABELLED_ROWS / max(n_labels, 1)) + 1)
    while True:
        texts = labelled_texts(docs, labels.filter(drawn < taken))
        table = _odds(texts, sure, prior, apart)
        if table is not None:
            break
        taken //= 2
    plain = Model(np.array([t[0] for t in table], np.uint64), np.array([t[1] for t in table], float), price)
    every = min(1_000_000, int(1_000_000 * CALIBRATION_ROWS / max(n_labels * taken / 1_000_000, 1)) + 1)
    some = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < every)
    known = some.sparkSession.sparkContext.broadcast(plain)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch.column(1))
            out = [(int(toxic[r]), n, [x for _, _, x in found]) for r, n, found in _scored_rows(known.value, batch.column(0))]
            if out:
                kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["y", "n", "found"])

    seen = cut(some.select("text", "toxic").mapInArrow(measure, "y int, n long, found array<double>"))
    clean = seen.filter("y = 0").select(F.greatest("n", F.lit(1)).alias("n"), F.coalesce(F.array_max("found"), F.lit(0.0)).alias("best")).collect()
    rate, size = _fit_law(np.array([c.n for c in clean], float), np.array([c.best for c in clean], float))
    law = replace(plain, rate=rate, size=size)
    bare = replace(law, tokens=plain.tokens[:0], scores=plain.scores[:0])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [evidence(bare, n, found) for n, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.float64())], names=["y", "x"])

    points = seen.mapInArrow(weigh, "y int, x double").collect()
    slope, offset = _fit_curve(np.array([r.x for r in points]), np.array([r.y for r in points], float)) if points else (0.0, -30.0)
    return replace(law, slope=slope, offset=offset)


def _odds(texts: DataFrame, sure: float, prior: float, apart: float) -> list[tuple[int, float]] | None:
    """(token, log-odds) of all stems and words of a model, by token; None if they are too many."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(0))
            toxic = np.asarray(batch.column(1))
            for s, e in row_slices(offsets):
                words, stems, counts = _tokens(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])
                rows = mix(np.repeat(np.arange(len(counts), dtype=np.uint64), counts))
                toxic_at = np.repeat(toxic[s:e] == 1, counts)
                for own, of in ((stems, None), (words, stems)):
                    # a token counts once for a text, however often it stands in it
                    once = np.unique(mix(own + rows), return_index=True)[1]
                    keys, first, inverse = np.unique(own[once], return_index=True, return_inverse=True)
                    n_bad = np.bincount(inverse, weights=toxic_at[once], minlength=len(keys)).astype(np.int64)
                    n_good = np.bincount(inverse, minlength=len(keys)) - n_bad
                    parent = pa.nulls(len(keys), pa.int64()) if of is None else pa.array(of[once][first].view(np.int64))
                    columns = [pa.array(keys.view(np.int64)), parent, pa.array(n_bad), pa.array(n_good)]
                    yield pa.RecordBatch.from_arrays(columns, names=["token", "stem", "bad", "good"])

    counted = texts.select("text", "toxic").mapInArrow(count, "token long, stem long, bad long, good long")
    counted = counted.groupBy("token").agg(F.min("stem").alias("stem"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    sizes = texts.groupBy("toxic").count().collect()
    n_bad, n_good = (sum(r["count"] for r in sizes if r.toxic == y) for y in (1, 0))
    if not n_bad or not n_good:
        return []
    held = 0.5 + prior * (F.col("bad") + F.col("good")) / F.lit(float(n_bad + n_good))
    odds = F.log((F.col("bad") + held) / F.lit(n_bad + prior)) - F.log((F.col("good") + held) / F.lit(n_good + prior))
    spread = F.sqrt(1 / (F.col("bad") + held) + 1 / (F.col("good") + held))
    counted = cut(counted.withColumns({"score": odds, "spread": spread}))

    def surest(rows: DataFrame, base: Column, least: float) -> DataFrame:
        return cut(rows.filter(F.abs((F.col("score") - base) / F.col("spread")) >= least).select("token", "score"))

    stems = surest(counted.filter("stem is null"), F.lit(0.0), sure)
    if stems.count() > MODEL_TOKENS:
        return None
    base = F.broadcast(stems.select(F.col("token").alias("stem"), F.col("score").alias("base")))
    words = counted.filter("stem is not null").join(base, "stem", "left").withColumn("base", F.coalesce("base", F.lit(0.0)))
    # a word's prior is centred on the rates that its stem gives it
    share = 1 / (1 + F.exp(-F.col("base")) * F.lit(n_good / n_bad))
    bad, good = F.col("bad") + 0.5 + prior * share, F.col("good") + 0.5 + prior * (1 - share)
    words = words.withColumns({"score": F.log(bad / good) - F.lit(math.log(n_bad / n_good)), "spread": F.sqrt(1 / bad + 1 / good)})
    words = surest(words, F.col("base"), apart)
    if stems.count() + words.count() > MODEL_TOKENS:
        return None
    return sorted((r.token & 0xFFFFFFFFFFFFFFFF, r.score) for r in stems.unionAll(words).collect())


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """Score every whole text of ``docs`` (``doc_id``, ``text``).

    The columns named in ``carry`` are given back as they are, after the others.
    Returns doc_id, score (0 to 1), n_words (in scripts without spaces every character
    begins one) and passages: every significant passage as first word, end word (exclusive) and significance, the natural logarithm of one
    over the number of such passages expected in a clean text. Null and empty texts
    have no passages and the lowest score, as all texts without a segment. Rows may repeat; other columns are not
    read; an empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "score", "n_words", "passages"]
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("significance", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for batch in batches:
            scores, sizes, passages = [], [], []
            for _, n, found in _scored_rows(m, batch.column(1)):
                value = m.slope * evidence(m, n, [x for _, _, x in found]) + m.offset
                scores.append(1 / (1 + math.exp(-min(max(value, -30.0), 30.0))))
                sizes.append(n)
                passages.append([{"start": b, "end": e, "significance": x} for b, e, x in significant(m, n, found)])
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array(sizes, pa.int64()), pa.array(passages, kind)]
            yield pa.RecordBatch.from_arrays([*columns, *(batch.column(at[c]) for c in carry)], names=[*names, *carry])

    others = [c for c in carry if c != "text"]
    at = {"text": 1} | {c: k + 2 for k, c in enumerate(others)}
    given = docs.select("doc_id", "text", *(F.col(c).alias(f"_{k}") for k, c in enumerate(others)))
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    key = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(
        run,
        f"doc_id {key}, score double, n_words long, passages array<struct<start: long, end: long, significance: double>>" + more,
    )
