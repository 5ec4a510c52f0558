"""Quality from weak labels: heuristic labellers, expectation-maximisation, a hashed linear scorer.

Each labeller votes good, bad or nothing on every text. The number of texts with
each pattern of votes, counted over the whole corpus, is all that
expectation-maximisation needs to estimate how often each labeller votes what on
good and on bad texts, and so how likely a text with that pattern is good. These
posterior labels train a linear scorer on hashed words, word shapes and
repetitions, which then judges every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm._text import SPACE, row_slices, utf8_buffers, word_hashes

BAD, NONE, GOOD = 0, 1, 2
LABELLERS = ("capitals", "marks", "repeats", "bars", "sentences", "emphasis", "variety", "length", "strings")
#: Texts that the scorer is trained on, at most about this many.
TRAINING_ROWS = 8_000
#: Hashed features: words, shapes and repetitions share the buckets.
BUCKETS = 1 << 14

UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LETTER = UPPER.copy()
LETTER[0x61:0x7B] = True
LETTER[0x80:] = True
#: Marks that prose has few of.
ODD = np.zeros(256, bool)
ODD[[ord(c) for c in "#$%&*+/<=>@\\^_`{|}~"]] = True
#: A byte's part of a word's shape: capital, other letter, digit, or the mark itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[LETTER] = ord("a")
SHAPE[UPPER] = ord("A")
SHAPE[0x30:0x3A] = ord("0")
SHAPE[SPACE] = 0x20


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])


def _vote(bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


class Slice:
    """What labellers and scorer read of a slice of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.words, self.counts = word_hashes(data, offsets)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        same = np.zeros(len(self.words), bool)
        same[1:] = (self.words[1:] == self.words[:-1]) & (self.row[1:] == self.row[:-1])
        self.same = same

    def votes(self) -> np.ndarray:
        """A code per text: its votes as digits to base three, the first labeller's lowest."""
        data, offsets, counts = self.data, self.offsets, self.counts
        n = np.maximum(counts, 1)
        letters = np.maximum(_sums(LETTER[data], offsets), 1)
        capitals = _sums(UPPER[data], offsets) / letters
        marks = _sums(ODD[data], offsets) / np.maximum(np.diff(offsets), 1)
        repeats = np.bincount(self.row, weights=self.same, minlength=len(counts)) / n
        following = np.append(data[1:], np.uint8(0x20))
        before = np.append(np.uint8(0x20), data[:-1])
        ends = SPACE[following]
        ends[offsets[1:][np.diff(offsets) > 0] - 1] = True
        bars = _sums((data == ord("|")) & ends & SPACE[before], offsets) / n
        stops = _sums(((data == ord(".")) | (data == ord("?"))) & ends, offsets) / n
        emphasis = _sums((data == ord("!")) & (before == ord("!")) & ends, offsets) / n
        strings = _sums(ODD[data] & (before == data) & ends, offsets) / n
        order = np.lexsort((self.words, self.row))
        w, r = self.words[order], self.row[order]
        distinct = r[np.append(True, (w[1:] != w[:-1]) | (r[1:] != r[:-1]))[: len(r)]]
        # of w words of prose about a power below one of w differ
        variety = np.bincount(distinct, minlength=len(counts)) / n**0.75
        some = counts >= 20
        columns = [
            _vote(capitals > 0.5, capitals < 0.2),
            _vote(marks > 0.04, marks < 0.015),
            _vote(repeats > 0.25, repeats < 0.05),
            _vote(bars > 0.15, bars < 0.02),
            _vote(some & (stops < 0.005), some & (stops > 0.02) & (stops < 0.3)),
            _vote(emphasis > 0.25, emphasis < 0.03),
            _vote(some & (variety < 0.5), some & (variety > 1.0)),
            _vote(counts < 3, np.zeros(len(counts), bool)),
            _vote(strings > 0.15, strings < 0.02),
        ]
        return sum(c.astype(np.int64) * 3**i for i, c in enumerate(columns))

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, row, weight) of every hashed feature: each kind's weights add up to one in a text."""
        shape = SHAPE[self.data]
        keep = np.append(True, shape[1:] != shape[:-1])[: len(shape)]
        keep[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        kept = np.concatenate([[0], np.cumsum(keep)])[self.offsets]
        shapes, n_shapes = word_hashes(shape[keep], kept, np.arange(256, dtype=np.uint8))
        low, top = np.uint64(BUCKETS - 4), np.int64(BUCKETS - 2)
        words = (self.words % low).astype(np.int64)
        forms = ((shapes ^ np.uint64(0x5BD1E995)) % low).astype(np.int64)
        share = 1 / np.maximum(self.counts, 1)
        own = share[self.row]
        of_shape = np.repeat(np.arange(len(n_shapes)), n_shapes)
        buckets = np.concatenate([words, forms, top + self.same])
        rows = np.concatenate([self.row, of_shape, self.row])
        return buckets, rows, np.concatenate([0.3 * own, (1 / np.maximum(n_shapes, 1))[of_shape], own])


def _slices(column: pa.Array) -> Iterator[tuple[int, int, Slice]]:
    data, offsets = utf8_buffers(column)
    for s, e in row_slices(offsets):
        yield s, e, Slice(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s])


def vote(docs: DataFrame) -> DataFrame:
    """(doc_id, text, votes): votes is the code of the labellers' votes on the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, e, part in _slices(batch.column(1)):
                part_of = batch.slice(s, e - s)
                yield pa.RecordBatch.from_arrays(
                    [part_of.column(0), part_of.column(1), pa.array(part.votes())], names=["doc_id", "text", "votes"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, text string, votes long")


def estimate(codes: np.ndarray, sizes: np.ndarray, rounds: int = 200, held: float = 0.05) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation over patterns of votes and their numbers.

    Returns the share of good texts, each labeller's chances to vote good by class
    (bad, good), and each pattern's chance to be good. An abstention says nothing.
    The start, which also counts as ``held`` of the texts, says that a labeller seldom
    accuses a good text but overlooks most kinds of bad ones; so bad texts of several
    kinds, each known to one labeller, stay one class.
    """
    digits = (codes[:, None] // 3 ** np.arange(len(LABELLERS))) % 3
    start = np.tile([0.7, 0.999], (len(LABELLERS), 1))
    chance, share, pseudo = start.copy(), 0.85, held * sizes.sum() + 1.0
    posterior = np.full(len(codes), share)
    for _ in range(rounds):
        says_good = np.log(chance[:, 1] / chance[:, 0])
        says_bad = np.log((1 - chance[:, 1]) / (1 - chance[:, 0]))
        odds = np.log(share / (1 - share)) + (digits == GOOD) @ says_good + (digits == BAD) @ says_bad
        new = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        for c, weight in ((0, (1 - new) * sizes), (1, new * sizes)):
            good, bad = weight @ (digits == GOOD), weight @ (digits == BAD)
            chance[:, c] = (good + pseudo * start[:, c]) / (good + bad + pseudo)
        share = float(((new * sizes).sum() + 4) / (sizes.sum() + 5))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            break
        posterior = new
    return share, chance, posterior


def train(examples: list[tuple[float, bytes, bytes]], rounds: int = 150) -> np.ndarray:
    """Weights (the last is the offset) of a logistic scorer for soft labels, by Adam on all examples at once."""
    weights = np.zeros(BUCKETS + 1)
    if not examples:
        return weights
    goal = np.array([x[0] for x in examples])
    buckets = np.concatenate([np.frombuffer(x[1], "<i4") for x in examples])
    values = np.concatenate([np.frombuffer(x[2], "<f4") for x in examples]).astype(float)
    rows = np.repeat(np.arange(len(examples)), [len(x[1]) // 4 for x in examples])
    balance = np.where(goal > 0.5, 0.5 / max(goal.mean(), 0.02), 0.5 / max(1 - goal.mean(), 0.02))
    mean, square = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(rows, weights=values * weights[buckets], minlength=len(goal)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - goal) * balance / len(goal)
        gradient = np.append(np.bincount(buckets, weights=values * error[rows], minlength=BUCKETS), error.sum()) + 1e-6 * weights
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        weights -= 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return weights


def fit(docs: DataFrame) -> tuple[np.ndarray, dict[int, float]]:
    """The scorer's weights and every pattern's chance to be good, from the corpus alone.

    All texts' votes are counted (3**9 patterns at most); the scorer learns from about
    TRAINING_ROWS texts at most, taken by a hash of doc_id.
    """
    voted = vote(docs)
    patterns = voted.groupBy("votes").count().collect()
    codes = np.array([r.votes for r in patterns], np.int64)
    sizes = np.array([r["count"] for r in patterns], float)
    _, _, posterior = estimate(codes, sizes)
    good = dict(zip(codes.tolist(), posterior.tolist()))
    every = min(1_000_000, int(1_000_000 * TRAINING_ROWS / max(sizes.sum(), 1)) + 1)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, part in _slices(batch.column(0)):
                labels = [good.get(v, 0.5) for v in part.votes().tolist()]
                buckets, rows, values = part.features()
                keys, inverse = np.unique(rows * BUCKETS + buckets, return_inverse=True)
                total = np.bincount(inverse, weights=values, minlength=len(keys)).astype("<f4")
                bounds = np.searchsorted(keys // BUCKETS, np.arange(len(labels) + 1))
                column = (keys % BUCKETS).astype("<i4")
                spans = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(labels),
                        pa.array([column[b:e].tobytes() for b, e in spans], pa.binary()),
                        pa.array([total[b:e].tobytes() for b, e in spans], pa.binary()),
                    ],
                    names=["goal", "buckets", "amounts"],
                )

    some = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < every)
    rows = some.select("text").mapInArrow(examples, "goal double, buckets binary, amounts binary").collect()
    return train([(r.goal, bytes(r.buckets), bytes(r.amounts)) for r in rows]), good


def score(docs: DataFrame, model: tuple[np.ndarray, dict[int, float]], carry: tuple[str, ...] = ()) -> DataFrame:
    """Judge every whole text of ``docs`` (``doc_id``, ``text``).

    The columns named in ``carry`` are given back as they are, after the others.
    Returns doc_id, score (0 to 1, higher: better), posterior (the labellers' alone) and
    votes. Null and empty texts have no features and the score of their votes. Rows may
    repeat; other columns are not read; an empty table gives an empty result.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, good = known.value
        for batch in batches:
            for s, e, part in _slices(batch.column(1)):
                codes = part.votes()
                posterior = np.array([good.get(v, 0.5) for v in codes.tolist()])
                buckets, rows, values = part.features()
                z = np.bincount(rows, weights=values * weights[buckets], minlength=e - s) + weights[-1]
                scores = np.where(part.counts > 0, 1 / (1 + np.exp(-np.clip(z, -40, 40))), posterior)
                columns = [batch.column(0).slice(s, e - s), *(pa.array(x) for x in (scores, posterior, codes))]
                columns += [c.slice(s, e - s) for c in (batch.column(at[c]) for c in carry)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "posterior", "votes", *carry])

    others = [c for c in carry if c != "text"]
    at = {"text": 1} | {c: k + 2 for k, c in enumerate(others)}
    given = docs.select("doc_id", "text", *(F.col(c).alias(f"_{k}") for k, c in enumerate(others)))
    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, score double, posterior double, votes long" + more)
