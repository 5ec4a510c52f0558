"""The label model against simulated labellers and a row-by-row loop, the scorer against a plain logistic fit."""

import math

import numpy as np

from fathom.llm import quality
from fathom.llm.quality import BAD, GOOD, LABELLERS, NONE


def simulated(n, seed=4):
    """(labels, votes, chances): texts whose labellers vote, by themselves, with known chances, and abstain at times."""
    draw = np.random.default_rng(seed)
    good = draw.random(n) < 0.8
    chances = np.column_stack([np.linspace(0.25, 0.75, len(LABELLERS)), np.linspace(0.97, 0.995, len(LABELLERS))])
    says_good = draw.random((n, len(LABELLERS))) < np.where(good[:, None], chances[:, 1], chances[:, 0])
    votes = np.where(draw.random(says_good.shape) < 0.2, NONE, np.where(says_good, GOOD, BAD))
    return good, votes, chances


def patterns(votes):
    codes, of, sizes = np.unique(votes @ 3 ** np.arange(len(LABELLERS)), return_inverse=True, return_counts=True)
    return codes, of, sizes.astype(float)


def test_accuracies_of_simulated_labellers():
    good, votes, chances = simulated(200_000)
    codes, of, sizes = patterns(votes)
    share, found, posterior = quality.estimate(codes, sizes, held=0.0)
    assert abs(share - good.mean()) < 0.01
    assert np.abs(found - chances).max() < 0.02
    joint = ((posterior[of] >= 0.5) == good).mean()
    single = [(np.where(votes[:, k] == NONE, True, votes[:, k] == GOOD) == good).mean() for k in range(len(LABELLERS))]
    assert joint > max(single) + 0.02 and joint > 0.97
    # with the start counted in, as in production, the order of the texts stays
    _, _, held = quality.estimate(codes, sizes)
    assert ((held[of] >= 0.5) == good).mean() > 0.96


def test_estimate_equals_a_loop_over_texts():
    """Counting patterns gives what every text by itself gives."""
    _, votes, _ = simulated(300, 9)
    codes, of, sizes = patterns(votes)
    share, chance, posterior = quality.estimate(codes, sizes, rounds=5)
    start = [(0.7, 0.999)] * len(LABELLERS)
    p, at, pseudo = 0.85, list(start), 0.05 * len(votes) + 1
    for _ in range(5):
        own = []
        for row in votes.tolist():
            a, b = p, 1 - p
            for (bad, fine), v in zip(at, row):
                if v != NONE:
                    a *= fine if v == GOOD else 1 - fine
                    b *= bad if v == GOOD else 1 - bad
            own.append(a / (a + b))
        at = []
        for k in range(len(LABELLERS)):
            pair = []
            for c in (0, 1):
                weight = lambda i: own[i] if c else 1 - own[i]  # noqa: B023, E731
                yes = sum(weight(i) for i, row in enumerate(votes) if row[k] == GOOD)
                no = sum(weight(i) for i, row in enumerate(votes) if row[k] == BAD)
                pair.append((yes + pseudo * start[k][c]) / (yes + no + pseudo))
            at.append(tuple(pair))
        p = (sum(own) + 4) / (len(own) + 5)
    assert abs(share - p) < 1e-9 and np.allclose(chance, at, atol=1e-9) and np.allclose(posterior[of], own, atol=1e-9)


def test_nothing_to_learn_from():
    share, chance, posterior = quality.estimate(np.zeros(0, np.int64), np.zeros(0))
    assert 0 < share < 1 and np.isfinite(chance).all() and len(posterior) == 0
    assert not quality.train([]).any()


def test_scorer_against_a_plain_logistic_fit():
    """Few features, so that the optimum can be found by Newton's steps; soft labels, classes balanced."""
    draw = np.random.default_rng(2)
    n, width = 2000, 12
    x = np.where(draw.random((n, width)) < 0.5, draw.random((n, width)), 0.0)
    truth = draw.normal(0, 4, width)
    goal = 1 / (1 + np.exp(-(x @ truth - 1)))
    examples = []
    for row, g in zip(x, goal):
        held = np.flatnonzero(row)
        examples.append((float(g), held.astype("<i4").tobytes(), row[held].astype("<f4").tobytes()))
    weights = quality.train(examples)
    assert not weights[width:-1].any()

    dense = np.column_stack([x, np.ones(n)])
    balance = np.where(goal > 0.5, 0.5 / goal.mean(), 0.5 / (1 - goal.mean()))
    plain = np.zeros(width + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-dense @ plain))
        slope = dense.T @ ((p - goal) * balance / n) + 1e-6 * plain
        bend = (dense * (p * (1 - p) * balance / n)[:, None]).T @ dense + 1e-6 * np.eye(width + 1)
        plain -= np.linalg.solve(bend, slope)
    loss = lambda w: float(np.mean(balance * (np.logaddexp(0, dense @ w) - goal * (dense @ w))))
    own = np.append(weights[:width], weights[-1])
    assert loss(plain) <= loss(own) <= loss(plain) + 0.002
    agree = ((dense @ own >= 0) == (dense @ plain >= 0)).mean()
    assert agree > 0.985


def test_scores_by_plain_sums(spark):
    """A text's score is the logistic of the sum over its features, taken one by one; a text without words has its votes' chance."""
    texts = ["Some plain words stand here, and more.", "BUY BUY BUY NOW !! !! | | |", "", "One. Two."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(9, None)], "doc_id long, text string")
    draw = np.random.default_rng(1)
    weights = draw.normal(0, 1, quality.BUCKETS + 1)
    got = {r.doc_id: r for r in quality.score(docs, (weights, {})).collect()}
    for i, text in enumerate(texts):
        data = np.frombuffer(text.encode(), np.uint8)
        part = quality.Slice(data, np.array([0, len(data)]))
        total = float(weights[-1])
        for bucket, _, amount in zip(*(v.tolist() for v in part.features())):
            total += weights[bucket] * amount
        want = 1 / (1 + math.exp(-total)) if text else 0.5
        assert abs(got[i].score - want) < 1e-9
    assert got[9].score == 0.5 == got[2].score
