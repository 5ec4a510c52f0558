"""What a worker of operator 6 holds does not grow with the corpus, and its filters are those of the definition."""

import tracemalloc

import numpy as np
import pytest

from fathom.llm import caps

#: Directions and threshold of 600,000 vectors of 64 components.
LARGE = 671, 0.6426479204438613


def peak_mb(run):
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def near(n, width=64):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(width)
    return centre / np.linalg.norm(centre) + 0.035 * rng.standard_normal((n, width))


def test_filters_of_a_large_code_fit_a_worker():
    x = np.random.default_rng(2).standard_normal((1500, 64))
    (rows, _), peak = peak_mb(lambda: caps.Filters({64: LARGE}).of(x))
    assert np.bincount(rows).min() >= caps.FILTERS_AT_LEAST and peak < 100


def test_a_cell_of_near_vectors_fits_a_worker():
    x, filters = near(1500), caps.Filters({64: LARGE})
    names, n = np.unique(filters.of(x[:200])[1], return_counts=True)
    ones = np.ones(len(x), np.int64)
    (count, _), peak = peak_mb(lambda: caps.compare(x, ones, ones > 0, int(names[n.argmax()]), filters, 0.9))
    assert count.sum() > 0 and peak < 150


@pytest.mark.parametrize("width, directions, threshold", [(64, 60, 0.5), (8, 30, 1.2), (3, 50, 1.5), (2, 3, 9.0), (16, 1, 0.0)])
def test_filters_by_their_definition(width, directions, threshold, monkeypatch):
    monkeypatch.setattr(caps, "PAIRS_AT_ONCE", 50)
    code = caps.ProductCode(width, directions, threshold)
    x = caps._units(np.random.default_rng(3).standard_normal((40, width)))
    one, two = code.products(x)
    sums = (one[:, :, None] + two[:, None, :]).reshape(40, -1)
    rows, filters = code.decode(x)
    least = min(caps.FILTERS_AT_LEAST, directions**2)
    for k, s in enumerate(sums):
        got, reached = filters[rows == k], np.flatnonzero(s >= threshold)
        assert len(set(got.tolist())) == len(got)
        if len(reached) >= least:
            assert got.tolist() == reached.tolist()
        else:
            assert sorted(s[got])[::-1][:least] == sorted(s)[::-1][:least]


def test_cells_count_the_same_by_any_number_of_filters_at_once(monkeypatch):
    x, filters = near(150, 16), caps.Filters({16: (40, 1.0)})
    names = np.unique(filters.of(x)[1])[5::9]
    ones = np.ones(len(x), np.int64)
    first = np.arange(len(x)) % 2 == 0
    count = lambda: [[c.tolist() for c in caps.compare(x, ones, first, int(f), filters, 0.9)] for f in names]
    whole = count()
    monkeypatch.setattr(caps, "NAMES_AT_ONCE", 3)
    assert count() == whole
    held = [set(filters.of(x[i : i + 1])[1].tolist()) for i in range(len(x))]
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    for f, (got, _) in zip(names, whole):
        close = [(i, j) for i in range(150) for j in range(150) if first[i] != first[j] and units[i] @ units[j] >= 0.9 and not any(g < f for g in held[i] & held[j])]
        assert got == np.bincount([i for i, _ in close], minlength=150).tolist()
