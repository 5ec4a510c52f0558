"""Near-duplicate vectors by spherical-cap filters.

The filters are the directions of a product code: the space, turned at random, is
split into two halves, each half has a code of random directions, and a filter is a
pair of them. A vector belongs to every filter whose inner product with it reaches a
threshold; since that product is a sum over the halves, the filters are listed from
each half's best directions without looking at all pairs; a vector that reaches few has
its best ones all the same. Vectors that share a filter are compared. The code grows with
the corpus, so a filter holds about the same number of vectors at any size. How many
filters a vector needs follows from pairs drawn at just the least cosine: as many as let
all but a few of them share one; the threshold then follows from the code's own
products. Where no number of filters does, as for narrow vectors, the code is as large
as one does for. A pair is counted only in the first filter that it shares.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import connected_components, cut
from fathom.llm.vectors import float_kind, matrix, packed

#: Vectors that a filter holds on average.
VECTORS_PER_FILTER = 64
#: Filters that a vector may have on average, the fewest that will do are taken, and those that it has in any case.
FILTERS_PER_VECTOR, FILTERS_AT_LEAST = (32, 48, 64, 96, 128, 192, 256), 32
#: Drawn pairs at the least cosine that may share no filter, of PROBES.
MISSED, PROBES = 0.003, 1000
#: Rows of a filter that one task compares at once; a larger one is dealt into cells.
CELL_ROWS = 1024
#: Pairs of directions, products of a half, shared filters and bytes of listed rows that a worker holds at once.
PAIRS_AT_ONCE, PRODUCTS_AT_ONCE, NAMES_AT_ONCE, BYTES_AT_ONCE = 500_000, 1_000_000, 2048, 4_000_000
#: Crowded filters up to which they are broadcast (16 bytes each).
BROADCAST_FILTERS = 1_000_000


class ProductCode:
    """Random directions in the two halves of a turned space of ``width`` components."""

    def __init__(self, width: int, directions: int, threshold: float = 0.0, seed: int = 7):
        rng = np.random.default_rng([seed, width])
        turn, _ = np.linalg.qr(rng.standard_normal((width, width)))
        self.half = max(1, width // 2)
        sides = []
        for n in (self.half, width - self.half):
            code = rng.standard_normal((directions, n)) if n else np.zeros((directions, 1))
            sides.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12))
        self.turn, self.sides, self.directions, self.threshold = turn, sides, directions, threshold

    def products(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every unit vector's inner products with the directions of either half."""
        turned = units @ self.turn
        one = turned[:, : self.half] @ self.sides[0].T
        rest = turned[:, self.half :]
        return one, rest @ self.sides[1].T if rest.shape[1] else np.zeros_like(one)

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) for every filter that a row's unit vector reaches, its best ones at least, by row and filter."""
        one, two = self.products(units)
        # a direction that reaches nothing with the best of the other half is in no filter; the others are paired row by row
        first, left = np.nonzero(one + two.max(axis=1, keepdims=True) >= self.threshold)
        second, right = np.nonzero(two + one.max(axis=1, keepdims=True) >= self.threshold)
        begin = np.searchsorted(second, np.arange(len(units) + 1))
        width = np.diff(begin)[first]
        upto = np.append(0, np.cumsum(width))
        found = []
        s = 0
        while s < len(first):
            e = max(s + 1, int(np.searchsorted(upto, upto[s] + PAIRS_AT_ONCE, "right")) - 1)
            n = width[s:e]
            k = np.repeat(np.arange(s, e), n)
            r = first[k]
            at = begin[r] + np.arange(len(k)) - np.repeat(upto[s:e] - upto[s], n)
            hit = one[r, left[k]] + two[r, right[at]] >= self.threshold
            found.append((r[hit], left[k[hit]] * self.directions + right[at[hit]]))
            s = e
        rows, filters = (np.concatenate([np.zeros(0, np.int64), *c]) for c in (zip(*found) if found else ((), ())))
        few = np.bincount(rows, minlength=len(units)) < FILTERS_AT_LEAST
        if few.any():
            best = self._best(one[few], two[few], np.flatnonzero(few))
            kept = ~few[rows]
            rows, filters = np.append(rows[kept], best[0]), np.append(filters[kept], best[1])
        order = np.lexsort((filters, rows))
        return rows[order], filters[order]

    def _best(self, one: np.ndarray, two: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of the FILTERS_AT_LEAST filters that each row is nearest to, and of what ties with the last of them."""
        most = min(self.directions, FILTERS_AT_LEAST)
        # the pair of the p-th and the q-th best has p times q pairs that are as good
        i, j = np.nonzero(np.outer(np.arange(1, most + 1), np.arange(1, most + 1)) <= FILTERS_AT_LEAST)
        least = min(FILTERS_AT_LEAST, len(i))
        found = []
        for s in range(0, len(one), 500):
            ranked = []
            for side in (one[s : s + 500], two[s : s + 500]):
                top = np.argpartition(-side, most - 1, axis=1)[:, :most]
                value = np.take_along_axis(side, top, 1)
                order = np.lexsort((top, -value))
                ranked.append((np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)))
            (left, a), (right, b) = ranked
            sums = a[:, i] + b[:, j]
            r, c = np.nonzero(sums >= -np.partition(-sums, least - 1, axis=1)[:, least - 1, None])
            found.append((names[s + r], left[r, i[c]] * self.directions + right[r, j[c]]))
        return tuple(np.concatenate(c) for c in zip(*found))


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pairs_at(cosine: float, width: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` pairs of random unit vectors with just this cosine."""
    rng = np.random.default_rng(seed)
    x, z = _units(rng.standard_normal((n, width))), rng.standard_normal((n, width))
    z = z - (z * x).sum(axis=1, keepdims=True) * x
    return x, cosine * x + math.sqrt(1 - cosine**2) * _units(z) if width > 1 else x


def shared(code: ProductCode, x: np.ndarray, y: np.ndarray) -> float:
    """The share of the pairs (x, y) that have a filter in common."""
    hits, n = 0, code.directions**2
    for s in range(0, len(x), 500):
        one, two = (r * n + f for r, f in (code.decode(v[s : s + 500]) for v in (x, y)))
        hits += len(np.unique(np.intersect1d(one, two, assume_unique=True) // n))
    return hits / len(x)


def _threshold(code: ProductCode, units: np.ndarray, per_vector: float) -> float:
    """What a product must reach for ``units`` to have ``per_vector`` filters on average."""
    one, two = code.products(units)
    two = np.sort(two, axis=1)
    low, high = float(one.min() + two.min()), float(one.max() + two.max())
    for _ in range(40):
        middle = (low + high) / 2
        n = sum(code.directions - np.searchsorted(b, middle - a) for a, b in zip(one, two)).sum() / len(units)
        low, high = (middle, high) if n > per_vector else (low, middle)
    return low


@lru_cache(maxsize=64)
def code_for(width: int, directions: int, least: float) -> tuple[int, float]:
    """(directions, threshold) of the largest code, of ``directions`` at most, that finds all but MISSED of the pairs at cosine ``least``.

    It gets the fewest filters a vector with which those pairs share one. Narrow vectors stand
    so close together that the small caps of a large code part too many pairs, however many
    a vector has: codes are tried from one direction, whose only filter all share, upwards.
    """
    best = 1, -math.inf
    if width == 1:
        return best
    units, _ = pairs_at(least, width, 200, 1)
    x, y = pairs_at(least, width, PROBES, 2)
    for n in sorted({directions >> k for k in range(directions.bit_length())} - {0, 1}):
        code = ProductCode(width, n)
        for per_vector in FILTERS_PER_VECTOR:
            if per_vector > n**2 / 2 and per_vector > FILTERS_PER_VECTOR[0]:
                return best
            code.threshold = _threshold(code, units, min(per_vector, n**2 / 2))
            if shared(code, x, y) >= 1 - MISSED:
                best = n, code.threshold
                break
        else:
            return best
    return best


@dataclass
class Filters:
    """The product codes of a corpus, one for each length of vectors, by its directions and threshold."""

    known: dict[int, tuple[int, float]]

    def __post_init__(self):
        self.codes: dict[int, ProductCode] = {}

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = x.shape[1]
        directions, threshold = self.known[width]
        if width not in self.codes:
            self.codes[width] = ProductCode(width, directions, threshold)
        rows, filters = [], []
        step = max(1, PRODUCTS_AT_ONCE // max(1000, directions))
        for s in range(0, len(x), step):
            r, f = self.codes[width].decode(_units(x[s : s + step]))
            rows.append(r + s)
            filters.append(f)
        return np.concatenate(rows), np.concatenate(filters)


def compare(
    x: np.ndarray, copies: np.ndarray, first: np.ndarray, this: int, filters: Filters, least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Links of the rows of one cell of filter ``this``: how many copies each row links to, and its group's first row.

    ``first`` marks the rows of the cell's first part; pairs are of a row of the first
    part and one of the second, or of any two if all are of the first. Pairs that share
    an earlier filter are counted there.
    """
    norm = np.linalg.norm(x, axis=1)
    close = x @ x.T
    close /= norm[:, None]
    close /= norm[None, :]
    close = close >= least
    np.fill_diagonal(close, False)
    if not first.all():
        close &= first[:, None] != first[None, :]
    count = np.zeros(len(x), np.int64)
    root = np.arange(len(x))
    near = np.flatnonzero(close.any(axis=1))
    if not len(near):
        return count, root
    rows, held = filters.of(x[near])
    early = held < this
    rows, held = rows[early], held[early]
    _, column, holders = np.unique(held, return_inverse=True, return_counts=True)
    new = close[np.ix_(near, near)]
    several = holders > 1  # a filter with one row parts no pair
    number = np.cumsum(several) - 1
    of_some = several[column]
    rows, column = rows[of_some], number[column[of_some]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for s in range(0, int(several.sum()), NAMES_AT_ONCE):
        a, b = np.searchsorted(column, (s, s + NAMES_AT_ONCE))
        member = np.zeros((len(near), NAMES_AT_ONCE), np.float32)
        member[rows[a:b], column[a:b] - s] = 1
        new &= member @ member.T == 0
    count[near] = new @ copies[near]
    label = np.arange(len(near))
    while True:
        best = np.minimum(label, np.where(new, label[None, :], len(near)).min(axis=1))
        best = best[best]
        if (best == label).all():
            break
        label = best
    root[near] = near[label]
    return count, root


def near_duplicates(
    vectors: DataFrame,
    least: float = 0.9,
    per_filter: float = VECTORS_PER_FILTER,
) -> DataFrame:
    """Link the rows of ``vectors`` (``vec_id``, ``embedding``) with cosine ``least`` or more.

    Returns a row per row: vec_id, n_links (other rows linked directly), component_id
    (least vec_id reachable) and kept (vec_id = component_id). No pair below ``least``
    is linked; a pair is found if it shares a filter.

    Null embeddings, zero vectors and those that hold null or non-finite components
    link with nothing, nor do null vec_ids, which are kept; vectors of different lengths
    do not link. Equal vectors are compared once and count as often as they stand there.
    Rows that repeat a vec_id are one vertex in the components; where their vectors differ,
    n_links of each counts the links of all. Other columns are not
    read; an empty table gives an empty result.
    """
    kind = float_kind(vectors)
    rows = cut(packed(vectors, zero_too=False))
    real = rows.filter("vector is not null and vec_id is not null")
    groups = cut(real.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    copied = cut(groups.filter("copies > 1").select("vector", "node", "copies"))
    size = np.dtype(kind).itemsize
    widths = groups.groupBy((F.octet_length("vector") / size).cast("int").alias("width")).count().collect()
    fitting = lambda n: max(8, math.ceil(math.sqrt(n * FILTERS_PER_VECTOR[1] / per_filter)))
    codes = {r["width"]: code_for(r["width"], fitting(r["count"]), least) for r in widths}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(codes)
        for batch in batches:
            raw = batch.column(0).to_pylist()
            width = np.array([len(v) // size for v in raw], np.int64)
            for w in np.unique(width).tolist():
                for part in np.array_split(np.flatnonzero(width == w), max(1, len(raw) // 1000)):
                    if not len(part):
                        continue
                    every, all_filters = filters.of(matrix([raw[i] for i in part], kind))
                    some = max(1, BYTES_AT_ONCE // (w * size + 32))
                    for s in range(0, len(every), some):
                        r, f = every[s : s + some], all_filters[s : s + some]
                        taken = pa.array(part[r])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(f), pa.array(np.full(len(f), w)), *(batch.column(c).take(taken) for c in (1, 2, 0))],
                            names=["filter", "width", "node", "copies", "vector"],
                        )

    schema = "filter long, width long, node long, copies long, vector binary"
    members = groups.select("vector", "node", "copies").mapInArrow(listed, schema)
    crowded = cut(members.groupBy("filter", "width").agg(F.count("*").alias("n")).filter(F.col("n") > CELL_ROWS))
    crowded = F.broadcast(crowded) if crowded.count() <= BROADCAST_FILTERS else crowded
    cells = F.ceil(F.coalesce("n", F.lit(1)) / CELL_ROWS).cast("int")
    # a row of part p goes to the cells (p, q) and (q, p): each pair of parts meets once
    dealt = (
        members.join(crowded, ["filter", "width"], "left")
        .withColumn("cells", cells)
        .withColumn("part", F.pmod(F.xxhash64("node", "filter"), F.col("cells")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select(
            "filter",
            "width",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            (F.col("part") <= F.col("other")).alias("first"),
            "node",
            "copies",
            "vector",
        )
    )
    keys = ["filter", "width", "low", "high"]
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys, "node")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(codes)
        held: list[pa.RecordBatch] = []
        kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close_group() -> None:
            table = pa.Table.from_batches(held)
            held.clear()
            if table.num_rows < 2:
                return
            nodes, copies = (table.column(c).to_numpy() for c in ("node", "copies"))
            first = table.column("first").to_numpy() | (table.column("low")[0].as_py() == table.column("high")[0].as_py())
            x = matrix(table.column("vector").to_pylist(), kind)
            count, root = compare(x, copies, first, table.column("filter")[0].as_py(), filters, least)
            some = count > 0
            if some.any():
                kept.append((nodes[some], count[some], nodes[root][some]))

        def flush() -> pa.RecordBatch:
            out = [np.concatenate(c) if kept else np.zeros(0, np.int64) for c in (zip(*kept) if kept else ((), (), ()))]
            kept.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["node", "links", "root"])

        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            at = np.stack([np.asarray(batch.column(k)) for k in keys])
            breaks = np.flatnonzero((at[:, 1:] != at[:, :-1]).any(axis=0)) + 1
            bounds = [0, *breaks.tolist(), batch.num_rows]
            for s, e in zip(bounds[:-1], bounds[1:]):
                key = tuple(at[:, s].tolist())
                if held and key != last:
                    close_group()
                held.append(batch.slice(s, e - s))
                last = key
            if sum(len(k[0]) for k in kept) > 50_000:
                yield flush()
        if held:
            close_group()
        yield flush()

    found = cut(dealt.mapInArrow(linked, "node long, links long, root long"))
    links = cut(found.groupBy("node").agg(F.sum("links").alias("links")))
    component = cut(connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    return (
        rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("vector")).alias("vector"))
        .join(copied, "vector", "left")
        .select("vec_id", F.coalesce("node", "vec_id").alias("node"), (F.coalesce("copies", F.lit(1)) - 1).alias("own"))
        .join(links, "node", "left")
        .join(component, "node", "left")
        .select(
            "vec_id",
            (F.col("own") + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
