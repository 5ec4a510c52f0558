"""Axes of rivers out of the parts that a centreline file holds.

Parts are joined where exactly two ends meet, whatever their directions: every part is two
darts, one each way, a dart is followed by the one that leaves the place where it ends, and
doubling the pointers ranks all darts in as many rounds as the logarithm of the longest
line's number of parts. No line passes through one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.materialise import cut, dropped
from fathom.operators import joins, reference

#: Metres within which a part's ends lie on the main line, and points of the surface on their axis.
BRANCH_SNAP, SURFACE_REACH = 15.0, 50.0
#: Roles of a part, and the attribute that says which way a part was drawn.
MAIN, ANABRANCH = "main", "anabranch"
WITH_FLOW, AGAINST_FLOW = "US2DS", "DS2US"
#: Parts of a river up to which one task merges it, and parts of rivers that a task ranks at once.
ONE_TASK_PARTS, PARTS_AT_ONCE = 10_000, 50_000


def _ranked(darts: DataFrame, most: int) -> DataFrame:
    """(river, d, next, last, hops, least) of lists ``darts`` (river, d, next) of at most ``most`` darts.

    A row knows the darts from its own to ``last``, their least and the ``next`` one; each
    round it takes over what that one knows. At the end of a list there is no next; a ring's rows keep one.
    """
    state = darts.select("river", "d", "next", F.col("d").alias("last"), F.lit(0).cast("long").alias("hops"), F.col("d").alias("least"))
    state = cut(state)
    for _ in range(max(1, math.ceil(math.log2(max(most, 2)))) + 1):
        ahead = state.select("river", F.col("d").alias("next"), *(F.col(c).alias(f"__{c}") for c in ("next", "last", "hops", "least")))
        met = state.join(ahead, ["river", "next"], "left")
        moved = F.col("__last").isNotNull()
        before, state = state, cut(
            met.select(
                "river", "d", F.when(moved, F.col("__next")).alias("next"),
                F.when(moved, F.col("__last")).otherwise(F.col("last")).alias("last"),
                (F.col("hops") + F.when(moved, F.col("__hops") + 1).otherwise(0)).alias("hops"),
                F.least("least", F.coalesce("__least", "least")).alias("least"),
            )
        )
        dropped(before)
    return state


def _within_tasks(at_once: int):
    """What merges whole rivers in a worker, about ``at_once`` parts at a time; its functions are sent by value."""

    def codes(columns: list[np.ndarray]) -> np.ndarray:
        """A number for every row, equal for equal rows."""
        code = np.zeros(len(columns[0]), np.int64)
        for c in columns:
            one = np.unique(c, return_inverse=True)[1].ravel()
            code = np.unique(code * (one.max(initial=0) + 1) + one, return_inverse=True)[1].ravel()
        return code

    def fields(places: pa.StructArray) -> list[np.ndarray]:
        """The fields of places as columns of numbers that are equal for equal values, nulls included."""
        out = []
        for field in places.flatten():
            if pa.types.is_floating(field.type) and not field.null_count:
                out.append(field.to_numpy(zero_copy_only=False) + 0.0)
            else:
                out.append(field.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64))
        return out

    def ranks(follow: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(next, last, hops, least) of darts followed by others (-1: none), as ``_ranked`` gives them."""
        following, last, hops, least = follow.copy(), np.arange(len(follow)), np.zeros(len(follow), np.int64), np.arange(len(follow))
        for _ in range(max(1, math.ceil(math.log2(max(most, 2)))) + 1):
            d = np.flatnonzero(following >= 0)
            if not len(d):
                break
            to = following[d]
            following[d], last[d], hops[d], least[d] = following[to], last[to], hops[d] + hops[to] + 1, np.minimum(least[d], least[to])
        return following, last, hops, least

    def merge(river: np.ndarray, first: list[np.ndarray], last: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(row, line, place, backward, closed) of parts sorted by river and part; ``line`` is the row of the line's least part.

        Dart 2k + w is part k the way w, so darts are in the order of their parts and ways.
        """
        n = len(river)
        ends = codes([np.concatenate([river, river]), *(np.concatenate(pair) for pair in zip(first, last))])
        a = np.stack([ends[:n], ends[n:]], axis=1).ravel()
        b = np.stack([ends[n:], ends[:n]], axis=1).ravel()
        darts, back = np.arange(2 * n), np.arange(2 * n) ^ 1
        order = np.argsort(a, kind="stable")
        begin = np.searchsorted(a[order], np.arange(ends.max() + 2))
        two = np.diff(begin)[b] == 2
        one, other = order[np.minimum(begin[b], 2 * n - 1)], order[np.minimum(begin[b] + 1, 2 * n - 1)]
        follow = np.where(two, np.where(one == back, other, one), -1)
        closed = a == b
        follow[closed | (follow == darts)] = -1
        most = int(np.bincount(river).max())
        following, end, hops, least = ranks(follow, most)
        ring = following >= 0
        if ring.any():  # a ring is opened before its least part, in both directions
            begins = 2 * (least // 2)
            opens = ring & ((follow == begins) | (darts == begins + 1))
            _, again, hops_again, _ = ranks(np.where(opens | ~ring, -1, follow), most)
            end, hops = np.where(ring, again, end), np.where(ring, hops_again, hops)
        _, of, size = np.unique(end, return_inverse=True, return_counts=True)
        lead = np.full(len(size), 2 * n)
        np.minimum.at(lead, of, darts)
        forward = np.bincount(of, weights=darts % 2 == 0)
        flat = np.zeros(len(size), bool)
        np.logical_or.at(flat, of, closed)
        # of a line's two lists, the one that most parts run along
        ranked = np.lexsort((lead % 2, -forward, lead // 2))
        kept = np.zeros(len(size), bool)
        kept[ranked[np.append(True, np.diff(lead[ranked] // 2) != 0)]] = True
        d = np.flatnonzero(kept[of])
        of = of[d]
        return d // 2, lead[of] // 2, size[of] - 1 - hops[d], d % 2 == 1, flat[of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Parts (river, part, first, last, length) sorted by river and part to the rows of ``merged_parts``, some whole rivers at a time."""
        held: list[pa.RecordBatch] = []

        def merged(parts: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
            river, part, first, last, length = (c.combine_chunks() for c in parts.columns)
            starts = np.zeros(len(river), np.int64)
            starts[begins[1:]] = 1
            row, line, place, backward, closed = merge(np.cumsum(starts), fields(first), fields(last))
            at = pa.array(row)
            out = [river.take(at), part.take(at), part.take(pa.array(line)), pa.array(place), pa.array(backward), pa.array(closed), length.take(at)]
            return pa.RecordBatch.from_arrays(out, names=["river", "part", "line", "place", "backward", "closed", "length"])

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            parts = pa.Table.from_batches(held)
            held.clear()
            river = parts.column(0).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
            begins = np.append(0, np.flatnonzero(np.diff(river)) + 1)
            end = parts.num_rows if last else int(begins[-1])  # the last river may go on
            if end:
                yield merged(parts.slice(0, end), begins[begins < end])
            if end < parts.num_rows:
                held.extend(parts.slice(end).combine_chunks().to_batches())

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                if sum(b.num_rows for b in held) >= at_once:
                    yield from whole(False)
        if held:
            yield from whole(True)

    return run


def merged_parts(parts: DataFrame) -> DataFrame:
    """Which line each part belongs to: river, part, line, place (from 0), backward (runs against the line), closed, length.

    ``parts`` has river, part (unique within the river), the places (structs) ``first``
    and ``last`` and its length. A line ends where one or more than two ends meet. It runs as most of its
    parts do; in ties as its least part does. ``line`` is the least part; a ring begins
    with it.
    """
    parts = parts.filter("river is not null")
    sizes = parts.groupBy("river").agg(F.count("*").alias("n"))
    large = cut(sizes.filter(F.col("n") > ONE_TASK_PARTS).select("river"))
    whole = parts if large.isEmpty() else parts.join(F.broadcast(large), "river", "left_anti")
    dealt = whole.select("river", "part", "first", "last", "length").repartition("river").sortWithinPartitions("river", "part")
    types = dict(parts.dtypes)
    schema = f"river {types['river']}, part {types['part']}, line {types['part']}, place long, backward boolean, closed boolean, length {types['length']}"
    out = dealt.mapInArrow(_within_tasks(PARTS_AT_ONCE), schema)
    if large.isEmpty():
        return out
    some = parts.join(F.broadcast(large), "river", "left_semi")
    return out.unionByName(_merged_large(some).join(some.select("river", "part", "length"), ["river", "part"]))


def _merged_large(parts: DataFrame) -> DataFrame:
    """``merged_parts`` without the length, of rivers of any size, by rounds over all darts."""
    way = F.explode(F.array(F.struct(F.lit(0).alias("w"), F.col("first").alias("a"), F.col("last").alias("b")), F.struct(F.lit(1).alias("w"), F.col("last").alias("a"), F.col("first").alias("b"))))
    darts = parts.select("river", "part", way.alias("e")).select("river", F.struct("part", F.col("e.w").alias("way")).alias("d"), F.col("e.a").alias("a"), F.col("e.b").alias("b"))
    darts = cut(darts)
    two = darts.groupBy("river", F.col("a").alias("b")).agg(F.count("*").alias("n"), F.min("d").alias("one"), F.max("d").alias("two")).filter("n = 2")
    back = F.struct(F.col("d.part").alias("part"), (1 - F.col("d.way")).alias("way"))
    follow = F.when(F.col("one") == back, F.col("two")).otherwise(F.col("one"))
    next_of = darts.join(two.drop("n"), ["river", "b"], "left").select("river", "d", F.when(F.col("one").isNotNull(), follow).alias("next"), (F.col("a") == F.col("b")).alias("closed"))
    alone = F.col("closed") | (F.col("next") == F.col("d"))
    next_of = cut(next_of.withColumn("next", F.when(~alone, F.col("next"))))
    most = parts.groupBy("river").count().agg(F.max("count")).first()[0] or 1
    ranked = _ranked(next_of, most)
    rings = cut(ranked.filter("next is not null").select("river", "d", "least"))
    if not rings.isEmpty():  # a ring is opened before its least part, in both directions
        least = rings.withColumn("opened", F.least(F.col("least"), F.struct(F.col("least.part").alias("part"), F.lit(0).alias("way"))))
        opened = next_of.join(least.select("river", "d", F.col("least.part").alias("begin")), ["river", "d"])
        ends = (F.col("next.part") == F.col("begin")) & (F.col("next.way") == 0) | (F.col("d.part") == F.col("begin")) & (F.col("d.way") == 1)
        again = _ranked(opened.withColumn("next", F.when(~ends, F.col("next"))), most)
        ranked = ranked.filter("next is null").unionByName(again)
    closed = F.max("closed")
    rows = ranked.drop("next", "least").join(next_of.select("river", "d", "closed"), ["river", "d"])
    lists = rows.groupBy("river", "last").agg(
        F.count("*").alias("n"), F.count_if(F.col("d.way") == 0).alias("forward"), F.min("d.part").alias("line"), F.min("d").alias("lead"), closed.alias("closed")
    )
    # of a line's two lists, the one that most parts run along
    order = Window.partitionBy("river", "line").orderBy(F.desc("forward"), F.col("lead.way"))
    lists = lists.withColumn("k", F.row_number().over(order)).filter("k = 1")
    out = rows.drop("closed").join(lists.select("river", "last", "line", "n", "closed"), ["river", "last"])
    return out.select("river", F.col("d.part").alias("part"), "line", (F.col("n") - 1 - F.col("hops")).alias("place"), (F.col("d.way") == 1).alias("backward"), "closed")


def merged_lines(vertices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines, vertices) of parts given as vertices (river, part, seq, x, y), joined by ``merged_parts``.

    Lines: river, line, n_parts, length, rank (1: the river's longest, ties by the least
    part). Vertices: river, line, seq (from 0), x, y, without the places where parts meet
    twice. Parts without a length of their own, and vertices without finite places, are
    left out.
    """
    far = float("inf")
    vertices = vertices.select("river", "part", "seq", "x", "y").filter((F.abs("x") < far) & (F.abs("y") < far))
    segments = joins.segments_of(vertices, ["river", "part"], "seq")
    place = F.struct("x", "y")
    size = segments.groupBy("river", "part").agg(F.sum("length").alias("length")).filter("length > 0")
    ends = vertices.groupBy("river", "part").agg(F.min_by(place, "seq").alias("first"), F.max_by(place, "seq").alias("last"))
    parts = cut(ends.join(size, ["river", "part"]))
    found = cut(merged_parts(parts))
    dropped(parts)
    lines = found.groupBy("river", "line").agg(F.count("*").alias("n_parts"), F.sum("length").alias("length"))
    lines = lines.withColumn("rank", F.row_number().over(Window.partitionBy("river").orderBy(F.desc("length"), "line")))
    rows = vertices.join(found.drop("length"), ["river", "part"])
    seq = F.when(F.col("backward"), -F.col("seq")).otherwise(F.col("seq"))
    rows = rows.withColumn("__seq", seq)
    begin = Window.partitionBy("river", "part").orderBy("__seq")
    rows = rows.withColumn("__at", F.row_number().over(begin)).filter("__at > 1 or place = 0")
    along = Window.partitionBy("river", "line").orderBy("place", "__seq")
    return cut(lines), rows.select("river", "line", (F.row_number().over(along) - 1).alias("seq"), "x", "y")


def downstream(main: DataFrame, surface: DataFrame | None, flow: DataFrame | None, reverse: bool = False) -> DataFrame:
    """Whether each river's main line (river, seq, x, y) must be turned so that it runs downstream: river, turned, why.

    By the ``flow`` attribute (river, flow) first; then by the slope of the ``surface``
    points (river, x, y, h; equal ones once) within SURFACE_REACH of the line, if three or
    more of them cover more than a metre; then by ``reverse``; else as drawn.
    """
    rivers = main.select("river").distinct()
    known = rivers.withColumns({"flow": F.lit(None).cast("string"), "slope": F.lit(None).cast("double")})
    if flow is not None:
        known = rivers.join(flow.filter(F.col("flow").isin(WITH_FLOW, AGAINST_FLOW)).groupBy("river").agg(F.min("flow").alias("flow")), "river", "left").withColumn("slope", F.lit(None).cast("double"))
    if surface is not None:
        points = surface.filter("h is not null and not isnan(h)").select("river", "x", "y", "h").distinct()
        points = points.withColumn("__id", F.struct("river", "x", "y", "h"))
        segments = joins.segments_of(main, ["river"], "seq")
        near = reference.on_declared(points, ["__id"], segments, "river", SURFACE_REACH).filter(F.col("distance") <= SURFACE_REACH)
        fit = near.withColumn("h", F.col("__id.h"))
        fit = fit.groupBy("river").agg(F.count("*").alias("n"), (F.max("chainage") - F.min("chainage")).alias("span"), F.regr_slope("h", "chainage").alias("fit"))
        known = known.drop("slope").join(fit.filter("n >= 3 and span > 1").select("river", F.col("fit").alias("slope")), "river", "left")
    by_flow, by_slope = F.col("flow").isNotNull(), F.col("slope").isNotNull()
    turned = F.when(by_flow, F.col("flow") == AGAINST_FLOW).when(by_slope, F.col("slope") > 0).otherwise(F.lit(reverse))
    why = F.when(by_flow, "flow_dir").when(by_slope, "surface").when(F.lit(reverse), "reverse").otherwise("drawn")
    return known.select("river", turned.alias("turned"), why.alias("why"))


def build_axes(vertices: DataFrame, surface: DataFrame | None = None, reverse: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(axes, branches, notes) of features given as vertices: river, part, seq, x, y and, if known, role and flow.

    An axis is the longest line that a river's main features merge to, running downstream:
    river, seq, x, y. Branches are the features with the role of one and, in rivers
    without roles, the other lines whose both ends lie within BRANCH_SNAP of the axis:
    river, line, seq, x, y. Notes tell what is left out, with its length and gaps, and
    how each axis was oriented: river, kind, line, length, gap0, gap1.
    """
    named = {c: F.col(c) if c in vertices.columns else F.lit(None).cast("string") for c in ("role", "flow")}
    rows = vertices.select("river", "part", "seq", "x", "y", F.lower(F.trim(named["role"])).alias("role"), F.upper(F.trim(named["flow"])).alias("flow"))
    roles = rows.groupBy("river").agg(F.bool_or(F.coalesce(F.col("role") != "", F.lit(False))).alias("has_role"))
    rows = cut(rows.join(roles, "river"))
    side = F.col("has_role") & (F.col("role") == ANABRANCH)
    lines, places = merged_lines(rows.filter(~F.coalesce(side, F.lit(False))))
    places = cut(places)
    main = places.join(lines.filter("rank = 1").select("river", "line"), ["river", "line"], "left_semi").drop("line")
    turned = cut(downstream(main, surface, rows.filter("flow <> ''").select("river", "flow"), reverse))
    last = Window.partitionBy("river")
    axes = main.join(turned, "river").withColumn("seq", F.when(F.col("turned"), F.max("seq").over(last) - F.col("seq")).otherwise(F.col("seq")))
    axes = cut(axes.select("river", "seq", "x", "y"))
    others = places.join(lines.filter("rank > 1").select("river", "line"), ["river", "line"], "left_semi")
    place = F.struct("x", "y")
    ends = others.groupBy("river", "line").agg(F.min_by(place, "seq").alias("first"), F.max_by(place, "seq").alias("last"))
    ends = ends.select("river", "line", F.posexplode(F.array("first", "last")).alias("end", "at")).select("river", "line", "end", F.col("at.x").alias("x"), F.col("at.y").alias("y"))
    ends = ends.withColumn("id", F.struct("river", "line", "end"))
    met = reference.on_declared(ends, ["id"], joins.segments_of(axes, ["river"], "seq"), "river").select("river", "id.line", "id.end", "distance")
    gap = lambda k: F.max(F.when(F.col("end") == k, F.col("distance"))).alias(f"gap{k}")
    gaps = cut(met.groupBy("river", "line").agg(gap(0), gap(1)).join(roles, "river"))
    joined = ~F.col("has_role") & (F.col("gap0") <= BRANCH_SNAP) & (F.col("gap1") <= BRANCH_SNAP)
    branches = others.join(gaps.filter(joined).select("river", "line"), ["river", "line"], "left_semi")
    drawn = rows.filter(F.coalesce(side, F.lit(False))).select("river", F.col("part").alias("line"), "seq", "x", "y")
    left = gaps.filter(~joined).join(lines.select("river", "line", "length"), ["river", "line"])
    kind: Column = F.when(F.col("has_role"), "not merged").otherwise("not connected")
    none = F.lit(None)
    oriented = turned.select("river", F.concat(F.lit("oriented: "), "why", F.when(F.col("turned"), ", turned").otherwise("")).alias("kind"))
    oriented = oriented.withColumns({"line": none.cast(dict(lines.dtypes)["line"]), **{c: none.cast("double") for c in ("length", "gap0", "gap1")}})
    notes = left.select("river", kind.alias("kind"), "line", "length", "gap0", "gap1").unionByName(oriented)
    return axes, branches.unionByName(drawn), notes
