"""Band, nearest, crossing and interval joins.

Segments (axes) are cut into grid cells so that points meet only the segments near
them; a broadcast is taken where the caller knows that side to be small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.materialise import cut, dropped

#: Pairs of rows that one task of a join by cells looks at, and tasks of such a join at most.
PAIRS_A_TASK, TASKS = 1_000_000, 2000


def band_join(points: DataFrame, s: str, step: float, half: float, node: str = "node") -> DataFrame:
    """A row per point and grid node ``k * step`` within ``half`` of it, both ends included; adds ``node`` (k).

    Each point lists the nodes that cover it, so the join is an explode without a shuffle.
    """
    first = F.ceil((F.col(s) - half) / step - 1e-9).cast("long")
    last = F.floor((F.col(s) + half) / step + 1e-9).cast("long")
    some = points.filter(F.col(s).isNotNull() & (last >= first))
    return some.withColumn(node, F.explode(F.sequence(first, last)))


def segments_of(vertices: DataFrame, line: Sequence[str], order: str, x: str = "x", y: str = "y") -> DataFrame:
    """Segments (x0, y0, x1, y1, s0, length) of polylines given by ordered vertices; s0 is the distance from the start."""
    from pyspark.sql import Window

    seq = Window.partitionBy(*line).orderBy(order)
    rows = vertices.select(
        *line,
        F.col(order).alias("seg_no"),
        F.col(x).alias("x0"),
        F.col(y).alias("y0"),
        F.lead(x).over(seq).alias("x1"),
        F.lead(y).over(seq).alias("y1"),
    ).filter("x1 is not null")
    rows = rows.withColumn("length", F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))
    upto = Window.partitionBy(*line).orderBy("seg_no").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("s0", F.sum("length").over(upto) - F.col("length"))


def foot(x: Column, y: Column) -> tuple[Column, Column]:
    """(distance, chainage) of the nearest place on the row's segment."""
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    u = F.coalesce(F.try_divide((x - F.col("x0")) * dx + (y - F.col("y0")) * dy, dx * dx + dy * dy), F.lit(0.0))
    u = F.greatest(F.lit(0.0), F.least(F.lit(1.0), u))
    return F.hypot(x - F.col("x0") - u * dx, y - F.col("y0") - u * dy), F.col("s0") + u * F.col("length")


def _ranked(met: DataFrame, key: Sequence[str], line: str, order: str, k: int) -> DataFrame:
    """The ``k`` nearest lines of each point among the segments that it has met."""
    from pyspark.sql import Window

    d, s = foot(F.col("x"), F.col("y"))
    per_line = met.groupBy(*key, line).agg(
        F.min(F.struct(d.alias("distance"), F.col(order).alias("order"), s.alias("chainage"))).alias("b")
    )
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("b.distance", "b.order"))
    ranked = per_line.withColumn("rank", rank).filter(F.col("rank") <= k)
    return ranked.select(*key, line, "b.distance", "b.chainage", "rank")


def nearest_segments(
    points: DataFrame,
    key: Sequence[str],
    segments: DataFrame,
    line: str,
    order: str,
    k: int = 1,
    cell: float = 250.0,
    own: bool = False,
) -> DataFrame:
    """The ``k`` nearest lines of every point (``x``, ``y``): line, distance, chainage, rank.

    ``key`` tells the points apart. Per point and line only the nearest place counts; ties
    go to the smaller ``order``. Points without finite coordinates have no row. With ``own`` a point has a column
    ``line`` too and meets that line only; points of a line that isn't there have no row.

    Points and segments meet in grid cells, a point in its own and the eight around it: one
    whose k-th line lies within a cell's width has met all that could be nearer; the others
    go on with cells four times as wide. So a round's work is that of its own points, whatever
    the number of segments, and rounds grow with the logarithm of the largest distance.
    """
    far = float("inf")
    names = [*key, line] if own else list(key)
    asked = points.select(*names, "x", "y").filter((F.abs("x") < far) & (F.abs("y") < far))
    there = segments.select(line).distinct()
    if own:
        k, asked = 1, asked.join(there, line, "left_semi")
    else:
        k = min(k, there.count())
    if not k:
        return _ranked(asked.join(segments, F.lit(False)), key, line, order, 1)
    by = ["cx", "cy", line] if own else ["cx", "cy"]
    done, asked = None, cut(asked)
    while done is None or not asked.isEmpty():
        around = lambda c: F.sequence(F.floor(F.col(c) / cell) - 1, F.floor(F.col(c) / cell) + 1)  # noqa: B023, E731
        wide = asked.withColumn("cx", F.explode(around("x"))).withColumn("cy", F.explode(around("y")))
        met = met_in_cells(wide, cells_along(segments, cell), by).drop("cx", "cy")
        found = cut(_ranked(met, key, line, order, k))
        near = found.filter((F.col("rank") == k) & (F.col("distance") <= cell)).select(*key)
        found = found.join(near, list(key), "left_semi")
        done = found if done is None else done.unionByName(found)
        asked = cut(asked.join(near, list(key), "left_anti"))
        cell *= 4
    return done


def met_in_cells(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The inner join of two tables by their cells, spread over tasks by the pairs that it makes and not by its bytes.

    Where a cell makes more than PAIRS_A_TASK pairs, its rows on the left are dealt over as
    many tasks and those on the right go to each of them.
    """
    here, there = left.groupBy(*by).agg(F.count("*").alias("__n")), right.groupBy(*by).agg(F.count("*").alias("__m"))
    parts = F.ceil(F.col("__n") * F.col("__m") / PAIRS_A_TASK)
    counts = here.join(there, list(by)).select(*by, (F.col("__n") * F.col("__m")).alias("__pairs"), parts.cast("int").alias("__parts"))
    counts = cut(counts)
    pairs = counts.agg(F.sum("__pairs")).first()[0] or 0
    if pairs <= PAIRS_A_TASK:
        dropped(counts)
        return left.join(right, list(by))
    tasks = min(TASKS, max(8, math.ceil(2 * pairs / PAIRS_A_TASK)))
    crowded = F.broadcast(counts.filter("__parts > 1").select(*by, "__parts"))
    one = left.withColumn("__hash", F.xxhash64(*left.columns)).join(crowded, list(by), "left")
    one = one.withColumn("__part", F.coalesce(F.pmod("__hash", "__parts"), F.lit(0)).cast("int")).drop("__hash", "__parts")
    two = right.join(crowded, list(by), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1)))
    keys = [*by, "__part"]
    return one.repartition(tasks, *keys).join(two.drop("__parts").repartition(tasks, *keys), keys).drop("__part")


def cells_along(segments: DataFrame, cell: float) -> DataFrame:
    """A row per segment and grid cell that it goes through: adds ``cx``, ``cy``.

    Column by column: the cells between the heights at which the segment enters and leaves
    it, so that a segment has about as many rows as cells, however long and slanted.
    """
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    slope = F.try_divide(y1 - y0, x1 - x0)
    low, high = F.least(x0, x1), F.greatest(x0, x1)
    rows = segments.withColumn("cx", F.explode(F.sequence(F.floor(low / cell), F.floor(high / cell))))
    # a hair wider than the column, so that rounding loses no cell
    hair = cell * 1e-6
    a = F.greatest(low, F.col("cx") * cell - hair)
    b = F.least(high, (F.col("cx") + 1) * cell + hair)
    ya, yb = y0 + slope * (a - x0), y0 + slope * (b - x0)
    bottom = F.greatest(F.least(y0, y1), F.coalesce(F.least(ya, yb), F.least(y0, y1)) - hair)
    top = F.least(F.greatest(y0, y1), F.coalesce(F.greatest(ya, yb), F.greatest(y0, y1)) + hair)
    return rows.withColumn("cy", F.explode(F.sequence(F.floor(F.least(bottom, top) / cell), F.floor(top / cell))))


def crossings(sections: DataFrame, key: Sequence[str], segments: DataFrame, cell: float, own: bool = False) -> DataFrame:
    """Places where sections (ax, ay, bx, by) and segments cross: px, py, chainage and the share along the section.

    Both sides are cut into cells and joined on them; a crossing found in several cells
    is kept once. Collinear overlaps give the middle of the overlap. With ``own`` a section
    has a column ``line`` too and meets that line only.
    """
    one = cells_along(
        sections.withColumnsRenamed({"ax": "x0", "ay": "y0", "bx": "x1", "by": "y1"}), cell
    ).withColumnsRenamed({"x0": "ax", "y0": "ay", "x1": "bx", "y1": "by"})
    met = met_in_cells(one, cells_along(segments, cell), ["cx", "cy", "line"] if own else ["cx", "cy"])
    rx, ry = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    qx, qy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    wx, wy = F.col("x0") - F.col("ax"), F.col("y0") - F.col("ay")
    det = rx * qy - ry * qx
    t, u = F.try_divide(wx * qy - wy * qx, det), F.try_divide(wx * ry - wy * rx, det)
    hit = (det != 0) & t.between(0, 1) & u.between(0, 1)
    # collinear: the overlap of [0, 1] and the segment's ends along the section
    size = rx * rx + ry * ry
    e0 = F.try_divide(wx * rx + wy * ry, size)
    e1 = F.try_divide((wx + qx) * rx + (wy + qy) * ry, size)
    lo, hi = F.greatest(F.lit(0.0), F.least(e0, e1)), F.least(F.lit(1.0), F.greatest(e0, e1))
    lying = (det == 0) & (F.abs(wx * ry - wy * rx) <= 1e-9 * size) & (lo <= hi)
    share = F.when(hit, t).when(lying, (lo + hi) / 2)
    rows = met.withColumn("share", share).filter("share is not null").dropDuplicates([*key, "line", "seg_no"])
    px, py = F.col("ax") + F.col("share") * rx, F.col("ay") + F.col("share") * ry
    chainage = F.col("s0") + F.hypot(px - F.col("x0"), py - F.col("y0"))
    return rows.select(*key, "line", "seg_no", px.alias("px"), py.alias("py"), chainage.alias("chainage"), "share")


def interval_join(points: DataFrame, parts: DataFrame, on: str, s: str, low: str, high: str, tolerance: float) -> DataFrame:
    """Points with every part of the same ``on`` whose range holds ``s``, ends widened by ``tolerance``."""
    p, q = points.alias("p"), parts.alias("q")
    inside = (F.col(f"p.{s}") >= F.col(f"q.{low}") - tolerance) & (F.col(f"p.{s}") <= F.col(f"q.{high}") + tolerance)
    return p.join(q, (F.col(f"p.{on}") == F.col(f"q.{on}")) & inside).select("p.*", *(f"q.{c}" for c in parts.columns if c != on))


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), list(on), "left_anti")


def compare_runs(old: DataFrame, new: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """A row per key of either run: where it stands and the difference of ``value``."""
    a = old.select(*key, F.col(value).alias("old"), F.lit(True).alias("in_old"))
    b = new.select(*key, F.col(value).alias("new"), F.lit(True).alias("in_new"))
    both = a.join(b, list(key), "full")
    where = F.when(F.col("in_old") & F.col("in_new"), "both").when(F.col("in_old"), "old only").otherwise("new only")
    return both.select(*key, where.alias("status"), "old", "new", (F.col("new") - F.col("old")).alias("difference"))


def locate_sections(sections: DataFrame, key: str, segments: DataFrame, line: str, cell: float, margin: float = 15.0, share: float = 0.15) -> DataFrame:
    """Where each section (ax, ay, bx, by) lies on the network: line, chainage, distance and method.

    The section is lengthened at both ends by ``share`` of its length, ``margin`` at
    least; of its crossings the one nearest to its middle counts. Without one the nearest
    line to the middle is taken.
    """
    size = F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))
    k = F.coalesce(F.try_divide(F.greatest(F.lit(margin), share * size), size), F.lit(0.0))
    ux, uy = k * (F.col("bx") - F.col("ax")), k * (F.col("by") - F.col("ay"))
    middle = sections.select(key, ((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y"))
    long = sections.select(key, (F.col("ax") - ux).alias("ax"), (F.col("ay") - uy).alias("ay"), (F.col("bx") + ux).alias("bx"), (F.col("by") + uy).alias("by"))
    met = crossings(long, [key], segments.withColumn("line", F.col(line)), cell).join(middle, key)
    d = F.hypot(F.col("px") - F.col("x"), F.col("py") - F.col("y"))
    best = met.groupBy(key).agg(F.min(F.struct(d.alias("distance"), "line", "chainage")).alias("c"))
    near = nearest_segments(middle, [key], segments.withColumn("order", F.lit(0)), line, "order")
    both = near.join(best, key, "left")
    crossed = F.col("c").isNotNull()
    return both.select(
        key,
        F.when(crossed, F.col("c.line")).otherwise(F.col(line)).alias("line"),
        F.when(crossed, F.col("c.chainage")).otherwise(F.col("chainage")).alias("chainage"),
        F.when(crossed, F.col("c.distance")).otherwise(F.col("distance")).alias("distance"),
        F.when(crossed, "crossing").otherwise("nearest").alias("method"),
    )
