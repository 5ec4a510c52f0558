"""River networks: links, head-to-outlet paths with continuous chainage, junctions, ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.materialise import cut
from fathom.operators.joins import cells_along, foot


def links(segments: DataFrame, snap: float = 2.0, cell: float = 250.0) -> DataFrame:
    """River -> the one river its last point lies on and goes past: (river, down, s_join).

    ``segments`` has line, x0, y0, x1, y1, s0, length. Several such rivers: no link. An end
    meets the segments of its grid cell and those around it; ``snap`` is at most a cell.
    """
    last = segments.groupBy("line").agg(
        F.max_by(F.struct("x1", "y1"), "s0").alias("e"), F.max(F.col("s0") + F.col("length")).alias("size")
    )
    ends = last.select(F.col("line").alias("river"), F.col("e.x1").alias("ex"), F.col("e.y1").alias("ey"))
    d, s = foot(F.col("ex"), F.col("ey"))
    around = lambda c: F.sequence(F.floor(F.col(c) / cell) - 1, F.floor(F.col(c) / cell) + 1)
    ends = ends.withColumn("cx", F.explode(around("ex"))).withColumn("cy", F.explode(around("ey")))
    met = ends.join(cells_along(segments, cell), ["cx", "cy"]).filter("river <> line").join(last.select("line", "size"), "line")
    near = met.groupBy("river", "line", "size").agg(F.min(F.struct(d.alias("d"), s.alias("s"))).alias("b"))
    near = near.filter((F.col("b.d") <= snap) & (F.col("b.s") < F.col("size") - snap))
    one = near.groupBy("river").agg(F.count("*").alias("n"), F.first("line").alias("down"), F.first("b.s").alias("s_join"))
    return one.filter("n = 1").select("river", "down", "s_join")


def paths(rivers: DataFrame, river_links: DataFrame, snap: float = 2.0) -> DataFrame:
    """Parts of all head-to-outlet paths: (head, k, river, s0, s1, p0), of whatever depth.

    ``rivers`` has river and length. Heads are rivers that no other flows into at their
    start. Along a path chainage p goes on: p0 at the part's s0. A path that comes back to
    one of its rivers ends before it. Every round doubles the parts that are known of each
    path: those up to step n give, with the river n steps down from each, the next n.
    """
    down = river_links.select("river", "down", F.col("s_join").cast("double").alias("s_join"))
    into = down.filter(F.col("s_join") <= snap).select(F.col("down").alias("river")).distinct()
    heads = rivers.select("river").distinct().join(into, "river", "left_anti")
    known = rivers.select("river").distinct()
    jump = cut(down.join(known.withColumnRenamed("river", "down"), "down", "left_semi").select("river", F.col("down").alias("to")))
    walk = cut(heads.select(F.col("river").alias("head"), F.lit(0).cast("long").alias("k"), "river"))
    step, n = 1, walk.count()
    while True:
        ahead = walk.join(jump, "river").select("head", (F.col("k") + step).alias("k"), F.col("to").alias("river"))
        both = walk.unionByName(ahead).groupBy("head", "river").agg(F.min("k").alias("k"))
        walk = cut(both.select("head", "k", "river"))
        if (more := walk.count()) == n:
            break
        n, step = more, step * 2
        far = jump.select(F.col("river").alias("to"), F.col("to").alias("beyond"))
        jump = cut(jump.join(far, "to").select("river", F.col("beyond").alias("to")))
    along = Window.partitionBy("head").orderBy("k")
    leaves = down.select("river", F.col("s_join").alias("__out"))
    rows = walk.join(rivers.select("river", F.col("length").cast("double").alias("s1")), "river").join(leaves, "river", "left")
    rows = rows.withColumn("s0", F.when(F.col("k") == 0, F.lit(0.0)).otherwise(F.lag("__out").over(along)))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    p0 = F.coalesce(F.sum(F.col("s1") - F.col("s0")).over(before), F.lit(0.0))
    return rows.withColumn("p0", p0).select("head", F.col("k").cast("int").alias("k"), "river", "s0", "s1", "p0")


def junctions(river_links: DataFrame, parts: DataFrame) -> DataFrame:
    """Where rivers flow in: (river, s, ups, to_outlet), those farthest from the outlet first."""
    size = parts.groupBy("head").agg(F.max(F.col("p0") + F.col("s1") - F.col("s0")).alias("whole"))
    at = parts.join(size, "head")
    met = river_links.groupBy(F.col("down").alias("river"), F.round("s_join", 3).alias("s")).agg(
        F.array_sort(F.collect_list(river_links["river"])).alias("ups")
    )
    rest = met.join(at.withColumnRenamed("river", "on"), (F.col("on") == F.col("river")) & (F.col("s") >= F.col("s0") - 2))
    left = F.col("whole") - F.col("p0") - (F.col("s") - F.col("s0"))
    return rest.groupBy("river", "s", "ups").agg(F.min(left).alias("to_outlet")).orderBy(F.desc("to_outlet"))


def positions(points: DataFrame, parts: DataFrame, river: str, s: str, tolerance: float = 2.0) -> DataFrame:
    """Every path position of points on rivers: adds head and p, one row per path through the place."""
    p, q = points.alias("p"), parts.alias("q")
    inside = F.col(f"p.{s}").between(F.col("q.s0") - tolerance, F.col("q.s1") + tolerance)
    met = p.join(q, (F.col(f"p.{river}") == F.col("q.river")) & inside)
    return met.select("p.*", "q.head", (F.col("q.p0") + F.col(f"p.{s}") - F.col("q.s0")).alias("p"))


def ranked_paths(placed: DataFrame, path: str) -> DataFrame:
    """Paths by falling number of points, then name: (path, n, rank from 0)."""
    counts = placed.groupBy(path).agg(F.count("*").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), path)) - 1)
