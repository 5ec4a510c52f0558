"""Water-surface levels along paths: inside by interpolation, outside by a guarded slope.

Anchors have path, p, h and deps (an array of the kinds of measurement they rest on).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Metres of anchors that an end slope is fitted to, and how close to the ends still counts as inside.
SLOPE_WINDOW, INSIDE = 1000.0, 0.5


def end_slopes(anchors: DataFrame, min_span: float = 200.0, max_slope: float = 0.002, default: float = 0.0, group: str = "path") -> DataFrame:
    """Per path and end (0 upstream, 1 downstream): the anchor there, the slope to go on with, and its ``origin``.

    The slope is fitted to the anchors nearest the end until they span SLOPE_WINDOW, else
    to the whole path, else ``default``; a fit must span ``min_span`` and lie in
    [-max_slope, 0]. A path with one anchor goes on flat.
    """
    ends = []
    for end in (0, 1):
        edge = F.min("p") if end == 0 else F.max("p")
        from_end = F.abs(F.col("p") - edge.over(Window.partitionBy(group)))
        rows = anchors.withColumn("__d", from_end)
        enough = F.min(F.when(F.col("__d") >= SLOPE_WINDOW, F.col("__d"))).over(Window.partitionBy(group))
        rows = rows.withColumn("__near", F.col("__d") <= F.coalesce(enough, F.lit(float("inf"))))

        def fit(c: Column) -> Column:
            slope = F.regr_slope(F.when(c, F.col("h")), F.when(c, F.col("p")))
            span = F.max(F.when(c, F.col("p"))) - F.min(F.when(c, F.col("p")))
            return F.when((span >= min_span) & (F.count_if(c) >= 2) & slope.between(-max_slope, 0), slope)

        near, whole = fit(F.col("__near")), fit(F.lit(True))
        origin = (
            F.when(F.count("*") < 2, "flat").when(near.isNotNull(), "end").when(whole.isNotNull(), "whole path").otherwise("default")
        )
        slope = F.when(F.count("*") < 2, F.lit(0.0)).otherwise(F.coalesce(near, whole, F.lit(default)))
        nearest = F.min_by(F.struct("p", "h", "deps"), F.struct("__d", "h"))
        ends.append(
            rows.groupBy(group).agg(nearest.alias("a"), slope.alias("slope"), origin.alias("origin")).withColumn("end", F.lit(end))
        )
    return ends[0].unionByName(ends[1])


def evaluate(points: DataFrame, anchors: DataFrame, slopes: DataFrame, group: str = "path", tolerance: float = 200.0) -> DataFrame:
    """``points`` (with ``group`` and ``p``) with value, source, extrapolated metres and whether that is doubtful.

    One union and one sort per path find the anchors on both sides. Sources: survey,
    station, bridge by what the anchors rest on, or extrap.
    """
    a = anchors.select(group, F.col("p").alias("__p"), "h", F.array_sort("deps").alias("deps"))
    asked = points.withColumn("__p", F.col("p").cast("double"))
    both = asked.withColumn("__ask", F.lit(True)).unionByName(a.withColumn("__ask", F.lit(False)), allowMissingColumns=True)
    seq = Window.partitionBy(group).orderBy("__p")
    here = F.when(~F.col("__ask"), F.struct("__p", "h", "deps"))
    both = both.withColumn("lo", F.last(here, True).over(seq.rangeBetween(Window.unboundedPreceding, 0)))
    back = Window.partitionBy(group).orderBy(F.col("__p").desc())
    both = both.withColumn("hi", F.last(here, True).over(back.rangeBetween(Window.unboundedPreceding, 0)))
    rows = both.filter("__ask").drop("h", "deps", "__ask")
    one = lambda n: slopes.filter(F.col("end") == n).select(
        group, F.struct("a", "slope", "origin").alias("up" if n == 0 else "down")
    )
    rows = rows.join(one(0), group).join(one(1), group)
    single = F.col("up.a.p") == F.col("down.a.p")
    above, below = F.col("__p") < F.col("up.a.p") - INSIDE, F.col("__p") > F.col("down.a.p") + INSIDE
    out = single | above | below
    edge = F.when(above | single, F.col("up")).otherwise(F.col("down"))
    far = F.col("__p") - edge["a"]["p"]
    lo, hi = F.coalesce("lo", "hi"), F.coalesce("hi", "lo")
    share = F.coalesce(F.try_divide(F.col("__p") - lo["__p"], hi["__p"] - lo["__p"]), F.lit(0.0))
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), share))
    deps = F.array_sort(F.array_union(lo["deps"], hi["deps"]))
    inside = (
        F.when(deps == F.array(F.lit("gnss")), "survey").when(deps == F.array(F.lit("gauge")), "station").otherwise("bridge")
    )
    return rows.select(
        *points.columns,
        F.when(out, edge["a"]["h"] + edge["slope"] * far).otherwise(lo["h"] + share * (hi["h"] - lo["h"])).alias("value"),
        F.when(out, "extrap").otherwise(inside).alias("source"),
        F.when(out, F.abs(far)).otherwise(F.lit(0.0)).alias("extrap_m"),
        (out & ((F.abs(far) > tolerance) | (edge["origin"] != "end"))).alias("doubtful"),
    )


def resolved(evaluated: DataFrame, key: list[str]) -> DataFrame:
    """One level per point: the mean over paths that interpolate, else over all; source of the least extrapolated."""
    inner = F.col("source") != "extrap"
    return evaluated.groupBy(*key).agg(
        F.coalesce(F.avg(F.when(inner, F.col("value"))), F.avg("value")).alias("ws_elev"),
        F.min_by("source", F.struct("extrap_m", "path")).alias("source"),
        F.min("extrap_m").alias("extrap_m"),
        (F.max("value") - F.min("value")).alias("path_spread"),
    )
