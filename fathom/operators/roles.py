"""What surface points and gauges are taken for: anchors, checks or nothing, and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.text import folded_name
from fathom.operators import grouping, network
from fathom.operators.aggregates import finite
from fathom.operators.joins import nearest_segments
from fathom.operators.reference import on_declared

#: Metres beyond an axis' end and off an axis, lead of the nearest axis, merging distance, margin of a bracket.
BEYOND_END, OFF_AXIS, LEAD, SAME_PLACE, MARGIN = 50.0, 250.0, 25.0, 0.01, 0.5


def _at_end(segments: DataFrame, line: str) -> DataFrame:
    return segments.groupBy(line).agg(F.max(F.col("s0") + F.col("length")).alias("__total"))


def point_roles(points: DataFrame, key: str, segments: DataFrame, line: str, declared: str | None = None, cell: float = 250.0) -> DataFrame:
    """Every surface point on its river: line, distance, chainage, the next river and its distance, role and note.

    A point lies on the river that it declares, whatever the letters' case and accents, else
    on the nearest. One that projects on an axis' end from more than 50 m, or lies more than
    250 m from its axis, is dropped; others are anchors. Notes, the first that holds: beyond
    the end, off the axis, ambiguous (nearest by less than 25 m, none declared), declared, not
    there (nearest taken instead); null for none. Points without finite coordinates are
    dropped with the note no place. Points and segments meet in grid cells only.
    """
    told = points.select(key, "x", "y", (F.col(declared) if declared else F.lit(None)).cast("string").alias("__said"))
    names = segments.select(line).distinct().select(folded_name(F.col(line).cast("string")).alias("__fold"), F.col(line).alias("__own"))
    names = names.groupBy("__fold").agg(F.min("__own").alias("__own"))
    told = told.withColumn("__fold", folded_name(F.col("__said"))).join(names, "__fold", "left").drop("__fold")
    near = nearest_segments(told, [key], segments.withColumn("__order", F.col(line)), line, "__order", k=2, cell=cell)
    place = F.struct(F.col(line).alias("line"), "distance", "chainage")
    two = near.groupBy(key).agg(F.max(F.when(F.col("rank") == 1, place)).alias("__one"), F.max(F.when(F.col("rank") == 2, place)).alias("__two"))
    wish = on_declared(told.filter("__own is not null").select(key, "x", "y", F.col("__own").alias(line)), [key], segments, line, cell)
    wish = wish.select(key, F.struct(F.col(line).alias("line"), "distance", "chainage").alias("__wish"))
    rows = told.select(key, "__said", "__own").join(two, key, "left").join(wish, key, "left").withColumn("__at", F.coalesce("__wish", "__one"))
    other = F.when(F.col("__one.line") != F.col("__at.line"), F.col("__one")).otherwise(F.col("__two"))
    rows = rows.withColumn("__other", other).join(_at_end(segments, line).withColumnRenamed(line, "__line"), F.col("__line") == F.col("__at.line"), "left")
    d, s = F.col("__at.distance"), F.col("__at.chainage")
    end = (s <= 1e-6) | (s >= F.col("__total") - 1e-6)
    lost = F.coalesce(
        F.when(F.col("__at").isNull(), "no place"), F.when(end & (d > BEYOND_END), "beyond the end"), F.when(d > OFF_AXIS, "off the axis")
    )
    free = F.col("__wish").isNull()
    note = F.coalesce(
        lost,
        F.when(free & (F.col("__other.distance") - d < LEAD), "ambiguous"),
        F.when(~free, "declared"),
        F.when(F.col("__said").isNotNull(), "not there"),
    )
    return rows.select(
        key, F.col("__at.line").alias(line), d.alias("distance"), s.alias("chainage"), F.col("__other.line").alias("other"),
        F.col("__other.distance").alias("other_distance"), F.when(lost.isNull(), "anchor").otherwise("dropped").alias("role"), note.alias("note"),
    )


def merged_points(placed: DataFrame, key: str, line: str, s: str, level: str) -> DataFrame:
    """Points of a river less than a centimetre from the first of their run as one: ids joined with +, mean place and level, number."""
    known = placed.select(line, key, finite(F.col(s)).alias(s), finite(F.col(level)).alias(level)).na.drop(subset=[line, s, level])
    runs = grouping.leader_runs(known, [line], [s, key], [], lambda a, b: b[s] - a[s] < SAME_PLACE)
    names = F.transform(F.array_sort(F.collect_list(F.struct(s, key))), lambda m: m[key].cast("string"))
    return runs.groupBy(line, "run").agg(
        F.array_join(names, "+").alias("ids"), F.avg(s).alias(s), F.avg(level).alias(level), F.count("*").alias("n")
    )


def gauge_roles(
    gauges: DataFrame, key: str, anchors: DataFrame, parts: DataFrame, river: str, s: str, level: str, reason: Column | None = None
) -> DataFrame:
    """Adds each gauge's ``role``: excluded (``reason`` is not null), no reading, qc or anchor.

    A gauge with ``anchors`` (``river``, ``s``) more than half a metre upstream and downstream
    of it on one of the paths through it (``parts`` of ``network.paths``) only checks the
    surface; others hold it. Anchors are reduced to the ends of each path before they meet
    gauges, so a gauge meets one row a path, however many anchors there are.
    """
    ends = network.positions(anchors.select(river, s), parts, river, s).groupBy("head").agg(F.min("p").alias("__lo"), F.max("p").alias("__hi"))
    asked = gauges.select(key, river, s).filter(finite(F.col(s)).isNotNull())
    held = network.positions(asked, parts, river, s).join(ends, "head")
    between = (F.col("__lo") < F.col("p") - MARGIN) & (F.col("__hi") > F.col("p") + MARGIN)
    held = held.filter(between).select(key).distinct().withColumn("__held", F.lit(True))
    role = F.when(finite(F.col(level)).isNull(), "no reading").when(F.col("__held"), "qc").otherwise("anchor")
    if reason is not None:
        role = F.when(reason.isNotNull(), "excluded").otherwise(role)
    return gauges.join(held, key, "left").withColumn("role", role).drop("__held")
