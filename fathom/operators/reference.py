"""Linear referencing: places, tangents and offsets along polylines, and points on declared lines.

``segments`` are those of ``joins.segments_of``: line, seg_no, x0, y0, x1, y1, length, s0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.angles import azimuth
from fathom.operators.joins import nearest_segments


def place_at(points: DataFrame, segments: DataFrame, line: str, s: Column, x: str, y: str, cell: float = 250.0) -> DataFrame:
    """Adds the place (``x``, ``y``) at chainage ``s`` of each point's line, within the line's ends.

    Segments are listed under the cells of chainage that they touch and meet the points of
    those cells only; each point meets one segment. Points with a null line or chainage,
    or a line without segments, have no row.
    """
    seq, whole = Window.partitionBy(line).orderBy("seg_no"), Window.partitionBy(line)
    end = F.col("s0") + F.col("length")
    parts = segments.select(
        line,
        *(F.col(c).alias(f"__{c}") for c in ("x0", "y0", "x1", "y1", "s0", "length")),
        F.lead("s0").over(seq).alias("__next"),
        F.max(end).over(whole).alias("__total"),
    )
    totals = parts.groupBy(line).agg(F.max("__total").alias("__total"))
    stop = F.coalesce(F.col("__next"), F.col("__total"))
    parts = parts.withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__s0") / cell), F.floor(stop / cell)))).drop("__total")
    asked = points.withColumn("__s", s.cast("double")).join(totals, line).filter("__s is not null and not isnan(__s)")
    asked = asked.withColumn("__s", F.greatest(F.lit(0.0), F.least("__s", "__total"))).withColumn("__cell", F.floor(F.col("__s") / cell))
    met = asked.join(parts, [line, "__cell"]).filter("__s0 <= __s and (__next is null or __s < __next)")
    u = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("__s") - F.col("__s0"), F.col("__length")), F.lit(0.0)))
    met = met.withColumn(x, F.col("__x0") + u * (F.col("__x1") - F.col("__x0"))).withColumn(y, F.col("__y0") + u * (F.col("__y1") - F.col("__y0")))
    return met.drop(*(c for c in met.columns if c.startswith("__")))


def tangent(points: DataFrame, segments: DataFrame, line: str, s: str, span: float = 50.0, out: str = "tangent") -> DataFrame:
    """Adds the unit chord over ``span`` either side of chainage ``s`` (struct ``out`` of x, y, azimuth); null where it has no length."""
    rows = place_at(points, segments, line, F.col(s) - span, "ta_x", "ta_y")
    rows = place_at(rows, segments, line, F.col(s) + span, "tb_x", "tb_y")
    dx, dy = F.col("tb_x") - F.col("ta_x"), F.col("tb_y") - F.col("ta_y")
    size = F.hypot(dx, dy)
    unit = F.struct((dx / size).alias("x"), (dy / size).alias("y"), azimuth(dx, dy).alias("azimuth"))
    return rows.withColumn(out, F.when(size > 1e-9, unit)).drop("ta_x", "ta_y", "tb_x", "tb_y")


def signed_offset(points: DataFrame, segments: DataFrame, line: str, s: str, x: str, y: str, span: float = 5.0) -> DataFrame:
    """Adds the nearest place on the line (snap_x, snap_y), the local ``axis`` and the ``offset`` from it, positive to the left."""
    rows = tangent(place_at(points, segments, line, F.col(s), "snap_x", "snap_y"), segments, line, s, span, "axis")
    vx, vy = F.col(x) - F.col("snap_x"), F.col(y) - F.col("snap_y")
    return rows.withColumn("offset", F.col("axis.x") * vy - F.col("axis.y") * vx)


def transferred(chainage: Column, offset: Column, axis_x: Column, axis_y: Column, dx: Column, dy: Column) -> tuple[Column, Column]:
    """(chainage, offset) of a footprint (dx, dy) away from a place with a known local axis, to first order."""
    return chainage + axis_x * dx + axis_y * dy, offset + axis_x * dy - axis_y * dx


def on_declared(points: DataFrame, key: Sequence[str], segments: DataFrame, line: str, cell: float = 250.0) -> DataFrame:
    """Every point (``x``, ``y``) on the line that it declares: distance, chainage and whether it lies at an end.

    Near a confluence another line may be nearer; the declared one is taken all the same.
    A point at an end may lie beyond the digitised reach. Points that declare no line, or
    one that is not there, and points without finite coordinates have no row. Points meet
    their line's segments in grid cells, so that none meets all of a long line.
    """
    totals = segments.groupBy(line).agg(F.max(F.col("s0") + F.col("length")).alias("__total"))
    placed = nearest_segments(points, key, segments.withColumn("__order", F.lit(0)), line, "__order", cell=cell, own=True)
    s = F.col("chainage")
    end = (s <= 1e-6) | (s >= F.col("__total") - 1e-6)
    return placed.join(totals, line).select(*key, line, "distance", "chainage", end.alias("at_end"))
