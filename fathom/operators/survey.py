"""Surveys: beam clouds, section profiles, repeated sections, tracks, quality checks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.angles import along_axis, offset_penalty, undirected_difference, utm
from fathom.operators import aggregates, joins, sequence

#: Tilt of the slant beams, frequency that separates their azimuth sets, weights and source codes.
TILT, SPLIT_KHZ = 25.0, 2500.0
VERTICAL_WEIGHT, SLANT_WEIGHT = 1.0, 0.5
SLANT, VERTICAL, SOUNDER, FILLED = 1, 2, 3, 4


def without_dropouts(df: DataFrame, lat: str, lon: str, east: str, north: str) -> DataFrame:
    """All four position columns null where any says that there was no fix; adds ``dropout``."""
    a, b, e, n = (aggregates.finite(F.col(c)) for c in (lat, lon, east, north))
    bad = a.isNull() | b.isNull() | (F.abs(a) < 1e-9) | (F.abs(b) < 1e-9) | e.isNull() | n.isNull() | ((e == 0) & (n == 0))
    rows = df.withColumn("dropout", bad)
    return rows.withColumns({c: F.when(~F.col("dropout"), F.col(c)) for c in (lat, lon, east, north)})


def filled_places(df: DataFrame, lat: str, lon: str, east: str, north: str, zone: Column, south: Column | None = None) -> DataFrame:
    """Recorded coordinates where both are finite, else those of latitude and longitude in ``zone``; adds ``rebuilt``.

    Both are taken from one source, so that a half-recorded pair is rebuilt as a whole. Rows
    without either source have null coordinates and are not rebuilt.
    """
    a, b, e, n = (aggregates.finite(F.col(c)) for c in (lat, lon, east, north))
    kept, known = e.isNotNull() & n.isNotNull(), a.isNotNull() & b.isNotNull()
    x, y = utm(b, a, zone, south)
    rows = df.withColumn("__x", F.when(kept, e).when(known, x)).withColumn("__y", F.when(kept, n).when(known, y))
    return rows.withColumns({"rebuilt": ~kept & known, east: F.col("__x"), north: F.col("__y")}).drop("__x", "__y")


def beam_cloud(df: DataFrame, keep: Sequence[str], east: str, north: str, depth: str, beams: str, heading: Column, khz: Column) -> DataFrame:
    """A row per beam that found the bed: ``keep``, e, n, depth, weight, beam_index, src.

    The vertical beam lies below the boat; a slant beam's footprint lies at depth *
    tan(25 degrees) in its own direction, of the high or the low set by frequency.
    """
    d = aggregates.finite(F.col(depth))
    turn = F.when(F.coalesce(khz, F.lit(3000.0)) >= SPLIT_KHZ, F.lit(0.0)).otherwise(F.lit(45.0))
    reach = math.tan(math.radians(TILT))

    def footprint(k: int) -> Column:
        z = aggregates.finite(F.try_element_at(F.col(beams), F.lit(k)).cast("double"))
        t = F.radians(F.coalesce(heading, F.lit(0.0)) + turn + 90.0 * (k - 1))
        return F.struct(
            (F.col(east) + z * reach * F.sin(t)).alias("e"),
            (F.col(north) + z * reach * F.cos(t)).alias("n"),
            z.alias("depth"),
            F.lit(SLANT_WEIGHT).alias("weight"),
            F.lit(k).alias("beam_index"),
            F.lit(SLANT).alias("src"),
        )

    below = F.struct(
        F.col(east).cast("double").alias("e"),
        F.col(north).cast("double").alias("n"),
        d.alias("depth"),
        F.lit(VERTICAL_WEIGHT).alias("weight"),
        F.lit(0).alias("beam_index"),
        F.lit(VERTICAL).alias("src"),
    )
    points = F.filter(F.array(below, *(footprint(k) for k in range(1, 5))), lambda p: p["depth"] > 0)
    return df.select(*keep, F.inline(points))


def on_section(cloud: DataFrame, x0: Column, y0: Column, bearing: Column, scale: float = 3.0) -> DataFrame:
    """Adds s and offset on the section's axis and reduces the weight by distance from it."""
    s, offset = along_axis(F.col("e"), F.col("n"), x0, y0, bearing)
    rows = cloud.withColumn("s", s).withColumn("offset", offset)
    return rows.withColumn("weight", F.col("weight") * offset_penalty(F.col("offset"), scale))


def node_depths(
    points: DataFrame, keys: Sequence[str], s: str, depth: str, weight: str, step: float, half: float, primary: str | None = None,
    primary_min: int = 1, composite: bool = True, source: str | None = None,
) -> DataFrame:
    """Weighted median depth at every grid node, from the points within ``half`` of it.

    With ``primary``, a node uses its primary points if there are ``primary_min`` of
    them, else all (``composite``) or none. Adds the number of points used and, with
    ``source``, the most frequent source (ties: the least). Points are dealt to their nodes
    once, and equal depths of a node are summed before they are ordered.
    """
    v = aggregates.finite(F.col(depth))
    near = joins.band_join(points.filter(v > 0), s, step, half)
    at = [*keys, "node"]
    sums = near.groupBy(
        *at,
        v.alias("__v"),
        F.coalesce(F.col(primary), F.lit(False)).alias("__p") if primary else F.lit(True).alias("__p"),
        F.col(source).alias("__src") if source else F.lit(0).alias("__src"),
    ).agg(F.sum(F.coalesce(aggregates.finite(F.col(weight)), F.lit(0.0))).alias("__w"), F.count("*").alias("__n"))
    group = Window.partitionBy(*at)
    if primary:
        enough = F.sum(F.when(F.col("__p"), F.col("__n")).otherwise(0)).over(group) >= primary_min
        sums = sums.withColumn("__enough", enough).filter(F.when(F.col("__enough"), F.col("__p")).otherwise(F.lit(composite)))
    upto = group.orderBy("__v", "__src", "__p").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumns({
        "__cw": F.sum("__w").over(upto), "__tw": F.sum("__w").over(group),
        "__cn": F.sum("__n").over(upto), "__tn": F.sum("__n").over(group),
        "__of": F.sum("__n").over(Window.partitionBy(*at, "__src")),
    })
    least = lambda c: F.min(F.when(c, F.col("__v")))
    plain = (least(F.col("__cn") * 2 >= F.col("__tn")) + least(F.col("__cn") * 2 > F.col("__tn"))) / 2
    median = F.coalesce(least((F.col("__tw") > 0) & (F.col("__cw") >= 0.5 * F.col("__tw"))), plain)
    mode = [F.min_by("__src", F.struct(-F.col("__of"), F.col("__src"))).alias("src")] if source else []
    return sums.groupBy(*at).agg(median.alias("depth_m"), F.sum("__n").alias("n_points"), *mode)


def profile(
    points: DataFrame, keys: Sequence[str], left: Column, right: Column, step: float = 0.5, half: float | None = None, primary: str | None = None,
    primary_min: int = 1, composite: bool = True, source: str | None = None, anchor: str = "ref", extent: DataFrame | None = None,
) -> DataFrame:
    """Section profile on a regular grid from the left bank (s = 0): node, s_m, depth_m, with ``source`` also src.

    ``points`` has ``keys``, s, depth, weight. The measured extent is moved to begin
    ``left`` metres from the bank and ends ``right`` metres before the other; banks are
    zero deep; gaps are filled along the line; the smoothing is quadratic over two metres
    (five nodes at least) and never negative; banks are set to zero again.

    The extent is that of the ``primary`` points with a depth (``anchor`` ref; of all points
    where there are none) or of all points (cloud). ``extent`` (``keys``, lo, hi) goes before
    both where its values are finite. Nodes more than a step outside it are not measured.
    ``primary``, ``primary_min``, ``composite`` and ``source`` are those of ``node_depths``;
    nodes without points have the source of filled ones.
    """
    if anchor not in ("ref", "cloud"):
        raise ValueError(f"anchor is ref or cloud, not {anchor!r}")
    s = aggregates.finite(F.col("s"))
    reference = F.when(F.col(primary) & (aggregates.finite(F.col("depth")) > 0), s) if primary and anchor == "ref" else s
    ends = points.groupBy(*keys).agg(
        F.coalesce(F.min(reference), F.min(s)).alias("__lo"), F.coalesce(F.max(reference), F.max(s)).alias("__hi"),
        left.alias("__left"), right.alias("__right"),
    )
    if extent is not None:
        lo, hi = aggregates.finite(F.col("lo")), aggregates.finite(F.col("hi"))
        given = extent.filter(lo.isNotNull() & hi.isNotNull()).select(*keys, lo.alias("__a"), hi.alias("__b"))
        ends = ends.join(given, list(keys), "left").withColumns({"__lo": F.coalesce("__a", "__lo"), "__hi": F.coalesce("__b", "__hi")})
        ends = ends.drop("__a", "__b")
    moved = points.join(F.broadcast(ends) if not keys else ends, list(keys)).withColumn("s", F.col("s") - F.col("__lo") + F.col("__left"))
    depths = node_depths(moved, keys, "s", "depth", "weight", step, half or 2 * step, primary, primary_min, composite, source)
    width = F.col("__left") + F.col("__hi") - F.col("__lo")
    last = F.floor((width + F.col("__right") + step / 2) / step - 1e-9).cast("long")
    at = F.col("node") * step
    grid = ends.select(
        *keys, "__left", width.alias("__end"), last.alias("__last"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("node")
    )
    rows = grid.join(depths.drop("n_points"), [*keys, "node"], "left")
    inside = at.between(F.col("__left") - step, F.col("__end") + step)
    bank = (F.col("node") == 0) | (F.col("node") == F.col("__last"))
    if source:
        rows = rows.withColumn("src", F.coalesce(F.when(inside, F.col("src")), F.lit(FILLED)))
    rows = rows.withColumn("depth_m", F.when(bank, F.lit(0.0)).when(inside, F.col("depth_m")))
    rows = sequence.gap_interpolate(rows, keys, "node", "depth_m", "filled")
    window = max(5, round(2.0 / step))
    rows = sequence.smooth(rows, keys, ["node"], "filled", window + (window % 2 == 0), "smoothed")
    depth = F.when(bank, F.lit(0.0)).otherwise(F.greatest(F.col("smoothed"), F.lit(0.0)))
    return rows.select(*keys, "node", at.alias("s_m"), depth.alias("depth_m"), *(["src"] if source else []))


def orientation(df: DataFrame, keys: Sequence[str], order: str, x: str, y: str, axis_bearing: Column) -> DataFrame:
    """Angle between the track (first to last fix) and the section axis, and the share of width lost to it."""
    from fathom.functions.angles import azimuth

    ends = df.groupBy(*keys).agg(
        F.min_by(F.struct(x, y), order).alias("a"), F.max_by(F.struct(x, y), order).alias("b"), F.first(axis_bearing).alias("axis")
    )
    track = azimuth(F.col(f"b.{x}") - F.col(f"a.{x}"), F.col(f"b.{y}") - F.col(f"a.{y}"))
    angle = undirected_difference(track, F.col("axis"))
    return ends.select(*keys, angle.alias("angle"), (1 - F.abs(F.cos(F.radians(angle)))).alias("width_lost"))


def principal_bearing(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Direction of the greatest spread of points, 0 to 180 degrees from north."""
    angle = 0.5 * F.atan2(2 * F.covar_pop(x, y), F.var_pop(x) - F.var_pop(y))
    return df.groupBy(*keys).agg(F.pmod(90 - F.degrees(angle), F.lit(180.0)).alias("bearing"))


def checks(profiles: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Acceptance of a profile: starts at zero, both banks dry, no gaps."""
    return profiles.groupBy(*keys).agg(
        (F.min("s_m") == 0).alias("starts_at_zero"),
        (F.abs(F.min_by("depth_m", "node")) + F.abs(F.max_by("depth_m", "node")) == 0).alias("dry_banks"),
        (F.count_if(F.col("depth_m").isNull()) == 0).alias("no_gaps"),
    )


def accepted(profiles: DataFrame, keys: Sequence[str], directions: DataFrame, tolerance: float = 10.0) -> DataFrame:
    """``checks`` with the axis' deviation from a right angle to the flow, and whether all that counts holds.

    ``directions`` has ``keys``, flow_azimuth and section_azimuth, whichever way they point.
    Accepted: within ``tolerance`` degrees, from zero on, without gaps. A profile without
    a direction is not accepted.
    """
    off = 90 - undirected_difference(F.col("section_azimuth"), F.col("flow_azimuth"))
    angles = directions.select(*keys, off.alias("off_degrees"))
    rows = checks(profiles, keys).join(angles, list(keys), "left")
    square = F.coalesce(F.col("off_degrees") <= tolerance, F.lit(False))
    return rows.withColumn("perpendicular", square).withColumn("accepted", square & F.col("starts_at_zero") & F.col("no_gaps"))
