"""Where every transect lies on the network, from its positions alone, before anything else is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions import crs
from fathom.functions.angles import utm, utm_zone
from fathom.functions.materialise import cut
from fathom.operators import joins, reference, survey

#: Metres and share of its length by which a section goes on at both ends; length from which a track has a section.
MARGIN, MARGIN_SHARE, LEAST_LENGTH = 15.0, 0.15, 1.0
#: Chainage that a section may cover, in metres and in lengths of its track.
SPAN, SPAN_SHARE = 50.0, 1.5


def filled_positions(fixes: DataFrame, key: str = "perfil") -> DataFrame:
    """Fixes (lat, lon, utm_e, utm_n) without dropouts, with ``epsg``: the UTM system of the file's mean place.

    A file without any finite UTM place gets them from latitude and longitude.
    """
    places = ("utm_e", "utm_n")
    none = F.col("utm_e").isNull() & F.col("utm_n").isNull() | F.isnan("utm_e") & F.isnan("utm_n")
    bare = fixes.groupBy(key).agg(F.bool_and(none).alias("__bare"))
    rows = fixes.join(bare, key)
    asked = rows.withColumns({f"__{c}": F.when(F.col("__bare"), F.lit(1.0)).otherwise(F.col(c)) for c in places})
    rows = survey.without_dropouts(asked, "lat", "lon", "__utm_e", "__utm_n")
    mean = rows.groupBy(key).agg(F.avg("lat").alias("__lat"), F.avg("lon").alias("__lon"))
    rows = rows.join(mean, key)
    zone, south = utm_zone(F.col("__lon")), F.col("__lat") < 0
    e, n = utm(F.col("lon"), F.col("lat"), zone, south)
    rows = rows.withColumn("epsg", F.when(south, 32700).otherwise(32600) + zone)
    filled = {c: F.when(F.col("__bare"), v).otherwise(F.col(f"__{c}")) for c, v in zip(places, (e, n))}
    return rows.withColumns(filled).drop("__bare", "__lat", "__lon", "__utm_e", "__utm_n")


def sections_of(tracks: DataFrame, key: str, order: str) -> DataFrame:
    """Each track's (``x``, ``y``) middle, first and last place, and its principal axis: n, cx, cy, first, last, a and b (ends)."""
    rows = tracks.filter("x is not null and y is not null and not isnan(x) and not isnan(y)")
    place = F.struct("x", "y")
    whole = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy"),
        F.min_by(place, order).alias("first"), F.max_by(place, order).alias("last"),
        (0.5 * F.atan2(2 * F.covar_pop("x", "y"), F.var_pop("x") - F.var_pop("y"))).alias("angle"),
    )
    along = (F.col("x") - F.col("cx")) * F.cos("angle") + (F.col("y") - F.col("cy")) * F.sin("angle")
    reach = rows.join(whole.select(key, "cx", "cy", "angle"), key).groupBy(key).agg(F.min(along).alias("lo"), F.max(along).alias("hi"))
    at = lambda t: F.struct((F.col("cx") + F.col(t) * F.cos("angle")).alias("x"), (F.col("cy") + F.col(t) * F.sin("angle")).alias("y"))
    return whole.join(reach, key).withColumns({"a": at("lo"), "b": at("hi")}).drop("angle", "lo", "hi")


def located(sections: DataFrame, key: str, segments: DataFrame, line: str, forced: DataFrame | None = None, cell: float = 250.0) -> DataFrame:
    """(line, chainage, distance, method) of each section: where it crosses a line, else the line nearest to its middle.

    A section goes on at both ends by MARGIN or MARGIN_SHARE of its length; of several
    crossings that nearest to the middle counts. ``forced`` (key, line) holds sections to a
    line; their method is ``manual``. Tracks of fewer than three fixes, or shorter than
    LEAST_LENGTH, have no section.
    """
    dx, dy = F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")
    size = F.hypot(dx, dy)
    more = F.greatest(F.lit(MARGIN), MARGIN_SHARE * size) / size
    long = sections.filter((F.col("n") >= 3) & (size >= LEAST_LENGTH)).select(
        key, "cx", "cy",
        (F.col("a.x") - more * dx).alias("ax"), (F.col("a.y") - more * dy).alias("ay"),
        (F.col("b.x") + more * dx).alias("bx"), (F.col("b.y") + more * dy).alias("by"),
    )
    met = joins.crossings(long.drop("cx", "cy"), [key], segments.withColumn("line", F.col(line)), cell).join(long.select(key, "cx", "cy"), key)
    middles = sections.select(key, F.col("cx").alias("x"), F.col("cy").alias("y"))
    ordered = segments.withColumn("__order", F.col(line))
    near = joins.nearest_segments(middles, [key], ordered, line, "__order", cell=cell).drop("rank")
    manual = F.lit(False)
    if forced is not None:
        forced = forced.select(key, F.col(line).alias("__forced"))
        met = met.join(forced, key, "left").filter("__forced is null or __forced = line")
        own = middles.join(forced.withColumnRenamed("__forced", line), key)
        own = reference.on_declared(own, [key], segments, line, cell).drop("at_end")
        near = near.join(forced, key, "left_anti").unionByName(own).join(forced, key, "left")
        manual = F.col("__forced").isNotNull()
    distance = F.hypot(F.col("px") - F.col("cx"), F.col("py") - F.col("cy"))
    best = met.groupBy(key).agg(F.min(F.struct(distance.alias("distance"), "line", "chainage")).alias("c"))
    both = near.join(best, key, "left")
    crossed = F.col("c").isNotNull()

    def of(name: str, other: str) -> Column:
        return F.when(crossed, F.col(f"c.{name}")).otherwise(F.col(other)).alias(other)

    method = F.when(manual, "manual").when(crossed, "crossing").otherwise("nearest").alias("method")
    return both.select(key, of("line", line), of("chainage", "chainage"), of("distance", "distance"), method)


def prescan(
    fixes: DataFrame, segments: DataFrame, line: str, system: int, forced: DataFrame | None = None, key: str = "perfil", order: str = "ens", cell: float = 250.0
) -> DataFrame:
    """Every transect on the network (``segments``, in the metric ``system``), from fixes with key, order, lat, lon, utm_e, utm_n.

    key, line, chainage, distance, method, span (chainage between the first and the last
    fix) and longitudinal: it covers more than SPAN and SPAN_SHARE of the way between its
    ends, so it looks like a run along the river. Files without a finite place have no row.
    """
    rows = filled_positions(fixes, key)
    place = crs.reprojected(F.col("utm_e"), F.col("utm_n"), F.col("epsg"), F.lit(system))
    sections = cut(sections_of(rows.select(key, order, place.alias("at")).select(key, order, "at.x", "at.y"), key, order))
    found = cut(located(sections, key, segments, line, forced, cell))
    ends = F.explode(F.array(F.struct(F.lit(0).alias("__end"), F.col("first").alias("at")), F.struct(F.lit(1).alias("__end"), F.col("last").alias("at"))))
    asked = sections.select(key, ends.alias("e")).select(key, "e.__end", F.col("e.at.x").alias("x"), F.col("e.at.y").alias("y"))
    placed = reference.on_declared(asked.join(found.select(key, line), key), [key, "__end"], segments, line, cell)
    span = placed.groupBy(key).agg((F.max("chainage") - F.min("chainage")).alias("span"))
    way = F.hypot(F.col("last.x") - F.col("first.x"), F.col("last.y") - F.col("first.y"))
    long = F.col("span") > F.greatest(F.lit(SPAN), SPAN_SHARE * F.greatest(way, F.lit(1.0)))
    out = found.join(span, key, "left").join(sections.select(key, "first", "last"), key)
    return out.select(key, line, "chainage", "distance", "method", "span", F.coalesce(long, F.lit(False)).alias("longitudinal"))
