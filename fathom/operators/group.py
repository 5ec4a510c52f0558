"""One profile for a group of repetitions of a section."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.functions.angles import along_axis
from fathom.functions.materialise import cut
from fathom.operators import aggregates, beams, flow, joins, reference, survey


class Processed(NamedTuple):
    """What ``process_groups`` gives: see there."""

    profile: DataFrame
    members: DataFrame
    nodes: DataFrame
    repetitions: DataFrame
    groups: DataFrame


def group_profile(
    cloud: DataFrame, vectors: DataFrame, edges: DataFrame, group: Sequence[str], member: str, step: float = 0.5, scale: float = 3.0, tolerance: float = 25.0,
    beam: str | None = None, primary: str | None = None, primary_min: int = 1, composite: bool = True, source: str | None = None,
    anchor: str = "ref", extent: str = "max",
) -> tuple[DataFrame, DataFrame]:
    """(profile, directions) of each group, from the clouds and velocities of all its repetitions.

    ``cloud`` has ``group``, ``member``, e, n, depth, weight; ``vectors`` has ``group``,
    ``member``, ve, vn, weight, step; ``edges`` has a row per group with left, right (metres
    from the measured ends to the banks) and surface (may be null). The section lies at right
    angles to the pooled flow, through the centre of the cloud. The profile has node, s_m,
    depth_m, the place east, north on the axis and the bed, with ``source`` also src. Groups
    without a direction, edges or depths have no profile.

    ``extent`` mean takes the mean of where the repetitions (with ``beam``, each of their beams)
    begin and end with a depth, so that a group is no wider than its repetitions; max takes the
    outermost points. With ``primary`` and ``anchor`` ref only primary points count there, of groups that
    have any. The other parameters are those of ``survey.profile``.
    """
    keys = list(group)
    directions = flow.group_direction(vectors, keys, member, "ve", "vn", "weight", "step", tolerance)
    centres = cloud.groupBy(*keys).agg(F.avg("e").alias("__e"), F.avg("n").alias("__n"))
    frame = centres.join(directions.select(*keys, "section_azimuth"), keys).join(edges, keys)
    placed = survey.on_section(cloud.join(frame, keys), F.col("__e"), F.col("__n"), F.col("section_azimuth"), scale)
    known = list(dict.fromkeys(c for c in (beam, primary, source) if c))
    placed = placed.select(*keys, member, *known, "s", "depth", "weight", "left", "right")
    reaching = placed.filter(aggregates.finite(F.col("depth")) > 0)
    each = [member, *([beam] if beam else [])]
    reach = lambda rows: aggregates.measured_extent(rows, keys, each, "s", mode=extent).select(
        *keys, F.col("extent_from").alias("lo"), F.col("extent_to").alias("hi")
    )
    ends = reach(reaching if extent == "mean" else placed)
    if primary and anchor == "ref":
        own = reach(reaching.filter(primary)).withColumnsRenamed({"lo": "__a", "hi": "__b"})
        ends = ends.join(own, keys, "left").select(*keys, F.coalesce("__a", "lo").alias("lo"), F.coalesce("__b", "hi").alias("hi"))
    profile = survey.profile(
        placed, keys, F.first("left"), F.first("right"), step, None, primary, primary_min, composite, source, anchor, ends
    )
    banks = ends.join(edges, keys).select(*keys, (F.col("lo") - F.col("left")).alias("__bank"))
    rows = profile.join(banks.join(frame, keys), keys).withColumn("__s", F.col("__bank") + F.col("s_m"))
    rows = beams.profile_table(rows, "__s", "depth_m", F.col("__e"), F.col("__n"), F.col("section_azimuth"), F.col("surface"))
    return rows.select(*keys, "node", "s_m", "depth_m", "east", "north", "bed", *(["src"] if source else [])), directions


def on_merged_axis(profiles: DataFrame, merged: DataFrame, directions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Nodes of the repetitions' profiles (``keys``, east, north) with ``s_m`` on the axis of their group's merged profile.

    By their place on the ground, not by their share of the width: what two repetitions
    measured at one place stays at one place, however wide each of them is.
    """
    origin = merged.filter("node = 0").select(*keys, F.col("east").alias("__x"), F.col("north").alias("__y"))
    axis = origin.join(directions.select(*keys, F.col("section_azimuth").alias("__t")), list(keys))
    s, _ = along_axis(F.col("east"), F.col("north"), F.col("__x"), F.col("__y"), F.col("__t"))
    return profiles.join(axis, list(keys)).withColumn("s_m", s).drop("__x", "__y", "__t")


def _fitting(cell: float, sections: DataFrame, segments: DataFrame) -> float:
    """Twice the mean length of the segments, a sixteenth of the sections' at least and ``cell`` at most; results are the same by any."""
    size = lambda rows, c: rows.agg(F.avg(aggregates.finite(c))).first()[0] or 0.0
    long = size(sections, F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    return min(cell, max(2 * size(segments, F.col("length")), long / 16) or cell)


def relocated(merged: DataFrame, edges: DataFrame, keys: Sequence[str], segments: DataFrame, line: str, cell: float = 250.0) -> DataFrame:
    """Where each merged section lies on the river of its group: line, chainage, distance and method.

    ``edges`` has ``keys``, left, right and the group's ``line``. The measured part of the
    section, without its banks, counts: where it crosses the river nearest to its middle,
    else the river's nearest place to the middle. Groups that name no line, or one that is
    not there, lie on the nearest.
    """
    ends = merged.groupBy(*keys).agg(
        F.min_by(F.struct("east", "north"), "node").alias("a"), F.max_by(F.struct("east", "north"), "node").alias("b"), F.max("s_m").alias("size")
    ).join(edges, list(keys))
    along = lambda m, c: F.col(f"a.{c}") + F.coalesce(F.try_divide(m, F.col("size")), F.lit(0.0)) * (F.col(f"b.{c}") - F.col(f"a.{c}"))
    lo, hi = F.col("left"), F.col("size") - F.col("right")
    sections = cut(ends.select(
        *keys, F.col(line).alias("__own"),
        along(lo, "east").alias("ax"), along(lo, "north").alias("ay"), along(hi, "east").alias("bx"), along(hi, "north").alias("by"),
    ))
    segments = cut(segments)
    cell = _fitting(cell, sections, segments)
    middle = sections.select(*keys, "__own", ((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y"))
    middle = cut(middle.join(segments.select(F.col(line).alias("__own")).distinct().withColumn("__there", F.lit(True)), "__own", "left"))
    own = reference.on_declared(middle.filter("__there").withColumnRenamed("__own", line), keys, segments, line, cell)
    free = middle.filter("__there is null")
    near = joins.nearest_segments(free, keys, segments.withColumn("__order", F.col(line)), line, "__order", cell=cell)
    foot = cut(own.select(*keys, line, "distance", "chainage").unionByName(near.select(*keys, line, "distance", "chainage")))
    # only crossings with the line on which the middle lies count
    sections = sections.drop("__own").join(foot.select(*keys, F.col(line).alias("line")), list(keys))
    met = joins.crossings(sections, keys, segments.withColumnRenamed(line, "line"), cell, own=True).withColumnRenamed("line", line)
    met = met.join(middle.select(*keys, "x", "y"), list(keys)).withColumn("__d", F.hypot(F.col("px") - F.col("x"), F.col("py") - F.col("y")))
    met = met.groupBy(*keys, line).agg(F.min(F.struct("__d", "chainage")).alias("__c"))
    rows = foot.join(met, [*keys, line], "left")
    crossed = F.col("__c").isNotNull()
    return rows.select(
        *keys, line, F.coalesce("__c.chainage", "chainage").alias("chainage"), F.coalesce("__c.__d", "distance").alias("distance"),
        F.when(crossed, "crossing").otherwise("nearest").alias("method"),
    )


def process_groups(
    cloud: DataFrame, vectors: DataFrame, members: DataFrame, group: Sequence[str], member: str, step: float = 0.5, scale: float = 3.0,
    tolerance: float = 25.0, segments: DataFrame | None = None, line: str = "line", stage_tolerance: float = 0.10, **options,
) -> Processed:
    """Groups of repetitions from their clouds to their quality, all groups at once.

    ``cloud`` and ``vectors`` are those of ``group_profile``; ``members`` has a row per
    repetition: ``group``, ``member``, left, right, surface, discharge and, with ``segments``,
    ``line``. A group's banks are the medians of its repetitions' and its surface their mean.

    ``profile``: the merged profiles. ``members``: each repetition's own profile, about its own
    axis, with s_m on the merged axis. ``nodes``: per merged node n, sigma (population) and
    whether all repetitions reach it. ``repetitions``: each one's root mean square against
    the merged profile. ``groups``: a row per group: direction and strays, banks, surface
    and its spread (``same_stage``: within ``stage_tolerance``), width, depth and thalweg,
    deviations over all and over common nodes, discharge statistics, acceptance and, with
    ``segments``, the place on the river (``relocated``). ``options`` are those of ``group_profile``.
    Groups without a merged profile are left out. Profiles are materialised once each, as
    all later tables read them.
    """
    keys = list(group)
    level, flow_of = aggregates.finite(F.col("surface")), aggregates.finite(F.col("discharge"))
    half = lambda c: F.coalesce(F.percentile(aggregates.finite(F.col(c)), F.lit(0.5)), F.lit(0.0)).alias(c)
    edges = members.groupBy(*keys).agg(
        half("left"), half("right"), F.avg(level).alias("surface"), (F.max(level) - F.min(level)).alias("surface_spread"), F.count("*").alias("n_members"),
        *([F.min(line).alias(line)] if segments is not None else []),
    )
    profile, directions = group_profile(cloud, vectors, edges, keys, member, step, scale, tolerance, **options)
    profile, directions = cut(profile), cut(directions)

    each = [*keys, member]
    again = lambda df: df.withColumn("__rep", F.col(member))
    own, _ = group_profile(
        again(cloud), again(vectors), members.select(*each, *(F.coalesce(aggregates.finite(F.col(c)), F.lit(0.0)).alias(c) for c in ("left", "right")), "surface"),
        each, "__rep", step, scale, tolerance, **options,
    )
    own = cut(on_merged_axis(own, profile, directions, keys))
    merged = profile.select(*keys, "node", "s_m", F.col("depth_m").alias("merged"))
    rows = cut(aggregates.resampled(own.select(*each, "s_m", "depth_m"), keys, member, "s_m", "depth_m", merged))
    nodes = aggregates.node_spread(rows, keys, "node", member, "resampled", own.select(*each).distinct())
    repetitions = aggregates.repetition_misfit(rows, keys, member, "resampled", "merged")

    on = F.when(F.col("common"), F.col("sigma"))
    spread = nodes.groupBy(*keys).agg(
        F.avg("sigma").alias("sigma_mean"), F.max("sigma").alias("sigma_max"), F.avg(on).alias("sigma_mean_common"), F.max(on).alias("sigma_max_common"),
        (F.min(F.when(F.col("common"), F.col("node"))) * step).alias("common_from"), (F.max(F.when(F.col("common"), F.col("node"))) * step).alias("common_to"),
    )
    shape = aggregates.thalweg(profile.withColumn("__ws", F.coalesce(F.col("bed") + F.col("depth_m"), F.lit(0.0))), keys, "depth_m", "__ws", "s_m")
    flows = aggregates.spread_statistics(members.withColumn("__q", flow_of), keys, "__q").select(
        *keys, F.col("mean").alias("discharge"), F.col("sd").alias("discharge_sd"), F.col("cv_percent").alias("discharge_cv"), F.col("n").alias("n_discharges")
    )
    groups = edges.withColumn("same_stage", F.coalesce(F.col("surface_spread") <= stage_tolerance, F.lit(True)))
    groups = groups.join(shape, keys).join(directions, keys).join(spread, keys, "left").join(flows, keys, "left")
    passed = survey.accepted(profile, keys, directions).select(*keys, "off_degrees", "accepted")
    groups = groups.join(passed, keys)
    if segments is not None:
        place = relocated(profile, edges.select(*keys, "left", "right", line), keys, segments, line)
        groups = groups.drop(line).join(place, keys, "left")
    return Processed(profile, own, nodes, repetitions, groups)
