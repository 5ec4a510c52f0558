"""Index and quality tables: a row per group, track or survey, and their order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.text import folded_name
from fathom.operators.aggregates import finite


def group_quality(df: DataFrame, group: Sequence[str], member: str, time: str, left: str, right: str, surface: str, chainage: str) -> DataFrame:
    """A row per group: its repetitions in order of time joined by semicolons, and what they have in common.

    Median distances to both banks, mean and spread of the water surface, spread of the
    chainage, first time. The list is as long as a group has repetitions.
    """
    of = {c: finite(F.col(c)) for c in (left, right, surface, chainage)}
    listed = F.transform(F.array_sort(F.collect_list(F.struct(time, member))), lambda m: m[member].cast("string"))
    return df.groupBy(*group).agg(
        F.array_join(listed, ";").alias("members"),
        F.count("*").alias("n_members"),
        F.percentile(of[left], F.lit(0.5)).alias("left_m"),
        F.percentile(of[right], F.lit(0.5)).alias("right_m"),
        F.avg(of[surface]).alias("surface_mean"),
        (F.max(of[surface]) - F.min(of[surface])).alias("surface_spread"),
        (F.max(of[chainage]) - F.min(of[chainage])).alias("chainage_spread"),
        F.min(time).alias("first_time"),
    )


def track_index(df: DataFrame, track: Sequence[str], fixed: Column, chainage: str, time: str, source: str) -> DataFrame:
    """A row per track: ensembles, those without a fix, chainage from and to, minutes, and how often each source gave the surface.

    Counted by track and source first, so a long track is spread over the tasks.
    """
    km = finite(F.col(chainage))
    parts = df.groupBy(*track, source).agg(
        F.count("*").alias("n"), F.count_if(~fixed).alias("lost"), F.min(km).alias("lo"), F.max(km).alias("hi"), F.min(time).alias("t0"), F.max(time).alias("t1")
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct(source, "n"))), lambda p: F.concat_ws(" ", p[source], p["n"].cast("string")))
    return parts.groupBy(*track).agg(
        F.sum("n").alias("n_ensembles"),
        F.sum("lost").alias("n_without_fix"),
        F.min("lo").alias("chainage_from"),
        F.max("hi").alias("chainage_to"),
        (F.timestamp_diff("MICROSECOND", F.min("t0"), F.max("t1")) / 6e7).alias("minutes"),
        F.array_join(listed, ", ").alias("sources"),
    )


def track_order(river: Column, chainage: Column) -> list[Column]:
    """Order of a track index: the first river, then the chainage, unknown ones as zero."""
    return [river.asc_nulls_first(), F.coalesce(finite(chainage), F.lit(0.0)).asc()]


def survey_order(rank: Column, continuous: Column, official: Column) -> list[Column]:
    """Order of a survey index: the path's rank, then the continuous chainage, else the official; unknown ones last."""
    return [rank.asc_nulls_last(), F.coalesce(finite(continuous), finite(official)).asc_nulls_last()]


def positions_in(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "position") -> DataFrame:
    """Adds each row's place from 1 in its key's order."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_seen(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "values") -> DataFrame:
    """The distinct values of each key in the order in which they appear first; nulls do not count."""
    first = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(order).alias("__first"))
    listed = F.array_sort(F.collect_list(F.struct("__first", value)))
    return first.groupBy(*keys).agg(F.transform(listed, lambda p: p[value]).alias(out))


def longest_part(df: DataFrame, keys: Sequence[str], length: str, part: str) -> DataFrame:
    """Each key's longest part (ties: the least) and its length."""
    best = F.min_by(F.struct(part, length), F.struct(-finite(F.col(length)), F.col(part)))
    return df.filter(finite(F.col(length)).isNotNull()).groupBy(*keys).agg(best.alias("b")).select(*keys, f"b.{part}", f"b.{length}")


def least_or_zero(df: DataFrame, keys: Sequence[str], value: Column, out: str = "least") -> DataFrame:
    """The least finite value of each key, zero where there is none."""
    return df.groupBy(*keys).agg(F.coalesce(F.min(finite(value)), F.lit(0.0)).alias(out))


def surface_warns(source: Column, note: Column) -> Column:
    """Whether a water surface is a warning: none or clamped, extrapolated too far, a failed comparison, a single anchor."""
    n = F.coalesce(note, F.lit(""))
    return F.coalesce(source.isin("clamp", "none"), F.lit(False)) | n.contains("EXTRAP") | n.contains("QC dif") | n.startswith("single")


def coverage(df: DataFrame, keys: Sequence[str], surface: str) -> DataFrame:
    """Per campaign: transects, those without a water surface, and whether none has one (``relative``)."""
    without = finite(F.col(surface)).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(without).alias("n_without"), F.min(without).alias("relative"))


def require_coverage(df: DataFrame, surface: str, allow_relative: bool = False) -> None:
    """Raise where no transect at all has a water surface, unless relative beds are allowed; an empty table passes."""
    found = coverage(df, [], surface).first()
    if found.n and found.relative and not allow_relative:
        raise ValueError(f"none of the {found.n} transects has a water surface: every bed would be relative")


def forced_groups(results: DataFrame, member: str, manual: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(results in groups named by hand, names without a result, results in no such group).

    ``manual`` has ``member`` and ``group``; a member in two groups is a result of both.
    """
    named = manual.select(member, "group").dropDuplicates()
    missing = named.join(results.select(member).distinct(), member, "left_anti")
    return results.join(named, member), missing, results.join(named.select(member).distinct(), member, "left_anti")


def forced_line(df: DataFrame, wanted: str, lines: DataFrame, line: str, found: str) -> DataFrame:
    """Adds the line named by hand, whatever its case and accents, else the one ``found``; and whether a wish was not there.

    ``lines`` names every line of the network once; names that fold alike count as the least.
    """
    names = lines.groupBy(folded_name(F.col(line)).alias("__key")).agg(F.min(line).alias("__line"))
    rows = df.withColumn("__key", folded_name(F.col(wanted))).join(names, "__key", "left")
    ignored = F.col("__line").isNull() & (F.coalesce(F.col("__key"), F.lit("")) != "")
    return rows.withColumn("river", F.coalesce("__line", found)).withColumn("ignored", ignored).drop("__key", "__line")
