"""Aggregates over groups: medians, directions, weights, extents, fits.

Functions take a DataFrame and column names and return one row per group, or the rows
with a column added where they say so. Null and NaN values take no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def weighted_median(df: DataFrame, keys: Sequence[str], value: str, weight: str, out: str = "median") -> DataFrame:
    """Least value whose cumulative weight reaches half the group's; the plain median where no weight is positive.

    Equal values are summed before they are ordered, so what is sorted is the distinct values.
    """
    v, w = finite(F.col(value)), F.coalesce(finite(F.col(weight)), F.lit(0.0))
    sums = (
        df.select(*keys, v.alias("__v"), w.alias("__w"))
        .filter("__v is not null")
        .groupBy(*keys, "__v")
        .agg(F.sum("__w").alias("__w"), F.count("*").alias("__n"))
    )
    group = Window.partitionBy(*keys)
    upto = group.orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(
        *keys,
        "__v",
        F.sum("__w").over(upto).alias("__cw"),
        F.sum("__w").over(group).alias("__tw"),
        F.sum("__n").over(upto).alias("__cn"),
        F.sum("__n").over(group).alias("__tn"),
    )
    least = lambda c: F.min(F.when(c, F.col("__v")))
    plain = (least(F.col("__cn") * 2 >= F.col("__tn")) + least(F.col("__cn") * 2 > F.col("__tn"))) / 2
    return sums.groupBy(*keys).agg(
        F.coalesce(least((F.col("__tw") > 0) & (F.col("__cw") >= 0.5 * F.col("__tw"))), plain).alias(out)
    )


def resultant_azimuth(df: DataFrame, keys: Sequence[str], east: str, north: str, weight: str) -> DataFrame:
    """Direction of the weighted sum of finite, non-zero vectors and the section at right angles to it.

    Non-positive weights count as none; where all are, every vector counts one.
    """
    e, n = finite(F.col(east)), finite(F.col(north))
    w = F.greatest(F.coalesce(finite(F.col(weight)), F.lit(0.0)), F.lit(0.0))
    rows = df.select(*keys, e.alias("__e"), n.alias("__n"), w.alias("__w")).filter("__e is not null and __n is not null and (__e <> 0 or __n <> 0)")
    sums = rows.groupBy(*keys).agg(
        F.sum("__w").alias("__w"),
        *(F.sum(F.col(c) * F.col("__w")).alias(f"__w{c}") for c in ("__e", "__n")),
        *(F.sum(c).alias(f"__s{c}") for c in ("__e", "__n")),
        F.count("*").alias("n_vectors"),
    )
    pick = lambda c: F.when(F.col("__w") > 0, F.col(f"__w{c}")).otherwise(F.col(f"__s{c}"))
    flow = F.pmod(F.degrees(F.atan2(pick("__e"), pick("__n"))), F.lit(360.0))
    return sums.select(
        *keys, flow.alias("flow_azimuth"), F.pmod(flow + 90, F.lit(360.0)).alias("section_azimuth"), "n_vectors"
    )


def interval_weights(df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, y: str, out: str = "weight") -> DataFrame:
    """Adds half the distance to both neighbours, at most three times its 95th percentile, as a weight of mean one.

    Points without distance get 0.05. A group without any distance gets ones.
    """
    seq, group = Window.partitionBy(*keys).orderBy(*order), Window.partitionBy(*keys)
    px, py = finite(F.col(x)), finite(F.col(y))
    step = F.coalesce(F.hypot(px - F.lag(px).over(seq), py - F.lag(py).over(seq)), F.lit(0.0))
    rows = df.withColumn("__step", step)
    half = (F.col("__step") + F.coalesce(F.lead("__step").over(seq), F.lit(0.0))) / 2
    rows = rows.withColumn("__half", half)
    positive = F.when(F.col("__half") > 0, F.col("__half"))
    rows = rows.withColumn("__cap", 3 * F.percentile(positive, F.lit(0.95)).over(group))
    rows = rows.withColumn("__half", F.least("__half", "__cap"))
    mean = F.avg(F.when(F.col("__half") > 0, F.col("__half"))).over(group)
    weight = F.when(mean.isNull(), F.lit(1.0)).when(F.col("__half") > 0, F.col("__half") / mean).otherwise(F.lit(0.05))
    return rows.withColumn(out, weight).drop("__step", "__half", "__cap")


def unit_discharge_weights(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, y: str, depth: str, out: str = "weight", positive: bool = True
) -> DataFrame:
    """Adds the interval weight times the depth, where a missing depth is the group's median.

    With ``positive`` a depth of zero or less is missing too, else it counts as it is.
    """
    rows = interval_weights(df, keys, order, x, y, "__interval")
    d = finite(F.col(depth))
    d = F.when(d > 0, d) if positive else d
    middle = F.percentile(d, F.lit(0.5)).over(Window.partitionBy(*keys))
    return rows.withColumn(out, F.col("__interval") * F.coalesce(d, middle)).drop("__interval")


def beam_average(beams: Column, draft: Column, method: str = "idw", at_least: int = 2) -> Column:
    """Average of the valid beams of an array: weights 1 - r / sum(r), or the plain mean.

    Null where fewer than ``at_least`` beams are valid or nothing is added to the draft.
    """
    good = F.filter(beams, lambda b: b.isNotNull() & ~F.isnan(b) & (b > 0))
    total = F.aggregate(good, F.lit(0.0), lambda a, b: a + (b - draft))
    if method == "simple":
        mean = F.aggregate(good, F.lit(0.0), lambda a, b: a + b) / F.size(good)
    else:
        weight = lambda b: 1 - (b - draft) / total
        top = F.aggregate(good, F.lit(0.0), lambda a, b: a + weight(b) * (b - draft))
        bottom = F.aggregate(good, F.lit(0.0), lambda a, b: a + weight(b))
        mean = draft + F.try_divide(top, bottom)
    return F.when((F.size(good) >= at_least) & (mean != draft), mean)


def last_finite(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """The last finite value of each column by ``order``."""
    return df.groupBy(*keys).agg(
        *(F.max_by(finite(F.col(v)), F.when(finite(F.col(v)).isNotNull(), F.col(order))).alias(v) for v in values)
    )


def spread_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, sample deviation, its share of the mean in per cent, least and greatest; the middle two null for one value."""
    v = finite(F.col(value))
    sd = F.when(F.count(v) > 1, F.stddev_samp(v))
    return df.groupBy(*keys).agg(
        F.avg(v).alias("mean"),
        sd.alias("sd"),
        F.try_divide(100 * sd, F.abs(F.avg(v))).alias("cv_percent"),
        F.min(v).alias("least"),
        F.max(v).alias("greatest"),
        F.count(v).alias("n"),
    )


def measured_extent(df: DataFrame, keys: Sequence[str], repetition: Sequence[str], s: str, at_least: int = 3, mode: str = "mean") -> DataFrame:
    """Where a group's repetitions begin and end: mean of their least and greatest ``s``.

    Repetitions of fewer than ``at_least`` points do not count unless all are so; mode
    ``max`` takes the least and greatest of all points.
    """
    v = finite(F.col(s))
    each = df.groupBy(*keys, *repetition).agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"))
    good = F.col("n") >= at_least
    pick = lambda c, f: F.coalesce(F.avg(F.when(good, F.col(c))), f(c)) if mode == "mean" else f(c)
    return each.groupBy(*keys).agg(
        pick("lo", F.min).alias("extent_from"),
        pick("hi", F.max).alias("extent_to"),
        F.count_if(good).alias("n_counted"),
        (F.max("lo") - F.min("lo")).alias("from_spread"),
        (F.max("hi") - F.min("hi")).alias("to_spread"),
    )


def slope_fit(df: DataFrame, keys: Sequence[str], x: str, y: str, min_span: float) -> DataFrame:
    """Least-squares slope of y on x; null for fewer than two points or a span below ``min_span``."""
    a, b = finite(F.col(x)), finite(F.col(y))
    both = F.when(b.isNotNull(), a)
    span = F.max(both) - F.min(both)
    return df.groupBy(*keys).agg(
        F.when((F.count(both) >= 2) & (span >= min_span), F.regr_slope(b, a)).alias("slope"),
        span.alias("span"),
        F.count(both).alias("n"),
    )


def gap_weighted_mean(df: DataFrame, keys: Sequence[str], value: str, gap: str) -> DataFrame:
    """Mean weighted by one over the gap (at least one), and the spread of the values."""
    w = 1 / F.greatest(finite(F.col(gap)), F.lit(1.0))
    v = finite(F.col(value))
    w = F.when(v.isNotNull(), w)
    return df.groupBy(*keys).agg((F.sum(v * w) / F.sum(w)).alias("mean"), (F.max(v) - F.min(v)).alias("spread"))


def tally(df: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Number of rows, distinct categories sorted and joined, and the most frequent (ties: the least)."""
    counts = df.groupBy(*keys, category).agg(F.count("*").alias("n"))
    return counts.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.array_join(F.array_sort(F.collect_set(category)), "; ").alias("categories"),
        F.min_by(category, F.struct(-F.col("n"), F.col(category))).alias("most_frequent"),
    )


def thalweg(df: DataFrame, keys: Sequence[str], depth: str, surface: str, s: str) -> DataFrame:
    """Lowest bed where there is water (else lowest of all), greatest depth and width."""
    bed, d = finite(F.col(surface)) - finite(F.col(depth)), finite(F.col(depth))
    return df.groupBy(*keys).agg(
        F.coalesce(F.min(F.when(d > 1e-6, bed)), F.min(bed)).alias("thalweg"),
        F.max(d).alias("max_depth"),
        (F.max(s) - F.min(s)).alias("width"),
    )


def repeatability(df: DataFrame, keys: Sequence[str], repetition: str, node: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Per node: mean, population deviation and whether all repetitions have it; per repetition: RMS against the mean.

    ``df`` has one value per repetition and node.
    """
    v = finite(F.col(value))
    total = df.filter(v.isNotNull()).groupBy(*keys).agg(F.count_distinct(repetition).alias("n_repetitions"))
    nodes = (
        df.groupBy(*keys, node)
        .agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("sigma"), F.count(v).alias("n"))
        .join(total, list(keys))
        .withColumn("common", F.col("n") == F.col("n_repetitions"))
    )
    rms = (
        df.withColumn("__v", v)
        .join(nodes.select(*keys, node, "mean"), [*keys, node])
        .groupBy(*keys, repetition)
        .agg(F.sqrt(F.avg(F.pow(F.col("__v") - F.col("mean"), 2))).alias("rms"), F.count("__v").alias("n"))
    )
    return nodes, rms


def null_share_gate(df: DataFrame, keys: Sequence[str], bad: Column, at_most: float) -> DataFrame:
    """The rows of the groups in which at most ``at_most`` of the rows are bad."""
    kept = df.groupBy(*keys).agg(F.avg(bad.cast("double")).alias("share")).filter(F.col("share") <= at_most)
    return df.join(kept.select(*keys), list(keys), "left_semi")


def resampled(profiles: DataFrame, keys: Sequence[str], rep: str, s: str, value: str, nodes: DataFrame, out: str = "resampled") -> DataFrame:
    """Every repetition's ``value`` at the ``nodes`` (``keys``, ``s``) of its group's merged profile: nodes, ``rep`` and ``out``.

    Linear between a repetition's own places and never beyond them; equal places are
    averaged. A repetition with fewer than two places has no row.
    """
    from fathom.operators import sequence

    known = profiles.withColumns({s: F.col(s).cast("double"), value: finite(F.col(value))}).filter(F.col(value).isNotNull() & F.col(s).isNotNull())
    reach = known.groupBy(*keys, rep).agg(F.min(s).alias("__lo"), F.max(s).alias("__hi"))
    inside = (F.col("__lo") < F.col("__hi")) & F.col(s).between(F.col("__lo"), F.col("__hi"))
    asked = nodes.withColumn(s, F.col(s).cast("double")).join(reach, list(keys)).filter(inside).drop("__lo", "__hi")
    return sequence.asof_interpolate(asked, known, [*keys, rep], s, value, out)


def node_spread(rows: DataFrame, keys: Sequence[str], node: str, rep: str, value: str, repetitions: DataFrame) -> DataFrame:
    """Per node of resampled rows: n, sigma (population) and ``common``: all of the group's ``repetitions`` (keys, rep) reach it."""
    every = repetitions.groupBy(*keys).agg(F.count_distinct(rep).alias("__n"))
    per = rows.groupBy(*keys, node).agg(F.count(value).alias("n"), F.stddev_pop(value).alias("sigma"))
    return per.join(every, list(keys)).select(*keys, node, "n", "sigma", (F.col("n") == F.col("__n")).alias("common"))


def repetition_misfit(rows: DataFrame, keys: Sequence[str], rep: str, value: str, merged: str) -> DataFrame:
    """Root mean square of each repetition's resampled values against the merged profile's, over the nodes that it reaches."""
    square = F.pow(F.col(value) - F.col(merged), 2)
    return rows.groupBy(*keys, rep).agg(F.count(value).alias("n"), F.sqrt(F.avg(square)).alias("rms"))
