"""Ordered rows: running statistics, interpolation, smoothing, spikes, gaps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.aggregates import finite


def _quantile(sorted_values: Column, q: float) -> Column:
    """Linear quantile of a sorted array without nulls; null for an empty one."""
    at = (F.size(sorted_values) - 1) * q
    low = F.try_element_at(sorted_values, F.floor(at).cast("int") + 1)
    high = F.try_element_at(sorted_values, F.ceil(at).cast("int") + 1)
    return F.when(F.size(sorted_values) > 0, low + (high - low) * (at - F.floor(at)))


def running_iqr(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, half: int = 10, out: str = "iqr") -> DataFrame:
    """Adds the interquartile range of up to ``half`` rows on both sides, the row itself left out; null for fewer than four."""
    seq = Window.partitionBy(*keys).orderBy(*order)
    v = finite(F.col(value))
    beside = F.array_sort(F.concat(F.collect_list(v).over(seq.rowsBetween(-half, -1)), F.collect_list(v).over(seq.rowsBetween(1, half))))
    rows = df.withColumn("__beside", beside)
    iqr = F.when(F.size("__beside") >= 4, _quantile(F.col("__beside"), 0.75) - _quantile(F.col("__beside"), 0.25))
    return rows.withColumn(out, iqr).drop("__beside")


def running_median(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, width: int = 11, out: str = "smooth") -> DataFrame:
    """Adds the median of ``width`` rows around each; at the ends the first and last values are repeated."""
    half = width // 2
    group = Window.partitionBy(*keys)
    seq = group.orderBy(*order)
    v = F.col(value)
    rows = (
        df.withColumn("__i", F.row_number().over(seq))
        .withColumn("__n", F.count("*").over(group))
        .withColumn("__near", F.collect_list(v).over(seq.rowsBetween(-half, half)))
        .withColumn("__first", F.first(v).over(seq.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("__last", F.last(v).over(seq.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    before = F.array_repeat(F.col("__first"), F.greatest(half + 1 - F.col("__i"), F.lit(0)).cast("int"))
    after = F.array_repeat(F.col("__last"), F.greatest(F.col("__i") + half - F.col("__n"), F.lit(0)).cast("int"))
    rows = rows.withColumn("__near", F.array_sort(F.concat(before, "__near", after)))
    return rows.withColumn(out, _quantile(F.col("__near"), 0.5)).drop("__i", "__n", "__near", "__first", "__last")


def gap_interpolate(df: DataFrame, keys: Sequence[str], position: str, value: str, out: str = "filled") -> DataFrame:
    """Adds the value, or what the line between the nearest values on both sides gives; beyond the ends the nearest."""
    seq = Window.partitionBy(*keys).orderBy(position)
    v = finite(F.col(value))
    known = F.when(v.isNotNull(), F.struct(F.col(position).cast("double").alias("p"), v.alias("v")))
    back = Window.partitionBy(*keys).orderBy(F.col(position).desc())
    rows = df.withColumn("__lo", F.last(known, True).over(seq.rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "__hi", F.last(known, True).over(back.rowsBetween(Window.unboundedPreceding, 0))
    )
    span = F.col("__hi.p") - F.col("__lo.p")
    share = F.try_divide(F.col(position).cast("double") - F.col("__lo.p"), span)
    line = F.col("__lo.v") + (F.col("__hi.v") - F.col("__lo.v")) * share
    return rows.withColumn(out, F.coalesce(v, line, "__lo.v", "__hi.v")).drop("__lo", "__hi")


def asof_interpolate(points: DataFrame, series: DataFrame, keys: Sequence[str], at: str, value: str, out: str) -> DataFrame:
    """``points`` with the value of ``series`` interpolated at ``at``, held at the ends.

    Both have the columns ``keys`` and ``at``. One union and one sort per key; equal
    places in the series are averaged first.
    """
    known = series.select(*keys, F.col(at).cast("double").alias("__at"), finite(F.col(value)).alias("__v")).filter("__v is not null")
    known = known.groupBy(*keys, "__at").agg(F.avg("__v").alias("__v"))
    asked = points.withColumn("__at", F.col(at).cast("double"))
    both = asked.withColumn("__v", F.lit(None).cast("double")).withColumn("__asked", F.lit(True)).unionByName(
        known.withColumn("__asked", F.lit(False)), allowMissingColumns=True
    )
    seq = Window.partitionBy(*keys).orderBy("__at")
    back = Window.partitionBy(*keys).orderBy(F.col("__at").desc())
    here = F.when(F.col("__v").isNotNull(), F.struct(F.col("__at").alias("p"), F.col("__v").alias("v")))
    both = both.withColumn("__lo", F.last(here, True).over(seq.rangeBetween(Window.unboundedPreceding, 0))).withColumn(
        "__hi", F.last(here, True).over(back.rangeBetween(Window.unboundedPreceding, 0))
    )
    share = F.try_divide(F.col("__at") - F.col("__lo.p"), F.col("__hi.p") - F.col("__lo.p"))
    line = F.col("__lo.v") + (F.col("__hi.v") - F.col("__lo.v")) * share
    filled = both.withColumn(out, F.coalesce(line, "__lo.v", "__hi.v")).filter("__asked")
    return filled.drop("__at", "__v", "__asked", "__lo", "__hi")


def smoothing_weights(width: int) -> list[list[float]]:
    """Quadratic least-squares weights: row k gives the fitted value at place k of ``width`` places."""
    import numpy as np

    x = np.arange(width) - width // 2
    design = np.stack([x**0, x, x**2], axis=1).astype(float)
    return (design @ np.linalg.pinv(design)).tolist()


def smooth(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, width: int = 5, out: str = "smooth") -> DataFrame:
    """Adds the value of the quadratic fitted to ``width`` rows around each; the end rows lie on the ends' fits.

    A group of fewer rows keeps its values.
    """
    half, weights = width // 2, smoothing_weights(width)
    group = Window.partitionBy(*keys)
    seq = group.orderBy(*order)
    rows = (
        df.withColumn("__i", F.row_number().over(seq) - 1)
        .withColumn("__n", F.count("*").over(group))
        .withColumn("__at", F.greatest(F.lit(0), F.least(F.col("__i") - half, F.col("__n") - width)))
        .withColumn("__near", F.collect_list(F.col(value)).over(seq.rowsBetween(-(width - 1), width - 1)))
    )
    begin = F.greatest(F.col("__i") - (width - 1), F.lit(0))
    part = F.slice("__near", (F.col("__at") - begin + 1).cast("int"), width)
    table = F.array(*(F.array(*map(F.lit, w)) for w in weights))
    row = F.try_element_at(table, (F.col("__i") - F.col("__at") + 1).cast("int"))
    fitted = F.aggregate(F.zip_with(part, row, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return rows.withColumn(out, F.when(F.col("__n") >= width, fitted).otherwise(F.col(value))).drop("__i", "__n", "__at", "__near")


def despike(
    df: DataFrame, keys: Sequence[str], order: str, value: str, half: int = 10, multiplier: float = 15.0, cycles: int = 3, out: str = "valid",
    positive: bool = True, at_least: int = 5,
) -> DataFrame:
    """Adds whether each value holds against a running median.

    A cycle fills gaps, smooths, and rejects rows whose residual exceeds the greatest of
    ``multiplier`` times the residuals' running interquartile range, 5 per cent of the
    value and 0.1. The first cycle sees non-positive values, later ones only what holds.
    Groups with fewer than ``at_least`` positive values are not filtered. Without ``positive``
    zero and negative values may hold and count like any other. ``order`` is a row number
    within the group or any distinct number.
    """
    group = Window.partitionBy(*keys)
    d = finite(F.col(value))
    rows = df.withColumn("__place", F.row_number().over(group.orderBy(order)).cast("double"))
    rows = rows.withColumn("__valid", d.isNotNull() & (d > 0) if positive else d.isNotNull()).withColumn("__work", d)
    rows = rows.withColumn("__enough", F.count_if("__valid").over(group) >= at_least)
    width = max(3, 2 * (half // 2) + 1)
    rows = rows.withColumn("__go", F.col("__enough"))
    for _ in range(max(1, cycles)):
        rows = gap_interpolate(rows, keys, "__place", "__work", "__filled")
        rows = running_median(rows, keys, ["__place"], "__filled", width, "__smooth")
        rows = rows.withColumn("__res", F.col("__filled") - F.col("__smooth"))
        rows = running_iqr(rows, keys, ["__place"], "__res", half, "__iqr")
        limit = F.greatest(F.col("__iqr") * multiplier, 0.05 * F.abs("__filled"), F.lit(0.10))
        known = F.count("__work").over(group) >= 3
        rows = rows.withColumn("__bad", F.col("__go") & known & (F.abs("__res") > limit))
        rows = rows.withColumn("__go", F.col("__go") & (F.count_if(F.col("__bad") & F.col("__valid")).over(group) > 0))
        rows = rows.withColumn("__valid", F.col("__valid") & ~(F.col("__bad") & F.col("__go")))
        rows = rows.withColumn("__work", F.when(F.col("__go"), F.when(F.col("__valid"), d)).otherwise(F.col("__work")))
    return rows.withColumn(out, F.col("__valid")).drop(*(c for c in rows.columns if c.startswith("__")))


def rises(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """The rows after which the value rises by more than ``tolerance``, with the ``rise``."""
    seq = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rise", F.lead(value).over(seq) - F.col(value)).filter(F.col("rise") > tolerance)


def gap_sessions(df: DataFrame, keys: Sequence[str], position: str, factor: float = 3.0, least: float = 0.0, out: str = "session") -> DataFrame:
    """Adds a session number from 0: a new one after a gap above ``factor`` times the median gap and above ``least``."""
    group = Window.partitionBy(*keys)
    seq = group.orderBy(position)
    rows = df.withColumn("__gap", F.col(position).cast("double") - F.lag(F.col(position).cast("double")).over(seq))
    rows = rows.withColumn("__limit", F.greatest(factor * F.percentile("__gap", F.lit(0.5)).over(group), F.lit(least)))
    cut = F.coalesce((F.col("__gap") > F.col("__limit")).cast("int"), F.lit(0))
    return rows.withColumn(out, F.sum(cut).over(seq.rowsBetween(Window.unboundedPreceding, 0))).drop("__gap", "__limit")


def run_starts(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "starts") -> DataFrame:
    """Adds whether the value differs from the row before."""
    seq = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, ~F.col(value).eqNullSafe(F.lag(value).over(seq)) | (F.row_number().over(seq) == 1))


def monotone_slopes(series: DataFrame, keys: Sequence[str], at: str, value: str, out: str = "slope") -> DataFrame:
    """Adds the derivative that keeps a cubic through the points monotone between them.

    Inside: the harmonic mean of both secants, weighted by the spans, or zero where they
    differ in sign. Ends: a one-sided three-point estimate, zero against the first
    secant's sign and at most three times it where the secants differ in sign. Two points
    give their secant.
    """
    seq = Window.partitionBy(*keys).orderBy(at)
    x, y = F.col(at).cast("double"), F.col(value).cast("double")
    rows = series.withColumn("__h", F.lead(x).over(seq) - x).withColumn("__m", (F.lead(y).over(seq) - y) / F.col("__h"))
    for n, name in ((1, "__h"), (1, "__m"), (2, "__h"), (2, "__m")):
        rows = rows.withColumn(f"{name}_{n}b", F.lag(name, n).over(seq))
    rows = rows.withColumn("__h_1a", F.lead("__h").over(seq)).withColumn("__m_1a", F.lead("__m").over(seq))

    def end(h0: Column, h1: Column, m0: Column, m1: Column) -> Column:
        d = F.try_divide((2 * h0 + h1) * m0 - h0 * m1, h0 + h1)
        return (
            F.when(m1.isNull(), m0)
            .when(F.signum(d) != F.signum(m0), F.lit(0.0))
            .when((F.signum(m0) != F.signum(m1)) & (F.abs(d) > 3 * F.abs(m0)), 3 * m0)
            .otherwise(d)
        )

    c = F.col
    w1, w2 = 2 * c("__h") + c("__h_1b"), c("__h") + 2 * c("__h_1b")
    inside = F.when(c("__m") * c("__m_1b") <= 0, F.lit(0.0)).otherwise((w1 + w2) / (w1 / c("__m_1b") + w2 / c("__m")))
    slope = (
        F.when(c("__h_1b").isNull(), end(c("__h"), c("__h_1a"), c("__m"), c("__m_1a")))
        .when(c("__h").isNull(), end(c("__h_1b"), c("__h_2b"), c("__m_1b"), c("__m_2b")))
        .otherwise(inside)
    )
    return rows.withColumn(out, F.coalesce(slope, F.lit(0.0))).drop(*(n for n in rows.columns if n.startswith("__")))


def monotone_interpolate(points: DataFrame, series: DataFrame, keys: Sequence[str], at: str, value: str, out: str) -> DataFrame:
    """``points`` with the monotone cubic through ``series`` at ``at``; null outside its range.

    Both have the columns ``keys`` and ``at``; places in the series are distinct.
    """
    known = monotone_slopes(series.filter(finite(F.col(value)).isNotNull()), keys, at, value, "__d")
    known = known.select(*keys, F.col(at).cast("double").alias("__at"), F.col(value).cast("double").alias("__v"), "__d")
    asked = points.withColumn("__at", F.col(at).cast("double")).withColumn("__asked", F.lit(True))
    both = asked.unionByName(known.withColumn("__asked", F.lit(False)), allowMissingColumns=True)
    seq = Window.partitionBy(*keys).orderBy("__at")
    back = Window.partitionBy(*keys).orderBy(F.col("__at").desc())
    here = F.when(~F.col("__asked"), F.struct("__at", "__v", "__d"))
    both = both.withColumn("__lo", F.last(here, True).over(seq.rangeBetween(Window.unboundedPreceding, 0))).withColumn(
        "__hi", F.last(here, True).over(back.rangeBetween(Window.unboundedPreceding, 0))
    )
    h = F.col("__hi.__at") - F.col("__lo.__at")
    t = F.coalesce(F.try_divide(F.col("__at") - F.col("__lo.__at"), h), F.lit(0.0))
    cubic = (
        (1 + 2 * t) * (1 - t) * (1 - t) * F.col("__lo.__v")
        + t * (1 - t) * (1 - t) * h * F.col("__lo.__d")
        + t * t * (3 - 2 * t) * F.col("__hi.__v")
        + t * t * (t - 1) * h * F.col("__hi.__d")
    )
    return both.withColumn(out, cubic).filter("__asked").drop("__at", "__v", "__d", "__asked", "__lo", "__hi")
