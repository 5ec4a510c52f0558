"""Direction of flow of a section: which ensembles count, by what weight, and of several repetitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.angles import undirected_difference
from fathom.operators import aggregates

#: Fixed value: the step of an ensemble that was taken on the way from bank to bank.
IN_TRANSIT = 3


def in_transit(df: DataFrame, keys: Sequence[str], step: str, at_least: int = 5) -> DataFrame:
    """The ensembles taken in transit, of groups that have ``at_least`` of them; of the other groups all.

    A null step is not in transit; rows with a null key are in no group and go.
    """
    counts = df.groupBy(*keys).agg(F.count_if(F.col(step) == IN_TRANSIT).alias("__moving"))
    few = F.col("__moving") < at_least
    return df.join(counts, list(keys)).filter(few | (F.col(step) == IN_TRANSIT)).drop("__moving")


def weighted(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], x: str, y: str, depth: str, weighting: str = "discharge", out: str = "weight"
) -> DataFrame:
    """Adds each ensemble's weight: of unit ``discharge``, of the ``density`` of ensembles, or ``none`` (1)."""
    if weighting == "none":
        return df.withColumn(out, F.lit(1.0))
    if weighting == "density":
        return aggregates.interval_weights(df, keys, order, x, y, out)
    if weighting == "discharge":
        return aggregates.unit_discharge_weights(df, keys, order, x, y, depth, out)
    raise ValueError(f"weighting is discharge, density or none, not {weighting!r}")


def direction(df: DataFrame, keys: Sequence[str], east: str, north: str, weight: str, step: str, at_least: int = 5) -> DataFrame:
    """flow_azimuth, section_azimuth and n_vectors of each group, from its ensembles in transit if there are enough."""
    return aggregates.resultant_azimuth(in_transit(df, keys, step, at_least), keys, east, north, weight)


def group_direction(
    df: DataFrame, group: Sequence[str], member: str, east: str, north: str, weight: str, step: str, tolerance: float = 25.0
) -> DataFrame:
    """Direction of the pooled vectors of a group's repetitions, and how far the repetitions stray from it.

    Vectors are pooled, not one angle a repetition, so a longer repetition counts for more.
    ``worst`` is the greatest angle between a repetition's own section and the group's,
    ``strays`` the repetitions beyond ``tolerance`` in order, ``agrees`` whether there is none.
    A repetition whose vectors are all still has no direction and does not count. The list
    is as long as a group has repetitions.
    """
    both = [*group, member]
    pooled = aggregates.resultant_azimuth(in_transit(df, both, step, 1), group, east, north, weight)
    own = direction(df, both, east, north, weight, step).select(*both, F.col("section_azimuth").alias("__own"))
    angle = undirected_difference(F.col("__own"), F.col("section_azimuth"))
    return (
        pooled.join(own, list(group))
        .withColumn("__angle", angle)
        .groupBy(*group, "flow_azimuth", "section_azimuth", "n_vectors")
        .agg(
            F.max("__angle").alias("worst"),
            F.array_sort(F.collect_list(F.when(F.col("__angle") > tolerance, F.col(member)))).alias("strays"),
            (F.max("__angle") <= tolerance).alias("agrees"),
        )
    )


def implausible(df: DataFrame, keys: Sequence[str], candidate: str, distance: str, declared: Column, tolerance: float = 1000.0) -> DataFrame:
    """Whether points lie where their declared reference system puts them.

    ``df`` has the distance of every point to the network under every candidate system.
    Returns per group the median under the declared system (``declared_m``), whether it is
    within ``tolerance`` (``plausible``) and, where not, the candidate with the least
    median if that is within it (``better``, ``better_m``). A group without finite
    distances under the declared system is plausible.
    """
    medians = df.groupBy(*keys, candidate).agg(F.percentile(aggregates.finite(F.col(distance)), F.lit(0.5)).alias("__m"))
    named = F.col(candidate) == declared
    found = medians.groupBy(*keys).agg(
        F.max(F.when(named, F.col("__m"))).alias("declared_m"),
        F.min(F.when(~named & F.col("__m").isNotNull(), F.struct("__m", candidate))).alias("__b"),
    )
    plausible = F.coalesce(F.col("declared_m") <= tolerance, F.lit(True))
    better = ~F.col("plausible") & (F.col("__b.__m") <= tolerance)
    return found.withColumn("plausible", plausible).select(
        *keys, "declared_m", "plausible", F.when(better, F.col(f"__b.{candidate}")).alias("better"), F.when(better, F.col("__b.__m")).alias("better_m")
    )
