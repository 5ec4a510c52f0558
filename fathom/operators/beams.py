"""Beams of a cloud: spikes of each by itself, selection, profiles as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.operators.sequence import despike


def despike_beams(
    df: DataFrame, keys: Sequence[str], order: str, vertical: str, beams: str, half: int = 10, multiplier: float = 15.0, cycles: int = 3, n_beams: int = 4
) -> DataFrame:
    """``df`` with rejected depths of the vertical beam and of each slant beam set to null.

    Every beam is filtered by itself, so a bad return of one leaves the others. Rows are
    told apart by ``keys`` and ``order``; all other columns are kept. A missing beam is
    null; ``beams`` has ``n_beams`` elements afterwards.
    """
    depth = lambda k: F.col(vertical) if k == 0 else F.try_element_at(F.col(beams), F.lit(k))
    each = F.array(*(F.struct(F.lit(k).alias("__beam"), depth(k).cast("double").alias("__depth")) for k in range(n_beams + 1)))
    others = [c for c in df.columns if c not in (*keys, order, vertical, beams)]
    rest = F.struct(*(others or [F.lit(0).alias("none")])).alias("__rest")
    rows = df.select(*keys, order, rest, F.inline(each)).withColumnsRenamed({"__rest": "rest", "__beam": "beam", "__depth": "depth"})
    rows = despike(rows, [*keys, "beam"], order, "depth", half, multiplier, cycles, "valid")
    held = lambda k: F.max(F.when((F.col("beam") == k) & F.col("valid"), F.col("depth")))
    out = rows.groupBy(*keys, order).agg(
        F.first("rest").alias("__rest"), held(0).alias(vertical), F.array(*(held(k) for k in range(1, n_beams + 1))).alias(beams)
    )
    back = {c: F.col("__rest")[c].alias(c) for c in others}
    return out.select(*(back.get(c, F.col(c)) for c in df.columns))


def selected(cloud: DataFrame, beam_index: str, which: str = "all") -> DataFrame:
    """The points of ``all`` beams, of the vertical one (``vb``) or of the ``slant`` ones; collapsed points are in ``all`` only."""
    if which not in ("all", "vb", "slant"):
        raise ValueError(f"beams are all, vb or slant, not {which!r}")
    return cloud if which == "all" else cloud.filter(F.col(beam_index) == 0 if which == "vb" else F.col(beam_index) > 0)


def profile_table(df: DataFrame, s: str, depth: str, x0: Column, y0: Column, bearing: Column, surface: Column) -> DataFrame:
    """Adds the node's place on the axis (east, north) and its bed: the surface less the depth; null without a surface."""
    t = F.radians(bearing)
    return df.withColumns(
        {"east": x0 + F.col(s) * F.sin(t), "north": y0 + F.col(s) * F.cos(t), "bed": surface - F.col(depth)}
    )
