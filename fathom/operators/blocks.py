"""Running windows over keys of any size: blocks of rows with a halo instead of a task for each key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.sources.clouds import numbered

#: Rows of a block, besides its halo.
BLOCK_ROWS = 100_000


def in_blocks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    apply: Callable[[DataFrame, list[str], list[str]], DataFrame],
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """``apply(rows, keys, order)`` of a window that looks at most ``reach`` rows back and ahead, block by block.

    Rows are numbered densely by ``keys`` and ``order`` (which must tell rows apart) and cut
    into blocks of ``size``; the ``reach`` rows on both sides of a cut are copied across it,
    and their results there are dropped. So a key that holds a third of all rows is worked on
    by many tasks, each of which sees ``size`` rows and its halo, and the result is the same as
    over the whole key: a key's rows stay apart from other keys' in a block, and its true
    ends remain ends. ``apply`` gets two columns more and must keep them: the block among
    its keys and the number as its order.
    """
    if reach > size:
        raise ValueError(f"a block of {size} rows is shorter than the reach of {reach}")
    rows = numbered(df, [*keys, *order], "__place")
    block, at = F.floor(F.col("__place") / size).cast("long"), F.col("__place") % size
    places = F.array(
        F.struct(block.alias("__block"), F.lit(True).alias("__own")),
        F.when(at < reach, F.struct((block - 1).alias("__block"), F.lit(False).alias("__own"))),
        F.when(at >= size - reach, F.struct((block + 1).alias("__block"), F.lit(False).alias("__own"))),
    )
    dealt = rows.withColumn("__to", F.explode(F.filter(places, lambda p: p.isNotNull()))).select(*rows.columns, "__to.*")
    return apply(dealt, [*keys, "__block"], ["__place"]).filter("__own").drop("__own", "__block", "__place")
