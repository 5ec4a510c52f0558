"""Islands of a river: branches that leave and rejoin it together, named from left to right."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def island_numbers(df: DataFrame, river: Sequence[str], s0: str, s1: str, order: str, tolerance: float = 25.0) -> DataFrame:
    """Adds ``island``, from 0 in each river: that of the first island whose first branch leaves and rejoins within ``tolerance``.

    Branches go by ``s0``, ``s1`` and ``order``. A task folds over sorted rows and keeps the
    islands that a branch can still join, which are those that begin within ``tolerance`` of it.
    """
    places = df.columns.index(s0), df.columns.index(s1), [df.columns.index(c) for c in river]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, open_, number = None, [], 0
        for batch in batches:
            out = []
            keys = zip(*(batch.column(i).to_pylist() for i in places[2]))
            for key, a, b in zip(keys, batch.column(places[0]).to_pylist(), batch.column(places[1]).to_pylist()):
                if key != at:
                    at, open_, number = key, [], 0
                open_ = [f for f in open_ if a - f[0] <= tolerance]
                own = next((k for _, r1, k in open_ if abs(b - r1) <= tolerance), None)
                if own is None:
                    own, number = number, number + 1
                    open_.append((a, b, own))
                out.append(own)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "island"])

    schema = StructType([*df.schema.fields, StructField("island", IntegerType())])
    placed = df.filter(F.col(s0).isNotNull() & F.col(s1).isNotNull())
    return placed.repartition(*river).sortWithinPartitions(*river, s0, s1, order).mapInArrow(fold, schema)


def channels(df: DataFrame, river: Sequence[str], s0: str, s1: str, left: str, order: str, label: str, tolerance: float = 25.0) -> DataFrame:
    """Every channel of every island: river, island, ``order`` (null for the main), s0, s1 and its name.

    ``left`` says how far a branch lies to the left of the main, looking downstream. From the
    left the channels are MI, M2 and so on, MD; equal ones keep their order, the main first.
    A branch's own ``label`` stands. A branch without a place is in no island.
    """
    rows = island_numbers(df, river, s0, s1, order, tolerance).select(*river, "island", order, s0, s1, F.col(left).cast("double").alias("__left"), F.col(label).alias("__own"))
    mains = rows.groupBy(*river, "island").agg(F.avg(s0).alias(s0), F.avg(s1).alias(s1), F.lit(0.0).alias("__left"))
    every = rows.unionByName(mains, allowMissingColumns=True)
    island = Window.partitionBy(*river, "island")
    rank = F.row_number().over(island.orderBy(F.col("__left").desc(), F.col(order).asc_nulls_first()))
    n = F.count("*").over(island)
    named = F.when(rank == 1, "MI").when(rank == n, "MD").otherwise(F.concat(F.lit("M"), rank.cast("string")))
    own = F.when(F.col("__own") != "", F.col("__own"))
    return every.withColumn("channel", F.coalesce(own, named)).drop("__left", "__own")
