"""Ordered grouping: runs held together by their first member."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def leader_runs(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], joins: Callable[[dict, dict], bool], out: str = "run"
) -> DataFrame:
    """Adds the number of each row's run, from 0, by ``order`` within ``keys``.

    A row joins the run before it iff ``joins(leader, row)`` holds for the run's first
    row; else it starts a run and leads it. ``joins`` is given the values of ``order`` and
    ``columns`` by name, nulls as not-a-number. That is a fold over sorted rows: a task
    keeps one leader and hands every batch on, so a key may hold any number of rows.
    """
    fields = list(dict.fromkeys([*order, *columns]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leader, number = None, None, -1
        for batch in batches:
            numbers = []
            of = zip(*(batch.column(k).to_pylist() for k in keys))
            values = zip(*([float("nan") if v is None else v for v in batch.column(f).to_pylist()] for f in fields))
            for own, row in zip(of, values):
                row = dict(zip(fields, row))
                if own != key:
                    key, leader, number = own, None, -1
                if leader is None or not joins(leader, row):
                    leader, number = row, number + 1
                numbers.append(number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int32())], names=[*batch.schema.names, out])

    schema = StructType([*df.schema.fields, StructField(out, IntegerType())])
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def group_names(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Name and size of each group: the least member's name, with the number of members if several."""
    n = F.count("*")
    return df.groupBy(*keys).agg(
        F.when(n > 1, F.concat(F.min(name), F.lit("_x"), n.cast("string"))).otherwise(F.min(name)).alias("group_id"), n.alias("n_members")
    )


def coincident(df: DataFrame, keys: Sequence[str], s: str, value: str, tolerance: float) -> DataFrame:
    """Merge points within ``tolerance`` of a run's first: first place, mean value and number."""
    runs = leader_runs(df.select(*keys, s, value), keys, [s, value], [], lambda a, b: b[s] - a[s] <= tolerance)
    return runs.groupBy(*keys, "run").agg(F.min(s).alias("place"), F.avg(value).alias("mean"), F.count("*").alias("n"))


def thinned(df: DataFrame, keys: Sequence[str], x: str, y: str | None, cell: float, order: Sequence[str]) -> DataFrame:
    """The first row by ``order`` of every square cell."""
    from pyspark.sql import Window

    places = [F.floor(F.col(c) / cell) for c in (x, y) if c]
    first = F.row_number().over(Window.partitionBy(*keys, *places).orderBy(*order))
    return df.withColumn("__k", first).filter("__k = 1").drop("__k")


def decimated(df: DataFrame, position: str, every: int) -> DataFrame:
    return df.filter(F.col(position) % every == 0)


def track_class(axis_span: Column, offset_span: Column, end_span: Column, override: Column | None = None) -> Column:
    """What a track is: an override; still; unplaced; along the axis; across it; else other."""
    found = (
        F.when(end_span < 30, "estatico")
        .when(axis_span.isNull(), "otro")
        .when(axis_span > F.greatest(F.lit(50.0), 2 * offset_span), "longitudinal")
        .when((axis_span > 30) | (offset_span > 30), "aproximacion")
        .otherwise("otro")
    )
    return found if override is None else F.coalesce(override, found)
