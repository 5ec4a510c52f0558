"""Parts of many rivers are merged within tasks; rivers of many parts by rounds that leave nothing behind."""

import os

import pytest
from pyspark.sql import functions as F

from fathom.operators import axes


def rivers(spark, n, parts):
    """``n`` rivers of a line of ``parts`` parts, each third drawn the other way, a ring of four and a part that closes itself."""
    line = spark.range(parts).select(F.col("id").alias("part"), F.col("id").cast("double").alias("x0"), (F.col("id") + 1.0).alias("x1"), F.lit(0.0).alias("y0"), F.lit(0.0).alias("y1"))
    ring = [(parts + 10 + k, 900.0 + (k in (1, 2)), 900.0 + (k in (0, 1)), float(k in (2, 3)), float(k in (1, 2))) for k in range(4)]
    every = line.unionAll(spark.createDataFrame(ring, line.schema))
    a, b = (F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y")) for k in (0, 1))
    ends = F.when(F.col("part") % 3 == 0, F.array(b, a)).otherwise(F.array(a, b))
    flat = every.select("part", F.posexplode(ends).alias("seq", "p")).select("part", "seq", "p.*")
    loop = spark.createDataFrame([(parts + 30, k, 700.0 + k % 2, 0.0) for k in range(3)], flat.schema)
    return spark.range(n).select(F.col("id").alias("river")).crossJoin(flat.unionAll(loop))


def merged(df):
    lines, places = axes.merged_lines(df)
    return sorted(map(tuple, lines.collect())), sorted(map(tuple, places.collect()))


@pytest.mark.parametrize("at_once", [10, 50_000])
def test_rivers_within_tasks_equal_rounds(spark, monkeypatch, at_once):
    df = rivers(spark, 7, 11).repartition(3)
    monkeypatch.setattr(axes, "PARTS_AT_ONCE", at_once)
    within = merged(df)
    monkeypatch.setattr(axes, "ONE_TASK_PARTS", 0)
    assert merged(df) == within and len(within[0]) == 21
    monkeypatch.setattr(axes, "ONE_TASK_PARTS", 11)
    some = df.filter("river < 3 or part < 11")
    mixed = merged(some)
    assert [r for r in mixed[0] if r[0] < 3] == [r for r in within[0] if r[0] < 3] and len(mixed[0]) == 13


@pytest.mark.parametrize("most", [0, 10_000])
def test_rounds_leave_no_states_behind(spark, monkeypatch, tmp_path, most):
    monkeypatch.setattr(axes, "ONE_TASK_PARTS", most)
    written = []
    keep = axes.cut
    monkeypatch.setattr(axes, "cut", lambda df: (out := keep(df), written.append(out))[0])
    axes.merged_lines(rivers(spark, 3, 40))
    there = [f.get() for d in written if os.path.exists((f := d._jdf.queryExecution().analyzed().rdd().getCheckpointFile()).get().removeprefix("file:"))]
    assert len(there) <= 8 and len(written) >= 4
