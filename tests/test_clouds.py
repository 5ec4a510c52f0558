"""Dense numbers, tables of clouds and levels, recorded runs, and repetitions on a merged grid."""

import csv
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import aggregates, blocks, sequence
from fathom.sources import clouds


@pytest.mark.parametrize("partitions", [1, 7])
def test_numbers_are_dense_and_in_order(spark, partitions):
    rows = spark.range(5000).select((F.hash("id") % 40).alias("k"), F.col("id").alias("i"), F.lit("z").alias("part"))
    got = clouds.numbered(rows, ["k", "i"], first=1, partitions=partitions)
    want = sorted((r.k, r.i) for r in rows.collect())
    assert [(r.k, r.i) for r in sorted(got.collect(), key=lambda r: r.pt_id)] == want
    assert sorted(r.pt_id for r in got.select("pt_id").collect()) == list(range(1, 5001))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, got.collect()))
    one = clouds.numbered(rows.withColumn("k", F.lit(1)), ["k", "i"], partitions=partitions)  # one key has all rows
    assert one.filter("pt_id <> i").count() == 0
    assert clouds.numbered(rows.limit(0), ["k", "i"]).count() == 0


def test_track_cloud(spark):
    rows = [("f2", 1, 0, 2, 1000.4, 3.5, None), ("f1", 2, 3, 1, None, 2.5, "x"), ("f1", 2, 0, 1, math.nan, 1.5, "y")]
    points = spark.createDataFrame(rows, "file string, ens int, beam_index int, source int, khz double, depth double, flag string")
    out = clouds.track_cloud(points)
    assert out.columns == list(clouds.TRACK_COLUMNS)
    got = [(r.pt_id, r.file, r.beam_id, r.beam_type, r.src, r.freq_khz, r.depth, r.flag, r.river) for r in out.orderBy("pt_id").collect()]
    assert got == [(0, "f1", "VB", "vert", "BT", 0, 1.5, "y", None), (1, "f1", "B3", "slant", "BT", 0, 2.5, "x", None), (2, "f2", "VB", "vert", "VB", 1000, 3.5, None, None)]


def test_surface_table(spark):
    points = spark.createDataFrame([("gnss", "p1", 12.345, 250.1234, math.nan)], "kind string, id string, km_internal_m double, elev_m double, x double")
    junction = spark.createDataFrame([("junction", "J:a@10", None, "mean of two")], "kind string, id string, elev_m double, note string")
    rows = {r.id: r for r in clouds.surface_table(points, junction).collect()}
    assert tuple(rows["p1"])[:4] == ("gnss", "p1", "", "12.35" if f"{12.345:.2f}" == "12.35" else "12.35") and rows["p1"].elev_m == "250.123" and rows["p1"].x == ""
    assert rows["J:a@10"].elev_m == "" and rows["J:a@10"].note == "mean of two"


def test_a_run_is_counted_as_it_is_written(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def once(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    log = ["[warn] a", " [error] b WARN", "plain", None, "x WARN y", "[WARN] z"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(log)], "id int, line string").mapInArrow(once, "id int, line string")
    counters = clouds.warning_counters("line") | {"most": F.max("id")}
    record = clouds.write_recorded(rows, str(tmp_path / "out"), str(tmp_path / "record"), counters, {"run": "r1", "dx": 0.5})
    assert {k: record[k] for k in ("rows", "errors", "warnings", "others", "most", "run", "dx")} == {"rows": 6, "errors": 1, "warnings": 3, "others": 2, "most": 5, "run": "r1", "dx": 0.5}
    assert seen.value == 6  # one pass
    lines = spark.read.text(str(tmp_path / "record")).collect()
    assert len(lines) == 1 and json.loads(lines[0].value)["warnings"] == 3 and spark.read.parquet(str(tmp_path / "out")).count() == 6
    empty = clouds.write_recorded(rows.limit(0), str(tmp_path / "none"), str(tmp_path / "none_record"), counters, form="csv")
    assert empty["rows"] == 0 and empty["warnings"] == 0


def test_repetitions_on_the_merged_grid(spark):
    rng = np.random.default_rng(2)
    own = {rep: np.sort(rng.uniform(10 * rep, 100 - 5 * rep, 12)) for rep in range(4)}
    rows = [("g", rep, float(s), float(np.sin(s / 9) + rep / 10)) for rep, at in own.items() for s in at] + [("g", 9, 50.0, 1.0), ("g", 0, None, 5.0), ("g", 1, 60.0, math.nan)]
    profiles = spark.createDataFrame(rows, "k string, rep int, s double, d double")
    grid = np.arange(0.0, 100.5, 2.5)
    nodes = spark.createDataFrame([("g", i, float(s), float(np.sin(s / 9))) for i, s in enumerate(grid)], "k string, node int, s double, merged double")
    out = aggregates.resampled(profiles, ["k"], "rep", "s", "d", nodes)
    stack = np.array([np.interp(grid, at, np.sin(at / 9) + rep / 10, left=np.nan, right=np.nan) for rep, at in own.items()])
    got = {(r.rep, r.node): r.resampled for r in out.collect()}
    assert set(got) == {(rep, i) for rep, i in np.argwhere(np.isfinite(stack)).tolist()}
    assert all(got[rep, i] == pytest.approx(stack[rep, i]) for rep, i in got)
    spread = {r.node: r for r in aggregates.node_spread(out, ["k"], "node", "rep", "resampled", profiles.filter("rep < 9").select("k", "rep")).collect()}
    for i in spread:
        some = stack[:, i][np.isfinite(stack[:, i])]
        assert (spread[i].n, spread[i].common) == (len(some), len(some) == 4) and spread[i].sigma == pytest.approx(np.std(some), abs=1e-12)
    rms = {r.rep: r.rms for r in aggregates.repetition_misfit(out, ["k"], "rep", "resampled", "merged").collect()}
    assert all(rms[rep] == pytest.approx(np.sqrt(np.nanmean((stack[rep] - np.sin(grid / 9)) ** 2))) for rep in own)


def test_written_tables_read_back(spark, tmp_path):
    points = spark.createDataFrame([("gnss", "p1", 1.0)], "kind string, id string, elev_m double")
    clouds.surface_table(points).coalesce(1).write.option("header", True).csv(str(tmp_path / "qc"))
    (part,) = (tmp_path / "qc").glob("*.csv")
    assert next(csv.reader(part.open())) == list(clouds.QC_COLUMNS)


def test_blocks_of_one_long_key_equal_the_window(spark):
    """One key has nine tenths of all rows; no block sees more than its own rows and two halos."""
    rows = spark.range(120_000).select(
        F.when(F.col("id") % 10 > 0, 1).otherwise(F.col("id") % 70).alias("k"), F.col("id").alias("i"), F.when(F.col("id") % 13 > 0, (F.hash("id") % 1000).cast("double")).alias("v")
    )
    seen = []

    def iqr(d, keys, order):
        seen.append(d.groupBy("__block").count().agg(F.max("count")).first()[0])
        return sequence.running_iqr(d, keys, order, "v")

    median = lambda d, keys, order: sequence.running_median(d, keys, order, "v")
    for apply, whole, out in ((iqr, sequence.running_iqr(rows, ["k"], ["i"], "v"), "iqr"), (median, sequence.running_median(rows, ["k"], ["i"], "v"), "smooth")):
        got = blocks.in_blocks(rows, ["k"], ["i"], 10, apply, size=7000)
        assert got.columns == whole.columns and got.count() == 120_000
        met = got.select("k", "i", F.col(out).alias("a")).join(whole.select("k", "i", F.col(out).alias("b")), ["k", "i"])
        assert met.filter("a <=> b").count() == 120_000
    assert seen[0] <= 7020
    with pytest.raises(ValueError):
        blocks.in_blocks(rows, ["k"], ["i"], 10, iqr, size=5)
