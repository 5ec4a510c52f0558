"""Joins by cells where all rows share a few cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.operators import group, joins


@pytest.fixture
def crowd(spark):
    """150 sections across 300 segments of three lines, all in one cell."""
    rng = np.random.default_rng(5)
    draw = lambda n: rng.random((n, 4)) * 40
    sections = [(i, f"r{i % 3}", *map(float, p)) for i, p in enumerate(draw(150))]
    segments = [(f"r{i % 3}", i, *map(float, p), float(np.hypot(p[2] - p[0], p[3] - p[1])), 100.0 * i) for i, p in enumerate(draw(300))]
    return (
        spark.createDataFrame(sections, "id int, line string, ax double, ay double, bx double, by double"),
        spark.createDataFrame(segments, "line string, seg_no int, x0 double, y0 double, x1 double, y1 double, length double, s0 double"),
    )


def plain_crossings(sections, segments, own):
    out = set()
    for s in sections.collect():
        for g in segments.collect():
            r, q, w = np.array([s.bx - s.ax, s.by - s.ay]), np.array([g.x1 - g.x0, g.y1 - g.y0]), np.array([g.x0 - s.ax, g.y0 - s.ay])
            det = r[0] * q[1] - r[1] * q[0]
            t, u = (w[0] * q[1] - w[1] * q[0]) / det, (w[0] * r[1] - w[1] * r[0]) / det
            if 0 <= t <= 1 and 0 <= u <= 1 and (s.line == g.line or not own):
                out.add((s.id, g.line, g.seg_no, round(s.ax + t * r[0], 6), round(s.ay + t * r[1], 6)))
    return out


@pytest.mark.parametrize("most", [9000, 10**9])
@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("cell", [7.0, 250.0])
def test_crossings_equal_all_pairs(spark, crowd, monkeypatch, most, own, cell):
    monkeypatch.setattr(joins, "PAIRS_A_TASK", most)
    sections, segments = crowd
    met = joins.crossings(sections if own else sections.drop("line"), ["id"], segments, cell, own)
    got = [(r.id, r.line, r.seg_no, round(r.px, 6), round(r.py, 6)) for r in met.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_crossings(sections, segments, own)


def test_one_cell_goes_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(joins, "PAIRS_A_TASK", 2000)
    one, two = (spark.range(200).select(F.lit(0).alias("cx"), F.lit(0).alias("cy"), F.col("id").alias(c)) for c in "ab")
    met = joins.met_in_cells(one, two, ["cx", "cy"])
    parts = met.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 40_000 == met.select("a", "b").distinct().count()
    assert max(r["count"] for r in parts) <= 8000


def test_sections_meet_their_own_line_only_in_short_cells(spark, crowd, monkeypatch):
    """No more pairs are looked at than a section and its own line make in cells of the segments' size."""
    sections, segments = crowd
    met, plain = [], joins.met_in_cells
    monkeypatch.setattr(joins, "met_in_cells", lambda a, b, by: (met.append(by), plain(a, b, by))[1])
    ends = sections.select("id", F.posexplode(F.array(F.struct(F.col("ax").alias("east"), F.col("ay").alias("north")), F.struct(F.col("bx").alias("east"), F.col("by").alias("north")))).alias("node", "p"))
    size = sections.select("id", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")).alias("s_m"))
    merged = ends.select("id", "node", "p.*").join(size, "id")
    edges = sections.select("id", "line", F.lit(0.0).alias("left"), F.lit(0.0).alias("right"))
    got = {r.id: r for r in group.relocated(merged, edges, ["id"], segments, "line").collect()}
    assert met[-1] == ["cx", "cy", "line"]
    every = plain_crossings(sections, segments, True)
    assert len(got) == 150 and {i for i, r in got.items() if r.method == "crossing"} == {i for i, *_ in every}
