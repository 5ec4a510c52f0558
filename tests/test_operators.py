"""Survey operators against plain statements of their formulas."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.functions import angles
from fathom.functions.text import folded_name, parsed_time, stem_time
from fathom.operators import aggregates, grouping, joins, network, reference, sequence, surface, survey


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


def test_weighted_median(spark):
    rows = [(1, 5.0, 1.0), (1, 1.0, 1.0), (1, 9.0, 5.0), (2, 1.0, 0.0), (2, 3.0, 0.0), (2, 4.0, -0.0), (3, None, 1.0), (3, float("nan"), 2.0), (4, 7.0, None)]
    frame = spark.createDataFrame(rows, "k int, v double, w double")
    got = {r.k: r.median for r in aggregates.weighted_median(frame, ["k"], "v", "w").collect()}
    assert got == {1: 9.0, 2: 3.0, 4: 7.0}


def test_interval_weights_have_mean_one(spark):
    frame = spark.createDataFrame([(i, float(x), 0.0) for i, x in enumerate([0, 1, 2, 2, 2, 5])], "i int, x double, y double")
    got = [r.weight for r in aggregates.interval_weights(frame, [], ["i"], "x", "y").orderBy("i").collect()]
    half = np.array([0.5, 1, 0.5, 0, 1.5, 1.5])
    half = np.minimum(half, 3 * np.percentile(half[half > 0], 95))
    want = np.where(half > 0, half / half[half > 0].mean(), 0.05)
    assert got == pytest.approx(want.tolist())


def despiked(d, half, multiplier, cycles):
    """The filter's rule, row by row."""
    valid, work, n = d > 0, d.copy(), len(d)
    if valid.sum() < 5:
        return valid
    for _ in range(cycles):
        good = np.flatnonzero(np.isfinite(work))
        full = np.interp(np.arange(n), good, work[good])
        wide = np.concatenate([np.repeat(full[0], half // 2), full, np.repeat(full[-1], half // 2)])
        res = full - np.array([np.median(wide[i : i + 2 * (half // 2) + 1]) for i in range(n)])
        limit = np.empty(n)
        for i in range(n):
            near = np.delete(res[max(0, i - half) : i + half + 1], min(i, half))
            iqr = np.subtract(*np.percentile(near, [75, 25])) if len(near) >= 4 else 0.0
            limit[i] = max(multiplier * iqr, 0.05 * abs(full[i]), 0.1)
        bad = np.abs(res) > limit
        if not (bad & valid).any():
            break
        valid &= ~bad
        work = np.where(valid, d, np.nan)
    return valid


def test_despike_against_the_rule(spark):
    rng = np.random.default_rng(6)
    rows, want = [], {}
    for k in range(4):
        d = 5 + np.sin(np.arange(40) / 5) + 0.02 * rng.standard_normal(40)
        d[rng.integers(0, 40, 3)] += rng.choice([-3, 4, 9], 3)
        d[7] = -1.0 if k == 1 else d[7]
        want[k] = despiked(d, 10, 15.0, 3).tolist()
        rows += [(k, i, float(x)) for i, x in enumerate(d)]
    rows += [(9, i, 1.0) for i in range(3)]
    want[9] = [True] * 3
    out = sequence.despike(spark.createDataFrame(rows, "k int, i int, d double"), ["k"], "i", "d")
    got = {}
    for r in out.orderBy("k", "i").collect():
        got.setdefault(r.k, []).append(r.valid)
    assert got == want


def test_smoothing_keeps_a_parabola(spark):
    frame = spark.createDataFrame([(i, 2.0 + 3 * i - 0.5 * i * i) for i in range(12)], "i int, v double")
    rows = sequence.smooth(frame, [], ["i"], "v", 7).collect()
    assert all(r.smooth == pytest.approx(r.v) for r in rows)
    assert sequence.smoothing_weights(5)[2] == pytest.approx([x / 35 for x in (-3, 12, 17, 12, -3)])


def test_asof_holds_at_the_ends(spark):
    series = spark.createDataFrame([("a", 10.0, 1.0), ("a", 20.0, 3.0), ("a", 20.0, 5.0), ("b", 5.0, 7.0)], "k string, t double, v double")
    points = spark.createDataFrame([("a", t) for t in (0.0, 10.0, 15.0, 20.0, 99.0)] + [("b", 1.0), ("c", 1.0)], "k string, t double")
    got = {(r.k, r.t): r.s for r in sequence.asof_interpolate(points, series, ["k"], "t", "v", "s").collect()}
    assert got == {("a", 0.0): 1.0, ("a", 10.0): 1.0, ("a", 15.0): 2.5, ("a", 20.0): 4.0, ("a", 99.0): 4.0, ("b", 1.0): 7.0, ("c", 1.0): None}


def test_leader_runs_follow_the_leader(spark):
    places = [0, 10, 14, 16, 20, 31, 0]
    frame = spark.createDataFrame([("s", i, float(p)) for i, p in enumerate(places)], "k string, i int, p double")
    out = grouping.leader_runs(frame, ["k"], ["i"], ["p"], lambda a, b: abs(a["p"] - b["p"]) <= 15)
    assert [r.run for r in out.orderBy("i").collect()] == [0, 0, 0, 1, 1, 1, 2]
    names = grouping.group_names(out.withColumn("name", F.concat(F.lit("t"), F.col("i"))), ["run"], "name")
    assert sorted(r.group_id for r in names.collect()) == ["t0_x3", "t3_x3", "t6"]


def test_angles(spark):
    assert one(spark, angles.undirected_difference(F.lit(175.0), F.lit(-10.0))) == pytest.approx(5)
    assert one(spark, angles.azimuth(F.lit(-1.0), F.lit(0.0))) == 270
    s, offset = angles.along_axis(F.lit(3.0), F.lit(4.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))
    assert one(spark, s) == pytest.approx(3) and one(spark, offset) == pytest.approx(4)
    texts = {0.0: "0+000.00", 1234.567: "1+234.57", -999.999: "-1+000.00", 59.999: "0+060.00"}
    assert all(one(spark, angles.chainage_text(F.lit(m))) == t for m, t in texts.items())


def test_belt_projection_meets_the_known_point(spark):
    east, north = angles.belt(F.lit(-68.06), F.lit(-38.98), F.lit(2))
    assert one(spark, east) == pytest.approx(2581452.51, abs=0.01) and one(spark, north) == pytest.approx(5685261.72, abs=0.01)
    e, n = angles.utm(F.lit(-69.0), F.lit(0.0), F.lit(19))
    assert one(spark, e) == pytest.approx(500_000) and one(spark, n) == pytest.approx(10_000_000)


def test_times(spark):
    for text in ("2026-04-15 10:30:00", "15/04/2026 10:30", "2026-04-15T10:30:00"):
        assert str(one(spark, parsed_time(F.lit(text)))) == "2026-04-15 10:30:00"
    assert one(spark, parsed_time(F.lit("soon"))) is None
    assert one(spark, stem_time(F.lit("20260415103000r"))) == 1776249000.0
    assert one(spark, folded_name(F.lit("  Río Neuquén "))) == "rio neuquen"


def test_network(spark):
    vertices = [("limay", 0, 0.0, 0.0), ("limay", 1, 1000.0, 0.0), ("neuquen", 0, 500.0, 900.0), ("neuquen", 1, 1000.0, 0.0), ("negro", 0, 1000.0, 0.0), ("negro", 1, 3000.0, 0.0), ("arroyo", 0, 2000.0, 500.0), ("arroyo", 1, 2000.0, 1.0)]
    segments = joins.segments_of(spark.createDataFrame(vertices, "line string, seq int, x double, y double"), ["line"], "seq")
    links = network.links(segments)
    assert sorted(map(tuple, links.collect())) == [("arroyo", "negro", 1000.0), ("limay", "negro", 0.0), ("neuquen", "negro", 0.0)]
    lengths = segments.groupBy(F.col("line").alias("river")).agg(F.sum("length").alias("length"))
    parts = network.paths(lengths, links)
    got = {(r.head, r.river): (r.s0, r.p0) for r in parts.collect()}
    assert got[("limay", "negro")] == (0.0, 1000.0) and got[("arroyo", "negro")] == (1000.0, 499.0) and len(got) == 6
    nodes = network.junctions(links, parts).collect()
    assert [(r.river, r.s, r.ups) for r in nodes] == [("negro", 0.0, ["limay", "neuquen"]), ("negro", 1000.0, ["arroyo"])]
    placed = network.positions(spark.createDataFrame([(1, "negro", 1500.0), (2, "limay", 10.0)], "id int, on string, s double"), parts, "on", "s")
    assert sorted((r.id, r.head, r.p) for r in placed.collect())[1:3] == [(1, "limay", 2500.0), (1, "neuquen", pytest.approx(2529.563))]


def test_nearest_and_crossings(spark):
    lines = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 100.0, 0.0), ("b", 0, 0.0, 50.0), ("b", 1, 100.0, 50.0)], "line string, seq int, x double, y double")
    segments = joins.segments_of(lines, ["line"], "seq").withColumn("order", F.ascii("line"))
    points = spark.createDataFrame([(1, 30.0, 10.0), (2, 120.0, 25.0)], "id int, x double, y double")
    got = [(r.id, r.line, r.distance, r.chainage) for r in joins.nearest_segments(points, ["id"], segments, "line", "order").orderBy("id").collect()]
    assert got == [(1, "a", 10.0, 30.0), (2, "a", pytest.approx(math.hypot(20, 25)), 100.0)]
    sections = spark.createDataFrame([(1, 50.0, -10.0, 50.0, 20.0), (2, 20.0, 50.0, 40.0, 50.0), (3, 0.0, 10.0, 9.0, 20.0)], "id int, ax double, ay double, bx double, by double")
    met = sorted((r.id, r.line, r.px, r.py) for r in joins.crossings(sections, ["id"], segments, 40.0).collect())
    assert met == [(1, "a", 50.0, 0.0), (2, "b", 30.0, 50.0)]


def test_surface_inside_and_outside(spark):
    anchors = spark.createDataFrame(
        [("p", 0.0, 10.0, ["gnss"]), ("p", 1000.0, 9.0, ["gnss"]), ("p", 1500.0, 8.9, ["gauge"]), ("q", 5.0, 1.0, ["gnss"]), ("g", 0.0, 2.0, ["gauge"]), ("g", 1.7, 2.41, ["gauge"])],
        "path string, p double, h double, deps array<string>",
    )
    points = spark.createDataFrame([("p", -100.0), ("p", 500.0), ("p", 1250.0), ("p", 1600.0), ("q", 99.0), ("g", 100.0)], "path string, p double")
    out = surface.evaluate(points, anchors, surface.end_slopes(anchors, default=-0.0009))
    got = {(r.path, r.p): (round(r.value, 4), r.source, r.doubtful) for r in out.collect()}
    assert got[("p", 500.0)] == (9.5, "survey", False) and got[("p", 1250.0)] == (8.95, "bridge", False)
    assert got[("p", -100.0)] == (10.1, "extrap", False)
    assert got[("q", 99.0)] == (1.0, "extrap", True)
    # two gauges 1.7 m apart say nothing about the slope
    assert got[("g", 100.0)] == (round(2.41 - 0.0009 * 98.3, 4), "extrap", True)
    assert surface.resolved(out.withColumn("id", F.lit(1)), ["id"]).first().source in ("survey", "bridge")


def test_profile_of_a_known_bed(spark):
    rng = random.Random(1)
    rows = [("t", s / 4, 2 + math.sin(s / 40), 1.0) for s in range(400) for _ in range(rng.randint(1, 3))]
    points = spark.createDataFrame(rows, "perfil string, s double, depth double, weight double")
    out = survey.profile(points, ["perfil"], F.lit(5.0), F.lit(3.0)).orderBy("node").collect()
    assert out[0].depth_m == out[-1].depth_m == 0 and len(out) == math.ceil((5 + 99.75 + 3 + 0.25) / 0.5)
    inner = [r for r in out if 8 < r.s_m < 98]
    assert max(abs(r.depth_m - (2 + math.sin((r.s_m - 5) / 10))) for r in inner) < 0.05
    assert survey.checks(survey.profile(points, ["perfil"], F.lit(5.0), F.lit(3.0)), ["perfil"]).first()[1:] == (True, True, True)


def test_beams_and_dropouts(spark):
    frame = spark.createDataFrame([(1, 100.0, 200.0, 4.6, [4.6, None, -1.0, 2.0], -38.0, -68.0), (2, 0.0, 0.0, 3.0, [1.0] * 4, 0.0, 0.0)], "ens int, e double, n double, d double, b array<double>, lat double, lon double")
    fixed = survey.without_dropouts(frame, "lat", "lon", "e", "n")
    assert [(r.ens, r.dropout, r.e) for r in fixed.orderBy("ens").collect()] == [(1, False, 100.0), (2, True, None)]
    cloud = survey.beam_cloud(frame.filter("ens = 1"), ["ens"], "e", "n", "d", "b", F.lit(0.0), F.lit(3000.0)).orderBy("beam_index").collect()
    assert [r.beam_index for r in cloud] == [0, 1, 4]
    assert cloud[1].n - 200 == pytest.approx(2.145, abs=1e-3)  # depth * tan(25 degrees), ahead


def test_extent_of_repetitions(spark):
    rows = [("g", rep, float(s)) for rep, lo, hi in (("a", 0, 140), ("b", 2, 150), ("c", -1, 141)) for s in range(lo, hi + 1)] + [("g", "d", 999.0)]
    frame = spark.createDataFrame(rows, "k string, rep string, s double")
    mean, most = (aggregates.measured_extent(frame, ["k"], ["rep"], "s", mode=m).first() for m in ("mean", "max"))
    assert mean.extent_from == pytest.approx(1 / 3) and mean.extent_to == pytest.approx(431 / 3) and mean.n_counted == 3
    assert (most.extent_from, most.extent_to) == (-1.0, 999.0)


def test_discharge_of_a_group(spark):
    frame = spark.createDataFrame([(1, q) for q in (55.006, 64.018, 50.229, 67.276)] + [(2, 1.0)], "k int, q double")
    got = {r.k: r for r in aggregates.spread_statistics(frame, ["k"], "q").collect()}
    assert got[1].mean == pytest.approx(59.132, abs=1e-3) and got[1].sd == pytest.approx(7.885, abs=1e-3) and got[1].cv_percent == pytest.approx(13.3, abs=0.05)
    assert got[2].sd is None and got[2].cv_percent is None


def test_monotone_cubic(spark):
    x, y = [0.0, 1.0, 3.0, 4.0, 7.0], [1.0, 2.0, 2.5, 2.0, 2.0]
    series = spark.createDataFrame([("k", a, b) for a, b in zip(x, y)] + [("two", 0.0, 1.0), ("two", 2.0, 5.0)], "k string, t double, v double")
    slopes = [r.slope for r in sequence.monotone_slopes(series, ["k"], "t", "v").filter("k = 'k'").orderBy("t").collect()]
    # secants 1, 0.25, -0.5, 0
    assert slopes == pytest.approx([1.25, 9 / (5 / 1 + 4 / 0.25), 0.0, 0.0, 0.0])
    points = spark.createDataFrame([("k", t) for t in (-1.0, 0.0, 0.5, 2.0, 3.5, 7.0, 8.0)] + [("two", 1.0)], "k string, t double")
    got = {(r.k, r.t): r.z for r in sequence.monotone_interpolate(points, series, ["k"], "t", "v", "z").collect()}
    assert got[("k", -1.0)] is None and got[("k", 8.0)] is None
    assert (got[("k", 0.0)], got[("k", 7.0)], got[("two", 1.0)]) == (1.0, 2.0, pytest.approx(3.0))
    assert 1 < got[("k", 0.5)] < 2 < got[("k", 2.0)] < 2.5 and 2 < got[("k", 3.5)] < 2.5


def test_sections_are_located(spark):
    lines = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 100.0, 0.0), ("b", 0, 0.0, 50.0), ("b", 1, 100.0, 50.0)], "river string, seq int, x double, y double")
    segments = joins.segments_of(lines, ["river"], "seq")
    sections = spark.createDataFrame([(1, 40.0, 10.0, 40.0, 30.0), (2, 70.0, 24.0, 90.0, 24.0)], "id int, ax double, ay double, bx double, by double")
    got = sorted(map(tuple, joins.locate_sections(sections, "id", segments, "river", 40.0).collect()))
    assert got == [(1, "a", 40.0, 20.0, "crossing"), (2, "a", 80.0, 24.0, "nearest")]


def test_nearest_by_cells_is_the_nearest(spark):
    rng = random.Random(2)
    lines = [(f"l{k}", i, rng.uniform(0, 5000), rng.uniform(0, 5000)) for k in range(6) for i in range(4)]
    segments = joins.segments_of(spark.createDataFrame(lines, "line string, seq int, x double, y double"), ["line"], "seq")
    segments = segments.withColumn("order", F.substring("line", 2, 1).cast("int"))
    places = [(i, rng.uniform(-2000, 7000), rng.uniform(0, 5000), f"l{i % 8}") for i in range(40)] + [(40, None, 1.0, "l0"), (41, math.nan, 1.0, "l0")]
    points = spark.createDataFrame(places, "id int, x double, y double, line string")

    def distance(x, y, line):
        own = [(a[2:], b[2:]) for a, b in zip(lines, lines[1:]) if a[0] == b[0] == line]
        out = []
        for (ax, ay), (bx, by) in own:
            t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
            out.append(math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)))
        return min(out)

    for cell in (20.0, 250.0, 9000.0):
        got = {(r.id, r["rank"]): (r.line, round(r.distance, 6)) for r in joins.nearest_segments(points.drop("line"), ["id"], segments, "line", "order", 2, cell).collect()}
        want = {}
        for i, x, y, _ in places[:40]:
            for k, (d, line) in enumerate(sorted((distance(x, y, f"l{k}"), f"l{k}") for k in range(6))[:2], 1):
                want[i, k] = (line, round(d, 6))
        assert got == want
        own = {r.id: round(r.distance, 6) for r in joins.nearest_segments(points, ["id"], segments, "line", "order", 1, cell, own=True).collect()}
        assert own == {i: round(distance(x, y, line), 6) for i, x, y, line in places[:40] if line < "l6"}
    assert joins.nearest_segments(points.drop("line"), ["id"], segments.limit(0), "line", "order").count() == 0


def test_long_lines_meet_points_in_cells(spark):
    """Of a line of 100,000 segments a point meets those of its cells; a long slanted segment lies in as many cells as it is long."""
    n = 100_000
    vertices = spark.range(n + 1).select(F.lit("a").alias("line"), F.col("id").alias("seq"), (F.col("id") * 10.0).alias("x"), (F.sin(F.col("id") / 50) * 200).alias("y"))
    segments = joins.segments_of(vertices, ["line"], "seq")
    points = spark.range(2000).select("id", F.lit("a").alias("line"), (F.col("id") * 499.0 + 3).alias("x"), F.lit(80.0).alias("y"))
    cells = joins.cells_along(segments, 250.0)
    assert cells.groupBy("cx", "cy").count().agg(F.max("count")).first()[0] < 100 and cells.count() < 1.2 * n
    got = reference.on_declared(points, ["id"], segments, "line")
    found = {r.id: r.distance for r in got.collect()}
    assert len(found) == 2000
    x0, y0 = np.arange(n) * 10.0, np.sin(np.arange(n) / 50) * 200
    dx, dy = 10.0, np.sin(np.arange(1, n + 1) / 50) * 200 - y0
    for i in range(0, 2000, 97):
        u = np.clip(((i * 499.0 + 3 - x0) * dx + (80.0 - y0) * dy) / (dx * dx + dy * dy), 0, 1)
        assert found[i] == pytest.approx(np.hypot(i * 499.0 + 3 - x0 - u * dx, 80.0 - y0 - u * dy).min())
    one = spark.createDataFrame([("a", 0.0, 0.0, 100_000.0, 70_000.0)], "line string, x0 double, y0 double, x1 double, y1 double")
    listed = joins.cells_along(one, 250.0)
    assert 400 < listed.count() < 1000  # its bounding box has 112,000
    through = {(int(t * 100_000 // 250), int(t * 70_000 // 250)) for t in (k / 99_991 for k in range(99_991))}
    assert through <= {(r.cx, r.cy) for r in listed.collect()}


def test_one_key_of_many_rows(spark):
    """Gaps, neighbours and runs of one key take time in proportion to its rows."""
    import time

    n = 200_000
    rows = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.when(F.col("id").isin(0, n - 1), F.col("id").cast("double")).alias("v"))
    begun = time.perf_counter()
    filled = sequence.gap_interpolate(rows, ["k"], "i", "v")
    assert filled.filter("abs(filled - i) > 1e-6").count() == 0
    at = sequence.asof_interpolate(rows.select("k", "i"), rows.filter("v is not null"), ["k"], "i", "v", "w")
    assert at.filter("abs(w - i) > 1e-6").count() == 0
    runs = grouping.leader_runs(rows.select("k", "i"), ["k"], ["i"], [], lambda a, b: b["i"] - a["i"] < 10)
    assert runs.filter("run <> floor(i / 10)").count() == 0
    assert time.perf_counter() - begun < 60
