"""Operators on groups, lines and tables by small examples and plain loops."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.functions import crs
from fathom.operators import beams, flow, group, islands, joins, reference, survey, tables
from fathom.sources.sinks import line_wkb


def test_output_system():
    assert crs.output_system(None, 32719) == (32719, "network")
    assert crs.output_system(5345, 32719) == (5345, "asked for")
    assert crs.output_system(None, None) == (5344, "fallback")
    assert not crs.is_metric(4326) and not crs.is_metric(None)
    with pytest.raises(ValueError):
        crs.output_system(4326, None)


def test_places_and_ends(spark):
    vertices = spark.createDataFrame([("a", 0, 0.0, 0.0), ("a", 1, 300.0, 0.0), ("a", 2, 300.0, 400.0), ("b", 0, 0.0, 0.0)], "line string, n int, x double, y double")
    segments = joins.segments_of(vertices, ["line"], "n")
    asked = [(1, "a", -5.0), (2, "a", 300.0), (3, "a", 350.0), (4, "a", 9000.0), (5, "b", 1.0), (6, None, 1.0), (7, "a", None)]
    points = spark.createDataFrame(asked, "id int, line string, s double")
    got = {r.id: (r.px, r.py) for r in reference.place_at(points, segments, "line", F.col("s"), "px", "py").collect()}
    assert got == {1: (0.0, 0.0), 2: (300.0, 0.0), 3: (300.0, 50.0), 4: (300.0, 400.0)}
    row = reference.signed_offset(
        spark.createDataFrame([(1, "a", 100.0, 100.0, 7.0)], "id int, line string, s double, x double, y double"), segments, "line", "s", "x", "y"
    ).first()
    assert (row.snap_x, row.snap_y, row.offset) == (100.0, 0.0, 7.0) and row.axis.azimuth == 90
    here = spark.createDataFrame([(1, "a", -3.0, 4.0), (2, "a", 310.0, 10.0), (3, "c", 0.0, 0.0)], "id int, line string, x double, y double")
    found = {r.id: (r.distance, r.chainage, r.at_end) for r in reference.on_declared(here, ["id"], segments, "line").collect()}
    assert found == {1: (5.0, 0.0, True), 2: (10.0, 310.0, False)}


def test_weighting(spark):
    rows = spark.createDataFrame([(1, i, float(i * i), 0.0, None if i == 1 else 2.0) for i in range(5)], "k int, i int, x double, y double, d double")
    weights = {w: [r.weight for r in flow.weighted(rows, ["k"], ["i"], "x", "y", "d", w).orderBy("i").collect()] for w in ("none", "density", "discharge")}
    assert weights["none"] == [1.0] * 5
    assert weights["discharge"] == pytest.approx([2 * w for w in weights["density"]])
    with pytest.raises(ValueError):
        flow.weighted(rows, ["k"], ["i"], "x", "y", "d", "speed")


def test_beams_keep_other_columns(spark):
    rows = [(1, i, 3.0 if i != 9 else 90.0, [3.0, 40.0 if i == 4 else 2.0, 1.0], f"t{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "f int, i int, vb double, bt array<double>, depth string")
    out = beams.despike_beams(df, ["f"], "i", "vb", "bt").orderBy("i").collect()
    assert out[0].asDict().keys() == {"f", "i", "vb", "bt", "depth"} and [r.depth for r in out] == [f"t{i}" for i in range(20)]
    assert [r.i for r in out if r.vb is None] == [9] and [r.i for r in out if r.bt[1] is None] == [4]
    assert all(r.bt[0] == 3.0 and r.bt[3] is None for r in out)


def test_coverage_stops(spark):
    rows = spark.createDataFrame([(1, None), (2, float("nan"))], "id int, ws double")
    with pytest.raises(ValueError):
        tables.require_coverage(rows, "ws")
    tables.require_coverage(rows, "ws", allow_relative=True)
    tables.require_coverage(rows.filter("false"), "ws")


def numbers_by_loop(branches, tolerance):
    out, groups = {}, []
    for a, b, i in sorted(branches):
        own = next((k for k, (x, y) in enumerate(groups) if abs(a - x) <= tolerance and abs(b - y) <= tolerance), None)
        if own is None:
            own = len(groups)
            groups.append((a, b))
        out[i] = own
    return out


def test_islands_by_loop(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        a = float(draw.randrange(0, 300))
        rows.append((i % 3, i, a, a + draw.randrange(0, 120)))
    df = spark.createDataFrame(rows, "river int, id int, s0 double, s1 double")
    got = {r.id: r.island for r in islands.island_numbers(df, ["river"], "s0", "s1", "id").collect()}
    want = {}
    for river in range(3):
        want |= numbers_by_loop([(a, b, i) for v, i, a, b in rows if v == river], 25.0)
    assert got == want


def test_channels_from_the_left(spark):
    rows = [("r", 1, 100.0, 200.0, 5.0, None), ("r", 2, 110.0, 190.0, -3.0, ""), ("r", 3, 105.0, 205.0, 9.0, "own"), ("r", 4, 900.0, 950.0, 2.0, None), ("r", 5, None, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, "river string, id int, s0 double, s1 double, left double, name string")
    got = {(r.island, r.id): r.channel for r in islands.channels(df, ["river"], "s0", "s1", "left", "id", "name").collect()}
    assert got == {(0, 3): "own", (0, 1): "M2", (0, None): "M3", (0, 2): "MD", (1, 4): "MI", (1, None): "MD"}


def test_line_wkb(spark):
    row = spark.createDataFrame([(1.5, -2.0, 3.25, 1e6)], "a double, b double, c double, d double")
    got = row.select(line_wkb((F.col("a"), F.col("b")), (F.col("c"), F.col("d"))).alias("g")).first().g
    assert bytes(got) == struct.pack("<BII4d", 1, 2, 2, 1.5, -2.0, 3.25, 1e6)


def test_group_profile_of_two_repetitions(spark):
    bed = lambda s: 4 - (s - 20) ** 2 / 100
    places = [(rep, i / 4) for rep in (1, 2) for i in range(161)]
    # the flow goes east, so the section runs south: s grows as n falls
    cloud = spark.createDataFrame([("g", rep, 500.0 + rep - 1.5, 1000.0 - s, bed(s), 1.0) for rep, s in places], "g string, m int, e double, n double, depth double, weight double")
    vectors = spark.createDataFrame([("g", rep, 1.0, 0.05 * (rep - 1.5), 1.0, 3) for rep, _ in places], "g string, m int, ve double, vn double, weight double, step int")
    edges = spark.createDataFrame([("g", 2.0, 3.0, 250.0), ("h", 1.0, 1.0, 250.0)], "g string, left double, right double, surface double")
    profile, directions = group.group_profile(cloud, vectors, edges, ["g"], "m")
    rows = {r.node: r for r in profile.collect()}
    assert sorted(rows) == list(range(91)) and rows[0].depth_m == rows[90].depth_m == 0
    assert all(abs(rows[k].depth_m - bed(k / 2 - 2)) < 0.05 for k in range(14, 74))
    assert rows[44].east == pytest.approx(500) and rows[44].north == pytest.approx(980) and rows[44].bed == 250 - rows[44].depth_m
    found = directions.first()
    assert found.agrees and found.strays == [] and found.section_azimuth == pytest.approx(180) and 0 < found.worst < 2


def plain_profile(rows, left, right, step, primary_min, composite, anchor, extent=None):
    """{node: (depth before smoothing, source)} by a loop over the nodes."""
    ref = [s for s, d, w, p, k in rows if p and d > 0] if anchor == "ref" else []
    lo, hi = extent or (min(ref or [r[0] for r in rows]), max(ref or [r[0] for r in rows]))
    end = left + hi - lo
    out = {}
    for node in range(math.ceil((end + right + step / 2) / step)):
        at, out[node] = node * step, (None, 4)
        if not left - step <= at <= end + step:
            continue
        near = [r for r in rows if r[1] > 0 and abs(r[0] - lo + left - at) <= 2 * step]
        own = [r for r in near if r[3]]
        used = own if len(own) >= primary_min else near if composite else []
        if used:
            total, upto = sum(r[2] for r in used), 0.0
            for r in sorted(used, key=lambda r: r[1]):
                upto += r[2]
                if upto >= total / 2:
                    break
            kinds = [q[4] for q in used]
            out[node] = (r[1], min(set(kinds), key=lambda k: (-kinds.count(k), k)))
    last = max(out)
    out[0], out[last] = (0.0, out[0][1]), (0.0, out[last][1])
    known = [n for n in out if out[n][0] is not None]
    return {n: (float(np.interp(n, known, [out[k][0] for k in known])), out[n][1]) for n in out}


@pytest.mark.parametrize("anchor, composite, primary_min, extent", [
    ("ref", True, 1, None), ("ref", False, 2, None), ("cloud", True, 3, None), ("ref", True, 2, (4.3, 21.9)),
])
def test_profile_options_against_a_loop(spark, anchor, composite, primary_min, extent):
    rng = random.Random(8)
    groups = {}
    for g in range(6):
        rows = []
        for _ in range(120):
            s = rng.uniform(0, 26)
            primary = g != 5 and 5 < s < 21 and not 11 < s < 14 and rng.random() < 0.4
            rows.append((s, round(rng.uniform(0.5, 3), 3) if rng.random() < 0.95 else -1.0, rng.choice([0.5, 1.0]), primary, 2 if primary else rng.choice([1, 3])))
        groups[g] = rows
    points = spark.createDataFrame([(g, *r) for g, rows in groups.items() for r in rows], "g int, s double, depth double, weight double, p boolean, kind int")
    given = spark.createDataFrame([(g, *extent) for g in groups] if extent else [], "g int, lo double, hi double")
    out = survey.profile(points, ["g"], F.lit(3.2), F.lit(2.1), 0.5, None, "p", primary_min, composite, "kind", anchor, given)
    got = {(r.g, r.node): r for r in out.collect()}
    for g, rows in groups.items():
        want = plain_profile(rows, 3.2, 2.1, 0.5, primary_min, composite, anchor, extent)
        last = max(want)
        assert {n for a, n in got if a == g} == set(want)
        smooth = np.clip(savgol5([want[n][0] for n in range(last + 1)]), 0, None)
        for n in want:
            assert got[g, n].src == want[n][1], (g, n)
            assert abs(got[g, n].depth_m - (0.0 if n in (0, last) else smooth[n])) < 1e-9, (g, n)


def savgol5(y):
    """A parabola through five values, by least squares; the ends take the first and the last one's."""
    fit = lambda k, at: np.polyval(np.polyfit(np.arange(-2, 3), y[k - 2 : k + 3], 2), at)
    n = len(y)
    return [fit(2, i - 2) if i < 2 else fit(n - 3, i - n + 3) if i > n - 3 else fit(i, 0) for i in range(n)]


def test_group_extent_is_the_mean_of_its_repetitions(spark):
    """One repetition reaches 10 m further: the mean extent lies halfway, the outermost at its end."""
    cloud = [(1, m, 0.0, float(y), 2.0, 1.0) for m, reach in ((1, 20), (2, 30)) for y in range(reach + 1)]
    cloud = spark.createDataFrame(cloud, "g int, m int, e double, n double, depth double, weight double")
    vectors = spark.createDataFrame([(1, m, 1.0, 0.0, 1.0, 3) for m in (1, 2) for _ in range(6)], "g int, m int, ve double, vn double, weight double, step int")
    edges = spark.createDataFrame([(1, 1.0, 1.0, 5.0)], "g int, left double, right double, surface double")
    width = {}
    for how in ("mean", "max"):
        rows, _ = group.group_profile(cloud, vectors, edges, ["g"], "m", extent=how)
        width[how] = max(r.s_m for r in rows.collect())
    assert width == {"mean": 27.0, "max": 32.0}


def test_whole_groups_against_a_loop(spark):
    """Two groups: repetitions of one bed, one of them narrower and one a constant deeper, and a river that the section crosses."""
    bed = lambda y: 1 + 0.1 * min(y, 40 - y)
    reps = {("g", 1): (0, 40, 0.0), ("g", 2): (8, 32, 0.0), ("g", 3): (0, 40, 0.2), ("h", 1): (0, 40, 0.0)}
    cloud = [(g, m, 100.0, float(y) / 2, bed(y / 2) + off, 1.0) for (g, m), (lo, hi, off) in reps.items() for y in range(2 * lo, 2 * hi + 1)]
    cloud = spark.createDataFrame(cloud, "g string, m int, e double, n double, depth double, weight double")
    vectors = [(g, m, 1.0, 0.0, 1.0, 3) for g, m in reps for _ in range(6)]
    vectors = spark.createDataFrame(vectors, "g string, m int, ve double, vn double, weight double, step int")
    members = [("g", 1, 1.0, 2.0, 250.0, 10.0, "r"), ("g", 2, 1.0, 2.0, 250.3, 12.0, "r"), ("g", 3, 9.0, 2.0, None, 11.0, "r"), ("h", 1, 1.0, 2.0, None, None, "gone")]
    members = spark.createDataFrame(members, "g string, m int, left double, right double, surface double, discharge double, line string")
    river = [("r", 0, 0.0, 25.0), ("r", 1, 200.0, 25.0), ("q", 0, 0.0, -3.0), ("q", 1, 200.0, -3.0)]
    segments = joins.segments_of(spark.createDataFrame(river, "line string, k int, x double, y double"), ["line"], "k")
    out = group.process_groups(cloud, vectors, members, ["g"], "m", segments=segments)
    top = {r.g: r for r in out.groups.collect()}
    g, h = top["g"], top["h"]
    assert (g.left, g.right, g.n_members, g.surface, g.same_stage, g.accepted) == (1.0, 2.0, 3, pytest.approx(250.15), False, True)
    assert (g.discharge, g.discharge_sd, g.width) == (11.0, 1.0, 43.0) and g.strays == []
    assert (g.line, g.method, round(g.chainage, 6), round(g.distance, 6)) == ("r", "crossing", 100.0, 5.0)
    assert (h.line, h.surface, h.discharge, h.same_stage, h.accepted) == ("r", None, None, True, True)

    merged = {(r.g, r.node): r for r in out.profile.collect()}
    own = {}
    for r in out.members.collect():
        own.setdefault((r.g, r.m), []).append((r.s_m, r.depth_m))
    stack = {}
    for (name, m), line in own.items():
        s, d = zip(*sorted(line))
        for (other, node), r in merged.items():
            if other == name and s[0] <= r.s_m <= s[-1]:
                stack.setdefault((name, node), {})[m] = float(np.interp(r.s_m, s, d))
    spread = {(r.g, r.node): (r.n, r.sigma, r.common) for r in out.nodes.collect()}
    assert spread.keys() == stack.keys()
    for at, values in stack.items():
        n, sigma, common = spread[at]
        assert n == len(values) and sigma == pytest.approx(np.std(list(values.values())), abs=1e-9) and common == (n == (3 if at[0] == "g" else 1))
    for r in out.repetitions.collect():
        misfit = [v[r.m] - merged[at].depth_m for at, v in stack.items() if at[0] == r.g and r.m in v]
        assert r.rms == pytest.approx(math.sqrt(np.mean(np.square(misfit))), abs=1e-9) and r.n == len(misfit)
    shared = [spread[at][1] for at in stack if at[0] == "g" and spread[at][2]]
    assert g.sigma_mean_common == pytest.approx(np.mean(shared)) and g.sigma_max_common == pytest.approx(max(shared))
    inner = [spread["g", node][1] for node in range(24, 60)]
    assert all(0.05 < v < 0.15 for v in inner)  # two at one depth, one 0.2 deeper: 0.094


def test_accepted_needs_a_right_angle(spark):
    rows = [(k, i, i * 0.5, 0.0 if i in (0, 4) else 1.0) for k in range(4) for i in range(5)] + [(4, 0, 0.5, 0.0), (4, 1, 1.0, None)]
    profiles = spark.createDataFrame(rows, "k int, node int, s_m double, depth_m double")
    axes = spark.createDataFrame([(0, 10.0, 100.0), (1, 10.0, 271.0), (2, 10.0, 111.0), (4, 0.0, 90.0)], "k int, flow_azimuth double, section_azimuth double")
    got = {r.k: (r.off_degrees, r.perpendicular, r.accepted) for r in survey.accepted(profiles, ["k"], axes).collect()}
    assert got == {0: (0.0, True, True), 1: (9.0, True, True), 2: (11.0, False, False), 3: (None, False, False), 4: (0.0, True, False)}


def test_places_are_filled_in_pairs(spark):
    rows = [(1, -38.0, -68.0, 5.0, 6.0), (2, -38.0, -68.0, 5.0, None), (3, None, -68.0, None, 6.0), (4, -38.0, -69.0, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double, e double, n double")
    got = {r.id: r for r in survey.filled_places(df, "lat", "lon", "e", "n", F.lit(19)).collect()}
    assert (got[1].e, got[1].n, got[1].rebuilt) == (5.0, 6.0, False) and (got[3].e, got[3].n, got[3].rebuilt) == (None, None, False)
    assert got[4].rebuilt and got[4].e == pytest.approx(500_000) and got[2].rebuilt and got[2].n == pytest.approx(got[4].n, abs=500)
