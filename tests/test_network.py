"""Axes out of parts, levels of junctions, prescans and changes of system, against plain loops and known places."""

import math
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.functions import crs
from fathom.operators import axes, joins, junctions, network, prescan
from fathom.sources import mat5, transects
from tests.test_sources import array, element

# ---- axes -------------------------------------------------------------------------------


def plain_merge(parts):
    """Lines of one river's parts {part: [(x, y), ...]} as sets of places in order, either way."""
    ends = defaultdict(list)
    for k, v in parts.items():
        ends[v[0]].append((k, 0))
        ends[v[-1]].append((k, -1))
    left, out = dict(parts), []
    while left:
        k = min(left)
        line, used = list(left.pop(k)), [k]
        for _ in range(2):
            while len(ends[line[-1]]) == 2 and line[0] != line[-1]:
                other = [e for e, _ in ends[line[-1]] if e not in used]
                if not other:
                    break
                v = left.pop(other[0])
                used.append(other[0])
                line += (v if v[0] == line[-1] else v[::-1])[1:]
            line.reverse()
        out.append((used, line))
    return out


def cut_line(rng, points, name, turn=0.5):
    at = sorted({0, len(points) - 1, *rng.sample(range(1, len(points) - 1), min(len(points) - 2, rng.randint(0, 12)))})
    parts = {}
    for i, (a, b) in enumerate(zip(at, at[1:])):
        own = points[a : b + 1]
        parts[f"{name}{rng.randint(0, 10**9):010d}-{i}"] = own[::-1] if rng.random() < turn else own
    return parts


def frame_of(spark, rivers, extra=""):
    rows = [(river, part, i, x, y) for river, parts in rivers.items() for part, v in parts.items() for i, (x, y) in enumerate(v)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "river string, part string, seq int, x double, y double" + extra)


def lines_of(vertices):
    out = defaultdict(list)
    for r in vertices.orderBy("river", "line", "seq").collect():
        assert r.seq == len(out[r.river, r.line])
        out[r.river, r.line].append((r.x, r.y))
    return out


def test_shuffled_and_turned_parts_give_the_lines(spark):
    rng = random.Random(4)
    rivers = {}
    for river in ("a", "b", "c"):
        points = [(float(i), rng.random() * 10) for i in range(60)]
        parts = cut_line(rng, points, "m")
        fork = points[30]
        parts |= cut_line(rng, [fork] + [(30.0 + i, 50.0 + rng.random()) for i in range(9)], "t")
        ring = [(200 + 10 * math.cos(t), 10 * math.sin(t)) for t in np.linspace(0, 2 * math.pi, 20)[:-1]]
        parts |= cut_line(rng, ring + ring[:1], "r")
        parts |= {"z": [(500.0, 0.0), (510.0, 0.0), (500.0, 0.0)], "w": [(600.0, 0.0), (601.0, 1.0)]}
        rivers[river] = parts
    lines, vertices = axes.merged_lines(frame_of(spark, rivers))
    got = lines_of(vertices)
    for river, parts in rivers.items():
        want = plain_merge(parts)
        mine = {line: v for (r, line), v in got.items() if r == river}
        assert len(mine) == len(want)
        for used, line in want:
            v = mine[min(used)]
            if line[0] == line[-1] and len(used) > 1:  # a ring begins with its least part
                assert v[0] == v[-1] and sorted(v[1:]) == sorted(line[1:]) and set(map(frozenset, zip(v, v[1:]))) == set(map(frozenset, zip(line, line[1:])))
            else:
                assert v in (line, line[::-1])
            along = sum(1 if v[: len(p)] == p or any(v[i : i + len(p)] == p for i in range(len(v))) else -1 for p in (parts[k] for k in used))
            assert along >= 0 or len(used) == 1 or line[0] == line[-1]
    rows = {(r.river, r.line): r for r in lines.collect()}
    assert all(r.length == pytest.approx(sum(math.dist(a, b) for a, b in zip(got[k], got[k][1:]))) for k, r in rows.items())
    longest = {river: max((r for k, r in rows.items() if k[0] == river), key=lambda r: r.length).line for river in rivers}
    assert {k[0]: k[1] for k, r in rows.items() if r["rank"] == 1} == longest


def test_one_line_of_many_parts(spark):
    n = 3000
    parts = spark.range(n).select(F.lit("a").alias("river"), F.format_string("%08d", F.expr("(id * 7919) % 3000")).alias("part"), F.col("id").alias("at"))
    ends = F.array(F.col("at"), F.col("at") + 1)
    vertices = parts.select("river", "part", F.posexplode(F.when(F.col("at") % 3 == 0, F.reverse(ends)).otherwise(ends)).alias("seq", "x"))
    lines, places = axes.merged_lines(vertices.select("river", "part", "seq", F.col("x").cast("double").alias("x"), F.lit(0.0).alias("y")))
    assert [(r.n_parts, r.length) for r in lines.collect()] == [(n, float(n))]
    assert places.filter("x <> seq").count() == 0 and places.count() == n + 1


def test_axes_run_downstream(spark):
    straight = lambda n: [(100.0 * i, 0.0) for i in range(n)]
    rivers = {
        "drawn": {"p1": straight(5)}, "flow": {"p1": straight(5)}, "slope": {"p1": straight(3), "p2": [(200.0, 0.0), (900.0, 0.0)]}, "few": {"p1": straight(5)},
        "island": {"p1": straight(9), "p2": [(200.0, 5.0), (300.0, 90.0), (400.0, -9.0)], "p3": [(200.0, 400.0), (300.0, 500.0)]},
        "role": {"p1": straight(9), "p2": [(200.0, 1.0), (300.0, 90.0)], "p3": [(2000.0, 0.0), (2100.0, 0.0)]},
    }
    role = F.when(F.col("river") == "role", F.when(F.col("part") == "p2", " Anabranch ").otherwise("main"))
    flow = F.when(F.col("river") == "flow", "ds2us")
    vertices = frame_of(spark, rivers).withColumns({"role": role, "flow": flow})
    surface = [("slope", 100.0, 10.0, 1.0), ("slope", 500.0, -20.0, 1.2), ("slope", 850.0, 0.0, 1.5), ("slope", 100.0, 80.0, 99.0), ("slope", 1.0, 1.0, None)]
    surface += [("few", 100.0, 0.0, 1.0), ("few", 300.0, 0.0, 2.0), ("flow", 100.0, 0.0, 1.0)]
    points = spark.createDataFrame(surface, "river string, x double, y double, h double")
    found, branches, notes = axes.build_axes(vertices, points)
    got = defaultdict(list)
    for r in found.orderBy("river", "seq").collect():
        got[r.river].append(r.x)
    assert got["drawn"] == [0, 100, 200, 300, 400] and got["flow"] == got["drawn"][::-1] and got["slope"] == [900, 200, 100, 0] and got["few"] == got["drawn"]
    assert {(r.river, r.line) for r in branches.select("river", "line").distinct().collect()} == {("island", "p2"), ("role", "p2")}
    told = {(r.river, r.kind) for r in notes.collect()}
    assert told >= {("flow", "oriented: flow_dir, turned"), ("slope", "oriented: surface, turned"), ("few", "oriented: drawn"), ("island", "not connected"), ("role", "not merged")}
    turned, _, _ = axes.build_axes(vertices.filter("river = 'drawn'"), None, True)
    assert [r.x for r in turned.orderBy("seq").collect()] == got["drawn"][::-1]
    assert axes.build_axes(vertices.limit(0))[0].count() == 0


# ---- levels of junctions -----------------------------------------------------------------


def plain_slope(seq, end, min_span, max_slope, default):
    if len(seq) < 2:
        return 0.0
    edge = (min if end == 0 else max)(p for p, _ in seq)
    far = [abs(p - edge) for p, _ in seq]
    enough = min([d for d in far if d >= 1000.0], default=math.inf)
    for own in ([s for s, d in zip(seq, far) if d <= enough], seq):
        p = [a for a, _ in own]
        if len(own) >= 2 and max(p) - min(p) >= min_span:
            slope = np.polyfit(p, [h for _, h in own], 1)[0]
            if -max_slope <= slope <= 0:
                return slope
    return default


def plain_solve(anchors, nodes, default, min_span=200.0, max_slope=0.002):
    """One node after the other, the farthest from the outlet first, with all values so far."""
    known = defaultdict(list)
    for path, p, h, deps in anchors:
        known[path].append((p, h, frozenset(deps), True))
    by_node = defaultdict(list)
    for node, path, p, branch in nodes:
        by_node[node].append((path, p, branch))
    rank = {node: max(sum(q < p for n, other, q, _ in nodes if other == path) for path, p, _ in places) for node, places in by_node.items()}
    out = {}
    for node in sorted(by_node, key=rank.get):
        places = sorted(by_node[node])
        if any(m and abs(p - q) <= 0.5 for path, q, _ in places for p, _, _, m in known[path]):
            continue
        down = min(((p - q, h, d) for path, q, _ in places for p, h, d, _ in known[path] if p > q + 0.5), default=None, key=lambda t: t[0])
        found, best = [], {}
        for path, q, branch in places:
            for p, h, d, _ in known[path]:
                if p < q - 0.5 and (branch not in best or q - p < best[branch][0]):
                    best[branch] = (q - p, h, d, path, q)
        for du, h, d, path, q in best.values():
            if down:
                gap = du + down[0]
                found.append((h + (down[1] - h) * du / gap, max(gap, 1), d | down[2]))
            else:
                slope = plain_slope([(p, x) for p, x, _, _ in known[path] if p < q - 0.5], 1, min_span, max_slope, default)
                found.append((h + slope * du, max(du, 1), d))
        if found:
            level = sum(v / g for v, g, _ in found) / sum(1 / g for _, g, _ in found)
            out[node] = (level, frozenset().union(*(d for _, _, d in found)), "interp" if down else "extrap-down", max(v for v, _, _ in found) - min(v for v, _, _ in found))
        elif down:
            path, q, _ = min(places)
            slope = plain_slope([(p, h) for p, h, _, _ in known[path] if p > q + 0.5], 0, min_span, max_slope, default)
            out[node] = (down[1] - slope * down[0], down[2], "extrap-up", 0.0)
        else:
            continue
        for path, q, _ in places:
            known[path].append((q, out[node][0], out[node][1], False))
    return out


def network_of(rng, n):
    """Nodes of a binary tree (0 nearest the outlet), and for each head's path its edges with their ends."""
    size = {(i, side): round(rng.uniform(300, 3000), 1) for i in range(n) for side in (0, 1)}
    nodes, edges = [], {}
    for i in range(n):
        for side in (0, 1):
            if 2 * i + 1 + side < n:
                continue
            path, p, at, own = f"h{i}-{side}", size[i, side], i, [((i, side), 0.0)]
            nodes.append((at, path, p, str(side)))
            while at:
                up = ((at - 1) // 2, (at - 1) % 2)
                own.append((up, p))
                p = round(p + size[up], 1)
                at = up[0]
                nodes.append((at, path, p, str(up[1])))
            own.append((("out", 0), p))
            edges[path] = own
    size["out", 0] = 5000.0
    return nodes, edges, size


def test_two_hundred_junctions_equal_a_plain_loop(spark):
    rng = random.Random(6)
    nodes, edges, size = network_of(rng, 200)
    spots = []
    for edge in size:
        low = 1 if edge[0] == "out" else edge[0]
        for _ in range(rng.choice([0, 0, 1, 3]) if low not in range(3, 7) else 0):
            spots.append((edge, round(rng.uniform(1, size[edge] - 1), 1), rng.choice(["gnss", "gauge"]), rng.uniform(-0.05, 0.05)))
    spots.append(((60, 0), size[60, 0], "gnss", 0.0))  # on a node
    spots = [s for s in spots if s[0] != ("out", 0)] if rng.random() < 0.5 else spots
    anchors = [(path, round(p + s, 1), 300 - (p + s) * 0.001 + e, [kind]) for edge, s, kind, e in spots for path, own in edges.items() for o, p in own if o == edge]
    want = plain_solve(anchors, nodes, -0.0007)
    given = spark.createDataFrame(anchors, "path string, p double, h double, deps array<string>")
    places = spark.createDataFrame(nodes, "node int, path string, p double, branch string")
    every, solved = junctions.solve(given, places, default=-0.0007)
    got = {r.node: (r.h, frozenset(r.deps), r.how, r.spread) for r in solved.collect()}
    assert set(got) == set(want) and 60 not in got
    for node, (h, deps, how, spread) in want.items():
        assert got[node][1:3] == (deps, how) and got[node][0] == pytest.approx(h) and got[node][3] == pytest.approx(spread)
    on = Counter(n for n, *_ in nodes)
    assert every.count() == len(anchors) + sum(on[n] for n in got)


def test_a_stem_of_junctions_and_one_sided_values(spark):
    """Junctions on one stem; without values below, without values above, and with values on no side."""
    n = 5
    nodes = [(k, "stem", 1000.0 * (k + 1), "stem") for k in range(n)]
    nodes += [(j, f"t{k}", 400.0 + 1000.0 * (j - k), "stem" if j > k else f"t{k}") for k in range(n) for j in range(k, n)]
    for anchors in (
        [("stem", 0.0, 100.0, ["gnss"]), ("stem", 900.0, 99.5, ["gnss"]), *((f"t{k}", 0.0, 101.0 - k, ["gauge"]) for k in range(n))],
        [("stem", 5500.0, 80.0, ["gnss"]), ("stem", 5900.0, 79.9, ["gnss"]), *((f"t{k}", 400.0 + 1000.0 * (4 - k) + d, h, ["gnss"]) for k in range(n) for d, h in ((500.0, 80.0), (900.0, 79.9)))],
        [],
    ):
        want = plain_solve(anchors, nodes, -0.001)
        given = spark.createDataFrame(anchors, "path string, p double, h double, deps array<string>")
        places = spark.createDataFrame(nodes, "node int, path string, p double, branch string")
        got = {r.node: (r.h, r.how) for r in junctions.solve(given, places, default=-0.001)[1].collect()}
        assert {k: v[1] for k, v in got.items()} == {k: v[2] for k, v in want.items()}
        assert all(got[k][0] == pytest.approx(want[k][0]) for k in want)


def test_levels_at_instants(spark):
    gauges = spark.createDataFrame([("g1", 100.0, 100.5, "p", 0.0), ("g2", 90.0, 90.5, "p", 2000.0)], "station_id string, zero double, h double, path string, p double")
    readings = spark.createDataFrame([("g1", 0.0, 1.0), ("g1", 100.0, 2.0)], "station_id string, at double, level double")
    rows = junctions.gauge_anchors(gauges, readings, [-5, 50, 500, 50])
    got = {(r.at, r.p): r.h for r in rows.collect()}
    assert got == {(-5.0, 0.0): 101.0, (50.0, 0.0): 101.5, (500.0, 0.0): 102.0, **{(t, 2000.0): 90.5 for t in (-5.0, 50.0, 500.0)}}
    nodes = spark.createDataFrame([(1, "p", 1000.0, "p")], "node int, path string, p double, branch string")
    _, solved = junctions.solve(junctions.at_instants(rows, []), junctions.at_instants(nodes, [-5, 50, 500]))
    assert {r.node["at"]: r.h for r in solved.collect()} == {-5.0: 95.75, 50.0: 96.0, 500.0: 96.25}


# ---- systems and prescans ------------------------------------------------------------------


def test_known_place_and_round_trips(spark):
    r = spark.range(1).select(crs.projected(F.lit(-68.06), F.lit(-38.98), F.lit(5344)).alias("p")).first().p
    assert (round(r.x, 2), round(r.y, 2)) == (2581452.51, 5685261.72)
    rng = random.Random(1)
    rows = []
    for _ in range(300):
        lon, lat = rng.uniform(-73.4, -52.6), rng.uniform(-55, -21)
        belt, zone = round((lon + 75) / 3), int((lon + 180) // 6) + 1
        rows += [(lon, lat, 5342 + belt), (lon, lat, 22180 + belt), (lon, lat, 32700 + zone), (lon, -lat, 32600 + zone), (lon, lat, 4326)]
    rows = spark.createDataFrame(rows, "lon double, lat double, code int")
    rows = rows.withColumn("p", crs.projected(F.col("lon"), F.col("lat"), F.col("code"))).select("lon", "lat", "code", "p.x", "p.y")
    back = rows.withColumn("q", crs.unprojected(F.col("x"), F.col("y"), F.col("code")))
    assert back.filter("code = 4326 and x is null and q.lon is null and q.lat is null").count() == 300
    assert back.filter("abs(lon - q.lon) < 5e-9 and abs(lat - q.lat) < 5e-9").count() == 1200
    # from belt to UTM and back: below a millimetre
    belts = rows.filter("code between 5343 and 5349")
    there = belts.withColumn("u", crs.reprojected(F.col("x"), F.col("y"), F.col("code"), F.lit(32719)))
    again = there.withColumn("v", crs.reprojected(F.col("u.x"), F.col("u.y"), F.lit(32719), F.col("code"))).filter("abs(lon + 69) < 4")
    assert again.count() > 50 and again.filter("abs(x - v.x) > 1e-3 or abs(y - v.y) > 1e-3").count() == 0
    same = belts.withColumn("u", crs.reprojected(F.col("x"), F.col("y"), F.col("code"), F.col("code")))
    assert same.filter("u.x <> x or u.y <> y").count() == 0


def mat_file(**trees):
    parts = b"".join(element(15, zlib.compress(array(k, v))) for k, v in trees.items())
    return b"MATLAB 5.0".ljust(124) + struct.pack("<H", 0x0100) + b"IM" + parts


def transect(spark, places, utm=True):
    """(lat, lon, UTM) of places in belt 2; the UTM pairs are missing where ``utm`` is not set."""
    rows = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(places)], "i int, x double, y double")
    there = crs.reprojected(F.col("x"), F.col("y"), F.lit(5344), F.lit(32719))
    rows = rows.select("i", crs.unprojected(F.col("x"), F.col("y"), F.lit(5344)).alias("g"), there.alias("u"))
    got = rows.select("i", "g.lon", "g.lat", F.col("u.x").alias("e"), F.col("u.y").alias("n")).orderBy("i").collect()
    gps = {"Latitude": [[r.lat] for r in got], "Longitude": [[r.lon] for r in got]}
    gps["UTM"] = [[r.e, r.n] if utm else [math.nan, math.nan] for r in got]
    n = len(got)
    return {"BottomTrack": {"BT_Beam_Depth": np.ones((n, 4)), "VB_Depth": np.ones((n, 1))}, "Other": {"Noise": np.random.default_rng(1).random((500, 40))}, "GPS": gps}


def test_only_the_wanted_variable_is_inflated(spark, tmp_path):
    import io

    body = mat_file(**transect(spark, [(2581000.0 + i, 5685000.0) for i in range(30)]))
    whole, part = {}, {}
    every = dict(mat5.variables(io.BytesIO(body), None, whole))
    only = dict(mat5.variables(io.BytesIO(body), {"GPS"}, part))
    assert list(only) == ["GPS"] and len(every) == 3 and part["kept"] == 1
    gps = len(array("GPS", transect(spark, [(2581000.0 + i, 5685000.0) for i in range(30)])["GPS"]))
    assert part["inflated"] <= gps + 3 * mat5.HEAD < 0.1 * whole["inflated"] and part["read"] < 0.1 * whole["read"]
    plain = b"MATLAB 5.0".ljust(124) + struct.pack("<H", 0x0100) + b"IM" + array("Other", {"a": np.ones((900, 9))}) + array("GPS", {"Latitude": [[1.0]]})
    tally = {}
    assert list(dict(mat5.variables(io.BytesIO(plain), {"GPS"}, tally))) == ["GPS"] and tally["read"] < 3000


def test_prescan_equals_known_places(spark, tmp_path):
    x0, y0 = 2581000.0, 5685000.0
    vertices = [("main", i, x0 + 500.0 * i, y0) for i in range(9)] + [("side", i, x0 + 2000.0, y0 + 1000.0 - 500.0 * i) for i in range(3)]
    segments = joins.segments_of(spark.createDataFrame(vertices, "river string, seq int, x double, y double"), ["river"], "seq")
    across = lambda x, y, n=9: [(x, y + 10.0 * i) for i in range(n)]
    tracks = {
        "t1": across(x0 + 700, y0 - 40), "t2": across(x0 + 1990, y0 + 30, 3), "short": [(x0 + 100, y0 + 8)] * 5, "bank": across(x0 + 3000, y0 + 4, 6),
        "bend": [(x0 + 100 + 80 * i, y0 + 3 * (-1) ** i) for i in range(8)] + [(x0 + 660 - 30 * i, y0 + 60 - i) for i in range(20)],
    }
    for k, (name, places) in enumerate(tracks.items()):
        (tmp_path / f"{name}.mat").write_bytes(mat_file(**transect(spark, places, utm=k != 1)))
    (tmp_path / "bad.mat").write_bytes(b"nothing")
    (tmp_path / "none.mat").write_bytes(mat_file(GPS={"Latitude": [[0.0]], "Longitude": [[0.0]], "UTM": [[0.0, 0.0]]}))
    transects.register(spark)
    fixes = spark.read.format("mat5").option("variables", "GPS").load(str(tmp_path))
    assert fixes.columns == ["perfil", "ens", "utm_e", "utm_n", "lat", "lon", "error"]
    full = mat5.read_transects(spark, [str(tmp_path), str(tmp_path / "t1.mat")])
    good = "perfil in ('t1', 't2', 'short', 'bank', 'bend')"
    assert sorted(map(repr, fixes.filter(good).collect())) == sorted(map(repr, full.filter(good).select(fixes.columns).collect()))
    assert {r.perfil for r in fixes.filter("error is not null").collect()} == {"bad"}
    forced = spark.createDataFrame([("t2", "main")], "perfil string, river string")
    found = {r.perfil: r for r in prescan.prescan(fixes.filter("error is null"), segments, "river", 5344).collect()}
    at = np.array(tracks["bend"])
    own, axis = at - at.mean(axis=0), np.linalg.eigh(np.cov(at.T))[1][:, 1]
    reach = np.array([(own @ axis).min(), (own @ axis).max()])
    reach += np.array([-1, 1]) * max(15.0, 0.15 * np.ptp(reach))
    sides = at.mean(axis=0)[1] - y0 + reach * axis[1]
    assert {k: (r.river, r.method) for k, r in found.items()} == {
        "t1": ("main", "crossing"), "t2": ("side", "nearest"), "short": ("main", "nearest"), "bank": ("main", "crossing"),
        "bend": ("main", "crossing" if sides[0] * sides[1] < 0 else "nearest"),
    }
    assert found["t1"].chainage == pytest.approx(700, abs=0.01) and found["t1"].distance == pytest.approx(0, abs=0.01) and found["t1"].span == pytest.approx(0, abs=0.01)
    assert found["t2"].chainage == pytest.approx(960, abs=0.01) and found["t2"].distance == pytest.approx(10, abs=0.01)
    assert found["short"].chainage == pytest.approx(100, abs=0.01) and found["bank"].distance == pytest.approx(29, abs=0.01)
    assert not found["t1"].longitudinal
    manual = {r.perfil: r for r in prescan.prescan(fixes.filter("error is null"), segments, "river", 5344, forced).collect()}
    assert (manual["t2"].river, manual["t2"].method) == ("main", "manual") and manual["t2"].chainage == pytest.approx(1990, abs=0.01)
    plain = lambda rows: {k: [round(v, 4) if isinstance(v, float) else v for v in r] for k, r in rows.items() if k != "t2"}
    assert plain(manual) == plain(found)


def test_longitudinal_runs_are_told(spark):
    """A track along a bend of the river covers far more of it than lies between its ends."""
    arc = [(1000 * math.cos(t), 1000 * math.sin(t)) for t in np.linspace(0, 2 * math.pi * 0.95, 200)]
    vertices = spark.createDataFrame([("r", i, 2581000.0 + x, 5685000.0 + y) for i, (x, y) in enumerate(arc)], "river string, seq int, x double, y double")
    segments = joins.segments_of(vertices, ["river"], "seq")
    rows = [("run", i, x, y) for i, (x, y) in enumerate(arc)] + [("cut", i, 980.0 + i, 5.0) for i in range(40)]
    tracks = spark.createDataFrame([(k, i, 2581000.0 + x, 5685000.0 + y) for k, i, x, y in rows], "perfil string, ens int, x double, y double")
    there = crs.reprojected(F.col("x"), F.col("y"), F.lit(5344), F.lit(32719))
    fixes = tracks.select("perfil", "ens", crs.unprojected(F.col("x"), F.col("y"), F.lit(5344)).alias("g"), there.alias("u"))
    fixes = fixes.select("perfil", "ens", "g.lon", "g.lat", F.col("u.x").alias("utm_e"), F.col("u.y").alias("utm_n"))
    got = {r.perfil: r.longitudinal for r in prescan.prescan(fixes, segments, "river", 5344).collect()}
    assert got == {"run": True, "cut": False}


def test_file_conditions_skip_files(spark, tmp_path):
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.mat").write_bytes(mat_file(GPS={"Latitude": [[1.0], [2.0]], "Longitude": [[1.0], [2.0]]}))
    transects.register(spark)
    rows = spark.read.format("mat5").option("variables", "GPS").load(str(tmp_path)).filter("perfil in ('a', 'c') and lat > 1")
    assert sorted((r.perfil, r.ens) for r in rows.collect()) == [("a", 1), ("c", 1)]
    reader = transects.TransectReader(str(tmp_path), mat5.schema_of({"GPS"}))
    kept = list(reader.pushFilters([transects.In(("perfil",), ("a", "c")), transects.EqualTo(("lat",), 1.0), transects.EqualTo(("perfil",), "c")]))
    assert [f.attribute for f in kept] == [("lat",)] and [p.rsplit("/", 1)[-1] for f in reader.partitions() for p in f.paths] == ["c.mat"]


def test_paths_of_any_depth(spark):
    """A chain of 5,000 rivers, a tree, a river without a length and a ring: every head's path to its end."""
    n = 5000
    length = {f"c{i}": 10.0 + i % 7 for i in range(n)} | {"a": 5.0, "b": 6.0, "c": 20.0, "d": 30.0, "x": 9.0, "y": 9.0, "z": 9.0}
    links = {f"c{i}": (f"c{i + 1}", float(i % 3)) for i in range(n - 1)} | {"a": ("c", 7.0), "b": ("c", 0.0), "c": ("d", 12.5), "d": ("gone", 1.0), "z": ("x", 4.0), "x": ("y", 3.0), "y": ("x", 5.0)}
    rivers = spark.createDataFrame(list(length.items()), "river string, length double")
    down = spark.createDataFrame([(r, d, s) for r, (d, s) in links.items()], "river string, down string, s_join double")
    got = defaultdict(list)
    for r in network.paths(rivers, down).orderBy("head", "k").collect():
        assert r.k == len(got[r["head"]])
        got[r["head"]].append((r.river, r.s0, r.s1, r.p0))
    taken = {d for d, s in links.values() if s <= 2.0}
    assert set(got) == {r for r in length if r not in taken}
    for head in ["c0", "a", "b", "z", *[h for h in got if h[0] == "c"][:3]]:
        river, s0, p0, want = head, 0.0, 0.0, []
        while river in length and river not in [w[0] for w in want[-3:]]:
            want.append((river, s0, length[river], p0))
            p0 += length[river] - s0
            river, s0 = links.get(river, (None, 0.0))
        assert [w[0] for w in got[head]] == [w[0] for w in want]
        assert all(a[1:3] == b[1:3] and a[3] == pytest.approx(b[3]) for a, b in zip(got[head], want))
