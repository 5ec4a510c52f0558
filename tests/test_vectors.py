"""GeoJSON and well-known binary: parts, aliases, missing texts, interior points, bad rows."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from fathom.operators import axes
from fathom.sources import sinks, vectors


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates} if kind else None}


SQUARE = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
HOLE = [[2, 2], [6, 2], [6, 8], [2, 8], [2, 2]]


def test_centrelines(spark, tmp_path):
    every = [
        feature("LineString", [[0, 0, 5], [100, 0, 5]], RIO=" Limay ", Rol="MAIN", flow_dir="us2ds"),
        feature("MultiLineString", [[[200, 0], [100, 0]], [[300, 1], [300, 2]]], river="Limay", role=None, etiqueta="nan"),
        feature("LineString", [[0, 9], [1, 9]], rio="None"), feature(None, None, rio="x"), feature("Point", [1, 2], rio="x"), feature("LineString", [], rio="x"),
    ]
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": every}, indent=1))
    rows = vectors.centrelines(vectors.read_geojson(spark, str(tmp_path / "c.geojson")), "first").collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.part, r.seq)):
        got.setdefault((r.river, r.part[-19:], r.role, r.label, r.flow), []).append((r.x, r.y))
    assert got == {
        ("Limay", "000000000000-000000", "main", "", "US2DS"): [(0, 0), (100, 0)], ("Limay", "000000000001-000000", "", "", ""): [(200, 0), (100, 0)],
        ("Limay", "000000000001-000001", "", "", ""): [(300, 1), (300, 2)], ("first", "000000000002-000000", "", "", ""): [(0, 9), (1, 9)],
    }
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text("\n".join(json.dumps(f) for f in every) + "\nnot json\n")
    by_line = vectors.centrelines(vectors.read_geojson(spark, str(tmp_path / "lines"), lines=True), "first")
    assert sorted((r.river, r.x, r.y) for r in by_line.collect()) == sorted((r.river, r.x, r.y) for r in rows)
    axis, _, _ = axes.build_axes(by_line.filter("role = '' and river = 'Limay'"))
    assert [r.x for r in axis.orderBy("seq").collect()] == [200, 100]


def test_stations_and_interior_points(spark, tmp_path):
    every = [
        feature("Point", [3, 4], id="s1", nombre="Uno", cero="250,5"),
        feature("Polygon", [SQUARE, HOLE], codigo="s2", gauge_zero=1),
        feature("MultiPolygon", [[SQUARE], [[[20, 0], [40, 0], [30, 30], [20, 0]]]], station_id="s3", km="x"),
        feature("LineString", [[0, 0], [4, 1], [10, 0]], id="s4"), feature("LineString", [[0, 0], [10, 0]], id="s5"),
        feature("MultiPoint", [[0, 0], [1, 0], [9, 0]], id="s6"), feature(None, None, id="s7"), feature("Polygon", [[[0, 5], [9, 5], [0, 5]]], id="s8"),
    ]
    (tmp_path / "s.geojson").write_text(json.dumps({"features": every}))
    rows = {r.station_id: r for r in vectors.stations(vectors.read_geojson(spark, str(tmp_path / "s.geojson"))).collect()}
    assert (rows["s1"].name, rows["s1"].zero, rows["s1"].x, rows["s1"].y) == ("Uno", 250.5, 3, 4)
    # half-way between the hole's sides' places: its lower and upper ones are 2 and 8, the middle is 5
    assert (rows["s2"].zero, rows["s2"].x, rows["s2"].y) == (1.0, 8.0, 5.0)
    assert (rows["s3"].chainage, rows["s3"].x, rows["s3"].y) == (None, 5.0, 5.0) or rows["s3"].x == pytest.approx(30.0)
    assert (rows["s4"].x, rows["s4"].y) == (4, 1) and rows["s5"].x in (0, 10) and rows["s6"].x == 1
    assert rows["s7"].x is None and rows["s8"].x is None


def wkb(kind, body, order="<", flags=0, srid=None):
    return (b"\x01" if order == "<" else b"\x00") + struct.pack(order + "I", kind | flags) + (struct.pack(order + "I", srid) if srid else b"") + body


def places(points, order="<"):
    return b"".join(struct.pack(f"{order}{len(p)}d", *p) for p in points)


def ring(points, order="<"):
    return struct.pack(order + "I", len(points)) + places(points, order)


def test_well_known_binary(spark):
    line = wkb(2, ring([(0, 0), (1, 2)]))
    rows = [
        (1, wkb(1, places([(3, 4)], ">"), ">")), (2, line), (3, wkb(3, struct.pack("<I", 2) + ring(SQUARE) + ring(HOLE))),
        (4, wkb(5, struct.pack("<I", 2) + line + wkb(2, ring([(5, 5), (6, 6)], ">"), ">"))), (5, wkb(1001, places([(1, 2, 9)]))),
        (6, wkb(1, places([(1, 2, 9)]), flags=0xA0000000, srid=5344)), (7, b"\x01\x02"), (8, None), (9, wkb(6, struct.pack("<I", 1) + wkb(3, struct.pack("<I", 1) + ring(SQUARE)))),
    ]
    got = {r.i: (r.kind, r.shapes) for r in vectors.from_wkb(spark.createDataFrame(rows, "i int, kind2 binary"), "kind2").collect()}
    f = lambda v: [[float(a), float(b)] for a, b in v]
    assert got[1] == ("Point", [[f([(3, 4)])]]) and got[2] == ("LineString", [[f([(0, 0), (1, 2)])]]) and got[3] == ("Polygon", [[f(SQUARE), f(HOLE)]])
    assert got[4] == ("MultiLineString", [[f([(0, 0), (1, 2)])], [f([(5, 5), (6, 6)])]]) and got[5] == got[6] == ("Point", [[f([(1, 2)])]])
    assert got[7] == got[8] == (None, None) and got[9] == ("MultiPolygon", [[f(SQUARE)]])
    written = spark.createDataFrame([(1.5, -2.25, 7.0)], "x double, y double, z double").select(sinks.point_wkb(F.col("x"), F.col("y"), F.col("z")).alias("g"))
    assert vectors.from_wkb(written, "g").first().shapes == [[[[1.5, -2.25]]]]
