"""Sources and sinks on files made here."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.sources import campaign, mat5, sinks, tables
from fathom.streaming.levels import occupations
from fathom.streaming.windows import hourly


def element(kind, body):
    return struct.pack("<II", kind, len(body)) + body + b"\0" * (0 if kind == 15 else -len(body) % 8)


def array(name, value):
    if isinstance(value, dict):
        width = 32
        head = element(6, struct.pack("<II", 2, 0)) + element(5, struct.pack("<ii", 1, 1)) + element(1, name.encode())
        names = b"".join(k.encode().ljust(width, b"\0") for k in value)
        return element(14, head + element(5, struct.pack("<i", width)) + element(1, names) + b"".join(array("", v) for v in value.values()))
    a = np.atleast_2d(np.asarray(value, float))
    head = element(6, struct.pack("<II", 6, 0)) + element(5, struct.pack("<ii", *a.shape)) + element(1, name.encode())
    return element(14, head + element(9, a.astype("<f8").tobytes("F")))


def mat_file(**trees):
    parts = b"".join(element(15, zlib.compress(array(k, v))) if k == "GPS" else array(k, v) for k, v in trees.items())
    return b"MATLAB 5.0".ljust(124) + struct.pack("<H", 0x0100) + b"IM" + parts


def test_transect_files(spark, tmp_path):
    body = mat_file(
        BottomTrack={"VB_Depth": [[1.0], [2.0]], "BT_Beam_Depth": np.arange(8).reshape(2, 4), "BT_Frequency": [[3000.0], [1000.0]]},
        GPS={"UTM": [[5.0, 6.0], [7.0, 8.0]], "Latitude": [[-38.0], [np.nan]], "Longitude": [[-68.0], [-68.0]]},
        System={"Time": [[8.3e8], [8.3e8]]},
        Summary={"Mean_Vel": [[0.1, 0.2], [0.3, 0.4]], "Total_Q": [[1.0], [2.0]]},
    )
    (tmp_path / "t1.mat").write_bytes(body)
    (tmp_path / "bad.mat").write_bytes(b"nothing")
    rows = mat5.read_transects(spark, str(tmp_path)).orderBy("perfil", "ens").collect()
    assert rows[0].perfil == "bad" and rows[0].error
    assert [(r.ens, r.vb_depth, r.bt_beams, r.khz, r.utm_e, r.lat, r.step, r.mean_vn) for r in rows[1:]] == [
        (0, 1.0, [0, 1, 2, 3], 3000.0, 5.0, -38.0, 3.0, 0.2),
        (1, 2.0, [4, 5, 6, 7], 1000.0, 7.0, None, 3.0, 0.4),
    ]


def test_setup_of_transects(spark, tmp_path):
    track = {"VB_Depth": [[1.0], [2.0]], "BT_Beam_Depth": np.ones((2, 4)), "BT_Frequency": [[3000.0], [1000.0]]}
    setup = {"Edges_0__DistanceToBank": [[2.5]], "Edges_1__DistanceToBank": [[4.0]], "startEdge": [[0.0]], "sensorDepth": [[0.06]], "depthReference": [[1.0]]}
    (tmp_path / "a.mat").write_bytes(mat_file(BottomTrack=track, System={"Heading": [[10.0], [20.0]]}, Summary={"Depth": [[1.5], [2.5]]}, Setup=setup))
    (tmp_path / "b.mat").write_bytes(mat_file(BottomTrack=track, System={"True_North_ADP_Heading": [[7.0], [8.0]], "Heading": [[0.0], [0.0]], "Time": [[5.0], [6.0]]}))
    (tmp_path / "c.mat").write_bytes(b"nothing")
    rows = mat5.read_transects(spark, str(tmp_path))
    got = {(r.perfil, r.ens): (r.heading, r.time, r.summary_depth) for r in rows.filter("error is null").collect()}
    assert got == {("a", 0): (10.0, 0.0, 1.5), ("a", 1): (20.0, 1.0, 2.5), ("b", 0): (7.0, 5.0, None), ("b", 1): (8.0, 6.0, None)}
    assert sorted(map(tuple, mat5.transect_setup(rows).collect())) == [("a", 2.5, 4.0, "left", 0.06, "bt", 2), ("b", 0.0, 0.0, "right", 0.0, "vb", 2)]


def test_csv_sources(spark, tmp_path):
    (tmp_path / "ws.csv").write_text("Punto,ESTE,Norte,Cota\np1,1,2,250.5\np2,x,2,3\np3,1,2,\n")
    points, rejected = tables.read_surface_points(spark, str(tmp_path / "ws.csv"))
    assert [(r.id, r.h) for r in points.collect()] == [("p1", 250.5)]
    assert sorted((r.id, r.reason) for r in rejected.collect()) == [("p2", "no place"), ("p3", "no level")]
    (tmp_path / "none.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        tables.read_surface_points(spark, str(tmp_path / "none.csv"))
    (tmp_path / "st.csv").write_text("station_id,name,river,gauge_zero,X,Y\ns1,Uno,Río Negro,250,1,2\ns2,Dos,,,1,2\ns3,Tres,r,1,,\n")
    assert {r.station_id: (r.reason, r.river_key) for r in tables.read_stations(spark, str(tmp_path / "st.csv")).collect()} == {
        "s1": (None, "rio negro"), "s2": ("no gauge zero", None), "s3": ("no place", "r"),
    }
    (tmp_path / "spot.csv").write_text("station_id,nivel\ns1,1.0\ns1,3.0\ns2,2\n")
    readings, mode = tables.read_levels(spark, str(tmp_path / "spot.csv"))
    assert mode == "spot" and {r.station_id: r.level for r in readings.collect()} == {"s1": 2.0, "s2": 2.0}
    (tmp_path / "series.csv").write_text("station_id,datetime,nivel\ns1,2026-04-15 10:00,1.0\ns1,15/04/2026 11:00,3.0\n")
    assert tables.read_levels(spark, str(tmp_path / "series.csv"))[1] == "series"


def test_campaign(tmp_path):
    path = tmp_path / "c.ini"
    path.write_text("[procesamiento]\ndx = 0,25\ncomposite = no\nwhat = 1\n[progresivas]\nNegro = 12.5\n[grupos]\nG1 = a, b; c\n")
    found = campaign.load(str(path), decimate=3)
    assert (found.dx, found.half_width, found.composite, found.decimate) == (0.25, 0.5, False, 3)
    assert found.offsets == {"Negro": 12.5} and found.groups == {"G1": ["a", "b", "c"]} and len(found.warnings) == 1


def test_geometry_bytes(spark, tmp_path):
    values = [(1.0, -2.5, 0.1), (581452.51, 5685261.72, 254.604), (0.0, -0.0, 1e-3), (3.0, 8.0, 2.0**-40)]
    frame = spark.createDataFrame(values, "x double, y double, z double")
    for r in frame.select("*", sinks.point_wkb(F.col("x"), F.col("y"), F.col("z")).alias("g")).collect():
        assert bytes(r.g) == b"\x01" + struct.pack("<I", 1001) + struct.pack("<3d", r.x, r.y + 0.0, r.z)
    sinks.write_points(frame, str(tmp_path / "pts"), "x", "y")
    assert spark.read.parquet(str(tmp_path / "pts")).count() == 4
    sinks.write_csv(frame, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 4


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("r", f"t{i}", f"2026-04-15 10:0{i}:00", float(p)) for i, p in enumerate([0, 10, 20, 21])]
    frame = spark.createDataFrame(rows, "river string, perfil string, ts string, chainage double").withColumn("ts", F.to_timestamp("ts"))
    frame.write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    run = occupations(stream, 15.0).writeStream.format("memory").queryName("runs").outputMode("append").trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert [r.run for r in spark.table("runs").orderBy("perfil").collect()] == [0, 0, 1, 1]
    events = frame.select("ts", F.lit("x").alias("event_type"), F.col("chainage").alias("value"))
    assert [(r.n, r.mean) for r in hourly(events).collect()] == [(4, 12.75)]
