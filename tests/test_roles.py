"""Roles of surface points and gauges on small rivers with known answers."""

from fathom.operators import joins, network, roles


def bed(spark):
    rows = [("Río Uno", 0, 0.0, 0.0), ("Río Uno", 1, 1000.0, 0.0), ("Dos", 0, 0.0, 100.0), ("Dos", 1, 1000.0, 100.0)]
    return joins.segments_of(spark.createDataFrame(rows, "line string, n int, x double, y double"), ["line"], "n")


def test_points_on_rivers(spark):
    nan = float("nan")
    asked = [
        (1, 500.0, 10.0, None), (2, 500.0, 45.0, None), (3, 500.0, 10.0, " dos "), (4, 500.0, 20.0, "tres"), (5, 1060.0, 0.0, None),
        (6, 500.0, -260.0, None), (7, nan, 0.0, None), (8, None, None, "RIO UNO"), (9, 1040.0, 0.0, "rio uno"),
    ]
    points = spark.createDataFrame(asked, "id int, x double, y double, said string")
    got = {r.id: (r.line, r.distance, r.role, r.note) for r in roles.point_roles(points, "id", bed(spark), "line", "said").collect()}
    assert got == {
        1: ("Río Uno", 10.0, "anchor", None), 2: ("Río Uno", 45.0, "anchor", "ambiguous"), 3: ("Dos", 90.0, "anchor", "declared"),
        4: ("Río Uno", 20.0, "anchor", "not there"), 5: ("Río Uno", 60.0, "dropped", "beyond the end"), 6: ("Río Uno", 260.0, "dropped", "off the axis"),
        7: (None, None, "dropped", "no place"), 8: (None, None, "dropped", "no place"), 9: ("Río Uno", 40.0, "anchor", "declared"),
    }
    alone = roles.point_roles(points.filter("id = 2"), "id", bed(spark).filter("line = 'Dos'"), "line").first()
    assert (alone.line, alone.other, alone.note) == ("Dos", None, None)
    assert roles.point_roles(points.filter("id > 99"), "id", bed(spark), "line", "said").count() == 0


def test_points_of_one_place_merge(spark):
    rows = [(1, "a", 5.0, 2.0), (2, "a", 5.009, 4.0), (3, "a", 5.012, 6.0), (4, "a", None, 1.0), (5, "b", 5.0, float("nan")), (6, "b", 5.0, 7.0)]
    out = roles.merged_points(spark.createDataFrame(rows, "id int, line string, s double, h double"), "id", "line", "s", "h").collect()
    assert sorted((r.line, r.ids, round(r.s, 6), r.h, r.n) for r in out) == [("a", "1+2", 5.0045, 3.0, 2), ("a", "3", 5.012, 6.0, 1), ("b", "6", 5.0, 7.0, 1)]


def test_gauges_between_points_only_check(spark):
    """Two branches meet in one river: points on branch a and below the junction hold gauges on their path, not those on b."""
    rivers = spark.createDataFrame([("a", 1000.0), ("b", 1000.0), ("c", 2000.0)], "river string, length double")
    down = spark.createDataFrame([("a", "c", 0.0), ("b", "c", 0.0)], "river string, down string, s_join double")
    parts = network.paths(rivers, down)
    anchors = spark.createDataFrame([("a", 200.0), ("c", 500.0)], "river string, s double")
    asked = [
        (1, "a", 500.0, 1.0), (2, "a", 200.4, 1.0), (3, "b", 500.0, 1.0), (4, "c", 100.0, 1.0), (5, "c", 900.0, 1.0), (6, "a", 600.0, None),
        (7, "z", 5.0, 1.0), (8, "a", None, 1.0), (9, "a", 500.0, 1.0),
    ]
    gauges = spark.createDataFrame(asked, "id int, river string, s double, level double").selectExpr("*", "case when id = 9 then 'no zero' end as why")
    got = {r.id: r.role for r in roles.gauge_roles(gauges, "id", anchors, parts, "river", "s", "level", gauges.why).collect()}
    assert got == {1: "qc", 2: "anchor", 3: "anchor", 4: "qc", 5: "anchor", 6: "no reading", 7: "anchor", 8: "anchor", 9: "excluded"}
    none = roles.gauge_roles(gauges.filter("id = 1"), "id", anchors.filter("s < 0"), parts, "river", "s", "level").first()
    assert none.role == "anchor"
