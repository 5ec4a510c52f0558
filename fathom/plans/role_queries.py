"""Roles of surface points and gauges over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import joins, network, roles
from fathom.plans.registry import fixed, fixed_all, query, r, table
from fathom.plans.sequence_queries import RIVERS, on_rivers, rivers

#: A river per nation through its customers, and suppliers as surface points, a fourth of which declare a river.
BENDS = f"""v AS (SELECT c_nationkey AS line, c_custkey AS seq, c_custkey * 3.0::DOUBLE AS x, c_nationkey * 300.0::DOUBLE + c_acctbal / 100 AS y FROM customer),
       g AS (SELECT line, seq, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM v WINDOW w AS (PARTITION BY line ORDER BY seq)),
       e AS (SELECT *, sqrt((x1 - x0) ** 2 + (y1 - y0) ** 2) AS size FROM g WHERE x1 IS NOT NULL),
       b AS (SELECT *, sum(size) OVER (PARTITION BY line ORDER BY seq) - size AS s0, sum(size) OVER (PARTITION BY line) AS total FROM e),
       p AS (SELECT s_suppkey, s_acctbal / 2 AS x, s_nationkey * 300.0 + s_suppkey % 7 * 45.0 AS y, CASE WHEN s_suppkey % 4 = 0 THEN s_nationkey + 1 END AS said FROM supplier),
       u AS (SELECT *, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / (size * size))) AS t FROM p CROSS JOIN b),
       d AS (SELECT s_suppkey, said, line, total, sqrt((x - x0 - t * (x1 - x0)) ** 2 + (y - y0 - t * (y1 - y0)) ** 2) AS far, s0 + t * size AS s FROM u),
       n AS (SELECT s_suppkey, said, line, any_value(total) AS total, min(far) AS far, arg_min(s, far) AS s FROM d GROUP BY ALL),
       k AS (SELECT *, said IS NOT NULL AND said = line AS forced, row_number() OVER (PARTITION BY s_suppkey ORDER BY said = line DESC NULLS LAST, far) AS pick,
         row_number() OVER (PARTITION BY s_suppkey ORDER BY far) AS rank FROM n),
       o AS (SELECT a.*, c.line AS other, c.far AS other_far FROM k a JOIN k c USING (s_suppkey) WHERE a.pick = 1 AND c.rank = CASE WHEN a.rank = 1 THEN 2 ELSE 1 END),
       f AS (SELECT *, CASE WHEN (s <= 1e-6 OR s >= total - 1e-6) AND far > 50 THEN 'beyond the end' WHEN far > 250 THEN 'off the axis' END AS lost FROM o)"""


def bends(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("line"), F.col("c_custkey").alias("seq"), (F.col("c_custkey") * 3.0).alias("x"),
        (F.col("c_nationkey") * 300.0 + F.col("c_acctbal") / 100).alias("y"),
    )
    return joins.segments_of(rows, ["line"], "seq")


def surface_points(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") / 2).alias("x"), (F.col("s_nationkey") * 300.0 + F.col("s_suppkey") % 7 * 45.0).alias("y"),
        F.when(F.col("s_suppkey") % 4 == 0, F.col("s_nationkey") + 1).alias("said"), "s_acctbal",
    )


@query(
    f"""WITH {BENDS} SELECT s_suppkey, line, {r('far', 4)} AS distance, {r('s', 4)} AS chainage, other, {r('other_far', 4)} AS other_distance,
       CASE WHEN lost IS NULL THEN 'anchor' ELSE 'dropped' END AS role,
       CASE WHEN lost IS NOT NULL THEN lost WHEN NOT forced AND other_far - far < 25 THEN 'ambiguous' WHEN forced THEN 'declared' WHEN said IS NOT NULL THEN 'not there' END AS note FROM f"""
)
def point_roles(spark, sf_dir):
    out = roles.point_roles(surface_points(spark, sf_dir), "s_suppkey", bends(spark, sf_dir), "line", "said")
    return fixed_all(out, "distance", "chainage", "other_distance", digits=4)


MERGED = """m AS (SELECT c_nationkey AS line, c_custkey, floor(c_acctbal / 50) AS s, c_acctbal AS h FROM customer)"""


@query(
    f"""WITH {MERGED} SELECT line, string_agg(CAST(c_custkey AS VARCHAR), '+' ORDER BY c_custkey) AS ids, s, {r('avg(h)')} AS h, count(*) AS n FROM m GROUP BY line, s"""
)
def merged_points(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("line"), "c_custkey", F.floor(F.col("c_acctbal") / 50).cast("double").alias("s"), F.col("c_acctbal").alias("h")
    )
    return roles.merged_points(rows, "c_custkey", "line", "s", "h").select("line", "ids", "s", fixed("h").alias("h"), "n")


@query(
    f"""WITH RECURSIVE {RIVERS}, a AS (SELECT s_suppkey AS river, abs(s_acctbal) / 10 AS s FROM supplier),
       q AS (SELECT head, min(p0 + s - s0) AS lo, max(p0 + s - s0) AS hi FROM a JOIN w USING (river) WHERE s BETWEEN s0 - 2 AND s1 + 2 GROUP BY 1),
       g AS (SELECT c_custkey, c_custkey // 15 AS river, c_acctbal / 10 AS s, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS level,
         CASE WHEN c_acctbal < 0 THEN 'below zero' END AS reason FROM customer),
       i AS (SELECT DISTINCT c_custkey FROM g JOIN w USING (river) JOIN q USING (head) WHERE s BETWEEN s0 - 2 AND s1 + 2 AND lo < p0 + s - s0 - 0.5 AND hi > p0 + s - s0 + 0.5)
       SELECT c_custkey, CASE WHEN reason IS NOT NULL THEN 'excluded' WHEN level IS NULL THEN 'no reading' WHEN c_custkey IN (SELECT c_custkey FROM i) THEN 'qc' ELSE 'anchor' END AS role FROM g"""
)
def gauge_roles(spark, sf_dir):
    """Customers as gauges on the rivers of the network, suppliers as the surface points that may lie on both sides of them."""
    level = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("level"), F.when(F.col("c_acctbal") < 0, "below zero").alias("reason")
    )
    gauges = on_rivers(spark, sf_dir, F.col("c_acctbal") / 10).join(level, "c_custkey")
    anchors = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("on_river"), (F.abs("s_acctbal") / 10).alias("s"))
    parts = network.paths(*rivers(spark, sf_dir))
    out = roles.gauge_roles(gauges, "c_custkey", anchors, parts, "on_river", "s", "level", F.col("reason"))
    return out.select("c_custkey", "role")
