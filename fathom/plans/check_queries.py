"""Quality checks, directions and names over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.angles import undirected_difference
from fathom.functions.text import beam_label
from fathom.operators import grouping, network, surface, survey
from fathom.plans.registry import fixed, fixed_all, query, r, table
from fathom.plans.sequence_queries import ANCHORS, RIVERS, events, on_rivers, rivers


@query(
    f"""WITH e AS (SELECT user_id, arg_min(value, event_id) AS ax, min(event_id) AS ay, arg_max(value, event_id) AS bx, max(event_id) AS bo FROM events GROUP BY 1),
       a AS (SELECT user_id, degrees(atan2(bx - ax, bo - ay)) AS t FROM e), d AS (SELECT user_id, abs((t - 30 + 90) - 180 * floor((t - 30 + 90) / 180) - 90) AS angle FROM a)
       SELECT user_id, {r('angle')} AS angle, {r('1 - abs(cos(radians(angle)))')} AS width_lost FROM d"""
)
def orientation_check(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", "event_id", "value", F.col("event_id").alias("north"))
    return fixed_all(survey.orientation(rows, ["user_id"], "event_id", "value", "north", F.lit(30.0)), "angle", "width_lost")


@query(
    f"""WITH v AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
       a AS (SELECT label, 90 - degrees(0.5 * atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y))) AS b FROM v GROUP BY 1)
       SELECT label, {r('b - 180 * floor(b / 180)')} AS bearing FROM a"""
)
def principal_direction(spark, sf_dir):
    part = lambda i: F.element_at("embedding", i).cast("double")
    rows = table(spark, sf_dir, "embeddings").select("label", part(1).alias("x"), part(2).alias("y"))
    return fixed_all(survey.principal_bearing(rows, ["label"], "x", "y"), "bearing")


@query(
    """SELECT o_custkey, CASE WHEN count(*) > 1 THEN min(o_orderpriority) || '_x' || count(*) ELSE min(o_orderpriority) END AS group_id,
       count(*) AS n_members FROM orders GROUP BY 1"""
)
def occupation_names(spark, sf_dir):
    return grouping.group_names(table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority"), ["o_custkey"], "o_orderpriority")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber - 1 = 0 THEN 'VB' WHEN l_linenumber > 5 THEN 'BT' ELSE 'B' || (l_linenumber - 1) END AS beam FROM lineitem"""
)
def beam_labels(spark, sf_dir):
    index = F.when(F.col("l_linenumber") > 5, -1).otherwise(F.col("l_linenumber") - 1)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", beam_label(index).alias("beam"))


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('abs((l_quantity * 11 - l_extendedprice / 100 + 90) - 180 * floor((l_quantity * 11 - l_extendedprice / 100 + 90) / 180) - 90)')} AS angle FROM lineitem"""
)
def undirected_angles(spark, sf_dir):
    angle = undirected_difference(F.col("l_quantity") * 11, F.col("l_extendedprice") / 100)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fixed(angle).alias("angle"))


@query(
    f"""WITH {ANCHORS} SELECT path, 0 AS "end", {r('s0')} AS slope, {r('h0')} AS h FROM f UNION ALL SELECT path, 1, {r('s1')}, {r('h1')} FROM f"""
)
def end_slopes(spark, sf_dir):
    anchors = events(spark, sf_dir).filter("event_type in ('view', 'error')").select(
        F.col("user_id").alias("path"), F.col("event_id").cast("double").alias("p"), (F.col("value") / 100).alias("h"),
        F.array(F.lit("gnss")).alias("deps"),
    )
    out = surface.end_slopes(anchors, default=-0.0005)
    return out.select("path", "end", fixed("slope").alias("slope"), fixed("a.h").alias("h"))


@query(
    f"""WITH RECURSIVE {RIVERS}, j AS (SELECT down AS river, s_join AS s, string_agg(CAST(river AS VARCHAR), ',' ORDER BY river) AS ups FROM k GROUP BY 1, 2),
       t AS (SELECT head, max(p0 + s1 - s0) AS whole FROM w GROUP BY 1)
       SELECT j.river, j.s, ups, {r('min(whole - p0 - (s - s0))')} AS to_outlet FROM j JOIN w ON w.river = j.river AND s >= s0 - 2 JOIN t USING (head) GROUP BY 1, 2, 3"""
)
def junction_order(spark, sf_dir):
    lines, into = rivers(spark, sf_dir)
    out = network.junctions(into, network.paths(lines, into))
    return out.select("river", "s", F.array_join(F.col("ups").cast("array<string>"), ",").alias("ups"), fixed("to_outlet").alias("to_outlet"))


@query()
def resolved_levels(spark, sf_dir):
    """Levels of customers' places: the mean of what the paths through them interpolate between suppliers' levels."""
    lines, into = rivers(spark, sf_dir)
    parts = network.paths(lines, into)
    points = network.positions(on_rivers(spark, sf_dir, F.col("c_acctbal") / 10), parts, "on_river", "s").withColumnRenamed("head", "path")
    known = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("on_river"), (F.abs("s_acctbal") / 10).alias("s"))
    anchors = network.positions(known, parts, "on_river", "s").select(
        F.col("head").alias("path"), "p", (260 - F.col("p") / 1000).alias("h"),
        F.array(F.when(F.col("s_suppkey") % 4 == 0, "gnss").otherwise("gauge")).alias("deps"),
    )
    anchors = anchors.groupBy("path", "p").agg(F.avg("h").alias("h"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("deps")))).alias("deps"))
    out = surface.evaluate(points, anchors, surface.end_slopes(anchors))
    return fixed_all(surface.resolved(out, ["c_custkey"]), "ws_elev", "extrap_m", "path_spread")
