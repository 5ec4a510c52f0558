"""Resampled repetitions, numbered clouds and merged axes over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.operators import aggregates, axes, blocks, sequence
from fathom.plans.registry import SQL, fixed, fixed_all, query, r, table
from fathom.plans.sequence_queries import events
from fathom.sources import clouds

RESAMPLED = """rep AS (SELECT l_suppkey, l_linenumber AS rep, l_extendedprice AS s, avg(l_quantity) AS v FROM lineitem GROUP BY ALL),
       m AS (SELECT l_suppkey, CAST(floor(l_extendedprice / 5000) AS BIGINT) AS node, floor(l_extendedprice / 5000) * 5000 + 2500 AS s, avg(l_quantity) AS merged FROM lineitem GROUP BY ALL),
       rng AS (SELECT l_suppkey, rep, min(s) AS lo, max(s) AS hi FROM rep GROUP BY ALL),
       a AS (SELECT m.*, rep FROM m JOIN rng USING (l_suppkey) WHERE lo < hi AND s BETWEEN lo AND hi),
       b AS (SELECT a.*, x.s AS s0, x.v AS v0 FROM a ASOF JOIN rep x ON a.l_suppkey = x.l_suppkey AND a.rep = x.rep AND a.s >= x.s),
       c AS (SELECT b.*, x.s AS s1, x.v AS v1 FROM b ASOF JOIN rep x ON b.l_suppkey = x.l_suppkey AND b.rep = x.rep AND b.s <= x.s),
       i AS (SELECT l_suppkey, node, rep, merged, CASE WHEN s1 > s0 THEN v0 + (v1 - v0) * (s - s0) / (s1 - s0) ELSE v0 END AS v FROM c)"""


def _resampled(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_linenumber").alias("rep"), F.col("l_extendedprice").alias("s"), "l_quantity")
    node = F.floor(F.col("s") / 5000).cast("long")
    merged = rows.groupBy("l_suppkey", node.alias("node")).agg(F.avg("l_quantity").alias("merged")).withColumn("s", F.col("node") * 5000.0 + 2500)
    return rows, aggregates.resampled(rows, ["l_suppkey"], "rep", "s", "l_quantity", merged)


@query(
    f"""WITH {RESAMPLED}, t AS (SELECT l_suppkey, count(DISTINCT rep) AS every FROM rep GROUP BY 1)
       SELECT l_suppkey, node, count(*) AS n, {r("stddev_pop(v)", 5)} AS sigma, count(*) = any_value(every) AS common FROM i JOIN t USING (l_suppkey) GROUP BY 1, 2"""
)
def resampled_spread(spark, sf_dir):
    """Spread of repetitions interpolated on their group's merged grid, each within its own range."""
    rows, on_grid = _resampled(spark, sf_dir)
    out = aggregates.node_spread(on_grid, ["l_suppkey"], "node", "rep", "resampled", rows.select("l_suppkey", "rep"))
    return fixed_all(out, "sigma", digits=5)


@query(f"""WITH {RESAMPLED} SELECT l_suppkey, rep, count(*) AS n, {r("sqrt(avg((v - merged) * (v - merged)))", 5)} AS rms FROM i GROUP BY 1, 2""")
def resampled_misfit(spark, sf_dir):
    """Each repetition against the merged profile, over the nodes that it reaches."""
    _, on_grid = _resampled(spark, sf_dir)
    return fixed_all(aggregates.repetition_misfit(on_grid, ["l_suppkey"], "rep", "resampled", "merged"), "rms", digits=5)


@query(
    """SELECT row_number() OVER (ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey) - 1 AS pt_id, l_suppkey, l_orderkey, l_linenumber, l_partkey FROM lineitem"""
)
def point_ids(spark, sf_dir):
    """All lines of orders numbered without gaps, by supplier."""
    names = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey"]
    return clouds.numbered(table(spark, sf_dir, "lineitem").select(*names), names)


@query(
    f"""WITH o AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS k FROM orders),
       p AS (SELECT o_custkey, o_orderkey, CAST(k * 100 AS DOUBLE) AS x, o_totalprice / 100 AS y, lead(o_totalprice / 100) OVER (PARTITION BY o_custkey ORDER BY k) AS y1 FROM o),
       s AS (SELECT * FROM p WHERE y1 IS NOT NULL),
       a AS (SELECT o_custkey, count(*) AS n_parts, sum(sqrt(10000 + (y1 - y) * (y1 - y))) AS length, 2 * count(*) FILTER (o_orderkey % 2 = 0) - count(*) AS lead_of, arg_min(o_orderkey, o_orderkey) AS line, min(x) AS x0, CAST(max(x) + 100 AS DOUBLE) AS x1 FROM s GROUP BY 1)
       SELECT o_custkey, n_parts, {r("length", 3)} AS length, line, CASE WHEN lead_of > 0 OR lead_of = 0 AND line % 2 = 0 THEN x0 ELSE x1 END AS x_first, CASE WHEN lead_of > 0 OR lead_of = 0 AND line % 2 = 0 THEN x1 ELSE x0 END AS x_last FROM a"""
)
def merged_axes(spark, sf_dir):
    """Each customer's orders as parts of a line, those with odd keys drawn the other way: the one line that they merge to."""
    seq = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_totalprice") / 100).alias("y"), (F.row_number().over(seq) - 1).alias("k"))
    o = o.withColumn("y1", F.lead("y").over(seq)).filter("y1 is not null")
    a, b = F.struct((F.col("k") * 100.0).alias("x"), "y"), F.struct((F.col("k") * 100.0 + 100).alias("x"), F.col("y1").alias("y"))
    parts = o.select(F.col("o_custkey").alias("river"), F.col("o_orderkey").alias("part"), F.posexplode(F.when(F.col("o_orderkey") % 2 == 0, F.array(a, b)).otherwise(F.array(b, a))).alias("seq", "p"))
    lines, places = axes.merged_lines(parts.select("river", "part", "seq", "p.x", "p.y"))
    ends = places.groupBy("river", "line").agg(F.min_by("x", "seq").alias("x_first"), F.max_by("x", "seq").alias("x_last"))
    out = lines.join(ends, ["river", "line"]).withColumnRenamed("river", "o_custkey")
    return fixed_all(out.select("o_custkey", "n_parts", "length", "line", "x_first", "x_last"), "length", digits=3)


@query(SQL["running_iqr"])
def block_iqr(spark, sf_dir):
    """The running interquartile range of users' events, in blocks of 2,000 events with a halo of 10."""
    running = lambda rows, keys, order: sequence.running_iqr(rows, keys, order, "value")
    out = blocks.in_blocks(events(spark, sf_dir), ["user_id"], ["event_id"], 10, running, size=2000)
    return out.select("event_id", "user_id", fixed("iqr").alias("iqr"))
