"""Places along lines, declared lines, beams and profiles over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import beams, joins, reference
from fathom.plans.registry import fixed, fixed_all, query, r, table
from fathom.plans.sequence_queries import LINES, nation_lines


NEAREST = f"""{LINES}, p AS (SELECT s_suppkey, s_acctbal AS x, s_nationkey * 400.0 AS y FROM supplier),
       u AS (SELECT s_suppkey, line, x, y, x0, y0, x1, y1, s0, len, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / (len * len))) AS t FROM p, seg),
       d AS (SELECT s_suppkey, line, x, y, sqrt(power(x - x0 - t * (x1 - x0), 2) + power(y - y0 - t * (y1 - y0), 2)) AS distance, s0 + t * len AS chainage FROM u),
       l AS (SELECT s_suppkey, line, x, y, min(distance) AS distance, arg_min(chainage, distance) AS chainage FROM d GROUP BY ALL),
       ends AS (SELECT line, max(s0 + len) AS total FROM seg GROUP BY 1)"""


@query(
    f"""WITH {NEAREST}, b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY distance, line) AS k FROM l) JOIN ends USING (line) WHERE k = 1),
       a AS (SELECT *, unnest([0, 1, 2, 3, 4]) AS tag, greatest(0, least(total, chainage + unnest([0, -50, 50, -5, 5]))) AS s FROM b),
       q AS (SELECT s_suppkey, tag, arg_max(x0 + least(1, (s - s0) / len) * (x1 - x0), s0) AS px, arg_max(y0 + least(1, (s - s0) / len) * (y1 - y0), s0) AS py FROM a JOIN seg USING (line) WHERE s0 <= s GROUP BY 1, 2),
       w AS (SELECT s_suppkey, {', '.join(f'max(CASE WHEN tag = {k} THEN p{c} END) AS {c}{k}' for k in range(5) for c in 'xy')} FROM q GROUP BY 1)
       SELECT s_suppkey, line, {r('x0', 4)} AS snap_x, {r('y0', 4)} AS snap_y, {r('degrees(atan2(x2 - x1, y2 - y1)) - 360 * floor(degrees(atan2(x2 - x1, y2 - y1)) / 360)', 4)} AS azimuth,
       {r('((x4 - x3) * (y - y0) - (y4 - y3) * (x - x0)) / sqrt(power(x4 - x3, 2) + power(y4 - y3, 2))', 4)} AS "offset" FROM w JOIN b USING (s_suppkey)"""
)
def axis_frame(spark, sf_dir):
    """Suppliers on their nearest line: the place there, the line's direction and the signed offset from it."""
    points = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 400.0).alias("y"))
    lines = nation_lines(spark, sf_dir).withColumn("order", F.col("line"))
    near = joins.nearest_segments(points, ["s_suppkey"], lines, "line", "order", 1).join(points, "s_suppkey")
    rows = reference.tangent(reference.signed_offset(near, lines, "line", "chainage", "x", "y"), lines, "line", "chainage")
    rows = rows.withColumn("azimuth", F.col("tangent.azimuth")).select("s_suppkey", "line", "snap_x", "snap_y", "azimuth", "offset")
    return fixed_all(rows, "snap_x", "snap_y", "azimuth", "offset", digits=4)


@query(
    f"""WITH {NEAREST}, n AS (SELECT s_suppkey, s_nationkey % 7 AS line FROM supplier)
       SELECT s_suppkey, line, {r('distance', 4)} AS distance, {r('chainage', 4)} AS chainage, chainage <= 1e-6 OR chainage >= total - 1e-6 AS at_end
       FROM n JOIN l USING (s_suppkey, line) JOIN ends USING (line)"""
)
def declared_line(spark, sf_dir):
    """Suppliers on the line that they declare; two of seven declare one that is not there."""
    points = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 400.0).alias("y"), (F.col("s_nationkey") % 7).alias("line")
    )
    return fixed_all(reference.on_declared(points, ["s_suppkey"], nation_lines(spark, sf_dir), "line"), "distance", "chainage", digits=4)


@query(
    f"""WITH a AS (SELECT *, radians(l_tax * 1000) AS t, l_discount * 10 AS dx, l_quantity / 10 AS dy FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, {r('l_extendedprice + sin(t) * dx + cos(t) * dy', 4)} AS chainage, {r('l_suppkey + sin(t) * dy - cos(t) * dx', 4)} AS "offset" FROM a"""
)
def footprint_transfer(spark, sf_dir):
    t = F.radians(F.col("l_tax") * 1000)
    s, o = reference.transferred(
        F.col("l_extendedprice"), F.col("l_suppkey"), F.sin(t), F.cos(t), F.col("l_discount") * 10, F.col("l_quantity") / 10
    )
    rows = table(spark, sf_dir, "lineitem").withColumns({"chainage": s, "offset": o})
    return fixed_all(rows.select("l_orderkey", "l_linenumber", "l_partkey", "chainage", "offset"), "chainage", "offset", digits=4)


@query(
    f"""WITH u AS (SELECT vec_id, label, k, abs(CAST(embedding[k + 1] AS DOUBLE)) * 10 AS value FROM embeddings, generate_series(0, 4) t(k)),
       n AS (SELECT *, row_number() OVER (PARTITION BY label, k ORDER BY vec_id) AS i, count(*) OVER (PARTITION BY label, k) AS c0 FROM u),
       pad AS (SELECT label, k, i, value FROM n UNION ALL SELECT label, k, -j, value FROM n, generate_series(0, 4) t(j) WHERE i = 1
         UNION ALL SELECT label, k, c0 + j, value FROM n, generate_series(1, 5) t(j) WHERE i = c0),
       m AS (SELECT label, k, i, median(value) OVER (PARTITION BY label, k ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS smooth FROM pad),
       e AS (SELECT *, value - smooth AS res FROM n JOIN m USING (label, k, i)),
       q AS (SELECT *, count(*) OVER w AS c, quantile_cont(res, 0.75) OVER w - quantile_cont(res, 0.25) OVER w AS iqr
         FROM e WINDOW w AS (PARTITION BY label, k ORDER BY vec_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING EXCLUDE CURRENT ROW)),
       v AS (SELECT vec_id, k, CASE WHEN c0 < 5 OR NOT (abs(res) > greatest(coalesce(CASE WHEN c >= 4 THEN 1.5 * iqr END, 0), 0.05 * abs(value), 0.1)) THEN {r('value')} END AS d FROM q)
       SELECT vec_id, {', '.join(f'max(CASE WHEN k = {k} THEN d END) AS {n}' for k, n in enumerate(['vb', 'b1', 'b2', 'b3', 'b4']))} FROM v GROUP BY 1"""
)
def beam_spikes(spark, sf_dir):
    depth = lambda k: F.abs(F.element_at("embedding", k).cast("double")) * 10
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", depth(1).alias("vb"), F.array(*map(depth, range(2, 6))).alias("b"))
    out = beams.despike_beams(rows, ["label"], "vec_id", "vb", "b", multiplier=1.5, cycles=1)
    return out.select("vec_id", fixed("vb").alias("vb"), *(fixed(F.element_at("b", k)).alias(f"b{k}") for k in range(1, 5)))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_linenumber > 1")
def slant_beams(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("beam_index", F.col("l_linenumber") - 1)
    return beams.selected(rows, "beam_index", "slant").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('1000 + l_quantity * sin(radians(l_tax * 1000))', 4)} AS east,
       {r('2000 + l_quantity * cos(radians(l_tax * 1000))', 4)} AS north, {r("CASE WHEN l_returnflag <> 'N' THEN 250 - l_discount * 10 END", 4)} AS bed FROM lineitem"""
)
def profile_columns(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").withColumn("depth", F.col("l_discount") * 10)
    surface = F.when(F.col("l_returnflag") != "N", F.lit(250.0))
    out = beams.profile_table(rows, "l_quantity", "depth", F.lit(1000.0), F.lit(2000.0), F.col("l_tax") * 1000, surface)
    return fixed_all(out.select("l_orderkey", "l_linenumber", "l_partkey", "east", "north", "bed"), "east", "north", "bed", digits=4)
