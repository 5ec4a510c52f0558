"""Ordered rows, joins, networks and geometry over the given tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fathom.functions import angles
from fathom.functions.text import decoded_epoch, folded_name
from fathom.operators import grouping, joins, network, sequence, surface, survey
from fathom.plans.registry import fixed, fixed_all, query, r, table


def events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


@query(
    f"""WITH c AS (SELECT event_id, user_id, value, count(value) OVER w AS n, quantile_cont(value, 0.75) OVER w - quantile_cont(value, 0.25) OVER w AS q
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING EXCLUDE CURRENT ROW))
       SELECT event_id, user_id, CASE WHEN n >= 4 THEN {r('q')} END AS iqr FROM c"""
)
def running_iqr(spark, sf_dir):
    out = sequence.running_iqr(events(spark, sf_dir), ["user_id"], ["event_id"], "value")
    return out.select("event_id", "user_id", fixed("iqr").alias("iqr"))


RUNNING = """n AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i,
       count(*) OVER (PARTITION BY user_id) AS k FROM events),
       pad AS (SELECT user_id, i, value FROM n UNION ALL SELECT user_id, -j, value FROM n, generate_series(0, 4) t(j) WHERE i = 1
         UNION ALL SELECT user_id, k + j, value FROM n, generate_series(1, 5) t(j) WHERE i = k),
       m AS (SELECT user_id, i, median(value) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) AS smooth FROM pad)"""


@query(f"WITH {RUNNING} SELECT event_id, user_id, {r('smooth')} AS smooth FROM n JOIN m USING (user_id, i)")
def running_median(spark, sf_dir):
    out = sequence.running_median(events(spark, sf_dir), ["user_id"], ["event_id"], "value")
    return out.select("event_id", "user_id", fixed("smooth").alias("smooth"))


@query(
    f"""WITH {RUNNING}, e AS (SELECT event_id, user_id, value, value - smooth AS res FROM n JOIN m USING (user_id, i)),
       q AS (SELECT *, count(*) OVER w AS c, quantile_cont(res, 0.75) OVER w - quantile_cont(res, 0.25) OVER w AS iqr
         FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING EXCLUDE CURRENT ROW))
       SELECT event_id, user_id, NOT (abs(res) > greatest(coalesce(CASE WHEN c >= 4 THEN 1.5 * iqr END, 0), 0.05 * abs(value), 0.1)) AS valid FROM q"""
)
def despike_once(spark, sf_dir):
    out = sequence.despike(events(spark, sf_dir), ["user_id"], "event_id", "value", multiplier=1.5, cycles=1, positive=False, at_least=1)
    return out.select("event_id", "user_id", "valid")


@query()
def despike(spark, sf_dir):
    out = sequence.despike(events(spark, sf_dir), ["user_id"], "event_id", "value", multiplier=1.5)
    return out.select("event_id", "user_id", "valid")


@query(
    f"""WITH v AS (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events),
       n AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER a AS lp, last_value(v IGNORE NULLS) OVER a AS lv,
         first_value(CASE WHEN v IS NOT NULL THEN event_id END IGNORE NULLS) OVER b AS hp, first_value(v IGNORE NULLS) OVER b AS hv FROM v
         WINDOW a AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         b AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
       SELECT event_id, user_id, {r('coalesce(v, lv + (hv - lv) * ((event_id - lp) / nullif(hp - lp, 0)), lv, hv)')} AS filled FROM n"""
)
def gap_interpolate(spark, sf_dir):
    rows = events(spark, sf_dir).withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    return fixed_all(sequence.gap_interpolate(rows, ["user_id"], "event_id", "value").select("event_id", "user_id", "filled"), "filled")


@query(
    f"""WITH a AS (SELECT event_id, user_id FROM events WHERE event_type = 'click'), b AS (SELECT event_id AS p, user_id, value AS h FROM events WHERE event_type = 'view'),
       l AS (SELECT a.event_id, a.user_id, max(p) AS lp, arg_max(h, p) AS lh FROM a JOIN b ON a.user_id = b.user_id AND p <= event_id GROUP BY 1, 2),
       u AS (SELECT a.event_id, a.user_id, min(p) AS hp, arg_min(h, p) AS hh FROM a JOIN b ON a.user_id = b.user_id AND p >= event_id GROUP BY 1, 2)
       SELECT a.event_id, a.user_id, {r('coalesce(lh + (hh - lh) * ((a.event_id - lp) / nullif(hp - lp, 0)), lh, hh)')} AS stage
       FROM a LEFT JOIN l USING (event_id) LEFT JOIN u USING (event_id)"""
)
def asof_interp_stage(spark, sf_dir):
    rows = events(spark, sf_dir)
    points = rows.filter("event_type = 'click'").select("event_id", "user_id")
    out = sequence.asof_interpolate(points, rows.filter("event_type = 'view'"), ["user_id"], "event_id", "value", "stage")
    return fixed_all(out, "stage")


@query(
    f"""WITH n AS (SELECT event_id, user_id, value, lag(value, 2) OVER w AS a, lag(value) OVER w AS b, lead(value) OVER w AS c, lead(value, 2) OVER w AS d
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
       SELECT event_id, user_id, {r('(-3 * a + 12 * b + 17 * value + 12 * c - 3 * d) / 35')} AS smooth FROM n WHERE a IS NOT NULL AND d IS NOT NULL"""
)
def savgol5(spark, sf_dir):
    from pyspark.sql import Window

    seq = Window.partitionBy("user_id").orderBy("event_id")
    out = sequence.smooth(events(spark, sf_dir), ["user_id"], ["event_id"], "value", 5)
    inner = F.lag("value", 2).over(seq).isNotNull() & F.lead("value", 2).over(seq).isNotNull()
    return out.withColumn("inner", inner).filter("inner").select("event_id", "user_id", fixed("smooth").alias("smooth"))


@query(
    f"""SELECT * FROM (SELECT event_id, user_id, {r('lead(value) OVER (PARTITION BY user_id ORDER BY event_id) - value')} AS rise FROM events) WHERE rise > 50"""
)
def monotonic_check(spark, sf_dir):
    out = sequence.rises(events(spark, sf_dir), ["user_id"], ["event_id"], "value", 50.0)
    # a rise of 50 that rounding errors lift above it is none
    return out.select("event_id", "user_id", fixed("rise").alias("rise")).filter("rise > 50")


@query(
    """WITH g AS (SELECT event_id, user_id, event_id - lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS gap FROM events),
       m AS (SELECT user_id, median(gap) AS mid FROM g GROUP BY 1),
       c AS (SELECT event_id, user_id, CASE WHEN gap > greatest(3 * mid, 20) THEN 1 ELSE 0 END AS cut FROM g JOIN m USING (user_id))
       SELECT event_id, user_id, CAST(sum(cut) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS session FROM c"""
)
def gap_sessions(spark, sf_dir):
    out = sequence.gap_sessions(events(spark, sf_dir), ["user_id"], "event_id", 3.0, 20.0)
    return out.select("event_id", "user_id", "session")


@query(
    """SELECT event_id, user_id, row_number() OVER w = 1 OR event_type <> lag(event_type) OVER w AS starts FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""
)
def run_starts(spark, sf_dir):
    return sequence.run_starts(events(spark, sf_dir), ["user_id"], ["event_id"], "event_type").select("event_id", "user_id", "starts")


@query(
    """WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
       f AS (SELECT event_id, user_id, i, value AS lv, event_type AS lt, 0 AS run FROM e WHERE i = 1 UNION ALL
         SELECT e.event_id, e.user_id, e.i, CASE WHEN e.event_type = f.lt OR abs(e.value - f.lv) <= 25 THEN f.lv ELSE e.value END,
           CASE WHEN e.event_type = f.lt OR abs(e.value - f.lv) <= 25 THEN f.lt ELSE e.event_type END,
           CASE WHEN e.event_type = f.lt OR abs(e.value - f.lv) <= 25 THEN f.run ELSE f.run + 1 END
         FROM f JOIN e ON e.user_id = f.user_id AND e.i = f.i + 1)
       SELECT event_id, user_id, run FROM f"""
)
def leader_groups(spark, sf_dir):
    joins_run = lambda a, b: (a["event_type"] == b["event_type"]) | (abs(a["value"] - b["value"]) <= 25)
    out = grouping.leader_runs(events(spark, sf_dir), ["user_id"], ["event_id"], ["event_type", "value"], joins_run)
    return out.select("event_id", "user_id", "run")


@query(
    f"""WITH RECURSIVE e AS (SELECT o_custkey, o_totalprice / 1000 AS s, o_orderkey AS v, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS i FROM orders),
       f AS (SELECT o_custkey, s, v, i, s AS lead, 0 AS run FROM e WHERE i = 1 UNION ALL
         SELECT e.o_custkey, e.s, e.v, e.i, CASE WHEN e.s - f.lead <= 40 THEN f.lead ELSE e.s END, CASE WHEN e.s - f.lead <= 40 THEN f.run ELSE f.run + 1 END
         FROM f JOIN e ON e.o_custkey = f.o_custkey AND e.i = f.i + 1)
       SELECT o_custkey, run, {r('min(s)')} AS place, {r('avg(v)')} AS mean, count(*) AS n FROM f GROUP BY 1, 2"""
)
def coincident_merge(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", (F.col("o_totalprice") / 1000).alias("s"), F.col("o_orderkey").alias("v"))
    return fixed_all(grouping.coincident(rows, ["o_custkey"], "s", "v", 40.0), "place", "mean")


@query(
    f"""WITH v AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y, CAST(embedding[3] AS DOUBLE) * 10 AS d,
         list_transform(embedding[4:7], lambda z: CAST(z AS DOUBLE) * 10) AS b, CAST(embedding[8] AS DOUBLE) * 90 AS h FROM embeddings),
       p AS (SELECT vec_id, 0 AS beam_index, x AS e, y AS n, d AS depth, 1.0 AS w FROM v WHERE d > 0 UNION ALL
         SELECT vec_id, k, x + b[k] * tan(radians(25)) * sin(radians(h + 90 * (k - 1))), y + b[k] * tan(radians(25)) * cos(radians(h + 90 * (k - 1))), b[k], 0.5
         FROM v, (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS k) WHERE b[k] > 0)
       SELECT vec_id, beam_index, {r('e')} AS e, {r('n')} AS n, {r('depth')} AS depth, {r('e * sin(radians(30)) + n * cos(radians(30))')} AS s,
       {r('w * exp(-0.5 * power(abs(n * sin(radians(30)) - e * cos(radians(30))) / 30, 2))')} AS weight FROM p"""
)
def beam_explode(spark, sf_dir):
    part = lambda i, k: (F.element_at("embedding", i).cast("double") * k)
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        part(1, 100).alias("x"),
        part(2, 100).alias("y"),
        part(3, 10).alias("d"),
        F.transform(F.slice("embedding", 4, 4), lambda z: z.cast("double") * 10).alias("b"),
        part(8, 90).alias("h"),
    )
    cloud = survey.beam_cloud(rows, ["vec_id"], "x", "y", "d", "b", F.col("h"), F.lit(3000.0))
    out = survey.on_section(cloud, F.lit(0.0), F.lit(0.0), F.lit(30.0), 30.0)
    return fixed_all(out, "e", "n", "depth", "s", "weight").select("vec_id", "beam_index", "e", "n", "depth", "s", "weight")


def nation_lines(spark, sf_dir):
    """A polyline per region through its nations, for want of rivers in the tables."""
    rows = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("line"),
        F.col("n_nationkey").alias("seq"),
        (F.col("n_nationkey") * 400.0).alias("x"),
        (F.col("n_regionkey") * 2000.0 + (F.col("n_nationkey") * 37) % 11 * 90.0).alias("y"),
    )
    return joins.segments_of(rows, ["line"], "seq")


LINES = """v AS (SELECT n_regionkey AS line, n_nationkey AS seq, n_nationkey * 400.0::DOUBLE AS x, n_regionkey * 2000.0::DOUBLE + (n_nationkey * 37) % 11 * 90.0::DOUBLE AS y FROM nation),
       sg AS (SELECT line, seq, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM v WINDOW w AS (PARTITION BY line ORDER BY seq)),
       s AS (SELECT *, sqrt(power(x1 - x0, 2) + power(y1 - y0, 2)) AS len FROM sg WHERE x1 IS NOT NULL),
       seg AS (SELECT *, sum(len) OVER (PARTITION BY line ORDER BY seq) - len AS s0 FROM s)"""


@query(
    f"""WITH {LINES}, p AS (SELECT s_suppkey, s_acctbal AS x, s_nationkey * 400.0 AS y FROM supplier),
       u AS (SELECT s_suppkey, line, x, y, x0, y0, x1, y1, s0, len, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / (len * len))) AS t FROM p, seg),
       d AS (SELECT s_suppkey, line, sqrt(power(x - x0 - t * (x1 - x0), 2) + power(y - y0 - t * (y1 - y0), 2)) AS distance, s0 + t * len AS chainage FROM u),
       l AS (SELECT s_suppkey, line, min(distance) AS distance, arg_min(chainage, distance) AS chainage FROM d GROUP BY 1, 2),
       k AS (SELECT *, CAST(row_number() OVER (PARTITION BY s_suppkey ORDER BY distance, line) AS INTEGER) AS rank FROM l)
       SELECT s_suppkey, line, {r('distance', 4)} AS distance, {r('chainage', 4)} AS chainage, rank FROM k WHERE rank <= 2"""
)
def nearest_segment(spark, sf_dir):
    points = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_acctbal").alias("x"), (F.col("s_nationkey") * 400.0).alias("y"))
    lines = nation_lines(spark, sf_dir).withColumn("order", F.col("line"))
    out = joins.nearest_segments(points, ["s_suppkey"], lines, "line", "order", 2)
    return fixed_all(out, "distance", "chainage", digits=4)


@query(
    f"""WITH {LINES}, p AS (SELECT s_suppkey, s_acctbal AS ax, s_nationkey * 400.0::DOUBLE AS ay, s_acctbal + 500 AS bx, s_nationkey * 400.0::DOUBLE + 3000 AS ey FROM supplier),
       c AS (SELECT *, (bx - ax) * (y1 - y0) - (ey - ay) * (x1 - x0) AS det FROM p, seg),
       t AS (SELECT *, ((x0 - ax) * (y1 - y0) - (y0 - ay) * (x1 - x0)) / det AS share, ((x0 - ax) * (ey - ay) - (y0 - ay) * (bx - ax)) / det AS u FROM c WHERE det <> 0)
       SELECT s_suppkey, line, CAST(seq AS INTEGER) AS seg_no, {r('ax + share * (bx - ax)', 4)} AS px, {r('ay + share * (ey - ay)', 4)} AS py FROM t WHERE share BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1"""
)
def segment_crossing(spark, sf_dir):
    y = F.col("s_nationkey") * 400.0
    sections = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("ax"), y.alias("ay"), (F.col("s_acctbal") + 500).alias("bx"), (y + 3000).alias("by")
    )
    out = joins.crossings(sections, ["s_suppkey"], nation_lines(spark, sf_dir), 1000.0)
    return fixed_all(out.select("s_suppkey", "line", "seg_no", "px", "py"), "px", "py", digits=4)


def rivers(spark, sf_dir):
    """Suppliers as rivers: supplier k flows into supplier k // 3, somewhere along it."""
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("river"))
    lines = suppliers.select("river", (1000.0 + F.col("river") % 25 * 10).alias("length"))
    join = F.when(F.col("river") % 3 == 0, F.lit(0.0)).otherwise((F.col("river") % 7) * 100.0)
    return lines, suppliers.filter("river > 0").select("river", F.expr("river div 3").alias("down"), join.alias("s_join"))


def on_rivers(spark, sf_dir, s):
    """Customers as places on rivers, fifteen a river, at chainage ``s``."""
    return table(spark, sf_dir, "customer").select("c_custkey", F.expr("c_custkey div 15").alias("on_river"), s.alias("s"))


RIVERS = """l AS (SELECT s_suppkey AS river, 1000.0::DOUBLE + s_suppkey % 25 * 10 AS length FROM supplier),
       k AS (SELECT s_suppkey AS river, s_suppkey // 3 AS down, CASE WHEN s_suppkey % 3 = 0 THEN 0.0 ELSE (s_suppkey % 7) * 100.0 END::DOUBLE AS s_join FROM supplier WHERE s_suppkey > 0),
       w AS (SELECT river AS head, 0 AS k, river, 0.0::DOUBLE AS s0, length AS s1, 0.0::DOUBLE AS p0 FROM l WHERE river NOT IN (SELECT down FROM k WHERE s_join <= 2)
         UNION ALL SELECT w.head, w.k + 1, k.down, k.s_join, l.length, w.p0 + w.s1 - w.s0 FROM w JOIN k ON k.river = w.river JOIN l ON l.river = k.down)"""


@query(f"WITH RECURSIVE {RIVERS} SELECT head, k, river, s0, s1, p0 FROM w")
def path_chainage(spark, sf_dir):
    return network.paths(*rivers(spark, sf_dir))


@query(
    f"""WITH RECURSIVE {RIVERS}, p AS (SELECT c_custkey, c_custkey // 15 AS river, c_acctbal / 10 AS s FROM customer)
       SELECT c_custkey, head, {r('p0 + s - s0')} AS p FROM p JOIN w USING (river) WHERE s BETWEEN s0 - 2 AND s1 + 2"""
)
def path_positions(spark, sf_dir):
    points = on_rivers(spark, sf_dir, F.col("c_acctbal") / 10)
    out = network.positions(points, network.paths(*rivers(spark, sf_dir)), "on_river", "s")
    return out.select("c_custkey", "head", fixed("p").alias("p"))


@query(
    """SELECT n_regionkey, n, CAST(row_number() OVER (ORDER BY n DESC, n_regionkey) - 1 AS INTEGER) AS rank
       FROM (SELECT n_regionkey, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)"""
)
def path_rank(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    placed = table(spark, sf_dir, "customer").select("c_nationkey").join(F.broadcast(nations), "c_nationkey")
    return network.ranked_paths(placed, "n_regionkey").select("n_regionkey", "n", F.col("rank").cast("int").alias("rank"))


ANCHORS = """a AS (SELECT user_id AS path, event_id AS p, value / 100 AS h, event_type AS kind FROM events WHERE event_type IN ('view', 'error')),
       q AS (SELECT user_id AS path, event_id AS id, event_id AS p FROM events WHERE event_type = 'click'),
       lo AS (SELECT id, arg_max(a.h, a.p) AS h, max(a.p) AS p, arg_max(a.kind, a.p) AS kind FROM q JOIN a ON a.path = q.path AND a.p <= q.p GROUP BY 1),
       hi AS (SELECT id, arg_min(a.h, a.p) AS h, min(a.p) AS p, arg_min(a.kind, a.p) AS kind FROM q JOIN a ON a.path = q.path AND a.p >= q.p GROUP BY 1),
       d AS (SELECT *, p - min(p) OVER g AS d0, max(p) OVER g - p AS d1 FROM a WINDOW g AS (PARTITION BY path)),
       n0 AS (SELECT path, coalesce(min(CASE WHEN d0 >= 1000 THEN d0 END), 1e18) AS m0, coalesce(min(CASE WHEN d1 >= 1000 THEN d1 END), 1e18) AS m1 FROM d GROUP BY 1),
       sl AS (SELECT path, regr_slope(h, p) FILTER (d0 <= m0) AS e0, max(p) FILTER (d0 <= m0) - min(p) FILTER (d0 <= m0) AS w0,
         regr_slope(h, p) FILTER (d1 <= m1) AS e1, max(p) FILTER (d1 <= m1) - min(p) FILTER (d1 <= m1) AS w1, regr_slope(h, p) AS e, max(p) - min(p) AS w,
         arg_min(h, p) AS h0, min(p) AS p0, arg_max(h, p) AS h1, max(p) AS p1, count(*) AS n FROM d JOIN n0 USING (path) GROUP BY 1),
       f AS (SELECT *, CASE WHEN n < 2 THEN 0 ELSE coalesce(CASE WHEN w0 >= 200 AND e0 BETWEEN -0.002 AND 0 THEN e0 END, CASE WHEN w >= 200 AND e BETWEEN -0.002 AND 0 THEN e END, -0.0005) END AS s0,
         CASE WHEN n < 2 THEN 0 ELSE coalesce(CASE WHEN w1 >= 200 AND e1 BETWEEN -0.002 AND 0 THEN e1 END, CASE WHEN w >= 200 AND e BETWEEN -0.002 AND 0 THEN e END, -0.0005) END AS s1 FROM sl)"""


@query(
    f"""WITH {ANCHORS} SELECT q.id, {r('CASE WHEN n = 1 OR q.p < p0 - 0.5 THEN h0 + s0 * (q.p - p0) WHEN q.p > p1 + 0.5 THEN h1 + s1 * (q.p - p1) ELSE coalesce(lo.h + (hi.h - lo.h) * ((q.p - lo.p) / nullif(hi.p - lo.p, 0)), lo.h) END')} AS value,
       CASE WHEN n = 1 OR q.p < p0 - 0.5 OR q.p > p1 + 0.5 THEN 'extrap' WHEN lo.kind <> hi.kind THEN 'bridge' WHEN lo.kind = 'view' THEN 'survey' ELSE 'station' END AS source
       FROM q JOIN f USING (path) LEFT JOIN lo USING (id) LEFT JOIN hi USING (id)"""
)
def bracket_extrap(spark, sf_dir):
    rows = events(spark, sf_dir)
    anchors = rows.filter("event_type in ('view', 'error')").select(
        F.col("user_id").alias("path"),
        F.col("event_id").cast("double").alias("p"),
        (F.col("value") / 100).alias("h"),
        F.array(F.when(F.col("event_type") == "view", "gnss").otherwise("gauge")).alias("deps"),
    )
    points = rows.filter("event_type = 'click'").select(
        F.col("user_id").alias("path"), F.col("event_id").alias("id"), F.col("event_id").cast("double").alias("p")
    )
    out = surface.evaluate(points, anchors, surface.end_slopes(anchors, default=-0.0005))
    return out.select("id", fixed("value").alias("value"), "source")


@query(
    """SELECT s_suppkey, CASE WHEN n_nationkey IS NULL THEN 'no river' WHEN s_acctbal < 0 THEN 'below zero' WHEN s_acctbal > 9000 THEN 'beyond the end' WHEN s_acctbal > 5000 THEN 'off axis' END AS reason,
       CASE WHEN n_nationkey IS NULL OR s_acctbal < 0 OR s_acctbal > 5000 THEN 'excluded' WHEN min(s_acctbal) OVER w < s_acctbal AND max(s_acctbal) OVER w > s_acctbal THEN 'qc' ELSE 'anchor' END AS role
       FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 4) ON s_nationkey = n_nationkey WINDOW w AS (PARTITION BY s_nationkey)"""
)
def role_assignment(spark, sf_dir):
    from pyspark.sql import Window

    nations = table(spark, sf_dir, "nation").filter("n_regionkey < 4").select(F.col("n_nationkey").alias("s_nationkey"), F.lit(True).alias("known"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal").join(F.broadcast(nations), "s_nationkey", "left")
    bal = F.col("s_acctbal")
    reason = F.coalesce(
        F.when(F.col("known").isNull(), "no river"),
        F.when(bal < 0, "below zero"),
        F.when(bal > 9000, "beyond the end"),
        F.when(bal > 5000, "off axis"),
    )
    group = Window.partitionBy("s_nationkey")
    inside = (F.min(bal).over(group) < bal) & (F.max(bal).over(group) > bal)
    rows = rows.withColumn("reason", reason)
    role = F.when(F.col("reason").isNotNull(), "excluded").when(inside, "qc").otherwise("anchor")
    return rows.select("s_suppkey", "reason", role.alias("role"))


@query(
    """WITH k AS (SELECT s_suppkey, translate(lower(trim('  Río Ñandú ' || s_name || ' ')), 'áéíóúñ', 'aeioun') AS folded FROM supplier),
       m AS (SELECT c_custkey, translate(lower(trim('RIO NANDÚ ' || replace(c_name, 'Customer', 'Supplier'))), 'áéíóúñ', 'aeioun') AS folded FROM customer)
       SELECT c_custkey, s_suppkey, folded FROM m JOIN k USING (folded)"""
)
def name_join(spark, sf_dir):
    """Rivers as two tables write them: other letters, accents and outer spaces."""
    rivers = table(spark, sf_dir, "supplier").select("s_suppkey", folded_name(F.concat(F.lit("  Río Ñandú "), F.col("s_name"), F.lit(" "))).alias("folded"))
    asked = F.concat(F.lit("RIO NANDÚ "), F.replace("c_name", F.lit("Customer"), F.lit("Supplier")))
    return table(spark, sf_dir, "customer").select("c_custkey", folded_name(asked).alias("folded")).join(rivers, "folded")


@query(
    """WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice - 30000 AS m, CAST(floor(abs(l_extendedprice - 30000) * 100 + 0.5) AS BIGINT) AS cm FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN m < 0 AND cm > 0 THEN '-' ELSE '' END || CAST(cm // 100000 AS VARCHAR) || '+' || lpad(CAST((cm // 100) % 1000 AS VARCHAR), 3, '0')
       || '.' || lpad(CAST(cm % 100 AS VARCHAR), 2, '0') AS chainage FROM c"""
)
def chainage_text(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", angles.chainage_text(F.col("l_extendedprice") - 30000).alias("chainage"))


@query(
    f"""WITH c AS (SELECT event_id, epoch_us(ts) / 1e6 AS h, CASE event_id % 4 WHEN 0 THEN epoch_us(ts) / 1e6 - 946684800 WHEN 1 THEN epoch_us(ts) / 1e6 / 86400 + 719529
         WHEN 2 THEN epoch_us(ts) / 1e6 ELSE epoch_us(ts) / 1e3 END AS v FROM events)
       SELECT event_id, {r("h", 0)} AS epoch FROM c"""
)
def epoch_decode(spark, sf_dir):
    t = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    k = F.col("event_id") % 4
    value = F.when(k == 0, t - 946_684_800).when(k == 1, t / 86_400 + 719_529).when(k == 2, t).otherwise(t * 1e3)
    return table(spark, sf_dir, "events").select("event_id", fixed(decoded_epoch(value, t + 3600), 0).alias("epoch"))


@query(
    """WITH p AS (SELECT s_suppkey, -72 + s_acctbal / 1000 AS lon, -45 + s_nationkey / 2.0 AS lat FROM supplier),
       q AS (SELECT *, CAST(floor((lon + 180) / 6) + 1 AS INTEGER) AS zone, CAST(round((lon + 75) / 3) AS INTEGER) AS belt FROM p)
       SELECT s_suppkey, zone, abs(e1 - 500000) < 400000 AND n1 BETWEEN 4500000 AND 7000000 AS sound FROM
       (SELECT *, 500000 + 0.9996 * 6378137 * radians(lon - (zone * 6 - 183)) * cos(radians(lat)) AS e1, 10000000 + 0.9996 * 6367449 * radians(lat) AS n1 FROM q)"""
)
def tm_zones(spark, sf_dir):
    rows = geographic(spark, sf_dir).withColumn("zone", angles.utm_zone(F.col("lon")))
    east, north = angles.utm(F.col("lon"), F.col("lat"), F.col("zone"))
    sound = (F.abs(east - 500_000) < 400_000) & north.between(4_500_000, 7_000_000)
    return rows.select("s_suppkey", "zone", sound.alias("sound"))


def series_sql(rows: str, scale: float, east0: str, north0: float) -> str:
    """East (x) and north (y) of ``rows`` (lat and dlon in radians) by the same series, spelt out."""
    radius, forward, e = angles._series()
    d = "{:.17e}".format  # an exponent, as DuckDB takes other literals for decimals
    east = " + ".join(["eta", *(f"{d(a)} * cos({2 * k} * xi) * sinh({2 * k} * eta)" for k, a in enumerate(forward, 1))])
    north = " + ".join(["xi", *(f"{d(a)} * sin({2 * k} * xi) * cosh({2 * k} * eta)" for k, a in enumerate(forward, 1))])
    return f"""t0 AS (SELECT *, sinh(atanh(sin(lat)) - {d(e)} * atanh({d(e)} * sin(lat))) AS t FROM {rows}),
       t1 AS (SELECT *, atan2(t, cos(dlon)) AS xi, asinh(sin(dlon) / sqrt(t * t + cos(dlon) * cos(dlon))) AS eta FROM t0),
       t2 AS (SELECT *, {east0} + {d(scale * radius)} * ({east}) AS x, {d(north0)} + {d(scale * radius)} * ({north}) AS y FROM t1)"""


PLACES = "SELECT s_suppkey, -72 + s_acctbal / 1000 AS lon, -45 + s_nationkey / 2e0 AS deg, s_acctbal FROM supplier"


@query(
    f"""WITH p AS ({PLACES}), q AS (SELECT *, CAST(floor((lon + 75) / 3 + 0.5) AS INTEGER) AS belt FROM p),
       a AS (SELECT *, radians(deg) AS lat, radians(lon - (belt * 3 - 75)) AS dlon FROM q),
       {series_sql("a", 1.0, "belt * 1e6 + 5e5", angles._series()[0] * math.pi / 2)} SELECT s_suppkey, belt, {r("x", 3)} AS east, {r("y", 3)} AS north FROM t2"""
)
def tm_project(spark, sf_dir):
    rows = geographic(spark, sf_dir).withColumn("belt", F.floor((F.col("lon") + 75) / 3 + 0.5).cast("int"))
    east, north = angles.belt(F.col("lon"), F.col("lat"), F.col("belt"))
    return rows.select("s_suppkey", "belt", fixed(east, 3).alias("east"), fixed(north, 3).alias("north"))


@query(
    f"""WITH p AS ({PLACES}), a AS (SELECT *, radians(deg) AS lat, radians(lon - (floor((lon + 180) / 6) * 6 - 177)) AS dlon,
         CASE WHEN s_suppkey % 3 > 0 THEN s_acctbal END AS e, CASE WHEN s_suppkey % 5 > 0 THEN s_acctbal * 2 END AS n FROM p),
       {series_sql("a", 0.9996, "5e5", 1e7)}
       SELECT s_suppkey, {r("CASE WHEN e IS NULL OR n IS NULL THEN x ELSE e END", 3)} AS east, {r("CASE WHEN e IS NULL OR n IS NULL THEN y ELSE n END", 3)} AS north,
         e IS NULL OR n IS NULL AS rebuilt FROM t2"""
)
def position_fill(spark, sf_dir):
    """Places of which one coordinate or both were not recorded, rebuilt from latitude and longitude."""
    rows = geographic(spark, sf_dir).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal"), "s_suppkey")
    rows = rows.withColumns({
        "east": F.when(F.col("s_suppkey") % 3 > 0, F.col("s_acctbal")), "north": F.when(F.col("s_suppkey") % 5 > 0, F.col("s_acctbal") * 2),
    })
    out = survey.filled_places(rows, "lat", "lon", "east", "north", angles.utm_zone(F.col("lon")))
    return out.select("s_suppkey", fixed("east", 3).alias("east"), fixed("north", 3).alias("north"), "rebuilt")


def geographic(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", (-72 + F.col("s_acctbal") / 1000).alias("lon"), (-45 + F.col("s_nationkey") / 2).alias("lat")
    )


@query()
def section_profile(spark, sf_dir):
    points = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.col("l_quantity").alias("s"), (F.col("l_extendedprice") / 1000).alias("depth"), (1 - F.col("l_discount")).alias("weight")
    )
    out = survey.profile(points, ["l_suppkey"], F.lit(3.0), F.lit(4.0))
    return fixed_all(out, "depth_m")


@query(
    """SELECT date_trunc('hour', ts) AS begins, event_type, count(*) AS n, floor(avg(value) * 1e6 + 0.5) / 1e6 AS mean FROM events GROUP BY 1, 2"""
)
def window_tumbling(spark, sf_dir):
    """An extension: hourly windows over the event stream, the batch form of fathom.streaming."""
    from fathom.streaming.windows import hourly

    out = hourly(table(spark, sf_dir, "events"))
    return fixed_all(out, "mean")
