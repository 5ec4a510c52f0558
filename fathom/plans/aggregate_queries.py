"""Aggregates, predicates and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.text import joined_flags
from fathom.operators import aggregates as agg
from fathom.operators import grouping, survey
from fathom.operators.joins import compare_runs, unmatched
from fathom.plans.registry import fixed, fixed_all, query, r, table


@query(
    """SELECT l_returnflag, count(*) AS n_rows, count(*) FILTER (l_discount = 0 AND l_tax = 0) AS n_dropouts,
       CAST(count(CASE WHEN NOT (l_discount = 0 AND l_tax = 0) AND l_quantity > 0 THEN 1 END) AS BIGINT) AS n_valid
       FROM lineitem GROUP BY l_returnflag"""
)
def scan_prune_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity", "l_discount", "l_tax")
    gone = (F.col("l_discount") == 0) & (F.col("l_tax") == 0)
    rows = rows.withColumn("depth", F.when(~gone, F.col("l_quantity")))
    return rows.groupBy("l_returnflag").agg(
        F.count("*").alias("n_rows"), F.count_if(gone).alias("n_dropouts"), F.count_if(F.col("depth") > 0).alias("n_valid")
    )


@query(
    """SELECT event_id, user_id FROM events WHERE user_id IN
       (SELECT user_id FROM events GROUP BY user_id HAVING avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) <= 0.2)"""
)
def gap_gate(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return agg.null_share_gate(rows, ["user_id"], F.col("event_type") == "error", 0.2).select("event_id", "user_id")


@query(
    """SELECT user_id, CAST(floor(value / 10) AS BIGINT) AS cell, min(event_id) AS event_id FROM events
       WHERE event_id % 3 = 0 GROUP BY 1, 2"""
)
def decimate_thin(spark, sf_dir):
    rows = grouping.decimated(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), "event_id", 3)
    first = grouping.thinned(rows, ["user_id"], "value", None, 10.0, ["event_id"])
    return first.select("user_id", F.floor(F.col("value") / 10).alias("cell"), "event_id")


@query(
    f"""WITH s AS (SELECT l_suppkey, l_extendedprice AS v, sum(l_quantity) AS w FROM lineitem GROUP BY 1, 2),
       c AS (SELECT *, sum(w) OVER (PARTITION BY l_suppkey ORDER BY v) AS cw, sum(w) OVER (PARTITION BY l_suppkey) AS tw FROM s)
       SELECT l_suppkey, {r('min(v)')} AS median FROM c WHERE cw >= 0.5 * tw GROUP BY 1"""
)
def weighted_median_supp(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_extendedprice", "l_quantity")
    return fixed_all(agg.weighted_median(rows, ["l_suppkey"], "l_extendedprice", "l_quantity"), "median")


BAND = """WITH p AS (SELECT l_suppkey, l_quantity AS s, l_extendedprice / 1000 AS d, CAST(round((1 - l_discount) * 100) AS BIGINT) AS w,
                 l_returnflag, l_linenumber AS src FROM lineitem WHERE l_extendedprice > 0),
       b AS (SELECT *, unnest(generate_series(CAST(ceil((s - 5) / 2.5 - 1e-9) AS BIGINT), CAST(floor((s + 5) / 2.5 + 1e-9) AS BIGINT))) AS node FROM p)"""


@query(
    BAND
    + f""", g AS (SELECT l_suppkey, node, d, sum(w) AS w, count(*) AS n FROM b GROUP BY 1, 2, 3),
       c AS (SELECT *, sum(w) OVER q AS cw, sum(w) OVER (PARTITION BY l_suppkey, node) AS tw,
                    sum(n) OVER (PARTITION BY l_suppkey, node) AS tn FROM g WINDOW q AS (PARTITION BY l_suppkey, node ORDER BY d))
       SELECT l_suppkey, node, {r('min(d)')} AS depth_m, CAST(max(tn) AS BIGINT) AS n_points
       FROM c WHERE 2 * cw >= tw GROUP BY 1, 2"""
)
def band_profile(spark, sf_dir):
    points = band_points(spark, sf_dir)
    out = survey.node_depths(points, ["l_suppkey"], "s", "d", "w", 2.5, 5.0)
    return fixed_all(out.select("l_suppkey", "node", "depth_m", "n_points"), "depth_m")


def band_points(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_quantity").alias("s"),
        (F.col("l_extendedprice") / 1000).alias("d"),
        F.round((1 - F.col("l_discount")) * 100).cast("long").alias("w"),
        (F.col("l_returnflag") == "A").alias("first_choice"),
        F.col("l_linenumber").alias("src"),
    )


@query(
    BAND
    + f""", e AS (SELECT *, count(*) FILTER (l_returnflag = 'A') OVER (PARTITION BY l_suppkey, node) >= 20 AS ok FROM b),
       u AS (SELECT * FROM e WHERE l_returnflag = 'A' OR NOT ok),
       g AS (SELECT l_suppkey, node, d, sum(w) AS w FROM u GROUP BY 1, 2, 3),
       c AS (SELECT *, sum(w) OVER (PARTITION BY l_suppkey, node ORDER BY d) AS cw, sum(w) OVER (PARTITION BY l_suppkey, node) AS tw FROM g),
       m AS (SELECT l_suppkey, node, {r('min(d)')} AS depth_m FROM c WHERE 2 * cw >= tw GROUP BY 1, 2),
       k AS (SELECT l_suppkey, node, src, count(*) AS n FROM u GROUP BY 1, 2, 3),
       f AS (SELECT l_suppkey, node, CAST(sum(n) AS BIGINT) AS n_points, arg_min(src, -n * 1000 + src) AS src FROM k GROUP BY 1, 2)
       SELECT * FROM m JOIN f USING (l_suppkey, node)"""
)
def primary_composite(spark, sf_dir):
    out = survey.node_depths(
        band_points(spark, sf_dir), ["l_suppkey"], "s", "d", "w", 2.5, 5.0, primary="first_choice", primary_min=20, source="src"
    )
    return fixed_all(out, "depth_m")


@query(
    f"""WITH v AS (SELECT label, CAST(embedding[1] AS DOUBLE) AS e, CAST(embedding[2] AS DOUBLE) AS n, abs(CAST(embedding[3] AS DOUBLE)) AS w FROM embeddings),
       f AS (SELECT label, degrees(atan2(sum(e * w), sum(n * w))) AS a, count(*) AS n_vectors FROM v GROUP BY 1)
       SELECT label, {r('a - 360 * floor(a / 360)')} AS flow_azimuth, {r('(a + 90) - 360 * floor((a + 90) / 360)')} AS section_azimuth, n_vectors FROM f"""
)
def resultant_azimuth(spark, sf_dir):
    part = lambda i: F.element_at("embedding", i).cast("double")
    rows = table(spark, sf_dir, "embeddings").select("label", part(1).alias("e"), part(2).alias("n"), F.abs(part(3)).alias("w"))
    return fixed_all(agg.resultant_azimuth(rows, ["label"], "e", "n", "w"), "flow_azimuth", "section_azimuth")


INTERVALS = """WITH s AS (SELECT event_id, user_id, value, coalesce(sqrt(power(value - lag(value) OVER q, 2)
                 + power(event_id - lag(event_id) OVER q, 2)), 0) AS step FROM events WINDOW q AS (PARTITION BY user_id ORDER BY event_id)),
       h AS (SELECT *, (step + coalesce(lead(step) OVER (PARTITION BY user_id ORDER BY event_id), 0)) / 2 AS half FROM s),
       c AS (SELECT *, 3 * (SELECT quantile_cont(half, 0.95) FROM h k WHERE k.user_id = h.user_id AND k.half > 0) AS cap FROM h),
       l AS (SELECT *, least(half, cap) AS x FROM c),
       w AS (SELECT *, CASE WHEN avg(CASE WHEN x > 0 THEN x END) OVER g IS NULL THEN 1.0
                 WHEN x > 0 THEN x / avg(CASE WHEN x > 0 THEN x END) OVER g ELSE 0.05 END AS weight FROM l WINDOW g AS (PARTITION BY user_id))"""


@query(INTERVALS + f" SELECT event_id, user_id, {r('weight')} AS weight FROM w")
def interval_weights(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return fixed_all(agg.interval_weights(rows, ["user_id"], ["event_id"], "value", "event_id"), "weight").drop("value")


@query(
    INTERVALS
    + f""", d AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN value END AS depth FROM w)
       SELECT event_id, user_id, {r('weight * coalesce(depth, quantile_cont(depth, 0.5) OVER (PARTITION BY user_id))')} AS weight FROM d"""
)
def unit_discharge_weights(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    rows = rows.withColumn("depth", F.when(F.col("event_id") % 11 != 0, F.col("value")))
    out = agg.unit_discharge_weights(rows, ["user_id"], ["event_id"], "value", "event_id", "depth", positive=False)
    return fixed_all(out, "weight").select("event_id", "user_id", "weight")


@query(
    f"""WITH b AS (SELECT vec_id, list_filter(list_transform(embedding[1:4], lambda x: CAST(x AS DOUBLE)), lambda x: x > 0) AS g FROM embeddings),
       t AS (SELECT vec_id, g, list_sum(list_transform(g, lambda x: x - 0.02)) AS s FROM b WHERE len(g) >= 2)
       SELECT vec_id, {r('list_sum(g) / len(g)')} AS plain,
       {r('0.02 + list_sum(list_transform(g, lambda x: (1 - (x - 0.02) / s) * (x - 0.02))) / list_sum(list_transform(g, lambda x: 1 - (x - 0.02) / s))')} AS weighted
       FROM t"""
)
def idw_beam_average(spark, sf_dir):
    beams = F.transform(F.slice("embedding", 1, 4), lambda x: x.cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        agg.beam_average(beams, F.lit(0.02), "simple").alias("plain"),
        agg.beam_average(beams, F.lit(0.02)).alias("weighted"),
    )
    return fixed_all(rows.filter("weighted is not null"), "plain", "weighted")


@query("SELECT user_id, arg_max(value, event_id) FILTER (event_id % 5 <> 0) AS value FROM events GROUP BY user_id")
def last_finite(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return agg.last_finite(rows, ["user_id"], "event_id", ["value"])


@query(
    f"""SELECT l_suppkey, l_returnflag, {r('avg(l_quantity)')} AS mean, {r('stddev_samp(l_quantity)')} AS sd,
       {r('100 * stddev_samp(l_quantity) / avg(l_quantity)')} AS cv_percent, min(l_quantity) AS least, max(l_quantity) AS greatest, count(*) AS n
       FROM lineitem GROUP BY 1, 2"""
)
def discharge_stats(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_quantity")
    return fixed_all(agg.spread_statistics(rows, ["l_suppkey", "l_returnflag"], "l_quantity"), "mean", "sd", "cv_percent")


REPEATS = """WITH v AS (SELECT user_id % 10 AS k, event_type, CAST(floor(value / 20) AS BIGINT) AS node, avg(value) AS x FROM events GROUP BY 1, 2, 3),
       n AS (SELECT k, node, avg(x) AS mean, stddev_pop(x) AS sigma, count(*) AS n FROM v GROUP BY 1, 2),
       t AS (SELECT k, count(DISTINCT event_type) AS n_repetitions FROM v GROUP BY 1)"""


@query(REPEATS + f" SELECT k, node, {r('mean')} AS mean, {r('sigma')} AS sigma, n, n = n_repetitions AS common FROM n JOIN t USING (k)")
def repeatability(spark, sf_dir):
    nodes, _ = agg.repeatability(repeat_values(spark, sf_dir), ["k"], "event_type", "node", "x")
    return fixed_all(nodes.select("k", "node", "mean", "sigma", "n", "common"), "mean", "sigma")


@query(REPEATS + f" SELECT k, event_type, {r('sqrt(avg(power(x - mean, 2)))')} AS rms, count(*) AS n FROM v JOIN n USING (k, node) GROUP BY 1, 2")
def repetition_rms(spark, sf_dir):
    _, rms = agg.repeatability(repeat_values(spark, sf_dir), ["k"], "event_type", "node", "x")
    return fixed_all(rms, "rms")


def repeat_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select((F.col("user_id") % 10).alias("k"), "event_type", F.floor(F.col("value") / 20).alias("node"), "value")
    return rows.groupBy("k", "event_type", "node").agg(F.avg("value").alias("x"))


@query(
    f"""WITH e AS (SELECT l_suppkey, l_returnflag, l_linestatus, min(l_quantity) AS lo, max(l_quantity) AS hi, count(*) AS n
                  FROM lineitem GROUP BY 1, 2, 3)
       SELECT l_suppkey, {r('coalesce(avg(CASE WHEN n >= 3 THEN lo END), min(lo))')} AS extent_from,
       {r('coalesce(avg(CASE WHEN n >= 3 THEN hi END), max(hi))')} AS extent_to, count(*) FILTER (n >= 3) AS n_counted,
       max(lo) - min(lo) AS from_spread, max(hi) - min(hi) AS to_spread FROM e GROUP BY 1"""
)
def extent_mean_max(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    out = agg.measured_extent(rows, ["l_suppkey"], ["l_returnflag", "l_linestatus"], "l_quantity")
    return fixed_all(out, "extent_from", "extent_to")


@query(
    f"""SELECT user_id, CASE WHEN count(*) >= 2 AND max(event_id) - min(event_id) >= 20 THEN {r('regr_slope(value, event_id)')} END AS slope,
       CAST(max(event_id) - min(event_id) AS DOUBLE) AS span, count(*) AS n FROM events GROUP BY user_id"""
)
def slope_fit(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", "value")
    return fixed_all(agg.slope_fit(rows, ["user_id"], "event_id", "value", 20.0), "slope")


@query(
    f"""SELECT o_custkey, {r('sum(o_totalprice / greatest(o_orderkey % 50, 1)) / sum(1.0 / greatest(o_orderkey % 50, 1))')} AS mean,
       {r('max(o_totalprice) - min(o_totalprice)')} AS spread FROM orders GROUP BY 1"""
)
def gap_weighted_mean(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", (F.col("o_orderkey") % 50).alias("gap"))
    return fixed_all(agg.gap_weighted_mean(rows, ["o_custkey"], "o_totalprice", "gap"), "mean", "spread")


@query(
    """WITH c AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2),
       k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, p) AS i FROM c)
       SELECT o_custkey, CAST(sum(n) AS BIGINT) AS n, string_agg(p, '; ' ORDER BY p) AS categories, max(p) FILTER (i = 1) AS most_frequent
       FROM k GROUP BY 1"""
)
def tally(spark, sf_dir):
    return agg.tally(table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority"), ["o_custkey"], "o_orderpriority")


@query(
    f"""SELECT l_suppkey, {r('coalesce(min(CASE WHEN l_quantity - 40 > 1e-6 THEN 260 - (l_quantity - 40) END), min(260 - (l_quantity - 40)))')} AS thalweg,
       max(l_quantity - 40) AS max_depth, {r('max(l_extendedprice) - min(l_extendedprice)')} AS width FROM lineitem GROUP BY 1"""
)
def thalweg(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", (F.col("l_quantity") - 40).alias("depth"), F.lit(260.0).alias("surface"), "l_extendedprice"
    )
    return fixed_all(agg.thalweg(rows, ["l_suppkey"], "depth", "surface", "l_extendedprice"), "thalweg", "width")


@query(
    f"""WITH c AS (SELECT unnest([0.0, 2500.0, 5000.0, 7500.0, 10000.0]) AS candidate),
       m AS (SELECT s_nationkey, candidate, median(abs(s_acctbal - candidate)) AS far FROM supplier, c GROUP BY 1, 2)
       SELECT s_nationkey, arg_min(candidate, far * 1e6 + candidate / 1e6) AS candidate, {r('min(far)')} AS far FROM m GROUP BY 1"""
)
def crs_argmin(spark, sf_dir):
    places = F.explode(F.array(*(F.lit(float(x)) for x in (0, 2500, 5000, 7500, 10000))))
    rows = table(spark, sf_dir, "supplier").select("s_nationkey", "s_acctbal", places.alias("candidate"))
    far = rows.groupBy("s_nationkey", "candidate").agg(F.percentile(F.abs(F.col("s_acctbal") - F.col("candidate")), F.lit(0.5)).alias("far"))
    best = far.groupBy("s_nationkey").agg(F.min(F.struct("far", "candidate")).alias("b"))
    return best.select("s_nationkey", "b.candidate", fixed("b.far").alias("far"))


@query(
    """SELECT o.o_orderkey, CASE WHEN c.c_custkey IS NULL THEN 'no reading' ELSE 'ok' END AS status
       FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey
       UNION ALL SELECT -1 - c_custkey, 'no station' FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)"""
)
def orphan_readings(spark, sf_dir):
    stations = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    readings = table(spark, sf_dir, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("key"))
    seen = stations.join(readings.withColumn("found", F.lit(True)), "key", "left")
    status = F.when(F.col("found"), "ok").otherwise("no reading")
    lost = unmatched(readings, stations, ["key"])
    return seen.select("o_orderkey", status.alias("status")).unionAll(lost.select(-1 - F.col("key"), F.lit("no station")))


@query(
    f"""WITH a AS (SELECT o_orderkey, o_totalprice AS old FROM orders WHERE o_orderstatus <> 'P'),
       b AS (SELECT o_orderkey, o_totalprice + o_orderkey % 5 AS new FROM orders WHERE o_orderstatus <> 'O')
       SELECT o_orderkey, CASE WHEN old IS NULL THEN 'new only' WHEN new IS NULL THEN 'old only' ELSE 'both' END AS status,
       old, new, {r('new - old')} AS difference FROM a FULL JOIN b USING (o_orderkey)"""
)
def run_compare(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    old, new = (rows.filter(F.col("o_orderstatus") != s).select("o_orderkey", "o_totalprice") for s in ("P", "O"))
    new = new.withColumn("o_totalprice", F.col("o_totalprice") + F.col("o_orderkey") % 5)
    out = compare_runs(old, new, ["o_orderkey"], "o_totalprice")
    return fixed_all(out, "difference")


@query(
    """SELECT 'customer' AS cloud, c_custkey AS pt, c_nationkey AS nation, c_acctbal AS z FROM customer
       UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal FROM supplier"""
)
def union_clouds(spark, sf_dir):
    one = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("cloud"), F.col("c_custkey").alias("pt"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("z")
    )
    two = table(spark, sf_dir, "supplier").select(
        F.lit("supplier").alias("cloud"), F.col("s_suppkey").alias("pt"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("z")
    )
    return one.unionByName(two)


@query(
    """SELECT user_id, CASE WHEN span < 30 THEN 'estatico' WHEN axis > greatest(50, 2 * offs) THEN 'longitudinal'
       WHEN axis > 30 OR offs > 30 THEN 'aproximacion' ELSE 'otro' END AS track_class
       FROM (SELECT user_id, max(value) - min(value) AS axis, max(value) FILTER (event_type = 'view') - min(value) FILTER (event_type = 'view') AS offs,
             sqrt(power(max(value) - min(value), 2)) AS span FROM events GROUP BY 1) WHERE offs IS NOT NULL"""
)
def track_class(spark, sf_dir):
    view = F.when(F.col("event_type") == "view", F.col("value"))
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(
        (F.max("value") - F.min("value")).alias("axis"), (F.max(view) - F.min(view)).alias("offs")
    )
    spans = spans.filter("offs is not null").withColumn("span", F.hypot(F.col("axis"), F.lit(0.0)))
    return spans.select("user_id", grouping.track_class(F.col("axis"), F.col("offs"), F.col("span")).alias("track_class"))


@query(
    """SELECT doc_id, concat_ws(';', CASE WHEN n_chars > 5000 THEN 'LONG' END, CASE WHEN regexp_matches(text, '[#$%&*]{3}') THEN 'MARKS' END,
       CASE WHEN lang <> 'en' THEN 'FOREIGN' END) AS flag FROM documents WHERE n_chars > 5000 OR regexp_matches(text, '[#$%&*]{3}')"""
)
def flag_log(spark, sf_dir):
    long, marks = F.col("n_chars") > 5000, F.col("text").rlike("[#$%&*]{3}")
    rows = table(spark, sf_dir, "documents").filter(long | marks)
    return rows.select("doc_id", joined_flags(LONG=long, MARKS=marks, FOREIGN=F.col("lang") != "en").alias("flag"))
