"""Groups of repetitions, index tables, overrides and coverage over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import flow, group, islands, joins, tables
from fathom.plans.registry import fixed, fixed_all, query, r, table


@query(
    """SELECT event_id, user_id FROM (SELECT event_id, user_id, event_type, count_if(event_type = 'view') OVER (PARTITION BY user_id) AS n FROM events)
       WHERE n < 5 OR event_type = 'view'"""
)
def transit_subset(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "view", 3).otherwise(2).alias("step"))
    return flow.in_transit(rows, ["user_id"], "step").select("event_id", "user_id")


@query(
    f"""WITH v AS (SELECT label, vec_id % 5 AS m, CAST(embedding[1] AS DOUBLE) AS e, CAST(embedding[2] AS DOUBLE) AS n, abs(CAST(embedding[3] AS DOUBLE)) AS w, embedding[4] > 0 AS t FROM embeddings),
       k AS (SELECT *, count_if(t) OVER (PARTITION BY label, m) AS c FROM v),
       g AS (SELECT label, degrees(atan2(sum(w * e), sum(w * n))) AS a, count(*) AS n_vectors FROM k WHERE t OR c < 1 GROUP BY 1),
       o AS (SELECT label, m, degrees(atan2(sum(w * e), sum(w * n))) AS b FROM k WHERE t OR c < 5 GROUP BY 1, 2),
       x AS (SELECT label, m, abs((b - a + 90) - 180 * floor((b - a + 90) / 180) - 90) AS z FROM g JOIN o USING (label))
       SELECT label, {r('any_value(a) - 360 * floor(any_value(a) / 360)')} AS flow_azimuth, any_value(n_vectors) AS n_vectors, {r('max(z)')} AS worst,
       coalesce(string_agg(CAST(m AS VARCHAR), ';' ORDER BY m) FILTER (z > 25), '') AS strays, max(z) <= 25 AS agrees FROM x JOIN g USING (label) GROUP BY 1"""
)
def group_direction(spark, sf_dir):
    part = lambda i: F.element_at("embedding", i).cast("double")
    rows = table(spark, sf_dir, "embeddings").select(
        "label", (F.col("vec_id") % 5).alias("m"), part(1).alias("e"), part(2).alias("n"), F.abs(part(3)).alias("w"),
        F.when(part(4) > 0, 3).otherwise(2).alias("step"),
    )
    out = flow.group_direction(rows, ["label"], "m", "e", "n", "w", "step")
    out = out.withColumn("strays", F.array_join(F.col("strays").cast("array<string>"), ";")).drop("section_azimuth")
    return fixed_all(out, "flow_azimuth", "worst")


@query(
    f"""WITH m AS (SELECT l_suppkey, l_linenumber AS c, quantile_cont(l_extendedprice / 40, 0.5) AS d FROM lineitem GROUP BY 1, 2),
       g AS (SELECT l_suppkey, max(d) FILTER (c = 4) AS declared, min(d) FILTER (c <> 4) AS low, arg_min(c, d) FILTER (c <> 4) AS b FROM m GROUP BY 1)
       SELECT l_suppkey, {r('declared')} AS declared_m, coalesce(declared <= 1000, true) AS plausible,
       CASE WHEN declared > 1000 AND low <= 1000 THEN b END AS better, CASE WHEN declared > 1000 AND low <= 1000 THEN {r('low')} END AS better_m FROM g"""
)
def crs_plausible(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linenumber", (F.col("l_extendedprice") / 40).alias("d"))
    return fixed_all(flow.implausible(rows, ["l_suppkey"], "l_linenumber", "d", F.lit(4)), "declared_m", "better_m")


@query(
    f"""SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ';' ORDER BY o_orderdate, o_orderkey) AS members, count(*) AS n_members,
       {r('quantile_cont(o_totalprice / 1000, 0.5)', 9)} AS left_m, {r('quantile_cont(o_totalprice / 2000, 0.5)', 9)} AS right_m, {r('avg(o_totalprice / 500)', 9)} AS surface_mean,
       {r('max(o_totalprice / 500) - min(o_totalprice / 500)', 9)} AS surface_spread, CAST(max(o_orderkey) - min(o_orderkey) AS DOUBLE) AS chainage_spread, min(o_orderdate) AS first_time FROM orders GROUP BY 1"""
)
def group_quality(spark, sf_dir):
    price = F.col("o_totalprice")
    rows = table(spark, sf_dir, "orders").withColumns({"left": price / 1000, "right": price / 2000, "ws": price / 500, "km": F.col("o_orderkey")})
    out = tables.group_quality(rows, ["o_custkey"], "o_orderkey", "o_orderdate", "left", "right", "ws", "km")
    return fixed_all(out, "left_m", "right_m", "surface_mean", "surface_spread", digits=9)


@query(
    f"""WITH p AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), s AS (SELECT user_id, string_agg(event_type || ' ' || n, ', ' ORDER BY event_type) AS sources FROM p GROUP BY 1),
       t AS (SELECT user_id, count(*) AS n_ensembles, count_if(event_type = 'error') AS n_without_fix, min(value) AS chainage_from, max(value) AS chainage_to,
         date_diff('microsecond', min(ts), max(ts)) / 6e7 AS minutes, user_id % 10 AS river FROM events GROUP BY user_id)
       SELECT t.user_id, CAST(n_ensembles AS BIGINT) AS n_ensembles, CAST(n_without_fix AS BIGINT) AS n_without_fix, chainage_from, chainage_to, {r('minutes')} AS minutes, sources,
       CAST(row_number() OVER (PARTITION BY river ORDER BY coalesce(chainage_from, 0), t.user_id) AS INTEGER) AS position FROM t JOIN s USING (user_id)"""
)
def track_index(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    out = tables.track_index(rows, ["user_id"], F.col("event_type") != "error", "value", "ts", "event_type").withColumn("river", F.col("user_id") % 10)
    out = tables.positions_in(out, ["river"], [*tables.track_order(F.col("river"), F.col("chainage_from")), F.col("user_id").asc()])
    return fixed_all(out.drop("river"), "minutes")


@query(
    """SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END NULLS LAST,
       CASE WHEN c_acctbal > 0 THEN c_acctbal WHEN c_acctbal < -500 THEN -c_acctbal END NULLS LAST, c_custkey) AS INTEGER) AS position FROM customer"""
)
def survey_index(spark, sf_dir):
    rank = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    km = F.col("c_acctbal")
    order = tables.survey_order(rank, F.when(km > 0, km), F.when(km < -500, -km))
    rows = tables.positions_in(table(spark, sf_dir, "customer"), ["c_nationkey"], [*order, F.col("c_custkey").asc()])
    return rows.select("c_custkey", "position")


@query(
    """WITH f AS (SELECT user_id, event_type, min(event_id) AS p FROM events GROUP BY 1, 2) SELECT user_id, string_agg(event_type, ' / ' ORDER BY p) AS seen FROM f GROUP BY 1"""
)
def first_seen(spark, sf_dir):
    rows = tables.first_seen(table(spark, sf_dir, "events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id", "event_type", "seen")
    return rows.select("user_id", F.array_join("seen", " / ").alias("seen"))


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders) WHERE k = 1"""
)
def longest_part(spark, sf_dir):
    return tables.longest_part(table(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice", "o_orderkey")


@query("SELECT o_custkey, coalesce(min(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 0) AS least FROM orders GROUP BY 1")
def least_or_zero(spark, sf_dir):
    return tables.least_or_zero(table(spark, sf_dir, "orders"), ["o_custkey"], F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")))


@query(
    """SELECT o_orderkey, o_orderstatus = 'P' OR o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW') AS warns FROM orders"""
)
def surface_warnings(spark, sf_dir):
    notes = {"1-URGENT": "EXTRAP 900 m", "2-HIGH": "extrap 20 m", "3-MEDIUM": "gauge; QC dif 0.31 m", "5-LOW": "single anchor"}
    note = F.coalesce(*(F.when(F.col("o_orderpriority") == k, F.lit(v)) for k, v in notes.items()))
    source = F.when(F.col("o_orderstatus") == "P", "clamp").otherwise("survey")
    return table(spark, sf_dir, "orders").select("o_orderkey", tables.surface_warns(source, note).alias("warns"))


@query(
    """SELECT o_custkey, count(*) AS n, CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS n_without, bool_and(o_orderstatus = 'O') AS relative FROM orders GROUP BY 1"""
)
def surface_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("ws"))
    return tables.coverage(rows, ["o_custkey"], "ws")


@query(
    """WITH m AS (SELECT c_custkey AS k, c_mktsegment AS g FROM customer WHERE c_acctbal < 0)
       SELECT 'forced' AS kind, o_orderkey AS id, g AS "group" FROM orders JOIN m ON o_custkey = k UNION ALL
       SELECT 'missing', k, g FROM m WHERE k NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'other', o_orderkey, NULL FROM orders WHERE o_custkey NOT IN (SELECT k FROM m)"""
)
def forced_groups(spark, sf_dir):
    """Customers with debts are grouped by hand; their orders are the results."""
    manual = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("group"))
    results = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    forced, missing, other = tables.forced_groups(results, "o_custkey", manual)
    kind = lambda df, k, i, g: df.select(F.lit(k).alias("kind"), F.col(i).alias("id"), g.alias("group"))
    out = kind(forced, "forced", "o_orderkey", F.col("group")).unionAll(kind(missing, "missing", "o_custkey", F.col("group")))
    return out.unionAll(kind(other, "other", "o_orderkey", F.lit(None).cast("string")))


@query(
    """SELECT c_custkey, coalesce(w.n_name, CASE WHEN c_acctbal > 0 THEN o.n_name END) AS river, c_mktsegment = 'MACHINERY' AS ignored
       FROM customer LEFT JOIN nation w ON w.n_nationkey = (c_nationkey + 1) % 25 AND c_mktsegment = 'BUILDING' JOIN nation o ON o.n_nationkey = c_nationkey"""
)
def forced_line(spark, sf_dir):
    """Customers of one segment ask for the next nation's name in other letters, those of another for one that is not there."""
    nation = table(spark, sf_dir, "nation")
    own = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("found"))
    following = nation.select(F.pmod(F.col("n_nationkey") - 1, F.lit(25)).alias("c_nationkey"), F.concat(F.lit(" "), F.lower("n_name")).alias("next"))
    rows = table(spark, sf_dir, "customer").join(own, "c_nationkey").join(following, "c_nationkey")
    wanted = F.when(F.col("c_mktsegment") == "BUILDING", F.col("next")).when(F.col("c_mktsegment") == "MACHINERY", "nowhere")
    rows = rows.select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("found")).alias("found"), wanted.alias("wanted"))
    return tables.forced_line(rows, "wanted", nation, "n_name", "found").select("c_custkey", "river", "ignored")


@query()
def river_islands(spark, sf_dir):
    """Customers as branches of their nation's river; the grouping goes row by row, so there is no SQL."""
    rows = table(spark, sf_dir, "customer").select(
        "c_nationkey", "c_custkey", F.floor(F.abs("c_acctbal")).alias("s0"), (F.floor(F.abs("c_acctbal")) + F.col("c_custkey") % 7 * 20).alias("s1"),
        (F.col("c_custkey") % 11 - 5).alias("left"), F.lit(None).cast("string").alias("name"),
    )
    out = islands.channels(rows, ["c_nationkey"], "s0", "s1", "left", "c_custkey", "name")
    return out.select("c_nationkey", "island", "c_custkey", "channel", fixed("s0").alias("s0"), fixed("s1").alias("s1"))


def sections(spark, sf_dir):
    """(cloud, vectors) of suppliers as sections and line numbers as their repetitions."""
    rows = table(spark, sf_dir, "lineitem").withColumn("m", F.col("l_linenumber"))
    cloud = rows.select(
        "l_suppkey", "m", (F.col("l_discount") * 10).alias("e"), F.col("l_quantity").alias("n"), (F.col("l_extendedprice") / 20000).alias("depth"),
        F.lit(1.0).alias("weight"),
    )
    vectors = rows.select(
        "l_suppkey", "m", (1 + F.col("l_tax")).alias("ve"), (F.col("l_discount") - 0.05).alias("vn"), F.col("l_quantity").alias("weight"),
        F.when(F.col("l_returnflag") == "N", 3).otherwise(2).alias("step"),
    )
    return cloud, vectors


@query()
def group_profiles(spark, sf_dir):
    """Smoothing and gaps leave no short SQL, a test holds a known bed."""
    cloud, vectors = sections(spark, sf_dir)
    edges = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.lit(2.0).alias("left"), F.lit(3.0).alias("right"), F.when(F.col("s_acctbal") > 0, 250.0).alias("surface")
    )
    profile, _ = group.group_profile(cloud, vectors, edges, ["l_suppkey"], "m")
    return fixed_all(profile, "depth_m", "east", "north", "bed")


@query()
def processed_groups(spark, sf_dir):
    """Groups through the whole chain; a test holds its profiles, deviations and places against plain loops."""
    cloud, vectors = sections(spark, sf_dir)
    members = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", F.col("l_linenumber").alias("m")).agg(
        (F.avg("l_tax") * 50).alias("left"), F.lit(3.0).alias("right"), (250 + F.avg("l_discount")).alias("surface"), F.avg("l_quantity").alias("discharge"),
        (F.min("l_suppkey") % 7).cast("int").alias("line"),
    )
    river = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 5).alias("line"), F.col("c_custkey").alias("n"), (F.col("c_nationkey") * 0.4).alias("x"), "c_custkey")
    segments = joins.segments_of(river.withColumn("y", F.col("c_custkey") * 0.05), ["line"], "n")
    out = group.process_groups(cloud, vectors, members, ["l_suppkey"], "m", segments=segments).groups
    return out.select(
        "l_suppkey", "n_members", "strays", "same_stage", "accepted", "line", "method",
        *(fixed(c, 4).alias(c) for c in ("left", "surface", "width", "max_depth", "sigma_mean", "sigma_mean_common", "discharge", "discharge_cv", "chainage")),
    )
