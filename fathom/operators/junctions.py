"""Levels where rivers meet, from the junctions farthest upstream to the outlet.

A junction's level rests on the values around it, among them those of junctions upstream;
so junctions are solved in layers: a layer's junctions lie on no path below one another,
are solved together, and what the next ones need of them is kept per path. Each layer is
materialised, so that the plan doesn't grow with the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.materialise import cut
from fathom.operators import sequence, surface

#: Metres within which a measured value sits on a junction, and the least gap that weighs.
ON_NODE, LEAST_GAP = 0.5, 1.0
#: Layers after which the values kept per path are materialised.
EVERY = 8


def _each(rows: DataFrame, instants: Sequence[float]) -> DataFrame:
    return rows.withColumn("at", F.explode(F.array(*(F.lit(float(t)) for t in sorted(set(instants))))))


def gauge_anchors(gauges: DataFrame, readings: DataFrame, instants: Sequence[float]) -> DataFrame:
    """Anchors of gauges at each of ``instants`` (seconds): path, p, h, deps and at.

    ``gauges`` has station_id, zero, h (their level without a time), path and p; ``readings``
    station_id, at and level above the gauge's zero. Between two readings the level is
    interpolated, outside them the first or last holds; a gauge without readings keeps its h.
    """
    told = sequence.asof_interpolate(_each(gauges, instants), readings, ["station_id"], "at", "level", "stage")
    h = F.coalesce(F.col("zero") + F.col("stage"), F.col("h"))
    return told.select("path", "p", h.alias("h"), F.array(F.lit("gauge")).alias("deps"), "at")


def layers(nodes: DataFrame) -> DataFrame:
    """The layer of each node (from 1): the most nodes that lie on one of its paths as far as itself."""
    along = nodes.select("node", "path", "p").distinct()
    place = F.row_number().over(Window.partitionBy("path").orderBy("p"))
    return along.withColumn("__k", place).groupBy("node").agg(F.max("__k").alias("layer"))


def _around(nodes: DataFrame, anchors: DataFrame) -> DataFrame:
    """``nodes`` with the nearest anchors of their path ``up`` and ``down`` (p, h, deps) and whether one is on them."""
    known = anchors.select("path", F.col("p").cast("double").alias("__p"), F.struct(F.col("p").cast("double").alias("p"), F.col("h").cast("double").alias("h"), F.array_sort("deps").alias("deps")).alias("__a"))
    both = nodes.withColumn("__p", F.col("p").cast("double")).unionByName(known, allowMissingColumns=True)
    before = f"RANGE BETWEEN UNBOUNDED PRECEDING AND {ON_NODE + 1e-9}D PRECEDING"
    rows = both.withColumns(
        {
            "up": F.expr(f"last(__a, true) OVER (PARTITION BY path ORDER BY __p {before})"),
            "down": F.expr(f"last(__a, true) OVER (PARTITION BY path ORDER BY __p DESC {before})"),
            "measured": F.expr(f"count(__a) OVER (PARTITION BY path ORDER BY __p RANGE BETWEEN {ON_NODE}D PRECEDING AND {ON_NODE}D FOLLOWING) > 0"),
        }
    )
    return rows.filter("node is not null").drop("__p", "__a")


def _estimates(rows: DataFrame) -> DataFrame:
    """A row per node: level, deps, how and spread, out of its branches' nearest values upstream and the value downstream."""
    d = F.struct((F.col("p") - F.col("up.p")).alias("du"), "path", "up", "slope")  # ties by the path
    best = rows.groupBy("node", "branch").agg(F.min(F.when(F.col("up").isNotNull(), d)).alias("u"), F.min(F.when(F.col("down").isNotNull(), F.struct((F.col("down.p") - F.col("p")).alias("dd"), "path", "down", F.col("down_slope").alias("slope")))).alias("b"))
    below = F.min("b").over(Window.partitionBy("node"))
    best = best.withColumn("b", below)
    du, dd, up, down = F.col("u.du"), F.col("b.dd"), F.col("u.up"), F.col("b.down")
    level = F.when(F.col("b").isNull(), up["h"] + F.col("u.slope") * du).otherwise(up["h"] + (down["h"] - up["h"]) * du / (du + dd))
    gap = F.greatest(F.lit(LEAST_GAP), F.when(F.col("b").isNull(), du).otherwise(du + dd))
    best = best.withColumns({"level": level, "gap": gap, "deps": F.array_union(up["deps"], F.coalesce(down["deps"], F.array().cast("array<string>")))})
    one = best.groupBy("node").agg(
        F.try_divide(F.sum(F.col("level") / F.col("gap")), F.sum(F.when(F.col("level").isNotNull(), 1 / F.col("gap")))).alias("h"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("deps")))).alias("deps"),
        (F.max("level") - F.min("level")).alias("spread"),
        F.min("b").alias("b"),
    )
    lone = F.col("h").isNull() & F.col("b").isNotNull()
    how = F.when(lone, "extrap-up").when(F.col("b").isNull(), "extrap-down").otherwise("interp")
    flat = F.col("b.down.h") - F.col("b.slope") * F.col("b.dd")
    out = one.select(
        "node",
        F.when(lone, flat).otherwise(F.col("h")).alias("h"),
        F.when(lone, F.col("b.down.deps")).otherwise(F.col("deps")).alias("deps"),
        how.alias("how"),
        F.coalesce("spread", F.lit(0.0)).alias("spread"),
    )
    return out.filter("h is not null")


def solve(anchors: DataFrame, nodes: DataFrame, min_span: float = 200.0, max_slope: float = 0.002, default: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(anchors with the junctions', junctions): levels of all ``nodes`` of a network.

    ``anchors`` has path, p, h and deps; ``nodes`` node, path, p (its chainage on each of its
    paths) and branch (which of its rivers the path comes along). Junctions: node, h, deps,
    how and spread (between its branches). A branch's level is interpolated between its
    nearest value upstream, measured or of a junction, and the nearest measured one
    downstream; without one downstream it goes on from the upstream values with their end
    slope (see ``surface.end_slopes``), and a node with values only downstream takes
    theirs back. Branches count by one over their gap. A measured value on the node stands:
    such nodes, and those without any value, have no row. ``path`` may hold an instant too
    (a struct): every instant is then solved by itself, in the same passes.
    """
    options = {"min_span": min_span, "max_slope": max_slope, "default": default}
    anchors = cut(anchors.select("path", "p", "h", "deps"))
    around = _around(nodes.select("node", "path", "p", "branch").distinct(), anchors)
    bare = around.groupBy("node").agg(F.bool_or("measured").alias("__on"), F.bool_and(F.col("down").isNull()).alias("bare"))
    around = around.join(bare.filter("not __on").drop("__on"), "node").join(layers(nodes), "node").drop("measured")
    slopes = surface.end_slopes(anchors, **options).filter("end = 0").select("path", F.col("slope").alias("down_slope"))
    around = cut(around.join(slopes, "path", "left"))
    plan = sorted((r.layer, r.bare) for r in around.groupBy("layer").agg(F.bool_or("bare").alias("bare")).collect())
    # values of junctions by path, the last first: one for what lies below, and those too near to it to count
    state = around.select("path").distinct().withColumn("seen", F.array().cast("array<struct<p:double,h:double,deps:array<string>>>"))
    solved = []
    for k, (layer, needs) in enumerate(plan):
        rows = around.filter(F.col("layer") == layer).join(state, "path")
        nearer = F.get(F.filter("seen", lambda x: x["p"] < F.col("p") - ON_NODE), F.lit(0))
        rows = rows.withColumn("up", F.when(F.col("up").isNull() | (nearer["p"] > F.col("up.p")), F.coalesce(nearer, F.col("up"))).otherwise(F.col("up")))
        rows = rows.withColumn("slope", F.lit(None).cast("double"))
        if needs:
            rows = _with_slopes(cut(rows), anchors, solved, nodes, options)
        found = cut(_estimates(rows))
        solved.append(found)
        fresh = around.filter(F.col("layer") == layer).select("node", "path", "p").join(found, "node")
        fresh = fresh.groupBy("path").agg(F.max_by(F.struct(F.col("p").cast("double").alias("p"), "h", "deps"), "p").alias("__new"))
        new = F.col("__new")
        held = F.filter("seen", lambda x: x["p"] >= new["p"] - ON_NODE)
        older = F.slice(F.filter("seen", lambda x: x["p"] < new["p"] - ON_NODE), 1, 1)
        state = state.join(fresh, "path", "left").select("path", F.when(new.isNull(), F.col("seen")).otherwise(F.concat(F.array(new), held, older)).alias("seen"))
        state = cut(state) if k % EVERY == EVERY - 1 else state
    if not solved:
        empty = around.select("node", F.lit(0.0).alias("h"), F.array().cast("array<string>").alias("deps"), F.lit("").alias("how"), F.lit(0.0).alias("spread")).limit(0)
        return anchors, empty
    junctions = solved[0]
    for more in solved[1:]:
        junctions = junctions.unionByName(more)
    junctions = cut(junctions)
    placed = nodes.select("node", "path", "p").distinct().join(junctions.select("node", "h", "deps"), "node")
    return anchors.unionByName(placed.select("path", "p", "h", "deps")), junctions


def _with_slopes(rows: DataFrame, anchors: DataFrame, solved: list[DataFrame], nodes: DataFrame, options: dict) -> DataFrame:
    """``rows`` with the end slope of all values above nodes that have none below: such nodes end their path's values."""
    bare = rows.filter("bare").select("path", F.col("p").alias("__end"), "node").withColumn("g", F.struct("path", "node"))
    known = anchors
    for found in solved:
        known = known.unionByName(nodes.select("node", "path", "p").distinct().join(found.select("node", "h", "deps"), "node").select("path", "p", "h", "deps"))
    above = known.join(bare, "path").filter(F.col("p") < F.col("__end") - ON_NODE)
    slope = surface.end_slopes(above.select("g", "p", "h", "deps"), group="g", **options).filter("end = 1")
    slope = slope.select(F.col("g.path").alias("path"), F.col("g.node").alias("node"), F.col("slope").alias("__slope"))
    return rows.join(slope, ["path", "node"], "left").withColumn("slope", F.col("__slope")).drop("__slope")


def at_instants(rows: DataFrame, instants: Sequence[float]) -> DataFrame:
    """``rows`` for every instant, or for their own if they have ``at``: their ``path`` becomes a struct of at and path.

    With nodes, ``node`` becomes one too, as each instant has its own.
    """
    every = rows if "at" in rows.columns else _each(rows, instants)
    for c in ("path", "node"):
        if c in rows.columns:
            every = every.withColumn(c, F.struct("at", c))
    return every.drop("at")
