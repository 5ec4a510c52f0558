"""Materialisation and id helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where a local session names none (tests) a temporary folder is set once; a session
    on a cluster must name one, as its executors share no local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="fathom-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/fathom-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: cut like a checkpoint, but read by columns."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this subpackage has written and that nothing reads any more."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


#: Edges of the contracted graph up to which one task finds the components (16 bytes each); more go through rounds.
ONE_TASK_EDGES = 1_000_000
#: Edges that a task contracts at once.
CHUNK_EDGES = 500_000


def _roots(ends: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and their components' least nodes, by joining roots until none differ."""
    nodes, at = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
    one, two = at.reshape(2, -1)
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[one], root[two]), np.maximum(root[one], root[two])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _contracted(limit: int | None):
    """A star for every component of a partition's edges, taken ``limit`` at a time (None: all at once)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def star() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _roots(held)], names=["node", "component"])

        for batch in batches:
            if batch.num_rows:
                held.append(np.stack([np.asarray(batch.column(0)), np.asarray(batch.column(1))]))
                n += batch.num_rows
            if limit and n >= limit:
                yield star()
                held, n = [], 0
        if held:
            yield star()

    return run


def connected_components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (``a``, ``b`` longs).

    Every task first replaces its edges by stars. What is left fits one task up to
    ONE_TASK_EDGES edges. Beyond that, alternating large-star and small-star rounds: a
    node's neighbours are only ever reduced to their minimum, so no neighbour list is
    gathered, and a hot node's edges go through a join that adaptive execution can
    split. Returns (``node``, ``component``) for nodes with an edge.
    """
    some = edges.filter("a <> b").select("a", "b")
    stars = cut(some.mapInArrow(_contracted(CHUNK_EDGES), "node long, component long"))
    if stars.count() <= ONE_TASK_EDGES:
        return stars.coalesce(1).mapInArrow(_contracted(None), "node long, component long")
    pairs = cut(stars.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        large = cut(large)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = cut(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionAll(roots)
