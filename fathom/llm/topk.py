"""Exact top-k inner products by block-at-a-time pruning.

Vectors, as integers, are dealt into shards by ranges of vec_id, and a shard into
blocks of consecutive ids. A block keeps its vectors (the forward index) and the
largest and smallest value of every component. For a query, the sum over components
of the larger product bounds every score in a block; blocks are taken by falling
bound and scored through their forward index until a bound falls below the k-th best
score so far. Queries come in blocks too: every pair of a shard and a group of queries
is one bounded piece of work, and a query's best of all shards are merged at the end.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm._stage import cut
from fathom.llm.vectors import float_kind, packed

#: Vectors of a shard and of a block, and queries of a group.
SHARD_ROWS, BLOCK_ROWS, GROUP_QUERIES = 8192, 256, 2048


def as_integers(column: list[bytes], kind: str, scale: int) -> np.ndarray:
    """floor(scale * x) of every component: as doubles where they hold it exactly, else as Python's integers."""
    x = np.frombuffer(b"".join(column), kind).reshape(len(column), -1).astype(np.float64)
    if not x.size or np.abs(x).max() < 2**53 / scale:
        return np.floor(x * scale)
    # a double from 2**53 on is an integer; others are small enough for the product
    return np.array([[int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in row] for row in x.tolist()], object)


def by_size(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of those whose scores with each other are exact in doubles, and of the larger ones."""
    top = np.abs(x).max(axis=1, initial=0)
    plain = np.asarray(top * top * x.shape[1] < 2**53, bool)
    parts = ((np.flatnonzero(plain), x[plain].astype(np.float64)), (np.flatnonzero(~plain), x[~plain]))
    return [p for p in parts if len(p[0])]


def _exact(x: np.ndarray, top: int) -> np.ndarray:
    """``x`` in a type whose sums of products up to ``top`` are exact."""
    if top < 2**53:
        return x
    whole = x if x.dtype == object else np.array([[int(v) for v in row] for row in x.tolist()], object).reshape(x.shape)
    return whole.astype(np.int64) if top < 2**62 and (not whole.size or np.abs(whole).max() < 2**62) else whole


def _as_long(x: np.ndarray) -> np.ndarray:
    """Scores and bounds beyond 64 bits count as the nearest long."""
    return np.clip(x, -(2**63), 2**63 - 1).astype(np.int64) if x.dtype == object else x


def best_of_shard(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block: int = BLOCK_ROWS
) -> list[tuple[int, int, int]]:
    """(query, vec_id, score) of each query's k best in a shard sorted by id; ties to smaller ids."""
    starts = range(0, len(ids), block)
    high = np.stack([vectors[s : s + block].max(axis=0) for s in starts])
    low = np.stack([vectors[s : s + block].min(axis=0) for s in starts])
    top = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    queries, vectors, high, low = (_exact(x, top) for x in (queries, vectors, high, low))
    bounds = _as_long(np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T)
    order = np.argsort(bounds, axis=1, kind="stable")[:, ::-1]
    out = []
    for q in range(len(query_ids)):
        scores, found, least = np.zeros(0, bounds.dtype), np.zeros(0, np.int64), None
        for b in order[q].tolist():
            if least is not None and bounds[q, b] < least:
                break
            own = ids[b * block : (b + 1) * block]
            got = _as_long(vectors[b * block : (b + 1) * block] @ queries[q])
            keep = own != query_ids[q]
            if least is not None:
                keep &= got >= least
            if not keep.any():
                continue
            scores, found = np.append(scores, got[keep]), np.append(found, own[keep])
            top = np.lexsort((-found, scores))[::-1][:k]
            scores, found = scores[top], found[top]
            least = scores[-1] if len(top) == k else None
        out += [(int(query_ids[q]), int(v), int(s)) for v, s in zip(found, scores)]
    return out


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """The ``k`` best rows for every query row of ``vectors`` (``vec_id``, ``embedding``).

    Components x count as floor(scale * x); queries are the rows whose vec_id is
    divisible by ``every``; the score is the inner product. Returns query_id, rank (from
    1), vec_id, score; ties go to the smaller vec_id. Null embeddings, and those that
    hold null or non-finite components, take no part, nor do null vec_ids; vectors of
    different lengths do not meet. Finite components of any size take part and scores are
    exact; those beyond 64 bits count as the nearest long, in the ranking too. Rows with the query's vec_id count as its own and are
    left out; of other rows that repeat a vec_id each counts. Other columns are not
    read; an empty table, or one without queries, gives an empty result.
    """
    kind = float_kind(vectors)
    rows = packed(vectors, zero_too=True).filter("vector is not null and vec_id is not null")
    shards = max(1, math.ceil(vectors.count() / SHARD_ROWS))
    docs = rows.withColumn("width", F.octet_length("vector")).repartitionByRange(shards, "vec_id", F.xxhash64("vector"))
    docs = cut(docs.withColumn("shard", F.spark_partition_id()))
    last, n_queries = docs.agg(F.coalesce(F.max("shard"), F.lit(0)), F.count_if(F.col("vec_id") % every == 0)).first()
    groups = max(1, math.ceil(n_queries / GROUP_QUERIES))
    asked = docs.filter(F.col("vec_id") % every == 0).withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(last))))
    docs = docs.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        left = left.sort_values("vec_id", kind="stable")
        for width, wanted in right.groupby("width"):
            held = left[left.width == width]
            if not len(held):
                continue
            asking, ids = wanted.vec_id.to_numpy(), held.vec_id.to_numpy()
            mine = by_size(as_integers(held.vector.tolist(), kind, scale))
            for at, queries in by_size(as_integers(wanted.vector.tolist(), kind, scale)):
                for own, vectors in mine:
                    out += best_of_shard(asking[at], queries, ids[own], vectors, k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    found = docs.groupBy("shard", "group").cogroup(asked.groupBy("shard", "group"))
    found = found.applyInPandas(search, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
