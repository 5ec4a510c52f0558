"""Near-duplicates by word shingles: MinHash signatures in an LSH forest.

Texts with the same set of shingles are one node. Every node's signature is laid out
as several trees of ``deep`` values each. A tree's nodes are sorted by their values, so
nodes with a long common prefix stand together:

1. A region is a run of nodes with ``shallow`` values in common. Its depth adapts: it is
   cut deeper and deeper until a run holds at most ``crowd`` nodes, all of which are
   candidates of each other. In a region that had to be cut, every node is also a
   candidate of its neighbours in the order, those with the longest common prefix.
   There are as many trees as keep the chance that no region holds a pair at the
   threshold at ``miss``.
2. Candidates that their signatures do not rule out are confirmed on the full sets: of
   every node one candidate first, then those that are still of different components.
3. A region that was cut may have parted a pair. Where its nodes still form several
   components, a prefix filter over their full sets (the rarest shingles of each, in one
   order for all) finds every pair of different components exactly.

A tree's order is dealt out by ranges, so a region of any size is spread over tasks; a
region that a range's end may have cut counts as one that had to be cut.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import connected_components, cut, stored
from fathom.llm._text import mix, row_slices, shingle_hashes, utf8_buffers, word_hashes

#: Nodes up to which the texts are picked by a broadcast of their ids (about 40 bytes each).
BROADCAST_NODES = 500_000
#: Rows of a tree's order that are handled at once.
ORDER_ROWS = 20_000
#: Values by whose numbers of shingles the prefix filter puts shingles in order.
ORDER_BUCKETS = 1 << 16
#: Bytes of a signature's value, and of a tree's number before its values.
VALUE, HEAD = 2, 2


def trees_for(threshold: float, depth: int, miss: float) -> int:
    """Trees of ``depth`` values for which a pair at the threshold is missed with chance ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-(threshold**depth)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    values, counts = shingle_hashes(*word_hashes(data, offsets), width)
    at = 0
    for n in counts.tolist():
        own = np.sort(values[at : at + n])
        at += n
        yield own[np.append(True, own[1:] != own[:-1])] if n else own


def set_print(own: np.ndarray) -> bytes | None:
    """128 bits that name a set of shingles; none for the empty set."""
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None


def _signer(n_values: int):
    factors = mix(np.arange(1, n_values + 1, dtype=np.uint64)) | np.uint64(1)

    def sign(own: np.ndarray) -> bytes:
        least = np.full(n_values, 0xFFFFFFFFFFFFFFFF, np.uint64)
        step = max(1, 1_000_000 // n_values)
        for i in range(0, len(own), step):
            np.minimum(least, (factors[:, None] * own[None, i : i + step]).min(axis=1), out=least)
        return (least >> np.uint64(48)).astype(">u2").tobytes()

    return sign


def _signed(docs: DataFrame, width: int, n_values: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, print, signature) of every row of (doc_id, text_hash, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(n_values)
        for batch in batches:
            data, offsets = utf8_buffers(batch.column(2))
            for s, e in row_slices(offsets):
                sizes, prints, signatures = [], [], []
                for own in shingle_sets(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], width):
                    sizes.append(len(own))
                    prints.append(set_print(own))
                    signatures.append(sign(own) if len(own) else None)
                columns = [batch.column(0).slice(s, e - s), batch.column(1).slice(s, e - s), pa.array(sizes, pa.int64())]
                columns += [pa.array(x, pa.binary()) for x in (prints, signatures)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n_shingles", "print", "signature"])

    return docs.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, print binary, signature binary")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, shingles) of ``nodes`` (node, doc_id, print), from the texts of their doc_ids."""
    keys = nodes.withColumnRenamed("doc_id", "of")
    keys = F.broadcast(keys) if nodes.count() <= BROADCAST_NODES else keys
    texts = docs.join(keys, F.col("doc_id") == F.col("of")).select("node", "print", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(1).to_pylist()
            data, offsets = utf8_buffers(batch.column(2))
            for s, e in row_slices(offsets):
                own = list(shingle_sets(data[offsets[s] : offsets[e]], offsets[s : e + 1] - offsets[s], width))
                # another text of the same doc_id is another node
                right = [i for i, x in enumerate(own) if set_print(x) == prints[s + i]]
                own = [own[i] for i in right]
                ends = np.append(0, np.cumsum([len(x) for x in own])).astype(np.int32)
                values = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                taken = batch.column(0).slice(s, e - s).take(pa.array(right, pa.int64()))
                yield pa.RecordBatch.from_arrays([taken, lists], names=["node", "shingles"])

    made = texts.mapInArrow(run, "node long, shingles array<long>")
    return made.groupBy("node").agg(F.first("shingles").alias("shingles"))


def _orders(nodes: DataFrame, trees: int, deep: int) -> DataFrame:
    """A row per node and tree, (key, node), in every tree's order; key is the tree's number and the node's values."""
    values = VALUE * deep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                raw, _ = utf8_buffers(part.column(1))
                keys = np.empty((part.num_rows, trees, HEAD + values), np.uint8)
                keys[:, :, 0], keys[:, :, 1] = np.arange(trees) >> 8, np.arange(trees) & 255
                keys[:, :, HEAD:] = raw.reshape(part.num_rows, trees, values)
                n = part.num_rows * trees
                offsets = np.arange(n + 1, dtype=np.int32) * (HEAD + values)
                column = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(keys.reshape(-1))])
                yield pa.RecordBatch.from_arrays([column, pa.array(np.repeat(np.asarray(part.column(0)), trees))], names=["key", "node"])

    rows = nodes.select("node", "signature").mapInArrow(run, "key binary, node long")
    return rows.repartitionByRange("key", "node").sortWithinPartitions("key", "node")


def candidates(
    keys: np.ndarray, nodes: np.ndarray, shallow: int, deep: int, crowd: int, opens: bool, closes: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs (a, b) of the rows of one order, and which rows are of a region that was cut.

    ``opens`` and ``closes`` say that the first and the last region may go on outside.
    """
    n = len(nodes)
    same = keys[1:] == keys[:-1]
    common = np.where(same.all(axis=1), deep, (np.argmin(same, axis=1) - HEAD) // VALUE)
    runs = lambda depth: np.append(0, np.cumsum(common < depth))
    region = runs(shallow)
    was_cut = np.bincount(region) > crowd
    was_cut[0] |= opens
    was_cut[-1] |= closes
    dense = was_cut[region]
    ones, twos, done = [], [], np.zeros(n, bool)
    for depth in range(shallow, deep + 1):
        run = runs(depth)
        fits = (np.bincount(run)[run] <= crowd) & ~done
        for k in range(1, crowd):
            i = np.flatnonzero(fits[: n - k] & (run[: n - k] == run[k:]))
            if not len(i):
                break
            ones.append(i)
            twos.append(i + k)
        done |= fits
        if done.all():
            break
    beside = np.flatnonzero(dense[1:] & (common >= shallow))
    a = np.concatenate([*ones, beside])
    b = np.concatenate([*twos, beside + 1])
    return nodes[a], nodes[b], dense


def _forest(orders: DataFrame, shallow: int, deep: int, crowd: int) -> DataFrame:
    """(a, b, region): candidate pairs, region null; and the nodes ``a`` of every region that was cut, ``b`` null."""
    wide = HEAD + VALUE * deep

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, opens = np.zeros((0, wide), np.uint8), np.zeros(0, np.int64), True

        def work(n: int, closes: bool) -> Iterator[pa.RecordBatch]:
            a, b, dense = candidates(keys[:n], nodes[:n], shallow, deep, crowd, opens, closes)
            own = nodes[:n][dense]
            regions = [k.tobytes() for k in keys[:n][dense][:, : HEAD + VALUE * shallow]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.minimum(a, b), own])),
                    pa.concat_arrays([pa.array(np.maximum(a, b)), pa.nulls(len(own), pa.int64())]),
                    pa.concat_arrays([pa.nulls(len(a), pa.binary()), pa.array(regions, pa.binary())]),
                ],
                names=["a", "b", "region"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            raw, _ = utf8_buffers(batch.column(0))
            keys = np.concatenate([keys, raw.reshape(-1, wide)])
            nodes = np.concatenate([nodes, np.asarray(batch.column(1))])
            if len(nodes) < ORDER_ROWS:
                continue
            last = np.flatnonzero((keys[1:, : HEAD + VALUE * shallow] != keys[:-1, : HEAD + VALUE * shallow]).any(axis=1))
            if len(last):
                n = int(last[-1]) + 1
                yield from work(n, False)
                opens = False
            else:  # one region fills all: go on with its last row
                n = len(nodes) - 1
                yield from work(len(nodes), True)
                opens = True
            keys, nodes = keys[n:], nodes[n:]
        if len(nodes):
            yield from work(len(nodes), True)

    return orders.mapInArrow(run, "a long, b long, region binary")


def _rated(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, share): the pairs whose set sizes and signatures do not rule the threshold out.

    ``share`` is that of equal values, by their lowest bytes; it must not be more than
    five standard deviations below the threshold.
    """
    threshold = percent / 100
    one = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("signature").alias("s_a"))
    two = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("signature").alias("s_b"))
    joined = pairs.join(one, "a").join(two, "b").filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            a, b = (utf8_buffers(batch.column(i))[0].reshape(n, -1)[:, 1::VALUE] for i in (2, 3))
            floor = threshold - 5 * math.sqrt(threshold * (1 - threshold) / a.shape[1])
            share = (a == b).mean(axis=1)
            keep = pa.array(share >= floor)
            rows = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], names=["a", "b", "share"])
            yield rows.filter(keep)

    return joined.select("a", "b", "s_a", "s_b").mapInArrow(run, "a long, b long, share double")


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold: 100 * common >= percent * union."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("in_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("in_b"))
    common = F.size(F.array_intersect("in_a", "in_b")).cast("long")
    both = (F.size("in_a") + F.size("in_b")).cast("long")
    met = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", common.alias("common"), both.alias("both"))
    return met.filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common"))).select("a", "b")


def _labelled(rows: DataFrame, found: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of their ``node`` as ``name``: itself where it has no link."""
    named = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(named, node, "left").withColumn(name, F.coalesce(name, node))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs of different components."""
    both = _labelled(_labelled(pairs, found, "a", "of_a"), found, "b", "of_b")
    return both.filter("of_a <> of_b").select(*pairs.columns)


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, component, place, size): the prefix of each set that any partner must meet.

    Shingles are in order of how many the sets hold of their bucket, then by hash: the
    same order for all, as few sets as may be have their prefixes in common.
    """
    bucket = F.pmod("shingle", F.lit(ORDER_BUCKETS)).cast("int")
    counted = sets.select(F.explode("shingles").alias("shingle")).groupBy(bucket.alias("bucket")).count().collect()
    weights = np.zeros(ORDER_BUCKETS, np.int64)
    weights[[r.bucket for r in counted]] = [r["count"] for r in counted]
    known = sets.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            for i in range(batch.num_rows):
                own = np.asarray(lists[i].values)
                n = len(own)
                first = n - -(-percent * n // 100) + 1
                order = np.lexsort((own, known.value[own % ORDER_BUCKETS]))[:first]
                columns = [own[order], np.repeat(batch.column(0)[i].as_py(), first), np.repeat(batch.column(1)[i].as_py(), first)]
                columns += [np.arange(first, dtype=np.int32), np.repeat(np.int32(n), first)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "node", "component", "place", "size"])

    return sets.select("node", "component", "shingles").mapInArrow(
        run, "shingle long, node long, component long, place int, size int"
    )


def _met(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of different components that share a shingle of their prefixes and can reach the threshold.

    In a shingle's rows those of the commonest component meet only the others, so a
    group that is connected already costs no pairs among itself.
    """
    held = rows.groupBy("shingle", "component").agg(F.count("*").alias("n"))
    most = held.groupBy("shingle").agg(F.max_by("component", F.struct("n", "component")).alias("most"), F.count("*").alias("of"))
    most = cut(most.filter("of > 1").select("shingle", "most"))
    rows = cut(rows.join(most, "shingle"))
    one = rows.filter("component <> most").drop("most").alias("one")
    two = rows.alias("two")

    def of(side: str) -> Callable[[str], Column]:
        return lambda name: F.col(f"{side}.{name}")

    x, y = of("one"), of("two")
    sizes = x("size") + y("size")
    left = F.least(x("size") - x("place"), y("size") - y("place"))
    rule: Column = (
        (x("shingle") == y("shingle"))
        & (x("component") != y("component"))
        & ((y("component") == y("most")) | (x("node") < y("node")))
        & (100 * F.least(x("size"), y("size")) >= percent * F.greatest(x("size"), y("size")))
        & ((100 + percent) * left >= percent * sizes)
    )
    pairs = one.join(two, rule)
    return pairs.select(F.least(x("node"), y("node")).alias("a"), F.greatest(x("node"), y("node")).alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    shallow: int = 4,
    deep: int = 6,
    crowd: int = 32,
    miss: float = 1e-6,
) -> DataFrame:
    """Class every row of ``docs`` (``doc_id``, ``text``) by shared ``width``-word shingles.

    Words are runs of other than ASCII white space, A-Z lower-cased. Texts link if
    100 * common shingles >= ``percent`` * shingles of either. A text of fewer words
    is one shingle. Returns a row per row: doc_id, text_hash (xxhash64 of the text),
    n_shingles, component_id (least doc_id reachable by links), kept (doc_id =
    component_id).

    Texts without words, nulls included, have no shingles and link with nothing. A
    null doc_id links with nothing, has a null component and is kept. Rows that
    repeat a doc_id are classed each by its own text; equal rows have equal results.
    Other columns are not read; an empty table gives an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    trees = trees_for(percent / 100, shallow, miss)
    base = stored(_signed(docs, width, trees * deep), "signatures")
    groups = (
        base.filter("print is not null and doc_id is not null")
        .groupBy("print")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.count("*").alias("copies"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stored(groups, "nodes")
    forest = cut(_forest(_orders(nodes, trees, deep), shallow, deep, crowd))
    pairs = forest.filter("region is null").select("a", "b").distinct()
    rated = cut(_rated(pairs, nodes, percent))
    dense = forest.filter("region is not null").select(F.col("a").alias("node"), "region")
    wanted = rated.select(F.col("a").alias("node")).unionAll(rated.select("b")).unionAll(dense.select("node")).distinct()
    sets = cut(_sets(docs.select("doc_id", "text"), cut(nodes.select("node", "doc_id", "print").join(wanted, "node")), width))

    # of every node one candidate: the least of those that are likely links, so that many choose the same
    ends = rated.unionAll(rated.select(F.col("b").alias("a"), F.col("a").alias("b"), "share"))
    likely = F.min(F.when(F.col("share") >= (1 + percent / 100) / 2, F.col("b")))
    best = ends.groupBy("a").agg(F.coalesce(likely, F.max_by("b", F.struct("share", "b"))).alias("b"))
    best = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = cut(_links(best, sets, percent))
    found = cut(connected_components(links))
    links = links.unionAll(cut(_links(_apart(rated, found), sets, percent)))
    found = cut(connected_components(links))

    rows = _labelled(dense, found, "node", "component")
    several = rows.groupBy("region").agg((F.min("component") != F.max("component")).alias("several")).filter("several")
    still = cut(rows.join(several.select("region"), "region", "left_semi").select("node", "component").distinct())
    if not still.isEmpty():
        met = _met(_rarest(cut(sets.join(still, "node")), percent), percent)
        links = links.unionAll(cut(_links(met, sets, percent)))
        found = cut(connected_components(links))

    # a node's component is named by the least doc_id in it
    named = found.join(nodes.select("node", "doc_id"), "node")
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id")
    classes = nodes.select("print", "node", "doc_id", "copies").join(named, "node", "left")
    classes = classes.filter("copies > 1 or component_id is not null").select(
        F.col("print"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return (
        base.select("doc_id", "text_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("print")).alias("print"))
        .join(classes, "print", "left")
        .select("doc_id", "text_hash", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
