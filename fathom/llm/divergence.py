"""How far the sources of a language differ in their words, exactly.

The counts of terms by group (a source within a language) are a sparse matrix. It is cut
into blocks of terms, and each block into strips of groups; a task builds a K2-tree of a
block's strips: a square of 2**m places is split into four quadrants, a bit says whether a
quadrant holds a count, and only those that do are split further. For two groups the trees
are gone down together: a quadrant that is empty for both is not visited, as its terms all
have the same value, which is added at the end by their number; at the leaves the values
are computed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm._stage import cut, stored
from fathom.llm._text import LOWER, by_key, row_slices, runs, utf8_buffers

#: Documents of a language from which on a term is kept.
LEAST_DOCS = 10
#: Counts of a block, about, terms of one at most, and groups of a strip.
BLOCK_COUNTS, BLOCK_TERMS, STRIP = 200_000, 16_384, 256
#: Pairs of quadrants looked at together.
FRONTIER = 400_000
#: Groups up to which they are broadcast (about 100 bytes each).
BROADCAST_GROUPS = 200_000
#: Bytes of text handled at once, and rows kept before they are summed and given on.
SLICE_BYTES, HELD = 500_000, 1_000_000

#: Bytes of terms: ASCII letters and all of other characters.
TERM = np.zeros(256, bool)
TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(first row, row after the last, first byte, byte after the last); a long row is cut where no term is torn."""
    for r, to in row_slices(offsets, SLICE_BYTES):
        s, end = int(offsets[r]), int(offsets[to])
        while end - s > SLICE_BYTES:
            gaps = np.flatnonzero(~TERM[data[s : s + SLICE_BYTES]])
            if len(gaps):
                e = s + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(~TERM[data[s + SLICE_BYTES : end]])
                e = s + SLICE_BYTES + int(rest[0]) if len(rest) else end
            yield r, to, s, e
            s = e
        yield r, to, s, end


def _terms(part: np.ndarray, edges: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of some texts, and the row of each."""
    part = LOWER[part]
    keep = TERM[part]
    starts, ends = runs(keep, edges)
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(part[keep]))
    return terms, np.searchsorted(edges, starts, side="right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (lang, source), rows in by_key(batch, ("lang", "source")):
            data, offsets = utf8_buffers(rows.column(2))
            held, n = [], 0

            def summed() -> Iterator[pa.RecordBatch]:
                own = pa.concat_tables(held).group_by(["row", "term"]).aggregate([("n", "sum")])
                t = own.group_by("term").aggregate([("n_sum", "sum"), ("n_sum", "count")])
                columns = [pa.array([lang] * len(t), pa.string()), pa.array([source] * len(t), pa.string())]
                columns += [t["term"].cast(pa.string()), t["n_sum_sum"], t["n_sum_count"]]
                yield from pa.table(columns, names=["lang", "source", "term", "n", "docs"]).to_batches()

            last = -1
            for r, to, s, e in _parts(data, offsets):
                if n >= HELD and r != last:  # between two rows only, as a row counts once as a document
                    yield from summed()
                    held, n = [], 0
                terms, row = _terms(data[s:e], np.clip(offsets[r:to], s, e) - s)
                t = pa.table({"row": pa.array(row + r), "term": terms}).group_by(["row", "term"]).aggregate([([], "count_all")])
                held.append(t.rename_columns({"count_all": "n"}).select(["row", "term", "n"]))
                n, last = n + len(t), r
            if n:
                yield from summed()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (documents) of ``docs`` (``lang``, ``source``, ``text``)."""
    given = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text"))).filter("text <> ''")
    counted = given.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, kept: str) -> Column:
    """1 + floor(1000000000 * (count + 2) / (total + 2 * kept)), exact."""
    big = [f"cast(coalesce({c}, 0L) as decimal(20,0))" for c in (count, total, kept)]
    return F.expr(f"if({kept} > 0, 1L + (1000000000bd * ({big[0]} + 2bd)) div ({big[1]} + 2bd * {big[2]}), 0L)")


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)**2 / (p + q)) of shares, which are one or more and at most 10**9 + 1."""
    return (p - q) ** 2 // (p + q)


class Tree:
    """K2-tree (two by two) of places (row, column) below 2**levels: for each level the bits of the quadrants of what is not empty."""

    def __init__(self, row: np.ndarray, column: np.ndarray, levels: int):
        self.levels = levels
        code = np.zeros(len(row), np.int64)
        for k in range(levels):
            code |= ((row >> k) & 1) << (2 * k + 1) | ((column >> k) & 1) << (2 * k)
        self.order = np.argsort(code, kind="stable")
        code = code[self.order]
        self.bits, self.rank = [], []
        above = np.zeros(1, np.int64)
        for k in range(levels - 1, -1, -1):
            nodes = np.unique(code >> (2 * k))
            bits = np.zeros(4 * max(len(above), 1), bool)
            bits[4 * np.searchsorted(above, nodes >> 2) + (nodes & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            above = nodes

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The nodes below, -1 where they are empty; leaves are numbered as ``order`` has the places."""
        at = np.where(node >= 0, 4 * node + quadrant, 0)
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)


def joint(one: Tree, two: Tree, rows: tuple[int, int], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Leaves that hold a count for one row of each of two trees at least, without the quadrants empty for both.

    Yields (row of one, row of two, leaf of one, leaf of two), -1 for an empty leaf, in parts
    of bounded size. ``same``: the trees are one, and a pair of rows comes once, smaller first.
    """
    none = np.zeros(1, np.int64)
    if not len(one.order) and not len(two.order):
        return
    held = [(0, none, none, none if len(one.order) else none - 1, none if len(two.order) else none - 1)]
    while held:
        level, a, b, x, y = held.pop()
        if level == one.levels:
            yield a, b, x, y
            continue
        if len(a) > FRONTIER:
            half = len(a) // 2
            held += [(level, *(v[:half] for v in (a, b, x, y))), (level, *(v[half:] for v in (a, b, x, y)))]
            continue
        below = one.levels - level - 1
        found = []
        for i in (0, 1):
            for j in (0, 1):
                ra, rb = 2 * a + i, 2 * b + j
                ok = (ra << below < rows[0]) & (rb << below < rows[1])
                if same:
                    ok &= ra < rb if below == 0 else ra <= rb
                ra, rb, xs, ys = ra[ok], rb[ok], x[ok], y[ok]
                for c in (0, 1):
                    p, q = one.child(level, xs, 2 * i + c), two.child(level, ys, 2 * j + c)
                    some = (p >= 0) | (q >= 0)
                    found.append((ra[some], rb[some], p[some], q[some]))
        parts = tuple(np.concatenate([f[k] for f in found]) for k in range(4))
        if len(parts[0]):
            held.append((level + 1, *parts))


def block_sums(left: list[np.ndarray], right: list[np.ndarray], empty: tuple[np.ndarray, np.ndarray], same: bool) -> tuple[np.ndarray, ...]:
    """(row, row, sum of distances, terms visited) over the pairs of rows of two strips of a block.

    A strip is rows, columns and shares of its counts; ``empty`` has the rows' shares of a term
    that they don't hold.
    """
    widest = max(int(max((v.max(initial=0) for v in (*left[:2], *right[:2])), default=0)), len(empty[0]) - 1, len(empty[1]) - 1)
    levels = max(widest, 1).bit_length()
    one = Tree(left[0], left[1], levels)
    two = one if same else Tree(right[0], right[1], levels)
    p, q = np.append(left[2][one.order], 0), np.append(right[2][two.order], 0)  # the last for -1
    shape = (len(empty[0]), len(empty[1]))
    total, visited = np.zeros(shape[0] * shape[1], np.int64), np.zeros(shape[0] * shape[1], np.int64)
    for a, b, x, y in joint(one, two, shape, same):
        value = distance(np.where(x >= 0, p[x], empty[0][a]), np.where(y >= 0, q[y], empty[1][b]))
        pair = a * shape[1] + b
        np.add.at(total, pair, value)
        visited += np.bincount(pair, minlength=len(visited))
    some = np.flatnonzero(visited)
    return some // shape[1], some % shape[1], total[some], visited[some]


def _block(table: pa.Table, strip: int) -> pa.Table:
    """Sums of one block and one pair of strips: a row for each count (place, term, p) and, without a term, each group."""
    lang, first, second = (table[c][0].as_py() for c in ("lang", "first", "second"))
    side, place, p = (table[c].to_numpy() for c in ("side", "place", "p"))
    encoded = table["term"].combine_chunks().dictionary_encode()
    column = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    strips, empty = [], []
    for k, begin in ((0, first * strip), (1, second * strip)):
        mine, held = (side == k) & (column >= 0), (side == k) & (column < 0)
        strips.append([place[mine] - begin, column[mine], p[mine]])
        own = np.zeros(int(held.sum()), np.int64)
        own[place[held] - begin] = p[held]
        empty.append(own)
    same = first == second
    if same:
        strips[1], empty[1] = strips[0], empty[0]
    one, two, value, visited = block_sums(*strips, tuple(empty), same)
    columns = [pa.array([lang] * len(one), pa.string()), pa.array(one + first * strip), pa.array(two + second * strip)]
    return pa.table([*columns, pa.array(value), pa.array(visited)], names=["lang", "one", "two", "value", "visited"])


def matrix(docs: DataFrame, least: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """The matrix's counts (lang, source, term, n, and total, the language's), and its groups.

    Groups are all that occur: lang, source, place (from 0 in a language, by source), own
    (occurrences of kept terms), total, kept (terms), counts (of the language), empty (the
    share of a term without occurrence).
    """
    of = Window.partitionBy("lang", "term")
    counts = term_counts(docs).withColumns(
        {"total": F.sum("n").over(of), "in_docs": F.sum("docs").over(of), "first": F.row_number().over(of.orderBy("source")) == 1}
    )
    counts = stored(counts.filter(F.col("in_docs") >= least).select("lang", "source", "term", "n", "total", "first"), "terms")
    named = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    own = counts.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    sizes = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count_if("first").alias("kept"), F.count("*").alias("counts"))
    groups = named.join(own, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["own", "total", "kept", "counts"])
    groups = groups.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    return counts.drop("first"), cut(groups.withColumn("empty", share("0L", "own", "kept")))


def _small(groups: DataFrame) -> DataFrame:
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def pair_values(counts: DataFrame, groups: DataFrame, width: int = STRIP, block: int = BLOCK_COUNTS) -> DataFrame:
    """lang, one, two (places, one below two), value: the distance of every two groups of a language, over all its terms."""
    strips = groups.groupBy("lang").agg(F.floor((F.max("place") / width)).cast("int").alias("last"))
    groups = groups.join(strips, "lang").withColumn("blocks", F.ceil(F.greatest(F.col("counts") / block, F.col("kept") / BLOCK_TERMS)).cast("int"))
    strip = F.floor(F.col("place") / width).cast("int")
    meets = F.transform(
        F.sequence(F.lit(0), F.col("last")),
        lambda t: F.struct(F.least(strip, t).alias("first"), F.greatest(strip, t).alias("second"), F.when(t < strip, 1).otherwise(0).alias("side")),
    )
    groups = groups.withColumn("meets", meets)
    rows = counts.drop("total").join(_small(groups), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"), "meets", "place", "term", share("n", "own", "kept").alias("p")
    )
    every = groups.filter("blocks > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "meets", "place", F.lit(None).cast("string").alias("term"), F.col("empty").alias("p")
    )
    dealt = rows.unionByName(every).select("lang", "block", F.inline("meets"), "place", "term", "p")
    out = "lang string, one long, two long, value long, visited long"
    sums = dealt.groupBy("lang", "block", "first", "second").applyInArrow(lambda table: _block(table, width), out)
    sums = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"), F.sum("visited").alias("visited"))
    one = groups.select("lang", F.col("place").alias("one"), F.col("empty").alias("p"), "kept")
    two = groups.select("lang", F.col("place").alias("two"), F.col("empty").alias("q"))
    pairs = one.join(two, "lang").filter("one < two").join(sums, ["lang", "one", "two"], "left")
    blank = F.when(F.col("kept") > 0, F.expr("((p - q) * (p - q)) div (p + q)")).otherwise(F.lit(0))
    return pairs.select("lang", "one", "two", (F.coalesce("value", F.lit(0)) + (F.col("kept") - F.coalesce("visited", F.lit(0))) * blank).alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, terms: int = 10, width: int = STRIP, block: int = BLOCK_COUNTS) -> DataFrame:
    """Distances of the sources of each language, and the terms that tell a source from its language.

    lang, source, part, item, value, rank. Part ``pair``: every other source of the language,
    by the distance of their shares of all terms that stand in ``least`` of its documents.
    Part ``term``: the ``terms`` terms with the largest distance that the source uses more.
    A task gets about ``block`` counts of two strips of ``width`` sources. Ties by the item's bytes. Null lang, source and text are ''; a source without terms has
    its pairs too; a language without kept terms has distance 0. Rows may repeat and count
    each; other columns are not read; an empty table gives an empty result. The result has
    a row for each two sources of a language, so its size is theirs squared.
    """
    counts, groups = matrix(docs, least)
    known = _small(groups.select("lang", "source", "own", "kept", F.col("total").alias("all")))
    p, q = share("n", "own", "kept"), share("total", "all", "kept")
    told = counts.join(known, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    told = told.select("lang", "source", F.lit("term").alias("part"), "item", F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    names = groups.select("lang", "place", "source")
    pairs = pair_values(counts, groups, width, block)
    for k in ("one", "two"):
        pairs = pairs.join(_small(names.withColumnsRenamed({"place": k, "source": f"{k}_source"})), ["lang", k])
    both = F.array(*(F.struct(F.col(f"{a}_source").alias("source"), F.col(f"{b}_source").alias("item")) for a, b in (("one", "two"), ("two", "one"))))
    pairs = pairs.select("lang", "value", F.inline(both)).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", order).unionByName(told.withColumn("rank", order).filter(F.col("rank") <= terms))
