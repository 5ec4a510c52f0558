"""Phrases whose words keep together, counted in a prefix-free parse.

A text is cut into pieces at its punctuation and a piece into chunks: a chunk begins where
the next OVERLAP words' hash falls on a trigger, and runs OVERLAP words into the following
chunk. Equal passages are so cut alike wherever they stand, and the corpus becomes a
dictionary of distinct chunks with the number of times that the parse holds each. A phrase
of up to OVERLAP + 1 words lies whole inside the chunk that owns its first word; counting
the phrases that begin at a distinct chunk's own words, weighed by its number, counts
every occurrence once.

Counting goes in passes over the dictionary. The first counts hashes of words and pairs,
the second those of longer phrases whose pairs are all frequent; later ones count the
phrases themselves whose hash was frequent: hashes only choose what is looked at, so two
phrases that share one change no result.

Where only the first phrases of a language are asked for, words are spelt out first, and
of the longer phrases those that may be among the first, those around them, which may cover
them, and their parts. No phrase scores more than its hash's count and the counts of its
first and last word allow. The score from which on phrases are spelt is a guess; where fewer
than were asked for reach it, it is lowered for that language, down to all its phrases.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathom.llm._stage import cut, stored
from fathom.llm._text import BASE, LOWER, by_key, gathered, mix, row_slices, run_hashes, runs, utf8_buffers

#: Words that a chunk shares with the next; phrases have one more at most.
OVERLAP = 3
#: One place in so many begins a chunk, and after so many words one begins in any case.
TRIGGER, LONGEST = 16, 256
#: Bytes of text handled at once, and numbers kept before they are summed and given on.
SLICE_BYTES, HELD = 500_000, 2_000_000
#: Bits of the filter of frequent phrases that workers get (16 MB), whatever the corpus's size; beyond it only work grows.
FILTER_BITS = 1 << 27
#: Bytes of a sketch of counts, and of one part of it that a task fills; where more keys share a byte, more is spelt out.
SLOTS, BLOCK = 1 << 24, 1 << 18
#: Phrases spelt at first for each that is asked for, and one in so many whose scores tell where these begin.
ROOM, EVERY = 6, 64
#: Counts by level of a sketch, eight to a doubling; 0 is no count, the last level has no upper bound.
LEVELS = np.concatenate([[0.0], 2.0 ** (np.arange(254) / 8), [np.inf]])

SEPARATOR, BLANK = np.zeros(256, bool), np.zeros(256, bool)
SEPARATOR[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BLANK[[0x20, 0x09]] = True
NEXT_WORDS = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % OVERLAP)


def _parts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(first byte, byte after the last, byte where ownership ends, row starts): rows together up to a slice, longer ones cut.

    A long row is cut after a piece's end; where a piece is longer than a slice, before one
    of its words, and the OVERLAP words that follow are read with both sides.
    """
    none = np.zeros(1, np.int64)
    for r, to in row_slices(offsets, SLICE_BYTES):
        s, end = int(offsets[r]), int(offsets[to])
        while end - s > SLICE_BYTES:
            found = np.flatnonzero(SEPARATOR[data[s : s + SLICE_BYTES]])
            if len(found):
                e = own = s + int(found[-1]) + 1
            else:
                blanks = np.flatnonzero(BLANK[data[s : s + SLICE_BYTES]])
                if len(blanks):
                    own = s + int(blanks[-1]) + 1
                else:  # one word as long as a slice
                    rest = np.flatnonzero((SEPARATOR | BLANK)[data[s + SLICE_BYTES : end]])
                    own = s + SLICE_BYTES + int(rest[0]) if len(rest) else end
                e = own + NEXT_WORDS.match(memoryview(data[own:end])).end()
            yield s, e, own - s, none
            s = own
        yield s, end, end - s, offsets[r:to] - s if to - r > 1 else none


def _chunks(part: np.ndarray, own: int, edges: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The chunks of some texts, their words joined by one space, and how many words each owns."""
    part = LOWER[part]
    gap = SEPARATOR[part]
    keep = ~(gap | BLANK[part])
    starts, ends = runs(keep, edges)
    n = len(starts)
    if not n:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    gap[edges[edges < len(part)]] = True
    broken = np.cumsum(gap)
    new = np.ones(n + 1, bool)
    new[1:n] = broken[starts[1:]] != broken[ends[:-1] - 1]
    h = run_hashes(part, starts, ends)
    piece = np.flatnonzero(new)
    piece_end = np.repeat(piece[1:], np.diff(piece))
    window = np.zeros(n, np.uint64)
    for k in range(OVERLAP):
        window = window * np.uint64(BASE) + h[np.minimum(np.arange(n) + k, n - 1)]
    trigger = (mix(window) % np.uint64(TRIGGER) == 0) & (np.arange(n) + OVERLAP <= piece_end)
    begins = np.flatnonzero(new[:n] | trigger)
    size = np.diff(np.append(begins, n))
    more = (size - 1) // LONGEST
    step = np.arange(len(begins) + int(more.sum())) - np.repeat(np.cumsum(more + 1) - more - 1, more + 1)
    begins = np.repeat(begins, more + 1) + step * LONGEST
    after = np.append(begins[1:], n)
    last = np.minimum(after + OVERLAP, piece_end[begins])
    owned = np.minimum(after, np.searchsorted(starts, own)) - begins
    begins, last, owned = begins[owned > 0], last[owned > 0], owned[owned > 0]
    length = ends - starts
    at = np.cumsum(length + 1) - length - 1
    text = np.full(int(length.sum()) + n, 0x20, np.uint8)
    text[np.flatnonzero(keep) + np.repeat(at - starts, length)] = part[keep]
    return gathered(text, at[begins], at[last - 1] + length[last - 1]), owned


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for (lang,), rows in by_key(batch, ("lang",)):
            data, offsets = utf8_buffers(rows.column(1))
            for s, e, own, edges in _parts(data, offsets):
                chunks, owned = _chunks(data[s:e], own, edges)
                if len(chunks):
                    columns = [pa.array([lang] * len(chunks), pa.string()), chunks.cast(pa.string()), pa.array(owned, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "owned"])


def parse(docs: DataFrame) -> DataFrame:
    """The dictionary of ``docs`` (``lang``, ``text``): lang, chunk, owned (words whose phrases are the chunk's), times."""
    given = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").filter("text is not null")
    chunks = given.mapInArrow(_parsed, "lang string, chunk string, owned int")
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("times"))


def _phrases(rows: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts, ends, word hashes, own places, words left from each, times) for slices of a batch of one language."""
    data, offsets = utf8_buffers(rows.column(1))
    owned, times = (np.asarray(rows.column(k)).astype(np.int64) for k in (2, 3))
    for r, to in row_slices(offsets, SLICE_BYTES):
        part, edges = data[offsets[r] : offsets[to]], offsets[r:to] - offsets[r]
        starts, ends = runs(part != 0x20, edges)
        h = run_hashes(part, starts, ends)
        row = np.searchsorted(edges, starts, side="right") - 1
        n = np.bincount(row, minlength=to - r)
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        own = np.flatnonzero(place < owned[r:to][row])
        yield part, starts, ends, h, own, (n[row] - place)[own], times[r:to][row[own]]


def _keys(h: np.ndarray, at: np.ndarray, n: int, lang: int) -> np.ndarray:
    """Hashes of the phrases of ``n`` words from the places ``at``."""
    out = np.full(len(at), lang, np.uint64)
    for k in range(n):
        out = out * np.uint64(BASE) + h[at + k]
    return mix(out + np.uint64(n))


def _has(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys: both bits of a key are set."""

    def bit(at: np.ndarray) -> np.ndarray:
        return (held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    out = bit(keys & np.uint64(FILTER_BITS - 1))
    some = np.flatnonzero(out)
    out[some] = bit(keys[some] >> np.uint64(64 - FILTER_BITS.bit_length() + 1))
    return out


def _lang_hash(lang: str) -> int:
    raw = np.frombuffer(lang.encode() + b"\0", np.uint8)
    return int(run_hashes(raw, np.zeros(1, np.int64), np.array([len(raw)]))[0])


def _whole(h: np.ndarray, own: np.ndarray, left: np.ndarray, n: int, lang: int, pairs: np.ndarray | None) -> np.ndarray:
    """Which of the places begin a phrase of ``n`` words, all pairs of it in the filter."""
    ok = left >= n
    for k in range(n - 1) if pairs is not None else ():
        some = np.flatnonzero(ok)
        ok[some] = _has(pairs, _keys(h, own[some] + k, 2, lang))
    return ok


def _count(dictionary: DataFrame, sizes: tuple[int, ...], pairs) -> DataFrame:
    """(key, n): counts of the hashes of phrases of the given sizes; ``pairs`` (a broadcast) leaves out those with a rare pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        known = pairs.value if pairs is not None else None

        def merged() -> pa.RecordBatch:
            key, n = np.concatenate(keys), np.concatenate(counts)
            order = np.argsort(key)
            key, n = key[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            return pa.RecordBatch.from_arrays([pa.array(key[first].view(np.int64)), pa.array(np.add.reduceat(n, first))], names=["key", "n"])

        for batch in batches:
            for (lang,), rows in by_key(batch, ("lang",)):
                salt = _lang_hash(lang)
                for _, _, _, h, own, left, times in _phrases(rows):
                    for n in sizes:
                        ok = _whole(h, own, left, n, salt, known)
                        keys.append(_keys(h, own[ok], n, salt))
                        counts.append(times[ok])
                        held += len(keys[-1])
                    if held >= HELD:
                        yield merged()
                        keys, counts, held = [], [], 0
        if held:
            yield merged()

    return dictionary.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _filter(spark: SparkSession, keys: DataFrame):
    """A broadcast bitmap of FILTER_BITS that holds the keys; built by tasks from bitmaps of 4,096 bytes."""
    width = FILTER_BITS.bit_length() - 1
    places = F.array(F.col("key").bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned("key", 64 - width))
    places = keys.select(F.explode(places).alias("at"))
    bits = F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bits")
    blocks = places.groupBy(F.shiftright("at", 15).alias("block")).agg(bits)
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in blocks.collect():
        out[r.block * 4096 : (r.block + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return spark.sparkContext.broadcast(out)


def _sketch(spark: SparkSession, counts: DataFrame, upper: bool):
    """A broadcast of SLOTS levels: for each slot the largest count (``n``) of its keys, rounded up, or (not ``upper``) the least, rounded down."""
    steps = F.log2("n") * 8
    level = F.least(F.ceil(steps + 1e-6) + 1, F.lit(255)) if upper else F.least(F.greatest(F.floor(steps - 1e-6) + 1, F.lit(1)), F.lit(254))
    slots = counts.select(F.col("key").bitwiseAND(F.lit(SLOTS - 1)).alias("slot"), level.alias("level"))
    slots = slots.groupBy("slot").agg((F.max if upper else F.min)("level").alias("level"))

    def filled(group: pa.Table) -> pa.Table:
        at, out = np.asarray(group["slot"]), np.zeros(BLOCK, np.uint8)
        out[at % BLOCK] = np.asarray(group["level"])
        return pa.table({"block": pa.array([int(at[0]) // BLOCK], pa.int64()), "levels": pa.array([out.tobytes()], pa.binary())})

    blocks = slots.groupBy(F.shiftright("slot", BLOCK.bit_length() - 1).alias("block")).applyInArrow(filled, "block long, levels binary")
    out = np.zeros(SLOTS, np.uint8)
    for r in blocks.collect():
        out[r.block * BLOCK : (r.block + 1) * BLOCK] = np.frombuffer(r.levels, np.uint8)
    return spark.sparkContext.broadcast(out)


def _frequent(known: np.ndarray, h: np.ndarray, own: np.ndarray, left: np.ndarray, lang: int, least: int, every: int = 1) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, which places, keys) of the phrases of ``least`` words and more in the filter; of pairs and what begins with them, one in ``every``.

    A phrase is as rare as its beginning.
    """
    ok = np.arange(len(own))
    for n in range(least, OVERLAP + 2):
        ok = ok[left[ok] >= n]
        keys = _keys(h, own[ok], n, lang)
        if n == 2 and every > 1:
            there = keys % np.uint64(every) == 0
            ok, keys = ok[there], keys[there]
        there = _has(known, keys)
        ok = ok[there]
        yield n, ok, keys[there]


def _word_levels(words: np.ndarray, h: np.ndarray, lang: int) -> np.ndarray:
    """The counts of all words by their sketch."""
    return LEVELS[words[(_keys(h, np.arange(len(h)), 1, lang) & np.uint64(SLOTS - 1)).astype(np.int64)]]


def _reaches(levels: np.ndarray, phrases: np.ndarray, keys: np.ndarray, at: np.ndarray, n: int, floor: float) -> np.ndarray:
    """Whether the phrases of ``n`` words from the places may score ``floor`` (above 0) by the counts of words and the sketch of phrases'.

    A phrase's parts are as frequent as itself at least: cut after its first word or before
    its last, it scores no more than if the longer part occurred nowhere else.
    """
    first, last = levels[at], levels[at + n - 1]
    a = LEVELS[phrases[(keys & np.uint64(SLOTS - 1)).astype(np.int64)]]
    parts = first + last if n == 2 else np.maximum(first, last) + a
    return (first > 0) & (last > 0) & (2_000_000 * a * (1 + 1e-9) >= floor * parts)


def _parts_of(dictionary: DataFrame, frequent, words, phrases, floors: dict[str, float]) -> DataFrame:
    """(key): hashes of the parts, of two words and more, of all phrases that may score their language's floor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for batch in batches:
            for (lang,), rows in by_key(batch, ("lang",)):
                salt, floor = _lang_hash(lang), floors.get(lang, 0)
                for _, _, _, h, own, left, _ in _phrases(rows) if floor else ():
                    levels = _word_levels(words.value, h, salt)
                    for n, ok, keys in _frequent(frequent.value, h, own, left, salt, 2):
                        if n > 2:
                            at = own[ok]
                            at = at[_reaches(levels, phrases.value, keys, at, n, floor)]
                            found += [np.unique(_keys(h, at + s, k, salt)) for k in range(2, n) for s in (0, n - k)]
                            held += sum(map(len, found[-2 * (n - 2) :]))
                    if held >= HELD:
                        found = [np.unique(np.concatenate(found))]
                        held = len(found[0])
                        if held >= HELD // 2:
                            yield pa.RecordBatch.from_arrays([pa.array(found[0].view(np.int64))], names=["key"])
                            found, held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).view(np.int64))], names=["key"])

    return dictionary.mapInArrow(run, "key long").distinct()


#: Which of the places' phrases, of given keys and number of words, are spelt out; made for the word hashes of a slice of a language.
Chosen = Callable[[np.ndarray, int, str], Callable[[np.ndarray, np.ndarray, int], np.ndarray]]


def _first(words: Broadcast, phrases: Broadcast, parts: Broadcast, floors: dict[str, float]) -> Chosen:
    """Phrases that may score their language's floor, parts of such ones, and all that hold such a one."""

    def chosen(h: np.ndarray, salt: int, lang: str) -> Callable[[np.ndarray, np.ndarray, int], np.ndarray]:
        floor = floors.get(lang, 0)
        if not floor:
            return lambda keys, at, n: np.ones(len(keys), bool)
        levels = _word_levels(words.value, h, salt)

        def which(keys: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
            out = _reaches(levels, phrases.value, keys, at, n, floor)
            rest = np.flatnonzero(~out)
            out[rest] = _has(parts.value, keys[rest])
            for k in range(2, n):
                for s in range(n - k + 1):
                    rest = np.flatnonzero(~out)
                    inner = at[rest] + s
                    out[rest] = _reaches(levels, phrases.value, _keys(h, inner, k, salt), inner, k, floor)
            return out

        return which

    return chosen


def _spelt(dictionary: DataFrame, frequent, least: int = 1, every: int = 1, chosen: Chosen | None = None) -> DataFrame:
    """(lang, phrase, n): exact counts of the phrases that ``_frequent`` gives; of these the chosen ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, held = frequent.value, {}, 0

        def summed(lang: str) -> pa.Table:
            return pa.concat_tables(found[lang]).group_by("phrase").aggregate([("n", "sum")])

        def given() -> Iterator[pa.RecordBatch]:
            for lang in found:
                t = summed(lang)
                columns = {"lang": pa.array([lang] * len(t), pa.string()), "phrase": t["phrase"].cast(pa.string()), "n": t["n_sum"]}
                yield from pa.table(columns).to_batches(max_chunksize=100_000)

        for batch in batches:
            for (lang,), rows in by_key(batch, ("lang",)):
                salt = _lang_hash(lang)
                for part, starts, ends, h, own, left, times in _phrases(rows):
                    which = chosen(h, salt, lang) if chosen is not None else None
                    for n, ok, keys in _frequent(known, h, own, left, salt, least, every):
                        if which is not None:
                            ok = ok[which(keys, own[ok], n)]
                        phrases = gathered(part, starts[own[ok]], ends[own[ok] + n - 1])
                        t = pa.table({"phrase": phrases, "n": pa.array(times[ok])}).group_by("phrase").aggregate([("n", "sum")])
                        found.setdefault(lang, []).append(t.rename_columns({"n_sum": "n"}).select(["phrase", "n"]))
                        held += len(t)
                if held >= HELD // 2:
                    found = {k: [summed(k).rename_columns({"n_sum": "n"}).select(["phrase", "n"])] for k in found}
                    held = sum(len(t[0]) for t in found.values())
                    if held >= HELD // 4:
                        yield from given()
                        found, held = {}, 0
        yield from given()

    return dictionary.mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def _frequent_keys(dictionary: DataFrame, least: int) -> DataFrame:
    """(key, n): hashes that ``least`` occurrences or more have, of phrases of up to OVERLAP + 1 words."""
    short = cut(_count(dictionary, (1, 2), None).filter(F.col("n") >= least))
    pairs = _filter(dictionary.sparkSession, short)
    long = cut(_count(dictionary, tuple(range(3, OVERLAP + 2)), pairs).filter(F.col("n") >= least))
    pairs.destroy()
    return short.unionAll(long)


def phrase_counts(dictionary: DataFrame, least: int = 30) -> DataFrame:
    """lang, phrase, n: every phrase of up to OVERLAP + 1 words with ``least`` occurrences or more in a language."""
    frequent = _filter(dictionary.sparkSession, _frequent_keys(dictionary, least))
    return cut(_spelt(dictionary, frequent).filter(F.col("n") >= least))


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) of words (lang, phrase, n)."""
    for batch in batches:
        for (lang,), rows in by_key(batch, ("lang",)):
            data, offsets = utf8_buffers(rows.column(1))
            h = run_hashes(data, offsets[:-1], offsets[1:])
            keys = _keys(h, np.arange(len(h)), 1, _lang_hash(lang))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), rows.column(2)], names=["key", "n"])


def _floors(some: DataFrame, place: int) -> dict[str, float]:
    """The bound on the score of each language's phrase at that place among ``some``, by bound; languages with fewer have none."""
    words = some.filter(~F.col("phrase").contains(" ")).select("lang", "phrase", "n")
    longer = some.filter(F.col("phrase").contains(" ")).select(
        "lang", F.col("n").alias("a"), F.substring_index("phrase", " ", 1).alias("first"),
        F.substring_index("phrase", " ", -1).alias("last"), (F.size(F.split("phrase", " ", -1)) == 2).alias("pair"),
    )
    longer = longer.join(words.toDF("lang", "first", "l"), ["lang", "first"]).join(words.toDF("lang", "last", "r"), ["lang", "last"])
    parts = F.when(F.col("pair"), F.col("l").cast("double") + F.col("r")).otherwise(F.greatest("l", "r").cast("double") + F.col("a"))
    longer = longer.select("lang", (F.lit(2e6) * F.col("a") / parts).alias("bound"))
    ordered = longer.withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("bound"))))
    return {r.lang: r.bound for r in ordered.filter(F.col("at") == place).select("lang", "bound").collect()}


def first_ranked(dictionary: DataFrame, least: int, top: int, covered: int) -> DataFrame:
    """As ``rank`` of all phrase counts, spelling out only what the first ``top`` of a language need."""
    spark = dictionary.sparkSession
    keys = _frequent_keys(dictionary, least)
    frequent = _filter(spark, keys)
    some = cut(_spelt(dictionary, frequent, every=EVERY).filter(F.col("n") >= least))
    spelt = some.filter(~F.col("phrase").contains(" "))
    room = ROOM
    floors = _floors(some, -(-room * top // EVERY))
    if floors:
        words, phrases = _sketch(spark, spelt.mapInArrow(_word_keys, "key long, n long"), False), _sketch(spark, keys, True)
    while True:
        chosen = None
        if floors:
            parts = _filter(spark, _parts_of(dictionary, frequent, words, phrases, floors))
            chosen = _first(words, phrases, parts, floors)
        longer = cut(_spelt(dictionary, frequent, 2, chosen=chosen).filter(F.col("n") >= least))
        out = cut(rank(spelt.unionAll(longer), top, covered))
        reached = out.groupBy("lang").agg(F.count("*").alias("k"), F.min("score").alias("least"))
        met = {r.lang for r in reached.collect() if r.k >= top and r.least >= floors.get(r.lang, 0)}
        if floors.keys() <= met:
            return out
        room *= 4
        lower = _floors(some, -(-room * top // EVERY))
        floors = {lang: floor if lang in met else lower[lang] for lang, floor in floors.items() if lang in met or lang in lower}


def _exact(c: Column | str) -> Column:
    return F.col(c).cast("decimal(20,0)") if isinstance(c, str) else c.cast("decimal(20,0)")


def rank(counts: DataFrame, top: int | None = 2000, covered: int = 80) -> DataFrame:
    """Score phrases of two words and more from the counts of all phrases.

    lang, rank, phrase, a (its count), l and r (the counts of its parts at the cut that scores
    least, ties to the first) and score, floor(2000000 * a / (l + r)). Phrases inside a longer
    one with ``covered`` percent of their count or more are left out. ``top`` of a language,
    by score, count and bytes; None: all. A phrase with a part that has no count is not scored.
    """
    words = F.split("phrase", " ", -1)
    counts = counts.withColumn("words", words)
    size = F.size("words")
    cuts = counts.filter(size > 1).select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", (size - 1).alias("whole"),
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    plain = counts.select("lang", "phrase", "n")
    cuts = cuts.join(plain.toDF("lang", "head", "l"), ["lang", "head"]).join(plain.toDF("lang", "tail", "r"), ["lang", "tail"])
    score = F.expr("(cast(a as decimal(20,0)) * 2000000bd) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "whole").agg(least, F.count("*").alias("found")).filter(F.col("found") == F.col("whole")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # phrases inside each longer one, with the largest count of what holds them
    inner = F.explode(
        F.flatten(
            F.transform(
                F.sequence(F.lit(2), size - 1),
                lambda w: F.transform(F.sequence(F.lit(1), size - w + 1), lambda i: F.array_join(F.slice("words", i, w), " ")),
            )
        )
    )
    holders = counts.filter(size > 2).select("lang", inner.alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("held"))
    kept = scored.join(holders, ["lang", "phrase"], "left").filter(
        F.col("held").isNull() | (_exact("held") * F.lit(100).cast("decimal(3,0)") < _exact("a") * F.lit(covered).cast("decimal(3,0)"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    out = out.filter(F.col("rank") <= top) if top is not None else out
    return out.select("lang", "rank", "phrase", "a", "l", "r", "score")


def collocations(docs: DataFrame, least: int = 30, top: int | None = 2000, covered: int = 80) -> DataFrame:
    """The phrases of ``docs`` (``lang``, ``text``) that keep together most, for each language.

    As ``rank`` with n, the number of word occurrences of the language. A null language is
    ``und``; null and empty texts hold no words; repeated rows count as often as they stand;
    other columns are not read; an empty table gives an empty result.
    """
    dictionary = stored(parse(docs), "chunks")
    sizes = dictionary.groupBy("lang").agg(F.sum(F.col("owned").cast("long") * F.col("times")).alias("n"))
    ranked = rank(phrase_counts(dictionary, least), None, covered) if top is None else first_ranked(dictionary, least, top, covered)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
