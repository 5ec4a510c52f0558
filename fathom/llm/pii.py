"""Personal data: patterned entities, and the terms that give them away.

Entities (addresses, numbers) are found by patterns. The corpus tells which terms give
an entity away: a term discloses an entity to the extent that the pointwise mutual
information of the two, a text holding the term and the entity with it, exhausts the
entity's own information. Terms that disclose most of an entity are removed and terms
that disclose much of it are generalised: in the whole texts that hold the entity, and in
all other texts if the entity stands with at least ``likely`` of the term's texts, for
then the term leads to it where the entity itself doesn't stand. ``reach`` says how far a term may stand from an
entity that it is counted with; with None they need only stand in the same text.

Everything is DataFrame work on the JVM. A text is cut into chunks at places that no
match can cross, so the work on a text grows with its length, however much it holds.
The patterns are written with possessive repeats and look-behinds so that each chunk is
scanned in linear time; they match what the plain forms in ``PLAIN`` match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import cut, stored

#: The plain patterns, and the digits or parts that a match must have.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD_DIGITS, PHONE_DIGITS, IP_PART = (16, 19), (8, 15), 255

#: The same in linear time. A match starts where the one before ended or at the head of a run.
#: Digit runs of a card's length only: others of the plain pattern's matches would be dropped.
LINEAR = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of the kind holds; texts without one are not scanned.
HINT = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM = r"(?<![\p{L}\p{N}])\p{L}[\p{L}\p{N}]{2,63}+(?![\p{L}\p{N}])"
KINDS = tuple(PLAIN)
#: Texts (by a hash) or terms up to which they are broadcast (about 60 bytes each).
BROADCAST_ROWS = 500_000
#: Code points of a chunk, at least, unless the text ends; it ends before a word or after a mark that is in no match.
CHUNK = 500
#: Code points of the pieces that a longer text is cut into before its chunks.
LARGE = 100_000


def _cuts(least: int) -> str:
    """The pattern of chunks of ``least`` code points or more."""
    return rf"(?s).{{{least}}}.*?(?:(?<=\x20)(?=[A-Za-z])|(?<=[\n\r\t,;:!?\"'<>/\\|\[\]{{}}=*&#$^~`])|\z)|.+\z"


CHUNKS = _cuts(CHUNK)

SPAN = "struct<kind: string, start: bigint, end: bigint, value: string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(
    text: Column, pattern: str, kind: str, shift: Column | int = 0, only: Callable[[Column], Column] | None = None
) -> Column:
    """The matches of ``pattern`` in ``text`` (``only`` those that it holds for) with their places in code points, moved by ``shift``."""
    zero = F.struct((F.lit(0) + shift).cast("long").alias("at"), F.expr(f"cast(array() as array<{SPAN}>)").alias("found"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["value"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["value"].alias("value"))
        found = F.array_append(state["found"], one)
        found = F.when(only(x["value"]), found).otherwise(state["found"]) if only else found
        return F.struct(end.alias("at"), found.alias("found"))

    def all_of(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
        steps = F.arrays_zip(gaps.alias("gap"), matches.alias("value"))
        return F.when(F.size(matches) > 0, F.aggregate(steps, zero, step, lambda s: s["found"])).otherwise(zero["found"])

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), all_of)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the check: every second from the right doubled, nines cast out."""
    each = F.transform(F.split(F.reverse(digits), "(?!$)(?<=.)"), lambda d: d.cast("int"))
    worth = F.transform(
        each, lambda d, i: F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, F.lit(9)).otherwise(F.lit(0)))
    )
    return F.aggregate(worth, F.lit(0), lambda a, b: a + b) % 10 == 0


def _apart(terms: Column, spans: Column) -> Column:
    """The terms that overlap none of the spans."""
    return F.filter(terms, lambda t: ~F.exists(spans, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))


def _chunks(text: Column) -> Column:
    """``text`` as chunks: at (code points before it) and text."""

    def of(at: Column, pieces: Column) -> Column:
        zero = F.struct(at.alias("at"), F.expr("cast(array() as array<struct<at: bigint, text: string>>)").alias("found"))

        def step(state: Column, x: Column) -> Column:
            found = F.array_append(state["found"], F.struct(state["at"].alias("at"), x.alias("text")))
            return F.struct((state["at"] + F.char_length(x)).alias("at"), found.alias("found"))

        return F.aggregate(pieces, zero, step, lambda s: s["found"])

    start = F.lit(0).cast("long")
    parts = lambda t, pattern: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    # an array grows by copying, so a long text is first cut into large pieces: none of the arrays gets long
    large = F.transform(of(start, parts(text, _cuts(LARGE))), lambda p: of(p["at"], parts(p["text"], CHUNKS)))
    return (
        F.when(F.char_length(text) <= 2 * CHUNK, F.array(F.struct(start.alias("at"), text.alias("text"))))
        .when(F.char_length(text) <= LARGE, of(start, parts(text, CHUNKS)))
        .otherwise(F.flatten(large))
    )


def _of_kind(text: Column, kind: str, shift: Column | int = 0) -> Column:
    """The base entities of one kind in a chunk."""
    holds = {
        "email": lambda v: F.lit(True),
        "ip": lambda v: F.forall(
            F.split(v, "[.]"), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")
        ),
        "card": lambda v: _luhn(_digits(v)),
        "phone": lambda v: F.char_length(_digits(v)).between(*PHONE_DIGITS),
    }[kind]
    worth = text.contains(HINT[kind]) if HINT[kind] else text.rlike("[0-9][0-9 -]{14}")
    return F.when(worth, _placed(text, LINEAR[kind], kind, shift, only=holds)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)"))


def entities(chunks: Column) -> Column:
    """All base entities of a text's ``chunks``: kind, start, end (code points, end exclusive) and value."""

    def of(kind: str) -> Column:
        return F.flatten(F.transform(chunks, lambda c: _of_kind(c["text"], kind, c["at"])))

    return F.concat(*map(of, KINDS))


def _terms(text: Column) -> Column:
    """The different terms of a text, in lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _entity(s: Column) -> Column:
    """What a span's entity is called, the same for all ways of writing it."""
    return F.concat_ws(":", s["kind"], F.when(s["kind"] == "email", F.lower(s["value"])).otherwise(_digits(s["value"])))


def _spans(text: Column, shift: Column | int = 0) -> Column:
    """The base entities of all kinds in a chunk."""
    return F.concat(*(_of_kind(text, kind, shift) for kind in KINDS))


def _hidden(text: Column, hits: Column, shift: Column | int = 0) -> Column:
    """The places of the terms ``hits`` (term to kind) in a chunk, but for those that meet an entity."""
    terms = _placed(text, TERM, "term", shift, only=lambda v: F.map_contains_key(hits, F.lower(v)))
    both = lambda t: F.struct(t.alias("terms"), _spans(text, shift).alias("spans"))
    free = lambda t: _let(both(t), lambda x: _apart(x["terms"], x["spans"]))
    return F.when(F.cardinality(hits) > 0, _let(terms, lambda t: F.when(F.size(t) > 0, free(t)).otherwise(t))).otherwise(
        F.expr(f"cast(array() as array<{SPAN}>)")
    )


def _read(docs: DataFrame) -> DataFrame:
    """(doc_id, print, text): null texts as empty ones, print a hash of the text."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("print", F.xxhash64("text"))


def _small(rows: DataFrame) -> DataFrame:
    """``rows``, already materialised, to be broadcast up to a counted number."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _near(chunks: Column, reach: int) -> Column:
    """The different pairs, term and entity with a tab between, whose term stands outside all entities and within ``reach`` of this one."""
    pad = reach + 66  # a word that the pad tears stands outside the reach

    def around(c: Column, i: Column) -> Column:
        before = F.when(i > 0, F.right(F.get(chunks, i - 1)["text"], F.lit(pad))).otherwise("")
        after = F.coalesce(F.left(F.get(chunks, i + 1)["text"], F.lit(pad)), F.lit(""))
        wide = F.struct(F.concat(before, c["text"], after).alias("text"), (c["at"] - F.char_length(before)).alias("at"))
        until = c["at"] + F.char_length(c["text"])

        def marked(w: Column) -> Column:
            both = F.struct(_spans(w["text"], w["at"]).alias("spans"), _placed(w["text"], TERM, "term", w["at"]).alias("terms"))
            return _let(both, lambda x: F.struct(x["spans"].alias("spans"), _apart(x["terms"], x["spans"]).alias("terms")))

        def with_terms(s: Column, terms: Column) -> Column:
            close = F.filter(terms, lambda t: (t["start"] >= s["start"] - reach) & (t["end"] <= s["end"] + reach))
            return F.transform(close, lambda t: F.concat_ws("\t", F.lower(t["value"]), _entity(s)))

        def pairs(x: Column) -> Column:
            own = F.filter(x["spans"], lambda s: (s["start"] >= c["at"]) & (s["start"] < until))
            return F.flatten(F.transform(own, lambda s: with_terms(s, x["terms"])))

        return _let(wide, lambda w: _let(marked(w), pairs))

    return F.array_distinct(F.flatten(F.transform(chunks, around)))


def disclosing(docs: DataFrame, rows: DataFrame, reach: int | None, support: int, generalise: float, remove: float) -> DataFrame:
    """(term, entity, together, with_term, with_entity, share, kind) of the terms that disclose an entity.

    ``rows`` has print, base and near of every row of ``docs``. Counts are of rows: those
    whose whole text holds the term, or the entity, or the entity and the term within
    ``reach`` of it. Terms that too many texts hold to disclose any entity by
    ``generalise`` are left out before they meet the entities.
    """
    total = float(max(rows.count(), 1))
    some = rows.filter(F.size("base") > 0)
    named = some.select("print", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    whole = cut(named.groupBy("entity").agg(F.count("*").alias("with_entity")).filter(F.col("with_entity") >= support))
    most = whole.agg(F.max("with_entity")).first()[0] or 0
    said = _read(docs).select("print", _terms(F.col("text")).alias("terms"))
    if reach is not None:
        pair = F.split("pair", "\t")
        met = some.select(F.explode("near").alias("pair")).groupBy("pair").agg(F.count("*").alias("together"))
        met = cut(met.filter(F.col("together") >= support).select(pair[0].alias("term"), pair[1].alias("entity"), "together"))
        often = cut(met.select("term").distinct())
    else:  # texts that are equal are one here, with their number
        named = cut(named.join(whole, "entity").groupBy("print", "entity").agg(F.count("*").alias("n")))
        holders = cut(named.groupBy("print").agg(F.max("n").alias("n")))
        held = said.join(_small(holders), "print").select("print", "n", F.explode("terms").alias("term")).distinct()
        held = cut(held)
        often = cut(held.groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= support).select("term"))
    # counted before the join, so that what the join gives is a row a term, however many texts hold it
    with_term = said.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("with_term")).join(_small(often), "term")
    with_term = cut(with_term.filter(F.col("with_term") <= total ** (1 - generalise) * float(most) ** generalise * 1.000001))
    if reach is None:
        met = held.select("print", "term").join(_small(with_term.select("term")), "term").join(named, "print")
        met = met.groupBy("term", "entity").agg(F.sum("n").alias("together")).filter(F.col("together") >= support)
    information = F.log(F.lit(total) / F.col("with_entity"))
    shared = F.log(F.col("together") * F.lit(total) / (F.col("with_term") * F.col("with_entity")))
    return (
        met.join(with_term, "term")
        .join(whole, "entity")
        .withColumn("share", F.when(information > 0, shared / information).otherwise(F.lit(0.0)))
        .filter(F.col("share") >= generalise)
        .withColumn("kind", F.when(F.col("share") >= remove, "remove").otherwise("generalise"))
    )


def _hits(docs: DataFrame, rows: DataFrame, known: DataFrame, likely: float) -> DataFrame:
    """(of, of_print, hits): of every text, the terms to take out and their kinds."""
    anywhere = F.max(F.when(F.col("together") >= likely * F.col("with_term"), F.col("kind")))
    by_term = known.groupBy("term").agg(anywhere.alias("anywhere"), F.collect_list(F.struct("entity", "kind")).alias("of"))
    held = rows.filter(F.size("base") > 0).select("doc_id", "print", F.explode(F.transform("base", _entity)).alias("entity"))
    held = held.join(_small(cut(known.select("entity").distinct())), "entity", "left_semi")
    held = cut(held.groupBy("doc_id", "print").agg(F.collect_set("entity").alias("held")).withColumnsRenamed({"doc_id": "of", "print": "of_print"}))
    said = _read(docs).join(_small(held), _same_text(), "left").select("doc_id", "print", "held", F.explode(_terms(F.col("text"))).alias("term"))
    here = F.filter("of", lambda o: F.array_contains(F.col("held"), o["entity"]))
    kind = F.greatest("anywhere", F.array_max(F.transform(here, lambda o: o["kind"])))
    met = said.join(_small(cut(by_term)), "term").select("doc_id", "print", "term", kind.alias("kind")).filter("kind is not null")
    met = met.groupBy("doc_id", "print").agg(F.collect_set(F.struct("term", "kind")).alias("hits"))
    return cut(met.select(F.col("doc_id").alias("of"), F.col("print").alias("of_print"), F.map_from_entries("hits").alias("hits")))


def _same_text() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("print") == F.col("of_print"))


def _analysed(docs: DataFrame, reach: int | None, support: int, generalise: float, remove: float, likely: float) -> tuple[DataFrame, DataFrame]:
    """The base entities of all rows, and the disclosing terms of the texts that hold some."""
    none = F.lit(None).cast("array<string>")

    def marks(chunks: Column) -> Column:
        near = lambda base: F.when(F.size(base) > 0, _near(chunks, reach)) if reach is not None else none
        return _let(entities(chunks), lambda base: F.struct(base.alias("base"), near(base).alias("near")))

    rows = _read(docs).select("doc_id", "print", _let(_chunks(F.col("text")), marks).alias("marks"))
    rows = stored(rows.select("doc_id", "print", "marks"), "entities").select("doc_id", "print", "marks.base", "marks.near")
    return rows, _hits(docs, rows, cut(disclosing(docs, rows, reach, support, generalise, remove)), likely)


def find(
    docs: DataFrame, reach: int | None = 48, support: int = 3, generalise: float = 0.6, remove: float = 0.9, likely: float = 0.5
) -> DataFrame:
    """Find personal data in every whole text of ``docs`` (``doc_id``, ``text``).

    Returns a row per row: doc_id, print (a hash of the text), base (the entities: kind,
    start, end, value, in order of kind and place) and terms (disclosing terms: kind
    ``generalise`` or ``remove``, start, end, value, in order of kind and place).

    A term within ``reach`` code points (None: anywhere in the text) of an entity in at
    least ``support`` texts discloses log(p(entity | term) / p(entity)) /
    log(1 / p(entity)) of it, over all texts; from ``generalise`` on it is generalised and
    from ``remove`` on removed, wherever it stands in a text that holds the entity and, if
    the entity stands with at least ``likely`` of the texts with the term, in any text, but
    for places that belong to an entity themselves. Null and empty texts hold nothing. Repeated rows each count
    and each get a row. Other columns are not read; an empty table gives an empty result.
    """
    rows, hits = _analysed(docs, reach, support, generalise, remove, likely)
    found = _read(docs).join(_small(hits), _same_text()).dropDuplicates(["doc_id", "print"])
    terms = F.flatten(F.transform(_chunks(F.col("text")), lambda c: _hidden(c["text"], F.col("hits"), c["at"])))
    named = F.transform(
        terms,
        lambda t: F.struct(
            F.element_at(F.col("hits"), F.lower(t["value"])).alias("kind"), t["start"].alias("start"), t["end"].alias("end"), F.lower(t["value"]).alias("value")
        ),
    )
    told = cut(found.select("of", "of_print", F.array_sort(named).alias("terms")))
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    return rows.join(_small(told), _same_text(), "left").select("doc_id", "print", "base", F.coalesce("terms", none).alias("terms"))


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _cleaned(text: Column, hits: Column) -> Column:
    """A chunk with its entities and disclosing terms taken out."""
    word = lambda v: (
        F.when(v.rlike("[0-9]"), "[CODE]").when(v.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[TERM]")
    )
    known = F.transform(
        _hidden(text, hits),
        lambda t: F.struct(
            t["start"].alias("start"),
            (-t["end"]).alias("last"),
            F.when(F.element_at(hits, F.lower(t["value"])) == "remove", "").otherwise(word(t["value"])).alias("by"),
        ),
    )
    base = F.transform(
        _spans(text),
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("by")),
    )

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        return F.when(s["start"] < state["at"], state).otherwise(
            F.struct((-s["last"]).alias("at"), F.concat(state["out"], gap, s["by"]).alias("out"))
        )

    zero = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    rest = lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.char_length(text)))
    changed = lambda x: F.aggregate(F.array_sort(x), zero, step, rest)
    return _let(F.concat(base, known), lambda x: F.when(F.size(x) > 0, changed(x)).otherwise(text))


def sanitise(
    docs: DataFrame, reach: int | None = 48, support: int = 3, generalise: float = 0.6, remove: float = 0.9, likely: float = 0.5
) -> DataFrame:
    """``docs`` with the personal data of ``text`` taken out; all columns stay, ``n_chars`` is kept true.

    Entities become ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``. Generalised terms become
    what they are a case of: ``[CODE]`` with a digit, ``[NAME]`` with a capital, else
    ``[TERM]``; removed terms nothing. Of overlapping spans the first stays (ties: the
    longest). A null text stays null. Repeated rows stay; an empty table gives an empty one.
    """
    _, hits = _analysed(docs, reach, support, generalise, remove, likely)
    hits = _small(hits).withColumnsRenamed({"of": "__of", "of_print": "__print", "hits": "__hits"})
    same = F.col("doc_id").eqNullSafe(F.col("__of")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__print"))
    joined = docs.join(hits, same, "left").withColumn("__hits", F.coalesce("__hits", F.expr("cast(map() as map<string, string>)")))
    clean = F.array_join(F.transform(_chunks(F.col("text")), lambda c: _cleaned(c["text"], F.col("__hits"))), "")
    joined = joined.withColumn("text", F.when(F.col("text").isNotNull(), clean))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.coalesce(F.char_length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
