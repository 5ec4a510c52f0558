"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression with the literal tokens that any match must
contain. A rule is filed under the one of its tokens that the fewest URLs hold.
A URL's tokens fetch the rules filed under them, and only those rules run their
expression on it. All of it is DataFrame work. One scan counts the rules' tokens. In a
second, a short list's index stands in the plan as a map, so that every URL is judged in
its own row without a shuffle; a longer one is joined with the URLs' tokens, and only what
fits comes back to the URLs. Rules without a literal token have no place in the index and
run on every URL where it stands.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm._stage import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Tokens of rules up to which their index is broadcast (about 200 bytes each); a longer list is joined by shuffle.
BROADCAST_TOKENS = 200_000
#: Tokens of rules up to which the index is a map in the plan, searched from end to end.
MAP_TOKENS = 256
#: What bounds a token in an expression: an end of the text, or marks of which one must stand there.
MARK = r"(?:\\[Az]|\\[^A-Za-z0-9]|[^A-Za-z0-9\\\[\](){}*+?|^$.])"
BOUND = re.compile(rf"(?:{MARK}|\(\?:{MARK}(?:\|{MARK})*\))(?![*?{{])")


@dataclass(frozen=True)
class Rule:
    """``pattern`` (Java syntax) is searched in host + path; ``tokens`` are whole
    alphanumeric runs, in lower case, of every URL that it matches.

    ``named`` rules report their name and win by length over shorter ones; the
    others only decide where no named rule fits."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    named: bool = True


def site_rule(verdict: str, host: str, path: str = "/") -> Rule:
    """A rule for ``host`` and its subdomains and for paths that start with ``path``."""
    begin = re.sub(r"([^A-Za-z0-9/_])", r"\\\1", host) + re.sub(r"([^A-Za-z0-9/_])", r"\\\1", path)
    whole = path if not path[-1:].isalnum() else path[: len(path) - len(re.search(r"[A-Za-z0-9]*$", path)[0])]
    tokens = [t for t in re.split("[^a-z0-9]+", (host + whole).lower()) if t]
    return Rule(host + path, verdict, rf"(?s)\A(?:[^/]*\.)?{begin}", tuple(dict.fromkeys(tokens)))


def literal_tokens(pattern: str) -> tuple[str, ...]:
    """Alphanumeric runs that stand whole in every text that ``pattern`` matches, in lower case.

    A run counts if it is literal and has a bound on both sides, outside groups and
    classes. Patterns with alternatives at the top, or of another form, have none.
    """
    found, bounded, run, at = [], False, "", 0
    while at < len(pattern):
        c = pattern[at]
        bound = BOUND.match(pattern, at)
        if bound:
            if run and bounded:
                found.append(run)
            bounded, run, at = True, "", bound.end()
        elif c.isascii() and c.isalnum() and pattern[at + 1 : at + 2] not in ("*", "?", "{", "+"):
            run, at = run + c, at + 1
        elif c == "|":
            return ()
        else:
            bounded, run, at = False, "", _behind(pattern, at)
    return tuple(dict.fromkeys(t.lower() for t in found))


def _behind(pattern: str, at: int) -> int:
    """The place behind the escape, class, group or character at ``at`` and what repeats it."""
    depth, in_class = 0, False
    while at < len(pattern):
        c = pattern[at]
        at += 2 if c == "\\" else 1
        if in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        if depth == 0 and not in_class:
            break
    return re.compile(r"(?:[*+?]|\{[^}]*\})*").match(pattern, at).end()


def pattern_rule(name: str, verdict: str, pattern: str) -> Rule:
    return Rule(name, verdict, pattern, literal_tokens(pattern), named=False)


#: Sites of the production list.
SITES = (
    site_rule("allow", "org"),
    site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"),
    site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)
#: Pages that hold no prose, wherever they are.
GENERAL = (
    pattern_rule("ads", "block", "/ads/"),
    pattern_rule("adserver", "block", r"(?:\A|\.)adserver\."),
    pattern_rule("banners", "block", "/banners/"),
    pattern_rule("cgi", "block", "/cgi-bin/"),
    pattern_rule("login", "block", r"/login(?:/|\z)"),
    pattern_rule("logout", "block", r"/logout(?:/|\z)"),
    pattern_rule("wp-admin", "block", "/wp-admin/"),
    pattern_rule("wp-login", "block", r"/wp-login\.php"),
)
PRODUCTION = SITES + GENERAL


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = PRODUCTION, default: str = "allow") -> DataFrame:
    """Judge the ``url`` of every row of ``pages`` (``page_id``, ``url``).

    Returns page_id, host, path, rule, verdict, pattern. ``rule`` is the longest
    fitting named rule (ties: longer host part, then smaller name); without one it
    is null and the verdict is ``block`` if any general pattern with that verdict
    fits (``pattern`` names it), else ``default``. Null urls and urls without
    ``://`` have empty host and path and the default verdict. Repeated rows are
    judged one by one; columns other than the two are not looked at. An empty
    table gives an empty result.
    """
    n_tokens = sum(len(r.tokens) for r in rules)
    sent = F.broadcast if n_tokens <= BROADCAST_TOKENS else lambda side: side
    spark = pages.sparkSession
    url = F.coalesce(F.col("url"), F.lit(""))
    rows = pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1).alias("path"),
    )
    where = F.concat("host", "path")
    tokens = F.array_remove(F.array_distinct(F.split(F.lower(where), "[^a-z0-9]+")), "")
    listed = {i: {"size": len(r.name), "slash": -r.name.find("/") - 1, "id": -i, "name": r.name, "of": r.verdict, "expression": r.pattern, "named": r.named} for i, r in enumerate(rules)}
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    everywhere = literal([rule for i, rule in listed.items() if not rules[i].tokens], f"array<{RULE}>")
    filed = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in r.tokens], "rule int, token string")
    words = filed.select("token").distinct()
    seen = (
        rows.select(F.explode(tokens).alias("token"))
        .join(sent(words), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("urls"))
    )
    index = filed.join(sent(seen), "token", "left").groupBy("rule").agg(F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), "token")).alias("token"))
    if n_tokens <= MAP_TOKENS:
        under: dict[str, list] = {}
        for r in index.collect():  # a row per rule of the list that the caller gave
            under.setdefault(r.token, []).append(listed[r.rule])
        held = literal(under, f"map<string, array<{RULE}>>")
        fetched = F.flatten(F.filter(F.transform(tokens, lambda t: F.try_element_at(held, t)), lambda found: found.isNotNull()))
        judged = rows.withColumn("fits", _fitting(F.concat(fetched, everywhere), where))
    else:
        rows = cut(rows.withColumn("row", F.monotonically_increasing_id()))
        details = spark.createDataFrame([(i, *(v[k] for k in KEYS)) for i, v in listed.items()], f"rule int, {RULE[7:-1]}".replace(":", ""))
        filing = sent(index.join(sent(details), "rule").select("token", F.array(F.struct(*KEYS)).alias("held")))
        fits = rows.withColumn("token", F.explode(tokens)).join(filing, "token").select("row", F.explode(_fitting(F.col("held"), where)).alias("fit"))
        found = fits.groupBy("row").agg(F.collect_list("fit").alias("found"))
        judged = rows.join(found, "row", "left").withColumn("found", F.coalesce("found", F.array().cast(f"array<{RULE}>")))
        judged = judged.withColumn("fits", F.concat("found", _fitting(everywhere, where)))
    best = F.array_max(F.transform(F.filter("fits", lambda c: c["named"]), lambda c: F.struct(*(c[k].alias(k) for k in ("size", "slash", "id", "name", "of")))))
    milder = lambda c: F.struct((c["of"] != "block").alias("milder"), c["name"].alias("name"), c["of"].alias("of"))
    general = F.array_min(F.transform(F.filter("fits", lambda c: ~c["named"]), milder))
    return (
        judged.withColumn("best", best)
        .withColumn("general", general)
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.name").alias("rule"),
            F.coalesce("best.of", "general.of", F.lit(default)).alias("verdict"),
            F.when(F.col("best").isNull(), F.col("general.name")).alias("pattern"),
        )
    )


#: A rule as it stands beside a URL.
KEYS = ("size", "slash", "id", "name", "of", "expression", "named")
RULE = "struct<size: int, slash: int, id: int, name: string, of: string, expression: string, named: boolean>"


def _fitting(candidates: Column, where: Column) -> Column:
    """The candidates whose expression is found in ``where``."""
    return F.filter(candidates, lambda c: F.regexp_like(where, c["expression"]))
