"""Boolean trigram queries of regular expressions, and an inverted index of trigrams to answer them.

A query is a set of alternatives, each a set of trigrams: a text can match only if it holds all trigrams of
some alternative. It is derived by following an expression from left to right and keeping, for every way
through it, the trigrams seen so far and the last two signs. What may be anything (wide classes, repeats)
ends a literal. An alternative that demands more than another one is dropped. Trigrams are in lower case,
so that one index serves expressions of any case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.session import materialise

Query = frozenset[frozenset[str]]

#: A class of more signs counts as any sign; more ways through an expression than this are merged.
CLASS, WAYS = 8, 64
#: Repeats that are followed sign by sign.
UNROLLED = 3
_ANY = (frozenset(), "")


def trigram_query(pattern: str) -> Query | None:
    """The alternatives of an expression; None if it can match without any trigram."""
    ways = _follow({_ANY}, parser.parse(pattern))
    found = frozenset(grams for grams, _ in _weakest((g, "") for g, _ in ways))
    return None if frozenset() in found else found


def _follow(ways: set, items) -> set:
    for op, value in items:
        ways = _weakest(_step(ways, str(op), value))
        if len(ways) > WAYS:
            ways = _weakest((grams, "") for grams, _ in ways)
        if len(ways) > WAYS:
            ways = {(frozenset.intersection(*[g for g, _ in ways]), "")}
    return ways


def _step(ways: set, op: str, value) -> set:
    if op == "LITERAL":
        return _signs(ways, [chr(value)])
    if op == "IN":
        return _signs(ways, _members(value))
    if op == "SUBPATTERN":
        return _follow(ways, value[-1])
    if op == "BRANCH":
        return set().union(*[_follow(ways, items) for items in value[1]])
    if op in ("AT", "ASSERT", "ASSERT_NOT"):
        return ways  # no width
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
        least, most, items = value
        for _ in range(min(least, UNROLLED)):
            ways = _follow(ways, items)
        if least == most <= UNROLLED:
            return ways
        if (least, most) == (0, 1):
            return ways | _follow(ways, items)
    return {(grams, "") for grams, _ in ways}


def _signs(ways: set, signs: list[str] | None) -> set:
    if not signs or not all(s.isascii() for s in signs):
        return {(grams, "") for grams, _ in ways}
    out = set()
    for grams, tail in ways:
        for sign in signs:
            last = tail + sign.lower()
            out.add((grams | {last} if len(last) == 3 else grams, last[-2:]))
    return out


def _members(items) -> list[str] | None:
    """The signs of a class, None if they are many or not listed."""
    out = []
    for op, value in items:
        if str(op) == "LITERAL":
            out.append(chr(value))
        elif str(op) == "RANGE" and value[1] - value[0] < CLASS:
            out += [chr(c) for c in range(value[0], value[1] + 1)]
        else:
            return None
    return out if len(out) <= CLASS else None


def _weakest(ways: Iterable) -> set:
    """The ways that no other way implies."""
    kept: list = []
    for grams, tail in sorted(set(ways), key=lambda w: (len(w[0]), len(w[1]), sorted(w[0]), w[1])):
        if not any(g <= grams and tail.endswith(t) for g, t in kept):
            kept.append((grams, tail))
    return set(kept)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _any_of(grams: Iterable[str]) -> str:
    """An expression that finds all places of the trigrams, overlapping ones too, in one pass over a text."""
    tree: dict[str, dict[str, str]] = {}
    for a, b, c in sorted(grams):
        ends = tree.setdefault(a, {})
        ends[b] = ends.get(b, "") + re.escape(c)
    ways = "|".join(
        re.escape(a) + "(?:" + "|".join(f"{re.escape(b)}[{cs}]" for b, cs in ends.items()) + ")"
        for a, ends in tree.items()
    )
    return f"(?=[{''.join(map(re.escape, tree))}])(?=({ways}))"


def build_index(docs: DataFrame, text_col: str, grams: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Posting lists (gram, key) of the given trigrams, an entry per different text, on shared files; and how many
    rows have each text (key, rows).

    Trigrams that no query names would only be stored, so they are left out. All entries of a text lie
    in one file, which is sorted by trigram.
    """
    text = F.col(text_col)
    held = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_any_of(grams)), F.lit(1))))
    lists = docs.select(text_key(text).alias("key"), held.alias("grams")).where(F.size("grams") > 0)
    lists = materialise(lists.groupBy("key", "grams").agg(F.count("*").alias("rows")))
    index = materialise(lists.select(F.explode("grams").alias("gram"), "key").sortWithinPartitions("gram"))
    return index, lists.select("key", "rows")


def candidates(index: DataFrame, queries: Mapping[str, Query]) -> DataFrame:
    """(key, rules): the texts in the intersection of the posting lists of some alternative of a rule.

    An alternative's trigrams are numbered and the numbers seen for a text are joined by OR, so an entry may come
    twice; the lists are read once for all rules.
    """
    wanted = [
        (rule, n, gram, 1 << bit, (1 << len(grams)) - 1)
        for rule, query in queries.items()
        for n, grams in enumerate(sorted(query, key=sorted))
        for bit, gram in enumerate(sorted(grams)[:62])
    ]
    table = index.sparkSession.createDataFrame(
        [(r, n, g, b, min(all_, (1 << 62) - 1)) for r, n, g, b, all_ in wanted],
        "rule string, alternative int, gram string, bit long, all long",
    )
    named = index.where(F.col("gram").isin(sorted({w[2] for w in wanted})))
    hits = (
        named.join(F.broadcast(table), "gram")  # a row per trigram of a rule
        .groupBy("rule", "alternative", "all", "key")
        .agg(F.bit_or("bit").alias("seen"))
        .where(F.col("seen") == F.col("all"))
    )
    return hits.groupBy("key").agg(F.array_sort(F.collect_set("rule")).alias("rules"))


def admits(query: Query | None, text: str) -> bool:
    """Whether a text may match, by its trigrams."""
    low = text.lower()
    return query is None or any(all(g in low for g in grams) for grams in query)


def compiled(pattern: str) -> re.Pattern:
    """The expression as the JVM reads it: cases are folded for A-Z only."""
    return re.compile(pattern, re.ASCII)
