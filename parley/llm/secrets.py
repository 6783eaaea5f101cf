"""Secrets in texts, found through a trigram inverted index; DataFrame functions only.

Every rule is a regular expression for what stands before a secret and one for the secret. A Boolean query of
trigrams is derived from it, posting lists are intersected, and the rule runs over the texts that remain. A
rule without mandatory trigrams, such as a run of hex digits, runs over all texts.

A match's place is found without Python: matches are wrapped in a private sign, the text is
split there, and the lengths of the pieces are summed. Texts of candidates are the only ones that are
shuffled, and of these a text of a thousandth of all rows finds its rules by broadcast and is left where it is, so no task gets
all copies of one text. Candidates are told from the rest by a filter of hashes whose size follows their number.

Defined results: a null text is empty and has no spans; matches of one kind don't overlap and are
the leftmost ones; those whose secret is too short are dropped after matching, so what they cover stays covered;
repeated rows, ids and null ids give a row each; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.common import FILTER_BITS, probably
from parley.llm.trigrams import build_index, candidates, text_key, trigram_query
from parley.session import materialise

#: Share of all rows with trigrams from which a text counts as hot; there are fewer such texts than this.
HOT = 1000
#: Bits of the filter per candidate, and at most (32 MB).
BITS_EACH, MOST_BITS = 16, 1 << 28
_MARK, _OTHER = "\ue000", "\ue001"
_SPAN = "struct<start:int,no:int,kind:string,end:int>"


@dataclass(frozen=True)
class Rule:
    """``before`` and ``secret`` match one after the other; the secret has ``least`` signs or more."""

    kind: str
    before: str
    secret: str
    least: int
    any_case: bool = False

    @property
    def pattern(self) -> str:
        return f"{'(?i)' if self.any_case else ''}({self.before})({self.secret})"


# The three rules of the contract.
BASE = (
    Rule("assign", r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
         r"[A-Za-z0-9+/_.=-]+", 8, True),
    Rule("access", "", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", "", r"[0-9a-f]{32,}", 32),
)
#: Forms of keys that carry their own sign.
MORE = (
    Rule("github", "", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    Rule("pem", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 27),
    Rule("login", r"://[A-Za-z0-9._~%-]+:", r"[A-Za-z0-9._~%!$&*+;=-]+@", 7),
)
RULES = BASE + MORE


def _matches(text: Column, rule: Rule, no: int) -> Column:
    """Spans of a rule in a text that doesn't hold the private sign."""
    pieces = F.split(F.regexp_replace(text, F.lit(rule.pattern), F.lit(f"{_MARK}$1{_MARK}$2{_MARK}")), _MARK)
    parts = F.transform(pieces, lambda p, i: F.struct((i % 3).alias("part"), F.char_length(p).alias("size")))
    none = F.array().cast(f"array<{_SPAN}>")

    def step(seen: Column, piece: Column) -> Column:
        end = seen["at"] + piece["size"]
        span = F.struct(
            seen["start"].alias("start"), F.lit(no).alias("no"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        found = (piece["part"] == 2) & (piece["size"] >= rule.least)
        return F.struct(
            end.alias("at"),
            F.when(piece["part"] == 0, end).otherwise(seen["start"]).alias("start"),
            F.when(found, F.array_append(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"), none.alias("spans"))
    spans = F.aggregate(parts, start, step, lambda seen: seen["spans"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), spans).otherwise(none)


def _spans(text: Column, rules: Sequence[tuple[int, Rule, Column | None]]) -> Column:
    none = F.array().cast(f"array<{_SPAN}>")
    found = [
        _matches(text, rule, no) if asked is None else F.when(asked, _matches(text, rule, no)).otherwise(none)
        for no, rule, asked in rules
    ]
    return F.array_sort(F.concat(none, *found))


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, spans (start, no, kind, end), in order of start and rule.

    ``start`` and ``end`` count code points from 0; ``no`` is the rule's place in ``rules``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("whole"),
        F.when(F.contains(text, F.lit(_MARK)), F.replace(text, F.lit(_MARK), F.lit(_OTHER)))
        .otherwise(text).alias("text"),
    ).select("doc_id", "text", text_key(F.col("whole")).alias("key"))
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    numbered = list(enumerate(rules))
    everywhere = [(no, rule, None) for no, rule in numbered if queries[rule.kind] is None]
    indexed = {kind: query for kind, query in queries.items() if query is not None}
    if not indexed:
        return rows.select("doc_id", _spans(F.col("text"), everywhere).alias("spans"))
    grams = {gram for query in indexed.values() for grams in query for gram in grams}
    index, copies = build_index(docs, text_col, grams)
    found = materialise(candidates(index, indexed))
    total = copies.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    often = copies.where(F.col("rows") * HOT > total).select("key")
    bits = FILTER_BITS
    while bits < min(found.count() * BITS_EACH, MOST_BITS):
        bits *= 2
    marked = probably(rows, "key", found, "near", bits)
    rest = marked.where("NOT near").select("doc_id", _spans(F.col("text"), everywhere).alias("spans"))
    hot = found.join(F.broadcast(often), "key").select(F.col("key").alias("hot"), F.col("rules").alias("hot_rules"))
    near = marked.where("near").join(F.broadcast(hot), F.col("key") == F.col("hot"), "left")
    # A row that has its rules is dealt anywhere.
    way = F.when(F.col("hot").isNull(), F.col("key")).otherwise(F.xxhash64(F.monotonically_increasing_id()))
    rare = found.join(F.broadcast(often), "key", "left_anti").select(F.col("key").alias("of"), "rules")
    near = near.withColumn("way", way).join(rare, F.col("way") == F.col("of"), "left").select(
        "doc_id", "text", F.coalesce("hot_rules", "rules", F.array().cast("array<string>")).alias("rules")
    )
    asked = [
        (no, rule, None if queries[rule.kind] is None else F.array_contains("rules", rule.kind))
        for no, rule in numbered
    ]
    verified = near.select("doc_id", _spans(F.col("text"), asked).alias("spans"))
    return rest.unionByName(verified)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
