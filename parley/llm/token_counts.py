"""Token counts that follow edits.

Each document keeps a segment tree over its leaves, stretches of pre-tokens of about ``LEAF``
characters that end where the splitting pattern always ends one: before a single blank between two
other signs. Nodes hold the sums of characters and tokens below. An edit finds its leaves through the
sums of characters, encodes only those leaves and the context that their ends depend on, and updates
the sums above them. The count of the whole text is the root.

Edits of a document refer to its text before all of them: (start, length, text) in code points.

Defined results: a null text counts as empty and has 0 tokens; an edit that starts before the end of
an earlier one (by start, then length, then text) begins where that one ends; places outside the text are moved to
its ends; null parts of an edit count as 0 or empty; a document without edits keeps its count; edits of
unknown documents are dropped; repeated rows get the same edits each. A text without any blank is one
leaf. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import tokens

LEAF = 256
Edit = tuple[int, int, str]


def split(text: str, size: int = LEAF) -> list[str]:
    """Cut before single blanks between other signs, at least ``size`` characters apart."""
    out, start = [], 0
    at = text.find(" ", size)
    while at != -1 and at + 1 < len(text):
        if text[at - 1].isspace() or text[at + 1].isspace():
            at = text.find(" ", at + 1)
        else:
            out.append(text[start:at])
            start, at = at, text.find(" ", at + size)
    out.append(text[start:])
    return out


class Tree:
    """Sums over slots of text; a slot holds whole leaves, and none once they moved to another."""

    def __init__(self, slots: list[str], counts: list[int]):
        self.slots = slots
        self.base = 1 << (len(slots) - 1).bit_length()
        self.chars = [0] * (2 * self.base)
        self.tokens = [0] * (2 * self.base)
        self.chars[self.base : self.base + len(slots)] = map(len, slots)
        self.tokens[self.base : self.base + len(slots)] = counts
        for node in range(self.base - 1, 0, -1):
            self._sum(node)

    def _sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def find(self, at: int) -> tuple[int, int]:
        """The slot that holds the character ``at`` (or the last one) and where it begins."""
        at = max(0, min(at, self.chars[1] - 1))
        node, before = 1, 0
        while node < self.base:
            node *= 2
            if at - before >= self.chars[node]:
                before += self.chars[node]
                node += 1
        return node - self.base, before

    def put(self, slot: int, text: str, count: int) -> None:
        self.slots[slot] = text
        node = self.base + slot
        self.chars[node], self.tokens[node] = len(text), count
        while node > 1:
            node //= 2
            self._sum(node)

    @property
    def total(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.slots)


def build(text: str, encode: Callable[[str], list[int]], size: int = LEAF) -> Tree:
    slots = split(text, size)
    return Tree(slots, [len(encode(s)) for s in slots])


def ordered(edits: Iterable, length: int) -> list[Edit]:
    """Edits inside the text that don't overlap, by place."""
    cells = sorted((max(0, e[0] or 0), max(0, e[1] or 0), e[2] or "") for e in edits or () if e is not None)
    out, end = [], 0
    for start, size, new in cells:
        stop = min(start + size, length)
        start = min(max(start, end), length)
        out.append((start, max(0, stop - start), new))
        end = max(end, stop)
    return [e for e in out if e[1] or e[2]]


def edit(
    tree: Tree, edits: Iterable, encode: Callable[[str], list[int]], size: int = LEAF
) -> int:
    """Apply all edits; the number of characters that were encoded again.

    From the last region to the first, so that places before it still hold. A region is the slots of
    one edit and of all edits that touch them. The end of a leaf depends on the sign before and the
    two from it on, so the region reaches two signs before the edit and one beyond it.
    """
    regions: list[tuple[int, int, int, list[Edit]]] = []  # first slot, last slot, start, edits
    for start, length, new in ordered(edits, tree.chars[1]):
        first, before = tree.find(start - 2)
        last, _ = tree.find(start + length)
        if regions and first <= regions[-1][1]:
            old = regions[-1]
            regions[-1] = (old[0], max(last, old[1]), old[2], [*old[3], (start, length, new)])
        else:
            regions.append((first, last, before, [(start, length, new)]))
    encoded = 0
    for first, last, before, own in reversed(regions):
        text, parts, at = "".join(tree.slots[first : last + 1]), [], 0
        for start, length, new in own:
            parts += [text[at : start - before], new]
            at = start - before + length
        leaves = split("".join([*parts, text[at:]]), size)
        encoded += sum(map(len, leaves))
        # The leaves share out the slots of the region; what is over goes to the last one.
        room = last - first + 1
        for i in range(room):
            mine = leaves[i:] if i == room - 1 else leaves[i : i + 1]
            tree.put(first + i, "".join(mine), sum(len(encode(leaf)) for leaf in mine))
    return encoded


COUNTS = (
    "doc_id long, tokens_before long, tokens_after long, chars_after long, edits long, "
    "encoded_chars long"
)


def _counted(edits_of: Callable[[tuple], Iterable], path: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokens.load(path)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                tree = build(row.text or "", encode)
                before, own = tree.total, list(edits_of(row))
                encoded = edit(tree, own, encode)
                rows.append((before, tree.total, tree.chars[1], len(own), encoded))
            names = [f.split()[0] for f in COUNTS.split(", ")]
            out = pd.DataFrame(rows, columns=names[1:])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return run


def recount(
    docs: DataFrame,
    edits: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
) -> DataFrame:
    """Counts before and after a table of edits (doc_id, start, length, text).

    The edits of a document, which don't overlap, are no larger than its texts and are gathered
    beside it.
    """
    own = edits.groupBy(F.col("doc_id").alias("_of")).agg(
        F.collect_list(
            F.struct(
                F.coalesce("start", F.lit(0)).alias("start"),
                F.coalesce("length", F.lit(0)).alias("length"),
                F.coalesce("text", F.lit("")).alias("text"),
            )
        ).alias("own")
    )
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.join(own, F.col("doc_id") == F.col("_of"), "left").select("doc_id", "text", "own")

    def edits_of(row) -> list[Edit]:
        return [] if row.own is None else [(e["start"], e["length"], e["text"]) for e in row.own]

    return rows.mapInPandas(_counted(edits_of, tokenizer_path or tokens.default_path()), COUNTS)


def recount_by_rule(
    docs: DataFrame,
    rule: Callable[[str], Iterable[Edit]],
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
) -> DataFrame:
    """The same for edits that a rule finds in each text, without a shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def edits_of(row) -> Iterable[Edit]:
        return rule(row.text or "")

    return rows.mapInPandas(_counted(edits_of, tokenizer_path or tokens.default_path()), COUNTS)
