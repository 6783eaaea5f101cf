"""N-gram Jaccard join by count vectors, their R-trees and verification.

Two sets with a Jaccard similarity of at least t differ in few elements: d <= size * (1 - t) / t for
the smaller one. The hash range of the shingles is cut into more slabs than that, so linked sets agree
in at least one slab. Slabs with equal sums of shingle hashes are tiles, and every link lies within a tile.
A set takes part with its slabs of two shingles or more if those alone are more than d, so
that one of them must agree; else with all slabs, empty ones too. It does so on the slab grid of its own size and
on those of the smaller sizes that it may be linked with. Percentages from 75 on keep tiles small.

No tile is spelt out in pairs. Each member is tied to the tile's smallest one, and what hangs together
by such ties is a block, which then holds all links of its members. A block is joined in a task: shingles
are hashed into ``GROUPS`` groups, and the counts are points of an R-tree. Two nodes, or two points,
whose summed coordinate minima stay below the least overlap have no link. Survivors are verified on
their shingle sets unless links found before connect them, so at most a spanning tree comes out.

Before any shuffle, a task merges equal sets and, within a tile, keeps one member and hands the others
over as already tied, so a hot tile reaches the shuffle as one row for each task. Blocks above
``BLOCK`` members are cut into chunks, each pair of which is joined; none is dropped or capped.

Defined results: texts without words are linked with nothing and are their own component; shorter
texts than a shingle count as one; null ids have a size but no component; rows under one id are one document, and
the link of any of their texts counts; an empty table gives no rows. Other columns are ignored. Very long texts are
hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import probably_in
from parley.llm.components import components
from parley.llm.words import Words
from parley.session import materialise, settled

WORDS_PER_SHINGLE, PERCENT = 5, 80
GROUPS = 128
#: Members of a block, or chunk of one, that meet in a task; points of a leaf of the tree.
BLOCK, LEAF = 2048, 16
#: Keys over which the members of a large block are dealt.
SALTS = 16
#: Slab rows that a task merges at once.
_MERGE = 1 << 18


def shingles(text: str | None, k: int) -> np.ndarray:
    return Words(text.encode("utf-8", "replace")).shingles(k) if text else np.empty(0, np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def most_apart(size: int, percent: int) -> int:
    """Most elements by which a set of ``size`` and a linked one of no smaller size differ."""
    return size * (100 - percent) // percent


def slab_counts(size: int, percent: int) -> list[int]:
    """Numbers of slabs of the grids on which a set of ``size`` takes part.

    A grid serves the smaller partners that differ by so much that they need about its number of
    slabs; numbers grow by a fifth, so a set is on few of them.
    """
    smallest = -(-size * percent // 100)
    apart = {most_apart(s, percent) for s in (smallest, size)}
    low, high = max(1, min(apart)), max(apart)
    out, count = [], 3
    while high:
        if reach(count, percent) >= low:
            out.append(count)
        if reach(count, percent) >= high:
            break
        count = max(count + 1, count * 6 // 5)
    return out


def reach(count: int, percent: int) -> int:
    """The largest difference that a grid of ``count`` slabs serves.

    Enough slabs hold two shingles or more: at lower percentages slabs are smaller and more are needed.
    """
    return min(count - 2, int(count * (0.92 if percent >= 87 else 0.7)))


def slabs(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the tiles of one rising shingle set."""
    keys = []
    for count in slab_counts(len(own), percent):
        place = ((own >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        sums = np.add.reduceat(own, first)
        slab = place[first].astype(np.uint64)
        strong = np.diff(np.append(first, len(own))) > 1
        if strong.sum() > min(most_apart(len(own), percent), reach(count, percent)):
            slab, sums = slab[strong], sums[strong]
        else:
            empty = np.setdiff1d(np.arange(count, dtype=np.uint64), slab)
            slab = np.concatenate([slab, empty])
            sums = np.concatenate([sums, np.zeros(len(empty), np.uint64)])
        key = (sums ^ (slab * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(count)
        key = (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(key ^ (key >> np.uint64(30)))
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)


_SET = "doc_id long, n_shingles long, mark long, second_mark long"


def _marks(k: int):
    """One row per document: two sums that stand for its set."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                own = shingles(text, k)
                twisted = (own ^ (own >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
                sums = [own.sum(dtype=np.uint64), (twisted ^ (twisted >> np.uint64(29))).sum(dtype=np.uint64)]
                rows.append((len(own), *np.array(sums, np.uint64).view(np.int64).tolist()))
            out = pd.DataFrame(rows, columns=["n_shingles", "mark", "second_mark"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out.astype({"doc_id": "Int64"})

    return run


_MEMBER = "key long, id long, leader long"


def _members(k: int, percent: int):
    """Tile rows of the documents of a task; leader is null for those that go on to the shuffle."""

    def merged(keys: list[np.ndarray], ids: list[int]) -> pd.DataFrame:
        key = np.concatenate(keys)
        owner = np.repeat(np.array(ids, np.int64), [len(x) for x in keys])
        order = np.lexsort((owner, key))
        key, owner = key[order], owner[order]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        leader = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        # A tile's leader goes on; the others are matched, once with each leader.
        met = np.unique(np.stack([owner, leader])[:, owner != leader], axis=1)
        on = pd.DataFrame({"key": key[first], "id": owner[first]})
        met = pd.DataFrame({"key": 0, "id": met[0], "leader": met[1]})
        return pd.concat([on, met]).astype({"leader": "Int64"})[["key", "id", "leader"]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys: list[np.ndarray] = []
        ids: list[int] = []
        seen: set[bytes] = set()
        rows = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                own = shingles(text, k)
                mark = own.sum(dtype=np.uint64).tobytes() + len(own).to_bytes(8, "little")
                if mark in seen:  # the same set, met already; its document joins by its marks
                    continue
                seen.add(mark)
                found = slabs(own, percent)
                if len(found):
                    keys.append(found)
                    ids.append(int(doc_id))
                    rows += len(found)
                if rows > _MERGE:
                    yield merged(keys, ids)
                    keys, ids, rows, seen = [], [], 0, set()
        if keys:
            yield merged(keys, ids)

    return run


class Node:
    """A box of points: coordinate maxima and least size."""

    __slots__ = ("at", "parts", "top", "least")

    def __init__(self, at, parts, top, least):
        self.at, self.parts, self.top, self.least = at, parts, top, least


def tree(points: np.ndarray, size: np.ndarray, at: np.ndarray) -> Node:
    """The points ``at``, packed by size, then by the coordinate that varies most."""
    order = at[np.lexsort((points[at][:, int(points[at].var(0).argmax())], size[at]))]
    nodes = []
    for i in range(0, len(order), LEAF):
        own = order[i : i + LEAF]
        nodes.append(Node(own, None, points[own].max(0), int(size[own].min())))
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), LEAF):
            parts = nodes[i : i + LEAF]
            top = np.max([p.top for p in parts], 0)
            above.append(Node(None, parts, top, min(p.least for p in parts)))
        nodes = above
    return nodes[0]


def candidates(
    points: np.ndarray, size: np.ndarray, split: np.ndarray, percent: int
) -> Iterator[tuple[int, int]]:
    """Pairs of points whose bound allows a link.

    ``split`` numbers the chunks; with two of them only pairs across are wanted.
    """
    sides = [np.flatnonzero(split == s) for s in np.unique(split)]
    ratio = percent / (100 + percent)
    stack = [(tree(points, size, sides[0]), tree(points, size, sides[-1]))]
    while stack:
        x, y = stack.pop()
        if np.minimum(x.top, y.top).sum() < ratio * (x.least + y.least) - 1e-6:
            continue
        if x.parts is not None:
            stack += [(p, y) for p in x.parts]
        elif y.parts is not None:
            stack += [(x, p) for p in y.parts]
        else:
            bound = np.minimum(points[x.at][:, None], points[y.at][None]).sum(2)
            fits = bound >= ratio * (size[x.at][:, None] + size[y.at][None]) - 1e-6
            for p, q in zip(*np.nonzero(fits)):
                i, j = int(x.at[p]), int(y.at[q])
                if len(sides) == 2 or i < j:
                    yield i, j


def spanning_links(
    sets: list[np.ndarray], split: np.ndarray, percent: int, groups: int = GROUPS
) -> list[tuple[int, int]]:
    """Verified links that connect whatever all links connect; connected pairs aren't verified."""
    points = np.array(
        [np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups) for s in sets], np.int32
    )
    size = np.array([len(s) for s in sets])
    root, out = list(range(len(sets))), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in candidates(points, size, split, percent):
        a, b = find(i), find(j)
        if a != b and linked(sets[i], sets[j], percent):
            root[max(a, b)] = min(a, b)
            out.append((i, j))
    return out


def _linked_in_blocks(k: int, percent: int):
    """Over rows sorted by (block, low, high): many blocks are small, so a batch holds many."""

    def of_group(rows: pd.DataFrame) -> list[tuple]:
        ids, chunk = rows["id"].to_numpy(), rows["chunk"].to_numpy()
        if len(ids) < 2:
            return []
        sets = [shingles(t, k) for t in rows["text"]]
        return [
            (min(ids[i], ids[j]), max(ids[i], ids[j]))
            for i, j in spanning_links(sets, chunk, percent)
        ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            group = rows[["block", "low", "high"]].to_numpy()
            bounds = [0, *(np.flatnonzero((group[1:] != group[:-1]).any(1)) + 1).tolist()]
            found = [pair for x, y in zip(bounds, bounds[1:]) for pair in of_group(rows.iloc[x:y])]
            held = rows.iloc[bounds[-1] :]
            yield pd.DataFrame(found, columns=["a", "b"])
        if held is not None:
            yield pd.DataFrame(of_group(held), columns=["a", "b"])

    return run


def _links(blocks: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links within blocks (id, block); a block above ``BLOCK`` members is cut into chunks."""
    # Large blocks are few, one for ``BLOCK`` members at most; their members are dealt over ``SALTS`` keys.
    large = blocks.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).alias("chunks")).where("chunks > 1")
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    large = materialise(large.select("*", salts.alias("salt")))
    placed = (
        blocks.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS).cast("long")))
        .join(large, ["block", "salt"], "left")
        .select("block", "id", F.coalesce("chunks", F.lit(1).cast("long")).alias("chunks"))
        .select("*", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).alias("chunk"))
    )
    # Every pair of chunks is a group, and every chunk with itself.
    placed = placed.select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    ).select(
        "block", "id", "chunk", F.least("chunk", "other").alias("low"),
        F.greatest("chunk", "other").alias("high"),
    )
    texts = probably_in(docs, "doc_id", blocks.select("id"))
    group = ["block", "low", "high"]
    return (
        placed.join(texts, F.col("id") == F.col("doc_id"))
        .select(*group, "chunk", "id", "text")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInPandas(_linked_in_blocks(k, percent), "a long, b long")
    )


def _with_nodes(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` (doc_id, text, ...) with ``node``, and whether it differs from doc_id.

    Of an id with several texts the one of the least hash has the id as its node, the others have numbers from 2 ** 62 on.
    """
    text = F.xxhash64("text")
    several = materialise(
        docs.select("doc_id", text.alias("h")).groupBy("doc_id").agg(F.min("h").alias("least"), F.max("h").alias("b"))
        .where("least <> b AND doc_id IS NOT NULL").select(F.col("doc_id").alias("several"), "least")
    )
    if several.isEmpty():
        return docs.withColumn("node", F.col("doc_id")), False
    number = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2).bitwiseOR(F.lit(1 << 62))
    own = F.when(F.col("several").isNotNull() & (text != F.col("least")), number).otherwise(F.col("doc_id"))
    marked = docs.join(several, F.col("doc_id") == F.col("several"), "left")
    return marked.select(*docs.columns, own.alias("node")), True


def join(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nodes, several = _with_nodes(docs)
    if not several:
        return _join(docs, k, percent)
    found = materialise(_join(nodes.select(F.col("node").alias("doc_id"), "text"), k, percent))
    found = found.withColumnsRenamed({"doc_id": "node", "component_id": "part"})
    # The nodes of one id belong together, and so do the components they are in.
    apart = nodes.where("doc_id <> node").select("doc_id", F.explode(F.array("node", "doc_id")).alias("node"))
    own = materialise(apart.distinct())
    parts = own.join(found.select("node", "part").distinct(), "node").select("doc_id", "part").distinct()
    first = parts.groupBy("doc_id").agg(F.min("part").alias("a"))
    whole = components(parts.join(first, "doc_id").select("a", F.col("part").alias("b"))).select(
        F.col("id").alias("part"), "component"
    )
    rows = (
        found.join(whole, "part", "left")
        .join(own, "node", "left")
        .select(F.coalesce("doc_id", "node").alias("doc_id"), "n_shingles", F.coalesce("component", "part").alias("part"))
    )
    rows = materialise(rows)
    least = rows.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least.withColumnRenamed("part", "of"), F.col("part") == F.col("of"), "left").select(
        "doc_id", "n_shingles", "component_id"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = WORDS_PER_SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """The rows of ``docs`` that stay if one of each component of texts does: that of the smallest id.

    Rows are judged by their own text, also under a repeated id, where an order of hashes decides; rows
    without an id stay.
    """
    columns = docs.columns
    marked = docs.select(
        F.struct(*columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )
    nodes, _ = _with_nodes(marked)
    gone = settled(
        lambda: _join(nodes.select(F.col("node").alias("doc_id"), "text"), k, percent)
        .where("component_id <> doc_id").select(F.col("doc_id").alias("gone")).distinct()
    )
    return nodes.join(gone, F.col("node") == F.col("gone"), "left_anti").select("row.*")


def _join(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``join`` of rows (doc_id, text) in which one id has one text."""
    sets = materialise(docs.mapInPandas(_marks(k), _SET))
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")

    # Equal sets: the smallest id stands for all of them.
    same = ["n_shingles", "mark", "second_mark"]
    full = sets.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = full.groupBy(*same).agg(F.min("doc_id").alias("rep"))
    reps = materialise(full.join(first, same).select("doc_id", "rep").distinct())
    rep = reps.groupBy(F.col("doc_id").alias("id")).agg(F.min("rep").alias("rep"))

    # Tiles. Rows that a task has matched already are dealt by themselves.
    rows = known.mapInPandas(_members(k, percent), _MEMBER)
    deal = F.when(F.col("leader").isNull(), F.col("key")).otherwise(F.xxhash64("leader", "id"))
    tile = Window.partitionBy("deal", F.col("leader").isNull())
    rows = rows.select("*", deal.alias("deal")).select("id", "leader", F.min("id").over(tile).alias("least"))
    stars = rows.select("id", F.coalesce("leader", "least").alias("leader")).where("id <> leader")
    stars = materialise(stars.distinct())
    stars = stars.join(rep, "id").select("leader", F.col("rep").alias("b"))
    stars = stars.join(rep.withColumnRenamed("id", "leader"), "leader")
    blocks = components(stars.select(F.col("rep").alias("a"), "b")).withColumnRenamed("component", "block")

    links = _links(materialise(blocks), known, k, percent)
    found = materialise(components(links))

    named = rep.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias("of"), F.coalesce("component", "rep").alias("component")
    )
    return sets.join(named, F.col("doc_id") == F.col("of"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )
