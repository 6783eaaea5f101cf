"""A Merkle manifest of a dataset, and a proof for every row by pointer jumping.

A leaf is the digest of a row's fields. The leaves of a source, in order of their ids, are cut into runs
of ``FAN``; a run's digest is the digest of its members, and so on until one node, the subroot, is left.
The subroots, in order of their sources, make a tree of the same kind above; its last node is the root.

A node's first segment holds its siblings on the way to its parent. A round joins the table of
segments to itself: a node that reaches ancestor ``a`` takes over the segment of ``a``, so its distance
doubles, and after as many rounds as the height has binary digits every node reaches the root. The leaves
of one run share all but their own run, so they travel as one row, the run, and part at the end; the
segments that are shuffled are 16 times fewer. Only a row's digests leave the scan, never its text.

A round at distance ``d`` brings up to ``FAN ** d`` rows to one ancestor. Those rows are dealt to copies of
it, so that a copy meets about ``MEETING``; ancestors become rarer as fast as copies become more.

Defined results: a null field is written ``-``, so it differs from an empty one; a null id comes first in
its source, and a null source first of all; rows that agree in id follow the order of their leaves, and
equal rows have equal leaves but proofs of their own; a source of one row has that leaf as its
subroot; an only source has the root as its subroot; an empty table gives no rows. Columns that are not
named as fields are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.ranks import placed
from parley.session import materialise

#: Members of a run.
FAN = 16
#: Rows that meet one copy of an ancestor in a round, about.
MEETING = 4096
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_TOP = -1  # the tree above the sources
_NODE = ("tree", "level", "pos")
_PATH = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its bytes in UTF-8, ``:`` and the value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(
        F.concat(
            *[
                F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
                for t in texts
            ]
        ),
        256,
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def path_digest(path: Column) -> Column:
    """Hex SHA-256 of all siblings of a path, from the leaf upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _levels(nodes: int, fan: int) -> int:
    """Steps from ``nodes`` nodes to one."""
    steps = 0
    while nodes > 1:
        nodes, steps = -(-nodes // fan), steps + 1
    return steps


def _key(fan: int) -> list[Column]:
    """tree, level, pos and size of the node above a run; the subroot of a source is a leaf of the top tree."""
    size = F.expr(f"(size + {fan - 1}) DIV {fan}")
    ends = (F.col("tree") != _TOP) & (size == 1)
    return [
        F.when(ends, _TOP).otherwise(F.col("tree")).cast("long").alias("tree"),
        F.when(ends, 0).otherwise(F.col("level") + 1).cast("int").alias("level"),
        F.when(ends, F.col("tree")).otherwise(F.col("run")).cast("long").alias("pos"),
        F.when(ends, F.col("sources")).otherwise(size).cast("long").alias("size"),
    ]


def _joined(members: Column) -> Column:
    return F.array_join(F.transform(members, lambda m: m["digest"]), "")


def _beside(index: Column) -> Column:
    """The digests left and right of a member of ``members``."""
    after = F.slice("members", index + 2, F.greatest(F.size("members") - index - 1, F.lit(0)))
    return F.struct(
        _joined(F.slice("members", F.lit(1), index)).alias("left"), _joined(after).alias("right")
    )


def _runs(nodes: DataFrame, fan: int, *carry: str) -> DataFrame:
    """Nodes (tree, level, pos, size, digest) gathered into runs, ``fan`` at most."""
    members = F.array_sort(F.collect_list(F.struct("pos", "digest", *carry)))
    return (
        nodes.groupBy("tree", "level", F.expr(f"pos DIV {fan}").alias("run"), "size", "sources")
        .agg(members.alias("members"))
        .select("*", F.sha2(_joined(F.col("members")), 256).alias("digest"))
    )


def _above(runs: DataFrame, fan: int) -> DataFrame:
    return runs.select(*_key(fan), "sources", "digest")


def _links(runs: DataFrame, fan: int) -> DataFrame:
    """Every member of upper runs with the way to its parent."""
    parent = [c.alias(f"to_{n}") for c, n in zip(_key(fan), _NODE)]
    is_subroot = (F.col("tree") == _TOP) & (F.col("level") == 0)
    return runs.select(
        "tree", "level", *parent, F.posexplode("members").alias("at", "member"), "members"
    ).select(
        "tree", "level", F.col("member.pos").alias("pos"), *[f"to_{n}" for n in _NODE],
        F.array(_beside(F.col("at"))).alias("path"),
        F.when(is_subroot, F.col("member.digest")).alias("subroot"),
    )


def _doubled(links: DataFrame, reach: int, fan: int, count: int) -> DataFrame:
    """Links of distance ``reach`` made twice as long; those that end at the root stay."""
    copies = max(1, min(fan**reach, count) // MEETING)
    ancestors = links.where((F.col("tree") == _TOP) | (F.col("level") > reach)).select(
        *[F.col(n).alias(f"a_{n}") for n in _NODE], *[F.col(f"to_{n}").alias(f"b_{n}") for n in _NODE],
        F.col("path").alias("more"), F.col("subroot").alias("met"),
        F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy"),
    )
    dealt = links.select("*", F.pmod(F.xxhash64(*_NODE), F.lit(copies)).cast("int").alias("to_copy"))
    same = F.col("to_copy") == F.col("copy")
    for n in _NODE:
        same = same & (F.col(f"to_{n}") == F.col(f"a_{n}"))
    return dealt.join(ancestors, same, "left").select(
        *_NODE,
        *[F.coalesce(f"b_{n}", f"to_{n}").alias(f"to_{n}") for n in _NODE],
        F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("path", "more")).alias("path"),
        F.coalesce("subroot", "met").alias("subroot"),
    )


def prove(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_col: str = "doc_id",
    source_col: str = "source",
    carry: Mapping[str, Column] | None = None,
    fan: int = FAN,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, subroot, root, path and the columns of ``carry``.

    ``path`` has one (left, right) pair of joined sibling digests per level, from the leaf's run to the
    root; ``fold(leaf, path)`` is the root.
    """
    carry = dict(carry or {})
    leaves = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        digest(*[F.col(f) for f in fields]).alias("leaf"), *[c.alias(f"of_{n}") for n, c in carry.items()],
    )
    kept = ["doc_id", "source", *[f"of_{n}" for n in carry]]
    ordered = placed(leaves, "source", ["doc_id", "leaf"]).select(
        F.col("group_no").alias("tree"), F.lit(0).alias("level"), F.col("place").alias("pos"),
        F.col("group_rows").alias("size"), F.col("leaf").alias("digest"), *kept,
    )
    own_runs = materialise(_runs(ordered.withColumn("sources", F.lit(0)), fan, *kept))
    sources, most, count = own_runs.agg(F.max("tree"), F.max("size"), F.count("*")).first()
    if not count:
        return _proofs(own_runs.select("*", F.array().cast(_PATH).alias("path"), F.lit("").alias("subroot")), "", carry)
    own_runs = own_runs.withColumn("sources", F.lit(sources + 1))
    lone = F.col("size") == 1
    first = F.when(lone, F.col("members")[0]["digest"]).otherwise(F.col("digest"))
    height, top_height = _levels(most, fan), _levels(sources + 1, fan)
    nodes = own_runs.select(*_key(fan), "sources", first.alias("digest"))
    tops, tables = [nodes.where(F.col("tree") == _TOP)], []
    for _ in range(1, height):
        tables.append(materialise(_runs(nodes.where(F.col("tree") != _TOP), fan)))
        nodes = _above(tables[-1], fan)
        tops.append(nodes.where(F.col("tree") == _TOP))
    top = reduce(DataFrame.unionByName, tops)
    for _ in range(top_height):
        tables.append(materialise(_runs(top, fan)))
        top = _above(tables[-1], fan)
    root = top.first()["digest"]
    at_run = own_runs.select("*", F.struct(*_key(fan)[:3]).alias("node"))
    if tables:
        links = materialise(reduce(DataFrame.unionByName, [_links(t, fan) for t in tables]))
        reach = 1
        while reach < max(0, height - 1) + top_height:
            links = materialise(_doubled(links, reach, fan, count))
            reach *= 2
        ends = links.select(F.struct(*_NODE).alias("from"), "path", "subroot")
        at_run = at_run.join(ends, F.col("node") == F.col("from"), "left")
    else:
        at_run = at_run.select("*", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    return _proofs(at_run, root, carry)


def _proofs(runs: DataFrame, root: str, carry: Mapping[str, Column]) -> DataFrame:
    """Runs with the path above them, parted into their leaves."""
    none = F.array().cast(_PATH)
    above = F.coalesce("path", none).alias("above")
    own = F.when(F.col("size") == 1, none).otherwise(F.array(_beside(F.col("at"))))
    return runs.select(
        "size", "members", above, "subroot", F.posexplode("members").alias("at", "m")
    ).select(
        F.col("m.doc_id").alias("doc_id"), F.col("m.source").alias("source"), F.col("m.digest").alias("leaf"),
        F.coalesce("subroot", F.lit(root)).alias("subroot"), F.lit(root).alias("root"),
        F.concat(own, "above").alias("path"), *[F.col(f"m.of_{n}").alias(n) for n in carry],
    )
