"""Exact top-k search by inner product with a uniform threshold in three phases.

Vectors are quantised and cut into ``LISTS`` groups of components, so that a score is a sum of one
entry from each of as many lists. A task holds one list for a block of queries and a slab of blocks of
candidates.

1. Every list gives the best entries of each query; their full scores set a floor: the k-th best of
   them is a score that k candidates reach.
2. A candidate that reaches the floor has an entry of at least floor / lists in some list, and in that
   list at least the floor less the best entries of the other lists. That cutoff goes out with the
   queries and the lists give every entry that reaches it.
3. The full scores of those entries are computed and the best k kept.

Equal vectors are scored once; of a group of any size only its k + 1 smallest ids can be among the
best. Queries meet candidates in blocks, as the query set is stated.

Defined results: null ids, null vectors and vectors with null or non-finite components take no part;
shorter vectors count as filled up with zeros; components are cut at ±2**27 after quantising, so scores
fit a long; ties go to the smaller id; every row under a repeated id is a candidate and, if the id is asked, a query
of its own, which only leaves itself out; an empty table, or one without queries, gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.ranks import placed
from parley.session import materialise

LISTS = 2
#: Numbers in a block of one list, rows of a block of queries, blocks that meet a block of queries in a task.
BLOCK, QUERY_ROWS, SLAB = 1 << 18, 1024, 16
LIMIT = 2.0**27
_EXACT = 2.0**53


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id and v, whole numbers; rows that take no part are gone."""
    x = F.col(vector_col)
    bad = F.exists(
        x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))
    )
    cell: Callable[[Column], Column] = lambda c: F.greatest(
        F.lit(-LIMIT), F.least(F.lit(LIMIT), c.cast("double") * scale)
    )
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(cell(c)).cast("int")).alias("v"),
    )


_BLOCK = "block long, list long, ids binary, cells binary"


def _cut_block(lists: int, width: int):
    """The rows of a block as one matrix of each list."""
    edges = [width * i // lists for i in range(lists + 1)]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("uid")
        cells = np.zeros((len(group), width), "<i4")
        for row, v in enumerate(group["v"]):
            cells[row, : len(v)] = v
        ids = group["uid"].to_numpy("<i8").tobytes()
        rows = [
            (group["block"].iat[0], i, ids, np.ascontiguousarray(cells[:, a:b]).tobytes())
            for i, (a, b) in enumerate(zip(edges, edges[1:]))
        ]
        return pd.DataFrame(rows, columns=["block", "list", "ids", "cells"])

    return run


def _matrix(cells: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(cells, "<i4").reshape(rows, -1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact: in doubles as long as every sum stays a whole number there."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = float(np.abs(a.astype(np.int64)).max()) * float(np.abs(b.astype(np.int64)).max())
    if top * a.shape[1] < _EXACT:
        return a.astype(float) @ b.astype(float).T
    return a.astype(np.int64) @ b.astype(np.int64).T


_ENTRY = "quid long, list long, cuid long, part long"


def _gather(k: int):
    """Phase 1: the best k entries of one list for each query of the block."""

    def run(key: tuple, queries: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
        out = []
        for q in queries.itertuples():
            q_ids = np.frombuffer(q.ids, "<i8")
            left = _matrix(q.cells, len(q_ids))
            best = np.empty((len(q_ids), 0), np.int64)
            found = np.empty((len(q_ids), 0), np.int64)
            for c in slab.itertuples():
                c_ids = np.frombuffer(c.ids, "<i8")
                parts = _product(left, _matrix(c.cells, len(c_ids)))
                if len(c_ids) > k:
                    at = np.argpartition(parts, len(c_ids) - k, axis=1)[:, len(c_ids) - k :]
                else:
                    at = np.broadcast_to(np.arange(len(c_ids)), parts.shape)
                best = np.hstack([best, np.take_along_axis(parts, at, 1).astype(np.int64)])
                found = np.hstack([found, c_ids[at]])
                if best.shape[1] > k:
                    at = np.argpartition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k :]
                    best, found = np.take_along_axis(best, at, 1), np.take_along_axis(found, at, 1)
            out.append(
                pd.DataFrame(
                    {
                        "quid": np.repeat(q_ids, best.shape[1]),
                        "list": key[0],
                        "cuid": found.ravel(),
                        "part": best.ravel(),
                    }
                )
            )
        return pd.concat(out) if out else _empty(_ENTRY)

    return run


def _empty(schema: str) -> pd.DataFrame:
    return pd.DataFrame(columns=[f.split()[0] for f in schema.split(", ")])


_FOUND = "qblock long, slab long, cblock long, at_q binary, at_c binary"


def _collect(key: tuple, queries: pd.DataFrame, slab: pd.DataFrame) -> pd.DataFrame:
    """Phase 2: places of all entries of one list that reach their query's cutoff."""
    rows = []
    for q in queries.itertuples():
        cutoff = np.frombuffer(q.cutoffs, "<i8")[:, None]
        left = _matrix(q.cells, len(cutoff))
        for c in slab.itertuples():
            parts = _product(left, _matrix(c.cells, len(c.ids) // 8))
            at_q, at_c = np.nonzero(parts >= cutoff)
            if len(at_q):
                rows.append(
                    (key[1], key[2], c.block, at_q.astype("<i4").tobytes(), at_c.astype("<i4").tobytes())
                )
    return pd.DataFrame(rows, columns=[f.split()[0] for f in _FOUND.split(", ")])


_SCORE = "quid long, cuid long, score long"


def _resolve(k: int):
    """Phase 3: full scores of the collected places, the best k for each query of the block."""

    def whole(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        rows = rows.sort_values("list")
        ids = np.frombuffer(rows["ids"].iat[0], "<i8")
        return ids, np.hstack([_matrix(c, len(ids)) for c in rows["cells"]]).astype(np.int64)

    def run(key: tuple, found: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(found):
            return _empty(_SCORE)
        asked = blocks["asked"].to_numpy(bool)
        q_ids, left = whole(blocks[asked])
        best = []
        for block, places in found.groupby("cblock"):
            c_ids, right = whole(blocks[~asked & (blocks["block"] == block)])
            at = np.unique(
                np.concatenate(
                    [
                        np.frombuffer(a, "<i4").astype(np.int64) * len(c_ids) + np.frombuffer(b, "<i4")
                        for a, b in zip(places["at_q"], places["at_c"])
                    ]
                )
            )
            for part in np.array_split(at, -(-len(at) // 65536)):
                q, c = np.divmod(part, len(c_ids))
                best.append((q, c_ids[c], (left[q] * right[c]).sum(axis=1)))
            q, c, score = (np.concatenate(x) for x in zip(*best))
            order = np.lexsort((c, -score, q))
            q, c, score = q[order], c[order], score[order]
            rank = np.arange(len(q)) - np.searchsorted(q, q)
            best = [(q[rank < k], c[rank < k], score[rank < k])]
        q, c, score = best[0]
        return pd.DataFrame({"quid": q_ids[q], "cuid": c, "score": score})

    return run


def _blocks(vectors: DataFrame, number: int, lists: int, width: int) -> DataFrame:
    block = F.pmod(F.xxhash64("uid"), F.lit(number)).cast("long")
    return materialise(
        vectors.select("uid", "v", block.alias("block"))
        .groupBy("block")
        .applyInPandas(_cut_block(lists, width), _BLOCK)
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 256.0,
    lists: int = LISTS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the best ``k`` others of every row for which ``is_query`` holds.

    ``is_query`` is a condition on vec_id.
    """
    need = k + 1  # one of them may be the query itself
    rows = quantised(vectors, id_col, vector_col, scale)
    rows = materialise(rows.select("*", F.monotonically_increasing_id().alias("row")))
    groups = _numbered(materialise(rows.groupBy("v").agg(F.min("vec_id").alias("uid"))))
    order = Window.partitionBy("v").orderBy("vec_id", "row")
    members = materialise(
        rows.select("v", "vec_id", "row", F.row_number().over(order).alias("place"))
        .where(F.col("place") <= need)
        .join(groups, "v")
        .select("uid", "vec_id", "row")
    )
    asked = materialise(
        rows.where(is_query).join(groups, "v").select(
            "uid", F.col("vec_id").alias("query_id"), F.col("row").alias("query_row"))
    )
    wanted = groups.join(asked.select("uid").distinct(), "uid", "left_semi")
    width = groups.agg(F.max(F.size("v"))).first()[0] or 0
    c_number = max(1, -(-groups.count() // max(64, BLOCK // max(1, width))))
    q_number = max(1, -(-wanted.count() // QUERY_ROWS))
    c_blocks = _blocks(groups, c_number, lists, width)
    q_blocks = _blocks(wanted, q_number, lists, width)
    slab = F.floor(F.col("block") / SLAB).cast("long")
    every_q = F.explode(F.sequence(F.lit(0), F.lit(q_number - 1)).cast("array<long>"))
    every_slab = F.explode(
        F.sequence(F.lit(0), F.lit((c_number - 1) // SLAB)).cast("array<long>")
    )
    right = c_blocks.select("list", every_q.alias("qblock"), slab.alias("slab"), "block", "ids", "cells")
    left = q_blocks.select(
        "list", F.col("block").alias("qblock"), every_slab.alias("slab"), "block", "ids", "cells"
    )
    meet = ["list", "qblock", "slab"]
    grouped = right.groupBy(*meet)

    listed = left.groupBy(*meet).cogroup(grouped).applyInPandas(_gather(need), _ENTRY)
    best = Window.partitionBy("quid", "list").orderBy(F.desc("part"), "cuid")
    listed = materialise(
        listed.select("*", F.row_number().over(best).alias("place")).where(F.col("place") <= need)
    )
    cutoffs = _cutoffs(listed, wanted, groups, lists, need)

    q_cut = q_blocks.join(_cutoff_blocks(q_blocks, cutoffs, q_number), ["block", "list"])
    left_cut = q_cut.select(
        "list", F.col("block").alias("qblock"), every_slab.alias("slab"), "ids", "cells", "cutoffs"
    )
    found = materialise(left_cut.groupBy(*meet).cogroup(grouped).applyInPandas(_collect, _FOUND))

    both = left.withColumn("asked", F.lit(True)).unionByName(right.withColumn("asked", F.lit(False)))
    scores = (
        found.groupBy("qblock", "slab")
        .cogroup(both.groupBy("qblock", "slab"))
        .applyInPandas(_resolve(need), _SCORE)
    )
    ids = scores.join(members.withColumnRenamed("uid", "cuid"), "cuid")
    first = Window.partitionBy("quid").orderBy(F.desc("score"), "vec_id", "row")
    ids = ids.select("*", F.row_number().over(first).alias("place")).where(F.col("place") <= need)
    rank = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        asked.join(ids, F.col("uid") == F.col("quid"))
        .where(F.col("query_row") != F.col("row"))
        .select("query_id", F.row_number().over(rank).alias("rank"), "vec_id", "score")
        .where(F.col("rank") <= k)
    )


def _numbered(groups: DataFrame) -> DataFrame:
    """Groups (v, uid) under numbers that are unique and rise with their smallest ids.

    The smallest ids are such numbers themselves unless an id has several vectors.
    """
    if groups.groupBy("uid").count().where("count > 1").isEmpty():
        return groups
    ordered = placed(groups.select("v", "uid", F.lit(0).alias("all")), "all", ["uid", "v"])
    return materialise(ordered.select("v", F.col("place").alias("uid")))


def _cutoffs(listed: DataFrame, wanted: DataFrame, groups: DataFrame, lists: int, k: int) -> DataFrame:
    """quid, list, cutoff: what an entry of the list must reach."""
    pairs = listed.select("quid", "cuid").distinct()
    q, c = (t.select(F.col("uid").alias(n), F.col("v").alias(f"v_{n}")) for t, n in ((wanted, "quid"), (groups, "cuid")))
    product = F.zip_with(
        "v_quid", "v_cuid", lambda a, b: F.coalesce(a.cast("long") * b.cast("long"), F.lit(0))
    )
    scored = pairs.join(q, "quid").join(c, "cuid").select(
        "quid", F.aggregate(product, F.lit(0).cast("long"), lambda a, b: a + b).alias("score")
    )
    floors = scored.groupBy("quid").agg(
        F.get(F.sort_array(F.collect_list("score"), asc=False), F.lit(k - 1)).alias("floor")
    )  # lists * k scores at most
    bests = listed.groupBy("quid", "list").agg(F.max("part").alias("best"))
    total = bests.groupBy("quid").agg(F.sum("best").alias("bests"))
    others = F.col("floor") - (F.col("bests") - F.col("best"))
    least = F.greatest(F.ceil(F.col("floor") / lists), others)
    return materialise(
        bests.join(total, "quid").join(floors, "quid").select(
            "quid", "list", F.coalesce(least, F.lit(-(1 << 63) + 1)).cast("long").alias("cutoff")
        )
    )


def _cutoff_blocks(q_blocks: DataFrame, cutoffs: DataFrame, number: int) -> DataFrame:
    """The cutoffs of a block of queries in the order of its ids."""

    def line_up(key: tuple, block: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        by_id = own.set_index("quid")["cutoff"]
        rows = [
            (b.block, b.list, by_id.reindex(np.frombuffer(b.ids, "<i8")).to_numpy("<i8").tobytes())
            for b in block.itertuples()
        ]
        return pd.DataFrame(rows, columns=["block", "list", "cutoffs"])

    block = F.pmod(F.xxhash64("quid"), F.lit(number)).cast("long")
    return (
        q_blocks.select("block", "list", "ids")
        .groupBy("block", "list")
        .cogroup(cutoffs.select("*", block.alias("block")).groupBy("block", "list"))
        .applyInPandas(line_up, "block long, list long, cutoffs binary")
    )
