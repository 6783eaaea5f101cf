"""Exact nearest neighbours by metric cells: most of the index is left out by the triangle inequality.

Vectors of unit length have a distance that falls as their cosine rises. Every index row goes to the nearest of
some pivots; rows of one pivot that are about equally far from it are a cell, of which the least and greatest distance
and the number of rows are known. A question is at least ``|d(q, pivot) - d(x, pivot)|`` away from a row
``x``, so a cell's best possible cosine is known before any of its rows is read.

A question first visits its nearest cells until they hold enough rows; the k-th score found there is its
threshold. Then its scores are taken with the cells whose bound reaches that threshold, and no others. Bounds are in
the whole millionths in which scores are compared, one added, so a tie is never lost. With a filter, a cell also
keeps marks of the values it holds; cells without the wanted mark are skipped.

Index rows are dealt to their cells once and stored. For the first cells, of which a question has few, a cell of many
rows, such as a group of copies, is cut into blocks, and so are the questions that visit it; a pair of blocks is one group
of bounded size. All other cells may be many for each question, so questions are not sent to cells: runs of cells are
blocks, questions are blocks, both are dealt to a grid as in ``knn``, and where two blocks meet the bounds say which of the
cells are scored. A question and an index row are so shuffled a fixed number of times, however many cells are visited.
The best ``k`` of the groups are merged in two levels. Pivots and cells are bounded by ``PIVOTS`` and are the only things that every task sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parley.operators.knn import (
    BLOCK_QUESTIONS,
    BLOCK_ROWS,
    GROUP_ROWS,
    GROUPS,
    NO_SCORE,
    Best,
    _members,
    compared,
    hit_schema,
    matrix,
    ranked,
    units,
)
from parley.session import forget, materialise

#: Pivots at most; fewer for an index of fewer than their square.
PIVOTS = 2048
#: Rings of a pivot: a cell is a pivot and a range of distances of this width.
RING = 0.125
RINGS = int(2 / RING) + 1
#: Rows that a question's first cells hold at least, in multiples of ``k``.
FIRST = 8
_MARKS = 63
_MERGE = 16
#: Distances to pivots or cells that a task holds at a time.
HELD = 1 << 20


@dataclass(frozen=True)
class Cells:
    """What is known of every cell, as arrays; the last one holds the rows without a direction."""

    pivots: np.ndarray
    number: np.ndarray
    pivot: np.ndarray
    rows: np.ndarray
    near: np.ndarray
    far: np.ndarray
    marks: np.ndarray

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """Least possible distance of each vector (row) to the rows of each cell (column)."""
        to_pivots = _distances(vectors, self.pivots)[:, self.pivot]
        low = np.maximum(self.near - to_pivots, to_pivots - self.far)
        return np.where(self.number < 0, np.inf, np.maximum(low, 0))

    def only(self, numbers: np.ndarray) -> Cells:
        """Those of some numbers, which rise."""
        at = np.searchsorted(self.number, numbers)
        used, pivot = np.unique(self.pivot[at], return_inverse=True)
        return Cells(self.pivots[used], numbers, pivot, self.rows[at], self.near[at], self.far[at], self.marks[at])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a part has ``HELD`` values of ``width`` a row at most."""
    step = max(1, HELD // max(width, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _pivots(held: DataFrame, most: int) -> np.ndarray:
    """Vectors of the rows with the smallest hashes, ``sqrt(rows)`` of them and ``most`` at most."""
    rows = held.count()
    wanted = max(1, min(most, int(rows**0.5)))
    drawn = held.where(F.size("embedding") > 0).orderBy(F.xxhash64("chunk_id"), "chunk_id").limit(wanted)
    vectors = matrix(drawn.select("embedding").toArrow().column(0))
    return vectors[~np.isnan(vectors).any(axis=1)]


def _placed(held: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Index rows with ``cell`` and their distance to its pivot; cell -1 has no direction."""
    shared = held.sparkSession.sparkContext.broadcast(pivots)
    schema = T.StructType([*held.schema.fields, T.StructField("cell", T.IntegerType()),
                           T.StructField("distance", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, len(shared.value)):
            width = shared.value.shape[1] if len(shared.value) else None
            vectors = matrix(batch.column("embedding"), width)
            blank = np.isnan(vectors).any(axis=1)
            cell, distance = np.full(len(vectors), -1, np.int32), np.zeros(len(vectors))
            if len(shared.value) and not blank.all():
                d = _distances(vectors[~blank], shared.value)
                own = d.argmin(axis=1)
                distance[~blank] = d[np.arange(len(d)), own]
                cell[~blank] = own * RINGS + (distance[~blank] / RING).astype(np.int32)
            columns = [c.cast(f.type) for c, f in zip(batch.columns, arrow)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(cell), pa.array(distance)], schema=arrow)

    return materialise(held.mapInArrow(run, schema))


def _mark(value: str):
    return F.pmod(F.xxhash64(value), F.lit(_MARKS)).cast("int")


def _cells(placed: DataFrame, pivots: np.ndarray, filtered: bool) -> Cells:
    """One row per cell, ``PIVOTS * RINGS`` at most."""
    marks = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _mark("value"))) if filtered else F.lit(-1)
    found = placed.groupBy("cell").agg(
        F.count("*").alias("rows"), F.min("distance").alias("near"), F.max("distance").alias("far"),
        F.coalesce(marks, F.lit(0)).cast("long").alias("marks"),
    ).orderBy("cell").toArrow()
    column = {c: found.column(c).to_numpy() for c in found.column_names}
    number = column["cell"].astype(np.int64)
    return Cells(pivots, number, np.maximum(number, 0) // RINGS, column["rows"], column["near"] - 1e-9,
                 column["far"] + 1e-9, column["marks"].astype(np.int64))


def _visits(asked: DataFrame, cells: Cells, k: int) -> DataFrame:
    """``asked`` with ``cells``, the first ones of each question."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    schema = T.StructType([*asked.schema.fields, T.StructField("cells", T.ArrayType(T.IntegerType()))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _parts(batches, len(known.number)):
            low = known.nearest(matrix(batch.column("embedding"), known.pivots.shape[1]))
            chosen = pa.array(_first(low, _held(batch, known), known, FIRST * k), arrow[-1].type)
            columns = [batch.column(f.name).cast(f.type) for f in list(arrow)[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, chosen], schema=arrow)

    return materialise(asked.mapInArrow(run, schema))


def _held(asked: pa.RecordBatch | pa.Table, known: Cells) -> np.ndarray:
    """Whether a cell (column) may hold a value that a question (row) wants."""
    if "mark" not in asked.schema.names:
        return np.ones((asked.num_rows, len(known.number)), bool)
    mark = _flat(asked.column("mark")).to_numpy(zero_copy_only=False).astype(float)
    free = np.isnan(mark)
    bits = np.where(free, 0, np.nan_to_num(mark)).astype(np.int64)
    return free[:, None] | ((known.marks[None, :] >> bits[:, None]) & 1 == 1)


def _flat(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _limits(asked: pa.RecordBatch | pa.Table) -> np.ndarray:
    """The least score that matters, in millionths; ``threshold`` is the k-th so far, null if there are fewer."""
    limit = _flat(asked.column("threshold")).to_numpy(zero_copy_only=False).astype(float)
    return np.where(np.isnan(limit), NO_SCORE, np.rint(limit * 1e6))


def _reached(asked: pa.RecordBatch | pa.Table, vectors: np.ndarray, known: Cells) -> np.ndarray:
    """Whether a question (row) must see a cell (column) that is not among its first ones."""
    low = known.nearest(vectors)
    reach = np.where(np.isinf(low), NO_SCORE, units(1 - np.minimum(low, 2) ** 2 / 2) + 1)
    hit = _held(asked, known) & (reach >= _limits(asked)[:, None])
    seen = _flat(asked.column("cells"))
    row = np.repeat(np.arange(len(hit)), pc.list_value_length(seen).fill_null(0).to_numpy(zero_copy_only=False))
    number = seen.flatten().to_numpy()
    place = np.minimum(np.searchsorted(known.number, number), len(known.number) - 1)
    own = known.number[place] == number
    hit[row[own], place[own]] = False
    return hit


def _first(low: np.ndarray, held: np.ndarray, known: Cells, rows: int) -> list[list[int]]:
    """The nearest cells of each question that together hold ``rows`` rows."""
    out = []
    for distance, may in zip(low, held):
        order = np.argsort(np.where(may, distance, np.inf), kind="stable")
        order = order[may[order] & ~np.isinf(distance[order])]
        enough = np.searchsorted(np.cumsum(known.rows[order]), rows) + 1
        out.append(known.number[order[:enough]].tolist())
    return out


def _score(visits: DataFrame, placed: DataFrame, k: int, schema: T.StructType, filtered: bool,
           block_questions: int, block_rows: int) -> DataFrame:
    """Best ``k`` of every (questions, cell) group, blocks against blocks."""
    pairs = visits.select("question_id", "embedding", *(["wanted"] if filtered else []),
                          F.explode("cells").alias("cell"))
    asked = pairs.groupBy("cell").agg(F.ceil(F.count("*") / block_questions).cast("int").alias("_qs"))
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("_rs"))
    counts = F.broadcast(asked.join(sizes, "cell"))  # a row per cell, which are bounded

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        return (
            df.join(counts, "cell")
            .withColumn(own[1], F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
            .withColumn(other[1], F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("_qs", "_rs")
        )

    arrow = to_arrow_schema(schema)
    asked_columns = ["question_id", "embedding", *(["wanted"] if filtered else [])]

    def run(some: pa.Table, rows: pa.Table) -> pa.Table:
        best = Best(some.select(asked_columns), k)
        best.add_batch(rows)
        return best.table(arrow)

    group = ["cell", "q", "r"]
    left = dealt(pairs, "question_id", "_qs", "_rs").groupBy(*group)
    right = dealt(placed.drop("distance"), "chunk_id", "_rs", "_qs").groupBy(*group)
    return left.cogroup(right).applyInArrow(run, schema)


def _cell_blocks(spark: SparkSession, cells: Cells, block_rows: int) -> DataFrame:
    """(cell, block, parts): runs of cells of about ``block_rows`` rows; a larger cell is dealt to several blocks."""
    start = np.cumsum(cells.rows) - cells.rows
    rows = zip(cells.number.tolist(), (start // block_rows).tolist(), (-(-cells.rows // block_rows)).tolist())
    return spark.createDataFrame(list(rows), "cell int, block int, parts int")


def _score_reached(asked: DataFrame, placed: DataFrame, cells: Cells, k: int, schema: T.StructType,
                   block_questions: int, block_rows: int) -> DataFrame:
    """Best ``k`` of every question in the cells that it reaches, per block of questions and group of index blocks."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    blocks = F.broadcast(_cell_blocks(asked.sparkSession, cells, block_rows))  # a row per cell, which are bounded
    total = int(cells.rows.sum())
    questions, rows = max(1, -(-asked.count() // block_questions)), max(1, -(-total // block_rows))
    groups = min(questions, GROUPS), max(min(rows, GROUPS), -(-total // GROUP_ROWS))

    def packed(df: DataFrame, block: Column, name: str) -> DataFrame:
        """One row per block, which holds its members."""
        members = F.collect_list(F.struct(*[c for c in df.columns if c not in ("block", "parts")])).alias(name)
        return df.groupBy(block.cast("int").alias("_block")).agg(members)

    def dealt(df: DataFrame, own: int, name: str) -> DataFrame:
        """Blocks in their own group, and a copy per group of the other side."""
        return df.select("_block", name, F.pmod("_block", F.lit(groups[own])).alias(f"_g{own}"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups[1 - own] - 1))).alias(f"_g{1 - own}"))

    some = packed(asked, F.pmod(F.xxhash64("question_id"), F.lit(questions)), "_some")
    part = F.col("block") + F.pmod(F.xxhash64("chunk_id"), F.col("parts"))
    held = packed(placed.drop("distance").join(blocks, "cell"), part, "_held")
    left, right = dealt(some, 0, "_some"), dealt(held, 1, "_held").drop("_block")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = at = None
        for batch in batches:
            for row in range(batch.num_rows):
                if batch.column("_block")[row].as_py() != at:
                    if best is not None:
                        yield from best.table(arrow).to_batches()
                    at, asked = batch.column("_block")[row].as_py(), _members(batch.column("_some")[row])
                    best = Best(asked, k)
                _score_block(best, asked, _members(batch.column("_held")[row]), shared.value)
        if best is not None:
            yield from best.table(arrow).to_batches()

    # Merged, so that the blocks of the index meet one block of questions after the other.
    pairs = left.hint("merge").join(right, ["_g0", "_g1"])
    return pairs.select("_block", "_some", "_held").mapInArrow(run, schema)


def _score_block(best: Best, asked: pa.Table, held: pa.Table, cells: Cells) -> None:
    """Score the rows of a block with the questions that reach their cells."""
    cell = held.column("cell").combine_chunks().to_numpy()
    known = cells.only(np.unique(cell))
    limits, width = _limits(asked), known.pivots.shape[1] if len(known.pivots) else None
    step = max(1, HELD // len(known.number))
    hit = np.concatenate([
        _reached(asked.slice(n, step), best.vectors[n : n + step], known) for n in range(0, asked.num_rows, step)
    ])
    vectors = matrix(held.column("embedding"), width)
    keys = np.array(held.column("chunk_id").to_pylist())
    wanted = best.wanted or {None: np.arange(asked.num_rows)}
    value = None
    if best.wanted is not None:
        value = held.column("value").combine_chunks().dictionary_encode()
        code, value = value.indices.fill_null(-1).to_numpy(), {v: c for c, v in enumerate(value.dictionary.to_pylist())}
    order = np.argsort(cell, kind="stable")
    for number, mine in zip(known.number, np.split(order, np.searchsorted(cell[order], known.number[1:]))):
        column = hit[:, np.searchsorted(known.number, number)]
        for want, questions in wanted.items():
            rows = questions[column[questions]]
            if want is not None:
                own = mine[code[mine] == value.get(want, -2)]
            else:
                own = mine
            if not len(rows) or not len(own):
                continue
            step = max(1, HELD // len(own))
            for n in range(0, len(rows), step):
                some = rows[n : n + step]
                if number >= 0:  # most questions have better hits already
                    top = units((best.vectors[some] @ vectors[own].T).max(axis=1))
                    some = some[top >= np.maximum(limits[some], best.scores[some, -1])]
                if len(some):
                    best.add(some, keys[own], vectors[own], np.zeros(len(own), np.int64))


def _merged(hits: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per question in two levels, so that no task gets all bests of one question at once."""
    part = F.pmod(F.xxhash64("chunk_id"), F.lit(_MERGE))
    some = Window.partitionBy("question_id", part).orderBy(F.desc_nulls_last("score"), "chunk_id")
    kept = hits.withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= k).drop("_n")
    return ranked(kept, k)


def _undirected(asked: DataFrame, held: DataFrame, k: int, schema: T.StructType, filtered: bool) -> DataFrame:
    """Hits of questions without a direction: the smallest keys, with no score."""
    rows = held.select("chunk_id", *(["value"] if filtered else []))
    least = rows.orderBy("chunk_id").limit(k).select("chunk_id")  # k rows
    free = asked.where("wanted IS NULL") if filtered else asked
    hits = free.select("question_id").join(F.broadcast(least))
    if filtered:
        own = Window.partitionBy("value").orderBy("chunk_id")
        each = rows.where("value IS NOT NULL").withColumn("_n", F.row_number().over(own)).where(F.col("_n") <= k)
        equal = asked.join(each, F.col("wanted") == F.col("value")).select("question_id", "chunk_id")
        hits = hits.unionByName(equal)
    return hits.select("question_id", "chunk_id", F.lit(None).cast("double").alias("score"))


@dataclass(frozen=True)
class PrunedSearch:
    """Hits, and for every question with a direction how many index rows were scored."""

    hits: DataFrame
    scored: DataFrame


def search_pruned(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    filter_by: tuple[str, str] | None = None,
    pivots: int = PIVOTS,
    block_questions: int = BLOCK_QUESTIONS,
    block_rows: int = BLOCK_ROWS,
) -> PrunedSearch:
    """The same hits as ``knn.search``: question_id, chunk_id, score, rank."""
    questions, index = questions.where("question_id IS NOT NULL"), index.where("chunk_id IS NOT NULL")
    filtered = filter_by is not None
    asked, held = compared(questions, index, filter_by)
    schema = hit_schema(questions, index)
    asked = materialise(asked.select("*", _mark("wanted").alias("mark")) if filtered else asked)
    if filtered:
        asked = asked.withColumn("mark", F.when(F.col("wanted").isNotNull(), F.col("mark")))
    directed = _has_direction(F.col("embedding"))
    places = _pivots(held, pivots)
    placed = _placed(held, places)
    cells = _cells(placed, places, filtered)
    blank = _undirected(asked.where(~directed), held, k, schema, filtered)
    options = (filtered, block_questions, block_rows)
    if not len(places):  # no index row has a direction
        blank = _undirected(asked, held, k, schema, filtered)
        none = asked.where("false").select("question_id", F.lit(0).cast("long").alias("rows"))
        return PrunedSearch(ranked(blank, k), none)
    first = _visits(asked.where(directed), cells, k)
    found = materialise(_merged(_score(first, placed, k, schema, *options), k).drop("rank"))
    limits = found.groupBy("question_id").agg(
        F.when((F.count("*") == k) & (F.count("score") == k), F.min("score")).alias("threshold")
    )
    limited = materialise(
        first.join(limits.withColumnRenamed("question_id", "_id"), F.col("question_id") == F.col("_id"), "left")
        .drop("_id")
    )
    forget(first)
    rest = _score_reached(limited, placed, cells, k, schema, block_questions, block_rows)
    hits = _merged(found.unionByName(rest), k)
    scored = _scored(limited, cells).groupBy("question_id").agg(F.sum("rows").alias("rows"))
    return PrunedSearch(hits.unionByName(ranked(blank, k)), scored)


def _scored(asked: DataFrame, cells: Cells) -> DataFrame:
    """The number of index rows in the cells of each question."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    schema = T.StructType([asked.schema["question_id"], T.StructField("rows", T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in _parts(batches, len(known.number)):
            vectors = matrix(batch.column("embedding"), known.pivots.shape[1])
            seen = batch.column("cells")
            count = pc.list_value_length(seen).fill_null(0).to_numpy(zero_copy_only=False)
            own = known.rows[np.searchsorted(known.number, seen.flatten().to_numpy())]
            rows = _reached(batch, vectors, known) @ known.rows
            rows += np.bincount(np.repeat(np.arange(len(rows)), count), own, len(rows)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("question_id"), pa.array(rows, pa.int64())], schema=arrow)

    return asked.mapInArrow(run, schema)


def _has_direction(vector):
    """Whether a vector can be scaled to unit length: components, all of them known, not all zero."""
    components = F.transform(vector, lambda x: x.cast("double"))
    squares = F.aggregate(components, F.lit(0.0), lambda total, x: total + x * x)
    return F.coalesce((F.size(vector) > 0) & (squares > 0) & ~F.isnan(squares), F.lit(False))
