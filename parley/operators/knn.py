"""Exact nearest-neighbour joins of questions to an index.

Scores are cosines rounded to six digits; ties go to the smaller key, so that every plan gives
the same ranks. Tasks never emit more than their own best ``k`` per question.

Two plans give equal results, and ``pruned`` holds a third:

* few questions (their number and the size of their vectors are checked): each task of the index
  scan scores the questions in memory; the index is neither shuffled nor held. Columns that are asked for
  (vector, text, name) travel with a task's best rows, so nothing joins back to the index;
* many questions: index and questions are cut into blocks of bounded size, and each pair of
  blocks is scored. The number of blocks of a filter value follows its counted size, so a
  value that holds a third of the index has that many more blocks. A block is one row, and a task that joins groups
  of blocks has one block of each side in Python at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from parley.session import materialise

DIGITS = 6
UNIT = 10**DIGITS
NO_SCORE = -(2 * UNIT)  # below every cosine: ranks last
CELLS = 4_000_000  # scores held at a time

MAX_LOCAL_QUESTIONS = 4096
MAX_LOCAL_VALUES = 1 << 22  # components of all shared questions, 32 MB
BLOCK_QUESTIONS = 8192
BLOCK_ROWS = 8192
#: Groups of blocks on each side of a part, and rows of the index that a group holds at most.
GROUPS = 8
GROUP_ROWS = 1 << 18


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as rows scaled to unit length.

    Zero, null and empty vectors, and those with a null component, become NaN rows. ``width``
    is the length the others must have, or else that of the first one.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
    held = lengths > 0
    found = {*lengths[held].tolist(), *([width] if width else [])}
    if len(found) > 1:
        raise ValueError(f"vectors of unequal length: {sorted(found)}")
    rows = np.full((len(vectors), found.pop() if found else 1), np.nan)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows[held] = flat.reshape(int(held.sum()), rows.shape[1])
    norms = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norms > 0, rows / norms, np.nan)


def units(cosines: np.ndarray) -> np.ndarray:
    """Cosines as whole millionths."""
    return np.where(np.isnan(cosines), NO_SCORE, np.rint(cosines * UNIT)).astype(np.int64)


def best_of(questions: np.ndarray, index: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and scores of the best ``k`` rows per question; the first rows win ties."""
    n = len(index)
    scores = units(questions @ index.T)
    code = scores * n + (n - 1 - np.arange(n))  # unique, ordered by score, then by position
    if n > k:
        top = np.argpartition(-code, k - 1, axis=1)[:, :k]
    else:
        top = np.broadcast_to(np.arange(n), (len(questions), n))
    return top, np.take_along_axis(scores, top, axis=1)


def _slices(n_questions: int, n_rows: int) -> Iterator[slice]:
    step = max(1, CELLS // max(n_rows, 1))
    for start in range(0, n_questions, step):
        yield slice(start, start + step)


class Best:
    """Running best ``k`` of a task: arrays per question, merged batch by batch.

    ``refs`` points from a kept hit to its row in ``store``, the carried columns of rows that are or
    were among the best; the store is thinned before it outgrows twice the hits.
    """

    def __init__(self, questions: pa.Table, k: int, carry: Sequence[str] = ()):
        self.ids = questions.column("question_id").combine_chunks()
        self.vectors = matrix(questions.column("embedding"))
        self.width = None if np.isnan(self.vectors).all() else self.vectors.shape[1]
        self.wanted: dict[str | None, np.ndarray] | None = None
        if "wanted" in questions.column_names:
            groups: dict[str | None, list[int]] = {}
            for row, value in enumerate(questions.column("wanted").to_pylist()):
                groups.setdefault(value, []).append(row)
            self.wanted = {value: np.array(rows) for value, rows in groups.items()}
        self.k = k
        self.keys: np.ndarray | None = None
        self.scores = np.full((len(self.ids), k), NO_SCORE - 1, dtype=np.int64)
        self.refs = np.zeros(self.scores.shape, dtype=np.int64)
        self.carry = list(carry)
        self.store: list[pa.Table] = []
        self.stored = 0

    def _merge(self, rows: np.ndarray, keys: np.ndarray, scores: np.ndarray, refs: np.ndarray) -> None:
        """Fold candidates in; both sides hold ``k`` columns at most."""
        if self.keys is None:
            self.keys = np.zeros(self.scores.shape, dtype=keys.dtype)
        elif keys.dtype.itemsize > self.keys.dtype.itemsize:
            self.keys = self.keys.astype(keys.dtype)
        all_keys = np.concatenate([self.keys[rows], keys], axis=1)
        all_scores = np.concatenate([self.scores[rows], scores], axis=1)
        all_refs = np.concatenate([self.refs[rows], refs], axis=1)
        order = np.lexsort((all_keys, -all_scores), axis=-1)[:, : self.k]
        self.keys[rows] = np.take_along_axis(all_keys, order, axis=1)
        self.scores[rows] = np.take_along_axis(all_scores, order, axis=1)
        self.refs[rows] = np.take_along_axis(all_refs, order, axis=1)

    def add(self, rows: np.ndarray, keys: np.ndarray, vectors: np.ndarray, places: np.ndarray) -> None:
        order = np.argsort(keys, kind="stable")
        keys, vectors, places = keys[order], vectors[order], places[order]
        for part in _slices(len(rows), len(keys)):
            some = rows[part]
            top, scores = best_of(self.vectors[some], vectors, self.k)
            floor = self.scores[some, -1]
            useful = scores.max(axis=1) >= floor
            if useful.any():
                self._merge(some[useful], keys[top][useful], scores[useful], places[top][useful])

    def add_batch(self, batch: pa.RecordBatch | pa.Table) -> None:
        if not len(self.ids) or not batch.num_rows:
            return
        keys = np.array(batch.column("chunk_id").to_pylist())
        vectors = matrix(batch.column("embedding"), self.width)
        if self.width is None:
            self.vectors = np.full((len(self.ids), vectors.shape[1]), np.nan)
        places = self.stored + np.arange(len(keys))
        if self.wanted is None:
            self.add(np.arange(len(self.ids)), keys, vectors, places)
        else:
            if None in self.wanted:
                self.add(self.wanted[None], keys, vectors, places)
            values = batch.column("value")
            if isinstance(values, pa.ChunkedArray):
                values = values.combine_chunks()
            values = values.dictionary_encode()
            codes = values.indices.fill_null(-1).to_numpy()
            for code, value in enumerate(values.dictionary.to_pylist()):
                if value in self.wanted:
                    mine = np.flatnonzero(codes == code)
                    self.add(self.wanted[value], keys[mine], vectors[mine], places[mine])
        if self.carry:
            self._keep(batch)

    def _keep(self, batch: pa.RecordBatch | pa.Table) -> None:
        """Store the rows of a batch that are among the best now."""
        entered = self.refs >= self.stored
        if not entered.any():
            return
        rows, own = np.unique(self.refs[entered] - self.stored, return_inverse=True)
        self.refs[entered] = self.stored + own
        self.store.append(_table(batch).select(self.carry).take(pa.array(rows)))
        self.stored += len(rows)
        if self.stored > 2 * self.refs.size + 1024:
            live, own = np.unique(self.refs, return_inverse=True)
            self.store = [pa.concat_tables(self.store).take(pa.array(live)).combine_chunks()]
            self.refs, self.stored = own.reshape(self.refs.shape), len(live)

    def table(self, schema: pa.Schema) -> pa.Table:
        found = self.scores.ravel() >= NO_SCORE
        ids = np.repeat(np.arange(len(self.ids)), self.k)[found]
        scores = self.scores.ravel()[found]
        keys = [] if self.keys is None else self.keys.ravel()[found].tolist()
        columns = [
            self.ids.take(pa.array(ids)).cast(schema.field(0).type),
            pa.array(keys, schema.field(1).type),
            pa.array(scores / UNIT, pa.float64(), mask=scores == NO_SCORE),
        ]
        if self.store:
            carried = pa.concat_tables(self.store).take(pa.array(self.refs.ravel()[found]))
            columns += [carried.column(c).cast(schema.field(c).type) for c in self.carry]
        else:
            columns += [pa.array([], schema.field(c).type) for c in self.carry]
        return pa.table(columns, schema=schema)


def _table(batch: pa.RecordBatch | pa.Table) -> pa.Table:
    return batch if isinstance(batch, pa.Table) else pa.Table.from_batches([batch])


def hit_schema(questions: DataFrame, index: DataFrame, carry: Sequence[str] = ()) -> T.StructType:
    return T.StructType(
        [
            T.StructField("question_id", questions.schema["question_id"].dataType),
            T.StructField("chunk_id", index.schema["chunk_id"].dataType),
            T.StructField("score", T.DoubleType()),
            *[T.StructField(c, index.schema[c].dataType) for c in carry],
        ]
    )


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """Add ``rank`` and keep the best ``k`` of a question."""
    by_score = Window.partitionBy("question_id").orderBy(F.desc_nulls_last("score"), "chunk_id")
    return hits.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def _scan(questions: pa.Table, index: DataFrame, k: int, schema: T.StructType,
          carry: Sequence[str]) -> DataFrame:
    """Score all questions in every task of the index scan."""
    shared = index.sparkSession.sparkContext.broadcast(questions)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(shared.value, k, carry)
        for batch in batches:
            best.add_batch(batch)
        yield from best.table(arrow).to_batches()

    return index.mapInArrow(run, schema)


def _block_counts(df: DataFrame, rows: int, output: str) -> DataFrame:
    """How many blocks of ``rows`` rows each ``part`` needs."""
    return df.groupBy("part").agg(F.ceil(F.count("*") / rows).cast("int").alias(output))


def _with_counts(df: DataFrame, counts: list[DataFrame], one_part: bool) -> DataFrame:
    """Add the block counts: as scalars if there is one part, else by a join on the part."""
    for count in counts:
        name = count.columns[1]
        if one_part:
            df = df.withColumn(name, F.coalesce(count.select(name).scalar(), F.lit(0)))
        else:
            df = df.join(count, "part")
    return df


def _blocked(questions: DataFrame, index: DataFrame, k: int, schema: T.StructType,
             block_questions: int, block_rows: int, one_part: bool) -> DataFrame:
    """Join blocks of questions with blocks of index rows of the same ``part``.

    A block is one row, and blocks are dealt to a grid of groups, so each is shuffled ``GROUPS`` times, whatever the
    number of blocks that it meets. A task keeps the best of one block of questions over all index blocks of a group.
    """
    counts = [
        _block_counts(questions, block_questions, "_questions"),
        _block_counts(index, block_rows, "_rows"),
    ]
    # In how many groups the blocks of a part are dealt, on each side; the index has more where its groups would be large.
    groups = [
        F.greatest(F.least(F.col("_questions"), F.lit(GROUPS)), F.lit(1)),
        F.greatest(F.least(F.col("_rows"), F.lit(GROUPS)), F.ceil(F.col("_rows") * block_rows / GROUP_ROWS), F.lit(1)),
    ]

    def packed(df: DataFrame, key: str, own: str, name: str) -> DataFrame:
        """One row per block, which holds its members."""
        members = F.collect_list(F.struct(*[c for c in df.columns if c != "part"])).alias(name)
        block = F.pmod(F.xxhash64(key), F.col(own)).cast("int").alias("_block")
        return _with_counts(df, counts, one_part).groupBy("part", block, "_questions", "_rows").agg(members)

    def dealt(df: DataFrame, own: int, name: str) -> DataFrame:
        """Blocks in their own group, and a copy per group of the other side."""
        places = [F.pmod(F.col("_block"), groups[own]).cast("int").alias("_g" + str(own)),
                  F.explode(F.sequence(F.lit(0), groups[1 - own].cast("int") - 1)).alias("_g" + str(1 - own))]
        return df.select("part", "_block", name, *places)

    left = dealt(packed(questions, "question_id", "_questions", "_some"), 0, "_some")
    right = dealt(packed(index, "chunk_id", "_rows", "_held"), 1, "_held").drop("_block")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = at = None
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column("part")[row].as_py(), batch.column("_block")[row].as_py()
                if block != at:
                    if best is not None:
                        yield from best.table(arrow).to_batches()
                    best, at = Best(_members(batch.column("_some")[row]), k), block
                best.add_batch(_members(batch.column("_held")[row]))
        if best is not None:
            yield from best.table(arrow).to_batches()

    # Merged, so that the blocks of the index meet one block of questions after the other.
    pairs = left.hint("merge").join(right, ["part", "_g0", "_g1"])
    return pairs.select("part", "_block", "_some", "_held").mapInArrow(run, schema)


def _members(block: pa.ListScalar) -> pa.Table:
    """The rows of a block."""
    rows = block.values
    return pa.table({f.name: rows.field(f.name) for f in rows.type})


def search(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    filter_by: tuple[str, str] | None = None,
    max_local_questions: int = MAX_LOCAL_QUESTIONS,
    block_questions: int = BLOCK_QUESTIONS,
    block_rows: int = BLOCK_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` best index rows per question as ``(question_id, chunk_id, score, *carry, rank)``.

    ``questions`` has ``question_id, embedding``, ``index`` has ``chunk_id, embedding``.
    ``filter_by`` names a question column and an index column that must be equal; a question
    whose value is null searches the whole index. ``carry`` names index columns that hits shall have.
    A zero or null vector has a null score, ranked last. Rows without a key, on either side, do not
    take part; vectors of unequal length are an error.

    The questions are written once, so that their number and size are known before anything is shared.
    With few questions, carried columns come out of the scan; with many, where index rows are copied,
    they are joined to the hits.
    """
    questions, index = questions.where("question_id IS NOT NULL"), index.where("chunk_id IS NOT NULL")
    asked, held = compared(questions, index, filter_by, carry)
    asked = materialise(asked)
    count, values = asked.agg(F.count("*"), F.sum(F.greatest(F.size("embedding"), F.lit(0)))).first()
    if count <= max_local_questions and (values or 0) <= MAX_LOCAL_VALUES:
        return ranked(_scan(asked.toArrow(), held, k, hit_schema(questions, index, carry), carry), k)
    held = held.select("chunk_id", "embedding", *(["value"] if filter_by else []))
    schema = hit_schema(questions, index)
    if filter_by is None:
        hits = _blocked(
            asked.withColumn("part", F.lit("")), held.withColumn("part", F.lit("")),
            k, schema, block_questions, block_rows, one_part=True,
        )
    else:
        free = _blocked(
            asked.where("wanted IS NULL").select("question_id", "embedding", F.lit("").alias("part")),
            held.select("chunk_id", "embedding", F.lit("").alias("part")),
            k, schema, block_questions, block_rows, one_part=True,
        )
        equal = _blocked(
            asked.where("wanted IS NOT NULL").select(
                "question_id", "embedding", F.col("wanted").alias("part")),
            held.where("value IS NOT NULL").select(
                "chunk_id", "embedding", F.col("value").alias("part")),
            k, schema, block_questions, block_rows, one_part=False,
        )
        hits = free.unionByName(equal)
    hits = ranked(hits, k)
    if not carry:
        return hits
    carried = index.select(F.col("chunk_id").alias("_key"), *carry)
    return hits.join(carried, F.col("chunk_id") == F.col("_key")).select(
        "question_id", "chunk_id", "score", *carry, "rank"
    )


def compared(questions: DataFrame, index: DataFrame, filter_by: tuple[str, str] | None,
             carry: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both sides with the columns that a comparison needs; filters become ``wanted`` and ``value``."""
    asked = questions.select(
        "question_id", "embedding",
        *([F.col(filter_by[0]).cast("string").alias("wanted")] if filter_by else []),
    )
    held = index.select(
        "chunk_id", "embedding", *[c for c in carry if c != "embedding"],
        *([F.col(filter_by[1]).cast("string").alias("value")] if filter_by else []),
    )
    return asked, held
