"""Structure repair of conversations by a run-length dynamic program.

A repaired conversation has the roles ``(system? (user assistant)+)?``. Rows are kept, given another role, deleted, or
empty rows are inserted, at least cost. A row's symbol is the initial of its role and its first fault: blank, duplicate
(role and text seen earlier) or truncated. Equal consecutive symbols are a run. What a row costs between any two states of
the grammar is a 4 x 4 matrix of (min, +); a run is advanced by the binary powers of its matrix, which are kept.

Equal rows of a turn are counted before any shuffle. The counted rows, without their texts, are dealt to ranges of
(conversation, turn, role, digest), so a conversation of any length is cut into segments, each with its runs, its
product of matrices and its counts. A last pass reads a conversation's segments, then streams its rows:
costs to the end come from the segments' matrices backwards, choices are unrolled forwards, run by run, and each row
is edited as it passes. It holds one sign per run and edit, never the texts. A conversation's rows meet in one task
there, because the SHA-256 of its repaired text has to read them one after the other.

Ties go to the edits whose initials come first: D(elete), I(nsert), K(eep), R(erole).

Defined results: a null role or text is one space; a null turn comes first; rows of one turn follow the order of their
roles, then of the SHA-256 of their texts; a null conversation is one of its own; a role that doesn't begin with s, u or
a, or is empty, can't be kept; repeated rows are duplicates; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache, partial
from hashlib import sha256
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from parley.session import materialise

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Runs of a segment at most.
SEGMENT = 65536

FINE, CUT, COPY, BLANK = range(4)
_INITIALS = "suax"
# States of the grammar: nothing yet, a system row, a user row, an assistant row.
_E, _S, _U, _A = range(4)
_NEXT = {(_E, "s"): _S, (_E, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}
_OTHER = {_E: _U, _S: _U, _U: _A, _A: _U}  # where a new or a renamed row leads
_ROLE = {_U: "user", _A: "assistant"}
_FAR = 1 << 60

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def _product(a: Matrix, b: Matrix) -> Matrix:
    return tuple(
        tuple(min(_FAR, min(row[k] + b[k][q] for k in range(4))) for q in range(4)) for row in a
    )


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(_FAR, min(row[k] + v[k] for k in range(4))) for row in a)


_ONE: Matrix = tuple(tuple(0 if p == q else _FAR for q in range(4)) for p in range(4))
_ONCE: Matrix = tuple(tuple(0 if p == q else INSERT if _OTHER[p] == q else _FAR for q in range(4)) for p in range(4))
_INSERTS = _product(_ONCE, _ONCE)
#: Costs after the last row.
END: Vector = _apply(_INSERTS, (0, _FAR, _FAR, 0))


def _edits(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """What may happen to a row in a state: letter, cost, next state; in order of the letters."""
    initial, fault = symbol[0], int(symbol[1])
    out = [("D", DELETE, state)]
    if fault in (FINE, CUT):
        more = TRUNCATED if fault == CUT else 0
        if (state, initial) in _NEXT:
            out.append(("K", KEEP + more, _NEXT[state, initial]))
        out.append(("R", REROLE + more, _OTHER[state]))
    return out


@lru_cache(None)
def power(symbol: str, k: int) -> Matrix:
    """The matrix of 2 ** k rows of a symbol."""
    if k:
        half = power(symbol, k - 1)
        return _product(half, half)
    row = [[_FAR] * 4 for _ in range(4)]
    for p in range(4):
        for _, cost, q in _edits(symbol, p):
            row[p][q] = min(row[p][q], cost)
    return _product(_INSERTS, tuple(map(tuple, row)))


@lru_cache(1 << 16)
def _then(matrix: Matrix, symbol: str, count: int) -> tuple[Matrix, int]:
    """A matrix followed by a run, less its smallest entry, and that entry."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            matrix = _product(matrix, power(symbol, k))
    least = min(map(min, matrix))
    return tuple(tuple(x if x >= _FAR else x - least for x in row) for row in matrix), least


def _lowered(v: Vector) -> tuple[Vector, int]:
    least = min(v)
    return tuple(x if x >= _FAR else x - least for x in v), least


@lru_cache(1 << 16)
def _before(symbol: str, count: int, v: Vector) -> Vector:
    """Costs to the end before a run, from those after it."""
    for k in range(count.bit_length()):
        if count >> k & 1:
            v = _apply(power(symbol, k), v)
    return v


@lru_cache(1 << 16)
def _unroll(symbol: str, count: int, state: int, after: Vector) -> tuple[str, int]:
    """The letters of a run that begins in a state, and the state where it ends."""
    if count > 1:
        half = 1 << ((count - 1).bit_length() - 1)
        first, state = _unroll(symbol, count - half, state, _lowered(_before(symbol, half, after))[0])
        second, state = _unroll(symbol, half, state, after)
        return first + second, state
    here, letters = _before(symbol, 1, after), ""
    while True:
        options = _edits(symbol, state)
        options.insert(1, ("I", INSERT, _OTHER[state]))
        for letter, cost, q in options:
            if cost + (here if letter == "I" else after)[q] == here[state]:
                break
        letters, state = letters + letter, q
        if letter != "I":
            return letters, state


def solve(segments: list[tuple[str, list[int], Matrix | None]]) -> tuple[int, str]:
    """Least cost and letters of a conversation from its segments (symbols, counts, matrix)."""
    ends, at, paid = [], END, 0
    for n in range(len(segments) - 1, -1, -1):
        symbols, counts, matrix = segments[n]
        ends.append(at)
        if n:
            at = _apply(matrix, at)
        else:  # the first segment is unrolled right away, so its runs are needed anyway
            for r in range(len(counts) - 1, -1, -1):
                at = _before(symbols[2 * r : 2 * r + 2], counts[r], at)
        at, least = _lowered(at)
        paid += least
    cost, state, letters = paid + at[_E], _E, []
    for (symbols, counts, _), after in zip(segments, reversed(ends)):
        behind = []
        for r in range(len(counts) - 1, -1, -1):
            behind.append(after)
            after = _lowered(_before(symbols[2 * r : 2 * r + 2], counts[r], after))[0]
        for r, count in enumerate(counts):
            own, state = _unroll(symbols[2 * r : 2 * r + 2], count, state, behind.pop())
            letters.append(own)
    while state in (_S, _U):
        letters.append("I")
        state = _OTHER[state]
    return cost, "".join(letters)


_BLANKS = r"\x20\x09-\x0D"


def _clean(rows: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(" "))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit(" ")).alias("role"), text.alias("text"), F.sha2(text, 256).alias("digest"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Counted rows with their flags: copies, blank, cut, and whether role and text are new."""
    blank = ~F.regexp_like("text", F.lit(f"[^{_BLANKS}]"))
    cut = ~F.regexp_like("text", F.lit(rf"[.!?][{_BLANKS}]*\z"))
    keys = ["conv_id", "turn", "role", "digest"]
    counted = _clean(rows).groupBy(*keys, blank.alias("blank"), cut.alias("cut")).agg(F.count("*").alias("copies"))
    counted = materialise(counted)
    earliest = (
        counted.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("at"))
        .select("conv_id", F.col("at.turn").alias("turn"), "role", "digest")
        .select(*[F.col(k).alias(f"_{k}") for k in keys], F.lit(True).alias("_new"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return counted.join(earliest, same[0] & same[1] & same[2] & same[3], "left").select(
        *keys, "blank", "cut", "copies", F.col("_new").isNotNull().alias("new")
    )


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class _Segment:
    """Runs and counts of consecutive rows of one conversation."""

    def __init__(self, conv_id, number: int):
        self.conv_id, self.number = conv_id, number
        self.symbols: list[str] = []
        self.counts: list[int] = []
        self.matrix, self.paid = _ONE, 0
        self.total = dict.fromkeys(_COUNTS, 0)
        self.first_turn = self.last_turn = None

    def add(self, initial: str, fault: int, copies: int) -> None:
        symbol = f"{initial}{fault}"
        self.total["illegal"] += copies - 1 + bool(self.symbols and not legal(self.symbols[-1][0], initial))
        if self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += copies
        else:
            self.symbols.append(symbol)
            self.counts.append(copies)
        if fault != FINE:
            self.total[{CUT: "truncated", COPY: "duplicate", BLANK: "blank"}[fault]] += copies

    def turn(self, turn) -> None:
        if turn is not None and turn != self.last_turn:
            self.total["turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self) -> tuple:
        for symbol, count in zip(self.symbols, self.counts):
            self.matrix, least = _then(self.matrix, symbol, count)
            self.paid += least
        matrix = [[min(_FAR, x + self.paid) for x in row] for row in self.matrix]
        return (self.conv_id, self.number, "".join(self.symbols), self.counts, matrix,
                *self.total.values(), self.first_turn, self.last_turn)


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def _segments(batches: Iterable[pa.RecordBatch], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    out, own = [], None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for conv_id, turn, initial, blank, cut, copies, new in zip(*columns):
            if own is None or own.conv_id != conv_id or len(own.counts) >= most:
                number = own.number + 1 if own is not None else 0
                if own is not None:
                    out.append(own.row())
                own = _Segment(conv_id, number)
            own.turn(turn)
            fresh = 1 if new and not blank else 0
            if fresh:
                own.add(initial, CUT if cut else FINE, 1)
            if copies > fresh:
                own.add(initial, BLANK if blank else COPY, copies - fresh)
            if len(out) >= 4096:
                yield _batch(out, schema)
                out = []
    if own is not None:
        out.append(own.row())
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
    )


def _schema(rows: DataFrame, ddl: str) -> StructType:
    """conv_id in its own type, then the columns of ``ddl``."""
    return StructType([StructField("conv_id", rows.schema["conv_id"].dataType), *StructType.fromDDL(ddl).fields])


def _segment_table(rows: DataFrame, most: int) -> DataFrame:
    initial = F.substring("role", 1, 1)
    order = ["conv_id", "turn", "role", "digest"]
    marked = materialise(_marked(rows))
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    counted = ", ".join(f"{name} bigint" for name in (*_COUNTS, "first_turn", "last_turn"))
    schema = _schema(
        rows, f"number int, symbols string, counts array<bigint>, matrix array<array<bigint>>, {counted}"
    )
    found = dealt.select(
        "conv_id", "turn", F.when(initial.isin(*"sua"), initial).otherwise("x").alias("initial"),
        "blank", "cut", "copies", "new",
    ).mapInArrow(partial(_segments, schema=to_arrow_schema(schema), most=most), schema)
    return materialise(found.select("*", F.spark_partition_id().alias("part")))


def _stream(rows: DataFrame, ids: DataFrame | None, most: int) -> DataFrame:
    """Per conversation: its name (0), its segments (1), its rows (2), each kind in order."""
    segments = _segment_table(rows, most)
    kinds = [
        segments.withColumn("kind", F.lit(1)),
        _clean(rows).withColumn("kind", F.lit(2)),
    ]
    if ids is not None:
        kinds.append(ids.select("conv_id").distinct().withColumn("kind", F.lit(0)))
    both = kinds[0]
    for other in kinds[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    names = ["conv_id", "kind", "symbols", "counts", "matrix", *_COUNTS, "first_turn", "last_turn", "turn", "role", "text"]
    order = ["conv_id", "kind", "part", "number", "turn", "role", "digest"]
    return both.repartition("conv_id").sortWithinPartitions(*order).select(*names)


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """conv_id, its segments, and its rows (turn, role, text) as they come."""
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for conv_id, own in groupby(rows, itemgetter(0)):
        segments, first = [], []
        for row in own:
            if row[1] == 2:
                first.append(row)
                break
            if row[1] == 1:
                segments.append(row[2:12])
        yield conv_id, segments, (row[12:] for row in chain(first, own))


def _edited(letters: str, rows: Iterable[tuple]) -> Iterator[tuple]:
    """(letter, turn, role, text) of what stays."""
    state, rows = _E, iter(rows)
    for letter in letters:
        if letter == "I":
            state = _OTHER[state]
            yield letter, None, _ROLE[state], ""
            continue
        turn, role, text = next(rows)
        if letter == "K":
            state = _NEXT[state, role[:1]]
            yield letter, turn, role, text
        elif letter == "R":
            state = _OTHER[state]
            yield letter, turn, _ROLE[state], text


def _solved(segments: list[tuple]) -> tuple[int, str]:
    return solve([(s[0], s[1], tuple(map(tuple, s[2]))) for s in segments])


def _audits(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out = []
    for conv_id, segments, rows in _conversations(batches):
        cost, letters = _solved(segments)
        total = [sum(s[3 + n] for s in segments) for n in range(len(_COUNTS))]
        for a, b in zip(segments, segments[1:]):
            total[3] += not legal(a[0][-2], b[0][0])
        turns, last = 0, None
        for s in segments:
            turns += s[7] - (s[8] is not None and s[8] == last)
            last = last if s[9] is None else s[9]
        first = next((s[8] for s in segments if s[8] is not None), None)
        gaps = 0 if first is None else last - first + 1 - turns
        digest, mark = sha256(), ""
        for _, _, role, text in _edited(letters, rows):
            digest.update(f"{mark}{role}:{text}".encode())
            mark = "\n"
        out.append((conv_id, gaps, *total[:4], cost, letters, digest.hexdigest()))
        if len(out) >= 4096:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def audit(rows: DataFrame, ids: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows`` and of ``ids``: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit (the initials of the edits) and repaired_sha256 (of ``role:text`` lines)."""
    schema = _schema(
        rows, "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
        " audit string, repaired_sha256 string"
    )
    return _stream(rows, ids, segment).mapInArrow(partial(_audits, schema=to_arrow_schema(schema)), schema)


def _repairs(batches: Iterable[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out, size = [], 0
    for conv_id, segments, rows in _conversations(batches):
        letters = _solved(segments)[1]
        for place, (edit, turn, role, text) in enumerate(_edited(letters, rows)):
            out.append((conv_id, place, edit, turn, role, text))
            size += len(text)
            if len(out) >= 4096 or size >= 1 << 24:
                yield _batch(out, schema)
                out, size = [], 0
    if out:
        yield _batch(out, schema)


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place, edit (K, R or I), turn, role, text."""
    schema = _schema(rows, "place bigint, edit string, turn bigint, role string, text string")
    return _stream(rows, None, segment).mapInArrow(partial(_repairs, schema=to_arrow_schema(schema)), schema)
