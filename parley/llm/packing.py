"""Cost-balanced packing of tokenised documents into sequences.

A document is its token ids and a closing id. Each whole stretch of ``length`` ids is a sequence of
its own; the rest of each document is a piece to be packed. Pieces are dealt by a hash into groups of
about ``GROUP``; a group opens as many sequences as its tokens fill and goes through its pieces from
the longest to the shortest, giving each to the sequence of least estimated cost, linear * n +
quadratic * n**2 summed over its pieces, among those with room for it. A piece that has room nowhere
is cut over the sequences with the most room. So only one sequence of a group is not full.

Defined results: a null or empty text is the closing id alone; repeated rows are documents of their
own; ids may be null. An empty table gives no pieces. Other columns of the input are ignored. Very
long texts are encoded row by row; only the rest of a document, below ``length`` ids, carries its
ids through the shuffle.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm import tokens

LENGTH, CLOSING_ID = 1024, 0
#: Pieces of a group; the padding is one sequence in so many pieces.
GROUP = 16384
LINEAR, QUADRATIC = 1.0, 1.0 / 512

_CUT = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, spread long"
PIECE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long"
)
_ROWS = 2048


def cut(path: str, length: int = LENGTH):
    """Documents to whole stretches (without ids) and their rests (with ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokens.load(path)
        rows: list[tuple] = []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encode(text or ""), CLOSING_ID], "<u4")
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                spread = crc32(ids)  # with the place in the text, an even and repeatable deal
                for start in range(0, len(ids), length):
                    data = ids[start : start + length].tobytes()
                    whole = len(data) == 4 * length
                    rows.append(
                        (doc_id, start, len(data) // 4, None if whole else data, crc32(data),
                         len(ids), spread)
                    )
                if len(rows) >= _ROWS:
                    yield _frame(rows)
                    rows = []
        if rows:
            yield _frame(rows)

    return run


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=[f.split()[0] for f in _CUT.split(", ")])
    return out.astype({"doc_id": "Int64"})


class Room:
    """Open sequences, found by the least cost among those with at least so much room.

    A heap of (cost, sequence) for each amount of room, and a tree over the amounts that holds the
    least entry of each half. Entries that no longer hold are dropped when they surface.
    """

    def __init__(self, count: int, length: int):
        self.base = 1 << length.bit_length()
        self.left = [length] * count
        self.cost = [0.0] * count
        self.heaps: list[list] = [[] for _ in range(self.base)]
        self.best: list = [None] * (2 * self.base)
        self.heaps[length] = [(0.0, s) for s in range(count)]
        self._lift(length)

    def _lift(self, room: int) -> None:
        heap = self.heaps[room]
        while heap and (self.left[heap[0][1]] != room or self.cost[heap[0][1]] != heap[0][0]):
            heapq.heappop(heap)
        node = self.base + room
        self.best[node] = heap[0] if heap and room else None
        while node > 1:
            node //= 2
            a, b = self.best[2 * node], self.best[2 * node + 1]
            self.best[node] = min(a, b) if a and b else a or b

    def cheapest(self, need: int) -> int | None:
        """The sequence of least cost with room for ``need``."""
        low, high, found = self.base + need, 2 * self.base, None
        while low < high:
            if low & 1:
                here, low = self.best[low], low + 1
                found = min(found, here) if found and here else found or here
            low, high = low // 2, high // 2
        return None if found is None else found[1]

    def widest(self) -> int:
        """The sequence of most room, the cheapest of several."""
        node = 1
        while node < self.base:
            node = 2 * node + 1 if self.best[2 * node + 1] else 2 * node
        return self.best[node][1]

    def put(self, sequence: int, size: int) -> None:
        before = self.left[sequence]
        self.left[sequence] = before - size
        self.cost[sequence] += LINEAR * size + QUADRATIC * size * size
        heapq.heappush(self.heaps[before - size], (self.cost[sequence], sequence))
        self._lift(before)
        self._lift(before - size)


def assign(sizes: list[int], length: int) -> list[list[tuple[int, int, int]]]:
    """For each piece, its cuts (sequence, offset there, ids); ``sizes`` fall."""
    room = Room(-(-sum(sizes) // length), length)
    out = []
    for size in sizes:
        cuts = []
        while size:
            sequence = room.cheapest(size)
            part = size
            if sequence is None:
                sequence = room.widest()
                part = room.left[sequence]
            cuts.append((sequence, length - room.left[sequence], part))
            room.put(sequence, part)
            size -= part
        out.append(cuts)
    return out


def _pack(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True],
            ignore_index=True,
        )
        first = int(group["bucket"].iat[0]) << 32
        whole = group["ids"].isna().to_numpy()
        full, rest = group[whole], group[~whole]
        rows = list(
            zip(full["doc_id"], full["start"], full["length"], full["ids_crc32"], full["doc_tokens"],
                range(first, first + len(full)), [0] * len(full))
        )
        first += len(full)
        cuts = assign(rest["length"].tolist(), length)
        for doc_id, start, ids, crc, total, parts in zip(
            rest["doc_id"], rest["start"], rest["ids"], rest["ids_crc32"], rest["doc_tokens"], cuts
        ):
            at = 0
            for sequence, offset, size in parts:
                if len(parts) > 1:
                    crc = crc32(ids[4 * at : 4 * (at + size)])
                rows.append((doc_id, start + at, size, crc, total, first + sequence, offset))
                at += size
        out = pd.DataFrame(rows, columns=[f.split()[0] for f in PIECE.split(", ")])
        return out.astype({"doc_id": "Int64"})

    return run


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    length: int = LENGTH,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The number of groups follows the counted rows and bytes, so a group keeps its size at any scale.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    # A whole stretch weighs little: it holds no ids. A text has at least a byte for each id.
    buckets = max(1, -(-(rows + size // (8 * length)) // group))
    pieces = docs.mapInPandas(cut(tokenizer_path or tokens.default_path(), length), _CUT)
    bucket = F.pmod(F.xxhash64("doc_id", "start", "spread"), F.lit(buckets)).cast("long")
    return (
        pieces.withColumn("bucket", bucket)
        .drop("spread")
        .groupBy("bucket")
        .applyInPandas(_pack(length), PIECE)
    )
