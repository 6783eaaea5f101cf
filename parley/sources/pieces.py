"""Large files of records that span lines, read by many tasks.

Quoted CSV fields may hold line breaks, and an array of JSON objects has no lines at all, so Spark's own readers give such
a file to one task. Here the text reader cuts it into pieces at a sign that ends every record, ``\\n`` or ``}``, which
splits by byte ranges. Whether a piece ends a record depends on all quotes and braces before it. Every range is
summed up for both cases, that it begins inside quotes or outside; the sums of the ranges, one row each, are put together in
order; then every range knows how it begins, and its pieces are numbered by record. A piece that is a whole
record, as nearly all are, goes on as it is; the others are gathered by record. Parsing is Spark's.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SUMS = "file string, start long, flips int, net array<int>, depths array<array<int>>, ends array<array<long>>"
_PIECES = "file string, record long, place long, piece string, whole boolean"


@dataclass(frozen=True)
class Kind:
    """How pieces end, and whether braces count."""

    separator: str
    braces: bool


CSV = Kind("\n", False)
JSON_ARRAY = Kind("}", True)
_ESCAPES = re.compile(r"\\.", re.DOTALL)


def _lines(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    return spark.read.option("lineSep", kind.separator).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _braces(piece: str, inside: bool) -> int:
    """Opened less closed braces outside of quotes; the piece ends with the ``}`` that the reader took off."""
    return sum(p.count("{") - p.count("}") for p in f"{piece}}}".split('"')[inside::2])


@dataclass
class _Range:
    """The pieces of one byte range with what they do to the state, for both ways to begin."""

    values: pa.Array
    flips: np.ndarray
    nets: tuple[np.ndarray, np.ndarray]

    @classmethod
    def of(cls, values: pa.Array, kind: Kind) -> _Range:
        if not kind.braces:
            flips = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
            none = np.zeros(len(values), int)
            return cls(values, flips % 2, (none, none))
        plain = [_ESCAPES.sub("", v) for v in values.to_pylist()]
        flips = np.array([p.count('"') % 2 for p in plain], int)
        return cls(values, flips, tuple(np.array([_braces(p, i) for p in plain], int) for i in (False, True)))

    def states(self, inside: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether quotes are open, and the depth, after each piece."""
        after = (inside + self.flips.cumsum()) % 2
        before = np.concatenate([[inside], after[:-1]])
        return after, np.where(before == 1, self.nets[1], self.nets[0]).cumsum()


def _ranges(batches: Iterator[pa.RecordBatch], kind: Kind) -> Iterator[tuple[str, int, list[_Range]]]:
    """Byte ranges as they are read, in parts of a batch at most."""
    for batch in batches:
        start = batch.column("start").to_numpy(zero_copy_only=False)
        file = batch.column("file").dictionary_encode()
        codes = file.indices.to_numpy()
        edges = np.flatnonzero((np.diff(start) != 0) | (np.diff(codes) != 0)) + 1
        for a, b in zip([0, *edges], [*edges, len(start)]):
            if a < b:
                values = batch.column("value").slice(a, b - a)
                yield file.dictionary[codes[a]].as_py(), int(start[a]), _Range.of(values, kind)


def _sums(lines: DataFrame, kind: Kind) -> list:
    """One row per byte range, as many as the scan has splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list] = {}
        for file, start, part in _ranges(batches, kind):
            flips, net, ends = found.setdefault((file, start), [0, [0, 0], [Counter(), Counter()]])
            moved = list(net)
            for inside in (0, 1):
                after, depth = part.states((inside + flips) % 2)
                closed = depth[after == 0] + net[inside]
                ends[inside].update(dict(zip(*map(np.ndarray.tolist, np.unique(closed, return_counts=True)))))
                moved[inside] += int(depth[-1])
            found[file, start] = [(flips + int(part.flips.sum())) % 2, moved, ends]
        rows = [
            (f, s, flips, net, [list(e) for e in ends], [list(e.values()) for e in ends])
            for (f, s), (flips, net, ends) in found.items()
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32())),
                    pa.list_(pa.list_(pa.int64()))))],
                names=["file", "start", "flips", "net", "depths", "ends"],
            )

    return lines.mapInArrow(run, _SUMS).collect()


def _begins(sums: list) -> dict[tuple[str, int], tuple[int, int, int]]:
    """How each range begins: quotes open, depth, records ended before."""
    out, file, state = {}, None, (0, 0, 0)
    for r in sorted(sums, key=lambda r: (r.file, r.start)):
        if r.file != file:
            file, state = r.file, (0, 0, 0)
        out[r.file, r.start] = state
        inside, depth, records = state
        ended = dict(zip(r.depths[inside], r.ends[inside])).get(-depth, 0)
        state = ((inside + r.flips) % 2, depth + r.net[inside], records + ended)
    return out


def records(spark: SparkSession, path: str, kind: Kind) -> DataFrame:
    """``file, record, text``: the records of one or many files; ``record`` counts from 0 in a file."""
    lines = _lines(spark, path, kind)
    begins = spark.sparkContext.broadcast(_begins(_sums(lines, kind)))  # a row per split of the scan

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[tuple[str, int], tuple] = {}
        for file, start, part in _ranges(batches, kind):
            inside, depth, done, place = at.get((file, start)) or (*begins.value[file, start], 0)
            after, moved = part.states(inside)
            ended = (after == 0) & (moved + depth == 0)
            total = np.concatenate([[0], ended.cumsum()])
            opened = np.concatenate([[inside == 0 and depth == 0], ended[:-1]])
            n = len(ended)
            at[file, start] = (int(after[-1]), depth + int(moved[-1]), done + int(total[-1]), place + n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n), pa.array(done + total[:-1]), pa.array(start + place + np.arange(n)),
                 part.values, pa.array(opened & ended)],
                names=["file", "record", "place", "piece", "whole"],
            )

    pieces = lines.mapInArrow(run, _PIECES)
    parts = F.array_sort(F.collect_list(F.struct("place", "piece")))
    joined = pieces.where("NOT whole").groupBy("file", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["piece"]), kind.separator).alias("text")
    )
    return pieces.where("whole").select("file", "record", F.col("piece").alias("text")).unionByName(joined)
