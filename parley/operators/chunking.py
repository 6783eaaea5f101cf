"""Cutting texts into overlapping chunks."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.operators.batches import in_runs

# The separators to try, coarse to fine; the empty one cuts anywhere.
SEPARATORS = ("\n\n", "\n", " ", "")
#: Bytes of the texts that are cut at a time.
HELD_BYTES = 1 << 20


def text_steps(text: Column, size: int, overlap: int) -> Column:
    """The text cut into runs of ``size - overlap`` characters."""
    step = _check(size, overlap)
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))


def fixed_chunks(text: Column, steps: Column, size: int, overlap: int) -> Column:
    """Array of windows of ``size`` characters that overlap by ``overlap``.

    Every window is one of the ``steps`` of the text, and the start of the ones after it, so
    the cost is linear in the text. ``steps`` should be a plain column, as it is referred to
    several times. An empty text has one empty chunk.
    """
    step = _check(size, overlap)
    windows = F.greatest(F.ceil((F.length(text) - overlap) / step), F.lit(1)).cast("int")
    chunks = F.slice(steps, 1, windows)
    if overlap:
        following = range(1, -(-overlap // step) + 1)

        def window(piece: Column, i: Column) -> Column:
            tail = F.concat_ws("", *[F.get(steps, i + k) for k in following])
            return F.concat(piece, F.substring(tail, 1, overlap))

        chunks = F.transform(chunks, window)
    return F.when(F.length(text) == 0, F.array(F.lit(""))).otherwise(chunks)


def _check(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    return size - overlap


def _pieces(text: str, separator: str) -> list[str]:
    """Parts between separators, each with the separator before it."""
    if not separator:
        return list(text)
    first, *others = text.split(separator)
    return [p for p in (first, *(separator + o for o in others)) if p]


def _pack(pieces: Sequence[str], size: int, overlap: int) -> list[str]:
    """Fill chunks with whole pieces; the last pieces of a chunk, up to ``overlap`` long, start the next."""
    chunks: list[str] = []
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            chunks.append("".join(held).strip())
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    chunks.append("".join(held).strip())
    return [c for c in chunks if c]


def split_text(text: str, size: int, overlap: int, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Separator-aware chunks of one text.

    The first separator that occurs cuts the text. Short pieces are packed into chunks; a
    piece of ``size`` or longer is cut by the separators after it, or left whole if there is
    none. White space at both ends of a chunk is dropped, and so are empty chunks.
    """
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[at + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _pieces(text, separators[at]):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _pack(short, size, overlap)
        short = []
        chunks += split_text(piece, size, overlap, finer) if finer else [piece]
    return chunks + _pack(short, size, overlap)


def recursive_chunks(text: Column, size: int, overlap: int,
                     separators: Sequence[str] = SEPARATORS) -> Column:
    """Array of separator-aware chunks, computed in Arrow batches."""
    _check(size, overlap)
    separators = tuple(separators)

    def chunks(texts: pa.Array) -> pa.Array:
        lists = (None if t is None else split_text(t, size, overlap, separators) for t in texts.to_pylist())
        return pa.array(list(lists), pa.list_(pa.string()))

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        return in_runs(chunks, sizes, HELD_BYTES, texts)

    return cut(text)


def chunk(df: DataFrame, text: str, size: int, overlap: int, method: str = "recursive") -> DataFrame:
    """One row per chunk, with ``chunk_no`` from 0; all other columns are repeated."""
    others = [c for c in df.columns if c != text]
    if method == "recursive":
        chunks = recursive_chunks(F.col(text), size, overlap)
    elif method == "fixed":
        df = df.withColumn("_steps", text_steps(F.col(text), size, overlap))
        chunks = fixed_chunks(F.col(text), F.col("_steps"), size, overlap)
    else:
        raise ValueError(f"no chunker {method!r}")
    return df.select(*others, F.posexplode(chunks).alias("chunk_no", text))
