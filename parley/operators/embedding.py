"""Text to vectors, and the hook for models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import text as X
from parley.operators.batches import in_runs

DIMENSIONS = 64
#: Tokens and components of the texts that are counted at a time.
HELD_TOKENS = 1 << 17


def hash_slot(token: str, dim: int) -> int:
    """The slot of a token: below ``dim`` it counts up, above it counts down."""
    return int(md5(token.encode()).hexdigest()[:8], 16) % (2 * dim)


def hash_embedding(text: Column, dim: int = DIMENSIONS) -> Column:
    """Signed feature hashing of the tokens, scaled to unit length; no tokens give zeros.

    Texts are cut into tokens in the JVM. Arrow hands them over as one flat array per batch, of which runs of
    rows are counted at a time: each distinct token of a run is hashed once, and counting has no loop over rows.
    """

    def vectors(tokens: pa.Array) -> pa.Array:
        n = len(tokens)
        coded = tokens.flatten().dictionary_encode()
        slots = np.array([hash_slot(t, dim) for t in coded.dictionary.to_pylist()], dtype=np.int64)
        flat = slots[coded.indices.to_numpy()]
        rows = np.repeat(np.arange(n), np.diff(tokens.offsets.to_numpy()))
        signs = np.where(flat < dim, 1.0, -1.0)
        counts = np.bincount(rows * dim + flat % dim, signs, minlength=n * dim).reshape(n, dim)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        unit = np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)
        offsets = np.arange(0, (n + 1) * dim, dim, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(unit.ravel().astype(np.float32)))

    @F.arrow_udf("array<float>")
    def count(tokens: pa.Array) -> pa.Array:
        return in_runs(vectors, np.diff(tokens.offsets.to_numpy()) + dim, HELD_TOKENS, tokens)

    return count(X.letter_tokens(F.coalesce(text, F.lit(""))))


def apply_model(
    df: DataFrame,
    column: str,
    output: str,
    output_type: str,
    load: Callable[[], Callable[[pd.Series], pd.Series]],
) -> DataFrame:
    """Add a column computed by a model; ``load`` runs once per task, then per Arrow batch.

    This is the hook for sentence encoders and for text generation.
    """
    kind = T._parse_datatype_string(output_type)
    schema = T.StructType([*df.schema.fields, T.StructField(output, kind, True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for batch in batches:
            batch[output] = model(batch[column])
            yield batch

    return df.mapInPandas(run, schema)


def generate(
    df: DataFrame, prompt: str, load: Callable[[], Callable[[pd.Series], pd.Series]]
) -> DataFrame:
    """Add ``answer``: the model's text for each prompt."""
    return apply_model(df, prompt, "answer", "string", load)
