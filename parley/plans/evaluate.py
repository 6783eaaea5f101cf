"""Corpus evaluation of predictions against references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators import scoring as S
from parley.session import materialise
from parley.sources.writers import metrics_rows

METRICS = ("bleu", "rouge1", "rouge2", "rougeL", "rougeLsum", "bertscore")


def with_token_ids(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """``pair_id, prediction_ids, reference_ids`` for a vector table numbered from 0.

    A token's id is its md5 number modulo the size of the table.
    """
    size = max(vectors.count(), 1)

    def ids(column: str) -> F.Column:
        tokens = X.letter_tokens(F.coalesce(column, F.lit("")))
        return F.transform(tokens, lambda t: X.hash_number(F.md5(t)) % size)

    return pairs.select(
        "pair_id",
        ids("prediction").alias("prediction_ids"),
        ids("reference").alias("reference_ids"),
    )


def decoded_pairs(
    df: DataFrame,
    key: str,
    vocabulary: DataFrame,
    logits: str | None = None,
    predicted: str | None = None,
    labels: str = "labels",
    pad: int = 0,
    specials: Sequence[int] = (0,),
) -> DataFrame:
    """``pair_id, prediction, reference`` texts from logits or predicted ids, and padded label ids."""
    if (logits is None) == (predicted is None):
        raise ValueError("give either logits or predicted")
    ids = S.argmax_ids(F.col(logits)) if logits else F.col(predicted)
    rows = df.select(key, ids.alias("_p"), S.unmask(F.col(labels), pad).alias("_r"))
    prediction = S.decode(rows, key, "_p", vocabulary, specials)
    reference = S.decode(rows, key, "_r", vocabulary, specials)
    return prediction.withColumnRenamed("text", "prediction").join(
        reference.withColumnRenamed("text", "reference"), key
    ).withColumnRenamed(key, "pair_id")


def evaluate(
    pairs: DataFrame,
    run_id: str,
    metrics: Sequence[str] = METRICS,
    vectors: DataFrame | None = None,
) -> DataFrame:
    """``run_id, metric, value`` rows for ``pair_id, prediction, reference`` pairs.

    The pairs are written once. BLEU is a corpus score, the others are means over pairs. ``bertscore`` needs token
    vectors and gives three rows.
    """
    unknown = set(metrics) - set(METRICS)
    if unknown:
        raise ValueError(f"unknown metrics: {sorted(unknown)}")
    pairs = materialise(pairs.select("pair_id", "prediction", "reference"))  # each metric reads it
    parts: list[DataFrame] = []
    if "bleu" in metrics:
        parts.append(S.bleu(pairs))
    grams = [m for m in ("rouge1", "rouge2") if m in metrics]
    if grams:
        parts.append(S.rouge_n(pairs).agg(*[F.avg(m).alias(f"rouge_{m}") for m in grams]))
    if "rougeL" in metrics:
        parts.append(S.rouge_l(pairs).agg(F.avg("rougeL").alias("rouge_rougeL")))
    if "rougeLsum" in metrics:
        parts.append(S.rouge_lsum(pairs).agg(F.avg("rougeLsum").alias("rouge_rougeLsum")))
    if "bertscore" in metrics:
        if vectors is None:
            raise ValueError("bertscore needs token vectors")
        parts.append(
            S.bertscore(with_token_ids(pairs, vectors), vectors).agg(
                *[F.avg(c).alias(f"bertscore_{c}") for c in ("precision", "recall", "f1")]
            )
        )
    return reduce(DataFrame.unionByName, [metrics_rows(p, run_id) for p in parts])
