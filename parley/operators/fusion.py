"""Diversity-aware picks, rank fusion and votes over search hits."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.knn import NO_SCORE, UNIT, matrix, search, units

FETCH_K = 20
LAMBDA = 0.5
RRF_C = 60


def pick_diverse(scores: np.ndarray, pairs: np.ndarray, k: int, lam: float) -> list[int]:
    """Greedy picks: the best score, then the best ``lam * score - (1 - lam) * likeness``.

    ``likeness`` is the greatest cosine to a row picked before; the first row wins a tie.
    """
    chosen: list[int] = []
    likeness = np.full(len(scores), -np.inf)
    for _ in range(min(k, len(scores))):
        value = lam * scores - (1 - lam) * likeness if chosen else scores.copy()
        value[chosen] = -np.inf
        best = int(np.argmax(value))
        chosen.append(best)
        likeness = np.maximum(likeness, pairs[best])
    return chosen


def with_diverse_rank(hits: DataFrame, k: int, lam: float = LAMBDA,
                      carry: Sequence[str] = ()) -> DataFrame:
    """Add ``mmr_rank`` to hits that carry their ``embedding``: 1 to ``k`` for the picked ones, else null.

    A question's hits, whose number the search bounds, are gathered into one row; the picks
    are then made for a whole Arrow batch of questions at a time. The vectors end here.
    """
    gathered = hits.groupBy("question_id").agg(
        F.array_sort(
            F.collect_list(F.struct("rank", "chunk_id", "score", "embedding", *carry))
        ).alias("hits")
    )

    @F.arrow_udf("array<int>")
    def picks(scores: pa.Array, vectors: pa.Array) -> pa.Array:
        values = scores.flatten().to_numpy(zero_copy_only=False).astype(float)
        values = np.where(np.isnan(values), NO_SCORE / UNIT, values)
        rows = matrix(vectors.flatten())
        ranks = np.zeros(len(values), dtype=np.int32)
        for start, end in pairwise(scores.offsets.to_pylist()):
            pairs = units(rows[start:end] @ rows[start:end].T) / UNIT
            chosen = pick_diverse(values[start:end], pairs, k, lam)
            ranks[start + np.array(chosen)] = np.arange(1, len(chosen) + 1)
        return pa.ListArray.from_arrays(scores.offsets, pa.array(ranks, mask=ranks == 0))

    return (
        gathered.withColumn("mmr_rank", picks("hits.score", "hits.embedding"))
        .select("question_id", F.inline(F.arrays_zip("hits", "mmr_rank")))
        .select(
            "question_id", "hits.chunk_id", "hits.score", "hits.rank", "mmr_rank",
            *[f"hits.{c}" for c in carry],
        )
    )


def search_mmr(
    questions: DataFrame,
    index: DataFrame,
    k: int,
    fetch_k: int = FETCH_K,
    lam: float = LAMBDA,
    filter_by: tuple[str, str] | None = None,
) -> DataFrame:
    """``k`` hits per question that are both near and unlike each other, ranked by pick."""
    fetched = search(questions, index, fetch_k, filter_by, carry=("embedding",))
    hits = with_diverse_rank(fetched, k, lam)
    return hits.where("mmr_rank IS NOT NULL").select(
        "question_id", "chunk_id", "score", F.col("mmr_rank").alias("rank")
    )


def fuse(ranked: DataFrame, weights: Sequence[float], text_key: str, c: int = RRF_C,
         carry: Sequence[str] = ()) -> DataFrame:
    """Weighted reciprocal-rank fusion of lists.

    ``ranked`` has ``question_id, list_no, rank, chunk_id`` and the column that tells texts
    apart: hits of equal text are one. Ties go to the earlier list, then the better rank.
    Scores are rounded to twelve digits before they are compared. ``carry`` is taken from the first hit.
    """
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("list_no"))
    merged = ranked.groupBy("question_id", text_key).agg(
        F.round(F.sum(weight / (F.lit(c) + F.col("rank"))), 12).alias("score"),
        F.min(F.struct("list_no", "rank", "chunk_id", *carry)).alias("_first"),
    )
    order = Window.partitionBy("question_id").orderBy(F.desc("score"), "_first")
    keep = [] if text_key == "chunk_id" else [text_key]
    return merged.withColumn("rank", F.row_number().over(order)).select(
        "question_id", F.col("_first.chunk_id").alias("chunk_id"), *keep, "score", "rank",
        *[F.col(f"_first.{name}").alias(name) for name in carry],
    )


def search_ensemble(
    questions: DataFrame,
    index: DataFrame,
    k_sim: int,
    k_mmr: int,
    weights: Sequence[float],
    text_key: str = "chunk_id",
    fetch_k: int = FETCH_K,
    lam: float = LAMBDA,
    c: int = RRF_C,
    filter_by: tuple[str, str] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Similarity and diversity search fused; ``carry`` names index columns that hits shall have.

    The similarity list is the head of what the diversity search fetches, so one search
    serves both. Vectors and texts come with the hits; the index is read once.
    """
    also = [c for c in dict.fromkeys((text_key, *carry)) if c != "chunk_id"]
    fetched = search(questions, index, max(k_sim, fetch_k), filter_by, carry=("embedding", *also))
    hits = with_diverse_rank(fetched, k_mmr, lam, also)
    lists = F.array(
        F.struct(F.lit(0).alias("list_no"), F.when(F.col("rank") <= k_sim, F.col("rank")).alias("rank")),
        F.struct(F.lit(1).alias("list_no"), F.col("mmr_rank").alias("rank")),
    )
    ranked = (
        hits.select("question_id", "chunk_id", *also, F.explode(lists).alias("_l"))
        .select("question_id", "chunk_id", *also, "_l.*")
        .where("rank IS NOT NULL")
    )
    return fuse(ranked, weights, text_key, c, carry)


def majority_vote(hits: DataFrame, field: str) -> DataFrame:
    """The commonest value of a field per question; the best-ranked one on a tie."""
    counts = (
        hits.where(F.col(field).isNotNull())
        .groupBy("question_id", field)
        .agg(F.count("*").alias("_n"), F.min("rank").alias("_rank"))
    )
    return counts.groupBy("question_id").agg(
        F.max_by(F.col(field), F.struct("_n", -F.col("_rank"))).alias(field)
    )
