"""Tables of questions to context: entity, filtered search, joined text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.fusion import majority_vote, search_ensemble
from parley.operators.ordering import small_concat
from parley.session import materialise


@dataclass(frozen=True)
class EnsembleSettings:
    k_sim: int
    k_mmr: int
    weights: tuple[float, float]


# List lengths and weights of the two searches.
NAME_SEARCH = EnsembleSettings(2, 4, (0.2, 0.8))
INFO_SEARCH = EnsembleSettings(4, 4, (0.5, 0.5))


def _search(questions: DataFrame, index: DataFrame, settings: EnsembleSettings,
            filter_by: tuple[str, str] | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    return search_ensemble(
        questions, index, settings.k_sim, settings.k_mmr, settings.weights, "text",
        filter_by=filter_by, carry=carry,
    )


def resolve_entity(
    questions: DataFrame, index: DataFrame, settings: EnsembleSettings = NAME_SEARCH
) -> DataFrame:
    """Add ``entity``: the title that most hits of a question name; null without a hit."""
    hits = _search(questions, index, settings, carry=("movie_name",))
    votes = majority_vote(hits, "movie_name").withColumnRenamed("movie_name", "entity")
    return questions.join(votes, "question_id", "left")


def retrieve_context(
    questions: DataFrame,
    name_index: DataFrame,
    info_index: DataFrame,
    name_settings: EnsembleSettings = NAME_SEARCH,
    info_settings: EnsembleSettings = INFO_SEARCH,
) -> DataFrame:
    """Add ``entity`` and ``context`` to ``question_id, question, embedding`` rows.

    The second search only sees chunks of the entity, or all of them if there is none. Its
    texts are joined by a line break, best first; no hit gives an empty context. The resolved
    questions are used twice and therefore written to the shared folder once.
    """
    resolved = materialise(resolve_entity(questions, name_index, name_settings))
    hits = _search(resolved, info_index, info_settings, ("entity", "movie_name"))
    context = hits.groupBy("question_id").agg(
        small_concat(F.col("rank"), F.col("text"), "\n").alias("context")
    )
    return resolved.join(context, "question_id", "left").withColumn(
        "context", F.coalesce("context", F.lit(""))
    )
