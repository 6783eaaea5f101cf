"""Templated questions about titles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators.lookup import entity_rollup, sample_fraction
from parley.plans.qa import QA_INSTRUCTION
from parley.session import SEED, materialise

# The question wordings, by the attribute that they ask for.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "genre": (
        "What genre is the movie {movie_name}?",
        "Which genres does {movie_name} belong to?",
        "Can you tell me the genre of {movie_name}?",
        "What are the main genres of {movie_name}?",
        "Under which genres is {movie_name} classified?",
        "What type of film is {movie_name}?",
        "What genres categorize {movie_name}?",
    ),
    "release_year": (
        "In what year was {movie_name} released?",
        "When did {movie_name} come out?",
        "What is the release year of {movie_name}?",
        "Which year did {movie_name} premiere?",
        "When was {movie_name} first released?",
        "What year did {movie_name} hit theaters?",
        "Can you tell me the release year of {movie_name}?",
    ),
    "imdb_rating": (
        "What is the IMDb rating of {movie_name}?",
        "How is {movie_name} rated on IMDb?",
        "Can you tell me the IMDb score for {movie_name}?",
        "What rating did {movie_name} receive on IMDb?",
        "What is the IMDb rating for {movie_name}?",
    ),
    "num_imdb_votes": (
        "How many votes does {movie_name} have on IMDb?",
        "What is the total number of IMDb votes for {movie_name}?",
        "How many people rated {movie_name} on IMDb?",
        "What is the number of votes for {movie_name} on IMDb?",
    ),
}


def generate_questions(
    entities: DataFrame,
    key: str = "movie_name",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    seed: int = SEED,
) -> DataFrame:
    """Up to one question per entity and attribute; null and ``Unknown`` attributes get none.

    Question, answer and task replace the entity's ``utterance``, ``response``, ``instruction``.
    The wording is picked by ``md5(key:attribute:seed)``. Everything happens in one
    projection: the templates are literals and nothing is joined or shuffled.
    """
    facts = []
    for kind, wordings in templates.items():
        number = X.hash_number(X.seeded_hash(seed, F.col(key).cast("string"), F.lit(kind)))
        wording = F.get(F.array(*map(F.lit, wordings)), (number % len(wordings)).cast("int"))
        facts.append(
            F.struct(
                X.fill_template(wording, "movie_name", F.col("movie_name")).alias("utterance"),
                F.col(kind).cast("string").alias("response"),
            )
        )
    return (
        entities.withColumn("_fact", F.explode(F.array(*facts)))
        .where(F.col("_fact.response").isNotNull() & (F.col("_fact.response") != "Unknown"))
        .withColumns(
            {
                "utterance": F.col("_fact.utterance"),
                "response": F.col("_fact.response"),
                "instruction": F.lit(QA_INSTRUCTION),
            }
        )
        .drop("_fact")
    )


def augment(
    base: DataFrame,
    order: str,
    fraction: float = 0.2,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    seed: int = SEED,
    enabled: bool = True,
) -> DataFrame:
    """Append questions about a sample of the titles in ``base``; ``order`` decides what is first."""
    rows = base.withColumn("response", F.col("response").cast("string"))
    if not enabled:
        return rows
    entities = entity_rollup(
        base,
        "movie_name",
        order,
        ["character_names", "genre", "release_year", "num_imdb_votes"],
        ["imdb_rating"],
    )
    # One row per title, used three times; a mean of one-digit ratings shall read like one.
    entities = materialise(entities.withColumn("imdb_rating", F.round("imdb_rating", 6)))
    picked = sample_fraction(entities, fraction, ["movie_name"], seed)
    return rows.unionByName(
        generate_questions(picked, "movie_name", templates, seed), allowMissingColumns=True
    )
