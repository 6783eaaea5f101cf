"""Question-answering tables to one row per answered question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X

# Fixed value: the task line of a question record.
QA_INSTRUCTION = "Answer the following question:"


def answer_questions(qa: DataFrame) -> DataFrame:
    """Replace the answer list by the right answer; questions without an index are dropped."""
    return (
        qa.where(F.col("correct_index").isNotNull())
        .withColumn("response", X.item_at(F.col("answers"), F.col("correct_index")))
        .drop("answers", "correct_index")
    )


def build_qa(qa: DataFrame, movies: DataFrame, details: DataFrame) -> DataFrame:
    """Answered questions with title, genre, year and plot outline, where these are known.

    Keys that are null match nothing. Copies in ``movies`` or ``details`` multiply rows as in
    any left join.
    """
    outlines = details.select(F.col("title").alias("_title"), "plot_outline")
    return (
        answer_questions(qa)
        .join(movies.select("imdb_key", "name", "year", "genre"), "imdb_key", "left")
        .join(outlines, F.col("name") == F.col("_title"), "left")
        .drop("_title", "imdb_key")
        .withColumnsRenamed({"name": "movie_name"})
    )
