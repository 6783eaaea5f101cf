"""Cleaning and enriching the title catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators.lookup import (
    alias_name,
    best_candidate,
    concat_datasets,
    not_found,
    patch,
    without,
)

# Columns that hold a list literal and become plain text.
LIST_FIELDS = ("genres", "languages", "director", "writer", "cast", "character_names")


def list_fields_to_text(df: DataFrame, fields: Sequence[str] = LIST_FIELDS) -> DataFrame:
    """Turn list literals into comma-joined text; empty and null values stay as they are."""
    joined = {
        f: F.when(
            F.length(f) > 0, F.array_join(X.list_literal(F.col(f)), ", ")
        ).otherwise(F.col(f))
        for f in fields
        if f in df.columns
    }
    return df.withColumns(joined) if joined else df


def clean_catalog(
    first: DataFrame,
    second: DataFrame,
    denied: DataFrame,
    first_patches: DataFrame,
    second_patches: DataFrame,
    patched: Sequence[str] = ("votes", "rating", "plot_outline"),
) -> DataFrame:
    """Filter and repair the first catalog, patch the second, append them, join list fields.

    Rows of the first without an outline or with a denied name go; a missing synopsis is
    taken from the outline.
    """
    kept = without(first.where(F.col("plot_outline").isNotNull()), "movie_name", denied, "movie_name")
    repaired = patch(
        kept.withColumn("synopsis", F.coalesce("synopsis", "plot_outline")),
        "movie_name",
        first_patches,
        patched,
    )
    other = patch(second, "movie_name", second_patches, patched)
    return list_fields_to_text(
        concat_datasets(repaired, other, {"votes": "long", "rating": "double"})
    )


def outline_or_longest(outline: Column, synopsis: Column, plot: Column) -> Column:
    """An empty outline is replaced by the longer of synopsis and plot, if there are both."""
    missing = F.coalesce(outline, F.lit("")) == ""
    both = (F.coalesce(synopsis, F.lit("")) != "") & (F.coalesce(plot, F.lit("")) != "")
    return F.when(missing & both, X.longest(synopsis, plot)).otherwise(outline)


def enrich_catalog(
    titles: DataFrame,
    candidates: DataFrame,
    payload: Sequence[str],
    aliases: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Look up each title in a candidate table; returns ``(found, missing)``.

    ``titles`` has ``title_id, movie_name, release_year``; candidates have ``title, year,
    cand_rank`` and the payload columns. Outlines are completed and people lists reduced to
    names where the payload has these columns.
    """
    asked = titles.select(
        "title_id",
        "movie_name",
        alias_name(F.col("movie_name"), aliases or {}).alias("title"),
        F.col("release_year").alias("year"),
    )
    hits = best_candidate(asked, candidates, payload)
    missing = not_found(titles, hits, "title_id")
    found = hits.drop("title", "year")
    if {"plot_outline", "synopsis", "plot"} <= set(payload):
        found = found.withColumn(
            "plot_outline",
            outline_or_longest(F.col("plot_outline"), F.col("synopsis"), F.col("plot")),
        )
    for people in ("director", "writer", "cast"):
        if people in payload:
            found = found.withColumn(people, X.present_names(F.col(people)))
    return found, missing
