"""Instruction records, prompts and token limits."""

from __future__ import annotations

from collections.abc import Mapping
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.plans.dialogue import DIALOGUE_INSTRUCTION
from parley.plans.qa import QA_INSTRUCTION

JSON_OPTIONS = {"ignoreNullFields": "false"}

# Stated choice: the wording of a training prompt is a parameter, this is its default.
PROMPT_TEMPLATE = (
    "### Instruction:\n{instruction}\n\n### Context:\n{context}\n\n"
    "### Input:\n{input}\n\n### Response:\n{response}"
)
CONTEXT_LABELS = {
    "movie_name": "Movie",
    "character_names": "Characters",
    "genre": "Genre",
    "year": "Year",
    "imdb_rating": "Rating",
    "num_imdb_votes": "Votes",
    "plot_outline": "Plot",
}


def to_instruction_rows(df: DataFrame, kind: str, on_null: str = "keep", *keep: str) -> DataFrame:
    """Rows of ``split, type, instruction, input, context, response``.

    ``kind`` is ``dialogue`` or ``qa``; a qa context has no characters, rating and votes.
    A column that ``df`` lacks becomes its default; nulls only with ``on_null="default"``.
    """
    if kind not in ("dialogue", "qa"):
        raise ValueError("kind is 'dialogue' or 'qa'")

    def value(name: str, default: object, target: str) -> Column:
        return X.field_or(df, name, default, on_null).cast(target)

    context = [value("movie_name", "Unknown", "string").alias("movie_name")]
    if kind == "dialogue":
        context += [
            value("character_names", "Unknown", "string").alias("character_names"),
            value("genre", "", "string").alias("genre"),
            value("release_year", None, "int").alias("year"),
            value("imdb_rating", 0, "double").alias("imdb_rating"),
            value("num_imdb_votes", 0, "long").alias("num_imdb_votes"),
        ]
        question, instruction = "utterance", X.field_or(
            df, "instruction", DIALOGUE_INSTRUCTION, on_null
        )
    else:
        context += [
            value("genre", "Unknown", "string").alias("genre"),
            value("year", None, "int").alias("year"),
        ]
        question, instruction = "question", F.lit(QA_INSTRUCTION)
    context += [
        value("plot_outline", "Unknown", "string").alias("plot_outline"),
        F.lit(None).cast("string").alias("additional_information"),
    ]
    return df.select(
        *keep,
        value("split", "train", "string").alias("split"),
        F.lit(kind).alias("type"),
        instruction.alias("instruction"),
        value(question, "", "string").alias("input"),
        F.struct(*context).alias("context"),
        value("response", "Unknown", "string").alias("response"),
    )


def combine(*records: DataFrame) -> DataFrame:
    """Append record tables; fields that one lacks, also inside ``context``, are null."""
    first, *rest = records
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def json_records(df: DataFrame, *columns: str) -> Column:
    """A row, or some of its columns, as one JSON object; null fields are kept."""
    return F.to_json(F.struct(*(columns or df.columns)), JSON_OPTIONS)


def context_text(df: DataFrame, labels: Mapping[str, str] = CONTEXT_LABELS) -> Column:
    """Known context fields, one labelled line each."""
    known = df.schema["context"].dataType.fieldNames()
    return F.concat_ws(
        "\n",
        *[
            F.concat(F.lit(f"{label}: "), F.col(f"context.{name}").cast("string"))
            for name, label in labels.items()
            if name in known
        ],
    )


def format_prompt(
    df: DataFrame, template: str = PROMPT_TEMPLATE, eos: str = "</s>", split: str | None = None
) -> DataFrame:
    """Records to one ``text`` column; the six source columns are dropped."""
    rows = df if split is None else df.where(F.col("split") == split)
    values = {n: F.coalesce(F.col(n), F.lit("")) for n in ("instruction", "input", "response")}
    values["context"] = context_text(df)
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name])
    return rows.withColumn("text", F.concat(*parts, F.lit(eos))).drop(
        "split", "type", "instruction", "input", "context", "response"
    )


def training_texts(
    records: DataFrame, template: str = PROMPT_TEMPLATE, eos: str = "</s>", limit: int = 1024
) -> dict[str, DataFrame]:
    """``train`` and ``val`` prompts, cut to ``limit`` tokens.

    On a table partitioned by split, each of the two reads its own files only.
    """
    return {
        split: truncate_tokens(format_prompt(records, template, eos, split), "text", limit)
        for split in ("train", "val")
    }


def truncate_tokens(df: DataFrame, text: str, limit: int = 1024) -> DataFrame:
    """Cut a text after its ``limit``-th token; adds the token count and whether any was cut off.

    White space before and between the kept tokens stays as it is, and so does a text that is
    not cut. Each step below is a token with the white space before it.
    """
    return (
        df.withColumn("_tokens", F.regexp_extract_all(F.col(text), F.lit(r"\s*\S+"), F.lit(0)))
        .withColumns(
            {
                "n_tokens": F.size("_tokens"),
                "truncated": F.size("_tokens") > limit,
                "kept_text": F.when(
                    F.size("_tokens") > limit, F.array_join(F.slice("_tokens", 1, limit), "")
                ).otherwise(F.col(text)),
            }
        )
        .drop("_tokens")
    )
