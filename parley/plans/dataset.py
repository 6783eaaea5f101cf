"""The whole dataset job: raw tables to one split, combined record set."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.operators.lookup import prune_rare
from parley.operators.ordering import number_copies
from parley.operators.split import stratified_split
from parley.plans import dialogue as D
from parley.plans.augment import augment
from parley.plans.qa import build_qa
from parley.plans.records import combine, to_instruction_rows
from parley.session import SEED, materialise
from parley.sources.writers import write_records


@dataclass(frozen=True)
class DatasetConfig:
    """Shares and thresholds of both data sets."""

    sample_fraction: float = 0.2
    generate_new_questions: bool = True
    data_prune_enabled: bool = True
    dialogue_min_rows: int = 60
    dialogue_train: float = 0.7
    dialogue_test: float = 0.297
    qa_min_rows: int = 50
    qa_train: float = 0.8
    qa_test: float = 0.195
    seed: int = SEED


DIALOGUE_TABLES = (
    "movie_conversations",
    "movie_lines",
    "movie_titles_metadata",
    "movie_characters_metadata",
    "movie_details",
)
QA_TABLES = ("qa", "movies", "qa_details")


def number_conversations(conversations: DataFrame) -> DataFrame:
    """Add ``conv_id``: an md5 of the row, so that it is the same in every run.

    Equal rows are one conversation; the later removal of equal records would merge them.
    """
    return conversations.distinct().withColumn(
        "conv_id", F.md5(F.to_json(F.struct(*conversations.columns)))
    )


def dialogue_records(tables: Mapping[str, DataFrame], config: DatasetConfig) -> DataFrame:
    """Clean, join, stitch, augment, prune and split the dialogue tables."""
    conversations, lines, titles, characters, details = (tables[t] for t in DIALOGUE_TABLES)
    base = materialise(
        D.build_dialogue(
            D.clean_conversations(number_conversations(conversations)),
            D.clean_lines(lines),
            D.clean_titles(titles),
            D.clean_characters(characters),
            details,
        )
    )
    rows = augment(
        base, "conv_id", config.sample_fraction, seed=config.seed,
        enabled=config.generate_new_questions,
    )
    if config.data_prune_enabled:
        rows = prune_rare(rows, "movie_name", config.dialogue_min_rows)
    row_key = rows.withColumn(
        "row_key", F.md5(F.concat_ws("\x1f", "conv_id", "utterance", "response", "plot_outline"))
    )
    split = stratified_split(
        row_key, "movie_name", ["row_key"], config.dialogue_train, config.dialogue_test, config.seed
    )
    return to_instruction_rows(split, "dialogue")


def qa_records(tables: Mapping[str, DataFrame], config: DatasetConfig) -> DataFrame:
    """Answer, join, prune and split the question tables.

    Equal rows have no key that tells them apart; their copy number becomes part of it. The joined rows and
    the numbered ones are written once each, as they are counted before they are used.
    """
    rows = materialise(build_qa(*(tables[t] for t in QA_TABLES)))
    kept = prune_rare(rows, "movie_name", config.qa_min_rows)
    numbered = materialise(
        number_copies(kept, "copy").withColumn(
            "row_key", F.md5(F.concat_ws("\x1f", F.to_json(F.struct(*kept.columns)), "copy"))
        )
    )
    split = stratified_split(
        numbered, "movie_name", ["row_key"], config.qa_train, config.qa_test, config.seed
    )
    return to_instruction_rows(split, "qa")


def run_pipeline(
    tables: Mapping[str, DataFrame], out: str, config: DatasetConfig | None = None
) -> DataFrame:
    """Build both record sets, write them as one partitioned table and return it."""
    config = config or DatasetConfig()
    missing = [t for t in (*DIALOGUE_TABLES, *QA_TABLES) if t not in tables]
    if missing:
        raise ValueError(f"tables missing: {', '.join(missing)}")
    records = combine(dialogue_records(tables, config), qa_records(tables, config))
    write_records(records, out)
    return records.sparkSession.read.schema(records.schema).parquet(out)
