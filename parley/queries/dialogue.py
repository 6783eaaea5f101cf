"""Queries over the dialogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.plans import dialogue as D
from parley.queries import tables as T
from parley.queries.tables import title_case_sql, with_tables

QUERIES = {}
ORACLE = {}


def dialogue_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = D.clean_conversations(T.conversation_lists(spark, sf_dir))
    lines = D.clean_lines(T.lines(spark, sf_dir))
    stitched = D.stitch(D.spoken_lines(conversations, lines))
    return stitched.select(
        "conv_id", F.lit(D.DIALOGUE_INSTRUCTION).alias("instruction"), "input", "response", "n_turns"
    )


QUERIES["dialogue_stitch"] = dialogue_stitch
SPOKEN_SQL = f"""spoken AS (
        SELECT conv_id, turn, {title_case_sql('role')} || ': ' || text AS utterance
        FROM conversations WHERE text IS NOT NULL)"""
STITCHED_SQL = """stitched AS (
        SELECT conv_id,
               CASE WHEN len(u) > 1 THEN array_to_string(u[1:len(u) - 1], chr(10) || ' ')
                    ELSE u[1] END AS input,
               u[len(u)] AS response, len(u) AS n_turns
        FROM (SELECT conv_id, list(utterance ORDER BY turn) AS u FROM spoken GROUP BY conv_id))"""
ORACLE["dialogue_stitch"] = f"""WITH {SPOKEN_SQL}, {STITCHED_SQL}
    SELECT conv_id, '{D.DIALOGUE_INSTRUCTION}' AS instruction, input, response, n_turns
    FROM stitched"""


def dialogue_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.build_dialogue(
        D.clean_conversations(T.conversation_lists(spark, sf_dir)),
        D.clean_lines(T.lines(spark, sf_dir)),
        D.clean_titles(T.titles(spark, sf_dir)),
        D.clean_characters(T.characters(spark, sf_dir)),
        T.details(spark, sf_dir),
    )


QUERIES["dialogue_dataset"] = dialogue_rows
DIALOGUE_TABLES = "titles clean_titles characters conversation_lists details"
DIALOGUE_SQL = (
    SPOKEN_SQL,
    STITCHED_SQL,
    f"""heads AS (
        SELECT c.conv_id,
               {title_case_sql('a.character_name')} || ', ' || {title_case_sql('b.character_name')}
                   AS character_names,
               t.movie_name, t.release_year, t.imdb_rating, t.num_imdb_votes, t.genre
        FROM conversation_lists c JOIN clean_titles t USING (movie_id)
        JOIN characters a ON a.character_id = c.character_id1
        LEFT JOIN characters b ON b.character_id = c.character_id2)""",
    f"""dialogue AS (
        SELECT min(conv_id) AS conv_id, character_names, movie_name, release_year, imdb_rating,
               num_imdb_votes, genre, s.input AS utterance, s.response, d.plot_outline,
               '{D.DIALOGUE_INSTRUCTION}' AS instruction
        FROM heads JOIN stitched s USING (conv_id) LEFT JOIN details d USING (movie_name)
        GROUP BY ALL)""",
)
ORACLE["dialogue_dataset"] = with_tables(DIALOGUE_TABLES, "SELECT * FROM dialogue", *DIALOGUE_SQL)
