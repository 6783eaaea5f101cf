"""Round trips: tables written by the writers and read back by the readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.queries import tables as T
from parley.queries.tables import read
from parley.session import new_path
from parley.sources.readers import SEPARATOR, TableSpec, read_table, read_tables
from parley.sources.writers import write_json_array, write_table

QUERIES = {}
ORACLE = {}

_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted texts with line breaks, found by their extension and read by many tasks."""
    docs = read(spark, sf_dir, "documents")
    path = f"{new_path(spark, 'files')}/documents.csv"
    write_table(docs, path, "csv")
    return read_table(spark, TableSpec(path, docs.schema))


QUERIES["csv_round_trip"] = csv_round_trip
ORACLE["csv_round_trip"] = _DOCUMENTS


def csv_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some columns of a file with a header line."""
    part = read(spark, sf_dir, "part")
    path = f"{new_path(spark, 'files')}/part.csv"
    write_table(part, path, "csv")
    return read_table(spark, TableSpec(path, part.schema, columns=("p_partkey", "p_retailprice")))


QUERIES["csv_projected"] = csv_projected
ORACLE["csv_projected"] = "SELECT p_partkey, p_retailprice FROM part"


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of JSON Lines files, with lists."""
    vectors = read(spark, sf_dir, "embeddings")
    path = f"{new_path(spark, 'files')}/embeddings"
    write_table(vectors, path, "json")
    back = read_tables(spark, {"embeddings": TableSpec(path, vectors.schema, "json")}, ["embeddings"])["embeddings"]
    return back.select("vec_id", "label", F.posexplode("embedding").alias("slot", "x")).select(
        "vec_id", "label", "slot", F.round(F.col("x").cast("double"), 6).alias("x")
    )


QUERIES["json_round_trip"] = json_round_trip
ORACLE["json_round_trip"] = """
    SELECT vec_id, label, unnest(range(0, len(embedding)))::integer AS slot, round(unnest(embedding)::double, 6) AS x
    FROM embeddings"""


def json_array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of objects, one a file, found by their extension and read by many tasks."""
    turns = read(spark, sf_dir, "conversations")
    path = f"{new_path(spark, 'files')}/conversations.json"
    write_json_array(turns, path)
    return read_table(spark, TableSpec(path, turns.schema))


QUERIES["json_array_round_trip"] = json_array_round_trip
ORACLE["json_array_round_trip"] = "SELECT conv_id, turn, role, text FROM conversations"


def delimited_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialogue lines as the raw files have them: a long separator, Latin-1, no quotes."""
    lines = T.lines(spark, sf_dir).withColumn("utterance", F.regexp_replace("utterance", r"\s+", " "))
    path = f"{new_path(spark, 'files')}/lines.txt"
    # Latin-1 as bytes: each sign of the text is one byte, which UTF-8 text files can't hold.
    options = {"sep": SEPARATOR, "quote": "", "header": "false", "encoding": "ISO-8859-1"}
    lines.write.mode("overwrite").options(**options).csv(path)
    return read_table(spark, TableSpec(path, lines.schema))


QUERIES["delimited_round_trip"] = delimited_round_trip
ORACLE["delimited_round_trip"] = r"""
    SELECT 'L' || conv_id || '_' || turn AS line_id, role AS character_name,
           regexp_replace(text, '\s+', ' ', 'g') AS utterance FROM conversations"""
