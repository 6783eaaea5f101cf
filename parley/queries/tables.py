"""The domain tables, derived from the driver's Parquet tables.

Each function has its SQL twin in ``SQL``, a set of common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.ordering import ordered_concat
from parley.sources.readers import scan


# The columns of the given tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, name: str, spread_by: str | None = None) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name], spread_by)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select(
        F.concat(F.lit("L"), "conv_id", F.lit("_"), "turn").alias("line_id"),
        F.col("role").alias("character_name"),
        F.col("text").alias("utterance"),
    )


def conversation_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation with its line ids as a list literal."""
    quoted = read(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.lit("'L"), "conv_id", F.lit("_"), "turn", F.lit("'")).alias("item"),
    )
    joined = ordered_concat(quoted, ["conv_id"], "turn", "item", ", ", "items")
    return joined.select(
        "conv_id",
        (F.col("conv_id") % 25).cast("string").alias("movie_id"),
        F.col("conv_id").cast("string").alias("character_id1"),
        (F.col("conv_id") * 20).cast("string").alias("character_id2"),
        F.concat(F.lit("["), "items", F.lit("]")).alias("line_id_list"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("movie_id"),
        F.col("n_name").alias("movie_name"),
        F.concat((F.col("n_nationkey") + 1990).cast("string"), F.lit("/I")).alias("release_year"),
        (F.col("n_nationkey") * 0.25 + 2).alias("imdb_rating"),
        (F.col("n_nationkey") * 100).cast("long").alias("num_imdb_votes"),
        F.concat(F.lit("['"), "r_name", F.lit("', 'DRAMA']")).alias("genre"),
    )


def characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("character_id"),
        F.col("c_name").alias("character_name"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated rows on purpose: one per customer."""
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("movie_name"), F.col("c_mktsegment").alias("plot_outline")
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title catalog from parts; one type stands for a genre that is not known."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("title_id"),
        F.col("p_name").alias("movie_name"),
        F.col("p_brand").alias("character_names"),
        F.when(F.col("p_type") == "PROMO", "Unknown").otherwise(F.col("p_type")).alias("genre"),
        F.when(F.col("p_size") <= 45, F.col("p_size") + 1950).alias("release_year"),
        F.round(F.col("p_retailprice") / 100, 1).alias("imdb_rating"),
        F.col("p_partkey").alias("num_imdb_votes"),
    )


def qa_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per order; the answer index is null for one status, past the end for some."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("question_id"),
        F.concat(F.lit("What is known about order "), "o_orderkey", F.lit("?")).alias("question"),
        F.col("o_custkey").cast("string").alias("imdb_key"),
        F.array("o_orderstatus", "o_orderpriority").alias("answers"),
        F.when(
            F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1).cast("int") - 1
        ).alias("correct_index"),
    )


def qa_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("imdb_key"),
        F.col("c_name").alias("name"),
        (F.col("c_nationkey") + 1980).alias("year"),
        F.col("c_mktsegment").alias("genre"),
    )


def qa_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines are filed under the name of the customer with twice the number, so odd numbers have none."""
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
            F.format_string("Customer#%09d", F.col("c_custkey") * 2).alias("title"),
            F.col("n_name").alias("plot_outline"),
        )
    )


def evaluation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each answer of an assistant against the text of the turn before."""
    turns = read(spark, sf_dir, "conversations", spread_by="conv_id")
    answers = turns.where("role = 'assistant'").select(
        "conv_id", "turn", F.col("text").alias("prediction")
    )
    earlier = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    return answers.join(earlier, ["conv_id", "turn"]).select(
        F.concat_ws("_", "conv_id", "turn").alias("pair_id"), "prediction", "reference"
    )


SQL = {
    "lines": """lines AS (
        SELECT 'L' || conv_id || '_' || turn AS line_id, role AS character_name,
               text AS utterance FROM conversations)""",
    "conversation_lists": """conversation_lists AS (
        SELECT conv_id, (conv_id % 25)::varchar AS movie_id, conv_id::varchar AS character_id1,
               (conv_id * 20)::varchar AS character_id2,
               '[' || string_agg('''L' || conv_id || '_' || turn || '''', ', ' ORDER BY turn)
                   || ']' AS line_id_list
        FROM conversations GROUP BY conv_id)""",
    "titles": """titles AS (
        SELECT n_nationkey::varchar AS movie_id, n_name AS movie_name,
               (n_nationkey + 1990)::varchar || '/I' AS release_year,
               n_nationkey * 0.25::double + 2 AS imdb_rating,
               (n_nationkey * 100)::bigint AS num_imdb_votes,
               '[''' || r_name || ''', ''DRAMA'']' AS genre
        FROM nation JOIN region ON n_regionkey = r_regionkey)""",
    "clean_titles": """clean_titles AS (
        SELECT movie_id, movie_name,
               TRY_CAST(regexp_replace(release_year, '[^0-9]', '', 'g') AS INTEGER) AS release_year,
               round(imdb_rating, 1) AS imdb_rating, num_imdb_votes,
               nullif(array_to_string(regexp_extract_all(genre, '''(.*?)''', 1), ', '), '') AS genre
        FROM titles)""",
    "characters": """characters AS (
        SELECT c_custkey::varchar AS character_id, c_name AS character_name FROM customer)""",
    "details": """details AS (
        SELECT n_name AS movie_name, c_mktsegment AS plot_outline
        FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "catalog": """catalog AS (
        SELECT p_partkey AS title_id, p_name AS movie_name, p_brand AS character_names,
               CASE WHEN p_type = 'PROMO' THEN 'Unknown' ELSE p_type END AS genre,
               CASE WHEN p_size <= 45 THEN p_size + 1950 END AS release_year,
               round(p_retailprice / 100, 1) AS imdb_rating, p_partkey AS num_imdb_votes
        FROM part)""",
    "qa_questions": """qa_questions AS (
        SELECT o_orderkey AS question_id,
               'What is known about order ' || o_orderkey || '?' AS question,
               o_custkey::varchar AS imdb_key, [o_orderstatus, o_orderpriority] AS answers,
               CASE WHEN o_orderstatus <> 'P' THEN substr(o_orderpriority, 1, 1)::integer - 1 END
                   AS correct_index
        FROM orders)""",
    "qa_movies": """qa_movies AS (
        SELECT c_custkey::varchar AS imdb_key, c_name AS name, c_nationkey + 1980 AS year,
               c_mktsegment AS genre FROM customer)""",
    "qa_details": """qa_details AS (
        SELECT 'Customer#' || lpad((c_custkey * 2)::varchar, 9, '0') AS title, n_name AS plot_outline
        FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
    "evaluation_pairs": """evaluation_pairs AS (
        SELECT a.conv_id || '_' || a.turn AS pair_id, a.text AS prediction, b.text AS reference
        FROM conversations a JOIN conversations b
          ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
        WHERE a.role = 'assistant')""",
}


def with_tables(names: str, body: str, *more: str) -> str:
    """``body`` behind the named table expressions and any further ones."""
    return "WITH " + ",\n".join([*(SQL[n] for n in names.split()), *more]) + "\n" + body


def title_case_sql(text: str) -> str:
    """Upper-case the first letter of each run of letters in SQL.

    SQL has no title case; the one letter of the test texts whose title case is not its upper
    case is spelt out.
    """
    return (
        "array_to_string(list_transform(regexp_extract_all("
        f"{text}, '(\\p{{L}}+|\\P{{L}}+)'), "
        "lambda p: CASE p[1] WHEN 'ß' THEN 'Ss' ELSE upper(p[1]) END || lower(p[2:])), '')"
    )
