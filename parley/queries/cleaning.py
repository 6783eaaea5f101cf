"""Queries for scans, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators import lookup as L
from parley.plans import catalog as C
from parley.plans.records import json_records, truncate_tokens
from parley.queries import tables as T
from parley.queries.tables import SCHEMAS, read, title_case_sql, with_tables
from parley.session import new_path
from parley.sources.readers import split_delimited
from parley.sources.writers import write_with_manifest

QUERIES = {}
ORACLE = {}

def parse_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "conversations").select(
        F.concat_ws(
            " +++$+++ ", F.concat(F.lit("L"), "conv_id"), F.col("turn").cast("string"), "role", "text"
        ).alias("value")
    )
    return split_delimited(raw, "value", ["line_id", "turn", "role", "utterance"])


QUERIES["parse_delimited"] = parse_delimited
ORACLE["parse_delimited"] = """
    SELECT 'L' || conv_id AS line_id, turn::varchar AS turn, role, text AS utterance
    FROM conversations"""


def scan_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", "p_name")


QUERIES["scan_projected"] = scan_projected
ORACLE["scan_projected"] = "SELECT p_partkey, p_name FROM part"


def to_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").withColumn("remark", F.lit(None).cast("string"))
    return docs.select("doc_id", json_records(docs, "doc_id", "text", "lang", "remark").alias("json"))


QUERIES["to_json_records"] = to_json_records
ORACLE["to_json_records"] = """
    SELECT doc_id, to_json({doc_id: doc_id, text: text, lang: lang, remark: NULL})::varchar AS json
    FROM documents"""


def dataset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables are written; what was written is counted and hashed on the way."""
    tables = {name: read(spark, sf_dir, name) for name in SCHEMAS}
    return write_with_manifest(tables, new_path(spark, "dataset")).withColumn(
        "content_hash", F.col("content_hash").cast("string")
    )


def _cell_sql(column: str, kind: str) -> str:
    whole = "round({}::double * 1000000)::bigint"
    if kind == "array<float>":
        text = f"array_to_string(list_transform({column}, lambda x: {whole.format('x')}), ',')"
    else:
        text = f"{whole.format(column) if kind == 'double' else column}::varchar"
    return f"coalesce({text}, '-')"


def _manifest_sql(name: str) -> str:
    columns = [c.split() for c in SCHEMAS[name].split(", ")]
    cells = ", ".join(_cell_sql(*c) for c in columns)
    return f"""SELECT '{name}' AS table_name, count(*) AS n_rows, '{", ".join(c for c, _ in columns)}' AS column_names,
        coalesce(sum(('0x' || substr(md5(concat_ws('|', {cells})), 1, 15))::bigint::hugeint), 0)::varchar AS content_hash
        FROM {name}"""


QUERIES["dataset_manifest"] = dataset_manifest
ORACLE["dataset_manifest"] = " UNION ALL ".join(map(_manifest_sql, SCHEMAS))


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.catalog(spark, sf_dir).where(F.col("release_year").isNotNull()).select(
        "title_id", "movie_name", "release_year"
    )


QUERIES["filter_not_null"] = filter_not_null
ORACLE["filter_not_null"] = with_tables(
    "catalog",
    "SELECT title_id, movie_name, release_year FROM catalog WHERE release_year IS NOT NULL",
)


def dropna_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = read(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") != "system", F.col("text")).alias("utterance"),
        F.nullif(F.col("role"), F.lit("user")).alias("response"),
    )
    return spoken.dropna(subset=["utterance", "response"])


QUERIES["dropna_subset"] = dropna_subset
ORACLE["dropna_subset"] = """
    SELECT conv_id, turn, text AS utterance, role AS response FROM conversations
    WHERE role <> 'system' AND role <> 'user' AND text IS NOT NULL"""


def denylist_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    toxic = read(spark, sf_dir, "labels").where("toxic = 1")
    return L.without(read(spark, sf_dir, "documents"), "doc_id", toxic, "doc_id").select(
        "doc_id", "lang", "source", "n_chars"
    )


QUERIES["denylist_anti"] = denylist_anti
ORACLE["denylist_anti"] = """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"""


def clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    raw = part.select(
        "p_partkey",
        F.concat((F.col("p_size") + 1950).cast("string"), F.lit("/I")).alias("year"),
        (F.col("p_retailprice") / 100).alias("rating"),
        F.when(F.col("p_type") == "PROMO", "[]")
        .otherwise(F.concat(F.lit("['"), "p_type", F.lit("', '"), "p_brand", F.lit("']")))
        .alias("genre"),
    )
    return raw.select(
        "p_partkey",
        X.digits_to_int(F.col("year")).alias("release_year"),
        F.round("rating", 1).alias("imdb_rating"),
        X.quoted_text(F.col("genre")).alias("genre"),
    )


QUERIES["clean_fields"] = clean_fields
ORACLE["clean_fields"] = """
    SELECT p_partkey, p_size + 1950 AS release_year, round(p_retailprice / 100, 1) AS imdb_rating,
           CASE WHEN p_type <> 'PROMO' THEN p_type || ', ' || p_brand END AS genre
    FROM part"""


def clean_url_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select(
        "page_id", X.digits_to_int(F.col("url")).alias("url_number")
    )


QUERIES["clean_url_number"] = clean_url_number
ORACLE["clean_url_number"] = r"""
    SELECT page_id, TRY_CAST(regexp_replace(url, '\D', '', 'g') AS INTEGER) AS url_number
    FROM pages"""


def title_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    spoken = read(spark, sf_dir, "conversations").select(
        F.lit("line").alias("kind"),
        F.concat_ws("_", "conv_id", "turn").alias("item"),
        X.title_case(F.col("text")).alias("title"),
    )
    named = read(spark, sf_dir, "part").select(
        F.lit("part").alias("kind"),
        F.col("p_partkey").cast("string").alias("item"),
        X.title_case(F.col("p_name")).alias("title"),
    )
    return spoken.unionByName(named)


QUERIES["title_case"] = title_case
ORACLE["title_case"] = f"""
    SELECT 'line' AS kind, conv_id || '_' || turn AS item, {title_case_sql('text')} AS title
    FROM conversations
    UNION ALL
    SELECT 'part', p_partkey::varchar, {title_case_sql('p_name')} FROM part"""


def parse_list_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = T.conversation_lists(spark, sf_dir)
    return lists.select(
        "conv_id",
        F.size(X.quoted_items(F.col("line_id_list"))).cast("long").alias("n_items"),
        X.quoted_text(F.col("line_id_list")).alias("quoted"),
        F.array_join(X.list_literal(F.col("line_id_list")), ", ").alias("parsed"),
    )


QUERIES["parse_list_string"] = parse_list_string
ORACLE["parse_list_string"] = """
    SELECT conv_id, count(*) AS n_items,
           string_agg('L' || conv_id || '_' || turn, ', ' ORDER BY turn) AS quoted,
           string_agg('L' || conv_id || '_' || turn, ', ' ORDER BY turn) AS parsed
    FROM conversations GROUP BY conv_id"""


def qa_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        X.item_at(
            F.array("p_brand", "p_type", "p_name"), F.length("p_type") - F.lit(5)
        ).alias("response"),
    )


QUERIES["qa_answer"] = qa_answer
ORACLE["qa_answer"] = """
    SELECT p_partkey, [p_brand, p_type, p_name][length(p_type) - 5 + 1] AS response FROM part"""


def nested_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = F.array(
        F.struct(F.col("o_orderpriority").alias("name")),
        F.struct(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("name")),
        F.struct(F.lit("").alias("name")),
        F.struct(F.concat(F.lit("Clerk "), F.col("o_custkey").cast("string")).alias("name")),
    )
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.array_join(X.present_names(people), ", ").alias("names")
    )


QUERIES["nested_names"] = nested_names
ORACLE["nested_names"] = """
    SELECT o_orderkey,
           array_to_string(list_filter(
               [o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '',
                'Clerk ' || o_custkey], lambda x: x IS NOT NULL AND x <> ''), ', ') AS names
    FROM orders"""


def longest_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") != "en", F.col("lang")).alias("outline"),
        F.col("text").alias("synopsis"),
        F.when(
            F.col("lang") != "de", F.concat(F.lit("a plot as told by "), "source")
        ).alias("plot"),
    )
    return docs.select(
        "doc_id",
        C.outline_or_longest(F.col("outline"), F.col("synopsis"), F.col("plot")).alias("plot_outline"),
    )


QUERIES["longest_of"] = longest_of
ORACLE["longest_of"] = """
    SELECT doc_id,
           CASE WHEN lang <> 'en' THEN lang
                WHEN length(text) >= length('a plot as told by ' || source) THEN text
                ELSE 'a plot as told by ' || source END AS plot_outline
    FROM documents"""


def doc_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("source").alias("movie_name"),
        F.nullif(F.col("lang"), F.lit("es")).alias("genres"),
        F.col("n_chars").alias("votes"),
        F.col("text").alias("synopsis"),
    )
    fields = {"movie_name": "Movie Name", "year": "Year", "votes": "Votes", "genres": "Genre",
              "synopsis": "Synopsis"}
    return docs.select("doc_id", X.labelled_text(docs, fields).alias("full_text"))


QUERIES["doc_template"] = doc_template
ORACLE["doc_template"] = """
    SELECT doc_id, 'Movie Name: ' || source || chr(10) || 'Year: Unknown' || chr(10) ||
           'Votes: ' || n_chars || chr(10) || 'Genre: ' ||
           CASE WHEN lang = 'es' THEN 'Unknown' ELSE lang END || chr(10) ||
           'Synopsis: ' || text AS full_text
    FROM documents"""


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return L.quality_report(
        docs,
        {
            "missing_name": F.coalesce(F.col("source"), F.lit("")) == "",
            "missing_label": F.col("quality").isNull(),
            "toxic": F.col("toxic") == 1,
            "short_text": F.length("text") < 40,
            "wrong_length": F.length("text") != F.col("n_chars"),
        },
    )


QUERIES["quality_report"] = quality_report
ORACLE["quality_report"] = """
    WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)),
         n AS (SELECT count(*) AS n_rows FROM d)
    SELECT n_rows, 'missing_name' AS rule,
           (SELECT count(*) FROM d WHERE coalesce(source, '') = '') AS n_flagged FROM n
    UNION ALL SELECT n_rows, 'missing_label', (SELECT count(*) FROM d WHERE quality IS NULL) FROM n
    UNION ALL SELECT n_rows, 'toxic', (SELECT count(*) FROM d WHERE toxic = 1) FROM n
    UNION ALL SELECT n_rows, 'short_text', (SELECT count(*) FROM d WHERE length(text) < 40) FROM n
    UNION ALL SELECT n_rows, 'wrong_length',
                     (SELECT count(*) FROM d WHERE length(text) <> n_chars) FROM n"""


def patch_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.col("n_name").alias("movie_name"),
        F.col("s_acctbal").alias("rating"),
        F.col("s_suppkey").alias("votes"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("synopsis"),
        F.concat(F.lit("About "), "n_name").alias("plot_outline"),
    )
    filled = rows.withColumn("synopsis", F.coalesce("synopsis", "plot_outline"))
    return L.patch(filled, "movie_name", sample_patches(spark), ["votes", "rating"])


def sample_patches(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("NATION_3", "votes", "31"), ("NATION_3", "rating", "6.8"), ("NATION_4", "votes", "7")],
        "key string, field string, value string",
    )


QUERIES["patch_values"] = patch_values
ORACLE["patch_values"] = """
    SELECT s_suppkey, n_name AS movie_name,
           CASE WHEN n_name = 'NATION_3' THEN 6.8 ELSE s_acctbal END AS rating,
           CASE n_name WHEN 'NATION_3' THEN 31 WHEN 'NATION_4' THEN 7 ELSE s_suppkey END AS votes,
           CASE WHEN s_acctbal > 0 THEN s_name ELSE 'About ' || n_name END AS synopsis,
           'About ' || n_name AS plot_outline
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def alias_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' nations are looked up in a table that spells one of them differently."""
    supplier, nation = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation")
    asked = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey",
        F.col("n_name").alias("movie_name"),
        L.alias_name(F.col("n_name"), {"NATION_7": "Seventh Nation"}).alias("title"),
    )
    outside = nation.select(
        F.when(F.col("n_name") == "NATION_7", "Seventh Nation")
        .otherwise(F.col("n_name")).alias("name"),
        "n_regionkey",
    )
    return L.lookup(asked, "title", outside, "name", "n_regionkey", "region").drop("title")


QUERIES["alias_lookup"] = alias_lookup
ORACLE["alias_lookup"] = """
    SELECT s_suppkey, n_name AS movie_name, n_regionkey AS region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def catalog_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation")

    def side(name: str, key: str, nation_key: str, outline: F.Column) -> DataFrame:
        return (
            read(spark, sf_dir, name)
            .join(nation, F.col(nation_key) == F.col("n_nationkey"))
            .select(
                F.concat(F.lit(f"{name} "), F.col(key).cast("string")).alias("title_id"),
                F.col("n_name").alias("movie_name"),
                F.col(key).cast("string").alias("votes"),
                F.lit("5.5").alias("rating"),
                outline.alias("plot_outline"),
                F.lit(None).cast("string").alias("synopsis"),
                F.concat(F.lit("['"), "n_name", F.lit("', \"It's a drama\"]")).alias("genres"),
            )
        )

    first = side("supplier", "s_suppkey", "s_nationkey",
                 F.when(F.col("s_acctbal") > 0, F.col("s_name")))
    second = side("customer", "c_custkey", "c_nationkey", F.col("c_mktsegment"))
    denied = spark.createDataFrame([("NATION_5",)], "movie_name string")
    changes = spark.createDataFrame(
        [("NATION_6", "plot_outline", "A reel of scenes.")], "key string, field string, value string"
    )
    return C.clean_catalog(first, second, denied, sample_patches(spark), changes)


QUERIES["catalog_clean"] = catalog_clean
ORACLE["catalog_clean"] = """
    SELECT 'supplier ' || s_suppkey AS title_id, n_name AS movie_name,
           CASE n_name WHEN 'NATION_3' THEN 31 WHEN 'NATION_4' THEN 7 ELSE s_suppkey END AS votes,
           CASE WHEN n_name = 'NATION_3' THEN 6.8 ELSE 5.5 END::double AS rating,
           s_name AS plot_outline, s_name AS synopsis, n_name || ', It''s a drama' AS genres
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE s_acctbal > 0 AND n_name <> 'NATION_5'
    UNION ALL
    SELECT 'customer ' || c_custkey, n_name, c_custkey, 5.5::double,
           CASE WHEN n_name = 'NATION_6' THEN 'A reel of scenes.' ELSE c_mktsegment END, NULL,
           n_name || ', It''s a drama'
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def concat_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = read(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_suppkey").cast("string").alias("votes")
    )
    second = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_custkey").alias("votes")
    )
    return L.concat_datasets(first, second, {"votes": "long"})


QUERIES["concat_datasets"] = concat_datasets
ORACLE["concat_datasets"] = """
    SELECT s_name AS name, s_suppkey AS votes FROM supplier
    UNION ALL SELECT c_name, c_custkey FROM customer"""


def truncate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", spread_by="doc_id").select("doc_id", "text")
    return truncate_tokens(docs, "text").select(
        "doc_id",
        F.col("n_tokens").cast("long").alias("n_tokens"),
        F.col("truncated").cast("int").alias("truncated"),
        "kept_text",
    )


QUERIES["truncate_tokens"] = truncate_documents
ORACLE["truncate_tokens"] = r"""
    SELECT doc_id, len(t) AS n_tokens, (len(t) > 1024)::integer AS truncated,
           CASE WHEN len(t) > 1024 THEN array_to_string(t[1:1024], '') ELSE text END AS kept_text
    FROM (SELECT doc_id, text, regexp_extract_all(text, '\s*\S+') AS t FROM documents)"""
