"""Queries for joins, aggregates, sampling, splitting and record building."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import lookup as L
from parley.operators import split as S
from parley.plans import augment as A
from parley.plans import catalog as C
from parley.plans import qa as Q
from parley.plans import records as R
from parley.plans.dataset import DatasetConfig, run_pipeline
from parley.plans.dialogue import DIALOGUE_INSTRUCTION
from parley.queries import tables as T
from parley.queries.dialogue import DIALOGUE_SQL, DIALOGUE_TABLES, dialogue_rows
from parley.queries.tables import read, with_tables
from parley.session import new_path

QUERIES = {}
ORACLE = {}


def enrich_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    region = read(spark, sf_dir, "region").withColumnsRenamed({"r_regionkey": "n_regionkey"})
    return (
        customer.withColumnsRenamed({"c_nationkey": "n_nationkey", "c_name": "character_name1"})
        .join(nation, "n_nationkey")
        .join(region, "n_regionkey")
        .drop("n_nationkey", "n_regionkey", "c_acctbal")
        .withColumnsRenamed({"n_name": "movie_name", "r_name": "genre"})
    )


QUERIES["enrich_inner"] = enrich_inner
ORACLE["enrich_inner"] = """
    SELECT c_custkey, c_name AS character_name1, c_mktsegment, n_name AS movie_name, r_name AS genre
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""


def lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the customers with twice the number, where there is one; a repeated dimension does not fan out."""
    customer = read(spark, sf_dir, "customer")
    twice = customer.unionByName(customer)
    return L.lookup(
        read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("doubled")),
        "doubled", twice, "c_custkey", "c_name", "character_name2",
    )


QUERIES["lookup_left"] = lookup_left
ORACLE["lookup_left"] = """
    SELECT o_orderkey, o_custkey * 2 AS doubled, c_name AS character_name2
    FROM orders LEFT JOIN customer ON o_custkey * 2 = c_custkey"""


def left_fanout_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers above 4 are in no name of the other side, as sizes are taken modulo 5."""
    part = read(spark, sf_dir, "part")
    sold = (
        read(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.concat_ws(" ", "p_name", "l_linenumber").alias("movie_name"), "l_returnflag")
    )
    kinds = part.select(
        F.concat_ws(" ", "p_name", F.col("p_size") % 5).alias("movie_name"),
        F.col("p_type").alias("plot_outline"),
    )
    return L.left_distinct(sold, kinds, "movie_name")


QUERIES["left_fanout_dedup"] = left_fanout_dedup
ORACLE["left_fanout_dedup"] = """
    SELECT DISTINCT a.movie_name, l_returnflag, b.p_type AS plot_outline
    FROM (SELECT DISTINCT p_name || ' ' || l_linenumber AS movie_name, l_returnflag
          FROM lineitem JOIN part ON l_partkey = p_partkey) a
    LEFT JOIN (SELECT DISTINCT p_name || ' ' || (p_size % 5) AS name, p_type FROM part) b
      ON a.movie_name = b.name"""


def qa_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part with half a line's part number, the supplier's name, and an outline found by that name.

    Outlines are filed under the name of the supplier with twice the number, so odd numbers have none.
    """
    line = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    supplier = read(spark, sf_dir, "supplier")
    part = read(spark, sf_dir, "part").select((F.col("p_partkey") * 2).alias("p_partkey"), "p_name")
    outlines = supplier.select(
        F.format_string("Supplier#%09d", F.col("s_suppkey") * 2).alias("title"),
        F.concat(F.lit("Held by "), "s_name").alias("plot_outline"),
    )
    return (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(outlines, F.col("s_name") == F.col("title"), "left")
        .drop("title", "p_partkey", "l_suppkey", "s_suppkey")
        .withColumnsRenamed({"s_name": "movie_name"})
    )


QUERIES["qa_enrich"] = qa_enrich
ORACLE["qa_enrich"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name, s.s_name AS movie_name,
           'Held by ' || o.s_name AS plot_outline
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey * 2
    LEFT JOIN supplier s ON l_suppkey = s.s_suppkey
    LEFT JOIN supplier o ON s.s_name = 'Supplier#' || lpad((o.s_suppkey * 2)::varchar, 9, '0')"""


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("title_id"),
        F.col("p_name").alias("movie_name"),
        F.when(F.col("p_size") <= 40, F.col("p_size") + 1950).alias("release_year"),
    )


def _offered(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") > 2, F.col("p_size") + 1953).alias("year"),
        F.col("p_partkey").alias("cand_rank"),
        F.col("p_partkey").alias("cand_id"),
        F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("plot_outline"),
        F.col("p_brand").alias("synopsis"),
        F.col("p_name").alias("plot"),
        F.array(
            F.struct(F.col("p_brand").alias("name")), F.struct(F.lit("").alias("name"))
        ).alias("director"),
    )


_PAYLOAD = ["cand_id", "plot_outline", "synopsis", "plot", "director"]
_FOUND_SQL = """asked AS (
        SELECT p_partkey AS title_id, p_name AS movie_name,
               CASE WHEN p_size <= 40 THEN p_size + 1950 END AS release_year FROM part),
    offered AS (
        SELECT *, p_partkey AS cand_id, CASE WHEN p_size > 2 THEN p_size + 1953 END AS year
        FROM part),
    found AS (
        SELECT title_id, movie_name, release_year, cand_id, plot_outline FROM (
            SELECT a.*, cand_id,
                   CASE WHEN p_type <> 'PROMO' THEN p_type
                        WHEN length(p_brand) >= length(p_name) THEN p_brand
                        ELSE p_name END AS plot_outline,
                   p_brand AS director,
                   row_number() OVER (PARTITION BY title_id ORDER BY cand_id) AS r
            FROM asked a JOIN offered o ON o.p_name = a.movie_name
             AND (a.release_year IS NULL OR a.release_year = o.year)) WHERE r = 1)"""


def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _asked(spark, sf_dir).withColumnsRenamed({"movie_name": "title", "release_year": "year"})
    return L.best_candidate(asked, _offered(spark, sf_dir), ["cand_id"])


QUERIES["best_candidate"] = best_candidate
ORACLE["best_candidate"] = f"""WITH {_FOUND_SQL}
    SELECT title_id, movie_name AS title, release_year AS year, cand_id FROM found"""


def enrich_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = C.enrich_catalog(_asked(spark, sf_dir), _offered(spark, sf_dir), _PAYLOAD)
    return found.select("title_id", "movie_name", "cand_id", "plot_outline",
                        F.array_join("director", ", ").alias("director"))


QUERIES["enrich_catalog"] = enrich_catalog
ORACLE["enrich_catalog"] = f"""WITH {_FOUND_SQL}
    SELECT title_id, movie_name, cand_id, plot_outline, p_brand AS director
    FROM found JOIN part ON cand_id = p_partkey"""


def not_found_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.enrich_catalog(_asked(spark, sf_dir), _offered(spark, sf_dir), _PAYLOAD)[1]


QUERIES["not_found_anti"] = not_found_anti
ORACLE["not_found_anti"] = f"""WITH {_FOUND_SQL}
    SELECT * FROM asked WHERE title_id NOT IN (SELECT title_id FROM found)"""


def entity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = L.entity_rollup(
        T.catalog(spark, sf_dir), "movie_name", "title_id",
        ["character_names", "genre", "release_year", "num_imdb_votes"], ["imdb_rating"],
    )
    return rolled.withColumn("imdb_rating", F.round("imdb_rating", 6))


ROLLUP_SQL = """rollup_rows AS (
        SELECT movie_name,
               first(character_names ORDER BY title_id) AS character_names,
               first(genre ORDER BY title_id) AS genre,
               first(release_year ORDER BY title_id) FILTER (WHERE release_year IS NOT NULL)
                   AS release_year,
               first(num_imdb_votes ORDER BY title_id) AS num_imdb_votes,
               avg(imdb_rating) AS imdb_rating
        FROM catalog GROUP BY movie_name)"""
QUERIES["entity_rollup"] = entity_rollup
ORACLE["entity_rollup"] = with_tables(
    "catalog",
    "SELECT * REPLACE (round(imdb_rating, 6) AS imdb_rating) FROM rollup_rows",
    ROLLUP_SQL,
)


def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").withColumn(
        "year", F.concat((F.col("p_size") + 1950).cast("string"), F.lit("/I"))
    )
    return L.distinct_titles(part, "p_name", "year")


QUERIES["distinct_pairs"] = distinct_pairs
ORACLE["distinct_pairs"] = """
    SELECT DISTINCT p_name AS movie_name, p_size + 1950 AS release_year FROM part"""


def prune_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers with more than 10 orders, which is the mean at every scale."""
    return L.prune_rare(read(spark, sf_dir, "orders"), "o_custkey", 10).select(
        "o_orderkey", "o_custkey"
    )


QUERIES["prune_frequent"] = prune_frequent
ORACLE["prune_frequent"] = """
    SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (
        SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 10)"""


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.assign_batches(read(spark, sf_dir, "documents").select("doc_id"), 50, ["doc_id"])


QUERIES["batch_assign"] = batch_assign
ORACLE["batch_assign"] = """
    SELECT doc_id,
           (row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1) // 50 + 1 AS batch_no
    FROM documents"""


def sample_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.sample_fraction(
        read(spark, sf_dir, "part").select("p_partkey", "p_name"), 0.2, ["p_partkey"]
    )


QUERIES["sample_fraction"] = sample_fraction
ORACLE["sample_fraction"] = """
    SELECT p_partkey, p_name FROM (
        SELECT *, row_number() OVER (ORDER BY md5(p_partkey || ':42'), p_partkey) AS r,
               count(*) OVER () AS n FROM part)
    WHERE r <= round_even(n * 0.2::double, 0)"""


def question_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = A.generate_questions(T.catalog(spark, sf_dir), "title_id")
    return asked.select("title_id", "utterance", "response", "instruction")


def _questions_sql(source: str, key: str) -> str:
    """One branch per attribute; the wordings are picked by md5 in SQL as well."""
    branches = []
    for kind, wordings in A.TEMPLATES.items():
        options = ", ".join("'" + w.replace("'", "''") + "'" for w in wordings)
        number = f"('0x' || substr(md5({key} || ':{kind}:42'), 1, 8))::bigint % {len(wordings)}"
        branches.append(
            f"SELECT *, replace(([{options}])[{number} + 1], '{{movie_name}}', movie_name) AS utterance, "
            f"{kind}::varchar AS response, '{Q.QA_INSTRUCTION}' AS instruction FROM {source} "
            f"WHERE {kind} IS NOT NULL AND {kind}::varchar <> 'Unknown'"
        )
    return " UNION ALL ".join(branches)


QUERIES["question_templates"] = question_templates
ORACLE["question_templates"] = with_tables(
    "catalog",
    "SELECT title_id, utterance, response, instruction FROM questions",
    f"questions AS ({_questions_sql('catalog', 'title_id')})",
)


def augment_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = T.catalog(spark, sf_dir).select(
        "*",
        F.concat(F.lit("About "), "movie_name").alias("utterance"),
        F.col("title_id").alias("response"),
        F.lit("Continue.").alias("instruction"),
    )
    return A.augment(base, "title_id").withColumn("imdb_rating", F.round("imdb_rating", 6))


QUERIES["augment_union"] = augment_union
ORACLE["augment_union"] = with_tables(
    "catalog",
    """SELECT title_id, movie_name, character_names, genre, release_year,
              round(imdb_rating, 6) AS imdb_rating, num_imdb_votes,
              'About ' || movie_name AS utterance, title_id::varchar AS response,
              'Continue.' AS instruction FROM catalog
       UNION ALL
       SELECT NULL, movie_name, character_names, genre, release_year, round(imdb_rating, 6),
              num_imdb_votes, utterance, response, instruction FROM questions""",
    ROLLUP_SQL,
    """picked AS (
        SELECT * EXCLUDE (r, n) REPLACE (round(imdb_rating, 6) AS imdb_rating) FROM (
            SELECT *, row_number() OVER (ORDER BY md5(movie_name || ':42'), movie_name) AS r,
                   count(*) OVER () AS n FROM rollup_rows)
        WHERE r <= round_even(n * 0.2::double, 0))""",
    f"questions AS ({_questions_sql('picked', 'movie_name')})",
)


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return S.stratified_split(docs, "source", ["doc_id"], 0.7, 0.297)


def split_sql(rows: str, key: str, row_key: str, train: float, test: float) -> str:
    """Tables ``..split_rows``: the two-stage largest remainder split of ``rows`` in SQL."""
    def quota(source: str, size: str, target: str, out: str, rank: str) -> str:
        return f"""{out}_base AS (
            SELECT *, ({size}::hugeint * {target} // greatest(sum({size}) OVER (), 1))::bigint AS b,
                   ({size}::hugeint * {target} % greatest(sum({size}) OVER (), 1)) AS rest,
                   {target} AS t FROM {source}),
        {out} AS (
            SELECT * EXCLUDE (b, rest, t),
                   b + (row_number() OVER (ORDER BY rest DESC, {size}, md5({key} || ':42'), {key})
                        <= t - sum(b) OVER ())::integer AS {rank}
            FROM {out}_base)"""

    return f"""kept_rows AS (SELECT * FROM {rows} WHERE {key} IS NOT NULL),
        strata AS (SELECT {key}, count(*) AS n FROM kept_rows GROUP BY {key}),
        targets AS (SELECT floor(sum(n) * {train}::double)::bigint AS tr,
                           floor(sum(n) * {test}::double)::bigint AS te FROM strata),
        {quota('strata', 'n', '(SELECT tr FROM targets)', 'train_quota', 'tq')},
        remaining AS (SELECT *, (n - tq)::bigint AS left_over FROM train_quota),
        {quota('remaining', 'left_over', '(SELECT te FROM targets)', 'test_quota', 'eq')},
        split_rows AS (
            SELECT r.* EXCLUDE (rn),
                   CASE WHEN rn <= tq THEN 'train' WHEN rn <= tq + eq THEN 'test' ELSE 'val' END AS split
            FROM (SELECT *, row_number() OVER (PARTITION BY {key}
                         ORDER BY md5({row_key} || ':42'), {row_key}) AS rn FROM kept_rows) r
            JOIN test_quota USING ({key}))"""


QUERIES["stratified_split"] = split_documents
_SPLIT_SQL = split_sql("documents", "source", "doc_id", 0.7, 0.297)
ORACLE["stratified_split"] = f"WITH {_SPLIT_SQL} SELECT doc_id, source, split FROM split_rows"


def split_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return S.stratified_split(part, "p_name", ["p_partkey"], 0.8, 0.195)


QUERIES["stratified_split_parts"] = split_parts
_PARTS_SQL = split_sql("part", "p_name", "p_partkey", 0.8, 0.195)
ORACLE["stratified_split_parts"] = f"WITH {_PARTS_SQL} SELECT p_partkey, p_name, split FROM split_rows"


def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.split_summary(split_documents(spark, sf_dir), "source")


QUERIES["split_summary"] = split_summary
ORACLE["split_summary"] = f"""WITH {_SPLIT_SQL}
    SELECT split, source, count(*) AS n_rows FROM split_rows GROUP BY ALL"""


def split_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_documents(spark, sf_dir).where("split = 'train'").select("doc_id")


QUERIES["split_filter"] = split_filter
ORACLE["split_filter"] = f"WITH {_SPLIT_SQL} SELECT doc_id FROM split_rows WHERE split = 'train'"


def qa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.build_qa(
        T.qa_questions(spark, sf_dir), T.qa_movies(spark, sf_dir), T.qa_details(spark, sf_dir)
    )


QUERIES["qa_dataset"] = qa_rows
QA_TABLES = "qa_questions qa_movies qa_details"
QA_SQL = """qa AS (
        SELECT question_id, question, answers[correct_index + 1] AS response, name AS movie_name,
               year, genre, plot_outline
        FROM qa_questions LEFT JOIN qa_movies USING (imdb_key)
        LEFT JOIN qa_details ON name = title WHERE correct_index IS NOT NULL)"""
ORACLE["qa_dataset"] = with_tables(QA_TABLES, "SELECT * FROM qa", QA_SQL)


def instruction_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = R.to_instruction_rows(dialogue_rows(spark, sf_dir), "dialogue", "default", "conv_id")
    return rows.select(
        "conv_id",
        R.json_records(
            rows, "split", "type", "instruction", "input", "context", "response"
        ).alias("json"),
    )


_DIALOGUE_CONTEXT = """{movie_name: movie_name, character_names: %s, genre: genre,
        year: release_year, imdb_rating: imdb_rating, num_imdb_votes: num_imdb_votes,
        plot_outline: %s, additional_information: NULL::varchar}"""
QUERIES["instruction_records"] = instruction_records
ORACLE["instruction_records"] = with_tables(
    DIALOGUE_TABLES,
    f"""SELECT conv_id, to_json({{split: 'train', type: 'dialogue', instruction: instruction,
            input: utterance,
            context: {_DIALOGUE_CONTEXT % ("coalesce(character_names, 'Unknown')",
                                           "coalesce(plot_outline, 'Unknown')")},
            response: response}})::varchar AS json
        FROM dialogue""",
    *DIALOGUE_SQL,
)


def combined_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    dialogue = R.to_instruction_rows(dialogue_rows(spark, sf_dir), "dialogue")
    return R.combine(dialogue, R.to_instruction_rows(qa_rows(spark, sf_dir), "qa"))


def combine_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = combined_records(spark, sf_dir)
    return rows.select("type", "input", R.json_records(rows).alias("json"))


_COMBINED_SQL = f"""combined AS (
        SELECT 'train' AS split, 'dialogue' AS type, instruction, utterance AS input,
               {_DIALOGUE_CONTEXT % ("character_names", "plot_outline")} AS context, response
        FROM dialogue
        UNION ALL
        SELECT 'train', 'qa', '{Q.QA_INSTRUCTION}', question,
               {{movie_name: movie_name, character_names: NULL::varchar, genre: genre, year: year,
                 imdb_rating: NULL::double, num_imdb_votes: NULL::bigint,
                 plot_outline: plot_outline, additional_information: NULL::varchar}}, response
        FROM qa)"""
QUERIES["combine_records"] = combine_records
ORACLE["combine_records"] = with_tables(
    f"{DIALOGUE_TABLES} {QA_TABLES}",
    "SELECT type, input, to_json(combined)::varchar AS json FROM combined",
    *DIALOGUE_SQL, QA_SQL, _COMBINED_SQL,
)


def prompt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.format_prompt(combined_records(spark, sf_dir), split="train")


QUERIES["prompt_text"] = prompt_text
ORACLE["prompt_text"] = with_tables(
    f"{DIALOGUE_TABLES} {QA_TABLES}",
    """SELECT '### Instruction:' || chr(10) || instruction || chr(10) || chr(10) ||
              '### Context:' || chr(10) || array_to_string([
                  'Movie: ' || context.movie_name, 'Characters: ' || context.character_names,
                  'Genre: ' || context.genre, 'Year: ' || context.year,
                  'Rating: ' || context.imdb_rating, 'Votes: ' || context.num_imdb_votes,
                  'Plot: ' || context.plot_outline], chr(10)) || chr(10) || chr(10) ||
              '### Input:' || chr(10) || input || chr(10) || chr(10) ||
              '### Response:' || chr(10) || coalesce(response, '') || '</s>' AS text
       FROM combined""",
    *DIALOGUE_SQL, QA_SQL, _COMBINED_SQL,
)


#: The given tables have fewer rows of a title than the thresholds of the real ones.
SMALL = DatasetConfig(dialogue_min_rows=20, qa_min_rows=10)


def pipeline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole dataset job, written by split and type; the test split is read back."""
    tables = {
        "movie_conversations": T.conversation_lists(spark, sf_dir).drop("conv_id"),
        "movie_lines": T.lines(spark, sf_dir),
        "movie_titles_metadata": T.titles(spark, sf_dir),
        "movie_characters_metadata": T.characters(spark, sf_dir),
        "movie_details": T.details(spark, sf_dir),
        "qa": T.qa_questions(spark, sf_dir),
        "movies": T.qa_movies(spark, sf_dir),
        "qa_details": T.qa_details(spark, sf_dir),
    }
    records = run_pipeline(tables, new_path(spark, "records"), SMALL).where("split = 'test'")
    return records.select(
        "split", "type", "input", R.json_records(records, "instruction", "context", "response").alias("json")
    )


def _split_of(rows: str, train: float, test: float) -> str:
    return f"(WITH {split_sql(rows, 'movie_name', 'row_key', train, test)} SELECT * FROM split_rows)"


_PIPELINE_SQL = f"""keyed AS (
        SELECT conv_id, md5(to_json({{movie_id: movie_id, character_id1: character_id1, character_id2: character_id2,
                   line_id_list: line_id_list}})::varchar) AS conv_key FROM conversation_lists),
    base AS (
        SELECT min(conv_key) AS conv_id, character_names, movie_name, release_year, imdb_rating,
               num_imdb_votes, genre, s.input AS utterance, s.response, d.plot_outline,
               '{DIALOGUE_INSTRUCTION}' AS instruction
        FROM heads JOIN stitched s USING (conv_id) JOIN keyed USING (conv_id) LEFT JOIN details d USING (movie_name)
        GROUP BY ALL),
    rolled AS (
        SELECT movie_name, first(character_names ORDER BY conv_id) FILTER (WHERE character_names IS NOT NULL) AS character_names,
               first(genre ORDER BY conv_id) FILTER (WHERE genre IS NOT NULL) AS genre,
               first(release_year ORDER BY conv_id) FILTER (WHERE release_year IS NOT NULL) AS release_year,
               first(num_imdb_votes ORDER BY conv_id) FILTER (WHERE num_imdb_votes IS NOT NULL) AS num_imdb_votes,
               round(avg(imdb_rating), 6) AS imdb_rating
        FROM base GROUP BY movie_name),
    drawn AS (
        SELECT * EXCLUDE (r, n) FROM (
            SELECT *, row_number() OVER (ORDER BY md5(movie_name || ':42'), movie_name) AS r, count(*) OVER () AS n
            FROM rolled) WHERE r <= round_even(n * 0.2::double, 0)),
    drawn_questions AS ({_questions_sql('drawn', 'movie_name')}),
    grown AS (
        SELECT conv_id, character_names, movie_name, release_year, imdb_rating, num_imdb_votes, genre, utterance,
               response, plot_outline, instruction FROM base
        UNION ALL
        SELECT NULL, character_names, movie_name, release_year, imdb_rating, num_imdb_votes, genre, utterance,
               response, NULL, instruction FROM drawn_questions),
    talk AS (
        SELECT *, md5(concat_ws(chr(31), conv_id, utterance, response, plot_outline)) AS row_key FROM grown
        WHERE movie_name IN (SELECT movie_name FROM grown GROUP BY movie_name HAVING count(*) > {SMALL.dialogue_min_rows})),
    talk_split AS MATERIALIZED {_split_of('talk', SMALL.dialogue_train, SMALL.dialogue_test)},
    asked_rows AS (
        SELECT *, md5(concat_ws(chr(31), '{{' || array_to_string(list_filter([
                   '"movie_name":' || to_json(movie_name), '"question_id":' || to_json(question_id),
                   '"question":' || to_json(question), '"response":' || to_json(response), '"year":' || to_json(year),
                   '"genre":' || to_json(genre), '"plot_outline":' || to_json(plot_outline)],
                   lambda x: x IS NOT NULL AND NOT ends_with(x, ':null')), ',') || '}}', '1')) AS row_key
        FROM qa WHERE movie_name IN (SELECT movie_name FROM qa GROUP BY movie_name HAVING count(*) > {SMALL.qa_min_rows})),
    asked_split AS MATERIALIZED {_split_of('asked_rows', SMALL.qa_train, SMALL.qa_test)}"""
QUERIES["pipeline_records"] = pipeline_records
ORACLE["pipeline_records"] = with_tables(
    f"{DIALOGUE_TABLES} {QA_TABLES}",
    f"""SELECT split, 'dialogue' AS type, utterance AS input, to_json({{instruction: instruction,
               context: {_DIALOGUE_CONTEXT % ("character_names", "plot_outline")}, response: response}})::varchar AS json
        FROM talk_split WHERE split = 'test'
        UNION ALL
        SELECT split, 'qa', question, to_json({{instruction: '{Q.QA_INSTRUCTION}',
               context: {{movie_name: movie_name, character_names: NULL::varchar, genre: genre, year: year,
                          imdb_rating: NULL::double, num_imdb_votes: NULL::bigint,
                          plot_outline: plot_outline, additional_information: NULL::varchar}}, response: response}})::varchar
        FROM asked_split WHERE split = 'test'""",
    *DIALOGUE_SQL, QA_SQL, _PIPELINE_SQL,
)
