"""Queries over chunked documents, questions and chat memory."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.chunking import SEPARATORS, chunk
from parley.operators.embedding import DIMENSIONS, generate, hash_embedding
from parley.plans import chat as M
from parley.plans import index as I
from parley.plans import retrieval as R
from parley.queries import tables as T
from parley.queries.tables import read
from parley.queries.vectors import fused_sql, hits_sql, mmr_sql
from parley.session import new_path

QUERIES = {}
ORACLE = {}

def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents", spread_by="doc_id").select(
        "doc_id",
        F.col("source").alias("movie_name"),
        F.col("lang").alias("genres"),
        F.col("n_chars").alias("votes"),
        F.col("text").alias("synopsis"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.col("text").alias("question"),
        hash_embedding(F.col("text")).alias("embedding"),
    )


def chunks_sql(source: str, text: str, size: int, overlap: int) -> str:
    """A query of ``(source.*, chunk_no, chunk)`` rows of fixed windows."""
    step = size - overlap
    return f"""SELECT * EXCLUDE (n), substring({text}, chunk_no * {step} + 1, {size}) AS chunk
        FROM (SELECT *, unnest(range(0, n)) AS chunk_no FROM (
            SELECT *, CASE WHEN length({text}) <= {size} THEN 1
                           ELSE ceil((length({text}) - {overlap}) / {step}::double)::integer END AS n
            FROM {source}))"""


def recursive_chunks_sql(name: str, source: str, key: str, text: str, size: int, overlap: int) -> str:
    """Tables up to ``name``: ``(key, chunk_no, chunk)`` of separator-aware chunks; needs WITH RECURSIVE.

    A text is cut by the separators, coarse to fine, into pieces that know which cut they come from. Neighbours of
    one cut are a run; a chunk of a run starts at piece ``s`` and ends where the running length allows, and the
    recursion goes from chunk to chunk.
    """
    levels = [f"{name}_todo0 AS (SELECT {key} AS k, []::integer[] AS path, {text} AS piece FROM {source})"]
    last = len(SEPARATORS) - 1
    for n, separator in enumerate(SEPARATORS):
        mark = "'" + separator.replace("\n", "' || chr(10) || '") + "'"
        cut = (
            f"[CASE WHEN i = 1 THEN p ELSE {mark} || p END for p, i in string_split(piece, {mark})]"
            if separator else "regexp_extract_all(piece, '(?s).')"
        )
        has = f"contains(piece, {mark})" if separator else "true"
        levels.append(f"""{name}_cut{n} AS MATERIALIZED (
            SELECT * FROM (SELECT k, path AS parent, unnest(parts) AS piece,
                       list_append(path, generate_subscripts(parts, 1)::integer) AS path
                FROM (SELECT k, path, {cut} AS parts FROM {name}_todo{n} WHERE {has})) WHERE piece <> '')""")
        if n < last:
            levels.append(f"""{name}_todo{n + 1} AS (
            SELECT k, path, piece FROM {name}_todo{n} WHERE NOT {has}
            UNION ALL SELECT k, path, piece FROM {name}_cut{n} WHERE length(piece) >= {size})""")
    atoms = " UNION ALL ".join(
        f"SELECT * FROM {name}_cut{n}" + (f" WHERE length(piece) < {size}" if n < last else "") for n in range(last + 1)
    )
    return f"""{', '.join(levels)},
    {name}_runs AS MATERIALIZED (
        SELECT k, run, list_prepend(0, list(till ORDER BY path)) AS ends, string_agg(piece, '' ORDER BY path) AS whole
        FROM (SELECT *, sum(length(piece)) OVER (PARTITION BY k, run ORDER BY path)::bigint AS till
            FROM (SELECT *, sum(starts) OVER (PARTITION BY k ORDER BY path) AS run
                FROM (SELECT *, (parent IS DISTINCT FROM lag(parent) OVER (PARTITION BY k ORDER BY path))::integer
                          AS starts FROM ({atoms}))))
        GROUP BY k, run),
    {name}_held AS (
        SELECT k, run, 1 AS s, len(list_filter(ends, lambda x: x <= {size})) - 1 AS e FROM {name}_runs
        UNION ALL
        SELECT k, run, s, len(list_filter(ends, lambda x: x <= {size} + ends[s])) - 1 AS e
        FROM (SELECT h.k, h.run, r.ends, least(h.e + 1, 1 + len(list_filter(r.ends, lambda x:
                  r.ends[h.e + 1] - x > {overlap} OR r.ends[h.e + 2] - x > {size}))) AS s
              FROM {name}_held h JOIN {name}_runs r ON r.k = h.k AND r.run = h.run WHERE h.e < len(r.ends) - 1)),
    {name} AS MATERIALIZED (
        SELECT k AS {key}, row_number() OVER (PARTITION BY k ORDER BY run, s) - 1 AS chunk_no, chunk
        FROM (SELECT h.k, h.run, h.s, regexp_replace(substring(whole, ends[s] + 1, ends[e + 1] - ends[s]),
                  '^\\s+|\\s+$', '', 'g') AS chunk
              FROM {name}_held h JOIN {name}_runs r ON r.k = h.k AND r.run = h.run) WHERE chunk <> '')"""


def embedded_sql(source: str, key: str, text: str, name: str) -> str:
    """Tables ``name_slots`` and ``name``: hashed vectors of unit length per key."""
    return rf"""{name}_slots AS MATERIALIZED (
        SELECT {key}, slot % {DIMENSIONS} AS b, sum(CASE WHEN slot < {DIMENSIONS} THEN 1 ELSE -1 END) AS c
        FROM (SELECT {key}, ('0x' || substr(md5(token), 1, 8))::bigint % {2 * DIMENSIONS} AS slot
              FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+'))
                           AS token FROM {source}))
        GROUP BY ALL),
    {name} AS MATERIALIZED (
        SELECT {key}, list(coalesce(c / nullif(norm, 0), 0)::float ORDER BY b) AS embedding
        FROM (SELECT {key}, unnest(range(0, {DIMENSIONS})) AS b FROM {source})
        LEFT JOIN {name}_slots USING ({key}, b)
        LEFT JOIN (SELECT {key}, sqrt(sum(c * c)) AS norm FROM {name}_slots GROUP BY {key}) USING ({key})
        GROUP BY {key})"""


def chunk_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", spread_by="doc_id").select("doc_id", "source", "text")
    return chunk(docs, "text", 800, 150, "fixed")


QUERIES["chunk_fixed"] = chunk_fixed
ORACLE["chunk_fixed"] = f"""SELECT doc_id, source, chunk_no, chunk AS text
    FROM ({chunks_sql('(SELECT doc_id, source, text FROM documents)', 'text', 800, 150)})"""


def chunk_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", spread_by="doc_id").select("doc_id", "source", "text")
    return chunk(docs, "text", 1000, 200, "recursive")


QUERIES["chunk_recursive"] = chunk_recursive
ORACLE["chunk_recursive"] = f"""WITH RECURSIVE {recursive_chunks_sql('cut', 'documents', 'doc_id', 'text', 1000, 200)}
    SELECT doc_id, source, chunk_no::integer AS chunk_no, chunk AS text FROM cut JOIN documents USING (doc_id)"""


def hash_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", spread_by="doc_id").select(
        "doc_id", F.posexplode(hash_embedding(F.col("text"))).alias("slot", "weight")
    )
    return docs.withColumn("weight", F.round(F.col("weight").cast("double"), 6))


QUERIES["hash_embed"] = hash_embed
ORACLE["hash_embed"] = f"""WITH {embedded_sql('documents', 'doc_id', 'text', 'vectors')}
    SELECT doc_id, unnest(range(0, {DIMENSIONS})) AS slot,
           round(unnest(embedding)::double, 6) AS weight FROM vectors"""


def index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store that labelled documents, all documents, and all of them again are appended to, read back."""
    docs = catalog(spark, sf_dir)
    labelled = docs.join(read(spark, sf_dir, "labels"), "doc_id", "left_semi")
    path = new_path(spark, "store")
    for batch in (labelled, docs, docs):
        I.append_index(I.build_index(batch, "doc_id", I.INFOS), path)
    millionths = F.transform("embedding", lambda x: F.round(x.cast("double") * 1e6).cast("long").cast("string"))
    return spark.read.parquet(path).select(
        "collection", "chunk_id", "doc_id", "chunk_no", "movie_name", "year", "text",
        F.array_join(millionths, ",").alias("vector"),
    )


def _index_sql(name: str, collection: I.Collection, text: str) -> str:
    """Table ``name_chunks``: chunks of one collection with their ids."""
    source = f"(SELECT doc_id, source AS movie_name, {text} AS doc_text FROM documents)"
    return f"""{recursive_chunks_sql(f'{name}_cut', source, 'doc_id', 'doc_text', collection.size, collection.overlap)},
    {name}_chunks AS MATERIALIZED (
        SELECT '{collection.name}' AS collection,
               md5('{collection.name}:' || doc_id || ':' || chunk_no) AS chunk_id,
               doc_id, chunk_no::integer AS chunk_no, chunk AS text, source AS movie_name, 'Unknown' AS year
        FROM {name}_cut JOIN (SELECT doc_id, source FROM documents) USING (doc_id))"""


_INFO_TEXT = "'Movie Name: ' || source || chr(10) || 'Synopsis: ' || text"
_NAME_TEXT = " || chr(10) || ".join(
    f"'{label}: ' || " + {"movie_name": "source", "votes": "n_chars", "genres": "lang",
                          "synopsis": "text"}.get(column, "'Unknown'")
    for column, label in I.FULL_FIELDS.items()
)
QUERIES["index_append"] = index_append
ORACLE["index_append"] = f"""WITH RECURSIVE {_index_sql('info', I.INFOS, _INFO_TEXT)},
    {embedded_sql('info_chunks', 'chunk_id', 'text', 'vectors')}
    SELECT c.*, array_to_string(list_transform(embedding, lambda x: round(x::double * 1000000)::bigint), ',') AS vector
    FROM info_chunks c JOIN vectors USING (chunk_id)"""


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each collection is read once, by its search: hits come with their texts and titles."""
    docs = catalog(spark, sf_dir)
    return R.retrieve_context(
        questions(spark, sf_dir),
        I.build_index(docs, "doc_id", I.NAMES),
        I.build_index(docs, "doc_id", I.INFOS),
    )


def rag_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _context(spark, sf_dir).select("question_id", "entity", "context")


_CONTEXT_SQL = f"""{_index_sql('name', I.NAMES, _NAME_TEXT)},
    {embedded_sql('name_chunks', 'chunk_id', 'text', 'name_vectors')},
    name_index AS MATERIALIZED (SELECT * FROM name_chunks JOIN name_vectors USING (chunk_id)),
    {_index_sql('info', I.INFOS, _INFO_TEXT)},
    {embedded_sql('info_chunks', 'chunk_id', 'text', 'info_vectors')},
    info_index AS MATERIALIZED (SELECT * FROM info_chunks JOIN info_vectors USING (chunk_id)),
    {embedded_sql('benchmark', 'item_id', 'text', 'question_vectors')},
    questions AS MATERIALIZED (
        SELECT item_id AS question_id, text AS question, embedding
        FROM benchmark JOIN question_vectors USING (item_id)),
    {hits_sql('questions', 'name_index', 20, prefix='n_')},
    {mmr_sql('name_index', 4, 'n_')},
    {fused_sql(2, (0.2, 0.8), 'text', 'name_index', 'n_')},
    resolved AS MATERIALIZED (
        SELECT q.*, entity FROM questions q LEFT JOIN (
            SELECT question_id, movie_name AS entity, row_number() OVER (PARTITION BY question_id
                       ORDER BY count(*) DESC, min(rank)) AS r
            FROM n_fused JOIN name_index USING (chunk_id) GROUP BY question_id, movie_name) v
          ON v.question_id = q.question_id AND r = 1),
    {hits_sql('resolved', 'info_index', 20, 'q.entity IS NULL OR q.entity = d.movie_name', 'i_')},
    {mmr_sql('info_index', 4, 'i_')},
    {fused_sql(4, (0.5, 0.5), 'text', 'info_index', 'i_')},
    contexts AS MATERIALIZED (
        SELECT question_id, question, entity, coalesce(context, '') AS context
        FROM resolved LEFT JOIN (
            SELECT question_id, string_agg(text_key, chr(10) ORDER BY rank) AS context
            FROM i_fused GROUP BY question_id) USING (question_id))"""
QUERIES["rag_context"] = rag_context
ORACLE["rag_context"] = f"WITH RECURSIVE {_CONTEXT_SQL} SELECT question_id, entity, context FROM contexts"


def chat_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.chat_history(T.messages(spark, sf_dir))


_HISTORY_SQL = """histories AS (
        SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS history FROM conversations
        WHERE role IN ('user', 'assistant') GROUP BY conv_id)"""
QUERIES["chat_history"] = chat_history
ORACLE["chat_history"] = f"WITH {_HISTORY_SQL} SELECT * FROM histories"


def chat_history_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.history_before(T.messages(spark, sf_dir)).select(
        "conv_id", "turn", "n_history", "history_chars"
    )


QUERIES["chat_history_running"] = chat_history_running
ORACLE["chat_history_running"] = """
    SELECT conv_id, turn,
           count(*) FILTER (WHERE role <> 'system') OVER w AS n_history,
           greatest(coalesce(sum(length(text) + 1) FILTER (WHERE role <> 'system') OVER w, 0) - 1, 0)
               ::bigint AS history_chars
    FROM conversations
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


def chat_history_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The memory text before the latest question of each conversation."""
    messages = T.messages(spark, sf_dir)
    latest = messages.where("role = 'user'").groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return M.history_of(latest, messages)


QUERIES["chat_history_pending"] = chat_history_pending
ORACLE["chat_history_pending"] = """
    SELECT q.conv_id, q.turn, coalesce(string_agg(c.text, ' ' ORDER BY c.turn), '') AS history
    FROM (SELECT conv_id, max(turn) AS turn FROM conversations WHERE role = 'user' GROUP BY conv_id) q
    LEFT JOIN conversations c ON c.conv_id = q.conv_id AND c.turn < q.turn AND c.role <> 'system'
    GROUP BY q.conv_id, q.turn"""


LAST = 3


def chat_history_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A memory of the last three messages, for every message."""
    return M.history_last(T.messages(spark, sf_dir), LAST)


QUERIES["chat_history_last"] = chat_history_last
ORACLE["chat_history_last"] = f"""
    WITH numbered AS (
        SELECT conv_id, turn, text, role <> 'system' AS said, coalesce(count(*) FILTER (role <> 'system') OVER (
                   PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM conversations)
    SELECT m.conv_id, m.turn, coalesce(string_agg(s.text, ' ' ORDER BY s.turn), '') AS history
    FROM numbered m LEFT JOIN numbered s
      ON s.conv_id = m.conv_id AND s.said AND s.before >= m.before - {LAST} AND s.before < m.before
    GROUP BY m.conv_id, m.turn"""


def until_exit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third conversation is ended by its user, in odd letters; assistants can't end one."""
    leaves = (F.col("conv_id") % 3 == 0) & (F.col("turn") >= 2)
    messages = T.messages(spark, sf_dir).withColumn("text", F.when(leaves, "eXit").otherwise(F.col("text")))
    return M.until_exit(messages)


QUERIES["until_exit"] = until_exit
ORACLE["until_exit"] = """
    WITH messages AS (
        SELECT conv_id, turn, role, CASE WHEN conv_id % 3 = 0 AND turn >= 2 THEN 'eXit' ELSE text END AS text
        FROM conversations)
    SELECT m.* FROM messages m
    LEFT JOIN (SELECT conv_id, min(turn) AS ends FROM messages WHERE role = 'user' AND lower(text) = 'exit' GROUP BY conv_id)
      USING (conv_id) WHERE ends IS NULL OR turn < ends"""


def history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.summarise_history(T.messages(spark, sf_dir))


QUERIES["history_summary"] = history_summary
ORACLE["history_summary"] = r"""
    WITH parts AS (
        SELECT conv_id, turn, no, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS sentence FROM (
            SELECT conv_id, turn, unnest(s) AS raw, unnest(range(0, len(s))) AS no FROM (
                SELECT conv_id, turn, regexp_extract_all(text, '[^.!?\n]+[.!?]*') AS s
                FROM conversations WHERE role <> 'system'))),
    words AS (
        SELECT conv_id, turn, no, unnest(regexp_extract_all(lower(sentence), '[\p{L}\p{N}]+')) AS word
        FROM parts WHERE sentence <> ''),
    totals AS (SELECT word, count(*) AS total FROM words GROUP BY ALL),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn, no) AS place FROM (
            SELECT conv_id, turn, no, round(sum(total) / count(*)::double, 6) AS score
            FROM words JOIN totals USING (word) GROUP BY conv_id, turn, no))
    SELECT conv_id, string_agg(sentence, ' ' ORDER BY turn, no) AS summary
    FROM best JOIN parts USING (conv_id, turn, no) WHERE place <= 3 GROUP BY conv_id"""


def _asked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each question is asked in the conversation of its number, which may be new."""
    return _context(spark, sf_dir).withColumn("conv_id", F.col("question_id")).join(
        M.chat_history(T.messages(spark, sf_dir)).withColumnRenamed("history", "chat_history"),
        "conv_id", "left",
    )


def rag_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.build_prompt(_asked(spark, sf_dir)).select("question_id", "system", "memory", "human")


QUERIES["rag_prompt"] = rag_prompt
_SYSTEM = M.SYSTEM_TEXT.replace("{instruction}", M.INSTRUCTION).replace("'", "''")
ORACLE["rag_prompt"] = f"""WITH RECURSIVE {_CONTEXT_SQL}, {_HISTORY_SQL}
    SELECT question_id, '{_SYSTEM}' AS system,
           'Chat history: ' || coalesce(history, '') || chr(10) || 'Context: ' || context AS memory,
           'Question: ' || question AS human
    FROM contexts LEFT JOIN histories ON conv_id = question_id"""


def _echo():
    return lambda prompts: pd.Series("You asked: " + prompts)


def memory_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations grown by one question and its answer, from a stand-in for a model."""
    asked = read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("conv_id"), F.col("text").alias("question")
    )
    messages = T.messages(spark, sf_dir)
    return messages.unionByName(M.append_turns(messages, generate(asked, "question", _echo)))


QUERIES["memory_append"] = memory_append
ORACLE["memory_append"] = """
    WITH last AS (
        SELECT item_id, text, coalesce(max(turn), -1) AS t FROM benchmark b
        LEFT JOIN (SELECT conv_id, turn FROM conversations) ON conv_id = item_id
        GROUP BY item_id, text)
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT item_id, t + 1, 'user', text FROM last
    UNION ALL SELECT item_id, t + 2, 'assistant', 'You asked: ' || text FROM last"""
