"""Search queries over the embeddings table: every vector asks, every vector is searched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import fusion as U
from parley.operators.knn import search
from parley.operators.pruned import search_pruned
from parley.queries.tables import read

QUERIES = {}
ORACLE = {}


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), "embedding", "label"
    )


def _questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("question_id"),
        "embedding",
        F.nullif(F.col("label"), F.lit(0)).alias("wanted_label"),
    )


def hits_sql(questions: str, index: str, k: int, condition: str = "true", prefix: str = "") -> str:
    """Tables ``scored`` and ``hits``: ranks by rounded cosine, then key."""
    return f"""{prefix}scored AS (
        SELECT question_id, chunk_id,
               round(list_dot_product(q.embedding::double[], d.embedding::double[]) /
                     (sqrt(list_dot_product(q.embedding::double[], q.embedding::double[])) *
                      sqrt(list_dot_product(d.embedding::double[], d.embedding::double[]))), 6)
                   AS score
        FROM {questions} q JOIN {index} d ON {condition}),
    {prefix}hits AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY
                CASE WHEN isnan(score) THEN -2 ELSE score END DESC, chunk_id) AS rank
            FROM {prefix}scored) WHERE rank <= {k})"""


def mmr_sql(index: str, picks: int, prefix: str = "") -> str:
    """Tables ``pick1`` to ``pickN`` and ``mmr``: greedy picks out of ``hits``, lambda one half."""
    steps = [f"""{prefix}pairs AS (
        SELECT a.question_id, a.chunk_id AS a, b.chunk_id AS b,
               round(list_dot_product(x.embedding::double[], y.embedding::double[]) /
                     (sqrt(list_dot_product(x.embedding::double[], x.embedding::double[])) *
                      sqrt(list_dot_product(y.embedding::double[], y.embedding::double[]))), 6)
                   AS likeness
        FROM {prefix}hits a JOIN {prefix}hits b USING (question_id)
        JOIN {index} x ON x.chunk_id = a.chunk_id JOIN {index} y ON y.chunk_id = b.chunk_id),
    {prefix}pick1 AS (
        SELECT question_id, chunk_id, score, 1 AS mmr_rank FROM {prefix}hits WHERE rank = 1)"""]
    for n in range(2, picks + 1):
        before = " UNION ALL ".join(f"SELECT * FROM {prefix}pick{i}" for i in range(1, n))
        steps.append(f"""{prefix}pick{n} AS (
        SELECT question_id, chunk_id, score, {n} AS mmr_rank FROM (
            SELECT h.question_id, h.chunk_id, h.score,
                   row_number() OVER (PARTITION BY h.question_id ORDER BY
                       0.5 * any_value(h.score) - 0.5 * max(p.likeness) DESC, any_value(h.rank)) AS r
            FROM {prefix}hits h JOIN ({before}) c USING (question_id)
            JOIN {prefix}pairs p ON p.question_id = h.question_id AND p.a = h.chunk_id
             AND p.b = c.chunk_id
            GROUP BY h.question_id, h.chunk_id, h.score
            HAVING NOT bool_or(c.chunk_id = h.chunk_id)) WHERE r = 1)""")
    union = " UNION ALL ".join(f"SELECT * FROM {prefix}pick{i}" for i in range(1, picks + 1))
    steps.append(f"{prefix}mmr AS ({union})")
    return ", ".join(steps)


def fused_sql(k_sim: int, weights: tuple[float, float], text_key: str, index: str,
              prefix: str = "") -> str:
    """Tables ``fused``: reciprocal ranks of ``hits`` and ``mmr`` summed up by text."""
    return f"""{prefix}ranked AS (
        SELECT question_id, chunk_id, 0 AS list_no, rank, {weights[0]}::double AS w
        FROM {prefix}hits WHERE rank <= {k_sim}
        UNION ALL
        SELECT question_id, chunk_id, 1, mmr_rank, {weights[1]}::double FROM {prefix}mmr),
    {prefix}merged AS (
        SELECT question_id, i.{text_key} AS text_key,
               round(sum(w / (60 + rank)), 12) AS score,
               min({{list_no: list_no, rank: rank, chunk_id: r.chunk_id}}) AS f
        FROM {prefix}ranked r JOIN {index} i ON i.chunk_id = r.chunk_id
        GROUP BY question_id, i.{text_key}),
    {prefix}fused AS (
        SELECT question_id, f.chunk_id AS chunk_id, text_key, score,
               row_number() OVER (PARTITION BY question_id ORDER BY score DESC, f) AS rank
        FROM {prefix}merged)"""


_TABLES = """index AS (SELECT vec_id AS chunk_id, embedding, label FROM embeddings),
    questions AS (SELECT vec_id AS question_id, embedding, nullif(label, 0) AS wanted FROM embeddings)"""


def knn_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_questions(spark, sf_dir), _index(spark, sf_dir), 4)


QUERIES["knn_topk"] = knn_topk
ORACLE["knn_topk"] = f"WITH {_TABLES}, {hits_sql('questions', 'index', 4)} SELECT * FROM hits"


def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(
        _questions(spark, sf_dir), _index(spark, sf_dir), 4, filter_by=("wanted_label", "label")
    )


QUERIES["knn_filtered"] = knn_filtered
ORACLE["knn_filtered"] = f"""WITH {_TABLES},
    {hits_sql('questions', 'index', 4, 'q.wanted IS NULL OR q.wanted = d.label')}
    SELECT * FROM hits"""


def knn_blocked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan for many questions, on the same tables and with the same answer."""
    return search(
        _questions(spark, sf_dir), _index(spark, sf_dir), 4, filter_by=("wanted_label", "label"),
        max_local_questions=0, block_questions=256, block_rows=256,
    )


QUERIES["knn_blocked"] = knn_blocked
ORACLE["knn_blocked"] = ORACLE["knn_filtered"]


def knn_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact plan that leaves cells of the index out, on the same tables and with the same answer."""
    return search_pruned(
        _questions(spark, sf_dir), _index(spark, sf_dir), 4, filter_by=("wanted_label", "label")
    ).hits


QUERIES["knn_pruned"] = knn_pruned
ORACLE["knn_pruned"] = ORACLE["knn_filtered"]


def mmr_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.search_mmr(_questions(spark, sf_dir), _index(spark, sf_dir), 4)


QUERIES["mmr_topk"] = mmr_topk
_HITS_20 = f"{_TABLES}, {hits_sql('questions', 'index', 20)}, {mmr_sql('index', 4)}"
ORACLE["mmr_topk"] = f"""WITH {_HITS_20}
    SELECT question_id, chunk_id, score, mmr_rank AS rank FROM mmr"""


def rrf_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.search_ensemble(
        _questions(spark, sf_dir), _index(spark, sf_dir), 4, 4, (0.5, 0.5)
    )


QUERIES["rrf_fusion"] = rrf_fusion
ORACLE["rrf_fusion"] = f"""WITH {_HITS_20}, {fused_sql(4, (0.5, 0.5), 'chunk_id', 'index')}
    SELECT question_id, chunk_id, score, rank FROM fused"""


def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = _index(spark, sf_dir)
    hits = U.search_ensemble(_questions(spark, sf_dir), index, 2, 4, (0.2, 0.8), carry=("label",))
    return U.majority_vote(hits, "label")


QUERIES["majority_vote"] = majority_vote
ORACLE["majority_vote"] = f"""WITH {_HITS_20}, {fused_sql(2, (0.2, 0.8), 'chunk_id', 'index')},
    votes AS (
        SELECT question_id, label, row_number() OVER (PARTITION BY question_id
                   ORDER BY count(*) DESC, min(rank)) AS r
        FROM fused JOIN index USING (chunk_id) GROUP BY question_id, label)
    SELECT question_id, label FROM votes WHERE r = 1"""
