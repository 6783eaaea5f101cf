"""Evaluation queries: each assistant turn against the turn before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators import scoring as S
from parley.plans.evaluate import decoded_pairs, evaluate, with_token_ids
from parley.queries import tables as T
from parley.queries.tables import read, with_tables

QUERIES = {}
ORACLE = {}


def _logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector read as 8 positions of 8 logits."""
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice("embedding", i * 8 + 1, F.lit(8))
    )
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", rows.alias("logits"))


def argmax_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted ids, and label ids that are padded after the first ``label`` positions."""
    rows = _logits(spark, sf_dir).withColumn("ids", S.argmax_ids(F.col("logits")))
    padded = F.transform(
        "ids", lambda x, i: F.when(i < F.col("label"), x).otherwise(S.PADDING)
    )
    return rows.select(
        "vec_id",
        F.array_join(F.col("ids").cast("array<string>"), ",").alias("predicted"),
        F.array_join(S.unmask(padded, 99).cast("array<string>"), ",").alias("labelled"),
    )


_IDS_SQL = """ids AS (
        SELECT vec_id, label, list_transform(range(0, 8), lambda i:
            list_position(embedding[i * 8 + 1 : i * 8 + 8],
                          list_max(embedding[i * 8 + 1 : i * 8 + 8])) - 1) AS ids
        FROM embeddings)"""
QUERIES["argmax_tokens"] = argmax_tokens
ORACLE["argmax_tokens"] = f"""WITH {_IDS_SQL}
    SELECT vec_id, array_to_string(ids, ',') AS predicted,
           array_to_string(list_transform(range(0, 8), lambda i:
               CASE WHEN i < label THEN ids[i + 1] ELSE 99 END), ',') AS labelled
    FROM ids"""


def decode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted ids spelt with the nation names as vocabulary; id 0 is special."""
    rows = _logits(spark, sf_dir).withColumn("ids", S.argmax_ids(F.col("logits")))
    vocabulary = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("token_id"), F.col("n_name").alias("token")
    )
    return S.decode(rows, "vec_id", "ids", vocabulary)


QUERIES["decode_tokens"] = decode_tokens
ORACLE["decode_tokens"] = f"""WITH {_IDS_SQL}
    SELECT vec_id, coalesce(string_agg(n_name, ' ' ORDER BY pos), '') AS text
    FROM (SELECT vec_id, unnest(ids) AS id, unnest(range(0, 8)) AS pos FROM ids)
    LEFT JOIN nation ON n_nationkey = id AND id <> 0 GROUP BY vec_id"""


def decoded_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions and references spelt from logits and padded label ids, as the metrics take them."""
    rows = _logits(spark, sf_dir).withColumn("ids", S.argmax_ids(F.col("logits")))
    rows = rows.withColumn(
        "labels", F.transform("ids", lambda x, i: F.when(i < F.col("label"), x).otherwise(S.PADDING))
    )
    vocabulary = read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("token_id"), F.col("n_name").alias("token")
    )
    return decoded_pairs(rows, "vec_id", vocabulary, logits="logits")


QUERIES["decoded_pairs"] = decoded_texts
ORACLE["decoded_pairs"] = f"""WITH {_IDS_SQL}
    SELECT vec_id AS pair_id, coalesce(string_agg(n_name, ' ' ORDER BY pos), '') AS prediction,
           coalesce(string_agg(n_name, ' ' ORDER BY pos) FILTER (WHERE pos < label), '') AS reference
    FROM (SELECT vec_id, label, unnest(ids) AS id, unnest(range(0, 8)) AS pos FROM ids)
    LEFT JOIN nation ON n_nationkey = id AND id <> 0 GROUP BY vec_id"""


def bleu_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.bleu(T.evaluation_pairs(spark, sf_dir)).select(F.round("bleu", 9).alias("bleu"))


def _trim(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def _bleu_tokens(text: str) -> str:
    out = _trim(text)
    for old, new in (("'<skipped>'", "''"), ("'-' || chr(10)", "''"), ("chr(10)", "' '"),
                     ("'&quot;'", "'\"'"), ("'&amp;'", "'&'"), ("'&lt;'", "'<'"), ("'&gt;'", "'>'")):
        out = f"replace({out}, {old}, {new})"
    out = f"(' ' || {out} || ' ')"
    for pattern, new in ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "),
                         (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"),
                         (r"([0-9])(-)", r"\1 \2 ")):
        out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
    return rf"regexp_extract_all({out}, '\S+')"


def _rouge_tokens(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+')"


def _grams_sql(tokens, max_n: int, prefix: str) -> str:
    """Tables ``tokens`` and ``counts(pair_id, n, gram, p, r)``."""
    branches = " UNION ALL ".join(
        f"""SELECT pair_id, {n} AS n, unnest(list_transform(range(1, len({side}) - {n} + 2),
               lambda i: array_to_string({side}[i : i + {n - 1}], ' '))) AS gram,
               {int(side == 'pt')} AS p, {int(side == 'rt')} AS r
            FROM {prefix}tokens WHERE len({side}) >= {n}"""
        for n in range(1, max_n + 1)
        for side in ("pt", "rt")
    )
    return f"""{prefix}tokens AS (
        SELECT pair_id, {tokens('prediction')} AS pt, {tokens('reference')} AS rt
        FROM evaluation_pairs),
    {prefix}counts AS (
        SELECT pair_id, n, gram, sum(p) AS p, sum(r) AS r FROM ({branches}) GROUP BY ALL)"""


_BLEU_SQL = f"""{_grams_sql(_bleu_tokens, 4, 'b_')},
    b_totals AS (
        SELECT n, sum(least(p, r)) AS match, sum(p) AS p, sum(r) AS r FROM b_counts GROUP BY n),
    bleu AS (
        SELECT CASE WHEN min(match) > 0 THEN exp(avg(ln(match / p))) *
                    CASE WHEN max(p) FILTER (WHERE n = 1) > max(r) FILTER (WHERE n = 1) THEN 1
                         ELSE exp(1 - max(r) FILTER (WHERE n = 1) / max(p) FILTER (WHERE n = 1)) END
               ELSE 0 END::double AS bleu FROM b_totals)"""
QUERIES["bleu_corpus"] = bleu_corpus
ORACLE["bleu_corpus"] = with_tables(
    "evaluation_pairs", "SELECT round(bleu, 9) AS bleu FROM bleu", _BLEU_SQL
)


def rouge_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rouge_n(T.evaluation_pairs(spark, sf_dir)).select(
        "pair_id", F.round("rouge1", 9).alias("rouge1"), F.round("rouge2", 9).alias("rouge2")
    )


_ROUGE_SQL = f"""{_grams_sql(_rouge_tokens, 2, 'r_')},
    rouge AS (
        SELECT pair_id, coalesce(max(f) FILTER (WHERE n = 1), 0) AS rouge1,
               coalesce(max(f) FILTER (WHERE n = 2), 0) AS rouge2
        FROM evaluation_pairs LEFT JOIN (
            SELECT pair_id, n, 2.0::double * sum(least(p, r)) / (sum(p) + sum(r)) AS f
            FROM r_counts GROUP BY pair_id, n) USING (pair_id)
        GROUP BY pair_id)"""
QUERIES["rouge_n"] = rouge_n
ORACLE["rouge_n"] = with_tables(
    "evaluation_pairs",
    "SELECT pair_id, round(rouge1, 9) AS rouge1, round(rouge2, 9) AS rouge2 FROM rouge",
    _ROUGE_SQL,
)


def rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rouge_l(T.evaluation_pairs(spark, sf_dir)).select(
        "pair_id", F.round("rougeL", 9).alias("rougeL")
    )


# One recursion step per prediction token: the row of LCS lengths over the reference is renewed
# from the last match at or before each position.
_LCS_SQL = f"""l_tokens AS MATERIALIZED (
        SELECT pair_id, {_rouge_tokens('prediction')} AS pt, {_rouge_tokens('reference')} AS rt
        FROM evaluation_pairs),
    l_words AS (SELECT DISTINCT pair_id, rt, unnest(pt) AS word FROM l_tokens),
    l_last AS MATERIALIZED (
        SELECT pair_id, word, list(last_match ORDER BY pos) AS last_match FROM (
            SELECT pair_id, word, pos, max(CASE WHEN rt[pos] = word THEN pos END) OVER (
                       PARTITION BY pair_id, word ORDER BY pos) AS last_match
            FROM (SELECT pair_id, rt, word, unnest(range(1, len(rt) + 1)) AS pos FROM l_words))
        GROUP BY pair_id, word),
    l_steps AS MATERIALIZED (
        SELECT pair_id, i, last_match FROM (
            SELECT pair_id, unnest(pt) AS word, unnest(range(1, len(pt) + 1)) AS i FROM l_tokens)
        JOIN l_last USING (pair_id, word)),
    l_rows AS (
        SELECT pair_id, 0::bigint AS i, list_transform(rt, lambda x: 0::bigint) AS lengths FROM l_tokens
        UNION ALL
        SELECT s.pair_id, s.i, list_transform(range(1, len(w.lengths) + 1), lambda j:
                   CASE WHEN s.last_match[j] IS NULL THEN w.lengths[j]
                        ELSE greatest(w.lengths[j], coalesce(w.lengths[s.last_match[j] - 1], 0) + 1) END)
        FROM l_rows w JOIN l_steps s ON s.pair_id = w.pair_id AND s.i = w.i + 1),
    rouge_l AS (
        SELECT pair_id, CASE WHEN lcs > 0 THEN 2.0::double * lcs / (len(pt) + len(rt)) ELSE 0 END AS "rougeL"
        FROM l_tokens LEFT JOIN (
            SELECT pair_id, max(lengths[len(lengths)]) AS lcs FROM l_rows GROUP BY pair_id)
        USING (pair_id))"""
QUERIES["rouge_l"] = rouge_l
ORACLE["rouge_l"] = with_tables(
    "evaluation_pairs", 'SELECT pair_id, round("rougeL", 9) AS "rougeL" FROM rouge_l', _LCS_SQL
).replace("WITH ", "WITH RECURSIVE ", 1)


def rouge_lsum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.rouge_lsum(T.evaluation_pairs(spark, sf_dir)).select(
        "pair_id", F.round("rougeLsum", 9).alias("rougeLsum")
    )


# Lengths of the longest common subsequence of every two lines, a recursion step per token of the reference line;
# then the way back from their ends. Covered tokens count as often as both texts have them.
_LSUM_SQL = f"""s_lines AS MATERIALIZED (
        SELECT pair_id, side, no, tokens FROM (
            SELECT pair_id, side, no, {_rouge_tokens('line')} AS tokens FROM (
                SELECT pair_id, side, unnest(lines) AS line, unnest(range(0, len(lines))) AS no FROM (
                    SELECT pair_id, 'p' AS side, list_filter(string_split(prediction, chr(10)), lambda x: x <> '') AS lines
                    FROM evaluation_pairs
                    UNION ALL SELECT pair_id, 'r', list_filter(string_split(reference, chr(10)), lambda x: x <> '')
                    FROM evaluation_pairs)))),
    s_pairs AS MATERIALIZED (
        SELECT r.pair_id, r.no AS a, p.no AS b, r.tokens AS rt, p.tokens AS pt
        FROM s_lines r JOIN s_lines p ON p.pair_id = r.pair_id AND p.side = 'p' WHERE r.side = 'r'),
    s_rows AS (
        SELECT pair_id, a, b, 0::bigint AS i, list_transform(pt, lambda x: 0::bigint) AS lengths FROM s_pairs
        UNION ALL
        SELECT pair_id, a, b, i + 1, list_reduce(range(1, len(pt) + 1), lambda row, j: list_append(row, CASE
                   WHEN rt[i + 1] = pt[j] THEN coalesce(lengths[j - 1], 0) + 1
                   ELSE greatest(lengths[j], coalesce(row[j - 1], 0)) END), []::bigint[])
        FROM s_rows JOIN s_pairs USING (pair_id, a, b) WHERE i < len(rt)),
    s_kept AS MATERIALIZED (SELECT * FROM s_rows),
    s_back AS (
        SELECT pair_id, a, b, len(rt)::bigint AS i, len(pt)::bigint AS j, NULL::bigint AS hit FROM s_pairs
        UNION ALL
        SELECT w.pair_id, w.a, w.b,
               CASE WHEN rt[w.i] = pt[w.j] OR NOT left_more THEN w.i - 1 ELSE w.i END,
               CASE WHEN rt[w.i] = pt[w.j] OR left_more THEN w.j - 1 ELSE w.j END,
               CASE WHEN rt[w.i] = pt[w.j] THEN w.i END
        FROM (SELECT s.*, coalesce(here.lengths[s.j - 1], 0) > coalesce(above.lengths[s.j], 0) AS left_more
              FROM s_back s JOIN s_kept here ON here.pair_id = s.pair_id AND here.a = s.a AND here.b = s.b AND here.i = s.i
              JOIN s_kept above ON above.pair_id = s.pair_id AND above.a = s.a AND above.b = s.b AND above.i = s.i - 1
              WHERE s.i > 0 AND s.j > 0) w JOIN s_pairs USING (pair_id, a, b)),
    s_tokens AS (SELECT pair_id, side, unnest(tokens) AS token FROM s_lines),
    s_counts AS (
        SELECT pair_id, token, count(*) FILTER (side = 'p') AS p FROM s_tokens GROUP BY ALL),
    s_hits AS (
        SELECT pair_id, sum(least(covered, p)) AS hits FROM (
            SELECT pair_id, token, count(*) AS covered FROM (
                SELECT DISTINCT b.pair_id, b.a, b.hit, l.tokens[b.hit] AS token
                FROM s_back b JOIN s_lines l ON l.pair_id = b.pair_id AND l.side = 'r' AND l.no = b.a WHERE hit IS NOT NULL)
            GROUP BY ALL) JOIN s_counts USING (pair_id, token) GROUP BY pair_id),
    rouge_lsum AS (
        SELECT pair_id, coalesce(2.0::double * hits / n, 0) AS "rougeLsum" FROM evaluation_pairs
        LEFT JOIN s_hits USING (pair_id)
        LEFT JOIN (SELECT pair_id, count(*) AS n FROM s_tokens GROUP BY pair_id) USING (pair_id))"""
QUERIES["rouge_lsum"] = rouge_lsum
ORACLE["rouge_lsum"] = with_tables(
    "evaluation_pairs", 'SELECT pair_id, round("rougeLsum", 9) AS "rougeLsum" FROM rouge_lsum', _LSUM_SQL
).replace("WITH ", "WITH RECURSIVE ", 1)


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("token_id"), "embedding")


def bertscore_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, vectors = T.evaluation_pairs(spark, sf_dir), _vectors(spark, sf_dir)
    return S.bertscore(with_token_ids(pairs, vectors), vectors).select(
        "pair_id", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    )


def _token_side(column: str, name: str) -> str:
    return rf"""{name} AS (
        SELECT pair_id, token_id, count(*) AS n FROM (
            SELECT pair_id, ('0x' || substr(md5(token), 1, 8))::bigint %
                   (SELECT count(*) FROM embeddings) AS token_id
            FROM (SELECT pair_id, unnest(regexp_extract_all(lower({column}), '[\p{{L}}\p{{N}}]+'))
                         AS token FROM evaluation_pairs))
        GROUP BY ALL)"""


_BERT_SQL = f"""{_token_side('prediction', 'pt')}, {_token_side('reference', 'rt')},
    unit AS (SELECT vec_id, list_transform(embedding, lambda x: x::double / sqrt(
                 list_dot_product(embedding::double[], embedding::double[]))) AS v FROM embeddings),
    cosines AS (
        SELECT a.vec_id AS a, b.vec_id AS b, list_dot_product(a.v, b.v) AS c FROM unit a, unit b),
    matched AS (
        SELECT pt.pair_id, pt.token_id AS p, pt.n AS pn, rt.token_id AS r, rt.n AS rn, c
        FROM pt JOIN rt USING (pair_id) JOIN cosines ON a = pt.token_id AND b = rt.token_id),
    sides AS (
        SELECT pair_id, coalesce(pr, 0) AS pr, coalesce(re, 0) AS re
        FROM evaluation_pairs
        LEFT JOIN (SELECT pair_id, sum(best * pn) / sum(pn) AS pr FROM (
            SELECT pair_id, p, pn, max(c) AS best FROM matched GROUP BY pair_id, p, pn)
            GROUP BY pair_id) USING (pair_id)
        LEFT JOIN (SELECT pair_id, sum(best * rn) / sum(rn) AS re FROM (
            SELECT pair_id, r, rn, max(c) AS best FROM matched GROUP BY pair_id, r, rn)
            GROUP BY pair_id) USING (pair_id)),
    bert AS (
        SELECT pair_id, pr AS precision, re AS recall,
               CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f1 FROM sides)"""
QUERIES["bertscore_corpus"] = bertscore_corpus
ORACLE["bertscore_corpus"] = with_tables(
    "evaluation_pairs",
    """SELECT pair_id, round(precision, 9) AS precision, round(recall, 9) AS recall,
              round(f1, 9) AS f1 FROM bert""",
    _BERT_SQL,
)


def metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = evaluate(
        T.evaluation_pairs(spark, sf_dir), "run-1", vectors=_vectors(spark, sf_dir)
    )
    return scored.withColumn("value", F.round("value", 9))


QUERIES["metrics_long"] = metrics_long
ORACLE["metrics_long"] = with_tables(
    "evaluation_pairs",
    """SELECT 'run-1' AS run_id, metric, round(value, 9) AS value FROM (
           SELECT 'bleu' AS metric, bleu AS value FROM bleu
           UNION ALL SELECT 'rouge_rouge1', avg(rouge1) FROM rouge
           UNION ALL SELECT 'rouge_rouge2', avg(rouge2) FROM rouge
           UNION ALL SELECT 'rouge_rougeL', avg("rougeL") FROM rouge_l
           UNION ALL SELECT 'rouge_rougeLsum', avg("rougeLsum") FROM rouge_lsum
           UNION ALL SELECT 'bertscore_precision', avg(precision) FROM bert
           UNION ALL SELECT 'bertscore_recall', avg(recall) FROM bert
           UNION ALL SELECT 'bertscore_f1', avg(f1) FROM bert)""",
    _BLEU_SQL, _ROUGE_SQL, _LCS_SQL, _LSUM_SQL, _BERT_SQL,
).replace("WITH ", "WITH RECURSIVE ", 1)
