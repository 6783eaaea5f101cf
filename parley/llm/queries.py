"""The operators on the given tables, with production parameters, and SQL twins where SQL can say it."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.llm import (
    conversations,
    exact_dedup,
    jaccard,
    language,
    merkle,
    mixing,
    packing,
    quality,
    secrets,
    sharding,
    substrings,
    token_counts,
    topk,
    twins,
)
from parley.queries.tables import read

#: Grades of a rated document: toxic, poor, good. What is kept is likely to be good.
TOXIC, POOR, GOOD = 0, 1, 2
LIKELY = 0.5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents")


def mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


_MAIL = re.compile(r"[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,8}")
_NUMBERS = re.compile(r"(?<!\d)\d{1,3}(?:\.\d{1,3}){3}(?!\d)")


def personal_data(text: str) -> Iterator[token_counts.Edit]:
    """Edits that put a mark in the place of mail addresses and network addresses."""
    if "@" in text:
        for m in _MAIL.finditer(text):
            yield m.start(), m.end() - m.start(), "[mail]"
    for m in _NUMBERS.finditer(text):
        yield m.start(), m.end() - m.start(), "[address]"


def edited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after personal data are masked."""
    return token_counts.recount_by_rule(documents(spark, sf_dir), personal_data)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(documents(spark, sf_dir))


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(documents(spark, sf_dir)).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.expr("vec_id % 50 = 0"), k=5)


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir), k=3, percent=90)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    network = language.fit(docs.where(~language.held_out()))
    return language.identify(docs, network).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score"
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def grades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its expected grade, the probability that it is good, and whether it stays."""
    docs = documents(spark, sf_dir)
    rated = read(spark, sf_dir, "labels").where("quality IS NOT NULL AND toxic IS NOT NULL")
    grade = F.when(F.col("toxic") == 1, TOXIC).otherwise(F.when(F.col("quality") == 1, GOOD).otherwise(POOR))
    model = quality.fit_ratings(docs, rated.select("doc_id", grade.alias("grade")), top=GOOD)
    return quality.grade(docs, model, above=POOR).select(
        "doc_id", "expected_grade", "tail", (F.col("tail") >= LIKELY).alias("kept")
    )


def manifest_of(docs: DataFrame, fan: int = merkle.FAN) -> DataFrame:
    """Leaf, proof and root of every row, and whether a row tampered with still leads to the root."""
    plain = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    claimed = [plain if f == "text" else F.col(f) for f in merkle.FIELDS]
    proofs = merkle.prove(docs, carry={"claimed": F.when(changed, merkle.digest(*claimed))}, fan=fan)
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"),
        merkle.fold(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"),
    ).select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_of(documents(spark, sf_dir))


def secrets_of(docs: DataFrame) -> DataFrame:
    """Numbers of base spans, their digest, and all spans written out."""
    kinds = [rule.kind for rule in secrets.BASE]
    found = secrets.scan(docs)
    base = F.filter("spans", lambda s: s["no"] < len(kinds))

    def count(no: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["no"] == no)).cast("long")

    counts = [count(no).alias(f"n_{kind}") for no, kind in enumerate(kinds)]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.written(base), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_of(documents(spark, sf_dir))


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows, some dropped, emptied, cut, repeated or under another role, as their checksum has it."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = (F.crc32(F.encode(F.concat(plain("conv_id"), F.lit(":"), plain("turn")), "UTF-8")) % 20).alias("case")
    text = F.when(F.col("case") == 1, "").when(
        F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), case)
        .where("case <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"),
            text.alias("text"), F.explode(times).alias("time"),
        )
        .drop("time")
    )


def repairs_of(rows: DataFrame, **options: int) -> DataFrame:
    return conversations.audit(damaged(rows), rows.select("conv_id"), **options)


def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs_of(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_mix_sources": mixed_sources,
    "op2_token_counts": edited_counts,
    "op3_pack": packed,
    "op4_repeated_passages": repeated_passages,
    "op5_exact_copies": exact_copies,
    "op6_top_k": nearest,
    "op7_near_copies": near_copies,
    "op8_language": languages,
    "op9_shards": shards,
    "op10_quality": grades,
    "op11_manifest": manifest,
    "op12_secrets": secret_scan,
    "op13_conversations": repairs,
}

_BLANKS = r"[\x20\x09-\x0D]+"

ORACLES = {
    "op5_exact_copies": f"""
        WITH normal AS (
            SELECT doc_id, coalesce(length(text), 0) AS chars,
                   regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g') AS norm FROM documents)
        SELECT doc_id, first_value(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size,
               row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
        FROM normal WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)""",
    "op6_top_k": """
        WITH cells AS MATERIALIZED (
            SELECT vec_id, row_number() OVER (ORDER BY vec_id, embedding) AS row,
                   list_transform(embedding, lambda x: floor(256 * x::double)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT q.vec_id AS query_id, q.row, c.vec_id, c.row AS other,
                   list_inner_product(q.v, c.v)::bigint AS score
            FROM cells q JOIN cells c ON q.row <> c.row WHERE q.vec_id % 50 = 0)
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, vec_id, score, (row_number() OVER (
                PARTITION BY row ORDER BY score DESC, vec_id, other))::integer AS rank FROM scores)
        WHERE rank <= 5""",
    "op11_manifest": twins.manifest(),
    "op12_secrets": twins.spans(secrets.RULES, len(secrets.BASE)),
    "op13_conversations": twins.conversations(),
}
