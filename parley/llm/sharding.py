"""Contiguous shards of equal bytes by global prefix sums; DataFrame functions only.

Rows are ordered by the hash of their text, then by id, and dealt into ranges; a range knows its
bytes and rows, the running totals of all ranges before it give the place where it begins, and a
running sum within the range gives the place of every row. The line of all bytes is cut at equal
targets. Equal texts lie side by side, so a cut can only go through a group of copies; it moves to the
nearer end of that group if the group is smaller than ``SNAP`` of a shard, and goes through it
otherwise, as a group may be larger than a shard.

Only ids, hashes and sizes are shuffled. The totals of the ranges, one row each, are the only thing
that one task sees whole. A few numbers for each shard, its cut and its first row, pass the driver.

Defined results: a null text has size 1 and a null checksum; a null id comes first among equal texts;
rows that agree in text and id follow each other in any order; an empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.session import materialise

SHARDS = 8
#: A cut moves by at most half of this share of a shard to keep equal texts together.
SNAP = 0.01


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size, text_crc32, text_key with the first byte and the first row of each."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("text_key"),
    )
    dealt = materialise(
        rows.repartitionByRange("text_key", "text_crc32", "doc_id").select(
            "*", F.spark_partition_id().alias("part")
        )
    )
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        totals.select(
            F.col("part").alias("of"),
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_start"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_start"),
        )
    )
    within = Window.partitionBy("part").orderBy("text_key", "text_crc32", "doc_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    running = dealt.select(
        "*",
        F.coalesce(F.sum("size").over(within), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.count("size").over(within), F.lit(0)).alias("rows_before"),
    )
    return materialise(
        running.join(starts, F.col("part") == F.col("of")).select(
            "doc_id", "size", "text_crc32", "text_key",
            (F.col("byte_start") + F.col("bytes_before")).alias("at"),
            (F.col("row_start") + F.col("rows_before")).alias("row"),
        )
    )


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    snap: float = SNAP,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot, at (its first byte of all)."""
    placed = _placed(docs, id_col, text_col)
    total = placed.agg(F.sum("size")).first()[0] or 0
    group = ["text_key", "text_crc32"]
    # The cuts k with at < total * k / shards <= at + size, in whole numbers.
    first = F.expr(f"(at * {shards}) DIV {max(1, total)} + 1")
    last = F.least(F.expr(f"((at + size) * {shards}) DIV {max(1, total)}"), F.lit(shards - 1))
    through = materialise(
        placed.where(first <= last).select(*group, F.explode(F.sequence(first, last)).alias("cut"))
    ).select("cut", *[F.col(c).alias(f"of_{c}") for c in group])
    same = (F.col("text_key") == F.col("of_text_key")) & F.col("text_crc32").eqNullSafe(
        F.col("of_text_crc32")
    )
    ends = (
        placed.join(F.broadcast(through), same)  # shards - 1 rows at most
        .groupBy("cut")
        .agg(F.min("at").alias("low"), F.max(F.col("at") + F.col("size")).alias("high"))
        .orderBy("cut")
        .collect()
    )
    bounds = [_bound(total * e["cut"] / shards, e["low"], e["high"], total / shards * snap) for e in ends]
    marked = placed.select(
        "doc_id", "size", "text_crc32", "at", "row",
        sum((F.when(F.col("at") >= b, 1).otherwise(0) for b in bounds), F.lit(0)).alias("shard"),
    )
    firsts = marked.groupBy("shard").agg(F.min("row").alias("first"))
    return marked.join(F.broadcast(firsts), "shard").select(  # a row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"), "at"
    )


def _bound(target: float, low: int, high: int, most: float) -> float:
    """Where a cut goes whose target lies in a group of equal texts from low to high."""
    if high - low > most:
        return target
    return low if target - low <= high - target else high
