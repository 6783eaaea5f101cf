"""Ordered concatenation, exact ranks and prefix sums that survive a hot key.

A window over ``partitionBy(key)`` or a plain ``collect_list`` puts all rows of a key into one
task. The functions here cut every key into segments first, so that the bulk of the work is
spread, and only a small number of per-segment results meets again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.functions.text import seeded_hash
from parley.session import SEED

BUCKET_DIGITS = 3  # 16 ** 3 buckets of the digest per stratum


def _joined(order: Column, text: Column, separator: str) -> Column:
    """Aggregate: texts in order, joined."""
    items = F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t"))))
    return F.array_join(F.transform(items, lambda x: x["t"]), separator)


def ordered_concat(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    text: str,
    separator: str,
    output: str,
    segment: int = 1024,
) -> DataFrame:
    """Join the texts of a key in order; null texts are left out.

    ``order`` is a whole number. Segments of ``segment`` positions are joined first, in a
    shuffle that spreads a long key; the second step then only meets the joined segments.
    """
    cut = F.floor(F.col(order) / segment)
    parts = (
        df.where(F.col(text).isNotNull())
        .groupBy(*keys, cut.alias("_segment"))
        .agg(_joined(F.col(order), F.col(text), separator).alias("_part"))
    )
    return parts.groupBy(*keys).agg(
        _joined(F.col("_segment"), F.col("_part"), separator).alias(output)
    )


def small_concat(order: Column, text: Column, separator: str) -> Column:
    """The same as an aggregate, for groups whose size is bounded by a parameter such as k."""
    return _joined(order, text, separator)


def hash_buckets(df: DataFrame, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add the seeded md5 of ``key`` as ``_digest`` and its prefix as ``_bucket``."""
    return df.withColumn("_digest", seeded_hash(seed, *key)).withColumn(
        "_bucket", F.substring("_digest", 1, BUCKET_DIGITS)
    )


def bucket_offsets(sizes: DataFrame, strata: Sequence[str]) -> DataFrame:
    """``strata, _bucket, _size`` to the number of rows in the earlier buckets of a stratum.

    The running count sees 4,096 rows per stratum at most. Columns are renamed for a join.
    """
    before = Window.partitionBy(*strata).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return sizes.select(
        *[F.col(s).alias(f"_o_{s}") for s in strata],
        F.col("_bucket").alias("_o_bucket"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
    )


def rank_in_buckets(marked: DataFrame, offsets: DataFrame, strata: Sequence[str],
                    key: Sequence[str]) -> DataFrame:
    """Add ``_rank``: the rank inside the bucket, moved up by the bucket's offset."""
    within = Window.partitionBy(*strata, "_bucket").orderBy("_digest", *key)
    match = F.col("_bucket") == F.col("_o_bucket")
    for s in strata:
        match = match & F.col(s).eqNullSafe(F.col(f"_o_{s}"))
    return (
        marked.withColumn("_row", F.row_number().over(within))
        .join(offsets, match)
        .withColumn("_rank", (F.col("_offset") + F.col("_row")).cast("long"))
    )


def hash_rank(
    df: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    output: str = "rank",
    seed: int = SEED,
) -> DataFrame:
    """Exact 1-based rank of each row in its stratum, in seeded md5 order of ``key``.

    Rows are ranked inside (stratum, md5 prefix) buckets, which share out a stratum of any
    size, and moved up by the number of rows in the buckets before. ``key`` must be unique
    within a stratum.
    """
    marked = hash_buckets(df, key, seed)
    sizes = marked.groupBy(*strata, "_bucket").agg(F.count("*").alias("_size"))
    ranked = rank_in_buckets(marked, bucket_offsets(sizes, strata), strata, key)
    return ranked.select(*df.columns, F.col("_rank").alias(output))


def prefix_totals(
    df: DataFrame,
    key: str,
    order: str,
    measures: dict[str, Column],
    segment: int = 1024,
) -> DataFrame:
    """Add the totals of all earlier rows of a key, for each measure.

    The running sums are taken inside segments of ``segment`` positions; segment totals are
    summed up on their own and added.
    """
    cut = df.withColumn("_segment", F.floor(F.col(order) / segment)).select(
        "*", *[m.alias(f"_m_{name}") for name, m in measures.items()]
    )
    totals = cut.groupBy(key, "_segment").agg(
        *[F.sum(f"_m_{name}").alias(f"_t_{name}") for name in measures]
    )
    earlier_segments = Window.partitionBy(key).orderBy("_segment").rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = totals.select(
        key,
        "_segment",
        *[
            F.coalesce(F.sum(f"_t_{name}").over(earlier_segments), F.lit(0)).alias(f"_c_{name}")
            for name in measures
        ],
    )
    earlier_rows = Window.partitionBy(key, "_segment").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = cut.select(
        *df.columns,
        "_segment",
        *[
            F.coalesce(F.sum(f"_m_{name}").over(earlier_rows), F.lit(0)).alias(f"_r_{name}")
            for name in measures
        ],
    )
    return inside.join(carried, [key, "_segment"]).select(
        *df.columns,
        *[(F.col(f"_r_{name}") + F.col(f"_c_{name}")).alias(name) for name in measures],
    )


def number_copies(df: DataFrame, output: str, step: int = 10_000) -> DataFrame:
    """Tell equal rows apart: ``output`` counts the copies of a row from 1.

    Equal rows are counted first, with a combine on the map side, and then written out again
    in steps of ``step`` copies that are dealt out to tasks, so a row with very many copies
    is not the work of one task.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    steps = counted.withColumn(
        "_step", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / step)))
    )
    first = F.col("_step") * step + 1
    last = F.least((F.col("_step") + 1) * step, F.col("_copies"))
    return (
        steps.repartition(F.xxhash64(*df.columns), "_step")
        .withColumn(output, F.explode(F.sequence(first, last)))
        .drop("_copies", "_step")
    )


def first_by(value: str, order: str) -> Column:
    """Aggregate: first non-null value in the given order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def last_by(value: str, order: str) -> Column:
    """Aggregate: last non-null value in the given order."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))
