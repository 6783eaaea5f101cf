"""Exact, repeatable, stratified splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.ordering import hash_buckets, hash_rank
from parley.operators.selection import bounds, place, prefix_sizes
from parley.session import SEED, materialise

_WIDE = "decimal(19,0)"


def _quota(strata: DataFrame, key: str, size: str, target: Column, output: str,
           seed: int) -> DataFrame:
    """Share ``target`` rows over strata in proportion to ``size``, by largest remainder.

    Strata of equal size have equal shares and remainders, so the remainders are ordered over
    the distinct sizes, of which ``n`` rows allow ``sqrt(2 n)`` at most. Only in the one size
    that can be served in part are strata told apart, by md5 order.
    """
    sizes = strata.groupBy(F.col(size).alias("_size")).agg(F.count("*").alias("_strata"))
    everything = Window.partitionBy(F.lit(0))
    product = F.col("_size").cast(_WIDE) * F.col("_target").cast(_WIDE)
    shares = (
        sizes.withColumn("_total", F.sum(F.col("_size") * F.col("_strata")).over(everything))
        .withColumn("_target", target)
        .withColumn("_all", F.greatest("_total", F.lit(1)).cast(_WIDE))
        .withColumn("_rest", product % F.col("_all"))
        .withColumn("_base", ((product - F.col("_rest")) / F.col("_all")).cast("long"))
        .withColumn(
            "_left", F.col("_target") - F.sum(F.col("_base") * F.col("_strata")).over(everything)
        )
    )
    served = Window.partitionBy(F.lit(0)).orderBy(F.desc("_rest"), "_size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shares = shares.withColumn(
        "_extra", F.col("_left") - F.coalesce(F.sum("_strata").over(served), F.lit(0))
    ).select("_size", "_base", "_extra")
    ranked = hash_rank(strata, [size], [key], "_rank", seed)
    return ranked.join(shares, F.col(size) == F.col("_size")).select(
        *strata.columns,
        (F.col("_base") + (F.col("_rank") <= F.col("_extra")).cast("long")).alias(output),
    )


def stratified_split(
    df: DataFrame,
    key: str,
    id_cols: Sequence[str],
    train: float,
    test: float,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split``: ``int(n * train)`` rows of train, ``int(n * test)`` of test, the rest val.

    Both sizes are exact. Every stratum gets its proportional share to within one row, first
    of train, then of test out of what is left. Rows are taken in seeded md5 order of
    ``id_cols``, which must be unique within a stratum. Rows of a null stratum are dropped.

    Rows are counted by (stratum, md5 prefix), and the last rows of train and test of each stratum are looked up
    from the counts; rows are labelled where they are read, so no exchange carries them unless there
    are more strata than a broadcast takes. Counts, quotas and bounds are written to the shared folder.
    """
    known = df.where(F.col(key).isNotNull())
    sizes = prefix_sizes(known, [key], id_cols, seed)
    n = F.coalesce(F.sum("_size"), F.lit(0))
    train_rows, test_rows = (
        sizes.select(F.floor(n * F.lit(float(share))).cast("long")).scalar()
        for share in (train, test)
    )
    strata = sizes.groupBy(key).agg(F.sum("_size").alias("_n"))
    trained = _quota(strata, key, "_n", train_rows, "_train", seed)
    quotas = materialise(trained.withColumn("_remaining", F.col("_n") - F.col("_train")))
    quotas = _quota(quotas, key, "_remaining", test_rows, "_test", seed)
    ends = F.array(
        F.struct(F.lit("train").alias("_name"), F.col("_train").alias("_wanted")),
        F.struct(F.lit("test").alias("_name"), (F.col("_train") + F.col("_test")).alias("_wanted")),
    )
    ranks = quotas.select(key, F.inline(ends)).where("_wanted > 0")
    found = bounds(known, sizes, ranks, [key], id_cols, seed)
    last = materialise(
        found.groupBy(F.col(key).alias("_stratum")).agg(
            *[F.max(F.when(F.col("_name") == name, F.col("_bound"))).alias(f"_{name}") for name in ("train", "test")]
        )
    )
    split = (
        F.when(place(id_cols) <= F.col("_train"), "train")
        .when(place(id_cols) <= F.col("_test"), "test")
        .otherwise("val")
    )
    marked = hash_buckets(known, id_cols, seed)
    return marked.join(last, F.col(key) == F.col("_stratum"), "left").select(*df.columns, split.alias("split"))


def split_summary(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy("split", *by).agg(F.count("*").alias("n_rows"))
