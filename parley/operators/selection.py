"""Which rows come first in seeded md5 order, without ranking the rows.

A sample or split takes the first rows of a stratum up to some rank. Rows are counted by (stratum, digest prefix); the
counts tell in which prefix a rank falls. Only the ids of that prefix are read again, and counted by a longer prefix if
they are many, until few are left to be ranked. What comes out is the digest and id of the row at the rank, and every
row is labelled by comparing its own with that bound. Rows and their texts stay where they are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.ordering import BUCKET_DIGITS, hash_buckets
from parley.session import SEED, materialise

#: Ids that are ranked in one piece; a prefix that holds more is counted by a longer one.
FEW = 1 << 17
_DIGEST_DIGITS = 32


def prefix_sizes(df: DataFrame, strata: Sequence[str], key: Sequence[str], seed: int = SEED) -> DataFrame:
    """``strata, _bucket, _size``: written, as quotas and bounds are both taken from it."""
    marked = hash_buckets(df, key, seed)
    return materialise(marked.groupBy(*strata, "_bucket").agg(F.count("*").alias("_size")))


def place(key: Sequence[str]) -> Column:
    """What rows are compared by: the digest, then the id, as ``hash_buckets`` has marked them."""
    return F.struct("_digest", *key)


def _same(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns], F.lit(True))


def _located(sizes: DataFrame, ranks: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``ranks`` (groups, _name, _wanted) with the prefix that each falls in, and its rank there."""
    upto = Window.partitionBy(*groups).orderBy("_bucket")
    running = sizes.withColumn("_till", F.sum("_size").over(upto))
    asked = ranks.select(*[F.col(g).alias(f"_r_{g}") for g in groups], "_name", "_wanted")
    inside = (F.col("_wanted") > F.col("_till") - F.col("_size")) & (F.col("_wanted") <= F.col("_till"))
    return running.join(asked, _same(groups) & inside).select(
        *groups, "_bucket", "_size", "_name", (F.col("_wanted") - F.col("_till") + F.col("_size")).alias("_wanted")
    )


def bounds(
    df: DataFrame,
    sizes: DataFrame,
    ranks: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    seed: int = SEED,
    few: int = FEW,
) -> DataFrame:
    """``strata, _name, _bound``: the place of the row at each rank of ``ranks``.

    ``ranks`` has ``strata, _name, _wanted``, 1 or more each; a rank beyond the rows of its stratum has no bound.
    ``key`` must be unique within a stratum.
    """
    ids = hash_buckets(df, key, seed).select(*strata, "_bucket", "_digest", *[k for k in key if k not in strata])
    digits = BUCKET_DIGITS
    found = materialise(_located(sizes, ranks, strata))
    while True:
        groups = [*strata, "_bucket"]
        wanted = found.select(*[F.col(g).alias(f"_r_{g}") for g in groups]).distinct()
        ids = materialise(ids.join(wanted, _same(groups), "left_semi"))
        largest = found.agg(F.max("_size")).first()[0] or 0
        if largest <= few or digits >= _DIGEST_DIGITS:
            break
        digits += BUCKET_DIGITS
        outer = F.concat_ws("", "_bucket").alias("_outer")
        ids = ids.select(*strata, outer, F.substring("_digest", 1, digits).alias("_bucket"), "_digest",
                         *[k for k in key if k not in strata])
        finer = ids.groupBy(*strata, "_outer", "_bucket").agg(F.count("*").alias("_size"))
        asked = found.select(*strata, outer, "_name", "_wanted")
        found = materialise(_located(finer, asked, [*strata, "_outer"]).drop("_outer"))
        ids = ids.drop("_outer")
    order = Window.partitionBy(*strata, "_bucket").orderBy("_digest", *key)
    asked = found.select(*[F.col(g).alias(f"_r_{g}") for g in groups], "_name", "_wanted")
    return (
        ids.withColumn("_row", F.row_number().over(order))
        .join(asked, _same(groups) & (F.col("_row") == F.col("_wanted")))
        .select(*strata, "_name", place(key).alias("_bound"))
    )
