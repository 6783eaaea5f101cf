"""Exact places of rows within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.session import materialise


def placed(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with group_no (rank of the group's value, null first), place (from 0) and group_rows.

    Rows are dealt to ranges of (group, order); a range counts its rows of every group, and running
    totals of these counts over the ranges give each range its first place. So a group may hold any
    share of the rows, and there may be as many groups as rows: no window is wider than a range, or the
    list of ranges. Rows that agree in group and order take their places in any order; a stored
    number spreads them over ranges.
    """
    spread = F.xxhash64(F.monotonically_increasing_id()).alias("_spread")
    stored = materialise(rows.select("*", spread))
    dealt = materialise(
        stored.repartitionByRange(group, *order, "_spread").select(
            "*", F.spark_partition_id().alias("_part")
        )
    )
    counts = materialise(dealt.groupBy("_part", group).agg(F.count("*").alias("_rows")))
    of_group = Window.partitionBy(group).orderBy("_part")
    starts = counts.select(
        "*",
        F.coalesce(
            F.sum("_rows").over(of_group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_start"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("group_rows"),
        (F.row_number().over(of_group) == 1).alias("_first"),
    )
    firsts = starts.where("_first").select(
        "_part", group, F.row_number().over(Window.partitionBy("_part").orderBy(group)).alias("_own")
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        firsts.groupBy(F.col("_part").alias("_of"))
        .agg(F.count("*").alias("_groups"))
        .select("_of", F.coalesce(F.sum("_groups").over(before.orderBy("_of")), F.lit(0)).alias("_base"))
    )
    numbers = firsts.join(bases, F.col("_part") == F.col("_of")).select(
        F.col(group).alias("_number_of"), (F.col("_base") + F.col("_own") - 1).alias("group_no")
    )
    places = materialise(
        starts.join(numbers, F.col(group).eqNullSafe(F.col("_number_of"))).select(
            F.col("_part").alias("_p"), F.col(group).alias("_g"), "_start", "group_rows", "group_no"
        )
    )
    within = Window.partitionBy("_part", group).orderBy(*order)
    return (
        dealt.select("*", F.row_number().over(within).alias("_row"))
        .join(places, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
        .select(
            *rows.columns, "group_no", "group_rows",
            (F.col("_start") + F.col("_row") - 1).alias("place"),
        )
    )
