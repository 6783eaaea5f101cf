"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import forget, materialise


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b); component is the smallest id reachable.

    Alternating large and small stars: every node hands its larger neighbours to the smallest one it
    knows, then its smaller ones, until all hang on the smallest of their component. A round is two
    aggregations and two joins on links only; a hot node's neighbours are never gathered.
    """
    links = links.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    links = materialise(links.distinct())
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_least, "u")
        before = links
        links = materialise(
            small.select("u", F.col("m").alias("v"))
            .unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        forget(before)
        now = links.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == seen:
            break
        seen = now
    ends = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return ends.unionByName(roots)
