"""Lookups, patches, pruning and sampling.

No join here carries a broadcast hint: adaptive execution turns a side into a broadcast when
its measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and splits skewed
partitions of the other side when it is not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators.ordering import first_by, hash_buckets, hash_rank
from parley.operators.selection import bounds, place, prefix_sizes
from parley.session import SEED, materialise


def one_per_key(df: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """One row per key: the greatest value tuple, so that a lookup cannot fan out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(*values)).alias("_v"))
        .select(key, "_v.*")
    )


def lookup(df: DataFrame, key: str, dimension: DataFrame, dim_key: str, value: str,
           output: str) -> DataFrame:
    """Add ``output``: the dimension's value for the key, null if there is none."""
    side = one_per_key(dimension, dim_key, [value]).select(
        F.col(dim_key).alias("_k"), F.col(value).alias(output)
    )
    return df.join(side, F.col(key) == F.col("_k"), "left").drop("_k")


def left_distinct(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join followed by removal of equal rows.

    Both sides are reduced to distinct rows first, which gives the same rows and keeps copies
    from multiplying in the join.
    """
    return left.distinct().join(right.distinct(), on, "left")


def without(df: DataFrame, key: str, denied: DataFrame, denied_key: str) -> DataFrame:
    """Rows whose key is not on the list."""
    return df.join(denied.select(F.col(denied_key).alias("_d")), F.col(key) == F.col("_d"),
                   "left_anti")


def patch(df: DataFrame, key: str, patches: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Overwrite fields of named rows; ``patches`` has ``key, field, value`` as strings."""
    wide = patches.groupBy(F.col("key").alias("_k")).agg(
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f"_p_{f}") for f in fields]
    )
    kinds = {f.name: f.dataType for f in df.schema}
    patched = {f: F.coalesce(F.col(f"_p_{f}").cast(kinds[f]), F.col(f)) for f in fields}
    return df.join(wide, F.col(key) == F.col("_k"), "left").withColumns(patched).select(
        *df.columns
    )


def alias_name(title: Column, aliases: Mapping[str, str]) -> Column:
    """The name an outside table knows a title by; ``aliases`` is a short fixed mapping."""
    if not aliases:
        return title
    table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(table[title], title)


def best_candidate(questions: DataFrame, candidates: DataFrame, payload: Sequence[str]) -> DataFrame:
    """First candidate of a title by ``cand_rank``: of the asked year, or of any year if none is asked.

    Candidates are reduced to the first one per (title, year) and per title before the join,
    so no pair of question and rejected candidate is ever formed.
    """
    pick = F.min_by(F.struct(*payload), F.col("cand_rank")).alias("_pick")
    dated = candidates.where("year IS NOT NULL").groupBy("title", "year").agg(pick)
    undated = (
        candidates.groupBy("title").agg(pick)
        .withColumn("year", F.lit(None).cast(candidates.schema["year"].dataType))
    )
    firsts = dated.unionByName(undated).select(
        F.col("title").alias("_title"), F.col("year").alias("_year"), "_pick"
    )
    match = (F.col("title") == F.col("_title")) & F.col("year").eqNullSafe(F.col("_year"))
    return questions.join(firsts, match).select(*questions.columns, "_pick.*")


def not_found(questions: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return questions.join(found.select(key), key, "left_anti")


def entity_rollup(df: DataFrame, key: str, order: str, firsts: Sequence[str],
                  means: Sequence[str] = ()) -> DataFrame:
    """One row per key: first non-null attributes in ``order``, and means. Null keys are dropped."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *[first_by(c, order).alias(c) for c in firsts],
            *[F.avg(c).alias(c) for c in means],
        )
    )


def prune_rare(df: DataFrame, key: str, min_count: int) -> DataFrame:
    """Keep rows whose key occurs more than ``min_count`` times.

    The frequent keys are written first: the planner then knows their size, and broadcasts
    them below its threshold instead of shuffling the rows by a key that may be skewed.
    """
    frequent = materialise(
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"))
        .where(F.col("_n") > min_count)
        .select(key)
    )
    return df.join(frequent, key, "left_semi")


def distinct_titles(df: DataFrame, name: str, year: str) -> DataFrame:
    """Distinct (movie_name, release_year) pairs with the year as a number."""
    return (
        df.select(F.col(name).alias("movie_name"), F.col(year).cast("string").alias("release_year"))
        .distinct()
        .withColumn("release_year", X.digits_to_int(F.col("release_year")))
    )


def sample_fraction(df: DataFrame, fraction: float, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows, the first in seeded md5 order of a unique key.

    The last of them is looked up from counts; rows are compared with it where they are read.
    """
    sizes = prefix_sizes(df, [], key, seed)
    wanted = F.bround(F.coalesce(F.sum("_size"), F.lit(0)) * F.lit(float(fraction)), 0).cast("long")
    rank = sizes.agg(wanted.alias("_wanted")).select(F.lit("last").alias("_name"), "_wanted").where("_wanted > 0")
    last = materialise(bounds(df, sizes, rank, [], key, seed)).select("_bound").scalar()
    return hash_buckets(df, key, seed).where(place(key) <= last).select(*df.columns)


def assign_batches(df: DataFrame, size: int, key: Sequence[str], seed: int = SEED) -> DataFrame:
    """Add ``batch_no``: consecutive batches of ``size`` rows, starting at 1."""
    ranked = hash_rank(df, [], key, "_rank", seed)
    return ranked.withColumn("batch_no", F.floor((F.col("_rank") - 1) / size) + 1).drop("_rank")


def concat_datasets(first: DataFrame, second: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Append two tables of the same columns after casting the named ones on both sides."""
    def typed(df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.col(c).cast(kind) for c, kind in casts.items()})

    return typed(first).unionByName(typed(second))


def quality_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with the number of rows that break it."""
    counts = df.agg(
        F.count("*").alias("n_rows"), *[F.count_if(c).alias(name) for name, c in rules.items()]
    )
    return counts.unpivot("n_rows", list(rules), "rule", "n_flagged")
