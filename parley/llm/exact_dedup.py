"""Exact copies by an extendible-hash index on shared files; DataFrame functions only.

A text is normalised by deleting its blanks and keyed by a 64-bit hash, once; what is needed later is stored. The
directory addresses buckets by the leading bits of the key. It starts with few bits and doubles while a bucket holds
more than ``CAPACITY`` different keys; a bucket that is not overfull keeps its shorter address. Every row finds its
bucket by its address. Within a bucket, equal texts are brought together by (key, whole text), which compares bytes, after each
task has merged the copies it read; a group of any size so reaches the shuffle as one row a task. Texts that only share
a key are entries of one chain. The index holds an entry per text, without the text: bucket, key, place in the
chain, SHA-256, the row that stays and the number of copies; buckets are written in key order by the task that owns
their range. A row's look-up goes by address, bucket and key to the chain, where its SHA-256 picks the entry. Texts of a
thousandth of all rows, which are fewer than a thousand, are looked up in a broadcast of their entries, so that no task
gets all rows of one text.

Defined results: null counts as empty, and texts of blanks only are equal to it; of equal texts the
row with the most code points in its original text stays, then the smallest id, a null id last; of
rows that agree in id and text one stays; an empty table gives none. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import without_blanks
from parley.session import materialise, new_path, settled

#: Keys of a bucket; more if there would be more buckets than these, so that every task can hold the directory.
CAPACITY, BUCKETS = 65536, 4096
#: Levels that the directory is doubled by at a time.
STEP = 4
#: Share of all rows from which a text is looked up by broadcast.
HOT = 1000
_ID_SPACE, _NO_ID = Decimal(1 << 65), Decimal(1 << 64)


@dataclass(frozen=True)
class Index:
    """Where the entries lie, the bits that the directory addresses, and the rows with their addresses."""

    path: str
    depth: int
    entries: DataFrame
    directory: DataFrame
    rows: DataFrame

    def bucket_of(self, rows: DataFrame) -> DataFrame:
        """Rows that have a key, with the bucket that their address leads to."""
        addressed = rows.select("*", _address(F.col("key"), self.depth).alias("_at"))
        ways = self.directory.select("address", "bucket")
        # Some 2 ** STEP addresses a bucket at most, hence a megabyte or so.
        return addressed.join(F.broadcast(ways), F.col("_at") == F.col("address")).select(*rows.columns, "bucket")


def _rank(chars: Column, doc_id: Column) -> Column:
    """Most code points first, then the smallest id: one number whose greatest value stays."""
    wide = chars.cast("decimal(10,0)") * F.lit(_ID_SPACE).cast("decimal(21,0)")
    own = F.coalesce(doc_id.cast("decimal(21,0)"), F.lit(_NO_ID).cast("decimal(21,0)"))
    return (wide - own).cast("decimal(38,0)")


def _rank_id(rank: Column) -> Column:
    """The id within a rank."""
    space = F.lit(_ID_SPACE).cast("decimal(38,0)")
    own = F.pmod(-rank, space)
    return F.when(own == _NO_ID, None).otherwise(
        F.when(own > _NO_ID, own - space).otherwise(own)
    ).cast("long")


def _rank_chars(rank: Column) -> Column:
    return F.ceil(rank / F.lit(_ID_SPACE).cast("decimal(38,0)")).cast("long")


def _address(key: Column, depth: int) -> Column:
    """The leading ``depth`` bits."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.char_length(text), F.lit(0)).alias("chars"),
        without_blanks(text).alias("norm"),
    ).select("*", F.xxhash64("norm").alias("key"), F.sha2("norm", 256).alias("text_sha256"))


def _directory(keys: DataFrame, capacity: int) -> tuple[DataFrame, int]:
    """(address, bits, bucket) and the depth: every used address with the shortest prefix that is not overfull.

    One count per address gives the loads of all shorter prefixes. While a bucket is still overfull at full length, the
    directory doubles ``STEP`` times more; two keys differ in 64 bits, so it ends.
    """
    held = keys.count()
    capacity = max(capacity, -(-held // BUCKETS))
    depth = min(64, max(0, math.ceil(math.log2(max(1, held) / capacity))) + STEP)
    while True:
        counts = materialise(
            keys.groupBy(_address(F.col("key"), depth).alias("address")).agg(F.count("*").alias("held"))
        )
        most = counts.agg(F.max("held")).first()[0] or 0
        if most <= capacity or depth == 64:
            break
        depth = min(64, depth + STEP)
    levels = counts.select("*", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("bits"))
    levels = levels.select("*", _prefix("address", depth).alias("prefix"))
    loads = levels.groupBy("bits", "prefix").agg(F.sum("held").alias("load"))
    fits = (F.col("load") <= capacity) | (F.col("bits") == depth)
    found = (
        levels.join(loads.where(fits), ["bits", "prefix"])
        .groupBy("address")
        .agg(F.min("bits").alias("bits"))
        .select("address", "bits", F.expr(f"shiftleft({_PREFIX.format('address', depth)}, {depth} - bits)").alias("bucket"))
    )
    return materialise(found), depth


_PREFIX = "CASE WHEN bits = 0 THEN 0L ELSE shiftrightunsigned({0}, {1} - bits) END"


def _prefix(address: str, depth: int) -> Column:
    return F.expr(_PREFIX.format(address, depth))


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> Index:
    """One entry per different text, in files sorted by key range."""
    spark = docs.sparkSession
    rows = materialise(keyed(docs, id_col, text_col))
    directory, depth = _directory(rows.select("key").distinct(), capacity)
    path = new_path(spark, "index")
    index = Index(path, depth, rows, directory, rows)
    entries = materialise(
        index.bucket_of(rows)
        .groupBy("bucket", "key", "norm", "text_sha256")
        .agg(F.count("*").alias("group_size"), F.max(_rank(F.col("chars"), F.col("doc_id"))).alias("rank"))
        .drop("norm")
    )
    chain = Window.partitionBy("bucket", "key").orderBy("text_sha256")
    (
        entries.select(
            "bucket", "key", F.row_number().over(chain).alias("chained"), "text_sha256",
            "group_size", _rank_id(F.col("rank")).alias("keep_id"),
            _rank_chars(F.col("rank")).alias("keep_chars"),
        )
        .repartitionByRange("bucket", "key")
        .sortWithinPartitions("bucket", "key")
        .write.mode("overwrite")
        .parquet(path)
    )
    return replace(index, entries=spark.read.parquet(path), rows=rows.drop("norm"))


def find_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, bucket, key."""
    index = build_index(docs, id_col, text_col, capacity)
    total = index.rows.count()
    counted = index.rows.groupBy("doc_id", "chars", "key", "text_sha256").agg(F.count("*").alias("rows"))
    rows = materialise(index.bucket_of(counted))
    own = ["bucket", "key", "text_sha256"]
    hot = F.broadcast(index.entries.where(F.col("group_size") * HOT > total))  # fewer than HOT
    found = rows.join(hot, own).unionByName(
        rows.join(hot.select(*own), own, "left_anti").join(index.entries, own)
    )
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return found.select(
        "*", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("copy")
    ).select(
        "doc_id", "keep_id", "group_size", (stays & (F.col("copy") == 1)).alias("kept"),
        "text_sha256", "bucket", "key",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns."""
    columns = docs.columns
    # The index and its texts go before the documents themselves are shuffled.
    stays = settled(
        lambda: find_copies(docs, id_col, text_col)
        .where("kept")
        .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    )
    text = F.sha2(without_blanks(F.col(text_col)), 256)
    own = F.col(id_col).cast("long")
    none = F.lit(0).cast("long")
    marked = docs.select(
        "*", F.coalesce(own, none).alias("_own"), own.isNull().alias("_blank"), text.alias("_text_sha")
    )
    stays = stays.select(
        F.coalesce("_id", none).alias("_stays"), F.col("_id").isNull().alias("_no_id"), "_sha"
    )
    same = (F.col("_own") == F.col("_stays")) & (F.col("_blank") == F.col("_no_id")) & (F.col("_text_sha") == F.col("_sha"))
    # Rows that agree in id and normalised text are told apart by their length, then by nothing. They lie together
    # after the join, so the texts are shuffled once.
    one = Window.partitionBy("_own", "_blank", "_text_sha", id_col).orderBy(F.char_length(text_col).desc_nulls_last())
    return (
        marked.join(stays, same)
        .select(*columns, "_own", "_blank", "_text_sha", F.row_number().over(one).alias("_row"))
        .where("_row = 1")
        .select(*columns)
    )
