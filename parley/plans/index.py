"""Title catalog to chunks with vectors, in named collections."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.functions.text import labelled_text
from parley.operators.chunking import chunk
from parley.operators.embedding import hash_embedding
from parley.session import materialise

# The lines of a document text, by column.
FULL_FIELDS = {
    "movie_name": "Movie Name",
    "year": "Year",
    "rating": "Rating",
    "votes": "Votes",
    "genres": "Genre",
    "director": "Director",
    "writer": "Writer",
    "cast": "Cast",
    "character_names": "Character Names",
    "languages": "Languages",
    "countries": "Countries",
    "plot": "Plot",
    "plot_outline": "Plot Outline",
    "synopsis": "Synopsis",
}
SHORT_FIELDS = {"movie_name": "Movie Name", "synopsis": "Synopsis"}


@dataclass(frozen=True)
class Collection:
    """How one collection is made: document lines, chunk size, and the vector column."""

    name: str
    fields: Mapping[str, str]
    size: int
    overlap: int
    chunker: str = "recursive"
    embed: Callable[[Column], Column] = hash_embedding


# The two collections.
NAMES = Collection("movie_name_collection", FULL_FIELDS, 1000, 200)
INFOS = Collection("movie_collection", SHORT_FIELDS, 800, 150)


def build_index(
    catalog: DataFrame,
    key: str,
    collection: Collection,
    metadata: Sequence[str] = ("movie_name", "year"),
) -> DataFrame:
    """One row per chunk: ids, text, metadata and vector. Empty chunks are dropped.

    No shuffle: every chunk is made where its document is read.
    """
    documents = catalog.select(
        F.col(key).alias("doc_id"),
        *[
            F.coalesce(F.col(m).cast("string"), F.lit("Unknown")).alias(m)
            if m in catalog.columns
            else F.lit("Unknown").alias(m)
            for m in metadata
        ],
        labelled_text(catalog, collection.fields).alias("text"),
    )
    chunks = chunk(documents, "text", collection.size, collection.overlap, collection.chunker)
    return (
        chunks.where(F.length("text") > 0)
        .select(
            F.lit(collection.name).alias("collection"),
            F.md5(F.concat_ws(":", F.lit(collection.name), "doc_id", "chunk_no")).alias("chunk_id"),
            "doc_id",
            "chunk_no",
            "text",
            *metadata,
        )
        .withColumn("embedding", collection.embed(F.col("text")))
    )


# --- the stored collections -------------------------------------------------------------------

BUCKET_DIGITS = 2  # 256 buckets of a collection, by the first digits of the chunk id
FILTERS = "_filters"  # readers of the store skip folders that begin like this
BITS_PER_ID = 16
_BITS = 1 << 15  # of one bitmap


def _bucketed(chunks: DataFrame) -> DataFrame:
    digits = F.substring("chunk_id", 1, BUCKET_DIGITS)
    return chunks.withColumn("bucket", F.concat(F.lit("b"), digits))


def _place(bitmaps: Column) -> Column:
    """Where an id is marked among the bits of its bucket's bitmaps."""
    return F.pmod(F.xxhash64("chunk_id"), bitmaps * _BITS)


def _filters(rows: DataFrame) -> DataFrame:
    """Bitmaps of the ids of a batch: per bucket as many as its ids need."""
    ids = rows.select("collection", "bucket", "chunk_id")
    sizes = ids.groupBy("collection", "bucket").agg(
        F.ceil(F.count("*") * BITS_PER_ID / _BITS).cast("int").alias("bitmaps")
    )
    placed = ids.join(sizes, ["collection", "bucket"]).withColumn("at", _place(F.col("bitmaps")))
    return placed.groupBy("collection", "bucket", "bitmaps", F.expr(f"at DIV {_BITS}").alias("bitmap")).agg(
        F.bitmap_construct_agg(F.col("at") % _BITS).alias("bits")
    )


def _maybe_stored(rows: DataFrame, path: str) -> DataFrame:
    """collection, bucket, chunk_id of the rows that some batch of the store may hold."""
    filters = rows.sparkSession.read.parquet(f"{path}/{FILTERS}")
    ids = rows.select("collection", "bucket", "chunk_id")
    # An id meets the one bitmap of a batch that marks its place: first the sizes of the batches, then the bits.
    sizes = filters.select("collection", "bucket", "bitmaps").distinct()
    placed = ids.join(sizes, ["collection", "bucket"]).withColumn("at", _place(F.col("bitmaps")))
    placed = placed.withColumn("bitmap", F.expr(f"at DIV {_BITS}"))
    met = placed.join(filters, ["collection", "bucket", "bitmaps", "bitmap"])
    bit = F.col("at") % _BITS
    octet = F.conv(F.hex(F.substring("bits", F.expr(f"(at % {_BITS}) DIV 8 + 1").cast("int"), F.lit(1))), 16, 10)
    return (
        met.withColumns({"octet": octet.cast("int"), "bit": (bit % 8).cast("int")})
        .where("shiftright(octet, bit) & 1 = 1")
        .select("collection", "bucket", "chunk_id")
        .distinct()
    )


def stored_ids(rows: DataFrame, path: str) -> DataFrame | None:
    """``chunk_id`` of the rows that the store holds, from the buckets that may hold one; None if none may."""
    maybe = materialise(_maybe_stored(rows, path))
    touched = maybe.select("collection", "bucket").distinct().collect()  # buckets, not ids
    if not touched:
        return None
    store = rows.sparkSession.read.parquet(path)
    buckets = F.lit(False)
    for name in sorted({t.collection for t in touched}):
        own = sorted(t.bucket for t in touched if t.collection == name)
        buckets = buckets | ((F.col("collection") == name) & F.col("bucket").isin(own))
    return store.where(buckets).select("chunk_id").join(maybe.select("chunk_id"), "chunk_id", "left_semi")


def missing_from(chunks: DataFrame, store: DataFrame) -> DataFrame:
    """Chunks whose id a table of ids does not hold. That table is reduced to ids of this batch first."""
    known = store.select("chunk_id").join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    return chunks.join(known, "chunk_id", "left_anti")


def append_index(chunks: DataFrame, path: str, store: DataFrame | None = None) -> None:
    """Append the chunks whose id the store at ``path`` does not hold; a repeated call adds nothing.

    The store is laid out by collection and by the first digits of the id. Every batch leaves bitmaps of its
    ids beside its rows, so an append reads the bitmaps, and of the rows only the ids in buckets where one of its own
    may be. Of several chunks of one id in ``chunks`` one is written. The bitmaps are written first: if a
    job dies before its rows are there, they only cause a look at the rows. One writer at a time. If a table
    of ids is given as ``store``, it says what is held instead.
    """
    spark = chunks.sparkSession
    fresh = _bucketed(chunks)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{FILTERS}")
    if store is not None:
        fresh = missing_from(fresh, store)
    elif folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        known = stored_ids(fresh, path)
        if known is not None:
            fresh = fresh.join(known, "chunk_id", "left_anti")
    # Copies are dropped last: what is stored is left out before its text is sorted or its vector made.
    fresh = materialise(fresh.dropDuplicates(["chunk_id"]))
    _filters(fresh).write.mode("append").parquet(f"{path}/{FILTERS}")
    (
        fresh.repartition("collection", "bucket")
        .sortWithinPartitions("collection", "bucket")
        .write.mode("append").partitionBy("collection", "bucket").parquet(path)
    )
