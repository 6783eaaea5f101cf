"""What several operators of this folder need."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate words, and a word.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

_WORD = re.compile(WORD)
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(text: str | None) -> list[str]:
    """The words of a text with A-Z in lower case; none for null."""
    return _WORD.findall(text.translate(_LOWER)) if text else []


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without_blanks(text: Column) -> Column:
    """The text without its blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


#: Bits of the filter below: a megabyte goes to each task, however many keys there are.
FILTER_BITS = 1 << 23
_ROW_BITS = 1 << 15


def probably(
    df: DataFrame, key: str, keys: DataFrame, flag: str, bits: int = FILTER_BITS
) -> DataFrame:
    """``df`` with ``flag``: whether a row's key may be among ``keys`` (its first column); no shuffle of ``df``.

    The hashes of the keys are marked in bitmaps of a fixed total size. No row with a
    key of ``keys`` is left unmarked; others may be marked, so an exact join follows.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(bits))

    own = keys.columns[0]
    maps = (
        keys.select(place(own).alias("_p"))
        .groupBy(F.expr(f"_p DIV {_ROW_BITS}").alias("_bucket"))
        .agg(F.bitmap_construct_agg(F.col("_p") % _ROW_BITS).alias("_bits"))
    )
    marked = df.withColumn("_p", place(key)).withColumn(
        "_of", F.expr(f"_p DIV {_ROW_BITS}")
    )
    byte = F.conv(
        F.hex(F.substring("_bits", ((F.col("_p") % _ROW_BITS) / 8).cast("int") + 1, F.lit(1))), 16, 10
    )
    hit = F.expr("shiftright(_byte, cast(_p % 8 as int)) & 1 = 1")
    return (
        marked.join(F.broadcast(maps), F.col("_of") == F.col("_bucket"), "left")  # ``bits`` bits at most
        .withColumn("_byte", byte.cast("int"))
        .select(*df.columns, F.coalesce(hit, F.lit(False)).alias(flag))
    )


def probably_in(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key may be among ``keys``."""
    return probably(df, key, keys, "_near").where("_near").select(*df.columns)
