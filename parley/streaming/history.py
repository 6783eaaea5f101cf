"""A stream of chat messages, and what each message finds in memory.

A message may come late or twice, so running counts are not final when it arrives. The stream
stores what is: the size of every turn. Histories are summed from that table when read.

Messages that come in within ``DELAY`` of being sent are told apart by keyed state that ends: a turn's key is
dropped when the watermark has passed it. Messages that take longer are stored beside, without any
state, and may be there twice. Reading unites both and counts a turn once. Whether a message took too long is read
off the message itself; as the watermark can't be ahead of what has arrived, it never drops one that did not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from parley.plans.chat import message_sizes, totals_before
from parley.schemas import MESSAGES

SIZES = "conv_id long, turn long, chars long, late boolean"
DELAY = "1 hour"
FILES_PER_BATCH = 100


def read_messages(
    spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH,
    schema: StructType = MESSAGES,
) -> DataFrame:
    """Message files as a stream, oldest first. Where a batch ends has no effect on results."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def new_sizes(messages: DataFrame, delay: str = DELAY) -> DataFrame:
    """``conv_id, turn, chars, late`` of the turns as they come in, in any order.

    A repeated delivery within ``delay`` is dropped; the state holds the turns of about that time. ``late`` turns took
    longer, or don't say when they were sent, and all pass. ``sent`` and ``arrived`` are columns of the messages;
    a missing one is the time of processing. For a state that outgrows memory, Spark's RocksDB state store
    keeps it on disk (``spark.sql.streaming.stateStore.providerClass``).
    """

    def time(name: str) -> F.Column:
        return F.col(name).cast("timestamp") if name in messages.columns else F.current_timestamp()

    timed = messages.select("*", F.least(time("sent"), time("arrived")).alias("_at"), time("arrived").alias("_in"))
    timed = message_sizes(timed, ("_at", "_in"))
    # The watermark drops what is not after it, and begins at the epoch.
    passed = F.greatest(F.col("_in") - F.expr(f"INTERVAL '{delay}'"), F.timestamp_seconds(F.lit(0)))
    late = F.coalesce(passed >= F.col("_at"), F.lit(True))
    in_time = timed.where(~late).withWatermark("_at", delay).dropDuplicatesWithinWatermark(["conv_id", "turn"])
    columns = ["conv_id", "turn", "chars"]
    return in_time.select(*columns, F.lit(False).alias("late")).unionByName(
        timed.where(late).select(*columns, F.lit(True).alias("late"))
    )


def write_sizes(sizes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet files, late turns in a folder of their own; takes up all that is there, then stops."""
    return (
        sizes.writeStream.format("parquet").partitionBy("late")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_history(spark: SparkSession, path: str) -> DataFrame:
    """``conv_id, turn, n_history, history_chars`` of all turns that have come in so far.

    Equals ``history_before`` of the whole table, in whatever order turns were delivered. Of several deliveries of
    a turn the one in time counts, then the shortest.
    """
    stored = spark.read.schema(SIZES).parquet(path)
    turns = stored.groupBy("conv_id", "turn").agg(F.min(F.struct("late", "chars")).alias("_first"))
    return totals_before(turns.select("conv_id", "turn", "_first.chars")).drop("chars")
