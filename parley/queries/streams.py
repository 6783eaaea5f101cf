"""The message stream, run to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.queries import tables as T
from parley.queries.retrieval import ORACLE as RETRIEVAL_ORACLE
from parley.schemas import DELIVERED, MESSAGES
from parley.session import materialise, new_path
from parley.streaming.history import new_sizes, read_messages, running_history, write_sizes

QUERIES = {}
ORACLE = {}

DELIVERIES = 6
FILES_PER_BATCH = 2
#: Messages of a file at most. Batches follow the messages, not the tasks that wrote them.
FILE_MESSAGES = 1 << 18
START = "timestamp'2024-01-01 00:00:00'"


def chat_history_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, delivered hour by hour, not in order of the turns.

    Every fifth turn has been under way for five hours, four times the delay that is waited for; system turns come
    twice, in the same hour or up to five hours later.
    """
    messages = T.messages(spark, sf_dir).select(*MESSAGES.fieldNames())
    key = F.concat_ws(":", "conv_id", "turn")

    def draw(salt: int, values: int) -> F.Column:
        return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(values))

    first = messages.withColumn("hour", draw(1, DELIVERIES))
    again = first.where("role = 'system'").withColumn("hour", F.greatest("hour", draw(2, DELIVERIES)))
    hours = F.when(draw(3, 5) == 0, 5).otherwise(0)
    minutes = F.expr(START).cast("long") + (draw(1, DELIVERIES) - hours) * 3600 + draw(4, 3000)
    sent = first.unionByName(again).withColumns({
        "sent": F.timestamp_seconds(minutes),
        "arrived": F.timestamp_seconds(F.expr(START).cast("long") + F.col("hour") * 3600 + 3599),
    })
    folder = new_path(spark, "stream")
    delivered = materialise(sent)
    sizes = {r["hour"]: r["count"] for r in delivered.groupBy("hour").count().collect()}  # six rows
    for hour in range(DELIVERIES):
        (
            delivered.where(F.col("hour") == hour).select(*DELIVERED.fieldNames())
            .repartition(-(-sizes.get(hour, 0) // FILE_MESSAGES) or 1)
            .write.mode("append").parquet(f"{folder}/in")
        )
    sizes = new_sizes(read_messages(spark, f"{folder}/in", FILES_PER_BATCH, DELIVERED), "75 minutes")
    write_sizes(sizes, f"{folder}/out", f"{folder}/state").awaitTermination()
    return running_history(spark, f"{folder}/out")


QUERIES["chat_history_stream"] = chat_history_stream
ORACLE["chat_history_stream"] = RETRIEVAL_ORACLE["chat_history_running"]
