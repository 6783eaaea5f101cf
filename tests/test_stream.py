from pyspark.sql import functions as F

from parley.plans.chat import history_before
from parley.queries import streams
from parley.schemas import DELIVERED, MESSAGES
from parley.streaming.history import SIZES, new_sizes, read_messages, running_history, write_sizes


def test_stream_equals_batch_with_late_and_repeated_turns(spark, tmp_path):
    messages = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    turn = F.col("turn")
    for step in (turn > 4, turn.between(1, 5), turn < 2, turn >= 0):  # late first, all repeated at last
        delivered = messages.where(step).select(*MESSAGES.fieldNames())
        delivered.coalesce(1).write.mode("append").parquet(source)
        sizes = new_sizes(read_messages(spark, source, files_per_batch=1))  # a run of its own
        write_sizes(sizes, out, state).awaitTermination()
    got = sorted(tuple(r) for r in running_history(spark, out).collect())
    batch = history_before(messages).select("conv_id", "turn", "n_history", "history_chars")
    assert got == sorted(tuple(r) for r in batch.collect())


def test_state_ends_and_very_late_turns_count(spark, tmp_path):
    """Keys leave the state when the watermark has passed them; what comes later than that is kept beside."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    minute = 60
    rows = [(c, t, "user", "x" * (c + t + 1), (c * 20 + t) * minute) for c in range(30) for t in range(4)]
    repeated = [r for r in rows if r[0] == 29]  # within the delay
    very_late = [(1, 9, "user", "abc", 21 * minute)] + [r for r in rows if r[0] == 2]
    for own, at in ((rows[:40], 0), (rows[40:80], 1), (rows[80:], 2), (repeated, 3), (very_late * 2, 4), ([], 5)):
        arrived = max((r[4] for r in rows[: (at + 1) * 40]), default=0) + minute
        df = spark.createDataFrame([(*r[:4], r[4], arrived) for r in own] or [(99 + at, 0, "system", None, arrived, arrived)],
                                   "conv_id long, turn long, role string, text string, s long, a long")
        df.select("conv_id", "turn", "role", "text", F.timestamp_seconds("s").alias("sent"),
                  F.timestamp_seconds("a").alias("arrived")).coalesce(1).write.mode("append").parquet(source)
        stream = new_sizes(read_messages(spark, source, 1, DELIVERED), "190 minutes")
        query = write_sizes(stream, out, state)
        query.awaitTermination()
        ended = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    messages = spark.createDataFrame([r[:4] for r in [*rows, very_late[0]]] + [(104, 0, "system", None)],
                                     "conv_id long, turn long, role string, text string")
    want = history_before(messages).select("conv_id", "turn", "n_history", "history_chars")
    assert sorted(map(tuple, running_history(spark, out).collect())) == sorted(map(tuple, want.collect()))
    stored = spark.read.schema(SIZES).parquet(out)
    assert stored.where("late").count() == 11 and stored.where("NOT late").count() == len(rows)  # one was sent at the epoch
    assert ended <= 81  # of 121 keys that have passed the state


def test_batches_follow_the_messages_not_the_tasks(spark, tmp_path, monkeypatch):
    """A table of many files is delivered in few."""
    rows = [(c, t, ("system", "user", "assistant")[t % 3], f"text {c} {t}") for c in range(40) for t in range(3)]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    messages.repartition(12).write.parquet(str(tmp_path / "conversations.parquet"))
    monkeypatch.setattr(streams, "new_path", lambda spark, kind: str(tmp_path / kind))
    got = streams.chat_history_stream(spark, str(tmp_path))
    want = history_before(messages).select("conv_id", "turn", "n_history", "history_chars")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert len(list((tmp_path / "stream" / "in").glob("*.parquet"))) <= streams.DELIVERIES
