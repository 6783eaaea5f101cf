"""Chat memory, its summary, and prompts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators.ordering import ordered_concat, prefix_totals
from parley.session import materialise

# The prompt wording and the default task.
SYSTEM_TEXT = """You are an experienced assistant specializing in question-answering tasks.
Use the context to answer the following question.
If you're unsure, say 'I don't know.'
Instruction: {instruction}
"""
CONTEXT_TEXT = "Chat history: {chat_history}\nContext: {context}"
QUESTION_TEXT = "Question: {question}"
INSTRUCTION = "Answer the following question:"

SPEAKERS = ("user", "assistant")
#: Share of all words from which a word counts as frequent.
FREQUENT = 1 << 16
SEPARATOR = " "


def chat_history(messages: DataFrame) -> DataFrame:
    """``conv_id, history``: what user and assistant said, in order, joined by a space."""
    said = messages.where(F.col("role").isin(*SPEAKERS))
    return ordered_concat(said, ["conv_id"], "turn", "text", SEPARATOR, "history")


def message_sizes(messages: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """``conv_id, turn, chars``: the length of what was said, null for other roles and null texts."""
    counted = F.col("role").isin(*SPEAKERS) & F.col("text").isNotNull()
    return messages.select(
        "conv_id", "turn", F.when(counted, F.length("text")).cast("long").alias("chars"), *also
    )


def totals_before(sizes: DataFrame) -> DataFrame:
    """Add ``n_history, history_chars`` of the earlier turns to ``conv_id, turn, chars`` rows."""
    totals = prefix_totals(
        sizes,
        "conv_id",
        "turn",
        {
            "n_history": F.col("chars").isNotNull().cast("long"),
            "_chars": F.coalesce(F.col("chars") + len(SEPARATOR), F.lit(0)).cast("long"),
        },
    )
    return totals.withColumn(
        "history_chars", F.greatest(F.col("_chars") - len(SEPARATOR), F.lit(0)).cast("long")
    ).drop("_chars")


def history_before(messages: DataFrame) -> DataFrame:
    """What each message finds in memory: ``conv_id, turn, n_history, history_chars``.

    These are the number and length of the earlier messages. The history of a message is the
    first ``history_chars`` characters of the conversation's ``chat_history``. Spelling it out
    for every message would repeat a conversation once per turn; ``history_of`` does it for
    chosen messages. Texts are not shuffled.
    """
    return totals_before(message_sizes(messages)).drop("chars")


def history_of(chosen: DataFrame, messages: DataFrame) -> DataFrame:
    """Add ``history`` to chosen ``(conv_id, turn)`` rows: all that was said before that turn."""
    lengths = history_before(messages).select("conv_id", "turn", "history_chars")
    return (
        chosen.join(lengths, ["conv_id", "turn"])
        .join(chat_history(messages), "conv_id", "left")
        .withColumn(
            "history",
            F.coalesce(
                F.substring(F.col("history"), F.lit(1), F.col("history_chars").cast("int")), F.lit("")
            ),
        )
        .drop("history_chars")
    )


def history_last(messages: DataFrame, last_n: int, segment: int = 1024) -> DataFrame:
    """``conv_id, turn, history``: the text of the ``last_n`` earlier messages that each message finds in memory.

    Messages know how many were said before them, which numbers what is said. A conversation is cut into
    segments of these numbers; the last ones of a segment are copied to the next, so that a window over one
    segment sees all that it needs, and a long conversation is the work of many tasks.
    """
    segment = max(segment, last_n)
    counted = F.col("role").isin(*SPEAKERS) & F.col("text").isNotNull()
    said = messages.select("conv_id", "turn", F.when(counted, F.col("text")).alias("_text"))
    numbered = prefix_totals(said, "conv_id", "turn", {"_before": F.col("_text").isNotNull().cast("long")})
    own = F.floor(F.col("_before") / segment)
    tail = F.col("_text").isNotNull() & (F.col("_before") % segment >= segment - last_n)
    places = F.when(tail, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = numbered.select("*", F.posexplode(places).alias("_copy", "_segment"))
    window = Window.partitionBy("conv_id", "_segment").orderBy("_before").rangeBetween(-last_n, -1)
    found = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_before", "_text"))).over(window))
    return dealt.withColumn("_found", found).where("_copy = 0").select(
        "conv_id", "turn", F.array_join(F.transform("_found", lambda m: m["_text"]), SEPARATOR).alias("history")
    )


def summarise_history(messages: DataFrame, sentences: int = 3) -> DataFrame:
    """``conv_id, summary``: the sentences with the commonest words, in order.

    A sentence scores the mean number of times that its words occur in all messages. The words
    of a sentence are in one task, so they are averaged before the shuffle; before the
    ranking, every task keeps its own best sentences of a conversation only.
    """
    said = messages.where(F.col("role").isin(*SPEAKERS)).select("conv_id", "turn", "text")
    parts = said.select(
        "conv_id",
        "turn",
        F.posexplode(F.regexp_extract_all("text", F.lit(r"[^.!?\n]+[.!?]*"), F.lit(0))).alias(
            "no", "sentence"
        ),
    ).withColumn("sentence", X.strip(F.col("sentence"))).where("sentence != ''")
    words = parts.select(
        "conv_id", "turn", "no", F.explode(X.letter_tokens(F.col("sentence"))).alias("word")
    )
    # Written, as it is used twice. Words of a ``FREQUENT``-th of all, which are fewer than that many, are looked up
    # by broadcast; no other word is hot enough to burden the task that joins it.
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("total")))
    every = counts.agg(F.coalesce(F.sum("total"), F.lit(0))).scalar()
    often = F.broadcast(counts.where(F.col("total") * FREQUENT > every))
    known = words.join(often, "word", "left")
    rare = known.where("total IS NULL").drop("total").join(counts, "word")
    scores = (
        known.where("total IS NOT NULL").unionByName(rare)
        .groupBy("conv_id", "turn", "no")
        .agg(F.round(F.avg("total"), 6).alias("score"))
    )
    best = Window.partitionBy("conv_id").orderBy(F.desc("score"), "turn", "no")
    kept = scores.withColumn("place", F.row_number().over(best)).where(F.col("place") <= sentences)
    texts = kept.join(parts, ["conv_id", "turn", "no"])
    items = F.array_sort(F.collect_list(F.struct("turn", "no", "sentence")))
    return texts.groupBy("conv_id").agg(
        F.array_join(F.transform(items, lambda s: s["sentence"]), " ").alias("summary")
    )


def build_prompt(questions: DataFrame, instruction: str = INSTRUCTION) -> DataFrame:
    """Add the three messages to rows of ``question, context, chat_history``.

    The order is task, memory and context, question; missing text is empty.
    """

    def filled(template: str, **values: object) -> F.Column:
        parts = []
        for piece in template.replace("}", "{").split("{"):
            parts.append(values[piece] if piece in values else F.lit(piece))
        return F.concat(*parts)

    def known(name: str) -> F.Column:
        return F.coalesce(F.col(name), F.lit(""))

    return questions.withColumns(
        {
            "system": filled(SYSTEM_TEXT, instruction=F.lit(instruction)),
            "memory": filled(CONTEXT_TEXT, chat_history=known("chat_history"), context=known("context")),
            "human": filled(QUESTION_TEXT, question=known("question")),
        }
    )


def prompt_messages() -> F.Column:
    """The three messages as an array of ``(role, content)``."""
    pairs = (("system", "system"), ("assistant", "memory"), ("user", "human"))
    return F.array(
        *[F.struct(F.lit(role).alias("role"), F.col(c).alias("content")) for role, c in pairs]
    )


def until_exit(messages: DataFrame, word: str = "exit") -> DataFrame:
    """Messages before the one with which the user of a conversation ends it, in any case."""
    ends = (
        messages.where((F.col("role") == "user") & X.same_text(F.col("text"), F.lit(word)))
        .groupBy("conv_id")
        .agg(F.min("turn").alias("_end"))
    )
    open_ended = F.col("_end").isNull()
    return (
        messages.join(ends, "conv_id", "left")
        .where(open_ended | (F.col("turn") < F.col("_end")))
        .select(*messages.columns)
    )


def append_turns(messages: DataFrame, answers: DataFrame) -> DataFrame:
    """New messages: the question and the answer of each ``conv_id, question, answer`` row.

    They get the two turns after the last one of their conversation, or 0 and 1.
    """
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    start = F.coalesce(F.col("_last"), F.lit(-1))
    turns = F.array(
        F.struct((start + 1).alias("turn"), F.lit("user").alias("role"), F.col("question").alias("text")),
        F.struct((start + 2).alias("turn"), F.lit("assistant").alias("role"), F.col("answer").alias("text")),
    )
    return (
        answers.join(last, "conv_id", "left")
        .select("conv_id", F.explode(turns).alias("_t"))
        .select("conv_id", "_t.*")
    )
