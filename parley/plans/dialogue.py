"""Raw dialogue tables to one row per conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.functions import text as X
from parley.operators.lookup import one_per_key

LINE_BREAK = "\n "

# Fixed value: the task line of a dialogue record.
DIALOGUE_INSTRUCTION = "Continue the conversation between the characters."


def clean_lines(lines: DataFrame) -> DataFrame:
    return lines.withColumn("character_name", X.title_case(F.col("character_name")))


def clean_characters(characters: DataFrame) -> DataFrame:
    return characters.withColumn("character_name", X.title_case(F.col("character_name")))


def clean_titles(titles: DataFrame) -> DataFrame:
    return titles.withColumns(
        {
            "release_year": X.digits_to_int(F.col("release_year")),
            "genre": X.quoted_text(F.col("genre")),
            "imdb_rating": F.round(F.col("imdb_rating").cast("double"), 1),
        }
    )


def clean_conversations(conversations: DataFrame) -> DataFrame:
    return conversations.withColumn("line_ids", X.quoted_items(F.col("line_id_list"))).drop(
        "line_id_list"
    )


def stitch(spoken: DataFrame, min_turns: int = 1, segment: int = 1024) -> DataFrame:
    """``(conv_id, pos, utterance)`` to ``(conv_id, input, response, n_turns)``.

    The last utterance is the response, all others joined are the input; a conversation of
    one line has it on both sides. Null lines do not take part. Long conversations are
    joined in segments of ``segment`` positions, which spread over tasks; the second shuffle
    only carries joined segments.
    """
    segments = (
        spoken.where(F.col("utterance").isNotNull())
        .groupBy("conv_id", F.floor(F.col("pos") / segment).alias("seg"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "utterance"))).alias("items"))
        .select(
            "conv_id",
            F.struct(
                "seg",
                F.when(
                    F.size("items") > 1,
                    F.array_join(
                        F.transform(
                            F.slice("items", 1, F.size("items") - 1), lambda x: x["utterance"]
                        ),
                        LINE_BREAK,
                    ),
                ).alias("head"),
                F.element_at("items", -1)["utterance"].alias("last"),
                F.size("items").alias("n"),
            ).alias("part"),
        )
    )
    whole = (
        segments.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list("part")).alias("parts"), F.sum("part.n").alias("n_turns"))
        .where(F.col("n_turns") >= min_turns)
        .withColumn(
            "texts", F.flatten(F.transform("parts", lambda s: F.array(s["head"], s["last"])))
        )
    )
    before_last = F.array_join(F.slice("texts", 1, F.size("texts") - 1), LINE_BREAK)
    response = F.element_at("texts", -1)
    return whole.select(
        "conv_id",
        F.when(F.col("n_turns") > 1, before_last).otherwise(response).alias("input"),
        response.alias("response"),
        "n_turns",
    )


def spoken_lines(conversations: DataFrame, lines: DataFrame) -> DataFrame:
    """Explode the line ids of each conversation and look the lines up, keeping list order.

    Ids without a line are dropped. ``conversations`` needs ``conv_id`` and ``line_ids``.
    """
    exploded = conversations.select("conv_id", F.posexplode("line_ids").alias("pos", "line_id"))
    said = lines.select(
        "line_id", X.speak(F.col("character_name"), F.col("utterance")).alias("utterance")
    )
    return exploded.join(said, "line_id").select("conv_id", "pos", "utterance")


def build_dialogue(
    conversations: DataFrame,
    lines: DataFrame,
    titles: DataFrame,
    characters: DataFrame,
    details: DataFrame,
    min_turns: int = 1,
) -> DataFrame:
    """One instruction row per distinct conversation (and per distinct plot outline).

    Inputs are cleaned tables; ``conversations`` carries a ``conv_id``. Conversations of an
    unknown title or first character are dropped, an unknown second character leaves
    ``character_names`` null. Equal rows are merged before the details are joined, so the
    join meets every distinct row once; ``conv_id`` is the smallest of the merged ones.
    """
    people = one_per_key(characters, "character_id", ["character_name"])
    second = people.select(
        F.col("character_id").alias("character_id2"),
        F.col("character_name").alias("character_name2"),
    )
    heads = (
        conversations.select("conv_id", "movie_id", "character_id1", "character_id2")
        .join(titles, "movie_id")
        .join(
            people.withColumnsRenamed(
                {"character_id": "character_id1", "character_name": "character_name1"}
            ),
            "character_id1",
        )
        .join(second, "character_id2", "left")
        .select(
            "conv_id",
            F.concat("character_name1", F.lit(", "), "character_name2").alias("character_names"),
            "movie_name",
            "release_year",
            "imdb_rating",
            "num_imdb_votes",
            "genre",
        )
    )
    content = [c for c in heads.columns if c != "conv_id"]
    # Equal rows have equal digests; of each digest a task hands on its first row only, and texts are never compared.
    digest = F.sha2(F.to_json(F.struct(*content, "utterance", "response")), 256)
    first = Window.partitionBy("_digest").orderBy("conv_id")
    rows = (
        heads.join(stitch(spoken_lines(conversations, lines), min_turns), "conv_id")
        .withColumnRenamed("input", "utterance")
        .withColumn("_digest", digest)
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .drop("_digest", "_n", "n_turns")
    )
    outlines = details.select("movie_name", "plot_outline").distinct()
    return (
        rows.join(outlines, "movie_name", "left")
        .dropna(subset=["utterance", "response"])
        .select(
            "conv_id",
            *content,
            "utterance",
            "response",
            "plot_outline",
            F.lit(DIALOGUE_INSTRUCTION).alias("instruction"),
        )
    )
