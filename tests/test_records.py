import json

from pyspark.sql import functions as F

from parley.plans.augment import TEMPLATES, augment, generate_questions
from parley.plans import records as R

BASE = ("conv_id long, movie_name string, character_names string, genre string, release_year int, "
        "imdb_rating double, num_imdb_votes long, utterance string, response string, "
        "plot_outline string, instruction string")


def base(frame):
    return frame(
        [(1, "film", "A, B", "drama", 1999, 6.5, 12, "hi", "yo", "p", "go on"),
         (2, "film", "A, C", "war", 2000, 7.5, 13, "hi2", "yo2", None, "go on"),
         (3, "other", None, "Unknown", None, 5.0, 9, "x", "y", None, "go on")],
        BASE,
    )


def test_questions(frame):
    asked = generate_questions(base(frame).where("conv_id in (1, 3)"), "movie_name").collect()
    by = {(r.movie_name, r.response) for r in asked}
    assert by == {("film", "drama"), ("film", "1999"), ("film", "6.5"), ("film", "12"),
                  ("other", "5.0"), ("other", "9")}
    wordings = {w.replace("{movie_name}", n) for ws in TEMPLATES.values() for w in ws
                for n in ("film", "other")}
    assert {r.utterance for r in asked} <= wordings
    assert {r.instruction for r in asked} == {"Answer the following question:"}


def test_template_counts():
    assert {k: len(v) for k, v in TEMPLATES.items()} == {
        "genre": 7, "release_year": 7, "imdb_rating": 5, "num_imdb_votes": 4
    }


def test_augment(frame):
    rows = base(frame)
    assert augment(rows, "conv_id", enabled=False).count() == 3
    grown = augment(rows, "conv_id", fraction=1.0)
    new = grown.where("conv_id is null").collect()
    assert grown.count() == 3 + 6 and len(new) == 6
    film = [r for r in new if r.movie_name == "film"]
    assert {r.response for r in film} == {"drama", "1999", "7.0", "12"}
    assert {r.character_names for r in film} == {"A, B"} and {r.plot_outline for r in film} == {None}


def test_records_and_combine(frame):
    dialogue = R.to_instruction_rows(base(frame), "dialogue")
    qa = R.to_instruction_rows(
        frame([("q?", "a", "film", None)], "question string, response string, movie_name string, year int"),
        "qa",
    )
    rows = R.combine(dialogue, qa)
    both = rows.select("type", R.json_records(rows).alias("j")).collect()
    parsed = [(r.type, json.loads(r.j)) for r in both]
    record = next(p for t, p in parsed if t == "qa")
    assert record == {
        "split": "train", "type": "qa", "instruction": "Answer the following question:", "input": "q?",
        "context": {"movie_name": "film", "character_names": None, "genre": "Unknown", "year": None,
                    "imdb_rating": None, "num_imdb_votes": None, "plot_outline": "Unknown",
                    "additional_information": None},
        "response": "a",
    }
    assert list(record["context"]) == ["movie_name", "character_names", "genre", "year", "imdb_rating",
                                       "num_imdb_votes", "plot_outline", "additional_information"]
    assert sum(t == "dialogue" for t, _ in parsed) == 3


def test_on_null(frame):
    kept = R.to_instruction_rows(base(frame), "dialogue", "keep").where("input = 'x'").first()
    filled = R.to_instruction_rows(base(frame), "dialogue", "default").where("input = 'x'").first()
    assert kept.context.character_names is None and filled.context.character_names == "Unknown"


def test_prompt(frame):
    rows = R.to_instruction_rows(
        base(frame).withColumn("utterance", F.lit("say {response}")).where("conv_id = 1"), "dialogue")
    text = R.format_prompt(rows, "{instruction}|{context}|{input}|{response}", "<e>").first().text
    assert text == ("go on|Movie: film\nCharacters: A, B\nGenre: drama\nYear: 1999\nRating: 6.5\n"
                    "Votes: 12\nPlot: p|say {response}|yo<e>")
    assert R.format_prompt(rows).columns == ["text"]
    assert R.format_prompt(rows, split="val").count() == 0


def test_training_texts(frame):
    records = R.to_instruction_rows(
        base(frame).withColumn("split", F.when(F.col("conv_id") == 1, "val").otherwise("train")), "dialogue")
    texts = R.training_texts(records, "{input} {response}", "", 1)
    assert {r.kept_text for r in texts["train"].collect()} == {"hi2", "x"}
    assert [(r.n_tokens, r.kept_text) for r in texts["val"].collect()] == [(2, "hi")]


def test_truncate(frame):
    rows = frame([(1, " a  b c"), (2, "a b"), (3, "")], "i int, t string")
    got = R.truncate_tokens(rows, "t", 2).orderBy("i").collect()
    assert [(r.n_tokens, r.truncated, r.kept_text) for r in got] == [
        (3, True, " a  b"), (2, False, "a b"), (0, False, "")
    ]


def test_uncut_prompt_keeps_its_layout(frame):
    prompt = "### Instruction:\nGo on.\n\n### Input:\n  hi\tthere \n"
    rows = frame([(1, prompt), (2, None)], "i int, t string")
    got = {r.i: r.kept_text for r in R.truncate_tokens(rows, "t", 8).collect()}
    assert got == {1: prompt, 2: None}
    assert R.truncate_tokens(rows, "t", 4).where("i = 1").first().kept_text == "### Instruction:\nGo on."
