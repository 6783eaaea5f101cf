from __future__ import annotations

import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parley.llm import language, quality, token_counts, tokens
from parley.llm.queries import personal_data

SF = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    network = language.fit(docs.where(~language.held_out()))
    told = language.identify(docs, network).join(docs.select("doc_id", "lang", "text"), "doc_id")
    rows = told.where(language.held_out() & F.col("lang").isNotNull()).collect()
    assert all((r.lang_pred == "und") == (not any(map(str.isalpha, r.text or ""))) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    # What is predicted does not depend on language, source or id.
    other = docs.select((-F.col("doc_id")).alias("doc_id"), "text").withColumn("lang", F.lit("zz"))
    again = {-r.doc_id: (r.lang_pred, r.score) for r in language.identify(other, network).collect()}
    assert all(again[r.doc_id] == (r.lang_pred, r.score) for r in rows)


def test_held_out_is_crc32():
    import zlib

    assert language.crc_of(12) == zlib.crc32(b"12")


def test_hard_languages(hard, empty):
    network = language.fit(hard)
    rows = {r.doc_id: r for r in language.identify(hard, network).collect()}
    assert len(rows) == len({r.doc_id for r in hard.collect()})
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (2, 3, 4, 8))
    assert rows[7].lang_pred in {"en", "de"} and rows[6].lang_pred in {"en", "de"}
    kept = language.filter_known(hard, network, 0.0)
    assert kept.columns == hard.columns and kept.count() == hard.count() - 4
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.identify(hard, None).collect()} == {"und"}
    assert language.identify(empty, network).collect() == []


def test_whole_texts_are_read():
    windows = language.windows_of("a" * 1000)
    assert windows.shape == (4, 256) and (windows < 256).sum() == 1000


def test_grades_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 0).otherwise(F.when(F.col("quality") == 1, 2).otherwise(1))
    rated = docs.join(labels.select("doc_id", grade.alias("grade")), "doc_id")
    model = quality.fit(rated.where("doc_id % 4 <> 0"), top=2)
    assert np.all(np.diff(model.thresholds) > 0)
    rows = quality.grade(rated.where("doc_id % 4 = 0"), model, above=1).join(rated, "doc_id").collect()
    clean = [r.tail >= 0.5 for r in rows if r["grade"] == 2]
    poor = [r.tail < 0.5 for r in rows if r["grade"] == 1]
    assert np.mean(clean) > 0.97 and np.mean(poor) > 0.75
    mean = [np.mean([r.expected_grade for r in rows if r["grade"] == g]) for g in range(3)]
    assert mean[2] > mean[1] and mean[2] > mean[0]


def test_gradients():
    """A step along the fit raises the likelihood of an easy sample."""
    rows = [np.array([g, 3 + g]) for g in (0, 1, 2)] * 30
    model = quality.train(rows, np.array([0, 1, 2] * 30), 2, epochs=60)
    scores = [quality.score_of(model.weights, r) for r in rows[:3]]
    assert scores[0] < model.thresholds[0] < scores[1] < model.thresholds[1] < scores[2]


def test_hard_grades(hard, empty):
    rated = hard.withColumn("grade", F.when(F.col("doc_id") > 0, F.col("doc_id") % 3))
    model = quality.fit(rated, top=2)
    rows = quality.grade(hard, model, above=1).collect()
    assert len(rows) == hard.count()
    blank = {(r.expected_grade, r.tail) for r in rows if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1
    assert quality.grade(empty, quality.fit(empty.withColumn("grade", F.lit(1)), 2), 1).collect() == []


ENCODE = tokens.load(tokens.default_path())
_PIECE = st.one_of(
    st.text(string.ascii_letters + "'  \n\t.é1", max_size=12), st.sampled_from([" ", "  ", "'ll", "日本", "\U0001f600"])
)
_TEXT = st.lists(_PIECE, max_size=25).map("".join)


@settings(max_examples=300, deadline=None)
@given(_TEXT, st.lists(st.tuples(st.integers(-2, 90), st.integers(-1, 9), _PIECE), max_size=6), st.sampled_from([1, 4, 16]))
def test_counts_follow_edits(text, edits, size):
    tree = token_counts.build(text, ENCODE, size)
    assert tree.total == len(ENCODE(text)) and tree.text == text
    expected = text
    for start, length, new in reversed(token_counts.ordered(edits, len(text))):
        expected = expected[:start] + new + expected[start + length :]
    token_counts.edit(tree, edits, ENCODE, size)
    assert tree.text == expected and tree.total == len(ENCODE(expected))
    assert tree.chars[1] == len(expected)


def masked(text):
    text = re.sub(r"[\w.+-]{1,64}@[\w-]{1,63}(?:\.[\w-]{1,63}){1,8}", "[mail]", text)
    return re.sub(r"(?<!\d)\d{1,3}(?:\.\d{1,3}){3}(?!\d)", "[address]", text)


def test_counts_of_masked_documents(docs):
    rows = {r.doc_id: r for r in token_counts.recount_by_rule(docs, personal_data).collect()}
    edited = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        after, r = masked(text or ""), rows[doc_id]
        assert (r.tokens_before, r.tokens_after, r.chars_after) == (len(ENCODE(text or "")), len(ENCODE(after)), len(after))
        edited += r.edits > 0
        assert r.encoded_chars <= 1200 * r.edits
    assert edited > 5


def test_counts_of_an_edit_table(spark, hard, empty):
    edits = spark.createDataFrame(
        [(1, 0, 5, "x"), (1, 3, 4, None), (2, 0, 0, "new"), (5, 99, 3, " end"), (77, 0, 1, ""), (6, 5, 1, "  "), (3, None, None, None)],
        "doc_id long, start long, length long, text string",
    )
    rows = token_counts.recount(hard, edits).collect()
    assert len(rows) == hard.count()
    own = {r.doc_id: r for r in rows}
    assert own[2].tokens_before == 0 and own[2].tokens_after == len(ENCODE("new"))
    assert own[5].tokens_after == len(ENCODE("alphabetagamma end"))
    assert own[1].chars_after == len("x" + " beta  gamma\n"[2:])
    assert own[8].tokens_before == own[8].tokens_after and own[8].encoded_chars == 0
    assert token_counts.recount(empty, edits).collect() == []


def test_leaves_end_where_the_pattern_does():
    for text in ("a b  c d", "x " * 50, "word" * 100, " a", "a ", ""):
        for size in (1, 3):
            assert "".join(token_counts.split(text, size)) == text
    with pytest.raises(StopIteration):
        next(iter(token_counts.ordered([], 5)))


def test_rare_languages_stay_when_rows_are_cut(spark):
    rows = [(i, f"many words of number {i}", "aa") for i in range(400)]
    rows += [(1000 + i, f"seltene Zeilen Nummer {i}", lang) for lang in ("bb", "cc") for i in range(2)]
    network = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=9)
    assert network.languages == ["aa", "bb", "cc"]


def test_ratings_are_drawn_before_texts(docs, spark):
    """The same model as from joined rows, and no plan step shuffles all texts."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality IS NOT NULL AND toxic IS NOT NULL")
    ratings = labels.select("doc_id", F.when(F.col("toxic") == 1, 0).otherwise(F.col("quality") + 1).alias("grade"))
    joined = quality.fit(docs.join(ratings, "doc_id"), top=2, rows=40)
    drawn = quality.draw(ratings, 2, rows=40)
    assert drawn.count() == 40
    apart = quality.fit_ratings(docs, ratings, top=2, rows=40)
    assert np.array_equal(joined.weights, apart.weights) and np.array_equal(joined.thresholds, apart.thresholds)


def test_sample_is_bounded_in_tokens(docs, monkeypatch):
    rated = docs.withColumn("grade", (F.col("doc_id") % 3).cast("int"))
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, grades, top: seen.append(sum(map(len, rows))))
    for most in (1 << 25, 5000):
        monkeypatch.setattr(quality, "TOKENS", most)
        quality.fit(rated, top=2)
    assert seen[0] > 5000 >= seen[1] > 0


def test_gradients_of_grades():
    """One step moves the weights against the numeric gradient of the likelihood."""
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(12, 5, replace=False)) for _ in range(30)]
    grades = rng.integers(0, 3, 30)
    model = quality.train(rows, grades, 2, epochs=3)

    def loss(weights, thresholds):
        total = 0.0
        for r, g in zip(rows, grades):
            passed = 1 / (1 + np.exp(-(weights[r].sum() / len(r) ** 0.25 - thresholds)))
            tail = np.concatenate([[1.0], passed, [0.0]])
            total -= np.log(tail[g] - tail[g + 1])
        return total

    start = loss(np.zeros(quality.SIZE), np.array([0.0, 1.0]))
    assert loss(model.weights, model.thresholds) < start
    # at the optimum of many epochs the numeric gradient of loss and decay vanishes nearly
    model = quality.train(rows, grades, 2, epochs=3000)
    steps = []
    for i in range(12):
        up, down = model.weights.copy(), model.weights.copy()
        up[i] += 1e-5
        down[i] -= 1e-5
        steps.append((loss(up, model.thresholds) - loss(down, model.thresholds)) / 2e-5 + quality.DECAY * model.weights[i])
    assert np.abs(steps).max() < 0.2
