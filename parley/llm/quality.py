"""Ordinal quality grades by cumulative-link regression on hashed text.

Grades 0..n share one weight per hashed token and differ in ordered thresholds:
P(grade > g) = sigmoid(score - threshold[g]). Tokens are words in lower case, runs of signs and how often a token repeats at once; a text
scores the sum of the weights of its different tokens, divided by the fourth root of their number. The
expected grade is the sum of the tail probabilities; selection uses the tail above a grade.

The model is fitted in numpy on a bounded sample, the ``ROWS`` rated rows with the smallest hashes, as far as
they have ``TOKENS`` different tokens in all; the driver gets token hashes only. Ratings that lie in a table of their own
are drawn before a text is fetched, so texts without a drawn rating aren't shuffled. Scoring sends ``SIZE`` weights
to the tasks.

Defined results: a null, empty or blank text has score 0, hence the grade of the thresholds
alone; rows without a rating or a text are not learned from; without any rating every grade is as
likely as the even thresholds say; an empty table gives no rows. Several ratings of one row id all
count. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import probably_in
from parley.session import SEED, materialise

SIZE = 1 << 18
#: Most rated rows that a fit looks at, and most different tokens of all of them (128 MB).
ROWS, TOKENS = 40000, 1 << 25
EPOCHS, BATCH, RATE, DECAY = 10, 64, 0.3, 3e-3
#: Rated rows that must hold a token before it gets a weight.
LEAST = 4
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")
#: Tokens remembered by a worker before it starts afresh.
_KNOWN = 1 << 20


@dataclass
class Ordinal:
    """Shared weights and rising thresholds; grade g is passed with sigmoid(score - threshold[g])."""

    weights: np.ndarray
    thresholds: np.ndarray


class Hasher:
    """Distinct hashed tokens of a text, and one for the share of tokens that repeat the last one."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        known = self.known
        found = _TOKEN.findall(text.lower()) if text else []
        tokens = set(found)
        if found:
            again = sum(map(eq, found, found[1:]))
            tokens.add(f"repeats {int(log2(1 + 64 * again / len(found)))}")
        if len(known) > _KNOWN:
            known.clear()
        out = np.empty(len(tokens), np.int64)
        for i, token in enumerate(tokens):
            at = known.get(token)
            if at is None:
                at = known[token] = crc32(token.encode("utf-8", "replace")) % SIZE
            out[i] = at
        return np.unique(out)


def score_of(weights: np.ndarray, tokens: np.ndarray) -> float:
    return float(weights[tokens].sum() / max(1, len(tokens)) ** 0.25)


def train(rows: list[np.ndarray], grades: np.ndarray, top: int, epochs: int = EPOCHS) -> Ordinal:
    """Adagrad on the likelihood of the grades; thresholds are a first one plus positive steps."""
    rng = np.random.default_rng(SEED)
    common = np.bincount(np.concatenate([np.empty(0, np.int64), *rows]), minlength=SIZE) >= LEAST
    scale = np.array([1 / max(1, len(r)) ** 0.25 for r in rows])
    rows = [r[common[r]] for r in rows]  # a token of one or two rows would only learn them by heart
    weights = np.zeros(SIZE)
    free = np.zeros(top)  # the first threshold, then logarithms of steps
    seen_w, seen_f = np.full(SIZE, 1e-2), np.full(top, 1e-2)
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            sizes = [len(rows[i]) for i in chosen]
            tokens = np.concatenate([rows[i] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            score = np.bincount(owner, weights[tokens], len(chosen)) * scale[chosen]
            thresholds = free[0] + np.concatenate([[0.0], np.exp(free[1:]).cumsum()])
            passed = 1 / (1 + np.exp(-(score[:, None] - thresholds)))  # P(grade > g)
            tail = np.hstack([np.ones((len(chosen), 1)), passed, np.zeros((len(chosen), 1))])
            slope = np.hstack(
                [np.zeros((len(chosen), 1)), passed * (1 - passed), np.zeros((len(chosen), 1))]
            )
            g, r = grades[chosen], np.arange(len(chosen))
            likely = np.maximum(tail[r, g] - tail[r, g + 1], 1e-9)
            d_score = -(slope[r, g] - slope[r, g + 1]) / likely
            d_threshold = np.zeros((len(chosen), top + 2))
            d_threshold[r, g] += slope[r, g] / likely
            d_threshold[r, g + 1] -= slope[r, g + 1] / likely
            d_threshold = d_threshold[:, 1:-1].sum(0)
            d_free = np.concatenate(
                [[d_threshold.sum()], np.exp(free[1:]) * d_threshold[::-1].cumsum()[::-1][1:]]
            )
            used, back = np.unique(tokens, return_inverse=True)
            d_w = np.bincount(back, (d_score * scale[chosen])[owner]) + DECAY * weights[used]
            seen_w[used] += d_w**2
            weights[used] -= RATE * d_w / np.sqrt(seen_w[used])
            seen_f += d_free**2
            free -= RATE * d_free / np.sqrt(seen_f)
    return Ordinal(weights, free[0] + np.concatenate([[0.0], np.exp(free[1:]).cumsum()]))


def draw(ratings: DataFrame, top: int, id_col: str = "doc_id", grade_col: str = "grade", rows: int = ROWS) -> DataFrame:
    """The ids and grades that a fit looks at: of the ratings from 0 to ``top``, those of the smallest hashes."""
    grade = F.col(grade_col)
    known = ratings.where(grade.between(0, top) & F.col(id_col).isNotNull())
    return materialise(
        known.select(id_col, grade.cast("int").alias(grade_col))
        .orderBy(F.xxhash64(id_col, F.lit(SEED)), grade_col)
        .limit(rows)
    )


def fit_ratings(
    docs: DataFrame,
    ratings: DataFrame,
    top: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    rows: int = ROWS,
) -> Ordinal:
    """``fit`` for ratings in a table of their own: only texts of drawn ids are joined."""
    drawn = draw(ratings, top, id_col, grade_col, rows)
    texts = probably_in(docs.select(id_col, text_col), id_col, drawn)
    return fit(texts.join(drawn, id_col), top, id_col, text_col, grade_col, rows)


def fit(
    rated: DataFrame,
    top: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    rows: int = ROWS,
) -> Ordinal:
    """Learn from at most ``rows`` rows with a grade from 0 to ``top``."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            cells = [hasher(t).astype("<i4").tobytes() for t in batch["text"]]
            yield pd.DataFrame({"draw": batch["draw"], "grade": batch["grade"], "cells": cells})

    grade = F.col(grade_col)
    chosen = (
        rated.where(grade.between(0, top) & F.col(text_col).isNotNull())
        .select(
            F.xxhash64(id_col, F.lit(SEED)).alias("draw"),
            grade.cast("int").alias("grade"),
            F.col(text_col).alias("text"),
        )
        .mapInPandas(hashed, "draw long, grade int, cells binary")
        .orderBy("draw", "grade")
        .limit(rows)
    )
    # ``rows`` rows: one task sums up their tokens in order
    order = Window.orderBy("draw", "grade", "cells").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.sum(F.octet_length("cells") / 4).over(order)
    chosen = chosen.withColumn("held", held).where(F.col("held") <= TOKENS).drop("held").collect()
    if not chosen:
        return Ordinal(np.zeros(SIZE), np.arange(top) - (top - 1) / 2)
    tokens = [np.frombuffer(r["cells"], "<i4").astype(np.int64) for r in chosen]
    return train(tokens, np.array([r["grade"] for r in chosen]), top)


def grade(
    docs: DataFrame,
    model: Ordinal,
    above: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, expected_grade, tail (probability of a grade above ``above``) for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.weights.astype("f4"), model.thresholds)
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, thresholds = sent.value
        hasher = Hasher()
        for batch in batches:
            score = np.array([score_of(weights, hasher(t)) for t in batch["text"]])
            passed = 1 / (1 + np.exp(-(score[:, None] - thresholds)))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "expected_grade": passed.sum(1),
                    "tail": passed[:, above],
                }
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInPandas(run, "doc_id long, expected_grade double, tail double")
