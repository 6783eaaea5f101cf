"""Language identification by a small convolutional network over bytes.

A text is cut into windows of ``WINDOW`` bytes over its whole length. A window's bytes are embedded,
filters of several widths slide over them, each keeps its greatest answer, and a softmax over those
gives the languages. A text gets the mean of its windows, weighted by their letters. The
network is trained in numpy on a bounded sample: the ``PER_LANGUAGE`` rows of each language with the
smallest hashes, ``WINDOWS`` windows of each. Its weights, some hundred kilobytes, go out with the
tasks.

Defined results: a null text, or one without letters, is ``und`` with score 0; null languages are not
learned; a language column without values makes every text ``und``; an empty table gives no rows.
Very long texts are read window by window in batches of ``BATCH``. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import SEED, materialise

WINDOW, BATCH = 256, 32
#: Bounds of the training sample: rows of a language, windows of a row, rows of all languages.
PER_LANGUAGE, WINDOWS, ROWS = 1500, 2, 60000
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 6
WIDEST = max(WIDTHS)
#: Which inputs each filter sees: a narrower one looks at the first bytes of the widest stretch.
MASK = np.hstack(
    [np.repeat(np.arange(WIDEST) < width, EMBED)[:, None].repeat(FILTERS, 1) for width in WIDTHS]
).astype("f4")
UNKNOWN = "und"
_STEPS, _RATE, _SIZE = 900, 3e-3, 64


@dataclass
class Network:
    """Embedding (257 x EMBED, the last row for padding), filters side by side, output layer."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def windows_of(text: str, most: int | None = None) -> np.ndarray:
    """The text's bytes as rows of ``WINDOW``, filled up with 256; evenly spread ones if ``most``."""
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    rows = max(1, -(-len(data) // WINDOW))
    out = np.full(rows * WINDOW, 256, np.int16)
    out[: len(data)] = data
    out = out.reshape(rows, WINDOW)
    if most is not None and rows > most:
        out = out[np.linspace(0, rows - 1, most).astype(int)]
    return out


def _letters(windows: np.ndarray) -> np.ndarray:
    """Letters of each window: ASCII letters and bytes of other signs, and a little for padding."""
    low = windows | 32
    return ((low >= 97) & (low <= 122) & (windows < 128) | (windows >= 128) & (windows < 256)).sum(1)


def _answers(w: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
    """Every filter at every place, n x places x filters, by one product.

    The embeddings of neighbouring bytes lie side by side, so a stretch is a row of a strided view.
    """
    flat = w["embed"][windows].reshape(len(windows), -1)
    step = flat.strides[1]
    rows = np.lib.stride_tricks.as_strided(
        flat, (len(flat), WINDOW - WIDEST + 1, WIDEST * EMBED), (flat.strides[0], step * EMBED, step)
    )
    return (rows.reshape(-1, WIDEST * EMBED) @ w["filters"]).reshape(len(flat), -1, len(MASK[0]))


def _softmax(w: dict[str, np.ndarray], raw: np.ndarray) -> np.ndarray:
    scores = np.maximum(raw, 0) @ w["out"] + w["out_bias"]
    p = np.exp(scores - scores.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = _STEPS) -> Network:
    """Adam on the cross-entropy of single windows."""
    rng = np.random.default_rng(SEED)
    total = MASK.shape[1]
    w = {
        "embed": rng.normal(0, 0.5, (257, EMBED)).astype("f4"),
        "filters": rng.normal(0, 0.25, MASK.shape).astype("f4") * MASK,
        "bias": np.zeros(total, "f4"),
        "out": rng.normal(0, total**-0.5, (total, len(languages))).astype("f4"),
        "out_bias": np.zeros(len(languages), "f4"),
    }
    first = {k: np.zeros_like(v) for k, v in w.items()}
    second = {k: np.zeros_like(v) for k, v in w.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(windows), _SIZE)
        batch = windows[rows]
        answers = _answers(w, batch)
        at = answers.argmax(1)
        raw = np.take_along_axis(answers, at[:, None], 1)[:, 0] + w["bias"]
        d = _softmax(w, raw)
        d[np.arange(len(rows)), labels[rows]] -= 1
        d /= len(rows)
        back = (d @ w["out"].T) * (raw > 0)
        bytes_at = batch[np.arange(len(rows))[:, None, None], at[:, :, None] + np.arange(WIDEST)]
        stretch = w["embed"][bytes_at].reshape(len(rows), total, -1)
        to_x = np.einsum("nf,kf->nfk", back, w["filters"]).reshape(-1, EMBED)
        embed = np.zeros_like(w["embed"])
        np.add.at(embed, bytes_at.reshape(-1), to_x)
        grad = {
            "embed": embed,
            "filters": np.einsum("nfk,nf->kf", stretch, back) * MASK,
            "bias": back.sum(0),
            "out": np.maximum(raw, 0).T @ d,
            "out_bias": d.sum(0),
        }
        for k in w:
            first[k] = 0.9 * first[k] + 0.1 * grad[k]
            second[k] = 0.999 * second[k] + 0.001 * grad[k] ** 2
            rate = _RATE * (1 - step / (steps + 1)) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
            w[k] = (w[k] - rate * first[k] / (second[k] ** 0.5 + 1e-8)).astype("f4")
    return Network(languages, w)


def fit(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    rows: int = ROWS,
) -> Network | None:
    """A network learned from at most ``rows`` labelled rows; None if there are none.

    Ids only choose which rows are seen: the first of each language by a hash. Counts by powers of two of that
    hash tell where they end, so only about twice as many texts as are taken are shuffled, however many a language
    has. Of each row the driver gets ``WINDOWS`` windows.
    """
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")

    def shorten(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cells = [windows_of(t, WINDOWS).tobytes() for t in batch["text"]]
            yield pd.DataFrame(
                {"lang": batch["lang"], "draw": batch["draw"], "place": batch["place"], "cells": cells}
            )

    text = F.col(text_col)
    draw = F.xxhash64(id_col, F.lit(SEED))
    # The draw as a number from 0; each step holds about as many rows as all steps below it.
    step = F.floor(F.log2(F.greatest(draw.cast("double") + 2.0**63, F.lit(1.0))))
    own = labelled.where(F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), text.alias("text"), F.col(id_col).alias("doc_id"),
        draw.alias("draw"), step.alias("step"),
    )
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("step")) - F.col("n")
    cuts = (
        own.groupBy("lang", "step").agg(F.count("*").alias("n"))
        .select(F.col("lang").alias("of"), "step", before.alias("before"))
        .where(F.col("before") < per_language)
        .groupBy("of").agg(F.max("step").alias("cut"))
    )
    chosen = (
        own.join(materialise(cuts), (F.col("lang") == F.col("of")) & (F.col("step") <= F.col("cut")))
        .select("lang", "text", "doc_id", "draw", F.row_number().over(order).alias("place"))
        .where(F.col("place") <= per_language)
        .select("lang", "draw", "place", "text")
        .mapInPandas(shorten, "lang string, draw long, place int, cells binary")
        .orderBy("place", "draw")  # the first of every language, then the second: none is cut before another
        .limit(rows)
        .collect()
    )
    if not chosen:
        return None
    languages = sorted({r["lang"] for r in chosen})
    chosen.sort(key=lambda r: (r["draw"], r["lang"]))
    cells = [np.frombuffer(r["cells"], np.int16).reshape(-1, WINDOW) for r in chosen]
    labels = np.repeat([languages.index(r["lang"]) for r in chosen], [len(c) for c in cells])
    return train(np.concatenate(cells), labels, languages)


def predict(network: Network | None, text: str | None) -> tuple[str, float]:
    """The language of a whole text and its share of the evidence."""
    if network is None or not text or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0
    windows = windows_of(text)
    total = np.zeros(len(network.languages))
    weights = _letters(windows) + 1e-6
    for i in range(0, len(windows), BATCH):
        raw = _answers(network.weights, windows[i : i + BATCH]).max(1) + network.weights["bias"]
        total += weights[i : i + BATCH] @ _softmax(network.weights, raw)
    best = int(total.argmax())
    return network.languages[best], float(min(1.0, total[best] / weights.sum()))


def identify(
    docs: DataFrame, network: Network | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = [predict(sent.value, t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "lang_pred": [a for a, _ in answers],
                    "score": [b for _, b in answers],
                }
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInPandas(run, "doc_id long, lang_pred string, score double")


def filter_known(
    docs: DataFrame, network: Network, certain: float, text_col: str = "text"
) -> DataFrame:
    """The rows, with all their columns, whose language is known with at least that score."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    @F.pandas_udf("boolean")
    def known(texts: pd.Series) -> pd.Series:
        answers = (predict(sent.value, t) for t in texts)
        return pd.Series([lang != UNKNOWN and score >= certain for lang, score in answers], dtype=bool)

    return docs.where(known(F.col(text_col)))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no network may learn from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def crc_of(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())
