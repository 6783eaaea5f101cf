"""Text scores: n-gram overlap, longest common subsequence, vector matching, token ids."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions import text as X
from parley.operators.batches import in_runs
from parley.operators.knn import matrix
from parley.session import materialise

PADDING = -100
#: Tokens of the pairs whose n-grams are matched at a time.
GRAM_TOKENS = 1 << 16


# --- token ids -------------------------------------------------------------------------------


def argmax_ids(logits: Column) -> Column:
    """Index of the greatest value of each inner array; the first one on a tie."""
    return F.transform(
        logits, lambda row: (F.array_position(row, F.array_max(row)) - 1).cast("int")
    )


def unmask(ids: Column, pad: int = 0) -> Column:
    """Replace the padding mark by the pad token."""
    return F.transform(ids, lambda x: F.when(x == PADDING, pad).otherwise(x))


def decode(df: DataFrame, key: str, ids: str, vocabulary: DataFrame,
           specials: Sequence[int] = (0,), separator: str = " ") -> DataFrame:
    """``key, text``: token ids looked up in ``(token_id, token)`` and joined in order.

    Special and unknown tokens are skipped. ``key`` must be unique, so a group is one array.
    """
    tokens = df.select(key, F.posexplode(ids).alias("_pos", "token_id")).join(
        vocabulary.where(~F.col("token_id").isin(*specials)).select("token_id", "token"), "token_id"
    )
    items = F.array_sort(F.collect_list(F.struct("_pos", "token")))
    texts = tokens.groupBy(key).agg(
        F.array_join(F.transform(items, lambda x: x["token"]), separator).alias("text")
    )
    return df.select(key).join(texts, key, "left").select(
        key, X.strip(F.coalesce("text", F.lit(""))).alias("text")
    )


# --- n-grams ---------------------------------------------------------------------------------


def common_grams(prediction: pa.ListArray, reference: pa.ListArray, max_n: int) -> np.ndarray:
    """Shared n-grams of each pair of token lists, repeated ones as often as both have them.

    One row per pair, one column per n. Tokens and n-grams are numbered for all pairs at
    once, so there is no loop over pairs or tokens.
    """
    sides = (prediction, reference)
    n_pairs = len(prediction)
    codes = pa.concat_arrays([s.flatten() for s in sides]).dictionary_encode().indices.to_numpy()
    lengths = [np.diff(s.offsets.to_numpy()) for s in sides]
    ends = np.concatenate(lengths).cumsum()
    left = np.repeat(ends, np.concatenate(lengths)) - np.arange(len(codes))  # tokens to the end
    row = np.concatenate([np.repeat(np.arange(n_pairs), n) for n in lengths])
    is_prediction = np.arange(len(codes)) < lengths[0].sum()
    base = int(codes.max(initial=0)) + 1
    shared = np.zeros((n_pairs, max_n), dtype=np.int64)
    grams = codes.astype(np.int64)
    for n in range(1, max_n + 1):
        at = np.flatnonzero(left >= n)
        if n > 1:
            grams[at], _ = pd.factorize(grams[at] * base + codes[at + n - 1])
        keys, found = pd.factorize(row[at] * (int(grams.max(initial=0)) + 1) + grams[at])
        mine = is_prediction[at]
        counts = [np.bincount(keys[m], minlength=len(found)) for m in (mine, ~mine)]
        owner = np.zeros(len(found), dtype=np.int64)
        owner[keys] = row[at]
        shared[:, n - 1] = np.bincount(owner, np.minimum(*counts), minlength=n_pairs)
    return shared


def gram_matches(pairs: DataFrame, tokens: Callable[[Column], Column], max_n: int) -> DataFrame:
    """``pair_id`` and, for each n, ``match{n}, p{n}, r{n}``: shared n-grams and those of each side.

    A pair is one row, so its n-grams are matched where it is. Counting them by an exploded
    aggregation would shuffle every n-gram of the corpus.
    """
    sizes = range(1, max_n + 1)

    def shared_by(prediction: pa.Array, reference: pa.Array) -> pa.Array:
        shared = common_grams(prediction, reference, max_n)
        offsets = np.arange(0, shared.size + 1, max_n, dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(shared.ravel()))

    @F.arrow_udf("array<bigint>")
    def match(prediction: pa.Array, reference: pa.Array) -> pa.Array:
        tokens = np.diff(prediction.offsets.to_numpy()) + np.diff(reference.offsets.to_numpy())
        return in_runs(shared_by, tokens, GRAM_TOKENS, prediction, reference)

    words = pairs.select(
        "pair_id",
        tokens(X.strip(F.coalesce("prediction", F.lit("")))).alias("_p"),
        tokens(X.strip(F.coalesce("reference", F.lit("")))).alias("_r"),
    ).withColumn("_match", match("_p", "_r"))

    def grams(column: str, n: int) -> Column:
        return F.greatest(F.size(column) - (n - 1), F.lit(0))

    return words.select(
        "pair_id",
        *[F.get("_match", F.lit(n - 1)).alias(f"match{n}") for n in sizes],
        *[grams("_p", n).alias(f"p{n}") for n in sizes],
        *[grams("_r", n).alias(f"r{n}") for n in sizes],
    )


def bleu(pairs: DataFrame, max_n: int = 4) -> DataFrame:
    """One row ``bleu``: corpus BLEU against one reference per prediction, not smoothed."""
    sizes = range(1, max_n + 1)
    totals = gram_matches(pairs, X.bleu_tokens, max_n).agg(
        F.sum("p1").alias("length"),
        F.sum("r1").alias("reference_length"),
        *[F.sum(f"match{n}").alias(f"m{n}") for n in sizes],
        *[F.sum(f"p{n}").alias(f"p{n}") for n in sizes],
    )
    logs = sum(F.log(F.col(f"m{n}") / F.col(f"p{n}")) for n in sizes)
    brevity = F.when(F.col("length") > F.col("reference_length"), 1.0).otherwise(
        F.exp(1 - F.col("reference_length") / F.col("length"))
    )
    least = F.least(*[F.col(f"m{n}") for n in sizes])
    return totals.select(
        F.when(least > 0, F.exp(logs / max_n) * brevity).otherwise(0.0).alias("bleu")
    )


def f1(match: Column, p: Column, r: Column) -> Column:
    """Harmonic mean of ``match / p`` and ``match / r``; 0 without a match."""
    return F.when(match > 0, 2 * match / (p + r)).otherwise(0.0)


def rouge_n(pairs: DataFrame, max_n: int = 2, unicode: bool = False) -> DataFrame:
    """``pair_id, rouge1, rouge2, ...``: n-gram F1 of each pair."""
    matches = gram_matches(pairs, lambda c: X.rouge_tokens(c, unicode), max_n)
    return matches.select(
        "pair_id",
        *[
            f1(F.col(f"match{n}"), F.col(f"p{n}"), F.col(f"r{n}")).alias(f"rouge{n}")
            for n in range(1, max_n + 1)
        ],
    )


# --- longest common subsequence --------------------------------------------------------------


def _bits(other: Sequence[str]) -> dict[str, int]:
    """The places of every token of a text, as bits."""
    at: dict[str, int] = {}
    for i, token in enumerate(other):
        at[token] = at.get(token, 0) | (1 << i)
    return at


def lcs_rows(row: int, tokens: Sequence[str], at: dict[str, int], full: int) -> Iterator[int]:
    """The bit rows after ``row``, one per token; a zero bit marks a step of the LCS length.

    Bit-parallel: a token costs one addition on as many bits as the other text has tokens.
    """
    for token in tokens:
        hit = row & at.get(token, 0)
        row = ((row + hit) | (row & ~hit)) & full
        yield row


def lcs_length(reference: Sequence[str], other: Sequence[str]) -> int:
    row = full = (1 << len(other)) - 1
    for row in lcs_rows(full, reference, _bits(other), full):
        pass
    return len(other) - row.bit_count()


def lcs_positions(reference: Sequence[str], other: Sequence[str]) -> set[int]:
    """Positions in ``reference`` of one longest common subsequence, read from the end.

    Every ``sqrt(n)``-th row is kept; the rows between two kept ones are made again when the way back gets
    there, so twice the work needs ``2 * sqrt(n)`` rows at a time.
    """
    full, at = (1 << len(other)) - 1, _bits(other)
    step = isqrt(len(reference)) + 1
    kept = [full]
    for n, row in enumerate(lcs_rows(full, reference, at, full), 1):
        if n % step == 0:
            kept.append(row)
    first, rows = len(reference) + 1, []

    def length(i: int, j: int) -> int:
        return j - (rows[i - first] & ((1 << j) - 1)).bit_count()

    i, j, found = len(reference), len(other), set()
    while i and j:
        if i - 1 < first:
            first = (i - 1) // step * step
            some = reference[first : first + step]
            rows = [kept[first // step], *lcs_rows(kept[first // step], some, at, full)]
        if reference[i - 1] == other[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif length(i, j - 1) > length(i - 1, j):
            j -= 1
        else:
            i -= 1
    return found


def union_hits(references: Sequence[Sequence[str]], others: Sequence[Sequence[str]]) -> int:
    """Tokens of the reference sentences covered by any sentence of the other text.

    A token counts as often as both texts have it at most.
    """
    left = Counter(t for s in references for t in s)
    right = Counter(t for s in others for t in s)
    hits = 0
    for sentence in references:
        covered = set().union(*(lcs_positions(sentence, o) for o in others)) if others else set()
        for i in sorted(covered):
            token = sentence[i]
            if left[token] > 0 and right[token] > 0:
                hits += 1
                left[token] -= 1
                right[token] -= 1
    return hits


@F.pandas_udf(T.LongType())
def _lcs(reference: pd.Series, other: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(list(a), list(b)) for a, b in zip(reference, other)])


@F.pandas_udf(T.LongType())
def _union(reference: pd.Series, other: pd.Series) -> pd.Series:
    def lists(sentences):
        return [list(s) for s in sentences]

    return pd.Series([union_hits(lists(a), lists(b)) for a, b in zip(reference, other)])


def rouge_l(pairs: DataFrame, unicode: bool = False) -> DataFrame:
    """``pair_id, rougeL``: F1 of the longest common subsequence of whole texts; no shuffle."""
    tokens = pairs.select(
        "pair_id",
        *[
            X.rouge_tokens(F.coalesce(c, F.lit("")), unicode).alias(c)
            for c in ("prediction", "reference")
        ],
    ).withColumn("_lcs", _lcs("reference", "prediction"))
    return tokens.select(
        "pair_id", f1(F.col("_lcs"), F.size("prediction"), F.size("reference")).alias("rougeL")
    )


def rouge_lsum(pairs: DataFrame, unicode: bool = False) -> DataFrame:
    """``pair_id, rougeLsum``: the same over lines, with the union of their subsequences."""
    def sentences(column: str) -> Column:
        lines = F.filter(F.split(F.coalesce(column, F.lit("")), "\n"), lambda x: x != "")
        return F.transform(lines, lambda x: X.rouge_tokens(x, unicode))

    tokens = pairs.select(
        "pair_id", *[sentences(c).alias(c) for c in ("prediction", "reference")]
    ).withColumn("_hits", _union("reference", "prediction"))
    return tokens.select(
        "pair_id",
        f1(
            F.col("_hits"), F.size(F.flatten("prediction")), F.size(F.flatten("reference"))
        ).alias("rougeLsum"),
    )


# --- vector matching -------------------------------------------------------------------------


#: Tokens of the pairs that are matched in one group.
BLOCK_TOKENS = 1 << 16


def greedy_match(left: np.ndarray, left_n: np.ndarray, right: np.ndarray,
                 right_n: np.ndarray) -> tuple[float, float]:
    """Mean best cosine of the left rows and of the right rows, weighted by their counts."""
    if not len(left) or not len(right):
        return 0.0, 0.0
    cosines = left @ right.T
    return (
        float((cosines.max(axis=1) * left_n).sum() / left_n.sum()),
        float((cosines.max(axis=0) * right_n).sum() / right_n.sum()),
    )


def _with_f1(matched: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    return matched.select(
        "pair_id", "precision", "recall",
        F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0).alias("f1"),
    )


def bertscore(pairs: DataFrame, vectors: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``pair_id, precision, recall, f1``: greedy cosine matching of token vectors.

    ``pairs`` has ``pair_id, prediction_ids, reference_ids``, ``vectors`` has ``token_id,
    embedding``. Pairs are dealt to blocks, as many as their tokens need. A block gets each of its distinct
    tokens' vectors once and matches all its pairs in one call, so vectors travel once per block and token.
    Null ids are no tokens, tokens without a row do not take part, a null vector is like
    one of zeros, and of several rows of a token the smallest vector counts.
    """
    rows = materialise(
        pairs.select("pair_id", "prediction_ids", "reference_ids", F.xxhash64(*pairs.columns).alias("_deal"))
    )
    held = F.greatest(F.size("prediction_ids"), F.lit(0)) + F.greatest(F.size("reference_ids"), F.lit(0))
    total = rows.agg(F.sum(held)).first()[0] or 0
    dealt = rows.withColumn("block", F.pmod("_deal", F.lit(total // block_tokens + 1))).drop("_deal")
    none = F.array().cast(pairs.schema["prediction_ids"].dataType)
    ids = F.concat(F.coalesce("prediction_ids", none), F.coalesce("reference_ids", none))
    wanted = dealt.select(
        F.col("block").alias("of_block"), F.explode(F.array_distinct(ids)).alias("token_id")
    ).distinct()
    fetched = wanted.join(vectors.select("token_id", "embedding"), "token_id")
    kind = pairs.schema["pair_id"].dataType.simpleString()
    matched = dealt.groupBy("block").cogroup(fetched.groupBy("of_block")).applyInArrow(
        _match_block, f"pair_id {kind}, precision double, recall double"
    )
    return _with_f1(matched)


def _match_block(pairs: pa.Table, fetched: pa.Table) -> pa.Table:
    """All pairs of a block against its vectors."""
    tokens = fetched.column("token_id").to_numpy()
    if len(np.unique(tokens)) < len(tokens):
        vectors = fetched.column("embedding").to_pylist()
        order = sorted(range(len(tokens)), key=lambda i: (tokens[i], vectors[i] is not None, vectors[i] or []))
        tokens, first = np.unique(tokens[order], return_index=True)
        fetched = fetched.take(pa.array(np.array(order)[first]))
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], np.nan_to_num(matrix(fetched.column("embedding")))[order]
    sides = []
    for name in ("prediction_ids", "reference_ids"):
        column = pairs.column(name).combine_chunks()
        flat = column.flatten()
        owner = np.repeat(np.arange(len(column)), pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False))
        flat, known = flat.fill_null(0).to_numpy(), ~flat.is_null().to_numpy(zero_copy_only=False)
        place = np.searchsorted(tokens, flat)
        known &= place < len(tokens)
        known[known] = tokens[place[known]] == flat[known]
        # one entry per pair and distinct token, in order of the pairs
        code, count = np.unique(owner[known] * max(len(tokens), 1) + place[known], return_counts=True)
        pair, token = np.divmod(code, max(len(tokens), 1))
        sides.append((np.searchsorted(pair, np.arange(len(column) + 1)), token, count))
    scores = np.zeros((pairs.num_rows, 2))
    (p_at, p_token, p_n), (r_at, r_token, r_n) = sides
    for n in range(pairs.num_rows):
        p, r = slice(p_at[n], p_at[n + 1]), slice(r_at[n], r_at[n + 1])
        scores[n] = greedy_match(rows[p_token[p]], p_n[p], rows[r_token[r]], r_n[r])
    return pa.table({"pair_id": pairs.column("pair_id"), "precision": scores[:, 0], "recall": scores[:, 1]})
