import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from parley.operators import scoring as S
from parley.plans.evaluate import decoded_pairs, evaluate

WORDS = st.lists(st.sampled_from("abcd"), max_size=12)


def table(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            t[i][j] = t[i - 1][j - 1] + 1 if x == y else max(t[i - 1][j], t[i][j - 1])
    return t


def path(a, b):
    t, i, j, found = table(a, b), len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


@settings(max_examples=400, deadline=None)
@given(WORDS, WORDS)
def test_lcs_equals_the_table(a, b):
    assert S.lcs_length(a, b) == table(a, b)[-1][-1]
    assert S.lcs_positions(a, b) == path(a, b)


def pairs_of(frame, pairs):
    return frame([(i, p, r) for i, (p, r) in enumerate(pairs)],
                 "pair_id long, prediction string, reference string")


PAIRS = [
    ("The cat sat on the mat. It was happy!", "the cat lay on a mat. It was very happy!"),
    ("one two three four five", "one two three four five"),
    ("", "something here"), ("something here", ""), ("", ""), (None, "x"),
    ("a b\nc d", "c d\na b"), ("tail  ", " tail"),
]


def grams(tokens, n):
    return Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))


def rouge_words(text):
    import re

    return re.findall("[a-z0-9]+", (text or "").lower())


def test_rouge_equals_brute_force(frame):
    pairs = pairs_of(frame, PAIRS)
    got = {r.pair_id: r for r in S.rouge_n(pairs).collect()}
    long = {r.pair_id: r.rougeL for r in S.rouge_l(pairs).collect()}
    for i, (p, r) in enumerate(PAIRS):
        a, b = rouge_words(p), rouge_words(r)
        for n, score in ((1, got[i].rouge1), (2, got[i].rouge2)):
            ga, gb = grams(a, n), grams(b, n)
            match = sum((ga & gb).values())
            want = 2 * match / (sum(ga.values()) + sum(gb.values())) if match else 0
            assert score == pytest.approx(want)
        lcs = table(b, a)[-1][-1]
        assert long[i] == pytest.approx(2 * lcs / (len(a) + len(b)) if lcs else 0)


def test_rouge_lsum_equals_brute_force(frame):
    got = {r.pair_id: r.rougeLsum for r in S.rouge_lsum(pairs_of(frame, PAIRS)).collect()}
    for i, (p, r) in enumerate(PAIRS):
        a = [rouge_words(s) for s in (p or "").split("\n") if s]
        b = [rouge_words(s) for s in (r or "").split("\n") if s]
        left, right, hits = Counter(sum(b, [])), Counter(sum(a, [])), 0
        for sentence in b:
            for k in sorted(set().union(*(path(sentence, o) for o in a)) if a else ()):
                if left[sentence[k]] and right[sentence[k]]:
                    hits += 1
                    left[sentence[k]] -= 1
                    right[sentence[k]] -= 1
        total = sum(map(len, a)) + sum(map(len, b))
        assert got[i] == pytest.approx(2 * hits / total if hits else 0)
    assert got[6] == 1.0 and {r.pair_id: r.rougeL for r in S.rouge_l(pairs_of(frame, PAIRS)).collect()}[6] == 0.5


def test_unicode_option(frame):
    pairs = pairs_of(frame, [("été", "été"), ("été", "ete")])
    got = {r.pair_id: r.rouge1 for r in S.rouge_n(pairs, unicode=True).collect()}
    assert got == {0: 1.0, 1: 0.0}


def test_bleu(frame):
    def score(pairs):
        return S.bleu(pairs_of(frame, pairs)).first().bleu

    same = [("the cat sat on the mat .", "the cat sat on the mat .")]
    assert score(same) == pytest.approx(1)
    assert score([("a b c", "x y z")]) == 0 and score([("", "x")]) == 0
    p, r = "the cat sat on the mat".split(), "the cat sat on a mat today".split()
    precision = [sum((grams(p, n) & grams(r, n)).values()) / (len(p) - n + 1) for n in (1, 2, 3, 4)]
    want = math.exp(sum(map(math.log, precision)) / 4) * math.exp(1 - len(r) / len(p))
    assert score([(" ".join(p), " ".join(r))]) == pytest.approx(want)


@pytest.fixture()
def vectors(frame):
    rows = np.random.default_rng(3).normal(size=(50, 8))
    return frame([(i, v.tolist()) for i, v in enumerate(rows)], "token_id long, embedding array<float>")


def test_bertscore_equals_brute_force(frame, vectors):
    sides = [([1, 2, 2, 3], [4, 5]), ([7], [7]), ([], [1]), ([1], []), ([60, 1], [1])]
    ids = frame([(i, p, r) for i, (p, r) in enumerate(sides)],
                "pair_id long, prediction_ids array<long>, reference_ids array<long>")
    v = {r.token_id: np.array(r.embedding) / np.linalg.norm(r.embedding) for r in vectors.collect()}
    got = {r.pair_id: r for r in S.bertscore(ids, vectors).collect()}
    for i, (p, r) in enumerate(sides):
        p, r = [x for x in p if x in v], [x for x in r if x in v]
        if not p or not r:
            assert (got[i].precision, got[i].recall, got[i].f1) == (0, 0, 0)
            continue
        assert got[i].precision == pytest.approx(np.mean([max(v[a] @ v[b] for b in r) for a in p]), abs=1e-6)
        assert got[i].recall == pytest.approx(np.mean([max(v[a] @ v[b] for a in p) for b in r]), abs=1e-6)
    assert got[1].f1 == pytest.approx(1)


def test_bertscore_with_nulls_and_repeated_tokens(frame):
    vectors = frame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]), (3, None)],
                    "token_id long, embedding array<float>")
    ids = frame([(0, None, [1]), (1, [1], [2]), (2, [1, None], [3]), (3, [3, 1], [2])],
                "pair_id long, prediction_ids array<long>, reference_ids array<long>")
    got = {r.pair_id: (r.precision, r.recall) for r in S.bertscore(ids, vectors).collect()}
    assert got == {0: (0, 0), 1: (1, 1), 2: (0, 0), 3: (0.5, 1)}


def test_ids(frame):
    logits = frame([([[0.1, 0.9, 0.9], [3.0, 1.0, 2.0]], [5, -100])],
                   "l array<array<double>>, y array<int>")
    row = logits.select(S.argmax_ids(F.col("l")).alias("a"), S.unmask(F.col("y"), 7).alias("b")).first()
    assert row.a == [1, 0] and row.b == [5, 7]
    words = frame([(0, "<pad>"), (1, "hi"), (2, "you")], "token_id int, token string")
    ids = frame([("x", [2, 1, 0, 9, 2]), ("y", [0]), ("z", [])], "k string, ids array<int>")
    assert {r.k: r.text for r in S.decode(ids, "k", "ids", words).collect()} == {"x": "you hi you", "y": "", "z": ""}


def test_decoded_pairs(frame):
    words = frame([(0, "<pad>"), (1, "hi"), (2, "you")], "token_id int, token string")
    rows = frame([(7, [[0.0, 1.0, 0.5], [0.0, 0.0, 9.0]], [2, 1, -100])],
                 "k int, l array<array<double>>, labels array<int>")
    assert tuple(decoded_pairs(rows, "k", words, logits="l").first()) == (7, "hi you", "you hi")
    with pytest.raises(ValueError):
        decoded_pairs(rows, "k", words)


def test_evaluate(frame, vectors):
    pairs = pairs_of(frame, [("one two three four", "one two three four")])
    got = {r.metric: r.value for r in evaluate(pairs, "r", vectors=vectors).collect()}
    assert set(got) == {"bleu", "rouge_rouge1", "rouge_rouge2", "rouge_rougeL", "rouge_rougeLsum",
                        "bertscore_precision", "bertscore_recall", "bertscore_f1"}
    assert all(v == pytest.approx(1) for v in got.values())
    with pytest.raises(ValueError):
        evaluate(pairs, "r", ("meteor",))


def test_vector_match_in_blocks(frame):
    """Blocks of any size agree; null ids, unknown tokens, null lists and repeated vectors have their meaning."""
    pairs = frame([(1, [1, 2, 2], [2, 3]), (2, [1, None, 99], [1]), (3, None, [1]), (4, [5], [5]), (5, [], []), (6, [1, 3], [4])],
                  "pair_id long, prediction_ids array<int>, reference_ids array<int>")
    vectors = frame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, None), (1, [2.0, 5.0]), (5, [0.0, 3.0])],
                    "token_id int, embedding array<float>")
    got = {r.pair_id: r for r in S.bertscore(pairs, vectors).collect()}
    small = {r.pair_id: r for r in S.bertscore(pairs, vectors, block_tokens=1).collect()}
    assert got == small and len(got) == 6
    half = 0.5**0.5
    assert got[1].precision == pytest.approx((half + 1 + 1) / 3) and got[1].recall == pytest.approx((1 + half) / 2)
    assert (got[2].precision, got[2].recall, got[4].f1) == (1, 1, 1)
    assert all(got[i].f1 == 0 for i in (3, 5, 6))


def test_long_texts_keep_few_rows():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 30, 3000).tolist(), rng.integers(0, 30, 2500).tolist()
    places = sorted(S.lcs_positions(a, b))
    assert len(places) == S.lcs_length(a, b)
    at = 0  # what was found is a subsequence of the other text
    for i in places:
        at = b.index(a[i], at) + 1


def test_grams_are_matched_for_few_tokens_at_a_time(monkeypatch):
    """A batch of many pairs is numbered in parts, with the counts of the whole."""
    held = []
    common = S.common_grams
    monkeypatch.setattr(S, "common_grams", lambda p, r, n: held.append(len(p.flatten()) + len(r.flatten())) or common(p, r, n))
    rng = np.random.default_rng(5)
    sides = [pa.array([[str(x) for x in rng.integers(0, 9, rng.integers(0, 60))] for _ in range(4000)]) for _ in "pr"]
    tokens = [np.diff(s.offsets.to_numpy()) for s in sides]
    got = S.in_runs(lambda p, r: pa.array(S.common_grams(p, r, 2).tolist()), sum(tokens), S.GRAM_TOKENS, *sides)
    assert len(held) > 1 and max(held) <= S.GRAM_TOKENS
    assert got.to_pylist() == common(*sides, 2).tolist()
