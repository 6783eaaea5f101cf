from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import jaccard
from parley.llm.components import components
from parley.llm.words import Words
from tests.llm.conftest import long_text


def word_sets(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return set()
    if len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, k, percent):
    """doc_id -> smallest id reachable, by comparing every pair; ids are unique."""
    sets = {d: word_sets(t, k) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d in sorted(sets):
        counts = defaultdict(int)
        for s in sets[d]:
            for other in holders[s]:
                counts[other] += 1
            holders[s].append(d)
        for other, both in counts.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[other]) - both):
                a, b = sorted((find(d), find(other)))
                root[b] = a
    return {d: (len(sets[d]), find(d)) for d in sets}


def found(df, **parameters):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, **parameters).collect()}


def variants(seed):
    """Chains of edits: links that only a middle text makes, all sizes from one word on."""
    rng = random.Random(seed)
    rows = []
    for base in range(60):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(rng.choice([1, 2, 4, 6, 9, 15, 30, 80, 200, 600]))]
        for _ in range(rng.randint(1, 9)):
            rows.append((rng.randint(0, 10**9) * 1000 + len(rows), " ".join(words)))
            for _ in range(rng.randint(0, 1 + len(words) // 25)):
                at = rng.randrange(len(words))
                if rng.random() < 0.5:
                    words[at] = f"w{rng.randint(0, 5000)}"
                elif len(words) > 1 and rng.random() < 0.5:
                    del words[at]
                else:
                    words.insert(at, f"w{rng.randint(0, 5000)}")
    return rows


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (1, 60)])
def test_edited_texts(spark, k, percent):
    rows = variants(k)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, k=k, percent=percent) == brute(rows, k, percent)


def test_chunked_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    rows = variants(7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, k=3, percent=80) == brute(rows, 3, 80)


def test_given_documents(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs, k=3, percent=90) == brute(rows, 3, 90)


def test_linked_sets_share_a_tile():
    rng = np.random.default_rng(5)
    for _ in range(3000):
        percent = int(rng.choice([60, 80, 90]))
        own = rng.integers(0, 2**64, int(rng.integers(1, 90)), dtype=np.uint64)
        other = own.copy()
        for at in rng.choice(len(own), int(rng.integers(0, 1 + len(own) // 5)), replace=False):
            other[at] = rng.integers(0, 2**64, dtype=np.uint64)
        other = other[: len(other) - int(rng.integers(0, 1 + len(own) // 9))]
        a, b = np.unique(own), np.unique(other)
        if len(b) and jaccard.linked(a, b, percent) and not np.array_equal(a, b):
            assert set(jaccard.slabs(a, percent)) & set(jaccard.slabs(b, percent))


def test_bound_keeps_every_link():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 300, int(rng.integers(20, 60)), dtype=np.uint64)) for _ in range(150)]
    sets += [s[: len(s) - 2] for s in sets]
    points = np.array([np.bincount((s % np.uint64(16)).astype(int), minlength=16) for s in sets])
    size, own = np.array([len(s) for s in sets]), np.arange(len(sets))
    pairs = set(jaccard.candidates(points, size, np.zeros(len(sets), int), 80))
    links = {(i, j) for i in own for j in own if i < j and jaccard.linked(sets[i], sets[j], 80)}
    assert links <= pairs


def test_hard_rows(hard, empty):
    rows = jaccard.join(hard, k=3, percent=90).collect()
    assert len(rows) == hard.count()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[1] == {(1, 1)} and got[2] == {(0, 2)} and got[4] == {(0, 4)} and got[5] == {(1, 5)}
    assert got[None] == {(1, None)} and got[-9] == {(2, -9)}
    assert jaccard.join(empty).collect() == []


def test_one_id_with_two_texts(spark):
    rows = [(1, "a b c d"), (5, "A B c d"), (5, "x y z w"), (9, "x y  z w"), (7, "q")]
    got = {tuple(r) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), k=2).collect()}
    assert got == {(1, 3, 1), (5, 3, 1), (9, 3, 1), (7, 1, 7)}


def by_rows(rows, k, percent):
    """Components when rows of one id are linked as well, and the smallest id of each."""
    sets = [jaccard.shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] == rows[j][0] or len(sets[i]) and len(sets[j]) and jaccard.linked(sets[i], sets[j], percent):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows))


def test_repeated_ids(spark):
    """A link of any text of an id counts, whichever sets its other texts equal."""
    own, other = long_text(60, 1), long_text(60, 2)
    rows = [(1, own), (5, own), (5, other), (7, other + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard.join(df).collect())) == by_rows(rows, 5, 80)
    rows = [(d % 40, t) for d, t in variants(9)] + [(3, None), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.join(df, k=3, percent=80).collect())) == by_rows(rows, 3, 80)


def test_one_of_each_component_stays(spark):
    own, other = long_text(60, 1), long_text(60, 2)
    rows = [(1, own), (5, own + " end"), (5, other), (None, own), (8, other), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("x"))
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len([t for _, t in got if t == other]) == 1 and (1, own) in got and (None, own) in got and (9, None) in got
    assert len(got) == 4


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)]
    root = {x: x for pair in links for x in pair}
    for _ in range(500):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {x: got.get(x, x) for x in root} == root


def test_word_hashes():
    text = "Ab\tcd  ÄB\x0bab é\n" * 3
    words = Words(text.encode())
    plain = text.translate({c: chr(c + 32) for c in range(65, 91)}).split()
    assert [text.encode()[a:b] for a, b in zip(words.start, words.stop)] == [w.encode() for w in text.split()]
    same = {w: h for w, h in zip(plain, words.hash)}
    assert [same[w] for w in plain] == list(words.hash) and len(set(words.hash)) == len(set(plain))
