from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from parley.llm import mixing


def fill(sizes, weights, share, most):
    """Targets by sharing out and cutting again and again."""
    targets, open_ones = {}, dict(weights)
    left = share * sum(sizes.values())
    while open_ones:
        level = left / sum(open_ones.values())
        over = [s for s, w in open_ones.items() if level * w > most * sizes[s]]
        if not over:
            return targets | {s: level * w for s, w in open_ones.items()}
        for s in over:
            targets[s] = most * sizes[s]
            left -= targets[s]
            del open_ones[s]
    return targets


def check(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    largest = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.copies * r.size <= 2 * r.size
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    expected = fill(sizes, weights, 1.5, 2.0)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s])
        assert all(r.source_size == sizes[s] for r in rows if r.source == s)
    return target, taken, largest


def test_targets_and_totals(docs):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    target, taken, largest = check(rows)
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]


def test_reruns_agree(docs):
    first, second = (sorted(map(tuple, mixing.mix(d).collect()), key=repr) for d in (docs, docs.repartition(7)))
    assert first == second


def test_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP", 40)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 60)), "hot" if i % 3 else "cold") for i in range(3000)]
    rows.append((9000, "w " * 5000, "hot"))
    target, taken, _ = check(mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect())
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.002 * target[s]


def test_flight_keeps_totals_and_means():
    rng = np.random.default_rng(0)
    mass, count = rng.integers(1, 500, 200).astype(float), np.ones(200)
    start = rng.random(200)
    ends = []
    for seed in range(300):
        draws = iter(np.random.default_rng(seed).random(400).tolist())
        p = mixing.fly(mass, count, start, draws, 12)
        assert ((p > 0) & (p < 1)).sum() <= 12
        assert p @ mass == pytest.approx(start @ mass) and p.sum() == pytest.approx(start.sum())
        ends.append(p)
    assert np.abs(np.mean(ends, 0) - start).max() < 0.15


def test_hard_rows(hard, empty):
    rows = mixing.mix(hard).collect()
    assert len(rows) == hard.count()
    check(rows)
    assert mixing.mix(empty).collect() == []


def test_take_repeats_rows(docs, hard):
    decided = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    counted = defaultdict(int)
    out = mixing.take(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        counted[r.doc_id] += 1
    assert counted == {k: v for k, v in decided.items() if v}
    assert mixing.take(hard).columns == hard.columns
