from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, k, asked):
    cells = []
    for doc_id, v, *_ in rows:
        if doc_id is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        cells.append((doc_id, [math.floor(max(-topk.LIMIT, min(topk.LIMIT, 256 * x))) for x in v]))
    out = []
    for n, (q, own) in enumerate(cells):
        if asked(q):
            scores = sorted((-sum(x * y for x, y in zip(own, v)), c) for m, (c, v) in enumerate(cells) if m != n)
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scores[:k])]
    return sorted(out)


def found(df, k=5):
    return sorted(map(tuple, topk.top_k(df, F.expr("vec_id % 5 = 0"), k=k).collect()))


@pytest.mark.parametrize("seed, copies", [(1, 0), (2, 200)])
def test_against_all_pairs(spark, seed, copies, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 2048)
    monkeypatch.setattr(topk, "QUERY_ROWS", 32)
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(0, 0.4, 16)).tolist(), 0) for i in range(600)]
    rows += [(1000 + i, rows[3][1], 0) for i in range(copies)]
    rows += [(2000 + i, [0.25] * 16, 0) for i in range(20)]  # ties
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(df) == brute(rows, 5, lambda q: q % 5 == 0)


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (10, None, 0), (None, [1.0, 1.0], 0),
        (15, [nan, 1.0], 0), (20, [1.0, None], 0), (25, [-inf, 0.0], 0), (1, [1e300, -1e300], 0),
        (2, [1.0], 0), (30, [], 0), (3, [-0.001, 5.0, 7.0], 0), (35, [0.5, 0.25], 0), (35, [0.1, 0.2], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("uid", F.lit(1)).withColumn("v", F.lit("x"))
    assert found(df) == brute(rows, 5, lambda q: q % 5 == 0)
    assert found(df.limit(0)) == []
    assert found(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)) == []
    assert found(spark.createDataFrame([(5, [1.0], 0)], SCHEMA)) == []


def test_repeated_ids(spark, monkeypatch):
    """Every row is a candidate, and a query that leaves out itself alone."""
    rows = [(0, [1.0], 0), (3, [5.0], 0), (3, [2.0], 0), (4, [1.0], 0)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == [
        (0, 1, 3, 327680), (0, 2, 3, 131072), (0, 3, 4, 65536)]
    monkeypatch.setattr(topk, "BLOCK", 256)
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 12)), np.round(rng.normal(0, 1, 4), 1).tolist(), 0) for _ in range(150)]
    rows += [(5, rows[0][1], 0)] * 9 + [(7, [0.5] * 4, 0)] * 4
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df) == brute(rows, 5, lambda q: q % 5 == 0)
