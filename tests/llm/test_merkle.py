from __future__ import annotations

from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from parley.llm import merkle
from parley.llm.queries import manifest_of

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
A_Z = {c: c + 32 for c in range(65, 91)}


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def build(digests, fan):
    """Levels of a tree from its leaves to its root."""
    levels = [digests]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([h(*at[i : i + fan]) for i in range(0, len(at), fan)])
    return levels


def way(levels, i, fan):
    out = []
    for at in levels[:-1]:
        run = i // fan * fan
        out.append((at[run:i], at[i + 1 : run + fan]))
        i //= fan
    return out


def expected(rows, fan=16):
    sources = defaultdict(list)
    for r in rows:
        sources[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda x: x[:3])
        trees[s] = build([x[2] for x in sources[s]], fan)
    top = build([trees[s][-1][0] for s in names], fan)
    out = Counter()
    for n, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sources[s]):
            path = way(trees[s], i, fan) + way(top, n, fan)
            proof = h(*[d for left, right in path for d in left + right])
            at = leaf
            if r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                at = leaf_of((*r[:4], r[4].translate(A_Z)))
            for left, right in path:
                at = h(*left, at, *right)
            root = top[-1][0]
            out[(r[0], leaf, trees[s][-1][0], root, proof, at, at == root)] += 1
    return out


COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def found(df, **kw):
    return Counter(tuple(r[c] for c in COLUMNS) for r in manifest_of(df, **kw).collect())


def rows_of(df):
    return [tuple(r) for r in df.select(*FIELDS).collect()]


def test_manifest(docs):
    rows = found(docs)
    assert rows == expected(rows_of(docs))
    tampered = [r for r in rows if not r[-1]]
    assert 0 < len(tampered) < 0.3 * len(rows)


def test_hard(hard, empty):
    assert found(hard) == expected(rows_of(hard))
    assert manifest_of(empty).collect() == []


@pytest.mark.parametrize("sizes", [[1], [16], [17], [1, 1], [257, 1, 16, 4], [3] * 40])
def test_heights(spark, sizes):
    """Trees of different heights below a top tree, one row, one source, runs of one."""
    rows = [(i * 7 % 1000 + 1000 * s, f"s{s}" if s else None, "en", i, f"Text {i}")
            for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df) == expected(rows)


def test_small_fan_and_copies(spark, monkeypatch):
    """Many rounds, ancestors dealt to copies, equal rows and rows of one id."""
    monkeypatch.setattr(merkle, "MEETING", 2)
    rows = [(i // 3, "a" if i % 3 else "b", None, None, f"T{i % 2}") for i in range(150)] * 2
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df, fan=2) == expected(rows, 2)


def test_path_folds_to_root(docs):
    from pyspark.sql import functions as F

    proofs = merkle.prove(docs)
    assert proofs.where(merkle.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert proofs.select("leaf").distinct().count() > 100
