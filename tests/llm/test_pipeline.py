from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from tests.llm.conftest import DOCUMENT
from parley.llm import mixing
from parley.session import materialise
from tests.llm.test_exact_and_shards import expected
from tests.llm.test_jaccard import brute
from tests.llm.test_packing import check


def test_stages(spark):
    docs, sf_dir = None, "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
        after[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    known = after["language ID"]
    assert len(known) >= 0.95 * sum(any(map(str.isalpha, r.text or "")) for r in before)
    stays = {k[0] for k in expected([(r.doc_id, r.text) for r in known]) if k[3]}
    assert {r.doc_id for r in after["exact dedup"]} == stays
    groups = brute([(r.doc_id, r.text) for r in after["exact dedup"]], 5, 80)
    assert {r.doc_id for r in after["n-gram Jaccard join"]} == {d for d, (_, c) in groups.items() if c == d}
    mixed = after["mixing sources"]
    copies = defaultdict(int)
    for r in mixed:
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2 and set(copies) <= {r.doc_id for r in after["n-gram Jaccard join"]}
    check(after["packing"], [(r.doc_id, r.text) for r in mixed])


def test_hard_rows(spark, hard, empty):
    for df in (hard, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES:
            docs = materialise(stage(spark, docs, ""))
        assert (docs.count() > 0) == (df.count() > 0)
    assert mixing.mix(hard).count() == hard.count()


def test_near_stage_drops_rows_not_ids(spark):
    own = " ".join(f"word{i}" for i in range(60))
    other = " ".join(f"thing{i}" for i in range(60))
    rows = [(1, own, "en", "a", 1), (5, own + " more", "en", "a", 1), (5, other, "en", "a", 1), (9, other + " end", "en", "b", 1)]
    df = spark.createDataFrame(rows, DOCUMENT)
    kept = corpus_pipeline.near_stage(spark, df, "")
    assert kept.columns == df.columns
    texts = [r.text for r in kept.collect()]
    assert own in texts and len(texts) == 2 and sum(t.startswith(other) for t in texts) == 1
