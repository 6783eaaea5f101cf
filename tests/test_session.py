"""What the session's helpers leave on disk."""

from __future__ import annotations

import time
from pathlib import Path

import corpus_pipeline
from pyspark.sql import functions as F
from tests.llm.conftest import DOCUMENT
from parley.llm import exact_dedup, jaccard
from parley.llm.components import components
from parley.session import _CLEANUP, materialise, settled, shared_dir


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (found.apply(i).getName() for i in range(found.size())) if name.startswith("shuffle_")}


def tables(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file://")).iterdir()}


def texts(spark, count=60):
    rows = [(i, " ".join(f"w{(i // 2) * 7 + j}" for j in range(60)) + (" end" if i % 2 else ""), "en", "a", 1) for i in range(count)]
    return spark.createDataFrame(rows + rows[:5], DOCUMENT).repartition(3)


def test_materialise_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(_CLEANUP, None)
    df = materialise(spark.range(1000).repartition(7).groupBy((F.col("id") % 5).alias("k")).count().orderBy("k"))
    assert [r[1] for r in df.collect()] == [200] * 5
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(_CLEANUP, None) == setting


def test_settled_keeps_its_result_only(spark):
    before = tables(spark)

    def inner():
        return settled(lambda: materialise(spark.range(10)).where("id > 3"))

    df = settled(lambda: materialise(inner()).union(inner()))
    assert df.count() == 12
    assert len(tables(spark) - before) == 1


def test_stages_leave_little_behind(spark):
    """The index with its texts, the sets and the rounds of links go before the documents are shuffled."""
    docs = texts(spark)
    before = tables(spark)
    assert exact_dedup.drop_copies(docs).count() == 60
    assert len(tables(spark) - before) == 1
    before = tables(spark)
    assert jaccard.keep_one(docs).where("doc_id % 2 = 1").count() == 0
    assert len(tables(spark) - before) == 2  # ids with several texts, and those that go
    before = tables(spark)
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert components(links).where("component = 0").count() == 41
    assert len(tables(spark) - before) == 1


def test_exact_dedup_shuffles_documents_once(spark):
    plan = exact_dedup.drop_copies(texts(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2  # documents, and the rows that stay


def test_null_ids_and_copies_stay_as_before(spark):
    rows = [(None, "a b", "en", "a", 1), (None, "a b", "en", "a", 1), (0, "a b c", "en", "a", 1), (0, "a bc", "en", "a", 1), (7, None, "en", "a", 1)]
    kept = corpus_pipeline.exact_stage(spark, spark.createDataFrame(rows, DOCUMENT), "")
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("0", "a b c"), ("7", None), ("None", "a b")]
