from __future__ import annotations

import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

from pyspark.sql import functions as F

from parley.llm import exact_dedup, sharding


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]+", "", text or "")
        groups[norm].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for norm, own in groups.items():
        keep = min(own)[3]
        for i, (_, _, _, doc_id) in enumerate(sorted(own)):
            out.append((doc_id, keep, len(own), i == 0, sha256(norm.encode()).hexdigest()))
    return Counter(out)


def found(df):
    return Counter(tuple(r)[:5] for r in exact_dedup.find_copies(df).collect())


def test_copies(docs, hard):
    for df in (docs, hard):
        assert found(df) == expected([(r.doc_id, r.text) for r in df.collect()])


def test_small_buckets(docs):
    """Buckets split and the rows stay the same."""
    wide = {tuple(r)[:5] for r in exact_dedup.find_copies(docs).collect()}
    split = exact_dedup.find_copies(docs, capacity=4)
    assert {tuple(r)[:5] for r in split.collect()} == wide
    assert split.select("bucket").distinct().count() > 8


def test_buckets_hold_no_more_than_capacity(docs):
    index = exact_dedup.build_index(docs, capacity=16)
    most = index.entries.groupBy("bucket").count().agg({"count": "max"}).first()[0]
    assert most <= 16
    assert index.entries.agg({"chained": "max"}).first()[0] == 1


def test_directory_doubles_until_no_bucket_is_overfull(docs, monkeypatch):
    """Also beyond an even spread; each address leads to the shortest prefix that holds no more than it may."""
    monkeypatch.setattr(exact_dedup, "STEP", 1)
    index = exact_dedup.build_index(docs, capacity=2)
    loads = index.entries.groupBy("bucket").agg(F.countDistinct("key").alias("n")).collect()
    assert max(r.n for r in loads) <= 2
    keys = [r.key for r in index.entries.select("key").distinct().collect()]
    assert index.depth > len(keys).bit_length() - 1
    for r in index.directory.collect():
        shift = index.depth - r.bits
        own = [k for k in keys if (k % 2**64) >> (64 - index.depth) >> shift == r.address >> shift]
        wide = [k for k in keys if (k % 2**64) >> (64 - index.depth) >> (shift + 1) == r.address >> (shift + 1)]
        assert r.bucket == r.address >> shift << shift and len(own) <= 2 and (r.bits == 0 or len(wide) > 2)


def test_look_ups_go_through_the_directory(docs, monkeypatch):
    """Rows of an address that the directory leads elsewhere don't find their entries."""
    whole = exact_dedup.Index.bucket_of
    calls = []

    def astray(self, rows):
        calls.append(rows.columns)
        found = whole(self, rows)
        return found if "norm" in rows.columns else found.withColumn("bucket", -F.col("bucket") - 1)

    monkeypatch.setattr(exact_dedup.Index, "bucket_of", astray)
    assert exact_dedup.find_copies(docs).count() == 0 and len(calls) == 2


def test_hot_texts_are_looked_up_by_broadcast(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else f"t{i % 50}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for share in (2, 100, 10**6):
        monkeypatch.setattr(exact_dedup, "HOT", share)
        assert found(df) == expected(rows)


def test_drop_copies(hard, empty):
    kept = exact_dedup.drop_copies(hard)
    assert kept.columns == hard.columns
    stays = Counter(k[0] for k, n in expected([(r.doc_id, r.text) for r in hard.collect()]).items() if k[3])
    assert Counter(r.doc_id for r in kept.collect()) == stays
    assert exact_dedup.find_copies(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []


def check_shards(rows, texts, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 1, None if t is None else crc32(t.encode())) for d, t in texts
    )
    slots = defaultdict(list)
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append((r.slot, r.at, r.size))
    for own in slots.values():
        own.sort()
        assert [s for s, _, _ in own] == list(range(len(own)))
        assert all(a + n == b for (_, a, n), (_, b, _) in zip(own, own[1:]))
    return {s: sum(n for _, _, n in own) for s, own in slots.items()}


def test_shards(docs):
    rows = sharding.shard(docs).collect()
    sizes = check_shards(rows, [(r.doc_id, r.text) for r in docs.collect()], 8)
    total = sum(sizes.values())
    largest = max(r.size for r in rows)
    assert len(sizes) == 8 and all(abs(s - total / 8) <= largest + 0.01 * total / 8 for s in sizes.values())


def test_copies_share_a_shard(spark):
    texts = [(i, f"text {i // 3} " + "x" * (i // 3 % 40)) for i in range(6000)]
    rows = sharding.shard(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    sizes = check_shards(rows, texts, 8)
    shards = defaultdict(set)
    for r in rows:
        shards[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    assert max(sizes.values()) < 1.02 * min(sizes.values())


def test_hot_text_is_cut(spark):
    texts = [(i, "hot" if i % 2 else f"t{i}") for i in range(4000)]
    sizes = check_shards(sharding.shard(spark.createDataFrame(texts, "doc_id long, text string")).collect(), texts, 8)
    assert max(sizes.values()) < 1.02 * min(sizes.values())


def test_hard_shards(hard, empty):
    check_shards(sharding.shard(hard).collect(), [(r.doc_id, r.text) for r in hard.collect()], 8)
    assert sharding.shard(empty).collect() == []
