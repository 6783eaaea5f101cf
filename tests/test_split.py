import pytest

from parley.operators.ordering import hash_rank, number_copies, ordered_concat, prefix_totals
from parley.operators.lookup import sample_fraction
from parley.operators.selection import bounds, prefix_sizes
from parley.operators.split import split_summary, stratified_split
from parley.session import materialise
from pyspark.sql import functions as F


def rows_of(frame, sizes):
    return frame([(f"s{k}", f"{k}-{i}") for k, n in enumerate(sizes) for i in range(n)],
                 "stratum string, id string")


@pytest.mark.parametrize("sizes, train, test", [
    ([1, 2, 3], 0.7, 0.297),
    ([500, 300, 61, 61, 61, 1, 1], 0.7, 0.297),
    ([7] * 40, 0.8, 0.195),
    ([1] * 25, 0.5, 0.25),
    ([1000], 0.7, 0.297),
])
def test_sizes_are_exact_and_shares_near(frame, sizes, train, test):
    n = sum(sizes)
    split = stratified_split(rows_of(frame, sizes), "stratum", ["id"], train, test).cache()
    assert split.count() == n == split.select("id").distinct().count()
    totals = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    want = {"train": int(n * train), "test": int(n * test)}
    want["val"] = n - want["train"] - want["test"]
    assert totals == {k: v for k, v in want.items() if v}
    for row in split_summary(split, "stratum").where("split = 'train'").collect():
        size = sizes[int(row.stratum[1:])]
        assert abs(row.n_rows - size * want["train"] / n) < 1


def test_split_does_not_depend_on_partitions(frame):
    rows = rows_of(frame, [50, 20, 3])
    first, again = (
        {(r.id, r.split) for r in stratified_split(d, "stratum", ["id"], 0.7, 0.2).collect()}
        for d in (rows.repartition(1), rows.repartition(17))
    )
    assert first == again


def test_copies_are_numbered(frame):
    rows = frame([("a", 1)] * 25 + [("b", None)] * 3 + [("c", 2)], "k string, x int")
    got = number_copies(rows, "copy", step=10).groupBy("k", "x").agg(F.sort_array(F.collect_list("copy")).alias("c"))
    assert {(r.k, r.x): r.c for r in got.collect()} == {
        ("a", 1): list(range(1, 26)), ("b", None): [1, 2, 3], ("c", 2): [1]
    }


def test_null_stratum_is_dropped(frame):
    rows = frame([("a", "1"), (None, "2")], "stratum string, id string")
    assert [r.id for r in stratified_split(rows, "stratum", ["id"], 1.0, 0.0).collect()] == ["1"]


def test_ranks_are_whole_in_every_stratum(frame):
    rows = rows_of(frame, [10_000, 3, 1])
    ranked = hash_rank(rows, ["stratum"], ["id"])
    got = ranked.groupBy("stratum").agg(
        F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.min("rank").alias("lo"),
        F.max("rank").alias("hi"),
    )
    assert {(r.stratum, r.n, r.d, r.lo, r.hi) for r in got.collect()} == {
        ("s0", 10_000, 10_000, 1, 10_000), ("s1", 3, 3, 1, 3), ("s2", 1, 1, 1, 1)
    }


def test_ordered_concat_and_prefix_totals(frame):
    rows = frame([("a", i, f"t{i}") for i in range(1000)] + [("b", 5, "x"), ("b", 2, None)],
                 "k string, pos int, t string")
    got = {r.k: r.s for r in ordered_concat(rows, ["k"], "pos", "t", "|", "s", segment=7).collect()}
    assert got == {"a": "|".join(f"t{i}" for i in range(1000)), "b": "x"}
    totals = prefix_totals(rows, "k", "pos", {"n": F.lit(1)}, segment=7)
    assert all(r.n == r.pos for r in totals.where("k = 'a'").collect())
    assert {(r.pos, r.n) for r in totals.where("k = 'b'").collect()} == {(2, 0), (5, 1)}


@pytest.mark.parametrize("few", [1, 3, 1 << 17])
def test_bounds_are_the_rows_at_the_ranks(frame, few):
    """Prefixes grow until few ids are left; the bound is the row that a full ranking has there."""
    rows = rows_of(frame, [30_000, 40, 1])
    want = {(r.stratum, r["rank"]): r.id for r in hash_rank(rows, ["stratum"], ["id"]).collect()}
    asked = [("s0", 1), ("s0", 30_000), ("s0", 17_001), ("s1", 7), ("s1", 40), ("s2", 1), ("s2", 2), ("s9", 1)]
    ranks = frame([(s, str(n), n) for s, n in asked], "stratum string, _name string, _wanted long")
    sizes = prefix_sizes(rows, ["stratum"], ["id"])
    got = {(r.stratum, int(r._name)): r._bound.id for r in bounds(rows, sizes, ranks, ["stratum"], ["id"], few=few).collect()}
    assert got == {a: want[a] for a in asked if a in want}


def test_no_exchange_carries_the_rows(frame):
    rows = rows_of(frame, [500, 61, 7]).withColumn("text", F.concat(F.lit("t"), "id")).repartition(4)
    stored = materialise(rows)
    for df in (stratified_split(stored, "stratum", ["id"], 0.7, 0.2), sample_fraction(stored, 0.3, ["id"])):
        plan = df._jdf.queryExecution().executedPlan().toString()
        carried = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert "text#" in plan and not any("SortMergeJoin" in line for line in plan.splitlines())
        assert len(carried) == 0, plan


def test_sample_is_exact_and_the_first_of_the_order(frame):
    rows = rows_of(frame, [997])
    for fraction in (0.0, 0.2, 0.5, 1.0):
        got = {r.id for r in sample_fraction(rows, fraction, ["id"]).collect()}
        want = {r.id for r in hash_rank(rows, [], ["id"]).where(F.col("rank") <= round(997 * fraction)).collect()}
        assert got == want
    assert sample_fraction(rows.where("false"), 0.5, ["id"]).count() == 0
