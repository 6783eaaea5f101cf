import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.operators.embedding import apply_model, hash_embedding
from parley.operators.fusion import fuse, majority_vote, pick_diverse, search_ensemble, search_mmr
from parley.operators.knn import GROUPS, Best, _blocked, hit_schema, search
from parley.operators.pruned import HELD, Cells, _cell_blocks, _parts, search_pruned

RNG = np.random.default_rng(7)
INDEX = np.round(RNG.normal(size=(300, 8)), 1)
QUESTIONS = np.round(RNG.normal(size=(40, 8)), 1)
HOT = [0 if i % 3 == 0 else i % 7 for i in range(300)]  # a third of the rows share a value
WANTED = [None if i % 5 == 0 else i % 9 for i in range(40)]  # 7 and 8 match nothing


def unit(m):
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def brute(k, wanted=None):
    scores = np.rint(unit(QUESTIONS) @ unit(INDEX).T * 1e6).astype(int)
    hits = set()
    for q in range(len(QUESTIONS)):
        rows = [r for r in range(len(INDEX)) if not wanted or wanted[q] is None or wanted[q] == HOT[r]]
        best = sorted(rows, key=lambda r: (-scores[q, r], r))[:k]
        hits |= {(q, r, scores[q, r], n) for n, r in enumerate(best, 1)}
    return hits


@pytest.fixture()
def tables(frame):
    index = frame([(i, v.tolist(), HOT[i]) for i, v in enumerate(INDEX)],
                  "chunk_id long, embedding array<float>, value int")
    questions = frame([(i, v.tolist(), WANTED[i]) for i, v in enumerate(QUESTIONS)],
                      "question_id long, embedding array<float>, wanted int")
    return questions, index


def as_set(hits):
    return {(r.question_id, r.chunk_id, round(r.score * 1e6), r["rank"]) for r in hits.collect()}


BLOCKS = [{}, {"max_local_questions": 0}, {"max_local_questions": 3, "block_questions": 7, "block_rows": 11}]


@pytest.mark.parametrize("plan", BLOCKS)
def test_search_equals_brute_force(tables, plan):
    assert as_set(search(*tables, 5, **plan)) == brute(5)


@pytest.mark.parametrize("plan", BLOCKS)
def test_filtered_search_equals_brute_force(tables, plan):
    got = as_set(search(*tables, 5, filter_by=("wanted", "value"), **plan))
    assert got == brute(5, WANTED)


@pytest.mark.parametrize("plan", BLOCKS[:2])
def test_fewer_rows_than_k_and_no_questions(tables, plan):
    questions, index = tables
    few = search(questions, index.where("chunk_id < 3"), 5, **plan)
    assert few.groupBy("question_id").count().where("count = 3").count() == 40
    assert search(questions.where("false"), index, 5, **plan).count() == 0
    assert search(questions, index.where("false"), 5, **plan).count() == 0


def test_text_keys_and_zero_vector(frame):
    index = frame([("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("longer", [0.0, 1.0]), ("z", [0.0, 0.0])],
                  "chunk_id string, embedding array<float>")
    questions = frame([("q", [2.0, 0.0])], "question_id string, embedding array<float>")
    for plan in BLOCKS[:2]:
        got = search(questions, index, 4, **plan).orderBy("rank").collect()
        assert [(r.chunk_id, r.score) for r in got] == [("a", 1.0), ("b", 1.0), ("longer", 0.0), ("z", None)]


def test_null_vectors_and_keys(frame):
    index = frame([(1, [1.0, 0.0]), (2, None), (None, [1.0, 0.0]), (3, [1.0, None]), (4, [0.0, 1.0])],
                  "chunk_id long, embedding array<float>")
    questions = frame([(1, [2.0, 0.0]), (2, None), (None, [1.0, 0.0])],
                      "question_id long, embedding array<float>")
    for plan in BLOCKS:
        got = [(r.question_id, r.chunk_id, r.score)
               for r in search(questions, index, 9, **plan).orderBy("question_id", "rank").collect()]
        assert got == [(1, 1, 1.0), (1, 4, 0.0), (1, 2, None), (1, 3, None),
                       *[(2, i, None) for i in (1, 2, 3, 4)]]
        assert search(questions, index.where("chunk_id = 2"), 9, **plan).count() == 2


def test_unequal_lengths_are_an_error(frame):
    index = frame([(1, [1.0, 0.0, 0.0])], "chunk_id long, embedding array<float>")
    questions = frame([(1, [2.0, 0.0])], "question_id long, embedding array<float>")
    with pytest.raises(Exception, match="unequal length"):
        search(questions, index, 1).collect()


def test_small_blocks_do_not_multiply_the_hits(tables):
    """A task hands on the best of all index blocks of its group, so what is shuffled does not follow their number."""
    questions, index = (t.withColumn("part", F.lit("")).drop("wanted", "value") for t in tables)
    hits = _blocked(questions, index, 5, hit_schema(*tables), 7, 3, one_part=True)
    assert hits.count() <= GROUPS * 5 * len(QUESTIONS)


def test_pick_diverse():
    scores = np.array([0.9, 0.9, 0.5, 0.1])
    pairs = np.array([[1, 1, 0, 0], [1, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1.0]])
    assert pick_diverse(scores, pairs, 4, 0.5) == [0, 2, 3, 1]
    assert pick_diverse(scores, pairs, 2, 1.0) == [0, 1]
    assert pick_diverse(scores, pairs, 9, 0.5) == [0, 2, 3, 1]


def test_diversity_of_one_is_similarity(tables):
    assert as_set(search_mmr(*tables, 4, lam=1.0)) == brute(4)


def test_mmr_equals_brute_force(tables):
    got = {}
    for r in search_mmr(*tables, 4, fetch_k=10).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append(r.chunk_id)
    pairs = np.rint(unit(INDEX) @ unit(INDEX).T * 1e6) / 1e6
    for q in range(len(QUESTIONS)):
        pool = sorted((h for h in brute(10) if h[0] == q), key=lambda h: h[3])
        left, chosen = [(h[1], h[2] / 1e6) for h in pool], []
        while len(chosen) < 4:
            value = [0.5 * s - 0.5 * max((pairs[c, i] for c in chosen), default=0) for i, s in left]
            chosen.append(left.pop(int(np.argmax(value)))[0])
        assert got[q] == chosen


def test_fusion(frame):
    ranked = frame([(1, 0, 1, "a", "x"), (1, 0, 2, "b", "y"), (1, 1, 1, "c", "y"), (1, 1, 2, "d", "z")],
                   "question_id int, list_no int, rank int, chunk_id string, text string")
    got = fuse(ranked, (0.5, 0.5), "text").orderBy("rank").collect()
    assert [(r.chunk_id, r.text) for r in got] == [("b", "y"), ("a", "x"), ("d", "z")]
    assert got[0].score == pytest.approx(0.5 / 62 + 0.5 / 61)
    alone = fuse(ranked.where("list_no = 0"), (0.5, 0.5), "chunk_id").orderBy("rank").collect()
    assert [r.chunk_id for r in alone] == ["a", "b"]
    tied = frame([(1, 1, 1, "late"), (1, 0, 1, "early")], "question_id int, list_no int, rank int, chunk_id string")
    assert fuse(tied, (0.5, 0.5), "chunk_id").orderBy("rank").first().chunk_id == "early"


def test_ensemble_is_the_fusion_of_both_lists(tables):
    questions, index = tables
    lists = search(questions, index, 2).withColumn("list_no", F.lit(0)).unionByName(
        search_mmr(questions, index, 4).withColumn("list_no", F.lit(1)))
    assert as_set(fuse(lists, (0.2, 0.8), "chunk_id")) == as_set(
        search_ensemble(questions, index, 2, 4, (0.2, 0.8)))


def test_vote(frame):
    hits = frame([(1, 1, "a"), (1, 2, "b"), (1, 3, "b"), (2, 1, "c"), (2, 2, "d"), (3, 1, None)],
                 "question_id int, rank int, name string")
    assert {r.question_id: r.name for r in majority_vote(hits, "name").collect()} == {1: "b", 2: "c"}


def test_hash_embedding(frame):
    rows = frame([(0, "a b b"), (1, "b A b"), (2, "..."), (3, None)], "i int, t string")
    got = [np.array(r[0]) for r in rows.orderBy("i").select(hash_embedding(F.col("t"), 16)).collect()]
    assert np.array_equal(got[0], got[1])
    assert np.linalg.norm(got[0]) == pytest.approx(1, abs=1e-6)
    assert not got[2].any() and not got[3].any() and len(got[3]) == 16


def test_model_hook(frame):
    def load():
        return lambda texts: texts.str.len().astype("int64")

    got = apply_model(frame([("ab",), ("c",)], "t string"), "t", "n", "long", load)
    assert {(r.t, r.n) for r in got.collect()} == {("ab", 2), ("c", 1)}


def test_pruned_search_equals_brute_force(tables):
    questions, index = tables
    for blocks in ({}, {"pivots": 5, "block_questions": 7, "block_rows": 11}):
        assert as_set(search_pruned(questions, index, 5, **blocks).hits) == brute(5)
        assert as_set(search_pruned(questions, index, 5, ("wanted", "value"), **blocks).hits) == brute(5, WANTED)


def test_pruned_search_reads_a_part(frame):
    """Clustered vectors, a third of them copies: ties are kept and most pairs are never scored."""
    centres = RNG.normal(size=(20, 16))
    vectors = np.round(centres[RNG.integers(0, 20, 4000)] + 0.05 * RNG.normal(size=(4000, 16)), 3)
    vectors[::3] = vectors[0]
    index = frame([(i, v.tolist()) for i, v in enumerate(vectors)], "chunk_id long, embedding array<float>")
    questions = index.where("chunk_id % 40 = 0").withColumnRenamed("chunk_id", "question_id")
    got = search_pruned(questions, index, 5, block_rows=300)
    assert as_set(got.hits) == as_set(search(questions, index, 5))
    share = got.scored.agg(F.sum("rows")).first()[0] / (questions.count() * 4000)
    assert share < 0.4


def test_a_task_holds_few_distances_whatever_the_number_of_cells():
    batch = pa.record_batch({"question_id": np.arange(10_000)})
    for width in (0, 1, 2_500, 2 * HELD):
        parts = list(_parts(iter([batch]), width))
        assert all(len(p) == 1 or len(p) * width <= HELD for p in parts)
        assert np.concatenate([p.column(0) for p in parts]).tolist() == list(range(10_000))


def test_pruned_search_of_odd_rows(frame):
    index = frame([(1, [1.0, 0.0]), (2, None), (None, [1.0, 0.0]), (3, [1.0, None]), (4, [0.0, 1.0]), (5, [0.0, 0.0])],
                  "chunk_id long, embedding array<float>")
    questions = frame([(1, [2.0, 0.0]), (2, None), (None, [1.0, 0.0]), (3, [0.0, 0.0])],
                      "question_id long, embedding array<float>")

    def rows(hits):
        return sorted((r.question_id, r["rank"], r.chunk_id, r.score) for r in hits.collect())

    for k in (1, 3, 9):
        for held in (index, index.where("chunk_id IN (2, 3)"), index.where("false")):
            assert rows(search_pruned(questions, held, k).hits) == rows(search(questions, held, k))
    assert search_pruned(questions.where("false"), index, 2).hits.count() == 0


@pytest.mark.parametrize("plan", BLOCKS)
def test_carried_columns(tables, plan):
    questions, index = tables
    rich = index.withColumn("name", F.concat(F.lit("n"), "chunk_id"))
    for repeat in (1, 400):  # many small batches thin the store
        held = rich.repartition(repeat) if repeat > 1 else rich
        hits = search(questions, held, 5, carry=("name", "embedding"), **plan)
        assert as_set(hits) == brute(5)
        assert all(r.name == f"n{r.chunk_id}" and np.allclose(r.embedding, INDEX[r.chunk_id], atol=1e-6)
                   for r in hits.collect())


def test_store_is_thinned():
    best = Best(pa.table({"question_id": list(range(4)), "embedding": QUESTIONS[:4].tolist()}), 2, ["name"])
    for i in range(0, 2000):
        row = INDEX[i % 300] + i / 1000
        best.add_batch(pa.table({"chunk_id": [i], "embedding": [row.tolist()], "name": [str(i)]}))
    assert best.stored <= 2 * 8 + 1024 and sum(t.num_rows for t in best.store) == best.stored
    out = best.table(pa.schema([("q", pa.int64()), ("c", pa.int64()), ("s", pa.float64()), ("name", pa.string())]))
    assert out.column("name").to_pylist() == [str(c) for c in out.column("c").to_pylist()]


def test_nothing_joins_back_to_the_index(spark, tables):
    """With broadcasts off, no exchange reads the index before its rows are scored."""
    questions, index = tables
    rich = index.withColumn("text", F.concat(F.lit("t"), "chunk_id")).withColumn("movie_name", F.col("text"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = search_ensemble(questions, rich, 2, 4, (0.2, 0.8), "text", carry=("movie_name",))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_pruned_search_sends_questions_to_blocks_not_cells(spark, frame):
    """However many cells a question visits, it is shuffled once for each group of index blocks; blocks are bounded."""
    vectors = RNG.normal(size=(400, 32))
    index = frame([(i, v.tolist()) for i, v in enumerate(vectors)], "chunk_id long, embedding array<float>")
    questions = index.where("chunk_id % 8 = 0").withColumnRenamed("chunk_id", "question_id")
    got = search_pruned(questions, index, 3, block_questions=9, block_rows=30)
    plan = got.hits._jdf.queryExecution().executedPlan().toString()
    assert "explode(cells" not in plan
    assert as_set(got.hits) == as_set(search(questions, index, 3))
    sizes = np.array([3, 50, 200, 1, 1, 28, 30])
    none = np.zeros(7)
    cells = Cells(np.zeros((1, 2)), np.arange(-1, 6), none.astype(int), sizes, none, none, none.astype(int))
    rows = _cell_blocks(spark, cells, 30).collect()
    held = np.zeros(99)
    for r, size in zip(rows, sizes):
        held[r.block : r.block + r.parts] += size / r.parts
    assert [r.cell for r in rows] == list(range(-1, 6)) and held.max() <= 90 and (held > 0).sum() <= 400 // 30 + 1
