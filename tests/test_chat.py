import re

from pyspark.sql import functions as F

from parley.plans import chat as M
from parley.plans.retrieval import EnsembleSettings, resolve_entity, retrieve_context
from parley.plans import index as I
from parley.operators.embedding import hash_embedding

KIND = "conv_id long, turn long, role string, text string"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (1, 3, "user", None), (1, 4, "user", "bye"),
    (2, 0, "system", "only"),
]


def test_history(frame):
    got = {r.conv_id: r.history for r in M.chat_history(frame(ROWS, KIND)).collect()}
    assert got == {1: "hi hello bye"}


def test_history_before_and_of(frame):
    messages = frame(ROWS, KIND)
    before = {(r.conv_id, r.turn): (r.n_history, r.history_chars)
              for r in M.history_before(messages).collect()}
    assert before == {(1, 0): (0, 0), (1, 1): (0, 0), (1, 2): (1, 2), (1, 3): (2, 8), (1, 4): (2, 8),
                      (2, 0): (0, 0)}
    chosen = frame([(1, 2), (1, 4), (2, 0), (1, 0)], "conv_id long, turn long")
    got = {(r.conv_id, r.turn): r.history for r in M.history_of(chosen, messages).collect()}
    assert got == {(1, 2): "hi", (1, 4): "hi hello", (2, 0): "", (1, 0): ""}


def test_long_conversation(frame):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(3000)]
    messages = frame(rows, KIND)
    whole = " ".join(f"t{i}" for i in range(3000))
    assert M.chat_history(messages).first().history == whole
    chosen = frame([(1, 2500)], "conv_id long, turn long")
    assert M.history_of(chosen, messages).first().history == " ".join(f"t{i}" for i in range(2500))


def test_exit_ends_a_conversation(frame):
    rows = [*ROWS, (3, 0, "user", "hi"), (3, 1, "user", "EXIT"), (3, 2, "user", "late"),
            (4, 0, "assistant", "exit")]
    kept = {(r.conv_id, r.turn) for r in M.until_exit(frame(rows, KIND)).collect()}
    assert kept == {(c, t) for c, t, _, _ in rows} - {(3, 1), (3, 2)}


def test_append(frame):
    answers = frame([(1, "q", "a"), (9, "q9", "a9")], "conv_id long, question string, answer string")
    got = {tuple(r) for r in M.append_turns(frame(ROWS, KIND), answers).collect()}
    assert got == {(1, 5, "user", "q"), (1, 6, "assistant", "a"), (9, 0, "user", "q9"),
                   (9, 1, "assistant", "a9")}


def test_prompt(frame):
    rows = frame([("why {question}?", "ctx", None)], "question string, context string, chat_history string")
    built = M.build_prompt(rows, "Do it.").withColumn("m", M.prompt_messages()).first()
    assert built.system == M.SYSTEM_TEXT.replace("{instruction}", "Do it.")
    assert built.memory == "Chat history: \nContext: ctx" and built.human == "Question: why {question}?"
    assert [m.role for m in built.m] == ["system", "assistant", "user"]


def test_summary(frame):
    text = "Cats eat fish. Dogs run! Cats like fish. It rains."
    got = M.summarise_history(frame([(1, 0, "user", text)], KIND), 2).first().summary
    assert got == "Cats eat fish. Cats like fish."
    spread = frame([(1, 0, "user", "Dogs run. Cows moo."), (2, 0, "user", "Moo cows moo!")], KIND)
    best = {r.conv_id: r.summary for r in M.summarise_history(spread, 1).collect()}
    assert best == {1: "Cows moo.", 2: "Moo cows moo!"}


def corpus(frame):
    films = frame(
        [(1, "ring", 2001, "a hobbit carries the ring to the mountain"),
         (2, "shark", 1975, "a shark hunts swimmers at the beach"),
         (3, "empty", None, None)],
        "doc_id long, movie_name string, year int, synopsis string",
    )
    return I.build_index(films, "doc_id", I.NAMES), I.build_index(films, "doc_id", I.INFOS)


def test_index(frame):
    names, infos = corpus(frame)
    rows = {r.doc_id: r for r in infos.collect()}
    assert rows[3].text == "Movie Name: empty\nSynopsis: Unknown" and rows[3].year == "Unknown"
    assert rows[1].year == "2001" and rows[1].collection == "movie_collection"
    assert names.first().text.count("\n") == 13
    assert infos.select("chunk_id").distinct().count() == 3
    assert I.missing_from(infos, infos).count() == 0
    assert I.missing_from(infos, infos.where("doc_id = 1")).count() == 2


def test_append_twice_adds_nothing(spark, frame, tmp_path):
    _, infos = corpus(frame)
    path = str(tmp_path / "store")
    I.append_index(infos.where("doc_id < 3"), path)
    for _ in range(2):
        I.append_index(infos, path, spark.read.parquet(path))
        I.append_index(infos.unionByName(infos), path)
    assert spark.read.parquet(path).count() == 3
    new = str(tmp_path / "new")
    I.append_index(infos.unionByName(infos), new)
    assert spark.read.parquet(new).count() == 3


def test_frequent_words_do_not_change_the_summary(frame, monkeypatch):
    rows = frame([(c, t, "user", f"the the cat {c}. A dog {t} the. word{c} the {t}!") for c in range(6) for t in range(5)], KIND)
    got = []
    for share in (1, 4, 1 << 16, 1 << 40):
        monkeypatch.setattr(M, "FREQUENT", share)
        got.append(sorted(map(tuple, M.summarise_history(rows, 2).collect())))
    assert got[0] == got[1] == got[2] == got[3] and len(got[0]) == 6


def test_last_messages_of_a_cut_conversation(frame):
    """Windows reach over segments; other roles and null texts are not remembered."""
    turns = [(1, t, "system" if t % 7 == 0 else "user", None if t % 11 == 3 else f"m{t}") for t in range(100)]
    rows = frame(turns + [(2, 5, "user", "only")], "conv_id int, turn int, role string, text string")
    for n, segment in ((1, 1), (3, 4), (5, 5), (4, 1000)):
        got = {(r.conv_id, r.turn): r.history for r in M.history_last(rows, n, segment).collect()}
        said = [(t, x) for _, t, role, x in turns if role == "user" and x]
        assert got == {(2, 5): ""} | {
            (1, t): " ".join([x for u, x in said if u < t][-n:]) for _, t, _, _ in turns}


def test_append_reads_only_buckets_that_may_hold_an_id(spark, frame, tmp_path):
    rows = frame([(i, f"title {i}", 2000, f"word{i} tells a story") for i in range(400)],
                 "title_id long, movie_name string, year int, synopsis string")
    infos = I.build_index(rows, "title_id", I.INFOS)
    path = str(tmp_path / "store")
    I.append_index(infos.where("doc_id < 200"), path)
    I.append_index(infos, path)
    stored = spark.read.parquet(path)
    assert stored.count() == 400 and stored.select("bucket").distinct().count() > 100
    old = I._bucketed(infos.where("doc_id < 3"))
    known = I.stored_ids(old, path)
    assert known.count() == 3
    pruned = known._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert set(re.findall(r"\bb[0-9a-f]{2}\b", pruned)) == {r.bucket for r in old.select("bucket").collect()}
    new = I._bucketed(I.build_index(rows.withColumn("title_id", F.col("title_id") + 10_000), "title_id", I.INFOS))
    assert I._maybe_stored(new, path).count() < 60  # 400 ids, most of which no bitmap marks


def test_an_id_meets_one_bitmap_of_a_batch(spark, tmp_path):
    """Not every bitmap of its bucket, whose number grows with the batch as the ids do."""
    rows = I._bucketed(spark.range(9).select(F.lit("c").alias("collection"), F.md5(F.col("id").cast("string")).alias("chunk_id")))
    path = str(tmp_path / "store")
    for _ in range(2):
        I._filters(rows).write.mode("append").parquet(f"{path}/{I.FILTERS}")
    maybe = I._maybe_stored(rows, path)
    assert maybe.count() == 9
    assert re.search(r"bitmap#\d+L? = bitmap#\d+", maybe._jdf.queryExecution().optimizedPlan().toString())


def test_context(frame):
    names, infos = corpus(frame)
    questions = frame([(1, "which hobbit carries the ring"), (2, "the shark at the beach")],
                      "question_id long, question string").withColumn("embedding", hash_embedding(F.col("question")))
    got = {r.question_id: r for r in retrieve_context(questions, names, infos).collect()}
    assert got[1].entity == "ring" and got[1].context.startswith("Movie Name: ring\n")
    assert got[2].entity == "shark" and "hobbit" not in got[2].context


def test_no_hit_gives_null_entity_and_free_search(frame):
    names, infos = corpus(frame)
    questions = frame([(1, "hobbit")], "question_id long, question string").withColumn(
        "embedding", hash_embedding(F.col("question")))
    none = names.where("false")
    assert resolve_entity(questions, none, EnsembleSettings(2, 4, (0.2, 0.8))).first().entity is None
    row = retrieve_context(questions, none, infos).first()
    assert row.entity is None and row.context.count("Movie Name:") == 3
    assert retrieve_context(questions, none, infos.where("false")).first().context == ""
