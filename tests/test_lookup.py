from pyspark.sql import functions as F

from parley.operators import lookup as L
from parley.plans import catalog as C
from parley.plans.qa import build_qa


def test_best_candidate_and_not_found(frame):
    asked = frame([(1, "f", 2000), (2, "f", None), (3, "f", 1990), (4, "g", None)],
                  "title_id int, title string, year int")
    offered = frame([("f", None, 0, "z"), ("f", 1999, 1, "a"), ("f", 2000, 2, "b"), ("f", 2000, 3, "c")],
                    "title string, year int, cand_rank int, cand string")
    found = L.best_candidate(asked, offered, ["cand"])
    assert {r.title_id: r.cand for r in found.collect()} == {1: "b", 2: "z"}
    assert {r.title_id for r in L.not_found(asked, found, "title_id").collect()} == {3, 4}


def test_enrich_catalog(frame):
    titles = frame([(1, "Original", 2000), (2, "Lost", None)],
                   "title_id int, movie_name string, release_year int")
    offered = frame(
        [("Alias", 2000, 1, None, "long synopsis", "plot", [("d",), ("",)])],
        "title string, year int, cand_rank int, plot_outline string, synopsis string, plot string, "
        "director array<struct<name: string>>",
    )
    found, missing = C.enrich_catalog(
        titles, offered, ["plot_outline", "synopsis", "plot", "director"], {"Original": "Alias"}
    )
    row = found.first()
    assert (row.movie_name, row.plot_outline, row.director) == ("Original", "long synopsis", ["d"])
    assert [r.movie_name for r in missing.collect()] == ["Lost"]


def test_prune_keeps_strictly_more(frame):
    rows = frame([("a", i) for i in range(60)] + [("b", i) for i in range(61)]
                 + [(None, i) for i in range(70)], "k string, i int")
    assert {r.k for r in L.prune_rare(rows, "k", 60).collect()} == {"b"}


def test_rollup_skips_nulls(frame):
    rows = frame([("a", 2, "y", 1.0), ("a", 1, None, 2.0), ("a", 3, "z", None), (None, 1, "q", 1.0)],
                 "k string, o int, v string, x double")
    got = L.entity_rollup(rows, "k", "o", ["v"], ["x"]).collect()
    assert [tuple(r) for r in got] == [("a", "y", 1.5)]


def test_patch(frame):
    rows = frame([("a", 1, 1.5), ("b", 2, 2.5), (None, 3, 3.5)], "name string, n long, r double")
    patches = frame([("a", "n", "31"), ("a", "r", "6.8"), ("c", "n", "9")],
                    "key string, field string, value string")
    got = L.patch(rows, "name", patches, ["n", "r"]).orderBy("r").collect()
    assert sorted(tuple(r) for r in got if r.name) == [("a", 31, 6.8), ("b", 2, 2.5)]
    assert len(got) == 3


def test_lookup_does_not_fan_out(frame):
    rows = frame([(1, "a"), (2, "x"), (3, None)], "i int, k string")
    dim = frame([("a", "v1"), ("a", "v2"), (None, "v3")], "k2 string, v string")
    got = L.lookup(rows, "k", dim, "k2", "v", "out").orderBy("i").collect()
    assert [r.out for r in got] == ["v2", None, None]


def test_left_distinct(frame):
    left = frame([("a", 1), ("a", 1), ("b", 1)], "k string, x int")
    right = frame([("a", "p"), ("a", "p"), ("a", "q")], "k string, y string")
    got = sorted((r.k, r.x, r.y or "") for r in L.left_distinct(left, right, "k").collect())
    assert got == [("a", 1, "p"), ("a", 1, "q"), ("b", 1, "")]


def test_sample_is_exact_and_repeatable(frame):
    rows = frame([(i,) for i in range(997)], "i int")
    first = {r.i for r in L.sample_fraction(rows, 0.2, ["i"]).collect()}
    again = {r.i for r in L.sample_fraction(rows.repartition(11), 0.2, ["i"]).collect()}
    assert len(first) == 199 and first == again
    assert first != {r.i for r in L.sample_fraction(rows, 0.2, ["i"], seed=1).collect()}
    assert L.sample_fraction(rows, 1.0, ["i"]).count() == 997


def test_batches(frame):
    rows = L.assign_batches(frame([(i,) for i in range(120)], "i int"), 50, ["i"])
    sizes = {r.batch_no: r["count"] for r in rows.groupBy("batch_no").count().collect()}
    assert sizes == {1: 50, 2: 50, 3: 20}


def test_build_qa(frame):
    qa = frame(
        [("q0", "k1", ["a", "b"], 0), ("q1", "k1", ["a", "b"], None), ("q2", "k2", ["a"], 5),
         ("q3", None, ["c"], 0)],
        "question string, imdb_key string, answers array<string>, correct_index int",
    )
    movies = frame([("k1", "film", 1999, "drama"), (None, "nullish", 1, "x")],
                   "imdb_key string, name string, year int, genre string")
    details = frame([("film", "p"), (None, "np")], "title string, plot_outline string")
    got = {r.question: (r.response, r.movie_name, r.plot_outline) for r in
           build_qa(qa, movies, details).collect()}
    assert got == {"q0": ("a", "film", "p"), "q2": (None, None, None), "q3": ("c", None, None)}


def test_clean_catalog(frame):
    kind = ("movie_name string, plot_outline string, synopsis string, votes string, rating string, "
            "genres string")
    first = frame([("keep", "o", None, "5", "1.5", "['a', 'b']"), ("bad", "o", "s", "1", "1", "[]"),
                   ("none", None, "s", "1", "1", "['a']")], kind)
    second = frame([("reel", None, None, "7", "2.5", None)], kind)
    denied = frame([("bad",)], "movie_name string")
    one = frame([("keep", "votes", "31")], "key string, field string, value string")
    two = frame([("reel", "plot_outline", "cuts")], "key string, field string, value string")
    got = {r.movie_name: r for r in C.clean_catalog(first, second, denied, one, two).collect()}
    assert set(got) == {"keep", "reel"}
    assert (got["keep"].synopsis, got["keep"].votes, got["keep"].genres) == ("o", 31, "a, b")
    assert (got["reel"].plot_outline, got["reel"].rating, got["reel"].genres) == ("cuts", 2.5, None)


def test_quality_report(frame):
    rows = frame([("a", None), ("", 1), (None, 2)], "n string, y int")
    got = L.quality_report(rows, {"no_name": F.coalesce("n", F.lit("")) == "", "no_year": F.col("y").isNull()})
    assert {(r.rule, r.n_flagged, r.n_rows) for r in got.collect()} == {("no_name", 2, 3), ("no_year", 1, 3)}
