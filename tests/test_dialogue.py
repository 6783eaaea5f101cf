from pyspark.sql import functions as F

from parley.plans import dialogue as D

LINES = "line_id string, character_name string, utterance string"


def stitched(frame, rows, **options):
    spoken = frame(rows, "conv_id long, pos int, utterance string")
    return {r.conv_id: (r.input, r.response, r.n_turns) for r in D.stitch(spoken, **options).collect()}


def test_order_single_and_null_lines(frame):
    rows = [
        (1, 2, "c"), (1, 0, "a"), (1, 1, "b"),
        (2, 0, "only"),
        (3, 0, "x"), (3, 1, None), (3, 2, "y"), (3, 3, None),
        (4, 0, None),
    ]
    expected = {1: ("a\n b", "c", 3), 2: ("only", "only", 1), 3: ("x", "y", 2)}
    assert stitched(frame, rows) == expected
    assert stitched(frame, rows, segment=1) == expected
    assert stitched(frame, rows, segment=2) == expected
    assert set(stitched(frame, rows, min_turns=2)) == {1, 3}


def test_long_conversation_is_cut_into_segments(frame):
    rows = [(7, i, f"t{i}") for i in range(5000)] + [(8, 0, "a"), (8, 1, "b")]
    got = stitched(frame, rows, segment=64)
    assert got[7] == ("\n ".join(f"t{i}" for i in range(4999)), "t4999", 5000)
    assert got[8] == ("a", "b", 2)


def test_line_ids_out_of_order_and_unknown(frame):
    conversations = frame([(1, "['L9', 'L3', 'L77']")], "conv_id long, line_id_list string")
    lines = frame([("L3", "ann", "hi"), ("L9", "bob", "yo")], LINES)
    spoken = D.spoken_lines(D.clean_conversations(conversations), D.clean_lines(lines))
    assert [tuple(r) for r in D.stitch(spoken).select("input", "response").collect()] == [
        ("Bob: yo", "Ann: hi")
    ]


def build(frame, details, characters=(("u0", "ann"), ("u1", "bob"))):
    return D.build_dialogue(
        D.clean_conversations(
            frame(
                [
                    (1, "m0", "u0", "u1", "['L1', 'L2']"),
                    (2, "m0", "u0", "u1", "['L3', 'L4']"),  # the same words as 1
                    (3, "m0", "u0", "u9", "['L1']"),  # unknown second character
                    (4, "m9", "u0", "u1", "['L1']"),  # unknown title
                    (5, "m0", "u9", "u1", "['L1']"),  # unknown first character
                ],
                "conv_id long, movie_id string, character_id1 string, character_id2 string, "
                "line_id_list string",
            )
        ),
        D.clean_lines(
            frame([("L1", "ann", "hi"), ("L2", "bob", "yo"), ("L3", "ANN", "hi"), ("L4", "BOB", "yo")],
                  LINES)
        ),
        D.clean_titles(
            frame([("m0", "film", "1998/I", 6.84, 12, "['drama', 'war']")],
                  "movie_id string, movie_name string, release_year string, imdb_rating double, "
                  "num_imdb_votes long, genre string")
        ),
        D.clean_characters(frame(list(characters), "character_id string, character_name string")),
        frame(details, "movie_name string, plot_outline string"),
    )


def test_build_merges_equal_rows_and_keeps_unknown_second(frame):
    rows = build(frame, [("film", "p"), ("film", "p"), ("other", "q")]).orderBy("conv_id").collect()
    assert [(r.conv_id, r.character_names, r.response, r.plot_outline) for r in rows] == [
        (1, "Ann, Bob", "Bob: yo", "p"),
        (3, None, "Ann: hi", "p"),
    ]
    first = rows[0]
    assert (first.release_year, first.imdb_rating, first.genre, first.instruction) == (
        1998, 6.8, "drama, war", D.DIALOGUE_INSTRUCTION
    )


def test_two_different_outlines_fan_out(frame):
    rows = build(frame, [("film", "p"), ("film", "q"), ("film", "q")])
    assert rows.where(F.col("conv_id") == 1).count() == 2


def test_repeated_character_does_not_fan_out(frame):
    rows = build(frame, [], (("u0", "ann"), ("u0", "anne"), ("u1", "bob")))
    assert {r.character_names for r in rows.collect()} == {"Anne, Bob", None}
    assert rows.count() == 2


def test_texts_are_not_compared_to_merge_equal_rows(frame):
    rows = build(frame, [("film", "p")])
    plan = rows.withColumn("conv_id", F.col("conv_id").cast("string"))._jdf.queryExecution().executedPlan().toString()
    merging = [line for line in plan.splitlines() if "Aggregate(key=" in line and "response#" in line]
    assert not merging and "WindowGroupLimit" in plan
