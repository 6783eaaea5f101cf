from pyspark.sql import functions as F
import pytest

from parley.functions import text as X


def values(frame, kind, items, expression):
    rows = frame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_title_case(frame):
    texts = ["o'neil MC-FLY", "2nd x3y", "été ÉTÉ", None, ""]
    assert values(frame, "string", texts, X.title_case) == [
        "O'Neil Mc-Fly", "2Nd X3Y", "Été Été", None, ""
    ]


def test_digits_to_int(frame):
    texts = ["1998/I", "", None, "no year", "99999999999999"]
    assert values(frame, "string", texts, X.digits_to_int) == [1998, None, None, None, None]


def test_lists(frame):
    texts = ["[]", "['a']", "['a', 'b']", None]
    assert values(frame, "string", texts, X.quoted_text) == [None, "a", "a, b", None]
    mixed = ["""["O'Neil", 'b']""", r"['it\'s']", "[]"]
    assert values(frame, "string", mixed, X.list_literal) == [["O'Neil", "b"], ["it's"], []]


def test_speak_is_null_if_a_side_is(frame):
    rows = frame([(1, "a", "x"), (2, None, "x"), (3, "a", None)], "i int, n string, t string")
    got = rows.orderBy("i").select(X.speak(F.col("n"), F.col("t"))).collect()
    assert [r[0] for r in got] == ["a: x", None, None]


def test_item_at(frame):
    rows = frame([(i, ["a", "b"], k) for i, k in enumerate([0, 1, 2, None, -1])],
                 "i int, a array<string>, k int")
    got = rows.orderBy("i").select(X.item_at(F.col("a"), F.col("k"))).collect()
    assert [r[0] for r in got] == ["a", "b", None, None, None]


def test_strip_and_longest(frame):
    assert values(frame, "string", [" \n a b\t\n"], X.strip) == ["a b"]
    rows = frame([(1, "ab", "cd"), (2, "a", "cd")], "i int, a string, b string")
    got = rows.orderBy("i").select(X.longest(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == ["ab", "cd"]


def test_defaults(frame):
    rows = frame([(1, "x"), (2, None)], "i int, a string").orderBy("i")
    assert [r[0] for r in rows.select(X.field_or(rows, "a", "?")).collect()] == ["x", "?"]
    assert [r[0] for r in rows.select(X.field_or(rows, "a", "?", "keep")).collect()] == ["x", None]
    assert rows.select(X.field_or(rows, "b", "?", "keep")).first()[0] == "?"
    with pytest.raises(ValueError):
        X.field_or(rows, "a", "?", "drop")
    text = X.labelled_text(rows, {"a": "A", "b": "B"})
    assert [r[0] for r in rows.select(text).collect()] == ["A: x\nB: Unknown", "A: Unknown\nB: Unknown"]


def test_tokens(frame):
    assert values(frame, "string", ["Ça va 2x, OK?"], X.letter_tokens) == [["ça", "va", "2x", "ok"]]
    assert values(frame, "string", ["Ça va"], X.rouge_tokens) == [["a", "va"]]
    got = values(frame, "string", ["Hello, world! It's 3.5-ok &amp; (x).\nEnd-\ning"], X.bleu_tokens)
    assert got == [["Hello", ",", "world", "!", "It's", "3.5", "-", "ok", "&", "(", "x", ")", ".",
                    "Ending"]]


def test_names(frame):
    rows = frame([([("a",), ("",), (None,), ("b",)],)], "p array<struct<name: string>>")
    assert rows.select(X.present_names(F.col("p"))).first()[0] == ["a", "b"]
