from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
import pytest

from parley.operators.chunking import chunk, split_text


def chunks(frame, texts, size, overlap, method):
    rows = frame([(i, "m", t) for i, t in enumerate(texts)], "i int, meta string, text string")
    got = {}
    for r in chunk(rows, "text", size, overlap, method).orderBy("i", "chunk_no").collect():
        assert r.meta == "m" and r.chunk_no == len(got.setdefault(r.i, []))
        got[r.i].append(r.text)
    return [got.get(i, []) for i in range(len(texts))]


def windows(text, size, overlap):
    step = size - overlap
    n = 1 if len(text) <= size else -(-(len(text) - overlap) // step)
    return [text[i * step : i * step + size] for i in range(n)]


@pytest.mark.parametrize("size, overlap", [(10, 2), (10, 0), (10, 7), (10, 9), (3, 1)])
def test_fixed_windows(frame, size, overlap):
    letters = "abcdé\nfgh ijklmnöpqrstuvwxyz😀0123456789"
    texts = ["", *[(letters * 3)[:n] for n in (1, size - 1, size, size + 1, 2 * size, 57, 90)]]
    assert chunks(frame, texts, size, overlap, "fixed") == [windows(t, size, overlap) for t in texts]


def test_bad_sizes(frame):
    with pytest.raises(ValueError):
        chunk(frame([("x",)], "text string"), "text", 10, 10, "fixed")
    with pytest.raises(ValueError):
        chunk(frame([("x",)], "text string"), "text", 10, 1, "other")


def test_recursive_examples(frame):
    text = "one two three\n\nfour five\nsix\n\n" + "x" * 25
    assert split_text(text, 12, 4) == ["one two", "two three", "four five", "six", "x" * 11,
                                       "x" * 12, "x" * 10]
    assert split_text("", 10, 2) == [] and split_text(" \n ", 10, 2) == []
    assert split_text("short", 10, 2) == ["short"]
    assert split_text("aaa bbb ccc ddd", 8, 4, (" ",)) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert split_text("aaa bbb ccc ddd", 7, 4, (" ",)) == ["aaa bbb", "ccc", "ddd"]
    assert chunks(frame, [text, "", None], 12, 4, "recursive") == [split_text(text, 12, 4), [], []]


TEXTS = st.text(st.sampled_from("ab \n"), max_size=200)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(2, 20), st.data())
def test_recursive_properties(text, size, data):
    overlap = data.draw(st.integers(0, size - 1))
    got = split_text(text, size, overlap)
    assert all(0 < len(c) <= size and c == c.strip() for c in got)
    # apart from white space, each chunk goes on from the end of the one before, or starts in
    # its last ``overlap`` characters
    whole, ends = "".join(text.split()), {0}
    for c in ("".join(c.split()) for c in got):
        ends = {s + len(c) for e in ends for s in range(max(0, e - overlap), e + 1)
                if whole.startswith(c, s)}
    assert len(whole) in ends
