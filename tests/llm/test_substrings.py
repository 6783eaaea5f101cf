from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from parley.llm import substrings

SCHEMA = "doc_id long, text string"


def prose(rng, words):
    return [f"{rng.choice('abcdefgh')}{rng.randint(0, 30000)}" for _ in range(words)]


def planted(seed, copies, size, edits=0):
    """Documents of their own words; the first ``copies`` share one passage, with edits."""
    rng = random.Random(seed)
    passage, rows = prose(rng, size), []
    for i in range(40):
        words, own = prose(rng, rng.randint(30, 400)), list(passage)
        if i < copies:
            for _ in range(edits if i else 0):
                own[rng.randrange(size)] = f"x{rng.randint(0, 9999)}"
            at = rng.randint(0, len(words))
            words[at:at] = own
        rows.append((i * 7 + 1, " ".join(words)))
    return rows, passage


def test_exact_passages_are_found(spark):
    for seed in range(4):
        rows, passage = planted(seed, 9, 52)
        found = substrings.passages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
        assert {r.doc_id for r in found} == {i * 7 + 1 for i in range(1, 9)}
        texts = dict(rows)
        for r in found:
            assert r.source_id == 1 and r.words == r.equal_words >= 52
            cut = texts[r.doc_id].encode()[r.start : r.start + r.length].decode()
            assert " ".join(passage) in cut
            assert cut == texts[1].encode()[r.source_start : r.source_start + r.source_length].decode()


def test_edited_passages_are_found(spark):
    rows, _ = planted(11, 8, 120, edits=5)
    found = substrings.passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in found} == {i * 7 + 1 for i in range(1, 8)}
    assert all(r.words > r.equal_words >= 0.8 * r.words for r in found)


def test_short_repeats_are_left_alone(spark):
    rows, _ = planted(12, 30, 35)
    assert substrings.passages(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_passages_are_dropped(spark):
    rows, passage = planted(13, 5, 80)
    df = spark.createDataFrame([(*r, "é") for r in rows], SCHEMA + ", more string")
    left = substrings.drop_passages(df, substrings.passages(df))
    assert left.columns == df.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    for doc_id, text in rows:
        expected = text if doc_id in (1, *(i * 7 + 1 for i in range(5, 40))) else text.replace(" ".join(passage), "")
        assert texts[doc_id] == expected


def brute_score(a, b, gap):
    """Best score of a chain by comparing all pairs."""
    score = []
    for j in range(len(a)):
        before = [
            score[i] - (a[j] - a[i] + b[j] - b[i]) / (2 * gap) for i in range(j) if a[i] < a[j] and b[i] < b[j]
        ]
        score.append(1 + max([0.0, *before]))
    return max(score)


def test_best_chain():
    rng = random.Random(2)
    for _ in range(300):
        a = sorted(rng.sample(range(300), 25))
        b = [rng.randint(0, 300) for _ in a]
        chains = substrings._fenwick_chains(a, b, 1 / 96)
        assert sorted(i for c in chains for i in c) == list(range(25))
        def worth(c):
            return len(c) - (a[c[-1]] - a[c[0]] + b[c[-1]] - b[c[0]]) / 96

        assert abs(max(map(worth, chains)) - brute_score(a, b, 48)) < 1e-9
        assert all(b[x] < b[y] for c in chains for x, y in zip(c, c[1:]))


def test_alignment():
    a, b = list("abcdefghijk"), list("xbcdeQfghijkz")
    assert substrings.align(a, b, [(2, 2), (8, 9)]) == (1, 11, 1, 12, 10)


def test_hard_rows(hard, empty):
    assert substrings.passages(hard).count() == 0
    assert substrings.passages(empty).collect() == []
    assert substrings.drop_passages(hard, substrings.passages(hard)).count() == hard.count()


def longest_common(a, b):
    """Word numbers of ``a`` in the stretches of 50 words or more that ``b`` has too, by comparing all places."""
    covered, row = set(), [0] * (len(b) + 1)
    for i, x in enumerate(a):
        row = [0, *[row[j] + 1 if x == y else 0 for j, y in enumerate(b)]]
        for n in {n for n in row if n >= 50}:
            covered.update(range(i - n + 1, i + 1))
    return covered


def covered_by(found, doc_id, text):
    data, out = text.encode(), set()
    for r in found:
        if r.doc_id == doc_id:
            before = len(data[: r.start].split())
            out.update(range(before, before + len(data[r.start : r.start + r.length].split())))
    return out


def test_passages_stitched_of_lines_with_other_first_holders(spark):
    """Lines of earlier documents, each too short, make a passage that two later documents share."""
    rng, rows = random.Random(21), []
    for case in range(12):
        parts = [prose(rng, n) for n in ((26, 26), (30, 22), (18, 18, 18), (49, 1, 49))[case % 4]]
        texts = [prose(rng, 40) + part + prose(rng, 40) for part in parts]
        if case % 4 == 3:  # the two overlap: either holds 49 of the 50 words
            whole = prose(rng, 50)
            texts = [prose(rng, 40) + whole[:49] + prose(rng, 40), prose(rng, 40) + whole[1:] + prose(rng, 40)]
        else:
            whole = [w for part in parts for w in part]
        texts += [prose(rng, 60) + whole + prose(rng, 60) for _ in range(2)]
        rows += [(case * 10 + i, " ".join(t)) for i, t in enumerate(texts)]
    found = substrings.passages(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    texts = dict(rows)
    for doc_id, text in rows:
        expected = set()
        for other in (i for i in texts if i < doc_id and i // 10 == doc_id // 10):
            expected |= longest_common(text.split(), texts[other].split())
        assert expected <= covered_by(found, doc_id, text)
    assert len({r.doc_id for r in found}) == 12


def test_edited_short_passages_are_found(spark):
    """Share found of passages of the stated likeness; each pair has words of its own."""
    rng, rows, kinds = random.Random(22), [], {}
    for words, edits in ((50, 1), (55, 2), (60, 4), (80, 6), (50, 8), (80, 8)):
        for _ in range(40):
            passage, n = prose(rng, words), 2 * len(kinds)
            own = list(passage)
            for at in rng.sample(range(1, words - 1), edits):
                own[at] = f"x{rng.randint(0, 9999)}"
            for i, part in enumerate((passage, own)):
                rows.append((n + i, " ".join(prose(rng, 60) + part + prose(rng, 60))))
            kinds[n + 1] = words, edits
    found = {r.doc_id for r in substrings.passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    shares = {}
    for doc_id, kind in kinds.items():
        shares.setdefault(kind, []).append(doc_id in found)
    shares = {kind: sum(x) / len(x) for kind, x in shares.items()}
    assert min(shares.values()) >= 0.9, shares


def test_passages_of_long_words_are_found(spark):
    """Ends are not lost where words are long, however many bytes lie beyond the outermost seed."""
    rng, rows, expected = random.Random(23), [], {}
    for size, words in ((30, 52), (50, 52), (80, 60), (2000, 55)):
        for _ in range(6):
            passage, n = [f"{w}é".ljust(size, "z") for w in prose(rng, words)], 2 * len(expected)
            for i in range(2):
                rows.append((n + i, " ".join(prose(rng, 60) + passage + prose(rng, 60))))
            expected[n + 1] = " ".join(passage)
    found = substrings.passages(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = dict(rows)
    cuts = {r.doc_id: texts[r.doc_id].encode()[r.start : r.start + r.length].decode() for r in found}
    assert cuts == expected


def plain_extend(a, b, i, j, step, loss, room, other):
    """One search by a dictionary of diagonals."""
    x0, y0 = (i, j) if step > 0 else (i - 1, j - 1)

    def slide(x, y):
        start = x
        while x < room and y < other and a[x0 + step * x] == b[y0 + step * y]:
            x, y = x + 1, y + 1
        return x - start

    n = slide(0, 0)
    best, border = (n, n, n, n), n == room or n == other
    reached, edits = {0: (n, n)}, 0
    while reached:
        edits += 1
        new = {}
        for diagonal, (x, equal) in reached.items():
            for more, to in ((1, diagonal), (0, diagonal - 1), (1, diagonal + 1)):
                if x + more <= room and 0 <= x + more - to <= other:
                    new[to] = max(new.get(to, (-1, 0)), (x + more, equal))
        reached = {}
        for diagonal, (x, equal) in new.items():
            n = slide(x, x - diagonal)
            x, equal = x + n, equal + n
            score = equal - loss * edits
            if score > best[0]:
                best = (score, x, x - diagonal, equal)
            if score >= best[0] - substrings.DROP * min(1, loss / substrings.LOSSES[0]):
                border |= x == room or x - diagonal == other
                reached[diagonal] = (x, equal)
    return *best[1:], border


def test_many_searches_at_once_end_where_each_one_does():
    rng = random.Random(31)
    a, b, starts = [], [], []
    for case in range(150):
        own = [rng.randint(0, 3 if case % 3 else 5000) for _ in range(rng.randint(1, 400))]
        other = list(own)
        for _ in range(rng.randint(0, 40)):
            at = rng.randrange(len(other))
            other[at : at + rng.randint(0, 3)] = [rng.randint(0, 3) for _ in range(rng.randint(0, 3))]
            other = other or [1]
        for _ in range(3):
            i, j = rng.randint(0, len(own)), rng.randint(0, len(other))
            starts.append((len(a), len(a) + len(own), len(b), len(b) + len(other), len(a) + i, len(b) + j))
        a, b = a + own, b + other
    low, high, source_low, source_high, i, j = np.array(starts).T
    words, source_words = np.array(a, np.uint64), np.array(b, np.uint64)
    for loss in substrings.LOSSES:
        for step, room, other in ((-1, i - low, j - source_low), (1, high - i, source_high - j)):
            for most in (50, 1 << 31):
                sides = np.minimum(room, most), np.minimum(other, most)
                found = substrings._extend(words, source_words, i, j, *sides, step, loss)
                expected = [
                    plain_extend(a, b, x, y, step, loss, r, o) for x, y, r, o in zip(i, j, *(s.tolist() for s in sides))
                ]
                assert [tuple(map(int, x)) for x in zip(*found)] == [tuple(map(int, x)) for x in expected]


def test_first_holders_do_not_depend_on_batches():
    rng = np.random.default_rng(5)
    rows = np.stack([rng.integers(0, 60, 150), rng.integers(-3, 9, 150), rng.integers(0, 99, 150)])
    rows = rows[:, np.lexsort(rows[::-1])]
    seeds, number = np.unique(rows[0], return_counts=True)
    assert 1 in number and number.max() > 3
    expected = []
    for seed in seeds[number > 1]:
        own = rows[:, rows[0] == seed]
        expected += [(*x, *own[1:, 0].tolist()) for x in own[1:].T.tolist()]
    for size in (1, 2, 3, 7, 150):
        batches = [substrings._batch(list(rows[:, n : n + size]), substrings._SEED) for n in range(0, 150, size)]
        found = [tuple(r.values()) for b in substrings._held_first(iter(batches)) for r in b.to_pylist()]
        assert found == expected, size


def test_chains_of_two_texts_share_a_piece():
    """Many chains of one pair of documents carry the texts round them once."""
    at = np.array([0, 40, 700, 5000, 5300, 90_000])
    chain = [(1, 0, x, x + 20, x + 9, x + 29, *[np.array([y, y + 20], "<i4").tobytes() for y in (x, x + 9)]) for x in at.tolist()]
    chain += [(1, 3, *r[2:]) for r in chain[:1]]
    names = substrings._names(substrings._CHAIN)
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in chain])
    (groups,) = substrings._grouped(400)(iter([batch]))
    rows = groups.to_pylist()
    assert [(r["source_id"], r["first"], r["last"]) for r in rows] == [(0, 0, 720), (0, 5000, 5320), (0, 90_000, 90_020), (3, 0, 20)]
    places = [np.frombuffer(r["ats"], "<i4").tolist() for r in rows]
    assert places[0] == [0, 20, 40, 60, 700, 720] and places[3] == [0, 20]
    assert [np.frombuffer(r["chains"], "<i4").tolist() for r in rows] == [[2, 2, 2], [2, 2], [2], [2]]


def test_seeds_in_blocks_meet_their_first_holders(monkeypatch):
    """Seeds go to tasks in few rows, a block for each bucket, and have the same first holders, also where a bucket is stored."""
    rng = np.random.default_rng(6)
    rows = np.stack([rng.integers(-40, 40, 900) << 33, rng.integers(-3, 9, 900), rng.integers(0, 99, 900)])
    rows[0, :400] = 7 << 33  # a hot seed
    rows[0, -300:] = rng.integers(-(1 << 62), 1 << 62, 300)  # alone
    ordered = rows[:, np.lexsort(rows[::-1])]
    expected = [tuple(r.values()) for b in substrings._held_first(iter([substrings._batch(list(ordered), substrings._SEED)])) for r in b.to_pylist()]
    for deal, hold in ((1 << 20, 1 << 21), (64, 1 << 21), (64, 100)):
        monkeypatch.setattr(substrings, "_DEAL", deal)
        monkeypatch.setattr(substrings, "_HOLD", hold)
        parts = (list(rows[:, n : n + 50]) for n in range(0, 900, 50))
        blocks = [r for columns in substrings._dealt(parts, 4) for r in zip(*[c.to_pylist() for c in columns])]
        assert len(blocks) <= 4 * 18 and {b for b, _ in blocks} <= {0, 1, 2, 3}
        blocks.sort(key=lambda r: r[0])
        batches = [
            pa.RecordBatch.from_arrays([pa.array(list(x)) for x in zip(*blocks[n : n + 5])], ["bucket", "rows"])
            for n in range(0, len(blocks), 5)
        ]
        found = [tuple(r.values()) for b in substrings._held_blocks(iter(batches)) for r in b.to_pylist()]
        assert sorted(found) == sorted(expected), (deal, hold)
