from __future__ import annotations

import random
from collections import Counter, defaultdict
from functools import lru_cache
from hashlib import sha256
from itertools import product
from zlib import crc32

import pytest

from parley.llm import conversations
from parley.llm.queries import repairs_of

ROW = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\f\r"


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case == 0:
            continue
        if case == 1:
            text = ""
        if case == 2:
            text = "".join(c for c in text if c not in ".!?")
        yield from [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)


def faults(rows):
    seen = set()
    for _, _, role, text in rows:
        if not text.strip(BLANKS):
            yield "blank"
        elif (role, text) in seen:
            yield "duplicate"
        else:
            yield "fine" if text.rstrip(BLANKS)[-1] in ".!?" else "truncated"
        seen.add((role, text))


def cheapest(initials, marks):
    """(cost, letters, roles) by a plain recursion over rows and what the last role was."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, last, inserts):
        options = []
        if i == len(initials) and last in ("", "a"):
            options.append((0, "", ()))
        if inserts:
            for new in follow[last].replace("s", ""):
                options.append(add(best(i, new, inserts - 1), 5, "I", new))
        if i < len(initials):
            options.append(add(best(i + 1, last, 2), 2, "D", ""))
            if marks[i] in ("fine", "truncated"):
                more = 5 if marks[i] == "truncated" else 0
                for new in follow[last]:
                    if new == initials[i]:
                        options.append(add(best(i + 1, new, 2), more, "K", new))
                    if new != "s":
                        options.append(add(best(i + 1, new, 2), more + 1, "R", new))
        return min(options, default=(10**9, "", ()))

    def add(rest, cost, letter, new):
        return rest[0] + cost, letter + rest[1], (new, *rest[2])

    for i in range(len(initials), 0, -20):  # fills the table from the end
        [best(i, last, 2) for last in follow]
    return best(0, "", 2)


def order(row):
    conv, turn, role, text = row
    return turn is not None, turn or 0, role.encode(), sha256(text.encode()).hexdigest()


def expected(rows, damage=True):
    groups = defaultdict(list)
    ids = {r[0] for r in rows}
    for r in damaged(rows) if damage else rows:
        groups[r[0]].append(r)
    out = []
    for conv in ids:
        own = sorted(groups[conv], key=order)
        marks = list(faults(own))
        initials = [r[2][:1] for r in own]
        cost, letters, roles = cheapest(tuple(initials), tuple(marks))
        lines, at = [], iter(own)
        for letter, new in zip(letters, roles):
            if letter == "I":
                lines.append({"u": "user:", "a": "assistant:"}[new])
                continue
            _, _, role, text = next(at)
            if letter != "D":
                lines.append(f"{role if letter == 'K' else {'u': 'user', 'a': 'assistant'}[new]}:{text}")
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(marks)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, letters,
                    sha256("\n".join(lines).encode()).hexdigest()))
    return Counter(out)


def found(df, **kw):
    return Counter(tuple(r) for r in repairs_of(df, **kw).collect())


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def some_rows(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["", None, " \n", "Yes.", "No", "One! ", f"Line {turn}.", f"Line {turn}", "a:b\n?", "é…"])
            rows.append((conv if conv else None, rng.choice([turn, turn, turn * 3, None]), role, text))
    return rows


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_given_tables(spark, name):
    df = spark.read.parquet(f"/root/testdata/{name}/conversations.parquet")
    assert found(df) == expected(rows_of(df))


def test_random_rows_in_segments(spark):
    rows = some_rows(5, 150, 14)
    df = spark.createDataFrame(rows, ROW).repartition(5)
    from pyspark.sql import functions as F

    clash = df.select("*", *[F.lit("x").alias(c) for c in "kind part number case symbols copies new digest".split()])
    assert found(clash) == expected(rows)
    assert found(df, segment=2) == expected(rows)


def test_one_long_conversation(spark):
    """Longer than a segment and than a partition, with long runs and many copies."""
    rng = random.Random(8)
    rows, turn = [], 0
    for _ in range(60):
        role, text = rng.choice(["user", "assistant", "tool"]), rng.choice(["Same.", None, "Cut", "x"])
        for _ in range(rng.choice([1, 2, 40])):
            rows.append((7, turn // 2, role, text if text != "x" else f"Own {turn}."))
            turn += 1
    df = spark.createDataFrame(rows, ROW).repartition(6)
    assert found(df, segment=7) == found(df) == expected(rows)


def test_empty(spark):
    df = spark.createDataFrame([], ROW)
    assert repairs_of(df).collect() == [] and conversations.repair(df).collect() == []


def test_all_rows_dropped(spark):
    turn = next(t for t in range(1000) if crc32(f"3:{t}".encode()) % 20 == 0)
    assert found(spark.createDataFrame([(3, turn, "user", "Hi.")], ROW)) == Counter(
        [(3, 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())])


def test_repaired_rows(spark):
    rows = [r for r in damaged(some_rows(6, 60, 10))]
    df = spark.createDataFrame(rows, ROW)
    audits = {r.conv_id: r for r in conversations.audit(df).collect()}
    own = defaultdict(list)
    for r in conversations.repair(df).collect():
        own[r.conv_id].append(r)
    for conv, a in audits.items():
        lines = sorted(own[conv], key=lambda r: r.place)
        assert [r.place for r in lines] == list(range(len(lines)))
        assert "".join(r.edit for r in lines) == a.audit.replace("D", "")
        assert sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest() == a.repaired_sha256


def test_least_of_all_edits():
    """Every sequence of letters up to a length, for all short conversations of some symbols."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}

    def outcomes(symbols):
        for size in range(len(symbols) + 4):
            for letters in product("DIKR", repeat=size):
                at, last, cost = 0, "", 0
                for letter in letters:
                    if letter == "I":
                        last, cost = follow[last][-1], cost + 5
                        continue
                    if at == len(symbols):
                        break
                    initial, fault = symbols[at][0], int(symbols[at][1])
                    at += 1
                    if letter == "D":
                        cost += 2
                        continue
                    if fault > 1 or letter == "K" and initial not in follow[last]:
                        break
                    cost += (letter == "R") + 5 * fault
                    last = initial if letter == "K" else follow[last][-1]
                else:
                    if at == len(symbols) and last in ("", "a"):
                        yield cost, "".join(letters)

    kinds = ["s0", "u0", "a0", "x0", "u1", "a3"]
    for n in range(4):
        for symbols in product(kinds, repeat=n):
            wanted = min(outcomes(symbols))
            assert conversations.solve([("".join(symbols), [1] * n, None)]) == wanted


def test_powers_equal_single_steps():
    rng = random.Random(2)
    for _ in range(300):
        runs = [(rng.choice("suax") + str(rng.randrange(4)), rng.choice([1, 2, 3, 7, 20])) for _ in range(rng.randrange(1, 6))]
        single = [s for s, n in runs for _ in range(n)]
        assert conversations.solve([("".join(s for s, _ in runs), [n for _, n in runs], None)]) == conversations.solve(
            [("".join(single), [1] * len(single), None)])
