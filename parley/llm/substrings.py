"""Repeated passages by collinear chaining of shared seeds.

Seeds are k-word stretches, thinned to the least hash of every ``SPAN`` neighbours, so that two texts
with an equal stretch of K + SPAN - 1 words share one. Every seed is matched with one place only: its
first one in the document of smallest id that holds it. So there are no more matches than
seeds, whatever a seed's number of holders. Where seeds are matched, longer keys are matched again in
the same way: every stretch of ``LEAST_WORDS`` words, so that no exact passage is lost whichever
documents hold its parts, and pairs of near seeds that their first holders do not join, which bring
together documents that share edited passages of parts with different first holders. The matches of a
document with one such source are chained: both places must rise and gaps cost, which a Fenwick tree
over the places in the source solves in n log n. From the matches of a chain the texts are aligned in
both directions across edits, in ever longer pieces while an end may lie outside, and passages long
and alike enough are reported from their first to their last equal word. What lies within another
passage of the same text is left out.

Words are compared with A-Z in lower case. Positions are bytes of the UTF-8 text.

Defined results: null ids and null or short texts take no part; rows under one id are one document in
several pieces, each passage is reported once; passages that repeat only within one document are not
reported; copies of a document each have their passage in the first one; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import probably, probably_in
from parley.llm.words import _MUL, Words, _mixed
from parley.session import forget, materialise

K, SPAN = 5, 6
#: Words of a gap that cost as much as a seed earns; a chain is cut at longer ones.
GAP = 48
LEAST_WORDS, LEAST_ALIKE = 50, 0.8
#: Bytes around a chain in which its ends are looked for first, and the growth where they may lie outside.
MARGIN, GROWTH = 400, 16
#: Bytes that are added on both sides for each byte of a group of chains: copies are longer than what joins them.
REACH = 8
#: An edit costs as much as so many equal words; those after the first where it leaves too little alike or too short.
LOSSES = 2, 4, 1, 0.5
#: Words' worth by which an extension may fall below its best.
DROP = 16
#: Matched seeds after one with which it makes pairs.
SKIPS = 8

#: A place is a word's number, its first byte and whether other rows may have the same id, in one number.
_SEED = "seed long, doc_id long, place long"
_MATCH = "doc_id long, place long, source_id long, source_place long"
#: Of an equal stretch its first and its last matched place.
_RUN = "doc_id long, source_id long, place long, source_place long, last long, source_last long"
#: Seeds of a bucket: the columns of ``_SEED`` one after the other, all first bytes of the numbers, then all second ones
#: and so on, as the higher ones are often equal and then need little room.
_BLOCK = "bucket long, rows binary"
#: Runs, or blocks of keys; either has nulls for the other's columns.
_FOUND = _RUN + ", " + _BLOCK

#: Bytes of all texts for each bucket of seeds (some 50,000), and the number of buckets.
BUCKET_BYTES, BUCKETS = 1 << 20, (64, 1 << 20)
#: Rows that a task deals to buckets at once, and those of a bucket that it holds in memory.
_DEAL, _HOLD = 1 << 18, 1 << 20


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _place(word: np.ndarray, at: np.ndarray, many: np.ndarray) -> np.ndarray:
    return (word.astype(np.int64) << 32) | (at.astype(np.int64) << 1) | many


def _word(place: np.ndarray) -> np.ndarray:
    return place >> 32


def _at(place: np.ndarray) -> np.ndarray:
    return (place & 0xFFFFFFFF) >> 1


#: Bytes of texts whose words are hashed at once.
_BYTES = 1 << 18


def _in_turn(rows: Iterator, size: Callable, most: int = _BYTES) -> Iterator[list]:
    """The rows in lists of ``most`` by their size, or of one larger row."""
    held, total = [], 0
    for row in rows:
        if held and total + size(row) > most:
            yield held
            held, total = [], 0
        held.append(row)
        total += size(row)
    if held:
        yield held


class Texts:
    """Words of several texts at once; ``of`` is the text of each word, ``head`` the first word of each text."""

    def __init__(self, texts: list):
        parts, number = [], 0
        for some in _in_turn(iter(texts), len):
            size = np.array([len(t) + 1 for t in some], np.int64)
            low = np.cumsum(size) - size
            words = Words(b" ".join(some))
            of = np.searchsorted(low, words.start, "right") - 1
            parts.append((words.hash, of + number, words.start - low[of], words.stop - low[of]))
            number += len(some)
        self.hash, self.of, self.start, self.stop = [np.concatenate(x) for x in zip(*parts)]
        self.head = np.searchsorted(self.of, np.arange(len(texts) + 1))
        self.count = np.diff(self.head)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all stretches of ``k`` words and whether they lie in one text, with a place for every word."""
        count = len(self.hash)
        whole = np.zeros(count, bool)
        whole[: max(0, count - k + 1)] = self.of[: max(0, count - k + 1)] == self.of[k - 1 :]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hash * Words.up[:count])])
        stop = np.minimum(np.arange(k, count + k), count)
        return _mixed((sums[stop] - sums[:-1]) * Words.down[:count]), whole

    def seeds(self, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and word numbers of the chosen k-word stretches: the least of every ``span`` neighbours of a text."""
        grams, whole = self.grams(k)
        room = self.count - k + 1
        chosen = np.zeros(len(grams), bool)
        if len(grams) >= span:
            view = np.lib.stride_tricks.sliding_window_view(grams, span)
            full = np.flatnonzero(whole[: len(view)] & whole[span - 1 :] & (self.of[: len(view)] == self.of[span - 1 :]))
            chosen[view[full].argmin(1) + full] = True
        for text in np.flatnonzero((room > 0) & (room < span)):
            low = self.head[text]
            chosen[low + grams[low : low + room[text]].argmin()] = True
        at = np.flatnonzero(chosen)
        return grams[at].view(np.int64), at


def _columns(batch: pa.RecordBatch, schema: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in _names(schema)]


def _batch(columns: list[np.ndarray], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], _names(schema))


#: Rows that a task puts together before it hands them on.
_ROWS = 1 << 16


def _handed(parts: Iterator[list[np.ndarray]], schema: str) -> Iterator[pa.RecordBatch]:
    """The parts, a few columns each, in batches of about ``_ROWS`` rows."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += len(part[0])
        if rows >= _ROWS:
            yield _batch([np.concatenate(x) for x in zip(*held)], schema)
            held, rows = [], 0
    if rows:
        yield _batch([np.concatenate(x) for x in zip(*held)], schema)


def _blocks(rows: list[np.ndarray], buckets: int) -> list[pa.Array]:
    """Columns as in ``_BLOCK`` of rows as in ``_SEED``; the lower half of a seed is the even one."""
    seed = rows[0].view(np.uint64)
    turned = (seed << np.uint64(32)) | (seed >> np.uint64(32))
    order = np.argsort(turned)
    bucket = (turned[order] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    rows = np.stack(rows)[:, order]
    begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    ends = np.append(begin[1:], len(bucket))
    parts = [rows[:, a:b].copy().view(np.uint8).reshape(-1, 8).T.tobytes() for a, b in zip(begin, ends)]
    return [pa.array(bucket[begin].astype(np.int64)), pa.array(parts, pa.binary())]


def _dealt(parts: Iterator[list[np.ndarray]], buckets: int) -> Iterator[list[pa.Array]]:
    """Rows as in ``_SEED`` in blocks, ``_DEAL`` rows at a time."""
    for some in _in_turn(parts, lambda part: len(part[0]), _DEAL):
        rows = [np.concatenate(x) for x in zip(*some)]
        if len(rows[0]):
            yield _blocks(rows, buckets)


def _seeds(k: int, span: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            text = batch.column("text")
            for i, (doc_id, many) in enumerate(zip(*[batch.column(n).to_pylist() for n in ("doc_id", "many")])):
                yield doc_id, many, text[i].as_buffer()

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for some in _in_turn(rows(batches), lambda row: len(row[2])):
            doc_id, many, text = zip(*some)
            texts = Texts(list(text))
            seed, at = texts.seeds(k, span)
            of = texts.of[at]
            place = _place(at - texts.head[of], texts.start[at], np.array(many, np.int64)[of])
            yield [seed, np.array(doc_id, np.int64)[of], place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _dealt(parts(batches), buckets):
            yield pa.RecordBatch.from_arrays(columns, _names(_BLOCK))

    return run


def _held_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over rows sorted by (seed, doc_id, place): those of seeds with several rows, each with the seed's first one."""
    last = np.empty((3, 0), np.int64)  # the row before, its seed's first row, and whether it was handed on
    first, out = last, False
    for batch in batches:
        rows = np.concatenate([last, _columns(batch, _SEED)], axis=1)
        if not rows.shape[1]:
            continue
        same = rows[0, 1:] == rows[0, :-1]
        begin = np.flatnonzero(np.concatenate([[True], ~same]))
        heads = rows[:, begin]
        if last.shape[1]:
            heads[:, 0] = first
        of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, rows.shape[1])))
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        if last.shape[1]:
            shared[0] &= not out
        pick = np.flatnonzero(shared)
        # A seed's only row so far stays here until the next one is seen.
        out = bool(shared[-1]) or bool(last.shape[1] and rows.shape[1] == 1 and out)
        last, first = rows[:, -1:], heads[:, -1].copy()
        if len(pick):
            of = of[pick]
            yield _batch([rows[1, pick], rows[2, pick], heads[1, of], heads[2, of]], _MATCH)


def _several(blocks: list[np.ndarray]) -> np.ndarray:
    """The rows of seeds that have several, sorted by (seed, doc_id, place)."""
    rows = np.concatenate(blocks, axis=1)
    order = np.argsort(rows[0])
    seed = rows[0][order]
    same = seed[1:] == seed[:-1]
    rows = rows[:, order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
    return rows[:, np.lexsort(rows[::-1])]


def _stored_first(blocks: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Of a bucket that is not held in memory, as ``_held_first``: its blocks are stored and read again.

    What is held is the first row of each seed, and whether there are several.
    """
    with tempfile.TemporaryFile() as store:
        first, sizes = np.empty((4, 0), np.int64), []
        for some in _in_turn(blocks, lambda block: block.shape[1], _DEAL):
            rows = np.concatenate(some, axis=1)
            rows = rows[:, np.lexsort(rows[::-1])]
            store.write(rows.tobytes())
            sizes.append(rows.shape[1])
            rows = np.concatenate([first, np.concatenate([rows, np.zeros((1, rows.shape[1]), np.int64)])], axis=1)
            rows = rows[:, np.lexsort(rows[2::-1])]
            begin = np.flatnonzero(np.concatenate([[True], rows[0, 1:] != rows[0, :-1]]))
            first = rows[:, begin]
            first[3] = np.maximum.reduceat(rows[3], begin) | (np.diff(np.append(begin, rows.shape[1])) > 1)
        store.seek(0)
        for size in sizes:
            rows = np.frombuffer(store.read(24 * size), np.int64).reshape(3, size)
            of = np.searchsorted(first[0], rows[0])
            pick = np.flatnonzero(first[3, of])
            if len(pick):
                of = of[pick]
                yield _batch([rows[1, pick], rows[2, pick], first[1, of], first[2, of]], _MATCH)


def _held_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over blocks sorted by bucket: the rows of a seed are within one bucket."""

    def blocks() -> Iterator[tuple[int, np.ndarray]]:
        for batch in batches:
            rows = batch.column("rows")
            for i, bucket in enumerate(batch.column("bucket").to_pylist()):
                numbers = np.frombuffer(rows[i].as_buffer(), np.uint8).reshape(8, -1)
                yield bucket, np.ascontiguousarray(numbers.T).view(np.int64).reshape(3, -1)

    for _, own in groupby(blocks(), lambda block: block[0]):
        own, held, size = (rows for _, rows in own), [], 0
        for rows in own:
            held.append(rows)
            size += rows.shape[1]
            if size > _HOLD:
                yield from _stored_first(chain(held, own))
                break
        else:
            rows = _several(held)
            yield from _held_first(iter([_batch(list(rows[:, n : n + _ROWS]), _SEED) for n in range(0, rows.shape[1], _ROWS)]))


def _first_holders(blocks: DataFrame) -> DataFrame:
    """The places of seeds that several places have, each with the first place of the document of smallest id."""
    return blocks.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_held_blocks, _MATCH)


def _runs(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of equal stretches (places on one diagonal, no more than a seed apart) the first and the last place.

    Rows are as in ``_RUN``; they come back by doc_id, source_id and diagonal, with whether several rows end there.
    """
    doc, source, place, there, last, last_there = rows
    line = _word(place) - _word(there)
    order = np.lexsort((place, line, source, doc))
    doc, source, place, there, last, last_there, line = [x[order] for x in (*rows, line)]
    if not len(doc):
        return [*rows, np.zeros(0, bool)]
    new = (np.diff(doc) != 0) | (np.diff(source) != 0) | (np.diff(line) != 0)
    group = np.concatenate([[0], np.cumsum(new)])
    # The furthest end so far within a diagonal.
    reach = np.maximum.accumulate((group << 32) + _word(last))
    new |= _word(place[1:]) - (reach[:-1] & 0xFFFFFFFF) > k
    begin = np.flatnonzero(np.concatenate([[True], new]))
    group = np.concatenate([[0], np.cumsum(new)])
    by_end = np.lexsort((_word(last), group))
    end = np.append(begin[1:], len(doc)) - 1
    twice = (end > begin) & (_word(last[by_end[end - 1]]) == _word(last[by_end[end]]))
    end = by_end[end]
    return [doc[begin], source[begin], place[begin], there[begin], last[end], last_there[end], twice]


def _longer(k: int, span: int, least: int, buckets: int):
    """Runs of matched seeds, and longer keys there: all ``least``-word stretches, and pairs of seeds that no one source joins.

    Over rows sorted by doc_id, which alone Spark sorts by its bits. A stretch that another document has too has only
    matched seeds, apart from those that words beside it chose. A stretch within one run is left out: then
    the run's source is the stretch's first holder too, as the least one of its inner seeds, and has them on one line.
    """

    def of_documents(some: list[tuple]) -> Iterator[tuple[str, list[np.ndarray]]]:
        ids, texts_of, rows_of = zip(*some)
        ids, rows = np.array(ids, np.int64), [np.concatenate(x) for x in zip(*rows_of)]
        size = np.array([len(x[0]) for x in rows_of])
        rows = [x[np.lexsort((rows[2], rows[1], rows[0], np.repeat(np.arange(len(ids)), size)))] for x in rows]
        doc = np.repeat(ids, size)
        place, source, there = rows
        runs = _runs([x[source != doc] for x in (doc, source, place, there, place, there)], k)
        twice = runs.pop()
        yield _RUN, runs
        yield _RUN, [runs[i][twice] for i in (0, 1, 4, 5, 4, 5)]
        # Every text of a document meets all its matches.
        number = np.array([len(x) for x in texts_of])
        owner, many = np.repeat(np.arange(len(ids)), number), np.array([m for x in texts_of for m, _ in x], np.int64)
        texts = Texts([t for x in texts_of for _, t in x])
        low = np.cumsum(size) - size
        of = np.repeat(np.arange(len(owner)), size[owner])
        take = np.arange(len(of)) - np.repeat(np.cumsum(size[owner]) - size[owner], size[owner]) + low[owner[of]]
        word, source, there = _word(place)[take], source[take], _word(there)[take]
        seeds, at = texts.seeds(k, span)
        inside = word < texts.count[of]
        word, source, there, of = word[inside], source[inside], there[inside], of[inside]
        word += texts.head[of]
        total = len(texts.hash)
        seed_no = np.full(total, -1)
        seed_no[at] = np.arange(len(at))
        matched = np.zeros(total, bool)
        matched[word] = True
        lone = np.concatenate([[0], np.cumsum((seed_no >= 0) & ~matched)])
        grams, wanted = texts.grams(least)
        begin = np.flatnonzero(wanted)
        inner = max(least - k - span + 2, span - 1)
        begin = begin[lone[begin + inner] == lone[begin + span - 1]]
        # Stretches within a run of the only text of its document.
        first = np.searchsorted(owner, np.searchsorted(ids, runs[0]))
        head, low, stop = texts.head[first], _word(runs[2]), _word(runs[4]) + k - least + 1
        pick = (many[first] == 0) & (runs[3] & 1 == 0) & (stop > low)
        edges = np.zeros(total + 1, np.int64)
        np.add.at(edges, (head + low)[pick], 1)
        np.add.at(edges, (head + stop)[pick], -1)
        begin = begin[np.cumsum(edges)[begin] == 0]
        keys, words = [grams[begin]], [begin]
        own = seed_no[word] >= 0  # the others are of another row under the same id
        word, source, there, of = word[own], source[own], there[own], of[own]
        seeds = seeds.view(np.uint64)[seed_no[word]]
        for skip in range(1, min(SKIPS, len(word) - 1) + 1):
            step = there[skip:] - there[:-skip]
            joined = (source[skip:] == source[:-skip]) & (step >= 0) & (step <= GAP)
            near = (word[skip:] - word[:-skip] <= GAP) & (of[skip:] == of[:-skip])
            pick = np.flatnonzero(~joined & near)
            keys.append(_mixed(seeds[pick] * _MUL + seeds[pick + skip]))
            words.append(word[pick])
        keys, words = np.concatenate(keys).view(np.int64), np.concatenate(words)
        of = texts.of[words]
        place = _place(words - texts.head[of], texts.start[words], many[of])
        yield _SEED, [keys, ids[owner[of]], place]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now, texts, held = None, [], []
        for batch in batches:
            doc, *columns = [batch.column(n).to_numpy() for n in ("doc_id", "place", "source_id", "source_place")]
            text, is_text = batch.column("text"), columns[0] < 0
            begin = np.flatnonzero(np.concatenate([[True], np.diff(doc) != 0])) if len(doc) else np.empty(0, np.int64)
            edges, plain = np.append(begin, len(doc)), np.flatnonzero(is_text)
            columns = [x[~is_text] for x in columns]
            text_at = np.searchsorted(plain, edges)
            at = edges - text_at
            for n, first in enumerate(doc[begin].tolist()):
                if first != now:
                    if held:
                        yield now, texts, [np.concatenate(x) for x in zip(*held)]
                    now, texts, held = first, [], []
                for m in plain[text_at[n] : text_at[n + 1]].tolist():
                    texts.append((int(batch.column("place")[m].as_py() == -1), text[m].as_buffer()))
                if at[n] < at[n + 1]:
                    held.append([x[at[n] : at[n + 1]] for x in columns])
        if held:
            yield now, texts, [np.concatenate(x) for x in zip(*held)]

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[np.ndarray]]]:
        for some in _in_turn(documents(batches), lambda d: sum(len(t) for _, t in d[1])):
            yield from of_documents(some)

    def of_both(some: list[tuple[str, list[np.ndarray]]]) -> Iterator[pa.RecordBatch]:
        names, numbers = _names(_FOUND), len(_names(_RUN))
        if rows := [x for kind, x in some if kind == _RUN]:
            columns = [pa.array(np.concatenate(x)) for x in zip(*rows)]
            none = [pa.nulls(len(columns[0]), t) for t in (pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, *none], names)
        for columns in _dealt((x for kind, x in some if kind == _SEED), buckets):
            yield pa.RecordBatch.from_arrays([*[pa.nulls(len(columns[0]), pa.int64())] * numbers, *columns], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _in_turn(parts(batches), lambda part: len(part[1][0]), _DEAL):
            yield from of_both(some)

    return run


def _fenwick_chains(a: list[int], b: list[int], cost: float) -> list[list[int]]:
    places = sorted(set(b))
    size = len(places)
    best: list[tuple[float, int]] = [(0.0, -1)] * (size + 1)  # greatest score + cost * (a + b) of a prefix
    score, back = [0.0] * len(a), [-1] * len(a)
    for j, (x, y) in enumerate(zip(a, b)):
        rank = bisect_left(places, y)
        top, node = (0.0, -1), rank
        while node > 0:
            top = max(top, best[node])
            node &= node - 1
        gain = top[0] - cost * (x + y) if top[1] >= 0 else 0.0
        score[j] = 1 + max(0.0, gain)
        back[j] = top[1] if gain > 0 else -1
        entry, node = (score[j] + cost * (x + y), j), rank + 1
        while node <= size:
            best[node] = max(best[node], entry)
            node += node & -node
    used, out = [False] * len(a), []
    for j in sorted(range(len(a)), key=lambda i: (-score[i], i)):
        one = []
        while j >= 0 and not used[j]:
            used[j] = True
            one.append(j)
            j = back[j]
        if one:
            out.append(one[::-1])
    return out


_CHAIN = (
    "doc_id long, source_id long, first long, last long, source_first long, source_last long, "
    "ats binary, source_ats binary"
)


def _chained(a: np.ndarray, b: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The matches of all pairs in the order of their chains, and where a chain begins."""
    inner = np.diff(pair) == 0
    crossed = np.unique(pair[1:][inner & (np.diff(b) <= 0)])
    order, begin = np.arange(len(a)), np.concatenate([[True], ~inner])
    for one in crossed:
        low, high = np.searchsorted(pair, [one, one + 1])
        found = _fenwick_chains(a[low:high].tolist(), b[low:high].tolist(), 1 / (2 * GAP))
        order[low:high] = low + np.concatenate(found)
        begin[low:high] = False
        begin[low + np.cumsum([0, *map(len, found[:-1])])] = True
    begin[1:] |= np.diff(a[order]) + np.diff(b[order]) > 2 * GAP
    return order, np.flatnonzero(begin)


def _binaries(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers, each from one of ``begin`` to the next."""
    ends = pa.py_buffer(np.append(begin * 4, len(values) * 4).astype("<i4"))
    return pa.Array.from_buffers(pa.binary(), len(begin), [None, ends, pa.py_buffer(values.astype("<i4"))])


def _chains(k: int):
    """Runs over rows sorted by doc_id, in which all rows of a pair are; a document may go on in the next batch."""

    def of_pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        doc, source, place, there, last, last_there, twice = _runs(rows, k)
        more = (last > place) & ~twice  # an end that is matched by several keys does not count
        doc, source = [np.concatenate([x, x[more]]) for x in (doc, source)]
        place, there = np.concatenate([place, last[more]]), np.concatenate([there, last_there[more]])
        order = np.lexsort((there, place, source, doc))
        doc, source, place, there = [x[order] for x in (doc, source, place, there)]
        pair = np.cumsum(np.concatenate([[0], (np.diff(doc) != 0) | (np.diff(source) != 0)]))
        order, begin = _chained(_word(place), _word(there), pair)
        x, y = _at(place)[order], _at(there)[order]
        end = np.append(begin[1:], len(x)) - 1
        ids = doc[begin], source[begin]
        columns = [pa.array(v) for v in (*ids, x[begin], x[end], y[begin], y[end])]
        return pa.RecordBatch.from_arrays([*columns, _binaries(x, begin), _binaries(y, begin)], _names(_CHAIN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = _columns(batch, _RUN)
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            if not len(rows[0]):
                continue
            edges = np.flatnonzero(np.diff(rows[0]))
            cut = int(edges[-1]) + 1 if len(edges) else 0
            if cut:
                yield of_pairs([x[:cut] for x in rows])
            held = [x[cut:] for x in rows]
        if held is not None:
            yield of_pairs(held)

    return run


#: Chains of one document with one source, near enough to be aligned in one piece; ``chains`` has the places of each.
_GROUP = _CHAIN + ", chains binary, margin long"


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of all rows and how many each row has."""
    rows = [column[i].as_buffer() for i in range(len(column))]
    return np.frombuffer(b"".join(rows), "<i4").astype(np.int64), np.array([len(x) // 4 for x in rows], np.int64)


def _grouped(margin: int):
    """Runs over chains sorted by (doc_id, source_id, first); a group may end with a batch."""

    def of_chains(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, source, first, last, source_first, source_last = _columns(batch, _CHAIN.split(", ats")[0])
        pair = np.cumsum(np.concatenate([[0], (np.diff(doc) != 0) | (np.diff(source) != 0)]))
        reach = np.maximum.accumulate((pair << 32) + last) & 0xFFFFFFFF
        far = np.maximum(source_first[1:] - source_last[:-1], source_first[:-1] - source_last[1:])
        far = np.maximum(far, first[1:] - reach[:-1])
        begin = np.flatnonzero(np.concatenate([[True], (np.diff(pair) != 0) | (far > 2 * margin)]))
        at, number = _flat(batch.column("ats"))
        source_at, _ = _flat(batch.column("source_ats"))
        places = (np.cumsum(number) - number)[begin]
        ends = [
            np.minimum.reduceat(first, begin), np.maximum.reduceat(last, begin),
            np.minimum.reduceat(source_first, begin), np.maximum.reduceat(source_last, begin),
        ]
        return pa.RecordBatch.from_arrays(
            [*[pa.array(x) for x in (doc[begin], source[begin], *ends)], _binaries(at, places),
             _binaries(source_at, places), _binaries(number, begin), pa.array(margin + REACH * (ends[1] - ends[0]))],
            _names(_GROUP),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield of_chains(batch)

    return run


_NONE = -(1 << 62)
_LAST = 1 << 62


def _slide(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """How many words from x in ``a`` and y in ``b`` on are equal, ``most`` of them at most."""
    out, rows, width = np.zeros(len(x), np.int64), np.flatnonzero(most > 0), 4
    rows = rows[a[x[rows]] == b[y[rows]]]  # few go on
    out[rows] = 1
    rows = rows[most[rows] > 1]
    while len(rows):
        ahead = out[rows, None] + np.arange(width)
        inside = ahead < most[rows, None]
        ahead = np.where(inside, ahead, 0) * step
        equal = (a[x[rows, None] + ahead] == b[y[rows, None] + ahead]) & inside
        stop = np.where(equal.all(1), width, equal.argmin(1))
        out[rows] += stop
        rows = rows[(stop == width) & (out[rows] < most[rows])]
        width = min(4 * width, 64)
    return out


def _extend(
    a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, room: np.ndarray, other: np.ndarray, step: int,
    loss: float,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From many (i, j) on by ``step``, across edits: words taken of both sides, equal ones, whether a border ended it.

    ``room`` and ``other`` are the words that may be taken. Furthest places by number of edits and diagonal; an equal
    word earns 1, an edit costs ``loss``, and the search ends when all are ``DROP`` below the best. Rows are searches,
    columns diagonals; a place is its x and its equal words in one number. Among diagonals that come equally far the
    first one reached counts, so each has its turn besides.
    """
    drop = 2 * DROP * min(1, loss / LOSSES[0])  # scores count double
    x0, y0 = (i, j) if step > 0 else (i - 1, j - 1)
    n = _slide(a, b, x0, y0, np.minimum(room, other), step)
    taken, source_taken, equal, score = n.copy(), n.copy(), n.copy(), 2 * n
    border = (n == room) | (n == other)
    rows, low = np.arange(len(i)), 0
    far, turn = ((n << 32) + n)[:, None], np.zeros((len(i), 1), np.int64)
    edits = 0
    while len(rows):
        edits += 1
        width = far.shape[1] + 2
        low -= 1
        lines = low + np.arange(width)
        over = (np.minimum(room[rows, None], other[rows, None] + lines) + 1) << 32
        new = np.full((len(rows), width), _NONE)
        turns = np.full((len(rows), width), _LAST)
        tripled = 3 * turn
        for no, more, to in ((0, 1, 1), (1, 0, 0), (2, 1, 2)):
            part = slice(to, to + width - 2)
            moved, moved_turn = far + (more << 32), tripled + no
            out = (moved < 0) | (moved >= over[:, part])
            moved[out], moved_turn[out] = _NONE, _LAST
            np.maximum(new[:, part], moved, out=new[:, part])
            np.minimum(turns[:, part], moved_turn, out=turns[:, part])
        r, c = np.nonzero(new >= 0)
        x = new[r, c] >> 32
        y, row = x - lines[c], rows[r]
        n = _slide(
            a, b, x0[row] + step * x, y0[row] + step * y, np.minimum(room[row] - x, other[row] - y), step
        )
        x, y = x + n, y + n
        same = (new[r, c] & 0xFFFFFFFF) + n
        new[r, c] = (x << 32) + same
        worth = np.full(new.shape, -1e18)
        worth[r, c] = 2 * same - 2 * loss * edits
        best = score[rows]
        top = worth.max(1)
        better = top > best
        keep = worth >= (np.maximum(best, top) - drop)[:, None]
        # A diagonal is judged by the best of those before it.
        open_rows = np.flatnonzero(better & ((worth >= (best - drop)[:, None]) & ~keep).any(1))
        if len(open_rows):
            order = turns[open_rows].argsort(1, kind="stable")
            sorted_ = np.take_along_axis(worth[open_rows], order, 1)
            so_far = np.maximum(np.maximum.accumulate(sorted_, 1), best[open_rows, None])
            some = np.zeros(order.shape, bool)
            np.put_along_axis(some, order, sorted_ >= so_far - drop, 1)
            keep[open_rows] = some
        up = np.flatnonzero(better)
        if len(up):
            first = np.where(worth[up] == top[up, None], turns[up], _LAST).argmin(1)
            place, to = new[up, first], rows[up]
            taken[to], equal[to], score[to] = place >> 32, place & 0xFFFFFFFF, top[up]
            source_taken[to] = taken[to] - lines[first]
        kept = keep[r, c]
        border[row[kept & ((x == room[row]) | (y == other[row]))]] = True
        columns = np.flatnonzero(keep.any(0))
        if not len(columns):
            break
        part = slice(columns[0], columns[-1] + 1)
        left = keep.any(1)
        keep = keep[left, part]
        far, turn = np.where(keep, new[left, part], _NONE), turns[left, part]
        rows, low = rows[left], low + int(columns[0])
        if edits % 32 == 0:
            turn = np.where(keep, turn, _LAST).argsort(1, kind="stable").argsort(1)
    return taken, source_taken, equal, border


def align(
    a: list, b: list, pairs: list[tuple[int, int]], loss: float = 2
) -> tuple[int, int, int, int, int]:
    """From equal places (i, j), of which the first counts: the ends in ``a`` and ``b`` and the number of equal words."""
    number = {word: no for no, word in enumerate(dict.fromkeys([*a, *b]))}
    a, b = [np.array([number[word] for word in words], np.uint64) for words in (a, b)]
    i, j, zero = np.array([pairs[0][0]]), np.array([pairs[0][1]]), np.zeros(1, np.int64)
    size, source_size = np.array([len(a)]), np.array([len(b)])
    found = _both_ends(a, b, i, j, zero, size, zero, source_size, loss)
    return tuple(int(x[0]) for x in found[:5])


def _both_ends(
    a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, low: np.ndarray, high: np.ndarray,
    source_low: np.ndarray, source_high: np.ndarray, loss: float, most: int = 1 << 31,
) -> tuple[np.ndarray, ...]:
    """Ends in ``a`` and ``b``, equal words and whether the borders were met, of passages round (i, j)."""
    room, other = np.minimum(i - low, most), np.minimum(j - source_low, most)
    before, source_before, equal, first = _extend(a, b, i, j, room, other, -1, loss)
    first &= np.minimum(i - low, j - source_low) < most
    room, other = np.minimum(high - i, most), np.minimum(source_high - j, most)
    after, source_after, more, last = _extend(a, b, i, j, room, other, 1, loss)
    last &= np.minimum(high - i, source_high - j) < most
    return i - before, i + after, j - source_before, j + source_after, equal + more, first, last


PASSAGE = (
    "doc_id long, source_id long, start long, length long, source_start long, source_length long, "
    "words long, equal_words long"
)


#: What stays open because an end may lie outside the piece.
_OPEN = (
    ", mark long, first long, last long, source_first long, source_last long, ats binary, source_ats binary"
)


#: Bytes of pieces that are aligned at once.
_PIECES = 1 << 22


def _side(pieces: pa.Array, low: np.ndarray, size: np.ndarray) -> tuple[Texts, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of pieces, the first and the end of those of each piece, and at which ends words may be missing.

    Words that the cut may have split are left out.
    """
    data = [pieces[i].as_buffer() for i in range(len(pieces))]
    texts = Texts(data)
    before, after = low > 0, low + np.array([len(x) for x in data]) < size
    first = texts.head[:-1] + before
    return texts, first, np.maximum(first, texts.head[1:] - after), before, after


def _aligned(least: int, alike: float):
    names = _names(PASSAGE + _OPEN)

    def of_chains(rows: pa.RecordBatch) -> pa.RecordBatch:
        low, size, source_low, source_size = [
            rows.column(n).to_numpy().astype(np.int64) for n in ("low", "size", "source_low", "source_size")
        ]
        own, first, stop, *cut = _side(rows.column("piece"), low, size)
        source, source_first, source_stop, *source_cut = _side(rows.column("source_piece"), source_low, source_size)
        cut = [x | y for x, y in zip(cut, source_cut)]
        at, _ = _flat(rows.column("ats"))
        source_at, _ = _flat(rows.column("source_ats"))
        number, chains = _flat(rows.column("chains"))
        row = np.repeat(np.arange(len(chains)), chains)
        of = np.repeat(np.arange(len(number)), number)

        def word(texts: Texts, at: np.ndarray) -> np.ndarray:
            return np.searchsorted((texts.of << 32) + texts.start, (row[of] << 32) + at)

        i, j = word(own, at - low[row[of]]), word(source, source_at - source_low[row[of]])
        first, stop, source_first, source_stop = [x[row] for x in (first, stop, source_first, source_stop)]
        cut = [x[row] for x in cut]
        a, b = own.hash, source.hash
        good = (i >= first[of]) & (i < stop[of]) & (j >= source_first[of]) & (j < source_stop[of])
        good[good] = a[i[good]] == b[j[good]]  # others are of another row under the same id
        i, j, of = i[good], j[good], of[good]
        unsure = np.zeros(len(number), bool)
        found: list[list[np.ndarray]] = [[np.empty(0, np.int64)] * 6]
        # Each chain's first place that lies in none of its passages so far, until there is none.
        while len(of):
            heads = np.flatnonzero(np.concatenate([[True], np.diff(of) != 0]))
            now = of[heads]
            ends = np.zeros((5, len(heads)), np.int64)
            trying = np.arange(len(heads))
            for loss in LOSSES:
                # Cheap edits only help a passage to its least length.
                most = least if loss < LOSSES[0] else 1 << 31
                head, c = heads[trying], now[trying]
                *five, before, after = _both_ends(
                    a, b, i[head], j[head], first[c], stop[c], source_first[c], source_stop[c], loss, most
                )
                ends[:, trying] = five
                unsure[c] |= before & cut[0][c] | after & cut[1][c]
                words, source_words = five[1] - five[0], five[3] - five[2]
                enough = 2 * five[4] >= alike * (words + source_words)
                over = enough & (np.minimum(words, source_words) >= least) | (words < least // 2) | unsure[c]
                trying = trying[~over]
                if not len(trying):
                    break
            words, source_words = ends[1] - ends[0], ends[3] - ends[2]
            whole = np.minimum(words, source_words) >= least
            whole &= 2 * ends[4] >= alike * (words + source_words)
            found.append([now[whole], *ends[:, whole]])
            x, y, z, t = np.repeat(ends[:4], np.diff(np.append(heads, len(of))), axis=1)
            inside = (i >= x) & (i < y) & (j >= z) & (j < t)
            inside[heads] = True
            left = ~inside & ~unsure[of]
            i, j, of = i[left], j[left], of[left]
        c, x, y, z, t, equal = [np.concatenate(v) for v in zip(*found)]
        sure = ~unsure[c]
        c, x, y, z, t, equal = [v[sure] for v in (c, x, y, z, t, equal)]
        start, source_start = own.start[x], source.start[z]
        done = [
            low[row[c]] + start, own.stop[y - 1] - start, source_low[row[c]] + source_start,
            source.stop[t - 1] - source_start, y - x, equal,
        ]
        # What stays open, as it came.
        still = np.flatnonzero(unsure)
        kept, number = np.repeat(unsure, number), number[still]
        begin = np.cumsum(number) - number
        at, source_at = at[kept], source_at[kept]
        end = begin + number - 1
        left = [pa.array(v) for v in (at[begin], at[end], source_at[begin], source_at[end])]
        left += [_binaries(at, begin), _binaries(source_at, begin)]
        of = pa.array(row[np.concatenate([c, still])])
        columns = {n: rows.column(n).take(of) for n in ("doc_id", "source_id", "mark")}
        for n, v in zip(names[2:8], done):
            columns[n] = pa.concat_arrays([pa.array(v, pa.int64()), pa.nulls(len(still), pa.int64())])
        for n, v in zip(names[9:], left):
            columns[n] = pa.concat_arrays([pa.nulls(len(c), v.type), v])
        return pa.RecordBatch.from_arrays([columns[n] for n in names], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = sum(pa.compute.binary_length(batch.column(n)).to_numpy() for n in ("piece", "source_piece"))
            for some in _in_turn(iter(range(batch.num_rows)), size.__getitem__, _PIECES):
                yield of_chains(batch.slice(some[0], len(some)))

    return run


def passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    k: int = K,
    span: int = SPAN,
    least: int = LEAST_WORDS,
    alike: float = LEAST_ALIKE,
) -> DataFrame:
    """One row per passage of at least ``least`` words that an earlier document has too.

    doc_id, source_id, start and length in bytes on both sides, words, equal_words.
    """
    docs = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).where("doc_id IS NOT NULL AND text IS NOT NULL")
    spans = _spans(docs, k, span, least)
    texts = docs.select(F.col("doc_id").alias("of"), F.col("text").cast("binary").alias("data"))
    names = _names(PASSAGE)
    parts, margin = [], MARGIN
    while not spans.isEmpty():
        ids = spans.select("doc_id").unionByName(spans.select(F.col("source_id").alias("doc_id")))
        groups = (
            spans.repartition("doc_id", "source_id")
            .sortWithinPartitions("doc_id", "source_id", "first")
            .mapInArrow(_grouped(margin), _GROUP)
        )
        pieces = _pieces(groups, probably_in(texts, "of", ids))
        done = materialise(pieces.mapInArrow(_aligned(least, alike), PASSAGE + _OPEN))
        parts.append(done.where("start IS NOT NULL").select("mark", *names))
        spans = done.where("start IS NULL").select(*spans.columns)
        margin *= GROWTH
    if not parts:
        return docs.sparkSession.createDataFrame([], PASSAGE)
    # Of passages within another one of the same text only the outer one stays; of equal ones the first source's.
    stop = F.col("start") + F.col("length")
    before = (
        Window.partitionBy("doc_id", "mark")
        .orderBy("start", stop.desc(), "source_id", "source_start", "source_length", F.desc("equal_words"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    found = reduce(DataFrame.unionByName, parts).withColumn("before", F.max(stop).over(before))
    return found.where("before IS NULL OR before < start + length").select(*names).distinct()


def _spans(docs: DataFrame, k: int, span: int, least: int) -> DataFrame:
    """Chains of matches of each document with one earlier document."""
    repeated = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    texts = probably(docs.withColumn("text", F.col("text").cast("binary")), "doc_id", repeated, "many")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(max(size // BUCKET_BYTES, BUCKETS[0]), BUCKETS[1])
    matches = _first_holders(texts.mapInArrow(_seeds(k, span, buckets), _BLOCK))
    none = F.lit(-1).cast("long")
    rows = texts.select(
        "doc_id", (F.col("many").cast("long") - 2).alias("place"), none.alias("source_id"),
        none.alias("source_place"), "text",
    ).unionByName(matches.withColumn("text", F.lit(None).cast("binary")))
    dealt = rows.repartition("doc_id").sortWithinPartitions("doc_id")
    found = materialise(dealt.mapInArrow(_longer(k, span, least, buckets), _FOUND))
    runs = found.where("bucket IS NULL").select(*_names(_RUN))
    longer = _first_holders(found.where("bucket IS NOT NULL").select(*_names(_BLOCK)))
    longer = longer.where("doc_id <> source_id").select(
        "*", F.col("place").alias("last"), F.col("source_place").alias("source_last")
    )
    spans = materialise(
        runs.unionByName(longer)
        .repartition("doc_id", "source_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(_chains(k), _CHAIN)
    )
    forget(found)
    return spans


def _pieces(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """The chains with the margin of their group around them on both sides."""
    margin = F.least(F.col("margin"), F.lit(1 << 30))

    def piece(low: str, last: str):
        width = F.least(F.col(last) - F.col(low) + margin, F.lit((1 << 31) - 1))
        return F.substring("data", (F.col(low) + 1).cast("int"), width.cast("int"))

    found = groups.withColumns({
        "low": F.greatest(F.col("first") - margin, F.lit(0)),
        "source_low": F.greatest(F.col("source_first") - margin, F.lit(0)),
    })
    found = found.join(texts, F.col("doc_id") == F.col("of"))
    found = found.withColumns(
        {"piece": piece("low", "last"), "size": F.octet_length("data"), "mark": F.xxhash64("data")}
    )
    found = found.drop("of", "data").join(texts, F.col("source_id") == F.col("of"))
    found = found.withColumns(
        {"source_piece": piece("source_low", "source_last"), "source_size": F.octet_length("data")}
    )
    return found.drop("of", "data")


def drop_passages(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents without the passages that earlier documents have; all columns stay."""
    cuts = found.groupBy(F.col("doc_id").alias("_of")).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias("_cuts")
    )  # within one text
    text = F.col(text_col).cast("binary")
    whole = F.struct(F.lit(0).cast("long").alias("at"), F.lit(b"").alias("kept"))

    def step(done, cut):
        return F.struct(
            F.greatest(done["at"], cut["start"] + cut["length"]).alias("at"),
            F.concat(
                done["kept"],
                F.substring(
                    text, (done["at"] + 1).cast("int"),
                    F.greatest(cut["start"] - done["at"], F.lit(0)).cast("int"),
                ),
            ).alias("kept"),
        )

    left = F.aggregate(
        "_cuts", whole, step,
        lambda done: F.concat(
            done["kept"],
            F.substring(text, (done["at"] + 1).cast("int"), F.octet_length(text).cast("int")),
        ).cast("string"),
    )
    joined = docs.join(cuts, docs[id_col] == F.col("_of"), "left")
    kept = F.when(F.col("_cuts").isNull(), F.col(text_col)).otherwise(left)
    return joined.select(*[kept.alias(c) if c == text_col else F.col(c) for c in docs.columns])
