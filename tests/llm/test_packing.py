from __future__ import annotations

from collections import defaultdict
from zlib import crc32

import numpy as np
from tokenizers import Tokenizer

from parley.llm import packing, tokens
from tests.llm.conftest import HARD


def check(rows, texts, length=1024):
    """``texts``: (doc_id, text) of all documents."""
    encode = Tokenizer.from_file(tokens.default_path())
    ids = defaultdict(list)
    for doc_id, text in texts:
        own = np.array([*encode.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        ids[doc_id].append(own)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, ids[doc_id]))
        for r in own:
            fits = [x for x in ids[doc_id] if len(x) == r.doc_tokens]
            assert any(crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in fits)
        if len(ids[doc_id]) == 1:
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at
                at += r.length
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= length
    return len(sequences), sum(r.length for r in rows)


def test_round_trip(docs):
    rows = packing.pack(docs).collect()
    sequences, total = check(rows, [(r.doc_id, r.text) for r in docs.collect()])
    assert sequences == -(-total // 1024)


def test_small_groups(docs):
    rows = packing.pack(docs, group=16, length=256).collect()
    sequences, total = check(rows, [(r.doc_id, r.text) for r in docs.collect()], 256)
    assert sequences * 256 <= total * 1.05


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    sizes = sorted(rng.integers(1, 1024, 400).tolist(), reverse=True)
    cost = defaultdict(float)
    for cuts in packing.assign(sizes, 1024):
        for sequence, _, size in cuts:
            cost[sequence] += size + size * size / 512
    first_fit, room = defaultdict(float), {}
    for size in sizes:
        at = next((s for s, left in room.items() if left >= size), len(room))
        room[at] = room.get(at, 1024) - size
        first_fit[at] += size + size * size / 512
    assert np.std(list(cost.values())) < np.std(list(first_fit.values()))


def test_hard_rows(hard, empty):
    check(packing.pack(hard).collect(), [(r[0], r[1]) for r in HARD])
    assert packing.pack(empty).collect() == []


def test_ids_of_odd_texts():
    exact, encode = Tokenizer.from_file(tokens.default_path()), tokens.load(tokens.default_path())
    for text in ["", " ", "a  b\n\n c", "I'll it's 'S", "é ß €", "日本 ​ x", "<|endoftext|> y", "\U0001f600", "½ ²"]:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids
