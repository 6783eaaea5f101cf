"""Places and hashes of the words of a text, for whole texts at once in numpy."""

from __future__ import annotations

import numpy as np

from parley.llm.common import BLANKS

_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True
_LOW = np.arange(256, dtype=np.uint64) + 1
_LOW[65:91] += np.uint64(32)
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_INVERSE = pow(int(_MUL), -1, 1 << 64)


class Words:
    """Places and hashes of the words of a text."""

    up = down = np.ones(0, np.uint64)

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        solid = ~_BLANK[raw]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
        self.start, self.stop = edges[::2], edges[1::2]
        if len(Words.up) <= len(raw):
            room = len(raw) + (1 << 16)
            Words.up = _powers(int(_MUL), room)
            Words.down = _powers(_INVERSE, room)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_LOW[raw] * Words.up[: len(raw)])])
        # The sum over a word, moved to place 0: a polynomial in its bytes, modulo 2**64.
        self.hash = _mixed((sums[self.stop] - sums[self.start]) * Words.down[self.start])

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all stretches of ``k`` words."""
        count = max(0, len(self.hash) - k + 1)
        out = np.zeros(count, np.uint64)
        for i, power in enumerate(_powers(int(_MUL), k)):
            out += self.hash[i : i + count] * power
        return _mixed(out)

    def shingles(self, k: int) -> np.ndarray:
        """The set of those hashes, rising; a shorter sequence counts as one stretch."""
        if len(self.hash) == 0:
            return self.hash
        return np.unique(self.grams(min(k, len(self.hash))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))
