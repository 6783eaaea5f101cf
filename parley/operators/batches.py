"""Arrow batches cut by what their rows hold, so that Python's memory does not follow the size of a batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Neighbouring rows of ``most`` units together, or a single row of more."""
    ends, start = np.cumsum(sizes), 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield slice(start, stop)
        start = stop


def in_runs(make: Callable[..., pa.Array], sizes: np.ndarray, most: int, *columns: pa.Array) -> pa.Array:
    """``make(*columns)``, whose rows know nothing of each other, called for ``runs`` of rows."""
    parts = [make(*[c.slice(r.start, r.stop - r.start) for c in columns]) for r in runs(sizes, most)]
    return pa.concat_arrays(parts) if parts else make(*columns)
