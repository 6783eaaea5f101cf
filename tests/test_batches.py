import numpy as np
import pyarrow as pa

from parley.operators.batches import in_runs, runs


def test_runs_hold_few_units_and_every_row_once():
    rng = np.random.default_rng(3)
    for sizes in ([], [0, 0], [9], rng.integers(0, 9, 500), [1, 50, 1, 0, 50]):
        sizes = np.array(sizes, dtype=np.int64)
        cut = list(runs(sizes, 10))
        assert np.concatenate([np.arange(len(sizes))[r] for r in cut] or [[]]).tolist() == list(range(len(sizes)))
        assert all(r.stop - r.start == 1 or sizes[r].sum() <= 10 for r in cut)


def test_a_batch_is_made_in_runs():
    seen = []

    def make(column):
        seen.append(len(column))
        return pa.array([[x] if x is not None else None for x in column.to_pylist()], pa.list_(pa.int64()))

    column = pa.array([1, None, 3, 4, 5])
    assert in_runs(make, np.full(5, 4), 8, column).to_pylist() == [[1], None, [3], [4], [5]]
    assert seen == [2, 2, 1]
    assert in_runs(make, np.empty(0), 8, column[:0]).to_pylist() == []
