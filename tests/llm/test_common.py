"""Working memory of tasks: a batch is cut into small slices, and what Arrow keeps of
the batches before is given back."""

import pyarrow as pa
import pytest

from parcelyze.llm import common


def batch(lengths):
    return pa.RecordBatch.from_arrays([pa.array(range(len(lengths))), pa.array(
        [None if n is None else "x" * n for n in lengths], pa.string())], names=["id", "text"])


def test_slices_hold_a_megabyte_and_every_row_once():
    lengths = [300_000] * 10 + [None, 0, 3_000_000, 5, None]
    got = list(common.row_slices(batch(lengths), "text"))
    assert pa.Table.from_batches(got).equals(pa.Table.from_batches([batch(lengths)]))
    sizes = [sum(len(t or "") for t in b.column("text").to_pylist()) for b in got]
    assert len(got) > 3 and max(sizes[:3]) <= (1 << 20) + 300_000


@pytest.mark.parametrize("lengths, times", [([5, None, 7], 1), ([], 0)])
def test_kept_memory_is_given_back_once_a_batch(monkeypatch, lengths, times):
    class Pool:
        calls = 0

        def release_unused(self):
            Pool.calls += 1
    monkeypatch.setattr(common.pa, "default_memory_pool", Pool)
    list(common.row_slices(batch(lengths), "text"))
    assert Pool.calls == times
