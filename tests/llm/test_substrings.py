import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelyze.llm import slices, substrings

from . import cases


def brute(rows, words):
    """(id, n_words, n_removed, kept) by a dictionary of whole windows."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for r in order:
        w = (r[1] or "").encode().split()
        gone = set()
        for i in range(len(w) - words + 1):
            key = tuple(w[i:i + words])
            if key in seen:
                gone.update(range(i, i + words))
            seen.add(key)
        out.append((r[0], len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def run(df, words, **kw):
    got = substrings.remove_repeats(df, words=words, **kw).collect()
    for r in got:
        assert r.n_removed == sum(s.end - s.begin for s in r.removed)
        assert all(a.end < b.begin for a, b in zip(r.removed, r.removed[1:]))          # maximal
        assert r.n_words - r.n_removed == len(r.kept.encode().split())
    return sorted(((r.id, r.n_words, r.n_removed, r.kept) for r in got), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def passages(seed, n=60):
    """Documents that share passages, overlap themselves and repeat one short phrase."""
    rng = random.Random(seed)
    pool = [cases.prose(rng, rng.randrange(3, 40)) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(pool) if rng.random() < .5 else cases.prose(rng, rng.randrange(0, 30)) for _ in range(rng.randrange(1, 5))]
        rows.append((i * 3, "\n".join(parts), "en", "s", 0))
    return rows


@pytest.mark.parametrize("words,size", [(20, 8 << 20), (20, 300), (5, 900), (1, 2000), (3, 500)])
def test_same_as_all_windows_compared(spark, words, size, monkeypatch):
    monkeypatch.setattr(slices, "isqrt", lambda n: 7)                   # several slices and buckets of a few lines
    rows = passages(words) + [(100_000, "a " * 300, None, None, 0), (100_001, "a b " * 100, None, None, 0)]
    got = run(cases.docs(spark, rows), words, slice_bytes=size, bucket_bytes=size)
    assert got == brute(rows, words) and sum(r[2] for r in got) > 100


def test_awkward_documents(spark):
    rows = [r for i, r in enumerate(cases.doc_rows()) if r not in cases.doc_rows()[:i]]
    assert run(cases.with_extra(cases.docs(spark)).drop("id").dropDuplicates(["doc_id", "text"]), 4) == brute(rows, 4)


def test_repeated_rows_keep_one_and_ids_may_repeat(spark):
    t, u = " ".join(map(str, range(30))), " ".join(map(str, range(100, 140)))
    rows = [(5, t, "", "", 0), (5, t, "", "", 0), (5, u, "", "", 0), (None, t, "", "", 0), (6, t + " x", "", "", 0), (None, None, "", "", 0)]
    got = run(cases.docs(spark, rows), 20)
    assert [(r[0], r[1], r[2]) for r in got] == [(5, 30, 0), (5, 30, 30), (5, 40, 0), (6, 31, 30), (None, 0, 0), (None, 30, 30)]


def test_one_window_in_every_document(spark):
    hot = " ".join(f"h{i}" for i in range(20))
    rows = [(i, f"x{i} {hot} y{i}", "", "", 0) for i in range(400)]
    got = run(cases.docs(spark, rows), 20, slice_bytes=1000, bucket_bytes=1000)
    assert [r[2] for r in got] == [0] + [20] * 399


def test_empty_table(spark):
    assert substrings.remove_repeats(cases.empty(spark)).count() == 0


def test_rolling_hash_is_the_polynomial():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 33, 60, dtype=np.uint64)
    for n in (1, 2, 3, 7, 20, 32, 61):
        want = [sum(int(x) * pow(12345, n - 1 - j, substrings.PRIME) for j, x in enumerate(v[i:i + n])) % substrings.PRIME
                for i in range(max(0, len(v) - n + 1))]
        assert substrings.rolling(v, n, 12345).tolist() == want


def test_texts_are_exchanged_once(spark):
    import io
    from contextlib import redirect_stdout
    df = substrings.remove_repeats(cases.docs(spark).repartition(3))
    df.collect()
    with redirect_stdout(io.StringIO()) as out:
        df.explain("formatted")
    assert "ReusedExchange" in out.getvalue()
