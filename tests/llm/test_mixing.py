import hashlib
import math
import re
from collections import Counter

import pytest

from parcelyze.llm import mixing
from parcelyze.llm.queries import QUERIES

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """The contract read literally: share by weight, stop at the cap, reshare the excess."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(w[n] for n in open_)
        over = {n for n in open_ if w[n] * unit > most * sizes[n]}
        if not over:
            target.update({n: w[n] * unit for n in open_})
            break
        for n in over:
            target[n] = most * sizes[n]
            left -= target[n]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 100, "c": 50}, {"a": 0, "b": 7, None: 3}, {"x": 5},
    {"é": 40, "z": 1, "Z": 9, None: 12, "b": 300}, {str(i): (i * 37) % 91 for i in range(40)}])
def test_targets_match_repeated_resharing(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    want = water_fill(sizes)
    assert got.keys() == want.keys()
    for k in want:
        assert math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9), (k, got, want)


def brute(rows):
    size = lambda t: len(WORD.findall(t or ""))
    per = Counter()
    for r in rows:
        per[r[3]] += size(r[1])
    target = water_fill(dict(per))
    out = []
    for r in rows:
        rate = target[r[3]] / per[r[3]] if per[r[3]] else 0.0
        u = int(hashlib.md5(f"0:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:12], 16) / 2 ** 48
        out.append((r[0], r[1], math.floor(rate) + (u < rate - math.floor(rate))))
    return out


def test_copies_match_brute_force(spark):
    rows = cases.doc_rows()
    got = mixing.plan(cases.with_extra(cases.docs(spark)).drop("id", "size", "target")).collect()
    order = lambda x: (x[0] is not None, x[0] or 0, x[1])
    assert sorted(((r["id"], r["copies"]) for r in got), key=order) == sorted(((i, n) for i, _, n in brute(rows)), key=order)
    assert all(r["copies"] <= 2 and r["size"] >= 0 for r in got)
    mixed = Counter((r["doc_id"], r["text"]) for r in mixing.emit(cases.docs(spark)).collect())
    want = Counter()
    for i, t, n in brute(rows):
        want[i, t] += n
    assert mixed == +want


def test_emit_keeps_clashing_columns(spark):
    df = cases.with_extra(cases.docs(spark))
    assert mixing.emit(df).columns == df.columns
    assert mixing.emit(cases.empty(spark)).count() == 0 and mixing.plan(cases.empty(spark)).count() == 0


def test_sources_come_near_their_targets(spark):
    rows = QUERIES["op9_mixing"](spark, "/root/testdata/sf0.1").toPandas()
    per = rows.groupby(["source_size", "target"]).taken.sum().reset_index()
    assert (abs(per.taken - per.target) <= 0.25 * per.target).all()
    assert abs(per.taken.sum() / per.target.sum() - 1) < 0.05
    assert (rows.taken <= 2 * rows["size"]).all()


def test_native_plan(spark):
    import io
    from contextlib import redirect_stdout
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (mixing.plan(docs), mixing.emit(docs)):
        with redirect_stdout(io.StringIO()) as out:
            df.explain("simple")
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", out.getvalue())
