import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelyze.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10, every=100, scale=1024):
    ok = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in sorted({i: v for i, v in ok if i % every == 0}.items()):
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:k]
        out += [(q, n, i, -x) for n, (x, i) in enumerate(s, 1)]
    return out


def run(spark, rows, every=100, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("id", F.lit("clash")).withColumn("score", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % every == 0, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def vectors(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, (spread * rng.standard_normal(width)).astype(np.float32).tolist(), 0) for i in range(n)]


@pytest.mark.parametrize("kw", [{}, {"block_rows": 64, "block_queries": 2}, {"block_rows": 7}])
def test_matches_brute_force(spark, kw):
    rows = vectors(500, 16, 1)
    assert run(spark, rows, **kw) == brute(rows)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [0.5, -0.25], 0) for i in range(300)] + [(300 + i, [float(i % 3), 1.0], 0) for i in range(50)]
    assert run(spark, rows, block_rows=32) == brute(rows)


def test_unusable_vectors_take_no_part(spark):
    rows = vectors(40, 4, 2) + [(100, None, 0), (200, [1.0, None, 0.0, 0.0], 0), (300, [float("nan")] * 4, 0),
                                (400, [float("inf"), 0.0, 0.0, 0.0], 0), (None, [1.0] * 4, 0), (-100, [1.0, -2.0, 0.5, 0.0], 0)]
    got = run(spark, rows)
    assert got == brute(rows) and {q for q, *_ in got} == {0, -100}


def test_few_rows_short_vectors_and_empty_table(spark):
    assert run(spark, [(0, [1.0, 2.0], 0)]) == []
    assert run(spark, [(0, [1.0, 2.0], 0), (1, [3.0], 0), (2, [], 0)]) == [(0, 1, 1, 3 * 1024 * 1024), (0, 2, 2, 0)]
    assert run(spark, []) == []


def test_reading_stops_before_the_end():
    """Near duplicates of the query far above the rest: most of the lists stay unread."""
    rng = np.random.default_rng(4)
    base = np.abs(rng.standard_normal(8)) * 5 + 3
    v = np.floor(1024 * np.vstack([base + rng.standard_normal((20, 8)) * 0.01, rng.standard_normal((4000, 8)) * 0.2]))
    lists = topk.Lists(v)
    found = lists.best(v[0], 10)
    assert len(found) <= 40
    exact = np.argsort(-(v @ v[0]), kind="stable")[:10]
    assert set(exact) <= set(found)
