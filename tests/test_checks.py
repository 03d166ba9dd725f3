"""Declared checks: every kind, user checks, and the scans a set is compiled to."""

import re

import pytest
from pyspark.sql import functions as F

from parcelyze.operators import quality as Q
from parcelyze.operators.checks import (CheckSet, Coverage, Domain, Recorded, Reference, RowRule, SameCount, UniqueKey,
                                        orphan_rows)


@pytest.fixture(scope="module")
def tables(spark):
    parent = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (4, None)], "k int, kind string")
    child = spark.createDataFrame([(1, 1, 5), (1, 1, -5), (1, 2, 0), (3, 1, 1), (3, 1, 1), (None, 1, 1), (None, 2, -1), (2, 9, 2)],
                                  "k int, line int, v int")
    other = spark.createDataFrame([(1,), (5,), (5,)], "k int")
    return {"parent": parent, "child": child, "other": other}


def checks():
    return CheckSet("x", [
        RowRule("negative", "range_check", "{n} below zero", table="child", broken=lambda: F.col("v") < 0),
        UniqueKey("lines", "duplicate_check", table="child", keys=("k", "line")),
        UniqueKey("keys", "duplicate_check", table="parent", keys=("k",)),
        Reference("child->parent", "referential_integrity", table="child", key="k", parent="parent", parent_key="k"),
        Reference("other->parent", "referential_integrity", table="other", key="k", parent="parent", parent_key="k"),
        Reference("parent->child", "referential_integrity", table="parent", key="k", parent="child", parent_key="k"),
        Domain("kinds", "schema_validation", "{n} strange", table="parent", column="kind", allowed=("a", "b"), clear="none"),
        SameCount("count", "schema_validation", "{count} of {other_count}", table="child", other="parent"),
        Coverage("covered", "business_rule", "{pct}% ({valid}/{total})", table="child", column="k"),
        Recorded("ran", "freshness_check", "at {run_ts}"),
    ])


def result(df):
    return {r.check_id: (r.passed, r.violations, r.detail) for r in df.collect()}


def test_every_kind(tables):
    got = result(checks().compile(tables, "now"))
    assert got == {1: (0, 2, "2 below zero"), 2: (0, 2, "2 violations"), 3: (0, 1, "1 violations"), 4: (0, 4, "4 violations"),
                   5: (0, 2, "2 violations"), 6: (0, 2, "2 violations"), 7: (0, 2, "2 strange"), 8: (0, 3, "8 of 5"),
                   9: (1, 2, "75.0% (6/8)"), 10: (1, 0, "at now")}


def test_violating_rows_match_the_counts(tables):
    c = checks()
    got = result(c.compile(tables, "now"))
    for i in range(1, 8):
        assert c.rows(i, tables).count() == got[i][1], i
    for i in (8, 9, 10):
        with pytest.raises(ValueError, match="drill-down"):
            c.rows(i, tables)


def test_scans_are_one_per_key_that_no_longer_key_holds():
    assert sorted(checks().scans()) == [("child", ("k", "line")), ("other", ("k",)), ("parent", ("k",)), ("parent", ("kind",))]
    assert sorted(Q.RAW.scans()) == [("raw_customers", ("customer_id",)), ("raw_order_items", ("order_id", "order_item_id")),
                                     ("raw_order_reviews", ()), ("raw_orders", ("customer_id",)),
                                     ("raw_orders", ("order_id",)), ("raw_orders", ("order_status",))]
    assert len(Q.MODELED.scans()) == 5
    more = Q.RAW.copy()                                     # riders add no scan
    more.add(RowRule("zero price", "range_check", table="raw_order_items", broken=lambda: F.col("price") == 0))
    more.add(Coverage("approved", "business_rule", table="raw_orders", column="order_approved_at"))
    assert sorted(more.scans()) == sorted(Q.RAW.scans())


def test_the_plan_reads_what_scans_says(small_model):
    text = Q.raw_checks(small_model.raw, "t")._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[[^\]]*l_orderkey", text)) <= 2          # items, and orders' dates derive from lines


def test_user_checks_join_the_layer(spark, small_model):
    mine = Q.RAW.copy()
    mine.add(RowRule("free items", "business_rule", "{n} free", table="raw_order_items", broken=lambda: F.col("price") == 0))

    @mine.check("many", "business_rule", "{n} rows")
    def many(tables):
        return tables("raw_sellers").agg(F.count("*").alias("v"))
    got = result(Q.raw_checks(small_model.raw, "t", mine))
    base = result(Q.raw_checks(small_model.raw, "t"))
    assert {k: v for k, v in got.items() if k <= 12} == base and set(got) == {*range(1, 15)}
    assert got[14] == (0, small_model.raw["raw_sellers"].count(), f"{small_model.raw['raw_sellers'].count()} rows")
    assert len(Q.RAW.checks) == 12                                          # the built-in set is untouched
    assert Q.violating_rows("raw", 13, raw=small_model.raw, checks=mine).count() == got[13][1]


def test_numbers_are_unique_and_given_in_order():
    c = CheckSet("x", [Recorded("a", "f")])
    assert c.add(Recorded("b", "f")).check_id == 2
    with pytest.raises(ValueError, match="exists"):
        c.add(Recorded("c", "f", check_id=2))
    with pytest.raises(ValueError, match="columns"):
        c.add(UniqueKey("d", "f", table="t"))
    with pytest.raises(KeyError):
        c[9]


def test_empty_tables_pass(spark, tables):
    empty = {k: v.limit(0) for k, v in tables.items()}
    got = result(checks().compile(empty, "now"))
    assert all(v[0] == 1 and v[1] == 0 for v in got.values()) and got[7][2] == "none"


def test_a_heavy_null_key_meets_no_join(spark):
    child = spark.createDataFrame([(None, i) for i in range(50)] + [(7, 1), (8, 2)], "k int, v int")
    parent = spark.createDataFrame([(7,), (None,)], "k int")
    got = orphan_rows(child, "k", parent, "k")
    assert got.filter("k IS NULL").count() == 50 and got.filter("k = 8").count() == 1 and got.count() == 51
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "<=>" not in plan                                              # NULLs are filtered, not joined
