"""Joins whose sides grow with the input are never planned as a broadcast, however few
bytes their files have: a hash table of all customers goes through the driver."""

from datetime import datetime

from parcelyze.operators import analytics as A
from parcelyze.operators import checks as C
from parcelyze.operators import star
from parcelyze.operators.ranking import global_rank, grouped_exact_quantiles
from parcelyze.sources.adapter import raw_model

from .fixtures import money, raw_frames

DAY = datetime(2018, 1, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _merged(df) -> bool:
    return "SortMergeJoin" in _plan(df) and "BroadcastHashJoin" not in _plan(df)


def _driver_tables(spark, folder) -> str:
    tables = {
        "orders": ([(k, k % 3 if k else None, "O", 10.0 * k, DAY, "LOW") for k in range(6)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(1, 1, 0, 1, 2.0, 5.0, DAY)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                     "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"),
        "customer": ([(k, f"c{k}", k, 1.0, "M") for k in range(2)],
                     "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "supplier": ([(0, "s", 0, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "part": ([(1, "p", "b", "t", 1, 9.0)],
                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
        "nation": ([(0, "A", 0), (1, "B", 0)], "n_nationkey int, n_name string, n_regionkey int")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_adapted_orders_meet_customers_by_merging(spark, tmp_path):
    raw = raw_model(spark, _driver_tables(spark, tmp_path))
    assert _merged(raw["raw_orders"]) and _merged(raw["raw_order_reviews"])
    # an order without a customer, or with an unknown one, stays
    got = {r["order_id"]: r["customer_id"] for r in raw["raw_orders"].collect()}
    assert got == {"0": None, "1": "1", "2": "2", "3": "0", "4": "1", "5": "2"}


def test_geography_joins_merge(spark):
    raw = raw_frames(spark, raw_geolocation=[(1, 1.0, 2.0, "x", "SP"), (1, 3.0, 4.0, "x", "SP"), (2, None, None, "y", "RJ")])
    geo = star.dim_geography(raw["raw_geolocation"])
    assert _merged(geo)
    assert {tuple(r) for r in geo.collect()} == {(1, 2.0, 3.0, "x", "SP"), (2, None, None, "y", "RJ")}
    assert _merged(grouped_exact_quantiles(raw["raw_geolocation"], ["geolocation_city"], "geolocation_lat", [0.5]))


def test_fact_and_dimension_joins_merge(spark, tmp_path):
    raw = raw_frames(spark, raw_orders=[("o1", "c1", "delivered", DAY, DAY, DAY, DAY, DAY)],
                     raw_order_items=[("o1", 1, "p1", "s1", DAY, money(1), money(0))],
                     raw_sellers=[("s1", 1, "x", "SP")], raw_customers=[("c1", "u", 1, "x", "SP")])
    for name, df in raw.items():                    # files tell the planner their few bytes
        df.write.parquet(f"{tmp_path}/{name}")
    raw = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in raw}
    fact = star.fact_orders(raw["raw_orders"], raw["raw_order_items"], raw["raw_order_payments"], raw["raw_order_reviews"])
    assert _merged(fact)
    assert _merged(A.seller_measures(fact, star.dim_seller(raw["raw_sellers"]), 1))
    states = A.state_performance(fact, star.dim_customer(raw["raw_customers"]), 1)
    assert _merged(states) and states.first()["customer_state"] == "SP"


def test_orphan_checks_and_ranks_merge(spark):
    child = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), (None,)], "k string")
    count, rows = C.orphan_count(child, "k", parent, "k"), C.orphan_rows(child, "k", parent, "k")
    assert _merged(count) and count.first()["v"] == 3
    assert _merged(rows) and sorted(r["k"] or "" for r in rows.collect()) == ["", "b", "b"]
    ranked = global_rank(spark.createDataFrame([(2.0,), (1.0,), (None,)], "x double"), "x")
    # the per-bucket totals (at most 513 rows) may be broadcast, the positions may not
    assert "SortMergeJoin" in _plan(ranked)
    assert {(r["x"], r["rank"]) for r in ranked.collect()} == {(None, 1), (1.0, 2), (2.0, 3)}
