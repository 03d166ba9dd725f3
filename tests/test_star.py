"""Star schema semantics on tiny fixtures and the
reference's ETL tests on the adapted test data."""

from pyspark.sql import functions as F

from parcelyze.operators import star
from parcelyze.operators.model import StarModel

from .fixtures import money, order, raw_frames, ts


def _fact(spark, orders, items=(), payments=(), reviews=()):
    raw = raw_frames(spark, raw_orders=list(orders), raw_order_items=list(items),
                     raw_order_payments=list(payments), raw_order_reviews=list(reviews))
    return {r["order_id"]: r for r in StarModel(raw).fact_orders.collect()}


def test_sla_measures_and_traps(spark):
    f = _fact(spark, [
        order("ok"),                                                     # 2 days early
        order("late", delivered="2018-01-12 06:00:00"),                  # 2.25 days late
        order("noest", estimated=None),                                  # T1
        order("cancel", status="canceled"),                              # T2
        order("neg", approved="2018-01-04 00:00:00"),                    # T3
        order("anom", delivered="2018-01-02 00:00:00"),                  # delivered < carrier
        order("equal", delivered="2018-01-03 00:00:00"),                 # equal stamps: not flagged
        order("open", delivered=None),
    ])
    assert f["ok"]["delivery_delay_days"] == -2.0 and f["ok"]["on_time_flag"] == 1
    assert f["late"]["delivery_delay_days"] == 2.25 and f["late"]["on_time_flag"] == 0
    assert f["noest"]["delivery_delay_days"] is None and f["noest"]["on_time_flag"] == 0
    assert f["cancel"]["on_time_flag"] == 1
    assert f["neg"]["carrier_pickup_days"] == -1.0
    assert f["anom"]["timestamp_anomaly_flag"] is True
    assert f["anom"]["delivery_delay_days"] is None and f["anom"]["on_time_flag"] is None
    assert f["anom"]["shipping_days"] is None
    assert f["equal"]["timestamp_anomaly_flag"] is False
    assert f["open"]["on_time_flag"] is None and f["open"]["timestamp_anomaly_flag"] is False
    assert f["ok"]["processing_days"] == 0.0 and f["ok"]["shipping_days"] == 5.0
    assert f["ok"]["date_key"] == 20180101


def test_rollups_duplicates_nulls_and_ties(spark):
    d = ts("2018-01-01 00:00:00")
    items = [
        ("a", 1, "p1", "s1", d, money(10), money(1)),
        ("a", 1, "p1", "s1", d, money(10), money(1)),      # T4: duplicate line counted
        ("a", 2, "p2", "s2", d, money(5), money(1)),
        ("a", 3, "p3", "s2", d, money(5), money(1)),       # s2 has 2 rows, s1 has 2 rows: tie
        ("b", 1, "p1", "s9", d, None, None),               # T5: all-NULL price -> 0
        ("c", 1, "p1", None, d, money(1), money(1)),       # only NULL seller
    ]
    pays = [("a", 1, "boleto", 2, money(10)), ("a", 2, "voucher", None, money(20)),
            ("b", 1, None, 1, money(3))]
    f = _fact(spark, [order("a"), order("b"), order("c"), order("d")], items, pays)
    assert f["a"]["item_count"] == 4 and f["a"]["total_price"] == money(30)
    assert f["a"]["n_sellers"] == 2
    assert f["a"]["seller_id"] == "s1"                     # T6: tie -> first position
    assert f["a"]["payment_type"] == "boleto"              # T6: 1-1 tie -> first sequential
    assert f["a"]["payment_value"] == money(30) and f["a"]["payment_installments"] == 2
    assert f["b"]["total_price"] == money(0)               # T5
    assert f["b"]["payment_type"] is None                  # all-NULL modal -> NULL
    assert f["c"]["seller_id"] is None and f["c"]["n_sellers"] == 0
    assert f["d"]["item_count"] is None                    # no items: stays NULL


def test_first_row_dedup_and_keys(spark):
    items = [("a", 1, "p2", "s1", ts("2018-01-02 00:00:00"), money(1), money(1)),
             ("a", 1, "p1", "s1", ts("2018-01-01 00:00:00"), money(2), money(1))]
    raw = raw_frames(spark, raw_order_items=items)
    rows = star.fact_order_items(raw["raw_order_items"]).collect()
    assert len(rows) == 1 and rows[0]["product_id"] == "p1" and rows[0]["order_item_id"] == "a-1"


def test_dim_product_null_safe_lookup(spark):
    raw = raw_frames(spark,
                     raw_products=[("x", None, 1.0, 1.0, 1.0, 1.0, 1.0),
                                   ("y", "cama", 1.0, 1.0, 1.0, 1.0, 1.0),
                                   ("z", "PROMO", 1.0, 1.0, 1.0, 1.0, 1.0),
                                   ("w", None, 1.0, 1.0, 1.0, 1.0, 1.0)],
                     raw_category_translation=[("cama", "bed"), (None, "no_category")])
    d = {r["product_id"]: r["category"] for r in StarModel(raw).dim_product.collect()}
    assert d == {"x": "no_category", "y": "bed", "z": "PROMO", "w": "no_category"}
    raw2 = raw_frames(spark, raw_products=[("x", None, 1.0, 1.0, 1.0, 1.0, 1.0)])
    assert StarModel(raw2).dim_product.first()["category"] == "unknown"


def test_dim_geography_median_and_mode(spark):
    rows = [(1, 1.0, 10.0, "b", "SP"), (1, 3.0, 30.0, "a", "SP"), (1, 2.0, 20.0, "b", "RJ"),
            (1, 10.0, 40.0, "a", "RJ"), (None, 9.0, 9.0, "z", "z"), (2, 5.0, 5.0, None, "MG")]
    raw = raw_frames(spark, raw_geolocation=rows)
    g = {r["zip_prefix"]: r for r in StarModel(raw).dim_geography.collect()}
    assert set(g) == {1, 2}
    assert g[1]["lat"] == 2.5 and g[1]["lng"] == 25.0
    assert g[1]["city"] == "a" and g[1]["state"] == "RJ"          # ties -> smallest
    assert g[2]["city"] is None


def test_dim_date_calendar(spark):
    raw = raw_frames(spark, raw_orders=[order("a", purchase="2018-02-27 10:00:00"),
                                        order("b", purchase="2018-03-04 23:00:00")])
    d = StarModel(raw).dim_date.orderBy("date_key").collect()
    assert [r["date_key"] for r in d] == [20180227, 20180228, 20180301, 20180302, 20180303, 20180304]
    assert d[-1]["day_of_week"] == "Sunday" and d[-1]["is_weekend"] is True
    assert d[0]["is_weekend"] is False and d[0]["quarter"] == 1 and d[0]["year_month"] == "2018-02"


# ---- reference ETL tests, on the adapted sf0.001 data
def test_fact_grain_and_no_row_loss(small_model):
    f = small_model.fact_orders
    raw_n = small_model.raw["raw_orders"].count()
    assert f.count() == raw_n == f.select("order_id").distinct().count() == 1500


def test_geography_unique_zip(small_model):
    g = small_model.dim_geography
    assert g.count() == g.select("zip_prefix").distinct().count()


def test_fact_schema(small_model):
    from parcelyze.schemas import FACT_ORDERS_COLS
    assert small_model.fact_orders.columns == FACT_ORDERS_COLS


def test_adapter_counts(small_model):
    raw = small_model.raw
    counts = {n: raw[n].count() for n in ["raw_orders", "raw_order_items",
                                          "raw_order_payments", "raw_order_reviews"]}
    assert counts == {"raw_orders": 1500, "raw_order_items": 6000,
                      "raw_order_payments": 1790, "raw_order_reviews": 1471}
    f = small_model.fact_orders
    assert f.filter(F.col("delivery_delay_days").isNotNull()).count() == 1417
