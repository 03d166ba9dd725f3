"""Hot keys: one order holds a third of all item rows and one seller a third of
all orders. Results must stay exact (checked against a pandas brute force)."""

from datetime import datetime, timedelta

import pandas as pd

from parcelyze.operators import analytics as A
from parcelyze.operators import star
from parcelyze.operators.model import StarModel

from .fixtures import money, raw_frames


def _skewed(spark, n=3000):
    base = datetime(2018, 1, 1)
    orders, items = [], []
    for i in range(n):
        oid = f"o{i}"
        seller = "HOT" if i % 3 == 0 else f"s{i % 17}"
        late = (i % 5 == 0)
        orders.append((oid, f"c{i % 50}", "delivered", base, base, base + timedelta(days=1),
                       base + timedelta(days=12 if late else 5), base + timedelta(days=10)))
        items.append((oid, 1, f"p{i % 7}", seller, base, money(10 + i % 3), money(1)))
    # one order with a third of all item rows, spread over three sellers
    for j in range(n // 2):
        items.append(("o1", 2 + j, "p1", ["HOT", "s1", "s2"][j % 3], base, money(1), money(0)))
    raw = raw_frames(spark, raw_orders=orders, raw_order_items=items,
                     raw_sellers=[("HOT", 1, "x", "SP")] + [(f"s{k}", k, "y", "RJ") for k in range(17)])
    return raw, pd.DataFrame(items, columns=["order_id", "order_item_id", "product_id", "seller_id",
                                             "shipping_limit_date", "price", "freight_value"])


def test_item_rollup_exact_under_skew(spark):
    raw, items = _skewed(spark)
    got = {r["order_id"]: r for r in star.order_item_rollup(raw["raw_order_items"]).collect()}
    g = items.groupby("order_id")
    for oid, grp in [("o1", g.get_group("o1")), ("o3", g.get_group("o3"))]:
        r = got[oid]
        assert r["item_count"] == len(grp)
        assert r["total_price"] == sum(grp.price)
        assert r["n_sellers"] == grp.seller_id.nunique()
        counts = grp.seller_id.value_counts()
        top = counts[counts == counts.max()].index
        first = min(top, key=lambda s: (grp[grp.seller_id == s].order_item_id.min(), s))
        assert r["primary_seller_id"] == first


def test_scorecard_exact_under_skew(spark):
    raw, _ = _skewed(spark)
    m = StarModel(raw)
    sc = {r["seller_id"]: r for r in A.seller_scorecard(m.fact_orders, m.dim_seller).collect()}
    f = m.fact_orders.filter("n_sellers = 1").toPandas()
    for seller, grp in f.groupby("seller_id"):
        if len(grp) < 5:
            continue
        pct = round(100.0 * (grp.on_time_flag == 1).sum() / grp.on_time_flag.notna().sum(), 2)
        assert sc[seller]["order_count"] == len(grp) and sc[seller]["on_time_pct"] == pct
    assert sc["HOT"]["order_count"] >= 999
