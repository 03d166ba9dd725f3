"""Tiny inline raw tables for edge cases (FIXTURES.md section D)."""

from datetime import datetime
from decimal import Decimal

from parcelyze.schemas import RAW


def ts(s):
    return datetime.fromisoformat(s) if s else None


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def raw_frames(spark, **rows):
    """Build a raw model from dicts of row tuples; missing tables are empty."""
    out = {}
    for name, schema in RAW.items():
        data = rows.get(name, [])
        out[name] = spark.createDataFrame(data, schema)
    return out


def order(oid, status="delivered", purchase="2018-01-01 00:00:00", approved="2018-01-01 00:00:00",
          carrier="2018-01-03 00:00:00", delivered="2018-01-08 00:00:00",
          estimated="2018-01-10 00:00:00", customer="c1"):
    return (oid, customer, status, ts(purchase), ts(approved), ts(carrier), ts(delivered), ts(estimated))
