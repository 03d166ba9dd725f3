"""The modeled layer as one lazily-built object: raw tables in, star schema out."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from . import star


class StarModel:
    """Dimensions and facts built from a raw model (any mapping name -> DataFrame).

    Properties are cached *plans*, not data; nothing runs until an action, with one
    exception: the exact medians of ``dim_geography`` write their distinct value
    counts (two small jobs) when the property is first read."""

    def __init__(self, raw, dedupe_items: bool = False):
        self.raw = raw
        # The fact rollups read raw items, duplicates included (reference behaviour);
        # dedupe_items=True rolls up the de-duplicated fact_order_items instead.
        self.dedupe_items = dedupe_items

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.raw["raw_orders"])

    @cached_property
    def dim_geography(self) -> DataFrame:
        return star.dim_geography(self.raw["raw_geolocation"])

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.raw["raw_customers"])

    @cached_property
    def dim_seller(self) -> DataFrame:
        return star.dim_seller(self.raw["raw_sellers"])

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.raw["raw_products"], self.raw["raw_category_translation"])

    @cached_property
    def fact_order_items(self) -> DataFrame:
        return star.fact_order_items(self.raw["raw_order_items"])

    @cached_property
    def fact_orders(self) -> DataFrame:
        items = self.raw["raw_order_items"]
        if self.dedupe_items:
            items = self.fact_order_items.withColumnRenamed("item_number", "order_item_id")
        return star.fact_orders(self.raw["raw_orders"], items,
                                self.raw["raw_order_payments"], self.raw["raw_order_reviews"])

    def tables(self) -> dict:
        return {n: getattr(self, n) for n in
                ["dim_date", "dim_geography", "dim_customer", "dim_seller",
                 "dim_product", "fact_order_items", "fact_orders"]}


class TableModel:
    """A star schema already written to storage (pipeline output); same
    attributes as StarModel. ``raw``: the written raw layer, if any.
    fact_orders also exposes its ``year_month`` partition column, so month
    filters prune files."""

    def __init__(self, spark: SparkSession, root: str, raw=None):
        self._spark, self._root, self.raw = spark, root.rstrip("/"), raw

    def _read(self, name):
        return self._spark.read.parquet(f"{self._root}/{name}")

    dim_date = property(lambda self: self._read("dim_date"))
    dim_geography = property(lambda self: self._read("dim_geography"))
    dim_customer = property(lambda self: self._read("dim_customer"))
    dim_seller = property(lambda self: self._read("dim_seller"))
    dim_product = property(lambda self: self._read("dim_product"))
    fact_order_items = property(lambda self: self._read("fact_order_items"))
    # the written fact: the 24 contract columns plus its year_month partition column
    fact_orders = property(lambda self: self._read("fact_orders"))


def with_year_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """fact JOIN dim_date ON date_key (JN3); rows without a calendar day drop out.

    dim_date has one row per calendar day between the first and last purchase.
    One wrong date can stretch that span to millions of days, so no broadcast is
    forced: the planner decides by the measured size. When the fact table carries
    its own ``year_month`` (the written, month-partitioned fact), the calendar
    is only a semi-join filter and the month comes from the fact, so a month
    filter downstream prunes fact partitions at the scan."""
    if "year_month" in fact.columns:
        return fact.join(dim_date.select("date_key"), "date_key", "left_semi")
    return fact.join(dim_date.select("date_key", "year_month"), "date_key", "inner")
