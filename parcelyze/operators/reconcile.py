"""Order-free digests of tables, and where two tables differ.

Equal row counts say little: rows may differ all the same. A table's digest is its
count, the sum and the exclusive or of two hashes of every row: it does not depend
on the order or the partitioning and adds up from partial aggregates. Digests per
key range show where two tables differ, and only rows of those ranges are compared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hash(columns, seed: int):
    """A hash of whole rows in which a NULL has a place of its own."""
    marked = [x for c in columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(*marked, F.lit(seed))


def _measures(columns) -> list:
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_hash(columns, 1).cast("decimal(38,0)")), F.lit(0)).alias("total"),
            F.coalesce(F.bit_xor(_hash(columns, 2)), F.lit(0)).cast("long").alias("mixed")]


def table_digest(df: DataFrame) -> str:
    """The digest of all rows and columns (names and types included). Runs one job."""
    r = df.agg(*_measures(df.columns)).first()
    return f"{r['n']}:{r['total']}:{r['mixed']}:{df.schema.simpleString()}"


def range_digests(df: DataFrame, key: str, columns, ranges: int) -> DataFrame:
    """One digest per range of the key's hash: (range, n, total, mixed)."""
    return df.groupBy(F.pmod(F.xxhash64(key), F.lit(ranges)).alias("range")).agg(*_measures(columns))


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns, ranges: int = 4096) -> DataFrame:
    """(range, left_rows, right_rows) of the ranges whose digests differ."""
    a = range_digests(left, key, columns, ranges)
    b = range_digests(right, key, columns, ranges).select(*[F.col(c).alias(f"r_{c}") for c in ("range", "n", "total", "mixed")])
    same = F.lit(True)
    for c in ("n", "total", "mixed"):
        same = same & F.col(c).eqNullSafe(F.col(f"r_{c}"))
    return a.join(b, F.col("range") == F.col("r_range"), "full_outer").filter(~same).select(
        F.coalesce("range", "r_range").alias("range"), F.coalesce("n", F.lit(0)).alias("left_rows"),
        F.coalesce("r_n", F.lit(0)).alias("right_rows"))


def reconcile(left: DataFrame, right: DataFrame, key: str, columns, ranges: int = 4096) -> DataFrame:
    """The rows that the tables do not share: (columns, left_only, right_only) with how
    many more times a row stands in either. Only rows of differing ranges are grouped."""
    columns = list(columns)
    where = differing_ranges(left, right, key, columns, ranges).select("range")

    def some(df, sign):
        part = F.pmod(F.xxhash64(key), F.lit(ranges))
        return df.withColumn("range", part).join(where, "range", "left_semi").select(
            *[F.col(f"`{c}`") for c in columns], F.lit(sign).alias("_sign"))
    both = some(left, 1).unionByName(some(right, -1)).groupBy(*columns).agg(F.sum("_sign").alias("_more"))
    return both.filter("_more <> 0").select(
        *columns, F.greatest(F.col("_more"), F.lit(0)).cast("bigint").alias("left_only"),
        F.greatest(-F.col("_more"), F.lit(0)).cast("bigint").alias("right_only"))
