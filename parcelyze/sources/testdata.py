"""Reader for the driver's parquet test tables (`{sf_dir}/{name}.parquet`)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Lazy, schema from the parquet footer; Catalyst prunes columns and pushes
    # filters into the scan for every downstream query.
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
