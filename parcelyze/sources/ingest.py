"""Raw-layer ingest (SRC1/SRC2) and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_counts(raw) -> DataFrame:
    """One row per raw table: (table_name, row_count). One small job per table,
    unioned; each count is a partial-aggregated scan of that table only."""
    parts = [df.select(F.lit(name).alias("table_name"),
                       F.count(F.lit(1)).alias("row_count")) for name, df in raw.items()]
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------- CSV ingest

from pyspark.sql import SparkSession, Observation  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from ..schemas import RAW  # noqa: E402
from ..session import drop_folders, dropping_shuffles, path_exists, write_tables  # noqa: E402
from .csv_records import read_text_table  # noqa: E402

# Source file of each raw table.
CSV_FILES = {
    "raw_orders": "olist_orders_dataset.csv",
    "raw_order_items": "olist_order_items_dataset.csv",
    "raw_order_payments": "olist_order_payments_dataset.csv",
    "raw_order_reviews": "olist_order_reviews_dataset.csv",
    "raw_customers": "olist_customers_dataset.csv",
    "raw_sellers": "olist_sellers_dataset.csv",
    "raw_products": "olist_products_dataset.csv",
    "raw_geolocation": "olist_geolocation_dataset.csv",
    "raw_category_translation": "product_category_name_translation.csv",
}
# Text a pandas CSV reader turns into missing values by default.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
             "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
             "nan", "null"]
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
SEQ_COL = "_seq"                              # ingest sequence (file order), when known
SEQUENCED_TABLES = {"raw_order_items", "raw_order_payments"}


BAD_CELLS = "_unparsed_cells"                 # written next to the raw tables


def read_csv_text(spark: SparkSession, path: str, name: str, written: list | None = None, split_bytes=None) -> DataFrame:
    """SRC1 read side: every column of the file (or of all files of a folder) as text,
    unchanged (header, quoted fields with line breaks, BOM-safe; no trimming, no NA
    tokens, no inference). Files are read in splits, see ``csv_records``. A contract
    column that the header lacks is an error.

    Item and payment rows carry the number of their record over all files, for
    "first occurrence" tie-breaks; it does not depend on the splits. ``written`` and
    ``split_bytes``: see ``read_text_table``."""
    df = read_text_table(spark, path, SEQ_COL if name in SEQUENCED_TABLES else None, written, split_bytes)
    missing = [f.name for f in RAW[name].fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"{path}: columns {missing} of {name} are not in its header {df.columns}")
    return df


def _value(c: Column) -> Column:
    """The cell, or NULL where its text is exactly one of the NA tokens."""
    return F.when(c.isNull() | c.isin(NA_TOKENS), F.lit(None)).otherwise(c)


def _typed(c: Column, f) -> Column:
    """The cell in the contract's type, NULL where its text is not of that type. A
    whole number may be written 01037 or 3.0, as a float column is; 4.7 is none."""
    if isinstance(f.dataType, T.TimestampNTZType):
        return F.try_to_timestamp(c, F.lit(TS_FORMAT)).cast("timestamp_ntz")
    if isinstance(f.dataType, (T.IntegerType, T.LongType)):
        n = F.trim(c).try_cast("decimal(38,9)")
        return F.when(n == F.floor(n), n).try_cast(f.dataType)
    if isinstance(f.dataType, T.StringType):
        return c
    return F.trim(c).try_cast(f.dataType)


# Forms of a number in a column without a contract type (white space around it is allowed).
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|inf|infinity)\s*$"
# The words that a pandas CSV reader takes for truth values.
TRUTH_WORDS = {"True": True, "TRUE": True, "true": True, "False": False, "FALSE": False, "false": False}


def infer_types(text: DataFrame, columns) -> dict:
    """{column: Spark type} of text columns, as a pandas CSV reader would type them,
    from one aggregate over all cells. Per column six counts are kept, which add up
    over partitions in any order: cells, missing cells, and cells that are 64-bit integers,
    unsigned ones, numbers, truth words. Integers make ``bigint`` (beyond 64 bits
    ``decimal(20,0)``), with missing cells or among other numbers ``double``; truth words
    ``boolean``, with missing cells text, as is everything else. A column without any
    cell is ``double``, one of an empty table text."""
    columns = list(columns)
    if not columns:
        return {}
    cells, counts = [], []
    for i, name in enumerate(columns):                     # every form of a cell is looked at once
        c = _value(F.col(f"`{name}`"))
        cells += [c.alias(f"c{i}"), F.when(c.rlike(_INTEGER), c.try_cast("decimal(38,0)")).alias(f"w{i}"), c.rlike(_FLOAT).alias(f"f{i}")]
        c, whole = F.col(f"c{i}"), F.col(f"w{i}")
        counts += [F.count(c).alias(f"cells{i}"), F.count_if(c.isNull()).alias(f"none{i}"),
                   F.count_if(whole.between(F.lit(-2 ** 63), F.lit(2 ** 63 - 1))).alias(f"signed{i}"),
                   F.count_if(whole.between(F.lit(0), F.lit(str(2 ** 64 - 1)).cast("decimal(38,0)"))).alias(f"unsigned{i}"),
                   F.count_if(F.col(f"f{i}")).alias(f"number{i}"),
                   F.count_if(c.isin(list(TRUTH_WORDS))).alias(f"truth{i}")]
    got = text.select(*cells).agg(*counts).first()

    def decide(i):
        cells, none, signed, unsigned, number, truth = (got[f"{k}{i}"] for k in (
            "cells", "none", "signed", "unsigned", "number", "truth"))
        if cells + none == 0:
            return "string"
        if number == cells:
            if none == 0 and signed == cells:
                return "bigint"
            return "decimal(20,0)" if none == 0 and unsigned == cells else "double"
        return "boolean" if truth == cells and none == 0 else "string"
    return {name: decide(i) for i, name in enumerate(columns)}


def _as(c: Column, kind: str) -> Column:
    if kind == "string":
        return c
    if kind == "boolean":
        return F.when(c.isNotNull(), c.isin([w for w, v in TRUTH_WORDS.items() if v]))
    plain = F.regexp_replace(c, r"\s", "")
    return (F.regexp_replace(plain, r"^\+", "") if kind != "double" else plain).try_cast(kind)


def extra_columns(text: DataFrame, name: str) -> list:
    contract = {f.name for f in RAW[name].fields}
    return [c for c in text.columns if c not in contract and c != SEQ_COL]


def type_raw(text: DataFrame, name: str, extra_types: dict | None = None) -> DataFrame:
    """The text layer typed to the contract. Columns beyond it get their type from
    ``extra_types`` (NA tokens are NULL); without one they pass through as text."""
    contract = {f.name: f for f in RAW[name].fields}
    typed = [_typed(_value(F.col(f"`{n}`")), f).alias(n) for n, f in contract.items()]
    rest = []
    for c in text.columns:
        if c not in contract:
            kind = (extra_types or {}).get(c)
            rest.append(F.col(f"`{c}`") if kind is None else _as(_value(F.col(f"`{c}`")), kind).alias(c))
    return text.select(*typed, *rest)


def unparsed_cells(text: DataFrame, name: str) -> DataFrame:
    """Cells that hold a value which is not of the contract's type: (table_name,
    column_name, cell, row_count), one row per distinct text."""
    checked = [f for f in RAW[name].fields if not isinstance(f.dataType, T.StringType)]
    if not checked:
        return text.limit(0).select(F.lit(name).alias("table_name"), F.lit("").alias("column_name"),
                                    F.lit("").alias("cell"), F.lit(0).cast("bigint").alias("row_count"))
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), _value(F.col(f.name)).alias("cell"),
                               _typed(_value(F.col(f.name)), f).isNull().alias("bad")) for f in checked])
    return (text.select(F.inline(cells)).filter("bad AND cell IS NOT NULL").groupBy("column_name", "cell")
            .agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("table_name"), "column_name", "cell", "row_count"))


def read_raw_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Text and typing in one plan, for a look at a file without landing it."""
    return type_raw(read_csv_text(spark, path, name), name)


@dropping_shuffles
def ingest_csv(spark: SparkSession, raw_dir: str, out_root: str) -> dict:
    """SRC1/SRC2: check that every source file exists and has its columns (before
    writing anything), land each file as text under ``<out_root>/_text``, then type
    the text into the raw tables (columns beyond the contract as ``infer_types`` finds
    them) and list the cells that could not be typed. Row
    counts come from an Observation on the write itself (no second scan).
    Returns {table: rows}."""
    root = out_root.rstrip("/")
    paths = {n: f"{raw_dir.rstrip('/')}/{f}" for n, f in CSV_FILES.items()}
    missing = [p for p in paths.values() if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"Missing raw source file: {missing[0]}")
    # independent tables side by side; nothing is written to out_root before all are read
    written: dict = {n: [] for n in paths}
    read = write_tables({name: lambda n=name, p=path: read_csv_text(spark, p, n, written[n]) for name, path in paths.items()})
    counts = write_tables({name: lambda n=name, d=df: _land(spark, d, n, root, written[n]) for name, df in read.items()})
    bad = [unparsed_cells(spark.read.parquet(f"{root}/_text/{name}"), name) for name in read]
    reduce(DataFrame.unionByName, bad).write.mode("overwrite").parquet(f"{root}/{BAD_CELLS}")
    return counts


def _land(spark: SparkSession, df: DataFrame, name: str, root: str, written: list) -> int:
    """Write one table as text, then typed; what it was read from (``written``) goes as soon as the
    text is there. Returns its rows."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/_text/{name}")
    drop_folders(spark, written)
    text = spark.read.parquet(f"{root}/_text/{name}")
    typed = type_raw(text, name, infer_types(text, extra_columns(text, name)))
    obs = Observation(name)
    typed.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root}/{name}")
    return obs.get["rows"]


def read_unparsed_cells(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{BAD_CELLS}")


def write_csv(raw, folder: str, compression: str = "none", rows_per_file: int = 0) -> None:
    """Export a raw model as the nine CSV sources (one folder of part files each).
    ``compression``: a codec of Spark's CSV writer; files that readers cannot split are best
    kept short with ``rows_per_file``."""
    for name, df in raw.items():
        cols = [F.date_format(c, TS_FORMAT).alias(c) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes
                if c != SEQ_COL]
        (df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').option("compression", compression)
         .option("maxRecordsPerFile", rows_per_file).option("emptyValue", "").csv(f"{folder.rstrip('/')}/{CSV_FILES[name]}"))


def write_raw(raw, out_root: str) -> dict:
    """Write a raw model (e.g. the test-data adapter) as the raw layer; counts
    via Observation on each write."""
    def job(name, df):
        def run():
            obs = Observation(name)
            df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite") \
              .parquet(f"{out_root.rstrip('/')}/{name}")
            return obs.get["rows"]
        return run
    return write_tables({name: job(name, df) for name, df in raw.items()})


def read_raw_layer(spark: SparkSession, root: str) -> dict:
    """SRC3: the written raw layer as lazy DataFrames."""
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in RAW}
