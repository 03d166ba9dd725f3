"""Helpers shared by the operators: table access, stable splits, Arrow columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

__all__ = ["table", "materialize", "fold", "text_of", "large_strings", "row_slices", "free_name", "columns"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(taken, base: str) -> str:
    """``base`` with as many underscores before it as keep it apart from ``taken``
    (names differ by more than case)."""
    low = {c.lower() for c in taken}
    while base.lower() in low:
        base = "_" + base
    return base


def columns(names) -> list:
    """The columns of these names, whatever characters they hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in names]


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod`` (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def text_of(df: DataFrame, text_col: str) -> Column:
    """The text with NULL read as the empty string."""
    return F.coalesce(df[text_col].cast("string"), F.lit(""))


def large_strings(batch: pa.RecordBatch, name: str) -> list:
    """One column of an Arrow batch as Python strings, NULL as ''."""
    return [x if x is not None else "" for x in batch.column(name).to_pylist()]


def row_slices(batch: pa.RecordBatch, name: str, max_bytes: int = 1 << 20):
    """Cut an Arrow batch into row ranges whose ``name`` column holds about
    ``max_bytes`` bytes (one row may exceed it), so that the working memory of
    a task follows the longest text and not the batch size.

    Workers outlive their tasks, and Arrow keeps the memory of the batches before
    for later ones: it is given back here, once a batch."""
    import numpy as np
    col = batch.column(name)
    n = len(col)
    if n == 0:
        return
    import pyarrow.compute as pc
    pa.default_memory_pool().release_unused()
    lens = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lens) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), n]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)
