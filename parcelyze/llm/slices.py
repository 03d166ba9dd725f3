"""Whole documents dealt into slices of bounded size, and numbers from other slices sent back to them.

Several operators need to know something of all documents for every word or
window of one: whether a window stands earlier elsewhere, how often a word is
used in all. They work in the same way:
  1. documents are dealt into slices of about ``slice_bytes`` by a hash of id and text;
  2. a task reduces a slice to its distinct items, one row (or one entry of a packed
     row) for each, so that an item in every document is one row a slice;
  3. Spark groups these by item and decides;
  4. what was decided goes back by slice number and meets the same documents again.
The texts are exchanged once: both passes read the same exchange.

Rows with one id and one text are in one slice.
"""

from __future__ import annotations

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns


def deal(docs: DataFrame, id_col: str, text_col: str, slice_bytes: int, **others: str):
    """(dealt, bytes): rows (slice, id, tie, text, ...) with ``tie`` a hash of the text
    and ``others`` (name=column) as strings, and the bytes of all texts (one job). There
    are never more slices than the square root of a 400th of the bytes, so that a
    slice's share of a group stays large; a slice grows beyond ``slice_bytes`` from
    there on, with the square root of the input (100 TB: 200 MB)."""
    ident, text = columns([id_col, text_col])
    d = docs.select(ident.cast("long").alias("id"), text.cast("string").alias("text"),
                    *[c.cast("string").alias(k) for k, c in zip(others, columns(others.values()))])
    total = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = number_of(total, slice_bytes)
    return d.withColumn("tie", F.xxhash64("text")).withColumn(
        "slice", F.pmod(F.xxhash64("id", "tie"), F.lit(n)).cast("int")), total


def number_of(total: int, each: int) -> int:
    """How many parts of ``each`` bytes, but no more than the square root of total / 400."""
    return max(1, min(ceil(total / each), isqrt(total // 400)))


def in_order(table: pa.Table) -> pa.Table:
    """The rows of a slice by id (NULL last) and text."""
    return table.sort_by([("id", "ascending"), ("tie", "ascending")]).combine_chunks()


def text_bytes(column):
    """(data, offsets): the bytes of all texts and where each ends, from 0; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(texts)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    if off[-1] == off[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]], off - off[0]


def word_spans(data: np.ndarray, off: np.ndarray, space: np.ndarray):
    """(begin, end, first): the byte ranges of maximal runs of bytes that ``space``
    (by byte) does not hold, never over the end of a text, and per text the number
    of its first word (one more entry at the end)."""
    word = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, word[:-1]
    begin = np.flatnonzero(word & (edge[:-1] | ~before))
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, word[1:]
    end = np.flatnonzero(word & (edge[1:] | ~after)) + 1
    return begin, end, np.searchsorted(begin, off)


def planes(x: np.ndarray) -> bytes:
    """The bytes of an array of numbers, all first bytes first: equal ones pack well."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def from_planes(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)
