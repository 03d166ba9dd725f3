"""Packing by concatenate and cut, with prefix sums in two passes.

Documents are range-partitioned and sorted by id (rows with one id: by a hash
of the text), tokenized and followed by an end id. Pass one writes the ids with
each document's start inside its partition, and sums the partitions. The
partition totals, one number each, give every partition its global offset. Pass
two cuts at multiples of the window: a document that crosses a boundary leaves a
piece on either side, also when it continues into the next partition's window.
All sequences but the last are full.

No group is collected: a piece depends on its own document and two numbers.
NULL and empty texts hold the end id alone; a NULL id sorts first; an empty
table gives no pieces.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_slices
from .tokens import default_tokenizer, encoder


def in_id_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text), range-partitioned and sorted by id. Rows that share an id are
    spread by a hash of their text, so a hot id meets no single task."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    d = d.withColumn("tie", F.xxhash64("text"))
    return d.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").drop("tie")


def token_rows(docs: DataFrame, id_col: str, text_col: str, path: str, end_id: int) -> DataFrame:
    """Pass one: (part, id, start, n_tokens, ids); start counts the ids before the
    document in its partition, ids are unsigned 16- or 32-bit by vocabulary."""
    def run(batches):
        enc, part, start = encoder(path), TaskContext.get().partitionId(), 0
        width = "<u2" if max(enc.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        for whole in batches:
            for b in row_slices(whole, "text"):
                ids, ends = enc.encode(b.column("text"))
                ids = ids.astype(width)
                begins = np.concatenate([[0], ends[:-1]])
                tail = np.array([end_id], width).tobytes()
                n = ends - begins + 1
                starts = start + np.cumsum(n) - n
                start += int(n.sum())
                raw = [ids[x:y].tobytes() + tail for x, y in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, np.int64)), b.column("id"), pa.array(starts), pa.array(n),
                     pa.array(raw, pa.binary())], names=["part", "id", "start", "n_tokens", "ids"])
    return in_id_order(docs, id_col, text_col).mapInArrow(
        run, "part long, id long, start long, n_tokens long, ids binary")


def pack(docs: DataFrame, id_col="doc_id", text_col="text", tokenizer: str | None = None,
         end_id: int = 0, window: int = 1024) -> DataFrame:
    """One row per piece: doc_id, start (ids of its document before it), length,
    doc_tokens, sequence_id, offset, ids (little-endian unsigned 32-bit)."""
    path = tokenizer or default_tokenizer()
    rows = materialize(token_rows(docs, id_col, text_col, path, end_id), "packing")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()    # one number per partition
    base, total = {}, 0
    for r in sorted(totals, key=lambda r: r["part"]):
        base[r["part"]] = total
        total += r["n"]

    def cut(batches):
        for whole in batches:
            for b in row_slices(whole, "ids", 2 << 20):
                out = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
                for part, doc, start, n, raw in zip(*(b.column(i).to_pylist() for i in range(5))):
                    ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                    at = base[part] + start
                    edges = [at, *range((at // window + 1) * window, at + n, window), at + n]
                    for x, y in zip(edges[:-1], edges[1:]):
                        out["doc_id"].append(doc)
                        out["start"].append(x - at)
                        out["length"].append(y - x)
                        out["doc_tokens"].append(n)
                        out["sequence_id"].append(x // window)
                        out["offset"].append(x % window)
                        out["ids"].append(ids[x - at:y - at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in out.items()], names=list(out))

    return rows.select("part", "id", "start", "n_tokens", "ids").mapInArrow(
        cut, "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """The packed sequences: (sequence_id, n_tokens, ids), the last one padded to
    the window unless its length is a power of two. A group holds at most
    ``window`` ids."""
    g = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    pad = F.lit(int(pad_id).to_bytes(4, "little"))
    two = F.bit_count(F.col("n_tokens")) == 1
    missing = F.when(two, F.lit(0)).otherwise(F.lit(window) - F.col("n_tokens")).cast("int")
    filler = F.unhex(F.repeat(F.hex(pad), missing))
    return g.select("sequence_id", "n_tokens", F.concat(joined, filler).alias("ids"))
