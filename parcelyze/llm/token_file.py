"""Token ids in patched frame-of-reference blocks.

A file holds one stream of ids in blocks of ``BLOCK`` values. A block stores its
minimum, the differences to it packed at the width that a chosen percentile of
them needs, and the wider ones whole in an exception list of (place, difference).
After the blocks comes the index: where each block starts, and the id and token
count of each document, so that a reader can seek to any document.

    magic "PFRB1\\n"
    block   u16 values, u8 width, u16 exceptions, u32 minimum, packed words
            (groups of 64 values, ``width`` u64 words each), exceptions as
            u16 places and u32 differences
    index   u64 starts of the blocks, i64 document ids, u64 token counts,
            u8 null flags of the ids
    tail    u64 blocks, u64 documents, u64 tokens, u64 start of the index, magic

All numbers are little-endian.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import row_slices
from .packing import in_id_order
from .tokens import default_tokenizer, encoder

MAGIC = b"PFRB1\n"
BLOCK = 1024
_HEAD = struct.Struct("<HBHI")
_TAIL = struct.Struct("<QQQQ")


def _pack_lanes(values: np.ndarray, width: int) -> np.ndarray:
    """values: (groups, 64) unsigned; (groups, width) words of 64 bits."""
    out = np.zeros((width, len(values)), np.uint64)
    lanes = np.ascontiguousarray(values.T.astype(np.uint64))
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack_lanes(words: np.ndarray, width: int) -> np.ndarray:
    out = np.empty((64, len(words)), np.uint64)
    cols = np.ascontiguousarray(words.T)
    mask = np.uint64((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        v = cols[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | (cols[word + 1] << np.uint64(64 - shift))
        out[i] = v & mask
    return np.ascontiguousarray(out.T)


def encode_blocks(ids: np.ndarray, percentile: float = 0.9) -> list:
    """The blocks of a stream, as bytes; the last may be short."""
    blocks = []
    for a in range(0, len(ids), BLOCK * 256):
        chunk = ids[a:a + BLOCK * 256].astype(np.int64)
        n = len(chunk)
        rows = -(-n // BLOCK)
        full = np.concatenate([chunk, np.full(rows * BLOCK - n, chunk[-1])]).reshape(rows, BLOCK)
        count = np.full(rows, BLOCK)
        count[-1] = n - (rows - 1) * BLOCK
        low = full.min(axis=1)
        diff = full - low[:, None]
        at = np.sort(diff, axis=1)[:, int(percentile * (BLOCK - 1))]
        width = np.ceil(np.log2(at + 1.0)).astype(np.int64)
        over = diff >= (np.int64(1) << width)[:, None]
        body = np.where(over, 0, diff)
        packed = [b""] * rows
        for w in np.unique(width[width > 0]):
            of = np.flatnonzero(width == w)
            words = _pack_lanes(body[of].reshape(-1, 64), int(w)).reshape(len(of), -1)
            for i, x in zip(of.tolist(), words):
                packed[i] = x.astype("<u8").tobytes()
        for i in range(rows):
            place = np.flatnonzero(over[i])
            blocks.append(_HEAD.pack(count[i], width[i], len(place), low[i]) + packed[i]
                          + place.astype("<u2").tobytes() + diff[i, place].astype("<u4").tobytes())
    return blocks


def decode_blocks(raw: bytes, starts: list) -> np.ndarray:
    """The ids of the blocks that begin at ``starts`` in ``raw``."""
    heads = [_HEAD.unpack_from(raw, s) for s in starts]
    out = np.empty((len(starts), BLOCK), np.uint32)
    width = np.array([h[1] for h in heads], np.int64)
    out[width == 0] = 0
    for w in np.unique(width[width > 0]).tolist():
        of = np.flatnonzero(width == w)
        size = BLOCK // 64 * w
        words = np.array([np.frombuffer(raw, "<u8", size, starts[i] + _HEAD.size) for i in of]).reshape(-1, w)
        out[of] = _unpack_lanes(words, w).reshape(len(of), BLOCK)
    for i, (s, (_, w, n, low)) in enumerate(zip(starts, heads)):
        if n:
            p = s + _HEAD.size + BLOCK // 8 * w
            out[i, np.frombuffer(raw, "<u2", n, p)] = np.frombuffer(raw, "<u4", n, p + 2 * n)
        out[i] += np.uint32(low)
    if heads and heads[-1][0] < BLOCK:
        return out.reshape(-1)[:(len(starts) - 1) * BLOCK + heads[-1][0]]
    return out.reshape(-1)


class Writer:
    """Streams ids into one file; ids of a document may come in several parts."""

    def __init__(self, out, percentile: float = 0.9):
        self.out, self.percentile, self.at = out, percentile, len(MAGIC)
        self.starts, self.docs, self.counts, self.nulls, self.rest = [], [], [], [], np.empty(0, np.uint32)
        out.write(MAGIC)

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray):
        self.docs += [0 if d is None else d for d in doc_ids]
        self.nulls += [d is None for d in doc_ids]
        self.counts += counts.tolist()
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._blocks(ids[:whole])
        self.rest = ids[whole:]

    def _blocks(self, ids):
        for b in encode_blocks(ids, self.percentile):
            self.starts.append(self.at)
            self.out.write(b)
            self.at += len(b)

    def close(self) -> dict:
        self._blocks(self.rest)
        tokens = int(sum(self.counts))
        self.out.write(np.array(self.starts, "<u8").tobytes() + np.array(self.docs, "<i8").tobytes()
                       + np.array(self.counts, "<u8").tobytes() + np.array(self.nulls, "u1").tobytes()
                       + _TAIL.pack(len(self.starts), len(self.docs), tokens, self.at) + MAGIC)
        self.out.close()
        return {"docs": len(self.docs), "tokens": tokens, "blocks": len(self.starts)}


class Reader:
    """Random access to one file."""

    def __init__(self, source):
        self.source = source
        size, foot = source.size(), _TAIL.size + len(MAGIC)
        tail = source.read_at(foot, size - foot)
        if tail[-len(MAGIC):] != MAGIC:
            raise ValueError("not a token file, or an unfinished one")
        blocks, docs, self.tokens, at = _TAIL.unpack(tail[:_TAIL.size])
        index = source.read_at(size - foot - at, at)
        self.starts = np.append(np.frombuffer(index, "<u8", blocks), at).astype(np.int64)
        self.docs = np.frombuffer(index, "<i8", docs, 8 * blocks)
        self.counts = np.frombuffer(index, "<u8", docs, 8 * (blocks + docs)).astype(np.int64)
        self.nulls = np.frombuffer(index, "u1", docs, 8 * (blocks + 2 * docs)).astype(bool)
        self.ends = np.cumsum(self.counts)

    def ids(self, a: int, b: int) -> np.ndarray:
        """The ids a to b of the stream; reads the blocks that hold them."""
        if b <= a:
            return np.empty(0, np.uint32)
        x, y = a // BLOCK, -(-b // BLOCK)
        raw = self.source.read_at(int(self.starts[y] - self.starts[x]), int(self.starts[x]))
        return decode_blocks(raw, (self.starts[x:y] - self.starts[x]).tolist())[a - x * BLOCK:b - x * BLOCK]


def write(docs: DataFrame, folder: str, id_col="doc_id", text_col="text", tokenizer: str | None = None,
          end_id: int = 2, percentile: float = 0.9, file_tokens: int = 4 << 20) -> list:
    """Tokenize every text whole (NULL: empty), append ``end_id`` and write the ids
    in ascending id order (NULL ids first) into files of about ``file_tokens``
    ids. Runs one job; returns the manifest."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        fs, root = files.resolve(folder)
        enc, part, w, done, name = encoder(path), TaskContext.get().partitionId(), None, [], ""

        def shut():
            done.append((part, len(done), name, *w.close().values()))
        for whole in batches:
            for b in row_slices(whole, "text", 4 << 20):
                ids, ends = enc.encode(b.column("text"))
                ids = np.insert(ids, ends, end_id)
                counts = np.diff(np.concatenate([[0], ends])) + 1
                if w is None:
                    name = files.temporary_name(".pfrb")
                    w = Writer(fs.open_output_stream(f"{root}/{name}"), percentile)
                w.add(b.column("id").to_pylist(), counts, ids)
                if len(w.starts) * BLOCK >= file_tokens:
                    shut()
                    w = None
        if w is not None:
            shut()
        cols = list(zip(*done)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)],
                                         names=["part", "seq", "temporary", "docs", "tokens", "blocks"])

    rows = in_id_order(docs, id_col, text_col).mapInArrow(
        run, "part long, seq long, temporary string, docs long, tokens long, blocks long").collect()   # one row per file
    entries, start = [], 0
    for r in sorted(rows, key=lambda r: (r["part"], r["seq"])):
        entries.append({**r.asDict(), "name": f"part-{r['part']:06d}-{r['seq']:04d}.pfrb", "start": start})
        start += r["tokens"]
    return files.commit(folder, entries)


def read(spark, folder: str, step_tokens: int = 1 << 20) -> DataFrame:
    """One row per document from the files alone: doc_id, start (ids of all
    documents before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    listed = [(e["name"], e["start"]) for e in files.manifest(folder)]
    schema = "doc_id long, start long, n_tokens long, ids binary"
    if not listed:
        return spark.createDataFrame([], schema)

    def run(batches):
        fs, root = files.resolve(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as f:
                    r, d = Reader(f), 0
                    while d < len(r.docs):
                        at = int(r.ends[d] - r.counts[d])
                        e = max(d + 1, int(np.searchsorted(r.ends, at + step_tokens, side="right")))
                        ids = r.ids(at, int(r.ends[e - 1])).astype("<u4")
                        stop = r.ends[d:e] - at
                        begin = stop - r.counts[d:e]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(r.docs[d:e].copy(), pa.int64(), mask=r.nulls[d:e]),
                             pa.array(base + at + begin), pa.array(r.counts[d:e]),
                             pa.array([ids[x:y].tobytes() for x, y in zip(begin, stop)], pa.binary())],
                            names=["doc_id", "start", "n_tokens", "ids"])
                        d = e

    files_df = spark.createDataFrame(listed, "name string, start long").repartition(len(listed))
    return files_df.mapInArrow(run, schema)
