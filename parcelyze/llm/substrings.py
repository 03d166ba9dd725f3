"""Substring dedup: Rabin-Karp hashes of every window of ``words`` words, counted in Spark.

A window is ``words`` consecutive words of one document. A word is removed if a
window that covers it stands earlier too: in a document before this one (smaller
id) or earlier in this one. Windows are judged on the input.

Words are hashed with a key drawn per run, and windows with polynomials of the
word hashes modulo 2**31 - 1 whose bases are drawn per run: H(2m) at i is
H(m)[i] * base**m + H(m)[i + m], so a window costs a few multiplications whatever
its length. Two lanes make the 62 bits that are compared; a third one deals windows into buckets.

  1. Documents are dealt into slices (see ``slices``). Of equal windows of a slice only
     the first is sent on: a window in every document is one entry a slice.
     Entries travel as packed rows, one per slice and bucket: hashes, places, documents.
  2. A bucket puts equal windows together. All but the first in document order are
     repeats; one bit an entry goes back to the slice.
  3. The slice, cut into the same windows again, merges repeated windows into maximal
     intervals of removed words and joins the words that are left by single blanks.

Documents are ordered by id (NULL last); those of one id by their slice and in it by
a hash of the text, so rows equal in both are repeats of one another. NULL and empty texts have no word; a text with
fewer than ``words`` words has no window and stays whole. Any two of n different
windows share all hashes with a probability of about n * n / 2**63 / buckets.
"""

from __future__ import annotations

import secrets

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import deal, from_planes, in_order, number_of, planes, text_bytes, word_spans
from .tokens import span_hashes

PRIME = (1 << 31) - 1
#: ASCII white space; every other byte belongs to a word.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _mod(x: np.ndarray) -> np.ndarray:
    """x modulo 2**31 - 1, for x below 2**63."""
    for _ in range(2):
        x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def rolling(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """The Rabin-Karp hash of every ``length`` consecutive values: the sum of
    value[i + j] * base ** (length - 1 - j) modulo 2**31 - 1."""
    one = _mod(values)
    h, size = one, 1
    for bit in bin(length)[3:]:
        m = max(0, len(h) - size)
        h = _mod(h[:m] * np.uint64(pow(base, size, PRIME)) + h[size:size + m])
        size *= 2
        if bit == "1":
            m = max(0, len(h) - 1)
            h = _mod(h[:m] * np.uint64(base) + one[size:size + m])
            size += 1
    return h


class Windows:
    """The windows of a slice in document order."""

    def __init__(self, table: pa.Table, words: int, bases: tuple, buckets: int):
        self.rows = in_order(table)
        self.data, off = text_bytes(self.rows.column("text"))
        self.begin, self.end, self.first = word_spans(self.data, off, _SPACE)
        self.words = words
        key, one, two, deal_by = bases
        value = span_hashes(self.data, self.begin, self.end, key)
        low, high = value & np.uint64(0xFFFFFFFF), value >> np.uint64(32)
        # places where a window begins: all but the last words of a text
        count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(count)), np.maximum(0, count - words + 1))
        base_at = np.cumsum(np.maximum(0, count - words + 1)) - np.maximum(0, count - words + 1)
        self.pos = np.arange(len(self.doc)) - base_at[self.doc]
        self.at = self.first[self.doc] + self.pos
        third = rolling(low + high, words, deal_by)[self.at]
        self.hash = (rolling(low, words, one)[self.at] << np.uint64(31)) | rolling(high, words, two)[self.at]
        self.bucket = (third % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(self.hash, kind="stable")
        h, t = self.hash[order], third[order]
        same = np.zeros(len(order), bool)
        same[1:] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        self.repeat = np.zeros(len(order), bool)
        self.repeat[order[same]] = True                    # stands earlier in this slice
        sent = np.flatnonzero(~self.repeat)
        self.sent = sent[np.argsort(self.bucket[sent], kind="stable")]     # by bucket, in order

    def packed(self):
        """(bucket, documents, entries a document, places, hashes) of every bucket."""
        ids = self.rows.column("id").to_numpy()
        null = self.rows.column("id").is_null().to_numpy()
        ids = np.where(null, 0, ids).astype("<i8")
        bucket = self.bucket[self.sent]
        edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            k = self.sent[a:b]
            docs, n = np.unique(self.doc[k], return_counts=True)
            step = np.diff(self.pos[k], prepend=0).astype("<i8").astype("<u4")
            yield (int(bucket[a]), planes(ids[docs]), null[docs].tobytes(),
                   planes(n.astype("<u4")), planes(step), self.hash[k].astype("<u8").tobytes())


_PACKED = "slice int, bucket int, ids binary, nulls binary, counts binary, steps binary, hashes binary"


def repeats_of(bucket: pa.Table) -> list:
    """Per packed row of a bucket the bits of the entries that stand earlier elsewhere."""
    hashes, docs, places, ends = [], [], [], []
    ids, slices, nulls, at, total = [], [], [], 0, 0
    for r in bucket.to_pylist():
        n = from_planes(r["counts"], "<u4")
        h = np.frombuffer(r["hashes"], "<u8")
        hashes.append(h)
        docs.append(np.repeat(np.arange(at, at + len(n), dtype=np.int32), n))
        places.append(np.cumsum(from_planes(r["steps"], "<u4"), dtype=np.uint32))
        ids.append(from_planes(r["ids"], "<i8"))
        slices.append(np.full(len(n), r["slice"], np.int32))
        nulls.append(np.frombuffer(r["nulls"], bool))
        at, total = at + len(n), total + len(h)
        ends.append(total)
    h, doc, place = (np.concatenate(x) for x in (hashes, docs, places))
    ids, slices, nulls = (np.concatenate(x) for x in (ids, slices, nulls))
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    some = np.zeros(len(s), bool)
    some[1:] |= same
    some[:-1] |= same
    k = order[some]                                          # only hashes met twice are put in document order
    # documents of one id and slice are numbered in their order there
    k = k[np.lexsort((place[k], doc[k], slices[doc[k]], ids[doc[k]], nulls[doc[k]], h[k]))]
    later = np.zeros(len(h), bool)
    later[k[1:][h[k[1:]] == h[k[:-1]]]] = True
    return [np.packbits(later[a:b]).tobytes() for a, b in zip([0, *ends[:-1]], ends)]


def intervals(covered: np.ndarray, first: np.ndarray):
    """(text, begin, end) of the maximal runs of True within each text."""
    edge = np.zeros(len(covered) + 1, bool)
    edge[first] = True
    before = np.concatenate([[False], covered[:-1]])
    after = np.concatenate([covered[1:], [False]])
    begin = np.flatnonzero(covered & (edge[:-1] | ~before))
    end = np.flatnonzero(covered & (edge[1:] | ~after)) + 1
    text = np.searchsorted(first, begin, side="right") - 1
    return text, begin - first[text], end - first[text]


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 20,
                   slice_bytes: int = 8 << 20, bucket_bytes: int = 12 << 20) -> DataFrame:
    """One row per row of ``docs``: id, n_words, n_removed, removed (maximal intervals
    of word numbers from 0, end excluded) and kept (the words left, joined by single
    blanks). A task holds one slice of about ``slice_bytes`` of text, or one bucket of
    the windows of about ``bucket_bytes`` of text. One job sizes the slices."""
    dealt, total = deal(docs, id_col, text_col, slice_bytes)
    buckets = number_of(total, bucket_bytes)
    bases = (secrets.randbits(63), *(secrets.randbelow(PRIME - 1000) + 500 for _ in range(3)))
    names = [f.split()[0] for f in _PACKED.split(", ")]

    def pack(key, table):
        rows = [(key[0].as_py(), *r) for r in Windows(table, words, bases, buckets).packed()]
        types = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    def decide(table):
        return pa.table([table.column("slice"), table.column("bucket"), pa.array(repeats_of(table), pa.binary())],
                        names=["slice", "bucket", "bits"])

    def cut(table, bits):
        w = Windows(table, words, bases, buckets)
        repeat, at = w.repeat, 0
        size = dict(zip(*(x.tolist() for x in np.unique(w.bucket[w.sent], return_counts=True))))
        for r in sorted(bits.to_pylist(), key=lambda r: r["bucket"]):
            n = size[r["bucket"]]
            flags = np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=n).astype(bool)
            repeat[w.sent[at:at + n][flags]] = True
            at += n
        open_ = np.zeros(len(w.begin) + 1, np.int64)
        open_[w.at[repeat]] += 1
        np.subtract.at(open_, w.at[repeat] + words, 1)
        covered = np.cumsum(open_[:-1]) > 0
        text, a, b = intervals(covered, w.first)
        spans = [[] for _ in range(len(w.rows))]
        for t, x, y in zip(text.tolist(), a.tolist(), b.tolist()):
            spans[t].append({"begin": x, "end": y})
        raw = w.rows.column("text").cast(pa.binary()).to_pylist()
        kept = []
        for t, s in zip(raw, spans):
            left = (t or b"").split()                        # cuts at the same six bytes
            for x in reversed(s):
                del left[x["begin"]:x["end"]]
            kept.append(b" ".join(left))
        n = np.diff(w.first)
        gone = np.array([sum(x["end"] - x["begin"] for x in s) for s in spans], np.int64)
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table([w.rows.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                         pa.array(spans, span), pa.array(kept, pa.binary()).cast(pa.string())],
                        names=["id", "n_words", "n_removed", "removed", "kept"])

    bits = dealt.groupBy("slice").applyInArrow(pack, _PACKED).groupBy("bucket").applyInArrow(
        decide, "slice int, bucket int, bits binary")
    return dealt.groupBy("slice").cogroup(bits.groupBy("slice")).applyInArrow(
        cut, "id long, n_words long, n_removed long, removed array<struct<begin:long,end:long>>, kept string")
