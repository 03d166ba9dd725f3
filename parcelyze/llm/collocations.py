"""Phrase collocations per language, counted in mergeable counting quotient filters.

Texts are lower-cased (A-Z), split at the punctuation ``[.,;:!?\\x0A-\\x0D]`` into
pieces and those at blanks and tabs into words. A phrase of 2 to ``longest`` words
that stands at least ``least`` times within pieces is a candidate.

  1. Documents are dealt into slices (see ``slices``); a slice's distinct words are
     summed over the corpus. Only words with ``least`` occurrences can be part of a
     candidate: they get dense numbers, which go back to the slices that hold them.
  2. The word numbers of an n-gram are packed into one number of 2w bits, which a
     four-round Feistel network permutes. The leading bits choose the shard, the
     next ones are the quotient, the rest is the remainder, kept in full: two n-grams
     never share an entry, and the permutation is undone to list them.
  3. A slice's filter of a shard holds, in sorted order, a bit per quotient (occupied),
     a bit per entry (end of a run), the remainders and one-byte counters with an
     exception list. Filters of a shard are merged as sorted lists; an n-gram that every
     document holds is one entry a slice.
  4. Candidates are cut, scored and ranked as Spark tables with decimal arithmetic.

A phrase cut after its first k words has l = f(first part), r = f(rest) and score
floor(1000000 * a * a / (l * r)); the lowest score counts (ties: smallest k).
Candidates inside a longer candidate with 100 * f(longer) >= ``absorb`` * a are dropped.

NULL texts are empty, a NULL language is ``und``. Exact while a count stays below
10**16 and ``longest`` word numbers have 126 bits at most (42 bits each for three).
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize
from .slices import deal, number_of, text_bytes, word_spans
from .tokens import Pieces, mix

#: Bytes that end a piece, and those that end a word.
_BREAK = np.zeros(256, bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _BREAK.copy()
_GAP[list(b" \t")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Parts that a language's candidates are ranked in first.
_PARTS = 32
_ROUNDS = tuple(np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89))


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


# Numbers of up to 128 bits are two arrays (high, low) of 64 bits each.

def _right(high, low, n: int):
    """The low 64 bits of the number shifted right by ``n``."""
    if n >= 64:
        return high >> _u(n - 64)
    return low if n == 0 else (low >> _u(n)) | (high << _u(64 - n))


def _left(x, n: int):
    """(high, low) of a 64-bit number shifted left by ``n``."""
    zero = np.zeros_like(x)
    if n == 0:
        return zero, x
    if n >= 64:
        return x << _u(n - 64), zero
    return x >> _u(64 - n), x << _u(n)


def _joined(left, right, w: int):
    """Halves of ``w`` bits as (high, low)."""
    high, low = _left(left, w)
    return high, low | right


def _halves(high, low, w: int):
    return _right(high, low, w) & _mask(w), low & _mask(w)


def pack(ids: np.ndarray, bits: int):
    """(high, low) of rows of numbers below 2 ** bits, the first one leading."""
    high, low = np.zeros(len(ids), np.uint64), np.zeros(len(ids), np.uint64)
    n = ids.shape[1]
    for j in range(n):
        h, x = _left(ids[:, j].astype(np.uint64), bits * (n - 1 - j))
        high, low = high | h, low | x
    return high, low


def unpack(high, low, bits: int, n: int) -> np.ndarray:
    return np.stack([_right(high, low, bits * (n - 1 - j)) & _mask(bits) for j in range(n)], axis=1).astype(np.int64)


def permute(high, low, w: int):
    """An invertible scrambling of numbers of 2w bits."""
    a, b = _halves(high, low, w)
    for k in _ROUNDS:
        a, b = b, a ^ (mix(b + k) & _mask(w))
    return _joined(a, b, w)


def restore(high, low, w: int):
    a, b = _halves(high, low, w)
    for k in reversed(_ROUNDS):
        a, b = b ^ (mix(a + k) & _mask(w)), a
    return _joined(a, b, w)


def summed(high, low, count):
    """Sorted distinct numbers with their counts added."""
    if len(low) == 0:
        return high, low, count
    order = np.lexsort((low, high)) if high.any() else np.argsort(low, kind="stable")
    high, low, count = high[order], low[order], count[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    at = np.flatnonzero(new)
    return high[at], low[at], np.add.reduceat(count, at)


_HEAD = struct.Struct("<QBBBQI")


def encode(high, low, count, bits: int, shard_bits: int) -> bytes:
    """A counting quotient filter of sorted distinct numbers of ``bits`` bits with the
    same ``shard_bits`` leading ones. The remainder takes whole bytes and there are
    no more quotients than entries."""
    n, free = len(low), bits - shard_bits
    r = min(free, -(-max(0, free - max(0, n.bit_length() - 1)) // 8) * 8)
    q = free - r
    quotient = _right(high, low, r) & _mask(q) if q else np.zeros(n, np.uint64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient.astype(np.int64)] = True
    last = np.ones(n, bool)
    last[:-1] = quotient[1:] != quotient[:-1]
    width = -(-r // 8)
    rest = np.stack([low, high], axis=1).astype("<u8").view(np.uint8).reshape(n, 16)[:, :width]
    large = np.flatnonzero(count >= 255)
    shard = int(_right(high[:1], low[:1], free)[0]) if shard_bits and n else 0
    return b"".join([_HEAD.pack(n, q, r, shard_bits, shard, len(large)), np.packbits(occupied).tobytes(),
                     np.packbits(last).tobytes(), rest.T.tobytes(), np.minimum(count, 255).astype(np.uint8).tobytes(),
                     large.astype("<u4").tobytes(), count[large].astype("<u8").tobytes()])


def entries(raw: bytes):
    """(high, low, count) of a filter, sorted."""
    n, q, r, shard_bits, shard, k = _HEAD.unpack_from(raw)
    at, width = _HEAD.size, -(-r // 8)

    def take(size):
        nonlocal at
        at += size
        return np.frombuffer(raw, np.uint8, size, at - size)
    occupied = np.flatnonzero(np.unpackbits(take(-(-(1 << q) // 8)), count=1 << q))
    last = np.unpackbits(take(-(-n // 8)), count=n)
    run = np.cumsum(last) - last                            # which run an entry is in
    full = np.zeros((n, 16), np.uint8)
    full[:, :width] = take(n * width).reshape(width, n).T
    low, high = full.view("<u8").T.astype(np.uint64)
    if r < 64:
        low, high = low & _mask(r), np.zeros_like(high)
    else:
        high = high & _mask(r - 64)
    count = take(n).astype(np.int64)
    where = take(4 * k).view("<u4")
    count[where] = take(8 * k).view("<u8")
    for x, shift in ((occupied.astype(np.uint64)[run], r), (np.full(n, shard, np.uint64), q + r)):
        h, x = _left(x, shift) if shift < 128 else (0, 0)
        high, low = high | h, low | x
    return high, low, count


def merge(filters: list, bits: int) -> bytes:
    """One filter of all the entries of filters of one shard."""
    parts = [entries(f) for f in filters]
    shard_bits = _HEAD.unpack_from(filters[0])[3]
    return encode(*summed(*(np.concatenate(x) for x in zip(*parts))), bits, shard_bits)


class Words:
    """The distinct (language, word) pairs of a slice and its words in order."""

    def __init__(self, table: pa.Table):
        lang = pc.fill_null(table.column("lang"), "und").combine_chunks()
        lang = lang.dictionary_encode() if isinstance(lang, pa.Array) else lang.chunk(0).dictionary_encode()
        names, code = lang.dictionary.to_pylist(), lang.indices.to_numpy()
        data, off = text_bytes(table.column("text"))
        data = _LOWER[data]
        begin, end, first = word_spans(data, off, _GAP)
        known = Pieces()
        number = known.number(data, begin, end)
        pair = np.repeat(code, np.diff(first)).astype(np.int64) * max(1, len(known)) + number
        key, self.word, self.count = np.unique(pair, return_inverse=True, return_counts=True)
        self.pairs = [(names[k // max(1, len(known))], known[k % max(1, len(known))].decode()) for k in key.tolist()]
        piece = np.searchsorted(np.flatnonzero(_BREAK[data]), begin)
        doc = np.repeat(np.arange(len(code)), np.diff(first))
        self.goes_on = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])     # the next word is in the same piece

    def grams(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Rows of ``n`` word numbers (0: none) that stand side by side in a piece."""
        seq = ids[self.word]
        m = max(0, len(seq) - n + 1)
        ok = np.ones(m, bool)
        for j in range(n):
            ok &= seq[j:j + m] > 0
            if j + 1 < n:
                ok &= self.goes_on[j:j + m]
        at = np.flatnonzero(ok)
        return np.stack([seq[at + j] for j in range(n)], axis=1)


def half_bits(longest_id: int, n: int):
    """(bits of a word number, w): n numbers fit in 2w bits."""
    bits = max(1, int(longest_id).bit_length())
    if n * bits > 126:
        raise ValueError(f"{n} word numbers of {bits} bits do not fit in 126 bits")
    return bits, max(1, -(-n * bits // 2))


def vocabulary(in_slices: DataFrame, least: int):
    """(lang, word, f, id): words with at least ``least`` occurrences, numbered from 1
    without gaps: by place in a written partition plus the partitions before it (one
    number a partition on the driver). Also the largest number."""
    f = in_slices.groupBy("lang", "word").agg(F.sum("n").alias("f")).filter(F.col("f") >= least)

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(b), part, np.int32)), pa.array(np.arange(at, at + len(b)))],
                names=["lang", "word", "f", "part", "place"])
            at += len(b)
    rows = materialize(f.mapInArrow(number, "lang string, word string, f long, part int, place long"), "collocation-words")
    sizes = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count("*").alias("n")).collect())
    base, total = [], 0
    for part, n in sizes:
        base.append((part, total + 1))
        total += n
    before = rows.sparkSession.createDataFrame(base, "part int, base long")
    return rows.join(before, "part").select("lang", "word", "f", (F.col("base") + F.col("place")).alias("id")), total


def ngrams(docs: DataFrame, id_col: str, text_col: str, lang_col: str, least: int, longest: int, slice_bytes: int,
           shard_bytes: int):
    """(words, totals, grams): words (lang, word, f, id) and grams (ids, a) with at least
    ``least`` occurrences, and (lang, n) with all word occurrences."""
    dealt, total = deal(docs, id_col, text_col, slice_bytes, lang=lang_col)

    def count(key, table):
        w = Words(table)
        return pa.table([pa.array([key[0].as_py()] * len(w.pairs), pa.int32()), pa.array([p[0] for p in w.pairs], pa.string()),
                         pa.array([p[1] for p in w.pairs], pa.string()), pa.array(w.count, pa.int64())],
                        names=["slice", "lang", "word", "n"])
    in_slices = materialize(dealt.groupBy("slice").applyInArrow(
        count, "slice int, lang string, word string, n long"), "collocation-slices")
    totals = in_slices.groupBy("lang").agg(F.sum("n").alias("n"))
    words, largest = vocabulary(in_slices, least)
    words = materialize(words, "collocation-vocabulary")
    shard_bits = (number_of(total, shard_bytes) - 1).bit_length()
    shapes = {n: half_bits(largest, n) for n in range(2, longest + 1)}

    def filters(table, known):
        w = Words(table)
        number = dict(zip(zip(known.column("lang").to_pylist(), known.column("word").to_pylist()), known.column("id").to_pylist()))
        ids = np.array([number.get(p, 0) for p in w.pairs], np.int64)
        out = []
        for n, (bits, half) in shapes.items():
            s = min(shard_bits, 2 * half)
            grams = w.grams(ids, n)
            high, low, c = summed(*permute(*pack(grams, bits), half), np.ones(len(grams), np.int64))
            shard = _right(high, low, 2 * half - s).astype(np.int64) if s else np.zeros(len(low), np.int64)
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else [0]
            out += [(n, int(shard[a]), encode(high[a:b], low[a:b], c[a:b], 2 * half, s)) for a, b in zip(edges[:-1], edges[1:])]
        return pa.table([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))],
                        names=["size", "shard", "filter"])

    def frequent(key, table):
        n = key[0].as_py()
        bits, half = shapes[n]
        high, low, c = entries(merge(table.column("filter").to_pylist(), 2 * half))
        keep = c >= least
        ids = unpack(*restore(high[keep], low[keep], half), bits, n)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, n), pa.int32()), pa.array(ids.ravel(), pa.int64()))
        return pa.table([flat, pa.array(c[keep], pa.int64())], names=["ids", "a"])

    back = in_slices.select("slice", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    shards = dealt.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(filters, "size int, shard long, filter binary")
    grams = shards.groupBy("size", "shard").applyInArrow(frequent, "ids array<bigint>, a long")
    return words, totals, materialize(grams, "collocation-grams")


def score(words: DataFrame, grams: DataFrame) -> DataFrame:
    """(ids, a, l, r, score) of every candidate by its lowest-scoring cut."""
    parts = grams.select("ids", F.col("a").alias("f")).unionByName(words.select(F.array("id").alias("ids"), "f"))
    cuts = grams.select("ids", "a", F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = cuts.select("ids", "a", "k", F.slice("ids", F.lit(1), F.col("k")).alias("x"),
                       F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("y"))
    cuts = cuts.join(parts.select(F.col("ids").alias("x"), F.col("f").alias("l")), "x")
    cuts = cuts.join(parts.select(F.col("ids").alias("y"), F.col("f").alias("r")), "y")
    exact = F.expr("CAST((CAST(1000000 AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(38, 0)) * CAST(a AS DECIMAL(38, 0))) "
                   "div (CAST(l AS DECIMAL(38, 0)) * CAST(r AS DECIMAL(38, 0))) AS BIGINT)")
    best = cuts.groupBy("ids", "a").agg(F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("b"))
    return best.select("ids", "a", "b.l", "b.r", "b.score")


def outermost(grams: DataFrame, absorb: int) -> DataFrame:
    """The candidates (ids) that no longer candidate absorbs."""
    size = F.size("ids")
    inner = grams.filter(size > 2).select("ids", "a", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("ids", "a", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("i"))
    inner = inner.groupBy(F.slice("ids", F.col("i"), F.col("m")).alias("ids")).agg(F.max("a").alias("longer"))
    swallowed = F.coalesce(F.lit(100) * F.col("longer") >= F.lit(absorb) * F.col("a"), F.lit(False))
    return grams.join(inner, "ids", "left").filter(~swallowed).select("ids")


def collocations(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", least: int = 10, longest: int = 3,
                 absorb: int = 50, top: int = 2000, slice_bytes: int = 8 << 20, shard_bytes: int = 24 << 20) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``top`` candidates by
    score and a, descending, and phrase (UTF-8 bytes). Runs several jobs."""
    words, totals, grams = ngrams(docs, id_col, text_col, lang_col, least, longest, slice_bytes, shard_bytes)
    found = score(words, grams).join(outermost(grams, absorb), "ids")
    spelled = grams.select("ids", F.posexplode("ids").alias("pos", "id")).join(words.select("id", "lang", "word"), "id")
    spelled = spelled.groupBy("ids").agg(F.min("lang").alias("lang"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    out = found.join(spelled, "ids").join(totals, "lang")
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # the first of every part first, so that a language's last step holds no more than _PARTS * top rows
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))).orderBy(*best)
    out = out.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    w = Window.partitionBy("lang").orderBy(*best)
    return out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
