"""Near-duplicate groups by MinHash with sequential Bayesian verification.

1. Every text becomes the set of its word shingles, a signature of ``hashes``
   MinHash values and a 128-bit digest of its words. Rows with equal digests are
   one class, represented by its smallest id; only classes are compared from here
   on.
2. A signature is cut into bands of ``rows`` values; classes that agree on a band
   share a bucket and are candidates.
3. First every class is compared with one pivot, the most popular class of its
   buckets (popular: the sizes of its buckets summed; the text that a family of
   copies was made from meets all of them). Links found merge classes into
   components, which settles most buckets.
4. In the buckets that still hold several components the pairs across components
   are compared, each in the first band its classes share. A bucket is cut into blocks
   of about ``BLOCK`` classes, a task takes two blocks, blocks of the bucket's largest
   component meet the others only, and a bucket of one component is not looked at. Of
   the likely links that a task finds it emits a spanning forest over the components,
   fewer rows than it has classes: if all of these hold, the others join what is joined
   already. Buckets where one fails are compared again after the merge, with 8, 64, ...
   forests, until no link that was left out rests on a pair that failed.
5. A pair's signatures are compared in batches. After n values with m agreeing the
   posterior probability (uniform prior) that the similarity reaches the threshold
   is P(Binomial(n + 1, t) <= m); a pair is pruned once it falls below ``miss``.
   Survivors are verified on the full sets of the words themselves. In step 4 a bound on their
   intersection, from sets of shortened hashes, comes in between; it never drops
   a link.

With 28 bands of 4 rows a pair at similarity 0.8 shares no bucket with
probability 4e-7; ``miss`` bounds what the pruning adds per batch. Words are hashed
with a key drawn per run (``key``) for signatures and bounds only.

Rows without a word, or with a NULL id, are linked with nothing. Rows that share
an id are one document.
"""

from __future__ import annotations

import hashlib
import secrets
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, row_slices
from .components import connected_components
from .shingles import mix, shingle_sets, text_words, word_shingles

_CHUNK = 1 << 16
#: Classes of a block of a large bucket.
BLOCK = 512
#: Shingles of a set whose shortened hashes have 32 bits.
LARGE = 2048


class Hashes:
    """A family of MinHash functions x -> a * x + b on 32 bits."""

    def __init__(self, n: int, seed: int = 20):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 1 << 31, n, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, n, dtype=np.uint32)

    def signatures(self, sets: list) -> np.ndarray:
        """One row per non-empty set."""
        out = np.empty((len(sets), len(self.a)), np.uint32)
        i = 0
        while i < len(sets):
            j, size = i, 0
            while j < len(sets) and (j == i or size + len(sets[j]) <= _CHUNK):
                size += len(sets[j])
                j += 1
            x = (np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32)
            at = np.cumsum([0, *map(len, sets[i:j - 1])])
            for k, (a, b) in enumerate(zip(self.a, self.b)):
                out[i:j, k] = np.minimum.reduceat(x * a + b, at)
            i = j
        return out


def least_matches(n: int, threshold: float, miss: float) -> int:
    """The fewest agreeing values of n that keep the posterior at ``miss`` or more."""
    total = 0.0
    for m in range(n + 1):
        total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        if total >= miss:
            return m
    return n


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int, hashes: int, key: int = 0) -> DataFrame:
    """(id, n_shingles, digest, signature); both NULL for a text without words."""
    def run(batches):
        family = Hashes(hashes)
        for whole in batches:
            for b in row_slices(whole, "text", 1 << 20):
                sets = shingle_sets(b.column("text"), words, key)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = dict(zip(full, family.signatures([sets[i] for i in full])))
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(b" ".join(text_words(t)), digest_size=16).digest() if len(s) else None
                               for t, s in zip(b.column("text").to_pylist(), sets)], pa.binary()),
                     pa.array([sig[i].tobytes() if i in sig else None for i in range(len(sets))], pa.binary())],
                    names=["id", "n_shingles", "digest", "signature"])
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "id long, n_shingles long, digest binary, signature binary")


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per signature and band."""
    bands = sig.reshape(len(sig), -1, rows)
    key = np.arange(bands.shape[1], dtype=np.uint64)[None, :] + np.zeros((len(sig), 1), np.uint64)
    for i in range(rows):
        key = mix(key + bands[:, :, i])
    return key


def buckets(classes: DataFrame, rows: int) -> DataFrame:
    """(key, rep): the buckets of every class that it shares with another one."""
    def run(batches):
        for b in batches:
            if not len(b):
                continue
            key = band_keys(np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(len(b), -1), rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1).view(np.int64)),
                 pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), key.shape[1]))], names=["key", "rep"])
    every = classes.select("rep", "signature").mapInArrow(run, "key long, rep long")
    shared = every.groupBy("key").agg(F.min("rep").alias("x"), F.max("rep").alias("y")).filter("x <> y").select("key")
    return every.join(shared, "key")


def surviving(pairs: DataFrame, classes: DataFrame, threshold: float, miss: float, batch: int, hashes: int) -> DataFrame:
    """The pairs (a, b) that no batch of signature values prunes."""
    steps = [(n, least_matches(n, threshold, miss)) for n in range(batch, hashes + 1, batch)]

    def run(batches):
        for b in batches:
            if not len(b):
                continue
            x, y = (np.frombuffer(b"".join(b.column(i).to_pylist()), np.uint32).reshape(len(b), -1) for i in (2, 3))
            alive, agree = np.arange(len(b)), np.zeros(len(b), np.int64)
            for n, least in steps:
                agree = agree + (x[alive, n - batch:n] == y[alive, n - batch:n]).sum(axis=1)
                keep = agree >= least
                alive, agree = alive[keep], agree[keep]
            yield b.take(pa.array(alive)).select(["a", "b"])
    s = classes.select(F.col("rep").alias("a"), F.col("signature").alias("sa"))
    t = classes.select(F.col("rep").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(s, "a").join(t, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    def run(batches):
        for whole in batches:
            for half in row_slices(whole, "ta", 1 << 20):
                for b in row_slices(half, "tb", 1 << 20):
                    ok = []
                    for i, (s, t) in enumerate(zip(b.column("ta").to_pylist(), b.column("tb").to_pylist())):
                        s, t = (word_shingles(text_words(v), words) for v in (s, t))
                        both = len(s & t)
                        if 100 * both >= percent * (len(s) + len(t) - both) > 0:
                            ok.append(i)
                    yield b.take(pa.array(ok, pa.int64())).select(["a", "b"])
    s = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta"))
    t = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb"))
    return pairs.join(s, "a").join(t, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def shortened(texts: DataFrame, words: int, key: int = 0) -> DataFrame:
    """(rep, n, compact): the set size and its distinct hashes cut to 16 bits, or to
    32 bits for a large set."""
    def run(batches):
        for whole in batches:
            for b in row_slices(whole, "text", 1 << 20):
                sets = shingle_sets(b.column("text"), words, key)
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep"), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([_cut(x).tobytes() for x in sets], pa.binary())], names=["rep", "n", "compact"])
    return texts.select("rep", "text").mapInArrow(run, "rep long, n long, compact binary")


def _cut(hashes: np.ndarray) -> np.ndarray:
    """Sorted distinct leading bits, 32 of them for a large set."""
    if len(hashes) <= LARGE:
        return np.unique((hashes >> np.uint64(48)).astype("<u2"))
    return np.unique((hashes >> np.uint64(32)).astype("<u4"))


def _compact_sets(raw: list, sizes: np.ndarray) -> list:
    """The sets of a group in one width."""
    large = [n > LARGE for n in sizes]
    out = [np.frombuffer(r, "<u4" if big else "<u2") for r, big in zip(raw, large)]
    if any(large) and not all(large):
        out = [np.unique(x >> 16).astype("<u2") if big else x for x, big in zip(out, large)]
    return out


def shared_bound(sets: list, sizes: np.ndarray, i: np.ndarray, j: np.ndarray, columns: int = 4096) -> np.ndarray:
    """At least the size of the intersection of pairs (i, j) of the full sets: the
    shared shortened hashes, and what shortening has merged within a set."""
    every = np.concatenate(sets)
    values, code, count = np.unique(every, return_inverse=True, return_counts=True)
    useful = np.cumsum(count > 1) - 1                       # a hash of one set is shared with none
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = count[code] > 1
    row, col = row[keep], useful[code[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros(len(i))
    n = int(col[-1]) + 1 if len(col) else 0
    for c in range(0, n, columns):
        x, y = np.searchsorted(col, [c, c + columns])
        has = np.zeros((len(sets), min(columns, n - c)), np.float32)
        has[row[x:y], col[x:y] - c] = 1
        total += (has @ has.T)[i, j]
    merged = sizes - np.array([len(x) for x in sets])
    return total + np.minimum(merged[i], merged[j])


def compare_block(key, left, right, rep, label, sig, raw, sizes, rows: int, steps: list, batch: int, percent: int):
    """The pairs of one bucket between its blocks left and right that may be links, the
    likeliest first: of different components, first met in this bucket, not pruned."""
    m = len(rep)
    i, j = np.triu_indices(m, 1) if left is None else (x.ravel() for x in np.meshgrid(left, right, indexing="ij"))
    ok = label[i] != label[j]
    i, j = i[ok], j[ok]
    if not len(i):
        return i, j
    keys = band_keys(sig, rows)
    band = int(np.flatnonzero(keys[0] == key)[0])
    for b in range(band):
        ok = keys[i, b] != keys[j, b]
        i, j = i[ok], j[ok]
    agree = np.zeros(len(i), np.int16)
    for n, least in steps:
        for k in range(n - batch, n):
            agree += sig[i, k] == sig[j, k]
        ok = agree >= least
        i, j, agree = i[ok], j[ok], agree[ok]
    if len(i):
        both = shared_bound(_compact_sets(raw, sizes), sizes, i, j)
        union = sizes[i] + sizes[j] - both
        ok = np.flatnonzero(100 * both >= percent * union)
        ok = ok[np.argsort(-both[ok] / np.maximum(union[ok], 1), kind="stable")]
        i, j = i[ok], j[ok]
    return i, j


def spanning(x: np.ndarray, y: np.ndarray, forests: int) -> np.ndarray:
    """Which of the links x - y the given number of spanning forests take: a link that
    closes a ring in one forest goes to the next, behind the last one it is left out."""
    trees: list = [{} for _ in range(forests)]

    def root(tree, v):
        while (up := tree.get(v, v)) != v:
            tree[v] = v = tree.get(up, up)
        return v
    kept = np.zeros(len(x), bool)
    for n, (a, b) in enumerate(zip(x.tolist(), y.tolist())):
        for tree in trees:
            s, t = root(tree, a), root(tree, b)
            if s != t:
                tree[s] = t
                kept[n] = True
                break
    return kept


def dealt_blocks(state: DataFrame, size: int | None = None) -> DataFrame:
    """(key, rep, label, block, x, y) of open buckets (key, rep, label): one row for every
    task (x, y), x <= y, that compares block x with block y and takes the class.

    A bucket of at most ``size`` classes is one block. Of a larger one the largest
    component is cut into the first ``main`` blocks and the others into ``rest`` more.
    Classes of one component are never compared, so the first blocks meet the others only:
    a class of the largest component goes to ``rest`` tasks, not to one for each block."""
    size = size or BLOCK
    counts = state.groupBy("key", "label").agg(F.count("*").alias("c"))
    cuts = counts.groupBy("key").agg(F.max(F.struct("c", "label")).alias("m"), F.sum("c").alias("all")).select(
        "key", F.col("m.label").alias("largest"), (F.col("all") <= size).alias("one"),
        F.ceil(F.col("m.c") / size).cast("int").alias("main"), F.ceil((F.col("all") - F.col("m.c")) / size).cast("int").alias("rest"))
    s = state.join(cuts, "key").withColumn("inner", F.col("label") == F.col("largest"))
    at = F.xxhash64("rep")
    s = s.withColumn("block", F.when(F.col("one"), 0).when(F.col("inner"), F.pmod(at, F.col("main"))).otherwise(
        F.col("main") + F.pmod(at, F.col("rest"))).cast("int"))
    start = F.when(F.col("inner"), F.col("main")).otherwise(0)
    s = s.withColumn("other", F.explode(F.when(F.col("one"), F.array(F.lit(0))).otherwise(
        F.sequence(start, F.col("main") + F.col("rest") - 1))))
    return s.select("key", "rep", "label", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))


def crossing(state: DataFrame, classes: DataFrame, texts: DataFrame, words, rows, threshold, percent, batch, miss,
             hashes, word_key=0, forests: int = 1) -> DataFrame:
    """(key, a, b, more): pairs across components of the open buckets (key, rep, label)
    that may be links, of each task those of some spanning forests over its components;
    more: the task left others out."""
    steps = [(n, least_matches(n, threshold, miss)) for n in range(batch, hashes + 1, batch)]
    s = dealt_blocks(state)
    members = state.select("rep").distinct()
    sets = shortened(texts.join(members, "rep", "left_semi"), words, word_key)
    wide = s.join(classes.select("rep", "signature"), "rep").join(sets, "rep")
    dealt = wide.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "rep")

    def groups(batches):
        now, held = None, []
        for whole in batches:
            for b in row_slices(whole, "compact", 4 << 20):
                for r in zip(*(b.column(c).to_pylist() for c in
                               ("key", "x", "y", "rep", "label", "block", "signature", "n", "compact"))):
                    if r[:3] != now:
                        if held:
                            yield now, held
                        now, held = r[:3], []
                    held.append(r[3:])
        if held:
            yield now, held

    def run(batches):
        for (key, x, y), got in groups(batches):
            rep, label, block, sig, n, raw = zip(*got)
            if min(label) == max(label):
                continue
            block = np.array(block)
            left, right = (None, None) if x == y else (np.flatnonzero(block == x), np.flatnonzero(block == y))
            rep = np.array(rep, np.int64)
            i, j = compare_block(np.int64(key).astype(np.uint64), left, right, rep, np.array(label, np.int64),
                                 np.frombuffer(b"".join(sig), np.uint32).reshape(len(rep), -1), list(raw),
                                 np.array(n, np.int64), rows, steps, batch, percent)
            if len(i):
                label = np.array(label, np.int64)
                kept = spanning(label[i], label[j], forests)
                i, j = i[kept], j[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(i), key, np.int64)), pa.array(np.minimum(rep[i], rep[j])),
                     pa.array(np.maximum(rep[i], rep[j])), pa.array(np.full(len(i), not kept.all()))],
                    names=["key", "a", "b", "more"])

    cols = ["key", "x", "y", "rep", "label", "block", "signature", "n", "compact"]
    return dealt.select(*cols).mapInArrow(run, "key long, a long, b long, more boolean")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 5, percent: int = 80,
                    hashes: int = 112, rows: int = 4, batch: int = 16, miss: float = 1e-9,
                    key: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, class_id (smallest id with the
    same words), component_id (smallest id reachable over links, itself included).
    Runs several jobs; intermediate tables go to the shared checkpoint folder."""
    threshold = percent / 100
    key = secrets.randbits(63) if key is None else key
    rows_ = materialize(sketch(docs, id_col, text_col, words, hashes, key), "minhash-sketch")
    linked = rows_.filter("digest IS NOT NULL AND id IS NOT NULL")
    classes = materialize(linked.groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("signature").alias("signature")), "minhash-classes")
    state = materialize(buckets(classes, rows), "minhash-buckets")
    source = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).cast("string").alias("text"))
    texts = materialize(source.join(state.select("rep").distinct(), "rep", "left_semi"), "minhash-texts")

    size = state.groupBy("key").agg(F.count("*").alias("size"))
    fame = state.join(size, "key").groupBy("rep").agg(F.sum("size").alias("fame"))
    pivot = state.join(fame, "rep").groupBy("key").agg(F.max_by("rep", "fame").alias("pivot"), F.max("fame").alias("fame"))
    first = state.join(pivot, "key").groupBy("rep").agg(F.max_by("pivot", "fame").alias("pivot")).filter("rep <> pivot")
    pairs = first.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
    left = surviving(pairs, classes, threshold, miss, batch, hashes)
    labels = connected_components(materialize(verified(left, texts, words, percent), "minhash-links"), "a", "b")

    forests = 1
    while True:
        state = _still_open(state, labels)
        pairs = materialize(crossing(state, classes, texts, words, rows, threshold, percent, batch, miss, hashes, key,
                                     forests), "minhash-crossing")
        found = materialize(verified(pairs.select("a", "b").distinct(), texts, words, percent), "minhash-links")
        labels = _merge(labels, found)
        # links left out may matter where one of those taken in their place has failed
        again = materialize(pairs.filter("more").join(found, ["a", "b"], "left_anti").select("key").distinct(), "minhash-again")
        if again.limit(1).count() == 0:
            break
        state, forests = state.join(again, "key"), forests * 8

    out = rows_.select("id", "n_shingles", "digest").join(
        classes.select("digest", F.col("rep").alias("class_id")), "digest", "left")
    out = out.join(labels.withColumnRenamed("node", "class_id"), "class_id", "left")
    known = F.col("id").isNotNull()
    return out.select("id", "n_shingles", F.when(known, F.coalesce("class_id", "id")).alias("class_id"),
                      F.when(known, F.coalesce("label", "class_id", "id")).alias("component_id"))


def _still_open(state: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, rep, label): the buckets that hold several components, with these labels."""
    state = state.select("key", "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("label", "rep").alias("label"))
    mixed = state.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    return materialize(state.join(mixed.select("key"), "key"), "minhash-open")


def _merge(labels: DataFrame, found: DataFrame) -> DataFrame:
    """(node, label) after new links; nodes not labelled yet are their own label."""
    own = found.select(F.col("a").alias("node")).union(found.select("b")).distinct().join(
        labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("label"))
    every = labels.unionByName(own)
    x = every.select(F.col("node").alias("a"), F.col("label").alias("la"))
    y = every.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    groups = connected_components(found.join(x, "a").join(y, "b").select("la", "lb"), "la", "lb")
    moved = groups.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return materialize(every.join(moved, "label", "left").select(
        "node", F.coalesce("next", "label").alias("label")), "minhash-labels")
