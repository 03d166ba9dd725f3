import random
import re
from collections import Counter

import numpy as np
import pytest

from parcelyze.llm import collocations as co
from parcelyze.llm import slices

from . import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=3, absorb=50, top=2000):
    f = {}
    for _, text, lang, *_ in rows:
        c = f.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = re.findall("[^ \t]+", piece)
            for n in range(1, longest + 1):
                c.update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        total = sum(n for p, n in c.items() if len(p) == 1)
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cand.items():
            longer = [b for q, b in cand.items() if len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= absorb * a for b in longer):
                continue
            s, k = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            rows.append((" ".join(p), a, c[p[:k]], c[p[k:]], total, s))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i, *r) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def run(df, **kw):
    return sorted(tuple(r) for r in co.collocations(df, **kw).collect())


def texts(seed, n=80):
    rng = random.Random(seed)
    words = ["New", "york", "city", "the", "of", "naïve", "日本", "a", "B", "c'd", "x-y"]
    rows = []
    for i in range(n):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", ";x "]) for _ in range(rng.randrange(40)))
        t += rng.choice(["", " New York City", " of the of the", "New York"])
        rows.append((i, t, rng.choice(["en", "en", "de", None, "und"]), "s", 0))
    return rows


@pytest.mark.parametrize("least,longest,size", [(10, 3, 8 << 20), (3, 3, 400), (2, 4, 700), (5, 2, 300), (1, 3, 900)])
def test_same_as_plain_counters(spark, monkeypatch, least, longest, size):
    monkeypatch.setattr(slices, "isqrt", lambda n: 6)
    rows = texts(least)
    got = run(cases.docs(spark, rows), least=least, longest=longest, slice_bytes=size, shard_bytes=size)
    want = brute(rows, least, longest)
    assert got == want and len(got) > 5


def test_limits_and_absorption(spark):
    rows = texts(9, 150)
    assert run(cases.docs(spark, rows), least=3, top=7) == brute(rows, 3, top=7)
    for absorb in (1, 90, 101):
        assert run(cases.docs(spark, rows), least=3, absorb=absorb) == brute(rows, 3, absorb=absorb)


def test_awkward_documents(spark):
    rows = cases.doc_rows()
    assert run(cases.with_extra(cases.docs(spark)).drop("id"), least=2) == brute(rows, 2)
    assert co.collocations(cases.empty(spark)).count() == 0
    assert co.collocations(cases.docs(spark, [(1, None, None, None, 0), (2, " .,", "en", None, 0)])).count() == 0


def test_exact_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", "a", 9 * 10 ** 15, 1), ("en", "b", 10 ** 15 + 7, 2)], "lang string, word string, f long, id long")
    a = 10 ** 15 - 1
    grams = spark.createDataFrame([([1, 2], a)], "ids array<bigint>, a long")
    assert co.score(words, grams).first()["score"] == 1_000_000 * a * a // (9 * 10 ** 15 * (10 ** 15 + 7))


@pytest.mark.parametrize("bits,n", [(1, 2), (7, 2), (17, 3), (21, 3), (30, 3), (33, 2), (42, 3), (31, 4)])
def test_packing_and_permutation_are_undone(bits, n):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 1 << bits, (500, n))
    ids[0], ids[1] = 0, (1 << bits) - 1
    b, half = co.half_bits((1 << bits) - 1, n)
    assert b == bits
    packed = co.pack(ids, bits)
    mixed = co.permute(*packed, half)
    assert not ((mixed[0] == packed[0]) & (mixed[1] == packed[1]))[2:].all() or bits == 1
    assert (co.unpack(*co.restore(*mixed, half), bits, n) == ids).all()
    with pytest.raises(ValueError):
        co.half_bits(1 << 42, 3)


@pytest.mark.parametrize("bits,shard_bits", [(8, 0), (20, 3), (34, 0), (63, 5), (64, 2), (90, 4), (126, 6), (126, 0)])
@pytest.mark.parametrize("n", [0, 1, 2, 100, 3000])
def test_filters_are_lossless_and_merge(bits, shard_bits, n):
    rng = np.random.default_rng(n + bits)
    free = bits - shard_bits
    n = min(n, 1 << min(free, 12))

    def some(k):
        x = {int.from_bytes(rng.bytes(16), "little") % (1 << free) + (5 % (1 << shard_bits) << free) for _ in range(k)}
        return {v: int(rng.choice([1, 3, 254, 255, 256, 10 ** 12])) for v in x}

    def arrays(d):
        keys = sorted(d)
        return (np.array([k >> 64 for k in keys], np.uint64), np.array([k & (2 ** 64 - 1) for k in keys], np.uint64),
                np.array([d[k] for k in keys], np.int64))

    def plain(raw):
        return {(int(h) << 64) + int(x): int(c) for h, x, c in zip(*co.entries(raw))}
    a, b = some(n), some(n // 2)
    b.update({k: 7 for k in list(a)[:n // 3]})
    one, two = (co.encode(*arrays(d), bits, shard_bits) for d in (a, b))
    assert plain(one) == a and plain(two) == b
    if n:
        assert plain(co.merge([one, two], bits)) == dict(Counter(a) + Counter(b))


def test_filters_are_compact():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 1 << 51, 100_000, dtype=np.uint64))
    assert len(co.encode(np.zeros_like(x), x, np.ones(len(x), np.int64), 51, 0)) < 7 * len(x)
