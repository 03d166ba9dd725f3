import random
import re
from math import comb

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelyze.llm import components, minhash, shingles

from . import cases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, words):
    t = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not t:
        return frozenset()
    return frozenset(tuple(t[i:i + words]) for i in range(len(t) - words + 1)) if len(t) >= words else frozenset([tuple(t)])


def brute(rows, words, percent=80):
    """id -> (shingles, component): all pairs, then flood fill."""
    sets = [(r[0], shingle_set(r[1], words)) for r in rows]
    near = {}
    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1:]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                near.setdefault(a, set()).add(b)
                near.setdefault(b, set()).add(a)
    out = []
    for a, s in sets:
        seen, todo = {a}, [a]
        while todo:
            for b in near.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        out.append((a, len(s), None if a is None else min(seen)))
    return out


def key(x):
    return tuple((v is not None, v or 0) for v in x)


def groups(df, **kw):
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, **kw).collect()), key=key)


@pytest.mark.parametrize("words", [2, 5])
def test_awkward_documents(spark, words):
    rows = cases.doc_rows()
    assert groups(cases.with_extra(cases.docs(spark)).drop("id"), words=words) == sorted(brute(rows, words), key=key)


def edited(rng, words, n):
    w = list(words)
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(cases.WORDS) + str(rng.randrange(99))
    return w


def test_chains_families_and_pairs_about_the_threshold(spark):
    """Families whose members resemble some others only, so that components are
    found through chains and buckets stay mixed for several rounds."""
    rng = random.Random(11)
    rows, n = [], 0
    for f in range(12):
        words = [rng.choice(cases.WORDS) + str(rng.randrange(99)) for _ in range(rng.randrange(30, 200))]
        for _ in range(rng.randrange(2, 14)):
            words = edited(rng, words, rng.randrange(0, max(2, len(words) // 12)))     # a chain of edits
            rows.append((rng.randrange(10 ** 6), " ".join(words), "en", "s", 0))
            n += 1
    assert groups(cases.docs(spark, rows), words=2) == sorted(brute(rows, 2), key=key)


def test_large_group_of_near_copies(spark):
    rng = random.Random(5)
    base = [rng.choice(cases.WORDS) + str(i) for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 4)), "en", "s", 0) for i in range(150)]
    rows += [(1000 + i, " ".join(base), "en", "s", 0) for i in range(150)]
    got = groups(cases.docs(spark, rows), words=2)
    assert got == sorted(brute(rows, 2), key=key) and {c for _, _, c in got} == {0}


def test_empty_table_and_nothing_to_link(spark):
    assert groups(cases.empty(spark), words=2) == []
    rows = [(i, f"only{i} words{i} of{i} their{i} own{i}", None, None, 0) for i in range(5)]
    assert [c for _, _, c in groups(cases.docs(spark, rows), words=2)] == [0, 1, 2, 3, 4]


def test_sets_have_the_size_of_exact_sets():
    rows = cases.doc_rows()
    for words in (1, 2, 5):
        got = shingles.shingle_sets(pa.array([r[1] for r in rows], pa.string()), words)
        assert [len(s) for s in got] == [len(shingle_set(r[1], words)) for r in rows]
        assert all((np.diff(s.astype(object)) > 0).all() for s in got if len(s) > 1)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    sig = minhash.Hashes(4096).signatures([np.sort(x[:2000]), np.sort(x[1000:])])
    assert abs((sig[0] == sig[1]).mean() - 1 / 3) < 0.04


def test_pruning_bound_is_the_posterior():
    """Beta(1 + m, 1 + n - m) tail at the threshold, by numerical integration."""
    x = np.linspace(0, 1, 200_001)
    for n, miss in ((16, 1e-3), (32, 1e-6), (112, 1e-9)):
        least = minhash.least_matches(n, 0.8, miss)

        def tail(m):
            d = comb(n, m) * (n + 1) * x ** m * (1 - x) ** (n - m)
            return np.trapezoid(d[x >= 0.8], x[x >= 0.8])
        assert tail(least) >= miss * 0.999 and (least == 0 or tail(least - 1) < miss * 1.001)


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(7, 8), (8, 9), (9, 7), (3, 3)]
    got = {r.node: r.label for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long").repartition(7)).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 5 for i in range(200, 400))
    assert (got[5], got[7], got[8], got[9]) == (5, 7, 7, 7) and 3 not in got
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_structured_words_are_not_taken_for_one_another(spark):
    from .test_tokens import STRUCTURED, thue_morse
    x, y = thue_morse(2048)
    texts = [x, y, f"a {x} b c d e", f"a {y} b c d e", *dict.fromkeys(STRUCTURED)]
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts)]
    for words in (1, 2, 5):
        got = groups(cases.docs(spark, rows), words=words)
        assert [c for _, _, c in got] == [0, 1, 2, 3, *(c for _, _, c in sorted(brute(rows, words))[4:])]


def test_links_need_the_words_even_if_all_hashes_agree(spark, monkeypatch):
    """Sets are confirmed on the words: a hash that knows lengths only links nothing that differs."""
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "a long, b long")
    texts = spark.createDataFrame([(1, "ab cd ef gh ij kl"), (2, "ba dc fe hg ji lk"), (3, "AB cd ef gh ij kl")], "rep long, text string")
    assert minhash.verified(pairs, texts, 5, 80).collect() == [(1, 3)]


def test_blocks_of_the_largest_component_meet_the_others_only(spark):
    """Every pair across components shares a task, and a large component costs a row a class."""
    rng = random.Random(3)
    rows = [(7, i, 0) for i in range(400)] + [(7, 1000 + i, 1000 + i % 9) for i in range(30)]
    rows += [(8, i, i) for i in range(90)] + [(9, i, i % 2) for i in range(20)]
    rng.shuffle(rows)
    got = minhash.dealt_blocks(spark.createDataFrame(rows, "key long, rep long, label long"), 40).collect()
    tasks = {}
    for r in got:
        assert r.block in (r.x, r.y)
        tasks.setdefault((r.key, r.x, r.y), []).append(r)
    met = [(k, *sorted((s.rep, t.rep))) for (k, x, y), held in tasks.items() for i, s in enumerate(held) for t in held[i + 1:]
           if s.label != t.label and (x == y or s.block != t.block)]
    want = {(k, *sorted((a, b))) for k, a, x in rows for l, b, y in rows if k == l and x != y}
    assert len(met) == len(set(met)) and set(met) == want
    # 400 classes once and 30 with each of their ten blocks and among themselves; a row for each of eleven blocks before
    assert sum(r.key == 7 for r in got) == 400 + 30 * 11


def test_links_across_blocks_of_a_large_bucket(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = random.Random(6)
    base = [rng.choice(cases.WORDS) + str(i) for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 8)), "en", "s", 0) for i in range(120)]
    assert groups(cases.docs(spark, rows), words=2) == sorted(brute(rows, 2), key=key)


def open_bucket(spark, texts, words=2):
    """One bucket of classes that share a band, each a component of its own."""
    docs = spark.createDataFrame(list(enumerate(texts)), "rep long, text string")
    classes = minhash.sketch(docs.withColumnRenamed("rep", "id"), "id", "text", words, 112).select(
        F.col("id").alias("rep"), "signature")
    state = minhash.buckets(classes, 4).withColumn("label", F.col("rep"))
    return state, classes, docs


def test_a_large_group_of_likely_links_costs_a_forest(spark):
    """A task that finds all pairs of a group likely emits fewer rows than it has classes."""
    rng = random.Random(11)
    base = [rng.choice(cases.WORDS) + str(i) for i in range(150)]
    texts = [" ".join(edited(rng, base, 1)) for _ in range(40)]
    state, classes, docs = open_bucket(spark, texts)
    got = minhash.crossing(state, classes, docs, 2, 4, 0.8, 80, 16, 1e-9, 112).collect()
    tasks = {k: [r for r in got if r.key == k] for k in {r.key for r in got}}
    assert got and all(len(t) < 40 for t in tasks.values()) and any(r.more for r in got)     # 780 pairs before
    every = minhash.crossing(state, classes, docs, 2, 4, 0.8, 80, 16, 1e-9, 112, forests=1000).collect()
    assert len({(r.a, r.b) for r in every}) == 40 * 39 // 2 and not any(r.more for r in every)


def test_forests_take_every_link_in_the_end():
    x, y = (np.array(v) for v in zip(*[(a, b) for a in range(9) for b in range(a)]))
    assert minhash.spanning(x, y, 1).sum() == 8
    assert minhash.spanning(x, y, 2).sum() == 15
    assert minhash.spanning(x, y, 64).all()


def test_links_behind_a_pair_that_fails_are_found(spark, monkeypatch):
    """Bounds that let every pair pass make forests of pairs that fail; no link may be lost by it."""
    real, rounds = minhash.crossing, []

    def loose(state, classes, texts, words, rows, threshold, percent, batch, miss, hashes, word_key, forests):
        rounds.append(forests)
        return real(state, classes, texts, words, rows, 0.01, 1, batch, miss, hashes, word_key, forests)
    monkeypatch.setattr(minhash, "crossing", loose)
    rng = random.Random(12)
    base = [rng.choice(cases.WORDS) + str(i) for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, 9)), "en", "s", 0) for i in range(60)]
    assert groups(cases.docs(spark, rows), words=2) == sorted(brute(rows, 2), key=key)
    assert rounds[:2] == [1, 8]
