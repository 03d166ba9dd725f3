import hashlib
import io
import re
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from parcelyze.llm import fingerprints as fp

from . import cases

PIECE = re.compile(r"[^\n]{1,%d}[^ \t\n\x0b\f\r]*" % fp.PIECE)


def pieces(t):
    return set(PIECE.findall(t))


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, got):
    """Brute force over the descending order of the distinct (id, text)."""
    want = {(r[0], r[1] or "") for r in rows}
    assert len(got) == len(rows)
    ids = [d[0] for d in want]
    texts = sorted(want, key=lambda d: (d[0] is None, -(d[0] or 0)))
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, (k, t) in enumerate(texts):
        if ids.count(k) > 1 or k is None or ids.count(texts[(i + 1) % len(texts)][0]) > 1 \
                or texts[(i + 1) % len(texts)][0] is None:
            continue                       # the order among texts of one id is by a hash
        nxt, half = texts[(i + 1) % len(texts)][1], len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        for r in by[k]:
            assert r["n_chars"] == len(t)
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert r["near_edited"] == pytest.approx(jaccard(pieces(t), pieces(edited)))
            assert r["near_next"] == pytest.approx(jaccard(pieces(t), pieces(nxt)))


def run(df):
    return fp.compare(df).withColumnRenamed("id", "doc_id").collect()


def test_matches_sets_on_awkward_documents(spark):
    rows = cases.doc_rows()
    got = run(cases.with_extra(cases.docs(spark)).drop("id"))
    check(rows, got)
    marks = {}
    text = {r[0]: r[1] or "" for r in rows}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] is not None:
            marks.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in marks.values())                     # equal texts
    assert len({x for v in marks.values() for x in v}) == len({frozenset(pieces(t)) for t in marks})


def test_single_document_meets_itself(spark):
    r, = run(cases.docs(spark, [(7, "one two three\nfour five six", None, None, 0)]))
    assert r["near_next"] == 1.0 and r["edited_sha256"] == hashlib.sha256(b"one two three\none two three").hexdigest()


def test_empty_table_and_empty_texts(spark):
    assert run(cases.empty(spark)) == []
    got = run(cases.docs(spark, [(1, None, None, None, 0), (2, "", None, None, 0), (3, "abc", None, None, 0)]))
    near = {r["doc_id"]: (r["n_chars"], r["near_edited"], r["near_next"]) for r in got}
    assert near == {3: (3, 0.0, 0.0), 2: (0, 1.0, 1.0), 1: (0, 1.0, 0.0)}


def test_many_partitions_and_repeated_rows(spark):
    rows = [(i, f"line {i}\n" * 3 + f"tail {i % 5}", None, None, 0) for i in range(60)] + [(5, "line 5\n" * 3 + "tail 0", None, None, 0)] * 3
    check(rows, run(cases.docs(spark, rows, partitions=13)))


def sets(spark, a, b):
    return spark.createDataFrame([(sorted(a), sorted(b))], "a array<bigint>, b array<bigint>")


def peeled(spark, a, b):
    return sets(spark, a, b).select(fp.peel(fp.subtract(fp.sketch(F.col("a")), fp.sketch(F.col("b")))).alias("r")).first().r


def test_peeling_finds_the_differing_digests_or_says_so(spark):
    common = [fp_hash(i) for i in range(500)]
    for seed in range(12):
        one, two = [fp_hash(f"{seed}a{i}") for i in range(seed)], [fp_hash(f"{seed}b{i}") for i in range(11 - seed)]
        r = peeled(spark, common + one, common + two)
        assert r.left > 0 or (r.plus, r.minus) == (sorted(one), sorted(two))
        if seed in (3, 8):                                    # most of these peel
            assert r.left == 0
    assert peeled(spark, common, []).left > 0
    assert peeled(spark, common, common)[:] == (0, [], [])


def test_fingerprints_are_the_sketches_and_can_be_read_back(spark):
    rows = [(1, ""), (2, "one line"), (3, "\n".join(f"line {i}" for i in range(80))), (4, "a\nb\nc"), (5, "a\nb\nd")]
    df = spark.createDataFrame(rows, "id int, text string").withColumn("fp", fp.fingerprint(F.col("text")))
    got = df.select("id", "fp", fp.parse(F.col("fp")).alias("back"), fp.sketch(fp.digests(F.col("text"))).alias("cells")).collect()
    assert all(r.back == r.cells and len(r.cells) == 24 and sum(c["count"] for c in r.cells) % 3 == 0 for r in got)
    a, b = (df.filter(F.col("id") == i).select(F.col("fp").alias(f"f{i}")) for i in (4, 5))
    r = a.crossJoin(b).select(fp.peel(fp.subtract(fp.parse(F.col("f4")), fp.parse(F.col("f5")))).alias("r")).first().r
    want = {x.d for x in spark.sql("SELECT xxhash64('c') AS d UNION SELECT xxhash64('d')").collect()}
    assert r.left == 0 and len(r.plus) == len(r.minus) == 1 and {*r.plus, *r.minus} == want


def recovered(df):
    plus, minus = set(), set()
    for r in fp.differences(df).collect():
        assert not (plus & set(r["plus"])) and not (minus & set(r["minus"]))
        plus |= set(r["plus"])
        minus |= set(r["minus"])
    return plus, minus


@pytest.mark.parametrize("group", [fp.GROUP, 40, 10 ** 6])
def test_failures_are_tried_again_larger(spark, monkeypatch, group):
    monkeypatch.setattr(fp, "GROUP", group)                  # sketches too small at first: groups do not peel
    a, b = {fp_hash(i) for i in range(900)}, {fp_hash(i) for i in range(100, 1600)}
    df = sets(spark, a, b).selectExpr("1L AS kid", "2L AS tie", "'k' AS kind", "a", "b")
    assert recovered(df) == (a - b, b - a)


def test_retries_end(spark, monkeypatch):
    monkeypatch.setattr(fp, "GROUP", 10 ** 6)
    monkeypatch.setattr(fp, "RETRIES", 1)
    df = sets(spark, {fp_hash(i) for i in range(900)}, set()).selectExpr("1L AS kid", "2L AS tie", "'k' AS kind", "a", "b")
    with pytest.raises(RuntimeError, match="did not peel"):
        fp.differences(df)


def test_digests_that_differ_in_few_bits_part(spark):
    a = {1 << 3, 1 << 7, 1 << 11, 0, 1, -1, 1 << 62, -(1 << 63)}
    df = sets(spark, a, set()).selectExpr("1L AS kid", "2L AS tie", "'k' AS kind", "a", "b")
    assert recovered(df) == (a, set())


def fp_hash(i):
    return int.from_bytes(hashlib.blake2b(str(i).encode(), digest_size=8).digest(), "little", signed=True)


def test_native_plans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (fp.versions(docs), fp.compare(docs)):
        with redirect_stdout(io.StringIO()) as out:
            df.explain("simple")
        assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", out.getvalue())


def test_digests_of_failed_pairs_are_not_written_again(spark, monkeypatch):
    """Written between the rounds are flags, sizes and results; digests are read from the pairs."""
    monkeypatch.setattr(fp, "GROUP", 60)
    written, keep = [], fp.materialize

    def spy(df, label="t"):
        out = keep(df, label)
        written.append(out)
        return out
    monkeypatch.setattr(fp, "materialize", spy)
    a, b, c = ({fp_hash(f"{x}{i}") for i in range(n)} for x, n in (("a", 300), ("b", 500), ("c", 4)))
    rows = [(1, 2, "edited", a, b), (1, 2, "next", a, a | c), (3, 2, "edited", b, a), (3, 2, "next", b, c | b)]
    df = spark.createDataFrame([(*r[:3], sorted(r[3]), sorted(r[4])) for r in rows], "kid long, tie long, kind string, a array<bigint>, b array<bigint>")
    got = {}
    for r in fp.differences(df).collect():
        plus, minus = got.setdefault((r.kid, r.kind), (set(), set()))
        plus.update(r["plus"])
        minus.update(r["minus"])
    assert got == {(r[0], r[2]): (r[3] - r[4], r[4] - r[3]) for r in rows}
    assert len(written) > 2                                     # a retry took place
    assert not any({"a", "b"} & set(w.columns) for w in written)
