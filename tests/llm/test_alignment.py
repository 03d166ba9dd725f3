import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from parcelyze.llm import alignment, tokens

from . import cases

ODD = ["a<|endoftext|>b <s> </s><unk> <0x41> x", "tabs\tand\nlines\r\n  of  text ", " lead", "  two", "trail ", "trail  ", " ",
       "   ", "\n", "naïve café déjà vu", "日本語 テスト test　全角 a", "🙂🙂 ok 🙂a‍b 👩‍👩‍👧", "a b  c  d   e", "x ▁ y", "▁", "\x00\x01 \x7f",
       "it's we'll I'M don't '", "1,234.5 != 3e8", "ab" * 700, "é ä", "\u0085 x", "x\u0085 y", "é à ü", "z 　", "﻿bom ﻿",
       "a b c d", "١٢٣ عربي", "\U0001f468‍\U0001f4bb"]


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokens.default_tokenizer())
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.default_pieces())


def plain(text, models):
    """[(ids of A, ids of B)] of a whole text, from the token bytes alone."""
    a, b = models
    if not text:
        return []
    full = " " + text
    alphabet = {c: x for x, c in tokens.byte_chars().items()}
    ia, ib = a.encode(full, add_special_tokens=False).ids, b.encode(text)
    sa = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ia]
    sb = [bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    if b"".join(sa) != full.encode() or b"".join(sb) != full.encode():
        return []
    out, x, y, na, nb = [], 0, 0, 0, 0
    ga, gb = [], []
    while x < len(ia) or y < len(ib):
        if y == len(ib) or x < len(ia) and na <= nb:
            na += len(sa[x])
            ga.append(ia[x])
            x += 1
        else:
            nb += len(sb[y])
            gb.append(ib[y])
            y += 1
        if na == nb:
            out.append((tuple(ga), tuple(gb)))
            ga, gb = [], []
    assert not ga and not gb
    return out


def brute(rows, models):
    per = [(r[0], plain(r[1], models)) for r in rows]
    held = Counter()
    for _, g in per:
        held.update({(i, j) for a, b in g for i in a for j in b})
    top = {}
    for (i, _), n in held.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for doc, g in per:
        links = [(i, j) for a, b in g for i in a for j in b]
        out.append((doc, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(held[p] == top[p[0]] for p in links), sum(held[p] for p in links),
                    ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def run(df, **kw):
    return sorted((tuple(r) for r in alignment.align(df, **kw).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


def spelled(al, text_array):
    units, first = al.number(text_array)
    return ["" if (al.numbers[u, 0] == 0).any() else al.spell(u) for u in (units[a:b] for a, b in zip(first[:-1], first[1:]))]


def as_text(g):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)


def test_units_align_as_whole_texts(models):
    rng = random.Random(1)
    al = alignment.Aligner(tokens.default_tokenizer(), alignment.default_pieces())
    texts = ODD + ["".join(rng.choice(["a", "B", " ", " ", "  ", "\n", "\n", ".", "é", "日", "'s", "\u00a0", "\u3000", "1", "the", "▁", "\t", "🙂"])
                           for _ in range(rng.randrange(25))) for _ in range(3000)]
    texts += ["x\ny", "a\n b", "a \nb", "a\n\nb", "\nlead", "trail\n", "a\r\nb", "one\ntwo three\nfour", "\x85\n b", "b\n\u3000c"]
    for part in (texts, texts[::-1], ["zz", *texts][:700]):
        for t, got in zip(part, spelled(al, pa.array(part, pa.string()))):
            assert got == as_text(plain(t, models)), repr(t)


def test_same_as_whole_texts_aligned(spark, models, monkeypatch):
    from parcelyze.llm import slices
    monkeypatch.setattr(slices, "isqrt", lambda n: 5)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)] + [(100 + r[0] if r[0] is not None else None, *r[1:]) for r in cases.doc_rows()]
    assert run(cases.docs(spark, rows), slice_bytes=2000) == brute(rows, models)


def test_awkward_documents(spark, models):
    rows = cases.doc_rows()
    assert run(cases.with_extra(cases.docs(spark)).drop("id")) == brute(rows, models)
    assert alignment.align(cases.empty(spark)).count() == 0
    none = run(cases.docs(spark, [(1, None, None, None, 0), (2, "", None, None, 0)]))
    assert none == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_spans_are_refined_by_decoded_bytes():
    import numpy as np
    assert alignment.refined(np.array([2, 5, 5, 5, 6]), np.array([2, 1, 1, 1, 1])).tolist() == [2, 3, 4, 5, 6]
    assert alignment.refined(np.array([0, 3]), np.array([1, 2])).tolist() == [1, 3]


def test_forgetting_and_runs_change_nothing(models, monkeypatch):
    monkeypatch.setattr(alignment, "_TOGETHER", 3)
    small = alignment.Aligner(tokens.default_tokenizer(), alignment.default_pieces(), max_units=5)
    for k in range(4):
        for t in ("one two three four five", "six ▁ seven eight", f"nine ten {k} é日 x\nz"):
            assert spelled(small, pa.array([t])) == [as_text(plain(t, models))]


def test_registered_query_on_whole_table(spark, models):
    from hashlib import sha256

    from parcelyze.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*r[:7], sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute(rows, models)]
    got = QUERIES["op13_alignment"](spark, sf)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_counts_hash_no_tokens_one_by_one(models, monkeypatch):
    """Units and pairs of a slice are made distinct by sorting and by flags, with the same counts."""
    texts = [None, "", *ODD, *["the cat sat, on the mat. " * n for n in range(1, 40)]]
    table = pa.table({"id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    al = alignment.Aligner(tokens.default_tokenizer(), alignment.default_pieces())
    alignment.Slice(table, al)                               # units are known from here on

    def refused(*args, **kw):
        raise AssertionError("np.unique over the tokens of a slice")
    monkeypatch.setattr(alignment.np, "unique", refused)
    pairs, n = alignment.Slice(table, al).document_counts()
    monkeypatch.undo()
    want = Counter()
    for text in texts:
        want.update({a << 32 | b for g in plain(text, models) for a in g[0] for b in g[1]})
    assert dict(zip(pairs.tolist(), n.tolist())) == want
    values = np.array([5, -1, 5, 3, -1, 2 ** 62, 0], np.int64)
    assert alignment.distinct(values).tolist() == [-1, 0, 3, 5, 2 ** 62] and not len(alignment.distinct(values[:0]))
