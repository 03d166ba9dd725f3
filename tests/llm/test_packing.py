import numpy as np
import pytest
from tokenizers import Tokenizer

from parcelyze.llm import packing, tokens

from . import cases


def brute(rows):
    t = Tokenizer.from_file(tokens.default_tokenizer())
    return [(r[0], [*t.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in rows]


@pytest.mark.parametrize("window", [1024, 7])
def test_every_id_in_one_piece_and_no_gap(spark, window):
    rows = cases.doc_rows()
    got = packing.pack(cases.with_extra(cases.docs(spark)), window=window).collect()
    got.sort(key=lambda r: (r.sequence_id, r.offset))
    at = 0
    docs, current = [], []
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.sequence_id * window + r.offset == at and len(ids) == r.length and r.offset + r.length <= window
        at += r.length
        assert r.start == len(current)
        current += ids
        if len(current) == r.doc_tokens:
            docs.append((r.doc_id, current))
            current = []
    assert not current
    order = lambda d: (d[0] is not None, d[0] or 0, d[1])
    assert sorted(docs, key=order) == sorted(brute(rows), key=order)
    ids = [d[0] for d in docs]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))       # NULL first, then ascending


def test_sequences_are_full_or_padded(spark):
    pieces = packing.pack(cases.docs(spark), window=64)
    whole = packing.sequences(pieces, window=64, pad_id=9).orderBy("sequence_id").collect()
    total = sum(r.n_tokens for r in whole)
    assert all(r.n_tokens == 64 for r in whole[:-1]) and total == sum(len(d) for _, d in brute(cases.doc_rows()))
    last, n = np.frombuffer(whole[-1].ids, "<u4"), whole[-1].n_tokens
    assert len(last) == (n if n & (n - 1) == 0 else 64) and set(last[n:].tolist()) <= {9}


def test_empty_table_and_only_empty_texts(spark):
    assert packing.pack(cases.empty(spark)).count() == 0
    got = packing.pack(cases.docs(spark, [(2, None, None, None, None), (1, "", None, None, None)])).collect()
    assert sorted((r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in got) == [
        (1, 0, 1, 1, 0, 0), (2, 0, 1, 1, 0, 1)]
