import io

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelyze.llm import files, token_file, tokens

from . import cases


def round_trip(ids):
    blocks = token_file.encode_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1].tolist()
    return token_file.decode_blocks(b"".join(blocks), starts)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 50), st.integers(0, 2 ** 32 - 1)), min_size=1, max_size=2500))
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    assert round_trip(ids).tolist() == values


@pytest.mark.parametrize("n", [1, 1023, 1024, 1025, 300_000])
def test_block_sizes_and_widths(n):
    rng = np.random.default_rng(n)
    for high in (1, 2, 300, 50_000, 2 ** 32):
        ids = rng.integers(0, high, n).astype(np.uint32)
        assert (round_trip(ids) == ids).all()


def test_outliers_are_exceptions():
    ids = np.full(1024, 7, np.uint32)
    ids[::50] = 4_000_000_000
    block, = token_file.encode_blocks(ids)
    n, width, exceptions, low = token_file._HEAD.unpack_from(block)
    assert (n, width, exceptions, low) == (1024, 0, 21, 7) and len(block) < 200
    assert (round_trip(ids) == ids).all()


def test_random_access():
    sink = io.BytesIO()
    sink.close = lambda: None
    w = token_file.Writer(sink)
    ids = np.arange(5000, dtype=np.uint32) % 997
    w.add([1, None, 3], np.array([0, 4000, 1000]), ids)
    assert w.close() == {"docs": 3, "tokens": 5000, "blocks": 5}
    r = token_file.Reader(pa.BufferReader(sink.getvalue()))
    for a, b in ((0, 0), (0, 1), (1023, 1025), (4000, 5000), (0, 5000), (4999, 5000)):
        assert r.ids(a, b).tolist() == ids[a:b].tolist()
    assert r.counts.tolist() == [0, 4000, 1000] and r.nulls.tolist() == [False, True, False]
    with pytest.raises(ValueError):
        token_file.Reader(pa.BufferReader(sink.getvalue()[:-3]))


@pytest.mark.parametrize("file_tokens", [4 << 20, 1000])
def test_files_hold_every_text_in_order(spark, file_tokens):
    rows = cases.doc_rows()
    folder = files.new_folder(spark, "test-token-files")
    listed = token_file.write(cases.with_extra(cases.docs(spark)), folder, file_tokens=file_tokens)
    assert sum(e["docs"] for e in listed) == len(rows)
    t = Tokenizer.from_file(tokens.default_tokenizer())
    want = sorted(((r[0], tuple([*t.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in rows),
                  key=lambda d: (d[0] is not None, d[0] or 0, d[1]))
    got = sorted(token_file.read(spark, folder, step_tokens=500).collect(), key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    assert [r.doc_id for r in got] == [d for d, _ in want]
    assert sorted(((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got),
                  key=lambda d: (d[0] is not None, d[0] or 0, d[1])) == want


def test_only_committed_files_are_read(spark):
    folder = files.new_folder(spark, "test-token-files")
    token_file.write(cases.empty(spark), folder)
    fs, p = files.resolve(folder)
    with fs.open_output_stream(f"{p}/part-000099-0000.pfrb") as f:          # of a lost attempt
        f.write(b"rubbish")
    assert token_file.read(spark, folder).count() == 0
