import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from parcelyze.llm import tokens

ODD = [None, "", " ", "  a", "a  b ", "it's we'll I'M don't'", "x  y   z", " \n\n a\t b\x0b\x0cc", "a<|endoftext|>b",
       "naïve café’s  ’tis", "123 abc12d 3.14,5", "日本語 テスト test　全角", "\x1c\x1d a\x1fb", "a" * 3000, "áb c", "ǅ ʼn Ω x",
       "🙂🙂 ok🙂a‍b", "\x00\x01 \x7f"]


@pytest.fixture(scope="module")
def enc():
    return tokens.Encoder(tokens.default_tokenizer())


def library(enc, texts):
    return [e.ids for e in enc.library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(ids, ends):
    return [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]


def test_same_ids_as_the_library(enc):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice("ab '\n\t.,1é  Z’s ") for _ in range(rng.randrange(40))) for _ in range(2000)]
    assert split(*enc.encode(pa.array(texts, pa.string()))) == library(enc, texts)
    sliced = pa.array(["zzz", *texts], pa.string()).slice(1)
    assert split(*enc.encode(sliced)) == library(enc, texts)


def test_forgetting_changes_nothing():
    small = tokens.Encoder(tokens.default_tokenizer(), max_pieces=20)
    texts = [f"word{i} other {i % 7} thing" for i in range(200)]
    for i in range(0, 200, 10):
        part = texts[i:i + 10]
        assert split(*small.encode(pa.array(part))) == library(small, part)


def test_small_windows(enc, monkeypatch):
    monkeypatch.setattr(tokens, "_WINDOW", 7)
    assert split(*enc.encode(pa.array(ODD, pa.string()))) == library(enc, ODD)


def test_empty_column(enc):
    ids, ends = enc.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and len(ends) == 0
    ids, ends = enc.encode(pa.array([None, ""], pa.string()))
    assert len(ids) == 0 and ends.tolist() == [0, 0]


def test_added_tokens_as_in_an_untouched_tokenizer(enc):
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    assert plain.encode("a<|endoftext|>b", add_special_tokens=False).ids == [64, 50256, 65]
    texts = ["a<|endoftext|>b", "one two", "<|endoftext|>", "<|endoftext|><|endoftext|>", "<|endoftext|", None,
             "it's <|endoftext|>\n\n  don't<|endoftext|> 12 <|end of text|>", "x<|endoftext|> a\u3000 b", "one <|endoftext| >two", *ODD]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    for _ in range(2):                                      # met and not met before
        assert split(*enc.encode(pa.array(texts, pa.string()))) == want


def test_added_token_of_letters(tmp_path):
    plain = Tokenizer.from_file(tokens.default_tokenizer())
    plain.add_special_tokens(["stopword"])
    plain.save(str(tmp_path / "t.json"))
    texts = ["stopword", "a stopword b", "stopwords here", "stop word"]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert split(*tokens.Encoder(str(tmp_path / "t.json")).encode(pa.array(texts))) == want


def thue_morse(n):
    """A word of ``n`` letters and its complement: equal under a polynomial hash modulo 2**64."""
    w = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return w, w.translate(str.maketrans("ab", "ba"))


STRUCTURED = [*thue_morse(1024), *thue_morse(4096), *thue_morse(8192), "ab" * 900, "ba" * 900, "01" * 700, "10" * 700,
              *(format(i, "b").translate(str.maketrans("01", "ab")) for i in range(300)), "a" * 5000, "a" * 5001]


def test_structured_words_keep_their_own_ids():
    enc, plain = tokens.Encoder(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer())
    want = [plain.encode(t, add_special_tokens=False).ids for t in STRUCTURED]
    for t, ids in zip(STRUCTURED, want):                    # one by one, then all at once
        assert split(*enc.encode(pa.array([t]))) == [ids]
    assert split(*enc.encode(pa.array(STRUCTURED))) == want


@pytest.mark.parametrize("weak", [lambda d, b, e: np.zeros(len(b), np.uint64), lambda d, b, e: (e - b).astype(np.uint64)])
def test_pieces_of_one_hash_are_told_apart(monkeypatch, weak):
    monkeypatch.setattr(tokens, "span_hashes", weak)
    enc, plain = tokens.Encoder(tokens.default_tokenizer()), Tokenizer.from_file(tokens.default_tokenizer())
    for texts in (["one two three", "two one", "six ten ten"], ["ten", "abc abd", ""], STRUCTURED[:6]):
        assert split(*enc.encode(pa.array(texts))) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_hash_depends_on_every_byte_and_the_length():
    data = np.frombuffer(b"".join(t.encode() for t in STRUCTURED), np.uint8)
    end = np.cumsum([len(t) for t in STRUCTURED])
    begin = end - [len(t) for t in STRUCTURED]
    h = tokens.span_hashes(data, begin, end)
    assert len(set(h.tolist())) == len(set(STRUCTURED))
    assert (tokens.span_hashes(data, begin, end, 5) == tokens.span_hashes(data.copy(), begin, end, 5)).all()
    assert len(set(tokens.span_hashes(np.zeros(40, np.uint8), np.zeros(40, np.int64), np.arange(40)).tolist())) == 40
