import random
import re

import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models

from parcelyze.llm import token_counts as tc

from . import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def vocabulary():
    return tc.zipf_vocabulary(tc.default_model())


def plain(word, vocabulary, unknown=-20.0):
    """Viterbi over one word, nothing shared."""
    best = [(0.0, 0)]
    for j in range(1, len(word) + 1):
        n = len(word[j - 1].encode())
        found = [(best[j - 1][0] + n * unknown, -(best[j - 1][1] + n))]
        for i in range(max(0, j - 40), j):
            if word[i:j] in vocabulary:
                found.append((best[i][0] + vocabulary[word[i:j]], -(best[i][1] + 1)))
        s, c = max(found)
        best.append((s, -c))
    return best[-1][1]


def test_matches_word_by_word_viterbi(spark, vocabulary):
    rows = cases.doc_rows()
    got = sorted(((r["id"], r["n_pretokens"], r["n_tokens"]) for r in tc.count_tokens(
        cases.with_extra(cases.docs(spark)).drop("id")).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = sorted(((r[0], len(w), sum(plain("▁" + x, vocabulary) for x in w)) for r in rows
                   for w in [WORD.findall(r[1] or "")]), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert got == want


def test_agrees_with_a_unigram_library():
    """Scores without ties on words that pieces cover."""
    rng = random.Random(2)
    vocabulary = {"▁": -2.05}
    for n in (1, 1, 1, 2, 2, 3, 4):
        for _ in range(30):
            vocabulary.setdefault("".join(rng.choice("abcd") for _ in range(n)), -rng.uniform(1, 3) * (1 + 0.3 * n))
    for c in "abcd":
        vocabulary.setdefault(c, -rng.uniform(3, 6))
    library = Tokenizer(models.Unigram([("<unk>", -100.0), *vocabulary.items()], unk_id=0))
    for _ in range(300):
        w = "▁" + "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 25)))
        assert tc.Trie(vocabulary, -50.0).insert(w) == len(library.encode(w).ids)


def test_prefixes_are_computed_once(vocabulary):
    t = tc.Trie(vocabulary, -20.0)
    a = t.insert("▁international")
    nodes = len(t.score)
    assert t.insert("▁international") == a and t.insert("▁inter") >= 1 and len(t.score) == nodes
    t.insert("▁internationally")
    assert len(t.score) == nodes + 2


def test_forgetting_changes_nothing(vocabulary):
    small, big = tc.Counter(vocabulary, -20.0, max_words=5), tc.Counter(vocabulary, -20.0)
    for i in range(0, 60, 6):
        a = pa.array([f"word{j} and other words {j % 4}" for j in range(i, i + 6)])
        assert [x.tolist() for x in small.count(a)] == [x.tolist() for x in big.count(a)]


def test_empty(spark):
    assert tc.count_tokens(cases.empty(spark)).count() == 0
    got = tc.count_tokens(cases.docs(spark, [(1, None, None, None, 0), (2, " \n", None, None, 0)])).collect()
    assert [(r["n_pretokens"], r["n_tokens"]) for r in got] == [(0, 0), (0, 0)]


def test_structured_words_keep_their_own_counts():
    from .test_tokens import STRUCTURED
    toy = {"▁": -1.0, "a": -2.0, "b": -2.0, "aab": -2.5, "abba": -3.0, "ba": -3.5}
    c = tc.Counter(toy, -20.0)
    for t in STRUCTURED:
        assert c.count(pa.array([t]))[1].tolist() == [plain("▁" + t, toy)]
    assert c.count(pa.array(STRUCTURED))[1].tolist() == [plain("▁" + t, toy) for t in STRUCTURED]
