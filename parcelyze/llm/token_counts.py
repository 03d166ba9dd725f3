"""Token counts under a unigram model, by dynamic programming shared in a trie.

A pre-token is a word [^\\x20\\x09-\\x0D]+ behind the mark that stands for its blank.
Its best segmentation maximises the sum of the pieces' log-probabilities; among
equal sums the one with fewer pieces counts. The best score of a prefix does not
depend on what follows, so the distinct pre-tokens of a batch are inserted in a
trie and the forward score is computed once per node, from the nodes above it.
The node where a pre-token ends stores its token count. Counts of pre-tokens that
this Python worker has met are kept (at most ``max_words``; found by hash and
confirmed byte by byte), so the trie of a batch holds new ones only and is dropped
with the batch.

A character in no piece is spelled in byte pieces: as many tokens as UTF-8 bytes,
each at the ``unknown`` score. The vocabulary file holds merge ranks and no
probabilities; by default a piece of rank r scores as Zipf's law has it, -ln(r + 1)
less the logarithm of the sum of 1 / (r + 1). NULL and empty texts count 0.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_slices
from .shingles import _SPACE
from .tokens import Pieces

MARK = "▁"


def zipf_vocabulary(path: str) -> dict:
    """{piece: log-probability} of the normal pieces of a sentencepiece model."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rank = {}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
            rank.setdefault(sp.id_to_piece(i), len(rank))
    norm = math.log(sum(1 / (r + 1) for r in rank.values()))
    return {p: -math.log(r + 1) - norm for p, r in rank.items()}


class Trie:
    """Nodes with the best score and token count of the prefix they spell."""

    def __init__(self, vocabulary: dict, unknown: float):
        self.vocabulary, self.unknown = vocabulary, unknown
        self.longest = max(map(len, vocabulary), default=0)
        self.child, self.score, self.count = {}, [0.0], [0]

    def insert(self, word: str) -> int:
        """The number of tokens of ``word``."""
        path, child, node = [0], self.child, 0
        for j, ch in enumerate(word, 1):
            nxt = child.get((node, ch))
            if nxt is None:
                nxt = child[node, ch] = len(self.score)
                self._forward(word, j, path)
            node = nxt
            path.append(node)
        return self.count[node]

    def _forward(self, word: str, j: int, path: list):
        spelled = len(word[j - 1].encode("utf-8", "surrogatepass"))
        best = self.score[path[j - 1]] + spelled * self.unknown
        count = self.count[path[j - 1]] + spelled
        known, score, counts = self.vocabulary, self.score, self.count
        for i in range(j - 1, max(-1, j - 1 - self.longest), -1):
            p = known.get(word[i:j])
            if p is not None:
                s, c = score[path[i]] + p, counts[path[i]] + 1
                if s > best or s == best and c < count:
                    best, count = s, c
        score.append(best)
        counts.append(count)


class Counter:
    """Counts of whole texts, with the counts of known words kept."""

    def __init__(self, vocabulary: dict, unknown: float, max_words: int = 2_000_000):
        self.vocabulary, self.unknown, self.max_words = vocabulary, unknown, max_words
        self.known, self.counts = Pieces(), np.empty(0, np.int64)

    def _of(self, data, begin, end) -> np.ndarray:
        """The token count of each range."""
        if len(self.known) > self.max_words:
            self.known, self.counts = Pieces(), np.empty(0, np.int64)
        slot = self.known.number(data, begin, end)
        trie = Trie(self.vocabulary, self.unknown)
        new = [trie.insert(MARK + self.known[i].decode()) for i in range(len(self.counts), len(self.known))]
        self.counts = np.concatenate([self.counts, np.array(new, np.int64)])
        return self.counts[slot]

    def count(self, texts: pa.Array):
        """(pre-tokens, tokens) per text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
        if n == 0 or off[-1] == off[0]:
            return np.zeros(n, np.int64), np.zeros(n, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        edge = np.zeros(len(data) + 1, bool)
        edge[off] = True
        word = ~_SPACE[data]
        begin = np.flatnonzero(word & np.concatenate([[True], edge[1:-1] | ~word[:-1]]))
        end = np.flatnonzero(word & np.concatenate([edge[1:-1] | ~word[1:], [True]])) + 1
        total = np.concatenate([[0], np.cumsum(self._of(data, begin, end))])
        last = np.searchsorted(begin, off[1:])
        start = np.concatenate([[0], last[:-1]])
        return last - start, total[last] - total[start]


_COUNTERS: dict = {}


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def count_tokens(docs: DataFrame, id_col="doc_id", text_col="text", model: str | None = None,
                 unknown: float = -20.0) -> DataFrame:
    """One row per row of ``docs``: id, n_pretokens, n_tokens. No shuffle: a worker
    shares its counts between batches and tasks."""
    path = model or default_model()

    def run(batches):
        if (path, unknown) not in _COUNTERS:
            _COUNTERS[path, unknown] = Counter(zipf_vocabulary(path), unknown)
        counter = _COUNTERS[path, unknown]
        for whole in batches:
            for b in row_slices(whole, "text", 1 << 20):
                words, tokens = counter.count(b.column("text"))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(words), pa.array(tokens)],
                                                 names=["id", "n_pretokens", "n_tokens"])
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "id long, n_pretokens long, n_tokens long")
