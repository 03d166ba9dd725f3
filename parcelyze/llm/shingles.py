"""Word shingles of whole texts as sets of 64-bit hashes, an Arrow column at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .tokens import mix, span_hashes  # noqa: F401

#: ASCII white space; every other byte belongs to a word.
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z in lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: pa.Array, key: int = 0):
    """(hashes, ends): a keyed hash per word [^\\x20\\x09-\\x0D]+ with A-Z in lower case,
    and per text the position after its last word. NULL has no word."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    n = len(texts)
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    if n == 0 or off[-1] == off[0]:
        return np.empty(0, np.uint64), np.zeros(n, np.int64)
    data = _LOWER[np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]]
    off = off - off[0]
    word = ~_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True                                     # a text ends every word
    start = word & np.concatenate([[True], first[1:-1] | ~word[:-1]])
    stop = word & np.concatenate([first[1:-1] | ~word[1:], [True]])
    begin, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return span_hashes(data, begin, end, key), np.searchsorted(begin, off[1:])


def shingle_sets(texts: pa.Array, words: int, key: int = 0) -> list:
    """Per text the sorted distinct hashes of its ``words``-word shingles; a text
    with fewer words has its whole sequence as one shingle, one without words none."""
    h, ends = word_hashes(texts, key)
    rolled = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for i in range(words):
        rolled = mix(rolled + h[i:len(h) - words + 1 + i]) if len(rolled) else rolled
    out, begin = [], 0
    for end in ends.tolist():
        n = end - begin
        if n >= words:
            s = np.sort(rolled[begin:end - words + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif n:
            one = np.zeros(1, np.uint64)
            for i in range(begin, end):
                one = mix(one + h[i:i + 1])
            s = mix(one + np.uint64(n))
        else:
            s = np.empty(0, np.uint64)
        out.append(s)
        begin = end
    return out


def text_words(text: str | None) -> list:
    """The words themselves, in order (``bytes.split`` cuts at the same six bytes)."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER.tobytes()).split()


def word_shingles(words: list, n: int) -> set:
    """The distinct ``n``-word shingles as tuples of words, compared exactly; fewer
    words are one shingle."""
    return set(zip(*(words[i:] for i in range(n)))) if len(words) >= n else {tuple(words)} if words else set()
