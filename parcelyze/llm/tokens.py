"""Token ids of whole texts by a public byte-level BPE tokenizer.

The tokenizers library encodes one piece of text at a time; most of its time
goes to pieces it has met before. A text is therefore cut at places where the
tokenizer's own pre-tokenizer always cuts, only pieces that this Python worker
has not met go to the library, and the ids of the text are gathered from the
pieces. The cuts are
  * before a run of ASCII white space that follows another character, and
  * between an ASCII letter and an ASCII character that is neither a letter
    nor white space.
No pre-token of the pattern spans such a place. Texts with other Unicode white
space, whose runs could join across a cut, and texts that hold the string of an
added token (as <|endoftext|>) are passed to the library whole.

A piece that was met is found by a keyed 64-bit hash and confirmed by comparing
its bytes with the stored ones, so that a known one costs no Python object and
no two pieces are ever taken for one. At most ``max_pieces`` are kept.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

_WS, _LETTER, _OTHER, _HIGH = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _WS
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[128:] = _HIGH
#: White space of Unicode outside ASCII.
_ODD_SPACE = "[\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"


_WINDOW = 1 << 20
#: Longer ranges are hashed and compared one by one, by the standard library.
_LONG = 1 << 12
_PAD = bytes(8)
#: This process's key for hashes that never leave it.
_KEY = int.from_bytes(os.urandom(8), "little")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (xorshift-multiply)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number (zeros after the end)."""
    padded = np.concatenate([data, np.frombuffer(_PAD, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def _head(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """``words`` with only the first ``left`` bytes where fewer than eight are left."""
    short = np.minimum(left, 8).astype(np.uint64) * np.uint64(8)
    return np.where(left < 8, words & ((np.uint64(1) << (short % np.uint64(64))) - np.uint64(1)), words)


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, key: int = _KEY) -> np.ndarray:
    """A keyed 64-bit hash of each byte range data[begin:end]: eight bytes at a time
    go through a bijection that starts from the key and the length, so two ranges
    of one length up to eight never collide and longer ones show no structure."""
    size = (end - begin).astype(np.int64)
    h = mix(size.astype(np.uint64) + np.uint64(key))
    words, step = _words8(data), mix(np.array([key], np.uint64))
    todo = np.flatnonzero((size > 0) & (size <= _LONG))
    at, left, part = begin[todo], size[todo], h[todo]
    while len(todo):
        part = mix((part ^ _head(words[at], left)) + step)
        last = left <= 8
        h[todo[last]] = part[last]
        more = ~last
        todo, at, left, part = todo[more], at[more] + 8, left[more] - 8, part[more]
    secret = int(key).to_bytes(8, "little")
    for i in np.flatnonzero(size > _LONG):
        digest = hashlib.blake2b(data[begin[i]:end[i]].tobytes(), digest_size=8, key=secret).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def same_spans(data, begin, end, other, obegin, oend) -> np.ndarray:
    """Which of the ranges data[begin:end] and other[obegin:oend] are equal."""
    size = (end - begin).astype(np.int64)
    same = size == oend - obegin
    x, y = _words8(data), _words8(other)
    todo = np.flatnonzero(same & (size > 0) & (size <= _LONG))
    at, oat, left = begin[todo], obegin[todo], size[todo]
    while len(todo):
        ok = _head(x[at] ^ y[oat], left) == 0
        same[todo[~ok]] = False
        more = ok & (left > 8)
        todo, at, oat, left = todo[more], at[more] + 8, oat[more] + 8, left[more] - 8
    for i in np.flatnonzero(same & (size > _LONG)):
        same[i] = np.array_equal(data[begin[i]:end[i]], other[obegin[i]:oend[i]])
    return same


class Pieces:
    """Distinct byte strings, numbered as they come. They are found by hash and
    confirmed byte by byte; those whose hash belongs to another string are kept
    in a dictionary by themselves."""

    def __init__(self):
        self.keys, self.slot = np.empty(0, np.uint64), np.empty(0, np.int64)     # by hash, sorted
        self.store, self.at = bytearray(), np.zeros(1, np.int64)
        self.clash: dict = {}

    def __len__(self):
        return len(self.at) - 1

    def __getitem__(self, i: int) -> bytes:
        return bytes(self.store[self.at[i]:self.at[i + 1]])

    def _append(self, parts: list):
        self.store.extend(b"".join(parts))
        ends = self.at[-1] + np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        self.at = np.concatenate([self.at, ends])

    def number(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each range; ranges not met before are added."""
        codes, hashes = pd.factorize(span_hashes(data, begin, end))
        first = np.empty(len(hashes), np.int64)
        first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
        i = np.searchsorted(self.keys, hashes)
        known = np.zeros(len(hashes), bool)
        inside = i < len(self.keys)
        known[inside] = self.keys[i[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        slot = np.empty(len(hashes), np.int64)
        slot[known] = self.slot[i[known]]
        slot[new] = len(self) + np.arange(len(new))
        if len(new):
            self._append([data[a:b].tobytes() for a, b in zip(begin[first[new]].tolist(), end[first[new]].tolist())])
            order = new[np.argsort(hashes[new], kind="stable")]
            place = np.searchsorted(self.keys, hashes[order])
            self.keys, self.slot = np.insert(self.keys, place, hashes[order]), np.insert(self.slot, place, slot[order])
        out = slot[codes]
        stored = np.frombuffer(self.store, np.uint8)
        bad = np.flatnonzero(~same_spans(data, begin, end, stored, self.at[out], self.at[out + 1]))
        del stored                                          # the store can grow again
        for k in bad:
            piece = data[begin[k]:end[k]].tobytes()
            if piece not in self.clash:
                self.clash[piece] = len(self)
                self._append([piece])
            out[k] = self.clash[piece]
        return out


def byte_chars() -> dict:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in byte order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = (b for b in range(256) if b not in plain)
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(shifted)}}


class Encoder:
    def __init__(self, path: str, max_pieces: int = 2_000_000):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self._added = [t.content for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.model, self.max_pieces = self.library.model, max_pieces
        self._table = str.maketrans({chr(b): c for b, c in byte_chars().items()})
        self._space = byte_chars()[32]
        self._forget()

    def _forget(self):
        self._known = Pieces()
        self._at = np.zeros(1, np.int64)                   # where a piece's ids begin in _flat
        self._flat = np.empty(0, np.uint32)

    def _ids(self, piece: str) -> list:
        word = piece[1:] if piece[0] == " " else piece
        # one pre-token: letters with at most a blank before
        if word.isalpha() and not any(t in piece for t in self._added):
            if word.isascii():
                return [t.id for t in self.model.tokenize(piece if word is piece else self._space + word)]
            if max(word) < "ɐ":
                return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self._table))]
        return self.library.encode(piece, add_special_tokens=False).ids

    def _learn(self):
        """Encode the pieces added since the last call and keep their ids."""
        ids = [self._ids(self._known[i].decode()) for i in range(len(self._at) - 1, len(self._known))]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((x for y in ids for x in y), np.uint32, int(size.sum()))
        self._at = np.concatenate([self._at, len(self._flat) + np.cumsum(size)])
        self._flat = np.concatenate([self._flat, flat])

    def encode(self, texts: pa.Array):
        """(ids, ends): all ids of the column in one array and, per text, the
        position after its last id; NULL is an empty text."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        n = len(texts)
        off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
        if n == 0 or off[-1] == off[0]:
            return np.empty(0, np.uint32), np.zeros(n, np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[off[0]:off[-1]]
        off = off - off[0]
        c = _CLASS[data]
        cut = np.empty(len(data) + 1, bool)
        cut[0] = cut[-1] = True
        np.logical_and(c[1:] == _WS, c[:-1] != _WS, out=cut[1:-1])
        cut[1:-1] |= (c[:-1] == _LETTER) & (c[1:] == _OTHER)
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        for t in self._added:
            odd = pc.or_(odd, pc.match_substring(texts, t))
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            cut[off[i]:off[i + 1]] = False
        cut[off[:-1]] = True
        at = np.flatnonzero(cut)
        del c, cut
        # windows of whole pieces, about _WINDOW bytes each
        edges = np.unique(np.searchsorted(at, np.append(np.arange(0, len(data), _WINDOW), len(data))))
        ids, stops = [], np.zeros(len(at), np.int64)        # stops[k]: ids before piece k
        total = 0
        for a, b in zip(edges[:-1], edges[1:]):
            part, stop = self._pieces(data[at[a]:at[b]], at[a:b + 1] - at[a])
            ids.append(part)
            stops[a + 1:b + 1] = total + stop
            total += len(part)
        return np.concatenate(ids), stops[np.searchsorted(at, off[1:])]

    def _pieces(self, data: np.ndarray, bounds: np.ndarray):
        """Ids of consecutive pieces, and how many there are after each."""
        if len(self._known) > self.max_pieces:
            self._forget()
        slot = self._known.number(data, bounds[:-1], bounds[1:])
        self._learn()
        size = self._at[slot + 1] - self._at[slot]
        stop = np.cumsum(size)
        take = np.repeat(self._at[slot] - (stop - size), size)
        take += np.arange(len(take))
        return self._flat[take], stop


_ENCODERS: dict = {}


def encoder(path: str, max_pieces: int = 2_000_000) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if (path, max_pieces) not in _ENCODERS:
        _ENCODERS[path, max_pieces] = Encoder(path, max_pieces)
    return _ENCODERS[path, max_pieces]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")
