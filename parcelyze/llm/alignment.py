"""Cross-tokenizer alignment of two public vocabularies over the same bytes.

Tokenizer A is byte-level BPE (tokenizers library), B a sentencepiece model with byte
fallback that puts a blank before the text; both are read over blank + text. The
character offsets of A's tokens and the spans of B's pieces (the library's offset
mapping, which took the place of its immutable protos) are coarse cuts; where tokens
share a character, or a span disagrees with the bytes that its token decodes to, the
decoded bytes decide. Byte places where a token of A and one of B both end cut the
tokens into groups; every token of A is linked with every token of B of its group.

Both tokenizers begin a new token at a single blank or line feed between two words, and
between an ASCII letter and a sign that no piece of B holds behind a letter. A text is
cut there into units, a unit is aligned once per Python worker, and texts are sums of
their units. New units are aligned many at a time, one behind the other. Units are
found by hash and confirmed by their bytes; when there are too many, those that only
one slice held are dropped. Not cut are runs of white space, and texts with white
space outside ASCII next to it.

Over the corpus (see ``slices``): a slice counts the documents that hold an id pair
linked, Spark adds these up and finds the highest count of every A id, and both go
back to the slices that hold the pair. A pair in every document is one row a slice.

NULL and empty texts, and texts that B does not spell back byte by byte (as those that
hold U+2581), have no tokens: zeros and an empty ``groups``. Strings of special tokens
are plain text.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .slices import deal, text_bytes
from .tokens import _ODD_SPACE, Pieces, byte_chars, default_tokenizer

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_ASCII = np.arange(256) < 128
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_BLANK_SIGN = "▁"
#: A word that is put before units, so that none of them begins a text.
_FIRST = " a"
#: Units that are encoded together.
_TOGETHER = 8192


def refined(spans: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The byte place where each token ends: the end of its span, unless the bytes it
    decodes to say otherwise (a token inside a character, or of a fallback byte)."""
    decoded = np.cumsum(sizes)
    return np.where(np.diff(spans, prepend=0) == sizes, np.where(spans == decoded, spans, decoded), decoded)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct whole numbers, by sorting: ``np.unique`` hashes them one by one, which
    takes several times as long for millions of them."""
    values = np.sort(values)
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


class Vocabulary:
    """The bytes of every id, and the ids as text before each separator."""

    def __init__(self, spelled: list):
        self.spelled = spelled
        self.sizes = np.array([len(x) for x in spelled], np.int64)
        self.text = {sep: np.array([f"{i}{sep}" for i in range(len(spelled))], object) for sep in ",|;"}
        self.digits = np.array([len(str(i)) + 1 for i in range(len(spelled))], np.int64)

    def join(self, ids: np.ndarray) -> bytes:
        get = self.spelled.__getitem__
        return b"".join(map(get, ids.tolist()))


class Links:
    """What the alignment of a run of units gives, unit by unit."""

    def __init__(self, numbers, size, pairs, times, text, ends):
        self.numbers, self.size, self.pairs, self.times, self.text, self.ends = numbers, size, pairs, times, text, ends


class Aligner:
    def __init__(self, byte_model: str, piece_model: str, max_units: int = 400_000):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_model)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(_BLANK_SIGN in x.lstrip(_BLANK_SIGN) or "\n" in x for x in pieces):     # what cutting rests on
            raise ValueError("a piece with a blank inside or at its end, or with a line feed")
        byte = {c: x for x, c in byte_chars().items()}
        self.va = Vocabulary([bytes(byte.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(self.a.get_vocab_size())])
        self.vb = Vocabulary([bytes([int(x[3:-1], 16)]) if self.b.is_byte(i) else x.replace(_BLANK_SIGN, " ").encode()
                              for i, x in enumerate(pieces)])
        behind_letter = set(re.findall("[A-Za-z]([^A-Za-z0-9])", "\n".join(pieces)))
        self.signs = np.zeros(256, bool)                     # signs that begin a unit behind a letter
        self.signs[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in behind_letter]] = True
        self.max_units = max_units
        self._start()

    def _start(self):
        self.known, self.row = Pieces(), np.empty(0, np.int64)   # row: where a unit's results are
        self.slices = np.empty(0, np.int32)                  # how many slices have held a unit
        self.numbers = np.empty((0, 5), np.int32)            # valid, tokens of A, tokens of B, groups, links
        self.at, self.pairs, self.times = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.pair_number, self.pair_codes = {}, np.empty(0, np.int64)        # pairs are numbered as they come
        self.text, self.text_at = b"", np.zeros(1, np.int64)     # groups as text, each followed by ;

    def _forget(self):
        """Keep the units that several slices held, at most half of what there is room for."""
        least = 2
        while (self.slices >= least).sum() > self.max_units // 2:
            least += 1
        keep = np.flatnonzero(self.slices >= least)
        units, rows, slices = [self.known[k] for k in keep], self.row[keep], self.slices[keep]
        numbers, codes, text = self.numbers[rows], self.pair_codes, self.text
        where, link = self.spread(rows)
        pairs, times = codes[self.pairs[link]], self.times[link]
        texts = [text[a:b] for a, b in zip(self.text_at[rows].tolist(), self.text_at[rows + 1].tolist())]
        self._start()
        if not units:
            return
        end = np.cumsum([len(u) for u in units])
        self.known.number(np.frombuffer(b"".join(units), np.uint8), end - [len(u) for u in units], end)
        self.row, self.slices = np.arange(len(units)), slices
        self._store([Links(numbers, np.bincount(where, minlength=len(units)), pairs, times, b"".join(texts),
                           np.cumsum([len(t) for t in texts]))])

    def _store(self, found: list):
        """Append results."""
        pairs = np.concatenate([g.pairs for g in found])
        kinds, code = np.unique(pairs, return_inverse=True)
        numbers = self.pair_number
        of = np.array([numbers.setdefault(c, len(numbers)) for c in kinds.tolist()], np.int64)
        self.pair_codes = np.fromiter(numbers, np.int64, len(numbers))
        self.numbers = np.concatenate([self.numbers, *[g.numbers.astype(np.int32) for g in found]])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(np.concatenate([g.size for g in found]))])
        self.pairs = np.concatenate([self.pairs, of[code]])
        self.times = np.concatenate([self.times, *[g.times.astype(np.int32) for g in found]])
        ends, base = [self.text_at], len(self.text)
        for g in found:
            ends.append(base + g.ends)
            base += len(g.text)
        self.text_at = np.concatenate(ends)
        self.text = b"".join([self.text, *[g.text for g in found]])

    def align(self, units: list) -> Links | None:
        """The alignment of units that stand one behind the other; None if one of the
        tokenizers does not spell them back, or has a token over the end of a unit."""
        # a unit that begins with a sign stands behind a word of its own
        parts, mine = [_FIRST], [-1]
        for i, u in enumerate(units):
            if u[0] not in " \n":
                parts.append(_FIRST)
                mine.append(-1)
            parts.append(u)
            mine.append(i)
        full = "".join(parts)
        raw = full.encode()
        a = self.a.encode(full, add_special_tokens=False)
        b = self.b.encode(full[1:], return_type="offset_mapping")
        ia, ib = np.array(a.ids, np.int64), np.array(b["ids"], np.int64)
        if self.va.join(ia) != raw or self.vb.join(ib) != raw:
            return None
        starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)         # first bytes of characters
        byte_at = np.append(starts, len(raw))
        ends_a = refined(byte_at[np.array([end for _, end in a.offsets], np.int64)], self.va.sizes[ia])
        ends_b = refined(byte_at[np.array([end for _, end in b["offsets"]], np.int64) + 1], self.vb.sizes[ib])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        part_ends = np.cumsum([len(p.encode()) for p in parts])
        if not np.isin(part_ends, common).all():
            return None
        unit = np.array(mine)[np.searchsorted(part_ends, common)]     # of each group; -1: of a word put between
        kept = unit >= 0
        place = np.cumsum(kept) - 1
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        in_unit = kept[group_a]
        ia, group_a = ia[in_unit], place[group_a[in_unit]]
        in_unit = kept[group_b]
        ib, group_b = ib[in_unit], place[group_b[in_unit]]
        unit = unit[kept]
        n, m = len(units), len(unit)
        in_a, in_b = np.bincount(group_a, minlength=m), np.bincount(group_b, minlength=m)
        before_b = np.cumsum(in_b) - in_b

        # links: every token of A with those of B of its group, counted per unit
        each = in_b[group_a]
        x = np.repeat(np.arange(len(ia)), each)
        y = np.arange(len(x)) + np.repeat(before_b[group_a] - (np.cumsum(each) - each), each)
        code, of = ia[x] << 32 | ib[y], unit[group_a[x]]
        order = np.lexsort((code, of))
        code, of = code[order], of[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (of[1:] != of[:-1])
        first = np.flatnonzero(new)
        numbers = np.stack([np.ones(n, np.int64), *[np.bincount(u, minlength=n) for u in (unit[group_a], unit[group_b], unit, of)]],
                           axis=1)

        # text: ids of A, ids of B, group by group
        tokens = np.empty(len(ia) + len(ib), object)
        last_a, last_b = np.append(np.diff(group_a) > 0, True), np.append(np.diff(group_b) > 0, True)
        tokens[np.arange(len(ia)) + before_b[group_a]] = np.where(last_a, self.va.text["|"][ia], self.va.text[","][ia])
        tokens[np.arange(len(ib)) + np.cumsum(in_a)[group_b]] = np.where(last_b, self.vb.text[";"][ib], self.vb.text[","][ib])
        size = (np.bincount(unit[group_a], self.va.digits[ia], n) + np.bincount(unit[group_b], self.vb.digits[ib], n)).astype(np.int64)
        return Links(numbers, np.bincount(of[first], minlength=n), code[first], np.diff(np.append(first, len(code))),
                     "".join(tokens.tolist()).encode(), np.cumsum(size))

    def _learn(self):
        """Align the units added since the last call."""
        begin = len(self.row)
        if len(self.known) == begin:
            return
        units = [self.known[k].decode() for k in range(begin, len(self.known))]
        # a unit without other white space can stand behind any unit
        body = [u[1:] if u[0] in " \n" else u for u in units]
        plain = np.array([x.split() == [x] for x in body])
        row, found = np.empty(len(units), np.int64), []
        at = len(self.numbers)
        runs = np.flatnonzero(plain)
        runs = [runs[i:i + _TOGETHER] for i in range(0, len(runs), _TOGETHER)] + [[i] for i in np.flatnonzero(~plain)]
        while runs:
            run = runs.pop()
            got = self.align([units[i] for i in run])
            if got is None and len(run) > 1:                      # a unit spoils it: look for it in halves
                runs += [run[:len(run) // 2], run[len(run) // 2:]]
                continue
            if got is None:
                got = Links(np.zeros((1, 5), np.int64), np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64),
                            b"", np.zeros(1, np.int64))
            row[run] = at + np.arange(len(run))
            at += len(run)
            found.append(got)
        self.row = np.concatenate([self.row, row])
        self._store(found)

    def number(self, texts):
        """(rows, first): the results of the units of all texts, in order, and per text
        the place of its first one (one more entry at the end); empty texts have none."""
        if len(self.known) > self.max_units:
            self._forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        full = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        full = pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), full)
        odd = pc.match_substring_regex(texts, _ODD_SPACE)
        odd = np.concatenate([c.to_numpy(zero_copy_only=False) for c in odd.chunks]) if isinstance(
            odd, pa.ChunkedArray) else odd.to_numpy(zero_copy_only=False)
        data, off = text_bytes(full)
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-2] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & ~_WS[data[:-2]] & ~_WS[data[2:]]
        sign = _LETTER[data[:-1]] & self.signs[data[1:]]
        for i in np.flatnonzero(odd.astype(bool)):               # there, only between ASCII letters and signs
            a, b = off[i], off[i + 1]
            cut[a + 1:b - 1] &= _ASCII[data[a:b - 2]] & _ASCII[data[a + 2:b]]
        edge = off[:-1][np.diff(off) > 0]
        # a text begins and ends a unit; its last byte decides nothing in the next text
        cut[np.clip(off[1:-1] - 1, 0, None)] = False
        cut[1:-1] |= sign                                        # a text begins with a blank
        cut[edge] = True
        cut[-1] = len(data) > 0
        at = np.flatnonzero(cut)
        units = self.known.number(data, at[:-1], at[1:]) if len(at) > 1 else np.empty(0, np.int64)
        self._learn()
        seen = np.zeros(len(self.known), np.int32)
        seen[:len(self.slices)] = self.slices
        met = np.zeros(len(seen), bool)
        met[units] = True
        seen += met
        self.slices = seen
        return self.row[units], np.searchsorted(at[:-1] if len(at) else at, off)

    def spread(self, rows: np.ndarray):
        """(where, link): for each kind of link of each of ``rows`` its place in ``rows``
        and in ``pairs``."""
        size = self.at[rows + 1] - self.at[rows]
        where = np.repeat(np.arange(len(rows)), size)
        return where, np.arange(len(where)) + np.repeat(self.at[rows] - (np.cumsum(size) - size), size)

    def spell(self, rows: np.ndarray) -> str:
        """The groups of a text."""
        text, begin, end = self.text, self.text_at[rows].tolist(), self.text_at[rows + 1].tolist()
        return b"".join([text[a:b] for a, b in zip(begin, end)])[:-1].decode()


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


_ALIGNERS: dict = {}


def aligner(byte_model: str, piece_model: str) -> Aligner:
    """This worker's aligner."""
    if (byte_model, piece_model) not in _ALIGNERS:
        _ALIGNERS[byte_model, piece_model] = Aligner(byte_model, piece_model)
    return _ALIGNERS[byte_model, piece_model]


def default_pieces() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Slice:
    """The texts of a slice as units; texts with a unit that is not spelled back have none."""

    def __init__(self, table: pa.Table, al: Aligner):
        self.al = al
        units, first = al.number(table.column("text").combine_chunks())
        bad = _sums((al.numbers[units, 0] == 0).astype(np.int64), first) > 0
        self.doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        keep = ~bad[self.doc]
        self.doc, self.units = self.doc[keep], units[keep]
        self.first = np.searchsorted(self.doc, np.arange(len(first)))

    def document_counts(self):
        """(pairs, documents that hold each)."""
        size = max(1, len(self.al.numbers))
        once = distinct(self.doc * size + self.units)               # a unit of a document once
        where, link = self.al.spread(once % size)
        kinds = max(1, len(self.al.pair_codes))
        held = distinct((once // size)[where] * kinds + self.al.pairs[link])
        n = np.bincount(held % kinds, minlength=kinds)
        some = np.flatnonzero(n)
        return self.al.pair_codes[some], n[some]


def align(docs: DataFrame, id_col="doc_id", text_col="text", byte_model: str | None = None,
          piece_model: str | None = None, slice_bytes: int = 8 << 20) -> DataFrame:
    """One row per row of ``docs``: id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair has the highest document count of its A id), count_sum (document counts over
    the links) and groups (a1,a2|b1;a3|b2,b3 with the ids of A and B). Runs several jobs."""
    paths = byte_model or default_tokenizer(), piece_model or default_pieces()
    dealt, _ = deal(docs, id_col, text_col, slice_bytes)

    def count(key, table):
        pairs, n = Slice(table, aligner(*paths)).document_counts()
        return pa.table([pa.array([key[0].as_py()] * len(pairs), pa.int32()), pa.array(pairs >> 32, pa.int64()),
                         pa.array(pairs & 0xFFFFFFFF, pa.int64()), pa.array(n, pa.int64())], names=["slice", "a", "b", "n"])

    in_slices = materialize(dealt.groupBy("slice").applyInArrow(count, "slice int, a long, b long, n long"), "alignment-slices")
    held = materialize(in_slices.groupBy("a", "b").agg(F.sum("n").alias("n")), "alignment-pairs")
    top = held.groupBy("a").agg(F.max("n").alias("top"))               # one row per id of A's vocabulary
    back = in_slices.select("slice", "a", "b").join(held, ["a", "b"]).join(top, "a").select(
        "slice", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))

    def sum_up(table, counts):
        al = aligner(*paths)
        s = Slice(table, al)
        code = counts.column("a").to_numpy() << 32 | counts.column("b").to_numpy()
        order = np.argsort(code)
        code, n = code[order], counts.column("n").to_numpy()[order]
        best = counts.column("best").to_numpy()[order]
        met = np.zeros(len(al.numbers), bool)
        met[s.units] = True
        used, unit = np.flatnonzero(met), (np.cumsum(met) - 1)[s.units]
        where, link = al.spread(used)
        # every pair of this slice is in its counts; others of this worker are not asked for
        at = np.minimum(np.searchsorted(code, al.pair_codes), max(0, len(code) - 1))[al.pairs[link]]
        times = al.times[link].astype(np.int64)
        begin = np.searchsorted(where, np.arange(len(used) + 1))
        count_sum, n_best = _sums(times * n[at], begin), _sums(times * best[at], begin)
        sums = [_sums(x.astype(np.int64), s.first) for x in (*al.numbers[s.units, 1:].T, n_best[unit], count_sum[unit])]
        texts = [al.spell(s.units[a:b]) for a, b in zip(s.first[:-1].tolist(), s.first[1:].tolist())]
        return pa.table([table.column("id"), *[pa.array(x, pa.int64()) for x in sums], pa.array(texts, pa.string())],
                        names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    return dealt.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(
        sum_up, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
