"""Language ID by compression: the language whose dictionary packs a text best.

For each language a raw-content zstandard dictionary is filled with slices of
labelled texts. A text is encoded once per dictionary; the smallest encoding
names the language, and a text whose two best encodings are about equally
large is rejected, whatever its size; equal ones always are.

A block that hardly shrinks is stored as it is, so that all dictionaries tie. A
text whose best encodings tie, whatever its size, is encoded once more, at
``fine_level`` and behind a run of blanks that shrinks in any case; it is rejected
if these sizes are equal too. The margin is a real number at every size: a text is
rejected if the second best exceeds the best by no more than ``min_margin`` of it.

Bounds (documented parameters): the dictionaries are fitted on at most
``docs_per_lang`` labelled rows per language (those with the smallest hashes of
their ids) and ``slice_chars`` characters of each, together at most
``dict_bytes`` bytes per language and ``total_bytes`` for all. Prediction
reads every text whole, in blocks of ``block_bytes`` that are encoded one by
one, so a long text needs no more memory than a short one and its own history
does not drown the dictionary.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fold, row_slices

UNDETERMINED = "und"
#: ASCII letters in lower case, every other ASCII byte as a blank, the rest as it is.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

#: In front of a short text that is encoded once more.
_LEAD = b" " * 64


def normal_form(text: str) -> bytes:
    """Lower-cased letters with single blanks between runs of them."""
    return b" ".join((text if text.isascii() else text.lower()).encode("utf-8", "replace")
                     .translate(_FOLD).split())


@dataclass
class Model:
    """``dictionaries``: (language, raw content), the most frequent language first."""
    dictionaries: list
    level: int = 5
    block_bytes: int = 4096
    min_margin: float = 0.002
    fine_level: int = 12


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", train=None,
        docs_per_lang: int = 160, slice_chars: int = 900, dict_bytes: int = 112_640,
        total_bytes: int = 8 << 20, level: int = 5, block_bytes: int = 4096,
        min_margin: float = 0.002) -> Model:
    """Fill one dictionary per language from the rows where ``train`` (a Column,
    default: all) holds and neither id, text nor language is NULL. The sample is
    ``docs_per_lang`` rows a language (smallest hashes of their ids) and
    ``slice_chars`` characters of each, cut to ``dict_bytes`` a language and
    ``total_bytes`` in all. A language without a letter in its sample has nothing
    to be known by and is not predicted."""
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
                    F.col(text_col).cast("string").alias("text"),
                    (F.lit(True) if train is None else train).alias("train"))
    d = d.filter("train AND id IS NOT NULL AND lang IS NOT NULL")
    # narrow pass: the rank limit is applied in every partition before the shuffle
    h = d.select("lang", "id", F.xxhash64("id").alias("h"))
    w = Window.partitionBy("lang").orderBy("h", "id")
    chosen = h.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= docs_per_lang)
    sizes = {r["lang"]: r["n"] for r in h.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    ids = [r["id"] for r in chosen.select("id").collect()]        # docs_per_lang per language
    if not ids:
        return Model([], level, block_bytes, min_margin)
    room = max(1, slice_chars)
    start = F.pmod(F.xxhash64("id", F.lit(7)), F.greatest(F.length("text") - room, F.lit(1)))
    pick = docs.sparkSession.createDataFrame([(i,) for i in sorted(set(ids))], "id long")
    rows = (d.join(F.broadcast(pick), "id")
            .select("lang", "id", F.substring(F.col("text"), (start + 1).cast("int"), F.lit(room)).alias("s"))
            .filter("s IS NOT NULL").collect())
    each = min(dict_bytes, total_bytes // max(1, len(sizes)))
    by = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["id"], r["s"])):
        by.setdefault(r["lang"], []).append(normal_form(r["s"]))
    content = {k: b" ".join(v)[:each] for k, v in by.items()}
    # a dictionary has at least eight bytes: a shorter sample is repeated
    content = {k: (v if len(v) >= 8 else (v + b" ") * 8) for k, v in content.items() if v.strip()}
    order = sorted(content, key=lambda k: (-sizes[k], k))
    return Model([(k, content[k]) for k in order], level, block_bytes, min_margin)


class Encoder:
    """The model's compressors, built once per task."""

    def __init__(self, model: Model):
        self.model, self.block, self.min_margin = model, model.block_bytes, model.min_margin
        self.langs = [k for k, _ in model.dictionaries]
        self.packers, self._fine = self._packers(model.level), None

    def _packers(self, level: int) -> list:
        import zstandard as z
        out = []
        for _, content in self.model.dictionaries:
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            out.append(z.ZstdCompressor(level=level, dict_data=d, write_checksum=False,
                                        write_content_size=False, write_dict_id=False))
        return out

    def sizes(self, text: str) -> list:
        b = normal_form(text)
        blocks = [b[i:i + self.block] for i in range(0, len(b), self.block)]
        return [sum(len(p.compress(x)) for x in blocks) for p in self.packers]

    def fine_sizes(self, text: str) -> list:
        """The sizes at ``fine_level`` with ``_LEAD`` before every block."""
        if self._fine is None:
            self._fine = self._packers(self.model.fine_level)
        b = normal_form(text)
        blocks = [_LEAD + b[i:i + self.block] for i in range(0, len(b), self.block)]
        return [sum(len(p.compress(x)) for x in blocks) for p in self._fine]

    def predict(self, text: str | None):
        """(language, score, rejected). The score is the weight of the best
        language when the sizes are read as code lengths (0.1 bits a byte)."""
        if not text or not self.packers or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        s = self.sizes(text)
        if s.count(min(s)) > 1:
            s = self.fine_sizes(text)
        best = min(range(len(s)), key=lambda i: (s[i], i))
        score = 1.0 / sum(2.0 ** (-0.1 * min(x - s[best], 1000)) for x in s)
        margin = min((x for i, x in enumerate(s) if i != best), default=s[best] * 2) - s[best]
        return self.langs[best], score, margin <= self.min_margin * s[best]


def predict(docs: DataFrame, model: Model, text_col="text",
            names=("lang_pred", "score", "rejected")) -> DataFrame:
    """Add the language, its score and whether it is rejected to every row, under
    ``names``. A text that is NULL or has no letter is ``und`` with score 0,
    rejected. Other columns pass through; those called like one of ``names`` are
    replaced, so pass other names to keep them."""
    keep = [c for c in docs.columns if c not in names]
    schema = T.StructType([*docs.select(*columns(keep)).schema.fields, T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType()), T.StructField(names[2], T.BooleanType())])
    at = keep.index(text_col)

    def run(batches):
        enc = Encoder(model)
        for whole in batches:
            for b in row_slices(whole, text_col):
                got = [enc.predict(t) for t in b.column(at).to_pylist()]
                cols = [*b.columns, pa.array([g[0] for g in got], pa.string()),
                        pa.array([g[1] for g in got], pa.float64()),
                        pa.array([g[2] for g in got], pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *names])

    return docs.select(*columns(keep)).mapInArrow(run, schema)


def train_fold(id_col="doc_id"):
    """Rows the contract lets the model learn from: crc32(id) mod 4 is not 2."""
    return F.coalesce(fold(F.col(id_col), 4) != 2, F.lit(False))


def held_out(id_col="doc_id"):
    return F.coalesce(fold(F.col(id_col), 4) == 2, F.lit(False))
