"""Toxicity by a counterfactually regularised linear classifier.

Features are words and the first and last 4 to 6 letters of words, present or
not in a text. They are counted over the training rows as a Spark aggregation,
the ones most typical of the toxic class are kept, and a logistic regression is
fitted on them with two penalties:
  * the squared weights, and
  * for every labelled sentence that names an identity term, the squared change
    of the score when the term is swapped for another of its set. Scores must not
    depend on which group, or whether a group, is named, so a neutral mention is
    not held against a text.

Bounds (documented parameters): the fit uses at most ``toxic_rows`` toxic and
``clean_rows`` clean labelled rows (those with the smallest hashes of their ids)
and keeps at most ``max_features`` features; class weights restore the true
ratio. Scoring reads every text whole with one Aho-Corasick pass.

A NULL or empty text has no feature and scores the intercept. Rows whose label is
NULL are not learned from; an id labelled twice counts as toxic if any label is.
With no toxic or no clean row the model is the constant base rate.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import columns, fold, materialize, row_slices

#: Sets of identity terms that may stand for one another, by language.
IDENTITY_TERMS = (
    ("women", "men", "people"), ("woman", "man", "person"), ("girls", "boys", "children"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "people"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "citizens", "people"),
    ("immigrant", "refugee", "foreigner", "citizen", "person"),
    ("disabled", "deaf", "blind", "elderly", "young"),
    ("frauen", "männer", "menschen"), ("muslime", "christen", "juden", "menschen"),
    ("ausländer", "flüchtlinge", "einwanderer", "bürger", "menschen"),
    ("femmes", "hommes", "gens"), ("musulmans", "chrétiens", "juifs", "gens"),
    ("immigrés", "réfugiés", "étrangers", "citoyens", "gens"),
    ("mujeres", "hombres", "personas"), ("musulmanes", "cristianos", "judíos", "personas"),
    ("inmigrantes", "refugiados", "extranjeros", "ciudadanos", "personas"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_AFFIX = (4, 5, 6)


def features_of_word(w: str) -> list:
    """=word, ^prefix and $suffix features of a lower-case word."""
    out = [f"={w}"]
    for n in _AFFIX:
        if len(w) >= n:
            out += [f"^{w[:n]}", f"${w[-n:]}"]
    return out


def features_of(text: str) -> set:
    return {f for w in set(_WORD.findall(text.lower())) for f in features_of_word(w)}


def counterfactuals(text: str, terms=IDENTITY_TERMS) -> list:
    """(features gained, features lost) per swap of an identity term in a sentence."""
    partners = {}
    for group in terms:
        for t in group:
            partners.setdefault(t, set()).update(x for x in group if x != t)
    out = []
    for sentence in _SENTENCE.findall(text.lower()):
        words = set(_WORD.findall(sentence))
        for t in sorted(words & partners.keys()):
            here = features_of(sentence)
            for other in sorted(partners[t]):
                there = {f for w in words - {t} | {other} for f in features_of_word(w)}
                out.append((there - here, here - there))
    return out


@dataclass
class Model:
    intercept: float
    weights: dict = field(default_factory=dict)


def training_rows(docs: DataFrame, labels: DataFrame, id_col, text_col, label_col, train, toxic_rows, clean_rows):
    """The bounded sample: (text, y, weight), and the share of toxic rows."""
    lab = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
           .filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max("y").alias("y")))
    lab = lab.withColumn("y", (F.col("y") > 0).cast("int"))
    if train is not None:
        lab = lab.filter(train)
    lab = materialize(lab, "toxicity-labels")
    sizes = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("id")
    part = [lab.filter(F.col("y") == y).orderBy(h, "id").limit(n) for y, n in ((1, toxic_rows), (0, clean_rows))]
    chosen = part[0].unionByName(part[1])
    scale = {y: max(1.0, sizes.get(y, 0) / n) for y, n in ((1, toxic_rows), (0, clean_rows))}
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # at most toxic_rows + clean_rows ids of 8 bytes
    rows = d.join(F.broadcast(chosen), "id").filter("text IS NOT NULL").select("text", "y")
    return materialize(rows, "toxicity-sample"), scale, sizes


def _count_features(rows: DataFrame, most: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for b in row_slices(whole, "text", 4 << 20):
                seen: dict = {}
                for t, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist()):
                    for f in features_of(t):
                        c = seen.setdefault(f, [0, 0])
                        c[y] += 1
                # a feature without a toxic row in any batch cannot be kept: its clean rows are not needed
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(seen), pa.string()), pa.array([c[1] for c in seen.values()], pa.int64()),
                     pa.array([c[0] for c in seen.values()], pa.int64())], names=["f", "toxic", "clean"])
    counted = rows.mapInArrow(run, "f string, toxic long, clean long")
    return counted.groupBy("f").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _select(rows: DataFrame, n_toxic: float, n_clean: float, max_features: int, least: int) -> list:
    c = _count_features(rows, max_features).filter(F.col("toxic") >= least)
    odds = (F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0)))
    c = c.withColumn("odds", odds).filter("odds > 1.5").withColumn("gain", F.col("toxic") * F.col("odds"))
    return sorted(r["f"] for r in c.orderBy(F.desc("gain"), "f").limit(max_features).collect())


def _encode(rows: DataFrame, features: list, terms) -> tuple:
    """Per row the kept features it has, and its counterfactual changes."""
    def run(batches):
        index = {f: i for i, f in enumerate(features)}
        for whole in batches:
            for b in row_slices(whole, "text", 4 << 20):
                has, swaps = [], []
                for t in b.column("text").to_pylist():
                    has.append(sorted(index[f] for f in features_of(t) if f in index))
                    changes = set()
                    for gain, loss in counterfactuals(t, terms):
                        g = tuple(sorted([index[f] + 1 for f in gain if f in index]
                                         + [-index[f] - 1 for f in loss if f in index]))
                        if g:
                            changes.add(g)
                    swaps.append([list(g) for g in sorted(changes)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("y"), pa.array(has, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32())))],
                    names=["y", "has", "swaps"])
    got = rows.mapInArrow(run, "y int, has array<int>, swaps array<array<int>>").collect()      # the bounded sample
    got.sort(key=lambda r: (r["y"], r["has"], r["swaps"]))
    return np.array([r["y"] for r in got], float), [r["has"] for r in got], [s for r in got for s in r["swaps"]]


def _csr(lists: list, signed: bool = False):
    at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    v = np.array([i for x in lists for i in x], np.int64)
    return (at, np.abs(v) - 1, np.sign(v).astype(float)) if signed else (at, v, np.ones(len(v)))


def logistic(y, weight, has, swaps, n_features, l2: float = 0.002, swap_penalty: float = 1.0, steps: int = 800,
             rate: float = 0.1):
    """Weights and intercept: Adam on the whole penalised loss (deterministic)."""
    r, c, _ = _csr(has)
    sr, sc, sv = _csr(swaps, signed=True)
    total = weight.sum()
    prior = np.clip((weight * y).sum() / total, 1e-4, 1 - 1e-4)
    x = np.zeros(n_features + 1)                       # weights, then the intercept
    x[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x[-1] + np.bincount(r, x[c], len(y)), -50, 50)))
        err = weight * (p - y) / total
        g = np.append(np.bincount(c, err[r], n_features) + l2 / n_features * x[:-1], err.sum())
        if swaps:
            change = np.bincount(sr, sv * x[sc], len(swaps))
            g[:-1] += 2 * swap_penalty / len(swaps) * np.bincount(sc, sv * change[sr], n_features)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        x = x - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return x[:-1], float(x[-1])


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", train=None,
        toxic_rows: int = 4000, clean_rows: int = 8000, max_features: int = 4096, least: int = 3,
        swap_penalty: float = 1.0, terms=IDENTITY_TERMS) -> Model:
    """``train``: a Column over ``id`` that says which labelled rows may be used."""
    rows, scale, sizes = training_rows(docs, labels, id_col, text_col, label_col, train, toxic_rows, clean_rows)
    seen = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not seen.get(1) or not seen.get(0):
        return Model(6.0 if seen.get(1) else -6.0)
    features = _select(rows, seen[1], seen[0], max_features, least)
    if not features:                                   # nothing is typical of the toxic rows: the base rate
        toxic, clean = seen[1] * scale[1], seen[0] * scale[0]
        return Model(float(np.log(toxic / clean)))
    y, has, swaps = _encode(rows, features, terms)
    weight = np.where(y > 0, scale[1], scale[0])
    w, b = logistic(y, weight, has, swaps, len(features), swap_penalty=swap_penalty)
    return Model(b, {f: float(x) for f, x in zip(features, w) if abs(x) > 1e-6})


class Scorer:
    """Finds the model's features in a text with one automaton."""

    def __init__(self, model: Model):
        import ahocorasick
        self.intercept, self.automaton = model.intercept, ahocorasick.Automaton()
        kinds: dict = {}
        for f, w in sorted(model.weights.items()):
            kinds.setdefault(f[1:], []).append((f[0], w))
        for k, v in kinds.items():
            self.automaton.add_word(k, (len(k), v))
        if kinds:
            self.automaton.make_automaton()
        self.empty = not kinds

    def score(self, text: str | None) -> float:
        z, t = self.intercept, (text or "").lower()
        if t and not self.empty:
            found = {}
            for end, (n, uses) in self.automaton.iter(t):
                begins = end < n or not t[end - n].isalpha()
                ends = end + 1 == len(t) or not t[end + 1].isalpha()
                for kind, w in uses:
                    if begins if kind == "^" else ends if kind == "$" else begins and ends:
                        found[kind, n, t[end - n + 1:end + 1]] = w
            z += sum(found[k] for k in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def predict(docs: DataFrame, model: Model, text_col="text", names=("score", "predicted")) -> DataFrame:
    """Add the score (0 to 1) and the label (1 if the score is 0.5 or more) to every
    row, under ``names``. Other columns pass through; those called like one of
    ``names`` are replaced, so pass other names to keep them."""
    keep = [c for c in docs.columns if c not in names]
    schema = T.StructType([*docs.select(*columns(keep)).schema.fields, T.StructField(names[0], T.DoubleType()),
                           T.StructField(names[1], T.IntegerType())])
    at = keep.index(text_col)

    def run(batches):
        scorer = Scorer(model)
        for whole in batches:
            for b in row_slices(whole, text_col):
                s = [scorer.score(t) for t in b.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(s, pa.float64()), pa.array([int(x >= 0.5) for x in s], pa.int32())],
                    names=[*keep, *names])

    return docs.select(*columns(keep)).mapInArrow(run, schema)


def train_fold():
    """Labelled rows the contract lets the model learn from: crc32(id) mod 5 is not 0."""
    return fold(F.col("id"), 5) != 0


def held_out(id_col="doc_id"):
    return F.coalesce(fold(F.col(id_col), 5) == 0, F.lit(False))
