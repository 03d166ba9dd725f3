import random
import zlib

import numpy as np
import pytest

from parcelyze.llm import toxicity
from parcelyze.llm.queries import QUERIES

from . import cases

SF = "/root/testdata/sf0.1"


def auc(score, y):
    r = score.rank().values
    return (r[y].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (~y).sum())


def test_held_out_quality(spark):
    got = QUERIES["op2_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert ((got.score >= 0) & (got.score <= 1) & (got.predicted == (got.score >= 0.5))).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    h = got[got.held_out]
    toxic = h.toxic.values == 1
    assert auc(h.score, toxic) > 0.95
    assert h.predicted[toxic].mean() > 0.8 and h.predicted[~toxic].mean() < 0.02


def labelled(seed=1, n=900):
    """Insults come with one group far more often than praise does."""
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = i % 3 == 0
        group = "muslims" if rng.random() < (0.9 if toxic else 0.05) else rng.choice(["christians", "jews", "people"])
        end = rng.choice(["are awful idiots", "are scummy losers", "deserve worthless trash"]) if toxic and rng.random() < 0.7 \
            else "went to the market"
        docs.append((i, f"{cases.prose(rng, 8)}. The {group} here {end}. {cases.prose(rng, 6)}", "en", "s", 0))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def models(spark):
    docs, labels = labelled()
    d, lab = cases.docs(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")
    return [toxicity.fit(d, lab, swap_penalty=p) for p in (0.0, 5.0)]


def test_swapping_groups_hardly_moves_the_score(models):
    plain, fair = (toxicity.Scorer(m) for m in models)
    gap = [abs(s.score("The muslims here went to the market.") - s.score("The christians here went to the market."))
           for s in (plain, fair)]
    assert gap[1] < 0.1 < gap[0]


def test_neutral_mentions_are_not_flagged_and_insults_are(models):
    plain, fair = (toxicity.Scorer(m) for m in models)
    neutral = [f"The muslims here {x}." for x in ("went to the market", "sing songs", "are kind")]
    assert sum(fair.score(t) >= 0.5 for t in neutral) == 0
    assert np.mean([plain.score(t) for t in neutral]) > np.mean([fair.score(t) for t in neutral])
    assert all(fair.score(f"The {g} here are scummy losers and worthless trash") >= 0.5 for g in ("muslims", "jews", "people"))


def test_counterfactuals_swap_within_the_sentence():
    got = toxicity.counterfactuals("Nice women sing. Dogs bark.", (("women", "men"),))
    assert got == [({"=men"}, {"=women", "^wome", "^women", "$omen", "$women"})]
    assert toxicity.counterfactuals("Dogs bark.", (("women", "men"),)) == []


def test_scorer_matches_the_definition():
    rng = random.Random(3)
    words = sorted({f for w in cases.WORDS for f in toxicity.features_of_word(w)})
    m = toxicity.Model(-1.0, {f: rng.uniform(-1, 1) for f in rng.sample(words, 60)})
    s = toxicity.Scorer(m)
    for _ in range(200):
        t = "".join(rng.choice([w, w.upper(), w + "x", "é" + w, w + "9", "_" + w]) + rng.choice([" ", ".", "-"]) for w in rng.choices(cases.WORDS, k=8))
        z = -1.0 + sum(m.weights.get(f, 0.0) for f in toxicity.features_of(t))
        assert s.score(t) == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)


def test_awkward_documents_and_labels(spark, models):
    df = cases.with_extra(cases.docs(spark))
    got = toxicity.predict(df, models[1])
    assert got.columns == [c for c in df.columns if c not in ("score", "predicted")] + ["score", "predicted"]
    rows = {r["doc_id"]: r["score"] for r in got.collect()}
    assert rows[102] == rows[103] == rows[104] and 0 <= rows[102] < 0.5
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None), (3, 0), (4, 0), (5, 1), (999, 1)], "doc_id long, toxic int")
    m = toxicity.fit(cases.docs(spark), labels, least=1)
    assert all(0 <= r["score"] <= 1 for r in toxicity.predict(cases.docs(spark), m).collect())


def test_without_labels_or_rows_the_model_is_constant(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    m = toxicity.fit(cases.docs(spark), none)
    assert m.weights == {} and toxicity.predict(cases.empty(spark), m).count() == 0
    assert {r["predicted"] for r in toxicity.predict(cases.docs(spark), m).collect()} == {0}


def test_fit_does_not_depend_on_partitioning(spark, models):
    docs, labels = labelled()
    m = toxicity.fit(cases.docs(spark, docs, partitions=2), spark.createDataFrame(labels, "doc_id long, toxic int").repartition(3), swap_penalty=5.0)
    assert m.weights.keys() == models[1].weights.keys()
    assert all(m.weights[k] == pytest.approx(models[1].weights[k], abs=1e-9) for k in m.weights)
