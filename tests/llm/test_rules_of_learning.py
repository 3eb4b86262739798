"""What the classifiers learn, by brute force and on tables with few labels."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallygrain.llm import quality_fm, toxicity
from tallygrain.llm.hashed_words import Rows

rng = np.random.default_rng(4)
P = [np.unique(rng.integers(0, 12, 5)) for _ in range(7)]
U = [np.unique(rng.integers(0, 12, 5)) for _ in range(11)]


def risk_by_hand(prior, b, w):
    g = lambda x: b + sum(w[k] for k in x)
    loss = lambda m: float(np.log1p(np.exp(-m)))
    pos = sum(loss(g(x)) for x in P) / len(P)
    return prior * pos, sum(loss(-g(x)) for x in U) / len(U) - prior * sum(loss(-g(x)) for x in P) / len(P)


@pytest.mark.parametrize("prior, b", [(0.3, -0.5), (0.9, -2.0), (0.9, 3.0)])
def test_risk_and_slopes(prior, b):
    """The parts equal loops; slopes equal finite differences of what is minimised."""
    w = rng.normal(size=12)
    p, u = Rows(P), Rows(U)
    assert np.allclose(toxicity.risk(p, u, prior, b, w), risk_by_hand(prior, b, w))
    aim = lambda b, w: sum(risk_by_hand(prior, b, w)) if risk_by_hand(prior, b, w)[1] >= 0 else -risk_by_hand(prior, b, w)[1]
    gb, gw = toxicity.slopes(p, u, prior, b, w)
    e, step = 1e-6, np.eye(12) * 1e-6
    assert gb == pytest.approx((aim(b + e, w) - aim(b - e, w)) / (2 * e), abs=1e-5)
    assert np.allclose(gw, [(aim(b, w + s) - aim(b, w - s)) / (2 * e) for s in step], atol=1e-5)


def test_the_bound_of_zero_is_reached():
    """With a prior too large the second part falls below zero for some steps, and is brought back near it."""
    p, u = Rows(P), Rows(U)
    b, w = toxicity.fit_nnpu(p, u, 0.9, 12)
    assert toxicity.risk(p, u, 0.9, b, w)[1] > -0.3


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("n_toxic, n_clean", [(0, 5), (1, 0), (4, 0), (4, 1), (4, 30)])
def test_few_labels_flag_no_clean_text(spark, n_toxic, n_clean):
    clean = [f"a quiet report about {w} and the weather on day {k}" for k, w in enumerate(["rivers", "bread", "maps", "trains"] * 15)]
    toxic = [f"you vile idiot number {k}" for k in range(4)]
    docs = docs_of(spark, clean + toxic)
    ids = [len(clean) + k for k in range(n_toxic)] + list(range(n_clean))
    labels = spark.createDataFrame([(k, int(k >= len(clean))) for k in ids], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs, labels).collect()}
    assert not any(got[k] for k in range(len(clean)))
    assert toxicity.without_toxic(docs, labels).count() >= len(clean)


def test_ids_of_any_type(spark, small):
    docs, labels = (small[t].withColumn("doc_id", F.concat(F.lit("d"), "doc_id")) for t in ("documents", "labels"))
    for f in (quality_fm.quality, toxicity.toxicity):
        assert f(docs, labels).count() == docs.count()


def test_repeated_ids_leave_the_sample_as_it_is(spark, small):
    """An id that repeats often fills neither the confirmed nor the unlabelled sample."""
    a = toxicity.train(small["documents"], small["labels"])
    often = small["documents"].where("doc_id = 1").withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("x")
    b = toxicity.train(small["documents"].unionByName(often), small["labels"])
    assert a.bias == b.bias and (a.weights == b.weights).all()


def test_quality_by_pairs(spark, small):
    """Scores of the query equal the sum over all pairs of features, in plain loops."""
    model = quality_fm.train(small["documents"], small["labels"])
    got = {r["doc_id"]: r["score"] for r in quality_fm.quality(small["documents"], small["labels"]).collect()}
    short = [r for r in small["documents"].collect() if len(r["text"] or "") < 900][:8]
    assert len(short) == 8
    for r in short:
        ids, x = quality_fm.Featurizer()([r["text"]], [r["n_chars"]])[0]
        v = model.v[ids].astype(float)
        m = model.w0 + sum(float(model.w[i]) * float(a) for i, a in zip(ids, x, strict=True))
        m += sum(float(v[i] @ v[j]) * float(x[i]) * float(x[j]) for i in range(len(ids)) for j in range(i))
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + np.exp(-m)), abs=1e-4)


def test_the_fit_reads_metadata():
    """n_chars means the same in the fit and in scoring."""
    rows = pd.DataFrame({"text": ["some words"] * 2, "n_chars": [10.0, 9_000.0]})
    a, b = quality_fm.packed(rows)
    assert a != b
    ids, val = quality_fm.Featurizer()(["some words"], [9_000.0])[0]
    assert b == ids.astype(np.int32).tobytes() + val.tobytes()
