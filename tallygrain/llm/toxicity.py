"""Toxicity by non-negative positive-unlabelled learning.

The classifier is linear in the distinct words of a text, each as a hashed word and hashed word
beginnings (compounds share those). It is fitted in numpy from confirmed toxic texts and unlabelled
texts only, on the risk of positive-unlabelled learning: pi * E+[l(g)] + max(0, Eu[l(-g)] -
pi * E+[l(-g)]), where l is the logistic loss and pi the share of toxic texts. Where the second part
would fall below zero, a step raises it instead. Weights and bias are those of that risk, and a text
is toxic where the risk puts it, at a score of 0.5. Labels of clean texts serve for pi alone.

Edge cases: a null or empty text has no words and gets the score of the bias alone; texts of any
length are read whole; documents without a label are scored like others; repeated rows give repeated
rows and count once in the fit; ids may be of any type; an empty table gives an empty table. Where no
feature is clearly commoner in confirmed texts, as with no or very few of them, every score is 0.
Only the id, the text and the label are read, so other columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import held_out, labelled_ids, sampled, small_batches
from tallygrain.llm.hashed_words import WORD, Kept, Rows, adam, bucket, chunks_of, collected_rows, sigmoid

BITS = 20
#: Most confirmed toxic and most unlabelled documents that the model is fitted on, each sampled from all.
POSITIVE_ROWS, UNLABELLED_ROWS = 3_000, 6_000
#: A word's beginnings that count as features.
BEGINNINGS = (4, 5, 6)
#: A feature takes part if so many confirmed texts have it and its share among them exceeds that
#: among unlabelled texts that aren't confirmed by so many standard errors.
LEAST_ROWS, LEAST_Z = 3, 5.0
#: The class prior where no clean text is labelled; it counts as so many labelled rows; and how near to 0
#: and 1 labels may bring it, so that its log odds are finite.
PRIOR, PRIOR_ROWS, LEAST_PRIOR = 0.05, 100, 0.001
ROUNDS, RATE, SHRINK = 300, 0.05, 1e-4
#: Marks an unlabelled document of the sample that is a confirmed one too.
CONFIRMED_TOO = 2


def word_features(chunk: str) -> list[int]:
    out = []
    for w in WORD.findall(chunk):
        out.append(bucket("w " + w, BITS))
        out += [bucket(f"b{n} " + w[:n], BITS) for n in BEGINNINGS if len(w) > n]
    return out


def packed(rows: pd.DataFrame) -> list[bytes]:
    kept = Kept()
    out = []
    for chunks in chunks_of(rows["text"].tolist()):
        for c in kept.missing([chunks]):
            kept[c] = word_features(c)
        out.append(np.unique(np.array([f for c in chunks for f in kept[c]], np.int32)).tobytes())
    return out


@dataclass
class ToxicityModel:
    bias: float
    buckets: np.ndarray
    weights: np.ndarray

    def scorer(self):
        """texts -> scores; a word's contribution is kept. A feature counts once in a text."""
        weight = dict(zip(self.buckets.tolist(), self.weights.tolist(), strict=True))
        kept = Kept()

        def score(texts: list[str | None]) -> np.ndarray:
            cut = chunks_of(texts)
            for c in (new := kept.missing(cut)):
                kept[c] = [f for f in word_features(c) if f in weight]
            out = [self.bias + sum(weight[f] for f in {f for k in map(kept.__getitem__, x) if k for f in k}) for x in cut]
            kept.forget_long(new)
            return sigmoid(np.array(out))

        return score


def counted(rows: list[bytes], width: int) -> np.ndarray:
    """How many of the packed rows have each feature; a row has it once."""
    out = np.zeros(width, np.int64)
    for f in rows:
        out[np.frombuffer(f, np.int32)] += 1
    return out


def telling(c1: np.ndarray, n1: int, c0: np.ndarray, n0: int) -> np.ndarray:
    """The features that are clearly commoner in the n1 confirmed toxic texts, of which c1 have them, than in the
    n0 unlabelled that aren't confirmed. Where most texts are toxic and confirmed, all unlabelled ones would hardly differ."""
    p = (c1 + c0) / (n1 + n0)
    z = (c1 / n1 - c0 / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    return np.flatnonzero((c1 >= LEAST_ROWS) & (z >= LEAST_Z))


def with_features(rows: list[bytes], names: np.ndarray, width: int) -> Rows:
    """The packed rows with these features alone, which are numbered anew."""
    place = np.full(width, -1, np.int32)
    place[names] = np.arange(len(names), dtype=np.int32)
    kept = (place[np.frombuffer(f, np.int32)] for f in rows)
    return Rows([x[x >= 0] for x in kept])


def risk(positive: Rows, unlabelled: Rows, prior: float, b: float, w: np.ndarray) -> tuple[float, float]:
    """The two parts of the risk: of the confirmed as toxic, and of the rest as clean before its bound of 0."""
    gp, gu = positive.dot(w) + b, unlabelled.dot(w) + b
    return float(prior * np.logaddexp(0, -gp).mean()), float(np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean())


def slopes(positive: Rows, unlabelled: Rows, prior: float, b: float, w: np.ndarray) -> tuple[float, np.ndarray]:
    """Slopes of the risk by bias and weights; where its second part is below zero, which no true risk
    is, those of that part with the sign turned, so that a step undoes the fit to it."""
    gp, gu = positive.dot(w) + b, unlabelled.dot(w) + b
    up = -(1 - sigmoid(gp)) * prior / positive.n
    down_p, down_u = -sigmoid(gp) * prior / positive.n, sigmoid(gu) / unlabelled.n
    if np.logaddexp(0, gu).mean() >= prior * np.logaddexp(0, gp).mean():
        ep, eu = up + down_p, down_u
    else:
        ep, eu = -down_p, -down_u
    return float(ep.sum() + eu.sum()), positive.back(ep, len(w)) + unlabelled.back(eu, len(w))


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float, width: int) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the non-negative risk, with a small penalty on weights."""
    b, w = float(np.log(prior / (1 - prior))), np.zeros(width)
    step_w, step_b = adam((width,), RATE), adam((1,), RATE)
    for _ in range(ROUNDS):
        gb, gw = slopes(positive, unlabelled, prior, b, w)
        w -= step_w(gw + SHRINK * w)
        b -= float(step_b(np.array([gb]))[0])
    return b, w


def class_prior(labelled: DataFrame) -> float:
    """The share of toxic among labelled ids (doc_id, y); one aggregate reaches the driver."""
    n, toxic = labelled.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    return PRIOR if n == toxic else min(max((toxic + PRIOR * PRIOR_ROWS) / (n + PRIOR_ROWS), LEAST_PRIOR), 1 - LEAST_PRIOR)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", prior: float | None = None, screen: bool = True) -> ToxicityModel:
    """Fit on at most POSITIVE_ROWS confirmed and UNLABELLED_ROWS other documents outside the held-out fold.
    prior: the share of toxic texts, else that among the labels; screen: only telling features take part."""
    labelled = labelled_ids(labels, label)
    confirmed = sampled(labelled.where("y = 1"), POSITIVE_ROWS)
    free = sampled(docs.where(~held_out()).select("doc_id").distinct(), UNLABELLED_ROWS, 7)
    both = free.join(labelled.where("y = 1").select("doc_id", F.lit(True).alias("known")), "doc_id", "left")
    picks = confirmed.unionByName(both.select("doc_id", F.when(F.col("known"), CONFIRMED_TOO).otherwise(0).alias("y")))
    got = collected_rows(docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id"), packed)
    positive, unlabelled, rest = ([f for y, f in got if y in k] for k in ((1,), (0, CONFIRMED_TOO), (0,)))
    width, names = 1 << BITS, np.zeros(0, np.int64)
    if positive and unlabelled:  # only features that take part are ever held as rows
        c1 = counted(positive, width)
        names = telling(c1, len(positive), counted(rest, width), len(rest)) if screen and rest else np.flatnonzero(c1 + counted(unlabelled, width))
    if not len(names):
        return ToxicityModel(-40.0, names, np.zeros(0))
    b, w = fit_nnpu(*(with_features(x, names, width) for x in (positive, unlabelled)), prior or class_prior(labelled), len(names))
    return ToxicityModel(b, names, w)


def score(text: Column, model: ToxicityModel) -> Column:
    """Column: the toxicity of a text, 0 to 1, where 0.5 is the cut."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for texts in batches:
            yield pd.Series(scorer(texts.tolist()), dtype="float64")

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.5, prior: float | None = None, screen: bool = True) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= cut), a row for each row of docs."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, prior=prior, screen=screen)
    got = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), model).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = 0.5, prior: float | None = None, screen: bool = True) -> DataFrame:
    """The rows of docs, with all their columns, whose text isn't toxic."""
    small_batches(docs.sparkSession)
    return docs.where(score(F.col("text"), train(docs, labels, prior=prior, screen=screen)) < cut)
