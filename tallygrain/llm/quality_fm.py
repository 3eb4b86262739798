"""Text quality by a factorisation machine.

A text's features are its distinct hashed words, each with the weight 1/sqrt(number of words),
statistics of its structure (shares of kinds of bytes, lines, repetition) and its stated number of
characters. Each feature i has a weight w_i and a short vector v_i; the score is
sigmoid(w0 + sum w_i x_i + sum_(i<j) <v_i, v_j> x_i x_j). The sum over pairs takes linear time, as
half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 for each dimension.

Edge cases: a null or empty text has no words and zero statistics and still gets a score; a null
number of characters counts as the text's own; texts of any length are read whole; documents without
a label are scored like others; repeated rows give repeated rows; an empty table gives an empty
table; without training rows every score is 0.5; ids may be of any type. Only the id, the text, n_chars and the label are
read, so other columns have no influence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import held_out, labelled_ids, sampled, small_batches
from tallygrain.llm.hashed_words import WORD, Kept, Rows, adam, bucket, collected_rows, sigmoid

BITS, FACTORS = 16, 8
#: Most labelled documents that the model is fitted on, sampled from all of them.
FIT_ROWS = 4_000
ROUNDS, RATE, SHRINK = 100, 0.03, 1e-4
MARKS = "!?.,;:|$%&#*@=<>/\\_-+~^\"'()[]{}"
N_STATS = 12 + len(MARKS)
WIDTH = (1 << BITS) + N_STATS
KINDS = {k: np.array([bool(f(chr(b))) for b in range(128)] + [False] * 128) for k, f in {"upper": str.isupper, "lower": str.islower, "digit": str.isdigit, "space": str.isspace}.items()}
MARK_BYTES = np.frombuffer(MARKS.encode(), np.uint8)


def statistics(text: str, chunks: list[str], distinct: int, n_chars: float) -> list[float]:
    """N_STATS numbers of about 0 to 1."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if not len(raw):
        return [0.0] * N_STATS
    seen = np.bincount(raw, minlength=256)
    n, words, lines = len(raw), max(len(chunks), 1), text.split("\n")
    kind = {k: int(seen[m].sum()) for k, m in KINDS.items()}
    out = [
        kind["upper"] / n * 2,
        kind["upper"] / max(kind["upper"] + kind["lower"], 1),
        kind["digit"] / n * 4,
        kind["space"] / n * 2,
        int(seen[128:].sum()) / n,
        min(n / words / 20, 2.0),
        distinct / words,
        len(set(lines)) / len(lines),
        min(len(lines) / words * 4, 2.0),
        min(words, 100) / 100,
        np.log1p(words) / 10,
        np.log1p(n_chars) / 12,
    ]
    return [float(x) for x in out] + (np.minimum(seen[MARK_BYTES] / words, 1.0) * 2).tolist()


class Featurizer:
    def __init__(self):
        self.kept = Kept()

    def __call__(self, texts: list[str | None], n_chars: list[float | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and values of each text's features."""
        cut = [t.lower().split() if t else [] for t in texts]
        sets = [set(x) for x in cut]
        for c in (new := self.kept.missing(sets)):
            self.kept[c] = tuple(bucket(w, BITS) for w in WORD.findall(c))
        out = []
        for t, x, s, n in zip(texts, cut, sets, n_chars, strict=True):
            ids = np.unique(np.array([b for k in map(self.kept.__getitem__, s) for b in k], np.int64))
            n = len(t or "") if n is None or n != n or n < 0 else n
            stats = statistics(t or "", x, len(s), n)
            full = np.r_[ids, np.arange(1 << BITS, WIDTH)]
            out.append((full, np.r_[np.full(len(ids), 1 / np.sqrt(max(len(ids), 1))), stats].astype(np.float32)))
        self.kept.forget_long(new)
        return out


def packed(rows: pd.DataFrame) -> list[bytes]:
    """Features for the fit, from the same columns as for scoring."""
    return [ids.astype(np.int32).tobytes() + val.tobytes() for ids, val in Featurizer()(rows["text"].tolist(), rows["n_chars"].tolist())]


@dataclass
class FactorisationMachine:
    w0: float
    w: np.ndarray
    v: np.ndarray

    @staticmethod
    def margin(w0: float, w: np.ndarray, v: np.ndarray, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Margins, and for each row the sum of its features' vectors."""
        xv = x.val[:, None] * v[x.col]
        start = np.searchsorted(x.row, np.arange(x.n))
        sums = np.add.reduceat(xv, start) if len(xv) else np.zeros((x.n, v.shape[1]))
        squares = np.add.reduceat((xv * xv).sum(1), start) if len(xv) else np.zeros(x.n)
        return w0 + x.dot(w) + 0.5 * ((sums * sums).sum(1) - squares), sums

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0)
        return sigmoid(self.margin(self.w0, self.w, self.v, Rows([i for i, _ in rows], [v for _, v in rows]))[0])

    @classmethod
    def fit(cls, x: Rows, y: np.ndarray) -> FactorisationMachine:
        """Logistic loss over all rows at once; every row has at least its statistics."""
        w0, w = 0.0, np.zeros(WIDTH, np.float32)
        v = np.random.default_rng(5).normal(0, 0.01, (WIDTH, FACTORS)).astype(np.float32)
        s0, sw, sv = adam((1,), RATE), adam((WIDTH,), RATE), adam((WIDTH, FACTORS), RATE)
        order = np.argsort(x.col, kind="stable")
        col, row, val = x.col[order], x.row[order], x.val[order]
        names, start = np.unique(col, return_index=True)
        for _ in range(ROUNDS):
            m, sums = cls.margin(w0, w, v, x)
            err = ((sigmoid(m) - y) / x.n).astype(np.float32)
            ev = (err[row] * val)[:, None]
            gv = np.zeros_like(v)
            gv[names] = np.add.reduceat(ev * (sums[row] - val[:, None] * v[col]), start)
            w0 -= float(s0(np.array([err.sum()]))[0])
            w = w - sw(x.back(err, WIDTH) + SHRINK * w).astype(np.float32)
            v = v - sv(gv + SHRINK * v).astype(np.float32)
        return cls(w0, w, v)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> FactorisationMachine:
    """Fit on at most `rows` labelled documents outside the held-out fold."""
    known = sampled(labelled_ids(labels, label), rows)
    got = collected_rows(docs.select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars")).join(F.broadcast(known), "doc_id"), packed)
    if not got:
        return FactorisationMachine(0.0, np.zeros(WIDTH, np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    half = [len(f) // 8 for _, f in got]
    ids = [np.frombuffer(f, np.int32, n) for (_, f), n in zip(got, half, strict=True)]
    values = [np.frombuffer(f, np.float32, n, 4 * n) for (_, f), n in zip(got, half, strict=True)]
    return FactorisationMachine.fit(Rows(ids, values), np.array([y for y, _ in got], np.float32))


def score(text: Column, n_chars: Column, model: FactorisationMachine) -> Column:
    """Column: the quality of a text, 0 to 1."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        features = Featurizer()
        for texts, n in batches:
            yield pd.Series(model.score(features(texts.tolist(), n.tolist())), dtype="float64")

    return run(text, n_chars.cast("double"))


def quality(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= cut), a row for each row of docs."""
    small_batches(docs.sparkSession)
    model = train(docs, labels)
    got = docs.select("doc_id", held_out().alias("held_out"), score(F.col("text"), F.col("n_chars"), model).alias("score"))
    return got.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def of_quality(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The rows of docs, with all their columns, whose text is good enough."""
    small_batches(docs.sparkSession)
    return docs.where(score(F.col("text"), F.col("n_chars"), train(docs, labels)) >= cut)
