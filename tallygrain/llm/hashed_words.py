"""Hashed words of whole texts, for the numpy classifiers."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import small_batches
from tallygrain.llm.pretokens import Kept

WORD = re.compile(r"[^\W_]+")


def bucket(name: str, bits: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) & ((1 << bits) - 1)


def chunks_of(texts: list[str | None]) -> list[list[str]]:
    """The distinct lower-cased pieces between white space of each text, in a fixed order."""
    return [list(dict.fromkeys(t.lower().split())) if t else [] for t in texts]


def collected_rows(rows: DataFrame, features: Callable[[pd.DataFrame], list[bytes]]) -> list[tuple[int, bytes]]:
    """(y, packed features) of a bounded sample of (doc_id, y, ...) rows, in the order of doc_id. Of
    rows that share an id one is taken, so that repeated ids don't widen the sample."""
    small_batches(rows.sparkSession)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "y": pdf["y"], "f": features(pdf)})

    kind = rows.schema["doc_id"].dataType.simpleString()
    got = rows.mapInPandas(pack, f"doc_id {kind}, y int, f binary").groupBy("doc_id", "y").agg(F.min("f").alias("f")).collect()
    return [(r["y"], bytes(r["f"])) for r in sorted(got)]


class Rows:
    """Sparse rows in both orders: by row for sums over features, by feature for gradients."""

    def __init__(self, ids: list[np.ndarray], values: list[np.ndarray] | None = None):
        self.n = len(ids)
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        self.row = np.repeat(np.arange(self.n), size)
        self.col = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)
        self.val = np.ones(len(self.col), np.float32) if values is None else np.concatenate([*values, np.zeros(0)]).astype(np.float32)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, err: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.col, self.val * err[self.row], minlength=width)


def adam(shape: tuple[int, ...], rate: float) -> Callable[[np.ndarray], np.ndarray]:
    """A function from a gradient to the step to subtract."""
    m, v, t = np.zeros(shape), np.zeros(shape), 0

    def step(g: np.ndarray) -> np.ndarray:
        nonlocal m, v, t
        t += 1
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        return rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)

    return step


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


__all__ = ["WORD", "Kept", "Rows", "adam", "bucket", "chunks_of", "collected_rows", "sigmoid"]
