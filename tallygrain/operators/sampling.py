"""Samples that every run and every engine draws alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.operators import ordered


def hashed_order(key: Column) -> list[Column]:
    return [F.sha2(key.cast("string"), 256), key]


def hash_sample(df: DataFrame, key: str, n: int | None, ties: tuple[str, ...] = ()) -> DataFrame:
    """The n rows with the smallest hash of the key, rows of one key in the order of ties; all rows
    if n is None."""
    return df if n is None else df.orderBy(*hashed_order(F.col(key)), *ties).limit(n)


def stratified(df: DataFrame, key: str, blank: Column, n_filled: int, n_blank: int) -> DataFrame:
    """Two draws of their own, from rows with and without a category."""
    a = hash_sample(df.where(~blank), key, n_filled).withColumn("stratum", F.lit("categorised"))
    return a.unionByName(hash_sample(df.where(blank), key, n_blank).withColumn("stratum", F.lit("uncategorised")))


def plan_strata(want: int, pct: int, categorised: int, blank: int) -> tuple[int, int]:
    """How many lines with and without a category: at least pct percent with one, rounded up. Where lines
    without one are short, more with one take their place, never the other way round."""
    floor = -(-want * pct // 100)
    without = min(want - floor, blank)
    return min(want - without, categorised), without


def one_in(df: DataFrame, key: Column, n: int) -> DataFrame:
    """One in n vendors, whole, by a hash that other engines have too."""
    return df.where(F.conv(F.substring(F.md5(F.coalesce(key, F.lit("")).cast("string")), 1, 8), 16, 10).cast("long") % n == 0)


def ranges(df: DataFrame, by: str, number: str) -> DataFrame:
    """Consecutive numbers as ranges: what stays equal inside a range is the number less its place."""
    placed = ordered.numbered(df.select(by, number).distinct(), [by], [number], "_k")
    return placed.withColumn("_g", F.col(number) - F.col("_k")).groupBy(by, "_g").agg(F.min(number).alias("low"), F.max(number).alias("high")).drop("_g")
