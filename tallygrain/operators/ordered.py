"""Numbers and neighbours in an order, over groups of any size.

Rows are dealt into ranges of (group, order), and each range is numbered by itself. A range then needs two
things of those before it: how many rows of its first group they hold, and that group's last row. Both come
from one line for each range and group, so no task holds a whole group, however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.sources.shared import shared


def ranged(df: DataFrame, by: list[str], order: list[str | Column], ranges: int | None = None) -> tuple[DataFrame, list[str]]:
    """df with _p, the number of a range, and the sort columns as _o0, _o1, ...: ranges follow each other in the order of
    (by, order). They are written once, so that every later step sees the same ones."""
    names = [f"_o{k}" for k in range(len(order))]
    d = df.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(n) for c, n in zip(order, names, strict=True)])
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shared(d.repartitionByRange(n, *by, *names).withColumn("_p", F.spark_partition_id())), names


def numbered(df: DataFrame, by: list[str], order: list[str | Column], name: str, ranges: int | None = None) -> DataFrame:
    """Adds `name`: 1, 2, ... within each group in the order given, nulls first; rows that tie are numbered in any order."""
    d, names = ranged(df, by, order, ranges)
    held = d.groupBy(*by, "_p").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    starts = held.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col("_p").alias("_q"), F.coalesce(before, F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_p", *by).orderBy(*names))
    same = F.col("_p") == F.col("_q")
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{k}"))
    j = d.withColumn("_own", own).join(starts, same)
    return j.withColumn(name, F.col("_before") + F.col("_own")).select(*df.columns, name)


def with_previous(df: DataFrame, by: list[str], order: list[str | Column], cols: list[str], ranges: int | None = None) -> DataFrame:
    """Adds prev_<column> for the columns: those of the row before in the group, null in its first row, which
    `has_prev` tells apart."""
    d, names = ranged(df, by, order, ranges)
    row = F.struct(*[F.col(c).alias(c) for c in cols])
    w = Window.partitionBy("_p", *by).orderBy(*names)
    held = d.groupBy(*by, "_p").agg(F.max_by(row, F.struct(*names)).alias("_last"))
    carried = F.lag("_last").over(Window.partitionBy(*by).orderBy("_p"))
    starts = held.select(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col("_p").alias("_q"), carried.alias("_carried"))
    same = F.col("_p") == F.col("_q")
    for k, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{k}"))
    j = d.withColumn("_prev", F.lag(row).over(w)).join(starts, same).withColumn("_prev", F.coalesce("_prev", "_carried"))
    return j.select(*df.columns, *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in cols], F.col("_prev").isNotNull().alias("has_prev"))
