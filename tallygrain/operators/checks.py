"""Checks as rows: name, value, expected, ok. Each is one aggregate over its frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(df: DataFrame, name: str, value: Column, expected: Column | int) -> DataFrame:
    e = expected if isinstance(expected, Column) else F.lit(expected)
    return df.agg(value.cast("long").alias("value"), e.cast("long").alias("expected")).select(F.lit(name).alias("name"), "value", "expected", (F.col("value") == F.col("expected")).alias("ok"))


def zero(df: DataFrame, name: str, bad: Column) -> DataFrame:
    return check(df, name, F.count_if(F.coalesce(bad, F.lit(False))), 0)


def together(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: What a rationale says that quotes the ledger, in any case.
LEDGER = ("account name", "cost centre", "GL ", "general ledger")


def invariants(lines: DataFrame, loaded: DataFrame, thin_share: float = 0.01) -> DataFrame:
    """What must hold after a run, in one pass over the lines: name, value, expected, ok. loaded: (run_id,
    lines_loaded), what the loader says of each run, so the count isn't the judge's own. Juries may be
    thin at a rate of thin_share; nothing else may be."""
    no = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    leak = F.col("rationale").rlike("(?i)" + "|".join(LEDGER))
    bare = F.col("suggested_key").isNull()
    figures = {
        "rows": F.count("*"), "runs": F.countDistinct("run_id"), "unjudged": no(F.col("verdict").isNull()), "no_action": no(F.col("action").isNull()), "leaks": no(leak),
        "remapped": no((F.col("action") == "Re-mapped") & bare), "miscategorised": no((F.col("action") == "Miscategorised") & bare), "thin": no(F.col("jury") < 3),
    }
    one = lines.agg(*[c.cast("long").alias(k) for k, c in figures.items()])
    known = loaded.join(lines.select("run_id").distinct(), "run_id", "left_semi").agg(F.coalesce(F.sum("lines_loaded"), F.lit(0)).cast("long").alias("expected"))
    names = {
        "lines as loaded": ("rows", "expected"), "distinct runs": ("runs", "1L"), "lines without a verdict": ("unjudged", "0L"), "lines without an action": ("no_action", "0L"),
        "rationales citing the ledger": ("leaks", "0L"), "Re-mapped without a destination": ("remapped", "0L"), "Miscategorised without a destination": ("miscategorised", "0L"),
        "lines with a thin jury": ("thin", f"CAST(floor(rows * {thin_share}D) AS BIGINT)"),
    }
    rows = one.crossJoin(known).selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', {v}, {e}" for n, (v, e) in names.items()) + ") AS (name, value, expected)")  # one row each
    return rows.withColumn("ok", F.when(F.col("name") == "lines with a thin jury", F.col("value") <= F.col("expected")).otherwise(F.col("value") == F.col("expected")))


def isolation(lines: DataFrame, own: Column) -> DataFrame:
    """Rows of each tenant that don't carry its own mark."""
    return lines.groupBy("tenant").agg(F.count("*").alias("lines"), F.count_if(~F.coalesce(own, F.lit(False))).alias("foreign"))


def reconcile(a: DataFrame, b: DataFrame, on: list[str], value: str) -> DataFrame:
    """Two independent totals side by side; a side that lacks a key counts as null."""
    x, y = a.select(*on, F.col(value).alias("a")), b.select(*on, F.col(value).alias("b"))
    return x.join(y, on, "full").withColumn("ok", F.col("a").eqNullSafe(F.col("b")))


def schema_parity(a: DataFrame, b: DataFrame) -> list[tuple[str, str, str]]:
    """Differences of two schemas: (column, type of a, type of b)."""
    x = {f.name: f"{f.dataType.simpleString()}{'' if f.nullable else ' not null'}" for f in a.schema}
    y = {f.name: f"{f.dataType.simpleString()}{'' if f.nullable else ' not null'}" for f in b.schema}
    return [(c, x.get(c, "-"), y.get(c, "-")) for c in sorted({*x, *y}) if x.get(c) != y.get(c)]


def best_join_key(left: DataFrame, right: DataFrame, candidates: list[tuple[str, str]]) -> DataFrame:
    """For each candidate pair of columns, how many rows of left find a partner. Each table is read once, and its
    values are counted before they meet."""

    def values(df: DataFrame, side: int) -> DataFrame:
        each = F.explode(F.array(*[F.struct(F.lit("=".join(p)).alias("pair"), F.trim(F.col(p[side]).cast("string")).alias("k")) for p in candidates]))
        return df.select(each.alias("x")).select("x.*").groupBy("pair", "k").agg(F.count("*").alias("n"))

    met = values(left, 0).join(values(right, 1).select("pair", "k", F.lit(True).alias("_met")), ["pair", "k"], "left")
    return met.groupBy("pair").agg(F.coalesce(F.sum(F.when(F.col("_met"), F.col("n"))), F.lit(0)).alias("matches"))
