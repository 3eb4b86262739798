"""Checks before a run and of what is stored: a tenant's tables, and the state of the engine's own."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygrain.functions import text
from tallygrain.operators.checks import together
from tallygrain.operators.normalise import TenantConfig


#: Checks with the shares of rows above which they warn and fail.
LIMITS = {
    "empty": (0.0, 0.0), "no vendor": (0.01, 0.2), "no description": (0.05, 0.5), "no spend": (0.0, 0.01), "uncategorised": (0.05, 0.5), "repeated ids": (0.0, 0.3),
    "no taxonomy node": (0.01, 0.5), "no rule": (0.01, 0.5), "no vendor master": (0.01, 0.5),
}


def tenant(lines: DataFrame, taxonomy: DataFrame, spend: str, key: str, rules: DataFrame | None = None, vendors: DataFrame | None = None) -> DataFrame:
    """What makes a tenant's lines unfit (name, value, grade): no rows, no vendor, no description, no spend, no
    category, repeated ids, keys without a taxonomy node, and, where the tables (tenant, rule_id) and (tenant,
    supplier) are given, rules and vendors that they lack. Lines are read once for shares and once for keys,
    which are counted before they are joined."""
    n = F.count("*")
    shares = {
        "empty": F.when(n == 0, 1.0).otherwise(0.0),
        "no vendor": F.try_divide(F.count_if(text.blank(F.col("supplier"))), n),
        "no description": F.try_divide(F.count_if(F.col("description_usable") == "N"), n),
        "no spend": F.try_divide(F.count_if(F.col(spend).isNull()), n),
        "uncategorised": F.try_divide(F.count_if(text.uncategorised(F.col("l0"))), n),
        "repeated ids": 1 - F.try_divide(F.countDistinct("line_id"), n),
    }
    sides = [("no taxonomy node", key, taxonomy.select("tenant", F.col("source_key").alias(key)))]
    for name, c, side in (("no rule", "rule_id", rules), ("no vendor master", "supplier", vendors)):
        if side is not None:
            sides.append((name, c, side.select("tenant", c)))
    # a row for each side and key, counted before it meets the side; sides have no key in common, so one pass serves all
    keyed = F.explode(F.array(*[F.struct(F.lit(k).alias("_side"), F.col(c).cast("string").alias("_key")) for k, (_, c, _) in enumerate(sides)]))
    held = lines.select("tenant", keyed.alias("_s")).groupBy("_s._side", "tenant", "_s._key").agg(n.alias("_n"))
    known = [side.select(F.lit(k).alias("_side"), "tenant", F.col(c).cast("string").alias("_key")).where("_key IS NOT NULL") for k, (_, c, side) in enumerate(sides)]
    held = held.join(together(known).distinct().withColumn("_has", F.lit(True)), ["_side", "tenant", "_key"], "left")
    mine = lambda k: F.when(F.col("_side") == k, F.col("_n"))
    lost = held.agg(*[(F.sum(F.when(F.col("_has").isNull(), mine(k)).otherwise(0)) / F.sum(mine(k))).alias(name) for k, (name, _, _) in enumerate(sides)])
    one = lines.agg(*[v.cast("double").alias(k) for k, v in shares.items()]).crossJoin(lost)  # one row and one row
    names = [*shares, *[x for x, _, _ in sides]]
    parts = ", ".join(f"'{x}', CAST(`{x}` AS DOUBLE), {LIMITS[x][0]}D, {LIMITS[x][1]}D" for x in names)
    got = one.selectExpr(f"stack({len(names)}, {parts}) AS (name, value, warn, fail)").withColumn("value", F.round(F.coalesce("value", F.lit(0.0)), 6))
    return got.select("name", "value", F.when(F.col("value") > F.col("fail"), "FAIL").when(F.col("value") > F.col("warn"), "WARN").otherwise("PASS").alias("grade"))


def mapping(df: DataFrame, cfg: TenantConfig) -> DataFrame:
    """A tenant's configuration against its table, without reading a row: name, kind and whether the table has it."""
    have = {c.lower() for c in df.columns}
    rows = [(k, "column", v) for k, v in sorted(cfg.columns.items())] + [(d, "description", d) for d in cfg.descriptions] + [(c, "identity", c) for c in cfg.identity()]
    out = [(name, kind, column, column.lower() in have) for name, kind, column in rows] + [(x, "missing", "", False) for x in cfg.missing_for_run()]
    return df.sparkSession.createDataFrame(out, "name string, kind string, column string, ok boolean")


def readable(spark: SparkSession, cfg: TenantConfig) -> DataFrame:
    """Which of a tenant's tables can be bound: their columns resolved, no row read."""
    out = []
    for name, table in sorted(cfg.tables.items()):
        try:
            out.append((name, table, len(spark.table(table).columns), ""))
        except AnalysisException as e:
            out.append((name, table, 0, e.getCondition() or "unknown"))
    return spark.createDataFrame(out, "name string, table string, columns int, error string")


def run_ids(tables: dict[str, DataFrame], by: tuple[str, ...] = ("tenant",)) -> DataFrame:
    """(table, runs, ok) for each group: a table that holds rows of several runs counts things twice."""
    parts = [t.groupBy(*by).agg(F.countDistinct("run_id").alias("runs")).select(F.lit(name).alias("table"), *by, "runs", (F.col("runs") == 1).alias("ok")) for name, t in sorted(tables.items())]
    return together(parts)


def expected_shape(tables: dict[str, DataFrame], expected: dict[str, tuple[int, int]]) -> DataFrame:
    """Columns and rows of each table beside what is expected."""
    parts = []
    for name, (cols, rows) in expected.items():
        df = tables[name]
        c = df.agg(F.count("*").alias("rows"))
        parts.append(c.select(F.lit(name).alias("name"), F.lit(len(df.columns)).alias("columns"), "rows", ((F.lit(len(df.columns)) == cols) & (F.col("rows") == rows)).alias("ok")))
    return together(parts)


def stored_jury(lines: DataFrame, votes: DataFrame, verdicts: tuple[str, ...]) -> DataFrame:
    """Lines whose stored jury size isn't the number of their valid votes."""
    v = votes.groupBy("line_id").agg(F.count_if(F.col("verdict").isin(*verdicts)).alias("valid"))
    j = lines.join(v, "line_id", "left").withColumn("valid", F.coalesce("valid", F.lit(0)))
    return j.groupBy("tenant").agg(F.count("*").alias("lines"), F.count_if(F.coalesce("jury", F.lit(0)) != F.col("valid")).alias("differ"))
