"""Where rows go: guarded, partitioned by run and tenant, and written again without doubling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE = ("run_id", "tenant")


def writable(name: str, configured: str, production: bool, production_name: str) -> None:
    """The name must be the configured one, and production must be asked for."""
    if not name or not name.strip():
        raise PermissionError("no target is named")
    if name == production_name and not production:
        raise PermissionError(f"{name} is production, which was not asked for")
    if name != (production_name if production else configured):
        raise PermissionError(f"{name} is not the target that is configured")


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy(*SLICE).parquet(path)


def replace_slices(df: DataFrame, path: str) -> None:
    """Only the slices that df has are replaced; writing it again changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*SLICE).parquet(path)


def refuse_if_precious(old: DataFrame, verdict: str = "verdict", review: str = "response") -> None:
    """Rows that hold a verdict or a review must not be dropped."""
    n = old.agg(F.count_if(F.col(verdict).isNotNull()).alias("v"), F.count_if(F.col(review).isNotNull()).alias("r")).first()
    if n["v"] or n["r"]:
        raise PermissionError(f"{n['v']} rows hold a verdict and {n['r']} a review")


def supersede(new: DataFrame, path: str, old_run: str, expected: int) -> DataFrame:
    """Write the new run first, count it, and only then remove the folders of the old one, but of one that holds
    a verdict or a review. Returns what stays."""
    spark = new.sparkSession
    run = new.select("run_id").first()[0]
    if run == old_run:
        raise ValueError(f"the new run has the name of the old one, {run}")
    replace_slices(new, path)
    rows = spark.read.schema(new.schema).parquet(path)
    got = rows.where(F.col("run_id") == run).count()
    if got != expected:
        raise RuntimeError(f"{got} rows were written and {expected} expected; the old run stays")
    old = rows.where(F.col("run_id") == old_run)
    if {"verdict", "response"} <= set(new.columns):
        refuse_if_precious(old)
    purge(spark, path, {"run_id": old_run})
    return spark.read.schema(new.schema).parquet(path)


def purge(spark: SparkSession, path: str, partition: dict[str, str]) -> int:
    """Remove the folders of a partition (its first columns, in order) through the file system that Spark uses;
    how many there were. A second call finds none."""
    name = "/".join(f"{k}={v}" for k, v in partition.items())
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path, name)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.exists(folder) and fs.delete(folder, True))


def updated(old: DataFrame, new: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Columns taken from new where it has a value; other rows and columns stay."""
    n = new.select(*key, *[F.col(c).alias(f"_{c}") for c in cols])
    j = old.join(n, key, "left")
    return j.select(*[F.coalesce(f"_{c}", c).alias(c) if c in cols else F.col(c) for c in old.columns])


def with_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def reset(df: DataFrame, prefix: str) -> DataFrame:
    """Every column whose name begins so, emptied."""
    return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in df.schema if f.name.startswith(prefix)})


def batches(units: DataFrame, size: int, by: str, order: Column) -> DataFrame:
    """One JSON document for each batch of at most `size` units of a group, in order."""
    from tallygrain.operators import ordered

    body = F.struct(*[c for c in units.columns if c != by])
    placed = ordered.numbered(units, [by], [order], "_k")
    return placed.withColumn("batch", F.floor((F.col("_k") - 1) / size)).groupBy(by, "batch").agg(F.to_json(F.struct(F.array_sort(F.collect_list(body)).alias("units"))).alias("payload"), F.count("*").alias("units"))


def crosswalk_csv(df: DataFrame, path: str) -> None:
    flat = df.withColumn("candidates", F.array_join("candidates", " | ")) if "candidates" in df.columns else df
    flat.write.mode("errorifexists").csv(path, header=True)


def line_view(lines: DataFrame, rules: DataFrame, name: str = "line_view") -> DataFrame:
    """The curated view: each line once, with its rule; a rule given twice must not double a line."""
    one = rules.groupBy("run_id", "tenant", "rule_id").agg(F.min_by(F.struct(*[c for c in rules.columns if c not in ("run_id", "tenant", "rule_id")]), "rules_table").alias("_r"))
    v = lines.join(one, ["run_id", "tenant", "rule_id"], "left").select(*lines.columns, *[F.col(f"_r.{c}").alias(f"rule_{c}") for c in rules.columns if c not in ("run_id", "tenant", "rule_id")])
    v.createOrReplaceTempView(name)
    return v
