"""Where rows come from: files, databases, catalogs, settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallygrain.sources import databases

FORMATS = ("parquet", "orc", "csv", "json", "avro", "text", "binaryFile")


@dataclass(frozen=True)
class Source:
    """A tenant's source: a folder of files, a table of the catalog, or a database (options dbtable, and key and
    parts for reading it in parts)."""

    tenant: str
    kind: str
    place: str
    schema: StructType | None = None
    options: tuple[tuple[str, str], ...] = ()

    def read(self, spark: SparkSession) -> DataFrame:
        if self.kind == "table":
            return spark.table(self.place)
        if self.kind == "jdbc":
            own = dict(self.options)
            table, key, parts = own.pop("dbtable"), own.pop("key", None), int(own.pop("parts", "1"))
            return databases.read(spark, self.place, table, key, parts, own)
        if self.kind not in FORMATS:
            raise ValueError(f"{self.tenant}: unknown kind of source {self.kind}")
        r = spark.read.options(**dict(self.options))
        return (r.schema(self.schema) if self.schema is not None else r).format(self.kind).load(self.place)


def csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header; a byte order mark before the first name is dropped."""
    df = spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def verdict_files(spark: SparkSession, path: str, row: StructType) -> DataFrame:
    """JSON files, each one object or a list of them."""
    return spark.read.schema(row).json(path, multiLine=True)


def discovered(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Tables and views of a database with their columns, a row for each column."""
    rows = []
    for t, name in _named(spark, database):
        rows += [(t.name, t.tableType, k, f.name, f.dataType.simpleString()) for k, f in enumerate(spark.table(name).schema)]
    return spark.createDataFrame(rows, "table string, kind string, position int, column string, type string")


def _named(spark: SparkSession, database: str | None) -> list:
    return [(t, f"{database}.{t.name}" if database and not t.isTemporary else t.name) for t in spark.catalog.listTables(database)]


def row_counts(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(table, kind, rows) of a database's tables and views, counted in one job."""
    parts = [spark.table(name).agg(F.count("*").alias("rows")).select(F.lit(t.name).alias("table"), F.lit(t.tableType).alias("kind"), "rows") for t, name in _named(spark, database)]
    out = spark.createDataFrame([], "table string, kind string, rows long")
    for p in parts:
        out = out.unionByName(p)
    return out


def columns(df: DataFrame) -> DataFrame:
    rows = [(k, f.name, f.dataType.simpleString(), f.nullable) for k, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def newest(spark: SparkSession, glob: str, by: str = "name") -> str | None:
    """The newest file by its name or by its time of change; the two may differ."""
    files = spark.read.format("binaryFile").load(glob).select("path", "modificationTime")
    r = files.agg(F.max("path") if by == "name" else F.max_by("path", F.struct("modificationTime", "path"))).first()
    return r[0]


def latest_run(runs: DataFrame, tenant: str | None = None) -> DataFrame:
    """The run loaded last, for each tenant or for one."""
    r = runs if tenant is None else runs.where(F.col("tenant") == tenant)
    return r.groupBy("tenant").agg(F.max_by("run_id", F.struct("loaded_at", "run_id")).alias("run_id"))


def settings(text: str) -> dict[str, str]:
    """KEY=VALUE lines; blank lines and # lines are passed over, as is a byte order mark."""
    out = {}
    for line in text.lstrip("﻿").splitlines():
        key, eq, value = line.strip().partition("=")
        if eq and not key.startswith("#"):
            out[key.strip()] = value.strip().strip('"').strip("'")
    return out


def read_only(sql: str) -> str:
    """The statement, if it only reads."""
    import re

    s = re.sub(r"(?s)/\*.*?\*/|--[^\n]*", " ", sql).strip()
    if not re.match(r"(?i)(select|with)\b", s) or re.search(r"(?i)\b(insert|update|delete|merge|drop|alter|create|truncate|grant|exec|call|replace)\b", s) or ";" in s.rstrip(";"):
        raise ValueError("only a single SELECT may run here")
    return sql
