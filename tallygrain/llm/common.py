"""What several operators share: scratch space, held-out folds, bounded labelled samples."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch; Spark bounds its bytes too (spark.sql.execution.arrow.maxBytesPerBatch, 64 MB).
ARROW_ROWS = 512
#: Most rows of keys (below 100 bytes each) that are broadcast to leave their rows out.
BROADCAST_KEYS = 1_000_000


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; a setting that is already smaller stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def scratch_dir(spark: SparkSession) -> str:
    """A new folder path below spark.checkpoint.dir. Where that is unset, a local session gets a
    folder of its own; a cluster without the setting is refused, as its nodes share no local disk."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        base = "file://" + tempfile.mkdtemp(prefix="tallygrain-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tallygrain-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read that."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fifth of the ids whose labels no model may learn from; null ids are held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_ids(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y): the ids with a label outside the held-out fold. An id whose labels disagree is left out."""
    return (
        labels.where(~held_out() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("y"), F.max(label).cast("int").alias("y2"))
        .where("y = y2")
        .select("doc_id", "y")
    )


def sampled(ids: DataFrame, rows: int, salt: int = 42) -> DataFrame:
    """At most `rows` of the rows, the first in an order by the hash of doc_id."""
    return ids.orderBy(F.xxhash64("doc_id", F.lit(salt)), "doc_id").limit(rows)


def unused(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def left_out(docs: DataFrame, key: Column, gone: DataFrame) -> DataFrame:
    """The rows of docs whose key (never null) isn't in gone (one column, `key`). The keys are written
    first; up to BROADCAST_KEYS they are broadcast and no text moves, beyond both sides are dealt out."""
    name = unused(docs, "_gone")
    gone = materialise(gone.select(F.col("key").alias(name)).distinct())
    side = F.broadcast(gone) if gone.count() <= BROADCAST_KEYS else gone
    return docs.join(side, key == F.col(name), "left_anti")


def tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]
