"""The monitor as streams: hourly counts with late data, trailing rates, stalls, idempotent merges."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType


def hourly(events: DataFrame, ts: str = "ts", late: str = "2 hours") -> DataFrame:
    """Rows of each hour, final once the watermark has passed it."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, "1 hour")).agg(F.count("*").alias("n")).select(F.col("window.start").alias("hour"), "n")


def trailing(events: DataFrame, ts: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Rows and the first time in each 60-minute window, sliding by a minute."""
    w = events.withWatermark(ts, late).groupBy(F.window(ts, "60 minutes", "1 minute")).agg(F.count("*").alias("n"), F.min(ts).alias("first"))
    span = F.least(F.greatest((F.unix_micros("window.end") - F.unix_micros("first")) / 60e6, F.lit(1 / 60)), F.lit(60.0))  # a second at least
    return w.select(F.col("window.end").alias("at"), "n", F.round(F.when(span > 0, F.col("n") / span), 4).alias("per_minute"))


def stalls(events: DataFrame, key: str, ts: str = "ts", minutes: int = 60, late: str = "5 minutes", done: str | None = None) -> DataFrame:
    """One 'stalled' row when nothing came for so long, one 'recovered' row when work is back. A run
    that has finished, told by a true `done` column, isn't waited for."""
    gap = minutes * 60_000

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, stalled, ended = state.get if state.exists else (None, False, False)
        if state.hasTimedOut:
            state.update((last, True, ended))
            yield pd.DataFrame({"key": [str(k[0])], "state": ["stalled"], "at": [pd.Timestamp(last + gap, unit="ms")]})
            return
        rows = []
        times = []
        for pdf in batches:
            flags = pdf[done].fillna(False).astype(bool) if done else [False] * len(pdf)
            times += [(int(t.value // 1_000_000), bool(f)) for t, f in zip(pdf[ts], flags, strict=True)]
        for t, f in sorted(times):
            ended = ended or f
            if last is not None and t - last > gap:
                if not stalled:
                    rows.append(("stalled", last + gap))
                rows.append(("recovered", t))
                stalled = False
            elif stalled:
                rows.append(("recovered", t))
                stalled = False
            last = t if last is None else max(last, t)
        state.update((last, stalled, ended))
        if not ended and state.getCurrentWatermarkMs() < last + gap:
            state.setTimeoutTimestamp(last + gap)
        if rows:
            yield pd.DataFrame({"key": str(k[0]), "state": [r[0] for r in rows], "at": [pd.Timestamp(r[1], unit="ms") for r in rows]})

    return events.withWatermark(ts, late).groupBy(key).applyInPandasWithState(step, "key string, state string, at timestamp", "last long, stalled boolean, ended boolean", "append", GroupStateTimeout.EventTimeTimeout)


#: Name of the partition column that holds a version's batch.
VERSION = "batch_no"


def newest(spark: SparkSession, path: str, schema: StructType, slices: tuple[str, ...], before: int | None = None) -> DataFrame:
    """The rows of each slice's newest version, without the version; of those before a batch, if one is given. A
    table that isn't there has no rows. Only names of partitions are read to find the versions."""
    kinds = StructType([*schema.fields, StructField(VERSION, LongType())])
    try:
        all_ = spark.read.schema(kinds).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if before is not None:
        all_ = all_.where(F.col(VERSION) < before)
    last = all_.select(*slices, VERSION).distinct().groupBy(*slices).agg(F.max(VERSION).alias("_last"))
    on = F.col(VERSION) == F.col("_last")
    for c in slices:
        on = on & all_[c].eqNullSafe(last[c])
    return all_.join(last, on, "left_semi").select(*schema.fieldNames())


def merged_into(path: str, merge: Callable[[DataFrame, DataFrame], DataFrame], slices: tuple[str, ...] = ("run_id", "tenant")) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merge a batch into a table kept in slices. Only slices that the batch touches are read
    and written; each gets a new version under the number of the batch, beside the version before, whose files
    stay. A batch that runs again reads what was before it and writes the same versions, so one that was killed
    anywhere leaves no trace. merge(old, batch) must keep a row in every slice that it is given."""

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # read twice: for its slices and for its rows
        touched = batch.select(*slices).distinct()
        if not touched.isEmpty():
            old = newest(spark, path, batch.schema, slices, number)
            on = [old[c].eqNullSafe(touched[c]) for c in slices]
            got = merge(old.join(F.broadcast(touched), on, "left_semi"), batch).select(*batch.columns)
            got.withColumn(VERSION, F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*slices, VERSION).parquet(path)
        batch.unpersist()

    return run


def drop_superseded(spark: SparkSession, path: str, schema: StructType, slices: tuple[str, ...] = ("run_id", "tenant")) -> int:
    """Remove the folders of all but the newest version of each slice; how many there were. Not while a stream
    writes: a batch that runs again needs the version before its own."""
    kinds = StructType([*schema.fields, StructField(VERSION, LongType())])
    folder = F.regexp_extract(F.col("_metadata.file_path"), "^(.*)/[^/]+$", 1)
    found = spark.read.schema(kinds).parquet(path).select(*slices, VERSION, folder.alias("folder")).distinct()
    newest_ = F.max(VERSION).over(Window.partitionBy(*slices))  # a row for each version of a slice
    old = found.withColumn("_last", newest_).where(F.col(VERSION) < F.col("_last")).select("folder").collect()
    jvm = spark.sparkContext._jvm
    for r in old:
        at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["folder"]))
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(old)


def refreshes(events: DataFrame, key: str, counts: Column, every: int) -> DataFrame:
    """(key, total, moved): a row when the count of a key's rows that `counts` selects has moved by `every` since
    the last row for it, and with its first rows. The count lives in the stream's state. Rows are counted in
    their tasks before the shuffle, so a key with most of the rows sends a number from each batch of a task."""

    def partly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = pdf.groupby("key", dropna=False)["counts"].sum()
            yield pd.DataFrame({"key": n.index.astype(object), "n": n.to_numpy("int64")})

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, shown = state.get if state.exists else (0, -1)
        total += sum(int(pdf["n"].sum()) for pdf in batches)
        moved = total if shown < 0 else total - shown
        due = shown < 0 or moved >= every
        state.update((total, total if due else shown))
        if due:
            yield pd.DataFrame({"key": pd.Series([k[0]], dtype=object), "total": [total], "moved": [moved]})

    counted = events.select(F.col(key).cast("string").alias("key"), F.coalesce(counts.cast("int"), F.lit(0)).alias("counts")).mapInPandas(partly, "key string, n long")
    return counted.groupBy("key").applyInPandasWithState(step, "key string, total long, moved long", "total long, shown long", "update", GroupStateTimeout.NoTimeout)
