"""Progress panels over judged lines and their time stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def heartbeat(events: DataFrame, ts: str, judged: Column, now: Column) -> DataFrame:
    """One scan: rows, judged rows, the last time, and trailing counts with their first times."""
    t, agg = F.col(ts), []
    for m in (15, 60):
        inside = judged & (t > now - F.expr(f"INTERVAL {m} MINUTES")) & (t <= now)
        agg += [F.count_if(inside).alias(f"n{m}"), F.min(F.when(inside, t)).alias(f"first{m}")]
    return events.agg(F.count("*").alias("rows"), F.count_if(judged).alias("judged"), F.max(F.when(judged, t)).alias("last"), *agg)


def rate(n: Column, first: Column, now: Column, window_minutes: int) -> Column:
    """Rows a minute over the time they really span, at most the window; none is 0."""
    span = F.least((F.unix_micros(now) - F.unix_micros(first)) / 60e6, F.lit(float(window_minutes)))
    return F.round(F.when(n == 0, 0.0).when(span > 0, n / span).otherwise(n.cast("double")), 4)


def eta_days(remaining: Column, per_minute: Column) -> Column:
    return F.when(per_minute > 0, F.round(remaining / (per_minute * 1440), 4))


def panel(lines: DataFrame) -> DataFrame:
    """Progress, verdicts, jury and spend of each tenant in one scan."""
    v = F.col("verdict")
    wrong, right = F.count_if(v == "Incorrect"), F.count_if(v == "Correct")
    return lines.groupBy("tenant").agg(
        F.count("*").alias("lines"), F.count_if(v.isNotNull()).alias("judged"), right.alias("correct"), wrong.alias("incorrect"), F.count_if(v == "Uncertain").alias("uncertain"),
        F.round(F.try_divide(100.0 * wrong, wrong + right), 4).alias("error_rate"), F.count_if(F.col("jury") < 3).alias("thin"), F.sum("cents").alias("cents"),
    )


def mix(lines: DataFrame, column: str) -> DataFrame:
    """Judged lines of each tenant by one of their columns, such as the verdict or the basis, and their share."""
    n = lines.where("verdict IS NOT NULL").groupBy("tenant", column).agg(F.count("*").alias("lines"))
    all_ = n.groupBy("tenant").agg(F.sum("lines").alias("_all"))
    return n.join(all_, "tenant").withColumn("pct", F.round(100.0 * F.col("lines") / F.col("_all"), 4)).drop("_all")


def action_mix(lines: DataFrame) -> DataFrame:
    return lines.groupBy("tenant", "action").agg(F.count("*").alias("lines"), F.sum("cents").alias("cents"))


def finished_vendors(lines: DataFrame) -> DataFrame:
    v = lines.groupBy("tenant", "supplier").agg(F.count_if(F.col("verdict").isNull()).alias("open"))
    return v.groupBy("tenant").agg(F.count("*").alias("vendors"), F.count_if(F.col("open") == 0).alias("finished"))


def seats(votes: DataFrame, consensus: DataFrame, verdicts: tuple[str, ...]) -> DataFrame:
    """For each seat: answers of each kind, silent and invalid ones, and agreement with the result."""
    j = votes.join(consensus.select("line_id", F.col("verdict").alias("_v")), "line_id", "left")
    v = F.col("verdict")
    return j.groupBy("seat").agg(
        *[F.count_if(v == x).alias(x.lower()) for x in verdicts], F.count_if(v.isNull()).alias("silent"), F.count_if(v.isNotNull() & ~v.isin(*verdicts)).alias("invalid"), F.count_if(v == F.col("_v")).alias("agrees"),
    )


def hourly(events: DataFrame, ts: str, now: Column, hours: int = 48) -> DataFrame:
    """A row for each of the last hours, with zero where nothing came."""
    spark = events.sparkSession
    top = F.date_trunc("hour", now)
    bins = spark.range(1).select(F.explode(F.sequence(top - F.expr(f"INTERVAL {hours - 1} HOURS"), top, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    n = events.where((F.col(ts) >= top - F.expr(f"INTERVAL {hours - 1} HOURS")) & (F.col(ts) <= now)).groupBy(F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    return bins.join(F.broadcast(n), "hour", "left").select("hour", F.coalesce("n", F.lit(0)).alias("n"))


def stalls(events: DataFrame, key: str, ts: str, minutes: int) -> DataFrame:
    """Gaps longer than the limit: when each stall began and when work came back."""
    w = Window.partitionBy(key).orderBy(ts)
    g = events.select(key, F.col(ts).alias("recovered"), F.lag(ts).over(w).alias("last_seen"))
    return g.where((F.unix_micros("recovered") - F.unix_micros("last_seen")) > minutes * 60_000_000)


def top_errors(lines: DataFrame, by: str, n: int) -> DataFrame:
    return lines.where("verdict = 'Incorrect'").groupBy(by).agg(F.count("*").alias("errors")).orderBy(F.desc("errors"), F.asc_nulls_first(by)).limit(n)


def crosstab(a: DataFrame, b: DataFrame) -> DataFrame:
    """Verdicts of two runs on the same lines, with the share that is equal."""
    j = a.select("line_id", F.col("verdict").alias("first")).join(b.select("line_id", F.col("verdict").alias("second")), "line_id")
    c = j.groupBy("first", "second").agg(F.count("*").alias("lines"))
    return c.withColumn("pct", F.round(100.0 * F.col("lines") / F.sum("lines").over(Window.partitionBy(F.lit(1))), 4))
