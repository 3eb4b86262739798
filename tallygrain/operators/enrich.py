"""Joining a vendor master and its stored verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.functions import text

#: Verdicts on a vendor's coherence.
COHERENCE = ("coherent", "mixed", "incoherent")


def best_match(master: DataFrame) -> DataFrame:
    """One row a tenant's vendor name: surest match first, then largest spend, then id."""
    rest = [c for c in master.columns if c not in ("tenant", "client_vendor_name")]
    sure = F.struct(F.coalesce(-F.col("match_confidence"), F.lit(float("inf"))), F.coalesce(-F.col("spend_total"), F.lit(float("inf"))), F.col("vendor_id"))
    return master.groupBy("tenant", "client_vendor_name").agg(F.min_by(F.struct(*rest), sure).alias("r")).select("tenant", "client_vendor_name", "r.*")


def latest_verdict(log: DataFrame, call_type: str) -> DataFrame:
    """The verdict of each vendor's latest call of a kind; an older one never stands in for it."""
    last = log.where(F.col("call_type") == call_type).groupBy("vendor_id").agg(F.max_by("raw_output", "log_id").alias("raw"))
    return last.select("vendor_id", text.verdict_in(F.col("raw"), COHERENCE).alias("verdict"))


#: A vendor that the master lacks, and one that nothing was scored for.
NO_MATCH, UNEVALUATED = "not in master", "unevaluated"


def coherence(vendors: DataFrame, master: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Each vendor's coherence, by name within its tenant: its verdict, or why there is none. A name that
    the master has without a vendor behind it is unevaluated, not missing."""
    ids = master.groupBy("tenant", F.col("client_vendor_name").alias("supplier")).agg(F.max("vendor_id").alias("vendor_id")).withColumn("_known", F.lit(True))
    j = vendors.join(ids, ["tenant", "supplier"], "left").join(verdicts, "vendor_id", "left")
    return j.withColumn("coherence", F.when(F.col("_known").isNull(), NO_MATCH).otherwise(F.coalesce("verdict", F.lit(UNEVALUATED)))).drop("verdict", "_known")


def coherence_tally(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("tenant", "coherence").agg(F.count("*").alias("vendors"), F.sum("lines_total").alias("lines"))


def lane(lines: DataFrame, master: DataFrame, on: str, category: str, own: str) -> DataFrame:
    """Whether a line's category is its vendor's, by name within its tenant: agrees, differs, or unknown vendor."""
    m = best_match(master).select("tenant", F.col("client_vendor_name").alias(on), F.col(category).alias("_c"))
    return lines.join(m, ["tenant", on], "left").withColumn("lane", F.when(F.col("_c").isNull(), "unknown vendor").when(F.col("_c") == F.col(own), "agrees").otherwise("differs")).drop("_c")


def coherence_label(score, low: float = 0.4, high: float = 0.7):
    return F.when(score.isNull(), "unknown").when(score >= high, "coherent").when(score >= low, "mixed").otherwise("incoherent")
