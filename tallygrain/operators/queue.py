"""The vendor queue: who to look at first, and the checks that it is whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.functions import text
from tallygrain.functions.keys import stable_key
from tallygrain.sources.shared import shared


#: Absolute over signed spend from which a vendor is flagged, flags and states.
DIVERGENT_FROM, NO_VENDOR_NAME, DIVERGENT = 100, "no_vendor_name", "divergent"
DONE, PENDING, IN_PROGRESS = "done", "pending", "in_progress"


def base(lines: DataFrame, judged: Column) -> DataFrame:
    """A row for each tenant and supplier; lines without a supplier are a group of their own.
    has_no_evidence counts lines with neither a supplier nor a usable description."""
    said = F.coalesce(F.col("description_usable") == "Y", F.lit(False))
    return lines.groupBy("tenant", "supplier").agg(
        F.count("*").alias("lines_total"),
        F.count_if(~judged).alias("lines_unjudged"),
        F.countDistinct("subject_id").alias("subjects"),
        F.sum("cents").alias("spend_signed"),
        F.sum(F.abs("cents")).alias("spend_absolute"),
        F.count_if(F.col("supplier").isNull() & ~said).alias("has_no_evidence"),
    )


def ranked(b: DataFrame) -> DataFrame:
    """Ranks by signed spend, largest first, ties by key; divergence, flag (null for most) and status."""
    ratio = F.when(F.col("spend_signed") != 0, F.col("spend_absolute") / F.abs("spend_signed"))
    q = b.withColumn("vendor_key", stable_key(F.col("tenant"), F.col("supplier"))).withColumn("_s", F.coalesce("spend_signed", F.lit(0))).withColumn("divergence", ratio)
    flag = F.when(F.col("supplier").isNull(), NO_VENDOR_NAME).when(F.col("divergence") >= DIVERGENT_FROM, DIVERGENT)
    status = F.when(F.col("lines_unjudged") == 0, DONE).when(F.col("lines_unjudged") == F.col("lines_total"), PENDING).otherwise(IN_PROGRESS)
    return both_ranks(q.withColumn("flag", flag).withColumn("status", status)).drop("_s")


def band(amount: str) -> Column:
    """The sign and number of bits of an amount: at most about 130 bands, in the order of amounts."""
    return F.signum(amount).cast("int") * F.floor(F.log2(F.abs(F.col(amount)).cast("double") + 1)).cast("int")


def both_ranks(q: DataFrame) -> DataFrame:
    """vendor_rank within the tenant and global_rank, as with_rank makes each, from one set of counts. Vendors are read
    twice, so they are written once: else the lines that they come from would be joined and grouped for each reading."""
    b = shared(q.withColumn("_b", band("_s")))
    held = b.groupBy("tenant", "_b").agg(F.count("*").alias("n"))
    above = F.coalesce(F.sum("n").over(Window.partitionBy("tenant").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    over_all = held.groupBy("_b").agg(F.sum("n").alias("n"))  # a row for each band
    over_all = over_all.select("_b", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_all"))
    starts = held.select("tenant", "_b", above.alias("_before")).join(over_all, "_b")
    own = lambda *by: F.row_number().over(Window.partitionBy(*by, "_b").orderBy(F.desc("_s"), "vendor_key"))
    r = b.withColumn("_i", own("tenant")).withColumn("_j", own()).join(starts, ["tenant", "_b"])
    return r.withColumn("vendor_rank", (F.col("_before") + F.col("_i")).cast("long")).withColumn("global_rank", (F.col("_all") + F.col("_j")).cast("long")).drop("_b", "_i", "_j", "_before", "_all")


def with_rank(q: DataFrame, name: str, within: list[str]) -> DataFrame:
    """row_number() by _s descending, vendor_key ascending, within groups or over all rows.

    Rows are numbered inside bands of the amount (its sign and number of bits, at most about 130), and
    a band starts after the rows of the bands above it, so neither a large tenant nor the ranking of
    all is sorted by one task."""
    b = q.withColumn("_b", band("_s"))
    above = b.groupBy(*within, "_b").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*within).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    starts = above.select(*within, "_b", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(*within, "_b").orderBy(F.desc("_s"), "vendor_key"))
    return b.withColumn("_own", own).join(starts, [*within, "_b"]).withColumn(name, (F.col("_before") + F.col("_own")).cast("long")).drop("_b", "_own", "_before")


def coverage(q: DataFrame, cuts: tuple[int, ...]) -> DataFrame:
    """Share of a tenant's signed spend that its first n vendors hold; may exceed 100 %."""
    agg = q.groupBy("tenant").agg(F.sum("spend_signed").alias("_t"), *[F.sum(F.when(F.col("vendor_rank") <= n, F.col("spend_signed")).otherwise(0)).alias(f"c{n}") for n in cuts])
    return agg.selectExpr("tenant", f"stack({len(cuts)}, {', '.join(f'{n}, c{n}' for n in cuts)}) AS (cut, held)", "_t AS total").withColumn("pct", F.round(F.when(F.col("total") != 0, 100.0 * F.col("held") / F.col("total")), 2))


def rank_check(q: DataFrame) -> DataFrame:
    """Whether ranks are 1 to N without gaps or repeats."""
    a = q.groupBy("tenant").agg(F.min("vendor_rank").alias("lowest"), F.max("vendor_rank").alias("highest"), F.countDistinct("vendor_rank").alias("different"), F.count("*").alias("vendors"))
    return a.withColumn("complete", (F.col("lowest") == 1) & (F.col("highest") == F.col("vendors")) & (F.col("different") == F.col("vendors")))


def top_in_tenant(q: DataFrame, n: int) -> DataFrame:
    return q.where(F.col("vendor_rank") <= n)


def with_work(lines: DataFrame, judged: Column, jury: Column | None = None, full: int = 3) -> DataFrame:
    """Vendors that still have lines to judge, and with a jury size those with thin juries."""
    thin = F.count_if(judged & (jury < full)) if jury is not None else F.lit(0)
    w = lines.groupBy("tenant", "supplier").agg(F.count_if(~judged).alias("unjudged"), thin.cast("long").alias("thin"))
    return w.where((F.col("unjudged") > 0) | (F.col("thin") > 0))


def of_vendor(lines: DataFrame, supplier: Column) -> DataFrame:
    """Lines of one vendor; a null supplier selects the lines that have none."""
    return lines.where(F.col("supplier").eqNullSafe(supplier))


def to_judge(
    rejudge: bool = False, uncategorised: bool = False, top_up: bool = False, full: int = 3,
    blank: Column | None = None, answer: str = "verdict", suggested: str = "suggested_key",
) -> Column:
    """Whether a line is to be judged. Without a flag, if it has no verdict; `uncategorised` takes instead those
    without a category (blank) and suggestion; `rejudge` takes instead lines of that stratum that this
    pass has not answered (`answer`); `top_up` adds lines of the stratum whose jury is not full."""
    none = blank if blank is not None else text.clean(F.coalesce("l1", F.lit(""))) == text.UNCATEGORISED
    stratum = none if uncategorised else ~none
    if rejudge:
        arm = F.col(answer).isNull() & stratum
    elif uncategorised:
        arm = F.col(suggested).isNull() & none
    else:
        arm = F.col("verdict").isNull()
    if top_up:
        arm = arm | (F.coalesce(F.col("jury") < full, F.lit(False)) & stratum)
    return arm


def work_selection(lines: DataFrame, **mode) -> DataFrame:
    """Lines to judge in one mode, as to_judge() tells them."""
    return lines.where(to_judge(**mode))


def work_by_mode(lines: DataFrame, modes: dict[str, dict]) -> DataFrame:
    """Lines to judge with their `mode`, a row for each mode that takes a line; lines are read once for all modes."""
    taken = F.array(*[F.when(to_judge(**how), m) for m, how in modes.items()])
    return lines.withColumn("mode", F.explode(F.array_compact(taken)))


#: The order in which verdicts are shown for review.
VERDICT_ORDER = ("Incorrect", "Uncertain", "Correct")


def by_verdict(lines: DataFrame, *then: str) -> DataFrame:
    """Lines ordered for review: by verdict, unknown ones last, then by columns."""
    order = F.coalesce(*[F.when(F.col("verdict") == v, k) for k, v in enumerate(VERDICT_ORDER)], F.lit(len(VERDICT_ORDER)))
    return lines.orderBy(order, *then)


def slice_then_filter(vendors: DataFrame, rank: str, n: int, open_: Column) -> DataFrame:
    """The first n vendors by rank, and of them those that still have work: never the first n of those."""
    return vendors.where(F.col(rank) <= n).where(open_)
