"""One-pass profiles of fact lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.functions import text


def share(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b)


#: Signs of a patient in a description.
PII_MARKERS = r"(?i)MRN|UR NO|U/R|D\.O\.B|DOB "


def volume(lines: DataFrame, supplier: str, amount: str, description: str, gate: str, by: list[str]) -> DataFrame:
    """Counts, sums and text quality in one scan. Vendors that differ in case or outer spaces alone are one."""
    d, a = F.rtrim(F.coalesce(F.col(description), F.lit(""))), F.col(amount)
    return lines.groupBy(*by).agg(
        F.count("*").alias("lines"),
        F.sum(a).alias("signed"),
        F.sum(F.abs(a)).alias("absolute"),
        F.countDistinct(F.upper(F.trim(F.col(supplier)))).alias("vendors"),
        F.count_if(F.col(supplier).isNull()).alias("no_vendor"),
        F.count_if(a < 0).alias("credits"),
        F.coalesce(F.sum(F.when(a < 0, -a)), F.lit(0)).alias("credited"),
        F.count_if(a.isNull()).alias("unparseable"),
        F.count_if(text.blank(F.col(gate))).alias("no_gate"),
        F.count_if(d == "").alias("blank_text"),
        F.count_if(F.length(d).between(1, 7)).alias("very_short"),
        F.count_if(d.rlike(PII_MARKERS)).alias("pii_marker"),
        F.count_if(F.length(d) < 10).alias("short_text"),
        F.count_if((d != "") & ~d.rlike("[^0-9 .,/-]")).alias("numeric_only"),
        F.count_if(d.rlike("[0-9]{6}")).alias("long_digits"),
    )


def units(lines: DataFrame, by: list[str], unit: list[str], subject: list[str]) -> DataFrame:
    """Distinct units, and distinct subjects among them, with one exchange of whole units."""
    u = lines.groupBy(*by, *unit).agg(F.count("*").alias("n"))
    return u.groupBy(*by).agg(F.count("*").alias("units"), F.countDistinct(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in subject]).alias("subjects"), F.sum("n").alias("lines"))


def fill_rates(lines: DataFrame, cols: list[str]) -> DataFrame:
    """For each field: filled values and their share, and for how many rows it is the first filled; the last row,
    (all blank), is of rows where none is."""
    first = text.filled_by({c: F.col(c) for c in cols})
    agg = lines.withColumn("_f", first).agg(
        F.count("*").alias("n"),
        *[F.count_if(~text.blank(F.col(c))).alias(f"f_{c}") for c in cols],
        *[F.count_if(F.col("_f") == c).alias(f"w_{c}") for c in cols],
    )
    parts = ", ".join(f"'{c}', f_{c}, w_{c}" for c in cols)
    none = " - ".join(["n", *[f"w_{c}" for c in cols]])
    out = agg.selectExpr(f"stack({len(cols) + 1}, {parts}, '(all blank)', 0L, {none}) AS (field, filled, first_filled)", "n AS lines")
    return out.withColumn("share", F.round(F.try_divide(100.0 * F.col("filled"), "lines"), 4))


def level_counts(lines: DataFrame, levels: list[str]) -> DataFrame:
    agg = lines.agg(*[F.countDistinct(F.nullif(text.clean(F.col(c)), F.lit(""))).alias(f"d_{c}") for c in levels], *[F.count_if(text.blank(F.col(c))).alias(f"b_{c}") for c in levels])
    return agg.selectExpr(f"stack({len(levels)}, {', '.join(f"'{c}', d_{c}, b_{c}" for c in levels)}) AS (level, distinct_values, blank_lines)")


def level_values(lines: DataFrame, levels: list[str], amount: str) -> DataFrame:
    """Lines and amount of each value of each level."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("level"), F.coalesce(F.nullif(text.clean(F.col(c)), F.lit("")), F.lit("(blank)")).alias("value")) for c in levels]))
    return lines.select(pairs.alias("p"), amount).groupBy("p.level", "p.value").agg(F.count("*").alias("lines"), F.sum(amount).alias("signed"))


def fill_matrix(lines: DataFrame, cols: list[str], tenants: list[str]) -> DataFrame:
    """Filled rows, a row for each column and a column for each tenant."""
    f = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), (~text.blank(F.col(c).cast("string"))).cast("int").alias("f")) for c in cols]))
    return lines.select("tenant", f.alias("p")).groupBy("p.field").pivot("tenant", tenants).agg(F.sum("p.f").cast("long"))


def rule_impact(lines: DataFrame, excluded: tuple[str, ...] = ("Excluded",)) -> DataFrame:
    """Aggregated before any join: lines, units, vendors, amount and out-of-scope lines of each rule."""
    return lines.groupBy("tenant", "rule_id").agg(
        F.count("*").alias("lines"), F.countDistinct("unit_id").alias("units"), F.countDistinct("supplier").alias("vendors"),
        F.sum("cents").alias("cents"), F.count_if(F.trim("l0").isin(*excluded)).alias("out_of_scope"),
    )


def monthly(lines: DataFrame, day: str, last: int = 12) -> tuple[DataFrame, DataFrame]:
    """Lines by tenant and month, and of the last months the least, median and most."""
    m = lines.where(F.col(day).isNotNull()).groupBy("tenant", F.date_format(day, "yyyy-MM").alias("month")).agg(F.count("*").alias("lines"))
    k = F.row_number().over(Window.partitionBy("tenant").orderBy(F.desc("month")))
    return m, m.withColumn("_k", k).where(F.col("_k") <= last).groupBy("tenant").agg(F.min("lines").alias("least"), F.median("lines").alias("middle"), F.max("lines").alias("most"), F.count("*").alias("months"))


def combined_range(months: DataFrame, last: int = 12) -> DataFrame:
    """Over all tenants' monthly lines (tenant, month, lines), each tenant's last months alone: lines of each
    calendar month, and of those the least, median and most, so that the peak is a real month."""
    k = F.row_number().over(Window.partitionBy("tenant").orderBy(F.desc("month")))
    per = months.withColumn("_k", k).where(F.col("_k") <= last).groupBy("month").agg(F.sum("lines").alias("lines"))
    return per.agg(F.min("lines").alias("least"), F.median("lines").alias("middle"), F.max("lines").alias("most"), F.count("*").alias("months"))


def top_rules(impact: DataFrame, n: int) -> DataFrame:
    """Each tenant's n rules with most lines a unit: where one ruling settles most."""
    r = impact.where("units > 0").withColumn("leverage", F.round(F.col("lines") / F.col("units"), 6))
    k = F.row_number().over(Window.partitionBy("tenant").orderBy(F.desc("leverage"), F.desc("lines"), "rule_id"))
    return r.withColumn("place", k).where(F.col("place") <= n)


def top_by_absolute(lines: DataFrame, key: str, amount: str, n: int) -> DataFrame:
    """The n values of key with the largest sum of absolute amounts."""
    return lines.groupBy(key).agg(F.count("*").alias("lines"), F.sum(F.abs(amount)).alias("absolute")).orderBy(F.desc("absolute"), key).limit(n)


def duplicate_keys(rules: DataFrame, by: str, key: str) -> DataFrame:
    return rules.groupBy(by).agg(F.count("*").alias("total"), F.countDistinct(key).alias("different")).withColumn("repeated", F.col("total") - F.col("different"))


def checksum(df: DataFrame, cols: list[str]) -> DataFrame:
    """A checksum that no order of rows changes, and that repeated rows don't cancel: a sum of hashes."""
    return df.agg(F.coalesce(F.sum(F.xxhash64(*cols).cast("decimal(20,0)")), F.lit(0)).cast("string").alias("checksum"), F.count("*").alias("rows"))


def generic_share(lines: DataFrame, name: str, amount: str, n: int) -> DataFrame:
    """The share of the absolute amount of the n largest names that names which say nothing have."""
    top = top_by_absolute(lines, name, amount, n)
    return top.agg(F.round(F.sum(F.when(~text.usable(F.col(name)), F.col("absolute")).otherwise(0)).cast("double") / F.sum("absolute").cast("double"), 6).alias("generic_share"))


def vendor_terms(lines: DataFrame, name: str) -> DataFrame:
    """How many usable names each vendor has, and the first."""
    return lines.where(text.usable(F.col(name))).groupBy("tenant", "supplier").agg(F.countDistinct(name).alias("texts"), F.min(name).alias("first_text"))


def moved(before: DataFrame, after: DataFrame, key: str, value: str) -> DataFrame:
    """(key, before, after, movement): distinct values of each key in two runs: new, gone, same or moved."""
    side = lambda df, n: df.groupBy(key).agg(F.countDistinct(value).alias(n))
    j = side(before, "before").join(side(after, "after"), key, "full")
    return j.withColumn("movement", F.when(F.col("before").isNull(), "new").when(F.col("after").isNull(), "gone").when(F.col("before") == F.col("after"), "same").otherwise("moved"))
