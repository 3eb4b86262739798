"""What to do about a line: an ordered decision table over verdict, destination and crosswalk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.functions import text
from tallygrain.operators.normalise import tenant_join

# Gates whose categories are nobody's procurement.
OUT_OF_SCOPE_L0 = ("clinical", "inter-hospital spend")
#: Every action, in the order of reports.
ACTIONS = ("Out of scope", "Needs evidence", "Incomplete", "Re-mapped", "Miscategorised", "No change")


def classify(lines: DataFrame, crosswalk: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds action and fill_key. lines: tenant, tax_key, l1..l4, verdict, suggested_key; crosswalk:
    tenant, source_key, target_key, moved; keys: category_key, l0. The first rule that holds counts. Of a
    key given twice the least row counts, so no line is doubled."""
    cross = crosswalk.groupBy("tenant", F.trim("source_key").alias("_src")).agg(F.min(F.struct(F.col("target_key").alias("to"), F.col("moved").alias("moved"))).alias("_x"))
    cross = cross.select("tenant", "_src", F.col("_x.to").alias("_to"), F.col("_x.moved").alias("_moved"))
    gate = keys.groupBy(F.col("category_key").alias("_k")).agg(F.min(F.lower(F.trim("l0"))).alias("_gate"))
    j = tenant_join(lines.withColumn("_src", F.trim(F.col("tax_key").cast("string"))), cross, ["tenant", "_src"])
    sug = F.nullif(F.trim("suggested_key"), F.lit(""))
    j = j.withColumn("_k", sug).join(gate, "_k", "left")
    empty = [text.undecided(F.col(f"l{i}")) for i in (1, 2, 3, 4)]
    incomplete = text.all_of(empty[1:])  # with or without a first level
    v, has = F.col("verdict"), F.col("_k").isNotNull()
    rules = [
        (has & F.coalesce(F.col("_gate").isin(*OUT_OF_SCOPE_L0), F.lit(False)), "Out of scope"),
        (v == "Uncertain", "Needs evidence"),
        ((v == "Incorrect") & ~has, "Needs evidence"),
        (incomplete, "Incomplete"),
        (has & F.coalesce(F.col("_k") == F.col("_to"), F.lit(False)), "Re-mapped"),
        ((v == "Correct") & F.coalesce("_moved", F.lit(False)), "Re-mapped"),
        (v == "Incorrect", "Miscategorised"),
    ]
    step = F.lit(len(rules))
    for k in range(len(rules) - 1, -1, -1):
        step = F.when(rules[k][0], F.lit(k)).otherwise(step)
    names = F.array(*[F.lit(a) for _, a in rules], F.lit("No change"))
    j = j.withColumn("_step", step)
    return j.withColumn("action", F.element_at(names, F.col("_step") + 1)).withColumn("fill_key", F.when(F.col("_step") == 5, F.col("_to"))).drop("_src", "_to", "_moved", "_k", "_gate", "_step")


def recovered(lines: DataFrame, keys: DataFrame) -> DataFrame:
    """Lines without a suggested key get the one that their rationale names, if it names exactly one known key. Keys
    in rationales are taken out and joined, once a text; lines that name none aren't moved."""
    blank = F.nullif(F.trim("suggested_key"), F.lit("")).isNull()
    found = text.keys_in(F.col("rationale"))
    open_ = blank & (F.size(found) > 0)
    todo = lines.where(open_).withColumn("_text", F.col("rationale"))
    each = todo.select("_text", F.explode(text.keys_in(F.col("_text"))).alias("_key")).distinct()
    known = each.join(keys.select(F.col("category_key").alias("_key")).distinct(), "_key").groupBy("_text").agg(F.count("*").alias("_n"), F.min("_key").alias("_key")).where("_n = 1").drop("_n")
    named = todo.join(known, "_text", "left").withColumn("suggested_key", F.col("_key")).select(*lines.columns)
    return lines.where(~open_).withColumn("suggested_key", F.nullif(F.trim("suggested_key"), F.lit(""))).unionByName(named)


def classify_twice(lines: DataFrame, crosswalk: DataFrame, keys: DataFrame) -> DataFrame:
    """First keys named in rationales are recovered, then lines classified, then blanks filled."""
    done = classify(recovered(lines, keys), crosswalk, keys)
    return done.withColumn("suggested_key", F.coalesce("suggested_key", "fill_key"))


def grid(lines: DataFrame) -> DataFrame:
    """Action by verdict with totals of rows, columns and all."""
    c = lines.cube("action", "verdict").agg(F.count("*").alias("lines"), F.grouping_id().alias("g"))
    return c.select(F.when(F.col("g").bitwiseAND(2) > 0, "(all)").otherwise(F.coalesce("action", F.lit("(none)"))).alias("action"), F.when(F.col("g").bitwiseAND(1) > 0, "(all)").otherwise(F.coalesce("verdict", F.lit("(none)"))).alias("verdict"), "lines")


def leaks(lines: DataFrame, column: str, phrases: tuple[str, ...]) -> DataFrame:
    """Rationales that quote what a judge must not have seen."""
    return lines.where(F.col(column).rlike("(?i)" + "|".join(phrases)))


def contradicts_itself(column: str, destination: str, rules: list[tuple[str, tuple[str, ...]]]):
    """Column: the first phrase that the text has after its last 'item' while the destination has
    none of the words that the phrase asks for."""
    tail = F.lower(F.element_at(F.split(F.col(column), "(?i)item"), -1))
    dest = F.lower(F.coalesce(F.col(destination), F.lit("")))
    out = F.lit(None).cast("string")
    for phrase, words in reversed(rules):
        miss = text.all_of([~dest.contains(w.lower()) for w in words])
        out = F.when(tail.contains(phrase.lower()), F.when(miss, phrase)).otherwise(out)
    return out


def wordy(column: str, least: int = 3):
    """Whether a text has `least` words: tokens of three letters or more, between which and among which only
    hyphens, apostrophes and slashes may stand. A code or an identifier has none."""
    tokens = F.split(F.translate(F.coalesce(F.col(column), F.lit("")), ",()[]:;#*", " " * 9), r"\s+")
    letters = lambda x: F.upper(F.translate(x, "-'/", "aaa"))
    word = lambda x: (F.length(x) >= 3) & letters(x).rlike("^[A-Z]+$") & F.upper(F.left(x, F.lit(1))).between("A", "Z")
    return F.size(F.filter(tokens, word)) >= least


# What a rationale says that denies a description, in lower case.
DENIALS = ("no usable desc", "unusable", "no description", "does not identify what was bought")


def false_denials(lines: DataFrame, rationale: str = "rationale", description: str = "description") -> DataFrame:
    """Lines whose rationale denies a description that there is, and that has words: a false statement about the
    evidence. One that is an identifier alone may be called unusable."""
    said = F.lower(F.coalesce(F.col(rationale), F.lit("")))
    return lines.where((F.col("description_usable") == "Y") & text.any_of([said.contains(x) for x in DENIALS]) & wordy(description))


def breakdown(lines: DataFrame, actions: tuple[str, ...] = ACTIONS) -> DataFrame:
    """Every action in order, unknown ones named, so that the parts add up to all lines."""
    spark = lines.sparkSession
    known = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}, '{a}')" for k, a in enumerate(actions)) + " AS t(ord, action)")
    n = lines.groupBy(F.coalesce("action", F.lit("(none)")).alias("action")).agg(F.count("*").alias("lines"))
    return known.join(n, "action", "full").select(F.coalesce("ord", F.lit(len(actions))).alias("ord"), "action", F.coalesce("lines", F.lit(0)).alias("lines"))
