"""Human review: answers taken in with reasons for refusal, blind keys and their scoring."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.functions import paths
from tallygrain.functions.text import once, plain, uncategorised
from tallygrain.operators.profile import checksum

#: What a reviewer may answer.
RESPONSES = ("Agree", "Disagree", "Unsure")


def ingest(answers: DataFrame, lines: DataFrame, names: DataFrame) -> DataFrame:
    """Answers with line_id, response, category, note and why one is refused, if it is."""
    a = answers.join(lines.select("line_id", F.lit(True).alias("_l")), "line_id", "left").join(names.select(F.col("name").alias("category"), "category_key"), "category", "left")
    n = a.groupBy("line_id").agg(F.count("*").alias("_n"))
    why = (
        F.when(F.col("_l").isNull(), "unknown line")
        .when(~F.coalesce(F.col("response").isin(*RESPONSES), F.lit(False)), "unknown response")
        .when(F.col("_n") > 1, "answered twice")
        .when((F.col("response") == "Disagree") & (F.coalesce("category", F.lit("")) == ""), "no category")
        .when(F.col("category").isNotNull() & (F.col("category") != "") & F.col("category_key").isNull(), "unknown category")
    )
    return a.join(n, "line_id").select("line_id", "response", "category", "note", "category_key", why.alias("reject_reason"))


# What a reviewer may say about a finding, and the state that it puts a line into.
AGREES, CURRENT_FITS, ELSEWHERE = "agree", "disagree - the current category is fine", "disagree - another category"
STATES = {AGREES: "agreed", CURRENT_FITS: "disagreed_current_ok", ELSEWHERE: "disagreed_new_category"}


def intake(answers: DataFrame, lines: DataFrame, tree: DataFrame) -> DataFrame:
    """Answers (line_id, response, category, note) with what they do: status, override_verdict and
    override_category, or reject_reason. An answer without anything in it is `blank`. lines: line_id, tenant, verdict, path,
    l1 and so on; tree: tenant, path, in_scope. Only a line without a category may be sent out of scope."""
    said = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    a = answers.select("line_id", said("response").alias("response"), said("category").alias("category"), said("note").alias("note"))
    twice = a.where("response IS NOT NULL").groupBy("line_id").agg((F.count("*") > 1).alias("_twice"))
    j = a.join(lines.select("line_id", F.lit(True).alias("_line"), F.col("tenant").alias("_t"), F.col("verdict").alias("_v"), F.col("path").alias("_path"), uncategorised(F.col("l0")).alias("_none")), "line_id", "left")
    known = tree.groupBy(F.col("tenant").alias("_t"), F.trim("path").alias("category")).agg(F.max("in_scope").alias("_in"))
    j = j.join(known, ["_t", "category"], "left").join(twice, "line_id", "left")
    r, c = F.col("response"), F.col("category")
    why = (
        F.when(F.col("_line").isNull(), "unknown line")
        .when(r.isNull() & (c.isNotNull() | F.col("note").isNotNull()), "no response")
        .when(r.isNull(), "blank")
        .when(~r.isin(*STATES), "unknown response")
        .when(F.col("_twice"), "answered twice")
        .when((r == AGREES) & c.isNotNull(), "agrees and names a category")
        .when((r == ELSEWHERE) & c.isNull(), "names no category")
        .when((r == CURRENT_FITS) & (F.col("_v") == "Correct"), "that is agreement")
        .when((r == CURRENT_FITS) & F.col("_none"), "there is no category")
        .when(c.isNotNull() & F.col("_in").isNull(), "unknown category")
        .when(c.isNotNull() & ~F.col("_in") & ~F.col("_none"), "out of scope")
    )
    j = j.withColumn("reject_reason", why)
    ok = F.col("reject_reason").isNull()
    status = F.coalesce(*[F.when(ok & (r == k), v) for k, v in STATES.items()])
    verdict = F.when(ok & (r == CURRENT_FITS), "Correct").when(ok & (r == ELSEWHERE), "Incorrect")
    category = F.when(ok & (r == CURRENT_FITS), F.col("_path")).when(ok & (r == ELSEWHERE), c)
    return j.select("line_id", "response", status.alias("status"), verdict.alias("override_verdict"), category.alias("override_category"), "note", "reject_reason")


#: Columns that a review may write; all others are the finding, which it never changes.
REVIEWED = ("review_status", "reviewed_by", "review_override_verdict", "review_override_category", "review_note")


def reviewed(lines: DataFrame, taken: DataFrame, reviewer: str) -> DataFrame:
    """Lines with the answers that intake() accepted; other lines keep what they had."""
    a = taken.where("reject_reason IS NULL").select("line_id", F.struct(F.col("status"), F.lit(reviewer).alias("by"), F.col("override_verdict"), F.col("override_category"), F.col("note")).alias("_a"))
    j = lines.join(a, "line_id", "left")
    new = dict(zip(REVIEWED, ("status", "by", "override_verdict", "override_category", "note"), strict=True))
    had = lambda c: F.col(c) if c in lines.columns else F.lit(None).cast("string")
    return j.select(*[c for c in lines.columns if c not in REVIEWED], *[F.when(F.col("_a").isNotNull(), F.col(f"_a.{n}")).otherwise(had(c)).alias(c) for c, n in new.items()])


def publish(old: DataFrame, new: DataFrame, path: str, may_change: tuple[str, ...] = REVIEWED) -> DataFrame:
    """Write, audit, publish: new is written beside path and read back; only if every other column has the same
    checksum as in old, row by row, does it get its name. Else nothing is left of it, and path is as it was."""
    spark = old.sparkSession
    same = [c for c in old.columns if c not in may_change]
    staged = f"{path}.staged-{uuid.uuid4().hex}"
    new.write.parquet(staged)
    back = spark.read.schema(new.schema).parquet(staged)
    sums = [tuple(checksum(df, same).first()) for df in (old, back)]
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(staged)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if sums[0] != sums[1]:
        fs.delete(at, True)
        raise RuntimeError(f"columns that a review never changes differ: {sums[0]} before, {sums[1]} after")
    if not fs.rename(at, jvm.org.apache.hadoop.fs.Path(path)):
        fs.delete(at, True)
        raise RuntimeError(f"{path} can't be written")
    return spark.read.schema(new.schema).parquet(path)


#: What a reviewer may type into a blind sheet.
BLIND_ANSWERS = ("RIGHT", "WRONG")


def blind_sheet(lines: DataFrame, by: list[str], shown: list[str]) -> tuple[DataFrame, DataFrame]:
    """The questions (group_key, lines, `shown`) with empty columns for answers, and apart from them the key with
    the engine's own verdicts, one row each for the same groups. shown may not hold a verdict or a suggestion."""
    ours = ("verdict", "confidence", "basis", "rationale", "suggested_key", "jury")
    if bad := [c for c in shown if c in ours]:
        raise ValueError(f"a blind sheet can't show {bad}")
    g = lines.groupBy(*by).agg(F.min("unit_id").alias("group_key"), F.count("*").alias("lines"), *[F.min(c).alias(c) for c in dict.fromkeys((*shown, *[c for c in ours if c in lines.columns])) if c not in by])
    empty = [F.lit(None).cast("string").alias(c) for c in ("your_answer", "where_it_should_go", "your_note")]
    return g.select("group_key", "lines", *shown, *empty), g.select("group_key", "lines", *[c for c in ours if c in lines.columns])


def answer_groups(lines: DataFrame, by: list[str]) -> DataFrame:
    """One question for lines that look alike: its least unit key and its lines."""
    return lines.groupBy(*by).agg(F.min("unit_id").alias("group_key"), F.count("*").alias("lines"))


def reattach(lines: DataFrame, groups: DataFrame, by: list[str]) -> DataFrame:
    """Lines with the key of their question; null is equal to null here."""
    g = groups.select(*[F.col(c).alias(f"_{c}") for c in by], "group_key")
    cond = F.lit(True)
    for c in by:
        cond = cond & lines[c].eqNullSafe(g[f"_{c}"])
    return lines.join(g, cond, "left").drop(*[f"_{c}" for c in by])


def agreement(his: str, levels: list[str]):
    """Column: leaf, branch or differs, comparing what a person typed with the engine's levels; none
    without an answer. People write parts of names, so equal or contained texts agree, with the leaf
    before its parent; else the first level, from the top, that shares a word decides."""
    lv = F.filter(F.array(*[F.when((F.col(c) != "") & ~F.lower(F.col(c)).contains("not used"), plain(F.col(c))) for c in levels]), lambda x: x.isNotNull())
    words = lambda x: F.array_remove(F.split(x, " "), "")

    def compared(s: Column) -> Column:
        h, at, n = s["h"], s["lv"], F.size(s["lv"])
        leaf, parent = F.coalesce(F.get(at, n - 1), F.lit("")), F.coalesce(F.get(at, n - 2), F.lit(""))
        meets = lambda c: (c != "") & (F.contains(c, h) | F.contains(h, c))
        sharing = once(words(h), lambda said: F.array_position(F.transform(at, lambda x: F.arrays_overlap(words(x), said)), True))
        by_word = once(sharing, lambda k: F.when(k == n, "leaf").when(k > 0, "branch").otherwise("differs"))
        return F.when((h == "") | (n == 0), "differs").when(meets(leaf), "leaf").when(meets(parent), "branch").otherwise(by_word)

    return F.when(F.col(his).isNull(), "none").otherwise(once(F.struct(plain(F.col(his)).alias("h"), lv.alias("lv")), compared))


def score(scored: DataFrame, column: str = "match") -> DataFrame:
    """Lines of each outcome and the rates among those with an answer."""
    a = scored.groupBy("tenant").agg(*[F.count_if(F.col(column) == m).alias(m) for m in ("leaf", "branch", "differs", "none")])
    n = F.col("leaf") + F.col("branch") + F.col("differs")
    return a.withColumn("leaf_pct", F.round(F.when(n > 0, 100.0 * F.col("leaf") / n), 4)).withColumn("branch_pct", F.round(F.when(n > 0, 100.0 * (F.col("leaf") + F.col("branch")) / n), 4))


def agreement_by_verdict(lines: DataFrame) -> DataFrame:
    a = lines.where(F.col("response").isNotNull()).groupBy("verdict").agg(F.count("*").alias("reviewed"), F.count_if(F.col("response") == "Agree").alias("agreed"))
    return a.withColumn("agree_pct", F.round(100.0 * F.col("agreed") / F.col("reviewed"), 4))


def unanswered_lost(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Answered rows of an old sheet that a new one would drop; if any, write a new version."""
    return old.where(F.coalesce("response", F.lit("")) != "").join(new, key, "left_anti")
