"""Verdicts: deterministic ones, votes of several models, their validation and coverage."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.functions import text
from tallygrain.functions.text import VERDICTS, confidence
from tallygrain.sources.shared import shared

#: On what a verdict may rest.
BASES = ("description", "supplier", "rule", "no_evidence")


class Scorer(Protocol):
    """The only place for Python in the engine: batches of units in, votes out."""

    def __call__(self, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]: ...


VOTES = "line_id long, seat int, verdict string, confidence string, basis string, suggested_key string, rationale string"


def score(units: DataFrame, scorer: Scorer, workers: int | None = None) -> DataFrame:
    """Votes of a scorer; workers bounds how many tasks call it at once."""
    return (units.repartition(workers) if workers else units).mapInPandas(scorer, VOTES)


def contradictions(lines: DataFrame) -> DataFrame:
    """Subjects that were put into more than one category."""
    return lines.groupBy("tenant", "subject_id").agg(F.countDistinct("unit_id").alias("units")).where("units > 1")


#: What a line without a verdict gets before any model is asked, in this order.
FINDINGS = (("contradiction", "Incorrect"), ("uncategorised", "Uncertain"), ("unjudgeable", "Uncertain"))


def deterministic(lines: DataFrame) -> DataFrame:
    """finding, verdict, confidence and basis of lines without a verdict: contradictory (the same
    subject in several categories, so one is wrong), uncategorised, unjudgeable: the first that holds.
    Lines with a verdict keep it and have no finding, so they aren't dealt out by subject."""
    c = contradictions(lines).select("tenant", "subject_id", F.lit(True).alias("_c"))
    judged = F.col("verdict").isNotNull()
    j = lines.where(~judged).join(c, ["tenant", "subject_id"], "left").unionByName(lines.where(judged).withColumn("_c", F.lit(None).cast("boolean")))
    found = F.when(F.col("_c"), "contradiction").when(text.uncategorised(F.col("l0")), "uncategorised").when(F.col("description_usable") == "N", "unjudgeable")
    j = j.withColumn("finding", F.when(F.col("verdict").isNull(), found)).drop("_c")
    given = F.coalesce(*[F.when(F.col("finding") == f, v) for f, v in FINDINGS])
    return j.withColumn("verdict", F.coalesce("verdict", given)).withColumn("confidence", F.when(F.col("finding").isNotNull(), 1.0)).withColumn("basis", F.concat(F.lit("deterministic_"), "finding"))


def suggested_levels(lines: DataFrame, tree: DataFrame, levels: list[str], key: str = "suggested_key") -> DataFrame:
    """Adds suggested_<level> for each level of the suggested key, all null without one. A level that
    the key lacks reads as not used, or, where no category has it at all, as no such level."""
    some = tree.agg(*[F.count_if(~text.blank(F.col(c))).alias(f"_n{k}") for k, c in enumerate(levels)])  # one row
    marks = [F.when(F.col(f"_n{k}") > 0, text.NOT_USED).otherwise(f"(no level {k} in this taxonomy)") for k in range(len(levels))]
    filled = tree.crossJoin(F.broadcast(some)).select(F.col("category_key").alias("_k"), F.struct(*[F.coalesce(F.nullif(text.clean(F.col(c)), F.lit("")), m).alias(c) for c, m in zip(levels, marks, strict=True)]).alias("_s"))
    one = filled.groupBy("_k").agg(F.min("_s").alias("_s"))
    j = lines.withColumn("_k", F.nullif(F.trim(key), F.lit(""))).join(one, "_k", "left")
    return j.select(*lines.columns, *[F.col(f"_s.{c}").alias(f"suggested_{c}") for c in levels])


def tally(votes: DataFrame, keys: DataFrame, uncategorised: Column | None = None) -> DataFrame:
    """One consensus a line of long votes (line_id, seat, verdict, confidence, basis, suggested_key,
    rationale). Two equal verdicts decide, ties alphabetically; the destination is voted among those
    that agree, on known keys in scope; one decider alone is a split."""
    known = keys.groupBy(F.col("category_key").alias("_k")).agg(F.max("in_scope").alias("_in"))
    valid = votes.where(F.col("verdict").isin(*VERDICTS)).withColumn("_k", F.nullif(F.trim("suggested_key"), F.lit(""))).join(known, "_k", "left")
    free = uncategorised if uncategorised is not None else F.lit(False)
    sure = F.coalesce(confidence(F.col("confidence")), F.lit(0.0))
    said = F.coalesce(F.col("rationale"), F.lit("")) != ""
    figures = []
    for k, v in enumerate(VERDICTS):  # what each verdict would give, so that lines are grouped once
        mine = F.col("verdict") == v
        figures += [
            F.count_if(mine).alias(f"n{k}"), F.round(F.avg(F.when(mine, sure)), 3).alias(f"c{k}"), F.mode(F.when(mine & F.col("basis").isin(*BASES), F.col("basis")), True).alias(f"b{k}"),
            F.min_by("rationale", F.when(mine & said, F.col("seat"))).alias(f"r{k}"), F.collect_list(F.when(mine & F.col("_in").isNotNull() & (free | F.col("_in")), F.col("_k"))).alias(f"k{k}"),
        ]
    g = valid.groupBy("line_id").agg(F.count("*").alias("got"), *figures)
    g = g.withColumn("_w", F.least(*[F.struct((-F.col(f"n{k}")).alias("n"), F.lit(v).alias("verdict"), F.lit(k).alias("k")) for k, v in enumerate(VERDICTS)]))
    won = lambda c: F.coalesce(*[F.when(F.col("_w.k") == k, F.col(f"{c}{k}")) for k in range(len(VERDICTS))])
    g = g.select("line_id", "got", F.col("_w.verdict").alias("verdict"), *[won(c).alias(n) for c, n in (("n", "n"), ("c", "confidence"), ("b", "basis"), ("r", "rationale"), ("k", "ks"))])
    times = F.transform(F.array_distinct("ks"), lambda x: F.struct((-F.size(F.filter("ks", lambda y: y == x))).alias("n"), x.alias("k")))
    got = g.withColumn("suggested_key", F.array_min(F.filter(times, lambda t: t["n"] <= -2))["k"])
    split = F.col("n") < 2
    return got.select(
        "line_id",
        F.when(split, "Uncertain").otherwise(F.col("verdict")).alias("verdict"),
        F.when(split, "split").otherwise(F.concat(F.col("n").cast("string"), F.lit("of"), F.col("got").cast("string"))).alias("agreement"),
        F.when(split, 0.0).otherwise(F.col("confidence")).alias("confidence"),
        F.when(split, "no_evidence").otherwise(F.coalesce("basis", F.lit("no_evidence"))).alias("basis"),
        F.when(~split, F.col("suggested_key")).alias("suggested_key"),
        F.when(split, "no two answers agree").otherwise(F.col("rationale")).alias("rationale"),
        F.col("got").cast("long").alias("jury"),
    )


def coverage(units: DataFrame, answers: DataFrame) -> DataFrame:
    """By id, not by count: answered, missing and alien answers of each seat."""
    u = units.select("line_id", F.lit(1).alias("_u")).distinct()
    a = answers.select("seat", "line_id").distinct()
    hit = a.join(u, "line_id", "left").groupBy("seat").agg(F.count_if(F.col("_u").isNotNull()).alias("answered"), F.count_if(F.col("_u").isNull()).alias("alien"))
    return hit.crossJoin(F.broadcast(u.agg(F.count("*").alias("sent")))).withColumn("missing", F.col("sent") - F.col("answered"))


def line_coverage(units: DataFrame, answers: DataFrame, seats: tuple[int, ...]) -> DataFrame:
    """How many of the seats answered about each line that was sent, by its id: votes, thin (fewer than
    all) and lost (none). Answers about lines that weren't sent count nowhere, repeated ones once."""
    a = answers.where(F.col("seat").isin(*seats)).select("line_id", "seat").distinct().groupBy("line_id").agg(F.count("*").alias("votes"))
    j = units.select("line_id").distinct().join(a, "line_id", "left").withColumn("votes", F.coalesce("votes", F.lit(0)))
    return j.select("line_id", "votes", (F.col("votes") < len(seats)).alias("thin"), (F.col("votes") == 0).alias("lost"))


def ask_again(units: DataFrame, answers: DataFrame, seats: tuple[int, ...]) -> DataFrame:
    """Units (batch, line_id, ...) with the seat that must be asked about them again: whole batches in which
    that seat answered about no line that was sent. Who answered about a part of a batch isn't asked again;
    line_coverage tells which lines lack it."""
    batches = units.select("batch").distinct().select("batch", F.explode(F.array(*map(F.lit, seats))).alias("seat"))
    heard = answers.select("seat", "line_id").join(units.select("batch", "line_id"), "line_id").select("batch", "seat").distinct()
    return units.join(batches.join(heard, ["batch", "seat"], "left_anti"), "batch")


def asked(units: DataFrame, scorers: dict[int, Scorer], rounds: int = 3, workers: int | None = None) -> DataFrame:
    """Votes of every seat about units (batch, line_id, ...), asked again for the batches in which a seat stayed
    silent, `rounds` times at most. Each round is written, so a later one doesn't call the scorers before it again."""
    votes = None
    for _ in range(rounds):
        again = units.select("*", F.explode(F.array(*map(F.lit, scorers))).alias("seat")) if votes is None else shared(ask_again(units, votes, tuple(scorers)))
        if votes is not None and again.isEmpty():
            break
        for seat, scorer in scorers.items():
            more = score(again.where(F.col("seat") == seat).drop("seat"), scorer, workers).withColumn("seat", F.lit(seat))
            votes = more if votes is None else votes.unionByName(more)
        votes = shared(votes)
    return votes


def with_rollup(rules: DataFrame, lines: DataFrame) -> DataFrame:
    """rules (tenant, rule_id, ...) with the figures of rule_rollup() in place of what they had; a rule without lines
    keeps its own."""
    figures = rule_rollup(lines)
    new = [c for c in figures.columns if c not in ("tenant", "rule_id")]
    j = rules.join(figures.select("tenant", "rule_id", F.struct(*new).alias("_f")), ["tenant", "rule_id"], "left")
    had = lambda c: F.col(c) if c in rules.columns else F.lit(None).cast(figures.schema[c].dataType)
    return j.select(*[c for c in rules.columns if c not in new], *[F.when(F.col("_f").isNotNull(), F.col(f"_f.{c}")).otherwise(had(c)).alias(c) for c in new])


def validated(answers: DataFrame, keys: DataFrame) -> DataFrame:
    """reject_reason: null for an answer that may be applied."""
    known = keys.select(F.col("category_key").alias("suggested_key"), F.col("in_scope"))
    j = answers.join(known, "suggested_key", "left")
    why = (
        F.when(~F.coalesce(F.col("verdict").isin(*VERDICTS), F.lit(False)), "verdict")
        .when(~F.coalesce(F.col("basis").isin(*BASES), F.lit(False)), "basis")
        .when(F.col("suggested_key").isNotNull() & F.col("in_scope").isNull(), "unknown key")
        .when(~F.coalesce("in_scope", F.lit(True)) & ~F.col("uncategorised"), "out of scope")
    )
    return j.withColumn("reject_reason", why).drop("in_scope")


def keep_larger_jury(old: DataFrame, new: DataFrame) -> DataFrame:
    """Merge by line: a result of a smaller jury never replaces one of a larger."""
    cols = [c for c in old.columns if c != "line_id"]
    n = new.select("line_id", F.lit(True).alias("_new"), *[F.col(c).alias(f"_{c}") for c in cols])
    j = old.join(n, "line_id", "full")
    take = F.coalesce("_new", F.lit(False)) & (F.col("jury").isNull() | (F.col("jury") <= F.col("_jury")))
    return j.select("line_id", *[F.when(take, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def rule_rollup(lines: DataFrame) -> DataFrame:
    """Judged lines, error rate among decided ones and completeness of each rule."""
    v = F.col("verdict")
    a = lines.groupBy("tenant", "rule_id").agg(F.count("*").alias("lines"), F.count_if(v.isNotNull()).alias("judged"), F.count_if(v == "Incorrect").alias("bad"), F.count_if(v == "Uncertain").alias("unsure"))
    decided = F.col("judged") - F.col("unsure")
    return a.withColumn("error_rate", F.round(F.when(decided > 0, F.col("bad") / decided), 6)).withColumn("is_complete", F.col("judged") == F.col("lines"))


def consistency(lines: DataFrame) -> DataFrame:
    """Units judged more than once, and those with more than one verdict."""
    u = lines.where(F.col("verdict").isNotNull()).groupBy("tenant", "unit_id").agg(F.count("*").alias("n"), F.countDistinct("verdict").alias("v")).where("n > 1")
    return u.groupBy("tenant").agg(F.count("*").alias("repeated"), F.count_if(F.col("v") > 1).alias("inconsistent"))


def deciders(votes: Column, verdict: Column) -> Column:
    """Who voted for the verdict, of an array of structs (model, verdict)."""
    names = F.transform(F.filter(votes, lambda v: v["verdict"] == verdict), lambda v: v["model"])
    return F.when(F.size(names) > 0, F.array_join(names, ", ")).otherwise("none - split rule")
