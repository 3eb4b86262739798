"""Quality rules: a decision list over statistics of whole texts, learned by sequential covering.

A rule is a conjunction of thresholds. It is grown on two thirds of the labelled rows: each step adds
the threshold with the largest information gain for poor texts, taken from the counts of rows by
statistic and bin, which one grouped count makes. It is pruned on the other third: of its beginnings
the one with the best share of poor rows is kept. If that share is high enough the rule joins the list,
the rows that it covers leave, and the next rule is grown from the rest. The list becomes one ordered
Spark conditional expression; a text that no rule covers is kept.

All of it is DataFrame and SQL functions. Only counts of bins reach the driver. A text's statistics
are made inside its row: repeated windows of words are found by sorting the hashes of its windows, and
only in texts that have any.

Edge cases: a null or empty text, or one of white space alone, has no words, zero counts and fails the
base rule; a text of fewer words than a window has no repeated words; texts of any length are read
whole; without poor labelled rows the list is empty and the base rule decides alone; an id with
contradicting labels is left out of the fit, repeated rows of an id count once in it and are repeated in the
result; null ids are held out; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import labelled_ids, materialise, sampled

SPACE = r"\x20\x09-\x0D"
SYMBOLS = "[#*$%&|<>]"
#: Words of a window whose repetition counts; the base rule: least words, most repeated words in a hundred.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30
#: Most labelled documents that the list is fitted on, sampled from all of them.
FIT_ROWS = 20_000
#: Thresholds tried for each statistic, most conditions of a rule and rules of a list.
BINS, CONDITIONS, RULES = 32, 4, 12
#: A rule needs this share of poor rows among all it covers, and so many poor rows.
PRECISION, LEAST_POOR = 0.95, 5


def base(text: Column) -> list[Column]:
    """The text as it is counted, its words and lines."""
    t = F.coalesce(text, F.lit(""))
    return [t.alias("t"), F.array_remove(F.split(t, f"[{SPACE}]+"), "").alias("words"), F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines")]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value made once: a filter that moves below a projection takes expressions along,
    and one that a lambda reads would be made again for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words stand in windows of WINDOW words that a text has twice or more."""

    def covered(spans: Column) -> Column:
        # windows in the order of their hashes: equal ones are neighbours
        twice = lambda s: F.filter(s, lambda x, i: x["h"].eqNullSafe(F.get(s, i + 1)["h"]) | x["h"].eqNullSafe(F.get(s, i - 1)["h"]))
        places = let(F.sort_array(F.transform(spans, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), lambda s: F.transform(twice(s), lambda x: x["i"]))
        # a window brings the words that the next one, if it overlaps, doesn't
        fresh = lambda p: F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        n = let(F.sort_array(places), lambda p: F.aggregate(fresh(p), F.lit(0), lambda a, x: a + x))
        return F.when(F.size(F.array_distinct(spans)) < F.size(spans), n).otherwise(0)

    hashed = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
    spans = let(F.transform(words, lambda w: F.xxhash64(w)), hashed)
    return F.when(F.size(words) >= WINDOW, let(spans, covered)).otherwise(0).cast("long")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the other counts that
    shares are made of, a row for each row of docs."""
    return docs.select(F.col(id_col).alias("doc_id"), *base(F.col(text_col))).select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit("[0-9]")).cast("long").alias("n_digits"),
        F.regexp_count("t", F.lit("[!?]")).cast("long").alias("n_marks"),
        F.regexp_count("t", F.lit("[.,;:]")).cast("long").alias("n_stops"),
    )


#: Statistics that rules may test: names and what they are made of.
SHARES: dict[str, tuple[str, str]] = {
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "stops_per_word": ("n_stops", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "distinct_share": ("n_distinct", "n_words"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "words_per_line": ("n_words", "n_lines"),
}


def shared(name: str) -> Column:
    a, b = SHARES[name]
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


@dataclass(frozen=True)
class Condition:
    name: str
    at_least: bool
    threshold: float

    def holds(self, value: Column) -> Column:
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    poor: int
    good: int

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))

    def covers(self, value=shared) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.holds(value(c.name))
        return out


def first_rule(rules: list[Rule]) -> Column:
    """Column: the first rule of the list that covers a row, in words; null if none does."""
    step = F.lit(None).cast("string")
    for r in reversed(rules):
        step = F.when(r.covers(), str(r)).otherwise(step)
    return step


def gain(poor: int, good: int, poor_before: int, good_before: int) -> float:
    if not poor:
        return 0.0
    return poor * (math.log2(poor / (poor + good)) - math.log2(poor_before / (poor_before + good_before)))


def best_split(counts: list[tuple[int, int, int, int]], poor: int, good: int) -> tuple[float, int, bool, int]:
    """(gain, statistic, at_least, bin) of the best threshold, of counts (statistic, bin, poor, good). A
    threshold stands below its bin. On equal gain the first statistic, at_least before below, the lowest bin."""
    best = (0.0, -1, False, 0)
    for f in sorted({c[0] for c in counts}):
        p = g = 0
        for _, b, p1, g1 in sorted(c for c in counts if c[0] == f):
            for at_least, x, y in ((True, poor - p, good - g), (False, p, g)):
                if 0 < x + y < poor + good and (v := gain(x, y, poor, good)) > best[0] + 1e-9:
                    best = (v, f, at_least, b)
            p, g = p + p1, g + g1
    return best


def learn(rows: DataFrame, names: list[str] | None = None) -> list[Rule]:
    """The decision list for rows (y, grow, one column for each name): y is 1 for poor, grow tells the
    rows to grow on from those to prune on. Rows are few, of a fit; only counts reach the driver."""
    names = names or list(SHARES)
    quantiles = [k / BINS for k in range(1, BINS)]
    cuts = rows.agg(*[F.percentile(c, F.array(*map(F.lit, quantiles))).alias(c) for c in names]).first()
    if cuts[0] is None:
        return []
    values = F.array(*names)
    edges = F.array(*[F.array(*[F.lit(float(t)) for t in sorted(set(cuts[c]))]) for c in names])
    binned = F.zip_with(F.col("v"), edges, lambda v, e: F.size(F.filter(e, lambda t: t <= v)))
    left = materialise(rows.select("y", "grow", values.alias("v")).select("y", "grow", "v", binned.alias("b")))
    count = (F.coalesce(F.sum("y"), F.lit(0)).alias("poor"), F.coalesce(F.sum(1 - F.col("y")), F.lit(0)).alias("good"))
    at = {c: F.get("v", F.lit(k)) for k, c in enumerate(names)}
    rules: list[Rule] = []
    while len(rules) < RULES:
        grown: list[Condition] = []
        inside = left.where("grow")
        poor, good = inside.agg(*count).first()
        while poor >= LEAST_POOR and good and len(grown) < CONDITIONS:
            got = inside.select("y", F.posexplode("b").alias("f", "bin")).groupBy("f", "bin").agg(*count).collect()
            v, f, at_least, b = best_split([tuple(r) for r in got], poor, good)
            if f < 0:
                break
            # the threshold in the middle of the gap, so that no value lies at it
            low, high = inside.agg(F.max(F.when(F.get("b", F.lit(f)) < b, F.get("v", F.lit(f)))), F.min(F.when(F.get("b", F.lit(f)) >= b, F.get("v", F.lit(f))))).first()
            grown.append(Condition(names[f], at_least, (low + high) / 2))
            inside = inside.where(grown[-1].holds(at[names[f]]))
            poor, good = inside.agg(*count).first()
        if not grown:
            break
        held = [Rule(tuple(grown[:k]), 0, 0).covers(at.__getitem__) for k in range(1, len(grown) + 1)]
        tried = left.agg(*[F.count_if(c & (F.col("y") == y) & ~F.col("grow")) for c in held for y in (1, 0)], *[F.count_if(c & (F.col("y") == y)) for c in held for y in (1, 0)]).first()
        k = max(range(len(held)), key=lambda k: ((tried[2 * k] + 1) / (tried[2 * k] + tried[2 * k + 1] + 2), -k))
        poor, good = tried[2 * (len(held) + k)], tried[2 * (len(held) + k) + 1]
        if poor < LEAST_POOR or poor < PRECISION * (poor + good):
            break
        rules.append(Rule(tuple(grown[: k + 1]), poor, good))
        left = left.where(~held[k])
    return rules


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> list[Rule]:
    """Fit on at most `rows` labelled documents outside the held-out fold that pass the base rule."""
    known = sampled(labelled_ids(labels, label), rows)
    got = materialise(statistics(docs.select("doc_id", "text").join(F.broadcast(known.select("doc_id")), "doc_id", "left_semi")))
    one = got.where(~base_failed(F.col("n_words"), F.col("n_repeat_words"))).select("doc_id", F.struct(*[shared(c).alias(c) for c in SHARES]).alias("x")).groupBy("doc_id").agg(F.min("x").alias("x"))
    grow = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) > 0
    return learn(one.join(F.broadcast(known), "doc_id").select((1 - F.col("y")).alias("y"), grow.alias("grow"), "x.*"))


def judged(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept, and the rule that a text fails, in words."""
    s = statistics(docs)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    out = s.withColumn("base_failed", failed).withColumn("rule", F.when(~F.col("base_failed"), first_rule(rules)))
    kept = ~F.col("base_failed") & F.col("rule").isNull()
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "rule")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """judged() by a list that is learned from the labels."""
    return judged(docs, train(docs, labels))
