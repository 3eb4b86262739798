"""The open questions of a merge, one row for each distinct decision, with the answers that there are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.functions import paths
from tallygrain.functions.keys import decision_id
from tallygrain.functions.text import loose

#: Kinds of questions, and what each is called in a sheet that rulings.by_type reads.
KINDS = {
    "home": "no home in the merged tree",
    "cross": "moves to another branch",
    "amb": "several possible homes",
    "gran": "becomes part of another category",
    "spell": "ALMOST the same label",
    "nyc": "ANSWERED (uncategorised by rule)",
}
#: Bases of nodes that are merged into another one.
MERGED = ("leaf_moved", "leaf_variant", "ruled_mapped")


def of_nodes(mapped: DataFrame) -> DataFrame:
    """kind, parts (what is decided), tenant, detail, option_a, option_b, lines and applies of every node of a
    crosswalk (tenant, path, lines, basis, target, candidates) that asks something."""
    canon = paths.joined(paths.canonical(paths.split_path(F.col("path"))))
    m = mapped.withColumn("_c", canon).withColumn("_up", F.upper("_c"))
    b, c = F.col("basis"), F.coalesce("candidates", F.array().cast("array<string>"))
    at = lambda k: F.coalesce(F.get(c, F.lit(k)), F.lit(""))
    merged = b.isin(*MERGED) & F.col("target").isNotNull() & (F.upper("target") != F.col("_up"))
    kind = F.when(b == "uncategorised_by_rule", "nyc").when(b == "unmapped", "home").when(b == "leaf_crosses_branch", "cross").when(b.endswith("_ambiguous"), "amb").when(merged, "gran")
    k = F.col("kind")
    parts = F.when(k.isin("nyc", "home"), F.array("_up")).when(k == "cross", F.array(F.col("_up"), at(0))).when(k == "amb", F.array(at(0), at(1))).when(k == "gran", F.array(F.col("_up"), F.upper("target")))
    a = F.when(k.isin("cross", "gran", "nyc"), F.col("_c")).when(k == "amb", at(0)).otherwise("")
    o = F.when(k == "cross", at(0)).when(k == "amb", at(1)).when(k == "gran", F.col("target")).otherwise("")
    more = F.when(k == "amb", F.col("_c")).when((k == "cross") & (F.size(c) > 1), F.concat(F.lit("other homes: "), F.array_join(F.slice(c, 2, 100), " | ")))
    return m.withColumn("kind", kind).where("kind IS NOT NULL").select("kind", parts.alias("parts"), "tenant", F.col("_c").alias("detail"), a.alias("option_a"), o.alias("option_b"), "lines", more.alias("applies"))


def of_pairs(pairs: DataFrame) -> DataFrame:
    """The same for labels that are almost equal and that nobody ruled on: typo_pairs with the ruling 'flag'."""
    p = pairs.where("ruling = 'flag'")
    detail = F.concat(F.lit("level "), F.col("level").cast("string"))
    return p.select(F.lit("spell").alias("kind"), F.array(loose("a"), loose("b")).alias("parts"), F.lit(None).cast("string").alias("tenant"), detail.alias("detail"), F.col("a").alias("option_a"), F.col("b").alias("option_b"), (F.col("lines_a") + F.col("lines_b")).alias("lines"), F.lit(None).cast("string").alias("applies"))


def gathered(asked: DataFrame, answered: DataFrame | None = None) -> DataFrame:
    """One row a decision: decision_id, kind, type, tenants (all that ask, each once), detail, options, lines at
    stake, applies (where else it counts) and the ruling that answered (decision_id, ruling) has. The id is of
    what is decided alone, so a question asked in other words keeps its answer."""
    named = asked.withColumn("decision_id", decision_id(F.col("kind"), F.array_join("parts", " | ")))
    out = named.groupBy("decision_id", "kind").agg(
        F.array_sort(F.collect_set("tenant")).alias("tenants"), F.min("detail").alias("detail"), F.min("option_a").alias("option_a"), F.min("option_b").alias("option_b"),
        F.sum("lines").alias("lines"), F.array_sort(F.collect_set("applies")).alias("applies"),
    )
    out = out.withColumn("type", F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in KINDS.items()]))
    if answered is None:
        return out.withColumn("ruling", F.lit(None).cast("string"))
    said = answered.where(F.coalesce(F.trim("ruling"), F.lit("")) != "").groupBy("decision_id").agg(F.min("ruling").alias("ruling"))
    return out.join(said, "decision_id", "left")


def still_open(questions: DataFrame) -> DataFrame:
    """Questions without an answer, most lines first."""
    return questions.where("ruling IS NULL AND kind <> 'nyc'").orderBy(F.desc("lines"), "decision_id")


def lost_answers(questions: DataFrame, answered: DataFrame) -> DataFrame:
    """Answers to decisions that aren't asked any more; a new sheet must not drop them unseen."""
    return answered.where(F.coalesce(F.trim("ruling"), F.lit("")) != "").join(questions.select("decision_id"), "decision_id", "left_anti")
