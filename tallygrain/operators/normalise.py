"""From a tenant's own table to fact lines: scope, levels, keys, taxonomy and rule joins."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.functions import keys, paths, text


@dataclass(frozen=True)
class TenantConfig:
    """How a tenant's columns map to fact lines. columns: internal name -> physical name."""

    tenant: str
    columns: dict[str, str]
    descriptions: tuple[str, ...]
    excluded_l0: tuple[str, ...] = ()
    tables: dict[str, str] = field(default_factory=dict)
    line_identity: tuple[str, ...] = ()
    gate: bool = False
    keywords: tuple[str, ...] = ()

    REQUIRED = ("supplier", "spend", "l0", "l1")
    REPORT = ("rule_id", "invoice_date", "source_row_id")

    @staticmethod
    def of(tenant: str, settings: dict) -> TenantConfig:
        """The configuration in a nested mapping, as a YAML or JSON file holds it: source (columns,
        description_fields, table, taxonomy_table, line_identity) and clinical_gate (enabled, exclude_values,
        exclude_keywords). Blank entries count as absent."""
        text = lambda v: str(v).strip() if v is not None else ""
        listed = lambda v: tuple(t for t in map(text, v or []) if t)
        source, gate = settings.get("source") or {}, settings.get("clinical_gate") or {}
        columns = {k: text(v) for k, v in (source.get("columns") or {}).items() if text(v)}
        tables = {k: text(source.get(k)) for k in ("table", "taxonomy_table") if text(source.get(k))}
        return TenantConfig(
            tenant, columns, listed(source.get("description_fields")), listed(gate.get("exclude_values")), tables,
            listed(source.get("line_identity")), bool(gate.get("enabled")), listed(gate.get("exclude_keywords")),
        )

    @staticmethod
    def load(tenant: str, path: str) -> TenantConfig:
        """The configuration in a JSON file, or a YAML file where a YAML package is installed; a byte order mark is
        passed over, and an empty file is an empty configuration."""
        with open(path, encoding="utf-8-sig") as f:
            held = f.read()
        if path.endswith(".json"):
            return TenantConfig.of(tenant, json.loads(held or "{}"))
        import yaml  # optional

        return TenantConfig.of(tenant, yaml.safe_load(held) or {})

    def missing_for_run(self) -> list[str]:
        """What keeps a run from starting. Exclusion by keywords is refused: what is out of scope is told by the
        first level of the category alone."""
        out = [c for c in self.REQUIRED if c not in self.columns] + ([] if self.descriptions else ["descriptions"])
        out += ["excluded_l0"] * (self.gate and not self.excluded_l0)
        return out + ["keywords, by which nothing may be excluded"] * bool(self.keywords)

    def identity(self) -> tuple[str, ...]:
        """The physical columns that tell a tenant's lines apart: as configured, else the source's row id, else
        what an invoice has."""
        if self.line_identity:
            return tuple(self.columns.get(c, c) for c in self.line_identity)
        names = ("source_row_id",) if "source_row_id" in self.columns else ("invoice_id", "invoice_number", "invoice_line_number")
        return tuple(self.columns[c] for c in names if c in self.columns)

    def missing_for_report(self) -> list[str]:
        return self.missing_for_run() + [c for c in self.REPORT if c not in self.columns]

    def same_catalog(self) -> None:
        """A table named through another catalog could be another tenant's."""
        for name, table in self.tables.items():
            if len(table.split(".")) > 2:
                raise ValueError(f"{self.tenant}: table {name} names a catalog: {table}")


def column_of(df: DataFrame, names: list[str], kind: str = "string") -> Column:
    """The first of the names that df has, else a typed null."""
    have = {c.lower(): c for c in df.columns}
    return next((F.col(f"`{have[n.lower()]}`").cast(kind) for n in names if n.lower() in have), F.lit(None).cast(kind))


def in_scope(l0: Column, excluded: tuple[str, ...]) -> Column:
    """Null and blank stay; an empty list excludes nothing."""
    return (~F.trim(l0).isin(*excluded) | l0.isNull()) if excluded else F.lit(True)


def level(l0: Column, li: Column) -> Column:
    """A level, or what its absence means: without an L0 nothing is categorised."""
    return F.when(text.blank(l0), text.UNCATEGORISED).when(text.blank(li), text.NOT_USED).otherwise(F.trim(li))


def taxonomy_level(matched: Column, exists: bool, i: int, li: Column) -> Column:
    """A level of the matched taxonomy, with three kinds of absence."""
    if not exists:
        return F.lit(f"(no level {i} in this taxonomy)")
    return F.when(~matched, text.NO_MATCH).when(text.blank(li), text.NOT_USED).otherwise(F.trim(li))


def scope_status(l0: Column, excluded: tuple[str, ...]) -> Column:
    return F.when(text.blank(l0), "uncategorised").when(F.trim(l0).isin(*excluded) if excluded else F.lit(False), "out of scope").otherwise("in scope")


def normalise(df: DataFrame, cfg: TenantConfig, run_id: str, source: str, levels: int = 5) -> DataFrame:
    """All fact columns in one projection, under the names that queue, judge, profile, monitor, preflight and
    actions read; a missing optional column becomes a typed null. line_id is the source's row id if that is a
    whole number, else a hash of the columns that identify a line; cents is spend in whole hundredths."""
    if cfg.missing_for_run():
        raise ValueError(f"{cfg.tenant}: no mapping for {cfg.missing_for_run()}")
    cfg.same_catalog()
    at = lambda name, kind="string": column_of(df, [cfg.columns[name]] if name in cfg.columns else [], kind)
    lev = [at(f"l{i}") for i in range(levels)]
    desc = [column_of(df, [d]) for d in cfg.descriptions]
    spend = at("spend").try_cast("double")
    named = [level(lev[0], x) for x in lev]
    described = text.first_usable(desc)
    same = [column_of(df, [c]) for c in cfg.identity()] or [F.lit(None).cast("string")]
    line_id = F.xxhash64(F.lit(cfg.tenant), *same)
    line_id = F.coalesce(same[0].try_cast("long"), line_id) if len(same) == 1 else line_id
    return df.select(
        F.lit(run_id).alias("run_id"),
        F.lit(cfg.tenant).alias("tenant"),
        line_id.alias("line_id"),
        at("source_row_id").alias("source_row_id"),
        at("supplier").alias("supplier"),
        described.alias("description"),
        F.when(text.any_of([text.usable(d) for d in desc]), "Y").otherwise("N").alias("description_usable"),
        text.filled_by(dict(zip(cfg.descriptions, desc, strict=True))).alias("description_source"),
        spend.alias("spend"),
        F.round(spend * 100).cast("long").alias("cents"),
        F.when(spend < 0, 1).otherwise(0).alias("is_credit"),
        *[c.alias(f"l{i}") for i, c in enumerate(named)],
        scope_status(lev[0], cfg.excluded_l0).alias("scope"),
        F.concat_ws(paths.SEP, *named).alias("path_full"),
        paths.readable(named).alias("path"),
        paths.distinct_depth(lev).alias("depth_distinct"),
        text.clean(at("rule_id")).alias("rule_id"),
        at("invoice_date").alias("invoice_date"),
        F.to_date(F.to_timestamp(at("invoice_date").try_cast("timestamp"))).alias("invoice_day"),
        keys.stable_key(F.lit(cfg.tenant), at("supplier"), described, *named).alias("unit_id"),
        keys.stable_key(F.lit(cfg.tenant), at("supplier"), described).alias("subject_id"),
        keys.stable_key(at("supplier")).alias("vendor_key"),
        text.clean(at("taxonomy_key")).alias("tax_key"),
        *[F.lit(None).cast(k).alias(c) for c, k in (("verdict", "string"), ("jury", "long"), ("suggested_key", "string"))],
        F.lit(source).alias("provenance"),
    ).where(in_scope(F.col("l0"), cfg.excluded_l0))


def tenant_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", small: bool = False) -> DataFrame:
    """The only join of tenants' tables: keys collide between tenants, so tenant must be among them."""
    if "tenant" not in on:
        raise ValueError("a join of tenants' tables needs tenant among its keys")
    return left.join(F.broadcast(right) if small else right, on, how)


def first_rule(tables: list[DataFrame], keys_: list[str]) -> DataFrame:
    """One row a key: of the first table, in the order given, that has the key."""
    both = None
    for k, t in enumerate(tables):
        t = t.withColumn("_ord", F.lit(k))
        both = t if both is None else both.unionByName(t, allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys_, "_ord")]
    return both.groupBy(*keys_).agg(F.min_by(F.struct(*rest), F.struct("_ord", *rest)).alias("r")).select(*keys_, "r.*")


def tests_description(fields: list[Column]) -> Column:
    """Y or N: whether a rule reads a description; null for a rule that doesn't resolve."""
    some = text.any_of([c.isNotNull() for c in fields])
    return F.when(some, F.when(F.exists(F.array(*fields), lambda f: F.coalesce(F.upper(f).contains("DESCRIPTION"), F.lit(False))), "Y").otherwise("N"))


def masked_condition(field_: Column, op: Column, value: Column, allowed: tuple[str, ...]) -> Column:
    """A rule's condition in words, its value withheld unless the field is allowed as evidence."""
    return F.when(field_.isNull(), None).when(F.upper(F.trim(field_)).isin(*allowed), F.concat_ws(" ", field_, op, value)).otherwise(F.concat(F.lit("[withheld "), F.trim(field_), F.lit("]")))


def sibling_counts(nodes: DataFrame, levels: list[str]) -> DataFrame:
    """For each row of nodes (tenant and levels), how many values stand beside its real leaf. Trees repeat
    a leaf to fill their levels, so the leaf is at the number of *distinct* non-blank levels, and its
    parent is the levels before that. A null in the parent matches nothing. Children of all parents are
    counted in one pass, instead of a lookup for each row."""
    at = [text.clean(F.col(c)) for c in levels]

    def parent(k: int) -> Column:
        return F.when(text.all_of([F.lit(True), *[x.isNotNull() for x in at[:k]]]), F.array(*at[:k]).cast("array<string>"))

    d = nodes.withColumn("_d", paths.distinct_depth([F.col(c) for c in levels]))
    child = F.explode(F.array(*[F.struct(F.lit(k + 1).alias("d"), parent(k).alias("p"), x.alias("v")) for k, x in enumerate(at)]))
    counts = nodes.select("tenant", child.alias("c")).select("tenant", "c.*").where("p IS NOT NULL").groupBy("tenant", F.col("d").alias("_d"), F.col("p").alias("_p")).agg(F.countDistinct("v").alias("siblings"))
    own = F.coalesce(*[F.when(F.col("_d") == k + 1, parent(k)) for k in range(len(levels))])
    return d.withColumn("_p", own).join(counts, ["tenant", "_d", "_p"], "left").drop("_d", "_p").withColumn("siblings", F.coalesce("siblings", F.lit(0)))


#: The label of spend that nobody procures, and how agreement of two paths is told.
NON_PROCUREMENT, NO_JOIN = "Non-Procurement", "(no join)"


def non_procurement(l0: Column, l1: Column) -> Column:
    """Whether a path is accounting noise by its first or second level: a label, never a filter."""
    return F.coalesce(text.clean(l0) == NON_PROCUREMENT, F.lit(False)) | F.coalesce(text.clean(l1) == NON_PROCUREMENT, F.lit(False))


def path_agrees(own: list[Column], tree: list[Column], joined: Column) -> Column:
    """Y or N: whether a line's levels still equal those of the tree it points to, blank as null."""
    same = [F.coalesce(text.clean(a), F.lit("")) == F.coalesce(text.clean(b), F.lit("")) for a, b in zip(own, tree, strict=True)]
    return F.when(~joined, NO_JOIN).when(text.all_of(same), "Y").otherwise("N")


def output_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Columns under their outside names; one that isn't named gets its own in upper case."""
    return df.select(*[F.col(c).alias(names.get(c, c.upper())) for c in df.columns])


def rule_census(lines: DataFrame, stratum: Column) -> DataFrame:
    """The rules that a stratum of lines uses, and how many lines each has there and in all."""
    n = lines.groupBy("tenant", "rule_id").agg(F.count_if(stratum).alias("in_stratum"), F.count("*").alias("lines"))
    return n.where("in_stratum > 0")


def without_own_output(df: DataFrame, name: str, column: str = "tenant") -> DataFrame:
    """Input rows but those that an earlier run of this engine wrote under its own name."""
    return df.where(~F.col(column).eqNullSafe(F.lit(name)))


def within_roots(nodes: DataFrame, path: str, roots: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Nodes whose first level is an allowed root, and the others, to be reported."""
    ok = F.coalesce(F.upper(F.get(paths.split_path(F.col(path)), F.lit(0))).isin(*[r.upper() for r in roots]), F.lit(False))
    return nodes.where(ok), nodes.where(~ok)


def tenant_tree(raw: DataFrame, levels: list[str], usage: DataFrame, excluded: tuple[str, ...], clinical: tuple[str, ...] = ("Clinical",)) -> DataFrame:
    """A tenant's categories from its raw tree (tenant, category_key, levels, description): path with
    markers, branch, leaf, parent and depth by distinct levels, siblings, scope and lines in use. A
    repeated key is one row, of the least path. usage: (tenant, category_key, lines)."""
    t = raw.select("tenant", text.clean(F.col("category_key")).alias("category_key"), *[F.nullif(text.clean(F.col(c)), F.lit("")).alias(c) for c in levels], "description")
    t = t.where(F.coalesce("category_key", F.lit("")) != "")
    real = F.array_distinct(F.array_compact(F.array(*levels)))
    gap = F.when(F.col(levels[0]).isNull(), text.UNCATEGORISED).otherwise(text.NOT_USED)
    t = t.withColumn("_r", real).select(
        "*",
        F.concat_ws(paths.SEP, *[F.coalesce(F.col(c), gap) for c in levels]).alias("path_full"),
        F.col(levels[1]).alias("branch"),
        F.element_at(F.when(F.size("_r") > 0, F.col("_r")), -1).alias("leaf"),
        F.when(F.size("_r") > 1, paths.joined(F.slice("_r", F.lit(1), F.greatest(F.size("_r") - 1, F.lit(0))))).alias("parent"),
        F.size("_r").alias("depth_distinct"),
        F.coalesce(F.col(levels[0]).isin(*clinical), F.lit(False)).alias("is_clinical"),
        (~F.coalesce(F.col(levels[0]).isin(*clinical, *excluded), F.lit(False))).alias("in_scope"),
    ).drop("_r")
    kids = t.groupBy("tenant", F.coalesce("parent", F.lit("")).alias("_p")).agg(F.size(F.collect_set(F.coalesce("leaf", F.lit("")))).alias("sibling_count"))
    rest = [c for c in t.columns if c not in ("tenant", "category_key")]
    one = t.groupBy("tenant", "category_key").agg(F.min_by(F.struct(*rest), F.struct("path_full", *rest)).alias("r"), (F.count("*") - 1).alias("repeats")).select("tenant", "category_key", "r.*", "repeats")
    used = usage.groupBy("tenant", text.clean(F.col("category_key")).alias("category_key")).agg(F.sum("lines").alias("lines_in_scope"))
    out = one.withColumn("_p", F.coalesce("parent", F.lit(""))).join(kids, ["tenant", "_p"]).drop("_p").join(used, ["tenant", "category_key"], "left")
    return out.withColumn("lines_in_scope", F.coalesce("lines_in_scope", F.lit(0)))


def branches(tree: DataFrame, in_scope_only: bool = True, used_only: bool = False) -> DataFrame:
    """First step of a choice: a tenant's branches, with leaves and lines of each."""
    return _offered(tree, in_scope_only, used_only).where("branch IS NOT NULL").groupBy("tenant", "branch").agg(F.count("*").alias("leaves"), F.sum("lines_in_scope").alias("lines"))


def leaves_of(tree: DataFrame, branch: Column, in_scope_only: bool = True, used_only: bool = False) -> DataFrame:
    """Second step: what stands below a branch of a tenant."""
    return _offered(tree, in_scope_only, used_only).where(F.col("branch") == branch).select("tenant", "branch", "category_key", "leaf", "path_full", "description", "lines_in_scope")


def _offered(tree: DataFrame, in_scope_only: bool, used_only: bool) -> DataFrame:
    t = tree.where("in_scope") if in_scope_only else tree
    return t.where("lines_in_scope > 0") if used_only else t


def placement(lines: DataFrame, nodes: DataFrame, levels: list[str]) -> DataFrame:
    """Adds placing: uncategorised, exact (all levels are a node's), finer (all but the last are) or branch missing."""
    e = nodes.select(*levels).distinct().withColumn("_e", F.lit(True))
    b = nodes.select(*levels[:-1]).distinct().withColumn("_b", F.lit(True))
    j = lines.join(e, levels, "left").join(b, levels[:-1], "left")
    how = F.when(text.uncategorised(F.col("l0")), "uncategorised").when(F.col("_e"), "exact").when(F.col("_b"), "finer").otherwise("branch missing")
    return j.withColumn("placing", how).drop("_e", "_b")


def kept_by(lines: DataFrame, rules: tuple[str, ...] = (), categories: tuple[str, ...] = (), names: tuple[str, ...] = (), category: str = "l0", name: str = "description") -> DataFrame:
    """Lines but those of some rules, of some categories, or whose name contains some text; null is none of these."""
    hit = [F.coalesce(F.col("rule_id").isin(*rules), F.lit(False))] * bool(rules) + [F.coalesce(F.col(category).isin(*categories), F.lit(False))] * bool(categories)
    hit += [F.coalesce(F.contains(F.col(name), F.lit(x)), F.lit(False)) for x in names]
    return lines.where(~text.any_of([F.lit(False), *hit]))


def suspects(lines: DataFrame, category: str, categories: tuple[str, ...], name: str, words: str) -> DataFrame:
    """(rule_id, suspects): lines that a rule put into one of the categories though their name has one of the words
    (a pattern, upper case)."""
    return lines.where(F.col(category).isin(*categories) & F.upper(F.coalesce(name, F.lit(""))).rlike(words)).groupBy("rule_id").agg(F.count("*").alias("suspects"))


def branch_summary(nodes: DataFrame, path: str = "path") -> DataFrame:
    """Nodes, lines and tenants of each branch, the first two levels of a path."""
    s = paths.split_path(F.col(path))
    return nodes.groupBy(F.get(s, F.lit(0)).alias("l0"), F.get(s, F.lit(1)).alias("l1")).agg(F.count("*").alias("nodes"), F.sum("lines").alias("lines"), F.countDistinct("tenant").alias("tenants"))
