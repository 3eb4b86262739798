"""Queries of the engine's own operators over the star-schema tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygrain.functions import keys, paths, text
from tallygrain.operators import actions, checks, decisions, enrich, judge, monitor, normalise, profile, queue, review, sampling, taxonomy
from tallygrain.plans.facts import WITH, Registry, frames
from tallygrain.sources.shared import shared

query = Registry()


def judged() -> Column:
    return F.col("verdict").isNotNull()


LEVELS = ["l0", "l1", "l2", "l3", "l4"]
KEY = "upper(left(sha256({}), 20))"
#: The time that stands for now in panels over events.
NOW = "2024-01-30 12:00:00"
BASE = """SELECT tenant, supplier, count(*) AS lines_total, count(*) FILTER (verdict IS NULL) AS lines_unjudged, count(DISTINCT subject_id) AS subjects,
 CAST(sum(cents) AS BIGINT) AS spend_signed, CAST(sum(abs(cents)) AS BIGINT) AS spend_absolute, count(*) FILTER (supplier IS NULL AND coalesce(description_usable, 'N') <> 'Y') AS has_no_evidence FROM lines GROUP BY tenant, supplier"""
QUEUE = f"""SELECT tenant, supplier, lines_total, lines_unjudged, subjects, spend_signed, spend_absolute, {KEY.format("tenant || '|' || coalesce(supplier, '')")} AS vendor_key,
 CASE WHEN spend_signed <> 0 THEN spend_absolute / abs(spend_signed) END AS d, has_no_evidence FROM ({BASE})"""
RANKED = f"""SELECT tenant, supplier, lines_total, lines_unjudged, subjects, spend_signed, spend_absolute, vendor_key, round(d, 6) AS divergence, has_no_evidence,
 CASE WHEN supplier IS NULL THEN 'no_vendor_name' WHEN d >= 100 THEN 'divergent' END AS flag,
 CASE WHEN lines_unjudged = 0 THEN 'done' WHEN lines_unjudged = lines_total THEN 'pending' ELSE 'in_progress' END AS status,
 row_number() OVER (PARTITION BY tenant ORDER BY spend_signed DESC, vendor_key) AS vendor_rank, row_number() OVER (ORDER BY spend_signed DESC, vendor_key) AS global_rank FROM ({QUEUE})"""


def ranked(spark: SparkSession, d: str, *without: str) -> DataFrame:
    """The vendor queue; columns that a query doesn't show (distinct subjects cost a shuffle of all lines) aren't made."""
    (lines,) = frames(spark, d, "lines")
    return queue.ranked(queue.base(lines, judged()).drop(*without))


@query(RANKED)
def vendor_queue(spark, d):
    return ranked(spark, d).select("tenant", "supplier", "lines_total", "lines_unjudged", "subjects", "spend_signed", "spend_absolute", "vendor_key", F.round("divergence", 6).alias("divergence"), "has_no_evidence", "flag", "status", F.col("vendor_rank").cast("long").alias("vendor_rank"), "global_rank")


@query(f"SELECT tenant, cut, held, total, round(100.0 * held / nullif(total, 0), 2) AS pct FROM (SELECT tenant, unnest([3, 10, 100]) AS cut, CAST(sum(spend_signed) AS BIGINT) AS total, unnest([CAST(sum(CASE WHEN vendor_rank <= 3 THEN spend_signed ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN vendor_rank <= 10 THEN spend_signed ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN vendor_rank <= 100 THEN spend_signed ELSE 0 END) AS BIGINT)]) AS held FROM ({RANKED}) GROUP BY tenant)")
def queue_coverage(spark, d):
    return queue.coverage(ranked(spark, d, "subjects"), (3, 10, 100))


@query(f"SELECT tenant, min(vendor_rank) AS lowest, max(vendor_rank) AS highest, count(DISTINCT vendor_rank) AS different, count(*) AS vendors, min(vendor_rank) = 1 AND max(vendor_rank) = count(*) AND count(DISTINCT vendor_rank) = count(*) AS complete FROM ({RANKED}) GROUP BY tenant")
def queue_rank_check(spark, d):
    q = ranked(spark, d, "subjects")
    return queue.rank_check(q.withColumn("vendor_rank", F.col("vendor_rank").cast("long")))


@query(f"SELECT tenant, supplier, vendor_rank, spend_signed FROM ({RANKED}) WHERE vendor_rank <= 3")
def queue_top3(spark, d):
    return queue.top_in_tenant(ranked(spark, d, "subjects"), 3).select("tenant", "supplier", F.col("vendor_rank").cast("long").alias("vendor_rank"), "spend_signed")


@query("SELECT tenant, supplier, count(*) FILTER (verdict IS NULL) AS unjudged, count(*) FILTER (verdict IS NOT NULL AND jury < 3) AS thin FROM lines GROUP BY tenant, supplier HAVING count(*) FILTER (verdict IS NULL) > 0 OR count(*) FILTER (verdict IS NOT NULL AND jury < 3) > 0")
def resume_scan(spark, d):
    (lines,) = frames(spark, d, "lines")
    return queue.with_work(lines, judged(), F.col("jury"))


@query("SELECT line_id, tenant, cents FROM lines WHERE supplier IS NULL")
def lines_without_vendor(spark, d):
    (lines,) = frames(spark, d, "lines")
    return queue.of_vendor(lines, F.lit(None).cast("string")).select("line_id", "tenant", "cents")


@query("""SELECT 'plain' AS mode, line_id FROM lines WHERE verdict IS NULL UNION ALL SELECT 'uncategorised', line_id FROM lines WHERE suggested_key IS NULL AND l0 = ''
 UNION ALL SELECT 'rejudge', line_id FROM lines WHERE suggested_key IS NULL AND l0 <> '' UNION ALL SELECT 'rejudge uncategorised', line_id FROM lines WHERE suggested_key IS NULL AND l0 = ''
 UNION ALL SELECT 'top up', line_id FROM lines WHERE verdict IS NULL OR (jury < 3 AND l0 <> '')""")
def work_selection(spark, d):
    (lines,) = frames(spark, d, "lines")
    modes = {"plain": {}, "uncategorised": {"uncategorised": True}, "rejudge": {"rejudge": True}, "rejudge uncategorised": {"rejudge": True, "uncategorised": True}, "top up": {"top_up": True}}
    return queue.work_by_mode(lines, {m: k | {"blank": F.col("l0") == "", "answer": "suggested_key"} for m, k in modes.items()}).select("mode", "line_id")


USABLE = "({0} IS NOT NULL AND trim({0}) <> '' AND upper(trim({0})) NOT IN ('NO DESCRIPTION', 'NO DESC', 'N/A', 'NA', 'UNKNOWN', 'NONE', 'NIL', 'TBA', 'MISC', 'MISCELLANEOUS', 'SUNDRY', '.', '-', 'XXX', 'NULL'))"
LEV = "CASE WHEN trim(coalesce(l0, '')) = '' THEN 'Uncategorised' WHEN trim(coalesce({0}, '')) = '' THEN '(not used at this level)' ELSE trim({0}) END"
NAMED = ", ".join(f"{LEV.format(c)} AS {c}" for c in LEVELS)
DESC = f"coalesce(CASE WHEN {USABLE.format('d1')} THEN trim(d1) END, CASE WHEN {USABLE.format('d2')} THEN trim(d2) END, trim(d1), '')"


NORMALISED = f"""(SELECT 'T' AS tenant, line_id, source_row_id, supplier, description, description_usable, description_source, spend, CAST(round(spend * 100) AS BIGINT) AS cents, is_credit, l0, l1, l2, l3, l4, scope,
  concat_ws(' > ', l0, l1, l2, l3, l4) AS path_full,
  array_to_string(list_filter([l0, l1, l2, l3, l4], lambda x: NOT starts_with(x, '(')), ' > ') AS path, depth_distinct, rule_id, tax_key,
  {KEY.format("concat_ws('|', 'T', coalesce(supplier, ''), description, l0, l1, l2, l3, l4)")} AS unit_id, {KEY.format("concat_ws('|', 'T', coalesce(supplier, ''), description)")} AS subject_id, {KEY.format("coalesce(supplier, '')")} AS vendor_key
FROM (SELECT line_id, CAST(line_id AS STRING) AS source_row_id, supplier, rule_id, tax_key, {DESC} AS description, CASE WHEN {USABLE.format('d1')} OR {USABLE.format('d2')} THEN 'Y' ELSE 'N' END AS description_usable,
  CASE WHEN trim(coalesce(d1, '')) <> '' THEN 'd1' WHEN trim(coalesce(d2, '')) <> '' THEN 'd2' ELSE '(none)' END AS description_source, CAST(cents AS DOUBLE) AS spend, CASE WHEN cents < 0 THEN 1 ELSE 0 END AS is_credit,
  {NAMED}, CASE WHEN trim(l0) = '' THEN 'uncategorised' WHEN l0 = 'Excluded' THEN 'out of scope' ELSE 'in scope' END AS scope,
  CAST(len(list_distinct(list_filter([trim(l0), trim(l1), trim(l2), trim(l3), trim(l4)], lambda x: x <> ''))) AS INTEGER) AS depth_distinct FROM lines) WHERE l0 <> 'Excluded')"""
OF_LINE = ("line_id", "source_row_id", "supplier", "description", "description_usable", "description_source", "spend", "cents", "is_credit", *LEVELS, "scope", "path_full", "path", "depth_distinct", "unit_id", "subject_id", "vendor_key")


def normal(spark, d):
    (lines,) = frames(spark, d, "lines")
    cfg = normalise.TenantConfig("T", {"supplier": "supplier", "spend": "cents", "source_row_id": "line_id", "rule_id": "rule_id", "taxonomy_key": "tax_key", **{c: c for c in LEVELS}}, ("d1", "d2"), ("Excluded",))
    return normalise.normalise(lines, cfg, "R1", "star schema")


@query(f"SELECT {', '.join(OF_LINE)} FROM {NORMALISED}")
def normalised_lines(spark, d):
    return normal(spark, d).select(*OF_LINE)


@query(f"""SELECT finding, verdict, count(*) AS lines FROM (SELECT CASE WHEN units > 1 THEN 'contradiction' WHEN l0 = 'Uncategorised' THEN 'uncategorised' WHEN description_usable = 'N' THEN 'unjudgeable' END AS finding,
 CASE WHEN units > 1 THEN 'Incorrect' WHEN l0 = 'Uncategorised' OR description_usable = 'N' THEN 'Uncertain' END AS verdict FROM {NORMALISED} JOIN (SELECT subject_id, count(DISTINCT unit_id) AS units FROM {NORMALISED} GROUP BY 1) USING (subject_id)) GROUP BY finding, verdict""")
def normalised_findings(spark, d):
    return judge.deterministic(normal(spark, d)).groupBy("finding", "verdict").agg(F.count("*").alias("lines"))


@query(f"""SELECT supplier, lines_total, lines_unjudged, subjects, spend_signed, row_number() OVER (ORDER BY spend_signed DESC, k) AS vendor_rank FROM (SELECT supplier, {KEY.format("'T|' || coalesce(supplier, '')")} AS k, count(*) AS lines_total,
 count(*) AS lines_unjudged, count(DISTINCT subject_id) AS subjects, CAST(sum(cents) AS BIGINT) AS spend_signed FROM {NORMALISED} GROUP BY supplier)""")
def normalised_queue(spark, d):
    return queue.ranked(queue.base(normal(spark, d), judged())).select("supplier", "lines_total", "lines_unjudged", "subjects", "spend_signed", "vendor_rank")


@query(f"SELECT rule_id, count(*) AS lines, count(DISTINCT unit_id) AS units, count(DISTINCT supplier) AS vendors, CAST(sum(cents) AS BIGINT) AS cents, round(count(*) / count(DISTINCT unit_id), 6) AS leverage FROM {NORMALISED} GROUP BY rule_id ORDER BY leverage DESC, lines DESC, rule_id LIMIT 3")
def normalised_top_rules(spark, d):
    return profile.top_rules(profile.rule_impact(normal(spark, d)), 3).select("rule_id", "lines", "units", "vendors", "cents", "leverage")


@query("SELECT tenant, count(*) AS lines, count(*) FILTER (l0 <> '') AS categorised, count(*) FILTER (l0 = '') AS blank FROM lines WHERE (trim(l0) NOT IN ('Excluded') OR l0 IS NULL) GROUP BY tenant")
def scope_counts(spark, d):
    (lines,) = frames(spark, d, "lines")
    return lines.where(normalise.in_scope(F.col("l0"), ("Excluded",))).groupBy("tenant").agg(F.count("*").alias("lines"), F.count_if(~text.blank(F.col("l0"))).alias("categorised"), F.count_if(text.blank(F.col("l0"))).alias("blank"))


@query("SELECT l.line_id, k.target_key, k.moved FROM lines l LEFT JOIN cross_ k ON l.tenant = k.tenant AND l.tax_key = k.source_key")
def taxonomy_join(spark, d):
    lines, cross = frames(spark, d, "lines", "cross_")
    return normalise.tenant_join(lines, cross.withColumnRenamed("source_key", "tax_key"), ["tenant", "tax_key"]).select("line_id", "target_key", "moved")


@query("SELECT l.line_id, coalesce(a.src, b.src) AS src FROM lines l LEFT JOIN (SELECT DISTINCT tenant, rule_id, 'first' AS src FROM lines WHERE line_no < 3 AND rule_id < '3') a ON l.tenant = a.tenant AND l.rule_id = a.rule_id LEFT JOIN (SELECT DISTINCT tenant, rule_id, 'second' AS src FROM lines WHERE line_no > 2 AND rule_id < '5') b ON l.tenant = b.tenant AND l.rule_id = b.rule_id")
def first_rule_join(spark, d):
    (lines,) = frames(spark, d, "lines")
    a = lines.where("line_no < 3 AND rule_id < '3'").select("tenant", "rule_id", F.lit("first").alias("src"))
    b = lines.where("line_no > 2 AND rule_id < '5'").select("tenant", "rule_id", F.lit("second").alias("src"))
    return normalise.tenant_join(lines, normalise.first_rule([a, b], ["tenant", "rule_id"]), ["tenant", "rule_id"]).select("line_id", "src")


@query("""SELECT tenant, source_key, (SELECT count(DISTINCT CASE a.dd WHEN 1 THEN trim(b.g) WHEN 2 THEN trim(b.l1) WHEN 3 THEN trim(b.l2) WHEN 4 THEN trim(b.l3) WHEN 5 THEN trim(b.l4) END) FROM nodes b WHERE b.tenant = a.tenant
 AND (a.dd < 2 OR trim(b.g) = trim(a.g)) AND (a.dd < 3 OR trim(b.l1) = trim(a.l1)) AND (a.dd < 4 OR trim(b.l2) = trim(a.l2)) AND (a.dd < 5 OR trim(b.l3) = trim(a.l3))) AS siblings
 FROM (SELECT *, len(list_distinct(list_filter([trim(g), trim(l1), trim(l2), trim(l3), trim(l4)], lambda x: x <> ''))) AS dd FROM nodes) a""")
def sibling_counts(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return normalise.sibling_counts(nodes.select("tenant", "source_key", "g", "l1", "l2", "l3", "l4"), ["g", "l1", "l2", "l3", "l4"]).select("tenant", "source_key", "siblings")


@query("""SELECT tenant, count(*) AS lines, CAST(sum(cents) AS BIGINT) AS signed, CAST(sum(abs(cents)) AS BIGINT) AS absolute, count(DISTINCT supplier) AS vendors, count(*) FILTER (supplier IS NULL) AS no_vendor, count(*) FILTER (cents < 0) AS credits, CAST(coalesce(sum(abs(cents)) FILTER (cents < 0), 0) AS BIGINT) AS credited, count(*) FILTER (cents IS NULL) AS unparseable,
 count(*) FILTER (l0 = '') AS no_gate, count(*) FILTER (rtrim(coalesce(d1, '')) = '') AS blank_text, count(*) FILTER (length(rtrim(d1)) IN (1, 2, 3, 4, 5, 6, 7)) AS very_short, count(*) FILTER (upper(d1) LIKE '%MRN%' OR upper(d1) LIKE '%UR NO%' OR upper(d1) LIKE '%U/R%' OR upper(d1) LIKE '%D.O.B%' OR upper(d1) LIKE '%DOB %') AS pii_marker,
 count(*) FILTER (length(rtrim(coalesce(d1, ''))) < 10) AS short_text, count(*) FILTER (rtrim(coalesce(d1, '')) <> '' AND NOT regexp_matches(d1, '[^0-9 .,/-]')) AS numeric_only, count(*) FILTER (regexp_matches(coalesce(d1, ''), '[0-9]{6}')) AS long_digits FROM lines GROUP BY tenant""")
def profile_volume(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.volume(lines, "supplier", "cents", "d1", "l0", ["tenant"])


@query("SELECT tenant, count(*) AS units, count(DISTINCT coalesce(supplier, '?') || '/' || subject_id) AS subjects, CAST(sum(n) AS BIGINT) AS lines FROM (SELECT tenant, supplier, subject_id, unit_id, count(*) AS n FROM lines GROUP BY ALL) GROUP BY tenant")
def profile_units(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.units(lines, ["tenant"], ["supplier", "subject_id", "unit_id"], ["supplier", "subject_id"])


@query("""SELECT field, filled, first_filled, lines, round(100.0 * filled / lines, 4) AS share FROM (SELECT count(*) AS lines, unnest(['d1', 'd2', '(all blank)']) AS field, unnest([count(*) FILTER (trim(coalesce(d1, '')) <> ''), count(*) FILTER (trim(coalesce(d2, '')) <> ''), 0]) AS filled,
 unnest([count(*) FILTER (trim(coalesce(d1, '')) <> ''), count(*) FILTER (trim(coalesce(d1, '')) = '' AND trim(coalesce(d2, '')) <> ''), count(*) FILTER (trim(coalesce(d1, '')) = '' AND trim(coalesce(d2, '')) = '')]) AS first_filled FROM lines)""")
def profile_fill_rates(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.fill_rates(lines, ["d1", "d2"])


@query(" UNION ALL ".join(f"SELECT '{c}' AS level, count(DISTINCT nullif(trim({c}), '')) AS distinct_values, count(*) FILTER (trim(coalesce({c}, '')) = '') AS blank_lines FROM lines" for c in LEVELS))
def profile_levels(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.level_counts(lines, LEVELS)


@query(" UNION ALL ".join(f"SELECT '{c}' AS level, coalesce(nullif(trim({c}), ''), '(blank)') AS value, count(*) AS lines, CAST(sum(cents) AS BIGINT) AS signed FROM lines GROUP BY 2" for c in LEVELS))
def profile_level_values(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.level_values(lines, LEVELS, "cents")


TENANTS = [f"NATION_{k}" for k in range(25)]
FILLED = ["supplier", "d1", "d2", "l0", "l2"]


@query(" UNION ALL ".join(f"SELECT '{c}' AS field, " + ", ".join(f"CAST(sum(CASE WHEN trim(coalesce({c}, '')) <> '' THEN 1 ELSE 0 END) FILTER (tenant = '{t}') AS BIGINT) AS \"{t}\"" for t in TENANTS) + " FROM lines" for c in FILLED))
def profile_fill_matrix(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.fill_matrix(lines, FILLED, TENANTS)


@query("SELECT tenant, rule_id, count(*) AS lines, count(DISTINCT unit_id) AS units, count(DISTINCT supplier) AS vendors, CAST(sum(cents) AS BIGINT) AS cents, count(*) FILTER (l0 = 'Excluded') AS out_of_scope FROM lines GROUP BY tenant, rule_id")
def rule_impact(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.rule_impact(lines)


@query("SELECT tenant, strftime(shipped, '%Y-%m') AS month, count(*) AS lines FROM lines GROUP BY 1, 2")
def monthly_volume(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.monthly(lines, "shipped")[0]


@query("SELECT tenant, min(lines) AS least, median(lines) AS middle, max(lines) AS most, count(*) AS months FROM (SELECT *, row_number() OVER (PARTITION BY tenant ORDER BY month DESC) AS k FROM (SELECT tenant, strftime(shipped, '%Y-%m') AS month, count(*) AS lines FROM lines GROUP BY 1, 2)) WHERE k <= 12 GROUP BY tenant")
def monthly_range(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.monthly(lines, "shipped")[1]


@query("SELECT min(lines) AS least, median(lines) AS middle, max(lines) AS most, count(*) AS months FROM (SELECT month, CAST(sum(lines) AS BIGINT) AS lines FROM (SELECT *, row_number() OVER (PARTITION BY tenant ORDER BY month DESC) AS k FROM (SELECT tenant, strftime(shipped, '%Y-%m') AS month, count(*) AS lines FROM lines GROUP BY 1, 2)) WHERE k <= 12 GROUP BY month)")
def monthly_combined(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.combined_range(profile.monthly(lines, "shipped")[0])


@query("SELECT d1, count(*) AS lines, CAST(sum(abs(cents)) AS BIGINT) AS absolute FROM lines GROUP BY d1 ORDER BY absolute DESC, d1 LIMIT 10")
def top_descriptions(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.top_by_absolute(lines, "d1", "cents", 10)


@query("SELECT tenant, count(*) AS total, count(DISTINCT rule_id) AS different, count(*) - count(DISTINCT rule_id) AS repeated FROM lines GROUP BY tenant")
def duplicate_rule_keys(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.duplicate_keys(lines, "tenant", "rule_id")


@query("SELECT line_id, tenant FROM lines ORDER BY sha256(CAST(line_id AS STRING)), line_id, tenant LIMIT 200")
def hash_sample(spark, d):
    (lines,) = frames(spark, d, "lines")
    return sampling.hash_sample(lines.select("line_id", "tenant"), "line_id", 200, ("tenant",))


@query("(SELECT line_id, 'categorised' AS stratum FROM lines WHERE l0 <> '' ORDER BY sha256(CAST(line_id AS STRING)), line_id LIMIT 80) UNION ALL (SELECT line_id, 'uncategorised' FROM lines WHERE l0 = '' ORDER BY sha256(CAST(line_id AS STRING)), line_id LIMIT 40)")
def stratified_sample(spark, d):
    (lines,) = frames(spark, d, "lines")
    return sampling.stratified(lines.select("line_id", "l0"), "line_id", text.blank(F.col("l0")), 80, 40).select("line_id", "stratum")


@query("SELECT line_id, supplier FROM lines WHERE CAST('0x' || left(md5(coalesce(supplier, '')), 8) AS BIGINT) % 4 = 0")
def vendor_spread(spark, d):
    (lines,) = frames(spark, d, "lines")
    return sampling.one_in(lines.select("line_id", "supplier"), F.col("supplier"), 4)


@query("SELECT tenant, min(n) AS low, max(n) AS high FROM (SELECT tenant, n, n - row_number() OVER (PARTITION BY tenant ORDER BY n) AS g FROM (SELECT DISTINCT tenant, part_id AS n FROM lines)) GROUP BY tenant, g")
def number_ranges(spark, d):
    (lines,) = frames(spark, d, "lines")
    return sampling.ranges(lines.select("tenant", F.col("part_id").alias("n")).distinct(), "tenant", "n")


@query("SELECT tenant, subject_id, count(DISTINCT unit_id) AS units FROM lines GROUP BY tenant, subject_id HAVING count(DISTINCT unit_id) > 1")
def contradictions(spark, d):
    (lines,) = frames(spark, d, "lines")
    return judge.contradictions(lines)


FOUND = "CASE WHEN c.subject_id IS NOT NULL THEN 'contradiction' WHEN l0 = '' THEN 'uncategorised' WHEN description_usable = 'N' THEN 'unjudgeable' END"


@query(f"""SELECT line_id, CASE WHEN verdict IS NULL THEN {FOUND} END AS finding, coalesce(verdict, CASE {FOUND} WHEN 'contradiction' THEN 'Incorrect' WHEN 'uncategorised' THEN 'Uncertain' WHEN 'unjudgeable' THEN 'Uncertain' END) AS verdict,
 CASE WHEN verdict IS NULL AND {FOUND} IS NOT NULL THEN 1.0::DOUBLE END AS confidence, CASE WHEN verdict IS NULL THEN 'deterministic_' || {FOUND} END AS basis
 FROM lines l LEFT JOIN (SELECT tenant, subject_id FROM lines GROUP BY 1, 2 HAVING count(DISTINCT unit_id) > 1) c ON l.tenant = c.tenant AND l.subject_id = c.subject_id""")
def deterministic_verdicts(spark, d):
    (lines,) = frames(spark, d, "lines")
    return judge.deterministic(lines).select("line_id", "finding", "verdict", "confidence", "basis")


TALLY = """WITH_v AS (SELECT *, nullif(trim(suggested_key), '') AS k FROM votes WHERE verdict IN ('Correct', 'Incorrect', 'Uncertain')),
n AS (SELECT line_id, verdict, count(*) AS n, sum(count(*)) OVER (PARTITION BY line_id) AS got, row_number() OVER (PARTITION BY line_id ORDER BY count(*) DESC, verdict) AS r FROM WITH_v GROUP BY line_id, verdict),
a AS (SELECT v.*, n.n, n.got FROM WITH_v v JOIN n ON v.line_id = n.line_id AND v.verdict = n.verdict WHERE n.r = 1),
dest AS (SELECT line_id, k, row_number() OVER (PARTITION BY line_id ORDER BY count(*) DESC, k) AS r FROM a JOIN keys_ ON k = category_key WHERE in_scope GROUP BY line_id, k HAVING count(*) >= 2),
b AS (SELECT line_id, basis, row_number() OVER (PARTITION BY line_id ORDER BY count(*) DESC, basis) AS r FROM a WHERE basis IN ('description', 'supplier', 'rule', 'no_evidence') GROUP BY line_id, basis),
g AS (SELECT line_id, any_value(verdict) AS verdict, any_value(n) AS n, any_value(got) AS got, avg(CASE WHEN confidence IS NULL THEN 0 ELSE least(greatest(coalesce(TRY_CAST(confidence AS DOUBLE), 0), 0), 1) END) AS confidence, arg_min(rationale, CASE WHEN rationale IS NOT NULL THEN seat END) AS rationale FROM a GROUP BY line_id)
SELECT g.line_id, CASE WHEN n < 2 THEN 'Uncertain' ELSE verdict END AS verdict, CASE WHEN n < 2 THEN 'split' ELSE n || 'of' || CAST(got AS BIGINT) END AS agreement, CASE WHEN n < 2 THEN 0.0 ELSE round(confidence, 3) END AS confidence, CASE WHEN n < 2 THEN 'no_evidence' ELSE coalesce(b.basis, 'no_evidence') END AS basis, CASE WHEN n >= 2 THEN dest.k END AS suggested_key, CASE WHEN n < 2 THEN 'no two answers agree' ELSE rationale END AS rationale, CAST(got AS BIGINT) AS jury
FROM g LEFT JOIN dest ON g.line_id = dest.line_id AND dest.r = 1 LEFT JOIN b ON g.line_id = b.line_id AND b.r = 1"""


def vote_tally(spark, d):
    votes, keys_ = frames(spark, d, "votes", "keys_")
    return judge.tally(votes, keys_)


def _tally_sql() -> str:
    return WITH.rstrip() + ", " + TALLY


query.queries["vote_tally"], query.sql["vote_tally"] = vote_tally, _tally_sql()


@query("SELECT s.seat, count(u.line_id) AS answered, count(*) - count(u.line_id) AS alien, any_value(c.sent) AS sent, any_value(c.sent) - count(u.line_id) AS missing FROM (SELECT DISTINCT seat, line_id + CASE WHEN (line_id + seat) % 17 = 0 THEN 100000000 ELSE 0 END AS line_id FROM votes WHERE verdict IS NOT NULL) s LEFT JOIN (SELECT DISTINCT line_id FROM lines WHERE verdict IS NOT NULL) u ON s.line_id = u.line_id CROSS JOIN (SELECT count(DISTINCT line_id) AS sent FROM lines WHERE verdict IS NOT NULL) c GROUP BY s.seat")
def answer_coverage(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    answers = votes.where("verdict IS NOT NULL").select("seat", (F.col("line_id") + F.when((F.col("line_id") + F.col("seat")) % 17 == 0, 100000000).otherwise(0)).alias("line_id"))
    return judge.coverage(lines.where(judged()), answers)


@query("SELECT line_id, votes, votes < 3 AS thin, votes = 0 AS lost FROM (SELECT u.line_id, count(DISTINCT v.seat) AS votes FROM lines u LEFT JOIN (SELECT line_id, seat FROM votes WHERE verdict IS NOT NULL AND (line_id + seat) % 17 <> 0 AND line_id % 31 <> 0) v USING (line_id) WHERE verdict IS NOT NULL GROUP BY u.line_id)")
def line_coverage(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    alien = F.when((F.col("line_id") + F.col("seat")) % 17 == 0, -1).otherwise(1)  # answers about lines that nobody sent
    answers = votes.where("verdict IS NOT NULL AND line_id % 31 <> 0").withColumn("line_id", F.col("line_id") * alien)
    return judge.line_coverage(lines.where(judged()), answers.unionByName(answers), (0, 1, 2))


@query("SELECT batch, line_id, seat FROM (SELECT line_id % 997 AS batch, line_id, CAST(seat AS INTEGER) AS seat FROM lines CROSS JOIN (VALUES (0), (1), (2)) AS s(seat) WHERE verdict IS NOT NULL) WHERE (batch, seat) NOT IN (SELECT (line_id % 997, seat) FROM votes WHERE (line_id % 997 + seat) % 50 <> 0 AND (line_id % 997 <= 900 OR verdict IS NOT NULL))")
def ask_again(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    batch = (F.col("line_id") % 997).alias("batch")
    heard = votes.where("(line_id % 997 + seat) % 50 <> 0 AND NOT (line_id % 997 > 900 AND verdict IS NULL)")
    return judge.ask_again(lines.where(judged()).select(batch, "line_id"), heard, (0, 1, 2))


@query("SELECT line_id, seat, CASE WHEN verdict IS NULL OR verdict NOT IN ('Correct', 'Incorrect', 'Uncertain') THEN 'verdict' WHEN basis NOT IN ('description', 'supplier', 'rule', 'no_evidence') THEN 'basis' WHEN category_key IS NULL THEN 'unknown key' WHEN NOT in_scope AND line_id % 2 = 0 THEN 'out of scope' END AS reject_reason FROM votes LEFT JOIN keys_ ON trim(suggested_key) = category_key")
def validated_answers(spark, d):
    votes, keys_ = frames(spark, d, "votes", "keys_")
    a = votes.withColumn("suggested_key", F.trim("suggested_key")).withColumn("uncategorised", F.col("line_id") % 2 != 0)
    return judge.validated(a, keys_).select("line_id", "seat", "reject_reason")


@query("SELECT line_id, CASE WHEN line_id % 3 <> 0 AND (jury IS NULL OR jury <= 2) THEN 'new' ELSE verdict END AS verdict, CASE WHEN line_id % 3 <> 0 AND (jury IS NULL OR jury <= 2) THEN 2 ELSE jury END AS jury FROM (SELECT line_id, max(verdict) AS verdict, max(jury) AS jury FROM lines GROUP BY line_id)")
def merge_larger_jury(spark, d):
    (lines,) = frames(spark, d, "lines")
    old = lines.groupBy("line_id").agg(F.max("verdict").alias("verdict"), F.max("jury").alias("jury"))
    new = old.where("line_id % 3 <> 0").select("line_id", F.lit("new").alias("verdict"), F.lit(2).cast("long").alias("jury"))
    return judge.keep_larger_jury(old, new)


@query("SELECT tenant, rule_id, lines, judged, bad, unsure, round(CASE WHEN judged - unsure > 0 THEN bad / (judged - unsure) END, 6) AS error_rate, judged = lines AS is_complete FROM (SELECT tenant, rule_id, count(*) AS lines, count(verdict) AS judged, count(*) FILTER (verdict = 'Incorrect') AS bad, count(*) FILTER (verdict = 'Uncertain') AS unsure FROM lines GROUP BY 1, 2)")
def rule_rollup(spark, d):
    (lines,) = frames(spark, d, "lines")
    return judge.rule_rollup(lines)


@query("SELECT tenant, count(*) AS repeated, count(*) FILTER (v > 1) AS inconsistent FROM (SELECT tenant, unit_id, count(*) AS n, count(DISTINCT verdict) AS v FROM lines WHERE verdict IS NOT NULL GROUP BY 1, 2) WHERE n > 1 GROUP BY tenant")
def self_consistency(spark, d):
    (lines,) = frames(spark, d, "lines")
    return judge.consistency(lines)


UND = "lower(trim(coalesce({0}, ''))) IN ('', 'uncategorised', 'uncategorized', 'not yet categorized', 'not yet categorised', 'not categorised', 'not categorized', '(not used at this level)', 'none', 'n/a')"
ACTION = f"""SELECT l.*, c.target_key, CASE WHEN lower(k.l0) IN ('clinical', 'inter-hospital spend') THEN 'Out of scope' WHEN verdict = 'Uncertain' THEN 'Needs evidence' WHEN verdict = 'Incorrect' AND suggested_key IS NULL THEN 'Needs evidence'
 WHEN {UND.format('l.l2')} AND {UND.format('l.l3')} AND {UND.format('l.l4')} THEN 'Incomplete' WHEN suggested_key = c.target_key THEN 'Re-mapped' WHEN verdict = 'Correct' AND coalesce(c.moved, false) THEN 'Re-mapped' WHEN verdict = 'Incorrect' THEN 'Miscategorised' ELSE 'No change' END AS action,
 CASE WHEN verdict = 'Correct' AND coalesce(c.moved, false) AND suggested_key IS NULL AND NOT ({UND.format('l.l2')} AND {UND.format('l.l3')} AND {UND.format('l.l4')}) THEN c.target_key END AS fill_key
 FROM lines l LEFT JOIN cross_ c ON l.tenant = c.tenant AND l.tax_key = c.source_key LEFT JOIN keys_ k ON l.suggested_key = k.category_key WHERE verdict IS NOT NULL"""


def acted(spark, d):
    lines, cross, keys_ = frames(spark, d, "lines", "cross_", "keys_")
    return actions.classify(lines.where(judged()), cross, keys_)


@query(f"SELECT line_id, action, fill_key FROM ({ACTION})")
def action_table(spark, d):
    return acted(spark, d).select("line_id", "action", "fill_key")


@query(f"SELECT coalesce(action, '(all)') AS action, coalesce(verdict, '(all)') AS verdict, count(*) AS lines FROM ({ACTION}) GROUP BY CUBE (action, verdict)")
def action_grid(spark, d):
    return actions.grid(acted(spark, d))


@query(f"SELECT ord, t.action, coalesce(lines, 0) AS lines FROM (VALUES (0, 'Out of scope'), (1, 'Needs evidence'), (2, 'Incomplete'), (3, 'Re-mapped'), (4, 'Miscategorised'), (5, 'No change')) AS t(ord, action) LEFT JOIN (SELECT action, count(*) AS lines FROM ({ACTION}) GROUP BY action) a ON t.action = a.action")
def action_breakdown(spark, d):
    return actions.breakdown(acted(spark, d))


@query(f"SELECT tenant, action, count(*) AS lines, CAST(sum(cents) AS BIGINT) AS cents FROM ({ACTION}) GROUP BY tenant, action")
def action_mix(spark, d):
    return monitor.action_mix(acted(spark, d))


CHECKED = f"(SELECT * REPLACE (CASE WHEN verdict IS NOT NULL THEN action END AS action), CASE WHEN line_id % 50 = 0 THEN 'see Account Name' ELSE 'fits' END AS rationale FROM ({ACTION.removesuffix(' WHERE verdict IS NOT NULL')}))"


@query(f"""WITH_c AS (SELECT count(*) AS n, 1 AS runs, count(*) FILTER (verdict IS NULL) AS unjudged, count(*) FILTER (action IS NULL) AS no_action,
 count(*) FILTER (rationale ILIKE '%account name%' OR rationale ILIKE '%cost centre%' OR rationale ILIKE '%GL %' OR rationale ILIKE '%general ledger%') AS leaks,
 count(*) FILTER (action = 'Re-mapped' AND suggested_key IS NULL) AS remapped, count(*) FILTER (action = 'Miscategorised' AND suggested_key IS NULL) AS misc, count(*) FILTER (jury < 3) AS thin FROM {CHECKED})
SELECT 'lines as loaded' AS name, n AS value, (SELECT count(*) FROM lineitem) AS expected, n = (SELECT count(*) FROM lineitem) AS ok FROM WITH_c UNION ALL SELECT 'distinct runs', runs, 1, runs = 1 FROM WITH_c
UNION ALL SELECT 'lines without a verdict', unjudged, 0, unjudged = 0 FROM WITH_c UNION ALL SELECT 'lines without an action', no_action, 0, no_action = 0 FROM WITH_c UNION ALL SELECT 'rationales citing the ledger', leaks, 0, leaks = 0 FROM WITH_c
UNION ALL SELECT 'Re-mapped without a destination', remapped, 0, remapped = 0 FROM WITH_c UNION ALL SELECT 'Miscategorised without a destination', misc, 0, misc = 0 FROM WITH_c
UNION ALL SELECT 'lines with a thin jury', thin, CAST(floor(n * 0.01) AS BIGINT), thin <= floor(n * 0.01) FROM WITH_c""".replace("WITH_c AS (SELECT count", ", WITH_c AS (SELECT count", 1))
def run_invariants(spark, d):
    lines, cross, keys_, items = frames(spark, d, "lines", "cross_", "keys_", "lineitem")
    a = actions.classify(lines, cross, keys_).withColumn("action", F.when(judged(), F.col("action"))).withColumn("run_id", F.lit("r1"))
    a = a.withColumn("rationale", F.when(F.col("line_id") % 50 == 0, "see Account Name").otherwise("fits"))
    return checks.invariants(a, items.agg(F.lit("r1").alias("run_id"), F.count("*").alias("lines_loaded")))


@query("SELECT tenant, count(*) AS lines, count(*) FILTER (supplier IS NULL) AS \"foreign\" FROM lines GROUP BY tenant")
def tenant_isolation(spark, d):
    (lines,) = frames(spark, d, "lines")
    return checks.isolation(lines, F.col("supplier").startswith("Supplier#"))


@query("SELECT tenant, a.n AS a, b.n AS b, a.n IS NOT DISTINCT FROM b.n AS ok FROM (SELECT tenant, count(*) AS n FROM lines GROUP BY tenant) a FULL JOIN (SELECT n_name AS tenant, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name) b USING (tenant)")
def reconciled_counts(spark, d):
    (lines,) = frames(spark, d, "lines")
    q = queue.base(lines, judged()).groupBy("tenant").agg(F.sum("lines_total").alias("n"))
    return checks.reconcile(lines.groupBy("tenant").agg(F.count("*").alias("n")), q, ["tenant"], "n")


@query("SELECT 'tax_key=source_key' AS pair, count(*) FILTER (tax_key IN (SELECT source_key FROM cross_)) AS matches FROM lines UNION ALL SELECT 'rule_id=source_key', count(*) FILTER (rule_id IN (SELECT source_key FROM cross_)) FROM lines")
def join_key_discovery(spark, d):
    lines, cross = frames(spark, d, "lines", "cross_")
    return checks.best_join_key(lines, cross, [("tax_key", "source_key"), ("rule_id", "source_key")])


@query("SELECT tenant, count(*) AS lines, count(verdict) AS judged, count(*) FILTER (verdict = 'Correct') AS correct, count(*) FILTER (verdict = 'Incorrect') AS incorrect, count(*) FILTER (verdict = 'Uncertain') AS uncertain, round(100.0 * count(*) FILTER (verdict = 'Incorrect') / nullif(count(*) FILTER (verdict IN ('Correct', 'Incorrect')), 0), 4) AS error_rate, count(*) FILTER (jury < 3) AS thin, CAST(sum(cents) AS BIGINT) AS cents FROM lines GROUP BY tenant")
def tenant_panel(spark, d):
    (lines,) = frames(spark, d, "lines")
    return monitor.panel(lines)


@query("SELECT tenant, count(*) AS vendors, count(*) FILTER (o = 0) AS finished FROM (SELECT tenant, supplier, count(*) FILTER (verdict IS NULL) AS o FROM lines GROUP BY 1, 2) GROUP BY tenant")
def finished_vendors(spark, d):
    (lines,) = frames(spark, d, "lines")
    return monitor.finished_vendors(lines)


@query("SELECT seat, count(*) FILTER (v.verdict = 'Correct') AS correct, count(*) FILTER (v.verdict = 'Incorrect') AS incorrect, count(*) FILTER (v.verdict = 'Uncertain') AS uncertain, count(*) FILTER (v.verdict IS NULL) AS silent, count(*) FILTER (v.verdict = 'maybe') AS invalid, count(*) FILTER (v.verdict = l.verdict) AS agrees FROM votes v LEFT JOIN lines l USING (line_id) GROUP BY seat")
def seat_panel(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    return monitor.seats(votes, lines, text.VERDICTS)


@query("SELECT supplier, count(*) AS errors FROM lines WHERE verdict = 'Incorrect' GROUP BY supplier ORDER BY errors DESC, supplier NULLS FIRST LIMIT 15")
def top_error_vendors(spark, d):
    (lines,) = frames(spark, d, "lines")
    return monitor.top_errors(lines, "supplier", 15)


@query("SELECT l.verdict AS \"first\", v.verdict AS \"second\", count(*) AS lines, round(100.0 * count(*) / sum(count(*)) OVER (), 4) AS pct FROM lines l JOIN votes v USING (line_id) WHERE v.seat = 0 GROUP BY 1, 2")
def verdict_crosstab(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    return monitor.crosstab(lines, votes.where("seat = 0"))


@query(f"SELECT h.hour, coalesce(n, 0) AS n FROM (SELECT unnest(generate_series(date_trunc('hour', TIMESTAMP '{NOW}') - INTERVAL 47 HOURS, date_trunc('hour', TIMESTAMP '{NOW}'), INTERVAL 1 HOUR)) AS hour) h LEFT JOIN (SELECT date_trunc('hour', ts) AS hour, count(*) AS n FROM events WHERE ts <= TIMESTAMP '{NOW}' GROUP BY 1) e USING (hour)", derived=False)
def hourly_bins(spark, d):
    (events,) = frames(spark, d, "events")
    return monitor.hourly(events, "ts", F.lit(NOW).cast("timestamp_ntz").cast(events.schema["ts"].dataType))


RATE = "round(CASE WHEN n{0} = 0 THEN 0.0 WHEN least(epoch_us(TIMESTAMP '" + NOW + "') - epoch_us(f{0}), CAST({0} AS BIGINT) * 60000000) > 0 THEN n{0} / (least((epoch_us(TIMESTAMP '" + NOW + "') - epoch_us(f{0})) / 60e6, {0}.0)) ELSE CAST(n{0} AS DOUBLE) END, 4)"


@query(f"SELECT rows, judged, last, n15, n60, {RATE.format(15)} AS rate15, {RATE.format(60)} AS rate60 FROM (SELECT count(*) AS rows, count(*) FILTER (event_type <> 'error') AS judged, max(ts) FILTER (event_type <> 'error') AS last, " + ", ".join(f"count(*) FILTER (event_type <> 'error' AND ts > TIMESTAMP '{NOW}' - INTERVAL {m} MINUTES AND ts <= TIMESTAMP '{NOW}') AS n{m}, min(ts) FILTER (event_type <> 'error' AND ts > TIMESTAMP '{NOW}' - INTERVAL {m} MINUTES AND ts <= TIMESTAMP '{NOW}') AS f{m}" for m in (15, 60)) + " FROM events)", derived=False)
def heartbeat(spark, d):
    (events,) = frames(spark, d, "events")
    now = F.lit(NOW).cast("timestamp")
    h = monitor.heartbeat(events.withColumn("ts", F.col("ts").cast("timestamp")), "ts", F.col("event_type") != "error", now)
    return h.select("rows", "judged", F.col("last").cast(events.schema["ts"].dataType).alias("last"), "n15", "n60", monitor.rate(F.col("n15"), F.col("first15"), now, 15).alias("rate15"), monitor.rate(F.col("n60"), F.col("first60"), now, 60).alias("rate60"))


@query("SELECT user_id, ts AS recovered, last_seen FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS last_seen FROM events) WHERE epoch_us(ts) - epoch_us(last_seen) > 86400000000", derived=False)
def stall_gaps(spark, d):
    (events,) = frames(spark, d, "events")
    return monitor.stalls(events.withColumn("ts", F.col("ts").cast("timestamp")), "user_id", "ts", 1440).select("user_id", *[F.col(c).cast(events.schema["ts"].dataType).alias(c) for c in ("recovered", "last_seen")])


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events", derived=False)
def json_fields(spark, d):
    (events,) = frames(spark, d, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT tenant, path, source_key, regexp_replace(upper(replace(l3, '&', ' AND ')), '[^\\p{L}\\p{N}]', '', 'g') AS loose_l3 FROM nodes")
def loose_labels(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return nodes.select("tenant", "path", "source_key", text.loose(F.col("l3")).alias("loose_l3"))


@query("SELECT tenant, source_key, CAST(len(string_split(path, ' > ')) - CASE WHEN lower(l3) = lower(l4) THEN 1 ELSE 0 END AS INTEGER) AS depth, 'Goods > ' || l1 || ' > ' || l2 || ' > ' || l3 || CASE WHEN lower(l3) = lower(l4) THEN '' ELSE ' > ' || l4 END AS canon FROM nodes")
def canonical_paths(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    c = paths.canonical(paths.split_path(F.col("path")))
    return nodes.select("tenant", "source_key", F.size(c).alias("depth"), paths.joined(c).alias("canon"))


@query("SELECT tenant, source_key, l1, l2, CASE WHEN bu >= bl THEN upper(l3) ELSE lower(l3) END AS l3 FROM (SELECT n.*, coalesce(u.s, 0) AS bu, coalesce(w.s, 0) AS bl FROM nodes n LEFT JOIN (SELECT l1, l2, upper(l3) AS k, sum(lines) AS s FROM nodes WHERE l3 = upper(l3) GROUP BY ALL) u ON u.l1 = n.l1 AND u.l2 = n.l2 AND u.k = upper(n.l3) LEFT JOIN (SELECT l1, l2, upper(l3) AS k, sum(lines) AS s FROM nodes WHERE l3 = lower(l3) GROUP BY ALL) w ON w.l1 = n.l1 AND w.l2 = n.l2 AND w.k = upper(n.l3))")
def unified_spelling(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return taxonomy.unified_spelling(nodes, ["g", "l1", "l2", "l3", "l4"]).select("tenant", "source_key", "l1", "l2", "l3")


LOOSE = r"regexp_replace(upper(replace({}, '&', ' AND ')), '[^\p{{L}}\p{{N}}]', '', 'g')"
SIBLINGS = "(SELECT parent, level, label, sum(lines) AS lines FROM (" + " UNION ALL ".join(f"SELECT {p} AS parent, {k} AS level, {c} AS label, lines FROM nodes" for k, c, p in ((1, "l1", "g"), (2, "l2", "g || '/' || l1"), (3, "l3", "g || '/' || l1 || '/' || l2"), (4, "l4", "g || '/' || l1 || '/' || l2 || '/' || l3"))) + ") GROUP BY ALL)"


@query(f"""SELECT level, a, b, CAST(min(e) AS INTEGER) AS edits, count(DISTINCT parent) AS parents, CAST(sum(la) AS BIGINT) AS lines_a, CAST(sum(lb) AS BIGINT) AS lines_b,
 CASE WHEN min(e) = 1 AND (starts_with(any_value(ka), any_value(kb)) OR starts_with(any_value(kb), any_value(ka)) OR ends_with(any_value(ka), any_value(kb)) OR ends_with(any_value(kb), any_value(ka)) OR count(DISTINCT parent) >= 3) THEN 'auto' ELSE 'flag' END AS ruling
 FROM (SELECT x.parent, x.level, x.label AS a, y.label AS b, {LOOSE.format("x.label")} AS ka, {LOOSE.format("y.label")} AS kb, levenshtein({LOOSE.format("x.label")}, {LOOSE.format("y.label")}) AS e, x.lines AS la, y.lines AS lb
  FROM {SIBLINGS} x JOIN {SIBLINGS} y ON x.parent = y.parent AND x.level = y.level AND x.label < y.label) WHERE e BETWEEN 1 AND 2 AND length(ka) >= 5 AND length(kb) >= 5 GROUP BY level, a, b""")
def typo_pairs(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    levels = ["g", "l1", "l2", "l3", "l4"]
    each = F.explode(F.array(*[F.struct(F.concat_ws("/", *levels[:k]).alias("parent"), F.lit(k).alias("level"), F.col(levels[k]).alias("label")) for k in range(1, 5)]))
    return taxonomy.typo_pairs(nodes.select(each.alias("x"), "lines").select("x.*", "lines"))


@query("SELECT x.tenant AS a, y.tenant AS b, count(*) AS shared, round(count(*) / least(any_value(nx.n), any_value(ny.n)), 6) AS overlap FROM (SELECT DISTINCT tenant, path FROM nodes) x JOIN (SELECT DISTINCT tenant, path FROM nodes) y ON x.path = y.path AND x.tenant < y.tenant JOIN (SELECT tenant, count(DISTINCT path) AS n FROM nodes GROUP BY 1) nx ON nx.tenant = x.tenant JOIN (SELECT tenant, count(DISTINCT path) AS n FROM nodes GROUP BY 1) ny ON ny.tenant = y.tenant GROUP BY x.tenant, y.tenant")
def tree_overlaps(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return taxonomy.overlaps(nodes)


@query("SELECT path FROM nodes WHERE tenant IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_16', 'NATION_20') GROUP BY path HAVING count(DISTINCT tenant) >= 3")
def tree_spine(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return taxonomy.spine(nodes, ["NATION_1", "NATION_2", "NATION_3", "NATION_4", "NATION_16", "NATION_20"])


QUESTIONS = f"""(SELECT CASE basis WHEN 'unmapped' THEN 'home' WHEN 'leaf_crosses_branch' THEN 'cross' WHEN 'leaf_moved_ambiguous' THEN 'amb' WHEN 'leaf_moved' THEN 'gran' END AS kind, tenant, lines, up, c, target,
 CASE basis WHEN 'unmapped' THEN up WHEN 'leaf_crosses_branch' THEN up || ' | ' || c[1] WHEN 'leaf_moved_ambiguous' THEN c[1] || ' | ' || c[2] ELSE up || ' | ' || upper(target) END AS parts FROM (SELECT *, array_to_string(u, ' > ') AS up, string_split(candidates, ' | ') AS c FROM (SELECT * FROM {{}}))
 WHERE basis IN ('unmapped', 'leaf_crosses_branch', 'leaf_moved_ambiguous') OR basis = 'leaf_moved' AND upper(target) <> up)"""


@query(f"SELECT a.label AS a, b.label AS b, CAST(levenshtein(a.k, b.k) AS INTEGER) AS edits, a.lines + b.lines AS lines FROM (SELECT label, {LOOSE.format('label')} AS k, CAST(sum(lines) AS BIGINT) AS lines FROM {SIBLINGS} GROUP BY label) a JOIN (SELECT label, {LOOSE.format('label')} AS k, CAST(sum(lines) AS BIGINT) AS lines FROM {SIBLINGS} GROUP BY label) b ON a.label < b.label AND abs(length(a.label) - length(b.label)) <= 3 WHERE levenshtein(a.k, b.k) IN (1, 2)")
def near_labels(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return taxonomy.near_labels(nodes.select(F.explode(F.array("l1", "l2", "l3", "l4")).alias("label"), "lines"))


@query("""SELECT tenant, canon, count(*) AS nodes, CAST(sum(lines) AS BIGINT) AS lines FROM (SELECT tenant, lines, upper('Goods > ' || l1 || ' > ' || l2 || ' > ' || l3 || CASE WHEN lower(l3) = lower(l4) THEN '' ELSE ' > ' || l4 END) AS canon
 FROM (FROM nodes UNION ALL FROM nodes WHERE length(path) % 2 = 0)) GROUP BY tenant, canon HAVING count(*) > 1""")
def tree_duplicates(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    nodes = shared(nodes.select("tenant", "path", "lines"))
    again = F.concat("path", F.lit(" > "), F.upper(F.element_at(F.split("path", " > "), -1)), F.lit(" > (Not Used At This Level)"))
    return taxonomy.duplicates(nodes.unionByName(nodes.where(F.length("path") % 2 == 0).withColumn("path", again)))


def mapped(spark, d):
    """Nodes, and the way of each onto the spine; both sides are read many times, so they are written once."""
    nodes = shared(frames(spark, d, "nodes")[0])
    group = nodes.where("tenant IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')")
    spine = shared(group.groupBy("path").agg(F.count("*").alias("n")).where("n >= 2").select("path"))
    return nodes, taxonomy.crosswalk(nodes.select("tenant", "source_key", "path", "lines"), spine)


#: Paths as lists; neighbours that are equal but for case are one. Every label here is a word, a brand or a type.
PLACED = "(SELECT tenant, source_key, path, lines, s, string_split(upper(array_to_string(s, ' > ')), ' > ') AS u FROM (SELECT *, CASE WHEN lower(l3) = lower(l4) THEN [g, l1, l2, l3] ELSE [g, l1, l2, l3, l4] END AS s FROM nodes))"
SPINE = f"(SELECT u, array_to_string(u, ' > ') AS up, min(array_to_string(s, ' > ')) AS shown FROM (SELECT path, any_value(s) AS s, any_value(u) AS u FROM {PLACED} WHERE tenant IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') GROUP BY path HAVING count(*) >= 2) GROUP BY u)"
ANCESTORS = f"(SELECT k, u[:k] AS a, min(array_to_string(string_split(shown, ' > ')[:k], ' > ')) AS shown FROM (SELECT u, shown, unnest([3, 4]) AS k FROM {SPINE}) WHERE k <= len(u) GROUP BY 1, 2)"
CROSSED = f"""(SELECT n.tenant, n.source_key, n.path, n.lines, n.u,
  CASE WHEN e.up IS NOT NULL THEN 'exact' WHEN len(near.l) = 1 THEN 'leaf_moved' WHEN len(near.l) > 1 THEN 'leaf_moved_ambiguous' WHEN far.l IS NOT NULL THEN 'leaf_crosses_branch' WHEN coalesce(a4.shown, a3.shown) IS NOT NULL THEN 'parent_match' ELSE 'unmapped' END AS basis,
  CASE WHEN e.up IS NOT NULL THEN e.shown WHEN len(near.l) = 1 THEN near.l[1] WHEN near.l IS NULL AND far.l IS NULL THEN coalesce(a4.shown, a3.shown) END AS target,
  CASE WHEN e.up IS NOT NULL THEN 1.0 WHEN len(near.l) = 1 THEN 0.9 WHEN far.l IS NOT NULL THEN 0.3 WHEN a4.shown IS NOT NULL THEN 0.8 WHEN a3.shown IS NOT NULL THEN round(3 / len(n.u), 2) ELSE 0.0 END::DOUBLE AS confidence,
  CASE WHEN e.up IS NULL AND len(near.l) > 1 THEN array_to_string(near.l[:4], ' | ') WHEN e.up IS NULL AND near.l IS NULL AND far.l IS NOT NULL THEN array_to_string(far.l[:4], ' | ') END AS candidates
 FROM {PLACED} n LEFT JOIN {SPINE} e ON e.u = n.u
 LEFT JOIN (SELECT u[-1] AS leaf, u[:2] AS branch, list(shown ORDER BY up) AS l FROM {SPINE} GROUP BY 1, 2) near ON near.leaf = n.u[-1] AND near.branch = n.u[:2] LEFT JOIN (SELECT u[-1] AS leaf, list(shown ORDER BY up) AS l FROM {SPINE} GROUP BY 1) far ON far.leaf = n.u[-1]
 LEFT JOIN {ANCESTORS} a4 ON len(n.u) = 5 AND a4.k = 4 AND a4.a = n.u[:4] LEFT JOIN {ANCESTORS} a3 ON a3.k = 3 AND a3.a = n.u[:3])"""


@query(f"SELECT tenant, source_key, path, lines, basis, target, confidence, candidates FROM {CROSSED}")
def tree_crosswalk(spark, d):
    return mapped(spark, d)[1].withColumn("candidates", F.array_join("candidates", " | "))


@query(f"""SELECT left(md5(kind || ' | ' || parts), 10) AS decision_id, kind, array_to_string(list_sort(list_distinct(list(tenant))), ',') AS tenants, CAST(sum(lines) AS BIGINT) AS lines, CAST(CASE kind WHEN 'amb' THEN count(DISTINCT up) WHEN 'cross' THEN CAST(max(len(c)) > 1 AS INTEGER) ELSE 0 END AS INTEGER) AS also,
 CASE WHEN substr(left(md5(kind || ' | ' || parts), 10), 1, 1) IN ('0', '1', '2', '3') THEN 'B' END AS ruling FROM {QUESTIONS.format(CROSSED)} GROUP BY kind, parts""")
def open_questions(spark, d):
    nodes, m = mapped(spark, d)
    asked = decisions.gathered(decisions.of_nodes(m))
    answered = shared(asked).where(F.left("decision_id", F.lit(1)).isin("0", "1", "2", "3")).select("decision_id", F.lit("B").alias("ruling"))
    return decisions.gathered(decisions.of_nodes(m), answered).select("decision_id", "kind", F.array_join("tenants", ",").alias("tenants"), "lines", F.size(F.array_distinct(F.transform("applies", F.upper))).alias("also"), "ruling")


@query("SELECT CAST(sum(lines) AS BIGINT) AS lines_in, CAST(sum(lines) FILTER (l1 <> 'Brand#12') AS BIGINT) AS lines_out, CAST(sum(lines) FILTER (l1 = 'Brand#12') AS BIGINT) AS lines_dropped, sum(lines) = sum(lines) FILTER (l1 <> 'Brand#12') + sum(lines) FILTER (l1 = 'Brand#12') AS ok FROM nodes")
def tree_conservation(spark, d):
    nodes, m = mapped(spark, d)
    dropped = F.element_at(paths.split_path(F.col("path")), 2) == "Brand#12"
    return taxonomy.conserved(nodes, taxonomy.merged(m.where(~dropped)), m.where(dropped))


@query(f"""SELECT resolved, 'XX-' || printf('%04d', CASE WHEN old THEN row_number() OVER (PARTITION BY old ORDER BY resolved) ELSE count(*) FILTER (old) OVER () + row_number() OVER (PARTITION BY old ORDER BY resolved) END) AS category_key, lines, nodes, absorbed
 FROM (SELECT *, length(resolved) % 2 = 0 AS old FROM (SELECT CASE WHEN basis = 'leaf_moved' THEN upper(target) ELSE array_to_string(u, ' > ') END AS resolved, CAST(sum(lines) AS BIGINT) AS lines, count(*) AS nodes, CAST(count(*) FILTER (basis = 'leaf_moved') AS BIGINT) AS absorbed FROM {CROSSED} GROUP BY 1))""")
def tree_numbered(spark, d):
    _, m = mapped(spark, d)
    tree = shared(taxonomy.merged(m))
    prefix = taxonomy.gate_prefix(F.substring_index("resolved", paths.SEP, 1))
    old = tree.where(F.length("resolved") % 2 == 0).withColumn("k", F.row_number().over(Window.partitionBy(prefix).orderBy("resolved")))
    previous = old.select("resolved", F.format_string("%s-%04d", prefix, "k").alias("category_key"))
    return taxonomy.numbered(tree, previous).select("resolved", "category_key", "lines", "nodes", "absorbed")


@query(f"""SELECT resolved, 'XX-' || printf('%04d', row_number() OVER (ORDER BY resolved)) AS category_key, lines FROM (SELECT CASE WHEN basis = 'leaf_moved' THEN upper(target) ELSE array_to_string(u, ' > ') END AS resolved, CAST(sum(lines) AS BIGINT) AS lines FROM {CROSSED} GROUP BY 1
 UNION ALL SELECT DISTINCT 'GOODS > ' || upper(l1) || ' > BY HAND', 0 FROM nodes)""")
def tree_with_added(spark, d):
    nodes, m = mapped(spark, d)
    added = nodes.select(F.concat(F.lit("Goods > "), F.col("l1"), F.lit(" > by hand")).alias("path")).unionByName(nodes.select("path").limit(5))
    none = spark.createDataFrame([], "resolved string, category_key string")
    return taxonomy.refuse_shared_keys(taxonomy.numbered(taxonomy.with_added(shared(taxonomy.merged(m)), added), none)).select("resolved", "category_key", "lines")


STATE = "CASE " + " ".join(f"WHEN regexp_matches(lower({{0}}), '\\b{w}\\b') THEN '{st}'" for w, st in taxonomy.STATES.items()) + " END"
#: The merged tree and, for each brand, a node of every fault that an audit finds; both engines read it.
AUDIT_NODES = """SELECT path, CAST(sum(lines) AS BIGINT) AS lines FROM (SELECT path, lines FROM {n} UNION ALL SELECT 'Goods > Is it ' || l1 || '?', lines FROM {n} UNION ALL SELECT 'Goods > ' || l1 || ', the second level', lines FROM {n}
 UNION ALL SELECT 'Goods > Fresh ' || l1 || ' > Frozen ' || l1, lines FROM {n} UNION ALL SELECT 'Goods > ' || l1, lines FROM {n} UNION ALL SELECT 'Fees > Rates ' || l1 || ' > Rates ' || l1 || ' - Other', lines FROM {n}
 UNION ALL SELECT 'Help > ' || l1 || ' tools > General ' || l1 || ' tool', lines FROM {n} UNION ALL SELECT 'Trips > Air freight ' || l1, lines FROM {n} UNION ALL SELECT 'Trips > Freight air ' || l1, lines FROM {n}) GROUP BY path"""
AUDITED = f"""(SELECT *, s[-1] AS leaf, array_to_string(s[:-2], ' > ') AS parent, array_to_string(s[:2], ' > ') AS branch, coalesce(s[3], s[-1]) AS label
 FROM (SELECT path, CAST(sum(lines) AS BIGINT) AS lines, string_split(path, ' > ') AS s FROM audit_nodes GROUP BY path))"""
STOPS = ", ".join(f"'{w}'" for w in taxonomy.STOP)
CONTENT = r"list_transform(list_filter(regexp_split_to_array(replace(lower({}), '&', ' and '), '[^\p{{L}}\p{{N}}]+'), lambda w: length(w) >= 3 AND w NOT IN (STOPS)), lambda w: CASE WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') THEN w[:-2] ELSE w END)".replace("STOPS", STOPS)
LABELS = f"(SELECT label, {LOOSE.format('label')} AS k, CAST(sum(lines) AS BIGINT) AS lines FROM (SELECT unnest(s[2:]) AS label, lines FROM {AUDITED}) GROUP BY label)"
KIDS = f"""(SELECT parent, min(child) AS child, string_split(parent, ' > ')[-1] AS tail, CAST(sum(lines) AS BIGINT) AS lines FROM (SELECT array_to_string(s[:i - 1], ' > ') AS parent, s[i] AS child, lines FROM (SELECT s, lines, unnest(range(2, len(s) + 1)) AS i FROM {AUDITED}))
 GROUP BY parent HAVING count(DISTINCT child) = 1)"""
OTHER = f"{LOOSE.format('child')} = {LOOSE.format("(tail || ' - Other')")}"
GENERICS = ", ".join(LOOSE.format(f"'{g}'") for g in taxonomy.GENERIC)
FINDINGS = f"""SELECT 'junk' AS "check", true AS blocking, path, lines FROM {AUDITED} WHERE len(list_filter(s[2:], lambda x: length(x) > 60 OR contains(x, '?') OR (contains(x, ',') AND list_has_all(regexp_split_to_array(lower(x[instr(x, ',') + 1:]), '[^a-z]+'), ['the', 'level'])))) > 0
 UNION ALL SELECT DISTINCT 'contradiction', true, path, lines FROM (SELECT path, lines, unnest(s) AS x, unnest(s[2:]) AS y FROM {AUDITED}) WHERE {STATE.format("x")} <> {STATE.format("y")}
 UNION ALL SELECT 'prefix_bucket', true, path, lines FROM {AUDITED} p WHERE EXISTS (FROM audit_nodes q WHERE starts_with(q.path, p.path || ' > '))
 UNION ALL SELECT 'sole_other', true, path, lines FROM {AUDITED} WHERE len(s) >= 3 AND {LOOSE.format("leaf")} = {LOOSE.format("(s[-2] || ' - Other')")} AND parent IN (SELECT parent FROM {KIDS})
 UNION ALL SELECT 'hollow', false, parent || ' > ' || child, lines FROM (SELECT *, {CONTENT.format("child")} AS wc, {CONTENT.format("tail")} AS wp FROM {KIDS}) WHERE contains(parent, ' > ') AND NOT ({OTHER}) AND (levenshtein({LOOSE.format("tail")}, {LOOSE.format("child")}) <= 2
  OR contains({LOOSE.format("parent")}, {LOOSE.format("child")}) OR contains({LOOSE.format("child")}, {LOOSE.format("tail")}) OR (len(wc) > 0 AND len(wp) > 0 AND (list_has_all(wp, wc) OR list_has_all(wc, wp))))
 UNION ALL SELECT 'multi_home', false, min(path), CAST(sum(lines) AS BIGINT) FROM {AUDITED} WHERE {LOOSE.format("leaf")} NOT IN ({GENERICS}) GROUP BY {LOOSE.format("leaf")} HAVING count(DISTINCT parent) > 1
 UNION ALL SELECT 'near_label', false, a.label || ' ~ ' || b.label, a.lines + b.lines FROM {LABELS} a JOIN {LABELS} b ON a.label < b.label AND abs(length(a.label) - length(b.label)) <= 3 WHERE levenshtein(a.k, b.k) IN (1, 2)
 UNION ALL SELECT 'word_order', false, min(label), CAST(sum(lines) AS BIGINT) FROM (SELECT *, {CONTENT.format("label")} AS w FROM {LABELS}) WHERE len(list_distinct(w)) > 1 GROUP BY list_sort(list_distinct(w)) HAVING count(DISTINCT w) > 1
 UNION ALL SELECT 'generic', false, path, lines FROM {AUDITED} WHERE lines > 0 AND ({" OR ".join(f"contains(lower(leaf), '{g}')" for g in taxonomy.GENERIC)})
 UNION ALL SELECT 'thin_branch', false, branch, CAST(sum(lines) AS BIGINT) FROM {AUDITED} GROUP BY branch HAVING count(*) = 1
 UNION ALL SELECT 'shared_group', false, min(label), CAST(sum(lines) AS BIGINT) FROM {AUDITED} GROUP BY {LOOSE.format("label")} HAVING count(DISTINCT branch) > 1"""


def audit_nodes(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return spark.sql(AUDIT_NODES, n=shared(nodes.select("path", "l1", "lines")))


def tree_audit(spark, d):
    return taxonomy.audit(audit_nodes(spark, d))


def tree_audit_whole(spark, d):
    return tree_audit(spark, d).groupBy("check", "blocking").agg(F.count("*").alias("findings"), F.sum("lines").alias("lines"))


WITH_AUDIT = WITH.rstrip() + f", audit_nodes AS ({AUDIT_NODES.format(n='nodes')}) "
query.queries["tree_audit"], query.sql["tree_audit"] = tree_audit, WITH_AUDIT + FINDINGS
query.queries["tree_audit_whole"] = tree_audit_whole
query.sql["tree_audit_whole"] = WITH_AUDIT + f'SELECT "check", blocking, count(*) AS findings, CAST(sum(lines) AS BIGINT) AS lines FROM ({FINDINGS}) GROUP BY 1, 2'


@query("SELECT tenant, source_key, CASE WHEN l1 = lag(l1) OVER w THEN '' ELSE l1 END AS show_l1, CASE WHEN l1 = lag(l1) OVER w AND l2 = lag(l2) OVER w THEN '' ELSE l2 END AS show_l2 FROM (SELECT tenant, min(source_key) AS source_key, l1, l2 FROM nodes GROUP BY tenant, l1, l2) WINDOW w AS (PARTITION BY tenant ORDER BY l1, l2)")
def tree_outline(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return taxonomy.outline(nodes.groupBy("tenant", "l1", "l2").agg(F.min("source_key").alias("source_key")), ["l1", "l2"]).select("tenant", "source_key", "show_l1", "show_l2")


GROUPS = "SELECT tenant, supplier, d1, verdict, min(unit_id) AS group_key, count(*) AS lines FROM lines GROUP BY tenant, supplier, d1, verdict"


@query(GROUPS)
def answer_groups(spark, d):
    (lines,) = frames(spark, d, "lines")
    return review.answer_groups(lines, ["tenant", "supplier", "d1", "verdict"])


@query(f"SELECT l.line_id, g.group_key FROM lines l LEFT JOIN ({GROUPS}) g ON l.tenant = g.tenant AND l.supplier IS NOT DISTINCT FROM g.supplier AND l.d1 IS NOT DISTINCT FROM g.d1 AND l.verdict IS NOT DISTINCT FROM g.verdict")
def answer_reattach(spark, d):
    (lines,) = frames(spark, d, "lines")
    by = ["tenant", "supplier", "d1", "verdict"]
    return review.reattach(lines, review.answer_groups(lines, by), by).select("line_id", "group_key")


@query("SELECT verdict, count(*) AS reviewed, count(*) FILTER (line_id % 4 > 0) AS agreed, round(100.0 * count(*) FILTER (line_id % 4 > 0) / count(*), 4) AS agree_pct FROM lines WHERE line_id % 3 = 0 GROUP BY verdict")
def review_agreement(spark, d):
    (lines,) = frames(spark, d, "lines")
    return review.agreement_by_verdict(lines.withColumn("response", F.when(F.col("line_id") % 3 == 0, F.when(F.col("line_id") % 4 > 0, "Agree").otherwise("Disagree"))))


HIS = "CASE line_no % 5 WHEN 0 THEN upper(l3) || 's' WHEN 1 THEN l1 || ' & more' WHEN 2 THEN 'some ' || split_part(l2, ' ', 1) WHEN 3 THEN ' - ' END"
MEANS = r"regexp_replace(trim(regexp_replace(replace(lower(trim({})), '&', ' and '), '[^a-z0-9]+', ' ', 'g')), 's\b', '', 'g')"
MATCHED = f"""(SELECT tenant, CASE WHEN his IS NULL THEN 'none' WHEN h = '' OR n = 0 THEN 'differs' WHEN lv[n] <> '' AND (contains(lv[n], h) OR contains(h, lv[n])) THEN 'leaf'
 WHEN n > 1 AND lv[n - 1] <> '' AND (contains(lv[n - 1], h) OR contains(h, lv[n - 1])) THEN 'branch' WHEN coalesce(hit, 0) = 0 THEN 'differs' WHEN hit = n THEN 'leaf' ELSE 'branch' END AS m
 FROM (SELECT *, len(lv) AS n, list_position(list_transform(lv, lambda x: len(list_intersect(list_filter(string_split(x, ' '), lambda w: w <> ''), string_split(h, ' '))) > 0), true) AS hit
  FROM (SELECT tenant, his, {MEANS.format("his")} AS h, list_transform(list_filter([l1, l2, l3, l4], lambda x: x <> '' AND NOT contains(lower(x), 'not used')), lambda x: {MEANS.format("x")}) AS lv FROM (SELECT *, {HIS} AS his FROM lines))))"""


@query(f"SELECT tenant, leaf, branch, differs, \"none\", round(100.0 * leaf / nullif(leaf + branch + differs, 0), 4) AS leaf_pct, round(100.0 * (leaf + branch) / nullif(leaf + branch + differs, 0), 4) AS branch_pct FROM (SELECT tenant, count(*) FILTER (m = 'leaf') AS leaf, count(*) FILTER (m = 'branch') AS branch, count(*) FILTER (m = 'differs') AS differs, count(*) FILTER (m = 'none') AS \"none\" FROM {MATCHED} GROUP BY tenant)")
def answer_scores(spark, d):
    (lines,) = frames(spark, d, "lines")
    return review.score(lines.withColumn("his", F.expr(HIS)).withColumn("match", review.agreement("his", ["l1", "l2", "l3", "l4"])))



MASTER = """SELECT n_name AS tenant, s_name AS client_vendor_name, CASE WHEN s_suppkey % 6 <> 1 THEN s_suppkey END AS vendor_id, s_acctbal AS spend_total, CAST(s_suppkey % 3 AS DOUBLE) AS match_confidence, 'Brand#' || CAST(1 + s_suppkey % 25 AS STRING) AS category
 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 7 <> 2
 UNION ALL SELECT n_name, s_name, s_suppkey + 1000000, s_acctbal + 1, CAST((s_suppkey + 1) % 3 AS DOUBLE), 'Brand#1' FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 4 = 0
 UNION ALL SELECT 'elsewhere', s_name, s_suppkey + 1, s_acctbal, 9.0, 'Brand#2' FROM supplier"""
LOG = """SELECT event_id AS log_id, event_id % 300 AS vendor_id, CASE WHEN event_id % 2 = 0 THEN 'coherence' ELSE 'other' END AS call_type,
 CASE WHEN event_id % 5 = 0 THEN 'I say "verdict": "mixed" here' WHEN event_id % 7 = 0 THEN 'nothing' WHEN event_id % 3 = 0 THEN '{"verdict": "incoherent"}' ELSE '{"verdict": "coherent"}' END AS raw_output FROM events"""
VERDICT = """CASE WHEN log_id % 5 = 0 THEN 'mixed' WHEN log_id % 7 = 0 THEN NULL WHEN log_id % 3 = 0 THEN 'incoherent' ELSE 'coherent' END"""


def master_and_log(spark, d):
    supplier, events, nation = frames(spark, d, "supplier", "events", "nation")
    supplier.createOrReplaceTempView("supplier")
    nation.createOrReplaceTempView("nation")
    events.createOrReplaceTempView("events")
    return spark.sql(MASTER), spark.sql(LOG)


@query(f"SELECT tenant, client_vendor_name, vendor_id, category FROM (SELECT *, row_number() OVER (PARTITION BY tenant, client_vendor_name ORDER BY match_confidence DESC NULLS LAST, spend_total DESC NULLS LAST, vendor_id) AS r FROM ({MASTER})) WHERE r = 1", derived=False)
def vendor_best_match(spark, d):
    return enrich.best_match(master_and_log(spark, d)[0]).select("tenant", "client_vendor_name", "vendor_id", "category")


LATEST = f"SELECT vendor_id, {VERDICT} AS verdict FROM (SELECT vendor_id, max(log_id) AS log_id FROM ({LOG}) WHERE call_type = 'coherence' GROUP BY vendor_id)"


@query(LATEST, derived=False)
def vendor_latest_verdict(spark, d):
    return enrich.latest_verdict(master_and_log(spark, d)[1], "coherence")


@query(f"SELECT tenant, coherence, count(*) AS vendors, CAST(sum(n) AS BIGINT) AS lines FROM (SELECT v.tenant, v.n, CASE WHEN m.client_vendor_name IS NULL THEN 'not in master' ELSE coalesce(c.verdict, 'unevaluated') END AS coherence FROM (SELECT tenant, supplier, count(*) AS n FROM lines GROUP BY 1, 2) v LEFT JOIN (SELECT tenant, client_vendor_name, max(vendor_id) AS vendor_id FROM ({MASTER}) GROUP BY 1, 2) m ON m.client_vendor_name = v.supplier AND m.tenant = v.tenant LEFT JOIN ({LATEST}) c ON c.vendor_id = m.vendor_id) GROUP BY tenant, coherence")
def vendor_coherence(spark, d):
    (lines,) = frames(spark, d, "lines")
    master, log = master_and_log(spark, d)
    return enrich.coherence_tally(enrich.coherence(queue.base(lines, judged()), master, enrich.latest_verdict(log, "coherence")))


@query(f"SELECT lane, count(*) AS lines FROM (SELECT CASE WHEN m.category IS NULL THEN 'unknown vendor' WHEN m.category = l.l1 THEN 'agrees' ELSE 'differs' END AS lane FROM lines l LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tenant, client_vendor_name ORDER BY match_confidence DESC NULLS LAST, spend_total DESC NULLS LAST, vendor_id) AS r FROM ({MASTER})) WHERE r = 1) m ON l.supplier = m.client_vendor_name AND l.tenant = m.tenant) GROUP BY lane")
def vendor_lane(spark, d):
    (lines,) = frames(spark, d, "lines")
    return enrich.lane(lines, master_and_log(spark, d)[0], "supplier", "category", "l1").groupBy("lane").agg(F.count("*").alias("lines"))


@query("SELECT line_id, CASE WHEN line_id % 5 = 0 THEN 'NC-0001' END AS found FROM lines")
def recovered_keys(spark, d):
    (lines,) = frames(spark, d, "lines")
    prose = F.when(F.col("line_id") % 5 == 0, "better NC-0001 than ZZ-9999").when(F.col("line_id") % 5 == 1, "NC-0001 or NC-0002").when(F.col("line_id") % 5 == 2, "nothing named").when(F.col("line_id") % 5 == 3, "XX-123")
    return lines.select("line_id", text.recovered_key(prose, F.array(F.lit("NC-0001"), F.lit("NC-0002"))).alias("found"))


@query("SELECT line_id, count(*) FILTER (verdict = 'Correct') AS c, string_agg('m' || seat, ', ' ORDER BY seat) FILTER (verdict = 'Correct') AS names FROM votes GROUP BY line_id HAVING count(*) FILTER (verdict = 'Correct') > 0")
def deciding_models(spark, d):
    (votes,) = frames(spark, d, "votes")
    arr = F.transform(F.array_sort(F.collect_list(F.struct("seat", "verdict"))), lambda v: F.struct(F.concat(F.lit("m"), v["seat"].cast("string")).alias("model"), v["verdict"].alias("verdict")))
    g = votes.groupBy("line_id").agg(F.count_if(F.col("verdict") == "Correct").alias("c"), arr.alias("v")).where("c > 0")
    return g.select("line_id", "c", judge.deciders(F.col("v"), F.lit("Correct")).alias("names"))


@query("SELECT CAST(count(*) AS BIGINT) AS rows, count(DISTINCT k) AS different FROM (SELECT " + KEY.format("tenant || '|' || coalesce(supplier, '') || '|' || coalesce(d1, '')") + " AS k FROM lines)")
def stable_keys(spark, d):
    (lines,) = frames(spark, d, "lines")
    return lines.select(keys.stable_key(F.col("tenant"), F.col("supplier"), F.col("d1")).alias("k")).agg(F.count("*").alias("rows"), F.countDistinct("k").alias("different"))


@query("SELECT tenant, subject_id FROM (SELECT DISTINCT tenant, subject_id FROM lines WHERE verdict = 'Correct') EXCEPT SELECT tenant, subject_id FROM lines WHERE verdict = 'Incorrect'")
def subjects_never_wrong(spark, d):
    (lines,) = frames(spark, d, "lines")
    return lines.where("verdict = 'Correct'").select("tenant", "subject_id").distinct().join(lines.where("verdict = 'Incorrect'").select("tenant", "subject_id").distinct(), ["tenant", "subject_id"], "left_anti")
