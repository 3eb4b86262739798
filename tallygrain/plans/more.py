"""Further queries: rule text, wording checks, preflight, rulings, payloads, two runs compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygrain.functions import answers, paths, text
from tallygrain.operators import actions, judge, monitor, normalise, preflight, profile, queue, review, rulings, taxonomy
from tallygrain.plans.facts import Registry, frames
from tallygrain.plans.reference import NORMALISED, normal
from tallygrain.sources import writers
from tallygrain.sources.shared import shared

query = Registry()


@query("SELECT line_id, CASE WHEN l0 = '' THEN 'uncategorised' WHEN e.p IS NOT NULL THEN 'exact' WHEN b.p IS NOT NULL THEN 'finer' ELSE 'branch missing' END AS placing FROM lines l LEFT JOIN (SELECT DISTINCT l1 || '/' || l2 || '/' || l3 AS p FROM nodes WHERE tenant < 'NATION_2') e ON e.p = l.l1 || '/' || l.l2 || '/' || l.l3 LEFT JOIN (SELECT DISTINCT l1 || '/' || l2 AS p FROM nodes WHERE tenant < 'NATION_2') b ON b.p = l.l1 || '/' || l.l2")
def placement_class(spark, d):
    lines, nodes = frames(spark, d, "lines", "nodes")
    return normalise.placement(lines, nodes.where("tenant < 'NATION_2'"), ["l1", "l2", "l3"]).select("line_id", "placing")


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'Y' ELSE 'N' END AS reads_description, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'Item Description contains ' || p_name ELSE '[withheld GL Account]' END AS fires_on FROM part", derived=False)
def rule_conditions(spark, d):
    (part,) = frames(spark, d, "part")
    f = F.when(F.col("p_partkey") % 5 == 0, None).when(F.col("p_partkey") % 5 == 1, "Item Description").otherwise("GL Account")
    return part.select("p_partkey", normalise.tests_description([f, F.lit(None).cast("string")]).alias("reads_description"), normalise.masked_condition(f, F.lit("contains"), F.col("p_name"), ("ITEM DESCRIPTION",)).alias("fires_on"))


SAID = "CASE WHEN line_id % 4 = 0 THEN 'charged to Cost Centre 12' WHEN line_id % 4 = 1 THEN 'the item is fuel for a van' WHEN line_id % 4 = 2 THEN 'item 7 # 12, x' ELSE 'the ITEM is a bolt' END"


def said():
    m = F.col("line_id") % 4
    return F.when(m == 0, "charged to Cost Centre 12").when(m == 1, "the item is fuel for a van").when(m == 2, "item 7 # 12, x").otherwise("the ITEM is a bolt")


@query("SELECT line_id FROM lines WHERE line_id % 4 = 0")
def leaked_rationales(spark, d):
    (lines,) = frames(spark, d, "lines")
    return actions.leaks(lines.withColumn("said", said()), "said", ("cost cent(re|er)", "gl account")).select("line_id")


@query("SELECT line_id, CASE WHEN line_id % 4 = 1 THEN 'fuel' WHEN line_id % 4 = 3 AND l3 <> 'bolt' THEN 'bolt' END AS phrase, line_id % 4 <> 2 AS wordy FROM lines")
def contradictory_rationales(spark, d):
    (lines,) = frames(spark, d, "lines")
    j = lines.withColumn("said", said())
    return j.select("line_id", actions.contradicts_itself("said", "l3", [("fuel", ("fuel",)), ("bolt", ("bolt",))]).alias("phrase"), actions.wordy("said").alias("wordy"))


#: What a seat might say; the SQL counts words in another way, by pieces between what isn't of a word.
DENIED = "CASE WHEN line_id % 3 = 0 THEN 'There is No Description of it' WHEN line_id % 3 = 1 THEN 'the text is unusable' ELSE 'a plain item' END"


@query("SELECT line_id, d FROM (SELECT *, d1 || ' ' || coalesce(d2, '') AS d FROM lines) WHERE description_usable = 'Y' AND line_id % 3 < 2 AND len(list_filter(string_split(d, ' '), lambda x: length(x) >= 3 AND regexp_full_match(x, '[a-zA-Z]+'))) >= 3")
def false_denials(spark, d):
    (lines,) = frames(spark, d, "lines")
    said = lines.withColumn("said", F.expr(DENIED)).withColumn("d", F.concat("d1", F.lit(" "), F.coalesce("d2", F.lit(""))))
    return actions.false_denials(said, "said", "d").select("line_id", "d")


@query("SELECT line_id FROM lines WHERE rule_id NOT IN ('1-URGENT') AND l0 <> 'Excluded' AND (d1 IS NULL OR d1 NOT LIKE '%ring%')")
def template_exclusions(spark, d):
    (lines,) = frames(spark, d, "lines")
    return normalise.kept_by(lines, ("1-URGENT",), ("Excluded",), ("ring",), name="d1").select("line_id")


@query("SELECT rule_id, count(*) AS suspects FROM lines WHERE l2 IN ('ECONOMY', 'PROMO') AND regexp_matches(upper(coalesce(d1, '')), 'GEAR|BOLT') GROUP BY rule_id")
def rule_suspects(spark, d):
    (lines,) = frames(spark, d, "lines")
    return normalise.suspects(lines, "l2", ("ECONOMY", "PROMO"), "d1", "GEAR|BOLT")


@query("SELECT round(CAST(sum(CASE WHEN d1 IN ('n/a', '  ') THEN absolute ELSE 0 END) AS DOUBLE) / CAST(sum(absolute) AS DOUBLE), 6) AS generic_share FROM (SELECT d1, sum(abs(cents)) AS absolute FROM lines GROUP BY d1 ORDER BY absolute DESC, d1 LIMIT 20)")
def generic_share(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.generic_share(lines, "d1", "cents", 20)


@query("""SELECT name, round(v, 6) AS value, CASE WHEN round(v, 6) > f THEN 'FAIL' WHEN round(v, 6) > w THEN 'WARN' ELSE 'PASS' END AS grade FROM (
SELECT 'empty' AS name, 0.0 AS v, 0 AS w, 0 AS f FROM lines HAVING count(*) > 0 UNION ALL SELECT 'no vendor', count(*) FILTER (supplier IS NULL) / count(*), 0.01, 0.2 FROM lines UNION ALL SELECT 'no description', count(*) FILTER (description_usable = 'N') / count(*), 0.05, 0.5 FROM lines
UNION ALL SELECT 'no spend', count(*) FILTER (cents IS NULL) / count(*), 0, 0.01 FROM lines UNION ALL SELECT 'uncategorised', count(*) FILTER (l0 = '') / count(*), 0.05, 0.5 FROM lines UNION ALL SELECT 'repeated ids', 1 - count(DISTINCT line_id) / count(*), 0, 0.3 FROM lines
UNION ALL SELECT 'no taxonomy node', count(*) FILTER (tax_key NOT IN (SELECT source_key FROM cross_)) / count(*), 0.01, 0.5 FROM lines UNION ALL SELECT 'no rule', count(*) FILTER (rule_id > '3') / count(*), 0.01, 0.5 FROM lines
UNION ALL SELECT 'no vendor master', count(*) FILTER (supplier IS NULL OR supplier NOT IN (SELECT s_name FROM supplier WHERE s_suppkey % 3 > 0)) / count(*), 0.01, 0.5 FROM lines)""")
def tenant_preflight(spark, d):
    lines, cross, suppliers, nations, orders = frames(spark, d, "lines", "cross_", "supplier", "nation", "orders")
    rules = nations.select(F.col("n_name").alias("tenant")).crossJoin(orders.where("o_orderpriority <= '3'").select(F.col("o_orderpriority").alias("rule_id")).distinct())
    master = suppliers.where("s_suppkey % 3 > 0").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("tenant"), F.col("s_name").alias("supplier"))
    return preflight.tenant(lines, cross, "cents", "tax_key", rules, master)


@query(f"""SELECT name, round(v, 6) AS value FROM (SELECT 'uncategorised' AS name, count(*) FILTER (l0 = 'Uncategorised') / count(*) AS v FROM {NORMALISED} UNION ALL SELECT 'no description', count(*) FILTER (description_usable = 'N') / count(*) FROM {NORMALISED} UNION ALL SELECT 'repeated ids', 1 - count(DISTINCT line_id) / count(*) FROM {NORMALISED}
 UNION ALL SELECT 'no vendor', count(*) FILTER (supplier IS NULL) / count(*) FROM {NORMALISED} UNION ALL SELECT 'no taxonomy node', count(*) FILTER (tax_key NOT IN (SELECT source_key FROM cross_)) / count(*) FROM {NORMALISED} UNION ALL SELECT unnest(['empty', 'no spend']), 0.0)""")
def normalised_preflight(spark, d):
    (cross,) = frames(spark, d, "cross_")
    return preflight.tenant(normal(spark, d), cross.select(F.lit("T").alias("tenant"), "source_key").distinct(), "cents", "tax_key").select("name", "value")


@query("SELECT 'nation' AS name, 3 AS columns, count(*) AS rows, count(*) = 25 AS ok FROM nation UNION ALL SELECT 'region', 2, count(*), count(*) = 4 FROM region", derived=False)
def state_audit(spark, d):
    nation, region = frames(spark, d, "nation", "region")
    return preflight.expected_shape({"nation": nation, "region": region}, {"nation": (3, 25), "region": (2, 4)})


@query("SELECT tenant, count(*) AS lines, count(*) FILTER (coalesce(jury, 0) <> coalesce(valid, 0)) AS differ FROM lines LEFT JOIN (SELECT line_id, count(*) FILTER (verdict IN ('Correct', 'Incorrect', 'Uncertain')) AS valid FROM votes GROUP BY line_id) USING (line_id) GROUP BY tenant")
def stored_jury_audit(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    return preflight.stored_jury(lines, votes, text.VERDICTS)


RULINGS = "SELECT 'NODE ' || CAST(p_partkey AS STRING) AS subject, CASE p_partkey % 8 WHEN 0 THEN 'Drop' WHEN 1 THEN 'rename to: New ' || CAST(p_partkey AS STRING) WHEN 2 THEN 'Map to G > X' WHEN 3 THEN 'keep apart' WHEN 4 THEN 'same' WHEN 5 THEN '' WHEN 6 THEN 'define as things' ELSE 'hm?' END AS ruling FROM part"


@query("SELECT subject, left(md5(subject), 10) AS decision_id, ['drop', 'rename', 'map', 'keep', 'merge', 'open', 'define', 'unread'][1 + p % 8] AS kind, CASE p % 8 WHEN 1 THEN 'New ' || CAST(p AS STRING) WHEN 2 THEN 'G > X' WHEN 6 THEN 'things' END AS argument FROM (SELECT 'NODE ' || CAST(p_partkey AS STRING) AS subject, CAST(p_partkey AS INTEGER) AS p FROM part)", derived=False)
def parsed_rulings(spark, d):
    (part,) = frames(spark, d, "part")
    part.createOrReplaceTempView("part")
    return rulings.parsed(spark.sql(RULINGS)).select("subject", "decision_id", "kind", "argument")


@query("SELECT path, CASE p % 8 WHEN 1 THEN 'New ' || CAST(p AS STRING) WHEN 2 THEN 'G > X' ELSE path END AS new_path, p % 8 = 0 AS dropped, lines FROM (SELECT 'NODE ' || CAST(p_partkey AS STRING) AS path, p_partkey AS p, CAST(p_size AS BIGINT) AS lines FROM part)", derived=False)
def applied_rulings(spark, d):
    (part,) = frames(spark, d, "part")
    part.createOrReplaceTempView("part")
    nodes = part.select(F.concat(F.lit("NODE "), F.col("p_partkey").cast("string")).alias("path"), F.col("p_size").cast("long").alias("lines"))
    return rulings.applied(nodes, rulings.parsed(spark.sql(RULINGS))).select("path", "new_path", "dropped", "lines")


#: Decisions of every type with the answers that people type, one for each part.
DECISIONS = """SELECT p_partkey, 'T1, T2' AS tenants, CASE WHEN p % 17 < 8 THEN 'ALMOST THE SAME' WHEN p % 17 = 8 THEN 'MANUAL ADD' WHEN p % 17 = 9 THEN 'manual drop' WHEN p % 17 = 10 THEN 'MANUAL RENAME' WHEN p % 17 = 11 THEN 'MANUAL DEFINE' ELSE 'mapping' END AS type,
 CASE WHEN p % 17 < 8 THEN '' ELSE 'Clinical > Old ' || p_brand || ' > (not used at this level)' END AS detail, 'Paste ' || p_name AS option_a, 'Pasta ' || p_name AS option_b,
 CASE p % 17 WHEN 0 THEN 'Option A' WHEN 1 THEN ' b ' WHEN 2 THEN 'Keep both' WHEN 3 THEN 'these can''t be merged' WHEN 4 THEN 'merge them as "Spreads"' WHEN 5 THEN 'Dough' WHEN 6 THEN '  ' WHEN 7 THEN NULL
  WHEN 8 THEN CASE WHEN p % 2 = 0 THEN 'Clinical >  New > New ' ELSE 'Elsewhere > New' END WHEN 9 THEN 'Clinical > Gone' WHEN 10 THEN CASE WHEN p % 2 = 0 THEN 'Fire' ELSE 'Clinical > Fire' END WHEN 11 THEN 'What burns, not what smokes'
  WHEN 12 THEN 'isn''t this medical?' WHEN 13 THEN 'CLINICAL > OLD ' || p_brand WHEN 14 THEN 'Clinical > Old ' || lower(p_brand) ELSE 'Non-Clinical > Here > here' END AS ruling FROM (SELECT *, CAST(p_partkey AS INTEGER) AS p FROM part) x"""
RULED = f"""(SELECT *, ['spelling', 'spelling', 'keep', 'keep', 'spelling', 'spelling', 'open', 'open', CASE WHEN p_partkey % 2 = 0 THEN 'add' ELSE 'rejected' END, 'drop', CASE WHEN p_partkey % 2 = 0 THEN 'rename' ELSE 'rejected' END, 'define', 'rejected', 'rejected', 'own', 'target', 'target'][1 + p_partkey % 17] AS kind,
 CASE WHEN p_partkey % 17 IN (11, 14, 15, 16) THEN replace(detail, ' > (not used at this level)', '') END AS subject,
 CASE p_partkey % 17 WHEN 0 THEN option_a WHEN 1 THEN option_b WHEN 4 THEN 'Spreads' WHEN 8 THEN CASE WHEN p_partkey % 2 = 0 THEN 'Clinical > New' ELSE ruling END WHEN 15 THEN 'Non-Clinical > Here' WHEN 16 THEN 'Non-Clinical > Here' WHEN 2 THEN NULL WHEN 3 THEN NULL WHEN 6 THEN NULL WHEN 14 THEN NULL ELSE ruling END AS argument FROM ({DECISIONS}))"""


def ruled(spark, d):
    (part,) = frames(spark, d, "part")
    part.createOrReplaceTempView("part")
    return rulings.by_type(spark.sql(DECISIONS))


@query(f"SELECT p_partkey, kind, subject, argument FROM {RULED}", derived=False)
def rulings_by_type(spark, d):
    return ruled(spark, d).select("p_partkey", "kind", "subject", "argument")


@query(f"SELECT label, min(argument) AS winner FROM (SELECT regexp_replace(upper(replace(unnest([option_a, option_b]), '&', ' AND ')), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS label, argument FROM {RULED} WHERE kind IN ('rename', 'spelling')) GROUP BY label", derived=False)
def ruled_spellings(spark, d):
    return rulings.spellings(ruled(spark, d))


@query(f"SELECT unnest(['T1', 'T2']) AS tenant, path, target FROM (SELECT upper(subject) AS path, min(coalesce(argument, '')) AS target FROM {RULED} WHERE kind IN ('target', 'own') GROUP BY 1)", derived=False)
def ruled_targets(spark, d):
    return rulings.targets(ruled(spark, d))


@query("""SELECT tenant, CAST(batch AS BIGINT) AS batch, count(*) AS units, '{"units":[' || string_agg('{"line_id":' || line_id || ',"part_id":' || part_id || ',"description":"' || d1 || '"}', ',' ORDER BY line_id, part_id) || ']}' AS payload
 FROM (SELECT tenant, line_id, part_id, d1, floor((row_number() OVER (PARTITION BY tenant ORDER BY line_id, part_id) - 1) / 50) AS batch FROM lines WHERE verdict IS NULL) GROUP BY tenant, batch""")
def batch_payloads(spark, d):
    (lines,) = frames(spark, d, "lines")
    units = lines.where("verdict IS NULL").select("tenant", "line_id", "part_id", F.col("d1").alias("description"))
    return writers.batches(units, 50, "tenant", F.struct("line_id", "part_id")).select("tenant", "batch", "units", "payload")


#: Votes as models send them: a list in an object, a bare list, fences, prose with brackets around, a vote said twice,
#: and JSON that is cut off, by the order that a batch is of.
@query("""SELECT DISTINCT order_id, line_id, verdict, basis, suggested_key FROM (SELECT line_id, verdict, basis, suggested_key, CAST(line_id // 10 AS BIGINT) AS order_id FROM votes WHERE seat = 1) WHERE order_id % 6 <> 5""")
def parsed_answers(spark, d):
    (votes,) = frames(spark, d, "votes")
    v = votes.where("seat = 1").select(F.floor(F.col("line_id") / 10).cast("long").alias("order_id"), F.struct("line_id", "verdict", "basis", "suggested_key", "rationale").alias("v"))
    texts = v.groupBy("order_id").agg(F.to_json(F.array_sort(F.collect_list("v"))).alias("rows"), F.min("v.line_id").alias("first"))
    bare, inside = F.col("rows"), F.concat(F.lit('{"verdicts":'), F.col("rows"), F.lit("}"))
    twice = F.concat(F.lit("["), F.concat(F.lit('{"line_id":'), F.col("first").cast("string"), F.lit(',"verdict":"withdrawn"},{"verdict":"no id"},')), F.substring(bare, F.lit(2), F.length(bare)))
    k = F.col("order_id") % 6
    said = (
        F.when(k == 0, inside).when(k == 1, bare).when(k == 2, F.concat(F.lit("```json\n"), inside, F.lit("\n```")))
        .when(k == 3, F.concat(F.lit("Here is what I think: "), inside, F.lit(" - I left {some} out."))).when(k == 4, twice).otherwise(F.substring(inside, F.lit(1), F.length(inside) - 3))
    )
    return answers.answers(texts.select("order_id", said.alias("said")), "said", ["order_id"]).select("order_id", "line_id", "verdict", "basis", "suggested_key")


@query("SELECT tenant, basis, count(*) AS lines, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY tenant), 4) AS pct FROM (SELECT l.tenant, v.basis, l.verdict FROM lines l JOIN (SELECT line_id, basis FROM votes WHERE seat = 2) v USING (line_id)) WHERE verdict IS NOT NULL GROUP BY tenant, basis")
def basis_mix(spark, d):
    lines, votes = frames(spark, d, "lines", "votes")
    return monitor.mix(lines.select("tenant", "line_id", "verdict").join(votes.where("seat = 2").select("line_id", "basis"), "line_id"), "basis")


#: A reviewer's answers, made from the votes of a seat: where the vote is another one, it names the suggested category.
REVIEWED = """(SELECT l.line_id, l.verdict, l.l0, CASE WHEN v.verdict = l.verdict THEN 'agree' WHEN v.verdict = 'Correct' THEN 'disagree - the current category is fine' WHEN v.verdict = 'Incorrect' THEN 'disagree - another category' ELSE v.verdict END AS response,
 CASE WHEN v.verdict = 'Incorrect' THEN trim(v.suggested_key) END AS category FROM (SELECT line_id, min(verdict) AS verdict, min(l0) AS l0 FROM lines GROUP BY 1) l JOIN (SELECT DISTINCT line_id, verdict, suggested_key FROM votes WHERE seat = 0) v USING (line_id))"""


@query(f"""SELECT line_id, CASE WHEN reject IS NULL THEN CASE response WHEN 'agree' THEN 'agreed' WHEN 'disagree - the current category is fine' THEN 'disagreed_current_ok' ELSE 'disagreed_new_category' END END AS status, reject AS reject_reason,
 CASE WHEN reject IS NULL AND response <> 'agree' THEN CASE WHEN response LIKE '%fine' THEN 'Correct' ELSE 'Incorrect' END END AS override_verdict FROM (SELECT *, CASE WHEN response IS NULL AND category IS NOT NULL THEN 'no response' WHEN response IS NULL THEN 'blank'
 WHEN response NOT IN ('agree', 'disagree - the current category is fine', 'disagree - another category') THEN 'unknown response' WHEN response = 'agree' AND category IS NOT NULL THEN 'agrees and names a category' WHEN response LIKE '%fine' AND verdict = 'Correct' THEN 'that is agreement'
 WHEN response LIKE '%fine' AND l0 = '' THEN 'there is no category' WHEN category = 'NC-0006' THEN 'unknown category' WHEN category = 'NC-0005' AND l0 <> '' THEN 'out of scope' END AS reject FROM {REVIEWED})""")
def review_intake(spark, d):
    lines, votes, keys_ = frames(spark, d, "lines", "votes", "keys_")
    lines = lines.groupBy("line_id").agg(*[F.min(c).alias(c) for c in ("tenant", "verdict", "l0", "l1")])  # ids repeat here
    v, l = votes.where("seat = 0").select("line_id", F.col("verdict").alias("v"), "suggested_key").distinct(), lines.select("line_id", F.col("verdict").alias("own"))
    said = F.when(F.col("v") == F.col("own"), review.AGREES).when(F.col("v") == "Correct", review.CURRENT_FITS).when(F.col("v") == "Incorrect", review.ELSEWHERE).otherwise(F.col("v"))
    typed = v.join(l, "line_id").select("line_id", said.alias("response"), F.when(F.col("v") == "Incorrect", F.col("suggested_key")).alias("category"), F.lit(None).cast("string").alias("note"))
    tree = lines.select("tenant").distinct().crossJoin(F.broadcast(keys_)).select("tenant", F.col("category_key").alias("path"), "in_scope")  # six keys
    return review.intake(typed, lines.withColumn("path", F.concat_ws(" > ", "l0", "l1")), tree).select("line_id", "status", "reject_reason", "override_verdict")


@query("SELECT subject_id, a.units AS before, b.units AS after, CASE WHEN a.units IS NULL THEN 'new' WHEN b.units IS NULL THEN 'gone' WHEN a.units = b.units THEN 'same' ELSE 'moved' END AS movement FROM (SELECT tenant || subject_id AS subject_id, count(DISTINCT unit_id) AS units FROM lines WHERE line_no < 5 GROUP BY 1) a FULL JOIN (SELECT tenant || subject_id AS subject_id, count(DISTINCT unit_id) AS units FROM lines WHERE line_no > 2 GROUP BY 1) b USING (subject_id)")
def movement_between_runs(spark, d):
    (lines,) = frames(spark, d, "lines")
    named = lines.withColumn("subject_id", F.concat("tenant", "subject_id"))
    return profile.moved(named.where("line_no < 5"), named.where("line_no > 2"), "subject_id", "unit_id")


@query("SELECT l0, l1, count(*) AS nodes, CAST(sum(lines) AS BIGINT) AS lines, count(DISTINCT tenant) AS tenants FROM (SELECT 'Goods' AS l0, l1, tenant, lines FROM nodes) GROUP BY l0, l1")
def branch_summary(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return normalise.branch_summary(nodes)


@query("SELECT tenant, supplier, count(DISTINCT d1) AS texts, min(d1) AS first_text FROM lines WHERE trim(coalesce(d1, '')) NOT IN ('', 'n/a') GROUP BY tenant, supplier")
def vendor_terms(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.vendor_terms(lines, "d1")


@query("SELECT p_partkey, count(*) AS same FROM part a JOIN (SELECT upper(p_type) || '  ' AS t FROM part WHERE p_partkey < 40) b ON lower(rtrim(a.p_type)) = lower(rtrim(b.t)) GROUP BY p_partkey", derived=False)
def collated_join(spark, d):
    (part,) = frames(spark, d, "part")
    b = part.where("p_partkey < 40").select(F.collate(F.concat(F.upper("p_type"), F.lit("  ")), "UTF8_LCASE_RTRIM").alias("t"))
    return part.withColumn("t", F.collate("p_type", "UTF8_LCASE_RTRIM")).join(b, "t").groupBy("p_partkey").agg(F.count("*").alias("same"))


@query()
def table_checksum(spark, d):
    (lines,) = frames(spark, d, "lines")
    return profile.checksum(lines, ["line_id", "tenant", "cents", "verdict"])


@query("SELECT tenant, count(*) AS rated, count(*) FILTER (label = 'coherent') AS coherent, count(*) FILTER (label = 'unknown') AS unknown FROM (SELECT n_name AS tenant, CASE WHEN s_acctbal < 0 THEN 'unknown' WHEN s_acctbal / 10000 >= 0.7 THEN 'coherent' WHEN s_acctbal / 10000 >= 0.4 THEN 'mixed' ELSE 'incoherent' END AS label FROM supplier JOIN nation ON s_nationkey = n_nationkey) GROUP BY tenant", derived=False)
def coherence_labels(spark, d):
    from tallygrain.operators.enrich import coherence_label

    supplier, nation = frames(spark, d, "supplier", "nation")
    s = supplier.join(F.broadcast(nation), supplier["s_nationkey"] == nation["n_nationkey"]).withColumn("label", coherence_label(F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") / 10000)))
    return s.groupBy(F.col("n_name").alias("tenant")).agg(F.count("*").alias("rated"), F.count_if(F.col("label") == "coherent").alias("coherent"), F.count_if(F.col("label") == "unknown").alias("unknown"))


@query("SELECT tenant, line_id, CAST(jury AS BIGINT) AS seats FROM lines WHERE verdict IS NOT NULL AND jury < 3 AND supplier IS NOT NULL")
def thin_juries(spark, d):
    (lines,) = frames(spark, d, "lines")
    return lines.where(F.col("verdict").isin(*judge.VERDICTS) & (F.col("jury") < 3) & F.col("supplier").isNotNull()).select("tenant", "line_id", F.col("jury").alias("seats"))


#: A tenant's raw tree, with gaps, and how many lines use each key.
RAW = """SELECT tenant, ' ' || source_key AS category_key, CASE WHEN length(l3) % 7 = 0 THEN NULL WHEN length(l1) % 4 = 0 THEN 'Clinical' ELSE g END AS c0, CASE WHEN length(l3) % 5 = 0 THEN NULL ELSE l1 END AS c1,
 l2 AS c2, l3 AS c3, CASE WHEN length(l4) % 2 = 0 THEN ' ' ELSE l4 END AS c4, CAST(NULL AS STRING) AS description, lines FROM nodes"""
ORDERED = "list_filter([c0, c1, c2, c3, c4], lambda x, i: x IS NOT NULL AND list_position([c0, c1, c2, c3, c4], x) = i)"
TREE = f"""(SELECT *, (SELECT 0) AS repeats FROM (SELECT t.*, (SELECT count(DISTINCT coalesce(u.leaf, '')) FROM (SELECT tenant, r[-1] AS leaf, CASE WHEN len(r) > 1 THEN array_to_string(r[:-2], ' > ') END AS parent FROM (SELECT *, {ORDERED} AS r FROM
  (SELECT tenant, nullif(trim(c0), '') AS c0, nullif(trim(c1), '') AS c1, nullif(trim(c2), '') AS c2, nullif(trim(c3), '') AS c3, nullif(trim(c4), '') AS c4 FROM ({RAW})))) u WHERE u.tenant = t.tenant AND u.parent IS NOT DISTINCT FROM t.parent) AS sibling_count
 FROM (SELECT tenant, category_key, concat_ws(' > ', coalesce(c0, gap), coalesce(c1, gap), coalesce(c2, gap), coalesce(c3, gap), coalesce(c4, gap)) AS path_full, c1 AS branch, r[-1] AS leaf, CASE WHEN len(r) > 1 THEN array_to_string(r[:-2], ' > ') END AS parent, CAST(len(r) AS INTEGER) AS depth_distinct,
   coalesce(c0 = 'Clinical', false) AS is_clinical, NOT coalesce(c0 = 'Clinical', false) AS in_scope, CASE WHEN lines > 5 THEN lines ELSE 0 END AS lines_in_scope
  FROM (SELECT *, {ORDERED} AS r, CASE WHEN c0 IS NULL THEN 'Uncategorised' ELSE '(not used at this level)' END AS gap FROM
   (SELECT tenant, trim(category_key) AS category_key, nullif(trim(c0), '') AS c0, nullif(trim(c1), '') AS c1, nullif(trim(c2), '') AS c2, nullif(trim(c3), '') AS c3, nullif(trim(c4), '') AS c4, lines FROM ({RAW})))) t))"""
OF_TREE = ("tenant", "category_key", "path_full", "branch", "leaf", "parent", "depth_distinct", "sibling_count", "is_clinical", "in_scope", "lines_in_scope")


def raw_tree(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    return nodes.selectExpr(*[x.strip() for x in (
        "tenant", "' ' || source_key AS category_key", "CASE WHEN length(l3) % 7 = 0 THEN NULL WHEN length(l1) % 4 = 0 THEN 'Clinical' ELSE g END AS c0", "CASE WHEN length(l3) % 5 = 0 THEN NULL ELSE l1 END AS c1",
        "l2 AS c2", "l3 AS c3", "CASE WHEN length(l4) % 2 = 0 THEN ' ' ELSE l4 END AS c4", "CAST(NULL AS STRING) AS description", "lines",
    )])


def tree_of(spark, d):
    raw = shared(raw_tree(spark, d))  # a few nodes of many lines, read three times
    return normalise.tenant_tree(raw, ["c0", "c1", "c2", "c3", "c4"], raw.where("lines > 5").select("tenant", "category_key", "lines"), ())


@query(f"SELECT {', '.join(OF_TREE)} FROM {TREE}")
def tenant_taxonomy(spark, d):
    return tree_of(spark, d).select(*OF_TREE)


@query(f"SELECT tenant, branch, count(*) AS leaves, CAST(sum(lines_in_scope) AS BIGINT) AS lines FROM {TREE} WHERE in_scope AND lines_in_scope > 0 AND branch IS NOT NULL GROUP BY tenant, branch")
def branch_choice(spark, d):
    return normalise.branches(tree_of(spark, d), used_only=True)


@query(f"SELECT tenant, branch, category_key, leaf, path_full, lines_in_scope FROM {TREE} WHERE in_scope AND branch = 'Brand#' || substr(tenant, -1)")
def leaves_of_branch(spark, d):
    own = F.concat(F.lit("Brand#"), F.substring("tenant", -1, 1))
    return normalise.leaves_of(tree_of(spark, d), own).drop("description")


@query("SELECT tenant, CASE WHEN p_partkey IS NULL THEN '(no join)' WHEN trim(l1) = trim(p_brand) AND trim(l2) = trim(p_type) THEN 'Y' ELSE 'N' END AS agrees, count(*) AS lines FROM lines LEFT JOIN (SELECT * FROM part WHERE p_partkey % 9 <> 0) p ON part_id = p_partkey GROUP BY 1, 2")
def path_agreement(spark, d):
    lines, part = frames(spark, d, "lines", "part")
    j = lines.join(part.where("p_partkey % 9 <> 0"), F.col("part_id") == F.col("p_partkey"), "left")
    agrees = normalise.path_agrees([F.col("l1"), F.col("l2")], [F.col("p_brand"), F.col("p_type")], F.col("p_partkey").isNotNull())
    return j.groupBy("tenant", agrees.alias("agrees")).agg(F.count("*").alias("lines"))


@query("SELECT tenant, non_procurement, count(*) AS lines FROM (SELECT tenant, CASE WHEN l0 = 'Excluded' THEN true ELSE l1 = 'Brand#11' AND line_no = 1 END AS non_procurement FROM lines) GROUP BY 1, 2")
def non_procurement_lines(spark, d):
    (lines,) = frames(spark, d, "lines")
    l0 = F.when(F.col("l0") == "Excluded", " Non-Procurement ").otherwise(F.col("l0"))
    l1 = F.when((F.col("l1") == "Brand#11") & (F.col("line_no") == 1), "Non-Procurement").otherwise(F.nullif("l1", F.lit("Brand#12")))
    return lines.groupBy("tenant", normalise.non_procurement(l0, l1).alias("non_procurement")).agg(F.count("*").alias("lines"))


@query("""SELECT line_id, CASE WHEN k IS NOT NULL THEN l0 END AS suggested_l0, CASE WHEN k IS NOT NULL THEN CASE WHEN k = 'NC-0002' THEN '(not used at this level)' ELSE 'Branch ' || k END END AS suggested_l1, CASE WHEN k IS NOT NULL THEN '(no level 2 in this taxonomy)' END AS suggested_l2
 FROM lines x LEFT JOIN (SELECT category_key AS k, l0 FROM keys_) y ON x.suggested_key = y.k""".replace("CASE WHEN k IS NOT NULL THEN l0 END", "y.l0"))
def suggestion_levels(spark, d):
    lines, keys_ = frames(spark, d, "lines", "keys_")
    tree = keys_.withColumn("l1", F.when(F.col("category_key") == "NC-0002", " ").otherwise(F.concat(F.lit("Branch "), "category_key"))).withColumn("l2", F.lit(None).cast("string"))
    return judge.suggested_levels(lines, tree, ["l0", "l1", "l2"]).select("line_id", "suggested_l0", "suggested_l1", "suggested_l2")


@query("SELECT tenant, rule_id, count(*) FILTER (l0 = '') AS in_stratum, count(*) AS lines FROM lines GROUP BY tenant, rule_id HAVING count(*) FILTER (l0 = '') > 0")
def rule_census(spark, d):
    (lines,) = frames(spark, d, "lines")
    return normalise.rule_census(lines, F.col("l0") == "")


@query("SELECT l1 IN ('Brand#11', 'Brand#12') AS inside, count(*) AS nodes FROM nodes WHERE tenant <> 'NATION_1' GROUP BY 1")
def nodes_within_roots(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    own = normalise.without_own_output(nodes.withColumn("p", F.concat_ws(" > ", "l1", "l2")), "NATION_1")
    inside, outside = normalise.within_roots(own, "p", ("BRAND#11", "Brand#12"))
    return inside.withColumn("inside", F.lit(True)).unionByName(outside.withColumn("inside", F.lit(False))).groupBy("inside").agg(F.count("*").alias("nodes"))


@query("SELECT tenant, supplier FROM (SELECT tenant, supplier, count(*) FILTER (verdict IS NULL) AS open, row_number() OVER (PARTITION BY tenant ORDER BY CAST(sum(cents) AS BIGINT) DESC, upper(left(sha256(tenant || '|' || coalesce(supplier, '')), 20))) AS r FROM lines GROUP BY 1, 2) WHERE r <= 5 AND open > 0")
def sliced_vendors(spark, d):
    (lines,) = frames(spark, d, "lines")
    q = queue.ranked(queue.base(lines, F.col("verdict").isNotNull()).drop("subjects"))
    return queue.slice_then_filter(q, "vendor_rank", 5, F.col("lines_unjudged") > 0).select("tenant", "supplier")


@query("SELECT tenant AS \"TENANT\", line_id AS \"QA_LINE\", cents AS \"SPEND\" FROM lines")
def output_names(spark, d):
    (lines,) = frames(spark, d, "lines")
    return normalise.output_names(lines.select("tenant", "line_id", "cents"), {"line_id": "QA_LINE", "cents": "SPEND"})


@query("SELECT path, CASE WHEN starts_with(path, 'Goods > Brand#11 > ') THEN 'Goods > Brand#11 > Group ' || substr(path, 20) WHEN upper(split_part(path, ' > ', 4)) = 'BOLT' THEN replace(replace(path, ' > bolt', ' > Bolts'), ' > BOLT', ' > Bolts') ELSE path END AS now FROM (SELECT DISTINCT path FROM nodes WHERE split_part(path, ' > ', 5) NOT IN ('bolt', 'BOLT'))".replace("'Goods > Brand#11 > Group ' || substr(path, 20)", "CASE WHEN upper(split_part(path, ' > ', 4)) = 'BOLT' THEN replace(replace('Goods > B11 > ' || substr(path, 20), ' > bolt', ' > Bolts'), ' > BOLT', ' > Bolts') ELSE 'Goods > B11 > ' || substr(path, 20) END"))
def rewritten_paths(spark, d):
    (nodes,) = frames(spark, d, "nodes")
    p = nodes.select("path").distinct().where("split_part(path, ' > ', 5) NOT IN ('bolt', 'BOLT')")
    rewrites = spark.sql("SELECT 3 AS level, 'BOLT' AS label, 'Bolts' AS winner")
    by_parent = spark.sql("SELECT 'GOODS' AS parent, 1 AS level, 'BRAND#11' AS label, 'B11' AS winner")
    return taxonomy.apply_rewrites(p.withColumn("now", F.col("path")), "now", rewrites, by_parent)
