import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallygrain.functions import keys, paths, text
from tallygrain.operators import actions, checks, judge, monitor, normalise, review, sampling, taxonomy
from tallygrain.sources import readers, writers


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if not isinstance(v, (int, list)) else 'array<string>' if isinstance(v, list) else 'long'}" for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("a, want", [("Cost & Care", "COSTANDCARE"), ("x-ray  film", "XRAYFILM"), ("", "")])
def test_loose(spark, a, want):
    assert one(spark, text.loose(F.col("a")), a=a) == want


def test_plain_and_placeholders(spark):
    assert one(spark, text.plain(F.col("a")), a=" Food & Beverages ") == "food and beverage"
    assert one(spark, text.first_usable([F.col("a"), F.col("b")]), a="n/a", b=" bolt ") == "bolt"
    assert one(spark, text.first_usable([F.col("a"), F.col("b")]), a="n/a", b=None) == "n/a"
    assert one(spark, text.filled_by({"a": F.col("a"), "b": F.col("b")}), a=" ", b="x") == "b"


@pytest.mark.parametrize("raw, want", [(None, None), ("0.5", 0.5), ("high", 0.0), ("7", 1.0), ("-1", 0.0), ("NaN", 0.0)])
def test_confidence(spark, raw, want):
    assert one(spark, text.confidence(F.col("a")), a=raw) == want


@pytest.mark.parametrize("said, want", [("to NC-0001 then", "NC-0001"), ("NC-0001 or NC-0002", None), ("ZZ-9999", None), ("none", None), ("", None), (None, None), ("NC-0001 and ZZ-9999", "NC-0001")])
def test_recovered_key(spark, said, want):
    assert one(spark, text.recovered_key(F.col("a"), F.array(F.lit("NC-0001"), F.lit("NC-0002"))), a=said) == want


def test_verdict_in(spark):
    assert one(spark, text.verdict_in(F.col("a"), ("mixed",)), a='{"verdict": "mixed"}') == "mixed"
    assert one(spark, text.verdict_in(F.col("a"), ("mixed",)), a='so "verdict": "mixed".') == "mixed"
    assert one(spark, text.verdict_in(F.col("a"), ("mixed",)), a="junk") is None
    assert one(spark, text.verdict_in(F.col("a"), ("mixed",)), a='{"verdict": "Mixed "}') == "mixed"
    assert one(spark, text.verdict_in(F.col("a"), ("mixed",)), a='{"verdict": "odd", "was": {"verdict": "mixed"}}') == "mixed"


def test_paths(spark):
    c = paths.canonical(paths.split_path(F.col("a")))
    assert one(spark, c, a="A > Tolls > tolls > (Not used at this level) > (Small) B") == ["A", "Tolls", "(Small) B"]
    assert one(spark, paths.padded(c), a="A > B") == ["A", "B", "B", "B", "B"]
    assert one(spark, paths.padded(c), a="A") == ["A"] * 5
    assert one(spark, paths.carried(c, "Not Yet Categorized"), a="A > Not yet categorized > C") == ["A", "Not Yet Categorized", "Not Yet Categorized"]
    assert one(spark, paths.prefixes(c, proper=True), a="A > B > C") == ["A", "A > B"]
    assert one(spark, paths.plain_path(F.col("a")), a="Fleet > Parking & Tolls") == "fleet > parking and toll"


def test_keys(spark):
    a = one(spark, keys.stable_key(F.col("a"), F.col("b")), a=None, b="x")
    assert a == one(spark, keys.stable_key(F.col("a"), F.col("b")), a="", b="x") and len(a) == 20 and a == a.upper()
    assert a != one(spark, keys.stable_key(F.col("a"), F.col("b"), utf16=True), a="", b="x")


# tenant, tax_key, l1..l4, verdict, suggested key -> action, fill key
CASES = [
    ("t1", "1", "a", "b", "c", "d", "Uncertain", "CL-1", "Out of scope", None),
    ("t1", "1", "a", "b", "c", "d", "Uncertain", None, "Needs evidence", None),
    ("t1", "1", "a", "b", "c", "d", "Incorrect", None, "Needs evidence", None),
    ("t1", "1", "a", "n/a", None, "(not used at this level)", "Correct", None, "Incomplete", None),
    ("t1", "1", "None", "", "", "", "Incorrect", "NC-0009", "Incomplete", None),
    ("t1", "27", "a", "b", "c", "d", "Incorrect", "NC-1", "Re-mapped", None),
    ("t1", "27", "a", "b", "c", "d", "Correct", None, "Re-mapped", "NC-1"),
    ("t1", "88", "a", "b", "c", "d", "Correct", None, "No change", None),
    ("t2", "27", "a", "b", "c", "d", "Correct", None, "No change", None),
    ("t1", "88", "a", "b", "c", "d", "Incorrect", "NC-0009", "Miscategorised", None),
]


def test_action_table(spark):
    cols = "tenant string, tax_key string, l1 string, l2 string, l3 string, l4 string, verdict string, suggested_key string, want string, fill string, n int"
    lines = spark.createDataFrame([(*c, k) for k, c in enumerate(CASES)], cols)
    cross = spark.createDataFrame([("t1", "27", "NC-1", True), ("t1", "88", "NC-2", False)], "tenant string, source_key string, target_key string, moved boolean")
    known = spark.createDataFrame([("CL-1", "Clinical"), ("NC-1", "Goods"), ("NC-0009", "Goods")], "category_key string, l0 string")
    got = actions.classify(lines, cross, known).orderBy("n").collect()
    assert [(r["action"], r["fill_key"]) for r in got] == [(r["want"], r["fill"]) for r in got] and len(got) == len(CASES)
    doubled = actions.classify(lines, cross.unionByName(cross).unionByName(cross.withColumn("target_key", F.lit("Z"))), known.unionByName(known))
    assert doubled.count() == len(CASES)
    twice = actions.classify_twice(lines.withColumn("rationale", F.lit("see NC-0009")), cross, known).where("n = 2").first()
    assert twice["action"] == "Miscategorised" and twice["suggested_key"] == "NC-0009"


def ballots(spark, *votes):
    return spark.createDataFrame([(1, k, *v) for k, v in enumerate(votes)], judge.VOTES)


def test_votes(spark):
    known = spark.createDataFrame([("A", True), ("B", True), ("C", False)], "category_key string, in_scope boolean")
    tally = lambda *v, **k: judge.tally(ballots(spark, *v), known, **k).first()
    r = tally(("Incorrect", "0.8", "rule", "A", None), ("Incorrect", "x", "rule", " A ", "why"), ("Correct", "1", "rule", "B", "no"))
    assert (r["verdict"], r["agreement"], r["confidence"], r["suggested_key"], r["rationale"], r["jury"]) == ("Incorrect", "2of3", 0.4, "A", "why", 3)
    r = tally(("Incorrect", "1", "rule", "A", "a"), ("Correct", "1", "rule", None, "b"), ("Uncertain", "1", "rule", None, "c"))
    assert (r["verdict"], r["agreement"], r["suggested_key"], r["basis"]) == ("Uncertain", "split", None, "no_evidence")
    assert tally(("maybe", "1", "rule", "A", "a"), (None, None, None, None, None)) is None
    r = tally(("Incorrect", "1", "odd", "C", ""), ("Incorrect", "1", None, "C", "z"))
    assert (r["suggested_key"], r["basis"], r["agreement"], r["rationale"]) == (None, "no_evidence", "2of2", "z")
    assert tally(("Incorrect", "1", "rule", "C", ""), ("Incorrect", "1", "rule", "C", "z"), uncategorised=F.lit(True))["suggested_key"] == "C"


@pytest.mark.parametrize("ids, want", [(range(8), (8, 0, 0)), ([0, 1, 2, 3, 4, 5, 90, 91], (6, 2, 2)), ([0, 1, 2, 3, 4], (5, 0, 3))])
def test_coverage(spark, ids, want):
    u = spark.range(8).select(F.col("id").alias("line_id"))
    a = spark.createDataFrame([(0, int(i)) for i in ids], "seat int, line_id long")
    r = judge.coverage(u, a).first()
    assert (r["answered"], r["alien"], r["missing"]) == want


def test_scorer(spark):
    def scorer(batches):
        for b in batches:
            yield b.assign(seat=0, verdict="Correct", confidence="1", basis="rule", suggested_key=None, rationale=None)[["line_id", "seat", "verdict", "confidence", "basis", "suggested_key", "rationale"]]

    assert judge.score(spark.range(5).select(F.col("id").alias("line_id")), scorer, 2).where("verdict = 'Correct'").count() == 5


def test_rate(spark):
    now = F.lit(dt.datetime(2024, 1, 1, 12, 0)).cast("timestamp")
    at = lambda m: F.lit(dt.datetime(2024, 1, 1, 12, 0) - dt.timedelta(minutes=m)).cast("timestamp")
    cases = [(36, 8, 15, 4.5), (36, 8, 60, 4.5), (36, 0, 15, 36.0), (540, 20, 15, 36.0), (0, 2, 60, 0.0), (9, 45, 60, 0.2)]
    for n, span, window, want in cases:
        assert spark.range(1).select(monitor.rate(F.lit(n), at(span), now, window).alias("x")).first()["x"] == want


def test_error_rate(spark):
    lines = spark.createDataFrame([("t", v, 3, 1) for v, n in (("Correct", 30), ("Incorrect", 10), ("Uncertain", 7)) for _ in range(n)] + [("u", None, None, 1)], "tenant string, verdict string, jury int, cents long")
    got = {r["tenant"]: r["error_rate"] for r in monitor.panel(lines).collect()}
    assert got["t"] == 25.0 and got["u"] is None


def test_plan_strata():
    assert sampling.plan_strata(30, 60, 900, 900) == (18, 12)
    assert sampling.plan_strata(7, 50, 900, 900) == (4, 3)  # the floor is rounded up
    assert sampling.plan_strata(30, 60, 900, 2) == (28, 2)  # what lacks goes to the categorised
    assert sampling.plan_strata(30, 60, 5, 900) == (5, 12)  # and never the other way


def test_config():
    c = normalise.TenantConfig("t", {"supplier": "s"}, ("d",), tables={"lines": "a.b.c"})
    assert c.missing_for_run() == ["spend", "l0", "l1"]
    with pytest.raises(ValueError):
        c.same_catalog()


def test_joins_need_a_tenant(spark):
    with pytest.raises(ValueError):
        normalise.tenant_join(spark.range(1), spark.range(1), ["id"])


def test_crosswalk_tiers(spark):
    sp = spark.createDataFrame([("G > A > B > Lamps",), ("G > A > C > Cups",), ("G > Z > Pens",), ("G > A > D > Maps",), ("G > A > E > Maps",)], "path string")
    cases = {"G > A > B > lamps": "exact", "": "malformed", "G > A > Not yet categorized": "uncategorised_by_rule", "G > A > Lamps": "leaf_moved", "G > A > Q > Maps": "leaf_moved_ambiguous", "G > A > Cup-s": "leaf_variant", "G > Y > Pens": "leaf_crosses_branch", "G > A > B > New": "parent_match", "Q > R": "unmapped"}
    nodes = spark.createDataFrame([("t", str(k), p, 1) for k, p in enumerate(cases)], "tenant string, source_key string, path string, lines long")
    got = {r["path"]: r for r in taxonomy.crosswalk(nodes, sp).collect()}
    assert {p: r["basis"] for p, r in got.items()} == cases
    assert got["G > A > Lamps"]["target"] == "G > A > B > Lamps" and got["G > A > Q > Maps"]["candidates"] == ["G > A > D > Maps", "G > A > E > Maps"]
    assert got["G > A > B > New"]["target"] == "G > A > B" and got["G > A > B > New"]["confidence"] == 0.75
    assert taxonomy.conserved(nodes, taxonomy.merged(taxonomy.crosswalk(nodes, sp)), nodes.limit(0)).first()["ok"]


def test_numbers_stay(spark):
    tree = spark.createDataFrame([("CLINICAL > A",), ("CLINICAL > B",), ("CLINICAL > AA",), ("NON-CLINICAL > X",)], "resolved string")
    old = spark.createDataFrame([("CLINICAL > B", "CL-0001"), ("CLINICAL > GONE", "CL-0007")], "resolved string, category_key string")
    got = {r["resolved"]: r["category_key"] for r in taxonomy.numbered(tree, old).collect()}
    assert got == {"CLINICAL > A": "CL-0008", "CLINICAL > AA": "CL-0009", "CLINICAL > B": "CL-0001", "NON-CLINICAL > X": "NC-0001"}


def test_typos(spark):
    rows = [("p", "Cable", 2), ("p", "Cables", 5), ("p", "Night Lamp", 1), ("p", "Right-Lamp", 4), ("p", "Abc", 1), ("p", "Abd", 1), ("p", "Xcable", 1), ("p", "Inpatient", 3), ("p", "Unpatient", 3), ("p", "Door & Lock", 1), ("p", "door and lock", 1)]
    rows += [(q, x, 1) for q in "pqr" for x in ("Gauze", "Gauce")]
    labels = spark.createDataFrame([(p, 1, x, n) for p, x, n in rows], "parent string, level int, label string, lines long")
    pairs = taxonomy.typo_pairs(labels, keep=(("INPATIENT", "UNPATIENT"),), forced={"XCABLE": "Cable X"})
    got = {(r["a"], r["b"]): (r["ruling"], r["edits"], r["parents"]) for r in pairs.collect()}
    assert got == {
        ("Cable", "Cables"): ("auto", 1, 1), ("Cable", "Xcable"): ("auto", 1, 1), ("Cables", "Xcable"): ("auto", 2, 1), ("Night Lamp", "Right-Lamp"): ("flag", 1, 1),
        ("Inpatient", "Unpatient"): ("kept", 1, 1), ("Gauce", "Gauze"): ("auto", 1, 3),
    }
    won = {r["label"]: r["winner"] for r in taxonomy.typo_rewrites(pairs, {"XCABLE": "Cable X"}).collect()}
    assert won == {"CABLE": "Cable X", "CABLES": "Cable X", "XCABLE": "Cable X", "GAUZE": "Gauce"}


def test_audit_finds_each_kind(spark):
    nodes = spark.createDataFrame([("C > Food > Frozen Fruit > Fresh Berries", 5), ("C > Food > Pickled Goods", 1), ("C > Food > Pickeled Goods", 2), ("C > Fees > Sundry Fees", 4), ("N > Food > Pickled Goods", 0), ("N > Food > Pickled Goods > Cans", 1), ("N > Is it food?", 1), ("N > Lone > Rates > Rates - Other", 3), ("N > Travel > Air Transport", 1), ("N > Freight > Transport Air", 1), ("N > Help > Garden Tool Equipment > General Garden Tools", 7)], "path string, lines long")
    got = {(r["check"], r["path"], r["lines"]) for r in taxonomy.audit(nodes).collect()}
    assert got == {
        ("junk", "N > Is it food?", 1), ("prefix_bucket", "N > Food > Pickled Goods", 0), ("sole_other", "N > Lone > Rates > Rates - Other", 3),
        ("multi_home", "C > Food > Pickled Goods", 1), ("word_order", "Air Transport", 2), ("hollow", "N > Help > Garden Tool Equipment > General Garden Tools", 7), ("hollow", "C > Fees > Sundry Fees", 4),
        ("contradiction", "C > Food > Frozen Fruit > Fresh Berries", 5), ("near_label", "Pickeled Goods ~ Pickled Goods", 4),
        ("generic", "C > Fees > Sundry Fees", 4), ("generic", "N > Lone > Rates > Rates - Other", 3), ("generic", "N > Help > Garden Tool Equipment > General Garden Tools", 7),
        ("thin_branch", "C > Fees", 4), ("thin_branch", "N > Lone", 3), ("thin_branch", "N > Is it food?", 1), ("thin_branch", "N > Travel", 1), ("thin_branch", "N > Freight", 1), ("thin_branch", "N > Help", 7), ("shared_group", "Pickled Goods", 2),
    }


def test_agreeing_group():
    pairs = [("a", "b", 0.9), ("a", "c", 0.8), ("b", "c", 0.2), ("c", "d", 0.9)]
    assert taxonomy.agreeing_group(pairs, ["a", "b", "c", "d"]) == ["a", "b"]


def test_authority(spark):
    nodes = spark.createDataFrame([("t", "1", "C > A", 5), ("t", "2", "C > Old", 3), ("t", "3", "C > Unused", 0), ("t", "4", "N > X", 1)], "tenant string, source_key string, path string, lines long")
    got = {r["path"]: r["lines"] for r in taxonomy.with_authority(nodes, spark.createDataFrame([("C > A",), ("C > B",)], "path string"), "t", "C").collect()}
    assert got == {"C > A": 5, "C > B": 0, "C > Old": 3, "N > X": 1}


def test_review(spark):
    a = spark.createDataFrame([(1, "Agree", None, ""), (2, "Hm", None, ""), (3, "Disagree", "", ""), (9, "Agree", None, ""), (4, "Disagree", "X", ""), (5, "Agree", None, ""), (5, "Agree", None, "")], "line_id long, response string, category string, note string")
    lines = spark.range(1, 6).select(F.col("id").alias("line_id"))
    names = spark.createDataFrame([("Y", "NC-1")], "name string, category_key string")
    got = sorted((r["line_id"], r["reject_reason"] or "") for r in review.ingest(a, lines, names).collect())
    assert got == [(1, ""), (2, "unknown response"), (3, "no category"), (4, "unknown category"), (5, "answered twice"), (5, "answered twice"), (9, "unknown line")]


def test_contradicts_itself(spark):
    c = actions.contradicts_itself("a", "b", [("medical device", ("medical",)), ("fuel", ("fuel", "fleet"))])
    assert one(spark, c, a="the item is a medical device", b="Office") == "medical device"
    assert one(spark, c, a="the item is fuel", b="Fleet costs") is None
    upper = actions.contradicts_itself("a", "b", [("Candle", ("Candle",))])
    assert one(spark, upper, a="this item is a candle", b="Candles") is None and one(spark, upper, a="this item is a candle", b="Pens") == "Candle"


def test_write_guard():
    writers.writable("qa_test", "qa_test", False, "qa")
    writers.writable("qa", "qa_test", True, "qa")
    for name, production in (("qa", False), ("qa_tes", False), ("", False), ("qa_test", True), (" ", True)):
        with pytest.raises(PermissionError):
            writers.writable(name, "qa_test", production, "qa")


def test_slices_replace_once(spark, tmp_path):
    df = spark.createDataFrame([("r1", "a", 1), ("r1", "b", 2)], "run_id string, tenant string, x int")
    p = str(tmp_path / "t")
    writers.replace_slices(df, p)
    writers.replace_slices(df.where("tenant = 'a'").withColumn("x", F.lit(5)), p)
    assert sorted((r["tenant"], r["x"]) for r in spark.read.parquet(p).collect()) == [("a", 5), ("b", 2)]
    left = writers.supersede(spark.createDataFrame([("r2", "a", 9)], df.schema), p, "r1", 1)
    assert [(r["run_id"], r["x"]) for r in left.collect()] == [("r2", 9)]
    with pytest.raises(PermissionError):
        writers.refuse_if_precious(df.withColumn("verdict", F.lit("Correct")).withColumn("response", F.lit(None)))


def test_view_keeps_lines(spark):
    lines = spark.createDataFrame([("r", "t", "1", 1), ("r", "t", "9", 2)], "run_id string, tenant string, rule_id string, line_id int")
    rules = spark.createDataFrame([("r", "t", "1", "b", "B"), ("r", "t", "1", "a", "A")], "run_id string, tenant string, rule_id string, rules_table string, field string")
    got = {r["line_id"]: r["rule_field"] for r in writers.line_view(lines, rules).collect()}
    assert got == {1: "A", 2: None}


def test_read_only():
    assert readers.read_only("SELECT 1")
    for bad in ("DELETE FROM t", "SELECT 1; DROP TABLE t", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", ""):
        with pytest.raises(ValueError):
            readers.read_only(bad)


def test_readers(spark, tmp_path):
    assert readers.settings("﻿A=1\n# no\nB = 'x=y'\n\n") == {"A": "1", "B": "x=y"}
    (tmp_path / "b.csv").write_text("﻿k,v\n1,x\n")
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    assert readers.csv(spark, str(tmp_path / "b.csv")).columns == ["k", "v"]
    for name, second in (("b.csv", 1_000), ("a.csv", 2_000)):
        os.utime(tmp_path / name, (second, second))
    assert readers.newest(spark, str(tmp_path / "*.csv")).endswith("b.csv") and readers.newest(spark, str(tmp_path / "*.csv"), "time").endswith("a.csv")
    with pytest.raises(ValueError):
        readers.Source("t", "xlsx", "p").read(spark)


def test_schema_parity(spark):
    a, b = spark.createDataFrame([], "x int, y string"), spark.createDataFrame([], "x long, z string")
    assert checks.schema_parity(a, b) == [("x", "int", "bigint"), ("y", "string", "-"), ("z", "-", "string")]


def test_streams(spark, tmp_path):
    from tallygrain.streaming import verdicts

    events = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 5)), (1, dt.datetime(2024, 1, 1, 0, 10)), (1, dt.datetime(2024, 1, 1, 3, 0)), (2, dt.datetime(2024, 1, 1, 9, 0))], "user_id long, ts timestamp")
    src = str(tmp_path / "in")
    events.coalesce(1).write.parquet(src)

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return spark.sql(f"SELECT * FROM {name}").collect()

    stream = lambda: spark.readStream.schema(events.schema).parquet(src)
    hours = {r["hour"].hour: r["n"] for r in run(verdicts.hourly(stream()), "hourly_t")}
    assert hours.get(0) == 2 and hours.get(3) == 1
    got = sorted((r["key"], r["at"].hour, r["state"]) for r in run(verdicts.stalls(stream(), "user_id"), "stalls_t"))
    assert got[:2] == [("1", 1, "stalled"), ("1", 3, "recovered")]
    ended = run(verdicts.stalls(stream().withColumn("end", F.lit(True)), "user_id", done="end"), "ended_t")
    assert not [r for r in ended if r["state"] == "stalled" and r["at"].hour == 4]
