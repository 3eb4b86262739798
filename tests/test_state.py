"""Operators that number, join by edits, merge into slices, refresh, read in parts and publish."""

import itertools
import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tallygrain.functions import answers, paths
from tallygrain.operators import actions, cliques, decisions, edits, judge, monitor, normalise, ordered, preflight, profile, queue, review, sampling, taxonomy
from tallygrain.sources import databases, writers
from tallygrain.sources.readers import Source
from tallygrain.streaming import verdicts


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


@pytest.mark.parametrize("crowd", [2, 2000])
def test_pairs_within(spark, crowd):
    rnd = random.Random(crowd)
    keys = {"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 7))) for _ in range(90)}
    df = spark.createDataFrame([(g, k) for g in ("x", "y") for k in keys if g == "x" or len(k) > 3] + [("x", None), ("x", "aa"), ("x", "aa")], "g string, k string")
    got = sorted(map(tuple, edits.pairs_within(df, "k", 2, ("g",), crowd).collect()))
    here = {"x": keys | {"aa"}, "y": {k for k in keys if len(k) > 3}}
    want = sorted((g, a, b, d) for g, ks in here.items() for a, b in itertools.combinations(sorted(ks), 2) if (d := distance(a, b)) <= 2)
    assert got == want


def test_many_labels_stay_few_pairs(spark):
    """20,000 labels without a stage over all pairs: the join makes few more rows than there are shared remains."""
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).substr(1, 12).alias("k"))
    near = edits.pairs_within(df.unionByName(df.limit(50).select(F.concat("k", F.lit("x")).alias("k"))), "k", 1)
    assert near.count() == 50
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("ranges", [1, 5])
def test_numbers_over_ranges(spark, ranges):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 500), k) for k in range(700)]
    df = spark.createDataFrame(rows, "g string, x int, id int")
    got = ordered.numbered(df, ["g"], ["x", "id"], "n", ranges).collect()
    for g in ("a", "b", None):
        mine = sorted((r["x"], r["id"], r["n"]) for r in got if r["g"] == g)
        assert [n for *_, n in mine] == list(range(1, len(mine) + 1))
    before = {r["id"]: (r["prev_id"], r["has_prev"]) for r in ordered.with_previous(df, ["g"], ["x", "id"], ["id"], ranges).collect()}
    for g in ("a", "b", None):
        mine = [i for _, i in sorted((x, i) for h, x, i in rows if h == g)]
        assert [before[i] for i in mine] == [(None, False), *((i, True) for i in mine[:-1])]
    whole = ordered.numbered(df, [], ["id"], "n", ranges)
    assert all(r["n"] == r["id"] + 1 for r in whole.collect())
    assert ordered.numbered(df.where("false"), ["g"], ["x"], "n", ranges).count() == 0


def test_ranges_and_batches_have_no_window_over_a_group(spark):
    df = spark.createDataFrame([("t", k) for k in (1, 2, 3, 7, 8, 20)], "t string, n long")
    assert sorted(map(tuple, sampling.ranges(df, "t", "n").collect())) == [("t", 1, 3), ("t", 7, 8), ("t", 20, 20)]
    got = writers.batches(df, 4, "t", F.col("n")).orderBy("batch").collect()
    assert [(r["batch"], r["units"]) for r in got] == [(0, 4), (1, 2)] and got[1]["payload"] == '{"units":[{"n":8},{"n":20}]}'
    for out in (sampling.ranges(df, "t", "n"), writers.batches(df, 4, "t", F.col("n")), taxonomy.outline(df.withColumnRenamed("t", "tenant"), ["n"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert all("_p" in line for line in plan.splitlines() if "Window [" in line)


def largest_by_hand(names, agree):
    for size in range(len(names), 0, -1):
        for group in itertools.combinations(sorted(names), size):
            if all(frozenset(p) in agree for p in itertools.combinations(group, 2)):
                return list(group)
    return []


def test_largest_group():
    rnd = random.Random(5)
    for n in range(13):
        names = [f"t{k:02d}" for k in range(n)]
        for share in (0.2, 0.6, 0.9):
            agree = {frozenset(p) for p in itertools.combinations(names, 2) if rnd.random() < share}
            assert cliques.largest(names, agree) == largest_by_hand(names, agree)
    many = [f"t{k:02d}" for k in range(60)]
    agree = {frozenset(p) for p in itertools.combinations(many, 2) if rnd.random() < 0.6} | {frozenset(p) for p in itertools.combinations(many[7:21], 2)}
    assert len(cliques.largest(many, agree)) >= 14
    assert taxonomy.agreeing_group([("a", "b", 0.8), ("b", "c", 0.7)], ["c", "a", "b"]) == ["a", "b"]


SLICED = "run_id string, tenant string, line_id long, verdict string, jury long"


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_slices_of_batches(spark, tmp_path):
    """A batch that is replayed, or was killed when one of its slices was written, leaves one result."""
    path = tmp_path / "t"
    schema = spark.createDataFrame([], SLICED).schema
    step = verdicts.merged_into(str(path), judge.keep_larger_jury)
    step(spark.createDataFrame([("1", "a", 1, "Correct", 2), ("1", "b", 5, "Correct", 1)], schema), 0)
    first = files(path)
    more = spark.createDataFrame([("1", "a", 1, "Incorrect", 1), ("1", "a", 2, "Correct", 3)], schema)

    calls = []

    def sums(old, new):  # not idempotent by itself
        calls.append(1)
        return old.unionByName(new).groupBy("run_id", "tenant", "line_id").agg(F.min("verdict").alias("verdict"), F.sum("jury").alias("jury"))

    adding = verdicts.merged_into(str(path), sums)
    adding(more, 1)
    adding(more, 1)
    assert len(calls) == 2 and first.items() <= files(path).items()
    want = [("1", "a", 1, "Correct", 3), ("1", "a", 2, "Correct", 3), ("1", "b", 5, "Correct", 1)]
    now = lambda: sorted(map(tuple, verdicts.newest(spark, str(path), schema, ("run_id", "tenant")).collect()), key=repr)
    assert now() == want
    # killed: one slice of batch 2 is there, the others aren't
    both = spark.createDataFrame([("1", "a", 9, "Correct", 1), ("1", "b", 5, "Correct", 1), (None, "c d", 3, "Correct", 1)], schema)
    adding(both.where("tenant = 'a'"), 2)
    adding(both, 2)
    assert now() == sorted([*want[:2], ("1", "a", 9, "Correct", 1), ("1", "b", 5, "Correct", 2), (None, "c d", 3, "Correct", 1)], key=repr)
    step(both.where("false"), 3)
    assert not list(path.rglob("batch_no=3"))
    kept = now()
    assert verdicts.drop_superseded(spark, str(path), schema) == 3 and now() == kept
    assert verdicts.drop_superseded(spark, str(path), schema) == 0 and len(list(path.rglob("batch_no=*"))) == 3


def test_refresh_when_moved(spark, tmp_path):
    src, out = tmp_path / "src", []
    schema = "tenant string, verdict string"

    def put(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))

    put([("a", "Correct")] * 3 + [("b", None)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    moved = verdicts.refreshes(stream, "tenant", F.col("verdict").isNotNull(), 5)

    def run():
        q = moved.writeStream.outputMode("update").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, n: out.extend(map(tuple, df.collect()))).trigger(availableNow=True).start()
        q.awaitTermination()

    run()
    assert sorted(out) == [("a", 3, 3), ("b", 0, 0)]
    out.clear()
    put([("a", "Correct")] * 4 + [("b", "Correct")])
    run()
    assert out == []
    put([("a", "Incorrect")])
    run()
    assert out == [("a", 8, 5)]


def test_hours_as_a_stream(spark, tmp_path):
    """Hours that the watermark has passed come out once, with late rows inside it, and agree with the batch form."""
    src, schema, out = tmp_path / "src", "ts timestamp, k int", []
    at = lambda h, m=0: f"TIMESTAMP '2024-01-01 {h:02d}:{m:02d}:00'"

    def put(*times):
        spark.sql("SELECT * FROM VALUES " + ", ".join(f"({t}, 1)" for t in times) + " AS v(ts, k)").coalesce(1).write.mode("append").parquet(str(src))

    def run(form):
        q = form(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))).writeStream.outputMode("append").option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, n: out.extend(map(tuple, df.collect()))).trigger(availableNow=True).start()
        q.awaitTermination()

    hours = lambda df: verdicts.hourly(df, late="2 hours")
    put(at(1), at(1, 30), at(2))
    run(hours)
    put(at(1, 59), at(6))  # late, but inside the watermark
    run(hours)
    put(at(9))
    run(hours)
    got = sorted((t.hour, n) for t, n in out)
    assert got == [(1, 3), (2, 1), (6, 1)]
    batch = monitor.hourly(spark.read.schema(schema).parquet(str(src)), "ts", F.lit("2024-01-01 09:30:00").cast("timestamp"), 9)
    assert [(r["hour"].hour, r["n"]) for r in batch.where("n > 0").orderBy("hour").collect()] == [*got, (9, 1)]


def test_folders_go_with_the_driver(spark):
    from tallygrain.sources import shared

    df = shared.shared(spark.range(3))
    mine, before = shared.MADE[-1], list(shared.MADE[:-1])
    assert df.count() == 3
    shared.MADE[:] = [mine]
    shared.swept()
    assert shared.MADE == []
    with pytest.raises(Exception):
        spark.read.parquet(mine)
    shared.MADE[:] = before


def test_answers(spark):
    texts = [
        (1, '{"verdicts": [{"line_id": 1, "verdict": "Correct", "confidence": "when there is none"}, {"line_id": 1, "verdict": "Incorrect"}]}'),
        (2, '```json\n[{"line_id": "7", "verdict": "Correct"}]\n```'), (3, 'Sure! {"line_id": 4, "verdict": "a } b \\" { c"} and {more} text'),
        (4, "no json at all"), (5, '{"verdicts": [{"line_id": 1'), (6, None), (7, "[]"), (8, '[{"verdict": "x"}, 3, {"line_id": 2, "verdict": null}]'),
        (9, 'first [1] then {"verdicts": []}'), (10, "12"),
    ]
    df = spark.createDataFrame(texts, "batch int, said string")
    got = sorted((r["batch"], r["line_id"], r["verdict"], r["confidence"]) for r in answers.answers(df, "said", ["batch"]).collect())
    assert got == [(1, 1, "Incorrect", None), (2, 7, "Correct", None), (3, 4, 'a } b " { c', None), (8, 2, None, None)]


def test_reads_in_parts(spark):
    url = f"jdbc:derby:memory:d{uuid.uuid4().hex};create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = [(None if k % 50 == 0 else (k if k % 3 else 1_000_000 + k), k) for k in range(600)]
    spark.createDataFrame(rows, "K long, V long").coalesce(1).write.format("jdbc").options(url=url, dbtable="T", **options).save()
    parts = databases.predicates(spark, url, "T", "K", 4, options)
    df = databases.read(spark, url, "T", "K", 4, {**options})
    assert len(parts) >= 3
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(rows, key=repr)
    held = [r[0] for r in df.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(held) == 4 and max(held) <= 0.3 * len(rows)
    assert Source("t", "jdbc", url, options=(("dbtable", "T"), ("key", "K"), ("parts", "3"), *options.items())).read(spark).count() == 600
    assert databases.read(spark, url, "T", None, 1, options).count() == 600
    assert databases.predicates(spark, url, "(SELECT * FROM T WHERE K < 0) X", "K", 4, options) == ["1 = 1"]


def test_parts_of_equal_weight():
    counts = [(k, 10) for k in range(100)] + [(500, 1000)]
    bounds = databases.parts_of(counts, 4)
    assert bounds[0][0] is None and bounds[-1][1] is None and all(a[1] == b[0] for a, b in itertools.pairwise(bounds))
    inside = [sum(n for k, n in counts if (a is None or k >= a) and (b is None or k < b)) for a, b in bounds]
    assert sum(inside) == 2000 and all(inside[:2]) and max(inside) <= 1500


def test_supersede_and_purge(spark, tmp_path):
    p = str(tmp_path / "t")
    df = spark.createDataFrame([("r1", "a", 1), ("r1", "b", 2), ("r2", "a", 3)], "run_id string, tenant string, x int")
    writers.replace_slices(df.where("run_id = 'r1'"), p)
    with pytest.raises(RuntimeError):
        writers.supersede(df.where("run_id = 'r2'"), p, "r1", 99)
    assert spark.read.parquet(p).where("run_id = 'r1'").count() == 2
    left = writers.supersede(df.where("run_id = 'r2'"), p, "r1", 1)
    assert [(r["run_id"], r["x"]) for r in left.collect()] == [("r2", 3)] and not (tmp_path / "t" / "run_id=r1").exists()
    assert writers.purge(spark, p, {"run_id": "r1"}) == 0
    with pytest.raises(ValueError):
        writers.supersede(df.where("run_id = 'r2'"), p, "r2", 1)
    precious = df.withColumn("verdict", F.lit("Correct")).withColumn("response", F.lit(None).cast("string"))
    q = str(tmp_path / "q")
    writers.replace_slices(precious.where("run_id = 'r1'"), q)
    with pytest.raises(PermissionError):
        writers.supersede(precious.where("run_id = 'r2'"), q, "r1", 1)
    assert spark.read.parquet(q).where("run_id = 'r1'").count() == 2


@pytest.fixture
def findings(spark):
    rows = [(1, "t", "Goods", "Goods > A", "Correct"), (2, "t", "Goods", "Goods > B", "Incorrect"), (3, "t", "Uncategorised", "Uncategorised", "Uncertain"), (4, "t", "Goods", "Goods > A", "Incorrect")]
    return spark.createDataFrame(rows, "line_id long, tenant string, l0 string, path string, verdict string")


def test_review_intake(spark, findings):
    tree = spark.createDataFrame([("t", "Goods > A", True), ("t", "Clinical > C", False), ("u", "Goods > U", True)], "tenant string, path string, in_scope boolean")
    a, c, e = review.AGREES, review.CURRENT_FITS, review.ELSEWHERE
    cases = [
        (1, a, None, None, "agreed", None), (2, c, "", "fine", "disagreed_current_ok", None), (4, e, "Goods > A ", None, "disagreed_new_category", None), (3, e, "Clinical > C", None, "disagreed_new_category", None),
        (9, a, None, None, None, "unknown line"), (1, None, "Goods > A", None, None, "no response"), (1, " ", None, None, None, "blank"), (1, "yes", None, None, None, "unknown response"),
        (1, a, "Goods > A", None, None, "agrees and names a category"), (2, e, None, None, None, "names no category"), (1, c, None, None, None, "that is agreement"), (3, c, None, None, None, "there is no category"),
        (2, e, "Goods > U", None, None, "unknown category"), (2, e, "Clinical > C", None, None, "out of scope"),
    ]
    for k, (line, said, category, note, status, why) in enumerate(cases):
        typed = spark.createDataFrame([(line, said, category, note)], "line_id long, response string, category string, note string")
        r = review.intake(typed, findings, tree).first()
        assert (r["status"], r["reject_reason"]) == (status, why), k
    both = spark.createDataFrame([(2, c, None, None), (2, e, "Goods > A", None)], "line_id long, response string, category string, note string")
    assert {r["reject_reason"] for r in review.intake(both, findings, tree).collect()} == {"answered twice"}


def test_publish_or_refuse(spark, findings, tmp_path):
    tree = spark.createDataFrame([("t", "Goods > A", True)], "tenant string, path string, in_scope boolean")
    typed = spark.createDataFrame([(2, review.CURRENT_FITS, None, "n"), (4, review.ELSEWHERE, "Goods > A", None)], "line_id long, response string, category string, note string")
    new = review.reviewed(findings, review.intake(typed, findings, tree), "me")
    out = review.publish(findings, new, str(tmp_path / "v1"))
    got = {r["line_id"]: (r["review_status"], r["reviewed_by"], r["review_override_verdict"], r["review_override_category"]) for r in out.collect()}
    assert got == {1: (None,) * 4, 3: (None,) * 4, 2: ("disagreed_current_ok", "me", "Correct", "Goods > B"), 4: ("disagreed_new_category", "me", "Incorrect", "Goods > A")}
    again = review.reviewed(out, review.intake(typed.limit(1), findings, tree), "you")
    kept = {r["line_id"]: r["reviewed_by"] for r in review.publish(out, again, str(tmp_path / "v2")).collect()}
    assert kept == {1: None, 2: "you", 3: None, 4: "me"}
    with pytest.raises(RuntimeError, match="never changes"):
        review.publish(findings, new.withColumn("verdict", F.when(F.col("line_id") == 1, "Incorrect").otherwise(F.col("verdict"))), str(tmp_path / "v3"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["v1", "v2"]


def test_blind_sheet(spark, findings):
    lines = findings.withColumn("unit_id", F.col("path"))
    sheet, key = review.blind_sheet(lines, ["path"], ["path", "l0"])
    assert set(sheet.columns) == {"group_key", "lines", "path", "l0", "your_answer", "where_it_should_go", "your_note"} and "verdict" in key.columns
    assert sheet.count() == key.count() == 3
    with pytest.raises(ValueError):
        review.blind_sheet(lines, ["path"], ["verdict"])


def test_open_questions(spark):
    rows = [
        ("a", "G > X > Y", 5, "unmapped", None, None), ("b", "g > x > y", 7, "unmapped", None, None), ("a", "G > P", 1, "leaf_crosses_branch", None, ["H > P", "I > P"]), ("a", "G > Q", 2, "leaf_moved_ambiguous", None, ["G > A > Q", "G > B > Q"]),
        ("b", "G > QQ", 3, "leaf_variant_ambiguous", None, ["G > A > Q", "G > B > Q"]), ("a", "G > Z", 4, "leaf_moved", "G > W > Z", None), ("a", "G > S", 4, "leaf_moved", "G > S", None), ("a", "G > E", 9, "exact", "G > E", None), ("c", "Not Yet", 6, "uncategorised_by_rule", None, None),
    ]
    mapped = spark.createDataFrame(rows, "tenant string, path string, lines long, basis string, target string, candidates array<string>")
    pairs = spark.createDataFrame([(2, "Pasta", "Paste", 3, 4, "flag"), (2, "Rope", "Ropes", 1, 1, "auto")], "level int, a string, b string, lines_a long, lines_b long, ruling string")
    asked = decisions.of_nodes(mapped).unionByName(decisions.of_pairs(pairs))
    q = decisions.gathered(asked)
    got = {r["kind"]: (r["tenants"], r["lines"], r["applies"], r["option_a"], r["option_b"]) for r in q.collect()}
    assert got["home"] == (["a", "b"], 12, [], "", "") and got["cross"] == (["a"], 1, ["other homes: I > P"], "G > P", "H > P")
    assert got["amb"] == (["a", "b"], 5, ["G > Q", "G > QQ"], "G > A > Q", "G > B > Q") and got["gran"] == (["a"], 4, [], "G > Z", "G > W > Z")
    assert got["spell"] == ([], 7, [], "Pasta", "Paste") and set(got) == {"home", "cross", "amb", "gran", "spell", "nyc"}
    one = q.where("kind = 'home'").select("decision_id", F.lit("Goods > Y").alias("ruling"))
    old = one.unionByName(spark.createDataFrame([("gone", "x"), ("blank", " ")], one.schema))
    after = decisions.gathered(asked, old)
    assert [r["kind"] for r in decisions.still_open(after).collect()] == ["spell", "amb", "gran", "cross"]
    assert [r["decision_id"] for r in decisions.lost_answers(after, old).collect()] == ["gone"]


def test_added_paths_and_shared_keys(spark):
    tree = spark.createDataFrame([("G > A", ["t"], 1, 5, 0)], "resolved string, tenants array<string>, nodes long, lines long, absorbed long")
    added = spark.createDataFrame([("G > b",), ("g > a",), ("G > B",), (" ",)], "path string")
    none = spark.createDataFrame([], "resolved string, category_key string")
    got = sorted((r["resolved"], r["category_key"], r["lines"], r["tenants"]) for r in taxonomy.numbered(taxonomy.with_added(tree, added), none).collect())
    assert got == [("G > A", "XX-0001", 5, ["t"]), ("G > B", "XX-0002", 0, [])]
    old = spark.createDataFrame([("G > A", "XX-0003"), ("G > B", "XX-0003")], none.schema)
    twice = taxonomy.numbered(taxonomy.with_added(tree, added), old)
    assert [tuple(r) for r in taxonomy.shared_keys(twice).collect()] == [("XX-0003", ["G > A", "G > B"])]
    with pytest.raises(ValueError, match="XX-0003"):
        taxonomy.refuse_shared_keys(twice)


CONFIG = {"source": {"columns": {"supplier": "Vendor", "spend": "Amount", "l0": "Cat 0", "l1": " Cat 1 ", "rule_id": "", "invoice_id": "Inv"}, "description_fields": ["Text", None], "table": "s.lines"}, "clinical_gate": {"enabled": True, "exclude_values": ["Clinical"]}}


def test_configuration(spark, tmp_path):
    c = normalise.TenantConfig.of("t", CONFIG)
    assert c.columns["l1"] == "Cat 1" and "rule_id" not in c.columns and c.descriptions == ("Text",) and c.missing_for_run() == [] and c.identity() == ("Inv",)
    assert normalise.TenantConfig.of("t", {**CONFIG, "clinical_gate": {"enabled": True, "exclude_keywords": ["drug"]}}).missing_for_run() == ["excluded_l0", "keywords, by which nothing may be excluded"]
    assert normalise.TenantConfig.of("t", {**CONFIG, "source": {**CONFIG["source"], "line_identity": ["invoice_id", "Line"]}}).identity() == ("Inv", "Line")
    (tmp_path / "c.json").write_text("\ufeff" + json.dumps(CONFIG), encoding="utf-8")
    assert normalise.TenantConfig.load("t", str(tmp_path / "c.json")) == c
    (tmp_path / "d.json").write_text("")
    assert "supplier" in normalise.TenantConfig.load("t", str(tmp_path / "d.json")).missing_for_run()
    df = spark.createDataFrame([("x", "1", "a", "b", "t", "i")], "Vendor string, Amount string, `Cat 0` string, `Cat 1` string, Text string, Inv string")
    assert preflight.mapping(df, c).where("NOT ok").count() == 0
    assert [(r["kind"], r["column"]) for r in preflight.mapping(df.drop("Text"), c).where("NOT ok").collect()] == [("description", "Text")]
    spark.range(1).createOrReplaceTempView("bindable")
    got = preflight.readable(spark, normalise.TenantConfig("t", {}, (), tables={"table": "bindable", "taxonomy_table": "nowhere"}))
    assert {r["name"]: (r["columns"], r["error"]) for r in got.collect()} == {"table": (1, ""), "taxonomy_table": (0, "TABLE_OR_VIEW_NOT_FOUND")}


def test_from_raw_table_to_actions(spark):
    """One vocabulary: each step reads what the one before it writes."""
    raw = [("V1", "10.5", "Goods", "Pens", "a pen", "1"), (" v1 ", "2", "", "", "a pen", "2"), ("V2", "-3", "Goods", "Ink", "n/a", "3"), ("V3", "7", None, None, "cup", "x4"), ("V2", "4", "Clinical", "Gauze", "gauze", "5")]
    df = spark.createDataFrame(raw, "Vendor string, Amount string, `Cat 0` string, `Cat 1` string, Text string, Inv string")
    lines = normalise.normalise(df, normalise.TenantConfig.of("t", CONFIG), "r1", "raw")
    assert sorted(r["cents"] for r in lines.collect()) == [-300, 200, 700, 1050] and {1, 2, 3} < {r["line_id"] for r in lines.collect()}
    q = queue.ranked(queue.base(lines, F.col("verdict").isNotNull()))
    assert q.count() == 4 and q.agg(F.sum("lines_unjudged")).first()[0] == 4
    found = judge.deterministic(lines)
    assert sorted((r["cents"], r["finding"]) for r in found.collect()) == [(-300, "unjudgeable"), (200, "uncategorised"), (700, "uncategorised"), (1050, None)]
    assert profile.rule_impact(lines).first()["lines"] == 4 and monitor.panel(lines).first()["lines"] == 4
    assert profile.volume(lines, "supplier", "cents", "description", "l0", ["tenant"]).first()["vendors"] == 3
    got = {r["name"]: r["value"] for r in preflight.tenant(lines, spark.createDataFrame([], "tenant string, source_key string"), "cents", "tax_key").collect()}
    assert got["uncategorised"] == 0.5 and got["no description"] == 0.25 and got["no taxonomy node"] == 1.0
    cross = spark.createDataFrame([], "tenant string, source_key string, target_key string, moved boolean")
    keys = spark.createDataFrame([("NC-0001", "Goods")], "category_key string, l0 string")
    acted = actions.classify(found, cross, keys)
    assert acted.count() == 4 and acted.where("action IS NULL").count() == 0
    assert queue.work_selection(lines).count() == 4


def test_runs_by_table(spark):
    lines = spark.createDataFrame([("t", "r1"), ("t", "r2"), ("u", "r1")], "tenant string, run_id string")
    assert sorted(map(tuple, preflight.run_ids({"lines": lines}).collect())) == [("lines", "t", 2, False), ("lines", "u", 1, True)]


def test_brackets_are_labels(spark):
    df = spark.createDataFrame([("G > (Small) Cups > (NOT USED at this level)",)], "p string")
    assert df.select(paths.joined(paths.canonical(paths.split_path(F.col("p"))))).first()[0] == "G > (Small) Cups"
    assert df.select(paths.readable([F.lit("(Small) Cups"), F.lit("(no level 3 in this taxonomy)"), F.lit("(no taxonomy match)")])).first()[0] == "(Small) Cups"
