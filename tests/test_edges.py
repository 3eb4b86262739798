"""Readers, writers and small operators that no query calls."""

import datetime
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallygrain.functions import paths, text
from tallygrain.operators import actions, judge, monitor, normalise, preflight, profile, review, rulings, sampling
from tallygrain.sources import readers, sheets, writers


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    for kind in ("parquet", "json", "orc"):
        df.write.format(kind).save(str(tmp_path / kind))
        assert readers.Source("t", kind, str(tmp_path / kind), df.schema).read(spark).count() == 2
    df.write.csv(str(tmp_path / "csv"), header=True)
    assert readers.Source("t", "csv", str(tmp_path / "csv"), options=(("header", "true"),)).read(spark).columns == ["x", "y"]
    df.createOrReplaceTempView("of_a_source")
    assert readers.Source("t", "table", "of_a_source").read(spark).count() == 2
    with pytest.raises(ValueError):
        readers.Source("t", "tape", "x").read(spark)


def test_catalog(spark):
    spark.createDataFrame([(1, "a")], "x int, y string").createOrReplaceTempView("found_here")
    got = readers.discovered(spark).where("table = 'found_here'").orderBy("position").collect()
    assert [(r["column"], r["type"]) for r in got] == [("x", "int"), ("y", "string")]
    assert [r["rows"] for r in readers.row_counts(spark).where("table = 'found_here'").collect()] == [1]
    assert [(r["column"], r["nullable"]) for r in readers.columns(spark.range(1)).collect()] == [("id", False)]


def test_verdict_files_and_runs(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"line_id": 1, "verdict": "Correct"}')
    (tmp_path / "b.json").write_text('[{"line_id": 2, "verdict": "Incorrect"},\n {"line_id": 3, "verdict": null}]')
    row = spark.createDataFrame([], "line_id long, verdict string").schema
    assert sorted(r["line_id"] for r in readers.verdict_files(spark, str(tmp_path), row).collect()) == [1, 2, 3]
    runs = spark.createDataFrame([("t", "r1", 5), ("t", "r2", 9), ("t", "r3", 9), ("u", "r0", 1)], "tenant string, run_id string, loaded_at int")
    assert sorted(map(tuple, readers.latest_run(runs).collect())) == [("t", "r3"), ("u", "r0")]
    assert [r["run_id"] for r in readers.latest_run(runs, "u").collect()] == ["r0"]


def book(path, sheets_):
    """A small workbook: shared texts, texts in cells, numbers, gaps."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    texts = []
    with zipfile.ZipFile(path, "w") as z:
        for k, rows in enumerate(sheets_.values()):
            out = ""
            for r, cells in enumerate(rows, 1):
                out += f'<row r="{r}">'
                for c, v in enumerate(cells):
                    at = f'r="{"ABCDEFG"[c]}{r}"'
                    if isinstance(v, str) and v.startswith("="):
                        out += f'<c {at} t="inlineStr"><is><t>{v[1:]}</t></is></c>'
                    elif isinstance(v, str):
                        texts.append(v)
                        out += f'<c {at} t="s"><v>{len(texts) - 1}</v></c>'
                    elif v is not None:
                        out += f"<c {at}><v>{v}</v></c>"
                out += "</row>"
            z.writestr(f"xl/worksheets/sheet{k}.xml", f"<worksheet {main}><sheetData>{out}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f"<si><r><t>{t[:1]}</t></r><r><t>{t[1:]}</t></r></si>" for t in texts) + "</sst>")
        names = "".join(f'<sheet name="{n}" r:id="i{k}"/>' for k, n in enumerate(sheets_))
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="i{k}" Target="{"/xl/" if k else ""}worksheets/sheet{k}.xml"/>' for k in range(len(sheets_))) + "</Relationships>")


def test_workbooks(spark, tmp_path):
    book(tmp_path / "one.xlsx", {"Rulings": [["Subject ", "RULING", "n"], ["a", "Drop", 4], [], ["=b", None, 1.5], [None, "keep"]], "Other": [["ruling"], ["x"]], "Empty": []})
    book(tmp_path / "two.xlsx", {"Rulings": [["ruling", "subject", "ruling"], ["r", "s", "later"]]})
    got = sheets.read_sheets(spark, str(tmp_path / "*.xlsx"), ["subject", "ruling", "n"])
    rows = sorted((r["path"][-8:-5], r["sheet"], r["row_number"], r["subject"], r["ruling"], r["n"]) for r in got.collect())
    assert rows == [("one", "Other", 2, None, "x", None), ("one", "Rulings", 2, "a", "Drop", "4"), ("one", "Rulings", 4, "b", None, "1.5"), ("one", "Rulings", 5, None, "keep", None), ("two", "Rulings", 2, "s", "r", None)]
    one = sheets.read_sheets(spark, str(tmp_path / "one.xlsx"), ["subject", "ruling"], "Rulings")
    assert sorted(r["kind"] for r in rulings.parsed(one).collect()) == ["drop", "keep", "open"]
    assert sheets.column_number("AA10") == 26


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("r", "t", 1, None), ("r", "t", 2, "old")], "run_id string, tenant string, k int, v string")
    writers.append(df, str(tmp_path / "a"))
    writers.append(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    new = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, v string")
    assert sorted((r["k"], r["v"]) for r in writers.updated(df, new, ["k"], ["v"]).collect()) == [(1, "x"), (2, "old")]
    assert writers.with_column(df, "v", "int") is df and writers.with_column(df, "w", "int").schema["w"].dataType.simpleString() == "int"
    assert [r["v"] for r in writers.reset(df, "v").collect()] == [None, None]
    cross = spark.createDataFrame([("a", ["x", "y"]), ("b", None)], "path string, candidates array<string>")
    writers.crosswalk_csv(cross, str(tmp_path / "c"))
    assert sorted((r["path"], r["candidates"]) for r in readers.csv(spark, str(tmp_path / "c")).collect()) == [("a", "x | y"), ("b", None)]


def test_sheets_that_would_lose_answers(spark):
    old = spark.createDataFrame([(1, "yes"), (2, " "), (3, "no")], "k int, response string").withColumn("response", F.trim("response"))
    assert [r["k"] for r in review.unanswered_lost(old, spark.createDataFrame([(1,)], "k int"), "k").collect()] == [3]


def test_small_functions(spark):
    one = spark.range(1)
    val = lambda c: one.select(c.alias("x")).first()["x"]
    assert val(text.first_filled([F.lit(" "), F.lit(" b "), F.lit("c")])) == "b" and val(text.first_filled([F.lit(None).cast("string")])) is None
    level = lambda m, e, v: val(normalise.taxonomy_level(F.lit(m), e, 3, F.lit(v)))
    assert [level(True, False, "x"), level(False, True, "x"), level(True, True, " "), level(True, True, " x ")] == ["(no level 3 in this taxonomy)", "(no taxonomy match)", "(not used at this level)", "x"]
    assert val(monitor.eta_days(F.lit(1440), F.lit(2.0))) == 0.5 and val(monitor.eta_days(F.lit(5), F.lit(0.0))) is None
    assert val(paths.all_undecided([F.lit("n/a"), F.lit(None).cast("string")])) and not val(paths.all_undecided([F.lit("n/a"), F.lit("Pens")]))
    df = spark.range(9)
    assert sampling.hash_sample(df, "id", None) is df and sampling.hash_sample(df, "id", 4).count() == 4
    said = {"keep both please": True, "they can't be merged": True, "Dough": False, "not the same": True, "merge as 'Dough'": False, "two separate things": True, "same": False}
    assert {k: val(rulings.stays_apart(F.lit(k))) for k in said} == said
    assert val(rulings.merged_as(F.lit(' Merge them as "Dough" '))) == "Dough" and val(rulings.merged_as(F.lit("Dough 'x'"))) is None
    words = {"a white paper cup": True, "X12 8823 CBORD ID:": False, "co-op o'clock and/or": True, "ab cd ef gh": False, "12-a b2b c3c": False}
    assert {k: val(F.expr("1").isNotNull()) and one.select(F.lit(k).alias("t")).select(actions.wordy("t")).first()[0] for k in words} == words


def test_provenance_and_day(spark):
    df = spark.createDataFrame([("v", "1", "G", "H", "text", "2024-02-03 10:00:00")], "s string, a string, g string, h string, d string, t string")
    cfg = normalise.TenantConfig("t", {"supplier": "s", "spend": "a", "l0": "g", "l1": "h", "invoice_date": "t"}, ("d",))
    r = normalise.normalise(df, cfg, "r", "from a test").first()
    assert r["provenance"] == "from a test" and r["invoice_day"] == datetime.date(2024, 2, 3)


def test_figures_into_rules(spark):
    lines = spark.createDataFrame([("t", "a", "Incorrect"), ("t", "a", None), ("t", "b", "Correct")], "tenant string, rule_id string, verdict string")
    rules = spark.createDataFrame([("t", "a", "A", 7), ("t", "c", "C", 9)], "tenant string, rule_id string, name string, judged long")
    got = {r["rule_id"]: (r["name"], r["judged"], r["lines"], r["error_rate"]) for r in judge.with_rollup(rules, lines).collect()}
    assert got == {"a": ("A", 1, 2, 1.0), "c": ("C", 9, None, None)}


def test_seats_are_asked_again(spark, tmp_path):
    """A seat that stays silent on a batch the first time is asked about that batch alone."""
    log = tmp_path / "calls"
    log.mkdir()

    def scorer(silent):
        def run(batches):
            import uuid

            for pdf in batches:
                for b, rows in pdf.groupby("batch"):
                    first = not list(log.glob(f"{silent}-{b}-*"))
                    (log / f"{silent}-{b}-{uuid.uuid4().hex}").write_text("x")
                    if b == silent and first or silent == 9:
                        continue
                    yield pd.DataFrame({"line_id": rows["line_id"], "seat": 0, "verdict": "Correct", "confidence": "1", "basis": "rule", "suggested_key": None, "rationale": "r"})

        return run

    units = spark.createDataFrame([(b, 10 * b + k) for b in (1, 2) for k in range(3)], "batch int, line_id long").coalesce(1)
    votes = judge.asked(units, {1: scorer(1), 2: scorer(0), 3: scorer(9)}, rounds=3)
    n = {r["seat"]: r["count"] for r in votes.groupBy("seat").count().collect()}
    assert n == {1: 6, 2: 6}
    calls = lambda s, b: len(list(log.glob(f"{s}-{b}-*")))
    assert (calls(1, 1), calls(1, 2), calls(0, 1), calls(0, 2), calls(9, 1)) == (2, 1, 1, 1, 3)


def test_mixes_and_leverage(spark):
    lines = spark.createDataFrame([("t", "Correct", "rule"), ("t", "Correct", "rule"), ("t", "Incorrect", None), ("t", None, "rule")], "tenant string, verdict string, basis string")
    assert {r["basis"]: (r["lines"], r["pct"]) for r in monitor.mix(lines, "basis").collect()} == {"rule": (2, 66.6667), None: (1, 33.3333)}
    rules = spark.createDataFrame([("t", "a", 10, 5), ("t", "b", 9, 1), ("t", "c", 1, 0)], "tenant string, rule_id string, lines long, units long")
    assert [(r["rule_id"], r["place"]) for r in profile.top_rules(rules, 1).collect()] == [("b", 1)]
    months = spark.createDataFrame([("t", "2024-01", 5), ("t", "2024-02", 7), ("u", "2024-02", 1)], "tenant string, month string, lines long")
    assert tuple(profile.combined_range(months).first()) == (5, 6.5, 8, 2)
    assert tuple(profile.combined_range(months, 1).first()) == (8, 8.0, 8, 1)


def test_vendors_differ_by_more_than_case(spark):
    df = spark.createDataFrame([("Acme", 1), ("ACME ", 2), (" acme", 3), (None, 4), ("Bolt", 5)], "supplier string, cents long").withColumns({"d": F.lit("text"), "l0": F.lit("G"), "t": F.lit("t")})
    r = profile.volume(df, "supplier", "cents", "d", "l0", ["t"]).first()
    assert (r["vendors"], r["no_vendor"]) == (2, 1)


def test_denials(spark):
    rows = [("No usable description.", "a white paper cup", "Y"), ("no usable description", "X12 8823 ID", "Y"), ("no description", "a white paper cup", "N"), ("fits", "a white paper cup", "Y"), (None, "a b c", "Y")]
    df = spark.createDataFrame(rows, "rationale string, description string, description_usable string")
    assert [r["rationale"] for r in actions.false_denials(df).collect()] == ["No usable description."]


def test_uncategorised_in_any_spelling(spark):
    df = spark.createDataFrame([("Uncategorised",), (None,), (" ",), ("Goods",)], "l0 string").withColumns({"supplier": F.lit("s"), "description_usable": F.lit("Y"), "cents": F.lit(1), "line_id": F.monotonically_increasing_id(), "tenant": F.lit("t"), "k": F.lit("k")})
    got = {r["name"]: r["value"] for r in preflight.tenant(df, spark.createDataFrame([("t", "k")], "tenant string, source_key string"), "cents", "k").collect()}
    assert got["uncategorised"] == 0.75 and got["no taxonomy node"] == 0.0 and got["empty"] == 0.0
    none = {r["name"]: (r["value"], r["grade"]) for r in preflight.tenant(df.where("false"), spark.createDataFrame([], "tenant string, source_key string"), "cents", "k").collect()}
    assert none["empty"] == (1.0, "FAIL") and none["no vendor"] == (0.0, "PASS")
