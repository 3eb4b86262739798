"""Operators whose meaning is easily misread, on cases written for that."""

import pytest
from pyspark.sql import functions as F

from tallygrain.operators import checks, enrich, judge, normalise, profile, queue, review, taxonomy


def by(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_siblings_of_padded_paths(spark):
    """Leaves repeated below themselves stand beside each other; a null in the parent matches nothing."""
    rows = [("t", 1, "G", "A", "x", "x"), ("t", 2, "G", "A", "y", "y"), ("t", 3, "G", "A", "z", "z"), ("t", 4, "G", "A", "z", "deep"), ("t", 5, "G", None, "p", "q"), ("t", 6, "G", "B", "", " "), ("t", 7, " ", None, "", None), ("u", 8, "G", "A", "x", "x")]
    nodes = spark.createDataFrame(rows, "tenant string, k int, a string, b string, c string, d string")
    got = dict(by(normalise.sibling_counts(nodes, ["a", "b", "c", "d"]), "k", "siblings"))
    # 4: two rows below G > A > z; 5 has distinct levels G, p, q, so its parent holds the null; 6: A and B, null is no value; 7: no level at all
    assert got == {1: 3, 2: 3, 3: 3, 4: 2, 5: 0, 6: 2, 7: 0, 8: 1}


def test_deterministic(spark):
    rows = [(1, "t", "s", "u1", "G", "Y", None), (2, "t", "s", "u2", "", "N", None), (3, "t", "r", "u3", "", "N", None), (4, "t", "q", "u4", "G", "N", None), (5, "t", "p", "u5", "G", "Y", None), (6, "t", "s", "u1", "G", "Y", "Correct"), (7, "v", "s", "u9", "G", "Y", None)]
    lines = spark.createDataFrame(rows, "line_id int, tenant string, subject_id string, unit_id string, l0 string, description_usable string, verdict string")
    assert by(judge.deterministic(lines), "line_id", "finding", "verdict", "confidence", "basis") == [
        (1, "contradiction", "Incorrect", 1.0, "deterministic_contradiction"), (2, "contradiction", "Incorrect", 1.0, "deterministic_contradiction"), (3, "uncategorised", "Uncertain", 1.0, "deterministic_uncategorised"),
        (4, "unjudgeable", "Uncertain", 1.0, "deterministic_unjudgeable"), (5, None, None, None, None), (6, None, "Correct", None, None), (7, None, None, None, None),
    ]


def test_queue_flags(spark):
    rows = [("t", "even", 500, "Y"), ("t", "even", -500, "Y"), ("t", "off", 1000, "Y"), ("t", "off", -990, "Y"), ("t", "near", 1000, "Y"), ("t", "near", -900, "Y"), ("t", None, 5, "N"), ("t", None, 5, None), ("t", None, 5, "Y"), ("t", "quiet", 7, "N")]
    lines = spark.createDataFrame(rows, "tenant string, supplier string, cents long, description_usable string").withColumn("subject_id", F.lit("s"))
    got = {r["supplier"]: (r["flag"], r["has_no_evidence"], r["status"]) for r in queue.ranked(queue.base(lines, F.coalesce(F.col("supplier") == "quiet", F.lit(False)))).collect()}
    assert got == {"even": (None, 0, "pending"), "off": ("divergent", 0, "pending"), "near": (None, 0, "pending"), None: ("no_vendor_name", 2, "pending"), "quiet": (None, 0, "done")}


def test_work_selection(spark):
    rows = [(1, "Uncategorised", None, None, None, None), (2, "Uncategorised", "Uncertain", None, None, 3), (3, "Pens", None, None, None, None), (4, "Pens", "Correct", "Correct", None, 2), (5, "Pens", "Correct", None, "K", None), (6, None, "Incorrect", "Incorrect", "K", 3), (7, "Uncategorised", "Uncertain", "Uncertain", "K", 1)]
    lines = spark.createDataFrame(rows, "line_id int, l1 string, verdict string, answer string, suggested_key string, jury int")
    of = lambda **k: [x for (x,) in by(queue.work_selection(lines, answer="answer", **k), "line_id")]
    assert of() == [1, 3]
    assert of(uncategorised=True) == [1, 2]
    assert of(rejudge=True) == [3, 5] and of(rejudge=True, uncategorised=True) == [1, 2]
    assert of(top_up=True) == [1, 3, 4] and of(uncategorised=True, top_up=True) == [1, 2, 7]


@pytest.mark.parametrize(
    "his, levels, want",
    [
        ("ladders", ["Tools", "Ladders & Steps"], "leaf"), ("NUTS", ["Food", "Baking", "Nut"], "leaf"), ("baking", ["Food", "Baking", "Nut"], "branch"), ("food and drink", ["Food", "Baking", "Nut"], "branch"),
        ("roast nut mix", ["Food", "Baking", "Nut brown"], "leaf"), ("ropes", ["Food", "Baking", "Nut"], "differs"), ("", ["Food"], "differs"), (" - ", ["Food"], "differs"), (None, ["Food"], "none"),
        ("nut", ["Food", "Nut", "(not used at this level)"], "leaf"), ("nut", [None, "", "Not Used"], "differs"), ("brown paint", ["Paint Shop", "Baking", "Nut brown"], "branch"),
    ],
)
def test_agreement(spark, his, levels, want):
    levels = (levels + [None] * 3)[:3]
    df = spark.createDataFrame([(his, *levels)], "his string, a string, b string, c string")
    assert df.select(review.agreement("his", ["a", "b", "c"]).alias("m")).first()["m"] == want


def test_vendors_stay_in_their_tenant(spark):
    master = spark.createDataFrame([("t", "Acme", 1, 5.0, 1.0, "A"), ("u", "Acme", 2, 9.0, 1.0, "B"), ("t", "Bare", None, 1.0, None, "C")], "tenant string, client_vendor_name string, vendor_id long, spend_total double, match_confidence double, category string")
    words = spark.createDataFrame([(1, "mixed")], "vendor_id long, verdict string")
    vendors = spark.createDataFrame([("t", "Acme"), ("u", "Acme"), ("v", "Acme"), ("t", "Bare"), ("t", None)], "tenant string, supplier string")
    assert by(enrich.coherence(vendors, master, words), "tenant", "supplier", "coherence") == sorted([("t", "Acme", "mixed"), ("u", "Acme", "unevaluated"), ("v", "Acme", "not in master"), ("t", "Bare", "unevaluated"), ("t", None, "not in master")], key=repr)
    lines = spark.createDataFrame([("t", "Acme", "A"), ("u", "Acme", "A"), ("v", "Acme", "A")], "tenant string, supplier string, l1 string")
    assert by(enrich.lane(lines, master, "supplier", "category", "l1"), "tenant", "lane") == [("t", "agrees"), ("u", "differs"), ("v", "unknown vendor")]


def test_invariants(spark):
    cols = "run_id string, verdict string, action string, rationale string, suggested_key string, jury int"
    good = [("r", "Correct", "No change", "fine", None, 3)] * 200
    bad = [("r", None, None, None, None, None), ("r", "Incorrect", "Re-mapped", "per the GL code", None, 2), ("r", "Incorrect", "Miscategorised", "General Ledger says", None, 3), ("r", "Correct", None, "", None, 2)]
    loaded = spark.createDataFrame([("r", 204), ("old", 9)], "run_id string, lines_loaded long")
    got = {r["name"]: (r["value"], r["ok"]) for r in checks.invariants(spark.createDataFrame(good + bad, cols), loaded).collect()}
    assert got == {
        "lines as loaded": (204, True), "distinct runs": (1, True), "lines without a verdict": (1, False), "lines without an action": (2, False), "rationales citing the ledger": (2, False),
        "Re-mapped without a destination": (1, False), "Miscategorised without a destination": (1, False), "lines with a thin jury": (2, True),
    }
    got = {r["name"]: r["ok"] for r in checks.invariants(spark.createDataFrame([*good, ("x", "Correct", "No change", None, None, 1), ("x", "Correct", "No change", None, None, 1), ("x", "Correct", "No change", None, None, 1)], cols), loaded).collect()}
    assert not got["distinct runs"] and not got["lines as loaded"] and not got["lines with a thin jury"] and got["lines without a verdict"]


def test_tenant_tree(spark):
    raw = spark.createDataFrame([("t", " 1 ", "Goods", "Food", "Egg", "Egg", None), ("t", "2", "Goods", "Food", "Ham", " ", None), ("t", "2", "Goods", "Food", "Oil", "", None), ("t", "3", "Clinical", "X", None, None, None), ("t", None, "Goods", "Y", None, None, None), ("t", "4", "", None, None, None, None), ("t", "5", "Gifts", "Z", None, None, None)], "tenant string, category_key string, a string, b string, c string, d string, description string")
    usage = spark.createDataFrame([("t", "1", 4), ("t", "1 ", 2), ("u", "2", 9)], "tenant string, category_key string, lines long")
    tree = normalise.tenant_tree(raw, ["a", "b", "c", "d"], usage, ("Gifts",))
    assert by(tree, "category_key", "path_full", "leaf", "parent", "depth_distinct", "sibling_count", "in_scope", "lines_in_scope", "repeats") == [
        ("1", "Goods > Food > Egg > Egg", "Egg", "Goods > Food", 3, 3, True, 6, 0), ("2", "Goods > Food > Ham > (not used at this level)", "Ham", "Goods > Food", 3, 3, True, 0, 1),
        ("3", "Clinical > X > (not used at this level) > (not used at this level)", "X", "Clinical", 2, 1, False, 0, 0), ("4", "Uncategorised > Uncategorised > Uncategorised > Uncategorised", None, None, 0, 1, True, 0, 0),
        ("5", "Gifts > Z > (not used at this level) > (not used at this level)", "Z", "Gifts", 2, 1, False, 0, 0),
    ]
    assert by(normalise.branches(tree, used_only=True), "branch", "leaves", "lines") == [("Food", 1, 6)]
    assert by(normalise.leaves_of(tree, F.lit("Food")), "category_key") == [("1",), ("2",)] and by(normalise.leaves_of(tree, F.lit("X"), in_scope_only=False), "category_key") == [("3",)]


def test_labels_of_lines(spark):
    one = spark.createDataFrame([("Goods ", "x", "Goods", "x"), ("Goods", None, "Goods", " "), ("Goods", "x", "Goods", "y"), ("a", "a", None, None)], "a string, b string, c string, d string")
    assert [r["m"] for r in one.select(normalise.path_agrees([F.col("a"), F.col("b")], [F.col("c"), F.col("d")], F.col("c").isNotNull()).alias("m")).collect()] == ["Y", "Y", "N", "(no join)"]
    assert [r["m"] for r in spark.createDataFrame([("Non-Procurement", "x"), (None, " Non-Procurement"), ("x", None)], "a string, b string").select(normalise.non_procurement(F.col("a"), F.col("b")).alias("m")).collect()] == [True, True, False]
    shown = queue.by_verdict(spark.createDataFrame([("Correct", 1), ("Odd", 2), ("Incorrect", 3), (None, 4), ("Uncertain", 5)], "verdict string, n int"), "n")
    assert [r["n"] for r in shown.collect()] == [3, 5, 1, 2, 4]


def test_rewrites_follow_the_rewritten_parent(spark):
    nodes = spark.createDataFrame([("G > Old > Pen > Pen",), ("G > New > Pen",), ("G > Pen",)], "path string")
    plain = spark.createDataFrame([(2, "PEN", "Pens")], "level int, label string, winner string")
    ruled = spark.createDataFrame([("G", 1, "OLD", "New"), ("G > NEW", 2, "PEN", "Quills")], "parent string, level int, label string, winner string")
    assert by(taxonomy.apply_rewrites(nodes, "path", plain), "path") == [("G > New > Pens",), ("G > Old > Pens > Pen",), ("G > Pen",)]
    assert by(taxonomy.apply_rewrites(nodes, "path", plain, ruled), "path") == [("G > New > Quills > Pen",), ("G > New > Quills",), ("G > Pen",)]


def test_checksum_sees_repeats(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "x int")
    assert profile.checksum(a, ["x"]).first() != profile.checksum(b, ["x"]).first() and profile.checksum(a, ["x"]).first() == profile.checksum(a.orderBy(F.desc("x")), ["x"]).first()
