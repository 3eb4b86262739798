"""What grows with the tables: lines are made once, shuffled while they are narrow, and texts are read once."""

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

from tallygrain.plans import facts, more, reference


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """As at scale: no table is small enough to be broadcast."""
    had = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", had)


@pytest.mark.parametrize("name", ["vendor_queue", "queue_coverage", "queue_rank_check", "queue_top3", "normalised_queue", "sliced_vendors"])
def test_vendors_are_made_once(spark, name):
    df = (reference.query.queries | more.query.queries)[name](spark, SMALL)
    assert "l_orderkey" not in plan(df)


def test_orders_are_met_by_narrow_lines(shuffled):
    (lines,) = facts.frames(shuffled, SMALL, "lines")
    keys = [x.split("hashpartitioning(")[1].split("#")[0] for x in plan(lines).splitlines() if "Exchange hashpartitioning" in x and "_orderkey" in x]
    names = [x for x in plan(lines).splitlines() if "FileScan" in x]
    assert keys and "nation" in names[-1] and "lineitem" in names[0] and "orders" in names[1]


def test_named_lines_are_not_dealt_out_for_suppliers(shuffled, monkeypatch):
    """Lines bear the names of parts when they meet suppliers: those are broadcast, up to a number of them."""
    dealt = lambda: [x for x in plan(facts.frames(shuffled, SMALL, "lines")[0]).splitlines() if "Exchange hashpartitioning(l_suppkey" in x]
    assert not dealt()
    monkeypatch.setattr(facts, "BROADCAST_SUPPLIERS", 1)
    assert dealt()


def test_narrow_lines_are_the_lines(spark):
    (narrow,) = facts.frames(spark, SMALL, "lines")
    assert (whole := spark.sql(facts.LINES)).columns == narrow.columns
    assert whole.exceptAll(narrow).count() == 0 and narrow.exceptAll(whole).count() == 0


def made(df):
    """The plan that runs, whole."""
    return df._jdf.queryExecution().optimizedPlan().toString()


def first_balanced(t):
    """As answers.balanced says, a character at a time."""
    at = min((t.index(c) for c in "[{" if c in t), default=None)
    depth, quoted, escaped = 0, False, False
    for k in range(at if at is not None else len(t), len(t)):
        c = t[k]
        if quoted:
            quoted, escaped = c != '"' or escaped, c == "\\" and not escaped
        elif c == '"':
            quoted = True
        elif c in "[]{}":
            depth += 1 if c in "[{" else -1
            if depth == 0:
                return t[at : k + 1]
    return None


def test_texts_are_parsed_once(spark):
    from tallygrain.functions import answers

    bits = ["{", "}", "[", "]", '"', "\\", '\\"', "a\n", "é𝄞", ","]
    texts = ["".join(bits[(i * 7919 // 11**k + k * i) % len(bits)] for k in range(i % 15)) for i in range(2000)]
    texts += ['say {"a": "' + '\\"' * 100_000 + '}"} and ]', "[" * 1000 + "]" * 1001, "{" + "x" * 100_000, "", "no json", '{"a": "}', '["\\\\"] [']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", answers.balanced(F.col("t")).alias("b")).collect()
    assert [r["b"] for r in got] == [first_balanced(t) for t in texts]
    odd = spark.createDataFrame([(1, None), (2, "x"), (3, '[null, {"line_id": 3}, 4]'), (4, "[]")], "k int, said string")
    df = answers.answers(odd, "said", ["k"])
    assert [(r["k"], r["line_id"]) for r in df.collect()] == [(3, 3)] and made(df).count("(?:json)") == 1  # where fences are sought


def test_labels_are_compared_once(spark):
    from tallygrain.operators import review

    df = spark.createDataFrame([("a", "b", "c")], "his string, x string, y string").select(review.agreement("his", ["x", "y"]).alias("m"))
    assert df.first()["m"] == "differs" and made(df).count("regexp_replace") == 6


def lineitems(df):
    return made(df).count("Relation [l_orderkey")


def test_lines_are_read_once_for_all_modes(spark):
    assert lineitems(reference.query.queries["work_selection"](spark, SMALL)) == 1


def test_preflight_counts_keys_apart(spark):
    """A supplier's lines are counted apart from rules and nodes: a group is a key, not a combination of keys."""
    df = more.query.queries["tenant_preflight"](spark, SMALL)
    assert not [x for x in made(df).splitlines() if "Aggregate [" in x and all(c in x.split("], [")[0] for c in ("tax_key", "rule_id", "supplier"))]
    assert lineitems(df) == 2


@pytest.mark.parametrize("name", ["branch_choice", "leaves_of_branch", "tenant_taxonomy"])
def test_nodes_are_made_once(spark, name):
    assert lineitems(more.query.queries[name](spark, SMALL)) == 0  # it reads the nodes that were written


def test_judged_lines_are_not_dealt_out(spark):
    """Only lines without a verdict meet the contradictory subjects."""
    from tallygrain.operators import judge

    df = spark.createDataFrame([(1, "T", "s", "u", "x", "Y"), (2, "T", "s", "v", "x", "Y")], "line_id long, tenant string, subject_id string, unit_id string, l0 string, description_usable string")
    open_, closed = (judge.deterministic(df.withColumn("verdict", F.lit(v).cast("string"))) for v in (None, "Correct"))
    assert "Join" in made(open_) and "Join" not in made(closed)
    assert [(r["finding"], r["verdict"]) for r in closed.collect()] == [(None, "Correct")] * 2
    assert [(r["finding"], r["verdict"]) for r in open_.collect()] == [("contradiction", "Incorrect")] * 2
