"""Limits and switches: any share of toxic texts, clashing columns, both sides of every size switch."""

import pytest
from pyspark.sql import functions as F

from tallygrain.llm import common, decontam, simhash_vp, token_files, toxicity
from tallygrain.llm.queries import vocabulary


def docs_with(spark, share, n=1000):
    """Toxic texts have one of a few words; the rest of all texts is the same mixture."""
    rows, labels = [], []
    for k in range(n):
        bad = (k * 37) % 100 < share * 100
        words = [f"w{(k * 7 + j * j) % 60}" for j in range(30)] + ([["vile", "nasty", "foul"][k % 3]] * 2 if bad else [])
        rows.append((k, " ".join(words)))
        labels.append((k, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.mark.parametrize("share", [0.05, 0.4, 0.8, 0.9])
def test_any_share_of_toxic_texts(spark, share):
    docs, labels = docs_with(spark, share)
    got = toxicity.toxicity(docs, labels).join(labels, "doc_id").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    assert sum(toxic) >= 0.9 * len(toxic)
    clean = [r["predicted"] for r in got if not r["toxic"]]
    assert sum(clean) <= 0.05 * len(clean)
    assert toxicity.without_toxic(docs, labels).count() == len(got) - sum(r["predicted"] for r in got)


def test_given_prior_and_no_screen(spark):
    docs, labels = docs_with(spark, 0.3)
    assert toxicity.train(docs, labels, prior=0.3).bias != toxicity.train(docs, labels, prior=0.5).bias
    assert len(toxicity.train(docs, labels, screen=False).buckets) > len(toxicity.train(docs, labels).buckets)
    assert toxicity.without_toxic(docs, labels, prior=0.3, screen=False).columns == docs.columns


def test_score_by_hand(spark, small):
    """The query's scores are the sums of the model's weights over a text's distinct features."""
    model = toxicity.train(small["documents"], small["labels"])
    weight = dict(zip(model.buckets.tolist(), model.weights.tolist()))
    got = {r["doc_id"]: r["score"] for r in toxicity.toxicity(small["documents"], small["labels"]).collect()}
    for r in small["documents"].limit(60).collect():
        features = {f for w in (r["text"] or "").lower().split() for f in toxicity.word_features(w)}
        x = model.bias + sum(weight.get(f, 0.0) for f in features)
        assert got[r["doc_id"]] == pytest.approx(float(toxicity.sigmoid(toxicity.np.array([x]))[0]), abs=1e-9)


@pytest.fixture
def clashing(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(1, text, "a", "b", "c"), (1, text, "a", "b", "c"), (2, text + " more", "d", "e", "f"), (3, "quite other words in this text here", "x", "y", "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, _gone string, _again string, _key string")


@pytest.mark.parametrize("limit", [0, 1_000_000])
def test_clashing_columns_and_both_joins(spark, clashing, monkeypatch, limit):
    """A limit of 0 shuffles what else would be broadcast."""
    for m in (common, simhash_vp):
        monkeypatch.setattr(m, "BROADCAST_KEYS", limit)
    got = simhash_vp.one_of_each(clashing)
    assert got.columns == clashing.columns
    assert sorted(map(tuple, got.collect())) == sorted({tuple(r) for r in clashing.collect() if r["doc_id"] in (1, 3)})
    bench = spark.createDataFrame([(9, "one two three four five six seven eight nine ten eleven twelve thirteen")], "item_id long, text string")
    left = decontam.without_leaks(clashing, bench)
    assert [tuple(r) for r in left.collect()] == [(3, "quite other words in this text here", "x", "y", "z")] and left.columns == clashing.columns


@pytest.mark.parametrize("hot", [0, 2])
def test_hot_keys(spark, small, monkeypatch, hot):
    want = sorted(map(tuple, simhash_vp.near_duplicates(small["documents"]).collect()))
    kept = sorted(r["doc_id"] for r in simhash_vp.one_of_each(small["documents"]).collect())
    monkeypatch.setattr(simhash_vp, "HOT", hot)
    assert sorted(map(tuple, simhash_vp.near_duplicates(small["documents"]).collect())) == want
    assert sorted(r["doc_id"] for r in simhash_vp.one_of_each(small["documents"]).collect()) == kept


def test_more_bits_find_no_fewer(spark, small):
    near = {r["doc_id"] for r in simhash_vp.one_of_each(small["documents"]).collect()}
    far = {r["doc_id"] for r in simhash_vp.one_of_each(small["documents"], near=11, far=64).collect()}
    assert far <= near


def test_items_of_one_word(spark):
    docs = spark.createDataFrame([(1, "a rare zebra"), (2, "nothing here")], "doc_id long, text string")
    bench = spark.createDataFrame([(5, "Zebra"), (6, "rare zebra"), (7, "")], "item_id long, text string")
    assert decontam.contaminated(docs, bench).count() == 0
    got = sorted((r["doc_id"], r["item_id"], r["first_token"]) for r in decontam.contaminated(docs, bench, fewest=1).collect())
    assert got == [(1, 5, 2), (1, 6, 1)]


def test_ids_that_are_no_numbers(spark):
    docs = spark.createDataFrame([("x", "some text"), ("12", "more")], "doc_id string, text string")
    got = token_files.read_token_files(*token_files.write_token_files(docs, vocabulary("byte_bpe_50k.json"), end_id=2)).select("doc_id").collect()
    assert sorted((r[0] for r in got), key=repr) == [12, None]


def test_left_out_with_a_name_in_use(spark):
    df = spark.range(3).withColumn("_gone", F.lit("k")).withColumn("_GONE_", F.lit("m"))
    got = common.left_out(df, F.col("id"), spark.range(1).select(F.col("id").alias("key")))
    assert sorted(r["id"] for r in got.collect()) == [1, 2] and got.columns == df.columns
