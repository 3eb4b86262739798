import pytest

SMALL = "/root/testdata/sf0.001"
#: What every operator must stand: nulls, empty and very long texts, ties, repeated rows, odd characters.
TEXTS = [
    (1, "plain words, and more of them.\nNext line"),
    (2, None),
    (3, ""),
    (4, "   "),
    (5, "plain words, and more of them.\nNext line"),
    (5, "plain words, and more of them.\nNext line"),
    (None, "a row without an id"),
    (6, "x" * 3000 + " " + "ab " * 20_000),
    (7, "a  b\t\tc \n\n d\u3000e\x1cf\x00g <|endoftext|> İΣ ΑΣ don't 123 ﬁ é é 漢字 😀 ²"),
    (8, " leading and trailing "),
    (9, "<|endoftext|>"),
    (10, "one"),
    (11, "one two"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, fp string, h string, rank string, _t string, _k string, component_id string, ids string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with columns whose names clash with those that operators make."""
    return spark.createDataFrame([(i, t, None, None, None if t is None else len(t), "s", "s", "s", "s", "s", "s", "s", "s", "s") for i, t in TEXTS], SCHEMA)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def small(spark):
    return {t: spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark", "pages")}
