"""Every registered query against its SQL."""

import duckdb
import pytest
from helpers import SMALL, rows

from tallygrain.plans.facts import TABLES
from tallygrain.plans import more, reference

QUERIES, SQL = reference.query.queries | more.query.queries, reference.query.sql | more.query.sql


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    want = duck.sql(SQL[name])
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_ranks_of_any_spend(spark):
    from pyspark.sql import functions as F

    from tallygrain.operators.queue import with_rank

    q = spark.range(500).select((F.pmod(F.xxhash64("id"), F.lit(2000)) - 1000).alias("_s"), F.col("id").cast("string").alias("vendor_key"))
    got = [(r["_s"], r["vendor_key"]) for r in with_rank(q, "global_rank", []).orderBy("global_rank").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1]))
