"""Fact lines over the star-schema tables: tenants are nations, vendors are suppliers.

The same SQL columns make the lines in Spark and stand before each oracle, so only the operators
themselves are compared; in Spark the same joins come in another order. Money is in whole cents, whose sums no order
of adding changes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Query = Callable[[SparkSession, str], DataFrame]

CENTS = "CAST(FLOOR(l_extendedprice * (1 - l_discount) * 100 + 0.5) AS BIGINT) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END"
JOINS = """FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
"""
#: Every column of a fact line; both engines read it.
LINES = f"""
SELECT n_name AS tenant,
  CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE s_name END AS supplier,
  l_orderkey * 10 + l_linenumber AS line_id,
  {CENTS} AS cents,
  CASE WHEN p_partkey % 11 = 0 THEN 'n/a' WHEN p_partkey % 13 = 0 THEN '  ' ELSE p_name END AS d1,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END AS d2,
  CASE WHEN p_size % 13 = 0 THEN '' WHEN p_size % 5 = 0 THEN 'Excluded' ELSE 'Goods' END AS l0,
  p_brand AS l1,
  CASE WHEN p_size % 3 = 0 THEN '' ELSE p_type END AS l2,
  split_part(p_name, ' ', 2) AS l3,
  CASE WHEN p_partkey % 4 = 0 THEN '(not used at this level)' ELSE split_part(p_name, ' ', 1) END AS l4,
  o_orderpriority AS rule_id,
  CASE WHEN (l_orderkey + l_linenumber) % 10 < 4 THEN 'Correct' WHEN (l_orderkey + l_linenumber) % 10 < 7 THEN 'Incorrect' WHEN (l_orderkey + l_linenumber) % 10 = 7 THEN 'Uncertain' END AS verdict,
  CAST(CASE WHEN (l_orderkey + l_linenumber) % 10 < 8 THEN 1 + (l_orderkey + l_partkey) % 3 END AS BIGINT) AS jury,
  CASE WHEN (l_orderkey + l_linenumber) % 10 IN (4, 5) THEN 'NC-000' || CAST(l_partkey % 6 AS STRING) END AS suggested_key,
  CAST(l_partkey % 9 AS STRING) AS tax_key,
  s_name || '/' || p_name AS subject_id,
  s_name || '/' || p_name || '/' || p_brand || '/' || CAST(p_size % 2 AS STRING) AS unit_id,
  l_partkey AS part_id, l_linenumber AS line_no, l_orderkey AS order_id,
  CASE WHEN p_partkey % 11 = 0 OR p_partkey % 13 = 0 THEN CASE WHEN p_partkey % 7 = 0 THEN 'N' ELSE 'Y' END ELSE 'Y' END AS description_usable,
  l_shipdate AS shipped
{JOINS}"""
#: LINES as Spark runs it: orders, the largest side, is met while a line is a few numbers, and what puts names on a line
#: comes last, so that large tables shuffle as little of a line as can be.
NARROW = LINES.replace(JOINS, f"""FROM (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, {CENTS} AS cents FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
""").replace(f"{CENTS} AS cents,\n", "cents,\n")
#: Most suppliers that are broadcast to the lines, at below 100 bytes each; beyond that, or where Spark's own bound would
#: stop it sooner, every line would be dealt out once more, by then with the names of its part.
BROADCAST_SUPPLIERS = 1_000_000
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")
#: Settings that name the folder of stored fact lines, one for each folder of tables; without it a query joins the star schema anew.
STORED = "spark.tallygrain.lines"


def stored_key(sf_dir: str) -> str:
    return f"{STORED}.{zlib.crc32(sf_dir.rstrip('/').encode())}"


#: The crosswalk and the keys of the merged tree, as in the two engines.
CROSS = "SELECT n_name AS tenant, CAST(k AS STRING) AS source_key, 'NC-000' || CAST(k % 6 AS STRING) AS target_key, k % 2 = 0 AS moved FROM nation CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6)) AS t(k)"
KEYS = "SELECT 'NC-000' || CAST(k AS STRING) AS category_key, CASE WHEN k = 5 THEN 'Clinical' ELSE 'Goods' END AS l0, k <> 5 AS in_scope FROM (VALUES (0), (1), (2), (3), (4), (5)) AS t(k)"
#: Three votes a line, drawn from its number.
VOTES = """
SELECT line_id, CAST(seat AS INT) AS seat,
  CASE WHEN (line_id + 3 * seat) % 11 = 0 THEN NULL WHEN (line_id + 5 * seat) % 13 = 0 THEN 'maybe' WHEN (line_id * (1 + seat) + seat) % 7 < 4 THEN 'Correct' WHEN (line_id + seat) % 3 < 2 THEN 'Incorrect' ELSE 'Uncertain' END AS verdict,
  CASE WHEN (line_id + seat) % 5 = 0 THEN 'high' ELSE CAST(CAST((line_id + seat) % 9 AS DOUBLE) / 8 AS STRING) END AS confidence,
  CASE WHEN (line_id + seat) % 4 = 0 THEN 'hunch' WHEN (line_id + seat) % 4 = 1 THEN 'supplier' ELSE 'description' END AS basis,
  CASE WHEN (line_id + seat) % 2 = 0 THEN 'NC-000' || CAST(line_id % 7 AS STRING) ELSE ' NC-000' || CAST(line_id % 7 AS STRING) || ' ' END AS suggested_key,
  CASE WHEN (line_id + seat) % 6 > 0 THEN 'seat ' || CAST(seat AS STRING) END AS rationale
FROM lines CROSS JOIN (VALUES (0), (1), (2)) AS s(seat) WHERE verdict IS NOT NULL
"""
#: Category nodes of each tenant with the lines they hold; spelling varies by tenant.
NODES = """
SELECT tenant, l1 || '/' || kind || '/' || l3 || '/' || l4x AS source_key,
  CASE WHEN MAX(length(tenant)) % 2 = 0 AND l3 = 'bolt' THEN 'Goods > ' || l1 || ' > ' || kind || ' > ' || upper(l3) || ' > ' || l4x ELSE 'Goods > ' || l1 || ' > ' || kind || ' > ' || l3 || ' > ' || l4x END AS path,
  'Goods' AS g, l1, kind AS l2, CASE WHEN MAX(length(tenant)) % 2 = 0 AND l3 = 'bolt' THEN upper(l3) ELSE l3 END AS l3, l4x AS l4, count(*) AS lines
FROM (SELECT *, CASE WHEN l2 = '' THEN 'OTHER' ELSE l2 END AS kind, CASE WHEN l4 = '(not used at this level)' THEN l3 ELSE l4 END AS l4x FROM lines WHERE l0 = 'Goods') x
GROUP BY tenant, l1, kind, l3, l4x
"""
WITH = f"WITH lines AS ({LINES}), cross_ AS ({CROSS}), keys_ AS ({KEYS}), votes AS ({VOTES}), nodes AS ({NODES}) "


#: Schemas of tables by session and path: they are read from footers once, not for each query.
SCHEMAS: dict[tuple[str, str], StructType] = {}
#: Rows of suppliers by session and path, counted once; they decide how lines meet them, not what comes out.
SUPPLIERS: dict[tuple[str, str], int] = {}


def table(spark: SparkSession, path: str) -> DataFrame:
    """A table's rows; its schema is that which the session found when it first read the path."""
    key = (spark.sparkContext.applicationId, path)
    if key not in SCHEMAS:
        SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[key]).parquet(path)


def narrow(spark: SparkSession, sf_dir: str) -> str:
    """NARROW over the tables of a folder, with suppliers broadcast up to BROADCAST_SUPPLIERS."""
    key = (spark.sparkContext.applicationId, f"{sf_dir}/supplier.parquet")
    if key not in SUPPLIERS:
        SUPPLIERS[key] = table(spark, key[1]).count()
    return NARROW.replace("SELECT", "SELECT /*+ BROADCAST(supplier, nation) */", 1) if SUPPLIERS[key] <= BROADCAST_SUPPLIERS else NARROW


def frames(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """Lazy frames of the derived relations and tables by name; nothing is registered in the session
    but views of the tables under names of their own."""
    stored = spark.conf.get(stored_key(sf_dir), None)
    view = stored_key(sf_dir).replace(".", "_")
    if stored:
        table(spark, stored).createOrReplaceTempView(view)
    made = not stored and any(n in ("lines", "votes", "nodes") for n in names)
    lines = narrow(spark, sf_dir) if made else f"SELECT * FROM {view}"
    texts = {"lines": lines, "cross_": CROSS, "keys_": KEYS, "votes": VOTES, "nodes": NODES}
    # reading a table looks into its footers, so only those that the lines or the crosswalk name are read, once
    need = {"lineitem", "supplier", "nation", "part", "orders"} if made else set()
    for t in need | ({"nation"} if "cross_" in names else set()):
        table(spark, f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    out = []
    for n in names:
        if n not in texts:
            out.append(table(spark, f"{sf_dir}/{n}.parquet"))
        elif n in ("lines", "cross_", "keys_"):
            out.append(spark.sql(texts[n]))
        else:
            out.append(spark.sql(f"WITH lines AS ({lines}) {texts[n]}"))
    return out


def stored_facts(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the fact lines of a folder of tables once, as a tenant's load does; the session's later queries over
    that folder read them there."""
    frames(spark, sf_dir, "lines")[0].write.mode("overwrite").parquet(path)
    SCHEMAS.pop((spark.sparkContext.applicationId, path), None)
    spark.conf.set(stored_key(sf_dir), path)


class Registry:
    """Queries by name, each with its SQL where SQL can say it."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, derived: bool = True):
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = (WITH if derived and not sql.lstrip().startswith("WITH RECURSIVE") else "") + sql
            return f

        return add
