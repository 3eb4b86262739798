"""Databases read by many tasks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Rows fetched at a time, and steps that a key's span is counted in before they are joined to parts.
FETCH, STEPS = 20_000, 1_000


def parts_of(counts: list[tuple[int, int]], parts: int) -> list[tuple[int | None, int | None]]:
    """Bounds [from, to) of parts of about equal weight, of counts (from, rows) of steps; None is open."""
    total, held, edges = sum(n for _, n in counts), 0, []
    for start, n in sorted(counts):
        if held and held >= total * (len(edges) + 1) / parts and len(edges) < parts - 1:
            edges.append(start)
        held += n
    return list(zip([None, *edges], [*edges, None]))


def predicates(spark: SparkSession, url: str, table: str, key: str, parts: int, options: dict[str, str] | None = None, steps: int = STEPS) -> list[str]:
    """Conditions on a whole-number key that deal a table into parts of about equal rows: the database gives its
    least and largest value and counts it in equal steps; a step with more than a part is counted in finer ones;
    then steps are joined until a part is full. Null keys go into the first part."""
    ask = lambda sql: spark.read.format("jdbc").options(url=url, query=sql, **(options or {})).load().collect()
    low, high = ask(f"SELECT MIN({key}) AS LO, MAX({key}) AS HI FROM {table}")[0]
    if low is None or parts < 2 or low == high:
        return ["1 = 1"]

    def counted(low: int, high: int) -> list[tuple[int, int, int]]:
        """(from, width, rows) of the steps of low <= key <= high that have rows."""
        width = -(-(high - low + 1) // steps)
        got = ask(f"SELECT STEP, COUNT(*) AS N FROM (SELECT ({key} - ({low})) / {width} AS STEP FROM {table} WHERE {key} >= {low} AND {key} <= {high}) T GROUP BY STEP")
        return [(low + int(r[0]) * width, width, int(r[1])) for r in got]

    found = counted(int(low), int(high))
    full = sum(n for *_, n in found) / parts
    while heavy := [x for x in found if x[2] > full and x[1] > 1]:  # at most `parts`, each some steps finer
        found = [x for x in found if x not in heavy] + [y for start, width, _ in heavy for y in counted(start, start + width - 1)]
    out = []
    for a, b in parts_of([(start, n) for start, _, n in found], parts):
        ends = [f"{key} >= {a}"] * (a is not None) + [f"{key} < {b}"] * (b is not None)
        inside = " AND ".join(ends) or "1 = 1"
        out.append(inside if a is not None or not ends else f"({inside} OR {key} IS NULL)")
    return out


def read(spark: SparkSession, url: str, table: str, key: str | None = None, parts: int = 1, options: dict[str, str] | None = None) -> DataFrame:
    """A table of a database, a task for each part; without a key in one task."""
    properties = {"fetchsize": str(FETCH), **(options or {})}
    if key is None or parts < 2:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **properties).load()
    return spark.read.jdbc(url, table, predicates=predicates(spark, url, table, key, parts, options), properties=properties)
