"""Labels within a few edits of each other, met by deletion neighbourhoods instead of all against all.

Of two keys at most `cap` edits apart, each leaves the same string when up to `cap` letters of it are left
out: of a replaced letter both leave out their own, of an inserted one the longer key does. So keys are
joined by hashes of what they leave, each pair of keys is taken once, and the edit distance decides. What
many keys leave, as short ones do, is dealt out over a grid of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.functions.text import distance

#: Keys that share a hash from which they are dealt out, and keys of a task there.
CROWD = 2_000


def one_less(key: Column) -> Column:
    """array<string>: the key without each of its letters."""
    at = F.when(F.length(key) > 0, F.sequence(F.lit(1), F.length(key))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat(F.substring(key, F.lit(1), i - 1), F.substring(key, i + 1, F.length(key))))


def neighbourhood(key: Column, cap: int) -> Column:
    """array<bigint>: hashes of the key and of all that it leaves without up to `cap` letters."""
    found = last = F.array(key)
    for _ in range(cap):
        last = F.array_distinct(F.flatten(F.transform(last, one_less)))
        found = F.concat(found, last)
    return F.array_distinct(F.transform(found, lambda x: F.xxhash64(x)))


def pairs_within(keys: DataFrame, key: str, cap: int, by: tuple[str, ...] = (), crowd: int = CROWD) -> DataFrame:
    """(*by, ka, kb, edits): pairs of distinct keys, ka < kb, of the same group `by` at most `cap` edits apart,
    each once. A null key has no pairs."""
    left = keys.select(*by, F.col(key).alias("k")).where("k IS NOT NULL").distinct().select(*by, "k", F.explode(neighbourhood(F.col("k"), cap)).alias("h"))
    on = [*by, "h"]
    n = left.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1").withColumn("side", F.ceil(F.col("n") / crowd).cast("int"))
    shared = left.join(n.drop("n"), on)
    share = F.pmod(F.xxhash64("k"), F.col("side")).cast("int")
    a = shared.select(*on, F.col("k").alias("ka"), share.alias("r"), F.explode(F.sequence(F.lit(0), F.col("side") - 1)).alias("c"))
    b = shared.select(*on, F.col("k").alias("kb"), share.alias("c"), F.explode(F.sequence(F.lit(0), F.col("side") - 1)).alias("r"))
    once = a.join(b, [*on, "r", "c"]).where((F.col("ka") < F.col("kb")) & (F.abs(F.length("ka") - F.length("kb")) <= cap)).select(*by, "ka", "kb").distinct()
    return once.withColumn("edits", distance(F.col("ka"), F.col("kb"), cap)).where(F.col("edits") <= cap)
