"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Each shard draws a number from the key, -weight / ln(u), where u is a hash of key and shard in (0, 1);
the record goes to the shard with the largest number. The draw of a shard knows nothing of the others,
so one more shard takes records only into itself, and each shard gets its share of the weights. The
key and the number of shards decide alone.

A record's slot is its place in its shard, without gaps. A shard may hold a large part of all rows,
so it is numbered by blocks: rows are dealt to blocks by a second hash of key, size and checksum (so a key
that many rows share is many blocks too), a count by block gives each block its offset, and rows are
numbered inside their block. The narrow rows are written once to the shared folder; texts never move.

Edge cases: a null key is a key like any other; rows that share a key share a shard and have slots of
their own, in an order by size and checksum; a null or empty text has size 1 and checksum 0; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import materialise

#: Rows that a block of a shard should hold.
BLOCK_ROWS = 20_000


def draw(key: Column, shard: int, weight: float) -> Column:
    """The shard's number for the key; larger wins. u comes from the 52 upper bits of a hash."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.lit(float(weight)) / F.log(u)


def shard_of(key: Column, weights: list[float]) -> Column:
    """Column int: the shard of a key; on equal numbers the higher shard."""
    best = F.greatest(*[F.struct(draw(key, k, w).alias("d"), F.lit(k).alias("shard")) for k, w in enumerate(weights)])
    return best["shard"]


def shard(docs: DataFrame, weights: list[float], more: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, a row for each row of docs. more: the
    weight of the shard that grown_shard adds."""
    if len(weights) < 2:
        raise ValueError("at least two shards are needed")
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), key.alias("_k"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = materialise(rows.select("doc_id", "size", "text_crc32", shard_of(F.col("_k"), weights).alias("shard"), shard_of(F.col("_k"), [*weights, more]).alias("grown_shard"), F.xxhash64("_k", "size", "text_crc32").alias("_b")))
    blocks = max(1, rows.count() // (BLOCK_ROWS * len(weights)))
    rows = rows.withColumn("_b", F.pmod("_b", F.lit(blocks)))
    held = rows.groupBy("shard", "_b").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    offset = held.select("shard", "_b", F.coalesce(before, F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "_b").orderBy("doc_id", "size", "text_crc32")) - 1
    numbered = rows.withColumn("_i", inside).join(offset, ["shard", "_b"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("_offset") + F.col("_i")).cast("long").alias("slot"), "grown_shard")
