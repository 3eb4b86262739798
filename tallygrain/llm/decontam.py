"""Benchmark decontamination by spaced seeds.

A text's tokens are its lower-cased runs of letters and digits. Fixed masks pick some tokens of a
span and ignore the others, so a seed still matches where ignored tokens were replaced. Seeds of all
positions of the training texts are joined with those of the benchmark; every WINDOW tokens of the
item that hold the seed (the whole item, if shorter) are compared with the text's at the same
distance, and at least SHARE of them must be equal.

An item of WINDOW tokens or more has the seeds of MASKS at each token: of any two replaced tokens in
a window, one of them misses both. A shorter item that may have s tokens replaced has s + 1 seeds,
each of every (s + 1)th token from a start of its own, so one of them is whole whichever s are
replaced. So no overlap is lost in either case.

Edge cases: a null or empty text has no tokens and no hits; items with fewer than LEAST tokens (a parameter) are no
passage and have no hits; texts of any length are searched whole; a null id is kept as it is; rows of
one id are one document or item where results are counted, but each row's text is compared by itself;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import left_out, materialise

#: 1: the token counts, 0: it is ignored.
MASKS = ("11101001", "11010011", "10110101")
SPAN, WINDOW, SHARE = 8, 13, 0.8
#: Least tokens of an item, unless the caller asks for fewer: one or two words stand in any text.
LEAST = 3
#: Most tokens of a window that stand before its seed.
BEFORE = WINDOW - SPAN
#: Most benchmark seeds that are broadcast with their windows (about 200 bytes each). Beyond, seeds
#: alone are broadcast, SEEDS_HELD (about 30 bytes each) at a time, and what hits is dealt out.
WINDOWS_HELD, SEEDS_HELD = 500_000, 4_000_000


def short_masks(n: int) -> list[tuple[str, int]]:
    """(mask, tokens of the item before it) for an item of n tokens, fewer than WINDOW."""
    step = n - math.ceil(n * SHARE) + 1
    return [(("0" * (step - 1)).join("1" * len(range(k, n, step))), k) for k in range(step)]


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def hashed(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    return df.select(F.col(id_col).alias(name), F.transform(tokens(F.col(text_col)), lambda w: F.xxhash64(w)).alias("h"))


def seed(mask: str, h: Column, i: Column) -> Column:
    """The mask's seed at token i of the hashed tokens h, which must have room for it."""
    return F.xxhash64(F.lit(int(mask, 2)), *[h[i + j] for j, c in enumerate(mask) if c == "1"])


def positions(h: Column, span: int) -> Column:
    """Where seeds start; null where there are too few tokens."""
    return F.when(F.size(h) >= span, F.sequence(F.lit(0), F.size(h) - span))


def benchmark_seeds(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", least: int = LEAST) -> tuple[list[str], DataFrame]:
    """The masks, and seed, item_id, lead and win: the tokens that a window with the seed can reach; the
    seed starts at win[lead]."""
    items = hashed(benchmark, item_col, text_col, "item_id").withColumn("n", F.size("h")).where(F.col("n") >= max(least, 1))
    at = items.where(F.col("n") >= WINDOW).select("item_id", "h", F.explode(positions(F.col("h"), SPAN)).alias("p"))
    at = at.withColumn("lead", F.least("p", F.lit(BEFORE)))
    win = F.slice("h", F.col("p") - F.col("lead") + 1, F.col("lead") + WINDOW)
    keys = at.select("item_id", "lead", win.alias("win"), F.explode(F.array(*[seed(m, F.col("h"), F.col("p")) for m in MASKS])).alias("seed"))
    masks = list(MASKS)
    for n in sorted(r["n"] for r in items.where(F.col("n") < WINDOW).select("n").distinct().collect()):  # at most WINDOW - LEAST lengths
        own = F.array(*[F.struct(F.lit(k).alias("lead"), seed(m, F.col("h"), F.lit(k)).alias("seed")) for m, k in short_masks(n)])
        short = items.where(F.col("n") == n).select("item_id", F.col("h").alias("win"), F.explode(own).alias("x"))
        keys = keys.unionByName(short.select("item_id", "x.lead", "win", "x.seed"))
        masks += [m for m, _ in short_masks(n) if m not in masks]
    return masks, keys


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", fewest: int = LEAST) -> DataFrame:
    """doc_id, item_id, first_token (where the first overlap starts in the text), n_overlaps (number
    of verified windows' places), equal_tokens (most in a window): a row for each document and item.
    fewest: least tokens of an item; 1 searches single words too."""
    masks, keys = benchmark_seeds(benchmark, least=fewest)
    keys = materialise(keys)
    n_keys = keys.count()
    h, i, least = F.col("h"), F.col("i"), min(map(len, masks))
    room = lambda m: seed(m, h, i) if len(m) == least else F.when(i + len(m) <= F.size(h), seed(m, h, i))
    # explode_outer, as the optimizer derives a filter from explode that would tokenise twice
    at = hashed(docs, id_col, text_col, "doc_id").select("doc_id", "h", F.explode_outer(positions(h, least)).alias("i"))
    at = at.select("doc_id", "h", "i", F.explode_outer(F.when(i.isNotNull(), F.array(*map(room, masks)))).alias("seed"))
    place = i
    if n_keys <= WINDOWS_HELD:
        hits = at.join(F.broadcast(keys), "seed")
    else:  # only seeds that hit are shuffled, and take along the tokens that a window can reach
        parts = -(-n_keys // SEEDS_HELD)
        known = materialise(keys.select("seed").distinct())
        first = F.greatest(F.lit(0), i - BEFORE)
        cut = ("doc_id", F.slice("h", first + 1, F.lit(WINDOW + BEFORE)).alias("h"), "i", "seed")
        some = [at.join(F.broadcast(known.where(F.pmod("seed", F.lit(parts)) == k)), "seed", "left_semi").select(*cut) for k in range(parts)]
        found = some[0]
        for more in some[1:]:
            found = found.unionByName(more)
        hits, place = found.join(keys, "seed"), F.least(i, F.lit(BEFORE))
    # plain terms, as a lambda would keep the join out of code generation and copy h for every seed
    bits = sum((F.when(F.get("h", place - F.col("lead") + k) == F.get("win", F.lit(k)), 1 << k).otherwise(0) for k in range(WINDOW + BEFORE)), F.lit(0))
    met = hits.select("doc_id", "item_id", (i - F.col("lead")).alias("from"), bits.alias("bits"), F.size("win").alias("reach"))
    # every window with the seed; neither arrays nor texts are shuffled. Again explode_outer: a filter
    # derived from explode would move into the join and make its loop too large to be compiled
    size = F.least("reach", F.lit(WINDOW))
    window = lambda k: F.struct((F.col("from") + k).alias("at"), F.bit_count(F.col("bits").bitwiseAND(F.lit((1 << WINDOW) - 1 << k))).alias("equal"))
    fits = lambda k: (F.col("reach") >= size + k) & (window(k)["equal"] >= F.ceil(size * SHARE))
    over = F.array_compact(F.array(*[F.when(fits(k), window(k)) for k in range(BEFORE + 1)]))
    places = met.select("doc_id", "item_id", F.explode_outer(over).alias("w")).where("w IS NOT NULL").select("doc_id", "item_id", "w.*")
    places = places.groupBy("doc_id", "item_id", "at").agg(F.max("equal").alias("equal"))
    return places.groupBy("doc_id", "item_id").agg(F.min("at").cast("long").alias("first_token"), F.count("*").alias("n_overlaps"), F.max("equal").cast("long").alias("equal_tokens"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no passage of the benchmark. Texts are told
    apart by their MD5, so null and repeated ids change nothing."""
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    leaks = contaminated(docs.select(digest.alias("_d"), "text"), benchmark, "_d")
    return left_out(docs, digest, leaks.select(F.col("doc_id").alias("key")))


def oracle() -> str:
    """The same rows in DuckDB's SQL on documents and benchmark, on strings instead of hashes."""
    cut = r"list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    part = lambda m, a, i: f"'{m}' || " + " || ".join(f"'|' || {a}[{i} + {j + 1}]" for j, c in enumerate(m) if c == "1")
    short = [(n, m, k) for n in range(LEAST, WINDOW) for m, k in short_masks(n)]
    items = [f"SELECT br, p, {part(m, 'b', 'p')} AS seed FROM bp" for m in MASKS] + [f"SELECT br, {k} AS p, {part(m, 'b', k)} AS seed FROM b WHERE len(b) = {n}" for n, m, k in short]
    texts = [f"SELECT dr, i, {part(m, 'h', 'i')} AS seed FROM dp WHERE i + {len(m)} <= len(h)" for m in dict.fromkeys([*MASKS, *(m for _, m, _ in short)])]
    return f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS dr, doc_id, {cut} AS h FROM documents),
b AS MATERIALIZED (SELECT row_number() OVER () AS br, item_id, {cut} AS b FROM benchmark),
dp AS (SELECT dr, h, unnest(range(len(h))) AS i FROM d),
bp AS (SELECT br, b, unnest(range(len(b) - {SPAN - 1})) AS p FROM b WHERE len(b) >= {WINDOW}),
bs AS ({" UNION ALL ".join(items)}),
ds AS ({" UNION ALL ".join(texts)}),
hits AS (SELECT DISTINCT dr, br, i - p AS base, p FROM ds JOIN bs USING (seed)),
w AS (SELECT DISTINCT dr, br, base, unnest(CASE WHEN len(b) < {WINDOW} THEN [0] ELSE range(greatest(0, p - {BEFORE}), least(p, len(b) - {WINDOW}) + 1) END) AS s FROM hits JOIN b USING (br)),
v AS (SELECT doc_id, item_id, base + s AS pos, least(len(b), {WINDOW}) AS size,
        list_sum([CASE WHEN base + s + k >= 0 AND h[base + s + k + 1] = b[s + k + 1] THEN 1 ELSE 0 END FOR k IN range(least(len(b), {WINDOW}))]) AS equal
      FROM w JOIN d USING (dr) JOIN b USING (br)),
places AS (SELECT doc_id, item_id, pos, max(equal) AS equal FROM v WHERE equal >= ceil(size * {SHARE}) GROUP BY ALL)
SELECT doc_id, item_id, CAST(min(pos) AS BIGINT) AS first_token, count(*) AS n_overlaps, CAST(max(equal) AS BIGINT) AS equal_tokens
FROM places GROUP BY doc_id, item_id"""
