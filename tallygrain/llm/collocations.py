"""Phrase collocations from count tries.

Texts are cut into shards of words of one language: a sorted dictionary and the words by number, with
breaks between pieces. A shard counts its phrases in a trie of limited depth, level by level in numpy: a
node of the next level is a node and a word after it. Nodes leave in the order of their paths, each with the
range of prefixes that its path is in, and the sorted tries of all shards are merged by these ranges, where
counts of equal paths are added. Ranges are of about equal weight by the counts of first words; a very common
first word is cut into several by the word after it.

A phrase that occurs LEAST times has parts that do too. So words are counted first, then pairs of frequent
words, then longer phrases of frequent pairs. What is frequent is handed on as a bit map of hashes with a
fixed largest size: a false hit costs a count and changes no result, which has exact counts.

The frequent phrases are a trie again. A walk through it in order gives a phrase's beginnings, the left
parts of its cuts. The suffix link of a node, the phrase without its first word, is the parent of that node
in the trie of reversed phrases; a walk through that one gives the right parts. Walks are cut into ranges,
and a range gets the ancestors of its first node along, so no word, however common, has a task of its own.

Edge cases: a null or empty text has no words; a null language is `und`; texts of any length are read
whole; phrases don't cross marks or lines; a shard ends between texts; repeated rows count again; ties are
broken by the phrase in the order of UTF-8; an empty table gives an empty result; other columns, and the
id, are not read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrain.llm.common import BROADCAST_KEYS, materialise, small_batches

#: Words of a phrase; least occurrences; percent of a phrase's count from which a longer one replaces it; results of a language.
LONGEST, LEAST, REPLACES, TOP = 5, 100, 100, 2000
#: Words of a shard, unless one text has more.
SHARD_WORDS = 1 << 21
#: Bits of a bit map for each thing in it, and most bits in all (16 MB).
BITS_EACH, MOST_BITS = 32, 1 << 27
#: Frequent phrases of a range of a walk, and rows of the samples that ranges are made from.
RANGE_ROWS, RANGE_SAMPLE = 20_000, 20_000
#: Ranges of prefixes for each task that merges tries.
RANGES_A_TASK = 4
MARKS = re.compile(rb"[.,;:!?\x0a-\x0d]+")


def packed_bytes(b: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b)


def unpacked_bytes(b: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(b)


def packed_ids(ids: np.ndarray) -> bytes:
    """32-bit numbers, their first bytes together, then their second ones and so on."""
    return packed_bytes(np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpacked_ids(b: bytes) -> np.ndarray:
    planes = np.frombuffer(unpacked_bytes(b), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").reshape(-1).astype(np.int64)


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = SHARD_WORDS) -> DataFrame:
    """(lang, words, ids, n): the shard's distinct words in order, joined by line ends, its words by number, -1
    between pieces and texts, and their count; both are packed."""
    small_batches(docs.sparkSession)

    def packed(lang: str, names: dict[bytes, int], texts: list[np.ndarray]) -> pd.DataFrame:
        order = sorted(names.keys() - {b"."})  # a mark, as no word has one
        place = np.full(len(names), -1, np.int32)
        place[[names[w] for w in order]] = np.arange(len(order), dtype=np.int32)
        ids = place[np.concatenate(texts)]
        return pd.DataFrame({"lang": [lang], "words": [packed_bytes(b"\n".join(order))], "ids": [packed_ids(ids)], "n": [int((ids >= 0).sum())]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
        size: dict[str, int] = defaultdict(int)
        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                if lang not in held:
                    held[lang] = (fresh(), [])
                got = (MARKS.sub(b" . ", text.encode("utf-8", "surrogatepass").lower()) + b" .").split()
                held[lang][1].append(np.fromiter(map(held[lang][0].__getitem__, got), np.int32, len(got)))
                size[lang] += len(got)
                full = lang if size[lang] >= words else max(size, key=size.__getitem__) if sum(size.values()) >= 4 * words else None
                if full is not None:
                    yield packed(full, *held.pop(full))
                    del size[full]
        for lang, x in held.items():
            yield packed(lang, *x)

    def fresh() -> dict[bytes, int]:
        names: dict[bytes, int] = defaultdict()
        names.default_factory = names.__len__
        return names

    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(run, "lang string, words binary, ids binary, n long")


def crc(lang: str, names: list[bytes]) -> np.ndarray:
    """A hash of each word of a language, as `hashed` makes it."""
    start = zlib.crc32(lang.encode("utf-8", "surrogatepass") + b" ")
    return np.fromiter((zlib.crc32(w, start) for w in names), np.int64, len(names))


def hashed(lang: Column, word: Column) -> Column:
    return F.crc32(F.concat(lang, F.lit(" "), word).cast("binary"))


def mixed(a, b):
    """The hash of a pair from those of its words, on numbers or columns."""
    return a * 1_000_003 + b


class BitMap:
    """What may be frequent: bit number h modulo the size, for each hash h."""

    def __init__(self, rows: DataFrame, h: Column):
        """rows are unique; at most MOST_BITS bits, in pieces of 4 KB, reach the driver."""
        n = max(rows.count(), 1)
        self.size = min(MOST_BITS, max(1 << 15, 1 << (n * BITS_EACH - 1).bit_length()))
        bit = F.pmod(h, F.lit(self.size)) + 1  # buckets count from 1
        parts = rows.select(F.bitmap_bucket_number(bit).alias("k"), F.bitmap_bit_position(bit).alias("p")).groupBy("k").agg(F.bitmap_construct_agg("p").alias("b")).collect()
        self.bits = np.zeros(self.size // 8, np.uint8)
        for r in parts:
            self.bits[(r["k"] - 1) * 4096 : r["k"] * 4096] = np.frombuffer(bytes(r["b"]), np.uint8)

    def has(self, h: np.ndarray) -> np.ndarray:
        h = h % self.size
        return (self.bits[h >> 3] >> (h & 7) & 1).astype(bool)


def levels(t: np.ndarray, n_words: int, frequent: np.ndarray, pair_ok: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(paths, counts) of the trie's nodes, level by level, each in the order of paths: of two words,
    both frequent, or, with pair_ok (whether the pair at a place may be frequent), of three words and more."""
    ok = frequent[t] & (t >= 0)
    at = np.flatnonzero(ok[:-1] & ok[1:] if pair_ok is None else pair_ok)
    depth, parent = 1, t[at]
    paths = np.arange(n_words)[:, None]
    while len(at) and depth < (LONGEST if pair_ok is not None else 2):
        depth += 1
        key, inverse, counts = np.unique(parent * np.int64(n_words) + t[at + depth - 1], return_inverse=True, return_counts=True)
        paths = np.c_[paths[key // n_words], key % n_words]
        if pair_ok is None or depth > 2:
            yield paths, counts
        if pair_ok is not None:
            on = pair_ok[np.minimum(at + depth - 1, len(pair_ok) - 1)] & (at + depth - 1 < len(pair_ok))
            at, parent = at[on], inverse[on]


Bounds = list[tuple[str, str, str]]


def prefix_ranges(words: DataFrame, ranges: int) -> Bounds:
    """At most 2 * ranges bounds (lang, first word, second word), in order, between ranges of about equal weight, of the words
    (lang, phrase, f). Words with a range's weight or more, of which there are at most `ranges`, are all known; a
    sample stands for the others. A word of several ranges is cut where its language's words would be."""
    all_, n = words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count("*")).first()
    full = all_ / ranges
    heavy = words.where(F.col("f") >= full)
    light = words.where(F.col("f") < full)
    some = light.orderBy(F.xxhash64("lang", "phrase"), "lang", "phrase").limit(RANGE_SAMPLE)
    scale = max(1.0, (n - heavy.count()) / RANGE_SAMPLE)
    rows = sorted((lang, w, f, s) for df, s in ((heavy, 1.0), (some, scale)) for lang, w, f in df.select("lang", "phrase", "f").collect())
    by_lang: dict[str, list[tuple[str, float]]] = defaultdict(list)
    for lang, w, f, s in rows:
        by_lang[lang].append((w, f * s))
    bounds, held = [], 0.0
    for lang, w, f, s in rows:
        if held >= full:
            bounds.append((lang, w, ""))
            held = 0.0
        parts = int(f * s // full)
        if parts > 1:
            total, seen, k = sum(x for _, x in by_lang[lang]), 0.0, 1
            for w2, x in by_lang[lang]:
                if k < parts and seen >= total * k / parts:
                    bounds.append((lang, w, w2))
                    k += 1
                seen += x
        held += f * s
    return sorted(set(bounds))


def tries(shard: DataFrame, words: BitMap | None = None, pairs: BitMap | None = None, bounds: Bounds | None = None) -> DataFrame:
    """(lang, phrase, f, range): the tries of shards: words; with `words`, pairs of frequent words; with
    `pairs` too, longer phrases of frequent pairs. A shard's nodes come in the order of their paths."""
    shared = shard.sparkSession.sparkContext.broadcast((words, pairs))
    bounds = bounds or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_pairs = shared.value
        for batch in batches:
            for lang, joined, ids in zip(*(batch.column(c).to_pylist() for c in ("lang", "words", "ids")), strict=True):
                joined = unpacked_bytes(joined)
                names = joined.split(b"\n") if joined else []
                t = unpacked_ids(ids)
                column = pa.array([w.decode("utf-8", "surrogatepass") for w in names], pa.string())
                if known is None:
                    yield rows_of(lang, column, np.bincount(t[t >= 0], minlength=len(names)), np.zeros(len(names), np.int32))
                elif names:
                    h = crc(lang, names)
                    may, pair_ok = known.has(h), None
                    if known_pairs is not None:
                        both = may[t[:-1]] & may[t[1:]] & (t[:-1] >= 0) & (t[1:] >= 0)
                        pair_ok = both & known_pairs.has(mixed(h[t[:-1]], h[t[1:]]))
                    cuts = cuts_of(lang, names)
                    for paths, counts in levels(t, len(names), may, pair_ok):
                        place = np.searchsorted(cuts, paths[:, 0] * np.int64(len(names)) + paths[:, 1], "right")
                        yield rows_of(lang, pc.binary_join_element_wise(*[column.take(pa.array(p)) for p in paths.T], " "), counts, place)

    def cuts_of(lang: str, names: list[bytes]) -> np.ndarray:
        """The bounds as numbers of a shard's pairs of words; those of other languages are before or after all."""
        code = lambda w: w.encode("utf-8", "surrogatepass")
        out = []
        for of, w, w2 in bounds:
            k = bisect_left(names, code(w))
            there = k < len(names) and names[k] == code(w)
            at = k * len(names) + (bisect_left(names, code(w2)) if there else 0)
            out.append(-1 if of < lang else len(names) ** 2 if of > lang else at)
        return np.array(out, np.int64)

    def rows_of(lang: str, phrases: pa.Array, counts: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(phrases), pa.string()), phrases, pa.array(counts, pa.int64()), pa.array(place, pa.int32())], ["lang", "phrase", "f", "range"])

    return shard.mapInArrow(run, "lang string, phrase string, f long, range int")


def merged(nodes: DataFrame, least: int = LEAST) -> DataFrame:
    """Tries merged by their ranges of prefixes; of what occurs `least` times."""
    ranged = nodes.repartition("range").groupBy("range", "lang", "phrase").agg(F.sum("f").alias("f"))
    return materialise(ranged.where(F.col("f") >= least).drop("range"))


def walked(frequent: DataFrame, reverse: bool, rows: int = RANGE_ROWS) -> DataFrame:
    """(lang, phrase, parts): the counts of a phrase's beginnings of 1, 2 and more words, or with `reverse`
    of its ends, of every phrase of two words or more."""
    path = F.split("phrase", " ")
    nodes = frequent.select("lang", "phrase", "f", (F.reverse(path) if reverse else path).alias("path"))
    n = frequent.count()
    some = sorted((r["lang"], tuple(r["path"])) for r in nodes.orderBy(F.xxhash64("lang", "phrase"), "lang", "phrase").limit(RANGE_SAMPLE).select("lang", "path").collect()) if n > rows else []
    ranges = -(-n // rows)
    bounds = sorted({some[len(some) * k // ranges] for k in range(1, ranges)}) if some else []
    along: dict[tuple[str, tuple[str, ...]], list[int]] = defaultdict(list)  # ancestors of a range's first node
    for k, (lang, p) in enumerate(bounds):
        for d in range(1, len(p)):
            along[lang, p[:d]].append(k + 1)

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = list(zip(pdf["lang"], map(tuple, pdf["path"]), strict=True))
            own = pdf.assign(range=np.array([bisect_right(bounds, k) for k in keys], np.int32), own=True)
            more = [(i, r) for i, k in enumerate(keys) for r in along.get(k, ())]
            extra = pdf.iloc[[i for i, _ in more]].assign(range=np.array([r for _, r in more], np.int32), own=False)
            yield pd.concat([own, extra], ignore_index=True)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, names, counts = None, [], []
        for pdf in batches:
            out = []
            for r, lang, phrase, f, p, own in zip(*(pdf[c] for c in ("range", "lang", "phrase", "f", "path", "own")), strict=True):
                if at != (r, lang):
                    at, names, counts = (r, lang), [], []
                p = list(p)
                d = len(p) - 1
                if names[:d] != p[:d]:
                    raise ValueError(f"a phrase is counted, but not all of its beginnings: {phrase}")
                names, counts = p, counts[:d] + [f]
                if own and d:
                    out.append((lang, phrase, counts[:d]))
            if out:
                yield pd.DataFrame(out, columns=["lang", "phrase", "parts"])

    kinds = "lang string, phrase string, f long, path array<string>, range int, own boolean"
    ordered = nodes.mapInPandas(dealt, kinds).repartition("range").sortWithinPartitions("range", "lang", "path", F.desc("own"))
    return ordered.mapInPandas(walk, "lang string, phrase string, parts array<long>")


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of the phrases of up to LONGEST words that occur LEAST times, and (lang, n)."""
    shard = materialise(shards(docs, text_col, lang_col))
    words = materialise(tries(shard).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= LEAST))
    known = BitMap(words, hashed(F.col("lang"), F.col("phrase")))
    bounds = prefix_ranges(words, RANGES_A_TASK * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = merged(tries(shard, known, bounds=bounds))
    part = lambda k: hashed(F.col("lang"), F.get(F.split("phrase", " "), F.lit(k)))
    longer = merged(tries(shard, known, BitMap(pairs, mixed(part(0), part(1))), bounds))
    return words.unionByName(pairs).unionByName(longer), shard.groupBy("lang").agg(F.sum("n").alias("n"))


def weakest_cut() -> Column:
    """Column struct (score, k, l, r): the cut with the least score, the first of equal ones, of a phrase's count
    a, the words n, and the counts of its beginnings ls and ends rs. Products are decimals of 38 digits."""
    return F.expr("""array_min(transform(sequence(1, size(ls)), k -> struct(
      (1000 * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) div (CAST(ls[k - 1] AS DECIMAL(19, 0)) * CAST(rs[size(rs) - k] AS DECIMAL(19, 0))) AS score,
      k AS k, ls[k - 1] AS l, rs[size(rs) - k] AS r)))""")


def collocations(docs: DataFrame, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two words or more, by the
    score of their weakest cut, without those that a longer one replaces."""
    counts, total = frequent_phrases(docs, text_col, lang_col)
    total = materialise(total)
    phrases = counts.where(F.contains("phrase", F.lit(" "))).withColumnRenamed("f", "a")
    w, m = F.split("phrase", " "), F.size(F.split("phrase", " "))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), m - 1), lambda k: F.transform(F.sequence(F.lit(1), m - k + 1), lambda i: F.array_join(F.slice(w, i, k), " "))))
    inside = phrases.where(m > 2).select("lang", F.col("a").alias("longer"), F.explode(spans).alias("phrase")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    gone = inside.join(phrases, ["lang", "phrase"]).where(100 * F.col("longer") >= REPLACES * F.col("a")).select("lang", "phrase")
    left, right = (walked(counts, reverse).withColumnRenamed("parts", name) for reverse, name in ((False, "ls"), (True, "rs")))
    small = total.count() <= BROADCAST_KEYS  # a row for each language
    scored = phrases.join(gone, ["lang", "phrase"], "left_anti").join(left, ["lang", "phrase"]).join(right, ["lang", "phrase"]).join(F.broadcast(total) if small else total, "lang").withColumn("x", weakest_cut())
    best = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase"))
    ranked = scored.withColumn("rank", best).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "x.l", "x.r", "n", F.col("x.score").cast("long").alias("score"))


def oracle() -> str:
    """The same rows in DuckDB's SQL on documents."""
    words = lambda k: " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    grams = " UNION ALL ".join(f"SELECT lang, {k} AS m, {words(k)} AS phrase FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM p WHERE len(w) >= {k})" for k in range(1, LONGEST + 1))
    piece = "unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]'))"
    return f"""
WITH q AS (SELECT coalesce(lang, 'und') AS lang, {piece} AS piece FROM documents),
p AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM q),
n AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
f AS MATERIALIZED (SELECT lang, m, phrase, count(*) AS f FROM ({grams}) GROUP BY lang, m, phrase HAVING count(*) >= {LEAST}),
k AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1),
c AS (SELECT k.lang, k.m, k.phrase, a, k.k, l.f AS l, r.f AS r, n, 1000::HUGEINT * a * n // (l.f::HUGEINT * r.f) AS score
  FROM k JOIN n ON n.lang = k.lang JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:k.m], ' ')),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS i FROM c),
d AS (SELECT * FROM b WHERE i = 1 AND NOT EXISTS (SELECT 1 FROM f WHERE f.lang = b.lang AND f.m > b.m AND contains(' ' || f.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * f.f >= {REPLACES} * b.a)),
t AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM d)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM t WHERE rank <= {TOP}"""
