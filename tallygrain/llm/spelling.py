"""Spelling variants, grouped with forward and reversed sorted dictionaries.

Two words are near if one inserted, deleted or replaced code point turns one into the other. One edit
leaves a half intact: with m code points in the shorter word, the pair shares its first m // 2 or its
last m // 2. So words of m and of m + 1 code points meet in blocks of a forward dictionary, sorted by
the words, and of a reversed one, sorted by the reversed words; a range of such a dictionary is read
block by block. What is left between the shared ends of a block is one edit apart too, so a block with
more than MOST words is divided by the halves of that middle, until the middle is one code point: such a
block has at most as many words of a length as there are letters. Every pair has one place: where it
shares both halves, the left one counts. Pairs of a block are verified in numpy, and only near ones leave.

Words are counted in tasks before they are shuffled. The dictionaries hold the distinct words alone.

Edge cases: a null or empty text has no words; a null id counts as `null`; texts of any length are
read whole; repeated rows count again; ties are as `forms` states; no word that occurs
often enough gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import materialise, small_batches

RUN = re.compile("[a-zÀ-ÿ]+")
#: Least code points and occurrences of a word; how many times as often as a word its form must occur.
LEAST_LETTERS, LEAST_TIMES, TIMES = 6, 5, 5
#: One run in so many, by its hash with the document's id, loses a letter.
LOSES = 199
#: Words of a block that are compared with each other; beyond, the block is divided.
MOST = 128
#: Words that a task counts before it hands them on, and pairs that are verified at once.
HELD, PAIRS = 200_000, 1 << 18


def words_of(text: str | None, doc_id: str) -> Iterator[tuple[str, int]]:
    """The words of a text, some with a letter lost, and how often each run of it gave them."""
    seen: dict[str, int] = defaultdict(int)
    for run in RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")):  # of bytes, only A-Z
        seen[run] += 1
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in seen.items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSES == 0:
            k = h % len(run)
            run = run[:k] + run[k + 1 :]
        if len(run) >= LEAST_LETTERS:
            yield run, n


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = LEAST_TIMES) -> DataFrame:
    """(word, n): the words of LEAST_LETTERS code points or more that occur at least `times` times."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = defaultdict(int)
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                for w, n in words_of(text, doc_id):
                    held[w] += n
                if len(held) >= HELD:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


def in_blocks(words: DataFrame, path: str) -> DataFrame:
    """words (word, n, m, ...) in the block that a path of halves leads to, l for left and r for right: m is the
    length of a pair's shorter word, and block names what its words share."""
    middle, left, right = F.col("m"), F.lit(0), F.lit(0)
    for side in path:
        half = F.floor(middle / 2).cast("int")
        left, right = (left + half, right) if side == "l" else (left, right + half)
        middle = middle - half
    shared = F.concat(F.substring(F.col("word"), F.lit(1), left), F.lit("|"), F.substring(F.col("word"), F.length("word") - right + 1, right))
    return words.select("word", "n", "m", F.lit(path).alias("path"), shared.alias("block"))


def blocks(words: DataFrame, most: int = MOST) -> DataFrame:
    """(word, n, m, path, block): blocks of at most `most` words, or whose middle is one code point, such
    that every near pair is in the block of its own path. Each round divides the blocks that are too large,
    and a round halves the middle, so there are few."""
    length = F.length("word")
    both = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).where("m > 0")
    done, todo, depth = None, both, 0
    paths = [""]
    while True:
        depth += 1
        rows = None
        for p in paths:
            source = todo if depth == 1 else todo.where(F.col("path") == p)
            for side in "lr":
                part = in_blocks(source, p + side)
                rows = part if rows is None else rows.unionByName(part)
        rows = materialise(rows)
        key = ["path", "m", "block"]
        size = rows.groupBy(*key).agg(F.count("*").alias("size"))
        middle = F.col("m")
        for _ in range(depth):
            middle = middle - F.floor(middle / 2)
        large = materialise(size.where((F.col("size") > most) & (middle > 1)).select(*key))
        few = rows.join(large, key, "left_anti")
        done = few if done is None else done.unionByName(few)
        if large.isEmpty():
            return done
        todo = materialise(rows.join(large, key, "left_semi"))
        paths = [r[0] for r in todo.select("path").distinct().collect()]  # at most 2 ** depth


def letters(words: list[str], width: int) -> np.ndarray:
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def ahead(same: np.ndarray) -> np.ndarray:
    """How many columns from the left are all true, by row."""
    return np.where(same.all(1), same.shape[1], np.argmin(same, 1)) if same.shape[1] else np.zeros(len(same), np.int64)


def near_in(words: list[str], pairs: tuple[np.ndarray, np.ndarray], m: int, path: str) -> np.ndarray:
    """Which of the pairs (shorter of m letters, longer of m or m + 1) are near and belong to the path."""
    a, b = pairs
    x = letters(words, m + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    same = x[a, :m] == x[b, :m]
    p = ahead(same)
    equal = size[b] == m
    # from the end: the longer word is one letter ahead
    tail = np.where(equal[:, None], same, x[a, :m] == x[b, 1 : m + 1])
    q = ahead(tail[:, ::-1])
    ok = np.where(equal, (~same).sum(1) == 1, p + q >= m)
    middle, left = m, 0
    for side in path:
        half = middle // 2
        shares = p >= left + half  # both start with these
        ok &= shares if side == "l" else ~shares
        left, middle = left + half * (side == "l"), middle - half
    return ok


def pairs_of(size: np.ndarray, short: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i, j), i before j in the same block and i one of the shorter words, of blocks of `size` words."""
    end = np.repeat(np.cumsum(size), size)
    more = np.where(short, end - np.arange(len(short)) - 1, 0)
    i = np.repeat(np.arange(len(short)), more)
    return i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(more) - more, more)


def near_pairs(words: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b, na, nb): every near pair of words (word, n) once; a is no longer than b."""
    rows = materialise(blocks(words, most))

    def verified(run: pd.DataFrame) -> pd.DataFrame:
        """Whole blocks of one m and path: shorter words come first in a block."""
        m, path, w, n = int(run["m"].iloc[0]), run["path"].iloc[0], run["word"].to_numpy(object), run["n"].to_numpy(np.int64)
        first = np.flatnonzero(np.r_[True, run["block"].to_numpy()[1:] != run["block"].to_numpy()[:-1]])
        a, b = pairs_of(np.diff(np.r_[first, len(run)]), np.fromiter(map(len, w), np.int64, len(w)) == m)
        out = [(a[:0], b[:0])]
        for k in range(0, len(a), PAIRS):
            ak, bk = a[k : k + PAIRS], b[k : k + PAIRS]
            names, place = np.unique(np.r_[ak, bk], return_inverse=True)
            ok = near_in(w[names].tolist(), (place[: len(ak)], place[len(ak) :]), m, path)
            out.append((ak[ok], bk[ok]))
        a, b = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"a": w[a], "b": w[b], "na": n[a], "nb": n[b]})

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of one path and m, cut between blocks so that a run has few pairs; a block that the end of
        a batch cuts waits for the next one."""
        left = None
        for pdf in batches:
            pdf = pdf if left is None else pd.concat([left, pdf], ignore_index=True)
            key = pdf["path"] + " " + pdf["m"].astype(str) + " " + pdf["block"]
            first = np.flatnonzero(np.r_[True, key.to_numpy()[1:] != key.to_numpy()[:-1]])
            left = pdf.iloc[first[-1] :]
            yield from cut(pdf.iloc[: first[-1]], first[:-1])
        if left is not None:
            yield from cut(left, np.zeros(1, int))

    def cut(pdf: pd.DataFrame, first: np.ndarray) -> Iterator[pd.DataFrame]:
        if not len(pdf):
            return
        size = np.diff(np.r_[first, len(pdf)])
        kind = (pdf["path"] + " " + pdf["m"].astype(str)).to_numpy()[first]
        start, held = 0, 0
        for k in range(len(first)):
            if k > start and (kind[k] != kind[start] or held + size[k] ** 2 > PAIRS):
                yield verified(pdf.iloc[first[start] : first[k]])
                start, held = k, 0
            held += size[k] ** 2
        yield verified(pdf.iloc[first[start] :])

    tasks = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = rows.repartitionByRange(int(tasks), "path", "m", "block").sortWithinPartitions("path", "m", "block", F.length("word"), "word")
    return ranged.mapInPandas(scan, "a string, b string, na long, nb long")


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): the form is the near word of largest n, ties by code points, if
    that n is at least `times` the word's."""
    both = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("o"), F.col("nb").alias("k")), F.struct(F.col("b").alias("word"), F.col("a").alias("o"), F.col("na").alias("k")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("k")).alias("k"), "o")).alias("best"))
    j = words.join(best, "word", "left")
    form = -F.col("best.k") >= times * F.col("n")
    return j.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(form, F.col("best.o")).alias("form"), F.when(form, -F.col("best.k")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """Adds root: the last of a word's forms, the word itself without one. Each round doubles the steps
    that a root has gone, and a step multiplies n, so there are few."""
    steps = materialise(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = materialise(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            return formed.join(steps.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
        steps = steps.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the documents."""
    words = materialise(vocabulary(docs, id_col, text_col))
    formed = materialise(forms(words, near_pairs(words)))
    return roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def oracle() -> str:
    """The same rows in DuckDB's SQL on documents: CRC-32 by its table, near words by patterns."""
    table = []
    for k in range(256):
        for _ in range(8):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        table.append(k)
    # of letters up to 00FF, which are one byte or two
    octets = "flatten(list_transform(string_split(s, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + unicode(c) // 64, 128 + unicode(c) % 64] END))"
    return f"""
WITH RECURSIVE r AS (SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
c AS (SELECT id, run, count(*) AS n, id || ':' || run AS s FROM r GROUP BY id, run),
h AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform({octets}, lambda b: CAST(b AS BIGINT))), lambda a, b: xor(a >> 8, CAST({table} AS BIGINT[])[xor(a & 255, b) + 1])), 4294967295) AS h FROM c),
w AS (SELECT CASE WHEN h % {LOSES} = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_TIMES}),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS x, substr(word, i + 1) AS y FROM p),
e AS (SELECT a.word, b.word AS o, b.n AS k FROM d a JOIN d b ON a.i = b.i AND a.x = b.x AND a.y = b.y AND a.word <> b.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON v.word = d.x || d.y UNION SELECT v.word, d.word, d.n FROM d JOIN v ON v.word = d.x || d.y),
b AS (SELECT word, count(*) AS n_near, max(k) AS k FROM e GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.k >= {TIMES} * v.n THEN (SELECT min(e.o) FROM e WHERE e.word = v.word AND e.k = b.k) END AS form, CASE WHEN b.k >= {TIMES} * v.n THEN b.k END AS form_n FROM v LEFT JOIN b USING (word)),
t AS (SELECT word, word AS root, 0 AS step FROM f UNION ALL SELECT t.word, f.form, step + 1 FROM t JOIN f ON f.word = t.root WHERE f.form IS NOT NULL),
l AS (SELECT word, arg_max(root, step) AS root FROM t GROUP BY word)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n FROM f JOIN l USING (word)"""
