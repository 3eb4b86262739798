"""URL filter: rules on host and path, and a logistic regression where no rule fits.

All of it is DataFrame and SQL functions. The model reads hashed character n-grams of host and path.
It is trained from a small labelled table of URLs, held as one row of sparse lists: gradient descent
is a fold over the rounds in a single expression. Only its weights, WIDTH + 1 numbers, reach the
driver; scoring is a fold over the URL's n-grams.

Edge cases: a null URL or one without :// has an empty host and path, fits no rule and is judged by
the model's bias; an empty table gives an empty table; rules of equal length can't both fit, as each
is a suffix of the host with a prefix of the path, unless they are given twice, and then the
alphabetically first counts; very long URLs are read whole; repeated rows give repeated rows; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host with all its subdomains, beginning of the path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Words of hosts that sell, lure or track, and of hosts with prose: general words, not hosts of any table.
BLOCKED = (
    "ads", "adult", "bets", "bingo", "bonus", "casino", "cheap", "clicks", "crack", "deals", "escort", "free", "hack", "jackpot", "keygen", "loans", "lottery", "malware",
    "meds", "payday", "pills", "poker", "popup", "porn", "prizes", "replica", "roulette", "sexy", "slots", "spam", "spins", "torrent", "track", "viagra", "warez", "win",
)
ALLOWED = (
    "archive", "astronomy", "book", "choir", "city", "club", "college", "cooking", "council", "culture", "farm", "film", "football", "garden", "health", "history", "hospital", "journal", "law", "library",
    "local", "map", "market", "mountain", "museum", "music", "nature", "news", "opera", "orchestra", "parliament", "press", "railway", "review", "school", "science", "source", "theatre", "travel", "weather",
)
#: Invented names of hosts are three of these in a row.
SYLLABLES = ("ba", "cen", "dor", "fil", "gra", "hum", "jen", "kor", "lum", "mor", "nes", "pal", "quin", "ros", "sten", "tor", "ul", "vel", "wis", "zan")
#: What may stand before and after a name; both classes have all of it.
BEFORE, AFTER = ("www.", "m.", "", "blog."), (".org/en/71.html", ".net/de/5", ".com/en/802", ".example.org/fr/44/", ".info/")
#: n of the n-grams, hashed features, rounds and step of gradient descent, and its penalty.
SIZES, WIDTH, ROUNDS, RATE, SHRINK = (3, 4), 8192, 150, 8.0, 0.0002


def host_of(url: Column) -> Column:
    """From the first :// to the next /, ? or #, with A-Z in lower case."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)"))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to the next ? or #."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_u, instr(_u, '://') + 3)"))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def hashed_ngrams(name: str, text: Column, n: int) -> Column:
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(f"{name}{n}"), F.substring(text, i, F.lit(n))), F.lit(WIDTH)).cast("int"))


def ngrams(host: Column, path: Column) -> Column:
    """array<int>: the distinct hashed n-grams of host and path, each with its part's name."""
    parts = [hashed_ngrams(name, F.concat(F.lit("^"), text, F.lit("$")), n) for name, text in (("h", host), ("p", path)) for n in SIZES]
    return F.array_distinct(F.concat(*parts))


def host_names(words: tuple[str, ...], more: tuple[str, ...] = ("",)) -> list[str]:
    """Each word alone and in compounds with another one and with one of `more`."""
    n = len(words)
    out = []
    for k, w in enumerate(words):
        out += [w, f"{w}-{words[(k + 3) % n]}", words[(k + 7) % n] + w, f"the-{w}", f"{more[k % len(more)]}{w}"]
    return list(dict.fromkeys(out))


def invented(start: int, n: int) -> list[str]:
    s = len(SYLLABLES)
    return [SYLLABLES[k % s] + SYLLABLES[(k * 7 + k // s + 3) % s] + SYLLABLES[(k * 3 + 11 * (k // s)) % s] for k in range(start, start + n)]


def urls_of(names: list[str]) -> list[str]:
    return [f"https://{BEFORE[k % len(BEFORE)]}{h}{AFTER[k % len(AFTER)]}" for k, h in enumerate(names)]


def labelled_urls(spark: SparkSession, blocked: tuple[str, ...] = BLOCKED, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """(url, y): the small training table, a few hundred rows made from words by rule; y is 1 for block."""
    rows = [(u, 1) for u in urls_of(host_names(blocked, allowed))] + [(u, 0) for u in urls_of(host_names(allowed) + invented(0, 100))]
    values = ", ".join(f"('{u}', {y})" for u, y in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(url, y)")


def train(labelled: DataFrame) -> list[float]:
    """WIDTH weights and a bias. labelled: (url, y), small.

    Gradient descent needs, for each round, the errors of all rows (sums over a row's features) and
    then the slopes of all features (sums over a feature's rows), so both lists are made first."""
    if labelled.isEmpty():
        raise ValueError("the labelled table is empty, so there is nothing to learn from")
    host_path = labelled.select(F.col("url").alias("_u"), "y").select(host_of(F.col("_u")).alias("h"), path_of(F.col("_u")).alias("p"), F.col("y").cast("double").alias("y"))
    rows = host_path.select("y", ngrams(F.col("h"), F.col("p")).alias("g")).withColumn("x", 1 / F.sqrt(F.greatest(F.size("g"), F.lit(1)).cast("double")))
    all_rows = rows.agg(F.array_sort(F.collect_list(F.struct("y", "g", "x"))).alias("r"))
    each = all_rows.select(F.posexplode("r").alias("k", "e")).select("k", "e.x", F.explode("e.g").alias("j"))
    lists = each.groupBy("j").agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("q"))
    by_feature = lists.agg(F.map_from_entries(F.collect_list(F.struct("j", "q"))).alias("m"))
    nothing = "CAST(array() AS array<struct<k:int,x:double>>)"
    fit = f"""aggregate(sequence(1, {ROUNDS}), array_repeat(0D, {WIDTH + 1}), (w, i) ->
      transform(array(transform(r, e -> 1 / (1 + exp(-aggregate(e.g, 0D, (s, j) -> s + w[j]) * e.x - w[{WIDTH}])) - e.y)),
        d -> concat(
          transform(f, (l, j) -> w[j] - {RATE}D * (aggregate(l, 0D, (s, q) -> s + d[q.k] * q.x) / size(r) + {SHRINK}D * w[j])),
          array(w[{WIDTH}] - {RATE}D * aggregate(d, 0D, (s, v) -> s + v) / size(r))))[0])"""
    # an array of one binds the lists to a name, or the optimizer would make them in every round
    every = f"array(transform(sequence(0, {WIDTH - 1}), j -> coalesce(m[j], {nothing})))"
    return all_rows.crossJoin(by_feature).select(F.expr(f"transform({every}, f -> {fit})[0]").alias("w")).first()["w"]  # one row and one row


def verdicts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's score, a row for each row of pages. labelled:
    (url, y), a small training table; that of this module by default."""
    spark = pages.sparkSession
    weights = train(labelled if labelled is not None else labelled_urls(spark))
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # one constant
    cut = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_u"))
    cut = cut.select("page_id", host_of(F.col("_u")).alias("host"), path_of(F.col("_u")).alias("path"))
    fits = [
        F.when(((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p), F.struct(F.lit(-len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in RULES
    ]
    found = cut.withColumn("_r", F.least(*fits)).withColumn("_g", ngrams(F.col("host"), F.col("path")))
    size = F.sqrt(F.greatest(F.size("_g"), F.lit(1)).cast("double"))
    margin = F.aggregate("_g", F.lit(0.0), lambda s, j: s + F.element_at(w, j + 1)) / size + F.element_at(w, WIDTH + 1)
    scored = found.withColumn("score", 1 / (1 + F.exp(-margin)))
    own = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.coalesce("_r.verdict", own).alias("verdict"), "score")
