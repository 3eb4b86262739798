"""Quality rules, spelling variants and collocations against plain loops and SQL."""

import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from helpers import rows

from tallygrain.llm import collocations, quality_rules, queries, spelling

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def base_by_hand(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    spans = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(spans)
    covered = {i + k for i, s in enumerate(spans) if often[s] > 1 for k in range(8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


def loops(n):
    rnd = random.Random(8)
    return [" ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "\n", "\n \n# x\n# x"]) for _ in range(n)]


def test_base_statistics(spark, small, odd, empty):
    made = spark.createDataFrame([(i, t) for i, t in enumerate(loops(300))], "doc_id long, text string")
    for docs in (small["documents"], odd, made):
        got = quality_rules.judged(docs, [])
        assert got.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
        want = []
        for r in docs.collect():
            b = base_by_hand(r["text"])
            fail = b[0] < 20 or 100 * b[4] > 30 * b[0]
            want.append((r["doc_id"], *b, fail, not fail))
        assert sorted((tuple(r)[:8] for r in got.collect()), key=repr) == sorted(want, key=repr)
    assert quality_rules.quality_rules(empty, spark.createDataFrame([], "doc_id long, quality int")).count() == 0


def test_statistics_survive_a_filter(small):
    """A filter that moves below the projection must not make a list again for each word."""
    got = quality_rules.statistics(small["documents"]).where("n_repeat_words > 3")
    assert got.count() == sum(base_by_hand(r["text"])[4] > 3 for r in small["documents"].collect())


def splits_by_hand(rows_, names):
    """The best first threshold by gain, over all distinct values instead of bins."""
    poor, good = sum(y for y, _ in rows_), sum(1 - y for y, _ in rows_)
    best = 0
    for k in range(len(names)):
        for t in {v[k] for _, v in rows_}:
            for side in (lambda x: x >= t, lambda x: x < t):
                p = sum(y for y, v in rows_ if side(v[k]))
                g = sum(1 - y for y, v in rows_ if side(v[k]))
                if p + g:
                    best = max(best, quality_rules.gain(p, g, poor, good))
    return best


def test_learned_list(spark):
    """Two kinds of poor rows, one of which needs two conditions; noise in the rest."""
    rnd = random.Random(4)
    data = []
    for k in range(900):
        a, b, c = rnd.random(), rnd.random(), rnd.random()
        poor = a > 0.8 or (b < 0.3 and c > 0.6)
        data.append((int(poor), k % 3 > 0, a, b, c))
    df = spark.createDataFrame(data, "y int, grow boolean, a double, b double, c double")
    rules = quality_rules.learn(df, ["a", "b", "c"])
    assert 2 <= len(rules) <= 5
    hit = lambda r: any(all((r["abc".index(c.name) + 2] >= c.threshold) == c.at_least for c in rule.conditions) for rule in rules)
    assert sum(hit(r) == bool(r[0]) for r in data) >= 0.93 * len(data)
    assert sum(hit(r) and not r[0] for r in data) <= 0.05 * sum(r[0] for r in data)
    # the counts of covered rows are those of the rows that no earlier rule covers
    left = data
    for rule in rules:
        inside = [r for r in left if all((r["abc".index(c.name) + 2] >= c.threshold) == c.at_least for c in rule.conditions)]
        assert (rule.poor, rule.good) == (sum(r[0] for r in inside), sum(1 - r[0] for r in inside))
        left = [r for r in left if r not in inside]
    grow = [(r[0], r[2:]) for r in data if r[1]]
    poor, good = sum(y for y, _ in grow), sum(1 - y for y, _ in grow)
    first = [(y, v) for y, v in grow if (v["abc".index(rules[0].conditions[0].name)] >= rules[0].conditions[0].threshold) == rules[0].conditions[0].at_least]
    got = quality_rules.gain(sum(y for y, _ in first), sum(1 - y for y, _ in first), poor, good)
    assert got >= 0.9 * splits_by_hand(grow, "abc")  # bins may miss the very best value


def test_no_poor_rows_no_rules(spark, small):
    df = spark.createDataFrame([(0, True, 0.1), (0, False, 0.2)], "y int, grow boolean, a double")
    assert quality_rules.learn(df, ["a"]) == []
    assert quality_rules.learn(df.where("false"), ["a"]) == []
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert quality_rules.train(small["documents"], none) == []


def test_op11_is_native_and_ordered(spark, small):
    df = queries.op11_quality_rules(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rules = [quality_rules.Rule((quality_rules.Condition("word_length", True, 0.0),), 1, 0), quality_rules.Rule((quality_rules.Condition("word_length", False, 99.0),), 1, 0)]
    got = quality_rules.judged(small["documents"], rules).where("NOT base_failed").select("rule", "kept").distinct().collect()
    assert [tuple(r) for r in got] == [("word_length >= 0", False)]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_hand(docs):
    n = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def formed_by_hand(n):
    out = {}
    for w in n:
        others = [o for o in n if near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = (form, len(others), n[form] if form else None)
    res = []
    for w, (form, k, fn) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        res.append((w, form, root, n[w], k, fn))
    return sorted(res, key=repr)


def edited(rnd, w, letters):
    k, c = rnd.randrange(len(w) + 1), rnd.choice(letters)
    return rnd.choice([w[:k] + c + w[k:], w[:k] + w[k + 1 :], w[:k] + c + w[k + 1 :]])


@pytest.mark.parametrize("most", [2, 5, 128])
def test_near_pairs(spark, monkeypatch, most):
    """Words of two letters, so that blocks are crowded and are divided down to single letters."""
    rnd = random.Random(most)
    words = {"".join(rnd.choice("aé") for _ in range(rnd.randint(1, 9))) for _ in range(250)} | {"x" * 300, "x" * 299, "y" + "x" * 298}
    for w in rnd.sample(sorted(words), 80):
        words.add(edited(rnd, w, "aéb"))
    words -= {""}
    monkeypatch.setattr(spelling, "PAIRS", 500)
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    got = [frozenset((r["a"], r["b"])) for r in spelling.near_pairs(df, most).collect()]
    want = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    want = {p for p in want if min(map(len, p)) > 0}
    assert len(got) == len(set(got)) and set(got) == want


def test_spelling_chain(spark):
    """Forms that lead to forms, ties, and a letter that is lost."""
    texts = [("naïveté " * 900 + "naïvete " * 160 + "naivete " * 30 + "naivet " * 5 + "Naivetx " * 5 + "stoneB " * 25 + "stonea " * 25 + "stonec " * 5)] * 2
    docs = spark.createDataFrame([(None, texts[0], "x", "y"), (7, texts[1], "x", "y"), (8, None, "x", "y")], "doc_id long, text string, word string, n string")
    got = sorted(map(tuple, spelling.variants(docs).collect()), key=repr)
    assert got == formed_by_hand(variants_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()]))
    by = {r[0]: r for r in got}
    assert by["naivet"][1:3] == ("naivete", "naïveté") and by["stonec"][1] == "stonea"


def test_op12(spark, small, odd, empty):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.op12_spelling_variants(spark, SMALL)
    want = con.sql(queries.oracle_sql()["op12_spelling_variants"])
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)
    for docs in (small["documents"], odd):
        n = variants_by_hand([(r["doc_id"], r["text"]) for r in docs.collect()])
        assert sorted(map(tuple, spelling.variants(docs).collect()), key=repr) == formed_by_hand(n)
    assert spelling.variants(empty).count() == 0


def phrases_by_hand(docs, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", t):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in f.items():
        some = {p: a for p, a in c.items() if a >= least}
        best = []
        for p, a in some.items():
            if len(p) < 2 or any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in some.items()):
                continue
            score, k = min((1000 * a * n[lang] // (some[p[:k]] * some[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p), some[p[:k]], some[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top]):
            out.append((lang, rank + 1, p, -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("least, shard, ranged", [(2, 50, 20), (4, 1 << 21, 100_000)])
def test_collocations(spark, odd, monkeypatch, least, shard, ranged):
    rnd = random.Random(least)
    words = ["a", "b", "the", "$x", "-", "\x01", "a\x01", "é", "A", "\xa0"]
    texts = [(rnd.choice(["en", "de", None]), "".join(rnd.choice(words) + rnd.choice([" ", "  ", "\t", " ", " ", ". ", "\n"]) for _ in range(rnd.randint(0, 60)))) for _ in range(120)]
    texts += [("en", ""), ("fr", None), ("en", "of the of the of the, of the")]
    monkeypatch.setattr(collocations, "LEAST", least)
    monkeypatch.setattr(collocations.merged, "__defaults__", (least,))
    monkeypatch.setattr(collocations.shards, "__defaults__", ("text", "lang", shard))
    monkeypatch.setattr(collocations.walked, "__defaults__", (ranged,))
    monkeypatch.setattr(collocations, "RANGES_A_TASK", 1 if ranged > 100 else 40)
    docs = spark.createDataFrame([(i, lang, t, "x", "y") for i, (lang, t) in enumerate(texts)], "doc_id long, lang string, text string, phrase string, rank string")
    assert sorted(map(tuple, collocations.collocations(docs, top=30).collect())) == phrases_by_hand(texts, least, 30)
    if shard == 50:
        some = [(r["lang"], r["text"]) for r in odd.collect()]
        assert sorted(map(tuple, collocations.collocations(odd).collect())) == phrases_by_hand(some, least, 2000)


def test_op13(spark, empty):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    df = queries.op13_collocations(spark, SMALL)
    want = con.sql(queries.oracle_sql()["op13_collocations"])
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)
    assert collocations.collocations(empty).count() == 0


def test_prefix_ranges(spark):
    """Bounds are in order, a very common word is cut, and ranges have about equal weight."""
    rows_ = [("en", f"w{k:03d}", 100 + k) for k in range(300)] + [("en", "the", 40_000), ("de", "und", 20_000)]
    words = spark.createDataFrame(rows_, "lang string, phrase string, f long")
    bounds = collocations.prefix_ranges(words, 20)
    assert bounds == sorted(set(bounds)) and sum(b[1] == "the" and b[2] > "" for b in bounds) >= 4
    weight = Counter()
    for lang, w, f in rows_:
        mine = [x for x in rows_ if x[0] == lang]
        for _, w2, f2 in mine:  # pairs as if words were independent
            weight[sum(b <= (lang, w, w2) for b in bounds)] += f * f2 / sum(x[2] for x in mine)
    assert max(weight.values()) <= 3 * sum(weight.values()) / 20
    assert collocations.prefix_ranges(words.where("false"), 20) == []


def test_products_beyond_64_bits(spark):
    """The score of a cut whose products pass 64 bits is exact."""
    from pyspark.sql import functions as F

    a, n, left, right = 10**13 + 7, 10**15 + 1, 3 * 10**13, 5 * 10**13 + 3
    df = spark.range(1).select(F.lit(a).alias("a"), F.lit(n).alias("n"), F.array(F.lit(left)).alias("ls"), F.array(F.lit(right)).alias("rs"))
    assert df.select(collocations.weakest_cut()["score"]).first()[0] == 1000 * a * n // (left * right)


def test_bit_map(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 3000, 3)
    bits = collocations.BitMap(df, F.crc32(F.col("id").cast("string").cast("binary")))
    h = collocations.np.array([zlib.crc32(str(k).encode()) for k in range(3000)])
    assert bits.has(h[::3]).all() and bits.has(h).sum() < 1200
