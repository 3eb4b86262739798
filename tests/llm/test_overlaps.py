"""Near-duplicates and benchmark passages against brute force."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from test_llm import kept_by_hand, shingle_set

from tallygrain.llm import decontam, simhash_vp


def overlaps_by_hand(text, item):
    """(first_token, n_overlaps, equal_tokens) over all windows and all places, or None; no seeds."""
    t, b, over = text.split(), item.split(), {}
    n = min(len(b), decontam.WINDOW)
    for s in range(len(b) - n + 1):
        for at in range(1 - n, len(t)):
            e = sum(0 <= at + k < len(t) and t[at + k] == b[s + k] for k in range(n))
            if e >= math.ceil(n * decontam.SHARE):
                over[at] = max(e, over.get(at, 0))
    return (min(over), len(over), max(over.values())) if over else None


@pytest.mark.parametrize("held", [decontam.WINDOWS_HELD, 0])
def test_no_overlap_is_lost(spark, monkeypatch, held):
    """Items of 3 to 20 tokens whole, cut at an end, or with tokens replaced at any places, near the ends of texts too."""
    monkeypatch.setattr(decontam, "WINDOWS_HELD", held)
    monkeypatch.setattr(decontam, "SEEDS_HELD", 3_000)
    rnd, items, texts = random.Random(5), [], []
    for k in range(720):
        n = 3 + k % 18
        item = [f"i{k}w{x}" for x in range(n)]
        text = item[rnd.randint(0, 1) :]
        for x in rnd.sample(range(len(text)), min(len(text) - 1, rnd.randint(0, 3))):
            text[x] = "other"
        items.append((k, " ".join(item)))
        texts.append((k, " ".join(["before"] * rnd.randint(0, 3) + text + ["after"] * rnd.randint(0, 3))))
    want = {(k, k, *w) for (k, t), (_, b) in zip(texts, items, strict=True) if (w := overlaps_by_hand(t, b))}
    got = decontam.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 250


def test_repeated_and_null_item_ids(spark):
    """Rows of one item_id are compared each by itself."""
    a, b = [f"a{k}" for k in range(9)], [f"b{k}" for k in range(20)]
    texts = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b)), (None, " ".join(b)), (3, "nothing of it at all")], "doc_id long, text string")
    for i in (7, None):
        items = spark.createDataFrame([(i, " ".join(a)), (i, " ".join(b)), (i, " ".join(b))], "item_id long, text string")
        got = {(r["doc_id"], r["item_id"], r["equal_tokens"]) for r in decontam.contaminated(texts, items).collect()}
        assert got == {(1, i, 9), (2, i, 13), (None, i, 13)}
        assert [r["doc_id"] for r in decontam.without_leaks(texts, items).collect()] == [3]


def edited(rnd, words, n):
    out = list(words)
    for k in rnd.sample(range(len(out)), n):
        out[k] = f"new{rnd.randint(0, 10**9)}"
    return out


@pytest.fixture(scope="module")
def corpus():
    """Clusters of copies with few to many edits, free texts, and short ones."""
    rnd = random.Random(9)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(12):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(60, 300))]
        texts += [" ".join(edited(rnd, base, rnd.choice((0, 1, 2, 3, 4, 8, 20)))) for _ in range(9)]
    texts += [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(40, 200))) for _ in range(80)]
    return dict(enumerate([*texts, "one", "one", "one two", "One Two", "", " ", "one two three four five six"]))


@pytest.mark.parametrize("cell", [simhash_vp.CELL_TEXTS, 3])
def test_one_of_each(spark, corpus, monkeypatch, cell):
    """Exactly the classes of all pairs, in whole cells and dealt out over a grid of tasks."""
    monkeypatch.setattr(simhash_vp, "CELL_TEXTS", cell)
    docs = spark.createDataFrame(list(corpus.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in simhash_vp.one_of_each(docs).collect()} == kept_by_hand(corpus)


def test_one_row_of_each_class(spark):
    """Repeated rows, repeated ids and null ids."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(5, long, "a"), (5, long, "b"), (None, long, "c"), (4, long + " end", "d"), (None, "no id here", "e"), (None, "no id here", "f"), (8, "other words", "g"), (8, "still other words", "h"), (9, None, "i"), (10, "", "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = simhash_vp.one_of_each(docs)
    assert got.columns == docs.columns
    left = sorted((r["key"] for r in got.collect()))
    assert len(left) == 5 and left[0] == "d" and left[1] in "ef" and left[2:] == ["g", "h", "i"]


def test_grid_of_a_shard(spark):
    """A shard of many owners, dealt out over tasks, has the same classes."""
    rnd = random.Random(2)
    fps = list({c ^ (1 << rnd.randint(0, 63)) ^ (1 << rnd.randint(0, 63)) for c in [rnd.getrandbits(64) for _ in range(20)] for _ in range(30)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    at = lambda **k: {(r["node"], r["root"]) for r in simhash_vp.components(simhash_vp.links(df, **k)).collect()}
    assert at(shard=10_000, most=20) == at() and at()


def test_bands_lose_no_pair(spark):
    """Radius 8 over three bands: classes equal those of all pairs."""
    rnd = random.Random(3)
    centres = [rnd.getrandbits(64) for _ in range(40)]
    fps = sorted({c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 9))) for c in centres for _ in range(12)})
    label = simhash_vp.Forest(len(fps))
    a, b = map(np.array, zip(*[(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 8], strict=True))
    label.join(a, b)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = {r["node"]: r["root"] for r in simhash_vp.components(simhash_vp.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 8, 3, shard=8, sample=300)).collect()}
    pairs = {(int(k), got.get(s, s)) for k, s in zip(label.label, signed, strict=True)}
    assert len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs}) < len(fps)


def test_similar_in_cell_by_hand():
    rnd = random.Random(8)
    base = [f"w{k}" for k in range(80)]
    texts = [" ".join(edited(rnd, base, rnd.randint(0, 6))) for _ in range(40)]
    rows = [(f"{k:03d}", *simhash_vp.set_prints(t)[1:], simhash_vp.BOTH) for k, t in enumerate(texts)]
    got = simhash_vp.similar_in_cell(pd.DataFrame(rows, columns=["t", "second", "shingles", "part"]))
    up = dict(zip(got["a"], got["b"], strict=True))
    of = lambda k: up.get(f"{k:03d}", f"{k:03d}")
    least = kept_by_hand(dict(enumerate(texts)))
    assert len({of(k) for k in range(40)}) == len(least) and len(shingle_set(texts[0])) == 76


def test_similar_sets_share_a_first_shingle():
    rnd = np.random.default_rng(5)
    for size in (1, 4, 5, 9, 60, 300):
        a = rnd.integers(0, 1 << 63, size, dtype=np.uint64)
        for lost in range(size // 5 + 1):
            for more in (0, 1, size // 4 - lost):
                b = np.concatenate([a[lost:], rnd.integers(0, 1 << 63, max(more, 0), dtype=np.uint64)])
                common = np.sort(np.concatenate([rnd.choice(a, size // 3), rnd.integers(0, 1 << 63, 5, dtype=np.uint64)]))
                if len(np.intersect1d(a, b)) >= simhash_vp.SIMILAR * len(np.union1d(a, b)):
                    for c in (common, common[:0]):
                        assert len(np.intersect1d(simhash_vp.firsts(np.sort(a), c), simhash_vp.firsts(np.sort(b), c)))
        assert len(simhash_vp.firsts(a, a[:0])) <= size / 5 + 1  # rows grow with the text alone


def test_few_words_in_many_orders(spark):
    """Sets of few words lie far apart after one edit, while the texts are similar."""
    rnd = random.Random(4)
    base = [rnd.choice("abcdef") for _ in range(400)]
    rows = [(k, " ".join(edited(rnd, base, k))) for k in range(6)]
    far = [simhash_vp.set_prints(t)[0] ^ simhash_vp.set_prints(rows[0][1])[0] for _, t in rows]
    assert max((x & (1 << 64) - 1).bit_count() for x in far) > 8
    assert [r["doc_id"] for r in simhash_vp.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()] == [0]


def test_crowds_are_joined_as_all_pairs():
    """Many texts with one first shingle: the classes of all pairs."""
    rnd = random.Random(6)
    centres = [rnd.getrandbits(64) for _ in range(9)]
    second = [c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 12))) for c in centres for _ in range(40)]
    size = [rnd.choice((50, 60, 70, 90)) for _ in second]
    label = simhash_vp.Forest(len(second))
    near = [(i, j) for i in range(len(second)) for j in range(i) if (second[i] ^ second[j]).bit_count() <= 18 and min(size[i], size[j]) >= 0.8 * max(size[i], size[j])]
    label.join(*map(np.array, zip(*near, strict=True)))
    signed = [s - (1 << 64) if s >> 63 else s for s in second]
    got = simhash_vp.alike_in_bucket(pd.DataFrame({"id": range(len(second)), "fp": 0, "second": signed, "n": size, "first": 7}))
    up = dict(zip(got["a"], got["b"], strict=True))
    assert [up.get(k, k) for k in range(len(second))] == label.label.tolist() and 1 < len(set(label.label)) < len(second)
