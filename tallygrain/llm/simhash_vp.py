"""SimHash near-duplicates, found exactly with vantage-point trees.

Fingerprints of 64 bits are linked if at most `radius` bits differ. A tree is built from a bounded
sample of them: an inner node has a vantage point, and its children are rings of distances to it. Every
distinct fingerprint belongs to the shard (leaf) that its distances lead to, and asks the shards
beyond a ring's boundary that the triangle inequality leaves: one flipped bit moves every distance
by exactly one, two flipped bits move it by two or not at all. Of two fingerprints that part ways at
a node the one in the lower ring asks, so a pair meets once. A radius above two has a tree for each of
several bands of bits: of `radius` flipped bits, some band has at most radius // bands. Each shard
searches its own rows with rings of its own and gives back a spanning forest of the links, never all
pairs; a shard with too many owners is a grid of tasks.

`near_duplicates` links fingerprints of three-word shingles at two bits. `one_of_each` links texts
with a Jaccard similarity of SIMILAR of their sets of five-word shingles. Of two such sets in one
order, each has a shingle of the other among its first (1 - SIMILAR) n + 1, so texts meet by those, rare
ones first; where many meet, rings around vantage points and fingerprints of the shingles leave out
what is far, and the sets themselves decide.

Copies are one row in the search. Components come from rounds of star contraction, each written to
the shared folder; neither links nor fingerprints of all documents reach the driver.

Edge cases: a null or empty text, or one of white space alone, has the fingerprint zero and is
linked like any other; with fewer words than a shingle has, the whole text is one; a null id takes
part in the links, but names a component only by null if no other id is there; repeated rows give
repeated rows in `near_duplicates`, while `one_of_each` keeps one row of a class whatever its ids
(the smallest id, null last, then by the text's MD5); an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import BROADCAST_KEYS, left_out, materialise, small_batches, unused

SEED, SHINGLE, RADIUS = 42, 3, 2
#: Of `one_of_each`: words of a shingle, least similarity, bits beyond which fingerprints of word sets and
#: of shingles rule a pair out; 64 rules none out.
WORDS, SIMILAR, NEAR, FAR = 5, 0.8, 64, 18
#: First shingles that a bucket should have, texts that are sampled for shingles to put last, and how many
#: of those texts have such a shingle; most members of a shingle that are compared at once.
BUCKET, COMMON_SAMPLE, COMMON, CROWD = 1 << 15, 4_096, 8, 64
#: Fingerprints that a shard should own, most that a task owns, and fingerprints of which a tree is built.
SHARD, MOST, SAMPLE = 512, 50_000, 1 << 16
#: Hashes or comparisons that are held at once.
HELD = 1 << 18
#: Texts and shingles of a task that compares sets.
CELL_TEXTS, CELL_SHINGLES = 4_096, 1_000_000
#: Rows of one key from which a join meets that key by broadcast; at most rows / HOT keys are so many.
HOT = 200_000
OWN = 4


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], n: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a whole text, in blocks."""
    if not words:
        return
    size = np.fromiter(map(len, words), np.int64, len(words))
    whole = b" ".join(words)
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    n = min(n, len(words))
    start, stop = start[: len(words) - n + 1], stop[n - 1 :]
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(start), HELD):
        pairs = zip(start[k : k + HELD].tolist(), stop[k : k + HELD].tolist(), strict=True)
        yield np.array([digest(whole[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprints(texts: list[str | None]) -> np.ndarray:
    """A bit is 1 if more than half of the hashes have it."""
    ones, total = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held: list[np.ndarray] = []
    owner: list[int] = []

    def flush() -> None:
        if held:
            bits = np.unpackbits(np.concatenate(held).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            size = np.fromiter(map(len, held), np.int64, len(held))
            np.add.at(ones, owner, np.add.reduceat(bits, np.cumsum(size) - size, axis=0, dtype=np.int32))
        held.clear()
        owner.clear()

    n = 0
    for k, t in enumerate(texts):
        for h in shingle_hashes(words_of(t)):
            held.append(h)
            owner.append(k)
            total[k] += len(h)
            n += len(h)
            if n >= HELD:
                flush()
                n = 0
    flush()
    bits = (2 * ones > total[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).reshape(-1)


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if more than half of the hashes have it; as a signed number."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), HELD):
        ones += np.unpackbits(hashes[k : k + HELD].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little").view(np.int64)[0])


def set_prints(text: str | None) -> tuple[int, int, bytes]:
    """Fingerprints of the sets of words and of WORDS-word shingles, and the latter's hashes in order."""
    words = words_of(text)
    each = np.concatenate([*shingle_hashes(list(set(words)), 1), np.zeros(0, np.uint64)])
    hashes = np.unique(np.concatenate([*shingle_hashes(words, WORDS), np.zeros(0, np.uint64)]))
    return majority(each), majority(hashes), hashes.tobytes()


def sets_of(text: Column) -> Column:
    """Column struct: fp of the words, second of the shingles, and the shingles' hashes."""

    @F.pandas_udf("fp long, second long, shingles binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([set_prints(t) for t in texts.tolist()], columns=["fp", "second", "shingles"])

    return run(text)


def fingerprint(text: Column) -> Column:
    """Column: the fingerprint of a text as a long."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(fingerprints(texts.tolist()), dtype="int64")

    return run(text)


def distance(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)).astype(np.int64)


def band_of(fp: np.ndarray, k: int, bands: int) -> np.ndarray:
    """The bits of band k; bands are equally wide, but the last, which has what is left."""
    if bands == 1:
        return fp
    width = 64 // bands
    return (fp.view(np.uint64) >> np.uint64(k * width) & np.uint64((1 << (width if k < bands - 1 else 64 - k * width)) - 1)).view(np.int64)


class Tree:
    """Rings around vantage points. child[k][d] is the child of node k for distance d; a child below
    zero is leaf -1 - child."""

    def __init__(self, sample: np.ndarray, scale: float, shard: int = SHARD, depth: int = 12):
        self.vantage: list[int] = []
        self.child: list[np.ndarray] = []
        self.owners: list[float] = []  # expected in each leaf
        self.root = self._grow(np.sort(sample), scale, shard, depth)

    def _leaf(self, owners: float) -> int:
        self.owners.append(owners)
        return -len(self.owners)

    def _grow(self, fp: np.ndarray, scale: float, shard: int, depth: int) -> int:
        if len(fp) * scale <= shard or not depth or fp[0] == fp[-1]:
            return self._leaf(len(fp) * scale)
        v = fp[(len(fp) * 7919 + depth) % len(fp)]
        d = distance(fp, v)
        count = np.bincount(d, minlength=65) * scale
        if count.max() >= count.sum() * 0.95 and depth < 4:
            return self._leaf(count.sum())
        k = len(self.vantage)
        self.vantage.append(int(v))
        self.child.append(np.zeros(65, np.int64))
        low = 0
        while low <= 64:  # a ring is one distance, or several as long as they fit into one shard
            high, held = low, count[low]
            while high < 64 and held + count[high + 1] <= shard:
                high += 1
                held += count[high]
            self.child[k][low : high + 1] = self._grow(fp[(d >= low) & (d <= high)], scale, shard, depth - 1)
            low = high + 1
        return k

    def route(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Leaf, position in fp and whether it owns, for every shard that a fingerprint goes to."""
        leaf, place, own = [], [], []
        todo = [(self.root, np.arange(len(fp)), OWN)]
        while todo:
            node, at, state = todo.pop()
            if node < 0:
                leaf.append(np.full(len(at), -1 - node))
                place.append(at)
                own.append(np.full(len(at), state == OWN))
                continue
            d, child = distance(fp[at], self.vantage[node]), self.child[node]
            mine = child[d]
            if state == OWN:
                moves = [(1, 1), (2, 2)]
            else:
                moves = [(1, -1), (1, 1)] if state == 1 else [(2, -2), (2, 0), (2, 2)]
            goes: dict[tuple[int, int], list[np.ndarray]] = {}
            if state == OWN:
                for c in np.unique(mine).tolist():
                    goes[c, OWN] = [at[mine == c]]
            for flips, step in moves:
                to = d + step
                ok = (to >= 0) & (to <= 64)
                c = child[np.clip(to, 0, 64)]
                if state == OWN:
                    ok &= c != mine
                for x in np.unique(c[ok]).tolist():
                    goes.setdefault((x, flips), []).append(at[ok & (c == x)])
            todo += [(c, np.unique(np.concatenate(x)) if len(x) > 1 else x[0], s) for (c, s), x in goes.items()]
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        return cat(leaf, np.int64), cat(place, np.int64), cat(own, bool)


def close_pairs(metrics: list[tuple[np.ndarray, int]], asks: np.ndarray, owns: np.ndarray, depth: int = 12) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of asks and owners that are within the reach of the last metric, as they are in
    the reach of each: rings around one of the owners, then blocks of XOR."""
    if not len(asks) or not len(owns):
        return
    if depth and len(owns) > 64 and len(asks) * len(owns) > HELD:
        for value, reach in metrics:
            v = value[owns[len(owns) // 2]]
            do = distance(value[owns], v)
            if do[0] != do[-1] or len(np.unique(do)) > 1:
                da = distance(value[asks], v)
                for k in np.unique(do).tolist():
                    yield from close_pairs(metrics, asks[np.abs(da - k) <= reach], owns[do == k], depth - 1)
                return
    value, reach = metrics[-1]
    step = max(1, HELD // len(owns))
    for k in range(0, len(asks), step):
        a, b = np.nonzero(distance(value[asks[k : k + step], None], value[owns][None, :]) <= reach)
        if len(a):
            yield asks[k + a], owns[b]


class Forest:
    """Classes of n things: every label is the least of its class."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            p, q = self.label[a], self.label[b]
            apart = p != q
            if not apart.any():
                return
            a, b, p, q = a[apart], b[apart], p[apart], q[apart]
            np.minimum.at(self.label, np.maximum(p, q), np.minimum(p, q))
            while (after := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = after

    def edges(self, names: np.ndarray) -> pd.DataFrame:
        some = np.flatnonzero(self.label != np.arange(len(self.label)))
        return pd.DataFrame({"a": names[some], "b": names[self.label[some]]})


#: What a row is to its task: a question, an owner, or both.
ASKS, OWNS, BOTH = 0, 1, 2


def dealt(leaf: np.ndarray, own: np.ndarray, fp: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place, leaf, row and column of a task and the part in it. A leaf is a grid of side x side tasks;
    a task has a share of the owners and a share of the questions, so that each pair meets once."""
    g = side[leaf]
    at = np.flatnonzero(g == 1)
    zero = np.zeros(len(at), np.int64)
    out = [(at, leaf[at], zero, zero, np.where(own[at], BOTH, ASKS))]
    h = (fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    for some, part in ((np.flatnonzero((g > 1) & own), OWNS), (np.flatnonzero(g > 1), ASKS)):
        n = g[some]
        at = np.repeat(some, n)
        each = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
        share = (h[at] % g[at].astype(np.uint64)).astype(np.int64)
        row, column = (share, each) if part == OWNS else (each, share)
        out.append((at, leaf[at], row, column, np.full(len(at), part)))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def links(distinct: DataFrame, radius: int = RADIUS, bands: int = 1, also: int | None = None, shard: int = SHARD, sample: int = SAMPLE, most: int = MOST) -> DataFrame:
    """(a, b): links that join the same fingerprints as all pairs within radius do. distinct: fp; with
    `also`, second too, and only rows whose seconds differ in at most so many bits are linked."""
    if radius // bands > 2:
        raise ValueError("a band must be searched within two bits at most")
    spark, names = distinct.sparkSession, ["fp"] if also is None else ["fp", "second"]
    n = distinct.count()
    some = distinct.select(names).orderBy(F.xxhash64(*names), *names).limit(sample)
    fp = np.array([r[0] for r in some.collect()], np.int64)
    trees = [Tree(band_of(fp, k, bands), n / max(len(fp), 1), shard) for k in range(bands)]
    first = np.r_[0, np.cumsum([len(t.owners) for t in trees])].tolist()
    side = np.ceil(np.maximum(np.concatenate([t.owners for t in trees]) / most, 1)).astype(np.int64)
    shared = spark.sparkContext.broadcast(trees)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def out(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            fp = rows["fp"].to_numpy(np.int64)
            for k, tree in enumerate(shared.value):
                leaf, at, own = tree.route(band_of(fp, k, bands))
                place, leaf, row, column, part = dealt(leaf + first[k], own, fp[at], side)
                yield rows.iloc[at[place]].assign(leaf=leaf.astype(np.int32), r=row.astype(np.int32), c=column.astype(np.int32), part=part.astype(np.int8), band=np.int8(k))

        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(map(len, held)) >= HELD // 16:
                yield from out(pd.concat(held))
                held = []
        if held:
            yield from out(pd.concat(held))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part", ascending=False).drop_duplicates([*names, "part"] if (pdf["part"] == OWNS).any() else names)
        fp, part = pdf["fp"].to_numpy(np.int64), pdf["part"].to_numpy()
        metrics = [(band_of(fp, int(pdf["band"].iloc[0]), bands), radius // bands), (fp, radius)] if bands > 1 else [(fp, radius)]
        name, place = np.unique(fp, return_inverse=True)
        found = Forest(len(name))
        for a, b in close_pairs(metrics, np.flatnonzero(part != OWNS), np.flatnonzero(part != ASKS)):
            if also is not None:
                second = pdf["second"].to_numpy(np.int64)
                ok = distance(second[a], second[b]) <= also
                a, b = a[ok], b[ok]
            found.join(place[a], place[b])
        return found.edges(name)

    kinds = ", ".join(f"{c} long" for c in names) + ", leaf int, r int, c int, part byte, band byte"
    sent = distinct.select(names).mapInPandas(route, kinds)
    return sent.groupBy("leaf", "r", "c").applyInPandas(search, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for all nodes of edges (a, b) but roots.

    Alternating stars: every node's larger neighbours move to its smallest neighbour, then its
    smaller ones, until nothing moves. The number of rounds grows with the logarithm of a
    component's size; every round is written."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n")))
        large = materialise(with_hot_keys(both, low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")))
        moved = with_hot_keys(large, low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(low.select("a", F.col("m").alias("b")).unionByName(moved).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now


def with_hot_keys(rows: DataFrame, facts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """rows joined with facts, unique by key, whose column n counts the key's rows. Keys of more than
    HOT rows, of which there are few, are broadcast, so no task gets all rows of one key."""
    hot = F.broadcast(facts.where(F.col(n) > HOT))
    often = rows.join(hot, key)
    return often.unionByName(rows.join(F.broadcast(facts.where(F.col(n) > HOT).select(key)), key, "left_anti").join(facts.where(F.col(n) <= HOT), key))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id that links reach),
    a row for each row of docs."""
    small_batches(docs.sparkSession)
    prints = materialise(docs.select(F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col)).alias("fp")))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n"))
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "n", "least_id", F.coalesce("root", "fp").alias("root"))
    rooted = materialise(rooted)
    named = materialise(rooted.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("size")))
    by_fp = materialise(with_hot_keys(rooted, named, "root", "size").select("fp", "n", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return with_hot_keys(prints, by_fp, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def similar_in_cell(pdf: pd.DataFrame, far: int = FAR) -> pd.DataFrame:
    """Links (a, b) between questions and owners (t, second, shingles, part) of one task whose sets are
    similar. Sets meet as rows of bits, over a block of shingles at a time; pairs already joined are passed over."""
    pdf = pdf.sort_values(["t", "part"], ascending=[True, False]).drop_duplicates(["t", "part"] if (pdf["part"] == OWNS).any() else ["t"])
    name, place = np.unique(pdf["t"].to_numpy(object), return_inverse=True)
    second, part = pdf["second"].to_numpy(np.int64), pdf["part"].to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    row = np.repeat(np.arange(len(sets)), size)
    _, col, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    number = np.cumsum(often > 1) - 1
    shared = often[col] > 1
    row, col = row[shared], number[col[shared]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both, width = np.zeros(len(a), np.int64), 4096
        for low in range(0, int(col[-1]) + 1 if len(col) else 0, width):
            i, j = np.searchsorted(col, (low, low + width))
            bits = np.zeros((len(sets), width // 8), np.uint8)
            np.bitwise_or.at(bits, (row[i:j], (col[i:j] - low) >> 3), (1 << ((col[i:j] - low) & 7)).astype(np.uint8))
            words = bits.view(np.uint64)
            for k in range(0, len(a), 8192):
                both[k : k + 8192] += np.bitwise_count(words[a[k : k + 8192]] & words[b[k : k + 8192]]).sum(1, dtype=np.int64)
        return both

    found, asks, owns = Forest(len(name)), np.flatnonzero(part != OWNS), np.flatnonzero(part != ASKS)
    step = max(1, HELD // max(1, len(owns)))
    for k in range(0, len(asks), step):
        some = asks[k : k + step, None]
        fit = (found.label[place[some]] != found.label[place[owns]]) & (distance(second[some], second[owns][None, :]) <= far)
        fit &= np.minimum(size[some], size[owns]) >= SIMILAR * np.maximum(size[some], size[owns])
        a, b = np.nonzero(fit)
        a, b = asks[k + a], owns[b]
        both = common(a, b)
        ok = both >= SIMILAR * (size[a] + size[b] - both)  # two empty sets are alike
        found.join(place[a[ok]], place[b[ok]])
    return found.edges(name)


def firsts(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Of a set's shingles, common ones last, those that a similar set shares one of; of no shingles, zero."""
    if not len(shingles):
        return np.zeros(1, np.uint64)
    at = np.minimum(np.searchsorted(common, shingles), max(len(common) - 1, 0))
    last = common[at] == shingles if len(common) else np.zeros(len(shingles), bool)
    n = len(shingles) - int(np.ceil(SIMILAR * len(shingles) - 1e-9)) + 1
    return np.concatenate([shingles[~last], shingles[last]])[:n]


def common_shingles(prints: DataFrame, texts: int) -> np.ndarray:
    """Shingles of many texts of a sample of about COMMON_SAMPLE, in order. Which they are changes what a search
    costs, not what it finds."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sets = [np.frombuffer(x, np.int64) for x in pdf["shingles"]]
            yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(np.int64), [len(x) for x in sets]), "first": np.concatenate([np.zeros(0, np.int64), *sets])})

    some = prints.select(F.xxhash64("t").alias("id"), "shingles").where(F.pmod("id", F.lit(max(1, texts // COMMON_SAMPLE))) == 0)
    often = some.mapInPandas(run, "id long, first long").groupBy("first").agg(F.countDistinct("id").alias("n")).where(F.col("n") >= COMMON)
    return np.sort(np.array([r["first"] for r in often.orderBy(F.desc("n"), "first").limit(1 << 16).collect()], np.int64).view(np.uint64))


def join_crowd(found: Forest, place: np.ndarray, second: np.ndarray, at: np.ndarray, far: int, fit: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> None:
    """Joins what is linked among `at`, many members of one shingle. Some of them are compared with all; what that
    leaves outside the largest class is compared with all by rings."""
    rest = at
    for _ in range(8):
        if not len(rest):
            return
        hub = np.full(len(at), rest[len(rest) // 2])
        ok = (distance(second[hub], second[at]) <= far) & fit(hub, at)
        found.join(place[hub[ok]], place[at[ok]])
        rest = rest[(found.label[place[rest]] != found.label[place[hub[0]]]) & (rest != hub[0])]
    label = found.label[place[at]]
    kinds, n = np.unique(label, return_counts=True)
    for a, b in close_pairs([(second, far)], at[label != kinds[n.argmax()]], at):
        ok = fit(a, b)
        found.join(place[a[ok]], place[b[ok]])


def alike_in_bucket(pdf: pd.DataFrame, near: int = NEAR, far: int = FAR) -> pd.DataFrame:
    """Links (a, b) between texts (id, first, fp, second, n) that share a first shingle and that neither their
    fingerprints nor their numbers of shingles rule out, as a spanning forest."""
    pdf = pdf.drop_duplicates(["first", "id"]).sort_values(["first", "second"])
    first, fp, second, n = (pdf[c].to_numpy(np.int64) for c in ("first", "fp", "second", "n"))
    name, place = np.unique(pdf["id"].to_numpy(np.int64), return_inverse=True)
    start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
    size = np.diff(np.r_[start, len(first)])
    crowd = np.repeat(size > CROWD, size)
    found = Forest(len(name))

    def fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (distance(fp[a], fp[b]) <= near) & (np.minimum(n[a], n[b]) >= SIMILAR * np.maximum(n[a], n[b]))

    for k in range(1, min(int(size.max()), CROWD)):
        a = np.flatnonzero((first[k:] == first[:-k]) & ~crowd[k:])
        a = a[(distance(second[a], second[a + k]) <= far) & fit(a, a + k)]
        found.join(place[a], place[a + k])
    for k in np.flatnonzero(size > CROWD).tolist():
        join_crowd(found, place, second, np.arange(start[k], start[k] + size[k]), far, fit)
    return found.edges(name)


def alike(prints: DataFrame, texts: DataFrame, near: int = NEAR, far: int = FAR) -> DataFrame:
    """(a, b): links between texts, named by the XXH64 of t, that hold all similar pairs within near and far bits
    together. Each text goes to the buckets of its first shingles, so rows grow with the texts alone."""
    shingles = F.col("shingles")
    n, rows = texts.agg(F.count("*"), F.sum(F.floor(shingles * (1 - SIMILAR)) + 1)).first()
    buckets = max(1, (rows or 0) // BUCKET)
    common = prints.sparkSession.sparkContext.broadcast(common_shingles(prints, n))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf = pdf.drop_duplicates("id")
            sets = [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
            goes = [firsts(x, common.value) for x in sets]
            out = pdf.drop(columns="shingles").assign(n=[len(x) for x in sets])
            first = np.concatenate([np.zeros(0, np.uint64), *goes])
            bucket = ((first & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)).astype(np.int32)
            yield out.iloc[np.repeat(np.arange(len(out)), [len(x) for x in goes])].assign(first=first.view(np.int64), bucket=bucket)

    sent = prints.select(F.xxhash64("t").alias("id"), "fp", "second", "shingles").mapInPandas(route, "id long, fp long, second long, n long, first long, bucket int")
    return sent.groupBy("bucket").applyInPandas(lambda pdf: alike_in_bucket(pdf, near, far), "a long, b long").distinct()


def similar_texts(prints: DataFrame, texts: DataFrame, near: int = NEAR, far: int = FAR) -> DataFrame:
    """(node, root) of texts t that similarity joins. prints: key, t, fp, second, shingles; texts: a row for
    each t with one of its keys and the number of shingles."""
    rough = components(alike(prints, texts, near, far))
    rooted = materialise(texts.withColumn("id", F.xxhash64("t")).join(rough, F.col("id") == F.col("node"), "left").select("key", "shingles", F.coalesce("root", "id").alias("root")))
    held = rooted.groupBy("root").agg(F.count("*").alias("n"), F.sum("shingles").alias("s")).where("n > 1")
    side = F.greatest(F.ceil(F.col("n") / CELL_TEXTS), F.ceil(F.col("s") / CELL_SHINGLES)).cast("int")
    many = materialise(rooted.join(held.select("root", side.alias("side")), "root").select("key", "root", "side"))
    few = many.count() <= BROADCAST_KEYS
    sets = prints.select("key", "t", "second", "shingles").join(F.broadcast(many) if few else many, "key")
    h = F.pmod(F.xxhash64("t"), F.col("side")).cast("int")
    each = F.sequence(F.lit(0), F.col("side") - 1)
    cell = lambda r, c, part: F.struct(r.cast("int").alias("r"), c.cast("int").alias("c"), F.lit(part).alias("part"))
    whole = F.array(cell(F.lit(0), F.lit(0), BOTH))
    grid = F.concat(F.transform(each, lambda k: cell(h, k, OWNS)), F.transform(each, lambda k: cell(k, h, ASKS)))
    dealt_out = sets.select("root", "t", "second", "shingles", F.explode(F.when(F.col("side") == 1, whole).otherwise(grid)).alias("x")).select("root", "t", "second", "shingles", "x.*")
    return components(dealt_out.groupBy("root", "r", "c").applyInPandas(lambda pdf: similar_in_cell(pdf, far), "a string, b string").distinct())


def one_of_each(docs: DataFrame, near: int = NEAR, far: int = FAR) -> DataFrame:
    """One row, with all its columns, of each class of similar texts: that with the smallest id. Pairs
    whose fingerprints differ in more than `near` (words) or `far` (shingles) bits are not looked at."""
    small_batches(docs.sparkSession)
    digest = F.md5(F.coalesce(F.col("text"), F.lit("")))
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), digest)
    prints = materialise(docs.select("doc_id", key.alias("key"), digest.alias("t"), sets_of(F.col("text")).alias("p")).select("doc_id", "key", "t", "p.*"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    texts = prints.groupBy("t").agg(F.min(order).alias("least"), F.count("*").alias("n"), F.min(F.octet_length("shingles") / 8).cast("long").alias("shingles"))
    texts = materialise(texts)
    alike = similar_texts(prints, texts.select("t", "least.key", "shingles"), near, far)
    classed = materialise(texts.join(alike, F.col("t") == F.col("node"), "left").select("t", "n", "least", F.coalesce("root", "t").alias("class")))
    best = materialise(classed.groupBy("class").agg(F.min("least").alias("best"), F.count("*").alias("size")))
    kept = materialise(with_hot_keys(classed, best, "class", "size").select("t", "n", F.col("best.key").alias("best")))
    gone = with_hot_keys(prints.select("t", "key"), kept.where("n > 1 OR NOT endswith(best, t)"), "t").where("key <> best").select("key")
    rows = left_out(docs, key, gone)
    again = materialise(prints.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    if not again.count():
        return rows
    own, other = unused(docs, "_key"), unused(docs, "_again")
    once = rows.withColumn(own, key).join(again.withColumnRenamed("key", other), F.col(own) == F.col(other), "left_semi").dropDuplicates([own])
    return left_out(rows, key, again).union(once.drop(own))
