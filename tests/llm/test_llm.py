"""The training-data operators against libraries, brute force and SQL."""

import gc
import hashlib
import random
import re
import struct
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallygrain.llm import bpe_codec, decontam, hashed_words, ogg_media, quality_fm, queries, sharding, simhash_vp, token_counts, token_files, toxicity, url_filter
from tallygrain.llm.common import held_out
from tallygrain.llm.pretokens import Kept

SMALL = "/root/testdata/sf0.001"
BYTES, WORDS = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("word_bpe_49k.json")
PIECES = ["a", "aa", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "漢字", "1", "23", "!!", "...", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "\u3000", "\u0301", "😀", "the", "aaaaaaa", "İ", "Σ", "ΑΣ", "\xa0", "\x00", "²", " the,", " of."]


def noise(n):
    rnd = random.Random(3)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(n)] + ["", None]


def by_id(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_counts_of_noise():
    t, texts = Tokenizer.from_file(BYTES), noise(3000)
    assert token_counts.count_batch(pa.array(texts), BYTES).tolist() == [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_long_text_in_blocks(monkeypatch):
    from tallygrain.llm import pretokens

    text = " ".join(noise(2000)[:-2]) + "  end"
    monkeypatch.setattr(pretokens, "BLOCK", 500)
    monkeypatch.setattr(pretokens.blocks, "__defaults__", (500,))
    assert len(list(pretokens.blocks(text))) > 3 and "".join(pretokens.blocks(text)) == text
    assert token_counts.count_batch(pa.array([text]), BYTES)[0] == len(Tokenizer.from_file(BYTES).encode(text, add_special_tokens=False).ids)


def test_op1(spark, small, odd, empty):
    t = Tokenizer.from_file(BYTES)
    for docs in (small["documents"], odd):
        want = [(r["doc_id"], len((r["text"] or "").encode()), n := len(t.encode(r["text"] or "", add_special_tokens=False).ids), n > 512) for r in docs.collect()]
        assert by_id(token_counts.token_counts(docs, BYTES)) == sorted(want, key=repr)
    assert token_counts.token_counts(empty, BYTES).count() == 0


def test_codec_of_noise():
    t, texts = Tokenizer.from_file(WORDS), noise(3000)
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    assert list(bpe_codec.encode_batch(pa.array(texts), WORDS)) == [(len(i), " ".join(map(str, i)), t.decode(i, skip_special_tokens=False)) for i in ids]


def test_speculation_is_verified(small):
    """Proposals that pass are exact, and only others are merged."""
    v = bpe_codec.WordVocabulary(WORDS)
    words = sorted({w for r in small["documents"].limit(60).collect() for w in re.findall(r"[a-z]+", r["text"].lower())})
    spelled = [w + bpe_codec.END for w in words]
    exact = v.exact(spelled)
    assert v.encode_words(words) == exact
    for w, own in zip(words, exact, strict=True):
        p = v.propose(w)
        fine = all(v.compatible(np.array(p[:-1]), np.array(p[1:]))) if len(p) > 1 else True
        assert fine == (p == own)


def test_op3(small, odd, empty):
    t = Tokenizer.from_file(WORDS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for docs in (small["documents"], odd):
        want = []
        for r in docs.collect():
            ids = t.encode(r["text"] or "", add_special_tokens=False).ids
            want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
        assert by_id(bpe_codec.encode_digests(docs, WORDS)) == sorted(want, key=repr)
    full = bpe_codec.encode(odd, WORDS).where("doc_id = 11").first()
    assert full["ids"] == t.encode("one two", add_special_tokens=False).ids and full["n_tokens"] == 2
    assert bpe_codec.encode_digests(empty, WORDS).count() == 0


def test_op3_keeps_no_codes_beyond_a_task():
    """A Python worker lives on for other tasks and stages, and its memory with it."""
    held = lambda: sum(len(x) for x in gc.get_objects() if isinstance(x, Kept))
    gc.collect()
    before = held()
    assert len(list(bpe_codec.encode_batch(pa.array(["words that no other test has: qzxv wvxq"]), WORDS))) == 1
    gc.collect()
    assert held() == before


def test_op7(small, odd, empty):
    t = Tokenizer.from_file(BYTES)
    for docs in (small["documents"], odd):
        start, want = 0, []
        for r in sorted(docs.select("doc_id", "text", F.xxhash64("text").alias("h")).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["h"], r["text"] is not None, r["text"] or "")):
            ids = [*t.encode(r["text"] or "", add_special_tokens=False).ids, 2]
            want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        folder, manifest = token_files.write_token_files(docs, BYTES, 2)
        assert by_id(token_files.read_token_files(folder, manifest)) == sorted(want, key=repr)
    assert token_files.read_token_files(*token_files.write_token_files(empty, BYTES, 2)).count() == 0


def test_random_access_and_damage(odd, tmp_path):
    import io

    import zstandard

    sink = io.BytesIO()
    w = token_files.FrameWriter(sink, 2)
    for k in range(5):
        w.add(k, bytes([k, 0] * (k + 1)))
    w.close()
    whole = sink.getvalue()
    # an ordinary reader passes over the tables
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read() == b"".join(bytes([k, 0] * (k + 1)) for k in range(5))
    (tmp_path / "f").write_bytes(whole)
    got = token_files.read_documents(f"file://{tmp_path}", "f", [3, 99])
    assert {k: v.tolist() for k, v in got.items()} == {3: [3, 3, 3, 3]}
    n, flags, magic = struct.unpack("<IBI", whole[-9:])
    assert (n, flags, magic) == (5, 0x80, 0x8F92EAB1)
    bad = bytearray(whole)
    bad[len(whole) - 9 - 12 * 5 + 8] ^= 1  # the first checksum
    (tmp_path / "g").write_bytes(bytes(bad))
    with pytest.raises(ValueError):
        token_files.read_documents(f"file://{tmp_path}", "g", [0])


def held(r):
    return r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0


def scored(spark, name, label, docs, labels):
    q = {"op2": quality_fm.quality, "op8": toxicity.toxicity}[name](docs, labels).collect()
    y = {r["doc_id"]: r[label] for r in labels.collect()}
    return q, [(r, y[r["doc_id"]]) for r in q if r["doc_id"] in y]


@pytest.mark.parametrize("name, label, cut, least", [("op2", "quality", 0.3, 0.97), ("op8", "toxic", 0.5, 0.93)])
def test_classifiers(spark, name, label, cut, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    q, known = scored(spark, name, label, docs, labels)
    assert len(q) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut) and r["held_out"] == held(r) for r in q)
    test = [(r["predicted"], y) for r, y in known if r["held_out"]]
    assert len(test) > 50 and sum(p == y for p, y in test) / len(test) >= least


@pytest.mark.parametrize("f", [quality_fm.quality, toxicity.toxicity])
def test_classifiers_on_odd_rows(spark, odd, empty, small, f):
    none = small["labels"].where("false")
    assert f(odd, none).count() == odd.count() and f(empty, none).count() == 0
    labels = spark.createDataFrame([(1, 1, 1), (10, 0, 0), (11, 0, 0), (1, 1, 1), (6, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert all(0 <= r["score"] <= 1 for r in f(odd, labels).collect())


def test_no_held_out_label_is_read(spark, small):
    """Labels of the held-out fold, turned round, change no score."""
    a = {r["doc_id"]: r["score"] for r in quality_fm.quality(small["documents"], small["labels"]).collect()}
    turned = small["labels"].withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert a == {r["doc_id"]: r["score"] for r in quality_fm.quality(small["documents"], turned).collect()}


def test_fm_identity():
    """The sum-of-squares form equals the sum over pairs."""
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=6), rng.normal(size=(6, 3))
    ids, x = np.array([0, 2, 5]), np.array([0.5, 2.0, -1.0], np.float32)
    pairs = sum(v[ids[a]] @ v[ids[b]] * x[a] * x[b] for a in range(3) for b in range(a + 1, 3))
    got = quality_fm.FactorisationMachine.margin(0.3, w, v, quality_fm.Rows([ids], [x]))[0][0]
    assert np.isclose(got, 0.3 + (w[ids] * x).sum() + pairs, atol=1e-5)


def verdict_by_hand(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"(?s)[^/?#]*", rest)[0]
        path = re.match(r"(?s)[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit)[1:] if fit else (None, None)


def test_op4(spark, small):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1?x#y", "https://a.net/es/1", "https://net/fr/", "https://anet/fr/", "ftp://x.org?a/b", "x://y://z.com/en/", "https://É.com/ÉN/", "https://m.casino-win.example.org/en/1", "https://blog.velmoros.example.org/de/9", "https://a.example.com/en/", "https://example.com/en", "https://x.com#/f", "https://" + "a" * 5000 + ".org/"]
    pages = small["pages"].select("page_id", "url").unionByName(spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id long, url string")).withColumn("rule", F.lit("x"))
    got = url_filter.verdicts(pages.withColumn("u", F.col("url")).select("page_id", "url", "rule"))
    by = {}
    for r in pages.collect():
        host, path, (rule, verdict) = verdict_by_hand(r["url"])
        by.setdefault(r["page_id"], []).append((host, path, rule, verdict))
    out = {}
    for r in got.collect():
        assert r["verdict"] in ("allow", "block")
        out.setdefault(r["page_id"], []).append((r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None))
    assert {k: sorted(v, key=repr) for k, v in out.items()} == {k: sorted(v, key=repr) for k, v in by.items()}
    model = {r["host"]: r["verdict"] for r in got.where("rule IS NULL").collect()}
    assert model["m.casino-win.example.org"] == "block" and model["blog.velmoros.example.org"] == "allow"
    assert url_filter.verdicts(pages.where("false")).count() == 0
    table = spark.createDataFrame([(f"https://{h}.org/{k}", int(h == "red")) for h in ("red", "blue") for k in range(9)], "url string, y int")
    with pytest.raises(ValueError):
        url_filter.verdicts(pages, labelled=table.where("false"))
    own = {r["host"]: r["verdict"] for r in url_filter.verdicts(spark.createDataFrame([(1, "https://red.org/77"), (2, "https://blue.org/77")], "page_id long, url string"), labelled=table).collect()}
    assert own == {"red.org": "block", "blue.org": "allow"}


def test_url_model_on_hosts_it_has_not_seen(spark):
    """Other compounds of the words, other suffixes and paths, and other invented names."""
    b, a, seen = url_filter.BLOCKED, url_filter.ALLOWED, {r["url"] for r in url_filter.labelled_urls(spark).collect()}
    names = [(f"{x}-{y}", "block") for x, y in zip(b, b[1:], strict=False)] + [(f"my{x}24", "block") for x in b]
    names += [(f"{x}-{y}", "allow") for x, y in zip(a, a[1:], strict=False)] + [(f"our{x}", "allow") for x in a] + [(x, "allow") for x in url_filter.invented(1000, 40)]
    pages = spark.createDataFrame([(k, f"https://{h}.dev/p/{k}") for k, (h, _) in enumerate(names)], "page_id long, url string")
    assert not seen & {r["url"] for r in pages.collect()}
    got = {r["page_id"]: r["verdict"] for r in url_filter.verdicts(pages).collect()}
    for y in ("block", "allow"):
        of = [got[k] == y for k, (_, v) in enumerate(names) if v == y]
        assert sum(of) / len(of) >= 0.95


def test_url_training_by_hand(spark):
    """The fold in one expression equals plain gradient descent."""
    rows = url_filter.labelled_urls(spark).select("y", F.col("url").alias("_u")).select("y", url_filter.ngrams(url_filter.host_of(F.col("_u")), url_filter.path_of(F.col("_u"))).alias("g")).collect()
    x = np.zeros((len(rows), url_filter.WIDTH))
    for k, r in enumerate(rows):
        x[k, r["g"]] = len(r["g"]) ** -0.5
    y, w, b = np.array([r["y"] for r in rows], float), np.zeros(url_filter.WIDTH), 0.0
    for _ in range(url_filter.ROUNDS):
        d = 1 / (1 + np.exp(-(x @ w + b))) - y
        w, b = w - url_filter.RATE * (x.T @ d / len(y) + url_filter.SHRINK * w), b - url_filter.RATE * d.mean()
    assert np.allclose(url_filter.train(url_filter.labelled_urls(spark)), [*w, b], atol=1e-9)


def test_ogg_checksum():
    """The usual table form of the checksum."""
    table = []
    for b in range(256):
        r = b << 24
        for _ in range(8):
            r = (r << 1 ^ 0x04C11DB7 if r >> 31 else r << 1) & 0xFFFFFFFF
        table.append(r)
    for data in (b"", b"OggS", bytes(range(256)) * 3):
        r = 0
        for b in data:
            r = (r << 8 & 0xFFFFFFFF) ^ table[r >> 24 ^ b]
        assert ogg_media.page_crc(data) == r


def test_ogg_pages_and_damage():
    packets = [(b"", 0), (b"a" * 255, 1), (b"b" * 70_000, 2), (b"c", 3), (b"d" * 65_025, 4)]
    data = b"".join(ogg_media.stream_pages(9, packets))
    s = ogg_media.demux(data)[9]
    assert s.packets == [p for p, _ in packets] and s.times[-1] == 4 and s.pages == 3
    for at in (3, 10, 30, len(data) // 2, len(data) - 1):
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            ogg_media.demux(bytes(bad))
    for cut in (data[:-1], data[: len(data) // 2], data[5:]):
        with pytest.raises(ValueError):
            ogg_media.demux(cut)


def test_op5(small, odd, empty):
    for docs in (small["documents"], odd):
        got = ogg_media.media_digests(ogg_media.stored(ogg_media.media_table(docs))).collect()
        texts = {}
        for r in docs.collect():
            texts.setdefault(r["doc_id"], r["text"])
        assert len(got) == docs.count()
        same = {}
        for r in got:
            raw = (texts[r["doc_id"]] or "").encode()
            payload = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
            level = [x - 128 for x in payload]
            f = dict(x.split("=") for x in r["feature"].split(";"))
            assert (f["streams"], int(f["packets"]), float(f["seconds"])) == ("2", len(payload) // 576, pytest.approx(len(payload) / 8000, abs=1e-6))
            assert (float(f["mean"]), float(f["rms"]), int(f["peak"])) == (pytest.approx(sum(level) / len(level), abs=1e-5), pytest.approx((sum(x * x for x in level) / len(level)) ** 0.5, abs=1e-5), max(map(abs, level)))
            laces = 576 // 255 + 1  # of a packet; a page has 255
            first = (255 - 1) // laces  # the header packet has one lacing value
            assert int(f["pages"]) == 1 + -(-(1 + laces * int(f["packets"])) // 255) and float(f["first_page"]) == pytest.approx(min(first, int(f["packets"])) * 576 / 8000, abs=1e-6)
            assert same.setdefault(raw, (r["media_bytes"], r["media_sha256"], r["feature"])) == (r["media_bytes"], r["media_sha256"], r["feature"])
    assert ogg_media.media_digests(ogg_media.media_table(empty)).count() == 0


def test_op6(spark, small, odd, empty, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 3)  # many blocks
    for docs in (small["documents"], odd):
        got = sharding.shard(docs, [1.0] * 16).collect()
        want = sorted((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.where("doc_id IS NOT NULL").collect())
        assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got if r["doc_id"] is not None) == want and len(got) == docs.count()
        for s in range(16):
            assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
        assert all(r["grown_shard"] in (r["shard"], 16) and r["law"] == "key" for r in got)
    assert sharding.shard(empty, [1.0] * 16).count() == 0


def test_shards_by_hand(small):
    """The largest -weight / ln(u) of a loop over shards, with u from XXH64 chained over key and shard."""

    def best(key, n):
        draws = []
        for k in range(n):
            h = xxhash.xxh64_intdigest(struct.pack("<i", k), xxhash.xxh64_intdigest(str(key).encode(), 42))
            draws.append((-1.0 / np.log(((h >> 12) + 0.5) / 2.0**52), k))
        return max(draws)[1]

    for r in sharding.shard(small["documents"], [1.0] * 16).collect():
        assert (r["shard"], r["grown_shard"]) == (best(r["doc_id"], 16), best(r["doc_id"], 17))


def test_weights(spark):
    ids = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = {r["shard"]: r["count"] for r in sharding.shard(ids, [1.0, 2.0, 5.0]).groupBy("shard").count().collect()}
    assert all(abs(n[k] / 40_000 - w / 8) < 0.01 for k, w in enumerate((1, 2, 5)))


def fp_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    """Components by comparing all pairs."""
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    fs = sorted(up)
    for k, a in enumerate(fs):
        for b in fs[:k]:
            if (a ^ b).bit_count() <= 2:
                p, q = root(a), root(b)
                up[max(p, q)] = min(p, q)
    return {f: root(f) for f in fs}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def kept_by_hand(texts):
    """The smallest id of each class of similar texts, by comparing all pairs of sets of five-word shingles."""
    sets, up = {k: shingle_set(t) for k, t in texts.items()}, {k: k for k in texts}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    ks = sorted(texts)
    for i, a in enumerate(ks):
        for b in ks[:i]:
            x, y = sets[a], sets[b]
            if len(x & y) >= 0.8 * len(x | y) and (p := root(a)) != (q := root(b)):
                up[max(p, q)] = min(p, q)
    return {root(k) for k in ks}


def test_op9(spark, small, odd, empty):
    for docs in (small["documents"], odd):
        rs = docs.select("doc_id", "text").collect()
        fp = [fp_by_hand(r["text"]) for r in rs]
        root = classes(fp)
        least = {}
        for r, f in zip(rs, fp, strict=True):
            if r["doc_id"] is not None:
                least[root[f]] = min(least.get(root[f], 1 << 60), r["doc_id"])
        want = [(r["doc_id"], f"{f:016x}", least.get(root[f])) for r, f in zip(rs, fp, strict=True)]
        assert by_id(simhash_vp.near_duplicates(docs)) == sorted(want, key=repr)
    assert simhash_vp.near_duplicates(empty).count() == 0


def test_vantage_points_lose_no_pair(spark):
    """Clusters around a few centres and free fingerprints, tiny shards: links equal brute force."""
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(30)]
    fps = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for c in centres for _ in range(40)} | {rnd.getrandbits(64) for _ in range(500)}
    chain = rnd.getrandbits(64)
    fps |= {(chain ^ ((1 << k) - 1)) for k in range(0, 60, 2)}  # each two bits from the next
    want = classes(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["node"]: r["root"] for r in simhash_vp.components(simhash_vp.links(distinct, shard=8, sample=300)).collect()}
    parts = {}
    for f in fps:
        s = f - (1 << 64) if f >> 63 else f
        parts.setdefault(got.get(s, s), set()).add(want[f])
    assert all(len(x) == 1 for x in parts.values()) and len(parts) == len(set(want.values()))


def test_op10(spark, small):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    df, want = queries.op10_decontamination(spark, SMALL), con.sql(decontam.oracle())
    assert rows(df.collect(), df.columns) == rows(want.fetchall(), want.columns)


def test_leaks_with_substitutions(spark, odd, empty):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
    changed = [w if k not in (4, 12) else "other" for k, w in enumerate(item)]
    docs = spark.createDataFrame([(1, "Some words. " + " ".join(item).upper() + "!"), (2, "x y z " + " ".join(changed) + " end"), (3, " ".join(item[:6])), (4, " ".join(reversed(item))), (5, " ".join(item[3:17])), (6, None), (7, "")], "doc_id long, text string").withColumn("seed", F.lit(1)).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame([(9, " ".join(item)), (10, "too short"), (11, None), (None, " ".join(item[::-1][:9] + ["q"] * 9))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench).collect()}
    assert got >= {(1, 9), (2, 9), (5, 9)} and not {d for d, _ in got} & {3, 6, 7}
    assert decontam.contaminated(odd, bench).count() == 0 and decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(docs, bench.where("false")).count() == 0


def windows_by_hand(text, item, n=13):
    """(first_token, n_overlaps, equal_tokens) over all windows of an item of n tokens or more, or None."""
    t, b, over = text.split(), item.split(), {}
    for s in range(len(b) - n + 1):
        for at in range(2 - n, len(t)):
            e = sum(0 <= at + k < len(t) and t[at + k] == b[s + k] for k in range(n))
            if e >= 11:
                over[at] = max(e, over.get(at, 0))
    return (min(over), len(over), max(over.values())) if over else None


@pytest.mark.parametrize("held", [decontam.WINDOWS_HELD, 0])
def test_every_window_with_a_seed_is_verified(spark, monkeypatch, held):
    """Passages of 13 tokens or more of longer items, two to four of them replaced: all windows by brute force."""
    monkeypatch.setattr(decontam, "WINDOWS_HELD", held)
    monkeypatch.setattr(decontam, "SEEDS_HELD", 5_000)
    rnd, items, texts = random.Random(11), [], []
    for k in range(300):
        item = [f"i{k}w{x}" for x in range(rnd.randint(13, 25))]
        start = rnd.randint(0, len(item) - 13)
        text = item[start : rnd.randint(start + 13, len(item))]
        for x in rnd.sample(range(len(text)), rnd.randint(2, 4)):
            text[x] = "other"
        items.append((k, " ".join(item)))
        texts.append((k, " ".join(["before"] * rnd.randint(0, 7) + text + ["after"] * rnd.randint(0, 7))))
    want = {(k, k, *w) for (k, t), (_, b) in zip(texts, items, strict=True) if (w := windows_by_hand(t, b))}
    got = decontam.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 100


def test_seed_join_without_broadcast(spark, small, monkeypatch):
    a = by_id(decontam.contaminated(small["documents"], small["benchmark"]))
    monkeypatch.setattr(decontam, "WINDOWS_HELD", 0)
    assert by_id(decontam.contaminated(small["documents"], small["benchmark"])) == a and a
    short = spark.createDataFrame([(k, " ".join(f"w{x}" for x in range(k))) for k in range(7, 20)], "item_id long, text string")
    texts = spark.createDataFrame([(k, " ".join(f"w{x}" for x in range(k % 5, 30))) for k in range(9)], "doc_id long, text string")
    b = by_id(decontam.contaminated(texts, short))
    monkeypatch.undo()
    assert b == by_id(decontam.contaminated(texts, short)) and b


def test_sample_of_repeated_ids(spark, small):
    """Rows that share an id count once in the sample that a classifier is fitted on."""
    one = spark.createDataFrame([(k, f"some words {k}", 1) for k in range(3)], "doc_id long, text string, y int")
    many = one.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50)))).drop("x")
    assert hashed_words.collected_rows(many, toxicity.packed) == hashed_words.collected_rows(one, toxicity.packed)


def test_pipeline(spark, small):
    import corpus_pipeline as p

    docs = small["documents"]
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = dict(p.STAGES)
    for name in ("toxicity", "quality", "near_duplicates", "decontamination"):
        before = docs
        docs = p.materialise(steps[name](spark, docs, SMALL))
        assert docs.columns == before.columns
        if name == "toxicity":
            gone = {r["doc_id"] for r in toxicity.toxicity(before, small["labels"]).where("predicted = 1").collect()}
        elif name == "quality":
            gone = {r["doc_id"] for r in quality_fm.quality(before, small["labels"]).where("predicted = 0").collect()}
        elif name == "near_duplicates":
            gone = set(left) - kept_by_hand(left)
        else:
            gone = {r["doc_id"] for r in decontam.contaminated(before, small["benchmark"]).collect()}
        left = {k: t for k, t in left.items() if k not in gone}
        assert sorted(r["doc_id"] for r in docs.collect()) == sorted(left)
    out = p.run(spark, SMALL)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(left)


def test_pipeline_on_odd_rows(spark, odd, empty):
    """No odd row is toxic or a passage of the benchmark; of repeated and equal texts one row stays, and of those without words."""
    import corpus_pipeline as p

    texts = {r["doc_id"]: r["text"] for r in odd.collect()}
    for docs in (odd, empty):
        some = not docs.isEmpty()
        for name, stage in p.STAGES:
            docs = p.materialise(stage(spark, docs, SMALL))
            left = [r["doc_id"] for r in docs.select("doc_id").collect()]
            assert len(left) == len(set(left)) or name in ("toxicity", "quality")
            if name == "toxicity":
                assert len(left) == (len(odd.collect()) if some else 0)
            if name == "near_duplicates":
                assert set(left) <= set(texts) and len([k for k in left if not (texts[k] or "").split()]) <= 1
        if some:
            t = Tokenizer.from_file(WORDS)
            assert all(r["ids"] == t.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids for r in docs.collect())
        assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]
