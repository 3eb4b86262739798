"""BPE encoding and decoding by speculation and verification.

For each distinct word a greedy longest match proposes tokens. A proposal is the BPE encoding of the
word exactly if every token encodes to itself and no merge would ever have crossed a boundary
between two neighbours. The second test is done for all adjacent pairs of all proposals at once, by
walking both tokens' merge histories backwards in arrays. Only words with a pair that fails go
through exact merging.

Edge cases: a null or empty text encodes to no tokens and decodes to ''; texts of any length are
encoded whole; repeated rows give repeated rows; an empty table gives an empty table; only the id
and text columns are read, so other columns, whatever their names, have no influence. Tokens decode
as the vocabulary has no decoder: its strings joined by a space.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import small_batches
from tallygrain.llm.pretokens import Kept, as_text, gathered_batches, space_units
from tallygrain.llm.token_counts import NO_RANK, PairRanks, byte_letters

#: What of a text is a word (fixed value of the vocabulary); all else is dropped.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
END = "</w>"
NEVER = NO_RANK
#: Chunks whose codes a task keeps, at about 400 bytes each. A worker lives on for the tasks of other stages, so none
#: are kept beyond the task: of new texts they spare a twentieth of the work.
KEPT = 600_000
#: Bytes of text that are encoded together.
HELD = 1 << 23
Code = tuple[int, str, str]


def normal(chunk: str) -> str:
    """NFC, then lower case letter by letter."""
    low = unicodedata.normalize("NFC", chunk)
    return low.lower() if "Σ" not in low else "".join(c.lower() for c in low)


class WordVocabulary:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [tuple(m) for m in spec["model"]["merges"]]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = added
        self.special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")")
        n = self.width = max([*self.vocab.values(), *added.values()]) + 1
        self.text = [""] * n
        for s, k in [*self.vocab.items(), *added.items()]:
            self.text[k] = s
        self.letters = byte_letters()
        # birth: the rank of the merge that makes a token (-1: none); left, right: what it is made of
        self.birth, self.left, self.right = np.full(n, -1), np.arange(n), np.arange(n)
        for k, (a, b) in enumerate(merges):
            t = self.vocab[a + b]
            self.birth[t], self.left[t], self.right[t] = k, self.vocab[a], self.vocab[b]
        self.pairs = PairRanks([(self.vocab[a], self.vocab[b]) for a, b in merges], [self.vocab[a + b] for a, b in merges], n)
        # tokens that exact merging of their own letters doesn't give back are never proposed
        names = list(self.vocab)
        own = self.exact(names)
        proposable = {s: self.vocab[s] for s, got in zip(names, own, strict=True) if got == [self.vocab[s]]}
        self.closing = {s[: -len(END)]: t for s, t in proposable.items() if s.endswith(END) and s != END}
        self.inner = {s: t for s, t in proposable.items() if not s.endswith(END) or s == END}
        # by the first three letters, the lengths of tokens that begin so, the longest first
        sizes: dict[str, set[int]] = {}
        for s in self.inner:
            if len(s) > 2:
                sizes.setdefault(s[:3], set()).add(len(s))
        self.sizes = {k: tuple(sorted(x, reverse=True)) for k, x in sizes.items()}

    def exact(self, words: list[str]) -> list[list[int]]:
        """The encodings by merging, all words at once. A word is byte letters, then END or not."""
        ends = [w.endswith(END) and len(w) > len(END) for w in words]
        bare = [w[: -len(END)] if e else w for w, e in zip(words, ends, strict=True)]
        size = np.fromiter(map(len, bare), np.int64, len(bare))
        vocab = self.vocab
        sym = np.array([vocab[c] for w in bare for c in w], np.int64)
        last, closed = np.cumsum(size) - 1, np.array(ends, bool)
        sym[last[closed]] = [vocab[w[-1] + END] for w, e in zip(bare, ends, strict=True) if e]
        sym, seq = self.pairs.merge_all(sym, np.repeat(np.arange(len(bare)), size))
        at = np.searchsorted(seq, np.arange(1, len(bare)))
        return [x.tolist() for x in np.split(sym, at)] if bare else []

    def propose(self, word: str) -> list[int]:
        """Greedy longest match over byte letters; the last token is one that ends a word."""
        out, at, n, last, have, sizes = [], 0, len(word), self.closing, self.inner, self.sizes
        while at < n:
            rest = word[at:]
            if (t := last.get(rest)) is not None:
                out.append(t)
                break
            # a token that reaches the end must carry END, so any other stops one letter short
            left = n - at
            for size in sizes.get(rest[:3], ()):
                if size < left and (t := have.get(rest[:size])) is not None:
                    break
            else:
                size = 2 if left > 2 and (t := have.get(rest[:2])) is not None else 1
                t = have[rest[:size]]
            out.append(t)
            at += size
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens, whether merging the letters of both leaves their boundary.

        Going back in time, the later-born of the two symbols at the boundary is replaced by its
        part there. While a symbol lives (from its birth to its use in the next), a merge of both
        would have crossed the boundary. On a tie with the use of the right symbol the crossing
        merge stands further left and comes first."""
        ok = np.ones(len(a), bool)
        todo = np.arange(len(a))
        end_a, end_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(todo):
            rank = self.pairs.rank(a, b)
            bad = (rank < NEVER) & (rank < end_a) & (rank <= end_b)
            ok[todo[bad]] = False
            born_a, born_b = self.birth[a], self.birth[b]
            back_a = born_a > born_b
            go = ~bad & (np.maximum(born_a, born_b) >= 0)
            # a tie in birth is the same token twice: its last use counts for both sides in turn
            end_a, end_b = np.where(back_a, born_a, end_a)[go], np.where(back_a, end_b, born_b)[go]
            a, b, todo = np.where(back_a, self.right[a], a)[go], np.where(back_a, b, self.left[b])[go], todo[go]
        return ok

    def encode_words(self, words: list[str]) -> list[list[int]]:
        spelled = ["".join([self.letters[x] for x in w.encode()]) for w in words]
        got = [self.propose(w) for w in spelled]
        size = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((t for x in got for t in x), np.int64, int(size.sum()))
        owner = np.repeat(np.arange(len(got)), size)
        at = np.flatnonzero(owner[:-1] == owner[1:])
        pairs, back = np.unique(flat[at] * self.width + flat[at + 1], return_inverse=True)
        ok = self.compatible(pairs // self.width, pairs % self.width)[back]
        failing = np.unique(owner[at[~ok]]).tolist()
        for k, own in zip(failing, self.exact([spelled[k] + END for k in failing]), strict=True):
            got[k] = own
        return got


_vocabulary = lru_cache(2)(WordVocabulary)


def words_of(chunk: str, v: WordVocabulary) -> list[str]:
    """A chunk's words in normal form, and the strings of special tokens as they are."""
    out: list[str] = []
    for k, part in enumerate(v.special.split(chunk) if "<|" in chunk else [chunk]):
        out += [part] if k % 2 else WORD.findall(normal(part))
    return out


def codes(chunks: list[str], v: WordVocabulary) -> list[Code]:
    """For each chunk: number of tokens, ids, decoded text."""
    words = [words_of(c, v) for c in chunks]
    distinct = list(set().union(*words).difference(v.added))
    ids = dict(zip(distinct, v.encode_words(distinct), strict=True)) | {s: [t] for s, t in v.added.items()}
    out = []
    for x in words:
        own = [t for w in x for t in ids[w]]
        out.append((len(own), " ".join(map(str, own)), " ".join([v.text[t] for t in own])))
    return out


def encode_batch(texts: pa.Array, path: str, kept: Kept | None = None) -> Iterator[Code]:
    """(number of tokens, decimal ids joined by a space, decoded text) of each text. kept: codes of earlier chunks."""
    v, kept = _vocabulary(path), Kept(KEPT) if kept is None else kept
    cut = space_units(as_text(texts))
    got = kept.values_for(cut.names.to_pylist(), lambda new: codes(new, v))
    counts = cut.sums(np.array([c[0] for c in got], np.int64))
    ids, shown = [c[1] for c in got], [c[2] for c in got]
    # a piece without a word would leave a second space
    empty = not all(ids)
    for n, a, b in zip(counts.tolist(), cut.lists(ids), cut.lists(shown), strict=True):
        yield n, " ".join(filter(None, a) if empty else a), " ".join(filter(None, b) if empty else b)


def encode_batches(batches: Iterator[pa.Array], path: str, size: int) -> Iterator[tuple]:
    """A task's batches, gathered to about `size` bytes: numbers of tokens, ids and decoded texts of each."""
    kept = Kept(KEPT)
    for texts in (pa.concat_arrays(x) for x in gathered_batches(batches, size)):
        yield tuple(zip(*encode_batch(texts, path, kept), strict=True)) if len(texts) else ((), (), ())
    kept.clear()
    pa.default_memory_pool().release_unused()


def encoded(text: Column, path: str) -> Column:
    """Column struct: n_tokens, ids, decoded. Batches are smaller than those of digests, as whole ids and texts are given back."""

    @F.arrow_udf("n_tokens long, ids array<int>, decoded string")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for n, ids, shown in encode_batches(batches, path, HELD // 8):
            flat = " ".join(filter(None, ids))
            numbers = pa.array(np.array(flat.split(" ") if flat else [], np.int32))
            bounds = pa.array(np.r_[0, np.cumsum(n)].astype(np.int32))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(bounds, numbers), pa.array(shown, pa.string())], ["n_tokens", "ids", "decoded"])

    return code(text)


def digested(text: Column, path: str) -> Column:
    """Column struct: n_tokens and the SHA-256 of ids and of the decoded text, which stay in the task."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for n, ids, shown in encode_batches(batches, path, HELD):
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array(map(sha, shown), pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"])

    return code(text)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids array<int>, decoded: the real output, a row for each row of docs."""
    small_batches(docs.sparkSession)
    got = docs.select(F.col(id_col).alias("doc_id"), encoded(F.col(text_col), path).alias("_c"))
    return got.select("doc_id", "_c.n_tokens", "_c.ids", "_c.decoded")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, a row for each row of docs."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).alias("doc_id"), digested(F.col(text_col), path).alias("_c")).select("doc_id", "_c.*")
