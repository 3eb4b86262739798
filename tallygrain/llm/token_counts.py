"""Token counts by rank-synchronous array merging.

The words of a batch are held as one flat array of symbols with a sequence number each. In every
round each sequence merges all occurrences of its own lowest-ranked pair at once; sequences with no
pair left leave the arrays, and the number of symbols they have left is their token count. Merging
a pair everywhere at once equals merging one occurrence at a time, since a pair that holds a merged
symbol always ranks after the merge that made it.

Edge cases: a null or empty text has 0 tokens; a text of any length is counted whole, in blocks;
repeated rows give repeated rows; an empty table gives an empty table; only the id and text columns
are read, so other columns, whatever their names, have no influence.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.common import small_batches
from tallygrain.llm.pretokens import RULE, Units, as_text, gathered_batches, rule_units

NO_RANK = np.iinfo(np.int64).max
#: Letters that every version of Unicode has, and a mark: such a unit is a word, or a word and a mark.
PLAIN = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{17F}]+[.,;:!?]?$"
MARKED = np.array([chr(b) in ".,;:!?" for b in range(256)], np.int64)


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in shown}, 256
    for b in range(256):
        if b not in letters:
            letters[b], extra = chr(extra), extra + 1
    return [letters[b] for b in range(256)]


class PairRanks:
    """Ranked merges of two symbols into one, as sorted arrays."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int], width: int):
        key = np.array([a * width + b for a, b in pairs], np.int64)
        order = np.argsort(key)
        self.width, self.keys, self.ranks, self.made = width, key[order], order.astype(np.int64), np.array(made, np.int64)

        # most pairs are of bytes and early merges: those have a table of their own
        n = self.small = min(1024, width)
        low = [(k, (a, b)) for k, (a, b) in enumerate(pairs) if a < n and b < n]
        self.table = np.full(n * n, NO_RANK)
        self.table[[a * n + b for _, (a, b) in low]] = [k for k, _ in low]

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        n = self.small
        out = self.table[np.minimum(left, n - 1) * n + np.minimum(right, n - 1)]
        far = np.flatnonzero((left >= n) | (right >= n))
        if len(far):
            key = left[far] * self.width + right[far]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[far] = np.where(self.keys[at] == key, self.ranks[at], NO_RANK)
        return out

    def merge_all(self, sym: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their sequence numbers (ascending) before and after all merges."""
        rank = np.full(len(sym), NO_RANK)
        inner = np.flatnonzero(seq[:-1] == seq[1:])
        rank[inner] = self.rank(sym[inner], sym[inner + 1])
        done_sym, done_seq = [sym[:0]], [seq[:0]]
        while len(sym):
            first = np.flatnonzero(np.r_[True, seq[1:] != seq[:-1]])
            size = np.diff(np.r_[first, len(seq)])
            lowest = np.minimum.reduceat(rank, first)
            over = lowest == NO_RANK
            if over.any():
                stay = np.repeat(~over, size)
                done_sym.append(sym[~stay])
                done_seq.append(seq[~stay])
                sym, seq, rank = sym[stay], seq[stay], rank[stay]
                size, lowest = size[~over], lowest[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, size))
            # of neighbours that share a symbol (as in aaa), every second one, from the left
            run = np.r_[True, np.diff(at) != 1]
            since = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
            at = at[since % 2 == 0]
            sym[at] = self.made[rank[at]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            sym, seq, rank = sym[stay], seq[stay], rank[stay]
            # only the pairs at a merged symbol are new
            new = np.zeros(len(sym), bool)
            new[moved[at]] = new[np.maximum(moved[at] - 1, 0)] = True
            redo = np.flatnonzero(new)
            rank[redo] = NO_RANK
            redo = redo[redo < len(sym) - 1]
            redo = redo[seq[redo] == seq[redo + 1]]
            rank[redo] = self.rank(sym[redo], sym[redo + 1])
        sym, seq = np.concatenate(done_sym), np.concatenate(done_seq)
        order = np.argsort(seq, kind="stable")
        return sym[order], seq[order]


class MergeTable:
    """A byte-level BPE vocabulary."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.byte_id = np.array([vocab[c] for c in byte_letters()], np.int64)
        pairs, made = [(vocab[a], vocab[b]) for a, b in merges], [vocab[a + b] for a, b in merges]
        self.pairs = PairRanks(pairs, made, max(vocab.values()) + 1)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def surviving(self, words: list[bytes]) -> np.ndarray:
        """How many symbols each word has after all merges."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        sym = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        _, seq = self.pairs.merge_all(sym, np.repeat(np.arange(len(words)), size))
        return np.bincount(seq, minlength=len(words))

    def _plain(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Symbols, words and units of units that are a space, letters, and at most one mark."""
        offset = np.frombuffer(names.buffers()[1], np.int64)[names.offset : names.offset + len(names) + 1]
        raw = np.frombuffer(names.buffers()[2], np.uint8)[offset[0] : offset[-1]]
        size = np.diff(offset) + 1
        stop = np.cumsum(size)
        sym = np.full(int(stop[-1]), self.byte_id[32])
        inner = np.ones(len(sym), bool)
        inner[stop - size] = False
        sym[inner] = self.byte_id[raw]
        marked = MARKED[raw[offset[1:] - offset[0] - 1]]
        words = 1 + marked
        seq = np.repeat(np.cumsum(words) - words, size)
        seq[stop - 1] += marked
        return sym, seq, np.repeat(np.arange(len(names)), words)

    def _other(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for any units, cut by the vocabulary's rule; a special token is one symbol."""
        sym: list[int] = []
        size: list[int] = []
        owner: list[int] = []
        ids = self.byte_id.tolist()
        for k, name in enumerate(names):
            for j, part in enumerate(self.special.split(name) if self.special and "<|" in name else [name]):
                for own in [[self.added[part]]] if j % 2 else [[ids[b] for b in w.encode()] for w in RULE.findall(part)]:
                    sym += own
                    size.append(len(own))
                    owner.append(k)
        return np.array(sym, np.int64), np.repeat(np.arange(len(size)), np.array(size, np.int64)), np.array(owner, np.int64)

    def encode_units(self, cut: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all distinct units: one array, with the start and the number of each unit's."""
        plain = pc.match_substring_regex(cut.names, PLAIN).to_numpy(zero_copy_only=False)
        here, there = np.flatnonzero(plain), np.flatnonzero(~plain)
        size = np.zeros(len(cut.names) + len(cut.extra), np.int64)
        units = np.r_[here, there, np.arange(len(cut.names), len(size))]
        flat = []
        step = 1 << 15  # words whose arrays stay in the processor's cache
        for k in range(0, len(here), step):
            sym, seq, owner = self._plain(cut.names.take(pa.array(here[k : k + step])))
            sym, seq = self.pairs.merge_all(sym, seq)
            size[here[k : k + step]] = np.bincount(owner[seq], minlength=len(here[k : k + step]))
            flat.append(sym)
        rest = [" " + s for s in cut.names.take(pa.array(there)).to_pylist()] + cut.extra
        for k in range(0, len(rest), step):
            sym, seq, owner = self._other(rest[k : k + step])
            sym, seq = self.pairs.merge_all(sym, seq)
            size[units[len(here) + k :][: len(rest[k : k + step])]] = np.bincount(owner[seq], minlength=len(rest[k : k + step]))
            flat.append(sym)
        start = np.zeros(len(size), np.int64)
        stop = np.cumsum(size[units])
        start[units] = stop - size[units]
        return np.concatenate([*flat, np.zeros(0, np.int64)]), start, size


@lru_cache(2)
def _table(path: str) -> MergeTable:
    """Kept for as long as the Python worker lives."""
    return MergeTable(path)


def count_batch(texts: pa.Array, path: str) -> np.ndarray:
    table = _table(path)
    cut = rule_units(as_text(texts), table.special)
    return cut.sums(table.encode_units(cut)[2])


def n_tokens(text: Column, path: str) -> Column:
    """Column: how many tokens the whole text has under the vocabulary at `path`."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in (pa.concat_arrays(x) for x in gathered_batches(batches)):
            yield pa.array(count_batch(texts, path), pa.int64())

    return count(text)


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), a row for each row of docs."""
    small_batches(docs.sparkSession)
    return (
        docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
        .select("doc_id", F.octet_length("_t").cast("long").alias("n_bytes"), n_tokens(F.col("_t"), path).alias("n_tokens"))
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
