"""Cut batches of texts into units that a vocabulary encodes independently of their neighbours.

A unit is a space with all up to the next space. The splitting rule of the byte-level vocabulary
starts a token at every space that stands between two characters other than white space, so a text
without double white space may be cut there by Arrow's string kernels; other texts are cut by the
rule itself. Units repeat far more often than texts do: a batch is turned into codes of its distinct
units, and what was computed for a unit is kept for later batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The splitting rule of the vocabulary (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULE = regex.compile(PATTERN)
#: White space of Unicode, and control characters that string methods take for white space.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CONTROL = r"\x00\x1c-\x1f"
ODD = f"[{SPACE}][{SPACE}]|^[{SPACE}]|[{SPACE}]$|[{CONTROL}]"
SPACES = regex.compile(r"\s+")
BLOCK = 1 << 20


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """The text in blocks of about `size` characters, cut at single spaces only; all but the first
    block begin with the space."""
    start = 0
    while len(text) - start > size:
        at = text.find(" ", start + size)
        while at > 0 and (text[at - 1].isspace() or text[at + 1 : at + 2].isspace() or at + 1 == len(text)):
            at = text.find(" ", at + 1)
        if at < 0:
            break
        yield text[start:at]
        start = at
    yield text[start:] if start else text


class Kept(dict):
    """A bounded cache: emptied when it has grown to `limit` entries; long keys aren't kept."""

    def __init__(self, limit: int = 400_000, longest: int = 80):
        super().__init__()
        self.limit, self.longest = limit, longest

    def missing(self, lists: list) -> list[str]:
        """Keys of the lists that aren't kept. Room is made first, so all of them fit afterwards."""
        if len(self) > self.limit:
            self.clear()
        return list(set().union(*lists).difference(self))

    def forget_long(self, keys: list[str]) -> None:
        for k in keys:
            if len(k) > self.longest:
                self.pop(k, None)

    def values_for(self, keys: list[str], compute: Callable[[list[str]], list]) -> list:
        """A value for each key; compute gives those of a list of missing keys."""
        new = self.missing([keys])
        self.update(zip(new, compute(new), strict=True))
        out = list(map(self.__getitem__, keys))
        self.forget_long(new)
        return out


class Units:
    """A batch of texts as codes: text k has the distinct units c for c in codes[bounds[k]:bounds[k + 1]].
    The first of them, `names`, are an Arrow array; `extra` are the others."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray, names: pa.Array, extra: list[str]):
        self.codes, self.bounds, self.names, self.extra = codes, bounds, names, extra

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text, the sum of its units' values."""
        total = np.r_[0, np.cumsum(values[self.codes])]
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def gathered(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All texts' values, where unit c has flat[start[c]:start[c] + size[c]], and each text's bounds."""
        n = size[self.codes]
        stop = np.r_[0, np.cumsum(n)]
        at = np.repeat(start[self.codes] - stop[:-1], n) + np.arange(stop[-1])
        return flat[at], stop[self.bounds]

    def lists(self, values: list) -> Iterator[list]:
        """For each text, its units' values."""
        get = values.__getitem__
        for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True):
            yield list(map(get, self.codes[a:b].tolist()))


def as_text(texts: pa.Array) -> pa.Array:
    """Nulls as empty texts, with offsets that can't overflow."""
    return pc.fill_null(texts.cast(pa.large_string()), "")


def gathered_batches(batches: Iterator[pa.Array], size: int = 1 << 24) -> Iterator[list[pa.Array]]:
    """Batches together as long as they hold about `size` bytes: more texts share more units."""
    held: list[pa.Array] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held


def _split(cut: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes, bounds and distinct strings of an array of lists of strings."""
    coded = cut.flatten().dictionary_encode()
    bounds = cut.offsets.to_numpy() - cut.offsets[0].as_py()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds.astype(np.int64), coded.dictionary


def rule_units(texts: pa.Array, special: regex.Pattern | None) -> Units:
    """Units for the byte-level vocabulary, of an array of large strings without nulls. A space stands
    before each of `names`."""
    odd = pc.or_(pc.match_substring_regex(texts, ODD), pc.greater(pc.utf8_length(texts), BLOCK)).to_numpy(zero_copy_only=False)
    plain = np.flatnonzero(~odd)
    codes, bounds, names = _split(pc.split_pattern(texts.take(pa.array(plain)) if odd.any() else texts, " "))
    # the first unit of a text has no space before it
    extra: dict[str, int] = {}
    some = bounds[:-1][bounds[1:] > bounds[:-1]]
    firsts = names.take(pa.array(codes[some])).to_pylist()
    codes[some] = [len(names) + extra.setdefault(u, len(extra)) for u in firsts]
    if not odd.any():
        return Units(codes, bounds, names, list(extra))
    out = [np.zeros(0, np.int64)] * len(texts)
    for k, i in enumerate(plain.tolist()):
        out[i] = codes[bounds[k] : bounds[k + 1]]
    for i in np.flatnonzero(odd).tolist():
        own: list[str] = []
        for block in blocks(texts[i].as_py()):
            for k, part in enumerate(special.split(block) if special else [block]):
                own += [part] if k % 2 else RULE.findall(part)
        out[i] = np.array([len(names) + extra.setdefault(u, len(extra)) for u in own], np.int64)
    return Units(np.concatenate(out), np.r_[0, np.cumsum([len(x) for x in out])].astype(np.int64), names, list(extra))


def space_units(texts: pa.Array) -> Units:
    """Pieces between white space, for vocabularies that drop it; some may be empty."""
    odd = pc.match_substring_regex(texts, f"[{CONTROL}]").to_numpy(zero_copy_only=False)
    if not odd.any():
        return Units(*_split(pc.utf8_split_whitespace(texts)), [])
    cut = [SPACES.split(t) if o else t.split() for t, o in zip(texts.to_pylist(), odd, strict=True)]
    return Units(*_split(pa.array(cut, pa.large_list(pa.large_string()))), [])

