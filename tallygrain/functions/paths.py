"""Category paths as array<string>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallygrain.functions.text import NO_MATCH, NOT_USED, loose, plain, undecided

SEP = " > "


def split_path(path: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(path, F.lit("")), ">"), lambda x: F.trim(x)), lambda x: x != "")


def canonical(segments: Column) -> Column:
    """Trimmed segments without blanks and the mark of an unused level, in any case; of equal neighbours by loose
    key, the first. A label in brackets is a label."""
    kept = F.filter(F.transform(segments, lambda x: F.trim(x)), lambda x: F.coalesce((x != "") & (F.lower(x) != NOT_USED), F.lit(False)))
    return F.filter(kept, lambda x, i: (i == 0) | (loose(x) != loose(F.get(kept, i - 1))))


def joined(segments: Column) -> Column:
    return F.array_join(segments, SEP)


def plain_path(path: Column) -> Column:
    return F.array_join(F.transform(canonical(split_path(path)), plain), SEP)


def distinct_depth(levels: list[Column]) -> Column:
    return F.size(F.array_distinct(F.filter(F.array(*[F.trim(F.coalesce(c, F.lit(""))) for c in levels]), lambda x: x != "")))


def readable(levels: list[Column]) -> Column:
    """Levels that say something, joined; blanks and marks of absence are passed over."""
    return F.concat_ws(SEP, *[F.when((F.trim(c) != "") & ~absent(F.trim(c)), F.trim(c)) for c in levels])


def absent(label: Column) -> Column:
    """Whether a label is a mark that a level isn't used, isn't there or has no match."""
    return F.lower(label).isin(NOT_USED, NO_MATCH) | label.rlike(r"^\(no level \d+ in this taxonomy\)$")


def padded(segments: Column, depth: int = 4) -> Column:
    """Gate and `depth` levels, the deepest repeated below itself."""
    return F.when(F.size(segments) == 0, segments).otherwise(F.transform(F.sequence(F.lit(0), F.lit(depth)), lambda i: F.get(segments, F.least(i.cast("int"), F.size(segments) - 1))))


def carried(segments: Column, marker: str) -> Column:
    """From the first undecided level on, every level reads the marker."""
    at = F.array_position(F.transform(segments, lambda x: loose(x) == loose(F.lit(marker))), True)
    return F.transform(segments, lambda x, i: F.when((at > 0) & (i + 1 >= at), F.lit(marker)).otherwise(x))


def prefixes(segments: Column, proper: bool = False) -> Column:
    """All beginnings of a path as strings; proper leaves out the path itself."""
    n = F.size(segments) - int(proper)
    return F.when(n >= 1, F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(segments, F.lit(1), k.cast("int")), SEP))).otherwise(F.array().cast("array<string>"))


def all_undecided(levels: list[Column]) -> Column:
    return F.forall(F.array(*levels), undecided)
