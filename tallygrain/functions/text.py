"""Text functions: label keys, markers, confidence, key recovery. Column in, Column out."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What occupies a description without describing anything.
NO_DESCRIPTION = ("NO DESCRIPTION", "NO DESC", "N/A", "NA", "UNKNOWN", "NONE", "NIL", "TBA", "MISC", "MISCELLANEOUS", "SUNDRY", ".", "-", "XXX", "NULL")
# Category levels at which nothing was decided, in lower case.
UNDECIDED = ("", "uncategorised", "uncategorized", "not yet categorized", "not yet categorised", "not categorised", "not categorized", "(not used at this level)", "none", "n/a")
# The answers a judge may give.
VERDICTS = ("Correct", "Incorrect", "Uncertain")
UNCATEGORISED, NOT_USED, NO_MATCH = "Uncategorised", "(not used at this level)", "(no taxonomy match)"


def clean(c: Column) -> Column:
    return F.trim(c.cast("string"))


def blank(c: Column) -> Column:
    return F.coalesce(clean(c), F.lit("")) == ""


def uncategorised(l0: Column) -> Column:
    """Whether a first level says that nothing was decided: null, blank, or the word that normalise() writes."""
    return blank(l0) | F.coalesce(clean(l0) == UNCATEGORISED, F.lit(False))


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c evaluated a single time, however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def usable(c: Column) -> Column:
    """Whether a description says anything."""
    return ~blank(c) & ~F.upper(F.coalesce(clean(c), F.lit(""))).isin(*NO_DESCRIPTION)


def first_usable(cols: list[Column]) -> Column:
    """The first usable of an ordered list; else the first as it is; else ''."""
    return F.coalesce(*[F.when(usable(c), clean(c)) for c in cols], clean(cols[0]), F.lit(""))


def first_filled(cols: list[Column]) -> Column:
    return F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in cols])


def filled_by(cols: dict[str, Column]) -> Column:
    """The name of the first column that isn't blank."""
    return F.coalesce(*[F.when(~blank(c), F.lit(n)) for n, c in cols.items()], F.lit("(none)"))


def loose(c: Column) -> Column:
    """A label without case, spaces and punctuation; & reads as AND."""
    return F.regexp_replace(F.upper(F.replace(c, F.lit("&"), F.lit(" AND "))), r"[^\p{L}\p{N}]", "")


def plain(c: Column) -> Column:
    """A label for comparing meaning: lower case, & as and, one space for punctuation, no plural s."""
    s = F.replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), F.lit("&"), F.lit(" and "))
    s = F.trim(F.regexp_replace(s, "[^a-z0-9]+", " "))
    return F.regexp_replace(s, r"s\b", "")


def undecided(c: Column) -> Column:
    return F.lower(F.trim(F.coalesce(c, F.lit("")))).isin(*UNDECIDED)


def distance(a: Column, b: Column, cap: int) -> Column:
    """Edit distance, cap + 1 beyond cap."""
    d = F.levenshtein(a, b, cap)
    return F.when(d < 0, cap + 1).otherwise(d)


def confidence(raw: Column) -> Column:
    """0 to 1; what isn't a number is 0; null, an answer that never came, stays null."""
    x = F.coalesce(F.expr("try_cast(_x AS double)") if isinstance(raw, str) else raw.try_cast("double"), F.lit(0.0))
    x = F.when(F.isnan(x), 0.0).otherwise(x)
    return F.when(raw.isNull(), None).otherwise(F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0)))


def keys_in(text: Column) -> Column:
    """array<string>: the distinct tokens of a text that look like a key."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\b([A-Z]{2,4}-\d{3,5})\b"), 1))


def recovered_key(text: Column, valid: Column) -> Column:
    """The key that prose names, if it names exactly one valid key."""
    found = F.array_intersect(keys_in(text), valid)
    return F.when(F.size(found) == 1, F.element_at(found, 1))


def verdict_in(raw: Column, allowed: tuple[str, ...]) -> Column:
    """The verdict of a model's output in any case: of its JSON, else of the first "verdict": "..." in
    prose whose word is allowed."""
    def known(v: Column) -> Column:
        return F.coalesce(*[F.when(F.lower(F.trim(v)) == a.lower(), F.lit(a)) for a in allowed])

    said = F.regexp_extract_all(raw, F.lit(r'"verdict"\s*:\s*"([^"]+)"'), 1)
    return F.coalesce(known(F.get_json_object(raw, "$.verdict")), F.get(F.filter(F.transform(said, known), lambda v: v.isNotNull()), F.lit(0)))


def content_words(label: Column, stop: tuple[str, ...]) -> Column:
    """Words of three letters or more that aren't stop words, without plural s, in order."""
    words = F.split(F.replace(F.lower(F.coalesce(label, F.lit(""))), F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}]+")
    kept = F.filter(words, lambda w: (F.length(w) >= 3) & ~w.isin(*stop))
    return F.transform(kept, lambda w: F.regexp_replace(w, "(?<!s)s$", ""))
