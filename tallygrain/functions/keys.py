"""Stable keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_key(*parts: Column, utf16: bool = False) -> Column:
    """20 upper-case hexadecimal digits of SHA-256 over the parts joined by |; null counts as ''.
    utf16 hashes UTF-16LE, as a database with wide characters does."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.upper(F.left(F.sha2(F.encode(text, "UTF-16LE") if utf16 else text, 256), F.lit(20)))


def decision_id(*parts: Column) -> Column:
    return F.left(F.md5(F.concat_ws(" | ", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), F.lit(10))
