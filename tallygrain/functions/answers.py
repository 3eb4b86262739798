"""Answers of a model, as text around JSON, taken as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygrain.functions.text import once

FIELDS = "line_id bigint, verdict string, confidence string, basis string, suggested_key string, rationale string"


def balanced(text: Column) -> Column:
    """From the first { or [ to the bracket that closes it, passing over brackets in strings; null if none does. The text
    is cut after each bracket outside strings; a string that doesn't end stops that, as nothing after it is outside."""
    rest = F.regexp_extract(text, r"(?s)([\[{].*)", 1)
    cuts = F.regexp_extract_all(rest, F.lit(r'(?s)\G(?:[^"\[\]{}]++|"(?:[^"\\]++|\\.)*+")*+[\[\]{}]'), 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(s: Column, c: Column) -> Column:
        depth, at = s["depth"] + F.when(F.right(c, F.lit(1)).isin("{", "["), 1).otherwise(-1), s["at"] + F.length(c)
        return F.struct(depth.alias("depth"), at.alias("at"), F.when((depth == 0) & (s["end"] == 0), at).otherwise(s["end"]).alias("end"))

    end = F.aggregate(cuts, start, step)["end"]
    return once(end, lambda n: F.when(n > 0, F.substring(rest, F.lit(1), n)))


def parsed(raw: Column) -> Column:
    """Variant: the JSON in an answer that may have fences or prose around it; null where there is none. Tried
    in this order: the whole text, what is between fences, the first balanced object or list, and from the first
    brace to the last."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    fenced = F.regexp_extract(t, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    widest = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    structure = lambda c: once(c, lambda x: F.when(F.left(F.ltrim(x), F.lit(1)).isin("{", "["), F.try_parse_json(x)))
    return F.coalesce(*[structure(c) for c in (t, fenced, balanced(t), widest)])


def answers(df: DataFrame, raw: str, by: list[str], fields: str = FIELDS, id_: str = "line_id", inside: str = "verdicts") -> DataFrame:
    """A row for each answer in the texts: by and the fields. The rows are the list in `inside`, or the top list,
    or a single object. Answers without an id are left out, and of those that share one in a text the last counts.
    A text without JSON gives no row."""
    v = df.select(*by, parsed(F.col(raw)).alias("_v"))
    rows = F.coalesce(F.try_variant_get("_v", f"$.{inside}", "array<variant>"), F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    # outer: else Spark filters by the rows before it makes them, and parses each text again for that; what is null has no id
    each = v.select(*by, F.posexplode_outer(rows).alias("_k", "_x"))
    names = [f.strip().split(" ", 1) for f in fields.split(",")]
    got = each.select(*by, "_k", *[F.try_variant_get("_x", f"$.{n}", kind).alias(n) for n, kind in names]).where(F.col(id_).isNotNull())
    rest = [n for n, _ in names if n != id_]
    last = got.groupBy(*by, id_).agg(F.max_by(F.struct(*rest), "_k").alias("_r"))
    return last.select(*by, id_, *[F.col(f"_r.{c}").alias(c) for c in rest])
