"""String functions as built-in Spark expressions (SC9-SC19, PF9, PF10).

No Python UDFs: every function returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from .. import constants as K


def normalize_reason(raw: Column) -> Column:
    """SC11 (runtime mode): NULL/empty -> unknown; a JSON list -> its first
    element (a text that only begins like one is taken as it stands); trimmed value in the canonical set -> lower-cased; else the first
    keyword group contained in the lower-cased text; else unknown."""
    s = raw.cast("string")
    listed = F.from_json(F.trim(s), ArrayType(StringType()))
    first = F.when(F.trim(s).startswith("[") & listed.isNotNull(), F.get(listed, F.lit(0))).otherwise(s)
    clean = F.trim(first)
    low = F.lower(clean)
    expr = F.when(first.isNull() | (clean == ""), F.lit("unknown")).when(
        low.isin(*K.CHURN_REASONS), low)
    for reason, words in K.REASON_KEYWORDS:
        cond = None
        for w in words:
            c = low.contains(w)
            cond = c if cond is None else (cond | c)
        expr = expr.when(cond, F.lit(reason))
    return expr.otherwise(F.lit("unknown"))


def normalize_reason_migration(raw: Column) -> Column:
    """SC12 / PF9 / PF10 (one-time migration mode): rows whose value is NULL
    or already canonical (case-insensitively, as under a case-insensitive
    collation) are left unchanged; others map by LIKE patterns on lower()."""
    low = F.lower(raw)
    mapped = None
    for reason, pats in K.REASON_LIKE_PATTERNS:
        cond = None
        for p in pats:
            c = low.like(p)
            cond = c if cond is None else (cond | c)
        mapped = F.when(cond, F.lit(reason)) if mapped is None else mapped.when(cond, F.lit(reason))
    mapped = mapped.otherwise(F.lit("unknown"))
    untouched = raw.isNull() | low.isin(*K.CHURN_REASONS)
    return F.when(untouched, raw).otherwise(mapped)


def is_canonical_reason(raw: Column) -> Column:
    """PF9: ``lower(c) IN (...)`` - NULL for NULL input (three-valued logic)."""
    return F.lower(raw).isin(*K.CHURN_REASONS)


def sanitize(text: Column) -> Column:
    """SC10: smart quotes/dashes/NBSP/control bytes to ASCII; chars mapped to
    nothing are deleted (translate drops chars beyond the replacement string)."""
    pairs = [p for p in K.SANITIZE_MAP if p[1]] + [p for p in K.SANITIZE_MAP if not p[1]]
    src = "".join(a for a, _ in pairs)
    dst = "".join(b for _, b in pairs if b)
    return F.translate(text, src, dst)


FENCE = r"```(?:json)?"


def extract_json_text(text: Column) -> Column:
    """SC13: strip code fences; the whole text if it is valid JSON, else the
    span from the first '{' to the last '}' if that is valid JSON, else NULL."""
    stripped = F.regexp_replace(F.regexp_replace(text, FENCE, ""), r"^\s+|\s+$", "")
    span = F.regexp_extract(stripped, r"(?s)\{.*\}", 0)
    whole_ok = F.try_parse_json(stripped).isNotNull()
    span_ok = (span != "") & F.try_parse_json(span).isNotNull()
    return F.when(whole_ok, stripped).when(span_ok, span)


def json_field(json_text: Column, *keys: str) -> Column:
    """First non-empty value among ``keys`` of a JSON object text (SC15)."""
    vals = [F.nullif(F.get_json_object(json_text, f"$.{k}"), F.lit("")) for k in keys]
    return F.coalesce(*vals)


def violation_ids(violations_json: Column, missing: str | None = "unknown") -> Column:
    """SC14 / SEM18: rule ids from a JSON array whose elements are objects
    (``rule_id`` taken) or bare strings; invalid JSON gives an empty array.
    Objects without ``rule_id`` give ``missing`` (``None`` drops them)."""
    arr = F.coalesce(F.from_json(violations_json, ArrayType(StringType())), F.array().cast("array<string>"))

    def rid(e):
        is_obj = F.ltrim(e).startswith("{")
        return F.when(is_obj, F.coalesce(F.get_json_object(e, "$.rule_id"),
                                         F.lit(missing) if missing is not None else F.lit(None).cast("string"))
                      ).otherwise(e)
    ids = F.transform(arr, rid)
    return F.filter(ids, lambda x: x.isNotNull())


def preview(text: Column, n: int = 500) -> Column:
    """SC16: first ``n`` characters."""
    return F.substring(text, 1, n)


def total_tokens(*cols: str) -> Column:
    """SC17: null-propagating sum of token columns."""
    out = None
    for c in cols:
        out = F.col(c) if out is None else out + F.col(c)
    return out


def edited(new: Column, old: Column) -> Column:
    """SC19: trimmed text inequality (was the draft edited?)."""
    return F.trim(F.coalesce(new, F.lit(""))) != F.trim(F.coalesce(old, F.lit("")))


def render(template: str, **values: Column) -> Column:
    """Fill a ``{name}`` template with string columns (built-in format_string)."""
    import re
    names = re.findall(r"\{(\w+)\}", template)
    fmt = re.sub(r"\{\w+\}", "%s", template.replace("%", "%%"))
    return F.format_string(fmt, *[values[n].cast("string") for n in names])
