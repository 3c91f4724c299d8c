"""Text column expressions: casing, spellings, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_header(name: str) -> str:
    """Column header in canonical spelling; works on names, not on rows."""
    text = name.strip().upper()
    for old, new in (("/", "_"), ("&", "AND"), (" ", "_")):
        text = text.replace(old, new)
    return text


def title_case(value: Column) -> Column:
    """Capital after every non-letter, small letters elsewhere.

    ``initcap`` only breaks words at blanks, so letter runs are cut out first.
    """
    runs = F.regexp_extract_all(F.lower(value), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.concat_ws("", F.transform(runs, F.initcap))


def name_key(value: Column) -> Column:
    """Comparison form of a place name."""
    return F.upper(F.trim(value))


def first_given(*values: Column, default=None) -> Column:
    """First value that is neither null nor empty, else the default."""
    candidates = [F.nullif(v.cast("string"), F.lit("")) for v in values]
    if default is not None:
        candidates.append(F.lit(default))
    return F.coalesce(*candidates)


def place_key(state: Column, district: Column) -> Column:
    return F.concat_ws("::", state, district)


def place_label(state: Column, district: Column) -> Column:
    return F.concat(district, F.lit(" ("), state, F.lit(")"))


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "HH:00")


def contains_any(columns: list[str], query: str) -> Column:
    """Case-insensitive substring test over several columns."""
    hits = [F.contains(F.lower(F.col(c)), F.lit(query.lower())) for c in columns]
    out = hits[0]
    for hit in hits[1:]:
        out = out | hit
    return out
