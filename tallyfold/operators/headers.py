"""Mapping of drifting source headers onto the canonical columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.numbers import lenient_int, total_of
from tallyfold.functions.text import canonical_header
from tallyfold.schema import DISTRICT, HEADS, STATE, TOTAL, YEAR

# Header spellings of the keys.
KEY_HEADERS = {
    STATE: ("STATE_UT", "STATES_UTS", "STATE"),
    DISTRICT: ("DISTRICT", "DISTRICTS"),
    YEAR: ("YEAR",),
}


@dataclass(frozen=True)
class HeadRule:
    """Sends a header to ``target`` if it has all ``words`` and none of ``without``."""

    target: str
    words: tuple[str, ...] = ()
    without: tuple[str, ...] = ()
    prefix: str = ""

    def takes(self, header: str) -> bool:
        return (header.startswith(self.prefix)
                and all(w in header for w in self.words)
                and not any(w in header for w in self.without))


# Header patterns; the first rule that takes a header decides.
HEAD_RULES = [
    HeadRule(TOTAL, ("TOTAL", "IPC")),
    HeadRule("MURDER", prefix="MURDER"),
    HeadRule("ATTEMPT_TO_MURDER", ("ATTEMPT", "MURDER")),
    HeadRule("CULPABLE_HOMICIDE", ("CULPABLE_HOMICIDE",)),
    HeadRule("RAPE", ("RAPE",), without=("ATTEMPT", "CUSTODIAL")),
    HeadRule("KIDNAPPING_ABDUCTION", ("KIDNAPPING",)),
    HeadRule("DACOITY", ("DACOITY",)),
    HeadRule("ROBBERY", ("ROBBERY",)),
    HeadRule("BURGLARY", ("BURGLARY",)),
    HeadRule("AUTO_THEFT", ("AUTO_THEFT",)),
    HeadRule("THEFT", ("THEFT",)),
    HeadRule("RIOTS", ("RIOTS",)),
    HeadRule("CHEATING", ("CHEATING",)),
    HeadRule("ARSON", ("ARSON",)),
    HeadRule("HURT", ("HURT",)),
    HeadRule("DOWRY_DEATHS", ("DOWRY",)),
    HeadRule("ASSAULT_ON_WOMEN", ("ASSAULT_ON_WOMEN",)),
    HeadRule("INSULT_TO_MODESTY_OF_WOMEN", ("INSULT", "MODESTY")),
    HeadRule("CRUELTY_BY_HUSBAND", ("CRUELTY", "HUSBAND")),
]


def rules_in_force(strict_compat: bool = False) -> list[HeadRule]:
    """The rules, or with ``strict_compat`` the historical set.

    Historically vehicle theft was counted as theft and insults had no rule.
    """
    if not strict_compat:
        return HEAD_RULES
    return [r for r in HEAD_RULES
            if r.target not in ("AUTO_THEFT", "INSULT_TO_MODESTY_OF_WOMEN")]


def assign_headers(columns: list[str], strict_compat: bool = False) -> dict[str, list[str]]:
    """Canonical column -> source columns feeding it. Looks at names only."""
    rules = rules_in_force(strict_compat)
    keys = {spelling: key for key, names in KEY_HEADERS.items() for spelling in names}
    out: dict[str, list[str]] = {}
    for column in columns:
        header = canonical_header(column)
        target = keys.get(header)
        if target is None:
            target = next((r.target for r in rules if r.takes(header)), None)
        if target is not None:
            out.setdefault(target, []).append(column)
    return out


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def unify_headers(df: DataFrame, strict_compat: bool = False,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Canonical fact rows from one raw source with text columns.

    Heads fed by several columns add up, the total takes the largest. The
    result is one projection and one filter over the scan.
    """
    feeds = assign_headers([c for c in df.columns if c not in keep], strict_compat)

    def key_text(name):
        source = feeds.get(name)
        if not source:
            return F.lit("")
        return F.upper(F.replace(F.trim(_quoted(source[-1])), F.lit(","), F.lit("")))

    def head(name):
        values = [lenient_int(_quoted(c)) for c in feeds.get(name, [])]
        out = F.lit(0).cast("bigint")
        for value in values:
            out = out + value
        return out.alias(name)

    totals = [lenient_int(_quoted(c)) for c in feeds.get(TOTAL, [])]
    total = F.greatest(F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), *totals)
    year = (lenient_int(_quoted(feeds[YEAR][-1])).try_cast("int")
            if YEAR in feeds else F.lit(0))
    out = df.select(
        key_text(STATE).alias(STATE), key_text(DISTRICT).alias(DISTRICT),
        F.coalesce(year, F.lit(0)).alias(YEAR),
        *[head(h) for h in HEADS], total.alias(TOTAL), *keep)
    return valid_rows(derive_total(out))


def derive_total(df: DataFrame, heads: list[str] | None = None, total: str = TOTAL) -> DataFrame:
    """Sum of the heads where no total was reported."""
    summed = total_of(heads or HEADS)
    return df.withColumn(total, F.when(F.coalesce(F.col(total), F.lit(0)) == 0, summed)
                         .otherwise(F.col(total)))


def valid_rows(df: DataFrame) -> DataFrame:
    """Rows with both place names and a usable year."""
    return df.filter((F.length(F.coalesce(F.col(STATE), F.lit(""))) > 0)
                     & (F.length(F.coalesce(F.col(DISTRICT), F.lit(""))) > 0)
                     & (F.col(YEAR) > 0))
