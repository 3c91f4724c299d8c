"""Coordinates for place names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.constants import NATIONAL_CENTROID
from tallyfold.functions.hashing import name_jitter
from tallyfold.functions.text import name_key
from tallyfold.schema import DISTRICT, LAT, LON


def exact_places(names: DataFrame, places: DataFrame, name: str, state: str | None = None,
                 any_state: bool = False) -> DataFrame:
    """Gazetteer columns by equal name; every input row is kept once.

    Of several entries the earliest counts. With ``state`` an entry of the same state goes
    first, then one by name alone, the latter only where all entries of that name are of one
    state; ``any_state`` goes by name alone.
    """
    entry = F.struct(*places.columns)
    by_name = places.groupBy(F.col("gaz_name").alias("_called")).agg(
        F.min_by(entry, "position").alias("_any"),
        (F.countDistinct(F.coalesce("gaz_state", F.lit(""))) == 1).alias("_sole"))
    found = names.join(by_name, F.col(name) == F.col("_called"), "left")
    hit = F.col("_any")
    if state and not any_state:
        here = places.groupBy(F.col("gaz_name").alias("_here_name"), F.col("gaz_state").alias("_here_state")).agg(
            F.min_by(entry, "position").alias("_here"))
        found = found.join(here, (F.col(name) == F.col("_here_name")) & (F.col(state) == F.col("_here_state")), "left")
        hit = F.coalesce("_here", F.when(F.col("_sole"), F.col("_any")))
    return found.select(*names.columns, hit.alias("_hit")).select(*names.columns, "_hit.*")


#: Characters of a gram in the index of parts of names.
GRAM = 3


def _grams(text, size):
    """All parts of one length, each once; none of a shorter text."""
    return F.when(F.length(text) >= size, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1), lambda at: F.substring(text, at, F.lit(size))))).otherwise(
        F.array().cast("array<string>"))


def contained_pairs(small: DataFrame, large: DataFrame, scope: list[str], gram: int = GRAM) -> DataFrame:
    """(scope, small, large) where a text of ``small`` is a part of one of ``large``; both have distinct, non-empty texts.

    ``large`` is indexed by its grams, as many as it has characters. A small text looks up the one of its grams
    that fewest large texts have, and what the index returns is verified by ``contains``; one with a gram that no large text
    has needs no look. Texts shorter than a gram meet the index of parts of their own length, if there are any.
    """
    indexed = large.select(*scope, "large", F.explode(_grams(F.col("large"), gram)).alias("_gram"))
    common = indexed.groupBy(*scope, "_gram").agg(F.count(F.lit(1)).alias("_held"))
    asked = small.where(F.length("small") >= gram).select(*scope, "small", F.explode(_grams(F.col("small"), gram)).alias("_gram"))
    rarest = asked.join(common, [*scope, "_gram"], "left").groupBy(*scope, "small").agg(
        F.min_by("_gram", F.struct("_held", "_gram")).alias("_gram"),
        F.count_if(F.col("_held").isNull()).alias("_absent")).where("_absent = 0").drop("_absent")
    found = rarest.join(indexed, [*scope, "_gram"]).where(F.contains("large", "small"))
    out = found.select(*scope, "small", "large")
    for size in range(1, gram):
        short = small.where(F.length("small") == size).select(*scope, "small", F.col("small").alias("_gram"))
        parts = large.select(*scope, "large", F.explode(_grams(F.col("large"), size)).alias("_gram"))
        out = out.unionByName(short.join(parts, [*scope, "_gram"]).select(*scope, "small", "large"))
    return out


def containing_places(names: DataFrame, places: DataFrame, name: str,
                      state: str | None = None) -> DataFrame:
    """First gazetteer entry whose name contains, or is contained in, ``name``.

    Substring tests would pair every name with every entry. Instead both sides are indexed by short grams
    (``contained_pairs``), after reducing each to distinct texts and the entries to the earliest one per
    text, so the rows built grow with the length of the names and not with their product. With
    ``state`` only entries of the same state count.

    Returns distinct (state, name) with the winning entry's columns; names
    without a match are absent.
    """
    scope = [state] if state else []
    entry_scope = [F.col("gaz_state").alias(state)] if state else []
    asked = names.select(*scope, name).filter(F.length(name) > 0).distinct()
    entry = F.struct("position", "gaz_name", "gaz_lat", "gaz_lon")
    entries = places.filter(F.length("gaz_name") > 0).groupBy(*entry_scope, F.col("gaz_name").alias("_text")).agg(
        F.min(entry).alias("_hit"))
    texts = entries.select(*scope, "_text")
    inside = contained_pairs(texts.withColumnRenamed("_text", "small"), asked.withColumnRenamed(name, "large"), scope).select(
        *scope, F.col("large").alias(name), F.col("small").alias("_text"))
    outside = contained_pairs(asked.withColumnRenamed(name, "small"), texts.withColumnRenamed("_text", "large"), scope).select(
        *scope, F.col("small").alias(name), F.col("large").alias("_text"))
    return (inside.unionByName(outside).join(entries, scope + ["_text"])
            .groupBy(*scope, name).agg(F.min("_hit").alias("_hit"))
            .select(*scope, name, "_hit.*"))


def locate(df: DataFrame, places: DataFrame, centroids: DataFrame, state: str = "STATE_RAW",
           district: str = DISTRICT, strict_compat: bool = False,
           names: DataFrame | None = None) -> DataFrame:
    """Adds latitude, longitude and how they were found.

    Tried in turn: the district by name in its state, the district by name where only one
    state has it, a district of the same state whose
    name overlaps, the state's centroid moved by a per-name jitter, the national
    centroid. ``strict_compat`` lets any state's equal or overlapping name match.

    Only distinct (state, district) pairs are looked up and joined back. Where a
    table of all places exists, give it as ``names`` (same two columns): the
    lookup then does not have to read the facts for their names.
    """
    asked = (df if names is None else names).select(name_key(F.col(state)).alias("_state"),
                      name_key(F.col(district)).alias("_name"),
                      F.trim(F.col(district)).alias("_shown")).distinct()
    exact = exact_places(asked, places, "_name", "_state", strict_compat)
    unmatched = exact.filter(F.col("gaz_name").isNull()).select("_state", "_name")
    if strict_compat:
        near = containing_places(unmatched, places, "_name")
        on = ["_name"]
    else:
        near = containing_places(unmatched, places, "_name", "_state")
        on = ["_state", "_name"]
    near = near.select(*on, F.col("gaz_lat").alias("_near_lat"), F.col("gaz_lon").alias("_near_lon"))
    tried = (exact.join(near, on, "left")
             .join(centroids, F.col("_state") == F.col("centroid_state"), "left"))
    jitter = name_jitter(F.col("_shown"))

    def pick(found, close, centre, default):
        return F.coalesce(found, close, F.round(centre + jitter, 4), F.lit(default))

    resolved = tried.select(
        "_state", "_name", "_shown",
        pick(F.col("gaz_lat"), F.col("_near_lat"), F.col("centroid_lat"),
             NATIONAL_CENTROID[0]).alias(LAT),
        pick(F.col("gaz_lon"), F.col("_near_lon"), F.col("centroid_lon"),
             NATIONAL_CENTROID[1]).alias(LON),
        F.when(F.col("gaz_lat").isNotNull(), F.lit("exact"))
        .when(F.col("_near_lat").isNotNull(), F.lit("overlap"))
        .when(F.col("centroid_lat").isNotNull(), F.lit("state"))
        .otherwise(F.lit("national")).alias("LOCATED_BY"))
    keyed = df.withColumns({"_state": name_key(F.col(state)),
                            "_name": name_key(F.col(district)),
                            "_shown": F.trim(F.col(district))})
    return keyed.join(resolved, ["_state", "_name", "_shown"], "left").drop(
        "_state", "_name", "_shown")


def within_box(df: DataFrame, south: float = 6.0, north: float = 38.0,
               west: float = 68.0, east: float = 98.0) -> DataFrame:
    """Rows whose coordinates are present and inside the bounding box."""
    return df.filter(F.col(LAT).between(south, north) & F.col(LON).between(west, east))
