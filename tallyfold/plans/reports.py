"""Report documents, each from the feature table, written as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import calendar, profiles, rollups
from tallyfold.operators.enrich import with_region
from tallyfold.sources.documents import write_document, write_json_lines


def hotspot_document(features: DataFrame, path: str) -> None:
    """Twenty largest districts, fifty hotspots and all states, largest first."""
    sections = {
        "top_20_districts": rollups.top_districts(features, 20),
        "top_50_hotspots": rollups.hotspots(features, 50),
        "state_rankings": rollups.state_rollup(features),
    }
    by_size = [-F.col("total_crimes"), F.col("state")]
    write_document(sections, path, {
        "top_20_districts": by_size + [F.col("district")],
        "top_50_hotspots": by_size + [F.col("district")],
        "state_rankings": by_size}, growing=("state_rankings",))


def time_document(features: DataFrame, path: str) -> None:
    """Yearly sums, seasonal shares, hour matrix and the grand total."""
    latest = rollups.latest_year(features).select("total_crimes")
    cells = calendar.apportion_week(latest)
    write_document({
        "yearly_trends": rollups.year_rollup(features),
        "seasonal_breakdown": calendar.apportion_seasons(latest),
        "heatmap_matrix": calendar.week_matrix(cells, "expected"),
        "totals": rollups.grand_total(features),
    }, path, {"yearly_trends": [F.col("year")], "heatmap_matrix": [F.col("hour")]})


def trend_document(features: DataFrame, clean: DataFrame, recovery: DataFrame, path: str) -> None:
    write_document({
        "category_trends": rollups.year_rollup(features),
        "property_financial_trends": rollups.property_recovery(recovery),
        "women_crimes_state_rankings": rollups.women_ranking(clean),
    }, path, {"category_trends": [F.col("year")], "property_financial_trends": [F.col("year")],
              "women_crimes_state_rankings": [-F.col("total_crimes_against_women"), F.col("state")]},
       growing=("women_crimes_state_rankings",))


def region_document(features: DataFrame, path: str, regions: DataFrame | None = None) -> None:
    known = with_region(features, regions)
    states = rollups.region_states(known)
    write_document({
        "regions": rollups.region_totals(known), "states": states,
        "region_map": states.select("state", "region"),
    }, path, {"regions": [F.col("region")], "states": [-F.col("total_crimes"), F.col("state")],
              "region_map": [F.col("state")]}, growing=("states", "region_map"))


def snapshot_lines(features: DataFrame, path: str) -> None:
    """One JSON line per year with national sums and top districts; states in ``<path>_states``.

    A year may have any number of states, so each is a line of its own there.
    """
    grains = rollups.yearly_grains(features)
    national = grains.filter(F.col("state").isNull()).select(
        "year", F.col("total_crimes").alias("national_total"),
        F.col("violent_crimes").alias("national_violent"),
        F.col("women_crimes").alias("national_women"),
        F.col("violent_pct").alias("national_violent_pct"))
    by_state = grains.filter(F.col("state").isNotNull())
    write_json_lines(by_state.select("year", "state", "total_crimes", "violent_crimes", "women_crimes",
                                     "property_crimes", "violent_pct"), f"{path}_states")
    top = rollups.yearly_top_districts(features)
    ranked = top.groupBy("year").agg(F.sort_array(F.collect_list(F.struct(
        "rank", *[c for c in top.columns if c not in ("year", "rank")]))).alias("top_districts"))
    write_json_lines(national.join(ranked, "year"), path)


def profile_document(features: DataFrame, path: str, k: int = 150) -> None:
    rows = profiles.place_profiles(features, k)
    shaped = rows.select(*[c for c in rows.columns if c not in profiles.SHARES],
                         F.struct(*profiles.SHARES).alias("dna"))
    write_document({"districts": shaped}, path, {
        "districts": [-F.col("total_crimes"), F.col("state"), F.col("district")]})
