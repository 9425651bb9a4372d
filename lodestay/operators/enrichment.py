"""Left-preserving enrichment of a canonical population and its derived features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.functions.numeric import ratio
from lodestay.operators.cleaning import GrainError, require_grain
from lodestay.operators.observed import Tally, figures_row
from lodestay.operators.summaries import long_metrics

# Labels of the derived columns.
PRICE_FROM_SUMMARY = "summary_listings"
PRICE_FROM_DETAIL = "detailed_listings"
PRICE_MISSING = "missing"
SEGMENT_SINGLE = "Single-listing host"
SEGMENT_SMALL = "Small multi-listing host (2-5)"
SEGMENT_LARGE = "Large/professional host (6+)"


def tolerant_select(df: DataFrame, wanted: Sequence[str], rename: Mapping[str, str] | None = None) -> DataFrame:
    """The wanted columns that exist, in the wanted order, renamed."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in wanted if c in df.columns])


def left_preserving_join(
    population: DataFrame, attributes: DataFrame, key: str, attribute_key: str, suffixes=("_x", "_y")
) -> DataFrame:
    """Left join that keeps every row of the population exactly once.

    Correct only if ``attributes`` has one row per key (``require_grain``); an
    aggregate grouped by the key has it by construction. A column name found
    on both sides gets a suffix.
    """
    shared = (set(population.columns) & set(attributes.columns)) - {attribute_key}
    left = population.withColumnsRenamed({c: c + suffixes[0] for c in shared if c != key})
    right = attributes.withColumnsRenamed({c: c + suffixes[1] for c in shared})
    right = right.withColumnRenamed(attribute_key, "__key")
    joined = left.join(right, F.col(key) == F.col("__key"), "left").drop("__key")
    return joined


def orphan_keys(attributes: DataFrame, attribute_key: str, population: DataFrame, key: str) -> DataFrame:
    """Distinct attribute keys that are not in the population."""
    known = population.select(F.col(key).alias("__known"))
    keys = attributes.select(F.col(attribute_key)).where(F.col(attribute_key).isNotNull()).distinct()
    return keys.join(known, F.col(attribute_key) == F.col("__known"), "left_anti")


def require_no_orphans(attributes: DataFrame, attribute_key: str, population: DataFrame, key: str, name: str) -> None:
    n = orphan_keys(attributes, attribute_key, population, key).count()
    if n:
        raise GrainError(f"{name}: {n:,} IDs are outside the canonical population.")


# ---- derived features (each skipped when its inputs are absent) --------------

def best_price(df: DataFrame) -> DataFrame:
    """Canonical price first, else the detailed one; and where it came from."""
    if "price" not in df.columns:
        return df
    source = F.when(F.col("price").isNotNull(), PRICE_FROM_SUMMARY)
    price: Column = F.col("price")
    if "detailed_price" in df.columns:
        price = F.coalesce("price", "detailed_price")
        source = source.when(F.col("detailed_price").isNotNull(), PRICE_FROM_DETAIL)
    return df.withColumns({"price_best_available": price, "price_source": source.otherwise(PRICE_MISSING)})


def price_ratios(df: DataFrame) -> DataFrame:
    out = {}
    for name, per in (("price_per_bedroom", "bedrooms"), ("price_per_guest", "accommodates")):
        if "price_best_available" in df.columns and per in df.columns:
            out[name] = ratio("price_best_available", per, 4)
    return df.withColumns(out) if out else df


def portfolio_segment(size: str | Column) -> Column:
    s = F.col(size) if isinstance(size, str) else size
    return (
        F.when(s == 1, SEGMENT_SINGLE).when((s >= 2) & (s <= 5), SEGMENT_SMALL).when(s >= 6, SEGMENT_LARGE)
    )


def derive_features(df: DataFrame) -> DataFrame:
    """Coverage flag, best price, ratios, host segment, review and calendar flags."""
    if "detailed_source_available" in df.columns:
        df = df.withColumn("detailed_source_available", F.coalesce("detailed_source_available", F.lit(False)))
    df = price_ratios(best_price(df))
    if "calculated_host_listings_count" in df.columns:
        size = F.col("calculated_host_listings_count").cast("double")
        df = df.withColumns({"host_portfolio_size": size, "host_portfolio_segment": portfolio_segment(size)})
    if "detailed_review_count" in df.columns:
        count = F.coalesce("detailed_review_count", F.lit(0).cast("bigint"))
        df = df.withColumns({"detailed_review_count": count, "has_review_history": count > 0})
    if "calendar_days_observed" in df.columns:
        df = df.withColumn("calendar_data_available", F.col("calendar_days_observed").isNotNull())
    return df


def require_sides(
    canonical: DataFrame, detail: DataFrame, review_rollup: DataFrame, calendar_rollup: DataFrame, key: str = "id"
) -> None:
    """Raise unless every side of the master is at its grain and no rollup has a key outside the population."""
    require_grain(canonical, "canonical listings", key)
    for df, name in ((detail, "detailed attributes"), (review_rollup, "review rollup"),
                     (calendar_rollup, "calendar rollup")):
        require_grain(df, name, "listing_id")
    require_no_orphans(review_rollup, "listing_id", canonical, key, "review rollup")
    require_no_orphans(calendar_rollup, "listing_id", canonical, key, "calendar rollup")


def build_master(
    canonical: DataFrame,
    detail: DataFrame,
    review_rollup: DataFrame,
    calendar_rollup: DataFrame,
    key: str = "id",
    verify: bool = False,
) -> DataFrame:
    """One row per canonical listing with everything known about it.

    With ``verify`` the grain of every side is proven first and after (each an
    aggregate over keys); without it the plan stays lazy.
    """
    if verify:
        require_sides(canonical, detail, review_rollup, calendar_rollup, key)
    master = canonical
    for side in (detail, review_rollup, calendar_rollup):
        master = left_preserving_join(master, side, key, "listing_id")
    master = derive_features(master)
    if verify:
        require_grain(master, "enriched listing master", key, canonical.count())
    return master


METRIC_NOTES = {
    "detailed_listing_rows": "One-row-per-listing records of the detailed source.",
    "detailed_listing_selected_columns": "Detailed attributes kept, with the source flag.",
    "review_aggregate_rows": "Listings with at least one review event.",
    "total_detailed_reviews_aggregated": "Review events in the rollup.",
    "calendar_aggregate_rows": "Listings in the calendar rollup.",
    "total_calendar_rows_aggregated": "Calendar rows in the rollup.",
    "listings_with_complete_365_day_calendar": "Listings with exactly a full window of calendar rows.",
    "canonical_input_rows": "Canonical population before enrichment.",
    "detailed_listing_matches": "Canonical listings found in the detailed source.",
    "summary_only_listings_preserved": "Canonical listings kept without a detailed match.",
    "final_enriched_rows": "Must equal the canonical population.",
    "final_enriched_columns": "Columns of the enriched master.",
    "price_best_available_non_null": "Listings with a usable price from either source.",
    "listings_with_review_history": "Listings with at least one review event.",
    "listings_with_calendar_data": "Listings with a calendar rollup.",
}


def metric_tallies(detail_columns: int, master_columns: int) -> dict[str, Tally]:
    """What the fifteen audit numbers count, by the table that they are counted in."""
    one = F.count(F.lit(1))

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    return {
        "detail": Tally({
            "detailed_listing_rows": one,
            "detailed_listing_selected_columns": F.max(F.lit(detail_columns)),
        }),
        "reviews": Tally({
            "review_aggregate_rows": one,
            "total_detailed_reviews_aggregated": total("detailed_review_count"),
        }),
        "calendar": Tally({
            "calendar_aggregate_rows": one,
            "total_calendar_rows_aggregated": total("calendar_days_observed"),
            "listings_with_complete_365_day_calendar": F.count_if("calendar_complete_365_day_window"),
        }),
        "canonical": Tally({"canonical_input_rows": one}),
        "master": Tally({
            "detailed_listing_matches": F.count_if("detailed_source_available"),
            "summary_only_listings_preserved": F.count_if(~F.col("detailed_source_available")),
            "final_enriched_rows": one,
            "final_enriched_columns": F.max(F.lit(master_columns)),
            "price_best_available_non_null": F.count("price_best_available"),
            "listings_with_review_history": F.count_if("has_review_history"),
            "listings_with_calendar_data": F.count_if("calendar_data_available"),
        }),
    }


def enrichment_metrics(
    canonical: DataFrame, detail: DataFrame, review_rollup: DataFrame, calendar_rollup: DataFrame, master: DataFrame
) -> DataFrame:
    """The fifteen audit numbers of an enrichment run as (metric, value, notes); a scan of each table."""
    tables = {"detail": detail, "reviews": review_rollup, "calendar": calendar_rollup, "canonical": canonical, "master": master}
    tallies = metric_tallies(len(detail.columns), len(master.columns))
    return reduce(DataFrame.unionByName, [long_metrics(tallies[name].of(df), METRIC_NOTES) for name, df in tables.items()])


def observed_metrics(spark: SparkSession, figures: Mapping[str, object]) -> DataFrame:
    """The same from figures that were counted while the tables were written (``observed.write_observed``)."""
    return long_metrics(figures_row(spark, {name: figures[name] for name in METRIC_NOTES}), METRIC_NOTES)
