"""Exploratory tables over the enriched master and over the raw facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.functions.numeric import rounded
from lodestay.operators import summaries as S
from lodestay.plans.warehouse import PRICE

CORRELATED = (
    PRICE, "accommodates", "bedrooms", "beds", "review_scores_rating", "detailed_review_count",
    "unavailability_rate_proxy", "host_portfolio_size",
)


def coverage_summary(master: DataFrame, key: str = "id") -> DataFrame:
    return master.agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.count_distinct(key).alias("unique_listing_ids"),
        F.count_if(F.col(key).isNull()).alias("missing_listing_ids"),
        F.count_if("detailed_source_available").alias("detailed_source_matches"),
        F.count_if(~F.col("detailed_source_available")).alias("summary_only_listings"),
        F.count_if("has_review_history").alias("listings_with_reviews"),
        F.count_if("calendar_data_available").alias("listings_with_calendar_data"),
        F.count(PRICE).alias("listings_with_price"),
    )


def listing_counts(master: DataFrame, group: str = "neighbourhood") -> DataFrame:
    counts = master.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("listing_count"))
    return counts.orderBy(F.desc("listing_count"), F.asc(group))


def price_summary(master: DataFrame, group: str = "neighbourhood", minimum: int = 0) -> DataFrame:
    """Price level and quartiles per group; ``minimum`` is the support a chart asks for."""
    out = S.group_summary(
        master.select(group, PRICE),
        [group],
        {
            "total_listings": S.row_count(),
            "listings_with_price": S.known(PRICE),
            "avg_price": S.average(PRICE, 2),
        },
        {"median_price": (PRICE, 0.5, 2), "price_q1": (PRICE, 0.25, 2), "price_q3": (PRICE, 0.75, 2)},
        drop_null_groups=True,
    )
    return out.where(F.col("listings_with_price") >= minimum).orderBy(F.desc_nulls_last("median_price"))


def review_activity(master: DataFrame, group: str = "neighbourhood", n: int | None = None) -> DataFrame:
    out = S.group_summary(
        master.select(group, "detailed_review_count", "has_review_history"),
        [group],
        {
            "listing_count": S.row_count(),
            "total_review_events": S.total("detailed_review_count"),
            "avg_reviews_per_listing": S.average("detailed_review_count", 2),
            "listings_with_reviews": S.rows_where(F.col("has_review_history")),
        },
        {"median_reviews_per_listing": ("detailed_review_count", 0.5, 2)},
        drop_null_groups=True,
    )
    order = [F.desc("total_review_events"), F.asc(group)]
    return out.orderBy(*order) if n is None else S.top_rows(out, order, n)


def availability_proxy(master: DataFrame, group: str = "neighbourhood") -> DataFrame:
    out = S.group_summary(
        master.select(group, "availability_rate_observed", "unavailability_rate_proxy"),
        [group],
        {
            "listing_count": S.row_count(),
            "avg_availability_rate": S.average("availability_rate_observed", 4),
            "avg_unavailability_rate_proxy": S.average("unavailability_rate_proxy", 4),
        },
        {"median_unavailability_rate_proxy": ("unavailability_rate_proxy", 0.5, 4)},
        drop_null_groups=True,
    )
    return out.orderBy(F.desc_nulls_last("avg_unavailability_rate_proxy"))


def price_by_capacity(master: DataFrame, minimum: int = 0) -> DataFrame:
    out = S.group_summary(
        master.where(F.col("accommodates") > 0).select("accommodates", PRICE),
        ["accommodates"],
        {
            "total_listings": S.row_count(),
            "listings_with_price": S.known(PRICE),
            "avg_price": S.average(PRICE, 2),
        },
        {"median_price": (PRICE, 0.5, 2)},
    )
    return out.where(F.col("listings_with_price") >= minimum).orderBy("accommodates")


def price_distribution(master: DataFrame) -> DataFrame:
    return S.group_summary(
        master.select(PRICE),
        [],
        {
            "non_null_price_count": S.known(PRICE),
            "min_price": S.least(PRICE),
            "max_price": S.greatest(PRICE),
            "avg_price": S.average(PRICE, 2),
        },
        {"q1": (PRICE, 0.25, 2), "median_price": (PRICE, 0.5, 2), "q3": (PRICE, 0.75, 2)},
    )


def trimmed_histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Histogram of the values at or below the upper fence (view only)."""
    bounds = S.iqr_bounds(df, column).select("upper_bound")
    kept = df.select(column).crossJoin(F.broadcast(bounds)).where(F.col(column) <= F.col("upper_bound"))  # one row
    return S.histogram(kept, column, bins)


def headline_metrics(master: DataFrame, review_fact: DataFrame, calendar_fact: DataFrame) -> DataFrame:
    """Coverage and fact totals as (metric, value) rows, all computed."""
    return (
        S.long_metrics(coverage_summary(master))
        .unionByName(S.long_metrics(review_fact.agg(F.sum("detailed_review_count").alias("total_review_events"))))
        .unionByName(S.long_metrics(calendar_fact.agg(F.sum("calendar_days_observed").alias("total_calendar_rows"))))
    )


# ---- raw facts: two-level aggregates, rows per key first ----------------------

def rows_per_key_summary(df: DataFrame, key: str, distinct: str) -> DataFrame:
    per_key = S.rows_per_key(df, key, distinct)
    return per_key.agg(
        F.count(F.lit(1)).alias("keys"),
        F.min("row_count").alias("min_rows"), F.max("row_count").alias("max_rows"),
        rounded(F.avg("row_count"), 4).alias("avg_rows"),
        F.min("distinct_count").alias("min_distinct"), F.max("distinct_count").alias("max_distinct"),
        rounded(F.avg("distinct_count"), 4).alias("avg_distinct"),
    )


def rows_per_key_histogram(df: DataFrame, key: str) -> DataFrame:
    return S.rows_per_key(df, key).groupBy("row_count").agg(F.count(F.lit(1)).alias("keys"))


def window_ranges(df: DataFrame, key: str, day: str) -> DataFrame:
    """How many keys share each (first day, last day, distinct days)."""
    per_key = df.groupBy(key).agg(
        F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count_distinct(day).alias("distinct_dates")
    )
    return per_key.groupBy("first_date", "last_date", "distinct_dates").agg(F.count(F.lit(1)).alias("keys"))


def per_key_flag_summary(df: DataFrame, key: str, flag: str) -> DataFrame:
    """Minimum, maximum and average per key of flagged rows, unflagged rows and the flagged share."""
    per_key = df.groupBy(key).agg(
        F.count_if(F.coalesce(F.col(flag), F.lit(False))).alias("yes"),
        F.count_if(F.coalesce(~F.col(flag), F.lit(False))).alias("no"),
        F.count(F.lit(1)).alias("rows"),
    ).withColumn("share", F.col("yes") / F.col("rows"))
    return per_key.agg(
        F.min("yes").alias("min_available"), F.max("yes").alias("max_available"),
        rounded(F.avg("yes"), 4).alias("avg_available"),
        F.min("no").alias("min_unavailable"), F.max("no").alias("max_unavailable"),
        rounded(F.avg("no"), 4).alias("avg_unavailable"),
        rounded(F.min("share"), 6).alias("min_rate"), rounded(F.max("share"), 6).alias("max_rate"),
        rounded(F.avg("share"), 6).alias("avg_rate"),
    )


def extreme_rows(df: DataFrame, first: str, second: str, ties: list[str], n: int = 20) -> DataFrame:
    """The ``n`` rows with the largest values; a top-N per partition, no full sort."""
    order = [F.desc_nulls_last(first), F.desc_nulls_last(second), *[F.asc(t) for t in ties]]
    return S.top_rows(df, order, n)


def events_per_key(df: DataFrame, key: str, digits: int = 2) -> DataFrame:
    per_key = S.rows_per_key(df.where(F.col(key).isNotNull()), key)
    return S.group_summary(
        per_key, [],
        {
            "keys": S.row_count(), "min_events": S.least("row_count"), "max_events": S.greatest("row_count"),
            "avg_events": S.average("row_count", digits),
        },
        {"median_events": ("row_count", 0.5, digits)},
    )


def busiest_keys(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    return S.top_rows(S.rows_per_key(df, key), [F.desc("row_count"), F.asc(key)], n)


def repeat_keys(df: DataFrame, key: str) -> DataFrame:
    """How many keys occur more than once."""
    per_key = S.rows_per_key(df.where(F.col(key).isNotNull()), key)
    return per_key.agg(F.count_if(F.col("row_count") > 1).alias("repeat_keys"))
