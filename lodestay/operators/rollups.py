"""Many-per-key facts -> one row per key, before any join.

Plain grouped aggregates: partial aggregation on the map side leaves one row
per key and task, so a hot listing costs no more than a quiet one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.functions.numeric import rounded
from lodestay.functions import parse

DAYS_PER_YEAR = 365.25
MINIMUM_SPAN_DAYS = 30
FULL_WINDOW_DAYS = 365


def events_per_year(count: str, span: str, minimum_span: int = MINIMUM_SPAN_DAYS, digits: int = 4):
    """Events per active year; NULL for a span too short to say."""
    rate = F.col(count) * F.lit(DAYS_PER_YEAR) / F.col(span)
    return F.when(F.col(span) >= minimum_span, rounded(rate, digits))


def event_rollup(
    events: DataFrame,
    key: str = "listing_id",
    date: str = "date",
    actor: str = "reviewer_id",
    actor_name: str = "reviewer_name",
    text: str = "comments",
) -> DataFrame:
    """Per key: events, first and last day, span, distinct actors, missing names, missing texts, yearly rate."""
    day = parse.date(date) if dict(events.dtypes)[date] == "string" else F.col(date).cast("date")
    out = (
        events.select(
            F.col(key).alias("listing_id"),
            day.alias("day"),
            F.col(actor).alias("actor"),
            parse.is_blank(actor_name).alias("no_name"),
            parse.is_blank(text).alias("no_text"),
        )
        .groupBy("listing_id")
        .agg(
            F.count(F.lit(1)).alias("detailed_review_count"),
            F.min("day").alias("first_detailed_review_date"),
            F.max("day").alias("last_detailed_review_date"),
            F.count_distinct("actor").alias("unique_reviewer_count"),
            F.count_if("no_name").alias("missing_reviewer_name_count"),
            F.count_if("no_text").alias("missing_comment_count"),
        )
        .withColumn(
            "review_span_days",
            F.date_diff("last_detailed_review_date", "first_detailed_review_date").cast("bigint"),
        )
    )
    out = out.withColumn("review_events_per_active_year", events_per_year("detailed_review_count", "review_span_days"))
    return out.select(
        "listing_id", "detailed_review_count", "first_detailed_review_date", "last_detailed_review_date",
        "review_span_days", "unique_reviewer_count", "missing_reviewer_name_count", "missing_comment_count",
        "review_events_per_active_year",
    )


def normalised_calendar(
    calendar: DataFrame,
    key: str = "listing_id",
    date: str = "date",
    available: str = "available",
    minimum_nights: str = "minimum_nights",
    maximum_nights: str = "maximum_nights",
) -> DataFrame:
    """Tolerantly typed calendar rows."""
    day = parse.date(date) if dict(calendar.dtypes)[date] == "string" else F.col(date).cast("date")
    return calendar.select(
        F.col(key).alias("listing_id"),
        day.alias("day"),
        parse.boolean(available).alias("is_available"),
        parse.number(minimum_nights).alias("min_nights"),
        parse.number(maximum_nights).alias("max_nights"),
    )


def calendar_rollup(normalised: DataFrame, full_window: int = FULL_WINDOW_DAYS) -> DataFrame:
    """Per listing: observed days, availability counts and rates (all, weekend, weekday), stay rules.

    Rates are over all observed rows. ``unavailability_rate_proxy`` is a proxy,
    not occupancy: an unavailable night may simply be blocked.
    """
    yes = F.coalesce(F.col("is_available"), F.lit(False))
    no = F.coalesce(~F.col("is_available"), F.lit(False))
    dow = F.dayofweek("day")  # 1 = Sunday, 7 = Saturday
    weekend = F.coalesce(dow.isin(1, 7), F.lit(False))
    weekday = F.coalesce(~dow.isin(1, 7), F.lit(False))

    def rate(part: str, whole: str):
        return rounded(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), 6)

    out = normalised.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("calendar_days_observed"),
        F.count_if(yes).alias("available_days"),
        F.count_if(no).alias("unavailable_days"),
        F.min("day").alias("calendar_start_date"),
        F.max("day").alias("calendar_end_date"),
        F.count_if(weekend).alias("weekend_days_observed"),
        F.count_if(weekend & yes).alias("available_weekend_days"),
        F.count_if(weekday).alias("weekday_days_observed"),
        F.count_if(weekday & yes).alias("available_weekday_days"),
        rounded(F.avg("min_nights"), 4).alias("calendar_avg_minimum_nights"),
        F.min("min_nights").alias("calendar_minimum_nights_min"),
        F.max("min_nights").alias("calendar_minimum_nights_max"),
        rounded(F.avg("max_nights"), 4).alias("calendar_avg_maximum_nights"),
    )
    return out.select(
        "listing_id",
        "calendar_days_observed",
        "available_days",
        "unavailable_days",
        rate("available_days", "calendar_days_observed").alias("availability_rate_observed"),
        rate("unavailable_days", "calendar_days_observed").alias("unavailability_rate_proxy"),
        "calendar_start_date",
        "calendar_end_date",
        "weekend_days_observed",
        "available_weekend_days",
        rate("available_weekend_days", "weekend_days_observed").alias("weekend_availability_rate"),
        "weekday_days_observed",
        "available_weekday_days",
        rate("available_weekday_days", "weekday_days_observed").alias("weekday_availability_rate"),
        "calendar_avg_minimum_nights",
        "calendar_minimum_nights_min",
        "calendar_minimum_nights_max",
        "calendar_avg_maximum_nights",
        (F.col("calendar_days_observed") == full_window).alias("calendar_complete_365_day_window"),
    )
