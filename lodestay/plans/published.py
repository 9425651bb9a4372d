"""The eight published market questions over the enriched master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.operators.summaries import average, group_summary, known, row_count, total, with_share
from lodestay.plans.warehouse import PRICE, host_portfolio_performance, neighbourhood_performance, room_type_performance

MINIMUM_AREA_LISTINGS = 100
MINIMUM_CAPACITY_PRICES = 30


def room_type_pricing(master: DataFrame) -> DataFrame:
    return room_type_performance(master).orderBy(F.desc_nulls_last("median_price"))


def area_pricing(master: DataFrame, minimum: int = MINIMUM_AREA_LISTINGS) -> DataFrame:
    areas = neighbourhood_performance(master).where(F.col("listing_count") >= minimum)
    return areas.orderBy(F.desc_nulls_last("median_price"))


def portfolio_concentration(master: DataFrame) -> DataFrame:
    shares = with_share(host_portfolio_performance(master), "listing_count", "market_supply_percentage", 2, labels_fixed=True)
    return shares.orderBy(F.desc("listing_count"))


def superhost_comparison(master: DataFrame) -> DataFrame:
    label = F.when(F.col("host_is_superhost"), "Superhost").otherwise("Non-superhost")
    rows = master.where(F.col("host_is_superhost").isNotNull()).withColumn("superhost_status", label)
    out = group_summary(
        rows,
        ["superhost_status"],
        {
            "listing_count": row_count(),
            "listings_with_price": known(PRICE),
            "average_price": average(PRICE, 2),
            "listings_with_review_score": known("review_scores_rating"),
            "average_review_score": average("review_scores_rating", 3),
            "total_review_events": total("detailed_review_count"),
            "average_reviews_per_listing": average("detailed_review_count", 2),
            "average_unavailability_rate_proxy": average("unavailability_rate_proxy", 4),
        },
        {"median_price": (PRICE, 0.5, 2)},
    )
    return out.select(
        "superhost_status", "listing_count", "listings_with_price", "average_price", "median_price",
        "listings_with_review_score", "average_review_score", "total_review_events", "average_reviews_per_listing",
        "average_unavailability_rate_proxy",
    ).orderBy(F.desc("superhost_status"))


def area_review_activity(master: DataFrame, minimum: int = MINIMUM_AREA_LISTINGS) -> DataFrame:
    areas = neighbourhood_performance(master).where(F.col("listing_count") >= minimum)
    return areas.select(
        "neighbourhood", "listing_count", "total_review_events", "avg_reviews_per_listing", "median_price",
        "avg_review_score",
    ).orderBy(F.desc("total_review_events"))


def quality_screening(master: DataFrame, minimum_reviews: int = 50, below_score: float = 4.5) -> DataFrame:
    """Much-reviewed listings with a low score."""
    rows = master.where((F.col("detailed_review_count") >= minimum_reviews) & (F.col("review_scores_rating") < below_score))
    return rows.select(
        F.col("id").alias("listing_id"), "name", "neighbourhood", "room_type", PRICE, "review_scores_rating",
        "detailed_review_count", "review_events_per_active_year", "host_is_superhost", "host_portfolio_segment",
    ).orderBy(F.desc("detailed_review_count"), F.asc("review_scores_rating"))


def area_availability(master: DataFrame, minimum: int = MINIMUM_AREA_LISTINGS) -> DataFrame:
    areas = neighbourhood_performance(master).where(F.col("listing_count") >= minimum)
    return areas.select(
        "neighbourhood", "listing_count", "avg_availability_rate", "avg_unavailability_rate_proxy", "median_price",
        "total_review_events",
    ).orderBy(F.desc_nulls_last("avg_unavailability_rate_proxy"))


def capacity_pricing(master: DataFrame, minimum: int = MINIMUM_CAPACITY_PRICES) -> DataFrame:
    rows = master.where((F.col("accommodates") > 0) & F.col(PRICE).isNotNull()).select("accommodates", PRICE)
    out = group_summary(
        rows,
        ["accommodates"],
        {
            "listing_count": row_count(),
            "listings_with_price": known(PRICE),
            "average_price": average(PRICE, 2),
        },
        {"median_price": (PRICE, 0.5, 2), "price_q1": (PRICE, 0.25, 2), "price_q3": (PRICE, 0.75, 2)},
    )
    return out.where(F.col("listings_with_price") >= minimum).orderBy("accommodates")
