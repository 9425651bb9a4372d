"""Column roles of the listing tables and the layout of area files.

Delimited sources are read as text and typed by the cleaning policy, so that
an unparseable value is counted instead of failing a read.
"""

from __future__ import annotations

from pyspark.sql import types as T

from lodestay.operators.cleaning import ColumnPolicy

# Columns by role.
SUMMARY_POLICY = ColumnPolicy(
    key="id",
    price="price",
    dates=("last_review",),
    categories=("room_type", "property_type", "neighbourhood", "neighbourhood_cleansed", "neighbourhood_group",
                "host_response_time"),
    integers=("id", "host_id", "minimum_nights", "number_of_reviews", "calculated_host_listings_count",
              "availability_365", "number_of_reviews_ltm", "number_of_reviews_l30d"),
    floats=("latitude", "longitude", "bathrooms", "reviews_per_month", "review_scores_rating",
            "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
            "review_scores_communication", "review_scores_location", "review_scores_value"),
)
DETAILED_POLICY = ColumnPolicy(
    key="id",
    price="price",
    dates=("last_scraped", "host_since", "calendar_last_scraped", "first_review", "last_review"),
    categories=SUMMARY_POLICY.categories,
    booleans=("host_is_superhost", "host_has_profile_pic", "host_identity_verified", "has_availability",
              "instant_bookable"),
    percents=("host_response_rate", "host_acceptance_rate"),
    integers=("id", "scrape_id", "host_id", "host_listings_count", "host_total_listings_count", "accommodates",
              "bedrooms", "beds", "minimum_nights", "maximum_nights", "minimum_minimum_nights",
              "maximum_minimum_nights", "minimum_maximum_nights", "maximum_maximum_nights", "number_of_reviews",
              "number_of_reviews_ltm", "number_of_reviews_l30d", "calculated_host_listings_count",
              "calculated_host_listings_count_entire_homes", "calculated_host_listings_count_private_rooms",
              "calculated_host_listings_count_shared_rooms", "availability_30", "availability_60",
              "availability_90", "availability_365"),
    floats=SUMMARY_POLICY.floats,
)

# Detailed attributes carried into the master, and their names there.
DETAIL_ATTRIBUTES = (
    "id", "property_type", "accommodates", "bathrooms", "bedrooms", "beds", "amenities", "price", "price_raw",
    "maximum_nights", "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "host_listings_count",
    "has_availability", "availability_30", "availability_60", "availability_90", "review_scores_rating",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin", "review_scores_communication",
    "review_scores_location", "review_scores_value", "calculated_host_listings_count_entire_homes",
    "calculated_host_listings_count_private_rooms", "calculated_host_listings_count_shared_rooms",
)
DETAIL_RENAMES = {
    "id": "listing_id", "price": "detailed_price", "price_raw": "detailed_price_raw",
    "property_type": "detailed_property_type",
}


# Geometry is carried, never computed with: only its type and presence matter.
AREA_COLLECTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])
