"""The derived market as SQL common table expressions (see ``market``)."""

from __future__ import annotations

from lodestay.suite import market as M


def _columns(columns: dict) -> str:
    return ",\n    ".join(f"{M.in_sql(e)} AS {c}" for c, e in columns.items())


def _blank(c: str) -> str:
    return f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END"


def _money(c: str) -> str:
    return f"TRY_CAST(trim(replace(replace({c}, '$', ''), ',', '')) AS DOUBLE)"


def _whole(c: str) -> str:
    return f"CAST(TRY_CAST({c} AS DOUBLE) AS BIGINT)"


def _flag(c: str) -> str:
    return (
        f"CASE WHEN lower(trim({c})) IN ('t','true','1','yes','y') THEN TRUE "
        f"WHEN lower(trim({c})) IN ('f','false','0','no','n') THEN FALSE END"
    )


def _day(c: str) -> str:
    return f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({c} AS DATE) END"


RAW_CTES = f"""
raw_listings AS (SELECT {_columns(M.RAW_LISTINGS)}
  FROM {M.LISTING_SOURCE}),
raw_detail AS (SELECT {_columns(M.RAW_DETAIL)}
  FROM {M.LISTING_SOURCE} WHERE o_orderstatus <> 'P'),
raw_reviews AS (SELECT {_columns(M.RAW_REVIEWS)} FROM lineitem),
raw_calendar AS (SELECT {_columns(M.RAW_CALENDAR)} FROM lineitem)"""

CLEAN_CTES = f"""
listings AS (SELECT
    CAST(id AS BIGINT) AS id, name, {_whole('host_id')} AS host_id, host_name,
    NULLIF(trim(neighbourhood_group), '') AS neighbourhood_group,
    NULLIF(trim(neighbourhood), '') AS neighbourhood,
    TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude,
    NULLIF(trim(room_type), '') AS room_type,
    {_blank('price')} AS price_raw, {_money('price')} AS price,
    {_whole('minimum_nights')} AS minimum_nights, {_whole('number_of_reviews')} AS number_of_reviews,
    {_day('last_review')} AS last_review, TRY_CAST(reviews_per_month AS DOUBLE) AS reviews_per_month,
    {_whole('calculated_host_listings_count')} AS calculated_host_listings_count,
    {_whole('availability_365')} AS availability_365, {_whole('number_of_reviews_ltm')} AS number_of_reviews_ltm,
    {_blank('license')} AS license
  FROM raw_listings),
detail AS (SELECT
    CAST(id AS BIGINT) AS listing_id, NULLIF(trim(property_type), '') AS detailed_property_type,
    {_whole('accommodates')} AS accommodates, TRY_CAST(bathrooms AS DOUBLE) AS bathrooms,
    {_whole('bedrooms')} AS bedrooms, TRY_CAST(beds AS DOUBLE) AS beds,
    {_blank('price')} AS detailed_price_raw, {_money('price')} AS detailed_price,
    {_whole('maximum_nights')} AS maximum_nights,
    {_flag('host_is_superhost')} AS host_is_superhost, {_flag('host_has_profile_pic')} AS host_has_profile_pic,
    {_flag('host_identity_verified')} AS host_identity_verified,
    TRY_CAST(review_scores_rating AS DOUBLE) AS review_scores_rating,
    TRY_CAST(review_scores_cleanliness AS DOUBLE) AS review_scores_cleanliness,
    TRY_CAST(review_scores_location AS DOUBLE) AS review_scores_location,
    TRUE AS detailed_source_available
  FROM raw_detail)"""

REVIEW_CTE = f"""
review_base AS (SELECT listing_id, {_day('date')} AS day, reviewer_id, reviewer_name, comments
  FROM raw_reviews WHERE listing_id IS NOT NULL),
review_counts AS (SELECT listing_id,
    COUNT(*) AS detailed_review_count, MIN(day) AS first_detailed_review_date, MAX(day) AS last_detailed_review_date,
    CAST(date_diff('day', MIN(day), MAX(day)) AS BIGINT) AS review_span_days,
    COUNT(DISTINCT reviewer_id) AS unique_reviewer_count,
    COUNT(*) FILTER (WHERE reviewer_name IS NULL OR trim(reviewer_name) = '') AS missing_reviewer_name_count,
    COUNT(*) FILTER (WHERE comments IS NULL OR trim(comments) = '') AS missing_comment_count
  FROM review_base GROUP BY listing_id),
review_fact AS (SELECT *,
    CASE WHEN review_span_days >= 30
      THEN ROUND(detailed_review_count * 365.25::DOUBLE / review_span_days, 4) END AS review_events_per_active_year
  FROM review_counts)"""

CALENDAR_CTE = f"""
calendar_rows AS (SELECT listing_id, {_day('date')} AS day, {_flag('available')} AS is_available,
    TRY_CAST(minimum_nights AS DOUBLE) AS min_nights, TRY_CAST(maximum_nights AS DOUBLE) AS max_nights
  FROM raw_calendar),
calendar_counts AS (SELECT listing_id,
    COUNT(*) AS calendar_days_observed,
    COUNT(*) FILTER (WHERE is_available) AS available_days,
    COUNT(*) FILTER (WHERE NOT is_available) AS unavailable_days,
    MIN(day) AS calendar_start_date, MAX(day) AS calendar_end_date,
    COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6)) AS weekend_days_observed,
    COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6) AND is_available) AS available_weekend_days,
    COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6)) AS weekday_days_observed,
    COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6) AND is_available) AS available_weekday_days,
    ROUND(AVG(min_nights), 4) AS calendar_avg_minimum_nights,
    MIN(min_nights) AS calendar_minimum_nights_min, MAX(min_nights) AS calendar_minimum_nights_max,
    ROUND(AVG(max_nights), 4) AS calendar_avg_maximum_nights
  FROM calendar_rows GROUP BY listing_id),
calendar_fact AS (SELECT *,
    ROUND(available_days::DOUBLE / NULLIF(calendar_days_observed, 0), 6) AS availability_rate_observed,
    ROUND(unavailable_days::DOUBLE / NULLIF(calendar_days_observed, 0), 6) AS unavailability_rate_proxy,
    ROUND(available_weekend_days::DOUBLE / NULLIF(weekend_days_observed, 0), 6) AS weekend_availability_rate,
    ROUND(available_weekday_days::DOUBLE / NULLIF(weekday_days_observed, 0), 6) AS weekday_availability_rate,
    calendar_days_observed = {M.FULL_WINDOW} AS calendar_complete_365_day_window
  FROM calendar_counts)"""

MASTER_CTE = """
joined AS (SELECT l.*, d.* EXCLUDE (listing_id, detailed_source_available),
    COALESCE(d.detailed_source_available, FALSE) AS detailed_source_available,
    r.* EXCLUDE (listing_id, detailed_review_count), COALESCE(r.detailed_review_count, 0) AS detailed_review_count,
    c.* EXCLUDE (listing_id)
  FROM listings l
  LEFT JOIN detail d ON l.id = d.listing_id
  LEFT JOIN review_fact r ON l.id = r.listing_id
  LEFT JOIN calendar_fact c ON l.id = c.listing_id),
priced AS (SELECT *,
    COALESCE(price, detailed_price) AS price_best_available,
    CASE WHEN price IS NOT NULL THEN 'summary_listings'
         WHEN detailed_price IS NOT NULL THEN 'detailed_listings' ELSE 'missing' END AS price_source
  FROM joined),
master AS (SELECT *,
    CASE WHEN bedrooms > 0 THEN ROUND(price_best_available / bedrooms, 4) END AS price_per_bedroom,
    CASE WHEN accommodates > 0 THEN ROUND(price_best_available / accommodates, 4) END AS price_per_guest,
    CAST(calculated_host_listings_count AS DOUBLE) AS host_portfolio_size,
    CASE WHEN calculated_host_listings_count = 1 THEN 'Single-listing host'
         WHEN calculated_host_listings_count BETWEEN 2 AND 5 THEN 'Small multi-listing host (2-5)'
         WHEN calculated_host_listings_count >= 6 THEN 'Large/professional host (6+)' END AS host_portfolio_segment,
    detailed_review_count > 0 AS has_review_history,
    calendar_days_observed IS NOT NULL AS calendar_data_available
  FROM priced)"""


def with_raw(select: str) -> str:
    return f"WITH {RAW_CTES}\n{select}"


def with_market(select: str) -> str:
    """``select`` over listings, detail, review_fact, calendar_fact and master."""
    return f"WITH {RAW_CTES},{CLEAN_CTES},{REVIEW_CTE},{CALENDAR_CTE},{MASTER_CTE}\n{select}"
