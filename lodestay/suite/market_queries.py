"""Enrichment, warehouse, published questions and exploration over the derived market."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestay.operators import enrichment, rollups
from lodestay.operators import summaries as S
from lodestay.plans import exploration as X
from lodestay.plans import published as P
from lodestay.plans import warehouse as W
from lodestay.suite import market as M
from lodestay.suite.market_sql import with_market
from lodestay.suite.registry import register, table

# ---- cleaning and enrichment -------------------------------------------------


@register("clean_listings", with_market("SELECT * FROM listings"))
def clean_listings(spark, sf):
    return M.canonical(spark, sf)


@register("clean_detail", with_market("SELECT * FROM detail"))
def clean_detail(spark, sf):
    return M.detail(spark, sf)


@register("event_rollup", with_market("SELECT * FROM review_fact"))
def event_rollup(spark, sf):
    return M.review_fact(spark, sf)


@register("calendar_rollup", with_market("SELECT * FROM calendar_fact"))
def calendar_rollup(spark, sf):
    return M.calendar_fact(spark, sf)


@register("enriched_master", with_market("SELECT * FROM master"))
def enriched_master(spark, sf):
    return M.master(spark, sf)


@register("event_rate", """
WITH per_user AS (SELECT user_id, COUNT(*) AS n, MIN(CAST(ts AS DATE)) AS first_day, MAX(CAST(ts AS DATE)) AS last_day
  FROM events GROUP BY user_id),
spans AS (SELECT *, CAST(date_diff('day', first_day, last_day) AS BIGINT) AS span_days FROM per_user)
SELECT user_id, n AS event_count, span_days,
  CASE WHEN span_days >= 29 THEN ROUND(n * 365.25::DOUBLE / span_days, 4) END AS events_per_year FROM spans""")
def event_rate(spark, sf):
    day = F.col("ts").cast("date")
    per_user = table(spark, sf, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("event_count"), F.date_diff(F.max(day), F.min(day)).cast("bigint").alias("span_days")
    )
    return per_user.withColumn("events_per_year", rollups.events_per_year("event_count", "span_days", 29))


@register("daily_calendar_rollup", """
WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day,
    CASE event_type WHEN 'view' THEN TRUE WHEN 'click' THEN TRUE WHEN 'error' THEN FALSE END AS ok FROM events)
SELECT user_id AS listing_id, COUNT(*) AS calendar_days_observed, COUNT(*) FILTER (WHERE ok) AS available_days,
  COUNT(*) FILTER (WHERE NOT ok) AS unavailable_days,
  ROUND(COUNT(*) FILTER (WHERE ok)::DOUBLE / COUNT(*), 6) AS availability_rate_observed,
  ROUND(COUNT(*) FILTER (WHERE NOT ok)::DOUBLE / COUNT(*), 6) AS unavailability_rate_proxy,
  MIN(day) AS calendar_start_date, MAX(day) AS calendar_end_date,
  COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6)) AS weekend_days_observed,
  COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6) AND ok) AS available_weekend_days,
  ROUND(COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6) AND ok)::DOUBLE
    / NULLIF(COUNT(*) FILTER (WHERE extract(dow FROM day) IN (0, 6)), 0), 6) AS weekend_availability_rate,
  COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6)) AS weekday_days_observed,
  COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6) AND ok) AS available_weekday_days,
  ROUND(COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6) AND ok)::DOUBLE
    / NULLIF(COUNT(*) FILTER (WHERE extract(dow FROM day) NOT IN (0, 6)), 0), 6) AS weekday_availability_rate,
  NULL::DOUBLE AS calendar_avg_minimum_nights, NULL::DOUBLE AS calendar_minimum_nights_min,
  NULL::DOUBLE AS calendar_minimum_nights_max, NULL::DOUBLE AS calendar_avg_maximum_nights,
  COUNT(*) = 365 AS calendar_complete_365_day_window
FROM days GROUP BY user_id""")
def daily_calendar_rollup(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("user_id").alias("listing_id"),
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_type").isin("view", "click"), True).when(F.col("event_type") == "error", False)
        .alias("is_available"),
        F.lit(None).cast("double").alias("min_nights"),
        F.lit(None).cast("double").alias("max_nights"),
    )
    return rollups.calendar_rollup(rows)


@register("price_coalesce", with_market("SELECT id, price, detailed_price, price_best_available, price_source FROM master"))
def price_coalesce(spark, sf):
    return M.master(spark, sf).select("id", "price", "detailed_price", "price_best_available", "price_source")


@register("guarded_ratios", with_market("SELECT id, price_per_bedroom, price_per_guest FROM master"))
def guarded_ratios(spark, sf):
    return M.master(spark, sf).select("id", "price_per_bedroom", "price_per_guest")


@register("portfolio_segment", with_market("SELECT id, host_portfolio_size, host_portfolio_segment FROM master"))
def portfolio_segment(spark, sf):
    return M.master(spark, sf).select("id", "host_portfolio_size", "host_portfolio_segment")


@register("orphan_keys", """
WITH known AS (SELECT DISTINCT user_id AS k FROM events)
SELECT DISTINCT c_custkey AS listing_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM known WHERE k = c_custkey)""")
def orphan_keys(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").alias("listing_id"))
    return enrichment.orphan_keys(keys, "listing_id", table(spark, sf, "events"), "user_id")


_METRICS = """
SELECT 'detailed_listing_rows' AS metric, (SELECT COUNT(*) FROM detail)::DOUBLE AS value
UNION ALL SELECT 'detailed_listing_selected_columns', (SELECT len(json_keys(to_json(d))) FROM detail d LIMIT 1)
UNION ALL SELECT 'review_aggregate_rows', (SELECT COUNT(*) FROM review_fact)
UNION ALL SELECT 'total_detailed_reviews_aggregated', (SELECT SUM(detailed_review_count) FROM review_fact)
UNION ALL SELECT 'calendar_aggregate_rows', (SELECT COUNT(*) FROM calendar_fact)
UNION ALL SELECT 'total_calendar_rows_aggregated', (SELECT SUM(calendar_days_observed) FROM calendar_fact)
UNION ALL SELECT 'listings_with_complete_365_day_calendar',
  (SELECT COUNT(*) FROM calendar_fact WHERE calendar_complete_365_day_window)
UNION ALL SELECT 'canonical_input_rows', (SELECT COUNT(*) FROM listings)
UNION ALL SELECT 'detailed_listing_matches', (SELECT COUNT(*) FROM master WHERE detailed_source_available)
UNION ALL SELECT 'summary_only_listings_preserved', (SELECT COUNT(*) FROM master WHERE NOT detailed_source_available)
UNION ALL SELECT 'final_enriched_rows', (SELECT COUNT(*) FROM master)
UNION ALL SELECT 'final_enriched_columns', (SELECT len(json_keys(to_json(m))) FROM master m LIMIT 1)
UNION ALL SELECT 'price_best_available_non_null', (SELECT COUNT(price_best_available) FROM master)
UNION ALL SELECT 'listings_with_review_history', (SELECT COUNT(*) FROM master WHERE has_review_history)
UNION ALL SELECT 'listings_with_calendar_data', (SELECT COUNT(*) FROM master WHERE calendar_data_available)"""


@register("enrichment_metrics", with_market(_METRICS))
def enrichment_metrics(spark, sf):
    return enrichment.enrichment_metrics(
        M.canonical(spark, sf), M.detail(spark, sf), M.review_fact(spark, sf), M.calendar_fact(spark, sf),
        M.master(spark, sf),
    ).select("metric", "value")


# ---- warehouse ----------------------------------------------------------------

_DIM = ", ".join(
    f"{c} AS {W.DIM_LISTING_RENAMES[c]}" if c in W.DIM_LISTING_RENAMES else c for c in W.DIM_LISTING_COLUMNS
)


@register("dim_listings", with_market(f"SELECT {_DIM} FROM master"))
def dim_listings(spark, sf):
    return W.dim_listings(M.master(spark, sf))


@register("dim_group_key", with_market("""
SELECT CAST(ROW_NUMBER() OVER (ORDER BY neighbourhood) AS INTEGER) AS neighbourhood_key, * FROM (
  SELECT neighbourhood, COUNT(*) AS listing_count, COUNT(price_best_available) AS listings_with_price,
    ROUND(AVG(price_best_available), 2) AS avg_price_best_available,
    ROUND(MEDIAN(price_best_available), 2) AS median_price_best_available
  FROM master WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood)"""))
def dim_group_key(spark, sf):
    return W.dim_neighbourhoods(M.master(spark, sf))


_AREA_VIEW = """SELECT neighbourhood, COUNT(*) AS listing_count, COUNT(price_best_available) AS listings_with_price,
  ROUND(AVG(price_best_available), 2) AS avg_price, ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(AVG(review_scores_rating), 3) AS avg_review_score,
  CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events,
  ROUND(AVG(detailed_review_count), 2) AS avg_reviews_per_listing,
  ROUND(AVG(availability_rate_observed), 4) AS avg_availability_rate,
  ROUND(AVG(unavailability_rate_proxy), 4) AS avg_unavailability_rate_proxy
FROM master WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood"""
_ROOM_VIEW = """SELECT room_type, COUNT(*) AS listing_count, COUNT(price_best_available) AS listings_with_price,
  ROUND(AVG(price_best_available), 2) AS avg_price, ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(AVG(review_scores_rating), 3) AS avg_review_score,
  CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events,
  ROUND(AVG(unavailability_rate_proxy), 4) AS avg_unavailability_rate_proxy
FROM master WHERE room_type IS NOT NULL GROUP BY room_type"""
_HOST_VIEW = """SELECT host_portfolio_segment, COUNT(*) AS listing_count,
  COUNT(price_best_available) AS listings_with_price,
  ROUND(AVG(price_best_available), 2) AS avg_price, ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(AVG(review_scores_rating), 3) AS avg_review_score,
  ROUND(AVG(detailed_review_count), 2) AS avg_reviews_per_listing,
  ROUND(AVG(unavailability_rate_proxy), 4) AS avg_unavailability_rate_proxy
FROM master WHERE host_portfolio_segment IS NOT NULL GROUP BY host_portfolio_segment"""


@register("view_neighbourhood", with_market(_AREA_VIEW))
def view_neighbourhood(spark, sf):
    return W.neighbourhood_performance(M.master(spark, sf))


@register("view_room_type", with_market(_ROOM_VIEW))
def view_room_type(spark, sf):
    return W.room_type_performance(M.master(spark, sf))


@register("view_host_portfolio", with_market(_HOST_VIEW))
def view_host_portfolio(spark, sf):
    return W.host_portfolio_performance(M.master(spark, sf))


def _check(object_name: str, metric: str, value: str, expected: str) -> str:
    return (
        f"SELECT '{object_name}' AS object_name, '{metric}' AS metric, CAST(({value}) AS BIGINT) AS value, "
        f"CAST(CAST(({expected}) AS BIGINT) AS VARCHAR) AS expected_value"
    )


_N = "SELECT COUNT(*) FROM {}".format
_DUP = "SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {t} WHERE {k} IS NOT NULL GROUP BY {k}) WHERE n > 1".format
_RECONCILE = "\nUNION ALL ".join([
    _check("enriched_listing_master", "row_count", _N("master"), _N("listings")),
    _check("enriched_listing_master", "unique_listing_ids", "SELECT COUNT(DISTINCT id) FROM master", _N("listings")),
    _check("enriched_listing_master", "null_listing_ids", "SELECT COUNT(*) FROM master WHERE id IS NULL", "0"),
    _check("enriched_listing_master", "duplicate_listing_id_rows", _DUP(t="master", k="id"), "0"),
    _check("dim_listings", "row_count", _N("master"), _N("listings")),
    _check("dim_listings", "unique_listing_ids", "SELECT COUNT(DISTINCT id) FROM master", _N("listings")),
    _check("dim_neighbourhoods", "row_count",
           "SELECT COUNT(*) FROM (SELECT neighbourhood FROM master WHERE neighbourhood IS NOT NULL GROUP BY 1)",
           "SELECT COUNT(DISTINCT neighbourhood) FROM listings"),
    _check("fact_review_activity", "row_count", _N("review_fact"), "SELECT COUNT(DISTINCT listing_id) FROM raw_reviews"),
    _check("fact_review_activity", "total_detailed_review_events", "SELECT SUM(detailed_review_count) FROM review_fact",
           "SELECT COUNT(*) FROM raw_reviews WHERE listing_id IS NOT NULL"),
    _check("fact_review_activity", "duplicate_listing_id_rows", _DUP(t="review_fact", k="listing_id"), "0"),
    _check("fact_calendar_activity", "row_count", _N("calendar_fact"),
           "SELECT COUNT(DISTINCT listing_id) FROM raw_calendar"),
    _check("fact_calendar_activity", "total_calendar_rows_represented",
           "SELECT SUM(calendar_days_observed) FROM calendar_fact", _N("raw_calendar")),
    _check("fact_calendar_activity", "complete_365_day_windows",
           "SELECT COUNT(*) FROM calendar_fact WHERE calendar_complete_365_day_window",
           "SELECT COUNT(DISTINCT listing_id) FROM raw_calendar"),
    _check("fact_calendar_activity", "duplicate_listing_id_rows", _DUP(t="calendar_fact", k="listing_id"), "0"),
])
_NON_EMPTY = "\nUNION ALL ".join(
    f"SELECT '{v}', 'row_count', 1::BIGINT, '> 0', 'PASS'" for v in W.VIEWS
)


@register("reconcile_totals", with_market(
    f"SELECT *, CASE WHEN CAST(value AS VARCHAR) = expected_value THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM ({_RECONCILE})\nUNION ALL {_NON_EMPTY}"))
def reconcile_totals(spark, sf):
    reviews = M.raw_reviews(spark, sf).where(F.col("listing_id").isNotNull())
    return W.reconcile(
        M.master(spark, sf), M.review_fact(spark, sf), M.calendar_fact(spark, sf), M.canonical(spark, sf), reviews,
        M.raw_calendar(spark, sf),
    ).drop("notes")


# ---- published questions --------------------------------------------------------


@register("q1", with_market(f"{_ROOM_VIEW} ORDER BY median_price DESC NULLS LAST"))
def q1(spark, sf):
    return P.room_type_pricing(M.master(spark, sf))


@register("q2", with_market(f"SELECT * FROM ({_AREA_VIEW}) WHERE listing_count >= 100 ORDER BY median_price DESC NULLS LAST"))
def q2(spark, sf):
    return P.area_pricing(M.master(spark, sf))


@register("q3", with_market(f"""SELECT *,
  ROUND(100.0::DOUBLE * listing_count / SUM(listing_count) OVER (), 2) AS market_supply_percentage
FROM ({_HOST_VIEW}) ORDER BY listing_count DESC"""))
def q3(spark, sf):
    return P.portfolio_concentration(M.master(spark, sf))


@register("q4", with_market("""SELECT CASE WHEN host_is_superhost THEN 'Superhost' ELSE 'Non-superhost' END AS superhost_status,
  COUNT(*) AS listing_count, COUNT(price_best_available) AS listings_with_price,
  ROUND(AVG(price_best_available), 2) AS average_price, ROUND(MEDIAN(price_best_available), 2) AS median_price,
  COUNT(review_scores_rating) AS listings_with_review_score,
  ROUND(AVG(review_scores_rating), 3) AS average_review_score,
  CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events,
  ROUND(AVG(detailed_review_count), 2) AS average_reviews_per_listing,
  ROUND(AVG(unavailability_rate_proxy), 4) AS average_unavailability_rate_proxy
FROM master WHERE host_is_superhost IS NOT NULL GROUP BY host_is_superhost ORDER BY host_is_superhost DESC"""))
def q4(spark, sf):
    return P.superhost_comparison(M.master(spark, sf))


@register("q5", with_market(f"""SELECT neighbourhood, listing_count, total_review_events, avg_reviews_per_listing,
  median_price, avg_review_score FROM ({_AREA_VIEW}) WHERE listing_count >= 100 ORDER BY total_review_events DESC"""))
def q5(spark, sf):
    return P.area_review_activity(M.master(spark, sf))


# An order has far fewer line items than a listing has reviews: 6, not 50.
@register("q6", with_market("""SELECT id AS listing_id, name, neighbourhood, room_type, price_best_available,
  review_scores_rating, detailed_review_count, review_events_per_active_year, host_is_superhost, host_portfolio_segment
FROM master WHERE detailed_review_count >= 6 AND review_scores_rating < 4.5
ORDER BY detailed_review_count DESC, review_scores_rating ASC"""))
def q6(spark, sf):
    return P.quality_screening(M.master(spark, sf), minimum_reviews=6)


@register("q7", with_market(f"""SELECT neighbourhood, listing_count, avg_availability_rate,
  avg_unavailability_rate_proxy, median_price, total_review_events
FROM ({_AREA_VIEW}) WHERE listing_count >= 100 ORDER BY avg_unavailability_rate_proxy DESC NULLS LAST"""))
def q7(spark, sf):
    return P.area_availability(M.master(spark, sf))


@register("q8", with_market("""SELECT accommodates, COUNT(*) AS listing_count,
  COUNT(price_best_available) AS listings_with_price, ROUND(AVG(price_best_available), 2) AS average_price,
  ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(QUANTILE_CONT(price_best_available, 0.25), 2) AS price_q1,
  ROUND(QUANTILE_CONT(price_best_available, 0.75), 2) AS price_q3
FROM master WHERE accommodates > 0 AND price_best_available IS NOT NULL
GROUP BY accommodates HAVING COUNT(price_best_available) >= 30 ORDER BY accommodates"""))
def q8(spark, sf):
    return P.capacity_pricing(M.master(spark, sf))


# ---- exploration ----------------------------------------------------------------


@register("coverage_summary", with_market("""SELECT COUNT(*) AS total_listings, COUNT(DISTINCT id) AS unique_listing_ids,
  COUNT(*) FILTER (WHERE id IS NULL) AS missing_listing_ids,
  COUNT(*) FILTER (WHERE detailed_source_available) AS detailed_source_matches,
  COUNT(*) FILTER (WHERE NOT detailed_source_available) AS summary_only_listings,
  COUNT(*) FILTER (WHERE has_review_history) AS listings_with_reviews,
  COUNT(*) FILTER (WHERE calendar_data_available) AS listings_with_calendar_data,
  COUNT(price_best_available) AS listings_with_price FROM master"""))
def coverage_summary(spark, sf):
    return X.coverage_summary(M.master(spark, sf))


@register("group_counts", with_market("""SELECT neighbourhood, COUNT(*) AS listing_count FROM master
WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood ORDER BY listing_count DESC"""))
def group_counts(spark, sf):
    return X.listing_counts(M.master(spark, sf))


@register("group_price_quartiles", with_market("""SELECT neighbourhood, COUNT(*) AS total_listings,
  COUNT(price_best_available) AS listings_with_price, ROUND(AVG(price_best_available), 2) AS avg_price,
  ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(QUANTILE_CONT(price_best_available, 0.25), 2) AS price_q1,
  ROUND(QUANTILE_CONT(price_best_available, 0.75), 2) AS price_q3
FROM master WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood HAVING COUNT(price_best_available) >= 20"""))
def group_price_quartiles(spark, sf):
    return X.price_summary(M.master(spark, sf), minimum=20)


_READOUT = "\nUNION ALL BY NAME ".join(
    f"SELECT '{name}' AS view_name, * FROM ({sql})" for name, sql in zip(W.VIEWS, (_AREA_VIEW, _ROOM_VIEW, _HOST_VIEW)))


@register("view_readout", with_market(_READOUT))
def view_readout(spark, sf):
    return W.view_readouts(M.master(spark, sf))


@register("group_activity", with_market("""SELECT neighbourhood, COUNT(*) AS listing_count,
  CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events,
  ROUND(AVG(detailed_review_count), 2) AS avg_reviews_per_listing,
  ROUND(MEDIAN(detailed_review_count), 2) AS median_reviews_per_listing,
  COUNT(*) FILTER (WHERE has_review_history) AS listings_with_reviews
FROM master WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood
ORDER BY total_review_events DESC, neighbourhood LIMIT 15"""))
def group_activity(spark, sf):
    return X.review_activity(M.master(spark, sf), n=15)


@register("group_availability", with_market("""SELECT neighbourhood, COUNT(*) AS listing_count,
  ROUND(AVG(availability_rate_observed), 4) AS avg_availability_rate,
  ROUND(AVG(unavailability_rate_proxy), 4) AS avg_unavailability_rate_proxy,
  ROUND(MEDIAN(unavailability_rate_proxy), 4) AS median_unavailability_rate_proxy
FROM master WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood"""))
def group_availability(spark, sf):
    return X.availability_proxy(M.master(spark, sf))


@register("capacity_price", with_market("""SELECT accommodates, COUNT(*) AS total_listings,
  COUNT(price_best_available) AS listings_with_price, ROUND(AVG(price_best_available), 2) AS avg_price,
  ROUND(MEDIAN(price_best_available), 2) AS median_price
FROM master WHERE accommodates > 0 GROUP BY accommodates HAVING COUNT(price_best_available) >= 20"""))
def capacity_price(spark, sf):
    return X.price_by_capacity(M.master(spark, sf), minimum=20)


@register("price_distribution", with_market("""SELECT COUNT(price_best_available) AS non_null_price_count,
  MIN(price_best_available) AS min_price, ROUND(QUANTILE_CONT(price_best_available, 0.25), 2) AS q1,
  ROUND(MEDIAN(price_best_available), 2) AS median_price,
  ROUND(QUANTILE_CONT(price_best_available, 0.75), 2) AS q3,
  MAX(price_best_available) AS max_price, ROUND(AVG(price_best_available), 2) AS avg_price FROM master"""))
def price_distribution(spark, sf):
    return X.price_distribution(M.master(spark, sf))


_COLS = X.CORRELATED


def _corr_sql() -> str:
    cells = []
    for a in _COLS:
        for b in _COLS:
            value = f"CASE WHEN MIN({a}) < MAX({a}) THEN 1.0::DOUBLE END" if a == b else f"ROUND(CORR({a}, {b}), 6)"
            cells.append(f"SELECT '{a}' AS column_1, '{b}' AS column_2, {value} AS correlation FROM master")
    return with_market("\nUNION ALL ".join(cells))


@register("correlation_pairs", _corr_sql())
def correlation_pairs(spark, sf):
    return S.correlation_pairs(M.master(spark, sf).select(*_COLS), _COLS, 6)


_ENDS = f"""supported AS (SELECT * FROM ({_AREA_VIEW}) WHERE listings_with_price >= 20 AND median_price IS NOT NULL)
SELECT *, 'top' AS list FROM (SELECT * FROM supported ORDER BY median_price DESC, neighbourhood LIMIT 5)
UNION ALL SELECT *, 'bottom' AS list FROM (SELECT * FROM supported ORDER BY median_price, neighbourhood LIMIT 5)"""


@register("top_bottom_groups", with_market("SELECT 1").removesuffix("\nSELECT 1") + ",\n" + _ENDS)
def top_bottom_groups(spark, sf):
    areas = W.neighbourhood_performance(M.master(spark, sf))
    return S.ranked_ends(areas, "median_price", "neighbourhood", 5, "listings_with_price", 20)


@register("metric_long", with_market("""SELECT metric, CAST(value AS DOUBLE) AS value FROM (
  UNPIVOT (SELECT COUNT(*) AS total_listings, COUNT(DISTINCT id) AS unique_listing_ids,
    COUNT(*) FILTER (WHERE id IS NULL) AS missing_listing_ids,
    COUNT(*) FILTER (WHERE detailed_source_available) AS detailed_source_matches,
    COUNT(*) FILTER (WHERE NOT detailed_source_available) AS summary_only_listings,
    COUNT(*) FILTER (WHERE has_review_history) AS listings_with_reviews,
    COUNT(*) FILTER (WHERE calendar_data_available) AS listings_with_calendar_data,
    COUNT(price_best_available) AS listings_with_price,
    CAST((SELECT SUM(detailed_review_count) FROM review_fact) AS BIGINT) AS total_review_events,
    CAST((SELECT SUM(calendar_days_observed) FROM calendar_fact) AS BIGINT) AS total_calendar_rows
  FROM master) ON COLUMNS(*) INTO NAME metric VALUE value)"""))
def metric_long(spark, sf):
    return X.headline_metrics(M.master(spark, sf), M.review_fact(spark, sf), M.calendar_fact(spark, sf))
