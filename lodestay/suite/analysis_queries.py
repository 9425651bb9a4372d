"""Distributions, reconciliation, hypothesis tests, facets and price models."""

from __future__ import annotations


from pyspark.sql import functions as F

from lodestay.operators import facets, hypothesis, modelling
from lodestay.operators import reconciliation as R
from lodestay.operators import summaries as S
from lodestay.plans import exploration as X
from lodestay.suite import market as M
from lodestay.suite.market_sql import with_market
from lodestay.suite.registry import register, table

# ---- distributions ----------------------------------------------------------------

_IQR = """WITH q AS (SELECT ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 2) AS q1,
  ROUND(QUANTILE_CONT(l_extendedprice, 0.75), 2) AS q3 FROM lineitem),
b AS (SELECT q1, q3, q1 - 1.5::DOUBLE * (q3 - q1) AS lower_bound, q3 + 1.5::DOUBLE * (q3 - q1) AS upper_bound FROM q)"""


@register("iqr_outliers", f"""{_IQR}
SELECT q1, q3, lower_bound, upper_bound, COUNT(l_extendedprice) AS value_count,
  COUNT(*) FILTER (WHERE l_extendedprice < lower_bound OR l_extendedprice > upper_bound) AS outlier_count,
  ROUND(100.0::DOUBLE * COUNT(*) FILTER (WHERE l_extendedprice < lower_bound OR l_extendedprice > upper_bound)
    / NULLIF(COUNT(l_extendedprice), 0), 2) AS outlier_percentage
FROM lineitem, b GROUP BY ALL""")
def iqr_outliers(spark, sf):
    return S.iqr_outliers(table(spark, sf, "lineitem"), "l_extendedprice")


def _histogram_sql(values: str, bins: int = 50) -> str:
    return f"""v AS ({values}), s AS (SELECT MIN(x) AS lo, MAX(x) AS hi, (MAX(x) - MIN(x)) / {float(bins)}::DOUBLE AS w FROM v),
h AS (SELECT CAST(CASE WHEN w > 0 THEN LEAST(FLOOR((x - lo) / w), {bins - 1}) ELSE 0 END AS INTEGER) AS bin, lo, w FROM v, s)
SELECT bin, ROUND(MAX(lo) + bin * MAX(w), 6) AS bin_start, ROUND(MAX(lo) + (bin + 1) * MAX(w), 6) AS bin_end,
  COUNT(*) AS row_count FROM h GROUP BY bin"""


@register("histogram_50", "WITH " + _histogram_sql("SELECT l_extendedprice AS x FROM lineitem"))
def histogram_50(spark, sf):
    return S.histogram(table(spark, sf, "lineitem"), "l_extendedprice")


@register("histogram_trimmed", f"{_IQR}, " + _histogram_sql(
    "SELECT l_extendedprice AS x FROM lineitem, b WHERE l_extendedprice <= upper_bound"))
def histogram_trimmed(spark, sf):
    return X.trimmed_histogram(table(spark, sf, "lineitem"), "l_extendedprice")


@register("value_distribution", """SELECT COUNT(l_extendedprice) AS count, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max,
  ROUND(AVG(l_extendedprice), 2) AS avg, ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 2) AS q1,
  ROUND(MEDIAN(l_extendedprice), 2) AS median, ROUND(QUANTILE_CONT(l_extendedprice, 0.75), 2) AS q3 FROM lineitem""")
def value_distribution(spark, sf):
    return S.distribution(table(spark, sf, "lineitem"), "l_extendedprice", digits=2)


@register("share_distribution", """SELECT l_returnflag, l_linestatus, COUNT(*) AS row_count,
  ROUND(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 4) AS percentage FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def share_distribution(spark, sf):
    return S.value_share(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


def _daily(spark, sf):
    return table(spark, sf, "events").withColumn("day", F.col("ts").cast("date"))


@register("rows_per_key", """WITH k AS (SELECT user_id, COUNT(*) AS n, COUNT(DISTINCT CAST(ts AS DATE)) AS d FROM events GROUP BY user_id)
SELECT COUNT(*) AS keys, MIN(n) AS min_rows, MAX(n) AS max_rows, ROUND(AVG(n), 4) AS avg_rows,
  MIN(d) AS min_distinct, MAX(d) AS max_distinct, ROUND(AVG(d), 4) AS avg_distinct FROM k""")
def rows_per_key(spark, sf):
    return X.rows_per_key_summary(_daily(spark, sf), "user_id", "day")


@register("rows_per_key_hist", """SELECT row_count, COUNT(*) AS keys FROM
  (SELECT l_orderkey, COUNT(*) AS row_count FROM lineitem GROUP BY l_orderkey) GROUP BY row_count""")
def rows_per_key_hist(spark, sf):
    return X.rows_per_key_histogram(table(spark, sf, "lineitem"), "l_orderkey")


@register("window_ranges", """WITH k AS (SELECT user_id, MIN(CAST(ts AS DATE)) AS first_date, MAX(CAST(ts AS DATE)) AS last_date,
  COUNT(DISTINCT CAST(ts AS DATE)) AS distinct_dates FROM events GROUP BY user_id)
SELECT first_date, last_date, distinct_dates, COUNT(*) AS keys FROM k GROUP BY ALL""")
def window_ranges(spark, sf):
    return X.window_ranges(_daily(spark, sf), "user_id", "day")


@register("availability_summary", """WITH k AS (SELECT user_id, COUNT(*) FILTER (WHERE event_type = 'view') AS yes,
  COUNT(*) FILTER (WHERE event_type <> 'view') AS no, COUNT(*) AS n FROM events GROUP BY user_id),
r AS (SELECT *, yes::DOUBLE / n AS share FROM k)
SELECT MIN(yes) AS min_available, MAX(yes) AS max_available, ROUND(AVG(yes), 4) AS avg_available,
  MIN(no) AS min_unavailable, MAX(no) AS max_unavailable, ROUND(AVG(no), 4) AS avg_unavailable,
  ROUND(MIN(share), 6) AS min_rate, ROUND(MAX(share), 6) AS max_rate, ROUND(AVG(share), 6) AS avg_rate FROM r""")
def availability_summary(spark, sf):
    rows = table(spark, sf, "events").select("user_id", (F.col("event_type") == "view").alias("is_view"))
    return X.per_key_flag_summary(rows, "user_id", "is_view")


@register("extreme_rows", """SELECT event_id, user_id, value, ts FROM events ORDER BY value DESC, user_id DESC, event_id LIMIT 20""")
def extreme_rows(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "user_id", "value", "ts")
    return X.extreme_rows(rows, "value", "user_id", ["event_id"], 20)


@register("events_per_actor", """WITH k AS (SELECT user_id, COUNT(*) AS n FROM events GROUP BY user_id)
SELECT COUNT(*) AS keys, MIN(n) AS min_events, MAX(n) AS max_events, ROUND(AVG(n), 2) AS avg_events,
  ROUND(MEDIAN(n), 2) AS median_events FROM k""")
def events_per_actor(spark, sf):
    return X.events_per_key(table(spark, sf, "events"), "user_id")


@register("busiest_keys", "SELECT user_id, COUNT(*) AS row_count FROM events GROUP BY user_id ORDER BY row_count DESC, user_id LIMIT 10")
def busiest_keys(spark, sf):
    return X.busiest_keys(table(spark, sf, "events"), "user_id", 10)


@register("repeat_actors", "SELECT COUNT(*) AS repeat_keys FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1)")
def repeat_actors(spark, sf):
    return X.repeat_keys(table(spark, sf, "lineitem"), "l_partkey")


# ---- reconciliation -----------------------------------------------------------------

_COVER = """WITH a AS (SELECT DISTINCT doc_id AS k FROM documents), b AS (SELECT DISTINCT doc_id AS k FROM labels),
j AS (SELECT a.k AS a, b.k AS b FROM a FULL JOIN b ON a.k = b.k)"""


@register("coverage_both_ways", f"""{_COVER}
SELECT COUNT(a) AS left_keys, COUNT(b) AS right_keys, COUNT(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS in_both,
  COUNT(*) FILTER (WHERE b IS NULL) AS only_left, COUNT(*) FILTER (WHERE a IS NULL) AS only_right,
  ROUND(COUNT(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)::DOUBLE / COUNT(a) * 100.0, 4) AS left_coverage_pct,
  ROUND(COUNT(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL)::DOUBLE / COUNT(b) * 100.0, 4) AS right_coverage_pct FROM j""")
def coverage_both_ways(spark, sf):
    return R.key_coverage(table(spark, sf, "documents"), "doc_id", table(spark, sf, "labels"), "doc_id")


@register("set_equality", """WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT COUNT(*) AS differing_keys, COUNT(*) = 0 AS sets_equal FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def set_equality(spark, sf):
    return R.same_key_set(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


@register("key_union", "SELECT o_custkey AS key FROM orders UNION SELECT user_id FROM events")
def key_union(spark, sf):
    return R.key_union(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"), "user_id")


@register("key_intersection", "SELECT o_custkey AS key FROM orders INTERSECT SELECT user_id FROM events")
def key_intersection(spark, sf):
    return R.key_intersection(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "events"), "user_id")


@register("key_difference", "SELECT o_orderkey AS key FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def key_difference(spark, sf):
    return R.key_difference(table(spark, sf, "orders"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


@register("multiset_diff", """WITH a AS (SELECT l_suppkey AS k, l_returnflag AS f, COUNT(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT l_suppkey AS k, l_returnflag AS f, COUNT(*) AS n FROM lineitem WHERE l_quantity < 50 GROUP BY ALL)
SELECT COALESCE(a.k, b.k) AS l_suppkey, COALESCE(a.f, b.f) AS l_returnflag, COALESCE(a.n, 0) AS left_count,
  COALESCE(b.n, 0) AS right_count FROM a FULL JOIN b ON a.k = b.k AND a.f = b.f WHERE a.n IS DISTINCT FROM b.n""")
def multiset_diff(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    return R.multiset_difference(lineitem, lineitem.where("l_quantity < 50"), ["l_suppkey", "l_returnflag"])


_PAIRS = "SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events"


@register("join_back_proof", f"""WITH e AS ({_PAIRS}), g AS (SELECT user_id, day FROM e GROUP BY ALL HAVING COUNT(*) > 1)
SELECT (SELECT COUNT(*) FROM g) AS repeated_groups, COUNT(*) AS rows_in_groups, COUNT(DISTINCT event_id) AS distinct_ids_in_groups,
  COUNT(*) = COUNT(DISTINCT event_id) AS all_distinct FROM e JOIN g USING (user_id, day)""")
def join_back_proof(spark, sf):
    return R.join_back_proof(_daily(spark, sf).select("user_id", "day", "event_id"), ["user_id", "day"], "event_id")


@register("group_examples", f"""WITH e AS ({_PAIRS}),
g AS (SELECT user_id, day, COUNT(*) AS group_size FROM e GROUP BY ALL HAVING COUNT(*) > 1
  ORDER BY group_size DESC, user_id, day LIMIT 5)
SELECT user_id, day, event_id, group_size FROM e JOIN g USING (user_id, day)""")
def group_examples(spark, sf):
    return R.group_examples(_daily(spark, sf), ["user_id", "day"], ["event_id"], 5)


@register("structure_comparison", """SELECT 'orders' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT o_orderkey) AS distinct_keys,
  CAST(MIN(o_orderdate) AS DATE) AS first_date, CAST(MAX(o_orderdate) AS DATE) AS last_date FROM orders
UNION ALL SELECT 'lineitem', COUNT(*), COUNT(DISTINCT l_orderkey), CAST(MIN(l_shipdate) AS DATE), CAST(MAX(l_shipdate) AS DATE) FROM lineitem""")
def structure_comparison(spark, sf):
    return R.structure_comparison([
        ("orders", table(spark, sf, "orders"), "o_orderkey", "o_orderdate"),
        ("lineitem", table(spark, sf, "lineitem"), "l_orderkey", "l_shipdate"),
    ])


@register("reference_coverage", with_market("""SELECT COUNT(*) AS row_count,
  COUNT(*) FILTER (WHERE neighbourhood IN (SELECT n_name FROM nation)) AS matched_rows,
  (SELECT COUNT(DISTINCT n_name) FROM nation) AS reference_values,
  (SELECT COUNT(DISTINCT n_name) FROM nation WHERE n_name NOT IN
    (SELECT neighbourhood FROM listings WHERE neighbourhood IS NOT NULL)) AS unused_reference_values,
  ROUND(COUNT(*) FILTER (WHERE neighbourhood IN (SELECT n_name FROM nation))::DOUBLE / COUNT(*) * 100.0, 4) AS coverage_pct
FROM listings"""))
def reference_coverage(spark, sf):
    return R.reference_coverage(M.raw_listings(spark, sf), "neighbourhood", table(spark, sf, "nation"), "n_name")


# ---- hypothesis tests -----------------------------------------------------------------

_H1 = {"A": "Accepted", "N": "None"}
_H2 = {True: "Superhost", False: "Non-superhost"}
_POP = """p AS (SELECT CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None' END AS "group", l_extendedprice AS value
  FROM lineitem WHERE l_returnflag IN ('A', 'N') AND l_extendedprice IS NOT NULL)"""


def _population(spark, sf):
    return hypothesis.two_groups(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", _H1)


def _superhosts(spark, sf):
    return hypothesis.two_groups(M.master(spark, sf), "host_is_superhost", "review_scores_rating", _H2)


@register("group_describe", f"""WITH {_POP} SELECT "group", COUNT(value) AS sample_size, ROUND(AVG(value), 6) AS mean,
  ROUND(MEDIAN(value), 6) AS median, ROUND(STDDEV_SAMP(value), 6) AS std, MIN(value) AS minimum, MAX(value) AS maximum,
  ROUND(QUANTILE_CONT(value, 0.25), 6) AS q1, ROUND(QUANTILE_CONT(value, 0.75), 6) AS q3,
  ROUND(QUANTILE_CONT(value, 0.75) - QUANTILE_CONT(value, 0.25), 6) AS iqr FROM p GROUP BY "group" """)
def group_describe(spark, sf):
    return hypothesis.describe_groups(_population(spark, sf), 6)


@register("boxplot_stats", f"""WITH {_POP}, q AS (SELECT "group", QUANTILE_CONT(value, 0.25) AS q1, MEDIAN(value) AS median,
  QUANTILE_CONT(value, 0.75) AS q3 FROM p GROUP BY "group")
SELECT "group", ROUND(MIN(value), 4) AS whisker_low, ROUND(MAX(q1), 4) AS q1, ROUND(MAX(median), 4) AS median,
  ROUND(MAX(q3), 4) AS q3, ROUND(MAX(value), 4) AS whisker_high FROM p JOIN q USING ("group")
WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY "group" """)
def boxplot_stats(spark, sf):
    return hypothesis.box_plot(_population(spark, sf), 4)


def _mw_ctes(population: str, first: str) -> str:
    """Tie-averaged rank test in SQL."""
    return f"""{population},
f AS (SELECT value, COUNT(*)::DOUBLE AS n, COUNT(*) FILTER (WHERE "group" = '{first}')::DOUBLE AS n1 FROM p GROUP BY value),
r AS (SELECT *, SUM(n) OVER (ORDER BY value) - n + (n + 1) / 2 AS rank FROM f),
s AS (SELECT SUM(n) AS n, SUM(n1) AS n1, SUM(n) - SUM(n1) AS n2, SUM(rank * n1) AS r1, SUM(n * n * n - n) AS ties FROM r),
u AS (SELECT *, r1 - n1 * (n1 + 1) / 2 AS u,
  SQRT(n1 * n2 / 12 * ((n + 1) - ties / (n * (n - 1)))) AS sigma FROM s),
z AS (SELECT *, (GREATEST(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma AS z FROM u)"""


@register("mann_whitney", f"""WITH {_mw_ctes(_POP, 'Accepted')}
SELECT CAST(n1 AS BIGINT) AS group_1_n, CAST(n2 AS BIGINT) AS group_2_n, u AS test_statistic, ROUND(z, 8) AS z,
  ROUND(2 * u / (n1 * n2) - 1, 8) AS effect_size_rank_biserial,
  CASE WHEN z > 1.959963984540054 THEN 'Reject H0' ELSE 'Fail to reject H0' END AS decision FROM z""")
def mann_whitney(spark, sf):
    test = hypothesis.mann_whitney(_population(spark, sf), "Accepted", "None")
    return test.select(
        "group_1_n", "group_2_n", "test_statistic",
        F.round("z", 8).alias("z"),
        F.round("effect_size_rank_biserial", 8).alias("effect_size_rank_biserial"),
        F.when(F.col("p_value") < hypothesis.ALPHA, "Reject H0").otherwise("Fail to reject H0").alias("decision"),
    )


# DuckDB has no normal tail function, so the p-values are tested in tests/.
@register("hypothesis_results")
def hypothesis_results(spark, sf):
    return hypothesis.hypothesis_table([
        hypothesis.hypothesis_row(_population(spark, sf), "Accepted", "None", "H1",
                                  "Do prices differ between the two return flags?", "price distributions"),
        hypothesis.hypothesis_row(_superhosts(spark, sf), "Superhost", "Non-superhost", "H2",
                                  "Do review scores differ between the two host groups?", "review-score distributions"),
    ])


@register("hypothesis_superhost", with_market("SELECT 1").removesuffix("\nSELECT 1") + ",\n" + _mw_ctes(
    """p AS (SELECT CASE WHEN host_is_superhost THEN 'Superhost' ELSE 'Non-superhost' END AS "group",
  review_scores_rating AS value FROM master WHERE host_is_superhost IS NOT NULL AND review_scores_rating IS NOT NULL)""",
    "Superhost") + """
SELECT CAST(n1 AS BIGINT) AS group_1_n, (SELECT MEDIAN(value) FROM p WHERE "group" = 'Superhost') AS group_1_median,
  CAST(n2 AS BIGINT) AS group_2_n, (SELECT MEDIAN(value) FROM p WHERE "group" <> 'Superhost') AS group_2_median,
  u AS test_statistic FROM z""")
def hypothesis_superhost(spark, sf):
    row = hypothesis.hypothesis_row(_superhosts(spark, sf), "Superhost", "Non-superhost", "H2", "", "scores")
    return row.select("group_1_n", "group_1_median", "group_2_n", "group_2_median", "test_statistic")


# ---- facets ------------------------------------------------------------------------------

_SPEC = facets.FacetSpec(
    choices={"neighbourhood": [f"NATION_{i}" for i in range(12)], "room_type": [],
             "host_portfolio_segment": ["Small multi-listing host (2-5)", "Large/professional host (6+)"]},
    flags={"host_is_superhost": ["Yes", "Missing"]},
    ranges={"price_best_available": (5000.0, 400000.0), "accommodates": (None, None)},
)
_FACETED = """f AS (SELECT * FROM master WHERE neighbourhood IN ('NATION_0','NATION_1','NATION_2','NATION_3','NATION_4','NATION_5',
  'NATION_6','NATION_7','NATION_8','NATION_9','NATION_10','NATION_11')
  AND host_portfolio_segment IN ('Small multi-listing host (2-5)', 'Large/professional host (6+)')
  AND (host_is_superhost OR host_is_superhost IS NULL) AND price_best_available BETWEEN 5000 AND 400000)"""


def _with_facets(select: str) -> str:
    return with_market("SELECT 1").removesuffix("\nSELECT 1") + ",\n" + _FACETED + "\n" + select


def _faceted(spark, sf):
    return facets.facet_filter(M.master(spark, sf), _SPEC)


@register("facet_filter", _with_facets("SELECT id, neighbourhood, room_type, price_best_available FROM f"))
def facet_filter(spark, sf):
    return _faceted(spark, sf).select("id", "neighbourhood", "room_type", "price_best_available")


@register("facet_filter_kpis", _with_facets("""SELECT COUNT(DISTINCT id) AS total_listings,
  COUNT(DISTINCT id) FILTER (WHERE price_best_available > 0) AS valid_price_listings,
  COUNT(DISTINCT neighbourhood) AS neighbourhood_count,
  MEDIAN(price_best_available) FILTER (WHERE price_best_available > 0) AS median_price FROM f"""))
def facet_filter_kpis(spark, sf):
    return facets.overview(_faceted(spark, sf), "id", "price_best_available", "neighbourhood")


@register("facet_secondary_kpis", _with_facets("""SELECT CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events,
  COUNT(*) FILTER (WHERE host_is_superhost) AS superhost_count, MEDIAN(unavailability_rate_proxy) AS median_unavailability,
  MEDIAN(accommodates) AS median_accommodates FROM f"""))
def facet_secondary_kpis(spark, sf):
    return facets.secondary_overview(
        _faceted(spark, sf), "detailed_review_count", "unavailability_rate_proxy", "accommodates", "host_is_superhost"
    )


@register("facet_options", with_market("""SELECT DISTINCT 'neighbourhood' AS facet, neighbourhood AS option FROM master WHERE neighbourhood IS NOT NULL
UNION SELECT DISTINCT 'room_type', room_type FROM master WHERE room_type IS NOT NULL
UNION SELECT DISTINCT 'host_portfolio_segment', host_portfolio_segment FROM master WHERE host_portfolio_segment IS NOT NULL"""))
def facet_options(spark, sf):
    return facets.facet_options(M.master(spark, sf), ["neighbourhood", "room_type", "host_portfolio_segment"])


@register("facet_flag_options", with_market("""SELECT DISTINCT CASE WHEN host_is_superhost IS NULL THEN 'Missing'
  WHEN host_is_superhost THEN 'Yes' ELSE 'No' END AS option FROM master"""))
def facet_flag_options(spark, sf):
    return facets.flag_options(M.master(spark, sf), "host_is_superhost")


@register("facet_ranges", with_market("""SELECT MIN(price_best_available) FILTER (WHERE price_best_available > 0) AS minimum_price,
  MAX(price_best_available) FILTER (WHERE price_best_available > 0) AS maximum_price,
  MIN(accommodates) FILTER (WHERE accommodates > 0) AS minimum_capacity,
  LEAST(MAX(accommodates) FILTER (WHERE accommodates > 0), 16) AS maximum_capacity FROM master"""))
def facet_ranges(spark, sf):
    return facets.observed_ranges(M.master(spark, sf), "price_best_available", "accommodates")


@register("facet_top_groups", with_market("""SELECT neighbourhood, COUNT(DISTINCT id) AS listing_count FROM master
WHERE neighbourhood IS NOT NULL GROUP BY neighbourhood ORDER BY listing_count DESC, neighbourhood LIMIT 15"""))
def facet_top_groups(spark, sf):
    return facets.top_groups_by_count(M.master(spark, sf), "neighbourhood", "id", 15)


@register("facet_top_medians", with_market("""SELECT neighbourhood, COUNT(DISTINCT id) AS listing_count,
  MEDIAN(price_best_available) AS median_price FROM master WHERE price_best_available > 0 AND neighbourhood IS NOT NULL
GROUP BY neighbourhood HAVING COUNT(DISTINCT id) >= 20 ORDER BY median_price DESC, neighbourhood LIMIT 15"""))
def facet_top_medians(spark, sf):
    rows = facets.positive(M.master(spark, sf), "price_best_available")
    return facets.top_groups_by_median(rows, "neighbourhood", "price_best_available", "id", name="median_price")


@register("facet_category_medians", with_market("""SELECT room_type, COUNT(DISTINCT id) AS listing_count,
  MEDIAN(price_best_available) AS median_price FROM master WHERE price_best_available > 0 AND room_type IS NOT NULL GROUP BY room_type"""))
def facet_category_medians(spark, sf):
    rows = facets.positive(M.master(spark, sf), "price_best_available")
    return facets.medians_by_group(rows, "room_type", "price_best_available", "id", "median_price")


@register("facet_price_histogram", with_market("SELECT 1").removesuffix("\nSELECT 1") + """,
pos AS (SELECT price_best_available AS x FROM master WHERE price_best_available > 0),
lim AS (SELECT QUANTILE_CONT(x, 0.99) AS m FROM pos), """ + _histogram_sql("SELECT x FROM pos, lim WHERE x <= m"))
def facet_price_histogram(spark, sf):
    return facets.limited_histogram(M.master(spark, sf), "price_best_available")


@register("facet_capacity_medians", with_market("""SELECT accommodates, COUNT(DISTINCT id) AS listing_count,
  MEDIAN(price_best_available) AS median_price FROM master
WHERE price_best_available > 0 AND accommodates > 0 AND accommodates <= 10 GROUP BY accommodates"""))
def facet_capacity_medians(spark, sf):
    rows = facets.positive(M.master(spark, sf), "price_best_available", "accommodates").where("accommodates <= 10")
    return facets.medians_by_group(rows, "accommodates", "price_best_available", "id", "median_price")


@register("facet_top_totals", with_market("""SELECT neighbourhood, CAST(SUM(detailed_review_count) AS BIGINT) AS total_review_events
FROM master WHERE neighbourhood IS NOT NULL AND detailed_review_count IS NOT NULL
GROUP BY neighbourhood ORDER BY total_review_events DESC, neighbourhood LIMIT 15"""))
def facet_top_totals(spark, sf):
    return facets.top_groups_by_total(M.master(spark, sf), "neighbourhood", "detailed_review_count", 15, "total_review_events")


@register("facet_top_proxy", with_market("""SELECT neighbourhood, COUNT(DISTINCT id) AS listing_count,
  MEDIAN(unavailability_rate_proxy) AS median_unavailability_proxy FROM master
WHERE neighbourhood IS NOT NULL AND unavailability_rate_proxy IS NOT NULL GROUP BY neighbourhood
HAVING COUNT(DISTINCT id) >= 20 ORDER BY median_unavailability_proxy DESC, neighbourhood LIMIT 15"""))
def facet_top_proxy(spark, sf):
    return facets.top_groups_by_median(
        M.master(spark, sf), "neighbourhood", "unavailability_rate_proxy", "id", name="median_unavailability_proxy"
    )


# ---- price models ----------------------------------------------------------------------------

_SPLIT = "(CAST(concat('0x', substr(md5(concat(CAST({k} AS VARCHAR), ':42')), 1, 8)) AS BIGINT) % 100 < 20)"
_SPLIT_ID = _SPLIT.format(k="id")


@register("model_frame", with_market(f"""SELECT id, neighbourhood, room_type, detailed_property_type,
  CAST(host_is_superhost AS VARCHAR) AS host_is_superhost, CAST(host_identity_verified AS VARCHAR) AS host_identity_verified,
  host_portfolio_segment, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in modelling.NUMERICAL)},
  price_best_available, {_SPLIT_ID} AS is_test FROM master WHERE price_best_available > 0"""))
def model_frame(spark, sf):
    spec = modelling.ModelSpec()
    return modelling.with_split(modelling.modelling_frame(M.master(spark, sf), spec), spec.key)


_MODEL = with_market("SELECT 1").removesuffix("\nSELECT 1") + f""",
frame AS (SELECT *, {_SPLIT_ID} AS is_test FROM master WHERE price_best_available > 0)"""


@register("rare_category_map", _MODEL + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, COALESCE(CAST({c} AS VARCHAR), 'Missing') AS category, COUNT(*) AS train_rows, "
    f"CASE WHEN COUNT(*) < 10 THEN '__rare__' ELSE COALESCE(CAST({c} AS VARCHAR), 'Missing') END AS encoded_as "
    f"FROM frame WHERE NOT is_test GROUP BY {c}" for c in modelling.CATEGORICAL))
def rare_category_map(spark, sf):
    spec = modelling.ModelSpec()
    frame = modelling.with_split(modelling.modelling_frame(M.master(spark, sf), spec), spec.key)
    return modelling.rare_category_map(frame.where(~F.col("is_test")), spec.categorical)


@register("dummy_metrics", _MODEL + """,
m AS (SELECT exp(MEDIAN(ln(1 + price_best_available))) - 1 AS guess FROM frame WHERE NOT is_test),
e AS (SELECT price_best_available AS a, price_best_available - guess AS e FROM frame, m WHERE is_test)
SELECT 'Dummy Regressor' AS model, ROUND(AVG(ABS(e)), 2) AS mae_eur, ROUND(SQRT(AVG(e * e)), 2) AS rmse_eur,
  ROUND(1 - AVG(e * e) / VAR_POP(a), 4) AS r2 FROM e""")
def dummy_metrics(spark, sf):
    from lodestay.operators.ordering import exact_quantiles

    spec = modelling.ModelSpec()
    frame = modelling.with_split(modelling.modelling_frame(M.master(spark, sf), spec), spec.key)
    train = frame.where(~F.col("is_test")).select(F.log1p(spec.target).alias("label"))
    guess = exact_quantiles(train, [], {"guess": ("label", 0.5)})
    scored = frame.where("is_test").crossJoin(F.broadcast(guess))  # one row
    scored = scored.withColumn("guess", F.expm1("guess"))
    return modelling.score(scored, spec.target, "guess", modelling.DUMMY)


@register("diagnostic_subset", _MODEL + """
SELECT id, price_best_available AS actual_price FROM frame WHERE is_test AND price_best_available <=
  (SELECT QUANTILE_CONT(price_best_available, 0.99) FROM frame WHERE is_test)""")
def diagnostic_subset(spark, sf):
    spec = modelling.ModelSpec()
    frame = modelling.with_split(modelling.modelling_frame(M.master(spark, sf), spec), spec.key)
    rows = frame.where("is_test").select("id", F.col(spec.target).alias("actual_price"))
    return modelling.diagnostic_rows(rows, "actual_price").select("id", "actual_price")


# Each query trains what it shows: 200 trees of depth 18, all other figures from all training rows, all test rows scored.

@register("ridge_rf_compare")
def ridge_rf_compare(spark, sf):
    return modelling.run_price_experiment(M.master(spark, sf)).results


@register("model_predictions")
def model_predictions(spark, sf):
    return modelling.run_price_experiment(M.master(spark, sf)).predictions


@register("feature_importance")
def feature_importance(spark, sf):
    return modelling.forest_importance(M.master(spark, sf))
