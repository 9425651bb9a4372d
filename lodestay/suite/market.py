"""A listing market derived from the shared test tables.

The tables hold neither NULLs nor malformed text, so raw listing, review and
calendar tables are derived from them with expressions that put in both. The
same expression text serves Spark and SQL; ``TEXT`` and ``MONEY`` are the only
dialect differences.

* canonical listings: every order, with its customer (host) and nation (area)
* detailed listings: orders whose status is not pending
* reviews and calendar days: every line item
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.operators import cleaning, enrichment, rollups
from lodestay.plans.refresh import detail_attributes
from lodestay.sources.schemas import DETAILED_POLICY, SUMMARY_POLICY
from lodestay.suite.registry import table

# Decided where the tables are derived: of the integer columns only beds gets fractions (a test compares with the data).
LISTING_POLICY = replace(SUMMARY_POLICY, fractional=frozenset())
DETAIL_POLICY = replace(DETAILED_POLICY, fractional=frozenset({"beds"}))
FULL_WINDOW = 4  # calendar rows that count as a complete window in this market
ROOM_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")

PRICE = (
    "CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN '   ' "
    "WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE concat('$', MONEY(o_totalprice)) END"
)
FLAG = (
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' F ' "
    "WHEN o_custkey % 2 = 0 THEN 'Yes' ELSE 'unknown-value' END"
)
PERCENT = "CASE WHEN o_orderkey % 9 = 0 THEN 'N/A' ELSE concat(CAST(o_orderkey % 101 AS TEXT), '%') END"
DAY = (
    "CASE WHEN o_orderkey % 17 = 0 THEN 'not-a-valid-date' ELSE CAST(CAST(o_orderdate AS DATE) AS TEXT) END"
)
CATEGORY = "CASE WHEN o_orderkey % 3 = 0 THEN concat(' ', o_orderpriority, '  ') ELSE o_orderpriority END"
AREA = (
    "CASE WHEN o_orderkey % 29 = 0 THEN '  ' WHEN o_orderkey % 3 = 0 THEN concat(' ', n_name, '  ') ELSE n_name END"
)
NIGHTS = (
    "CASE WHEN o_orderkey % 31 = 0 THEN '-1' WHEN o_orderkey % 37 = 0 THEN '2.0' "
    "ELSE CAST(day(o_orderdate) AS TEXT) END"
)
LATITUDE = "CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS TEXT)"
LONGITUDE = "CAST(CAST(floor(c_acctbal / 50) AS BIGINT) AS TEXT)"
HOST = "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey AS TEXT) END"
YEAR_DAY = "CAST(dayofyear(o_orderdate) AS TEXT)"
MONTH = "CAST(month(o_orderdate) AS TEXT)"

RAW_LISTINGS = {
    "id": "CAST(o_orderkey AS TEXT)",
    "name": "concat(o_orderpriority, ' / ', o_orderstatus)",
    "host_id": HOST,
    "host_name": "c_name",
    "neighbourhood_group": "CAST(NULL AS TEXT)",
    "neighbourhood": AREA,
    "latitude": LATITUDE,
    "longitude": LONGITUDE,
    "room_type": CATEGORY,
    "price": PRICE,
    "minimum_nights": NIGHTS,
    "number_of_reviews": MONTH,
    "last_review": DAY,
    "reviews_per_month": "concat(CAST(day(o_orderdate) % 7 AS TEXT), '.25')",
    "calculated_host_listings_count": "CAST(greatest(0, CAST(floor(c_acctbal / 1000) AS BIGINT)) AS TEXT)",
    "availability_365": YEAR_DAY,
    "number_of_reviews_ltm": MONTH,
    "license": "CAST(NULL AS TEXT)",
}

RAW_DETAIL = {
    "id": "CAST(o_orderkey AS TEXT)",
    "host_id": HOST,
    "neighbourhood_cleansed": "n_name",
    "latitude": LATITUDE,
    "longitude": LONGITUDE,
    "room_type": CATEGORY,
    "property_type": "concat(' ', c_mktsegment)",
    "accommodates": "CASE WHEN o_orderkey % 23 = 0 THEN '0' ELSE CAST(month(o_orderdate) AS TEXT) END",
    "bathrooms": "concat(CAST(day(o_orderdate) % 4 AS TEXT), '.5')",
    "bedrooms": "CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE CAST(quarter(o_orderdate) - 1 AS TEXT) END",
    "beds": "concat(CAST(day(o_orderdate) % 5 AS TEXT), CASE WHEN o_orderkey % 7 = 0 THEN '.5' ELSE '' END)",
    "price": (
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('$', MONEY(o_totalprice)) END"
    ),
    "minimum_nights": NIGHTS,
    "maximum_nights": YEAR_DAY,
    "availability_365": YEAR_DAY,
    "host_is_superhost": FLAG,
    "host_has_profile_pic": "CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'f' END",
    "host_identity_verified": "CASE WHEN o_custkey % 3 = 0 THEN 'TRUE' ELSE '0' END",
    "host_response_rate": PERCENT,
    "last_review": DAY,
    "review_scores_rating": (
        "concat(CAST(3 + day(o_orderdate) % 2 AS TEXT), '.', lpad(CAST((day(o_orderdate) * 3) % 100 AS TEXT), 2, '0'))"
    ),
    "review_scores_cleanliness": "concat('4.', CAST(month(o_orderdate) % 10 AS TEXT))",
    "review_scores_location": "CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE '4.5' END",
}

RAW_REVIEWS = {
    "listing_id": "CASE WHEN l_partkey % 97 = 0 AND l_linenumber = 7 THEN NULL ELSE l_orderkey END",
    "id": "l_orderkey * 10 + l_linenumber",
    "date": (
        "CASE WHEN l_suppkey % 17 = 0 AND l_linenumber = 1 THEN 'not-a-valid-date' "
        "ELSE CAST(CAST(l_shipdate AS DATE) AS TEXT) END"
    ),
    "reviewer_id": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_suppkey END",
    "reviewer_name": (
        "CASE WHEN l_returnflag = 'N' AND l_linenumber = 3 THEN '  ' "
        "WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN NULL ELSE l_returnflag END"
    ),
    "comments": (
        "CASE WHEN l_linestatus = 'O' AND l_linenumber = 2 THEN NULL "
        "WHEN l_linestatus = 'F' AND l_linenumber = 5 THEN '' ELSE l_linestatus END"
    ),
}

RAW_CALENDAR = {
    "listing_id": "l_orderkey",
    "date": (
        "CASE WHEN l_partkey % 53 = 0 THEN '2025-01' ELSE CAST(CAST(l_shipdate AS DATE) AS TEXT) END"
    ),
    "available": (
        "CASE WHEN l_returnflag = 'A' THEN 't' WHEN l_returnflag = 'R' THEN 'f' "
        "WHEN l_linestatus = 'O' THEN 'unknown' ELSE NULL END"
    ),
    "minimum_nights": (
        "CASE WHEN l_suppkey % 59 = 0 THEN 'n/a' WHEN l_partkey % 61 = 0 THEN '-2' "
        "ELSE CAST(CAST(l_quantity AS BIGINT) AS TEXT) END"
    ),
    "maximum_nights": "CAST(CAST(l_quantity AS BIGINT) + l_linenumber - 2 AS TEXT)",
}

LISTING_SOURCE = (
    "orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"
)


def in_spark(expression: str) -> str:
    return expression.replace("MONEY(o_totalprice)", "format_number(o_totalprice, 2)").replace("AS TEXT", "AS STRING")


def in_sql(expression: str) -> str:
    return expression.replace("MONEY(o_totalprice)", "format('{:,.2f}', o_totalprice)").replace("AS TEXT", "AS VARCHAR")


def _select(df: DataFrame, columns: dict) -> DataFrame:
    return df.select(*[F.expr(in_spark(e)).alias(c) for c, e in columns.items()])


def _orders_with_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )


def _listings(hosts: DataFrame) -> DataFrame:
    return _select(hosts, RAW_LISTINGS)


def _details(hosts: DataFrame) -> DataFrame:
    return _select(hosts.where("o_orderstatus <> 'P'"), RAW_DETAIL)


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listings(_orders_with_hosts(spark, sf_dir))


def raw_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _details(_orders_with_hosts(spark, sf_dir))


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), RAW_REVIEWS)


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "lineitem"), RAW_CALENDAR)


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.select(F.lit(None).cast("string").alias("neighbourhood_group"), F.col("n_name").alias("neighbourhood"))


def _canonical(hosts: DataFrame) -> DataFrame:
    return cleaning.clean(_listings(hosts), LISTING_POLICY)


def _detail(hosts: DataFrame) -> DataFrame:
    return detail_attributes(cleaning.clean(_details(hosts), DETAIL_POLICY))


def _review_fact(items: DataFrame) -> DataFrame:
    rows = _select(items, RAW_REVIEWS).where(F.col("listing_id").isNotNull())
    return rollups.event_rollup(rows)


def _calendar_fact(items: DataFrame) -> DataFrame:
    return rollups.calendar_rollup(rollups.normalised_calendar(_select(items, RAW_CALENDAR)), FULL_WINDOW)


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(_orders_with_hosts(spark, sf_dir))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _detail(_orders_with_hosts(spark, sf_dir))


def review_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews without a listing cannot be joined to one and are left to the validation report."""
    return _review_fact(table(spark, sf_dir, "lineitem"))


def calendar_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calendar_fact(table(spark, sf_dir, "lineitem"))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts, items = _orders_with_hosts(spark, sf_dir), table(spark, sf_dir, "lineitem")
    return enrichment.build_master(_canonical(hosts), _detail(hosts), _review_fact(items), _calendar_fact(items))
