"""Scans, profiles, duplicates, rules and column cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.functions.numeric import percentage
from lodestay.operators import cleaning, duplicates, profiling, rules
from lodestay.operators import summaries as S
from lodestay.plans import rulebook
from lodestay.sources import catalog, schemas
from lodestay.suite import market as M
from lodestay.suite.market_sql import with_market, with_raw
from lodestay.suite.registry import register, table

# ---- scans -------------------------------------------------------------------


@register("scan_project_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100")
def scan_project_limit(spark, sf):
    shelf = catalog.Catalog(spark, sf, ".", [catalog.Dataset("orders", "orders.parquet", "parquet")])
    return shelf.load("orders", ["o_orderkey", "o_totalprice"]).orderBy("o_orderkey").limit(100)


@register("param_sql", """SELECT n_name, COUNT(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal > 5000 AND n_name <> 'NATION_3' GROUP BY n_name""")
def param_sql(spark, sf):
    catalog.replace_view(table(spark, sf, "customer"), "lodestay_customer")
    catalog.replace_view(table(spark, sf, "nation"), "lodestay_nation")
    return catalog.run_sql(
        spark,
        "SELECT n_name, COUNT(*) AS customers FROM lodestay_customer JOIN lodestay_nation "
        "ON c_nationkey = n_nationkey WHERE c_acctbal > ? AND n_name <> ? GROUP BY n_name",
        [5000, "NATION_3"],
    )


# ---- profiles ----------------------------------------------------------------

# every column of the cleaned listings
_CLEAN_TYPES = {
    "id": "bigint", "name": "string", "host_id": "bigint", "host_name": "string", "neighbourhood_group": "string",
    "neighbourhood": "string", "latitude": "double", "longitude": "double", "room_type": "string", "price_raw": "string",
    "price": "double", "minimum_nights": "bigint", "number_of_reviews": "bigint", "last_review": "date",
    "reviews_per_month": "double", "calculated_host_listings_count": "bigint", "availability_365": "bigint",
    "number_of_reviews_ltm": "bigint", "license": "string",
}


def _profile_sql() -> str:
    cells = []
    for c, t in _CLEAN_TYPES.items():
        # integers and dates print alike in both engines; doubles do not and are compared as numbers
        low, high = (f"CAST(MIN({c}) AS VARCHAR)", f"CAST(MAX({c}) AS VARCHAR)") if t in ("bigint", "date") else ("NULL", "NULL")
        low_number, high_number = (f"MIN({c})", f"MAX({c})") if t == "double" else ("NULL", "NULL")
        cells.append(
            f"SELECT 'listings' AS dataset_name, '{c}' AS column_name, '{t}' AS data_type, "
            f"COUNT(*) - COUNT({c}) AS missing_count, "
            f"ROUND((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*) * 100.0, 4) AS missing_percentage, "
            f"COUNT(DISTINCT {c}) AS unique_count, {low} AS minimum, {high} AS maximum, "
            f"CAST({low_number} AS DOUBLE) AS minimum_number, CAST({high_number} AS DOUBLE) AS maximum_number, "
            f"NULL AS profile_note, COUNT(*) AS row_count FROM listings"
        )
    return with_market("\nUNION ALL ".join(cells))


@register("profile_columns", _profile_sql())
def profile_columns(spark, sf):
    out = profiling.column_profile(M.canonical(spark, sf), "listings")
    number = F.col("data_type") == "double"
    return out.withColumns({
        **{f"{c}_number": F.when(number, F.col(c).cast("double")) for c in ("minimum", "maximum")},
        **{c: F.when(~number, F.col(c)) for c in ("minimum", "maximum")},
    })


@register("profile_free_text", """
SELECT 'documents' AS dataset_name, 'text' AS column_name, COUNT(*) - COUNT(text) AS missing_count,
  CAST(NULL AS BIGINT) AS unique_count, 'Exact distinct count skipped for a free-text column.' AS profile_note FROM documents
UNION ALL SELECT 'documents', 'source', COUNT(*) - COUNT(source), COUNT(DISTINCT source), NULL FROM documents""")
def profile_free_text(spark, sf):
    out = profiling.column_profile(table(spark, sf, "documents"), "documents", ["text", "source"], skip_distinct=["text"])
    return out.select("dataset_name", "column_name", "missing_count", "unique_count", "profile_note")


@register("profile_table", """WITH g AS (SELECT COUNT(*) AS n FROM documents GROUP BY ALL_COLUMNS)
SELECT 'documents' AS dataset_name, 'documents.parquet' AS file_name, 'parquet' AS file_type,
  CAST(SUM(n) AS BIGINT) AS row_count, 5 AS column_count, CAST(SUM(n - 1) AS BIGINT) AS duplicate_count,
  ROUND(SUM(n - 1)::DOUBLE / SUM(n) * 100.0, 4) AS duplicate_percentage, 'full_row_hash' AS duplicate_method,
  'SUCCESS' AS status, NULL AS error_message FROM g""".replace("ALL_COLUMNS", "doc_id, text, lang, source, n_chars"))
def profile_table(spark, sf):
    return profiling.table_profile(table(spark, sf, "documents"), "documents", "documents.parquet", exact=False)


@register("profile_samples", """WITH v AS (
  SELECT 'lang' AS column_name, lang AS value FROM documents WHERE lang IS NOT NULL
  UNION SELECT 'doc_id', CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id IS NOT NULL
  UNION SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM documents WHERE n_chars IS NOT NULL
  UNION SELECT 'source', source FROM documents WHERE source IS NOT NULL
  UNION SELECT 'text', text FROM documents WHERE text IS NOT NULL),
r AS (SELECT column_name, ROW_NUMBER() OVER (PARTITION BY column_name ORDER BY value) AS rank,
    trim(regexp_replace(value, '\\s+', ' ', 'g')) AS line FROM v)
SELECT column_name, CAST(rank AS INTEGER) AS rank,
  CASE WHEN length(line) > 120 THEN concat(substr(line, 1, 117), '...') ELSE line END AS sample_value
FROM r WHERE rank <= 3""")
def profile_samples(spark, sf):
    return profiling.sample_values(table(spark, sf, "documents"), ["doc_id", "text", "lang", "source", "n_chars"])


@register("profile_json_props", """WITH p AS (SELECT unnest(json_keys(props)) AS property_name, props FROM events),
n AS (SELECT COUNT(*) AS c FROM events)
SELECT property_name, MAX(n.c) - COUNT(json_extract_string(props, '$.' || property_name)) AS missing_count,
  ROUND((MAX(n.c) - COUNT(json_extract_string(props, '$.' || property_name)))::DOUBLE / MAX(n.c) * 100.0, 4)
    AS missing_percentage,
  COUNT(DISTINCT json_extract_string(props, '$.' || property_name)) AS unique_count
FROM p, n GROUP BY property_name""")
def profile_json_props(spark, sf):
    return profiling.property_profile(table(spark, sf, "events"), "props")


@register("json_record_duplicates", """WITH g AS (SELECT COUNT(*) AS n FROM events
  GROUP BY json_extract_string(props, '$.k'))
SELECT CAST(SUM(n) AS BIGINT) AS row_count, CAST(SUM(n - 1) AS BIGINT) AS duplicate_count,
  ROUND(SUM(n - 1)::DOUBLE / SUM(n) * 100.0, 4) AS duplicate_percentage FROM g""")
def json_record_duplicates(spark, sf):
    return profiling.canonical_json_duplicates(table(spark, sf, "events"), "props")


@register("candidate_keys", with_market("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) AS row_count, COUNT(DISTINCT {c}) AS unique_count, "
    f"COUNT(*) - COUNT({c}) AS missing_count, COUNT(*) = COUNT(DISTINCT {c}) AND COUNT(*) = COUNT({c}) AS is_candidate_key "
    f"FROM listings" for c in _CLEAN_TYPES)))
def candidate_keys(spark, sf):
    return profiling.candidate_keys(profiling.column_profile(M.canonical(spark, sf), "listings"))


@register("value_counts_null", with_raw("SELECT host_is_superhost AS value, COUNT(*) AS row_count FROM raw_detail GROUP BY 1"))
def value_counts_null(spark, sf):
    return S.value_frequency(M.raw_detail(spark, sf), "host_is_superhost", 30)


@register("date_column_report", with_raw("\nUNION ALL ".join(
    f"SELECT '{t}.{c}' AS column_name, COUNT({c}) AS non_null_count, COUNT(*) FILTER (WHERE {c} IS NOT NULL AND "
    f"(NOT regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') OR TRY_CAST({c} AS DATE) IS NULL)) AS invalid_count, "
    f"MIN(CASE WHEN length({c}) = 10 THEN TRY_CAST({c} AS DATE) END) AS earliest, "
    f"MAX(CASE WHEN length({c}) = 10 THEN TRY_CAST({c} AS DATE) END) AS latest FROM {t}"
    for t, c in (("raw_listings", "last_review"), ("raw_calendar", "date"), ("raw_reviews", "date")))))
def date_column_report(spark, sf):
    parts = [(M.raw_listings(spark, sf), "raw_listings", "last_review"), (M.raw_calendar(spark, sf), "raw_calendar", "date"),
             (M.raw_reviews(spark, sf), "raw_reviews", "date")]
    return rules.combine([
        profiling.date_report(df, [c]).withColumn("column_name", F.lit(f"{t}.{c}")) for df, t, c in parts
    ])


_RANGED = tuple(c for c, t in _CLEAN_TYPES.items() if t in ("bigint", "double"))


@register("numeric_range_report", with_market("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, COUNT(DISTINCT {c}) AS distinct_count, "
    f"MIN({c})::DOUBLE AS minimum, MAX({c})::DOUBLE AS maximum, ROUND(AVG({c}), 4) AS average, "
    f"ROUND(MEDIAN({c}), 4) AS median FROM listings" for c in _RANGED)))
def numeric_range_report(spark, sf):
    return profiling.numeric_range_report(M.canonical(spark, sf), _RANGED)


@register("text_length_stats", """SELECT COUNT(text) AS text_count, MIN(length(text)) AS min_length, MAX(length(text)) AS max_length,
  ROUND(AVG(length(text)), 2) AS avg_length, COUNT(*) FILTER (WHERE trim(text) = '') AS blank_count,
  ROUND(MEDIAN(length(text)), 2) AS median_length FROM documents""")
def text_length_stats(spark, sf):
    return profiling.text_length_report(table(spark, sf, "documents"), "text")


@register("blank_text_count", with_raw("""SELECT COUNT(*) FILTER (WHERE trim(reviewer_name) = '') AS blank_names,
  COUNT(*) FILTER (WHERE trim(comments) = '') AS blank_comments,
  COUNT(*) FILTER (WHERE comments IS NULL OR trim(comments) = '') AS missing_comments FROM raw_reviews"""))
def blank_text_count(spark, sf):
    return M.raw_reviews(spark, sf).agg(
        F.count_if(profiling.blank_but_present("reviewer_name")).alias("blank_names"),
        F.count_if(profiling.blank_but_present("comments")).alias("blank_comments"),
        F.count_if(parse.is_blank("comments")).alias("missing_comments"),
    )


# ---- duplicates ---------------------------------------------------------------

_DUP = """WITH g AS (SELECT COUNT(*) AS n
  FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_linenumber = 7) AS r GROUP BY r)
SELECT CAST(SUM(n) AS BIGINT) AS row_count, CAST(SUM(n - 1) AS BIGINT) AS duplicate_count,
  ROUND(SUM(n - 1)::DOUBLE / SUM(n) * 100.0, 4) AS duplicate_percentage FROM g"""


def _lineitem_with_copies(spark, sf):
    """All rows and columns; as no row of the table repeats, those of the seventh lines come twice."""
    rows = table(spark, sf, "lineitem")
    return rows.unionByName(rows.where("l_linenumber = 7"))


@register("dup_full_rows", _DUP)
def dup_full_rows(spark, sf):
    return duplicates.duplicate_rows_exact(_lineitem_with_copies(spark, sf))


@register("dup_hash_rows", _DUP)
def dup_hash_rows(spark, sf):
    return duplicates.duplicate_rows_hashed(_lineitem_with_copies(spark, sf))


@register("dup_groups", """WITH g AS (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
SELECT CAST(SUM(n) AS BIGINT) AS row_count, COUNT(*) FILTER (WHERE n > 1) AS duplicate_groups,
  CAST(SUM(n) FILTER (WHERE n > 1) AS BIGINT) AS rows_in_groups,
  CAST(SUM(n - 1) FILTER (WHERE n > 1) AS BIGINT) AS extra_rows,
  ROUND((SUM(n - 1) FILTER (WHERE n > 1))::DOUBLE / SUM(n) * 100.0, 4) AS extra_percentage FROM g""")
def dup_groups(spark, sf):
    return duplicates.duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dup_top_groups", """SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1 ORDER BY row_count DESC, l_orderkey, l_linenumber LIMIT 20""")
def dup_top_groups(spark, sf):
    return duplicates.top_duplicate_groups(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 20)


@register("repeated_text", """WITH g AS (SELECT COUNT(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY text HAVING COUNT(*) > 1)
SELECT COUNT(*) AS repeated_texts, CAST(COALESCE(SUM(n), 0) AS BIGINT) AS rows_in_repeats,
  CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS extra_rows FROM g""")
def repeated_text(spark, sf):
    return duplicates.repeated_text_summary(table(spark, sf, "documents"), "text")


@register("repeated_text_top", """SELECT row_count, left(text, 120) AS preview, length(text) AS text_length,
  distinct_documents, distinct_sources
FROM (SELECT text, COUNT(*) AS row_count, COUNT(DISTINCT doc_id) AS distinct_documents,
    COUNT(DISTINCT source) AS distinct_sources FROM documents
  WHERE text IS NOT NULL GROUP BY text HAVING COUNT(*) > 1)
ORDER BY row_count DESC, preview, text_length LIMIT 20""")
def repeated_text_top(spark, sf):
    return duplicates.top_repeated_texts(
        table(spark, sf, "documents"), "text", {"distinct_documents": "doc_id", "distinct_sources": "source"}, 20
    )


# ---- rules ----------------------------------------------------------------------


def _rule(dataset: str, rule_id: str, source: str, invalid: str, severity: str = "ERROR", total: str = "COUNT(*)") -> str:
    bad = "FAIL" if severity == "ERROR" else "WARNING"
    return (
        f"SELECT '{dataset}' AS dataset_name, '{rule_id}' AS rule_id, CAST(invalid AS BIGINT) AS invalid_count, "
        f"CAST(total AS BIGINT) AS total_rows, "
        f"CASE WHEN total > 0 THEN ROUND(invalid::DOUBLE / total * 100.0, 4) ELSE 0 END AS invalid_percentage, "
        f"CASE WHEN invalid = 0 THEN 'PASS' ELSE '{bad}' END AS status, '{severity}' AS severity "
        f"FROM (SELECT {invalid} AS invalid, {total} AS total FROM {source})"
    )


def _count(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})"


def _number(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def _range(c: str, low: str, high: str | None = None) -> str:
    upper = f" OR {_number(c)} > {high}" if high is not None else ""
    return _count(f"{c} IS NOT NULL AND ({_number(c)} IS NULL OR {_number(c)} < {low}{upper})")


def _price(c: str = "price") -> str:
    return f"TRY_CAST(trim(replace(replace({c}, '$', ''), ',', '')) AS DOUBLE)"


def _bad_date(c: str) -> str:
    return _count(f"{c} IS NOT NULL AND (NOT regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
                  f"OR TRY_CAST({c} AS DATE) IS NULL)")


def _dup_rows(t: str, k: str) -> str:
    return f"(SELECT COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM {t} GROUP BY {k}) WHERE n > 1)"


def _schema(dataset: str, prefix: str, source: str, name: str) -> list[str]:
    return [_rule(dataset, f"{prefix}_SCHEMA_{i:03d}", source, "0")
            for i, _ in enumerate(sorted(rulebook.REQUIRED[name]), start=1)]


_TYPES = ", ".join(f"'{t}'" for t in M.ROOM_TYPES)
_UNKNOWN_AREA = "trim({c}) IS NOT NULL AND trim({c}) NOT IN (SELECT trim(n_name) FROM nation)".format
_ORPHAN = "listing_id IS NOT NULL AND listing_id NOT IN (SELECT o_orderkey FROM orders)"


def _listing_rules() -> list[str]:
    d, s = "listings.csv", "raw_listings"
    return _schema(d, "SL", s, "summary_listings") + [
        _rule(d, "SL_001", s, _count("id IS NULL")),
        _rule(d, "SL_002", "(SELECT 1)", _dup_rows(s, "id"), total=f"(SELECT COUNT(*) FROM {s})"),
        _rule(d, "SL_003", s, _count("host_id IS NULL"), "WARNING"),
        _rule(d, "SL_004", s, _range("latitude", "-90", "90")),
        _rule(d, "SL_005", s, _range("longitude", "-180", "180")),
        _rule(d, "SL_006", s, _range("availability_365", "0", "365")),
        _rule(d, "SL_007", s, _range("minimum_nights", "0")),
        _rule(d, "SL_008", s, _count(f"{_price()} < 0")),
        _rule(d, "SL_009", s, _count(f"price IS NOT NULL AND {_price()} IS NULL")),
        _rule(d, "SL_010", s, _count("price IS NULL"), "WARNING"),
        _rule(d, "SL_011", s, _count(f"room_type IS NOT NULL AND trim(room_type) NOT IN ({_TYPES})"), "WARNING"),
        _rule(d, "SL_012", s, _count(_UNKNOWN_AREA(c="neighbourhood"))),
    ]


def _detail_rules() -> list[str]:
    d, s = "listings.csv.gz", "raw_detail"
    return _schema(d, "DL", s, "detailed_listings") + [
        _rule(d, "DL_001", s, _count("id IS NULL")),
        _rule(d, "DL_002", "(SELECT 1)", _dup_rows(s, "id"), total=f"(SELECT COUNT(*) FROM {s})"),
        _rule(d, "DL_003", s, _count("id NOT IN (SELECT id FROM raw_listings)")),
        _rule(d, "DL_004", "raw_listings", _count("id NOT IN (SELECT id FROM raw_detail)"), "WARNING"),
        _rule(d, "DL_005", s, _count("host_id IS NULL"), "WARNING"),
        _rule(d, "DL_006", s, _range("latitude", "-90", "90")),
        _rule(d, "DL_007", s, _range("longitude", "-180", "180")),
        _rule(d, "DL_008", s, _count(f"{_price()} < 0")),
        _rule(d, "DL_009", s, _count(f"price IS NOT NULL AND {_price()} IS NULL")),
        _rule(d, "DL_010", s, _count("price IS NULL"), "WARNING"),
        _rule(d, "DL_011", s, _range("minimum_nights", "0")),
        _rule(d, "DL_012", s, _range("availability_365", "0", "365")),
        _rule(d, "DL_013", s, _count(f"room_type IS NOT NULL AND trim(room_type) NOT IN ({_TYPES})"), "WARNING"),
        _rule(d, "DL_014", s, _count(_UNKNOWN_AREA(c="neighbourhood_cleansed"))),
    ]


def _summary_review_rules() -> list[str]:
    d, s = "reviews.csv", "raw_reviews"
    return _schema(d, "SR", s, "summary_reviews") + [
        _rule(d, "SR_001", s, _count("listing_id IS NULL")),
        _rule(d, "SR_002", s, _count(_ORPHAN)),
        _rule(d, "SR_003", s, _count("date IS NULL")),
        _rule(d, "SR_004", s, _bad_date("date")),
        _rule(d, "SR_005", "(SELECT COUNT(*) AS n FROM raw_reviews GROUP BY listing_id, date)", "SUM(n - 1)", "WARNING",
              "SUM(n)"),
    ]


def _calendar_rules() -> list[str]:
    d, s = "calendar.csv.gz", "raw_calendar"
    return _schema(d, "CAL", s, "calendar") + [
        _rule(d, "CAL_001", s, _count("listing_id IS NULL")),
        _rule(d, "CAL_002", s, _count(f"listing_id IS NULL OR {_ORPHAN}")),
        _rule(d, "CAL_003", s, _count("date IS NULL")),
        _rule(d, "CAL_004", s, _bad_date("date")),
        _rule(d, "CAL_005", "(SELECT COUNT(*) AS n FROM raw_calendar GROUP BY listing_id, date)", "SUM(n - 1)", "ERROR",
              "SUM(n)"),
        _rule(d, "CAL_006", s, _count("available IS NULL OR lower(trim(available)) NOT IN ('t','f','true','false')")),
        _rule(d, "CAL_007", s, _range("minimum_nights", "0")),
        _rule(d, "CAL_008", s, _range("maximum_nights", "0")),
        _rule(d, "CAL_009", s, _count(f"{_number('maximum_nights')} < {_number('minimum_nights')}")),
    ]


def _review_rules() -> list[str]:
    d, s = "reviews.csv.gz", "raw_reviews"
    return _schema(d, "DR", s, "detailed_reviews") + [
        _rule(d, "DR_001", s, _count("id IS NULL")),
        _rule(d, "DR_002", s, "COUNT(id) - COUNT(DISTINCT id)"),
        _rule(d, "DR_003", s, _count("listing_id IS NULL")),
        _rule(d, "DR_004", s, _count(f"listing_id IS NULL OR {_ORPHAN}")),
        _rule(d, "DR_005", s, _count("date IS NULL")),
        _rule(d, "DR_006", s, _bad_date("date")),
        _rule(d, "DR_007", s, _count("reviewer_id IS NULL"), "WARNING"),
        _rule(d, "DR_008", s, _count("reviewer_name IS NULL OR trim(reviewer_name) = ''"), "WARNING"),
        _rule(d, "DR_009", s, _count("comments IS NULL OR trim(comments) = ''"), "INFO"),
    ]


def _union(*parts: list[str]) -> str:
    return "\nUNION ALL ".join(x for p in parts for x in p)


_SHOWN = ["dataset_name", "rule_id", "invalid_count", "total_rows", "invalid_percentage", "status", "severity"]


def _known(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))


def _listing_tables(spark, sf):
    return {"neighbourhoods": M.areas(spark, sf), "summary_listings": M.raw_listings(spark, sf),
            "detailed_listings": M.raw_detail(spark, sf)}


def _fact_tables(spark, sf):
    reviews = M.raw_reviews(spark, sf)
    return {"summary_reviews": reviews.select("listing_id", "date"), "calendar": M.raw_calendar(spark, sf),
            "detailed_reviews": reviews}


def _fact_report(spark, sf):
    book, facts, known = rules.RuleBook(), _fact_tables(spark, sf), _known(spark, sf)
    rulebook.summary_review_sheet(book, facts["summary_reviews"], known)
    rulebook.calendar_sheet(book, facts["calendar"], known)
    rulebook.detailed_review_sheet(book, facts["detailed_reviews"], known)
    return book.report()


_LISTING_SQL = _listing_rules()
_N_RULES = [
    _rule("neighbourhoods.csv", "N_SCHEMA_001", "nation", "0"),
    _rule("neighbourhoods.csv", "N_001", "nation", _count("n_name IS NULL")),
    _rule("neighbourhoods.csv", "N_002", "(SELECT 1)", _dup_rows("nation", "n_name"), total="(SELECT COUNT(*) FROM nation)"),
    _rule("neighbourhoods.csv", "N_003", "nation", "COUNT(*)", "INFO"),
]


@register("validate_report", with_raw(_union(_N_RULES, _LISTING_SQL, _detail_rules())))
def validate_report(spark, sf):
    report = rulebook.full_report(_listing_tables(spark, sf), M.ROOM_TYPES)
    return rules.ordered_report(report).select(*_SHOWN)


@register("validate_facts", with_raw(_union(_summary_review_rules(), _calendar_rules(), _review_rules())))
def validate_facts(spark, sf):
    return rules.ordered_report(_fact_report(spark, sf)).select(*_SHOWN)


@register("schema_rules", _union([
    f"SELECT 'orders' AS dataset_name, 'O_SCHEMA_{i:03d}' AS rule_id, '{c}' AS checked_column, {bad} AS invalid_count, "
    f"COUNT(*) AS total_rows, '{status}' AS status FROM orders"
    for i, (c, bad, status) in enumerate(
        [("o_clerk", "COUNT(*)", "FAIL"), ("o_custkey", "0::BIGINT", "PASS"), ("o_orderkey", "0::BIGINT", "PASS")], 1)
]))
def schema_rules(spark, sf):
    report = rules.check_columns(table(spark, sf, "orders"), "orders", ["o_orderkey", "o_custkey", "o_clerk"], "O_SCHEMA")
    return report.select("dataset_name", "rule_id", "checked_column", "invalid_count", "total_rows", "status")


@register("geometry_rules", """WITH g AS (SELECT
  CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 13 = 0 THEN 'twin' ELSE CAST(event_id AS VARCHAR) END AS name,
  CASE WHEN event_type = 'error' THEN NULL WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 90 THEN 'Point'
    WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) > 45 THEN 'Polygon' ELSE 'MultiPolygon' END AS kind FROM events),
listed AS (SELECT CAST(event_id AS VARCHAR) AS name FROM events WHERE event_id % 17 <> 0),
n AS (SELECT COUNT(*) AS total FROM g)
SELECT 'GJ_001' AS rule_id, COUNT(*) FILTER (WHERE name IS NULL) AS invalid_count, COUNT(*) AS total_rows FROM g
UNION ALL SELECT 'GJ_002', COALESCE(SUM(c) FILTER (WHERE c > 1), 0), MAX(total) FROM (SELECT name, COUNT(*) AS c FROM g GROUP BY name), n
UNION ALL SELECT 'GJ_003', (SELECT COUNT(*) FROM (SELECT DISTINCT name FROM g WHERE name IS NOT NULL) WHERE name NOT IN (SELECT name FROM listed)), total FROM n
UNION ALL SELECT 'GJ_004', (SELECT COUNT(*) FROM listed WHERE name NOT IN (SELECT name FROM g WHERE name IS NOT NULL)), (SELECT COUNT(DISTINCT name) FROM listed)
UNION ALL SELECT 'GJ_005', COUNT(*) FILTER (WHERE kind IS NULL), COUNT(*) FROM g
UNION ALL SELECT 'GJ_006', COUNT(*) FILTER (WHERE kind NOT IN ('Polygon', 'MultiPolygon')), COUNT(*) FROM g""")
def geometry_rules(spark, sf):
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.when(F.col("event_type") == "error", None).when(k > 90, "Point").when(k > 45, "Polygon").otherwise("MultiPolygon")
    name = F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 13 == 0, "twin").otherwise(F.col("event_id").cast("string"))
    events = table(spark, sf, "events")
    features = events.select(name.alias("neighbourhood"), kind.alias("geometry_type")).withColumn(
        "has_geometry", F.col("geometry_type").isNotNull())
    names = events.where("event_id % 17 <> 0").select(F.col("event_id").cast("string").alias("neighbourhood"))
    return rulebook.area_rules(features, names).select("rule_id", "invalid_count", "total_rows")


_KEYED = ("CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN -1 ELSE o_custkey END")


def _fk(sql_null_condition: str) -> str:
    return (f"WITH k AS (SELECT {_KEYED} AS key FROM orders) SELECT COUNT(*) FILTER (WHERE {sql_null_condition} key NOT IN "
            f"(SELECT c_custkey FROM customer)) AS invalid_count, COUNT(*) AS total_rows FROM k")


def _fk_report(spark, sf, null_is_orphan):
    keyed = table(spark, sf, "orders").select(F.expr(_KEYED).alias("key"))
    rule = rules.Rule("FK_001", "Order customer must exist", "key")
    return rules.check_reference(
        keyed, "orders", rule, "key", table(spark, sf, "customer"), "c_custkey", null_is_orphan=null_is_orphan
    ).select("invalid_count", "total_rows")


@register("fk_anti_null", _fk("key IS NULL OR"))
def fk_anti_null(spark, sf):
    return _fk_report(spark, sf, True)


@register("fk_isin_null", _fk("key IS NOT NULL AND"))
def fk_isin_null(spark, sf):
    return _fk_report(spark, sf, False)


@register("key_set_coverage", """SELECT 'K_001' AS rule_id,
  (SELECT COUNT(*) FROM (SELECT DISTINCT user_id AS k FROM events) WHERE k NOT IN (SELECT c_custkey FROM customer)) AS invalid_count,
  (SELECT COUNT(*) FROM events) AS total_rows
UNION ALL SELECT 'K_002', (SELECT COUNT(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)),
  (SELECT COUNT(DISTINCT c_custkey) FROM customer)""")
def key_set_coverage(spark, sf):
    return rules.check_key_cover(
        table(spark, sf, "events"), "events", "user_id", table(spark, sf, "customer"), "c_custkey",
        rules.Rule("K_001", "Users must be customers", "user_id"),
        rules.Rule("K_002", "Report customers without events", "user_id", rules.WARNING),
    ).select("rule_id", "invalid_count", "total_rows")


_WHOLE_REPORT = _union(_N_RULES, _LISTING_SQL, _detail_rules(), _summary_review_rules(), _calendar_rules(), _review_rules())


def _whole_report(spark, sf):
    return rulebook.full_report(_listing_tables(spark, sf) | _fact_tables(spark, sf), M.ROOM_TYPES)


@register("status_counts", with_raw(f"""SELECT s.status, COUNT(r.rule_id) AS rule_count
FROM (VALUES ('PASS'), ('WARNING'), ('FAIL')) s(status) LEFT JOIN ({_WHOLE_REPORT}) r ON r.status = s.status
GROUP BY s.status"""))
def status_counts(spark, sf):
    return rules.status_counts(_whole_report(spark, sf))


@register("gate_failures", with_raw(f"SELECT rule_id, invalid_count FROM ({_WHOLE_REPORT}) WHERE status = 'FAIL'"))
def gate_failures(spark, sf):
    return rules.failed_rules(_whole_report(spark, sf)).select("rule_id", "invalid_count")


# ---- column cleaning --------------------------------------------------------------


@register("clean_currency", with_raw(f"SELECT id, price AS raw, {_price()} AS price FROM raw_listings"))
def clean_currency(spark, sf):
    return M.raw_listings(spark, sf).select("id", F.col("price").alias("raw"), parse.currency("price").alias("price"))


@register("clean_percent", with_raw("SELECT id, TRY_CAST(replace(host_response_rate, '%', '') AS DOUBLE) AS rate FROM raw_detail"))
def clean_percent(spark, sf):
    return M.raw_detail(spark, sf).select("id", parse.percent("host_response_rate").alias("rate"))


@register("clean_bool", with_raw("""SELECT id, CASE WHEN lower(trim(host_is_superhost)) IN ('t','true','1','yes','y') THEN TRUE
  WHEN lower(trim(host_is_superhost)) IN ('f','false','0','no','n') THEN FALSE END AS flag FROM raw_detail"""))
def clean_bool(spark, sf):
    return M.raw_detail(spark, sf).select("id", parse.boolean("host_is_superhost").alias("flag"))


@register("clean_dates", with_raw("SELECT id, TRY_CAST(last_review AS DATE) AS day FROM raw_listings"))
def clean_dates(spark, sf):
    return M.raw_listings(spark, sf).select("id", parse.date("last_review").alias("day"))


@register("clean_blank_trim", with_raw("SELECT id, NULLIF(trim(neighbourhood), '') AS area, trim(room_type) AS room_type FROM raw_listings"))
def clean_blank_trim(spark, sf):
    return M.raw_listings(spark, sf).select(
        "id", parse.strip(parse.blank_to_null("neighbourhood")).alias("area"), parse.strip("room_type").alias("room_type")
    )


@register("clean_numeric", with_raw("""SELECT id, CAST(TRY_CAST(minimum_nights AS DOUBLE) AS BIGINT) AS nights,
  TRY_CAST(latitude AS DOUBLE) AS latitude FROM raw_listings"""))
def clean_numeric(spark, sf):
    return M.raw_listings(spark, sf).select(
        "id", parse.whole_number("minimum_nights").alias("nights"), parse.number("latitude").alias("latitude")
    )


def _audit_line(column: str, action: str, count: str, always: bool = True) -> str:
    line = f"SELECT '{column}' AS column_name, '{action}' AS action, {count} AS affected_rows FROM raw_detail"
    return line if always else f"SELECT * FROM ({line}) WHERE affected_rows > 0"


def _parsed(column: str, expression: str, good: str, bad: str) -> list[str]:
    return [
        _audit_line(column, good, f"COUNT({expression})"),
        _audit_line(column, bad, _count(f"NULLIF(trim({column}), '') IS NOT NULL AND {expression} IS NULL"), False),
    ]


_POLICY = M.DETAIL_POLICY


def _audit_sql() -> str:
    lines = [_audit_line(c, "blank_string_to_null", _count(f"trim({c}) = ''"), False) for c in M.RAW_DETAIL]
    lines += _parsed("price", _price(), "currency_to_numeric", "unparseable_price_to_null")
    lines += _parsed("last_review", "TRY_CAST(last_review AS DATE)", "parse_datetime", "invalid_date_to_nat")
    for c in _POLICY.categories:
        if c in M.RAW_DETAIL:
            lines.append(_audit_line(c, "trim_category_whitespace", _count(f"trim({c}) <> '' AND trim({c}) <> {c}")))
    for c in _POLICY.booleans:
        if c in M.RAW_DETAIL:
            word = f"CASE WHEN lower(trim({c})) IN ('t','true','1','yes','y','f','false','0','no','n') THEN 1 END"
            lines += _parsed(c, word, "normalize_boolean", "unknown_boolean_to_null")
    lines += _parsed("host_response_rate", "TRY_CAST(replace(host_response_rate, '%', '') AS DOUBLE)",
                     "percentage_to_numeric", "unparseable_percentage_to_null")
    for c in (*_POLICY.integers, *_POLICY.floats):
        if c in M.RAW_DETAIL:
            lines += _parsed(c, _number(c), "convert_numeric", "unparseable_numeric_to_null")
    lines.append("SELECT '*', 'row_count_preservation_check', 0")
    lines.append("SELECT '*', 'column_count_report', 1")
    return with_raw("\nUNION ALL ".join(lines))


@register("clean_audit", _audit_sql())
def clean_audit(spark, sf):
    return cleaning.audit(M.raw_detail(spark, sf), _POLICY, "listings.csv.gz").select("column_name", "action", "affected_rows")


@register("grain_integrity", """WITH o AS (SELECT o_orderkey AS k FROM orders), l AS (SELECT l_orderkey AS k FROM lineitem),
c AS (SELECT CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN -1 ELSE o_custkey END AS k FROM orders),
t AS (SELECT 'orders' AS dataset_name, k FROM o UNION ALL SELECT 'lineitem', k FROM l UNION ALL SELECT 'order customers', k FROM c),
g AS (SELECT dataset_name, k, COUNT(*) AS n FROM t GROUP BY dataset_name, k)
SELECT dataset_name, 'k' AS key_column, CAST(SUM(n) AS BIGINT) AS row_count,
  CAST(COALESCE(SUM(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
  CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_rows, COUNT(k) AS distinct_keys
FROM g GROUP BY dataset_name""")
def grain_integrity(spark, sf):
    orders, lineitem = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return cleaning.key_reports([
        (orders.select(F.col("o_orderkey").alias("k")), "orders", "k"),
        (lineitem.select(F.col("l_orderkey").alias("k")), "lineitem", "k"),
        (orders.select(F.expr(_KEYED).alias("k")), "order customers", "k"),
    ])


@register("column_assessment", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, "
    f"ROUND((COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*) * 100.0, 4) AS missing_pct, COUNT(DISTINCT {c}) AS unique_count FROM part"
    for c in ("p_brand", "p_type", "p_size")))
def column_assessment(spark, sf):
    out = profiling.column_profile(table(spark, sf, "part"), "part", ["p_brand", "p_type", "p_size"])
    return out.select(
        "column_name", "missing_count", percentage("missing_count", "row_count", 4).alias("missing_pct"), "unique_count"
    )
