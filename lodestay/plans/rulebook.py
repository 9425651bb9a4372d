"""The rule catalogue of the seven source datasets.

A ``…_sheet`` enters the rules of one table into a ``RuleBook``, which counts
those of all tables together; ``…_rules`` is the report of one table alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.operators import rules as R
from lodestay.operators.rules import ERROR, INFO, WARNING, Rule

# Accepted categories and required columns.
ROOM_TYPES = ("Entire home/apt", "Private room", "Shared room", "Hotel room")
GEOMETRY_TYPES = ("Polygon", "MultiPolygon")
REQUIRED = {
    "neighbourhoods": ("neighbourhood",),
    "summary_listings": ("id", "host_id", "neighbourhood", "latitude", "longitude", "room_type", "price",
                         "minimum_nights", "availability_365"),
    "summary_reviews": ("listing_id", "date"),
    "detailed_listings": ("id", "host_id", "neighbourhood_cleansed", "latitude", "longitude", "room_type", "price",
                          "minimum_nights", "availability_365"),
    "calendar": ("listing_id", "date", "available", "minimum_nights", "maximum_nights"),
    "detailed_reviews": ("listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"),
}
FILES = {
    "neighbourhoods": "neighbourhoods.csv", "summary_listings": "listings.csv", "summary_reviews": "reviews.csv",
    "detailed_listings": "listings.csv.gz", "geojson": "neighbourhoods.geojson", "calendar": "calendar.csv.gz",
    "detailed_reviews": "reviews.csv.gz",
}


class _Sheet:
    """Enters the checks of one table; a check on an absent column is skipped."""

    def __init__(self, book: R.RuleBook, df: DataFrame, dataset: str, prefix: str, required=()):
        self.book, self.df, self.dataset, self.prefix = book, df, dataset, prefix
        # column rules are counted in the same pass as the row rules
        self.rows: list[tuple[Rule, Column]] = R.column_rules(df, required, f"{prefix}_SCHEMA")

    def has(self, *columns: str) -> bool:
        return all(c in self.df.columns for c in columns)

    def rule(self, number: int, text: str, checked: str, severity: str = ERROR, notes: str = "") -> Rule:
        return Rule(f"{self.prefix}_{number:03d}", text, checked, severity, notes)

    def row(self, number: int, text: str, columns: tuple, bad, severity: str = ERROR, notes: str = "") -> None:
        if self.has(*columns):
            self.rows.append((self.rule(number, text, ",".join(columns), severity, notes), bad()))

    def null(self, number: int, text: str, c: str, severity: str = ERROR) -> None:
        self.row(number, text, (c,), lambda: F.col(c).isNull(), severity)

    def key(self, number: int, text: str, c: str) -> None:
        if self.has(c):
            self.book.unique(self.df, self.dataset, self.rule(number, text, c), c)

    def close(self) -> None:
        self.book.rows(self.df, self.dataset, self.rows)


def _alone(sheet):
    """The report of one sheet."""
    def report(*args, **options) -> DataFrame:
        book = R.RuleBook()
        sheet(book, *args, **options)
        return book.report()

    return report


def _location(s: _Sheet, lat: int, lon: int) -> None:
    s.row(lat, "Latitude must be between -90 and 90", ("latitude",), lambda: R.out_of_range("latitude", -90, 90))
    s.row(lon, "Longitude must be between -180 and 180", ("longitude",), lambda: R.out_of_range("longitude", -180, 180))


def _prices(s: _Sheet, first: int) -> None:
    s.row(first, "Parsed price must not be negative", ("price",), lambda: R.negative_currency("price"))
    s.row(first + 1, "A present price must parse", ("price",), lambda: R.unparseable_currency("price"))
    s.row(first + 2, "Report missing prices", ("price",), lambda: F.col("price").isNull(), WARNING,
          "A missing price is not a price of zero.")


def _stay(s: _Sheet, nights: int, availability: int) -> None:
    s.row(availability, "availability_365 must be between 0 and 365", ("availability_365",),
          lambda: R.out_of_range("availability_365", 0, 365))
    s.row(nights, "minimum_nights must not be negative", ("minimum_nights",),
          lambda: R.out_of_range("minimum_nights", 0))


def neighbourhood_sheet(book: R.RuleBook, df: DataFrame, dataset: str = FILES["neighbourhoods"]) -> None:
    s = _Sheet(book, df, dataset, "N", REQUIRED["neighbourhoods"])
    s.null(1, "Area name must not be null", "neighbourhood")
    s.key(2, "Area name must be unique", "neighbourhood")
    s.null(3, "Report missing area groups", "neighbourhood_group", INFO)
    s.close()


def summary_listing_sheet(
    book: R.RuleBook, df: DataFrame, areas: DataFrame, dataset: str = FILES["summary_listings"], room_types=ROOM_TYPES
) -> None:
    s = _Sheet(book, df, dataset, "SL", REQUIRED["summary_listings"])
    s.null(1, "Listing id must not be null", "id")
    s.key(2, "Listing id must be unique", "id")
    s.null(3, "Report missing host ids", "host_id", WARNING)
    _location(s, 4, 5)
    _stay(s, 7, 6)
    _prices(s, 8)
    s.row(11, "Room type must be a known category", ("room_type",), lambda: R.not_in_set("room_type", room_types),
          WARNING, "New source values are to be reviewed, not rejected.")
    if s.has("neighbourhood"):
        rule = s.rule(12, "Area must exist in the area list", "neighbourhood")
        book.reference(df, dataset, rule, "neighbourhood", areas, "neighbourhood", trim=True)
    s.close()


def summary_review_sheet(book: R.RuleBook, df: DataFrame, listings: DataFrame, dataset: str = FILES["summary_reviews"]) -> None:
    s = _Sheet(book, df, dataset, "SR", REQUIRED["summary_reviews"])
    s.null(1, "Review listing id must not be null", "listing_id")
    if s.has("listing_id"):
        rule = s.rule(2, "Review listing id must be canonical", "listing_id")
        book.reference(df, dataset, rule, "listing_id", listings, "id")
    s.null(3, "Review date must not be null", "date")
    s.row(4, "A present review date must parse", ("date",), lambda: R.unparseable_date("date"))
    rule = s.rule(5, "Report repeated rows", ",".join(df.columns), WARNING,
                  "Several reviews of one listing on one day are genuine and are kept.")
    book.no_extra_rows(df, dataset, rule)
    s.close()


def detailed_listing_sheet(
    book: R.RuleBook, df: DataFrame, listings: DataFrame, areas: DataFrame, dataset: str = FILES["detailed_listings"],
    room_types=ROOM_TYPES,
) -> None:
    s = _Sheet(book, df, dataset, "DL", REQUIRED["detailed_listings"])
    s.null(1, "Detailed listing id must not be null", "id")
    s.key(2, "Detailed listing id must be unique", "id")
    if s.has("id"):
        book.cover(
            df, dataset, "id", listings, "id",
            s.rule(3, "Detailed listings must be canonical", "id"),
            s.rule(4, "Report canonical listings without detail", "id", WARNING),
        )
    s.null(5, "Report missing host ids", "host_id", WARNING)
    _location(s, 6, 7)
    _prices(s, 8)
    _stay(s, 11, 12)
    s.row(13, "Room type must be a known category", ("room_type",), lambda: R.not_in_set("room_type", room_types), WARNING)
    if s.has("neighbourhood_cleansed"):
        rule = s.rule(14, "Area must exist in the area list", "neighbourhood_cleansed")
        book.reference(df, dataset, rule, "neighbourhood_cleansed", areas, "neighbourhood", trim=True)
    s.close()


def area_sheet(book: R.RuleBook, features: DataFrame, areas: DataFrame, dataset: str = FILES["geojson"]) -> None:
    """``features`` as read by ``sources.catalog.read_areas``."""
    s = _Sheet(book, features, dataset, "GJ")
    name = "neighbourhood"
    s.null(1, "Boundary area name must not be null", name)
    s.key(2, "Boundary area name must be unique", name)
    book.cover(
        features, dataset, name, areas, name,
        s.rule(3, "Boundary areas must be in the area list", name),
        s.rule(4, "Every listed area must have a boundary", name),
        trim_other=True,
    )
    s.row(5, "Geometry must be present", ("has_geometry",), lambda: ~F.col("has_geometry"))
    s.row(6, "Geometry must be a polygon or multipolygon", ("geometry_type",),
          lambda: F.col("has_geometry") & F.coalesce(~F.col("geometry_type").isin(*GEOMETRY_TYPES), F.lit(True)))
    s.close()


def calendar_sheet(book: R.RuleBook, df: DataFrame, listings: DataFrame, dataset: str = FILES["calendar"]) -> None:
    s = _Sheet(book, df, dataset, "CAL", REQUIRED["calendar"])
    s.null(1, "Calendar listing id must not be null", "listing_id")
    if s.has("listing_id"):
        rule = s.rule(2, "Calendar listing id must be canonical", "listing_id")
        book.reference(df, dataset, rule, "listing_id", listings, "id", null_is_orphan=True)
    s.null(3, "Calendar date must not be null", "date")
    s.row(4, "A present calendar date must parse", ("date",), lambda: R.unparseable_date("date"))
    if s.has("listing_id", "date"):
        rule = s.rule(5, "Listing and day must be unique together", "listing_id,date")
        book.no_extra_rows(df, dataset, rule, ["listing_id", "date"])
    s.row(6, "Availability must be a flag", ("available",), lambda: R.not_a_flag("available"))
    for number, c in ((7, "minimum_nights"), (8, "maximum_nights")):
        s.row(number, f"{c} must not be negative", (c,), lambda c=c: R.out_of_range(c, 0))
    s.row(9, "maximum_nights must not be below minimum_nights", ("minimum_nights", "maximum_nights"),
          lambda: R.wrong_order("minimum_nights", "maximum_nights"))
    s.close()


def detailed_review_sheet(book: R.RuleBook, df: DataFrame, listings: DataFrame, dataset: str = FILES["detailed_reviews"]) -> None:
    s = _Sheet(book, df, dataset, "DR", REQUIRED["detailed_reviews"])
    s.null(1, "Review id must not be null", "id")
    if s.has("id"):
        book.no_extra_rows(df, dataset, s.rule(2, "Review id must be unique", "id"), ["id"])
    s.null(3, "Review listing id must not be null", "listing_id")
    if s.has("listing_id"):
        rule = s.rule(4, "Review listing id must be canonical", "listing_id")
        book.reference(df, dataset, rule, "listing_id", listings, "id", null_is_orphan=True)
    s.null(5, "Review date must not be null", "date")
    s.row(6, "A present review date must parse", ("date",), lambda: R.unparseable_date("date"))
    s.null(7, "Report missing reviewer ids", "reviewer_id", WARNING)
    s.row(8, "Report missing reviewer names", ("reviewer_name",), lambda: parse.is_blank("reviewer_name"), WARNING)
    s.row(9, "Report missing or empty comments", ("comments",), lambda: parse.is_blank("comments"), INFO)
    s.close()


neighbourhood_rules = _alone(neighbourhood_sheet)
summary_listing_rules = _alone(summary_listing_sheet)
summary_review_rules = _alone(summary_review_sheet)
detailed_listing_rules = _alone(detailed_listing_sheet)
area_rules = _alone(area_sheet)
calendar_rules = _alone(calendar_sheet)
detailed_review_rules = _alone(detailed_review_sheet)


def full_report(tables: dict[str, DataFrame], room_types=ROOM_TYPES) -> DataFrame:
    """All rules over ``tables`` (logical name -> DataFrame) in one book; absent tables are skipped."""
    book = R.RuleBook()
    listings, areas = tables["summary_listings"], tables["neighbourhoods"]
    neighbourhood_sheet(book, areas)
    summary_listing_sheet(book, listings, areas, room_types=room_types)
    if "summary_reviews" in tables:
        summary_review_sheet(book, tables["summary_reviews"], listings)
    if "detailed_listings" in tables:
        detailed_listing_sheet(book, tables["detailed_listings"], listings, areas, room_types=room_types)
    if "neighbourhoods_geojson" in tables:
        area_sheet(book, tables["neighbourhoods_geojson"], areas)
    if "calendar" in tables:
        calendar_sheet(book, tables["calendar"], listings)
    if "detailed_reviews" in tables:
        detailed_review_sheet(book, tables["detailed_reviews"], listings)
    return book.report()
