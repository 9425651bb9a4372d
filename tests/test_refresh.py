"""A full run over seven generated source files: read, validate, gate, clean, enrich, publish."""

import csv
import gzip
import io
import json

import pytest

from lodestay.operators.rules import GateError
from lodestay.plans import published, warehouse
from lodestay.plans.refresh import refresh
from lodestay.sources.catalog import Catalog, read_areas, run_sql

AREAS = ["North", "South"]


def write_csv(path, header, rows):
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n")
    writer.writerow(header)
    writer.writerows(rows)
    data = text.getvalue().encode()
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)


def make_city(root, latitude="52.1"):
    root.mkdir(parents=True)
    ids = list(range(1, 9))
    write_csv(root / "neighbourhoods.csv", ["neighbourhood_group", "neighbourhood"], [["", a] for a in AREAS])
    write_csv(
        root / "listings.csv",
        ["id", "name", "host_id", "host_profile_id", "host_name", "neighbourhood_group", "neighbourhood", "latitude", "longitude",
         "room_type", "price", "minimum_nights", "number_of_reviews", "last_review", "reviews_per_month",
         "calculated_host_listings_count", "availability_365", "number_of_reviews_ltm", "license"],
        [[i, f"Nice, \"home\"\n{i}", i % 3 or "", "", "Ann", "", AREAS[i % 2], latitude, "4.9", "Private room",
          "" if i == 1 else 100 + i, 2, 3, "2025-01-15", "0.5", i, 100, 1, "N/A"] for i in ids],
    )
    write_csv(
        root / "listings.csv.gz",
        ["id", "host_id", "neighbourhood_cleansed", "latitude", "longitude", "room_type", "property_type", "price",
         "minimum_nights", "maximum_nights", "availability_365", "accommodates", "bathrooms", "bedrooms", "beds",
         "host_is_superhost", "host_has_profile_pic", "host_identity_verified", "host_response_rate", "review_scores_rating",
         "review_scores_cleanliness", "review_scores_location"],
        [[i, 5, AREAS[i % 2], "52.1", "4.9", "Private room", " Flat ", "$1,100.00", 2, 30, 100, i % 4, "1.5", 1, "1.0",
          "t" if i % 2 else "f", "t", "t", "95%", "4.5", "4.6", "4.7"] for i in ids[:-1]],
    )
    write_csv(root / "reviews.csv", ["listing_id", "date"], [[i, "2025-01-15"] for i in ids[1:]] + [[2, "2025-01-15"]])
    write_csv(
        root / "reviews.csv.gz", ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"],
        [[i, 100 + i, "2025-01-15", 7, "Bo", "line one\nline \"two\""] for i in ids[1:]] + [[2, 200, "2025-03-01", 8, "", ""]],
    )
    write_csv(
        root / "calendar.csv.gz", ["listing_id", "date", "available", "minimum_nights", "maximum_nights"],
        [[i, f"2025-{1 + d // 28:02d}-{1 + d % 28:02d}" if d < 336 else f"2026-{1 + (d - 336) // 28:02d}-{1 + (d - 336) % 28:02d}",
          "t" if d % 3 else "f", 2, 30] for i in ids for d in range(365)],
    )
    (root / "neighbourhoods.geojson").write_text(json.dumps({
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[[[4.9, 52.1], [4.8, 52.2]]]]},
                      "properties": {"neighbourhood": a, "neighbourhood_group": None}} for a in AREAS],
    }))


def test_full_run(spark, tmp_path):
    make_city(tmp_path / "raw" / "town")
    out = str(tmp_path / "out")
    master = refresh(spark, str(tmp_path / "raw"), "Town ", out, database="default")
    rows = {r.id: r for r in master.collect()}
    assert sorted(rows) == list(range(1, 9))
    assert rows[1].price is None and rows[1].price_best_available == 1100.0 and rows[1].price_source == "detailed_listings"
    assert not rows[1].has_review_history and rows[2].detailed_review_count == 2
    assert not rows[8].detailed_source_available and rows[8].calendar_complete_365_day_window
    assert rows[2].detailed_property_type == "Flat" and rows[3].host_is_superhost is True and rows[2].license is None
    assert rows[2].beds == 1 and rows[2].name == 'Nice, "home"\n2'
    report = spark.read.parquet(f"{out}/validation")
    assert report.count() == 90
    counts = {r.status: r["count"] for r in report.groupBy("status").count().collect()}
    assert "FAIL" not in counts and counts["WARNING"] >= 5
    checks = spark.read.option("header", True).csv(f"{out}/reports/warehouse_summary")
    assert checks.count() == 17 and checks.where("status = 'FAIL'").count() == 0
    metrics = {r.metric: float(r.value) for r in spark.read.option("header", True).csv(f"{out}/reports/enrichment_summary").collect()}
    assert len(metrics) == 15 and metrics["total_calendar_rows_aggregated"] == 8 * 365
    assert [r.neighbourhood_key for r in spark.read.parquet(f"{out}/dim_neighbourhoods").orderBy("neighbourhood").collect()] == [1, 2]
    assert len(spark.read.parquet(f"{out}/dim_listings").columns) == len(warehouse.DIM_LISTING_COLUMNS)
    assert spark.table("default.dim_listings").count() == spark.table("default.enriched_listing_master").count() == 8
    profile = spark.read.option("header", True).csv(f"{out}/reports/column_profile")
    samples = {(r.dataset_name, r.column_name): r.sample_values for r in profile.collect()}
    assert samples["neighbourhoods", "neighbourhood"] == "North | South"
    sizes = {r.dataset_name: int(r.file_size_bytes) for r in spark.read.option("header", True).csv(f"{out}/reports/dataset_summary").collect()}
    assert sizes["calendar"] == (tmp_path / "raw" / "town" / "calendar.csv.gz").stat().st_size and len(sizes) == 7
    via_sql = run_sql(spark, "SELECT * FROM vw_room_type_performance WHERE listing_count > :n", {"n": 1}).collect()
    assert [tuple(r) for r in via_sql] == [tuple(r) for r in published.room_type_pricing(master).collect()]


def test_gate_stops_a_bad_city(spark, tmp_path):
    make_city(tmp_path / "raw" / "town", latitude="123.0")
    with pytest.raises(GateError, match="SL_004"):
        refresh(spark, str(tmp_path / "raw"), "town", str(tmp_path / "out"))


def test_a_dataset_that_fails_is_reported_with_the_others(spark, tmp_path):
    from lodestay.plans.refresh import ProfileError

    make_city(tmp_path / "raw" / "town")
    (tmp_path / "raw" / "town" / "reviews.csv").unlink()
    with pytest.raises(ProfileError, match="reviews.csv"):
        refresh(spark, str(tmp_path / "raw"), "town", str(tmp_path / "out"))
    rows = {r.dataset_name: r for r in spark.read.option("header", True).csv(f"{tmp_path}/out/reports/dataset_summary").collect()}
    assert len(rows) == 7 and [n for n, r in rows.items() if r.status == "FAILED"] == ["summary_reviews"]
    assert rows["summary_reviews"].error_message and rows["summary_reviews"].row_count is None
    assert rows["calendar"].row_count == str(8 * 365) and rows["calendar"].error_message is None


def test_observed_figures_are_those_of_a_scan(spark, tmp_path):
    """Landing, the audit and the metrics count while they write; scans of their own give the same."""
    from lodestay.operators import cleaning
    from lodestay.operators.observed import Tally, write_observed
    from lodestay.sources import schemas
    from pyspark.sql import functions as F

    make_city(tmp_path / "raw" / "town")
    shelf = Catalog(spark, str(tmp_path / "raw"), "Town")
    for name, policy in (("summary_listings", schemas.SUMMARY_POLICY), ("detailed_listings", schemas.DETAILED_POLICY)):
        landed, figures = shelf.land_observed(name, str(tmp_path / "landed" / name), lambda df: cleaning.fraction_tally(df, policy))
        known = cleaning.with_fractions(landed, policy, figures)
        assert known.fractional == cleaning.fractional_columns(shelf.load(name), policy)
        path = str(tmp_path / "cleaned" / name)
        audit, rows = cleaning.write_cleaned(landed, known, name, path)
        assert rows == figures["rows"] == landed.count()
        assert sorted(map(tuple, audit.collect())) == sorted(map(tuple, cleaning.audit(landed, known, name).collect()))
        stored, wanted = spark.read.parquet(path), cleaning.clean(landed, known)
        assert stored.columns == wanted.columns and stored.exceptAll(wanted).isEmpty() and wanted.exceptAll(stored).isEmpty()
    tally = Tally({"rows": F.count(F.lit(1)), "twos": F.count_if("two")}, {"two": F.col("id") % 2 == 0})
    assert write_observed(spark.range(9).where("id > 3"), str(tmp_path / "some"), tally) == {"rows": 5, "twos": 3}
    assert spark.read.parquet(str(tmp_path / "some")).columns == ["id"]
    for empty in (spark.range(9).where("id > 30"), spark.range(9).where("false"), spark.createDataFrame([], "id long")):
        assert write_observed(empty, str(tmp_path / "none"), tally) == {"rows": 0, "twos": 0}
        assert spark.read.schema("id long").parquet(str(tmp_path / "none")).count() == 0


def test_catalog_and_areas(spark, tmp_path):
    make_city(tmp_path / "raw" / "town")
    shelf = Catalog(spark, str(tmp_path / "raw"), "Town")
    assert shelf.load("summary_reviews", ["date"], 3).collect()[0].asDict() == {"date": "2025-01-15"}
    assert shelf.load("detailed_reviews").where("comments LIKE '%two%'").count() == 7
    with pytest.raises(KeyError, match="unknown dataset"):
        shelf.path("bookings")
    areas = read_areas(spark, shelf.path("neighbourhoods_geojson")).orderBy("neighbourhood").collect()
    assert [(a.neighbourhood, a.geometry_type, a.has_geometry) for a in areas] == [
        ("North", "MultiPolygon", True), ("South", "MultiPolygon", True)]
    with pytest.raises(ValueError, match="empty"):
        run_sql(spark, "  ")


def test_a_failed_publication_leaves_the_old_table(spark):
    from pyspark.sql import functions as F

    from lodestay.sources.catalog import PublishError, replace_table

    replace_table(spark.range(3), "default.published")
    replace_table(spark.range(5), "default.published")
    assert spark.table("default.published").count() == 5
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("midway"))).cast("bigint").alias("id"))
    with pytest.raises(PublishError):
        replace_table(broken, "default.published")

    def too_few(df):
        if df.count() < 5:
            raise ValueError("rows are missing")

    with pytest.raises(PublishError):
        replace_table(spark.range(2), "default.published", too_few)
    assert spark.table("default.published").count() == 5
    assert [t.name for t in spark.catalog.listTables("default") if t.name.startswith("published")] == ["published"]
