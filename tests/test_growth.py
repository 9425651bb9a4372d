"""Work that must be done once, however many figures a query shows: scans in plans, and code that Spark can compile."""

import re

import pytest
from pyspark.sql import functions as F

from lodestay.operators import hypothesis
from lodestay.plans import warehouse
from lodestay.suite import market


@pytest.fixture
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_a_hypothesis_reads_its_population_once(static, tmp_path):
    path = str(tmp_path / "population")
    rows = [("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 2.0), ("b", 3.5), ("c", 9.0), ("a", None)]
    static.createDataFrame(rows, "group string, value double").write.parquet(path)
    found = hypothesis.hypothesis_row(static.read.parquet(path), "a", "b", "H", "?", "groups")
    assert scans(found) == 1
    r = found.first()
    assert (r.group_1_n, r.group_1_median, r.group_2_n, r.group_2_median, r.test_statistic) == (3, 2.0, 2, 2.75, 2.5)


def test_a_group_without_rows_has_no_median(spark):
    population = spark.createDataFrame([("a", 1.0), ("a", 5.0)], "group string, value double")
    r = hypothesis.hypothesis_row(population, "a", "b", "H", "?", "groups").first()
    assert (r.group_1_n, r.group_1_median, r.group_2_n, r.group_2_median, r.decision) == (2, 3.0, 0, None, None)


def _listing_master(spark, path):
    rows = [("A", "R", "S", 10.0, 4.0, 3, 0.5, 0.25), ("A", "R", None, 20.0, None, 0, 0.1, 0.75),
            ("B", "R", "S", None, 5.0, 2, None, None), (None, "Q", "S", 40.0, 3.0, 1, 0.2, 0.5)]
    spark.createDataFrame(rows, "neighbourhood string, room_type string, host_portfolio_segment string, "
                          "price_best_available double, review_scores_rating double, detailed_review_count long, "
                          "availability_rate_observed double, unavailability_rate_proxy double").write.parquet(path)
    return spark.read.parquet(path)


def test_all_view_readouts_come_from_one_scan(static, tmp_path):
    master = _listing_master(static, str(tmp_path / "master"))
    out = warehouse.view_readouts(master)
    assert scans(out) == 1
    got = {tuple(r) for r in out.collect()}
    for name, build in warehouse.VIEWS.items():
        view = build(master)
        missing = [c for c in out.columns if c not in view.columns and c != "view_name"]
        whole = view.select(F.lit(name).alias("view_name"), "*", *[F.lit(None).alias(c) for c in missing])
        mine = {tuple(r) for r in whole.select(*out.columns).collect()}
        assert mine <= got
        got -= mine
    assert not got


@pytest.mark.parametrize("cleaned", [market.canonical, market.detail])
def test_cleaning_stays_within_what_is_compiled(static, sf, cleaned):
    plan = cleaned(static, sf)._jdf.queryExecution().executedPlan()
    debug = static._jvm.org.apache.spark.sql.execution.debug
    text = getattr(getattr(debug, "package$"), "MODULE$").codegenString(plan)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", text)]
    assert sizes and 0 < min(sizes) and max(sizes) <= 8000  # HotSpot leaves larger methods to its interpreter
