"""Registered queries: contract, and a selection compared with SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import compare
from lodestay.suite.registry import ORACLES, QUERIES, TABLES

# one or two of each kind; ``check.py`` compares all of them
COMPARED = (
    "enriched_master", "event_rate", "reconcile_totals", "q1", "q3", "q4", "q8", "group_activity", "metric_long",
    "profile_columns", "profile_samples", "candidate_keys", "dup_hash_rows", "repeated_text_top", "validate_facts",
    "fk_anti_null", "status_counts", "clean_audit", "iqr_outliers", "histogram_trimmed", "multiset_diff",
    "coverage_both_ways", "group_describe", "mann_whitney", "facet_filter_kpis", "rare_category_map", "dummy_metrics",
)


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_contract():
    queries, oracles = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100
    # only what SQL cannot express has no equivalent
    assert set(QUERIES) - set(ORACLES) == {
        "hypothesis_results", "ridge_rf_compare", "model_predictions", "feature_importance"}


def test_entry_is_lazy_and_keeps_the_population(spark, sf):
    master = entry_points.entry(spark)
    assert master.count() == spark.read.parquet(f"{sf}/orders.parquet").count()


@pytest.mark.parametrize("name", COMPARED)
def test_matches_sql(spark, con, sf, name):
    text, _, fine = compare(spark, con, name, entry_points.queries()[name], entry_points.oracle_sql()[name], sf)
    assert fine, text


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_facets_and_columns_reach_the_scan(spark, sf, tmp_path):
    from lodestay.operators.facets import FacetSpec, facet_filter

    path = str(tmp_path / "master")
    entry_points.queries()["enriched_master"](spark, sf).write.parquet(path)
    spec = FacetSpec(choices={"neighbourhood": ["NATION_1"]}, flags={"host_is_superhost": ["Yes"]},
                     ranges={"price_best_available": (10.0, 1e6)})
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # show the whole scan line
    plan = final_plan(facet_filter(spark.read.parquet(path), spec).select("id"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    for part in ("EqualTo(neighbourhood,NATION_1)", "EqualTo(host_is_superhost,true)", "GreaterThanOrEqual(price_best_available"):
        assert part in pushed
    assert "room_type" not in pushed  # not read


def test_quantiles_share_one_shuffle_of_the_input(spark, sf):
    from lodestay.operators.ordering import exact_quantiles

    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    plan = final_plan(exact_quantiles(lineitem, ["l_returnflag"], {"m": ("l_extendedprice", 0.5)}))
    current = plan.split("== Initial Plan ==")[0]
    assert current.count("FileScan") == 1 and "ReusedExchange" in current and "CartesianProduct" not in current


def test_unused_joins_are_dropped(spark, sf):
    """Rollups are unique by construction, so a question that needs none of them joins none of them."""
    plan = final_plan(entry_points.queries()["portfolio_segment"](spark, sf)).split("== Initial Plan ==")[0]
    assert "lineitem.parquet" not in plan


def test_core_loads_without_what_the_training_data_operators_need():
    """With a dependency of theirs hidden, all other queries are there."""
    import subprocess
    import sys

    code = (
        "import sys, warnings; sys.modules['ahocorasick'] = None; warnings.simplefilter('ignore'); import __spark_entry__ as e; "
        "print(len(e.queries()), any(n.startswith('op') or n == 'pipeline' for n in e.queries() if n[2:3].isdigit() or n == 'pipeline'))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split()
    assert out == [str(len(QUERIES)), "False"]
