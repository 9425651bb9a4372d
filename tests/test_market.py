"""Enrichment semantics, warehouse reconciliation, facets and price models on small fixtures."""

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestay.operators import enrichment, facets, modelling, reconciliation, rollups
from lodestay.operators import summaries as S
from lodestay.operators.cleaning import GrainError
from lodestay.plans import warehouse
from lodestay.session import durable
from lodestay.suite import analysis_queries


def test_derived_features(spark):
    df = spark.createDataFrame(
        [(1, 200.0, 190.0, 2, 4, 1, 5, 365), (2, None, 120.0, 1, 2, 3, None, 365), (3, 150.0, 145.0, 0, 0, 10, 20, None)],
        "id int, price double, detailed_price double, bedrooms int, accommodates int, "
        "calculated_host_listings_count int, detailed_review_count long, calendar_days_observed long",
    )
    rows = enrichment.derive_features(df).orderBy("id").collect()
    assert [r.price_best_available for r in rows] == [200.0, 120.0, 150.0]
    assert [r.price_source for r in rows] == ["summary_listings", "detailed_listings", "summary_listings"]
    assert [r.price_per_bedroom for r in rows] == [100.0, 120.0, None]
    assert [r.price_per_guest for r in rows] == [50.0, 60.0, None]
    assert [r.host_portfolio_segment for r in rows] == [
        "Single-listing host", "Small multi-listing host (2-5)", "Large/professional host (6+)"]
    assert [r.detailed_review_count for r in rows] == [5, 0, 20]
    assert [r.has_review_history for r in rows] == [True, False, True]
    assert [r.calendar_data_available for r in rows] == [True, True, False]


def test_single_price_source(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None)], "id int, price double")
    assert [r.price_source for r in enrichment.derive_features(df).orderBy("id").collect()] == ["summary_listings", "missing"]


def test_segment_of_small_or_missing_size_is_null(spark):
    df = spark.createDataFrame([(0.0,), (None,), (1.5,)], "n double")
    assert [r[0] for r in df.select(enrichment.portfolio_segment("n")).collect()] == [None, None, None]


def test_join_keeps_population_and_suffixes_shared_names(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    right = spark.createDataFrame([(1, "x")], "listing_id int, name string")
    out = enrichment.left_preserving_join(left, right, "id", "listing_id")
    assert out.columns == ["id", "name_x", "name_y"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "a", "x"), (2, "b", None)]


def test_build_master_refuses_repeated_and_orphan_keys(spark):
    canonical = spark.createDataFrame([(1, 5.0), (2, None)], "id int, price double")
    detail = spark.createDataFrame([(1, True)], "listing_id int, detailed_source_available boolean")
    calendar = spark.createDataFrame([(1, 365)], "listing_id int, calendar_days_observed long")
    repeated = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "listing_id int, detailed_review_count long")
    with pytest.raises(GrainError, match="duplicate 'listing_id'"):
        enrichment.build_master(canonical, detail, repeated, calendar, verify=True)
    orphan = spark.createDataFrame([(7, 1)], "listing_id int, detailed_review_count long")
    with pytest.raises(GrainError, match="outside the canonical"):
        enrichment.build_master(canonical, detail, orphan, calendar, verify=True)
    good = spark.createDataFrame([(2, 4)], "listing_id int, detailed_review_count long")
    rows = enrichment.build_master(canonical, detail, good, calendar, verify=True).orderBy("id").collect()
    assert [(r.detailed_source_available, r.detailed_review_count) for r in rows] == [(True, 0), (False, 4)]


def test_event_rate_needs_thirty_days(spark):
    start = dt.date(2024, 1, 1)
    rows = [(1, start, 5, "n", "c"), (1, start + dt.timedelta(29), 5, " ", None),
            (2, start, None, None, ""), (2, start + dt.timedelta(30), 6, "n", "c")]
    df = spark.createDataFrame(rows, "listing_id int, date date, reviewer_id int, reviewer_name string, comments string")
    a, b = rollups.event_rollup(df).orderBy("listing_id").collect()
    assert (a.review_span_days, a.review_events_per_active_year, a.missing_reviewer_name_count) == (29, None, 1)
    assert (b.review_span_days, b.review_events_per_active_year, b.unique_reviewer_count) == (30, 24.35, 1)


def test_calendar_rates_use_all_rows(spark):
    # 2024-01-06 is a Saturday
    rows = [(1, "2024-01-06", "t", "2", "9"), (1, "2024-01-07", "f", "x", "9"), (1, "2024-01-08", "maybe", "4", None),
            (1, "bad", "t", None, None)]
    df = spark.createDataFrame(rows, "listing_id int, date string, available string, minimum_nights string, maximum_nights string")
    r = rollups.calendar_rollup(rollups.normalised_calendar(df), 4).first()
    assert (r.calendar_days_observed, r.available_days, r.unavailable_days) == (4, 2, 1)
    assert (r.availability_rate_observed, r.unavailability_rate_proxy) == (0.5, 0.25)
    assert (r.weekend_days_observed, r.weekend_availability_rate) == (2, 0.5)
    assert (r.weekday_days_observed, r.weekday_availability_rate) == (1, 0.0)
    assert (r.calendar_avg_minimum_nights, r.calendar_complete_365_day_window) == (3.0, True)


def test_key_probe_leaves_nulls_out_of_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    r = warehouse.key_probe(df, "k").first()
    assert (r.row_count, r.distinct_count, r.null_count, r.duplicate_key_rows) == (5, 2, 2, 2)


def test_reconciliation_error(spark):
    actual = spark.createDataFrame([(5,)], "n long")
    report = warehouse.equality_checks("t", actual, spark.createDataFrame([(6,)], "n long"), [("rows", "n", "n", "")])
    with pytest.raises(warehouse.ReconciliationError, match="t.rows: 5, expected 6"):
        warehouse.require_reconciled(report)
    warehouse.require_reconciled(warehouse.equality_checks("t", actual, actual, [("rows", "n", "n", ""), ("five", "n", 5, "")]))


def _small_market(spark):
    master = spark.createDataFrame([("1", "A", "R", "S"), ("2", "B", "R", None), ("3", None, "R", None)],
                                   "id string, neighbourhood string, room_type string, host_portfolio_segment string")
    reviews = spark.createDataFrame([("1",), ("1",), ("2",)], "listing_id string")
    fact = reviews.groupBy("listing_id").agg(F.count(F.lit(1)).alias("detailed_review_count"))
    days = fact.select("listing_id", F.col("detailed_review_count").alias("calendar_days_observed"),
                       F.lit(True).alias("calendar_complete_365_day_window"))
    return master, reviews, fact, days


def test_reconcile_passes_and_names_what_differs(spark):
    master, reviews, fact, days = _small_market(spark)

    def bad(*args, **dims):
        return {(r.object_name, r.metric) for r in warehouse.reconcile(*args, **dims).where("status = 'FAIL'").collect()}

    assert warehouse.reconcile(master, fact, days, master, reviews, reviews).count() == 17
    assert bad(master, fact, days, master, reviews, reviews) == set()
    dims, areas = warehouse.dim_listings(master), master.select("neighbourhood").dropna()
    assert bad(master, fact, days, master, reviews, reviews, listing_dim=dims, area_dim=areas) == set()
    assert bad(master, fact, days, master, reviews, reviews, listing_dim=dims.union(dims.limit(1)), area_dim=areas.limit(1)) == {
        ("dim_listings", "row_count"), ("dim_neighbourhoods", "row_count")}
    twice = master.union(master.where("id = '2'"))
    assert bad(twice, fact, days, master, reviews, reviews) == {
        ("enriched_listing_master", "row_count"), ("enriched_listing_master", "duplicate_listing_id_rows"),
        ("dim_listings", "row_count")}
    unknown = master.withColumn("host_portfolio_segment", F.lit(None).cast("string"))
    assert bad(unknown, fact.where("listing_id = '1'"), days.withColumn("calendar_complete_365_day_window", F.lit(False)),
               master, reviews, reviews) == {
        ("vw_host_portfolio_performance", "row_count"), ("fact_review_activity", "row_count"),
        ("fact_review_activity", "total_detailed_review_events"), ("fact_calendar_activity", "complete_365_day_windows")}


def test_reconcile_reads_each_object_once(spark, tmp_path):
    tables = []
    for i, df in enumerate(_small_market(spark)):
        df.write.parquet(str(tmp_path / str(i)))
        tables.append(spark.read.parquet(str(tmp_path / str(i))))
    master, reviews, fact, days = tables
    plan = warehouse.reconcile(master, fact, days, master, reviews, reviews)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 6


def test_correlation_skips_incomplete_pairs_and_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 7.0), (2.0, 4.0, 7.0), (3.0, None, 7.0), (None, 9.0, 7.0)], "a double, b double, c double")
    got = {(r.column_1, r.column_2): r.correlation for r in S.correlation_pairs(df, ["a", "b", "c"], 6).collect()}
    assert got[("a", "b")] == 1.0 and got[("b", "a")] == 1.0 and got[("a", "a")] == 1.0
    assert got[("a", "c")] is None and got[("c", "c")] is None


def test_histogram_covers_every_value(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(101), None or 100]], "x double")
    rows = S.histogram(df, "x", 50).collect()
    assert sum(r.row_count for r in rows) == 102 and {r.bin for r in rows} == set(range(50))
    flat = S.histogram(spark.createDataFrame([(3.0,), (3.0,)], "x double"), "x").collect()
    assert [(r.bin, r.row_count) for r in flat] == [(0, 2)]


def test_multiset_difference_matches_null_keys(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "d")], "k int, d string")
    b = spark.createDataFrame([(1, None), (2, "d"), (3, "e")], "k int, d string")
    rows = reconciliation.multiset_difference(a, b, ["k", "d"]).collect()
    assert sorted((r.k, r.left_count, r.right_count) for r in rows) == [(1, 2, 1), (3, 0, 1)]


def test_coverage_of_an_empty_side_is_zero(spark):
    a = spark.createDataFrame([], "k int")
    b = spark.createDataFrame([(1,)], "k int")
    r = reconciliation.key_coverage(a, "k", b, "k").first()
    assert (r.left_keys, r.only_right, r.left_coverage_pct, r.right_coverage_pct) == (0, 1, 0.0, 0.0)
    assert not reconciliation.same_key_set(a, "k", b, "k").first().sets_equal


def test_join_back_proof(spark):
    df = spark.createDataFrame([(1, "d", 10), (1, "d", 11), (2, "d", 12), (3, "e", 13), (3, "e", 13)], "k int, d string, id int")
    r = reconciliation.join_back_proof(df, ["k", "d"], "id").first()
    assert (r.repeated_groups, r.rows_in_groups, r.distinct_ids_in_groups, r.all_distinct) == (2, 4, 3, False)


def test_facets(spark):
    df = spark.createDataFrame([(1, "A", True, 10.0), (2, "B", None, None), (3, "A", False, 99.0)],
                               "id int, area string, flag boolean, price double")

    def ids(**kw):
        return sorted(r.id for r in facets.facet_filter(df, facets.FacetSpec(**kw)).collect())

    assert ids() == [1, 2, 3]
    assert ids(choices={"area": [], "absent": ["x"]}) == [1, 2, 3]
    assert ids(flags={"flag": ["Missing", "No"]}) == [2, 3]
    assert ids(ranges={"price": (10.0, 50.0)}) == [1]
    assert ids(ranges={"price": (None, None)}) == [1, 2, 3]
    assert facets.active_range((1, 9), (1, 9)) == (None, None) and facets.active_range((2, 9), (1, 9)) == (2, 9)
    r = facets.secondary_overview(df.limit(0).withColumn("e", F.lit(1)), "e", "price", "id", "flag").first()
    assert (r.total_review_events, r.superhost_count, r.median_unavailability) == (None, 0, None)


SPEC = modelling.ModelSpec(key="id", target="y", numerical=("x", "w"), categorical=("c",), trees=5, depth=4)


def model_rows(spark, n=400):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        x = float(rng.normal())
        c = None if i % 50 == 0 else ["a", "b", f"rare{i % 97}"][min(i % 23, 2) if i % 23 < 2 else (0 if i % 2 else 1)]
        rows.append((i, x if i % 11 else None, float(rng.normal()), c, float(np.exp(3 + 0.5 * x + 0.1 * rng.normal()))))
    return spark.createDataFrame(rows, "id int, x double, w double, c string, y double")


def test_model_frame_checks(spark):
    df = model_rows(spark, 20)
    with pytest.raises(ValueError, match="missing"):
        modelling.modelling_frame(df.drop("x"), SPEC)
    leaky = modelling.ModelSpec(key="id", target="y", numerical=("price",), categorical=())
    with pytest.raises(ValueError, match="leakage"):
        modelling.modelling_frame(df.withColumn("price", F.lit(1.0)), leaky)
    kept = modelling.modelling_frame(df.withColumn("y", F.when(F.col("id") > 1, F.col("y")).otherwise(-1.0)), SPEC)
    assert kept.count() == 18


def test_split_is_stable_and_about_a_fifth(spark):
    df = modelling.with_split(spark.range(5000), "id")
    a = {r.id for r in df.where("is_test").collect()}
    b = {r.id for r in modelling.with_split(spark.range(5000).repartition(7), "id").where("is_test").collect()}
    assert a == b and 850 < len(a) < 1150


def test_rare_unseen_and_missing_categories(spark):
    train = spark.createDataFrame([(i, 1.0, 2.0, c, 5.0) for i, c in enumerate(["a"] * 12 + ["r"] * 3 + [None] * 10)],
                                  "id int, x double, w double, c string, y double")
    fitted = modelling.fit_features(train, SPEC)
    assert fitted.names == ["x", "w", "c_Missing", "c___rare__", "c_a"]
    probe = spark.createDataFrame([(1, 1.0, 2.0, "a", 1.0), (2, 1.0, 2.0, "r", 1.0), (3, 1.0, 2.0, "new", 1.0),
                                   (4, None, 2.0, None, 1.0)], "id int, x double, w double, c string, y double")
    vectors = [list(r.features.toArray())[2:] for r in fitted.transform(probe).orderBy("id").collect()]
    assert vectors == [[0, 0, 1], [0, 1, 0], [0, 0, 0], [1, 0, 0]]


def test_ridge_equals_closed_form(spark):
    df = modelling.modelling_frame(model_rows(spark), SPEC).withColumn("label", F.log1p("y"))
    fitted = modelling.fit_features(df, SPEC)
    ready = fitted.transform(df).select("features", "label")
    model = modelling.fit_ridge(ready, modelling.ModelSpec(alpha=1.0))
    rows = ready.collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows])
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), expected, atol=1e-9)


def test_price_experiment(spark):
    result = modelling.run_price_experiment(model_rows(spark), SPEC)
    table = {r.model: r for r in result.results.collect()}
    assert table[modelling.RIDGE].mae_eur < table[modelling.DUMMY].mae_eur
    assert table[modelling.DUMMY].mae_improvement_pct == 0.0
    importance = result.importance.orderBy("rank").collect()
    assert importance[0].feature == "x" and sum(r.importance for r in importance) == pytest.approx(1.0)
    assert result.predictions.count() == result.predictions.select("id").distinct().count()
    scored = modelling.score(result.predictions, "actual_price", modelling.prediction_column(modelling.RIDGE), "r").first()
    assert scored.mae_eur == table[modelling.RIDGE].mae_eur


def test_model_queries_learn_from_all_training_rows(spark, sf, monkeypatch):
    """The tables of the queries agree with those over all rows; only the forest has a sample, and few trees here."""
    fit, learned, seen = modelling.fit_forest, [], []

    def small(train, spec):
        learned.append((train.count(), modelling.forest_sample(train, spec).count(), spec.trees, spec.depth))
        return fit(train, replace(spec, trees=2, depth=2))

    run = modelling.run_price_experiment
    monkeypatch.setattr(modelling, "fit_forest", small)
    monkeypatch.setattr(modelling, "run_price_experiment", lambda *a: seen.append(run(*a)) or seen[-1])
    dummy = analysis_queries.ridge_rf_compare(spark, sf).where(F.col("model") == modelling.DUMMY).drop("mae_improvement_pct")
    assert dummy.collect() == analysis_queries.dummy_metrics(spark, sf).collect()
    assert sorted(seen[0].features.categories.collect()) == sorted(analysis_queries.rare_category_map(spark, sf).collect())
    frame = analysis_queries.model_frame(spark, sf)
    n = frame.where("not is_test").count()
    assert learned == [(n, min(n, modelling.ModelSpec().forest_rows), 200, 18)] and n > 1000
    assert seen[0].predictions.count() == frame.where("is_test").count()


def test_ridge_that_has_not_converged_is_an_error(spark):
    df = modelling.modelling_frame(model_rows(spark), SPEC).withColumn("label", F.log1p("y"))
    ready = modelling.fit_features(df, SPEC).transform(df).select("features", "label")
    with pytest.raises(RuntimeError, match="converged"):
        modelling.fit_ridge(ready, replace(SPEC, ridge_iterations=2))


def test_forest_sample_does_not_depend_on_partitions(spark):
    rows, spec = spark.range(5000), replace(SPEC, forest_rows=300)
    first = {r.id for r in modelling.forest_sample(rows, spec).collect()}
    assert len(first) == 300 and first == {r.id for r in modelling.forest_sample(rows.repartition(9), spec).collect()}


def test_a_million_categories_in_signed_buckets(spark):
    rows = spark.range(1_000_000).select(
        F.col("id").cast("string").alias("id"), F.rand(1).alias("x"), F.rand(2).alias("w"), F.concat(F.lit("c"), "id").alias("c"),
        (F.rand(3) + 1).alias("y"))
    spec = replace(SPEC, hashed_buckets=32, ridge_iterations=200, ridge_tolerance=1e-4)
    frame = modelling.modelling_frame(rows, spec).withColumn("label", F.log1p("y"))
    fitted = modelling.fit_features(frame, spec)
    assert fitted.categories is None and fitted.names == ["x", "w", *(f"c_bucket_{k}" for k in range(32))]
    vectors = [r.features.toArray()[2:] for r in fitted.transform(frame.limit(200)).select("features").collect()]
    assert all(sorted(set(abs(v))) == [0.0, 1.0] and abs(v).sum() == 1 for v in vectors)
    assert {float(v.sum()) for v in vectors} == {-1.0, 1.0}
    again = fitted.transform(frame.where("id = 7")).first().features
    assert again == fitted.transform(frame.where("id = 7").repartition(3)).first().features
    assert len(modelling.fit_ridge(fitted.transform(frame).select("features", "label"), spec).coefficients) == 34
    with pytest.raises(ValueError, match="hashed_buckets"):
        modelling.fit_features(frame.where("id < 40").crossJoin(spark.range(10)).drop("id"), replace(SPEC, max_encoded_categories=5))


def test_declared_fractions_are_those_of_the_data(spark, sf):
    """The derived tables pass their fractional columns on, so that no job runs while a plan is put together."""
    from lodestay.operators import cleaning
    from lodestay.sources import schemas
    from lodestay.suite import market as M

    assert cleaning.fractional_columns(M.raw_listings(spark, sf), schemas.SUMMARY_POLICY) == M.LISTING_POLICY.fractional
    assert cleaning.fractional_columns(M.raw_detail(spark, sf), schemas.DETAILED_POLICY) == M.DETAIL_POLICY.fractional


def fitted_rows(spark, spec):
    frame = modelling.modelling_frame(model_rows(spark), spec).withColumn("label", F.log1p("y"))
    fitted = modelling.fit_features(frame, spec)
    return frame, fitted, fitted.transform(frame).select("id", "features", "label")


def test_batches_score_as_the_forest_does(spark):
    _, _, ready = fitted_rows(spark, SPEC)
    forest = modelling.fit_forest(ready, replace(SPEC, trees=7, depth=9, minimum_leaf=1))
    text = forest.toDebugString
    assert "in {" in text and "<=" in text  # both kinds of splits
    both = forest.setPredictionCol("its").transform(ready).withColumn("ours", modelling.forest_scores(forest)("features"))
    rows = both.select("its", "ours").collect()
    assert len({r.its for r in rows}) > 10 and all(r.its == r.ours for r in rows)


def test_listed_trees_send_values_down_as_spark_does():
    lines = ["header", "  If (feature 1 in {1.0})", "   Predict: 1.5", "  Else (feature 1 not in {1.0})", "   If (feature 0 <= -2.0E-3)",
             "    Predict: 2.5", "   Else (feature 0 > -2.0E-3)", "    Predict: -3.0"]
    feature, cut, child, value = modelling.listed_tree("\n".join(lines))
    assert (feature.tolist(), child.tolist(), value.tolist()) == ([1, 0, 0, 0, 0], [2, 1, 1, 1, 3, 4, 3, 3, 4, 4], [0, 1.5, 0, 2.5, -3])
    assert cut.tolist() == [0.5, np.inf, -0.002, np.inf, np.inf]
    assert modelling.listed_tree("header\n  If (feature 1 in {1.0,2.0})") is None


def test_categories_are_looked_up_without_a_shuffle_of_the_rows(spark):
    frame, fitted, _ = fitted_rows(spark, SPEC)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    plan = fitted.prepare(frame)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_ridge_is_solved_in_a_few_passes(spark):
    _, fitted, ready = fitted_rows(spark, SPEC)
    ready = durable(ready)
    spark.sparkContext.setJobGroup("solve", "ridge")
    model = modelling.solve_ridge(ready, SPEC, len(fitted.names))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("solve"))
    spark.sparkContext.setJobGroup("other", "")
    rows = ready.collect()
    x, y = np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])
    xc, yc = x - x.mean(0), y - y.mean()
    expected = np.linalg.solve(xc.T @ xc + SPEC.alpha * np.eye(x.shape[1]), xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), expected, atol=1e-9) and 0 < jobs <= 6
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ expected)


def test_the_importance_makes_vectors_of_the_sample_alone(spark, monkeypatch):
    spec = replace(SPEC, forest_rows=40)
    frame, fitted, ready = fitted_rows(spark, spec)
    near = modelling.around_sample(frame, spec)
    assert near.count() == 40 < frame.count()
    few = fitted.transform(near).select("id", "features", "label")
    assert modelling.fit_forest(few, spec).toDebugString.split("\n")[1:] == modelling.fit_forest(ready, spec).toDebugString.split("\n")[1:]
    fit, seen = modelling.fit_forest, []
    monkeypatch.setattr(modelling, "fit_forest", lambda train, spec: seen.append(train.count()) or fit(train, spec))
    modelling.forest_importance(model_rows(spark), spec)
    assert seen == [40]
