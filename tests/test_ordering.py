"""Distributed quantiles and rank sums against plain numpy."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestay.operators import hypothesis as H
from lodestay.operators import ordering
from lodestay.operators import summaries as S
from lodestay.operators.ordering import exact_quantiles
from lodestay.operators.summaries import group_summary


def test_quantiles_by_group_with_nulls_and_a_hot_group(spark):
    rng = np.random.default_rng(1)
    rows = [("hot", float(v)) for v in rng.integers(0, 500, 3000)] + [("small", 3.0), ("small", 8.0), ("one", 5.0)]
    rows += [(None, 1.0), (None, 2.0), ("empty", None), ("hot", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.q1, r.m, r.p) for r in exact_quantiles(
        df, ["g"], {"q1": ("v", 0.25), "m": ("v", 0.5), "p": ("v", 0.99)}).collect()}
    assert "empty" not in got
    for g in ("hot", "small", "one", None):
        values = [v for k, v in rows if k == g and v is not None and not math.isnan(v)]
        assert got[g] == pytest.approx(tuple(np.quantile(values, [0.25, 0.5, 0.99])))


def test_quantiles_of_several_columns_and_no_group(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, None), (4.0, 30)], "a double, b int")
    row = exact_quantiles(df, [], {"ma": ("a", 0.5), "mb": ("b", 0.5)}).first()
    assert (row.ma, row.mb) == (2.0, 20.0)


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(df, ["g"], {"m": ("v", 0.5)}).count() == 0
    row = group_summary(df, [], {"n": F.count("v")}, {"m": ("v", 0.5, None)}).first()
    assert (row.n, row.m) == (0, None)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6).map(lambda x: round(x, 2)), min_size=1, max_size=60), p=st.floats(0, 1))
def test_any_quantile(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, [], {"q": ("v", p)}).first().q
    assert got == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-6)


def brute_force_u(a, b):
    return sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def brute_force_p(a, b):
    n1, n2 = len(a), len(b)
    n, u = n1 + n2, brute_force_u(a, b)
    counts = np.unique(a + b, return_counts=True)[1].astype(float)
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - (counts**3 - counts).sum() / (n * (n - 1))))
    z = (max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / sigma
    return min(1.0, math.erfc(z / math.sqrt(2)))


def population(spark, a, b):
    return spark.createDataFrame([("a", float(v)) for v in a] + [("b", float(v)) for v in b], "group string, value double")


def test_rank_sum_with_ties(spark):
    row = H.mann_whitney(population(spark, [1, 2, 2], [2, 3]), "a", "b").first()
    assert (row.group_1_n, row.group_2_n, row.test_statistic) == (3, 2, 1.0)


def test_mann_whitney_against_brute_force(spark):
    rng = np.random.default_rng(7)
    a, b = [int(v) for v in rng.integers(0, 40, 70)], [int(v) for v in rng.integers(5, 45, 90)]
    row = H.mann_whitney(population(spark, a, b), "a", "b").first()
    assert row.test_statistic == brute_force_u(a, b)
    assert row.p_value == pytest.approx(brute_force_p(a, b), rel=1e-12)
    assert row.effect_size_rank_biserial == pytest.approx(2 * brute_force_u(a, b) / (70 * 90) - 1)


def test_hypothesis_row(spark):
    pop = population(spark, range(100, 150), range(50))
    row = H.hypothesis_row(pop, "a", "b", "H1", "question", "values").first()
    assert row.group_1_median == 124.5 and row.group_2_median == 24.5
    assert row.decision == "Reject H0" and len(row.asDict()) == 15
    same = H.hypothesis_row(population(spark, range(20), range(20)), "a", "b", "H2", "q", "values").first()
    assert same.decision == "Fail to reject H0" and same.p_value == 1.0


def test_two_groups_labels(spark):
    df = spark.createDataFrame([(True, 1.0), (False, 2.0), (None, 3.0), (True, None)], "f boolean, v double")
    rows = H.two_groups(df, "f", "v", {True: "yes", False: "no"}).collect()
    assert sorted((r.group, r.value) for r in rows) == [("no", 2.0), ("yes", 1.0)]


def test_no_decision_without_rows(spark):
    """An empty group, or no rows at all: the figures are unknown, and nothing is decided."""
    for first in ([], [1.0, 2.0]):
        rows = population(spark, first, [])
        row = H.hypothesis_row(rows, "a", "b", "h", "q", "prices").first()
        assert row.p_value is None and row.decision is None and row.conclusion is None
    tied = H.hypothesis_row(population(spark, [1.0, 1.0], [1.0]), "a", "b", "h", "q", "prices").first()
    assert tied.group_1_n == 2


def test_image_has_the_order_of_the_bits(spark):
    rng = np.random.default_rng(3)
    powers = 2.0 ** np.arange(-1074, 1024)
    values = np.concatenate([
        rng.integers(0, 2**64, 2000, dtype=np.uint64).view(np.float64), powers, -powers, np.nextafter(powers[100:], 0),
        np.nextafter(powers[:-1], np.inf), [0.0, -0.0, np.inf, -np.inf, 1.7976931348623157e308]])
    rows = spark.createDataFrame([(float(v),) for v in values if not np.isnan(v)], "v double").select("v", ordering.image("v").alias("k")).collect()
    bits = np.array([r.v for r in rows]).view(np.int64)
    assert [r.k for r in rows] == np.where(bits < 0, -(bits & 0x7FFFFFFFFFFFFFFF), bits).tolist()


def test_a_million_distinct_values_never_meet_in_one_running_total(spark):
    """Every window orders a bounded number of rows; the values themselves are never sorted together."""
    rows = spark.range(1_000_000).select(F.expr("(id * 7919 % 1000003) / 1000.0 - 300").alias("v"))
    assert exact_quantiles(rows, [], {"a": ("v", 0.5), "b": ("v", 0.999)}).first().asDict() == pytest.approx(
        dict(zip("ab", np.quantile(np.arange(1_000_000) * 7919 % 1000003 / 1000.0 - 300, [0.5, 0.999]))))
    values = ordering.counted(ordering.value_counts(rows, [], "v"))
    per_round = [
        values.groupBy(ordering.prefix(k - 1) if k > 1 else F.lit("all")).agg(F.count_distinct(ordering.prefix(k)).alias("n")).agg(F.max("n")).first()[0]
        for k in (1, 2, 3)]
    assert max(per_round) < 20_000 and max(ordering.LEVELS) <= 22 and sum(ordering.LEVELS) == 64


def test_folds_and_quantiles_read_the_input_once(spark, sf):
    lineitem = spark.read.parquet(f"{sf}/lineitem.parquet")
    out = group_summary(
        lineitem, ["l_returnflag"],
        {"n": S.row_count(), "k": S.known("l_tax"), "a": S.average("l_discount", 4), "s": S.total("l_linenumber"),
         "lo": S.least("l_tax"), "hi": S.greatest("l_tax"), "w": S.rows_where(F.col("l_tax") > 0.04)},
        {"m": ("l_extendedprice", 0.5, 2)})
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    plain = lineitem.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count("l_tax").alias("k"), S.rounded(F.avg("l_discount"), 4).alias("a"),
        F.sum("l_linenumber").alias("s"), F.min("l_tax").alias("lo"), F.max("l_tax").alias("hi"), F.count_if(F.col("l_tax") > 0.04).alias("w"))
    assert sorted(map(tuple, out.drop("m").collect())) == sorted(map(tuple, plain.collect()))
