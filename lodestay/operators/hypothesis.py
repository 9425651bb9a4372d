"""Group descriptions and the two-sided Mann-Whitney U test."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.functions.numeric import join_on_keys, rounded
from lodestay.operators.ordering import all_read, between_ends, counted, median_ends, positions, value_counts
from lodestay.operators.summaries import group_summary, known

ALPHA = 0.05


def two_sided_p(z: Column) -> Column:
    """Normal tail probability of ``|z|``.

    Spark has no erfc; this runs on one result row per test. The function is
    local so that it travels to the workers by value.
    """
    def tail(values: pd.Series) -> pd.Series:
        return values.map(lambda v: min(1.0, math.erfc(v / math.sqrt(2.0))), na_action="ignore")

    return F.pandas_udf(tail, T.DoubleType())(z)


def two_groups(df: DataFrame, column: str, measure: str, labels: dict) -> DataFrame:
    """Rows of the two compared categories with a measured value: (group, value).

    ``labels`` maps a category value to the group name shown.
    """
    label = reduce(lambda acc, kv: acc.when(F.col(column) == F.lit(kv[0]), F.lit(kv[1])), labels.items(), F)
    rows = df.select(label.alias("group"), F.col(measure).cast("double").alias("value"))
    return rows.where(F.col("group").isNotNull() & F.col("value").isNotNull())


def describe_groups(population: DataFrame, digits: int | None = None) -> DataFrame:
    """n, mean, median, sample std, min, max, q1, q3, iqr per group."""
    def shown(c: Column) -> Column:
        return c if digits is None else rounded(c, digits)

    out = group_summary(
        population,
        ["group"],
        {
            "sample_size": F.count("value"),
            "mean": shown(F.avg("value")),
            "std": shown(F.stddev_samp("value")),
            "minimum": F.min("value"),
            "maximum": F.max("value"),
        },
        {
            "median": ("value", 0.5, None),
            "q1": ("value", 0.25, None),
            "q3": ("value", 0.75, None),
        },
    )
    return out.select(
        "group", "sample_size", "mean", shown(F.col("median")).alias("median"), "std", "minimum", "maximum",
        shown(F.col("q1")).alias("q1"), shown(F.col("q3")).alias("q3"), shown(F.col("q3") - F.col("q1")).alias("iqr"),
    )


def box_plot(population: DataFrame, digits: int | None = None, k: float = 1.5) -> DataFrame:
    """Box and whiskers per group; whiskers end at the last value inside the fences."""
    quartiles = group_summary(
        population, ["group"], {"n": known("value")},
        {"q1": ("value", 0.25, None), "median": ("value", 0.5, None), "q3": ("value", 0.75, None)},
    )
    # values are combined first, so a hot group is not shuffled row by row
    values = population.groupBy("group", "value").agg(F.count(F.lit(1)).alias("rows"))
    spread = (F.col("q3") - F.col("q1")) * k
    inside = (F.col("value") >= F.col("q1") - spread) & (F.col("value") <= F.col("q3") + spread)
    joined = join_on_keys(values, quartiles, ["group"], "inner").where(inside)
    out = joined.groupBy("group").agg(
        F.min("value").alias("whisker_low"), F.max("q1").alias("q1"), F.max("median").alias("median"),
        F.max("q3").alias("q3"), F.max("value").alias("whisker_high"),
    )
    if digits is None:
        return out
    return out.select("group", *[rounded(c, digits).alias(c) for c in out.columns[1:]])


def mann_whitney(population: DataFrame, first: str, second: str) -> DataFrame:
    """One row: n per group, U of the first group, z, two-sided p, rank-biserial effect.

    Tie-averaged ranks come from the (value -> count) table and distributed
    running totals (``ordering``), never from a rank window over all rows.
    Asymptotic with tie correction and continuity correction, as is usual for
    anything but a handful of untied values.
    """
    return _rank_test(population, first, second)


def _rank_test(population: DataFrame, first: str, second: str, medians: bool = False) -> DataFrame:
    """The row of ``mann_whitney``, with ``group_1_median`` and ``group_2_median`` from the same counts if asked for."""
    in_first = F.col("group") == first
    rows = population.where(F.col("group").isin(first, second)).select(
        F.col("value"), in_first.alias("in_first")
    )
    counts = value_counts(rows, [], "value", {"__n1": F.count_if("in_first")})
    placed = positions(counted(counts, ["__n1"]), ["__n1"])
    ends = {}
    if medians:
        known_rows = all_read(counts, ["__n1"]).where(F.col("__n") > 0)  # rows without a value are in no rank
        totals = known_rows.agg(F.sum("__n1").alias("__all1"), F.sum(F.col("__n") - F.col("__n1")).alias("__all2"))
        placed = placed.crossJoin(F.broadcast(totals))  # one row
        ends = median_ends("group_1_median", "__n1_before", "__n1", "__all1") | median_ends(
            "group_2_median", "(__before - __n1_before)", "(__n - __n1)", "__all2")
    n = F.col("__n")
    # Twice a tie-averaged rank is a whole number: sums of these are exact in any order, whatever their size.
    twice_rank = (F.col("__before") * 2 + n + 1).cast("decimal(19,0)") * F.col("__n1").cast("decimal(19,0)")
    cubed = n.cast("double") * n * n - n  # a share of n**3 below, where a double's 16 digits do
    sums = placed.agg(
        F.sum("__n").cast("double").alias("n"),
        F.sum("__n1").cast("double").alias("n1"),
        (F.sum(twice_rank) / 2).cast("decimal(38,1)").cast("double").alias("r1"),
        F.sum(cubed).alias("ties"),
        *[c.alias(k) for k, c in ends.items()],
    ).withColumn("n2", F.col("n") - F.col("n1"))
    u = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2
    pairs = F.col("n1") * F.col("n2")
    sigma = F.sqrt(
        pairs / 12.0 * ((F.col("n") + 1) - F.coalesce(F.try_divide(F.col("ties"), F.col("n") * (F.col("n") - 1)), F.lit(0.0)))
    )
    top = F.greatest(F.col("u"), pairs - F.col("u"))
    return (
        sums.withColumn("u", u)
        .withColumn("z", F.try_divide(top - pairs / 2.0 - F.lit(0.5), sigma))
        .select(
            F.col("n1").cast("bigint").alias("group_1_n"),
            F.col("n2").cast("bigint").alias("group_2_n"),
            F.col("u").alias("test_statistic"),
            "z",
            two_sided_p(F.col("z")).alias("p_value"),
            (F.try_divide(2.0 * F.col("u"), pairs) - 1.0).alias("effect_size_rank_biserial"),
            *[between_ends(k).alias(k) for k in ("group_1_median", "group_2_median") if medians],
        )
    )


def hypothesis_row(
    population: DataFrame,
    first: str,
    second: str,
    name: str,
    question: str,
    subject: str,
    alpha: float = ALPHA,
) -> DataFrame:
    """One fifteen-column result row: sizes, medians, U, p, effect, decision, conclusion."""
    test = _rank_test(population, first, second, medians=True)
    reject = F.col("p_value") < alpha  # NULL where a group has no rows: no decision then
    return test.select(
        F.lit(name).alias("hypothesis"),
        F.lit(question).alias("business_question"),
        F.lit("Mann-Whitney U").alias("test"),
        F.lit(first).alias("group_1"),
        "group_1_n",
        "group_1_median",
        F.lit(second).alias("group_2"),
        "group_2_n",
        "group_2_median",
        "test_statistic",
        "p_value",
        "effect_size_rank_biserial",
        F.lit(alpha).alias("alpha"),
        F.when(reject, "Reject H0").when(~reject, "Fail to reject H0").alias("decision"),
        F.when(reject, f"Significant evidence that {subject} differ.")
        .when(~reject, f"Insufficient evidence that {subject} differ.")
        .alias("conclusion"),
    )


def hypothesis_table(rows: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)
