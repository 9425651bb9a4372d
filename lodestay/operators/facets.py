"""Faceted exploration: one filter, and the tables shown for the filtered rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.operators.summaries import at_or_below_quantile, group_summary, histogram, top_rows

CAPACITY_CEILING = 16  # fixed value: the capacity slider ends here


@dataclass(frozen=True)
class FacetSpec:
    """Selections. An empty list means all; a range with None is inactive.

    ``flags`` are selected by their Yes / No / Missing label. An active range
    is inclusive and drops rows without a value.
    """

    choices: Mapping[str, Sequence[str]] = field(default_factory=dict)
    flags: Mapping[str, Sequence[str]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)


def facet_condition(df: DataFrame, spec: FacetSpec) -> Column:
    """The selections as one predicate, over the columns that exist.

    Text and boolean facets compare the bare column, so they reach the scan.
    """
    condition = F.lit(True)
    types = dict(df.dtypes)
    for c, values in spec.choices.items():
        if values and c in types:
            shown = F.col(c) if types[c] == "string" else F.col(c).cast("string")
            condition = condition & shown.isin(*values)
    for c, labels in spec.flags.items():
        if labels and c in types:
            condition = condition & _flag_is(c, types[c], labels)
    for c, (low, high) in spec.ranges.items():
        if low is not None and high is not None and c in types:
            condition = condition & F.col(c).between(low, high)
    return condition


def _flag_is(c: str, data_type: str, labels: Sequence[str]) -> Column:
    if data_type != "boolean":
        return parse.yes_no_label(c).isin(*labels)
    wanted = {"Yes": F.col(c), "No": ~F.col(c), "Missing": F.col(c).isNull()}
    return reduce(lambda a, b: a | b, [wanted[x] for x in labels if x in wanted], F.lit(False))


def facet_filter(df: DataFrame, spec: FacetSpec) -> DataFrame:
    return df.where(facet_condition(df, spec))


def facet_options(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL values of every facet column as text, in one scan."""
    pairs = [F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("option"))
             for c in columns if c in df.columns]
    options = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.facet", "p.option")
    return options.where(F.col("option").isNotNull()).distinct().orderBy("facet", "option")


def flag_options(df: DataFrame, column: str) -> DataFrame:
    """Labels a flag facet offers, Missing included."""
    return df.select(parse.yes_no_label(column).alias("option")).distinct().orderBy("option")


def observed_ranges(df: DataFrame, price: str, capacity: str) -> DataFrame:
    """One row: slider ends over positive values; the capacity end is capped for display."""
    p, c = F.col(price), F.col(capacity)
    return df.agg(
        F.min(F.when(p > 0, p)).alias("minimum_price"),
        F.max(F.when(p > 0, p)).alias("maximum_price"),
        F.min(F.when(c > 0, c)).cast("bigint").alias("minimum_capacity"),
        F.least(F.max(F.when(c > 0, c)), F.lit(CAPACITY_CEILING)).cast("bigint").alias("maximum_capacity"),
    )


def active_range(selected: tuple[float, float], full: tuple[float, float]) -> tuple[float | None, float | None]:
    """A slider left at its full range filters nothing."""
    return (None, None) if tuple(selected) == tuple(full) else tuple(selected)


def positive(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.where(F.col(c) > 0)
    return df


def overview(df: DataFrame, key: str, price: str, group: str) -> DataFrame:
    """One row: distinct listings, those with a positive price, median positive price, groups."""
    valid = F.when(F.col(price) > 0, F.col(price))
    return group_summary(
        df.select(key, group, valid.alias("valid_price")),
        [],
        {
            "total_listings": F.count_distinct(key),
            "valid_price_listings": F.count_distinct(F.when(F.col("valid_price").isNotNull(), F.col(key))),
            "neighbourhood_count": F.count_distinct(group),
        },
        {"median_price": ("valid_price", 0.5, None)},
    )


def secondary_overview(df: DataFrame, events: str, proxy: str, capacity: str, flag: str) -> DataFrame:
    """One row: total events (NULL if there are none to add), median proxy and capacity, flagged listings."""
    return group_summary(
        df,
        [],
        {
            "total_review_events": F.sum(events).cast("bigint"),
            "superhost_count": F.count_if(parse.yes_no_label(flag) == "Yes"),
        },
        {"median_unavailability": (proxy, 0.5, None), "median_accommodates": (capacity, 0.5, None)},
    )


def top_groups_by_count(df: DataFrame, group: str, key: str, n: int = 15) -> DataFrame:
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(key).alias("listing_count"))
    return top_rows(counts, [F.desc("listing_count"), F.asc(group)], n)


def top_groups_by_total(df: DataFrame, group: str, measure: str, n: int = 15, name: str = "total") -> DataFrame:
    sums = df.where(F.col(group).isNotNull() & F.col(measure).isNotNull()).groupBy(group).agg(F.sum(measure).alias(name))
    return top_rows(sums, [F.desc(name), F.asc(group)], n)


def medians_by_group(df: DataFrame, group: str, measure: str, key: str, name: str = "median_value") -> DataFrame:
    """Median and distinct listings per group over rows that have both."""
    usable = df.where(F.col(group).isNotNull() & F.col(measure).isNotNull()).select(group, measure, key)
    return group_summary(
        usable, [group], {"listing_count": F.count_distinct(key)}, {name: (measure, 0.5, None)}
    )


def top_groups_by_median(
    df: DataFrame, group: str, measure: str, key: str, n: int = 15, minimum: int = 20, name: str = "median_value"
) -> DataFrame:
    """Highest medians among groups with at least ``minimum`` listings."""
    supported = medians_by_group(df, group, measure, key, name).where(F.col("listing_count") >= minimum)
    return top_rows(supported, [F.desc(name), F.asc(group)], n)


def limited_histogram(df: DataFrame, measure: str, p: float | None = 0.99, bins: int = 50) -> DataFrame:
    """Histogram of the positive values, cut at a quantile for display only."""
    rows = positive(df.select(measure), measure)
    return histogram(rows if p is None else at_or_below_quantile(rows, measure, p), measure, bins)
