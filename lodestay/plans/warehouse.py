"""Dimensions, facts, performance views and their reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.operators.enrichment import tolerant_select
from lodestay.operators.summaries import average, group_summary, known, row_count, surrogate_key, total

# Columns of the listing dimension and the names they get.
DIM_LISTING_COLUMNS = (
    "id", "name", "host_id", "host_name", "neighbourhood_group", "neighbourhood", "latitude", "longitude",
    "room_type", "detailed_property_type", "accommodates", "bathrooms", "bedrooms", "beds", "minimum_nights",
    "maximum_nights", "availability_365", "calculated_host_listings_count", "host_portfolio_size",
    "host_portfolio_segment", "host_is_superhost", "host_has_profile_pic", "host_identity_verified",
    "detailed_source_available", "price", "detailed_price", "price_best_available", "price_source",
    "price_per_bedroom", "price_per_guest", "review_scores_rating", "review_scores_cleanliness",
    "review_scores_location", "has_review_history", "calendar_data_available",
)
DIM_LISTING_RENAMES = {"id": "listing_id", "detailed_property_type": "property_type"}
PRICE = "price_best_available"


def dim_listings(master: DataFrame) -> DataFrame:
    return tolerant_select(master, DIM_LISTING_COLUMNS, DIM_LISTING_RENAMES)


def dim_neighbourhoods(master: DataFrame) -> DataFrame:
    """One row per area with a dense key in name order; rows without an area are left out."""
    groups = group_summary(
        master.select("neighbourhood", PRICE),
        ["neighbourhood"],
        {
            "listing_count": row_count(),
            "listings_with_price": known(PRICE),
            "avg_price_best_available": average(PRICE, 2),
        },
        {"median_price_best_available": (PRICE, 0.5, 2)},
        drop_null_groups=True,
    )
    keyed = surrogate_key(groups, "neighbourhood", "neighbourhood_key")
    return keyed.select("neighbourhood_key", *groups.columns)


# What the three performance views are grouped by, and the measures that not all of them have.
VIEW_GROUPS = {
    "vw_neighbourhood_performance": "neighbourhood",
    "vw_room_type_performance": "room_type",
    "vw_host_portfolio_performance": "host_portfolio_segment",
}
VIEW_EXTRAS = {
    "vw_neighbourhood_performance": ("total_review_events", "avg_reviews_per_listing", "avg_availability_rate"),
    "vw_room_type_performance": ("total_review_events",),
    "vw_host_portfolio_performance": ("avg_reviews_per_listing",),
}


def _performance(df: DataFrame, by: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """The measures the three performance views share, plus the ones asked for."""
    aggs = {
        "listing_count": row_count(),
        "listings_with_price": known(PRICE),
        "avg_price": average(PRICE, 2),
        "avg_review_score": average("review_scores_rating", 3),
        "total_review_events": total("detailed_review_count"),
        "avg_reviews_per_listing": average("detailed_review_count", 2),
        "avg_availability_rate": average("availability_rate_observed", 4),
        "avg_unavailability_rate_proxy": average("unavailability_rate_proxy", 4),
    }
    names = ["listing_count", "listings_with_price", "avg_price", "avg_review_score", *extra,
             "avg_unavailability_rate_proxy"]
    out = group_summary(
        df, by, {n: aggs[n] for n in names}, {"median_price": (PRICE, 0.5, 2)}, drop_null_groups=True
    )
    return out.select(*by, "listing_count", "listings_with_price", "avg_price", "median_price", *names[3:])


def _view(master: DataFrame, name: str) -> DataFrame:
    return _performance(master, [VIEW_GROUPS[name]], VIEW_EXTRAS[name])


def neighbourhood_performance(master: DataFrame) -> DataFrame:
    return _view(master, "vw_neighbourhood_performance")


def room_type_performance(master: DataFrame) -> DataFrame:
    return _view(master, "vw_room_type_performance")


def host_portfolio_performance(master: DataFrame) -> DataFrame:
    return _view(master, "vw_host_portfolio_performance")


VIEWS = {
    "vw_neighbourhood_performance": neighbourhood_performance,
    "vw_room_type_performance": room_type_performance,
    "vw_host_portfolio_performance": host_portfolio_performance,
}


def view_readouts(master: DataFrame) -> DataFrame:
    """The rows of all three views under their names; a column that a view lacks is NULL there.

    The master is made and read once: a listing counts in its group of each view.
    """
    places = F.array(*[
        F.struct(F.lit(name).alias("view_name"), F.col(group).alias("group")) for name, group in VIEW_GROUPS.items()
    ])
    extras = sorted({e for names in VIEW_EXTRAS.values() for e in names})
    dealt = master.select("*", F.explode(places).alias("__place")).select("*", "__place.view_name", "__place.group")
    out = _performance(dealt, ["view_name", "group"], VIEW_EXTRAS["vw_neighbourhood_performance"])

    def only(column: str, *names: str) -> Column:
        return F.when(F.col("view_name").isin(*names), F.col(column))

    groups = {group: only("group", name) for name, group in VIEW_GROUPS.items()}
    measures = {e: only(e, *[name for name, has in VIEW_EXTRAS.items() if e in has]) for e in extras}
    shown = ["view_name", "neighbourhood", *out.columns[2:], "room_type", "host_portfolio_segment"]
    return out.select(*[({**groups, **measures}.get(c, F.col(c))).alias(c) for c in shown])


def register_views(master: DataFrame) -> None:
    """The master and the three views as temporary views for SQL questions."""
    master.createOrReplaceTempView("enriched_listing_master")
    for name, build in VIEWS.items():
        build(master).createOrReplaceTempView(name)


# ---- reconciliation ----------------------------------------------------------

CHECK_COLUMNS = ("object_name", "metric", "value", "expected_value", "status", "notes")


class ReconciliationError(ValueError):
    """A warehouse object does not reconcile with its source."""


def key_probe(df: DataFrame, key: str, **totals) -> DataFrame:
    """One row: rows, distinct non-NULL keys, NULL keys, rows in repeated keys (NULLs left out), and sums of ``totals``."""
    groups = df.groupBy(F.col(key).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(name) for name, x in totals.items()])
    known = F.col("k").isNotNull()
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count("k").alias("distinct_count"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(known & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias("duplicate_key_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in totals],
    )


def _check(object_name: str, metric: str, value: Column, wanted: Column, notes: str) -> Column:
    value, wanted = value.cast("bigint"), wanted.cast("bigint")
    return F.struct(
        F.lit(object_name).alias("object_name"), F.lit(metric).alias("metric"), value.alias("value"),
        wanted.cast("string").alias("expected_value"),
        F.when(value == wanted, "PASS").otherwise("FAIL").alias("status"), F.lit(notes).alias("notes"),
    )


def _non_empty(object_name: str, rows: Column) -> Column:
    return F.struct(
        F.lit(object_name).alias("object_name"), F.lit("row_count").alias("metric"),
        F.least(rows, F.lit(1)).cast("bigint").alias("value"), F.lit("> 0").alias("expected_value"),
        F.when(rows > 0, "PASS").otherwise("FAIL").alias("status"),
        F.lit("A view must return at least one row.").alias("notes"),
    )


def _side_by_side(rows: dict[str, DataFrame]) -> DataFrame:
    """One row that holds each one-row table as a struct under its name."""
    return reduce(DataFrame.crossJoin, [df.select(F.struct("*").alias(name)) for name, df in rows.items()])


def equality_checks(object_name: str, actual: DataFrame, expected: DataFrame, checks: Sequence[tuple]) -> DataFrame:
    """Rows (object, metric, value, expected, status, notes) from two one-row tables.

    ``checks`` holds ``(metric, actual column, expected column or constant, notes)``.
    """
    cells = [
        _check(object_name, metric, F.col("a").getField(column),
               F.col("e").getField(wanted) if isinstance(wanted, str) else F.lit(wanted), notes)
        for metric, column, wanted, notes in checks
    ]
    return _side_by_side({"a": actual, "e": expected}).select(F.inline(F.array(*cells)))


def key_probes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: a struct as ``key_probe`` gives for each of ``keys``, and of the table's rows in all.

    The rows are read once: their keys, as text, are counted together as (number of the key, value).
    """
    cells = [F.struct(F.lit(i).alias("i"), F.col(k).cast("string").alias("k")) for i, k in enumerate(keys)]
    groups = df.select(F.inline(F.array(*cells))).groupBy("i", "k").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("k").isNotNull()

    def added(i: int, x: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("i") == i, x)), F.lit(0))

    return groups.agg(*[
        F.struct(
            added(i, F.col("n")).alias("row_count"),
            added(i, known.cast("bigint")).alias("distinct_count"),
            added(i, F.when(~known, F.col("n"))).alias("null_count"),
            added(i, F.when(known & (F.col("n") > 1), F.col("n"))).alias("duplicate_key_rows"),
        ).alias(k) for i, k in enumerate(keys)
    ])


def reconcile(
    master: DataFrame,
    review_fact: DataFrame,
    calendar_fact: DataFrame,
    canonical: DataFrame,
    review_source: DataFrame,
    calendar_source: DataFrame,
    key: str = "id",
    source_key: str = "listing_id",
    listing_dim: DataFrame | None = None,
    area_dim: DataFrame | None = None,
) -> DataFrame:
    """The seventeen checks; every expectation is computed from the sources, none is a constant.

    Each object is read once, for all that is asked of it. A dimension that is
    not handed in is the projection of the master that defines it, and counted
    with it. The views are grouped selections of the master, one row for each
    known value, so they hold a row exactly when the master holds such a value.
    """
    one = F.count(F.lit(1))
    groups = ("neighbourhood", "room_type", "host_portfolio_segment")
    rows = {
        "master": key_probes(master, [key, *groups]),
        "canonical": key_probes(canonical, [key, "neighbourhood"]),
        "reviews": review_source.agg(F.count_distinct(source_key).alias("keys"), one.alias("rows")),
        "calendar": calendar_source.agg(F.count_distinct(source_key).alias("keys"), one.alias("rows")),
        "review_fact": key_probe(review_fact, "listing_id", events="detailed_review_count"),
        "calendar_fact": key_probe(calendar_fact, "listing_id", days="calendar_days_observed",
                                   complete=F.col("calendar_complete_365_day_window").cast("bigint")),
    }
    ids, dim, areas = f"master.{key}", f"master.{key}", F.col("master.neighbourhood.distinct_count")
    if listing_dim is not None:
        rows["dim"], dim = key_probe(listing_dim, "listing_id"), "dim"
    if area_dim is not None:
        rows["areas"], areas = area_dim.agg(one.alias("rows")), F.col("areas.rows")
    listings, nothing = F.col(f"canonical.{key}.row_count"), F.lit(0)
    name, facts = "enriched_listing_master", ("fact_review_activity", "fact_calendar_activity")
    cells = [
        _check(name, "row_count", F.col(f"{ids}.row_count"), listings, "All canonical listings are kept."),
        _check(name, "unique_listing_ids", F.col(f"{ids}.distinct_count"), listings, "Every canonical id appears once."),
        _check(name, "null_listing_ids", F.col(f"{ids}.null_count"), nothing, "Ids are never null."),
        _check(name, "duplicate_listing_id_rows", F.col(f"{ids}.duplicate_key_rows"), nothing, "One row per listing."),
        _check("dim_listings", "row_count", F.col(f"{dim}.row_count"), listings, "Canonical grain."),
        _check("dim_listings", "unique_listing_ids", F.col(f"{dim}.distinct_count"), listings, "The key is unique."),
        _check("dim_neighbourhoods", "row_count", areas, F.col("canonical.neighbourhood.distinct_count"), "One row per area."),
        _check(facts[0], "row_count", F.col("review_fact.row_count"), F.col("reviews.keys"), "One row per reviewed listing."),
        _check(facts[0], "total_detailed_review_events", F.col("review_fact.events"), F.col("reviews.rows"),
               "All source rows are represented."),
        _check(facts[0], "duplicate_listing_id_rows", F.col("review_fact.duplicate_key_rows"), nothing, "One row per listing."),
        _check(facts[1], "row_count", F.col("calendar_fact.row_count"), F.col("calendar.keys"),
               "One row per listing with a calendar."),
        _check(facts[1], "total_calendar_rows_represented", F.col("calendar_fact.days"), F.col("calendar.rows"),
               "All source rows are represented."),
        _check(facts[1], "complete_365_day_windows", F.col("calendar_fact.complete"), F.col("calendar.keys"),
               "Every window is complete."),
        _check(facts[1], "duplicate_listing_id_rows", F.col("calendar_fact.duplicate_key_rows"), nothing,
               "One row per listing."),
    ]
    cells += [_non_empty(view, F.col(f"master.{group}.distinct_count")) for view, group in zip(VIEWS, groups)]
    return _side_by_side(rows).select(F.inline(F.array(*cells)))


def require_reconciled(report: DataFrame) -> None:
    bad = report.where(F.col("status") == "FAIL").orderBy("object_name", "metric").limit(10).collect()
    if bad:
        raise ReconciliationError("; ".join(f"{r.object_name}.{r.metric}: {r.value}, expected {r.expected_value}" for r in bad))
