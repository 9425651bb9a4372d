"""One city's full run: read, validate, gate, clean, enrich, publish.

Stages hand over through Parquet under ``out``, so a lost executor or a failed
later stage never repeats an earlier one. Rows, fractions, the audit of cleaning
and the metrics of enrichment are counted while the stages write; no table is
read again for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.operators import cleaning, enrichment, profiling, rollups, rules
from lodestay.operators.observed import Tally, write_observed
from lodestay.plans import rulebook, warehouse
from lodestay.sources import catalog as C
from lodestay.sources import schemas


def detail_attributes(cleaned_detail: DataFrame) -> DataFrame:
    """The detailed attributes that go into the master, with their source flag."""
    out = enrichment.tolerant_select(cleaned_detail, schemas.DETAIL_ATTRIBUTES, schemas.DETAIL_RENAMES)
    return out.withColumn("detailed_source_available", F.lit(True))


LISTING_TABLES = {"summary_listings": schemas.SUMMARY_POLICY, "detailed_listings": schemas.DETAILED_POLICY}


class ProfileError(RuntimeError):
    """Some datasets could not be read or profiled."""


def profile_sources(sources: C.Catalog, out: str) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """Land and profile every dataset; returns the tables and what was counted while the listing tables landed.

    A dataset that fails keeps its line in the summary, with the error, and
    the others are profiled all the same; the failures are raised after both
    reports are written.
    """
    raw, figures, profiles, summaries, failed = {}, {}, [], [], []
    for name, dataset in sources.datasets.items():
        policy = LISTING_TABLES.get(name)
        try:
            if policy:  # gzip and multi-line text are read once, by one task per file, then land as Parquet
                raw[name], figures[name] = sources.land_observed(
                    name, f"{out}/landed/{name}", lambda df: cleaning.fraction_tally(df, policy))
            else:
                raw[name] = sources.land(name, f"{out}/landed/{name}") if dataset.kind == "csv" else sources.load(name)
            samples = profiling.joined_samples(profiling.sample_values(raw[name], raw[name].columns))
            columns = profiling.column_profile(raw[name], name).join(samples, "column_name", "left")
            table = profiling.table_profile(raw[name], name, dataset.file_name, dataset.kind, exact=False)
            C.write_parquet(columns, f"{out}/profiles/columns/{name}")
            C.write_parquet(table.crossJoin(sources.file_size(name)), f"{out}/profiles/tables/{name}")  # one row each
            profiles.append(sources.spark.read.parquet(f"{out}/profiles/columns/{name}"))
            summaries.append(sources.spark.read.parquet(f"{out}/profiles/tables/{name}"))
        except Exception as error:
            failed.append(dataset.file_name)
            summaries.append(profiling.failed_table_profile(
                sources.spark, name, dataset.file_name, dataset.kind, str(error)
            ).withColumn("file_size_bytes", F.lit(None).cast("bigint")))
    if profiles:
        C.write_report(rules.combine(profiles), f"{out}/reports/column_profile")
    C.write_report(rules.combine(summaries), f"{out}/reports/dataset_summary")
    if failed:
        raise ProfileError(f"failed to profile: {', '.join(failed)}; see {out}/reports/dataset_summary")
    return raw, figures


def refresh(spark: SparkSession, root: str, city: str, out: str, database: str | None = None) -> DataFrame:
    """Run every stage; reports go to ``out/reports``. Returns the enriched master.

    With ``database`` the dimensions and facts are also published as its tables.
    """
    sources = C.Catalog(spark, root, city)
    raw, figures = profile_sources(sources, out)

    C.write_parquet(rulebook.full_report(raw), f"{out}/validation")
    report = spark.read.parquet(f"{out}/validation")
    C.write_report(rules.ordered_report(report), f"{out}/reports/validation_results")
    rules.gate(report)

    audits, rows = [], {}
    for name, policy in LISTING_TABLES.items():
        # the fractional columns are known since the table landed; the audit is counted while the table is written
        known = cleaning.with_fractions(raw[name], policy, figures[name])
        audit, rows[name] = cleaning.write_cleaned(
            raw[name], known, sources.dataset(name).file_name, f"{out}/cleaned/{name}")
        cleaning.require_grain(spark.read.parquet(f"{out}/cleaned/{name}"), name, policy.key, figures[name]["rows"])
        audits.append(audit)
    C.write_report(rules.combine(audits), f"{out}/reports/cleaning_summary")

    reviews = raw["detailed_reviews"].withColumn("listing_id", F.col("listing_id").try_cast("bigint"))
    calendar = raw["calendar"].withColumn("listing_id", F.col("listing_id").try_cast("bigint"))
    canonical = spark.read.parquet(f"{out}/cleaned/summary_listings")
    detail = detail_attributes(spark.read.parquet(f"{out}/cleaned/detailed_listings"))

    def written(df: DataFrame, folder: str, tally: Tally) -> DataFrame:
        metrics.update(write_observed(df, f"{out}/{folder}", tally))
        return spark.read.parquet(f"{out}/{folder}")

    metrics = {"detailed_listing_rows": rows["detailed_listings"], "canonical_input_rows": rows["summary_listings"],
               "detailed_listing_selected_columns": len(detail.columns)}
    tallies = enrichment.metric_tallies(len(detail.columns), 0)
    review_fact = written(rollups.event_rollup(reviews), "review_listing_aggregates", tallies["reviews"])
    calendar_fact = written(
        rollups.calendar_rollup(rollups.normalised_calendar(calendar)), "calendar_listing_aggregates", tallies["calendar"])
    enrichment.require_sides(canonical, detail, review_fact, calendar_fact)
    built = enrichment.build_master(canonical, detail, review_fact, calendar_fact)
    tallies = enrichment.metric_tallies(len(detail.columns), len(built.columns))
    master = written(built, "enriched_listing_master", tallies["master"])
    cleaning.require_grain(master, "saved listing master", "id", rows["summary_listings"])
    C.write_report(enrichment.observed_metrics(spark, metrics), f"{out}/reports/enrichment_summary")

    C.write_parquet(warehouse.dim_listings(master), f"{out}/dim_listings")
    C.write_parquet(warehouse.dim_neighbourhoods(master), f"{out}/dim_neighbourhoods")
    if database:
        for name in ("enriched_listing_master", "dim_listings", "dim_neighbourhoods", "review_listing_aggregates",
                     "calendar_listing_aggregates"):
            C.replace_table(spark.read.parquet(f"{out}/{name}"), f"{database}.{name}")
    warehouse.register_views(master)
    checks = warehouse.reconcile(
        master, review_fact, calendar_fact, canonical, reviews, calendar,
        listing_dim=spark.read.parquet(f"{out}/dim_listings"), area_dim=spark.read.parquet(f"{out}/dim_neighbourhoods"))
    C.write_report(checks, f"{out}/reports/warehouse_summary")
    warehouse.require_reconciled(checks)
    return master
