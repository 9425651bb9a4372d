"""Datasets by logical name, and the readers and sinks around them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.operators.observed import Tally, write_observed
from lodestay.sources import schemas


@dataclass(frozen=True)
class Dataset:
    name: str
    file_name: str
    kind: str  # csv, geojson or parquet
    description: str = ""
    # listing tables spell "no value" in many ways; fact tables leave it empty
    missing_tokens: bool = False
    # values may hold quoted line breaks; such a file cannot be split between tasks
    multi_line: bool = True


# Logical dataset names and the files behind them.
LISTING_MARKET = (
    Dataset("detailed_listings", "listings.csv.gz", "csv", "Listing attributes, one row per listing", True),
    Dataset("summary_listings", "listings.csv", "csv", "Canonical listing population", True),
    Dataset("calendar", "calendar.csv.gz", "csv", "One row per listing and day", multi_line=False),
    Dataset("detailed_reviews", "reviews.csv.gz", "csv", "One row per review"),
    Dataset("summary_reviews", "reviews.csv", "csv", "Listing and date of every review", True, multi_line=False),
    Dataset("neighbourhoods", "neighbourhoods.csv", "csv", "Area names", True, multi_line=False),
    Dataset("neighbourhoods_geojson", "neighbourhoods.geojson", "geojson", "Area boundaries"),
)


class Catalog:
    """Logical name -> DataFrame below ``root/<city>``."""

    def __init__(self, spark: SparkSession, root: str, city: str, datasets: Sequence[Dataset] = LISTING_MARKET):
        self.spark = spark
        self.base = f"{root.rstrip('/')}/{city.strip().lower()}"
        self.datasets = {d.name: d for d in datasets}

    def dataset(self, name: str) -> Dataset:
        try:
            return self.datasets[name]
        except KeyError:
            raise KeyError(f"unknown dataset '{name}'; known: {', '.join(sorted(self.datasets))}") from None

    def path(self, name: str) -> str:
        return f"{self.base}/{self.dataset(name).file_name}"

    def load(self, name: str, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
        d = self.dataset(name)
        if d.kind == "csv":
            df = read_csv(self.spark, self.path(name), d.missing_tokens, d.multi_line)
        elif d.kind == "geojson":
            df = read_areas(self.spark, self.path(name))
        else:
            df = self.spark.read.parquet(self.path(name))
        if columns is not None:
            df = df.select(*columns)
        return df if limit is None else df.limit(limit)

    def file_size(self, name: str) -> DataFrame:
        """One row: bytes of the dataset's files, as the scan itself reports them."""
        files = self.spark.read.format("binaryFile").load(self.path(name)).select("path", "length")
        return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("file_size_bytes"))

    def land(self, name: str, target: str) -> DataFrame:
        """Write a source once as Parquet and read it back.

        A gzip or multi-line file is one task however large, so its rows are
        rebalanced into even partitions before they are written, and every
        later job starts from splittable files.
        """
        return self.land_observed(name, target, lambda df: Tally({"rows": F.count(F.lit(1))}))[0]

    def land_observed(self, name: str, target: str, tally: Callable[[DataFrame], Tally]) -> tuple[DataFrame, dict]:
        """``land``, and the figures of the source's tally, counted while its rows are written."""
        df = self.load(name)
        figures = write_observed(df.hint("rebalance"), target, tally(df))
        return self.spark.read.parquet(target), figures


def read_csv(spark: SparkSession, path: str, missing_tokens: bool = False, multi_line: bool = True) -> DataFrame:
    """Delimited text with a header, every column as text; with ``multi_line`` quoted line breaks are part of a value.

    Columns are found by name, so an added or moved column does no harm; the
    only inference is reading the header line.
    """
    df = spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"', inferSchema=False).csv(path)
    if missing_tokens:
        df = df.select(*[parse.missing_token_to_null(c).alias(c) for c in df.columns])
    return df


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """A feature collection: one row per feature, properties as columns, geometry type and presence.

    The property columns are the union of the names found (area files are small).
    """
    features = (
        spark.read.schema(schemas.AREA_COLLECTION_SCHEMA)
        .option("multiLine", True)
        .json(path)
        .select(F.explode("features").alias("f"))
    )
    names = [
        r.k for r in features.select(F.explode(F.map_keys("f.properties")).alias("k")).distinct().orderBy("k").collect()
    ]
    return features.select(
        *[F.col("f.properties").getItem(n).alias(n) for n in names],
        F.col("f.geometry.type").alias("geometry_type"),
        (F.col("f.geometry").isNotNull()).alias("has_geometry"),
        F.to_json("f").alias("feature_json"),
    )


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report as one CSV file. For report-sized results only."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


class PublishError(RuntimeError):
    """A table was not published; the one before it is as it was."""


def replace_table(df: DataFrame, table: str, check: Callable[[DataFrame], None] | None = None) -> None:
    """Publish ``df`` as ``table``: write a staging table, look at it, then swap the names.

    Overwriting a table drops the old rows first, so that a job that fails half
    way leaves nothing. Here the old table is there until the new one is whole
    and ``check`` has seen it; only then are names changed, and if the second
    change fails the first is taken back. A staging table of a failed run is dropped.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    fresh, old = f"{table}__new_{tag}", f"{table}__old_{tag}"
    try:
        df.write.mode("errorifexists").saveAsTable(fresh)
        if check:
            check(spark.table(fresh))
    except Exception as failed:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise PublishError(f"{table} was not published") from failed
    had = spark.catalog.tableExists(table)
    if had:
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception as failed:
        if had:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise PublishError(f"{table} was not published") from failed
    if had:
        spark.sql(f"DROP TABLE {old}")


def replace_view(df: DataFrame, view: str) -> None:
    df.createOrReplaceTempView(view)


def run_sql(spark: SparkSession, query: str, parameters: Sequence | dict | None = None) -> DataFrame:
    """A SQL question with bound parameters (``?`` or ``:name``); lazy like any DataFrame."""
    if not query or not query.strip():
        raise ValueError("the SQL query must not be empty")
    return spark.sql(query, args=parameters) if parameters else spark.sql(query)
