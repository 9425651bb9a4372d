"""Repeated rows, repeated keys and repeated text.

All of it is ``groupBy`` counting with map-side combine, so a key or text that
makes up a large part of the table is reduced before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.functions.numeric import percentage, row_fingerprint


def duplicate_rows_exact(df: DataFrame) -> DataFrame:
    """One row: all rows, and extra copies of whole rows (NULLs are equal)."""
    return _extra(df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n")))


def duplicate_rows_hashed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """As ``duplicate_rows_exact``, grouping on a 128-bit row identity (wide or long rows)."""
    key = row_fingerprint(columns or df.columns)
    return _extra(df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")))


def _extra(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"),
    ).withColumn("duplicate_percentage", percentage("duplicate_count", "row_count", 4))


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key values repeat, rows inside them, extra rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    many = F.col("n") > 1
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_if(many).alias("duplicate_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n"))), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("extra_rows"),
    ).withColumn("extra_percentage", percentage("extra_rows", "row_count", 4))


def top_duplicate_groups(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most repeated key values; the key breaks ties."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    return groups.orderBy(F.desc("row_count"), *[F.asc_nulls_last(k) for k in keys]).limit(n)


def _by_text(df: DataFrame, text: str) -> DataFrame:
    """Group identity of a long text: a 128-bit hash of all of it, so that the shuffle
    and the distinct counting never carry the text."""
    return df.where(F.col(text).isNotNull()).withColumn("__text", row_fingerprint([text]))


def repeated_text_summary(df: DataFrame, text: str) -> DataFrame:
    """One row: distinct texts occurring more than once, and the extra copies."""
    groups = _by_text(df, text).groupBy("__text").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return groups.agg(
        F.count(F.lit(1)).alias("repeated_texts"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_repeats"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
    )


def top_repeated_texts(
    df: DataFrame, text: str, distinct: dict[str, str], n: int = 20, preview: int = 120
) -> DataFrame:
    """The ``n`` most repeated texts with a preview and distinct counts of other columns.

    Grouping is on the whole text; only the shown preview is cut.
    """
    rows = _by_text(df, text).select(
        "__text",
        F.substring(text, 1, preview).alias("preview"),
        F.length(text).alias("text_length"),
        *sorted(set(distinct.values())),
    )
    groups = rows.groupBy("__text").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("preview").alias("preview"),
        F.min("text_length").cast("bigint").alias("text_length"),
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()],
    )
    return (
        groups.where(F.col("row_count") > 1)
        .orderBy(F.desc("row_count"), F.asc("preview"), F.asc("text_length"), F.asc("__text"))
        .limit(n)
        .drop("__text")
    )
