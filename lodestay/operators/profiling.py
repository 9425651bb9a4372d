"""Table and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.functions import parse
from lodestay.functions.numeric import percentage, rounded
from lodestay.operators.duplicates import duplicate_rows_exact, duplicate_rows_hashed
from lodestay.operators.summaries import average, greatest, group_summary, known, least, rows_where

# Free-text columns whose exact distinct count is skipped, with a note.
FREE_TEXT = frozenset({"comments"})
SKIPPED_NOTE = "Exact distinct count skipped for a free-text column."

_ORDERED = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def has_range(data_type: T.DataType) -> bool:
    """Minimum and maximum are reported for numbers and dates only."""
    return isinstance(data_type, _ORDERED)


def table_profile(
    df: DataFrame, dataset: str, file_name: str = "", file_type: str = "parquet", exact: bool = True
) -> DataFrame:
    """One row: rows, columns, duplicate rows and how they were found."""
    dup = duplicate_rows_exact(df) if exact else duplicate_rows_hashed(df)
    return dup.select(
        F.lit(dataset).alias("dataset_name"),
        F.lit(file_name).alias("file_name"),
        F.lit(file_type).alias("file_type"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        "duplicate_count",
        "duplicate_percentage",
        F.lit("exact_rows" if exact else "full_row_hash").alias("duplicate_method"),
        F.lit("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


def failed_table_profile(
    spark: SparkSession, dataset: str, file_name: str, file_type: str, error: str,
) -> DataFrame:
    """The row of ``table_profile`` for a dataset that could not be read or profiled."""
    shape = table_profile(spark.range(0), dataset, file_name, file_type).schema
    known = {"dataset_name": dataset, "file_name": file_name, "file_type": file_type, "status": "FAILED", "error_message": error}
    kept = T.StructType([T.StructField(f.name, f.dataType, True) for f in shape])
    return spark.createDataFrame([tuple(known.get(f.name) for f in shape)], kept)


# How values with a range travel beside those of other columns, and back: whole numbers, days and instants as longs,
# floating point as doubles, decimals as the widest decimals. Types without a range have none.
_CARRIED = (
    (T.IntegralType, "long", lambda c, t: F.col(c).cast("bigint"), lambda x, t: x.cast(t)),
    (T.DateType, "long", lambda c, t: F.unix_date(c).cast("bigint"), lambda x, t: F.date_from_unix_date(x.cast("int"))),
    (T.TimestampType, "long", lambda c, t: F.unix_micros(c), lambda x, t: F.timestamp_micros(x)),
    (T.TimestampNTZType, "long", lambda c, t: F.unix_micros(F.to_utc_timestamp(F.col(c).cast("timestamp"), "UTC")),
     lambda x, t: F.timestamp_micros(x).cast(t)),
    (T.FractionalType, "double", lambda c, t: F.col(c).cast("double"), lambda x, t: x.cast(t)),
)


def _carried(t: T.DataType):
    if isinstance(t, T.DecimalType):
        wide = f"decimal(38,{t.scale})"
        return wide, lambda c, _: F.col(c).cast(wide), lambda x, _: x.cast(t)
    for kind, slot, there, back in _CARRIED:
        if isinstance(t, kind):
            return slot, there, back
    return None


def column_profile(
    df: DataFrame,
    dataset: str,
    columns: Sequence[str] | None = None,
    skip_distinct: Sequence[str] = tuple(FREE_TEXT),
    approximate: bool = False,
) -> DataFrame:
    """One row per column: type, missing, distinct, minimum, maximum, note.

    One scan, however many columns: each row gives a (column, 128-bit hash of
    the value) pair per column, combined map-side to the distinct ones, and
    every figure comes from those. ``approximate`` takes a sketch per column
    instead, also in one scan.
    """
    fields = {f.name: f for f in df.schema.fields}
    wanted = list(columns or df.columns)
    skipped = {c.lower() for c in skip_distinct}
    row = (_sketched if approximate else _counted)(df, wanted, fields, skipped)
    cells = []
    for i, c in enumerate(wanted):
        counted, kind = c.lower() not in skipped, fields[c].dataType
        none = F.lit(None).cast("string")
        missing = F.col("rows") - F.col(f"n{i}")
        cells.append(F.struct(
            F.lit(dataset).alias("dataset_name"),
            F.lit(c).alias("column_name"),
            F.lit(kind.simpleString()).alias("data_type"),
            missing.alias("missing_count"),
            percentage(missing, F.col("rows"), 4).alias("missing_percentage"),
            (F.col(f"u{i}") if counted else F.lit(None).cast("bigint")).alias("unique_count"),
            (F.col(f"lo{i}") if has_range(kind) else none).alias("minimum"),
            (F.col(f"hi{i}") if has_range(kind) else none).alias("maximum"),
            (none if counted else F.lit(SKIPPED_NOTE)).alias("profile_note"),
            F.col("rows").alias("row_count"),
        ))
    return row.select(F.inline(F.array(*cells)))


def _sketched(df: DataFrame, wanted: Sequence[str], fields: dict, skipped: set) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(wanted):
        aggs += [F.count(c).alias(f"n{i}"), F.approx_count_distinct(c).alias(f"u{i}")]
        if has_range(fields[c].dataType):
            aggs += [F.min(c).cast("string").alias(f"lo{i}"), F.max(c).cast("string").alias(f"hi{i}")]
    return df.agg(*aggs)


def _counted(df: DataFrame, wanted: Sequence[str], fields: dict, skipped: set) -> DataFrame:
    """One row: rows, and of column i the values n, the distinct ones u, and lo and hi as text."""
    carried = {c: _carried(fields[c].dataType) for c in wanted if has_range(fields[c].dataType)}
    slots = sorted({slot for slot, _, _ in carried.values()})
    pairs = []
    for i, c in enumerate(wanted):
        # a missing value has no hash; a column that is not counted has one for all values
        first = F.lit(0).cast("bigint") if c.lower() in skipped else F.xxhash64(c)
        second = F.lit(0).cast("bigint") if c.lower() in skipped else F.xxhash64(F.lit("second"), c)
        here = F.col(c).isNotNull()
        parts = [F.lit(i).alias("c"), F.when(here, first).alias("a"), F.when(here, second).alias("b")]
        for k, slot in enumerate(slots):
            mine = c in carried and carried[c][0] == slot
            parts.append((carried[c][1](c, None) if mine else F.lit(None)).cast(slot).alias(f"x{k}"))
        pairs.append(F.struct(*parts))
    ends = [f(f"x{k}").alias(f"{name}{k}") for k in range(len(slots)) for name, f in (("l", F.min), ("h", F.max))]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")
    distinct = long.groupBy("c", "a", "b").agg(F.count(F.lit(1)).alias("n"), *ends)
    each = distinct.groupBy("c").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("a").isNotNull(), F.col("n")).otherwise(0)).alias("n"),
        F.count("a").alias("u"), *[f(f"{name}{k}").alias(f"{name}{k}") for k in range(len(slots)) for name, f in (("l", F.min), ("h", F.max))])
    # one row for each column: a row of all figures, zeros for an empty table
    aggs = [F.coalesce(F.max("rows"), F.lit(0)).alias("rows")]
    for i, c in enumerate(wanted):
        def own(name: str, i=i) -> Column:
            return F.max(F.when(F.col("c") == i, F.col(name)))

        aggs += [F.coalesce(own("n"), F.lit(0)).alias(f"n{i}"), F.coalesce(own("u"), F.lit(0)).alias(f"u{i}")]
        if c in carried:
            slot, _, back = carried[c]
            k = slots.index(slot)
            aggs += [back(own(f"{end}{k}"), fields[c].dataType).cast("string").alias(f"{name}{i}") for end, name in (("l", "lo"), ("h", "hi"))]
    return each.agg(*aggs)


def sample_values(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    """The ``n`` smallest distinct non-NULL values of every column, as one line each.

    The k-th value is the minimum above the (k-1)-th: ``n`` scans that each
    reduce to one row, and no value is shuffled, however long or repeated.
    """
    texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])
    row = texts.agg(*[F.min(f"c{i}").alias(f"v{i}_1") for i in range(len(columns))])
    for k in range(2, n + 1):
        above = [
            F.min(F.when(F.col(f"c{i}") > F.col(f"v{i}_{k - 1}"), F.col(f"c{i}"))).alias(f"v{i}_{k}")
            for i in range(len(columns))
        ]
        row = texts.crossJoin(F.broadcast(row)).agg(*[F.max(c).alias(c) for c in row.columns], *above)  # one row
    cells = [
        F.struct(
            F.lit(c).alias("column_name"), F.lit(k).alias("rank"), parse.one_line(f"v{i}_{k}").alias("sample_value")
        )
        for i, c in enumerate(columns) for k in range(1, n + 1)
    ]
    return row.select(F.inline(F.array(*cells))).where(F.col("sample_value").isNotNull())


def joined_samples(samples: DataFrame, n: int = 3) -> DataFrame:
    """The samples of each column on one line, separated by `` | ``."""
    picks = [F.max(F.when(F.col("rank") == i, F.col("sample_value"))) for i in range(1, n + 1)]
    return samples.groupBy("column_name").agg(F.concat_ws(" | ", *picks).alias("sample_values"))


def candidate_keys(profile: DataFrame) -> DataFrame:
    """Columns of a column profile that identify a row: no NULL, all distinct."""
    good = (F.col("missing_count") == 0) & (F.col("unique_count") == F.col("row_count"))
    return profile.select("column_name", "row_count", "unique_count", "missing_count", good.alias("is_candidate_key"))


def property_profile(df: DataFrame, json_column: str) -> DataFrame:
    """Union of the property names of a JSON text column: rows having it, distinct values."""
    total = df.agg(F.count(F.lit(1)).alias("rows"))
    props = df.select(F.from_json(json_column, "map<string,string>").alias("m"))
    pairs = props.select(F.explode("m").alias("property_name", "value"))
    stats = pairs.groupBy("property_name").agg(
        F.count("value").alias("present_count"), F.count_distinct("value").alias("unique_count")
    )
    joined = stats.crossJoin(F.broadcast(total))  # one row
    missing = F.col("rows") - F.col("present_count")
    return joined.select(
        "property_name",
        missing.alias("missing_count"),
        percentage(missing, F.col("rows"), 4).alias("missing_percentage"),
        "unique_count",
    )


def canonical_json_duplicates(df: DataFrame, json_column: str) -> DataFrame:
    """Extra copies of records that are equal whatever the order of their properties, at every depth.

    A VARIANT keeps the keys of each of its objects in order, so its text is
    the same for records that differ in key order, white space or number
    spelling only. Text that is no JSON is compared as it is.
    """
    parsed = F.to_json(F.try_parse_json(F.col(json_column).cast("string")))
    kind = F.when(parsed.isNull(), "text").otherwise("json")
    record = F.coalesce(parsed, F.col(json_column).cast("string"))
    return duplicate_rows_hashed(df.select(kind.alias("kind"), record.alias("record")))


def date_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text date column: non-NULL, unparseable, earliest, latest."""
    aggs = []
    for i, c in enumerate(columns):
        d = parse.date(c)
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.count_if(F.col(c).isNotNull() & d.isNull()).alias(f"bad{i}"),
            F.min(d).alias(f"lo{i}"),
            F.max(d).alias(f"hi{i}"),
        ]
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("non_null_count"),
            F.col(f"bad{i}").alias("invalid_count"),
            F.col(f"lo{i}").alias("earliest"),
            F.col(f"hi{i}").alias("latest"),
        )
        for i, c in enumerate(columns)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def numeric_range_report(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Per numeric column: missing, distinct, minimum, maximum, average, exact median.

    The columns are unpivoted to (column, value) so that one pass and one
    distributed quantile serve them all.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.column_name", "p.value")
    return group_summary(
        long,
        ["column_name"],
        {
            "missing_count": F.count_if(F.col("value").isNull()),
            "distinct_count": F.count_distinct("value"),
            "minimum": F.min("value"),
            "maximum": F.max("value"),
            "average": rounded(F.avg("value"), digits),
        },
        {"median": ("value", 0.5, digits)},
    )


def text_length_report(df: DataFrame, text: str, digits: int = 2) -> DataFrame:
    """One row: non-NULL texts with minimum, maximum, median and average length, and blank texts."""
    lengths = df.select(F.length(text).cast("bigint").alias("len"), blank_but_present(text).alias("blank"))
    return group_summary(
        lengths,
        [],
        {
            "text_count": known("len"), "min_length": least("len"), "max_length": greatest("len"),
            "avg_length": average("len", digits), "blank_count": rows_where(F.col("blank")),
        },
        {"median_length": ("len", 0.5, digits)},
    )


def blank_but_present(c: str) -> Column:
    """Not NULL, yet nothing but spaces."""
    return F.col(c).isNotNull() & (F.trim(F.col(c)) == "")
