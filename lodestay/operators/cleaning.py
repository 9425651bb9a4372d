"""Column-policy cleaning with an audit of what it changed.

A policy names columns by role; roles are intersected with the columns that
exist. Cleaning is one projection; the audit is one aggregate over the input,
observed while the cleaned table is written or in a scan of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestay.functions import parse
from lodestay.operators.observed import Tally, figures_row, write_observed


@dataclass(frozen=True)
class ColumnPolicy:
    """Which columns play which role in a table."""

    key: str
    price: str | None = None
    dates: Sequence[str] = ()
    categories: Sequence[str] = ()
    booleans: Sequence[str] = ()
    percents: Sequence[str] = ()
    integers: Sequence[str] = ()
    floats: Sequence[str] = ()
    # integer-role columns stored as doubles; None: decided from the data (see ``fractional_columns``)
    fractional: frozenset | None = None

    def present(self, role: str, df: DataFrame) -> list[str]:
        return sorted(c for c in getattr(self, role) if c in df.columns)


def _text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _start(df: DataFrame, c: str) -> Column:
    """The value after blanks have become NULL."""
    return parse.blank_to_null(c) if c in _text_columns(df) else F.col(c)


def fraction_tally(df: DataFrame, policy: ColumnPolicy) -> Tally:
    """Rows, and for each integer-role column its numbers and the fractions among them."""
    names = policy.present("integers", df)
    figures = {"rows": F.count(F.lit(1))}
    for i in range(len(names)):
        x = F.col(f"__x{i}")
        figures |= {f"numbers{i}": F.count(x), f"fractions{i}": F.count_if(x != F.floor(x))}
    return Tally(figures, {f"__x{i}": parse.number(c) for i, c in enumerate(names)})  # each parsed once


def with_fractions(df: DataFrame, policy: ColumnPolicy, figures: Mapping) -> ColumnPolicy:
    """``policy`` with the fractional columns that the figures of ``fraction_tally`` show."""
    names = policy.present("integers", df)
    return replace(policy, fractional=frozenset(
        c for i, c in enumerate(names) if not figures[f"numbers{i}"] or figures[f"fractions{i}"]))


def fractional_columns(df: DataFrame, policy: ColumnPolicy) -> frozenset:
    """Integer-role columns that must be stored as doubles.

    A column is an integer column only if it has a value and all of them are
    whole. This decides the output schema, so it runs one aggregate (one row)
    when called; ``clean`` and ``audit`` call it unless the answer is passed on
    as ``ColumnPolicy.fractional``, which landing a table finds out on the way
    (``fraction_tally``).
    """
    if not policy.present("integers", df):
        return frozenset()
    return with_fractions(df, policy, fraction_tally(df, policy).of(df).first().asDict()).fractional


def decided(df: DataFrame, policy: ColumnPolicy) -> ColumnPolicy:
    """``policy`` with its fractional columns known, so that no fraction is lost by default."""
    return policy if policy.fractional is not None else replace(policy, fractional=fractional_columns(df, policy))


def _number(c: str) -> str:
    return f"__number_{c}"


def _with_numbers(df: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """``df`` with the double of every column with a numeric role, each parsed once (see ``parse.plain``)."""
    dropped = {policy.price: parse.MONEY} if policy.price and policy.price in df.columns else {}
    dropped |= {c: parse.PERCENT for c in policy.present("percents", df)}
    dropped |= {c: "" for role in ("integers", "floats") for c in policy.present(role, df)}
    return df.withColumns({_number(c): parse.plain(c, x) for c, x in dropped.items()})


def _cleaned(df: DataFrame, policy: ColumnPolicy) -> dict[str, Column]:
    """Cleaned expression, over ``_with_numbers``, of every column that has a role (blank text parses to NULL by itself)."""
    out: dict[str, Column] = {}
    if policy.price and policy.price in df.columns:
        out[policy.price] = parse.finite(_number(policy.price))
    for c in policy.present("dates", df):
        out[c] = parse.date(c)
    for c in policy.present("categories", df):
        out[c] = parse.strip(_start(df, c).cast("string"))
    for c in policy.present("booleans", df):
        out[c] = parse.boolean(c)
    for c in policy.present("percents", df):
        out[c] = parse.finite(_number(c))
    for c in policy.present("integers", df):
        out[c] = parse.finite(_number(c)) if c in policy.fractional else parse.whole(_number(c), c)
    for c in policy.present("floats", df):
        out[c] = parse.finite(_number(c))
    return out


def clean(df: DataFrame, policy: ColumnPolicy) -> DataFrame:
    """The cleaned table: same rows, one extra column ``<price>_raw`` before the price."""
    policy = decided(df, policy)
    return _with_numbers(df, policy).select(*_projection(df, policy))


def _projection(df: DataFrame, policy: ColumnPolicy) -> list[Column]:
    exprs = _cleaned(df, policy)
    out = []
    for c in df.columns:
        if c == policy.price and f"{c}_raw" not in df.columns:
            out.append(_start(df, c).alias(f"{c}_raw"))
        out.append(exprs.get(c, _start(df, c)).alias(c))
    return out


def audit(df: DataFrame, policy: ColumnPolicy, dataset: str) -> DataFrame:
    """What ``clean`` does to ``df``: dataset, column, action, affected rows, notes.

    Failure and blank actions appear only where they happened; parse and trim
    actions always do.
    """
    policy = decided(df, policy)
    tally, lines = _audited(df, policy)
    return _audit_report(tally.of(_with_numbers(df, policy)), lines, df, policy, dataset)


def write_cleaned(df: DataFrame, policy: ColumnPolicy, dataset: str, path: str) -> tuple[DataFrame, int]:
    """Write ``clean(df)`` to ``path``; returns its audit, as ``audit`` gives it, and the number of rows.

    Both are counted while the rows are written: ``df`` is read once, and each value parsed once.
    """
    policy = decided(df, policy)
    tally, lines = _audited(df, policy)
    figures = write_observed(_with_numbers(df, policy), path, tally, _projection(df, policy))
    return _audit_report(figures_row(df.sparkSession, figures), lines, df, policy, dataset), figures["rows"]


def _audited(df: DataFrame, policy: ColumnPolicy) -> tuple[Tally, list[tuple]]:
    """What an audit counts, and its lines: column, action, whether it is always shown, note."""
    exprs = _cleaned(df, policy)
    text = _text_columns(df)
    # Every value is parsed once, in a projection; the aggregate only counts.
    seen: dict[str, Column] = {}
    figures, lines = {"rows": F.count(F.lit(1))}, []

    def flag(x: Column) -> str:
        seen[f"__p{len(seen)}"] = x
        return f"__p{len(seen) - 1}"

    def line(c: str, action: str, counter: Column, always: bool, note: str) -> None:
        figures[f"a{len(lines)}"] = counter
        lines.append((c, action, always, note))

    def parsed(c: str, action: str, failure: str, note: str, value: Column | None = None) -> None:
        value = exprs[c] if value is None else value
        present, good = flag(_start(df, c).isNotNull()), flag(value.isNotNull())
        line(c, action, F.count_if(good), True, note)
        line(c, failure, F.count_if(F.col(present) & ~F.col(good)), False,
             "Present but unparseable values became NULL.")

    for c in text:
        line(c, "blank_string_to_null", F.count_if(flag(~parse.has_text(c))), False,
             "Whitespace-only text became NULL; other text is unchanged.")
    if policy.price and policy.price in df.columns:
        parsed(policy.price, "currency_to_numeric", "unparseable_price_to_null",
               f"Missing stays NULL; the original is kept in '{policy.price}_raw'.")
    for c in policy.present("dates", df):
        parsed(c, "parse_datetime", "invalid_date_to_nat", "Values in ISO form became dates.")
    for c in policy.present("categories", df):
        trimmed = flag(F.coalesce(_start(df, c).cast("string") != exprs[c], F.lit(False)))
        line(c, "trim_category_whitespace", F.count_if(trimmed), True, "Surrounding whitespace removed; labels are not remapped.")
    for c in policy.present("booleans", df):
        parsed(c, "normalize_boolean", "unknown_boolean_to_null", "Known spellings became true or false.")
    for c in policy.present("percents", df):
        parsed(c, "percentage_to_numeric", "unparseable_percentage_to_null", "Points on a 0-100 scale.")
    for c in policy.present("integers", df):
        kind = "Float64" if c in policy.fractional else "Int64"
        # an integer column holds no fraction, so what is a number converts (or is out of range)
        x = parse.finite(_number(c))
        value = x if c in policy.fractional else F.when(F.abs(x) < 2.0**63, x)
        parsed(c, "convert_numeric", "unparseable_numeric_to_null", f"Converted to nullable {kind}.", value)
    for c in policy.present("floats", df):
        parsed(c, "convert_numeric", "unparseable_numeric_to_null", "Converted to nullable Float64.")

    return Tally(figures, seen), lines


def _audit_report(row: DataFrame, lines: list[tuple], df: DataFrame, policy: ColumnPolicy, dataset: str) -> DataFrame:
    extra = int(policy.price in df.columns and f"{policy.price}_raw" not in df.columns)

    def cell(column: str, action: str, affected: Column, keep: Column, note: Column) -> Column:
        return F.struct(
            F.lit(dataset).alias("dataset_name"), F.lit(column).alias("column_name"), F.lit(action).alias("action"),
            affected.cast("bigint").alias("affected_rows"), note.alias("notes"), keep.alias("keep"),
        )

    cells = [
        cell(c, action, F.col(f"a{i}"), F.lit(always) | (F.col(f"a{i}") > 0), F.lit(note))
        for i, (c, action, always, note) in enumerate(lines)
    ]
    cells.append(cell("*", "row_count_preservation_check", F.lit(0), F.lit(True),
                      F.concat(F.lit("Rows kept: "), F.col("rows").cast("string"))))
    cells.append(cell("*", "column_count_report", F.lit(extra), F.lit(True),
                      F.lit(f"Columns in: {len(df.columns)}, out: {len(df.columns) + extra}")))
    return row.select(F.inline(F.array(*cells))).where("keep").drop("keep")


class GrainError(ValueError):
    """A table is not at the grain it claims."""


def key_report(df: DataFrame, dataset: str, key: str) -> DataFrame:
    """One row: rows, NULL keys, rows inside repeated keys (NULLs are one group), distinct keys."""
    groups = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
        F.count("k").alias("distinct_keys"),
    ).select(F.lit(dataset).alias("dataset_name"), F.lit(key).alias("key_column"), "*")


def key_reports(tables: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    return reduce(DataFrame.unionByName, [key_report(df, name, key) for df, name, key in tables])


def require_grain(df: DataFrame, dataset: str, key: str, expected_rows: int | None = None) -> None:
    """Raise unless ``key`` exists, is never NULL and never repeats (and the row count is as expected)."""
    if key not in df.columns:
        raise GrainError(f"{dataset}: required key column '{key}' is missing.")
    r = key_report(df, dataset, key).first()
    if expected_rows is not None and r.row_count != expected_rows:
        raise GrainError(f"{dataset}: expected {expected_rows:,} rows, found {r.row_count:,}.")
    if r.null_keys:
        raise GrainError(f"{dataset}: found {r.null_keys:,} null values in '{key}' (null listing IDs).")
    if r.duplicate_rows:
        raise GrainError(
            f"{dataset}: found {r.duplicate_rows:,} rows in duplicate '{key}' groups (duplicate listing-ID)."
        )
