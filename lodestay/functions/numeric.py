"""Small guarded arithmetic and row-identity expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions.parse import col


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` holds; 0, not NULL, over no rows."""
    return F.count_if(condition)


def rounded(c: str | Column, digits: int) -> Column:
    """Half-up rounding of a double the way SQL engines do it: scale, round, scale back.

    Spark's own ``round(x, d)`` works on the shortest decimal text of ``x`` and
    so rounds 274564.975 up although the stored double is below the half.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(col(c).cast("double") * scale) / scale


def ratio(numerator: str | Column, denominator: str | Column, digits: int | None = None) -> Column:
    """Quotient, NULL unless the denominator is present and positive."""
    n, d = col(numerator).cast("double"), col(denominator).cast("double")
    value = F.when(d > 0, n / d)
    return value if digits is None else rounded(value, digits)


def percentage(part: str | Column, whole: str | Column, digits: int, empty: float | None = 0.0) -> Column:
    """``100 * part / whole`` rounded; ``empty`` when the whole is zero."""
    p, w = col(part).cast("double"), col(whole).cast("double")
    fallback = F.lit(empty).cast("double")
    return F.when(w > 0, rounded(p / w * F.lit(100.0), digits)).otherwise(fallback)


def row_fingerprint(columns: Sequence[str]) -> Column:
    """128-bit identity of a row in which NULLs are equal to each other.

    Spark's hash skips NULLs, so ``(NULL, 'a')`` and ``('a', NULL)`` would
    collide: a NULL flag is hashed beside every value. One 64-bit hash is too
    narrow for trillions of rows, hence two with different seeds.
    """
    parts = []
    for c in columns:
        parts += [F.col(c), F.col(c).isNull()]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("second"), *parts).alias("b"))


def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join in which a NULL key matches a NULL key; key columns appear once."""
    if not keys:
        return left.crossJoin(right)  # both sides are single aggregate rows
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    condition = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])
