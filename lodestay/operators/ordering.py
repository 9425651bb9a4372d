"""Exact order statistics by radix selection, without putting a group into one task.

``percentile``/``median`` keep a value -> count map per group in one task, and
a rank window sorts a whole group in one task. Both fail when one group holds a
third of a very large table. Here instead:

1. ``value_counts``: (group, value) -> n. The shuffle key includes the value,
   so a hot group is spread out, and repeated values are combined map-side.
2. every value has a 64-bit image that keeps the order of doubles. A round
   counts rows per (group, prefix of the image), combined map-side, and a
   running total over a group's prefixes finds the one that holds a wanted
   position. The next round looks into that prefix only, ``LEVELS`` bits deeper.
3. after the last round a prefix is one value.

A running total orders at most 2 ** max(LEVELS) rows whatever the data, cuts
are exact, and nothing is sampled. All rounds, and all probabilities and
measures, read the same shuffle of step 1 (exchange reuse), so the input is
scanned once.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions.numeric import join_on_keys, rounded

LEVELS = (22, 21, 21)  # bits a round looks at, 64 together
COUNT = "__n"  # rows of a value, in ``value_counts``
_V, _N, _M, _K, _P = "__value", COUNT, "__measure", "__image", "__prefix"


def image(value: str) -> Column:
    """A long in the order of the doubles: exponent and mantissa of the magnitude, negated below zero.

    The exponent from the logarithm may be one off next to a power of two; the
    comparison puts it right. Powers of two and quotients by them are exact.
    Below the normal doubles the image counts the smallest steps.
    """
    a = f"least(abs({value}), {sys.float_info.max!r}D)"
    guess = f"floor(log2({a}))"
    exponent = f"({guess} - CASE WHEN {a} < pow(2D, {guess}) THEN 1 ELSE 0 END + CASE WHEN {a} >= pow(2D, {guess} + 1) THEN 1 ELSE 0 END)"
    mantissa = f"CAST(({a} / pow(2D, {exponent}) - 1D) * {2.0 ** 52!r}D AS BIGINT)"
    magnitude = (
        f"CASE WHEN abs({value}) > {sys.float_info.max!r}D THEN {2047 << 52}L "
        f"WHEN {a} < {2.0 ** -1022!r}D THEN CAST({a} * {2.0 ** 537!r}D * {2.0 ** 537!r}D AS BIGINT) "
        f"ELSE ({exponent} + 1023) * {1 << 52}L + {mantissa} END")
    return F.expr(f"CASE WHEN {value} < 0 THEN -1L ELSE 1L END * ({magnitude})")


def prefix(level: int) -> Column:
    """The leading bits of the image that ``level`` rounds have looked at."""
    rest = 64 - sum(LEVELS[:level])
    return F.shiftright(_K, rest) if rest else F.col(_K)


def value_counts(df: DataFrame, by: Sequence[str], value: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct values per group with their number of rows, the image, and aggregates ``extra`` of the same rows.

    NULL and NaN are one value without rows to count (``__n`` is 0), so that
    ``extra`` covers all rows; ``counted`` leaves it out.
    """
    x = F.col(value).cast("double")
    known = df.select("*", F.when(~F.isnan(x), x).alias(_V))
    aggs = [F.count(_V).alias(_N)] + [c.alias(k) for k, c in (extra or {}).items()]
    return known.groupBy(*by, _V).agg(*aggs)


def value_sums(df: DataFrame, by: Sequence[str], value: str, rows: str) -> DataFrame:
    """``value_counts`` of values that come with a number of ``rows`` each."""
    return df.groupBy(*by, F.col(value).alias(_V)).agg(F.sum(rows).alias(_N))


def all_read(counts: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``counts`` as every branch over it has to begin.

    The condition always holds and reads every figure: a branch that left one
    out would be another aggregate, with a scan and a shuffle of its own.
    """
    return counts.where(F.size(F.array(*[F.col(c).cast("double") for c in [_N, *extra]])) > 0)


def counted(counts: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The values with rows, and their images."""
    return all_read(counts, extra).where(F.col(_N) > 0).withColumn(_K, image(_V))


def _wanted(p: float, total: str = "__total") -> tuple[str, str]:
    """The two positions a linear-interpolated quantile lies between."""
    at = f"CAST({total} - 1 AS DOUBLE) * {float(p)!r}D"
    return f"floor({at})", f"ceil({at})"


def _holds(position: str, start: str, count: str) -> str:
    return f"({position} >= {start} AND {position} < {start} + {count})"


def _any_holds(probabilities: Sequence[float], ends: int = 2) -> str:
    """Whether a value holds one of the positions of the quantiles (the lower ones only, with one end)."""
    if len(probabilities) * ends <= 64:
        return " OR ".join(_holds(at, "__before", _N) for p in probabilities for at in _wanted(p)[:ends])
    at = [f"{end}(CAST(__total - 1 AS DOUBLE) * p)" for end in ("floor", "ceil")[:ends]]
    listed = ", ".join(f"{float(p)!r}D" for p in probabilities)  # a chain of as many conditions does not compile
    return f"exists(array({listed}), p -> {' OR '.join(_holds(x, '__before', _N) for x in at)})"


def _running(keys: Sequence[str]) -> tuple[Window, Window]:
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return whole, whole.orderBy(_P).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def selected(values: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The values of each group that hold a position of one of the quantiles, with rows before and rows in all."""
    held, keys = None, list(keys)
    wanted = _any_holds(probabilities)
    for level in range(1, len(LEVELS) + 1):
        figures = [F.sum(_N).alias(_N), F.max(_V).alias(_V)]  # at the last level one value
        if held is None:
            whole, upto = _running(keys)
            sums = values.groupBy(*keys, prefix(level).alias(_P)).agg(*figures)
            sums = sums.select("*", (F.sum(_N).over(upto) - F.col(_N)).alias("__before"), F.sum(_N).over(whole).alias("__total"))
        else:
            _, upto = _running([*keys, "__outer"])
            sums = _inside(values, held, keys, level - 1).groupBy(*keys, "__outer", prefix(level).alias(_P)).agg(
                *figures, F.max("__base").alias("__base"), F.max("__total").alias("__total"))
            sums = sums.withColumn("__before", F.col("__base") + F.sum(_N).over(upto) - F.col(_N))
        held = sums.where(wanted)
    return held


def _inside(values: DataFrame, held: DataFrame, keys: Sequence[str], level: int) -> DataFrame:
    """The values within the held prefixes of a round, which come along as ``__outer`` with the rows before them."""
    outer = held.select(*keys, F.col(_P).alias("__outer"), F.col("__before").alias("__base"), "__total")
    if not keys:  # two positions for each probability, no more
        outer = F.broadcast(outer)
    return join_on_keys(values.withColumn("__outer", prefix(level)), outer, [*keys, "__outer"], "inner")


def positions(values: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """All values of one group with ``__before``, the number of rows with a smaller value.

    ``carried`` are counts of a part of the rows, each with the number of such
    rows before (``<name>_before``). Rows before a prefix are running totals
    inside the prefix one round shorter, so a total orders at most
    2 ** max(LEVELS) rows at every depth. The joins match NULLs too: from a
    plain equality Spark would infer that the prefix is known and ask so below
    the shuffle of ``value_counts``, in some branches, which then were shuffles
    over scans of their own.
    """
    before, names = None, {_N: "__before", **{c: f"{c}_before" for c in carried}}
    _, upto = _running(["__outer"])

    def running(sums: DataFrame, base: bool) -> DataFrame:
        return sums.withColumns({
            name: F.sum(c).over(upto) - F.col(c) + (F.col(f"__base_{c}") if base else F.lit(0)) for c, name in names.items()})

    for level in range(1, len(LEVELS)):
        outer = prefix(level - 1) if level > 1 else F.lit(0)
        sums = values.select(*names, prefix(level).alias(_P), outer.alias("__outer"))
        sums = sums.groupBy("__outer", _P).agg(*[F.sum(c).alias(c) for c in names])
        sums = running(sums if before is None else join_on_keys(sums, before, ["__outer"], "inner"), before is not None)
        before = sums.select(F.col(_P).alias("__outer"), *[F.col(name).alias(f"__base_{c}") for c, name in names.items()])
    placed = values.select(_V, *names, prefix(len(LEVELS)).alias(_P), prefix(len(LEVELS) - 1).alias("__outer"))
    return running(join_on_keys(placed, before, ["__outer"], "inner"), True).select(_V, *names, *names.values())


def median_ends(group: str, before: str, count: str, total: str) -> dict[str, Column]:
    """Aggregates over ``positions`` with the group's ``total`` beside them; ``between_ends`` makes a median of them."""
    low, high = _wanted(0.5, total)
    ends = {f"{group}__lo": low, f"{group}__hi": high}
    return {
        **{k: F.expr(f"max(CASE WHEN {_holds(at, before, count)} THEN {_V} END)") for k, at in ends.items()},
        f"{group}__at": F.expr(f"max(CAST({total} - 1 AS DOUBLE) * 0.5D)"),
    }


def _interpolated(held: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[int | None, float]]) -> DataFrame:
    """One row per group from the held values; ``wanted`` maps a name to (measure number or None, probability)."""
    picks = []
    for name, (measure, p) in wanted.items():
        low, high = _wanted(p)
        mine = "TRUE" if measure is None else f"{_M} = {measure}"
        for end, at in (("lo", low), ("hi", high)):
            picks.append(F.expr(f"max(CASE WHEN {mine} AND {_holds(at, '__before', _N)} THEN {_V} END)").alias(f"{name}__{end}"))
        picks.append(F.expr(f"max(CASE WHEN {mine} THEN CAST(__total - 1 AS DOUBLE) * {float(p)!r}D END)").alias(f"{name}__at"))
    ends = held.groupBy(*by).agg(*picks)
    out = []
    for name in wanted:
        out.append(between_ends(name).alias(name))
    return ends.select(*by, *out)


def between_ends(name: str) -> Column:
    """The linear interpolation between ``<name>__lo`` and ``<name>__hi`` at the position ``<name>__at``."""
    lo, hi, part = f"`{name}__lo`", f"`{name}__hi`", f"(`{name}__at` - floor(`{name}__at`))"
    # the weighted form SQL engines use; equal ends need no arithmetic
    return F.expr(f"CASE WHEN {lo} = {hi} THEN {lo} ELSE {lo} * (1 - {part}) + {hi} * {part} END")


def quantiles_of_counts(
    counts: DataFrame, by: Sequence[str], wanted: Mapping[str, float], extra: Sequence[str] = (),
) -> DataFrame:
    """Linear-interpolated quantiles, name -> probability, from the ``value_counts`` of one measure."""
    held = selected(counted(counts, extra), by, sorted(set(wanted.values())))
    return _interpolated(held, by, {k: (None, p) for k, p in wanted.items()})


def quantile_values(counts: DataFrame, by: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """(by, value): the values that hold the lower position of each quantile, from ``value_counts``."""
    return selected(counted(counts), by, probabilities).where(_any_holds(probabilities, 1)).select(*by, F.col(_V).alias("value"))


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
    digits: int | None = None,
) -> DataFrame:
    """Linear-interpolated quantiles, one row per group.

    ``wanted`` maps an output name to ``(column, probability)``; NULL and NaN
    are ignored, a group with no value is absent from the result.
    """
    by = list(by)
    columns = sorted({c for c, _ in wanted.values()})
    if len(columns) == 1:
        measures = df.select(*by, F.col(columns[0]).cast("double").alias("__x"))
        out = quantiles_of_counts(value_counts(measures, by, "__x"), by, {k: p for k, (_, p) in wanted.items()})
    else:
        pairs = [F.struct(F.lit(i).alias("m"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)]
        measures = df.select(*by, F.explode(F.array(*pairs)).alias("p")).select(
            *by, F.col("p.x").alias("__x"), F.col("p.m").alias(_M)
        )
        keys = [*by, _M]
        held = selected(counted(value_counts(measures, keys, "__x")), keys, sorted({p for _, p in wanted.values()}))
        out = _interpolated(held, by, {k: (columns.index(c), p) for k, (c, p) in wanted.items()})
    return out if digits is None else out.select(*by, *[rounded(k, digits).alias(k) for k in wanted])


def approximate_quantiles(
    df: DataFrame, by: Sequence[str], wanted: Mapping[str, tuple[str, float]], accuracy: int = 10000
) -> DataFrame:
    """One-shuffle alternative with a bounded sketch (error 1/accuracy in rank)."""
    aggs = [F.percentile_approx(c, F.lit(p), F.lit(accuracy)).cast("double").alias(k) for k, (c, p) in wanted.items()]
    return df.groupBy(*by).agg(*aggs)
