"""Grouped summaries, shares, top-N lists, histograms, correlation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestay.functions.numeric import join_on_keys, rounded
from lodestay.operators.ordering import all_read, approximate_quantiles, exact_quantiles, quantiles_of_counts, value_counts
from lodestay.session import durable


@dataclass(frozen=True)
class Fold:
    """An aggregate that can also be had from aggregates of parts of the rows.

    ``parts`` are taken over each part, ``merged`` puts the parts' figures, given by column name, together.
    """

    plain: Column
    parts: tuple[Column, ...]
    merged: Callable[..., Column]


def row_count() -> Fold:
    return Fold(F.count(F.lit(1)), (F.count(F.lit(1)),), lambda n: F.coalesce(F.sum(n), F.lit(0)))


def known(column: str) -> Fold:
    """Rows with a value."""
    return Fold(F.count(column), (F.count(column),), lambda n: F.coalesce(F.sum(n), F.lit(0)))


def rows_where(condition: Column) -> Fold:
    return Fold(F.count_if(condition), (F.count_if(condition),), lambda n: F.coalesce(F.sum(n), F.lit(0)))


def total(column: str) -> Fold:
    return Fold(F.sum(column), (F.sum(column),), F.sum)


def least(column: str) -> Fold:
    return Fold(F.min(column), (F.min(column),), F.min)


def greatest(column: str) -> Fold:
    return Fold(F.max(column), (F.max(column),), F.max)


def average(column: str, digits: int | None = None) -> Fold:
    def shown(c: Column) -> Column:
        return c if digits is None else rounded(c, digits)

    x = F.col(column).cast("double")
    return Fold(
        shown(F.avg(column)), (F.sum(x), F.count(column)),
        lambda s, n: shown(F.try_divide(F.sum(s), F.sum(n))))


def group_summary(
    df: DataFrame,
    by: Sequence[str],
    aggs: Mapping[str, Column | Fold],
    quantiles: Mapping[str, tuple[str, float, int | None]] | None = None,
    drop_null_groups: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Ordinary aggregates plus exact quantiles per group.

    ``quantiles`` maps an output name to ``(column, probability, digits)``.
    If they are of one column and all aggregates are folds, everything comes
    from one scan and one shuffle: the folds' parts are taken per distinct
    value beside its count. Other aggregates are a pass of their own. Nothing
    gathers a group in one task (see ``ordering``). ``by`` may be empty.
    """
    by = list(by)
    if drop_null_groups:
        for k in by:
            df = df.where(F.col(k).isNotNull())
    plain = [(a.plain if isinstance(a, Fold) else a).alias(k) for k, a in aggs.items()]
    if not quantiles:
        return df.groupBy(*by).agg(*plain)
    measured = {c for c, _, _ in quantiles.values()}
    if exact and len(measured) == 1 and all(isinstance(a, Fold) for a in aggs.values()):
        parts = {f"__{i}_{j}": c for i, a in enumerate(aggs.values()) for j, c in enumerate(a.parts)}
        counts = value_counts(df, by, measured.pop(), parts)
        base = all_read(counts, list(parts)).groupBy(*by).agg(*[
            a.merged(*[f"__{i}_{j}" for j in range(len(a.parts))]).alias(k) for i, (k, a) in enumerate(aggs.items())
        ])
        q = quantiles_of_counts(counts, by, {k: p for k, (_, p, _) in quantiles.items()}, list(parts))
    else:
        base = df.groupBy(*by).agg(*plain)
        wanted = {k: (c, p) for k, (c, p, _) in quantiles.items()}
        q = exact_quantiles(df, by, wanted) if exact else approximate_quantiles(df, by, wanted)
    q = q.select(*by, *[
        (F.col(k) if d is None else rounded(k, d)).alias(k) for k, (_, _, d) in quantiles.items()
    ])
    if not by:
        # both sides are exactly one row, also for an empty input
        return base.crossJoin(q)
    # Without NULL groups a plain equality does, and a query that asks for no
    # quantile drops the join altogether.
    return base.join(q, by, "left") if drop_null_groups else join_on_keys(base, q, by, "left")


def with_share(df: DataFrame, count: str, name: str, digits: int | None = 2, labels_fixed: bool = False) -> DataFrame:
    """Share of each (already aggregated) row in the grand total.

    ``labels_fixed`` says that the groups are a fixed list of labels, so that
    one task may see all of them; otherwise the total is a one-row join.
    """
    if labels_fixed:
        total, out = F.sum(count).over(Window.partitionBy(F.lit(0))), df
    else:
        total = F.col("__total")
        out = df.crossJoin(F.broadcast(df.agg(F.sum(count).alias("__total"))))  # one row
    share = F.lit(100.0) * F.col(count) / total
    return out.withColumn(name, share if digits is None else rounded(share, digits)).drop("__total")


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows (a per-partition top-N, no full sort)."""
    return df.orderBy(*order).limit(n)


def value_share(df: DataFrame, columns: Sequence[str], name: str = "row_count") -> DataFrame:
    """Rows per distinct value with the share of all rows."""
    return with_share(df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)), name, "percentage", 4)


def value_frequency(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, NULL included, most frequent first."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    order = [F.desc("row_count"), F.col("value").asc_nulls_last()]
    return counts.orderBy(*order) if n is None else top_rows(counts, order, n)


def rows_per_key(df: DataFrame, key: str, distinct: str | None = None) -> DataFrame:
    """First level of the two-level distributions: rows (and distinct values) per key."""
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if distinct:
        aggs.append(F.count_distinct(distinct).alias("distinct_count"))
    return df.groupBy(key).agg(*aggs)


def distribution(
    df: DataFrame, column: str, prefix: str = "", quantiles: bool = True, digits: int | None = None
) -> DataFrame:
    """count, min, max, average and (optionally) q1, median, q3 of one column."""
    df = df.select(F.col(column).cast("double").alias(column))
    aggs = {
        f"{prefix}count": known(column), f"{prefix}min": least(column), f"{prefix}max": greatest(column),
        f"{prefix}avg": average(column, digits),
    }
    q = {
        f"{prefix}q1": (column, 0.25, digits),
        f"{prefix}median": (column, 0.5, digits),
        f"{prefix}q3": (column, 0.75, digits),
    }
    return group_summary(df, [], aggs, q if quantiles else None)


def iqr_outliers(df: DataFrame, column: str, digits: int = 2, k: float = 1.5) -> DataFrame:
    """Rows outside the Tukey fences built from the *rounded* quartiles; counted, not removed."""
    bounds = iqr_bounds(df, column, digits, k)
    x = F.col(column)
    outside = (x < F.col("lower_bound")) | (x > F.col("upper_bound"))
    return (
        df.select(column)
        .crossJoin(F.broadcast(bounds))  # one row
        .agg(
            F.max("q1").alias("q1"),
            F.max("q3").alias("q3"),
            F.max("lower_bound").alias("lower_bound"),
            F.max("upper_bound").alias("upper_bound"),
            F.count(column).alias("value_count"),
            F.count_if(outside).alias("outlier_count"),
        )
        .withColumn(
            "outlier_percentage",
            rounded(F.lit(100.0) * F.col("outlier_count") / F.nullif("value_count", F.lit(0)), 2),
        )
    )


def iqr_bounds(df: DataFrame, column: str, digits: int = 2, k: float = 1.5) -> DataFrame:
    """One row: rounded quartiles and the two fences."""
    q = exact_quantiles(df, [], {"q1": (column, 0.25), "q3": (column, 0.75)}, digits)
    spread = F.col("q3") - F.col("q1")
    return q.withColumn("lower_bound", F.col("q1") - k * spread).withColumn("upper_bound", F.col("q3") + k * spread)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over the observed range; the maximum falls in the last bin."""
    x = F.col(column).cast("double")
    values = df.where(x.isNotNull()).select(x.alias("x"))
    span = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    bin_id = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0)
    return (
        values.crossJoin(F.broadcast(span))  # one row
        .groupBy(bin_id.cast("int").alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.max("lo").alias("lo"),
            F.max("hi").alias("hi"),
        )
        .select(
            "bin",
            rounded(F.col("lo") + F.col("bin") * width, 6).alias("bin_start"),
            rounded(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("bin_end"),
            "row_count",
        )
    )


def at_or_below_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Rows whose value is at or below the p-quantile (view only; the input is untouched)."""
    limit = exact_quantiles(df, [], {"upper_limit": (column, p)})
    return df.crossJoin(F.broadcast(limit)).where(F.col(column) <= F.col("upper_limit"))  # one row


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """Pearson correlation of every pair over pairwise-complete rows, in one pass.

    Long form, full matrix (mirrored, 1.0 on the diagonal of a varying column).
    A pair without variance gives NULL.
    """
    aggs, pairs = [], list(combinations(columns, 2))
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        aggs += [F.regr_sxy(y, x).alias(f"xy{i}"), F.regr_sxx(y, x).alias(f"xx{i}"), F.regr_syy(y, x).alias(f"yy{i}")]
    for i, c in enumerate(columns):
        aggs += [F.min(F.col(c).cast("double")).alias(f"d0{i}"), F.max(F.col(c).cast("double")).alias(f"d1{i}")]
    row = df.agg(*aggs)
    cells = []
    for i, (a, b) in enumerate(pairs):
        r = F.try_divide(F.col(f"xy{i}"), F.sqrt(F.col(f"xx{i}") * F.col(f"yy{i}")))  # no variance: 0, hence NULL
        r = r if digits is None else rounded(r, digits)
        for left, right in ((a, b), (b, a)):
            cells.append(F.struct(F.lit(left).alias("column_1"), F.lit(right).alias("column_2"), r.alias("correlation")))
    for i, c in enumerate(columns):
        one = F.when(F.col(f"d0{i}") < F.col(f"d1{i}"), F.lit(1.0))
        cells.append(F.struct(F.lit(c).alias("column_1"), F.lit(c).alias("column_2"), one.alias("correlation")))
    return row.select(F.inline(F.array(*cells)))


def long_metrics(row: DataFrame, notes: Mapping[str, str] | None = None) -> DataFrame:
    """One aggregate row -> (metric, value[, notes]) rows, in column order."""
    cells = []
    for c in row.columns:
        fields = [F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")]
        if notes is not None:
            fields.append(F.lit(notes.get(c, "")).alias("notes"))
        cells.append(F.struct(*fields))
    return row.select(F.inline(F.array(*cells)))


def ranked_ends(df: DataFrame, measure: str, tie: str, n: int, support: str, minimum: int) -> DataFrame:
    """The n highest and n lowest groups among those with enough support."""
    usable = df.where((F.col(support) >= minimum) & F.col(measure).isNotNull())
    high = top_rows(usable, [F.desc(measure), F.asc(tie)], n).withColumn("list", F.lit("top"))
    low = top_rows(usable, [F.asc(measure), F.asc(tie)], n).withColumn("list", F.lit("bottom"))
    return high.unionByName(low)


def surrogate_key(df: DataFrame, order: str, name: str) -> DataFrame:
    """Dense 1..n key in the order of the unique column ``order``, NULL first.

    Rows are dealt to ranges of ``order`` and numbered inside their range; a
    prefix sum over the ranges' sizes, one row each, gives where a range
    begins. No task orders the whole table.
    """
    here = Window.partitionBy("__range").orderBy(F.col(order).asc_nulls_first())
    dealt = df.repartitionByRange(F.col(order).asc_nulls_first()).withColumn("__range", F.spark_partition_id())
    numbered = durable(dealt.withColumn("__place", F.row_number().over(here)))  # ranges must not be drawn twice
    before = Window.partitionBy(F.lit(0)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("__range").agg(F.count(F.lit(1)).alias("__size"))
    starts = sizes.select(F.col("__range"), F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    keyed = numbered.join(F.broadcast(starts), "__range")  # one row a range
    return keyed.withColumn(name, (F.col("__start") + F.col("__place")).cast("int")).drop("__range", "__place", "__start")
