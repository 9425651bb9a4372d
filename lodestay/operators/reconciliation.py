"""Do two tables speak about the same keys and rows?

Keys are compared by one full join of *distinct* (or counted) keys, never by
collecting a set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.functions.numeric import percentage


def _keys(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.count(F.lit(1)).alias(f"{name}_rows"))


def key_coverage(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: sizes of A, B, both, A only, B only and the coverage each way (0 for an empty side)."""
    joined = _keys(left, left_key, "a").join(_keys(right, right_key, "b"), F.col("a") == F.col("b"), "full")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    row = joined.agg(
        F.count("a").alias("left_keys"),
        F.count("b").alias("right_keys"),
        F.count_if(both).alias("in_both"),
        F.count_if(F.col("b").isNull()).alias("only_left"),
        F.count_if(F.col("a").isNull()).alias("only_right"),
    )
    return row.withColumns({
        "left_coverage_pct": percentage("in_both", "left_keys", 4),
        "right_coverage_pct": percentage("in_both", "right_keys", 4),
    })


def same_key_set(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """One row: are the two distinct key sets equal, and by how many keys they differ."""
    c = key_coverage(left, left_key, right, right_key)
    differing = F.col("only_left") + F.col("only_right")
    return c.select(differing.alias("differing_keys"), (differing == 0).alias("sets_equal"))


def key_union(left: DataFrame, left_key: str, right: DataFrame, right_key: str, name: str = "key") -> DataFrame:
    """Distinct keys of either table."""
    a = left.select(F.col(left_key).alias(name))
    b = right.select(F.col(right_key).alias(name))
    return a.union(b).where(F.col(name).isNotNull()).distinct()


def key_intersection(left: DataFrame, left_key: str, right: DataFrame, right_key: str, name: str = "key") -> DataFrame:
    a = left.select(F.col(left_key).alias(name)).where(F.col(name).isNotNull())
    return a.intersect(right.select(F.col(right_key).alias(name)))


def key_difference(left: DataFrame, left_key: str, right: DataFrame, right_key: str, name: str = "key") -> DataFrame:
    a = left.select(F.col(left_key).alias(name)).where(F.col(name).isNotNull())
    return a.subtract(right.select(F.col(right_key).alias(name)))


def multiset_difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose number of rows differs between the tables (NULL keys match each other)."""
    tagged = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    # one shuffle of counts instead of two aggregates and a join
    counts = tagged.groupBy(*keys).agg(
        F.sum("l").cast("bigint").alias("left_count"), F.sum("r").cast("bigint").alias("right_count")
    )
    return counts.where(F.col("left_count") != F.col("right_count"))


def join_back_proof(df: DataFrame, keys: Sequence[str], identity: str) -> DataFrame:
    """Rows inside repeated key groups against their distinct identities.

    Equal numbers prove that repeated keys are different records. Counted in
    two aggregate levels, so that no group is gathered.
    """
    per_identity = df.groupBy(*keys, identity).agg(F.count(F.lit(1)).alias("n"))
    per_group = per_identity.groupBy(*keys).agg(
        F.sum("n").alias("rows"), F.count(identity).alias("ids")
    ).where(F.col("rows") > 1)
    return per_group.agg(
        F.count(F.lit(1)).alias("repeated_groups"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum("ids"), F.lit(0)).alias("distinct_ids_in_groups"),
    ).withColumn("all_distinct", F.col("rows_in_groups") == F.col("distinct_ids_in_groups"))


def group_examples(df: DataFrame, keys: Sequence[str], columns: Sequence[str], groups: int = 5) -> DataFrame:
    """All rows of the ``groups`` most repeated keys; a key with a NULL is no key."""
    keyed = df.dropna(subset=list(keys))
    top = (
        keyed.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") > 1)
        .orderBy(F.desc("group_size"), *[F.asc(k) for k in keys])
        .limit(groups)
    )
    # at most ``groups`` rows on the right: a fixed, tiny side
    return keyed.select(*keys, *columns).join(F.broadcast(top), list(keys), "inner")


def structure_comparison(tables: Sequence[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Per (name, table, key, date): rows, distinct keys, first and last date."""
    out = None
    for name, df, key, day in tables:
        row = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(key).alias("distinct_keys"),
            F.min(F.col(day).cast("date")).alias("first_date"),
            F.max(F.col(day).cast("date")).alias("last_date"),
        ).select(F.lit(name).alias("table_name"), "*")
        out = row if out is None else out.unionByName(row)
    return out


def reference_coverage(df: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """One row: rows whose (trimmed) value is a reference value, their share, unused reference values."""
    values = (
        df.groupBy(parse.strip(F.col(column).cast("string")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    )
    known = reference.select(parse.strip(F.col(reference_column).cast("string")).alias("r")).where(
        F.col("r").isNotNull()
    ).distinct()
    joined = values.join(known, F.col("v") == F.col("r"), "full")
    matched = F.col("v").isNotNull() & F.col("r").isNotNull()
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(matched, F.col("n"))), F.lit(0)).alias("matched_rows"),
        F.count("r").alias("reference_values"),
        F.count_if(F.col("r").isNotNull() & F.col("v").isNull()).alias("unused_reference_values"),
    ).withColumn("coverage_pct", percentage("matched_rows", "row_count", 4))
