"""Figures counted while a stage writes its rows, so that no scan is made for a count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tally:
    """``seen``: columns computed once for each row; ``figures``: aggregates over them and the table's columns.

    Distinct counts cannot be observed; all other aggregates can.
    """

    figures: Mapping[str, Column]
    seen: Mapping[str, Column] = field(default_factory=dict)

    def of(self, df: DataFrame) -> DataFrame:
        """One row: the figures by a scan of their own."""
        return df.withColumns(dict(self.seen)).agg(*[x.alias(name) for name, x in self.figures.items()])


def write_observed(
    df: DataFrame, path: str, tally: Tally, written: Sequence[Column] | None = None,
) -> dict[str, object]:
    """Write ``written`` (all columns of ``df`` by default) as Parquet; returns the figures of ``tally``.

    With ``written``, the figures are over ``seen`` and the written columns. The rows pass once. They are counted in the stage that writes them, whose
    tasks Spark counts once each, however often a lost executor or speculation
    makes one run again; before a shuffle it would count a repeated task twice,
    so nothing is shuffled between counting and writing. An empty table whose
    plan Spark folds away is counted by an aggregate, which costs nothing then.
    """
    rows = df.select(*(written or ["*"]))
    hidden = [x.alias(name) for name, x in tally.seen.items()]
    observation = Observation()
    observed = df.select(*(written or ["*"]), *hidden).observe(
        observation, *[x.alias(name) for name, x in tally.figures.items()])
    observed.select(*(F.col(f"`{c}`") for c in rows.columns)).write.mode("overwrite").parquet(path)
    return dict(observation.get) or tally.of(df).first().asDict()


def figures_row(spark: SparkSession, figures: Mapping[str, object], kind: str = "bigint") -> DataFrame:
    """One row of whole-number figures."""
    schema = ", ".join(f"`{name}` {kind}" for name in figures)
    return spark.createDataFrame([tuple(figures.values())], schema)
