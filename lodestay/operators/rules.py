"""Declarative data-quality rules, their report, and the gate.

Row rules of a table are all evaluated in one aggregate pass. Key and
reference rules first count rows per key (map-side combined), so that a hot
key is one row by the time it is joined. A ``RuleBook`` goes further: the key
rules of all its tables are sums over one ledger of keys, joined by nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestay.functions import parse
from lodestay.functions.numeric import percentage, row_fingerprint

ERROR, WARNING, INFO = "ERROR", "WARNING", "INFO"
PASS, FAIL = "PASS", "FAIL"
STATUSES = (PASS, WARNING, FAIL)
REPORT_COLUMNS = (
    "dataset_name", "rule_id", "rule_description", "checked_column", "invalid_count",
    "total_rows", "invalid_percentage", "status", "severity", "notes",
)


@dataclass(frozen=True)
class Rule:
    """Identity of a rule; what it counts is decided by the check it is given to."""

    rule_id: str
    description: str
    checked: str
    severity: str = ERROR
    notes: str = ""


# ---- row conditions (True = violation) -------------------------------------

def out_of_range(c: str, low: float | None = None, high: float | None = None, number=parse.number) -> Column:
    """Present but not a number, or outside the inclusive bounds."""
    x = number(c)
    bad = x.isNull()
    if low is not None:
        bad = bad | (x < low)
    if high is not None:
        bad = bad | (x > high)
    return F.col(c).isNotNull() & bad


def negative_currency(c: str) -> Column:
    return F.coalesce(parse.currency(c) < 0, F.lit(False))


def unparseable_currency(c: str) -> Column:
    return F.col(c).isNotNull() & parse.currency(c).isNull()


def unparseable_date(c: str) -> Column:
    return F.col(c).isNotNull() & parse.date(c).isNull()


def not_in_set(c: str, allowed: Sequence[str]) -> Column:
    """Present and, trimmed, not one of the allowed values."""
    return F.col(c).isNotNull() & ~parse.strip(F.col(c).cast("string")).isin(*allowed)


def not_a_flag(c: str) -> Column:
    """NULL or not one of t, f, true, false."""
    word = F.lower(F.trim(F.col(c).cast("string")))
    return word.isNull() | ~word.isin("t", "f", "true", "false")


def wrong_order(low: str, high: str) -> Column:
    """Both are numbers and the upper one is below the lower one."""
    return F.coalesce(parse.number(high) < parse.number(low), F.lit(False))


# ---- checks -> one report row per rule --------------------------------------

def _report_row(rule: Rule, dataset: str, invalid: Column, total: Column) -> Column:
    status = (
        F.when(invalid == 0, PASS).otherwise(FAIL if rule.severity.upper() == ERROR else WARNING)
    )
    return F.struct(
        F.lit(dataset).alias("dataset_name"),
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.description).alias("rule_description"),
        F.lit(rule.checked).alias("checked_column"),
        invalid.cast("bigint").alias("invalid_count"),
        total.cast("bigint").alias("total_rows"),
        percentage(invalid, total, 4).alias("invalid_percentage"),
        status.alias("status"),
        F.lit(rule.severity.upper()).alias("severity"),
        F.lit(rule.notes).alias("notes"),
    )


def check_rows(df: DataFrame, dataset: str, rules: Sequence[tuple[Rule, Column]]) -> DataFrame:
    """All row-level rules of a table in one aggregate."""
    if not rules:
        raise ValueError("check_rows needs at least one rule")
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(bad).alias(f"bad{i}") for i, (_, bad) in enumerate(rules)]
    cells = [_report_row(rule, dataset, F.col(f"bad{i}"), F.col("rows")) for i, (rule, _) in enumerate(rules)]
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def one_check(row: DataFrame, rule: Rule, dataset: str) -> DataFrame:
    """Report row of a rule from a one-row table with ``invalid`` and ``total``."""
    cell = _report_row(rule, dataset, F.col("invalid"), F.col("total"))
    return row.select(F.inline(F.array(cell)))


def column_rules(df: DataFrame, required: Sequence[str], prefix: str) -> list[tuple[Rule, Column]]:
    """One rule per required column; all rows are invalid when it is absent.

    An empty table therefore passes, whatever its columns.
    """
    present = set(df.columns)
    rules = []
    for i, name in enumerate(sorted(required), start=1):
        rule = Rule(f"{prefix}_{i:03d}", f"Required column '{name}' must exist", name,
                    notes="Later steps may not run without it.")
        rules.append((rule, F.lit(name not in present)))
    return rules


def check_columns(df: DataFrame, dataset: str, required: Sequence[str], prefix: str) -> DataFrame:
    return check_rows(df, dataset, column_rules(df, required, prefix))


def check_unique(df: DataFrame, dataset: str, rule: Rule, keys: Sequence[str]) -> DataFrame:
    """Counts every row of a repeated key; NULLs form one group."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = groups.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return one_check(row, rule, dataset)


def check_no_extra_rows(df: DataFrame, dataset: str, rule: Rule, keys: Sequence[str]) -> DataFrame:
    """Counts rows beyond the first of a key.

    A single key ignores its NULLs; several keys are compared as a whole,
    NULLs equal.
    """
    if len(keys) == 1:
        groups = df.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("n"))
        extra = F.when(F.col(keys[0]).isNull(), 0).otherwise(F.col("n") - 1)
    else:
        groups = df.groupBy(row_fingerprint(keys).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        extra = F.col("n") - 1
    row = groups.agg(
        F.coalesce(F.sum(extra), F.lit(0)).alias("invalid"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    return one_check(row, rule, dataset)


def check_reference(
    df: DataFrame,
    dataset: str,
    rule: Rule,
    key: str,
    reference: DataFrame,
    reference_key: str,
    trim: bool = False,
    null_is_orphan: bool = False,
) -> DataFrame:
    """Rows whose key is missing from ``reference``.

    NULL keys are ignored, or count as orphans (anti-join reading) with
    ``null_is_orphan``.
    """
    def shown(c: str) -> Column:
        return parse.strip(F.col(c).cast("string")) if trim else F.col(c)

    counts = df.groupBy(shown(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    known = reference.select(shown(reference_key).alias("r")).where(F.col("r").isNotNull()).distinct()
    joined = counts.join(known, F.col("k") == F.col("r"), "left")
    orphan = F.col("r").isNull()
    if not null_is_orphan:
        orphan = orphan & F.col("k").isNotNull()
    row = joined.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("invalid"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
    )
    return one_check(row, rule, dataset)


def check_key_cover(
    df: DataFrame,
    dataset: str,
    key: str,
    other: DataFrame,
    other_key: str,
    forward: Rule,
    backward: Rule,
    forward_total: str = "rows",
) -> DataFrame:
    """Distinct keys of ``df`` absent from ``other``, and the other way round.

    ``forward_total`` is ``rows`` (all rows of the table) or ``keys``; the
    backward total is the number of distinct keys of ``other``. Both rules
    come from one full join of distinct keys.
    """
    a = df.groupBy(F.col(key).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    b = other.select(F.col(other_key).alias("b")).where(F.col("b").isNotNull()).distinct()
    both = a.join(b, F.col("a") == F.col("b"), "full")
    row = both.agg(
        F.count_if(F.col("a").isNotNull() & F.col("b").isNull()).alias("only_a"),
        F.count_if(F.col("a").isNull() & F.col("b").isNotNull()).alias("only_b"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("a").alias("keys"),
        F.count("b").alias("other_keys"),
    )
    cells = [
        _report_row(forward, dataset, F.col("only_a"), F.col(forward_total)),
        _report_row(backward, dataset, F.col("only_b"), F.col("other_keys")),
    ]
    return row.select(F.inline(F.array(*cells)))


# ---- many rules at once ------------------------------------------------------

@dataclass(frozen=True)
class _KeyUse:
    """A table's key as one ledger holds it."""

    df: DataFrame
    columns: tuple[str, ...]
    trim: bool = False
    hashed: bool = False  # the columns as a whole, NULLs equal

    def same(self, other: _KeyUse) -> bool:
        return self.df is other.df and (self.columns, self.trim, self.hashed) == (other.columns, other.trim, other.hashed)

    def type_name(self) -> str:
        return "string" if self.trim else self.df.schema[self.columns[0]].dataType.typeName()

    def image(self, whole_numbers: bool) -> Column:
        """The key as bytes: NULL for a NULL key, 128 bits for columns as a whole."""
        if self.hashed:
            mark = row_fingerprint(self.columns)
            return F.concat(*[F.unhex(F.lpad(F.hex(mark.getField(x)), 16, "0")) for x in ("a", "b")])
        text = F.col(self.columns[0]).cast("string")
        text = parse.strip(text) if self.trim else text
        if whole_numbers:  # '007' is 7 where the key it is compared with is a number; other text stays what it is
            text = F.coalesce(text.try_cast("bigint").cast("string"), text)
        return text.cast("binary")


class RuleBook:
    """Rules of several tables, counted together.

    Every table is read once for its row rules and once for all rules on keys.
    A key rule belongs to a ledger: the keys of the table it refers to (its own
    table for uniqueness). All tables hand their keys to all ledgers they occur
    in, as (ledger, key, place) rows, which are combined map-side into one row
    per ledger and key with a count for each place. Uniqueness, extra rows,
    references and covers are then sums over these rows: no join, one shuffle,
    and a hot key is one row however many rows have it.

    Keys are compared as text, and as whole numbers where text meets an integer
    column. Tables are told apart by being the same DataFrame object.
    """

    _INTEGERS = ("byte", "short", "integer", "long")

    def __init__(self) -> None:
        self._row_parts: list[DataFrame] = []
        self._ledgers: list[list[_KeyUse]] = []  # the first use names the ledger
        self._questions: list[tuple[str, Rule, Column, Column]] = []

    def _place(self, home: _KeyUse, use: _KeyUse) -> tuple[int, Column]:
        """Number of the ledger and the count of ``use`` in it."""
        at = next((i for i, uses in enumerate(self._ledgers) if uses[0].same(home)), None)
        if at is None:
            at = len(self._ledgers)
            self._ledgers.append([home])
        uses = self._ledgers[at]
        place = next((i for i, u in enumerate(uses) if u.same(use)), None)
        if place is None:
            place = len(uses)
            uses.append(use)
        return at, F.col(f"n{place}")

    def _ask(self, rule: Rule, dataset: str, ledger: int, invalid: Column, total: Column) -> None:
        here = F.col("ledger") == ledger
        self._questions.append((dataset, rule, F.when(here, invalid), F.when(here, total)))

    def rows(self, df: DataFrame, dataset: str, rules: Sequence[tuple[Rule, Column]]) -> None:
        """As ``check_rows``."""
        if rules:
            self._row_parts.append(check_rows(df, dataset, rules))

    def unique(self, df: DataFrame, dataset: str, rule: Rule, key: str) -> None:
        """As ``check_unique`` of one key."""
        use = _KeyUse(df, (key,))
        ledger, n = self._place(use, use)
        self._ask(rule, dataset, ledger, F.when(n > 1, n), n)

    def no_extra_rows(self, df: DataFrame, dataset: str, rule: Rule, keys: Sequence[str] | None = None) -> None:
        """As ``check_no_extra_rows``: a single key ignores its NULLs, several, or all columns, are compared as a whole."""
        use = _KeyUse(df, tuple(keys or df.columns), hashed=keys is None or len(keys) > 1)
        ledger, n = self._place(use, use)
        self._ask(rule, dataset, ledger, F.when(F.col("key").isNotNull() & (n > 1), n - 1), n)

    def reference(
        self, df: DataFrame, dataset: str, rule: Rule, key: str, reference: DataFrame, reference_key: str,
        trim: bool = False, null_is_orphan: bool = False,
    ) -> None:
        """As ``check_reference``."""
        home = _KeyUse(reference, (reference_key,), trim)
        ledger, known = self._place(home, home)
        _, n = self._place(home, _KeyUse(df, (key,), trim))
        orphan = F.when(F.col("key").isNull(), F.lit(null_is_orphan)).otherwise(known == 0)
        self._ask(rule, dataset, ledger, F.when(orphan, n), n)

    def cover(
        self, df: DataFrame, dataset: str, key: str, other: DataFrame, other_key: str, forward: Rule, backward: Rule,
        trim_other: bool = False,
    ) -> None:
        """As ``check_key_cover`` with totals of rows and of distinct keys of ``other``."""
        home = _KeyUse(other, (other_key,), trim_other)
        ledger, there = self._place(home, home)
        _, here = self._place(home, _KeyUse(df, (key,)))
        present = F.col("key").isNotNull()
        self._ask(forward, dataset, ledger, (present & (here > 0) & (there == 0)).cast("bigint"), here)
        self._ask(backward, dataset, ledger, (present & (here == 0) & (there > 0)).cast("bigint"),
                  (present & (there > 0)).cast("bigint"))

    def _keys(self) -> DataFrame:
        """(ledger, key, place) of every row of every table; a table is read once for all its keys."""
        tables: list[tuple[DataFrame, list[Column]]] = []
        for number, uses in enumerate(self._ledgers):
            kinds = {u.type_name() for u in uses if not u.hashed}
            whole = "string" in kinds and not kinds.isdisjoint(self._INTEGERS)
            for place, use in enumerate(uses):
                cell = F.struct(F.lit(number).alias("ledger"), use.image(whole).alias("key"), F.lit(place).alias("place"))
                held = next((cells for df, cells in tables if df is use.df), None)
                if held is None:
                    tables.append((use.df, [cell]))
                else:
                    held.append(cell)
        return combine([df.select(F.inline(F.array(*cells))) for df, cells in tables])

    def report(self) -> DataFrame:
        """One row per rule."""
        parts = list(self._row_parts)
        if self._questions:
            places = range(max(len(uses) for uses in self._ledgers))
            counts = self._keys().groupBy("ledger", "key").agg(
                *[F.count_if(F.col("place") == i).alias(f"n{i}") for i in places])
            sums, cells = [], []
            for i, (dataset, rule, invalid, total) in enumerate(self._questions):
                sums += [F.coalesce(F.sum(x), F.lit(0)).alias(f"{name}{i}") for name, x in (("bad", invalid), ("all", total))]
                cells.append(_report_row(rule, dataset, F.col(f"bad{i}"), F.col(f"all{i}")))
            parts.append(counts.agg(*sums).select(F.inline(F.array(*cells))))
        return combine(parts)


# ---- report -----------------------------------------------------------------

def combine(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def ordered_report(report: DataFrame) -> DataFrame:
    """FAIL first, then WARNING, then PASS; by dataset and rule within."""
    rank = F.when(F.col("status") == FAIL, 0).when(F.col("status") == WARNING, 1).otherwise(2)
    return report.orderBy(rank, "dataset_name", "rule_id")


def status_counts(report: DataFrame) -> DataFrame:
    """Rules per status; a status that did not occur shows 0."""
    aggs = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    cells = [F.struct(F.lit(s).alias("status"), F.col(s).alias("rule_count")) for s in STATUSES]
    return report.agg(*aggs).select(F.inline(F.array(*cells)))


class GateError(ValueError):
    """The quality gate stopped the run."""


GATE_COLUMNS = ("dataset_name", "rule_id", "rule_description", "status")


def failed_rules(report: DataFrame) -> DataFrame:
    return report.where(F.upper(F.trim("status")) == FAIL)


def gate(report: DataFrame, shown: int = 10) -> None:
    """Raise when any rule failed; warnings pass. Only up to ``shown`` report rows reach the driver."""
    missing = [c for c in GATE_COLUMNS if c not in report.columns]
    if missing:
        raise GateError(f"validation report lacks columns {missing}")
    failed = failed_rules(report)
    first = failed.orderBy("dataset_name", "rule_id").limit(shown).select("dataset_name", "rule_id").collect()
    if first:
        names = ", ".join(f"{r.dataset_name}/{r.rule_id}" for r in first)
        raise GateError(f"{failed.count()} validation rules failed; first: {names}")
