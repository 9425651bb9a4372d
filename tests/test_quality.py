"""Rules, gate, cleaning, audit, grain and duplicates on small fixtures."""

import pytest
from pyspark.sql import functions as F

from lodestay.operators import cleaning, duplicates, profiling, rules, summaries
from lodestay.operators.cleaning import ColumnPolicy, GrainError
from lodestay.operators.rules import Rule
from lodestay.plans import rulebook

RULE = Rule("R_001", "rule", "k")


def one(df):
    r = df.first()
    return r.invalid_count, r.total_rows, r.status


def test_unique_counts_all_rows_of_repeated_groups_nulls_equal(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert one(rules.check_unique(df, "t", RULE, ["k"])) == (4, 5, "FAIL")


def test_extra_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, None)], "k int, d string")
    assert one(rules.check_no_extra_rows(df, "t", RULE, ["k"])) == (3, 5, "FAIL")
    assert one(rules.check_no_extra_rows(df, "t", RULE, ["k", "d"])) == (2, 5, "FAIL")


def test_reference_rule_reads_null_two_ways(spark):
    df = spark.createDataFrame([("a ",), ("b",), (None,), ("z",)], "k string")
    ref = spark.createDataFrame([("a",), (" b",), (None,)], "r string")
    assert one(rules.check_reference(df, "t", RULE, "k", ref, "r", trim=True)) == (1, 4, "FAIL")
    assert one(rules.check_reference(df, "t", RULE, "k", ref, "r", trim=True, null_is_orphan=True)) == (2, 4, "FAIL")


def test_row_conditions(spark):
    df = spark.createDataFrame(
        [("91", "$-1.00", "2025-01", "X", "t", "5", "4"), ("-90", "$1.00", "2025-01-01", " A ", "maybe", "x", "4"),
         (None, None, None, None, None, None, None), ("north", "free", "bad", "A", "F", "1", "1")],
        "lat string, price string, day string, cat string, flag string, low string, high string",
    )
    report = rules.check_rows(df, "t", [
        (Rule("1", "", "lat"), rules.out_of_range("lat", -90, 90)),
        (Rule("2", "", "price"), rules.negative_currency("price")),
        (Rule("3", "", "price"), rules.unparseable_currency("price")),
        (Rule("4", "", "day"), rules.unparseable_date("day")),
        (Rule("5", "", "cat", rules.WARNING), rules.not_in_set("cat", ["A"])),
        (Rule("6", "", "flag"), rules.not_a_flag("flag")),
        (Rule("7", "", "low,high"), rules.wrong_order("low", "high")),
        (Rule("8", "", "cat", rules.INFO), F.col("cat") == "never"),
    ])
    got = {r.rule_id: (r.invalid_count, r.invalid_percentage, r.status) for r in report.collect()}
    assert got == {"1": (2, 50.0, "FAIL"), "2": (1, 25.0, "FAIL"), "3": (1, 25.0, "FAIL"), "4": (2, 50.0, "FAIL"),
                   "5": (1, 25.0, "WARNING"), "6": (2, 50.0, "FAIL"), "7": (1, 25.0, "FAIL"), "8": (0, 0.0, "PASS")}
    assert tuple(report.columns) == rules.REPORT_COLUMNS


def test_empty_table_passes_schema_rule(spark):
    df = spark.createDataFrame([], "a int")
    assert [r.status for r in rules.check_columns(df, "t", ["a", "b"], "S").collect()] == ["PASS", "PASS"]


def test_key_cover_both_ways(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (9,), (None,)], "k int")
    b = spark.createDataFrame([(1,), (2,), (3,), (3,), (4,)], "r int")
    rows = rules.check_key_cover(a, "t", "k", b, "r", Rule("F", "", "k"), Rule("B", "", "k", rules.WARNING)).collect()
    assert {r.rule_id: (r.invalid_count, r.total_rows, r.status) for r in rows} == {
        "F": (1, 5, "FAIL"), "B": (2, 4, "WARNING")}


def test_gate(spark):
    def report(*statuses):
        return spark.createDataFrame([("d", f"R{i}", "text", s) for i, s in enumerate(statuses)],
                                     "dataset_name string, rule_id string, rule_description string, status string")

    rules.gate(report("PASS", "WARNING"))
    with pytest.raises(rules.GateError, match="1 validation rules failed.*R1"):
        rules.gate(report("PASS", " fail "))
    with pytest.raises(rules.GateError, match="lacks columns"):
        rules.gate(report("PASS").drop("status"))
    counts = {r.status: r.rule_count for r in rules.status_counts(report("PASS", "PASS")).collect()}
    assert counts == {"PASS": 2, "WARNING": 0, "FAIL": 0}
    order = [r.status for r in rules.ordered_report(report("PASS", "WARNING", "FAIL")).collect()]
    assert order == ["FAIL", "WARNING", "PASS"]


def _ledger_tables(spark):
    items = spark.createDataFrame([("1", "A "), ("1", "B"), ("2", None), (None, "A"), (None, "C"), ("x", "  ")], "id string, area string")
    areas = spark.createDataFrame([(" A",), ("B",), ("B",), ("D",), (None,)], "area string")
    facts = spark.createDataFrame([(1, "d"), (1, "d"), (7, "d"), (None, None), (None, None), (2, "e")], "item bigint, day string")
    return items, areas, facts


def test_rule_book_counts_as_the_single_checks_do(spark):
    items, areas, facts = _ledger_tables(spark)
    rule = [rules.Rule(f"R{i}", "", "") for i in range(9)]
    book = rules.RuleBook()
    book.unique(items, "d", rule[0], "id")
    book.no_extra_rows(items, "d", rule[1], ["id"])
    book.no_extra_rows(facts, "d", rule[2], ["item", "day"])
    book.reference(items, "d", rule[3], "area", areas, "area", trim=True)
    book.reference(items, "d", rule[4], "area", areas, "area", null_is_orphan=True)
    book.cover(items, "d", "area", areas, "area", rule[5], rule[6])
    book.no_extra_rows(facts, "d", rule[7])
    single = rules.combine([
        rules.check_unique(items, "d", rule[0], ["id"]),
        rules.check_no_extra_rows(items, "d", rule[1], ["id"]),
        rules.check_no_extra_rows(facts, "d", rule[2], ["item", "day"]),
        rules.check_reference(items, "d", rule[3], "area", areas, "area", trim=True),
        rules.check_reference(items, "d", rule[4], "area", areas, "area", null_is_orphan=True),
        rules.check_key_cover(items, "d", "area", areas, "area", rule[5], rule[6]),
        rules.check_no_extra_rows(facts, "d", rule[7], facts.columns),
    ])
    assert sorted(book.report().collect()) == sorted(single.collect())


def test_rule_book_compares_text_with_whole_numbers(spark):
    items = spark.createDataFrame([("1",), ("007",), ("x",), (None,)], "id string")
    facts = _ledger_tables(spark)[2]
    book = rules.RuleBook()
    book.reference(facts, "d", rules.Rule("A", "", ""), "item", items, "id")
    book.reference(items, "d", rules.Rule("B", "", ""), "id", facts, "item", null_is_orphan=True)
    got = {r.rule_id: (r.invalid_count, r.total_rows) for r in book.report().collect()}
    assert got == {"A": (1, 6), "B": (2, 4)}  # 2 is no item; x and NULL are no facts


def test_rule_book_of_empty_tables_passes(spark):
    items, areas, _ = (t.limit(0) for t in _ledger_tables(spark))
    book = rules.RuleBook()
    book.unique(items, "d", rules.Rule("A", "", ""), "id")
    book.cover(items, "d", "area", areas, "area", rules.Rule("B", "", ""), rules.Rule("C", "", ""))
    assert {(r.rule_id, r.invalid_count, r.total_rows, r.status) for r in book.report().collect()} == {
        ("A", 0, 0, "PASS"), ("B", 0, 0, "PASS"), ("C", 0, 0, "PASS")}


def test_full_report_reads_each_table_twice(spark, tmp_path):
    """Once for the row rules, once for all keys."""
    tables = {}
    for name, required in rulebook.REQUIRED.items():
        path = str(tmp_path / name)
        spark.createDataFrame([tuple("1" for _ in required)], ", ".join(f"{c} string" for c in required)).write.parquet(path)
        tables[name] = spark.read.parquet(path)
    plan = rulebook.full_report(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2 * len(tables)


def test_area_rules_do_not_count_missing_geometry_twice(spark):
    features = spark.createDataFrame([("A", "Polygon", True), ("B", None, False), ("B", "Point", True), (None, None, True)],
                                     "neighbourhood string, geometry_type string, has_geometry boolean")
    areas = spark.createDataFrame([("A ",), ("C",)], "neighbourhood string")
    got = {r.rule_id: r.invalid_count for r in rulebook.area_rules(features, areas).collect()}
    assert got == {"GJ_001": 1, "GJ_002": 2, "GJ_003": 1, "GJ_004": 1, "GJ_005": 1, "GJ_006": 2}


POLICY = ColumnPolicy(key="id", price="price", dates=("day",), categories=("room",), booleans=("flag",), percents=("rate",),
                      integers=("id", "beds", "empty"), floats=("score",))


def dirty(spark):
    return spark.createDataFrame(
        [("101", "$1,250.00", "2025-01-15", " A ", "t", "95%", "2", None, "1.5", "  "),
         ("102", None, "not-a-valid-date", "A", "unknown-value", "N/A", "2.5", None, "x", "note"),
         ("103", "n/a", None, None, None, None, "3", None, None, None)],
        "id string, price string, day string, room string, flag string, rate string, beds string, empty string, "
        "score string, text string",
    )


def test_clean_and_audit(spark):
    df = dirty(spark)
    assert cleaning.fractional_columns(df, POLICY) == {"beds", "empty"}
    policy = POLICY  # decides by itself
    out = cleaning.clean(df, policy)
    assert out.columns == ["id", "price_raw", "price", "day", "room", "flag", "rate", "beds", "empty", "score", "text"]
    types = dict(out.dtypes)
    assert (types["id"], types["beds"], types["empty"], types["day"]) == ("bigint", "double", "double", "date")
    first, second, third = out.orderBy("id").collect()
    assert (first.price_raw, first.price, first.room, first.flag, first.rate, first.text) == (
        "$1,250.00", 1250.0, "A", True, 95.0, None)
    assert (second.price, second.day, second.flag, second.rate, second.beds, second.score) == (None, None, None, None, 2.5, None)
    assert (third.price_raw, third.price) == ("n/a", None)
    log = {(r.column_name, r.action): r.affected_rows for r in cleaning.audit(df, policy, "f.csv").collect()}
    assert log[("price", "currency_to_numeric")] == 1 and log[("price", "unparseable_price_to_null")] == 1
    assert log[("day", "parse_datetime")] == 1 and log[("day", "invalid_date_to_nat")] == 1
    assert log[("room", "trim_category_whitespace")] == 1
    assert log[("flag", "normalize_boolean")] == 1 and log[("flag", "unknown_boolean_to_null")] == 1
    assert log[("rate", "unparseable_percentage_to_null")] == 1
    assert log[("text", "blank_string_to_null")] == 1 and log[("empty", "convert_numeric")] == 0
    assert ("id", "unparseable_numeric_to_null") not in log
    assert log[("*", "column_count_report")] == 1


@pytest.mark.parametrize("ids, message", [([101, 101, 103], "duplicate listing-ID"), ([101, None, 103], "null listing IDs")])
def test_grain_errors(spark, ids, message):
    df = spark.createDataFrame([(i,) for i in ids], "id int")
    with pytest.raises(GrainError, match=message):
        cleaning.require_grain(df, "t", "id", 3)


def test_grain_ok_and_other_errors(spark):
    df = spark.createDataFrame([(101,), (102,), (103,)], "id int")
    cleaning.require_grain(df, "t", "id", 3)
    with pytest.raises(GrainError, match="expected 4 rows"):
        cleaning.require_grain(df, "t", "id", 4)
    with pytest.raises(GrainError, match="is missing"):
        cleaning.require_grain(df, "t", "key")


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, "b"), (2, None), (None, "2")], "k int, t string")
    for found in (duplicates.duplicate_rows_exact(df), duplicates.duplicate_rows_hashed(df)):
        row = found.first()
        assert (row.row_count, row.duplicate_count, row.duplicate_percentage) == (6, 2, 33.3333)
    row = duplicates.duplicate_groups(df, ["k"]).first()
    assert (row.duplicate_groups, row.rows_in_groups, row.extra_rows) == (2, 5, 3)
    top = duplicates.top_duplicate_groups(df, ["k"], 1).collect()
    assert [(r.k, r.row_count) for r in top] == [(None, 3)]


def test_profile(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, 2.0), (3, "a", None)], "id int, comments string, x double")
    got = {r.column_name: r for r in profiling.column_profile(df, "t").collect()}
    assert (got["id"].missing_count, got["id"].unique_count, got["id"].minimum, got["id"].maximum) == (0, 3, "1", "3")
    assert got["comments"].unique_count is None and got["comments"].profile_note == profiling.SKIPPED_NOTE
    assert (got["x"].missing_percentage, got["x"].unique_count) == (33.3333, 1)
    keys = {r.column_name: r.is_candidate_key for r in profiling.candidate_keys(profiling.column_profile(df, "t")).collect()}
    assert keys["id"] and not keys["x"]
    empty = profiling.column_profile(df.limit(0), "t").where("column_name = 'id'").first()
    assert (empty.missing_percentage, empty.minimum) == (0.0, None)
    lines = profiling.joined_samples(profiling.sample_values(df, ["id", "comments"])).collect()
    assert {r.column_name: r.sample_values for r in lines} == {"id": "1 | 2 | 3", "comments": "a"}


def test_fractions_are_kept_by_default(spark):
    df = spark.createDataFrame([("1", "2.5"), ("2", "3"), ("12345678901234567", "x")], "id string, beds string")
    policy = cleaning.ColumnPolicy(key="id", integers=("id", "beds"))
    out = cleaning.clean(df, policy)
    assert dict(out.dtypes) == {"id": "bigint", "beds": "double"}
    assert {r.id: r.beds for r in out.collect()} == {1: 2.5, 2: 3.0, 12345678901234567: None}
    log = {(r.column_name, r.action): (r.affected_rows, r.notes) for r in cleaning.audit(df, policy, "f").collect()}
    assert log["beds", "convert_numeric"][0] == 2 and "Float64" in log["beds", "convert_numeric"][1]
    assert log["beds", "unparseable_numeric_to_null"][0] == 1 and "Int64" in log["id", "convert_numeric"][1]


def test_examples_leave_out_keys_with_null(spark):
    from lodestay.operators.reconciliation import group_examples

    rows = [(None, i) for i in range(9)] + [("a", 1), ("a", 2), ("b", 3)]
    got = group_examples(spark.createDataFrame(rows, "k string, v int"), ["k"], ["v"], groups=1).collect()
    assert sorted((r.k, r.v, r.group_size) for r in got) == [("a", 1, 2), ("a", 2, 2)]


def test_json_duplicates_at_every_depth(spark):
    rows = [
        ('{"type":"Feature","properties":{"a":1,"b":{"x":[1,2],"y":null}}}',),
        ('{"properties":{"b":{"y":null,"x":[1, 2]},"a":1}, "type":"Feature"}',),
        ('{"type":"Feature","properties":{"a":1,"b":{"x":[2,1],"y":null}}}',), ("not json",), ("not json",), (None,),
        ('"not json"',)]
    row = profiling.canonical_json_duplicates(spark.createDataFrame(rows, "j string"), "j").first()
    assert (row.row_count, row.duplicate_count) == (7, 2)


def test_profile_of_ninety_columns_is_one_scan(spark, tmp_path):
    import datetime as dt
    from decimal import Decimal

    rows = [(1, 1.5, Decimal("2.50"), dt.date(2025, 1, 2), dt.datetime(2025, 1, 2, 3, 4, 5, 6), True, "x", "long text"),
            (2, None, Decimal("-2.50"), dt.date(1969, 1, 2), dt.datetime(1960, 1, 2, 3, 4, 5), False, "x", "long text"),
            (2, -1.5, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, m decimal(9,2), t date, s timestamp, f boolean, c string, comments string")
    wide = df.select("*", *[F.col("i").alias(f"i{k}") for k in range(82)])
    path = str(tmp_path / "wide")
    wide.write.parquet(path)
    out = profiling.column_profile(spark.read.parquet(path), "wide")
    got = {r.column_name: r for r in out.collect()}
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and len(got) == 90
    assert [(got[c].missing_count, got[c].unique_count, got[c].minimum, got[c].maximum) for c in ("i", "d", "m", "t", "s", "f", "c", "comments", "i81")] == [
        (0, 2, "1", "2"), (1, 2, "-1.5", "1.5"), (1, 2, "-2.50", "2.50"), (1, 2, "1969-01-02", "2025-01-02"),
        (1, 2, "1960-01-02 03:04:05", "2025-01-02 03:04:05.000006"), (1, 2, None, None), (1, 1, None, None), (1, None, None, None), (0, 2, "1", "2")]
    empty = profiling.column_profile(df.limit(0), "none").collect()
    assert {(r.row_count, r.missing_count, r.unique_count) for r in empty} == {(0, 0, 0), (0, 0, None)}
    rough = {r.column_name: r.unique_count for r in profiling.column_profile(df, "rough", approximate=True).collect()}
    assert rough["i"] == 2 and rough["comments"] is None


def test_surrogate_keys_are_dense_without_one_task(spark):
    names = [f"n{(k * 7919) % 1000:04d}" for k in range(1000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    out = summaries.surrogate_key(df, "name", "key")
    assert [(r.name, r.key) for r in out.orderBy("key").collect()] == [(n, i) for i, n in enumerate([None, *sorted(names[:-1])], 1)]
    assert summaries.surrogate_key(df.limit(0), "name", "key").count() == 0
