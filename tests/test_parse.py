"""Parsing rules: known inputs, dirty inputs, and the spellings that must not parse."""

import datetime as dt

import pytest

from lodestay.functions import parse

DAY = dt.date(2025, 1, 15)


def column(spark, builder, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", builder("v").alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize("builder, pairs", [
    (parse.currency, [("$1,250.00", 1250.0), ("$99.50", 99.5), ("$0.00", 0.0), (None, None), ("n/a", None), ("  ", None),
                      ("-$5.00", -5.0)]),
    (parse.percent, [("95%", 95.0), (" 7 % ", 7.0), ("N/A", None), (None, None)]),
    (parse.boolean, [("t", True), ("f", False), ("true", True), ("false", False), ("YES", True), (" no ", False),
                     ("1", True), ("0", False), (None, None), ("unknown-value", None)]),
    (parse.date, [("2025-01-15", DAY), ("2025-01-15 10:30:00", DAY), ("2025-01", None), ("not-a-valid-date", None),
                  ("2025-02-30", None), (None, None), ("2025-01-15x", None)]),
    (parse.number, [("12", 12.0), ("1e3", 1000.0), (".5", 0.5), ("1.5d", None), ("inf", None), ("nan", None),
                    ("1e999", None), ("\t7\n", 7.0), ("", None)]),
    (parse.whole_number, [("12", 12), ("12.0", 12), ("12.5", None), ("9007199254740993", 9007199254740993),
                          ("1e3", 1000), ("99999999999999999999", None), ("x", None)]),
    (parse.blank_to_null, [("  \t", None), (" a ", " a "), ("", None), (None, None)]),
    (parse.strip, [("\t a b  ", "a b"), (None, None)]),
    (parse.missing_token_to_null, [("N/A", None), ("null", None), ("Nation", "Nation"), (None, None)]),
    (parse.yes_no_label, [("T", "Yes"), ("0", "No"), (None, "Missing"), ("maybe", "maybe")]),
    (parse.one_line, [("a\r\n  b\tc", "a b c"), ("x" * 120, "x" * 120), ("x" * 121, "x" * 117 + "...")]),
])
def test_builder(spark, builder, pairs):
    assert column(spark, builder, [p[0] for p in pairs]) == [p[1] for p in pairs]


def test_fingerprint_keeps_null_positions(spark):
    from pyspark.sql import functions as F

    from lodestay.functions.numeric import row_fingerprint

    df = spark.createDataFrame([(None, "a"), ("a", None), (None, "a")], "x string, y string")
    assert df.select(row_fingerprint(["x", "y"]).alias("k")).agg(F.count_distinct("k")).first()[0] == 2


def test_rounding_follows_the_stored_double(spark):
    from pyspark.sql import functions as F

    from lodestay.functions.numeric import ratio, rounded

    row = spark.range(1).select(
        rounded(F.lit(274564.975), 2).alias("a"), rounded(F.lit(0.125), 2).alias("b"), rounded(F.lit(-0.125), 2).alias("c"),
        ratio(F.lit(200), F.lit(0)).alias("z"), ratio(F.lit(None).cast("double"), F.lit(2)).alias("n"),
    ).first()
    assert (row.a, row.b, row.c, row.z, row.n) == (274564.97, 0.13, -0.13, None, None)
