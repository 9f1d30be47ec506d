"""Scalar rules on literal frames (edge cases of the cleansing/mart rules)."""

import datetime as dt

from pyspark.sql import functions as F

from carelake.functions import (amount_or_zero, calendar_years, completed_years, flag,
                                in_year, tiered, tokenize, trim_or_default, valid_on)


def test_trim_spaces_only_and_defaults(spark):
    df = spark.createDataFrame([("  Ann ",), (None,), ("",), ("\tBo\t",)], "n string")
    got = [r[0] for r in df.select(trim_or_default("n", "UNKNOWN")).collect()]
    assert got == ["Ann", "UNKNOWN", "", "\tBo\t"]


def test_null_and_empty_mrn_share_token(spark):
    df = spark.createDataFrame([(None,), ("",), ("M1",)], "m string")
    a, b, c = [r[0] for r in df.select(tokenize("m")).collect()]
    assert a == b != c
    assert a == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def test_two_age_definitions_differ_before_birthday(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 6, 14), dt.date(1960, 6, 15)),
                                (dt.datetime(2000, 6, 15), dt.date(1960, 6, 15)),
                                (dt.datetime(2001, 2, 28), dt.date(1960, 2, 29)),
                                (dt.datetime(2000, 2, 28), dt.date(1960, 2, 29))],
                               "ts timestamp_ntz, b date")
    rows = df.select(completed_years("ts", "b").alias("c"),
                     calendar_years("ts", "b").alias("y")).collect()
    assert [(r.c, r.y) for r in rows] == [(39, 40), (40, 40), (41, 41), (39, 40)]


def test_high_cost_is_strict(spark):
    df = spark.createDataFrame([("10000.00",), ("10000.01",), (None,)], "a string")
    amt = F.col("a").cast("decimal(12,2)")
    got = [r[0] for r in df.select(flag(amt > F.lit("10000").cast("decimal(20,2)"))).collect()]
    assert got == ["N", "Y", "N"]


def test_gap_tiers_boundaries_and_null(spark):
    df = spark.createDataFrame([(180,), (181,), (365,), (366,), (None,)], "d int")
    got = [r[0] for r in df.select(tiered("d", [(365, "HIGH"), (180, "MEDIUM")], "LOW"))
           .collect()]
    assert got == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "LOW"]


def test_validity_inclusive_both_ends(spark):
    today = dt.date(2024, 6, 30)
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None), (dt.date(2024, 1, 1), today),
                                (dt.date(2024, 1, 1), dt.date(2024, 6, 29)),
                                (today, None), (dt.date(2024, 7, 1), None)],
                               "e date, x date")
    got = [r[0] for r in df.select(valid_on("e", "x", today)).collect()]
    assert got == [True, True, False, True, False]


def test_year_filter_is_half_open_range(spark):
    df = spark.createDataFrame([(dt.datetime(1999, 12, 31, 23, 59),), (dt.datetime(2000, 1, 1),),
                                (dt.datetime(2000, 12, 31, 23, 59, 59),),
                                (dt.datetime(2001, 1, 1),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(in_year("ts", 2000)).collect()] == [False, True, True, False]


def test_amount_default_stays_decimal(spark):
    df = spark.createDataFrame([(None,), ("1.005",)], "a string")
    out = df.select(amount_or_zero(F.col("a").cast("decimal(12,3)")).alias("v"))
    assert out.schema["v"].dataType.simpleString() == "decimal(12,2)"
    assert [str(r.v) for r in out.collect()] == ["0.00", "1.01"]
