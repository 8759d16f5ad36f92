"""Exact arithmetic on money, time and dates."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from comparing import rows
from parcelhouse.functions.columns import day_key, quotient, ratio


@pytest.mark.parametrize("part,whole,places,expected", [
    ("100249.99", "50000", 2, "2.00"),           # 2.0049998: six places first would give 2.01
    ("100250.00", "50000", 2, "2.01"),           # 2.005 exactly, away from zero
    ("-100250.00", "50000", 2, "-2.01"),
    ("2196.00", "4882256.07", 4, "0.0004"),      # 0.00044979
    ("1", "3", 6, "0.333333"),
    ("600000000000000000.01", "600000000000", 2, "1000000.00"),
    (None, "3", 2, None),
])
def test_quotient_rounds_once(spark, part, whole, places, expected):
    # Operands as wide as sums of sums are.
    one = spark.range(1).select(
        F.lit(part).cast("decimal(38,2)").alias("a"), F.lit(whole).cast("decimal(38,2)").alias("b"))
    got = one.select(quotient(F.col("a"), F.col("b"), places, f"decimal(18,{places})"))
    assert rows(got) == {(None if expected is None else Decimal(expected),)}


def test_ratio_of_nothing_is_null(spark):
    counts = spark.range(1).select(F.lit(0).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b"))
    assert rows(counts.select(ratio(F.col("a"), F.col("b")))) == {(None,)}


@pytest.mark.parametrize("moment,key", [
    ("2018-01-02 00:00:00", 20180102), ("2016-12-31 23:59:59.999999", 20161231), (None, None)])
def test_day_key(spark, moment, key):
    df = spark.range(1).select(F.lit(moment).cast("timestamp_ntz").alias("m"))
    assert rows(df.select(day_key("m"))) == {(key,)}
