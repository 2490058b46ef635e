from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lectern.functions import (
    band,
    iso_date,
    label,
    mask_name,
    mask_phone,
    money,
    rate,
    round_score,
    whole_number,
)
from lectern.functions.columns import OTHER_PLATFORM, PLATFORMS


def one(spark, function, value, *args):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(function(F.col("v"), *args)).first()[0]


@pytest.mark.parametrize("value, want", [("王五", "王XX"), ("a", "aXX"), ("", ""), (None, None)])
def test_mask_name(spark, value, want):
    assert one(spark, mask_name, value) == want


@pytest.mark.parametrize(
    "value, variant, want",
    [
        ("13712345678", "eleven", "137*****5678"),
        ("13712345678", "tail", "137*****678"),
        ("137123", "eleven", "137*****"),
        (None, "eleven", None),
        (None, "tail", None),
    ],
)
def test_mask_phone(spark, value, variant, want):
    assert one(spark, mask_phone, value, variant) == want


@pytest.mark.parametrize(
    "value, want",
    [("1", "PC"), ("2", "Mobile"), ("3", "App"), ("4", "WeChat"), ("9", "other"), (None, "other")],
)
def test_platform(spark, value, want):
    assert one(spark, label, value, PLATFORMS, OTHER_PLATFORM) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("12", 12), (" 7 ", 7), ("-3", -3), ("12.7", 12), ("x", 0), ("", 0), (None, 0),
        ("99999999999", 99999999999), ("-1e30", None), ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", None), ("NaN", 0), ("1e3", 1000), ("-2147483648", -(2**31)),
    ],
)
def test_whole_number(spark, value, want):
    assert one(spark, lambda _: whole_number("v"), value) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("83.85", "83.9"), ("83.86880766562163", "83.9"), ("0.25", "0.3"), ("0.35", "0.4"),
        ("59.95", "60.0"), ("0.04999999999", "0.0"), ("-0.25", "-0.3"), ("x", None), (None, None),
    ],
)
def test_round_score(spark, value, want):
    assert one(spark, round_score, value) == (None if want is None else Decimal(want))


def test_money(spark):
    assert one(spark, money, "12.34567") == Decimal("12.3457")
    assert one(spark, money, "1234567890.5") == Decimal("1234567890.5")
    assert one(spark, money, "abc") is None


@pytest.mark.parametrize(
    "value, want",
    [
        ("0", "0-20"), ("20", "0-20"), ("20.1", "20-40"), ("40", "20-40"), ("59.5", "40-60"),
        ("60", "40-60"), ("80", "60-80"), ("100", "80-100"), ("100.1", None), ("-1", None),
        (None, None),
    ],
)
def test_band(spark, value, want):
    assert one(spark, lambda c: band(c.cast("decimal(5,1)")), value) == want


def test_iso_date(spark):
    assert one(spark, iso_date, "20190722") == "2019-07-22"


def test_rate(spark):
    df = spark.createDataFrame([(1, 8), (29, 200), (0, 3), (0, 0)], "a int, b int")
    got = [r[0] for r in df.select(rate(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("0.13"), Decimal("0.15"), Decimal("0.00"), None]
