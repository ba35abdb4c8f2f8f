from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortline.functions import numbers, text, times


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first()["c"]


def ts(text_value):
    return F.lit(text_value).cast("timestamp")


def test_extract_or_null(spark):
    c = F.lit("abc-12")
    assert one(spark, text.extract_or_null(c, r"-(\d+)")) == "12"
    assert one(spark, text.extract_or_null(c, r"x(\d+)")) is None
    assert one(spark, text.extract_or_null(F.lit(None).cast("string"), r"x")) is None


@pytest.mark.parametrize("value, expected", [
    (2.5, 3), (-2.5, -3), (0.5, 1), (2.4, 2), (None, None),
])
def test_to_int64_rounds_half_away_from_zero(spark, value, expected):
    assert one(spark, numbers.to_int64(F.lit(value).cast("double"))) == expected


@pytest.mark.parametrize("value, expected", [
    ("0.29", "0.29"), ("1.999", "1.99"), ("-1.999", "-1.99"), ("64.8", "64.80"),
])
def test_trunc2_cuts_towards_zero(spark, value, expected):
    assert one(spark, numbers.trunc2(F.lit(value).cast("decimal(18,6)"))) == Decimal(expected)


def test_monthly_price(spark):
    assert one(spark, numbers.monthly_price(F.lit(1.0))) == Decimal("64.80")
    assert one(spark, numbers.monthly_price(F.lit(0.29))) == Decimal("18.79")


def test_elapsed_counts_whole_units_and_months_count_boundaries(spark):
    assert one(spark, times.elapsed("hour", ts("2020-01-01 00:59:00"), ts("2020-01-01 02:01:00"))) == 1
    assert one(spark, times.month_gap(ts("2020-01-31 00:00:00"), ts("2020-02-01 00:00:00"))) == 1
    assert one(spark, times.month_gap(ts("2020-03-01 00:00:00"), ts("2020-01-31 00:00:00"))) == -2


@pytest.mark.parametrize("life, expected", [("01:59:59", False), ("02:00:00", True)])
def test_lasted_two_hours(spark, life, expected):
    assert one(spark, times.lasted(ts("2020-01-01 00:00:00"), ts(f"2020-01-01 {life}"), "2 HOURS")) is expected


@pytest.mark.parametrize("at, after, from_, before", [
    # position of the day: 2020-01-01 is 18262
    ("2020-01-01 12:00:00", 18262, 18262, 18261),
    ("2020-01-01 23:59:58.999999", 18262, 18262, 18261),
    ("2020-01-01 23:59:59", 18263, 18262, 18261),
    ("2020-01-01 23:59:59.5", 18263, 18263, 18262),
    ("2020-01-02 00:00:00", 18263, 18263, 18262),
])
def test_period_end_bounds(spark, at, after, from_, before):
    assert one(spark, times.first_end_after("day", ts(at))) == after
    assert one(spark, times.first_end_after("day", ts(at), inclusive=True)) == from_
    assert one(spark, times.last_end_before("day", ts(at))) == before


def test_last_closed_position():
    month = lambda y, m: y * 12 + m - 1
    assert times.last_closed_position("month", "2001-09-01 00:00:00") == month(2001, 7)
    assert times.last_closed_position("month", "2001-09-01 00:00:01") == month(2001, 8)
    days = (date(2001, 8, 31) - date(1970, 1, 1)).days
    assert times.last_closed_position("day", "2001-09-01 00:00:00") == days - 1
    assert times.last_closed_position("day", datetime(2001, 9, 1, 1)) == days


def test_asset_id_from_url(spark):
    url = "https://x.example/#databases/abcd1234/created"
    assert one(spark, text.asset_id_from_url(F.lit(url), "created")) == "abcd1234"
    assert one(spark, text.asset_id_from_url(F.lit(url), "detail")) is None
    assert one(spark, text.asset_id_from_url(F.lit("https://x.example/#databases/abcd1234/detail"), "detail")) == "abcd1234"
    assert one(spark, text.asset_id_from_url(F.lit("http://x/created"), "created")) is None
