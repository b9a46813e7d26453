"""Edge rows of the column functions."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from orderstream import functions as fn


def apply(spark, kind, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [row[0] for row in rows.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "line", [None, ",", ",,,", " , ", "\t,\n", "\x00,\x1f", "\r\n,,\r\n"]
)
def test_unusable_lines(spark, line):
    assert apply(spark, "STRING", [line], fn.is_usable(F.col("v"))) == [False]


@pytest.mark.parametrize(
    "line", ["", " ", ", ,", ",a", "a,,", "{bad", " ,", "a\n,", ",\na,"]
)
def test_usable_lines(spark, line):
    assert apply(spark, "STRING", [line], fn.is_usable(F.col("v"))) == [True]


def test_ipv4_text(spark):
    numbers = [607649792, -1950089216, -564133889, 0, -1, 2147483647, None]
    assert apply(spark, "INT", numbers, fn.ipv4_text(F.col("v"))) == [
        "36.56.0.0", "139.196.0.0", "222.95.255.255", "0.0.0.0", "255.255.255.255",
        "127.255.255.255", None,
    ]
    assert apply(spark, "BIGINT", [3730833407], fn.ipv4_text(F.col("v"))) == ["222.95.255.255"]


def test_ipv4_number(spark):
    good = {"1.2.3.4": 16909060, "222.95.255.255": 3730833407, "0.0.0.0": 0,
            "255.255.255.255": 4294967295, "001.2.3.004": 16909060}
    assert apply(spark, "STRING", list(good), fn.ipv4_number(F.col("v"))) == list(good.values())
    bad = ["1.2.3", "999.1.1.1", "1.1.1.256", "a.b.c.d", "", None, "1.2.3.4.5", " 1.2.3.4",
           "1.2.3.4 ", "1.2.3.4\n", "1..2.3", "+1.2.3.4", "-1.2.3.4", "1.2.3.4e1", "1,2,3,4"]
    assert apply(spark, "STRING", bad, fn.ipv4_number(F.col("v"))) == [None] * len(bad)


def test_ipv4_round_trip(spark):
    numbers = [0, 1, 255, 256, 65535, 65536, 16777215, 16777216, 2147483648, 4294967295]
    assert apply(spark, "BIGINT", numbers, fn.ipv4_number(fn.ipv4_text(F.col("v")))) == numbers


@pytest.mark.parametrize(
    ("region", "province", "city"),
    [
        ("中国|0|海南省|海口市|教育网", "海南省", "海口市"),
        ("a|b|c|d|", "c", "d"),
        ("a|b|||e", "", ""),
        ("0|0|0|0|0", "0", "0"),
        ("a|b|c|d", None, None),
        ("a|b|c|d|e|f", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_region_fields(spark, region, province, city):
    assert apply(spark, "STRING", [region], fn.region_province(F.col("v"))) == [province]
    assert apply(spark, "STRING", [region], fn.region_city(F.col("v"))) == [city]


def test_times(spark):
    moment = [1730910796670, None]
    assert apply(spark, "BIGINT", moment, fn.order_time(F.col("v"))) == ["2024-11-0616:33:16.670", None]
    assert apply(spark, "BIGINT", moment, fn.order_time(F.col("v"), "yyyyMMddHHmmssSSS")) == [
        "20241106163316670", None,
    ]
    texts = ["2024-11-0616:33:16.670", "2024-11-06 16:33:16.670", "", None]
    assert apply(spark, "STRING", texts, fn.order_timestamp(F.col("v")).cast("timestamp_ntz")) == [
        datetime.datetime(2024, 11, 6, 16, 33, 16, 670000), None, None, None,
    ]


def test_order_and_user_ids(spark):
    numbers = [1, 999999, 1000000, None]
    ids = apply(spark, "BIGINT", numbers, fn.order_id(F.lit(1730910796670), F.col("v")))
    assert ids == ["20241106163316670000001", "20241106163316670999999", "202411061633166701000000", None]
    users = apply(spark, "BIGINT", [7, 123456789, None], fn.user_id(F.lit(3), F.col("v")))
    assert users == ["300000007", "3123456789", None]


def test_money_text(spark):
    assert apply(spark, "BIGINT", [0, 7, 99, None], fn.money_text(F.lit(5), F.col("v"))) == [
        "5.00", "5.07", "5.99", None,
    ]


def test_status_label(spark):
    codes = ["0", "1", "2", "3", "4", "x", None]
    assert apply(spark, "STRING", codes, fn.status_label(F.col("v"))) == [
        "open", "cancelled", "closed", "finished", None, None, None,
    ]
