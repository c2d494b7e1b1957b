from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tillworks.functions import dates, keyed, text


def one(spark, value, kind, *columns):
    frame = spark.createDataFrame([(value,)], f"v {kind}")
    return tuple(frame.select(*columns).first())


@pytest.mark.parametrize(
    ("raw", "decimal", "digits"),
    [
        ("₹465", 465, 465),
        ("₹1,200", 1200, 1200),
        ("₹12,516.90", 12517, 1251690),
        ("₹807.50", 808, 80750),
        ("₹807.49", 807, 80749),
        ("", None, None),
        ("free", None, None),
        ("1.2.3", 1, 123),
        ("Rs.1,200", 1200, 1200),
        ("from 99 to 120", 99, 99120),
        ("₹123,456,789,012,345.5", 123456789012346, 1234567890123455),
        ("9" * 25, None, None),
        (None, None, None),
    ],
)
def test_price(spark, raw, decimal, digits):
    prices = text.clean_price(F.col("v")), text.clean_price(F.col("v"), "digits")
    assert one(spark, raw, "STRING", *prices) == (decimal, digits)


def test_prices_round_half_up_like_decimals(spark):
    cents = [c * 7919 % 10_000_019 for c in range(2000)] + [50, 149, 150, 250, 99_999_950]
    rows = [(f"₹{c // 100:,}.{c % 100:02d}", int((Decimal(c) / 100).quantize(Decimal(1), ROUND_HALF_UP))) for c in cents]
    frame = spark.createDataFrame(rows, "v STRING, whole BIGINT")
    assert frame.where(~text.clean_price(F.col("v")).eqNullSafe(F.col("whole"))).isEmpty()


def test_unknown_price_mode():
    with pytest.raises(ValueError):
        text.clean_price(F.col("v"), "cents")


@pytest.mark.parametrize(("raw", "rating"), [("4.3", 4.3), ("Get", None), ("", None), (None, None)])
def test_rating(spark, raw, rating):
    assert one(spark, raw, "STRING", text.clean_rating(F.col("v"))) == (rating,)


@pytest.mark.parametrize(("raw", "count"), [("8,442", 8442), ("450", 450), ("FREE", None), ("", None), (None, None)])
def test_count(spark, raw, count):
    assert one(spark, raw, "STRING", text.clean_count(F.col("v"))) == (count,)


def test_one_word_name_and_missing_fields(spark):
    name = F.col("v")
    email = text.email_address(name, F.lit(7), F.lit("Gmail.com"))
    packed = text.unpack_field(name, 0), text.unpack_field(name, 2)
    assert one(spark, "Prince", "STRING", text.first_word(name), email, *packed) == (
        "Prince", "Prince_7@Gmail.com", "Prince", None,
    )
    assert one(spark, None, "STRING", email) == (None,)


def test_packing_skips_missing_fields(spark):
    assert one(spark, None, "STRING", text.pack_fields(F.lit(3), F.col("v"), F.lit("Texas"))) == ("3 - Texas",)


def test_bad_timestamps_become_null(spark):
    parsed = dates.parse_timestamp(F.col("v"))
    assert one(spark, "2023-02-30 00:00:00", "STRING", parsed) == (None,)
    assert one(spark, "2023-02-03 04:05:06", "STRING", parsed) == (datetime(2023, 2, 3, 4, 5, 6),)


@pytest.mark.parametrize(
    ("moment", "quarter"),
    [(datetime(2023, m, 1), (m - 1) // 3 + 1) for m in range(1, 13)] + [(None, 4)],
)
def test_quarter(spark, moment, quarter):
    assert one(spark, moment, "TIMESTAMP_NTZ", dates.quarter_bucket(F.col("v"))) == (quarter,)


def test_ship_date_is_midnight_across_a_leap_day(spark):
    shipped = dates.ship_date(F.col("v"), F.lit(2))
    assert one(spark, datetime(2024, 2, 28, 23, 59), "TIMESTAMP_NTZ", shipped) == (datetime(2024, 3, 1),)


def test_calendar_names(spark):
    moment = F.col("v")
    names = dates.month_name(moment), dates.weekday_name(moment), dates.quarter_name(F.lit(3))
    assert one(spark, datetime(2023, 7, 3), "TIMESTAMP_NTZ", *names) == ("July", "Monday", "Q3")


def test_keyed_values_stay_in_range_and_repeat(spark):
    key = F.col("id")
    frame = spark.range(5000).select(
        "id",
        keyed.keyed_int(key, "n", 100, 500).alias("n"),
        keyed.keyed_pick(key, "g", ["a", "b", "c"]).alias("g"),
        keyed.keyed_weighted_pick(key, "w", {"x": 15, "y": 10, "z": 80, "u": 5}).alias("w"),
        keyed.keyed_timestamp(key, "t", datetime(2023, 1, 1), 86400).alias("t"),
        keyed.stable_uuid(key).alias("u"),
    )
    rows = frame.collect()
    assert {min(r.n for r in rows), max(r.n for r in rows)} == {100, 500}
    assert {r.g for r in rows} == {"a", "b", "c"}
    assert all(datetime(2023, 1, 1) <= r.t < datetime(2023, 1, 2) for r in rows)
    assert len({r.u for r in rows}) == 5000
    assert all([len(part) for part in r.u.split("-")] == [8, 4, 4, 4, 12] for r in rows)
    share = {w: sum(r.w == w for r in rows) / 5000 for w in "xyzu"}
    for choice, weight in {"x": 15, "y": 10, "z": 80, "u": 5}.items():
        assert abs(share[choice] - weight / 110) < 0.02
    assert sorted(rows) == sorted(frame.repartition(13, "g").collect())
