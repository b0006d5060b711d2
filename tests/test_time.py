import datetime as dt

import pytest
from pyspark.sql import functions as F

from dockflow.functions import days, numeric, timefn
from dockflow.sources.calendars import break_ranges, holiday_dates

D, T = dt.date, dt.datetime


def one(spark, value, column, schema="t timestamp_ntz"):
    return spark.createDataFrame([(value,)], schema).select(column).first()[0]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_hour_floor_ignores_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, T(2024, 3, 10, 2, 59, 59, 999999), timefn.hour_floor(F.col("t"))) == T(2024, 3, 10, 2)
        assert one(spark, 1710037800, timefn.epoch_to_ts(F.col("t")), "t bigint") == T(2024, 3, 10, 2, 30)
        assert one(spark, "2024031002", timefn.parse_hour_stamp(F.col("t")), "t string") == T(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_clock_changes(spark):
    to_local = lambda t: one(spark, t, timefn.utc_to_local(F.col("t")))
    to_utc = lambda t: one(spark, t, timefn.local_to_utc(F.col("t")))
    assert to_local(T(2025, 3, 30, 0, 30)) == T(2025, 3, 30, 1, 30)
    assert to_local(T(2025, 3, 30, 1, 30)) == T(2025, 3, 30, 3, 30)
    assert to_utc(T(2025, 3, 30, 2, 30)) == T(2025, 3, 30, 1, 30)
    assert to_utc(T(2025, 10, 26, 2, 30)) == T(2025, 10, 26, 0, 30)


def test_special_days(spark):
    rows = [(D(2024, 5, d),) for d in range(6, 14)]
    df = spark.createDataFrame(rows, "date date")
    hol = holiday_dates(spark, [D(2024, 5, 8), D(2024, 5, 9)])
    out = {r.date.day: (r.holiday, r.preholiday, r.postholiday, r.pont) for r in days.special_days(df, hol).collect()}
    assert out[6] == (0, 0, 0, 0)
    assert out[7] == (0, 1, 0, 0)
    assert out[8] == out[9] == (1, 0, 0, 0)
    assert out[10] == (0, 0, 1, 1)
    assert out[11] == (0, 0, 0, 0)
    friday = days.special_days(df, holiday_dates(spark, [D(2024, 5, 10)])).collect()
    assert {r.date.day: r.pont for r in friday}[10] == 0


def test_calendar_has_one_row_per_input_row(spark):
    hours = [(T(2024, 5, 8, h),) for h in range(24)] * 2
    cal = days.add_calendar(
        spark.createDataFrame(hours, "datehour timestamp_ntz"), holiday_dates(spark, [D(2024, 5, 8), D(2024, 5, 8)]),
        break_ranges(spark, [(D(2024, 5, 8), D(2024, 5, 8)), (D(2024, 5, 1), D(2024, 5, 9)), (D(2024, 5, 9), D(2024, 5, 1))]),
        break_ranges(spark, [(D(2024, 5, 9), D(2024, 5, 9))]),
    )
    rows = cal.collect()
    assert len(rows) == 48 and all(r.holiday == 1 and r.vacances == 1 and r.vacances_uni == 0 for r in rows)


def test_ranges_are_half_open_and_empty_ranges_vanish(spark):
    rows = [(T(2024, 1, 1, 5), T(2024, 1, 1, 7)), (T(2024, 1, 1, 5), T(2024, 1, 1, 5)), (T(2024, 1, 1, 5), T(2024, 1, 1, 4))]
    out = timefn.range_hours(spark.createDataFrame(rows, "start timestamp_ntz, end timestamp_ntz")).collect()
    assert [r.datehour.hour for r in out] == [5, 6]


def test_numbers(spark):
    parse = lambda s: one(spark, s, numeric.parse_decimal_comma(F.col("t")), "t string")
    assert parse("3,5") == 3.5 and parse("-2") == -2.0 and parse("x") is None and parse(None) is None
    frost = lambda x: one(spark, x, numeric.frost_minutes(F.col("t")), "t double")
    assert frost(1.0) == 0 and frost(-1.0) == 20 and frost(-10.0) == 60
