"""Holidays and break ranges.

All calendar joins go through one row per day, so what is broadcast is bounded by the length of
the calendar and never by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.timefn import calendar_parts


HOLIDAY_KINDS = ["is_holiday", "before_holiday", "after_holiday"]


def holiday_days(holidays: DataFrame, col: str = "date") -> DataFrame:
    """(date, kind) rows: the holidays, the days before and the days after them."""
    d = F.to_date(F.col(col))
    days = F.array(
        F.struct(d.alias("date"), F.lit("is_holiday").alias("kind")),
        F.struct(F.date_sub(d, 1).alias("date"), F.lit("before_holiday").alias("kind")),
        F.struct(F.date_add(d, 1).alias("date"), F.lit("after_holiday").alias("kind")),
    )
    return holidays.select(F.inline(days)).filter("date is not null")


def range_days(ranges: DataFrame, kind: str) -> DataFrame:
    """(date, kind) rows of inclusive (start_date, end_date) ranges, unrolled to their days so
    that looking a date up is a hash join."""
    valid = ranges.filter(F.col("start_date") <= F.col("end_date"))
    days = F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day")))
    return valid.select(days.alias("date"), F.lit(kind).alias("kind"))


def flag_days(df: DataFrame, days: DataFrame, kinds: list[str], date_col: str = "date") -> DataFrame:
    """A 0/1 column per kind from (date, kind) rows, through one row per day."""
    flags = days.groupBy(F.col("date").alias("_day")).agg(*[F.max((F.col("kind") == k).cast("int")).alias(k) for k in kinds])
    out = df.join(F.broadcast(flags), F.col(date_col) == F.col("_day"), "left").drop("_day")
    return out.fillna(0, subset=kinds)


def holiday_flags(df: DataFrame, holidays: DataFrame, date_col: str = "date", holiday_col: str = "date") -> DataFrame:
    """Flags is_holiday, before_holiday and after_holiday of each row's date."""
    return flag_days(df, holiday_days(holidays, holiday_col), HOLIDAY_KINDS, date_col)


def _special(flagged: DataFrame, date_col: str) -> DataFrame:
    workday = F.col("is_holiday") == 0
    post = (workday & (F.col("after_holiday") == 1)).cast("int")
    return flagged.withColumns(
        {
            "holiday": F.col("is_holiday"),
            "preholiday": (workday & (F.col("before_holiday") == 1)).cast("int"),
            "postholiday": post,
            "pont": F.when(F.weekday(date_col) == 4, post).otherwise(0),
        }
    ).drop(*HOLIDAY_KINDS)


def special_days(df: DataFrame, holidays: DataFrame, date_col: str = "date", holiday_col: str = "date") -> DataFrame:
    """holiday, preholiday, postholiday (neither set on a holiday) and pont, the Friday after one."""
    return _special(holiday_flags(df, holidays, date_col, holiday_col), date_col)


def break_flags(df: DataFrame, ranges: DataFrame, flag: str, date_col: str = "date") -> DataFrame:
    """1 when the date lies in any inclusive (start_date, end_date) range."""
    return flag_days(df, range_days(ranges, flag), [flag], date_col)


def day_off(holiday: str = "holiday", pont: str = "pont") -> Column:
    return F.greatest(F.col(holiday), F.col(pont))


def add_calendar(df: DataFrame, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame) -> DataFrame:
    """All calendar columns of the hourly flow table, from one table of days and one join."""
    days = (
        holiday_days(holidays)
        .unionByName(range_days(breaks, "vacances"))
        .unionByName(range_days(uni_breaks, "vacances_uni"))
    )
    return _special(flag_days(calendar_parts(df), days, [*HOLIDAY_KINDS, "vacances", "vacances_uni"]), "date")
