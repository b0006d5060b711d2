"""Holiday and break calendars, which are input tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """``date;name;year`` CSV to distinct dates; the schema is positional, so a byte-order mark
    before the first header does not matter."""
    raw = spark.read.csv(path, sep=";", header=True, schema="day string, name string, year string", enforceSchema=True)
    return raw.select(F.to_date("day").alias("date")).filter("date is not null").distinct()


def read_breaks(
    spark: SparkSession, path: str, zone: str, min_year: int = 2024,
    zone_col: str = "Académies", start_col: str = "Date de début", end_col: str = "Date de fin",
) -> DataFrame:
    """Break ranges of one school zone that start in ``min_year`` or later."""
    raw = spark.read.csv(path, sep=";", header=True)
    out = raw.filter(F.col(zone_col) == zone).select(
        F.to_date(F.substring(start_col, 1, 10)).alias("start_date"),
        F.to_date(F.substring(end_col, 1, 10)).alias("end_date"),
    )
    return out.filter(F.year("start_date") >= min_year)


def break_ranges(spark: SparkSession, rows: list[tuple[date, date]]) -> DataFrame:
    """Break ranges given as literal (start, end) pairs."""
    return spark.createDataFrame(rows, "start_date date, end_date date")


def holiday_dates(spark: SparkSession, days: list[date]) -> DataFrame:
    return spark.createDataFrame([(d,) for d in days], "date date")
