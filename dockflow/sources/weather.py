"""Observed and forecast weather readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.numeric import frost_minutes, parse_decimal_comma
from dockflow.functions.timefn import epoch_to_ts, parse_hour_stamp

# Observation field names and the columns they become.
OBSERVATION_FIELDS = {"T": "temp", "RR1": "precip", "DG": "gel", "FF": "vent"}

FORECAST_PAYLOAD = """
    list array<struct<
        dt: bigint,
        main: struct<temp: double>,
        rain: struct<`3h`: double>,
        snow: struct<`3h`: double>,
        wind: struct<speed: double>>>
"""


def read_weather_obs(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon CSV of hourly observations; all other columns of the file are pruned."""
    raw = spark.read.csv(path, sep=";", header=True)
    values = [parse_decimal_comma(F.col(c)).alias(name) for c, name in OBSERVATION_FIELDS.items()]
    return raw.select(parse_hour_stamp(F.col("DATE")).alias("datehour"), *values)


def parse_forecast(payloads: DataFrame, col: str = "payload", station_col: str = "station") -> DataFrame:
    """Forecast payloads to one row per station and step; absent rain, snow and wind count as 0."""
    step = payloads.select(
        F.col(station_col).alias("station"),
        F.inline(F.from_json(F.col(col), FORECAST_PAYLOAD).getField("list")),
    )
    temp = F.col("main.temp")
    return step.select(
        "station",
        epoch_to_ts(F.col("dt")).alias("datehour"),
        temp.alias("temp"),
        (F.coalesce(F.col("rain.3h"), F.lit(0.0)) + F.coalesce(F.col("snow.3h"), F.lit(0.0))).alias("precip"),
        frost_minutes(temp).alias("gel"),
        F.coalesce(F.col("wind.speed"), F.lit(0.0)).alias("vent"),
    )
