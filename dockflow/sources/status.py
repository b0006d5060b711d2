"""Station status log and station dimension."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.numeric import first_key
from dockflow.functions.timefn import epoch_to_ts

EXTRACT_COLUMNS = ["status_id", "station", "lat", "lon", "delta", "bikes", "capacity", "name", "dt"]

STATUS_PAYLOAD = """
    data struct<stations: array<struct<
        station_id: string,
        num_bikes_available: int,
        num_docks_available: int,
        num_bikes_available_types: array<map<string, int>>,
        is_installed: int,
        is_returning: int,
        is_renting: int,
        last_reported: bigint>>>
"""

STATION_PAYLOAD = """
    data struct<stations: array<struct<
        station_id: string, lat: string, lon: string, name: string, capacity: int>>>
"""


def _hour_cut(t: datetime) -> datetime:
    return t.replace(minute=0, second=0, microsecond=0)


def time_window(col: Column, from_dt: datetime, to_dt: datetime | None = None) -> Column:
    """Open window ``from < t < to`` with both bounds cut to the hour."""
    def stamp(t: datetime) -> Column:
        return F.to_timestamp_ntz(F.lit(_hour_cut(t).strftime("%Y-%m-%d %H:%M:%S")))
    cond = col > stamp(from_dt)
    return cond if to_dt is None else cond & (col < stamp(to_dt))


def read_status(source: DataFrame, from_dt: datetime, to_dt: datetime | None = None) -> DataFrame:
    """Status extract of an open time window; both the filter and the columns reach the scan."""
    out = source.filter(time_window(F.col("dt"), from_dt, to_dt)).withColumn("delta", F.lit(0))
    return out.select(*EXTRACT_COLUMNS)


def read_status_jdbc(
    spark: SparkSession, url: str, from_dt: datetime, to_dt: datetime, table: str = "status_all",
    slice_hours: int = 24, properties: dict[str, str] | None = None,
) -> DataFrame:
    """The same extract from a database view, one partition per ``slice_hours`` of history."""
    low, high = _hour_cut(from_dt), _hour_cut(to_dt)
    predicates = []
    while low < high:
        nxt = min(low + timedelta(hours=slice_hours), high)
        op = ">" if not predicates else ">="
        predicates.append(f"dt {op} TIMESTAMP '{low}' AND dt < TIMESTAMP '{nxt}'")
        low = nxt
    view = spark.read.jdbc(url, table, predicates=predicates or ["1 = 0"], properties=properties or {})
    out = view.withColumns({"delta": F.lit(0), "dt": F.col("dt").cast("timestamp_ntz")})
    return out.select(*EXTRACT_COLUMNS)


def parse_status(payloads: DataFrame, col: str = "payload", poll_col: str = "poll_dt") -> DataFrame:
    """Status snapshot payloads to one row per station."""
    station = payloads.select(
        F.col(poll_col).alias("poll_dt"),
        F.inline(F.from_json(F.col(col), STATUS_PAYLOAD).getField("data").getField("stations")),
    )
    types = F.col("num_bikes_available_types")
    return station.select(
        F.col("station_id").alias("station"),
        F.col("num_bikes_available").alias("bikes"),
        F.col("num_docks_available").alias("max_bikes"),
        first_key(types, "mechanical").alias("mechanical"),
        first_key(types, "ebike").alias("ebike"),
        "is_installed",
        "is_returning",
        "is_renting",
        epoch_to_ts(F.col("last_reported")).alias("dt"),
        "poll_dt",
    )


def parse_stations(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """Station information payloads to the dimension; a key absent from an object is null."""
    station = payloads.select(
        F.inline(F.from_json(F.col(col), STATION_PAYLOAD).getField("data").getField("stations"))
    )
    return station.select(F.col("station_id").alias("station"), "lat", "lon", "name", "capacity")


def status_view(status: DataFrame, stations: DataFrame) -> DataFrame:
    """Status rows with their station's attributes, hour and ISO weekday (1 = Monday).

    The join carries no hint: the dimension is broadcast when its measured size is below the
    session's threshold, and otherwise shuffled with skewed stations split at run time.
    """
    dim = stations.select("station", "lat", "lon", "name", "capacity")
    fact = status.drop("lat", "lon", "name", "capacity")
    return fact.join(dim, "station").withColumns(
        {"hour": F.hour("dt"), "weekday": F.weekday("dt") + 1}
    )


def append_batches(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union of raw extracts by column name."""
    return old.unionByName(new)
