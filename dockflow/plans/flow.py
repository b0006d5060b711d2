"""From the status log to the hourly flow table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.days import add_calendar
from dockflow.functions.timefn import ONE_HOUR
from dockflow.operators.dedup import station_dim
from dockflow.operators.filters import WEATHER_COLUMNS, drop_incomplete, fix_types, select_flow
from dockflow.operators.grid import add_delta, by_hour, densify, hour_axis, hourly_observations
from dockflow.operators.outliers import drop_outliers
from dockflow.operators.rebuild import interpolate_night, rebuild_long_gaps
from dockflow.operators.weather import complete_weather, join_weather
from dockflow.session import scratch_path
from dockflow.sources.tables import write_and_read, write_by_station


def stage_tables(df: DataFrame) -> DataFrame:
    """Write an intermediate result below the shared folder and read it back."""
    return write_and_read(df, scratch_path(df.sparkSession, "stage"))


def stage_hours(df: DataFrame) -> DataFrame:
    """The same for rows of station hours, in buckets by station: the windows that follow find them placed."""
    return write_by_station(df, scratch_path(df.sparkSession, "stage"))


def dense_series(hourly: DataFrame, max_gap: int = 0) -> DataFrame:
    """Dense hourly stock and delta of every station, without the attributes: the windows of
    the reconstruction sort these rows several times, so they are kept narrow."""
    return add_delta(densify(hourly.select("station", "datehour", "bikes"), max_gap=max_gap))


def station_coverage(hourly: DataFrame) -> DataFrame:
    """Complete rows per station of the dense series, counted on the observations: a row has a
    delta when the hour before it was observed too."""
    before = F.lag("datehour").over(by_hour())
    consecutive = hourly.select("station", "datehour", (F.col("datehour") - F.expr(ONE_HOUR) == before).alias("ok"))
    return consecutive.filter("ok").groupBy("station").agg(F.count(F.lit(1)).alias("n"))


def build_station_flow(
    status: DataFrame, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame,
    drop_stations: bool = True, drop_days: bool = True, reconstruct: bool = True,
    legacy_outliers: bool = False, stage=stage_tables, stage_hours=stage_hours,
) -> DataFrame:
    """Clean, complete hourly flow per station with calendar columns, before weather.

    The log is reduced to its hourly observations once and stored; all later passes (bounds,
    coverage counts, result) read that much smaller table instead of the log. From then on one
    placement by station serves every window and the join of the station attributes. The interpolated
    series is stored too, as the days' counts and the result both read it. Calendar columns are
    made once per hour of the network and joined.
    """
    hourly = stage(hourly_observations(status, stage))
    flow = dense_series(hourly, max_gap=2 if reconstruct else 0)
    if drop_stations:
        counts = station_coverage(hourly)
        flow = drop_outliers(flow, "station", legacy=legacy_outliers, stage=stage, counts=counts)
    if reconstruct:
        flow = add_delta(interpolate_night(flow))
    if drop_days:
        flow = stage_hours(flow)
        dated = flow.withColumn("date", F.to_date("datehour"))
        flow = drop_outliers(dated, "date", legacy=legacy_outliers, stage=stage).drop("date")
    if reconstruct:
        keyed = flow.withColumns({"weekday": F.weekday("datehour"), "hour": F.hour("datehour")})
        flow = rebuild_long_gaps(keyed).drop("weekday", "hour")
    # The stored series is much smaller than its rows: without the hint it might be sent to every task instead of the stations.
    flow = flow.join(station_dim(hourly, ["datehour"]).hint("shuffle_hash"), "station")
    return select_flow(join_calendar(flow, hour_axis(hourly), holidays, breaks, uni_breaks))


def join_calendar(flow: DataFrame, hours: DataFrame, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame) -> DataFrame:
    """Calendar columns from a table of all hours of the flow, one row each, bounded by the calendar."""
    return flow.join(F.broadcast(add_calendar(hours, holidays, breaks, uni_breaks)), "datehour")


def build_flow(
    status: DataFrame, wx: DataFrame, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame,
    weather_places: int | None = None, **options,
) -> DataFrame:
    """The hourly flow table: 24 columns, one row per station and hour, without nulls."""
    return with_weather(build_station_flow(status, holidays, breaks, uni_breaks, **options), wx, weather_places)


def with_weather(flow: DataFrame, wx: DataFrame, places: int | None = None) -> DataFrame:
    """The flow with its hour's completed weather, which ``places`` rounds once per hour."""
    hourly = complete_weather(wx)
    if places is not None:
        hourly = hourly.withColumns({c: F.round(c, places) for c in WEATHER_COLUMNS})
    out = fix_types(join_weather(flow, hourly))
    return drop_incomplete(out.select(*flow.columns, *WEATHER_COLUMNS))
