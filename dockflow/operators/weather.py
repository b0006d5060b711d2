"""Weather completion and weather joins.

Completed observations hold one row per hour, so they are bounded by the calendar (under 90,000
rows in ten years) and are broadcast to the flow table. Un-partitioned windows are used on that
hour axis only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.timefn import ONE_HOUR, hour_index
from dockflow.operators.filters import WEATHER_COLUMNS, drop_incomplete
from dockflow.operators.grid import hour_axis, hour_bounds, hour_grid
from dockflow.operators.lookup import bucket_count, requested_part

GROWING = (W.unboundedPreceding, 0)


def interpolate_linear(df: DataFrame, cols: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """Linear interpolation without a length limit on a dense hour axis; a leading gap stays
    null and a trailing one repeats the last value."""
    h = hour_index(F.col("datehour"))
    asc = W.partitionBy(*keys).orderBy("_h").rowsBetween(*GROWING)
    desc = W.partitionBy(*keys).orderBy(F.col("_h").desc()).rowsBetween(*GROWING)

    def seen(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(F.col("_h").alias("p"), F.col(c).alias("v")))

    out = df.withColumn("_h", h)
    out = out.withColumns({f"_prev_{c}": F.last(seen(c), ignorenulls=True).over(asc) for c in cols})
    out = out.withColumns({f"_next_{c}": F.last(seen(c), ignorenulls=True).over(desc) for c in cols})

    def line(c: str) -> Column:
        p, n = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        between = p["v"] + (n["v"] - p["v"]) * (F.col("_h") - p["p"]) / (n["p"] - p["p"])
        return F.when(F.col(c).isNotNull(), F.col(c)).when(n.isNull(), p["v"]).otherwise(between)

    filled = out.withColumns({c: line(c) for c in cols})
    return filled.drop("_h", *[f"_prev_{c}" for c in cols], *[f"_next_{c}" for c in cols])


def complete_weather(wx: DataFrame) -> DataFrame:
    """One row per hour; no rain and no frost where unreported, the rest interpolated.

    Averaging per hour first leaves a single-source series unchanged and keeps the result
    bounded by the calendar if a source reports an hour twice.
    """
    hourly = wx.groupBy("datehour").agg(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS])
    dense = hour_axis(wx).join(hourly, "datehour", "left").fillna(0.0, subset=["precip", "gel"])
    return interpolate_linear(dense, ["temp", "vent"])


def hourly_forecast(fc: DataFrame) -> DataFrame:
    """Three-hour forecast steps to hours, per station.

    The axis starts two hours before the first step and ends one hour after the last. Rain is a
    three-hour sum, spread by a centred three-row mean; the rest is interpolated and a leading
    gap takes the first known value.
    """
    first, last = hour_bounds(fc).getField("low"), hour_bounds(fc).getField("high")
    ends = fc.sparkSession.range(1).select(
        F.explode(F.array(first - F.expr("interval 2 hours"), last + F.expr(ONE_HOUR))).alias("datehour")
    )
    grid = hour_grid(ends, fc.select("station").distinct())
    dense = grid.join(fc, ["station", "datehour"], "left").fillna(0.0, subset=["precip"])
    centred = W.partitionBy("station").orderBy("datehour").rowsBetween(-1, 1)
    spread = dense.withColumn("precip", F.avg("precip").over(centred))
    values = ["temp", "gel", "vent"]
    filled = interpolate_linear(spread, values, ("station",))
    ahead = W.partitionBy("station").orderBy(F.col("datehour").desc()).rowsBetween(*GROWING)
    return filled.withColumns({c: F.coalesce(c, F.last(c, ignorenulls=True).over(ahead)) for c in values})


def join_weather(flow: DataFrame, wx: DataFrame) -> DataFrame:
    """Completed hourly weather on the flow table; rows still incomplete are dropped."""
    return drop_incomplete(flow.join(F.broadcast(wx), "datehour", "left"))


def join_weather_past(req: DataFrame, flow: DataFrame) -> DataFrame:
    """Recorded weather of past (station, hour) requests; requests without a record are dropped."""
    return req.drop(*WEATHER_COLUMNS).join(_recorded(req, flow), ["station", "datehour"])


def _recorded(req: DataFrame, flow: DataFrame) -> DataFrame:
    if bucket_count(flow):
        flow = requested_part(flow, req, since=True)
    return flow.select("station", "datehour", *WEATHER_COLUMNS)


def join_weather_future(req: DataFrame, fc: DataFrame) -> DataFrame:
    """Forecast weather of future requests, null beyond the forecast.

    The forecast is that of the one location the model was trained with, averaged per hour: one
    row per hour, bounded by the forecast horizon.
    """
    hourly = fc.groupBy("datehour").agg(*[F.avg(c).alias(c) for c in WEATHER_COLUMNS])
    return req.drop(*WEATHER_COLUMNS).join(F.broadcast(hourly), "datehour", "left")


def join_weather_auto(req: DataFrame, flow: DataFrame, fc: DataFrame) -> DataFrame:
    """Recorded weather up to the newest recorded hour, forecast weather after it, in one pass over the requests.

    Of a flow in the layout by station the newest hour is looked up in its newest day, and only requested buckets and days are joined.
    """
    last = flow
    if bucket_count(flow):
        last = flow.filter(F.col("day") == flow.agg(F.max("day").alias("d")).scalar())
    newest = last.agg(F.max("datehour").alias("newest")).scalar()
    past = F.col("datehour") <= newest
    recorded = _recorded(req, flow).withColumnsRenamed({c: f"_was_{c}" for c in WEATHER_COLUMNS}).withColumn("_known", F.lit(True))
    both = join_weather_future(req, fc).join(recorded, ["station", "datehour"], "left").filter(~past | F.col("_known"))
    chosen = [F.when(past, F.col(f"_was_{c}")).otherwise(F.col(c)).alias(c) for c in WEATHER_COLUMNS]
    return both.select(*[c for c in req.columns if c not in WEATHER_COLUMNS], *chosen)
