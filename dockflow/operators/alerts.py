"""Alert rules over metric time series.

A metric series holds one sample per hour, so all windows are bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.timefn import hour_index
from dockflow.operators.grid import hour_axis


def over_time(df: DataFrame, fn: str, hours: int, value: str = "value", target: str | None = None, keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """avg, last or median of the samples in (t - hours, t] of each series."""
    w = W.partitionBy(*keys).orderBy(hour_index(F.col("datehour"))).rangeBetween(-hours + 1, 0)
    v = F.col(value)
    agg = {"avg": F.avg(v), "last": F.last(v, ignorenulls=True), "median": F.percentile(v, F.lit(0.5))}[fn]
    return df.withColumn(target or f"{fn}_{value}", agg.over(w))


def sustained(df: DataFrame, cond: Column, hours: int = 2, target: str = "firing", keys: tuple[str, ...] = ()) -> DataFrame:
    """True where the condition has held for ``hours`` hours without a break.

    The axis must be dense; an unknown condition counts as false.
    """
    w = W.partitionBy(*keys).orderBy("_h").rowsBetween(W.unboundedPreceding, 0)
    out = df.withColumn("_h", hour_index(F.col("datehour"))).withColumn("_on", F.coalesce(cond, F.lit(False)))
    last_off = F.max(F.when(~F.col("_on"), F.col("_h"))).over(w)
    since = F.coalesce(last_off + 1, F.min("_h").over(w))
    return out.withColumn(target, F.col("_on") & (F.col("_h") - since >= hours)).drop("_h", "_on")


def dense_hours(df: DataFrame, values: dict[str, float] | None = None) -> DataFrame:
    """The network's hourly series with its missing hours; ``values`` fill the gaps."""
    out = hour_axis(df).join(df, "datehour", "left")
    return out.fillna(values) if values else out


def duplicate_alert(health: DataFrame) -> DataFrame:
    """Hours with more rows than stations."""
    extra = F.col("n_rows") - F.col("n_stations")
    return health.withColumn("extra_rows", extra).filter("extra_rows > 0")


def station_drop_alert(health: DataFrame, margin: int = 5, hold: int = 2) -> DataFrame:
    """Median station count of the last day above the current count by more than ``margin``,
    held for ``hold`` hours; an hour without rows counts 0 stations."""
    dense = dense_hours(health, {"n_rows": 0, "n_stations": 0})
    day = over_time(dense, "median", 24, "n_stations", "day_median", ())
    return sustained(day, F.col("day_median") > F.col("n_stations") + margin, hold)


def shift_alert(ks: DataFrame, avg_limit: float = 0.1, max_limit: float = 0.2, hold: int = 2) -> DataFrame:
    """Per hour the mean and the largest K-S value, and whether either has been above its limit
    for ``hold`` hours. ``ks`` holds (datehour, metric, ks)."""
    hourly = ks.groupBy("datehour").agg(F.avg("ks").alias("avg_ks"), F.max("ks").alias("max_ks"))
    cond = (F.col("avg_ks") > avg_limit) | (F.col("max_ks") > max_limit)
    return sustained(dense_hours(hourly), cond, hold)


def stale_alert(health: DataFrame) -> DataFrame:
    """Hours of the covered period without any row."""
    seen = health.select("datehour")
    return hour_axis(seen).join(seen, "datehour", "left_anti")


def uptime(health: DataFrame, hours: int = 24) -> DataFrame:
    """Percent of hours with rows in (t - hours, t]."""
    dense = dense_hours(health.select("datehour", F.lit(100.0).alias("up")), {"up": 0.0})
    return over_time(dense, "avg", hours, "up", "uptime", ()).select("datehour", "uptime")
