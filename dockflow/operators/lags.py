"""Smoothing, seasonal means, peak sums and the lag history of requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.days import day_off
from dockflow.functions.timefn import hour_index
from dockflow.operators.grid import by_hour
from dockflow.operators.lookup import bucket_count, requested_part
from dockflow.session import shuffle_width

# Peak hours of the lag features (inclusive) and their columns.
MORNING_PEAK = (5, 11)
EVENING_PEAK = (15, 21)
PEAK_LENGTH = 7
PEAK_MEANS = ["mean_6_12", "mean_16_22"]
HISTORY_DAYS = 57

# Parts of the stack of requests and history per shuffle partition: the stack is several times the flow, and a task sorts its part whole.
STACK_PARTS = 4

LAG_KEYS = ["station", "weekday", "dayoff", "hour"]
LAG_COLUMNS = ["lagged_value", "lagged_value_3hours_mean", "mean_value", *PEAK_MEANS]


def centred_mean(col: str, hours: int, minimum: int = 1) -> Column:
    """Mean over the half-open window (t - W/2, t + W/2] of a station, by time."""
    low, high = -((hours + 1) // 2 - 1), hours // 2
    w = W.partitionBy("station").orderBy(hour_index(F.col("datehour"))).rangeBetween(low, high)
    mean = F.avg(col).over(w)
    return mean if minimum <= 1 else F.when(F.count(col).over(w) >= minimum, mean)


def smooth(df: DataFrame, window: int = 3, col: str = "delta") -> DataFrame:
    """Centred moving mean of the target; a window of 0 leaves it alone."""
    return df if window == 0 else df.withColumn(col, centred_mean(col, window))


def seasonal_mean(df: DataFrame, col: str = "delta", target: str = "mean_value", rows: int = 8, minimum: int = 3) -> DataFrame:
    """Mean of the previous 8 rows of the same station, weekday and hour, from 3 values on."""
    w = by_hour("station", "weekday", "hour").rowsBetween(-rows, -1)
    return df.withColumn(target, F.when(F.count(col).over(w) >= minimum, F.avg(col).over(w)))


def day_peaks(df: DataFrame, keep_incomplete: bool = False) -> DataFrame:
    """Morning and evening peak flow per station and day; a peak with a missing hour is null and
    days with a null peak are dropped unless ``keep_incomplete``."""
    def peak(hours: tuple[int, int]) -> Column:
        value = F.when(F.col("hour").between(*hours), F.col("delta"))
        return F.when(F.count(value) == PEAK_LENGTH, F.sum(value))

    firsts = [F.min_by(c, "datehour").alias(c) for c in ("lat", "lon") if c in df.columns]
    peaks = df.groupBy("station", "date").agg(
        peak(MORNING_PEAK).alias("morning_peak"), peak(EVENING_PEAK).alias("evening_peak"), *firsts
    )
    return peaks if keep_incomplete else peaks.na.drop()


def station_peaks(df: DataFrame, keep_incomplete: bool = False) -> DataFrame:
    """Mean day peaks and first position per station."""
    days = day_peaks(df, keep_incomplete)
    firsts = [F.min_by(c, "date").alias(c) for c in ("lat", "lon") if c in days.columns]
    return days.groupBy("station").agg(
        F.avg("morning_peak").alias("morning_peak"), F.avg("evening_peak").alias("evening_peak"), *firsts
    )


def peak_means(days: DataFrame, rows: int = 8, minimum: int = 4) -> DataFrame:
    """Mean peaks of the previous 8 days with the same weekday, from 4 values on; days without
    both means are dropped."""
    w = W.partitionBy("station", "weekday").orderBy("date").rowsBetween(-rows, -1)

    def mean(c: str) -> Column:
        return F.when(F.count(c).over(w) >= minimum, F.avg(c).over(w))

    out = days.withColumn("weekday", F.weekday("date")).withColumns(
        {PEAK_MEANS[0]: mean("morning_peak"), PEAK_MEANS[1]: mean("evening_peak")}
    )
    return out.select("station", "date", *PEAK_MEANS).na.drop()


def join_peaks(df: DataFrame, peaks: DataFrame) -> DataFrame:
    return df.join(peaks, ["station", "date"], "left")


def lag_history(df: DataFrame) -> DataFrame:
    """What later requests may know: value, 3-hour mean, seasonal mean and peak means per
    station and hour."""
    base = df.select(
        "datehour", "date", "hour", "station", "weekday", day_off().alias("dayoff"), F.col("delta").alias("lagged_value")
    )
    out = base.withColumn("lagged_value_3hours_mean", centred_mean("lagged_value", 3))
    out = seasonal_mean(out, "lagged_value")
    out = join_peaks(out, peak_means(day_peaks(df.select("station", "date", "hour", "datehour", "delta"))))
    return out.select("datehour", *LAG_KEYS, *LAG_COLUMNS)


def join_lags(
    req: DataFrame, hist: DataFrame, columns: list[str] | None = None, leak_free: bool = True,
) -> DataFrame:
    """Carry the lag history to request rows.

    Requests and history are stacked and carried by windows over (station, weekday, day off,
    hour), peak means over (station, weekday). The own hour's value and 3-hour mean are targets,
    so a request sees only earlier history rows; the means are built from earlier values and may
    come from its own hour. ``leak_free=False`` includes the own hour and fills backward inside
    the key, as a reading of known history does. Of a history in the layout by station only the requested buckets and days
    are opened, and only rows of requested stations are stacked.
    """
    if bucket_count(hist):
        hist = requested_part(hist, req, until=leak_free)
    columns = columns or LAG_COLUMNS
    kept = [c for c in req.columns if c not in columns]
    tagged = req.select(*kept).withColumns({"dayoff": day_off(), "_req": F.lit(1)})
    if "dayoff" not in kept:
        kept_out = kept
    else:
        kept_out = [c for c in kept if c != "dayoff"] + ["dayoff"]
    stacked = tagged.unionByName(
        hist.select("datehour", *LAG_KEYS, *columns).withColumn("_req", F.lit(0)), allowMissingColumns=True
    ).repartition(STACK_PARTS * shuffle_width(req.sparkSession), "station", "weekday")

    def keys_of(c: str) -> list[str]:
        return ["station", "weekday"] if c in PEAK_MEANS else LAG_KEYS

    def past(c: str) -> Column:
        own_hour = not leak_free or c in ("mean_value", *PEAK_MEANS)
        # history first lets a request see its own hour, requests first hide it
        tie = F.col("_req") if own_hour else F.col("_req").desc()
        return F.last(c, ignorenulls=True).over(
            W.partitionBy(*keys_of(c)).orderBy("datehour", tie).rowsBetween(W.unboundedPreceding, 0)
        )

    def first_known(c: str) -> Column:
        """What a row without an earlier value takes: the key's first one, without another sort."""
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.col("datehour"))).over(W.partitionBy(*keys_of(c)))

    out = stacked
    for group in (LAG_KEYS, ["station", "weekday"]):
        mine = [c for c in columns if keys_of(c) == group]
        out = out.withColumns({f"_past_{c}": past(c) for c in mine})
        if not leak_free:
            out = out.withColumns({f"_past_{c}": F.coalesce(f"_past_{c}", first_known(c)) for c in mine})
    out = out.withColumns({c: F.col(f"_past_{c}") for c in columns})
    return out.filter("_req = 1").select(*kept_out, *columns)


def last_similar(req: DataFrame, hist: DataFrame, leak_free: bool = True) -> DataFrame:
    """Last known value for the same station, weekday, day off and hour."""
    return join_lags(req, hist, ["lagged_value"], leak_free)


def last_similar_3h(req: DataFrame, hist: DataFrame, leak_free: bool = True) -> DataFrame:
    """Last known centred 3-hour mean for the same key."""
    return join_lags(req, hist, ["lagged_value_3hours_mean"], leak_free)


def carry_means(req: DataFrame, hist: DataFrame, leak_free: bool = True) -> DataFrame:
    """Seasonal and peak means carried to request rows."""
    return join_lags(req, hist, ["mean_value", *PEAK_MEANS], leak_free)


def lag_lead(df: DataFrame, hours: int = 12, col: str = "delta") -> DataFrame:
    """``lag_1..H`` and ``<col>_0..H`` of each station row; incomplete rows are dropped."""
    w = by_hour()
    added = {f"{col}_0": F.col(col)}
    for h in range(1, hours + 1):
        added[f"lag_{h}"] = F.lag(col, h).over(w)
        added[f"{col}_{h}"] = F.lead(col, h).over(w)
    return df.withColumns(added).na.drop(subset=list(added))


def day_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row per complete (station, date): 24 hourly feature vectors in hour order.

    A group never holds more than the 24 hours of a day.
    """
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    vector = F.array(*[F.col(c).cast("double") for c in cols])
    days = df.filter(complete).groupBy("station", "date").agg(
        F.sort_array(F.collect_list(F.struct("hour", vector.alias("v")))).alias("h")
    )
    return days.filter(F.size("h") == 24).select("station", "date", F.col("h.v").alias("matrix"))
