"""Regression scores and flow totals of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRUE, PRED = "delta_test", "delta_pred"

# Rush hours of the scores, inclusive.
MORNING_RUSH = (6, 12)
EVENING_RUSH = (15, 22)


def _error() -> Column:
    return F.col(TRUE) - F.col(PRED)


def _rmse(cond: Column | None = None) -> Column:
    sq = _error() * _error()
    return F.sqrt(F.avg(sq if cond is None else F.when(cond, sq)))


def _mae(cond: Column | None = None) -> Column:
    e = F.abs(_error())
    return F.avg(e if cond is None else F.when(cond, e))


def is_peak(low: Column, high: Column, col: str = TRUE) -> Column:
    return (F.col(col) < low) | (F.col(col) > high)


def regression_scores(df: DataFrame) -> DataFrame:
    return df.agg(_rmse().alias("rmse"), _mae().alias("mae"))


def peak_scores(df: DataFrame, low: Column, high: Column) -> DataFrame:
    """RMSE and MAE where the true flow is outside the margins."""
    peak = is_peak(low, high)
    return df.agg(_rmse(peak).alias("pic_rmse"), _mae(peak).alias("pic_mae"))


def station_scores(df: DataFrame, low: Column, high: Column) -> DataFrame:
    return df.groupBy("station").agg(_rmse().alias("rmse"), _rmse(is_peak(low, high)).alias("pic_rmse"))


def rush_share(df: DataFrame, low: Column, high: Column, col: str = "delta") -> DataFrame:
    return df.agg(F.avg(is_peak(low, high, col).cast("double")).alias("rush_share"))


def rush_sums(df: DataFrame) -> DataFrame:
    """True and predicted flow per station, date and rush half-day."""
    rush = F.col("hour").between(*MORNING_RUSH) | F.col("hour").between(*EVENING_RUSH)
    return df.filter(rush).groupBy("station", "date", (F.col("hour") <= MORNING_RUSH[1]).alias("morning")).agg(
        F.sum(TRUE).alias(TRUE), F.sum(PRED).alias(PRED)
    )


def rush_error(df: DataFrame, station: str) -> DataFrame:
    """Mean absolute error of the rush sums: overall, for one station, on the first Thursday of
    the test rows, and for both."""
    thursday = df.filter(F.weekday("date") == 3).agg(F.min("date").alias("d")).scalar()
    err = F.abs(_error())
    one, day = F.col("station") == station, F.col("date") == thursday
    return rush_sums(df).agg(
        F.avg(err).alias("mare"),
        F.avg(F.when(one, err)).alias("station_mare"),
        F.avg(F.when(day, err)).alias("date_mare"),
        F.avg(F.when(one & day, err)).alias("date_station_mare"),
    )


def peak_demand(df: DataFrame) -> DataFrame:
    """Bikes (negative flow) or free places (positive flow) needed per station, date and rush."""
    def need(c: str, sign: int, name: str) -> Column:
        return F.greatest(F.col(c) * sign, F.lit(0.0)).alias(name)
    return rush_sums(df).select(
        "station", "date", "morning", TRUE, PRED,
        need(TRUE, -1, "bikes_needed"), need(TRUE, 1, "places_needed"),
        need(PRED, -1, "bikes_predicted"), need(PRED, 1, "places_predicted"),
    )


def weighted_losses(df: DataFrame) -> DataFrame:
    """wmae, wmse, mae and mse with the row's ``weight``."""
    e, w = _error(), F.col("weight")
    return df.agg(
        F.avg(w * F.abs(e)).alias("wmae"), F.avg(w * e * e).alias("wmse"), F.avg(F.abs(e)).alias("mae"),
        F.avg(e * e).alias("mse"),
    )
