"""Gap handling and reconstruction on the dense hourly grid.

Every window is keyed by station, or by keys that refine it, so one placement by station serves
them all. Look-ahead uses either a frame of a few rows or a descending sort with a growing frame:
a frame that ends at the last row of the partition is evaluated in quadratic time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.operators.filters import clamp_stock
from dockflow.operators.grid import add_delta, by_hour

LEAD_IN = (W.unboundedPreceding, 0)


def backward(*keys: str, order: str = "datehour") -> W:
    """From the newest row down to the current one."""
    return W.partitionBy(*keys).orderBy(F.col(order).desc()).rowsBetween(*LEAD_IN)


def null_runs(df: DataFrame, col: str) -> DataFrame:
    """``run_id`` (1, 2, ... per station, null outside a gap) and ``run_length`` of null runs."""
    w = by_hour()
    starts = F.col(col).isNull() & (F.lag(F.col(col).isNull(), 1, False).over(w) == F.lit(False))
    ordinal = F.sum(starts.cast("int")).over(w.rowsBetween(*LEAD_IN))
    marked = df.withColumn("run_id", F.when(F.col(col).isNull(), ordinal))
    length = F.count(F.lit(1)).over(W.partitionBy("station", "run_id"))
    return marked.withColumn("run_length", F.when(F.col("run_id").isNotNull(), length))


def run_cumsum(df: DataFrame, compare_to: str, source: str, target: str, reverse: bool = False) -> DataFrame:
    """Running sum of ``source`` inside each null run of ``compare_to``, null elsewhere."""
    runs = null_runs(df, compare_to)
    order = F.col("datehour").desc() if reverse else F.col("datehour")
    w = W.partitionBy("station", "run_id").orderBy(order).rowsBetween(*LEAD_IN)
    total = F.when(F.col("run_id").isNotNull(), F.sum(source).over(w))
    return runs.withColumn(target, total).drop("run_id", "run_length")


def interpolate_gaps(
    df: DataFrame, col: str = "bikes", max_len: int = 2, keys: tuple[str, ...] = ("station",),
) -> DataFrame:
    """Linear interpolation by row position of gaps no longer than ``max_len``.

    A short gap at the end repeats the last value, a gap at the start stays null. Both ends of a
    short gap are within ``max_len`` rows, so a few row offsets see all that is needed.
    """
    w = by_hour(*keys)
    near = range(1, max_len + 1)
    out = df.withColumns(
        {f"_p{k}": F.lag(col, k).over(w) for k in near}
        | {f"_n{k}": F.lead(col, k).over(w) for k in near}
        | {f"_a{k}": F.lead(F.lit(1), k, 0).over(w) for k in near}
    )

    def first(side: str, value: Callable[[int], Column]) -> Column:
        """Value for the nearest known row on one side."""
        return F.coalesce(*[F.when(F.col(f"{side}{k}").isNotNull(), value(k)) for k in near])

    prev, back = first("_p", lambda k: F.col(f"_p{k}")), first("_p", F.lit)
    nxt, ahead = first("_n", lambda k: F.col(f"_n{k}")), first("_n", F.lit)
    rest = reduce(lambda x, y: x + y, [F.col(f"_a{k}") for k in near])
    line = prev + (nxt - prev) * back / (back + ahead)
    tail = nxt.isNull() & (rest < max_len) & (back + rest <= max_len)
    value = F.when(F.col(col).isNotNull(), F.col(col)).when(back + ahead - 1 <= max_len, line).when(tail, prev)
    return out.withColumn(col, value).drop(*[f"_{s}{k}" for s in "pna" for k in near])


def is_night(datehour: Column) -> Column:
    return (F.hour(datehour) < 6) | (F.hour(datehour) > 22)


def interpolate_night(df: DataFrame, col: str = "bikes", max_len: int = 3) -> DataFrame:
    """Second pass over the night rows alone, taken as one sequence across days."""
    night = df.withColumn("_night", is_night(F.col("datehour")))
    filled = interpolate_gaps(night.withColumn("_raw", F.col(col)), col, max_len, ("station", "_night"))
    return filled.withColumn(col, F.when(F.col("_night"), F.col(col)).otherwise(F.col("_raw"))).drop("_night", "_raw")


def seasonal_median(df: DataFrame, col: str = "delta", target: str = "seasonal_median") -> DataFrame:
    """Median of the known values among this and the two previous rows of the same station,
    weekday and hour; written with offsets, which cost far less than a sliding percentile."""
    w = by_hour("station", "weekday", "hour")
    out = df.withColumns({"_b": F.lag(col, 1).over(w), "_c": F.lag(col, 2).over(w)})
    a, b, c = F.col(col), F.col("_b"), F.col("_c")
    three = a.isNotNull() & b.isNotNull() & c.isNotNull()
    middle = F.greatest(F.least(a, b), F.least(F.greatest(a, b), c))
    fewer = (F.greatest(a, b, c) + F.least(a, b, c)) / 2
    return out.withColumn(target, F.when(three, middle).otherwise(fewer)).drop("_b", "_c")


def neighbour_mean(df: DataFrame, col: str, target: str = "neighbour_mean") -> DataFrame:
    """Mean of the last and the next known value; at the edges the only known one."""
    past = F.last(col, ignorenulls=True).over(by_hour().rowsBetween(*LEAD_IN))
    nxt = F.last(col, ignorenulls=True).over(backward("station"))
    # the descending sort comes first: later steps go on in the ascending order
    out = df.withColumn("_next", nxt).withColumn("_past", past)
    mean = (F.coalesce("_past", "_next") + F.coalesce("_next", "_past")) / 2
    return out.withColumn(target, mean).drop("_past", "_next")


def fill_delta(df: DataFrame) -> DataFrame:
    """Missing deltas become the seasonal median, else the mean of the neighbouring medians;
    ``reconstructed`` marks the rows that had none."""
    out = neighbour_mean(seasonal_median(df), "seasonal_median")
    return out.withColumns(
        {
            "reconstructed": F.col("delta").isNull(),
            "delta": F.coalesce("delta", "seasonal_median", "neighbour_mean"),
        }
    ).drop("seasonal_median", "neighbour_mean")


def fill_stock(df: DataFrame) -> DataFrame:
    """Missing stock from the running flow, anchored at the station's first known stock.

    ``anchor + flow(now) - flow(anchor)`` serves rows on both sides of the anchor. The anchor
    is the smallest (hour, stock, flow) among rows with a known stock, over the whole station.
    """
    flow = F.sum(F.coalesce("delta", F.lit(0.0))).over(by_hour().rowsBetween(*LEAD_IN))
    known = F.when(F.col("bikes").isNotNull(), F.struct("datehour", "bikes", "_flow"))
    anchor = F.min(known).over(W.partitionBy("station"))
    out = df.withColumn("_flow", flow).withColumn("_anchor", anchor)
    rebuilt = F.col("_anchor.bikes") + F.col("_flow") - F.col("_anchor._flow")
    return out.withColumn("bikes", F.coalesce("bikes", rebuilt)).drop("_flow", "_anchor")


def rebuild_short_gaps(df: DataFrame) -> DataFrame:
    """Interpolate gaps up to 2 hours, night gaps up to 3, and recompute the delta."""
    return add_delta(interpolate_night(interpolate_gaps(df, "bikes", 2)))


def rebuild_long_gaps(df: DataFrame) -> DataFrame:
    """Seasonal reconstruction of the flow, stock rebuilt from it, delta recomputed; the first
    row of a station keeps its filled delta cut to an integer."""
    filled = clamp_stock(fill_stock(fill_delta(df)))
    return add_delta(filled, fill=F.col("delta").cast("int").cast("double"))


def reconstruction_report(df: DataFrame) -> DataFrame:
    """Rebuilt rows: count and percent of the complete rows."""
    complete = df.na.drop()
    return complete.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("reconstructed")).alias("rebuilt")
    ).withColumn("percent", F.round(F.col("rebuilt") * 100 / F.col("n_rows"), 2))
