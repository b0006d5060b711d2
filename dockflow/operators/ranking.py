"""Exact quantiles and K-S statistics by pruning ranges, and distributed prefix sums.

Values fall into ranges by their logarithm, a fixed rule that keeps the order and needs no look at the data: a range spans a thousandth of its
values, all doubles fill fewer than 1.5 million. One pass counts each range, combined map-side. The totals tell which ranges hold a wanted rank,
or could hold a larger distance of two distributions than the range ends show; a second pass opens those alone, counts their distinct values and
ranks them within the range. Nothing is written or run while a query is built.

``prefix_sums`` ranks every row: distinct values are range-partitioned and stored with their partition number; a running sum inside
each partition plus the totals of the preceding ones gives the global one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.session import scratch_path, shuffle_width
from dockflow.sources.tables import write_and_read


def prefix_sums(values: DataFrame, keys: list[str], order: str, sums: list[str]) -> DataFrame:
    """``cum_<s>`` of every summed column, per key in ``order``; (keys, order) must be unique.

    The partition number is stored with the rows because it has to be the same for the totals
    and for the rows even when tasks are run again.
    """
    spark = values.sparkSession
    ranged = values.repartitionByRange(shuffle_width(spark), *keys, order)
    stored = write_and_read(ranged.withColumn("_part", F.spark_partition_id()), scratch_path(spark, "ranges"))
    before = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    totals = stored.groupBy(*keys, "_part").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    base = totals.select(*keys, "_part", *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_base_{s}") for s in sums])
    inside = W.partitionBy(*keys, "_part").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    joined = stored.join(F.broadcast(base), [*keys, "_part"])
    out = joined.withColumns({f"cum_{s}": F.sum(s).over(inside) + F.col(f"_base_{s}") for s in sums})
    return out.drop("_part", *[f"_base_{s}" for s in sums])


RANGES_PER_LOG = 1024
LOG_LIMIT = 760
NOT_A_NUMBER = 2 * LOG_LIMIT * RANGES_PER_LOG


def value_range(value: Column) -> Column:
    """Number of the range of a double: rising with the value, 0 for zero, NaN last as in Spark's order."""
    depth = F.floor(F.least(F.log(F.abs(value)), F.lit(float(LOG_LIMIT - 1))) * RANGES_PER_LOG) + LOG_LIMIT * RANGES_PER_LOG
    return F.when(F.isnan(value), NOT_A_NUMBER).when(value == 0, 0).when(value > 0, depth).otherwise(-depth).cast("int")


def long_values(df: DataFrame, cols: list[str], *extra: str) -> DataFrame:
    """(metric, value, range, extra...) of the non-null values of several columns."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(F.explode(pairs).alias("p"), *extra).select("p.metric", "p.value", *extra).filter("value is not null")
    return long.withColumn("range", value_range(F.col("value")))


def _ahead(*sums: str) -> dict[str, Column]:
    """What lies in the ranges before, and in all, per metric: a window over range totals."""
    before = W.partitionBy("metric").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("metric")
    return {f"before_{s}": F.coalesce(F.sum(s).over(before), F.lit(0)) for s in sums} | {f"total_{s}": F.sum(s).over(whole) for s in sums}


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """(metric, n, low, high, q_0, q_1, ...): interpolated quantiles, number and extremes of each column's values."""
    values = long_values(df, cols)
    ranges = values.groupBy("metric", "range").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    whole = W.partitionBy("metric")
    totals = ranges.withColumns(_ahead("n") | {"low": F.min("low").over(whole), "high": F.max("high").over(whole)})
    place = [F.lit(float(p)) * (F.col("total_n") - 1) for p in probs]
    inside = lambda pos: (F.col("before_n") <= pos) & (pos < F.col("before_n") + F.col("n"))
    holds = reduce(lambda a, b: a | b, [inside(f(pos)) for pos in place for f in (F.floor, F.ceil)])
    # At most two ranges per metric and quantile.
    carried = ["before_n", "total_n", "low", "high"]
    opened = F.broadcast(totals.filter(holds).select("metric", "range", *carried))
    counted = values.join(opened, ["metric", "range"]).groupBy("metric", "range", "value", *carried).agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("metric", "range").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = counted.withColumn("cum_n", F.sum("n").over(upto) + F.col("before_n"))

    def at(pos: Column) -> Column:
        return F.max(F.when((F.col("cum_n") - F.col("n") <= pos) & (pos < F.col("cum_n")), F.col("value")))

    out = ranked.groupBy("metric").agg(
        F.first("total_n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"),
        *[at(f(pos)).alias(f"_{s}_{i}") for i, pos in enumerate(place) for s, f in (("lo", F.floor), ("hi", F.ceil))])

    def value(i: int, p: float) -> Column:
        pos, lo, hi = F.lit(float(p)) * (F.col("n") - 1), F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
        return (lo + (hi - lo) * (pos - F.floor(pos))).alias(f"q_{i}")

    return out.select("metric", "n", "low", "high", *[value(i, p) for i, p in enumerate(probs)])


def margins(df: DataFrame, col: str = "delta", k: float = 1.5) -> DataFrame:
    """One row (low, high): quartiles of the target minus and plus k interquartile ranges."""
    q = exact_quantiles(df, [col], [0.25, 0.75])
    iqr = (F.col("q_1") - F.col("q_0")) * k
    return q.select((F.col("q_0") - iqr).alias("low"), (F.col("q_1") + iqr).alias("high"))


def ks_stat(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per column; null when a sample is empty."""
    both = a.select(*cols, F.lit(1).alias("in_a")).unionByName(b.select(*cols, F.lit(0).alias("in_a")))
    return ks_of_counts(long_values(both, cols, "in_a").select("metric", "value", F.col("in_a").alias("n_a"), (1 - F.col("in_a")).alias("n_b")))


def ks_of_counts(counts: DataFrame) -> DataFrame:
    """K-S statistic per metric from (metric, value, n_a, n_b), values in any number of rows; null when a sample is empty.

    Range ends give a distance that is reached, and inside a range the distance stays below what its two shares allow: only
    ranges that could exceed the largest one reached are opened.
    """
    values = counts.withColumn("range", value_range(F.col("value")))
    sums = [F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b")]
    totals = values.groupBy("metric", "range").agg(*sums).withColumns(_ahead("n_a", "n_b"))

    def share(s: str, n: Column | int = 0) -> Column:
        return (F.col(f"before_{s}") + n) / F.nullif(F.col(f"total_{s}"), F.lit(0))

    end = F.abs(share("n_a", F.col("n_a")) - share("n_b", F.col("n_b")))
    most = F.greatest(share("n_a", F.col("n_a")) - share("n_b"), share("n_b", F.col("n_b")) - share("n_a"))
    ends = totals.withColumns({"ks": end, "most": most}).withColumn("reached", F.max("ks").over(W.partitionBy("metric")))
    carried = [f"{w}_{s}" for w in ("before", "total") for s in ("n_a", "n_b")]
    opened = ends.filter("most > reached and n_a + n_b > 1").select("metric", "range", *carried)
    counted = values.join(opened, ["metric", "range"]).groupBy("metric", "range", "value", *carried).agg(*sums)
    upto = W.partitionBy("metric", "range").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    inside = counted.withColumns({s: F.sum(s).over(upto) for s in ("n_a", "n_b")}).select("metric", end.alias("ks"))
    return ends.select("metric", "ks").unionByName(inside).groupBy("metric").agg(F.max("ks").alias("ks"))
