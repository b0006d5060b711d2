"""Coverage counts and outlier removal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def unstaged(df: DataFrame) -> DataFrame:
    return df


def coverage_counts(df: DataFrame, key: str) -> DataFrame:
    """Complete rows per key value."""
    return df.na.drop().groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def outlier_borders(counts: DataFrame, value: str = "n", k: float = 1.5, method: str = "IQR") -> DataFrame:
    """One row (low, high): quartile fences, mean -/+ k deviations, or a hard floor.

    ``percentile`` keeps one entry per distinct count, which is bounded by the largest count.
    """
    v = F.col(value)
    if method == "IQR":
        q = counts.agg(F.percentile(v, F.array(F.lit(0.25), F.lit(0.75))).alias("q"))
        iqr = (F.col("q")[1] - F.col("q")[0]) * k
        return q.select((F.col("q")[0] - iqr).alias("low"), (F.col("q")[1] + iqr).alias("high"))
    if method == "zscore":
        m = counts.agg(F.avg(v).alias("m"), F.stddev_pop(v).alias("s"))
        return m.select((F.col("m") - F.col("s") * k).alias("low"), (F.col("m") + F.col("s") * k).alias("high"))
    if method == "hard":
        return counts.agg(F.lit(float(k)).alias("low"), F.max(v).cast("double").alias("high"))
    raise ValueError(f"unknown method {method!r}: IQR, zscore or hard")


def outlier_labels(counts: DataFrame, value: str = "n", k: float = 1.5, method: str = "IQR") -> DataFrame:
    """Counts with both borders and the label low, high or normal."""
    borders = outlier_borders(counts, value, k, method).select(F.struct("low", "high").alias("b")).scalar()
    out = counts.withColumns({"low": borders.getField("low"), "high": borders.getField("high")})
    v = F.col(value)
    label = F.when(v > F.col("high"), "high").when(v < F.col("low"), "low").otherwise("normal")
    return out.withColumn("label", label)


def drop_outliers(
    df: DataFrame, key: str, k: float = 3, method: str = "IQR", legacy: bool = False, stage: Stage = unstaged,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Keep rows whose key has a normal number of complete rows.

    ``legacy`` keeps every key that has a complete row at all, whatever its label. ``stage`` may
    materialise the counts, so that ``df`` is evaluated once for them and once for the result;
    ``counts`` may bring coverage counts that were found in a cheaper way.
    """
    counts = stage(coverage_counts(df, key) if counts is None else counts)
    keep = counts if legacy else outlier_labels(counts, "n", k, method).filter("label = 'normal'")
    return df.join(keep.select(key), key, "left_semi")
