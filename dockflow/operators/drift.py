"""Dataset profiles and drift between the newest and the previous period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.operators.ranking import exact_quantiles, ks_of_counts, ks_stat

# Profiled columns.
PROFILE_VALUES = ["delta", "temp", "precip", "vent"]


def _long(wide: DataFrame, selection: str, category: str, names: list[str]) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(F.lit(selection).alias("selection"), F.lit(category).alias("category"), F.inline(pairs))


def profile(df: DataFrame, values: list[str] | None = None, selection: str = "full") -> DataFrame:
    """Long rows (selection, category, metric, value): row and null counts, quartiles, fences,
    outliers beyond the fences and extremes of every value column.

    Three passes: range totals, the opened ranges, and one count of rows, nulls and values beyond the fences.
    """
    values = values or PROFILE_VALUES
    q = exact_quantiles(df, values, [0.25, 0.5, 0.75]).withColumn("_iqr", (F.col("q_2") - F.col("q_0")) * 1.5)
    q = q.select(
        "metric", F.col("q_0").alias("q1"), F.col("q_1").alias("q2"), F.col("q_2").alias("q3"),
        (F.col("q_2") + F.col("_iqr")).alias("high"), (F.col("q_0") - F.col("_iqr")).alias("low"),
        F.col("low").alias("min"), F.col("high").alias("max"),
    )
    fences = q.agg(F.map_from_entries(F.collect_list(F.struct("metric", F.struct("low", "high")))).alias("f")).scalar()
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns])
    top = {v: F.count_if(F.col(v).cast("double") > F.col("_fences")[v]["high"]) for v in values}
    bottom = {v: F.count_if(F.col(v).cast("double") < F.col("_fences")[v]["low"]) for v in values}
    counts = df.withColumn("_fences", fences).agg(
        F.count(F.lit(1)).alias("all"), F.count_if(any_null).alias("na"),
        *[F.count_if(F.col(v).isNull()).alias(f"{v}_na") for v in values],
        *[c for v in values for c in (
            F.when(F.count(v) > 0, top[v]).alias(f"{v}_outliers_top"), F.when(F.count(v) > 0, bottom[v]).alias(f"{v}_outliers_bottom"),
            F.when(F.count(v) > 0, top[v] + bottom[v]).alias(f"{v}_outliers"))],
    )
    stats = [F.struct(F.concat("metric", F.lit(f"_{n}")).alias("name"), F.col(n).cast("double").alias("value")) for n in ("q1", "q2", "q3", "high", "low", "min", "max")]
    spread = q.select(F.lit(selection).alias("selection"), F.lit("stats").alias("category"), F.inline(F.array(*stats))).withColumnRenamed("name", "metric")
    # A column without values has no outlier counts.
    return _long(counts, selection, "count", counts.columns).filter("value is not null").unionByName(spread)


def periods(df: DataFrame, days: int = 30, col: str = "datehour") -> tuple[DataFrame, DataFrame]:
    """(newest ``days`` days, the ``days`` days before them)."""
    newest = df.agg(F.max(col).alias("newest")).scalar()
    step = F.expr(f"interval {days} days")
    t = F.col(col)
    return df.filter(t >= newest - step), df.filter((t < newest - step) & (t >= newest - step - step))


def drift_stats(df: DataFrame, days: int = 30, values: list[str] | None = None) -> DataFrame:
    """K-S statistic of the newest period against the previous one, per value column."""
    return ks_stat(*periods(df, days), values or PROFILE_VALUES)


def profile_report(df: DataFrame, days: int = 30, values: list[str] | None = None) -> DataFrame:
    """Profiles of the whole data and of the newest period, and the drift between periods."""
    values = values or PROFILE_VALUES
    recent, _ = periods(df, days)
    name = f"{days}d"
    ks = drift_stats(df, days, values).select(
        F.lit(name).alias("selection"), F.lit("kstest").alias("category"), "metric", F.col("ks").alias("value")
    )
    return profile(df, values).unionByName(profile(recent, values, name)).unionByName(ks)


def drift_history(series: DataFrame, hours: int = 24) -> DataFrame:
    """Statistics rows as hourly refreshes would have stored them: (refreshed, selection, category, metric, value).

    For every hour up to the newest one, the K-S statistic of a metric's samples in the ``hours`` hours that end there against as many hours
    before. ``series`` holds (datehour, metric, value), one sample per hour: each serves 2 x ``hours`` refreshes. A refresh without samples in
    one of the periods has no row.
    """
    newest = series.agg(F.max("datehour")).scalar()
    later = F.explode(F.sequence(F.lit(0), F.lit(2 * hours - 1)))
    seen = series.withColumn("_later", later).withColumn("_at", F.col("datehour") + F.make_dt_interval(F.lit(0), F.col("_later"))).filter(F.col("_at") <= newest)
    name = F.concat_ws("|", F.date_format("_at", "'h'yyyyMMddHH"), F.col("metric"))
    recent = (F.col("_later") < hours).cast("int")
    ks = ks_of_counts(seen.select(name.alias("metric"), F.col("value").cast("double").alias("value"), recent.alias("n_a"), (1 - recent).alias("n_b")))
    return ks.filter("ks is not null").select(
        F.substring_index("metric", "|", 1).alias("refreshed"), F.lit(f"{hours}h").alias("selection"), F.lit("kstest").alias("category"),
        F.expr("substring(metric, locate('|', metric) + 1)").alias("metric"), F.col("ks").alias("value"),
    )
