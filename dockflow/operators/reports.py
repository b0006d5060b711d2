"""Usage, prediction and monitoring reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.timefn import hour_floor, weekday_label
from dockflow.operators.lags import smooth

# Run attributes shown with the latest run, and its reported metrics.
RUN_LABELS = {"starter": "tags", "wh": "params", "batch_size": "params", "loss_fn": "params"}


def last_hour_counts(df: DataFrame, now: Column | None = None, col: str = "poll_dt") -> DataFrame:
    """Rows and distinct stations polled in the hour before ``now`` (the newest poll by default)."""
    now = df.agg(F.max(col).alias("now")).scalar() if now is None else now
    return df.filter(F.col(col) >= now - F.expr("interval 1 hour")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("station").alias("n_stations")
    )


def hourly_health(df: DataFrame) -> DataFrame:
    """Rows and distinct stations per hour, for the alert rules."""
    return df.groupBy(hour_floor(F.col("dt")).alias("datehour")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("station").alias("n_stations")
    )


def stations_per_hour(df: DataFrame) -> DataFrame:
    """Stations with a known stock per hour."""
    return df.filter(F.col("bikes").isNotNull()).groupBy("datehour").agg(F.count_distinct("station").alias("n_stations"))


def box_summary(df: DataFrame, col: str) -> DataFrame:
    """Extremes, quartiles and the 1.5 IQR fences of a small-valued integer column."""
    q = df.agg(
        F.min(col).cast("double").alias("min"), F.percentile(col, F.array(*map(F.lit, (0.25, 0.5, 0.75)))).alias("q"),
        F.max(col).cast("double").alias("max"),
    )
    iqr = (F.col("q")[2] - F.col("q")[0]) * 1.5
    return q.select(
        "min", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "max",
        (F.col("q")[0] - iqr).alias("low_fence"), (F.col("q")[2] + iqr).alias("high_fence"),
    )


def usage_by_hour(df: DataFrame) -> DataFrame:
    """Least, mean and largest network flow by hour of day."""
    network = df.groupBy("datehour").agg(F.sum("delta").alias("flow"))
    return network.groupBy(F.hour("datehour").alias("hour")).agg(
        F.min("flow").alias("min_flow"), F.avg("flow").alias("mean_flow"), F.max("flow").alias("max_flow")
    )


def weather_corr(df: DataFrame) -> DataFrame:
    return df.agg(F.corr("delta", "temp").alias("corr_temp"), F.corr("delta", "precip").alias("corr_precip"))


def station_week(df: DataFrame, station: str, week: int, window: int = 3) -> DataFrame:
    """Raw and smoothed flow of one station in one ISO week, by date and hour."""
    raw = df.filter(F.col("station") == station).withColumn("smoothed", F.col("delta"))
    return smooth(raw, window, "smoothed").filter(F.weekofyear("datehour") == week).select(
        "date", "hour", "delta", "smoothed"
    )


def _taken() -> Column:
    return F.when(F.col("prediction") < 0, F.col("prediction")).otherwise(0.0)


def _returned() -> Column:
    return F.when(F.col("prediction") > 0, F.col("prediction")).otherwise(0.0)


def flow_totals(pred: DataFrame) -> DataFrame:
    """Bikes taken and returned, and the net flow."""
    return pred.agg(
        F.abs(F.round(F.sum(_taken()))).alias("taken"), F.round(F.sum(_returned())).alias("returned"),
        F.round(F.sum("prediction"), 2).alias("net"),
    )


def flow_per_hour(pred: DataFrame) -> DataFrame:
    return pred.groupBy("datehour").agg(F.sum("prediction").alias("flow"))


def flow_per_day(pred: DataFrame) -> DataFrame:
    """Daily morning, afternoon and total flow, bikes taken and returned, ordered by day."""
    morning = F.hour("datehour") < 12
    p = F.col("prediction")
    days = pred.groupBy(F.to_date("datehour").alias("date")).agg(
        F.round(F.abs(F.sum(_taken()))).alias("taken"),
        F.round(F.sum(_returned())).alias("returned"),
        F.round(F.sum(p)).alias("total"),
        F.round(F.sum(F.when(morning, p).otherwise(0.0))).alias("morning"),
        F.round(F.sum(F.when(morning, 0.0).otherwise(p))).alias("afternoon"),
    )
    return days.withColumn("dayofweek", weekday_label(F.weekday("date"))).select(
        "date", "dayofweek", "taken", "returned", "total", "morning", "afternoon"
    ).orderBy("date")


def name_predictions(pred: DataFrame, dim: DataFrame) -> DataFrame:
    return pred.join(dim.select("station", "name"), "station", "left")


def dataset_id(df: DataFrame) -> DataFrame:
    """Name of a training set from its first and last hour."""
    first, last = (F.date_format(f("datehour").cast("timestamp"), "yyyyMMdd_HH") for f in (F.min, F.max))
    return df.agg(F.concat(first, F.lit("-"), last, F.lit("_train")).alias("dataset_id"))


def latest_rows(df: DataFrame, n: int = 100, order: tuple[str, ...] = ("datehour", "station")) -> DataFrame:
    """The newest n rows, a sample stored with a run."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def best_candidate(scores: DataFrame, score: str = "score", key: str = "k") -> DataFrame:
    """Key of the best score, the lowest key among equals."""
    return scores.agg(F.max_by(key, F.struct(F.col(score), -F.col(key))).alias(key), F.max(score).alias(score))


def run_summary(runs: DataFrame) -> DataFrame:
    """Runs per experiment, and of the latest one its labels, duration and one-hot status.

    Running runs are not counted. Labels come from the run's tag and parameter maps.
    """
    done = runs.filter(F.col("status") != "RUNNING")
    attrs = F.struct("run_id", "status", "start_time", "end_time", "params", "tags", "metrics")
    latest = done.groupBy("experiment").agg(
        F.count(F.lit(1)).alias("n_runs"), F.max_by(attrs, F.struct("created", "run_id")).alias("run")
    )
    labels = [
        F.coalesce(F.try_element_at(F.col(f"run.{box}"), F.lit(key)), F.lit("unknown")).alias(key)
        for key, box in RUN_LABELS.items()
    ]
    status = F.col("run.status")
    seconds = F.unix_seconds(F.col("run.end_time").cast("timestamp")) - F.unix_seconds(F.col("run.start_time").cast("timestamp"))
    return latest.select(
        "experiment", "n_runs", F.col("run.run_id").alias("run_id"), *labels, seconds.alias("duration_seconds"),
        *[(status == s).cast("int").alias(s.lower()) for s in ("FINISHED", "RUNNING", "FAILED")],
        F.when(status == "FINISHED", F.col("run.metrics")).alias("metrics"),
    )


def run_metrics(summary: DataFrame) -> DataFrame:
    """Metrics of the latest finished runs as (experiment, metric, value) rows."""
    return summary.select("experiment", F.explode("metrics").alias("metric", "value"))


def stats_to_long(documents: DataFrame, col: str = "document") -> DataFrame:
    """Statistics documents to (selection, category, metric, value) rows."""
    nested = F.from_json(F.col(col), "map<string, map<string, map<string, double>>>")
    return (
        documents.select(F.explode(nested).alias("selection", "a"))
        .select("selection", F.explode("a").alias("category", "b"))
        .select("selection", "category", F.explode("b").alias("metric", "value"))
    )


def dataset_limits(df: DataFrame) -> DataFrame:
    """First and last hour of the dataset behind a statistics document."""
    return df.agg(F.min("datehour").alias("start_dt"), F.max("datehour").alias("end_dt"))
