"""Streaming forms of ingest, de-duplication, hourly reduction, health and refresh.

Event time is ``timestamp`` inside the streams, as watermarks require it, and ``timestamp_ntz``
in the tables; the clock is read as UTC both ways, so no result depends on the session zone. Every job takes the trigger from its caller; ``available_now`` drains what has
landed and stops, as the hourly pull does.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dockflow.functions.timefn import arrival_key, as_clock, as_instant
from dockflow.plans.incremental import FlowStore
from dockflow.sources.status import parse_status


def landed_tables(spark: SparkSession, path: str, schema: str, glob: str | None = None, max_files: int = 1000) -> DataFrame:
    """Stream of Parquet files landing in a folder, a bounded number per batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def ingest_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Landed snapshot payloads (payload, poll_dt) as typed status rows."""
    return parse_status(landed_tables(spark, path, "payload string, poll_dt timestamp_ntz", max_files=max_files))


def event_time(df: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Watermark on ``event_time``, the report time as an instant."""
    return df.withColumn("event_time", as_instant(F.col("dt"))).withWatermark("event_time", delay)


def dedup_stream(df: DataFrame, delay: str = "2 hours", keys: tuple[str, ...] = ("dt", "bikes", "capacity", "station")) -> DataFrame:
    """Copies of a report dropped while they arrive within the delay."""
    return event_time(df, delay).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")


def hourly_stream(df: DataFrame, delay: str = "2 hours") -> DataFrame:
    """First report per station and hour, emitted once the hour is closed; order and values are of fixed width, so the state
    is kept by hash tables."""
    columns = ["status_id", "bikes", "dt"]
    timed = event_time(df, delay).withColumn("_key", arrival_key())
    hourly = timed.groupBy("station", F.window("event_time", "1 hour").alias("w")).agg(*[F.min_by(c, "_key").alias(c) for c in columns])
    return hourly.select("station", as_clock(F.col("w.start")).alias("datehour"), *columns)


def health_stream(df: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Rows and distinct stations per closed hour.

    A stream cannot count distinct values directly: reports are counted per station and hour
    first, which also spreads a busy hour over its stations, and those counts per hour.
    """
    per_station = event_time(df, delay).groupBy(F.window("event_time", "1 hour").alias("w"), "station").agg(
        F.count(F.lit(1)).alias("n")
    )
    hourly = per_station.groupBy(F.window(F.col("w"), "1 hour").alias("h")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_stations")
    )
    return hourly.select(as_clock(F.col("h.start")).alias("datehour"), "n_rows", "n_stations")


def profile_stream(health: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Median and mean hourly station count over one-day windows sliding by the hour."""
    timed = health.withColumn("event_time", as_instant(F.col("datehour"))).withWatermark("event_time", delay)
    daily = timed.groupBy(F.window("event_time", "1 day", "1 hour").alias("w")).agg(
        F.count(F.lit(1)).alias("n_hours"), F.percentile("n_stations", F.lit(0.5)).alias("median_stations"),
        F.avg("n_rows").alias("mean_rows"),
    )
    return daily.select(as_clock(F.col("w.end")).alias("window_end"), "n_hours", "median_stations", "mean_rows")


HOUR_MS = 3_600_000


def _deltas(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Differences of one station's hourly stocks, in the order of the hours.

    Rows wait in the state until the watermark has passed the end of their hour, so a late row takes its
    place before its difference is made. A station that stays away loses its state after ``keep_ms``.
    """
    hours, stocks, last_hour, last, keep_ms = (*state.get,) if state.exists else ([], [], None, None, 0)
    waiting = dict(zip(hours, stocks))
    for rows in batches:
        for hour, stock, keep in zip(rows["hour_ms"].tolist(), rows["bikes"].astype("float64").tolist(), rows["keep_ms"].tolist()):
            keep_ms = keep
            if last_hour is None or hour > last_hour:
                waiting.setdefault(hour, stock)
    mark = state.getCurrentWatermarkMs()
    ready = sorted(h for h in waiting if h + HOUR_MS < mark)
    out = []
    for hour in ready:
        stock = waiting.pop(hour)
        out.append((key[0], hour, stock, None if last is None else stock - last))
        last_hour, last = hour, stock
    if waiting or (last_hour is not None and last_hour + keep_ms >= mark):
        state.update((list(waiting), list(waiting.values()), last_hour, last, keep_ms))
        due = min(waiting) + HOUR_MS if waiting else last_hour + keep_ms
        state.setTimeoutTimestamp(max(due, mark + 1))
    else:
        state.remove()
    if out:
        yield pd.DataFrame(out, columns=["station", "hour_ms", "bikes", "delta"]).astype({"delta": "float64"})


def delta_stream(hourly: DataFrame, delay: str = "2 hours", keep_days: int = 31) -> DataFrame:
    """Flow against the station's previous known hour, emitted once the watermark has closed the hour.

    The input is the hourly table, one row per station and hour, so a station's share of a batch
    is bounded by its hours however busy its raw log is. The state holds the hours still open and the
    last closed one; it ends when the station has been silent for ``keep_days``.
    """
    timed = hourly.select("station", "bikes", as_instant(F.col("datehour")).alias("event_time"))
    timed = timed.withWatermark("event_time", delay).withColumns(
        {"hour_ms": F.unix_millis("event_time"), "keep_ms": F.lit(keep_days * 24 * HOUR_MS)}
    )
    out = timed.groupBy("station").applyInPandasWithState(
        _deltas, "station string, hour_ms long, bikes double, delta double",
        "hours array<long>, stocks array<double>, last_hour long, last double, keep_ms long", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return out.select("station", as_clock(F.timestamp_millis("hour_ms")).alias("datehour"), "bikes", "delta")


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Drain the stream into a Parquet table and stop."""
    query = (
        df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode(mode).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def refresh_stream(incoming: DataFrame, store: FlowStore, log: str, checkpoint: str) -> None:
    """Per batch: write its rows to the log, and merge them into the flow.

    The log's part is replaced per batch id, and the store passes over an id its manifest has, so a repeated batch is harmless.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        part = f"{log}/batch={batch_id}"
        df.write.mode("overwrite").parquet(part)
        store.merge(df.sparkSession.read.schema(df.schema).parquet(part), batch_id)

    query = (
        incoming.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
