"""Streaming jobs, drained with ``availableNow`` into tables below the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.plans.incremental import FlowStore
from dockflow.registry.base import COPIED, FLOW, FLOW_VALUES, HEALTH, HOURLY, STATUS, calendars, copied_status, query, rounded, s6, status, weather
from dockflow.registry.cleaning import STATUS_ROWS, hourly, status_payloads
from dockflow.registry.reports import health
from dockflow.session import scratch_path, shuffle_width
from dockflow.sources.tables import load_table
from dockflow.streaming import jobs

STATUS_SCHEMA = (
    "status_id bigint, station string, bikes int, capacity int, lat double, lon double, name string, "
    "dt timestamp_ntz, poll_dt timestamp_ntz"
)


def landed(spark, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return path


def drained(spark, df: DataFrame, name: str) -> DataFrame:
    out = scratch_path(spark, name)
    jobs.run_to_table(df, out, scratch_path(spark, f"{name}-checkpoint"))
    return load_table(spark, out)


def status_stream(spark, sf, copied: bool = False) -> DataFrame:
    df = copied_status(spark, sf) if copied else status(spark, sf)
    return jobs.landed_tables(spark, landed(spark, df, "status-landing"), STATUS_SCHEMA)


@query("k01_ingest_stream", f"WITH {STATUS} {STATUS_ROWS}")
def _(spark, sf):
    path = landed(spark, status_payloads(spark, sf), "payload-landing")
    return drained(spark, jobs.ingest_stream(spark, path), "ingest")


@query("k02_dedup_stream", f"WITH {COPIED} SELECT DISTINCT dt, bikes, capacity, station FROM copied")
def _(spark, sf):
    out = drained(spark, jobs.dedup_stream(status_stream(spark, sf, copied=True)), "dedup")
    return out.select("dt", "bikes", "capacity", "station")


@query("k03_hourly_stream", f"""WITH {HOURLY} SELECT station, datehour, status_id, CAST(bikes AS INTEGER) AS bikes, dt FROM hourly
WHERE datehour + INTERVAL 1 HOUR <= (SELECT max(dt) FROM status) - INTERVAL 2 HOUR""")
def _(spark, sf):
    return drained(spark, jobs.hourly_stream(status_stream(spark, sf)), "hourly")


@query("k04_health_stream", f"""WITH {HEALTH} SELECT datehour, CAST(n_rows AS BIGINT) AS n_rows, n_stations FROM health
WHERE datehour + INTERVAL 1 HOUR <= (SELECT max(dt) FROM status) - INTERVAL 2 HOUR""")
def _(spark, sf):
    return drained(spark, jobs.health_stream(status_stream(spark, sf)), "health")


@query("k05_profile_stream", f"""WITH {HEALTH}, ends AS (SELECT unnest(generate_series(min(datehour) + INTERVAL 1 HOUR, max(datehour) + INTERVAL 24 HOUR, INTERVAL 1 HOUR)) AS window_end FROM health)
SELECT window_end, count(*) AS n_hours, {s6('quantile_cont(n_stations, 0.5)')} AS median_stations, {s6('avg(n_rows)')} AS mean_rows
FROM ends JOIN health ON datehour >= window_end - INTERVAL 24 HOUR AND datehour < window_end
WHERE window_end <= (SELECT max(datehour) FROM health) - INTERVAL 2 HOUR GROUP BY 1""")
def _(spark, sf):
    path = landed(spark, health(spark, sf), "health-landing")
    stream = jobs.landed_tables(spark, path, "datehour timestamp_ntz, n_rows bigint, n_stations bigint")
    return rounded(drained(spark, jobs.profile_stream(stream), "profile"), "median_stations", "mean_rows")


@query("k06_delta_stream", f"""WITH {HOURLY} SELECT station, datehour, bikes,
bikes - lag(bikes) OVER (PARTITION BY station ORDER BY datehour) AS delta FROM hourly
QUALIFY datehour + INTERVAL 1 HOUR < (SELECT max(datehour) FROM hourly) - INTERVAL 2 HOUR""")
def _(spark, sf):
    """Hourly rows landing in three batches; in each, some rows of the hour before arrive an hour late."""
    path, h = scratch_path(spark, "hourly-landing"), hourly(spark, sf).select("station", "datehour", "bikes")
    late = F.pmod(F.xxhash64("station", "datehour"), F.lit(5)) == 0
    arrival = F.when(late, F.col("datehour") + F.expr("interval 1 hour")).otherwise(F.col("datehour"))
    cuts = ["2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        part = h.filter((arrival >= F.lit(low).cast("timestamp_ntz")) & (arrival < F.lit(high).cast("timestamp_ntz")))
        part.repartition(shuffle_width(spark), "station").write.mode("append").parquet(path)
    stream = jobs.landed_tables(spark, path, "station string, datehour timestamp_ntz, bikes double", max_files=shuffle_width(spark))
    return drained(spark, jobs.delta_stream(stream), "deltas")


@query("k07_refresh_stream", f"WITH {FLOW} SELECT * FROM flow")
def _(spark, sf):
    """The log landing in three batches; each is merged into the stored flow, with outliers; weather is joined when it is read."""
    path, log, out = (scratch_path(spark, n) for n in ("refresh-landing", "stream-log", "stream-flow"))
    s, wx, cal = status(spark, sf), weather(spark, sf), calendars(spark)
    cuts = ["2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    for low, high in zip(cuts, cuts[1:]):
        part = s.filter((F.col("dt") >= F.lit(low).cast("timestamp_ntz")) & (F.col("dt") < F.lit(high).cast("timestamp_ntz")))
        part.repartition(shuffle_width(spark), "station").write.mode("append").parquet(path)
    store = FlowStore(spark, out, buckets=4)
    stream = jobs.landed_tables(spark, path, STATUS_SCHEMA, max_files=shuffle_width(spark))
    jobs.refresh_stream(stream, store, log, scratch_path(spark, "refresh-checkpoint"))
    return rounded(store.flow(wx, cal.holidays, cal.breaks, cal.uni_breaks), *FLOW_VALUES)
