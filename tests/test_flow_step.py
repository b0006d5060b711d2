"""What the hourly flow computes once: the interpolated series, the calendar of an hour, the flow of a refresh."""

import datetime as dt

from pyspark.sql import functions as F

from dockflow.operators import grid
from dockflow.plans import jobs
from dockflow.registry import base


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_interpolated_series_is_computed_once_and_never_broadcast(spark, sf):
    text = _plan(base.fresh_flow(spark, sf))
    assert "_night" not in text, "the result reads the series that the days' counts read"
    assert "ShuffledHashJoin [station#" in text


def test_a_run_of_hours_counts_them_once(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t + dt.timedelta(hours=h), b) for h, b in ((2, 4.0), (3, 5.0), (6, 8.0), (11, 1.0))] + [("b", t, None), ("b", t + dt.timedelta(hours=12), 2.0)]
    dense = grid.densify(spark.createDataFrame(rows, "station string, datehour timestamp_ntz, bikes double"), max_gap=2)
    assert _plan(dense).count("hour(datehour") <= 2
    got = {(r.station, r.datehour.hour): r.bikes for r in dense.collect()}
    known = {2: 4.0, 3: 5.0, 4: 6.0, 5: 7.0, 6: 8.0, 11: 1.0, 12: 1.0}
    assert got == {("a", h): known.get(h) for h in range(13)} | {("b", h): 2.0 if h == 12 else None for h in range(13)}


def test_a_refresh_computes_its_flow_once(spark, tmp_path):
    t = dt.datetime(2024, 1, 1)
    schema = "status_id bigint, station string, bikes int, capacity int, lat double, lon double, name string, dt timestamp_ntz, poll_dt timestamp_ntz"
    rows = [(k, f"s{k % 3}", k * 7 % 20, 30, 48.0, 2.0, f"n{k % 3}", t + dt.timedelta(hours=k // 3), t + dt.timedelta(hours=k // 3)) for k in range(3 * 24 * 9)]
    wx = spark.range(24 * 9).select(
        (F.lit(t).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datehour"),
        *[F.col("id").cast("double").alias(c) for c in ("temp", "precip", "gel", "vent")])
    cal, status = base.calendars(spark), spark.createDataFrame(rows, schema)
    flow = jobs.refresh(spark, str(tmp_path), status, wx, cal, days=2, buckets=2)
    assert "Join" not in _plan(flow) and "rebuilt" not in _plan(flow)
    want = jobs.flow_store(spark, str(tmp_path), buckets=2).flow(wx, cal.holidays, cal.breaks, cal.uni_breaks)
    assert flow.count() == want.count() > 0 and flow.exceptAll(want).count() == 0
