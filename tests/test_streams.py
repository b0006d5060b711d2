import datetime as dt

from pyspark.sql import functions as F

from dockflow.operators import dedup
from dockflow.plans.flow import build_station_flow
from dockflow.plans.incremental import FlowStore
from dockflow.registry import base
from dockflow.registry.streams import STATUS_SCHEMA
from dockflow.sources.tables import load_table
from dockflow.streaming import jobs
from tests.helpers import START

SMALL = "status_id bigint, station string, bikes int, capacity int, dt timestamp_ntz"


def land(spark, path, rows, schema=SMALL):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))


def at(minutes):
    return START + dt.timedelta(minutes=minutes)


def test_copies_are_dropped_across_batches(spark, tmp_path):
    land(spark, tmp_path / "in", [(1, "a", 5, 30, at(0)), (2, "a", 5, 30, at(0))])
    land(spark, tmp_path / "in", [(3, "a", 5, 30, at(0)), (4, "a", 6, 30, at(10))])
    stream = jobs.dedup_stream(jobs.landed_tables(spark, str(tmp_path / "in"), SMALL, max_files=1))
    jobs.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted((r.bikes, r.dt) for r in load_table(spark, str(tmp_path / "out")).collect()) == [(5, at(0)), (6, at(10))]


def test_hourly_stream_equals_the_batch_on_closed_hours_over_many_batches(spark, tmp_path, sf):
    status = base.status(spark, sf)
    for day in range(0, 31, 10):
        low, high = START + dt.timedelta(days=day), START + dt.timedelta(days=day + 10)
        cut = lambda t: F.lit(str(t)).cast("timestamp_ntz")
        status.filter((F.col("dt") >= cut(low)) & (F.col("dt") < cut(high))).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = jobs.hourly_stream(jobs.landed_tables(spark, str(tmp_path / "in"), STATUS_SCHEMA, max_files=1))
    jobs.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    newest = status.agg(F.max("dt")).first()[0]
    batch = dedup.first_per_hour(status).filter(F.col("datehour") + F.expr("interval 3 hours") <= F.lit(str(newest)).cast("timestamp_ntz"))
    key = ["station", "datehour", "status_id", "bikes", "dt"]
    got = load_table(spark, str(tmp_path / "out")).select(key)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.select(key).collect()))


HOUR_ROWS = "station string, datehour timestamp_ntz, bikes double"


def run_deltas(spark, tmp_path, batches, **options):
    """Land and drain the batches one after the other; {(station, hour): delta}."""
    for rows in batches:
        land(spark, tmp_path / "in", rows, HOUR_ROWS)
        stream = jobs.landed_tables(spark, str(tmp_path / "in"), HOUR_ROWS, max_files=1)
        jobs.run_to_table(jobs.delta_stream(stream, **options), str(tmp_path / "out"), str(tmp_path / "cp"))
    return {(r.station, r.datehour): r.delta for r in load_table(spark, str(tmp_path / "out")).collect()}


def test_delta_state_survives_a_restart(spark, tmp_path):
    batches = [[("a", at(60), 7.0), ("a", at(0), 5.0), ("b", at(0), 1.0)], [("a", at(120), 4.0)], [("z", at(60 * 9), 0.0)]]
    got = run_deltas(spark, tmp_path, batches)
    assert got == {("a", at(0)): None, ("a", at(60)): 2.0, ("a", at(120)): -3.0, ("b", at(0)): None}


def test_late_rows_take_their_place(spark, tmp_path):
    stock = {0: 5.0, 1: 6.0, 2: 9.0, 3: 10.0}
    batches = [[("a", at(60 * h), stock[h]) for h in hours] for hours in ([0, 2], [1], [3])] + [[("z", at(60 * 9), 0.0)]]
    assert run_deltas(spark, tmp_path, batches) == {("a", at(0)): None, ("a", at(60)): 1.0, ("a", at(120)): 3.0, ("a", at(180)): 1.0}


def test_state_of_a_silent_station_ends(spark, tmp_path):
    batches = [[("a", at(0), 5.0)], [("z", at(60 * 24 * 4), 0.0)], [("z", at(60 * 24 * 4 + 60), 0.0), ("a", at(60 * 24 * 4), 9.0)], [("z", at(60 * 24 * 5), 0.0)]]
    got = run_deltas(spark, tmp_path, batches, keep_days=2)
    assert got[("a", at(0))] is None and got[("a", at(60 * 24 * 4))] is None and got[("z", at(60 * 24 * 4 + 60))] == 0.0


def test_streams_do_not_follow_the_session_zone(spark, tmp_path):
    rows = [(1, "a", 5, 30, at(615)), (2, "a", 6, 30, at(590)), (3, "b", 7, 30, at(645)), (4, "a", 1, 30, at(60 * 30))]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for k, name in enumerate(["UTC", "Asia/Kolkata"]):
            spark.conf.set("spark.sql.session.timeZone", name)
            land(spark, tmp_path / f"in{k}", rows)
            stream = lambda: jobs.landed_tables(spark, str(tmp_path / f"in{k}"), SMALL)
            jobs.run_to_table(jobs.hourly_stream(stream()), str(tmp_path / f"hours{k}"), str(tmp_path / f"cph{k}"))
            jobs.run_to_table(jobs.health_stream(stream()), str(tmp_path / f"health{k}"), str(tmp_path / f"cpe{k}"))
            hours = sorted((r.station, r.datehour) for r in load_table(spark, str(tmp_path / f"hours{k}")).collect())
            assert hours == [("a", at(540)), ("a", at(600)), ("b", at(600))]
            health = sorted((r.datehour, r.n_rows, r.n_stations) for r in load_table(spark, str(tmp_path / f"health{k}")).collect())
            assert health == [(at(540), 1, 1), (at(600), 2, 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_refresh_publishes_the_whole_flow_of_all_batches(spark, tmp_path, sf):
    status, cal = base.status(spark, sf), base.calendars(spark)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    store = FlowStore(spark, str(tmp_path / "out"), buckets=2)
    args = (store, str(tmp_path / "log"), str(tmp_path / "cp"))
    stream = lambda: jobs.landed_tables(spark, str(tmp_path / "in"), STATUS_SCHEMA)
    late = status.filter((F.col("dt") >= cut) & (F.col("station") != "3"))
    status.filter(F.col("dt") < cut).coalesce(1).write.parquet(str(tmp_path / "in"))
    jobs.refresh_stream(stream(), *args)
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.refresh_stream(stream(), *args)
    want = build_station_flow(status.filter(F.col("dt") < cut).unionByName(late), cal.holidays, cal.breaks, cal.uni_breaks)
    flow = store.station_flow(cal.holidays, cal.breaks, cal.uni_breaks)
    key = ["station", "datehour", F.round("bikes", 6), F.round("delta", 6)]
    assert sorted(map(str, flow.select(*key).collect())) == sorted(map(str, want.select(*key).collect()))
    ends = {r.e for r in flow.groupBy("station").agg(F.max("datehour").alias("e")).collect()}
    assert len(ends) == 1, "all stations reach the same hour"
    store.merge(status.limit(5), 1)
    assert len(store.state().days) > 0 and store.state().batch == 1, "a batch that is in already does nothing"
