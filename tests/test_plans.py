import re

import pytest
from pyspark.sql import functions as F

from dockflow.operators import alerts, dedup, drift, filters, grid
from dockflow.plans import jobs
from dockflow.operators.outliers import unstaged
from dockflow.plans.flow import build_flow
from dockflow.registry import base
from dockflow.registry import cleaning
from dockflow.sources import status as status_src
from dockflow.sources import tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flow_is_complete_unique_and_consistent(spark, sf):
    flow = base.fresh_flow(spark, sf).cache()
    assert flow.columns == [
        "datehour", "date", "station", "lat", "lon", "name", "hour", "month", "weekday", "weekend", "holiday", "preholiday",
        "postholiday", "pont", "vacances", "vacances_uni", "reconstructed", "capacity", "bikes", "delta", "temp", "precip",
        "gel", "vent",
    ]
    assert filters.null_audit(flow).first().null_cells == 0
    assert flow.select("station", "datehour").distinct().count() == flow.count()
    assert flow.filter("bikes < 0").count() == 0
    steps = grid.add_delta(flow.drop("delta").withColumn("kept", F.lit(1)), target="step").join(flow.select("station", "datehour", "delta"), ["station", "datehour"])
    assert steps.filter("step is not null and abs(step - delta) > 1e-5").count() == 0
    flow.unpersist()


def test_staging_does_not_change_the_result(spark, sf):
    staged = base.flow(spark, sf)
    lazy = base.fresh_flow(spark, sf, stage=unstaged)
    assert staged.exceptAll(lazy).count() == 0 and staged.count() == lazy.count()


def test_switches_of_the_flow_job(spark, sf):
    raw = base.fresh_flow
    cal = base.calendars(spark)
    out = build_flow(
        base.status(spark, sf), base.weather(spark, sf), cal.holidays, cal.breaks, cal.uni_breaks,
        drop_stations=False, drop_days=False, reconstruct=False,
    )
    assert "reconstructed" not in out.columns and 0 < out.count() < raw(spark, sf).count()


def test_no_cross_or_nested_loop_joins(spark, sf):
    bad = re.compile("CartesianProduct|BroadcastNestedLoopJoin")
    for df in (base.fresh_flow(spark, sf), cleaning.dense(spark, sf), alerts.dense_hours(base.stored(spark, sf, "x", lambda: cleaning.hourly(spark, sf)).select("datehour").distinct())):
        assert not bad.search(plan(df))


def test_one_station_placement_serves_all_windows(spark, sf):
    from dockflow.operators import rebuild

    text = plan(rebuild.rebuild_long_gaps(rebuild.rebuild_short_gaps(cleaning.dense(spark, sf)).withColumns({"weekday": F.weekday("datehour"), "hour": F.hour("datehour")})))
    main = [l for l in text.splitlines() if "Exchange hashpartitioning" in l]
    assert len(main) == 1 and "station" in main[0]


def test_extract_filter_and_columns_reach_the_scan(spark, sf):
    import datetime as dt

    stored = base.stored(spark, sf, "log", lambda: base.status(spark, sf))
    text = plan(status_src.read_status(stored, dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)))
    assert "GreaterThan(dt,2024-01-05T00:00)" in text and "LessThan(dt,2024-01-06T00:00)" in text
    assert "poll_dt" not in text.split("ReadSchema")[1]


def test_the_log_is_reduced_in_hash_tables(spark, sf):
    log = base.status(spark, sf)
    for df in (grid.reduce_log(log), dedup.station_dim(log)):
        text = plan(df)
        scan = text.rindex("HashAggregate")
        assert "Sort" not in text[text.rindex("Exchange"):] and scan > text.rindex("Exchange"), "no sort below the exchange of the log"


def test_dedup_combines_before_the_shuffle(spark, sf):
    for df in (dedup.first_per_hour(base.status(spark, sf)), dedup.drop_exact(base.status(spark, sf))):
        text = plan(df)
        assert "partial_min_by" in text and "Window" not in text
        below = text[text.rindex("Exchange"):]
        assert "HashAggregate" in below and "Sort" not in below, "the log itself is never sorted"


def test_first_rows_with_null_times_and_many_names(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1, 5)
    schema = "status_id bigint, station string, bikes int, capacity int, name string, dt timestamp_ntz"
    rows = [(5, "a", 1, 9, "x", t), (3, "a", 2, 9, "y", t), (4, "a", 2, 9, None, t), (None, "b", 7, 9, "z", t), (1, "b", 8, 9, "z", t), (9, "c", 1, 9, "n", None), (8, "c", 3, 9, None, None)]
    got = {r.station: (r.status_id, r.bikes, r.name) for r in dedup.first_per_hour(spark.createDataFrame(rows * 2, schema)).collect()}
    assert got == {"a": (3, 2, "y"), "b": (None, 7, "z"), "c": (8, 3, None)}


def test_the_flow_reads_the_log_once(spark, sf):
    written = []
    grid.hourly_observations(base.status(spark, sf), stage=lambda df: written.append(df) or df)
    assert len(written) == 1 and plan(written[0]).count("FileScan") == 1
    text = plan(written[0])
    assert "Sort" not in text and text.count("Exchange") == 1


def test_refresh_in_two_steps_equals_one(spark, sf, tmp_path):
    s, wx, cal = base.status(spark, sf), base.weather(spark, sf), base.calendars(spark)
    cut = F.lit("2024-01-15 07:30:00").cast("timestamp_ntz")
    root = str(tmp_path / "data")
    jobs.refresh(spark, root, s.filter(F.col("dt") < cut), wx, cal, days=5, buckets=4)
    flow = jobs.refresh(spark, root, s, wx, cal, days=15, buckets=4)
    want = base.flow(spark, sf)
    got = base.rounded(flow, *base.FLOW_VALUES)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()
    recent = tables.current_table(spark, f"{root}/flow_recent")
    assert 0 < recent.count() < got.count()
    assert spark.read.text(f"{root}/stats/document").count() == 2, "one document per refresh"
    hours = tables.stats_history(spark, f"{root}/stats").select("datehour").distinct().collect()
    assert len(hours) == 2 and all(r.datehour is not None for r in hours)


def test_new_weather_alone_keeps_the_older_flow(spark, sf, tmp_path):
    s, wx, cal = base.status(spark, sf), base.weather(spark, sf), base.calendars(spark)
    cut = F.lit("2024-01-15 07:30:00").cast("timestamp_ntz")
    root = str(tmp_path / "data")
    jobs.refresh(spark, root, s.filter(F.col("dt") < cut), wx.filter(F.col("datehour") < cut), cal, days=5, buckets=4)
    got = jobs.refresh(spark, root, s, wx.filter(F.col("datehour") >= cut), cal, days=15, buckets=4)
    want = base.flow(spark, sf)
    got = base.rounded(got, *base.FLOW_VALUES)
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_stored_statistics_feed_the_shift_alert(spark, tmp_path):
    for k, ks in enumerate([0.05, 0.3, 0.3, 0.3]):
        rows = spark.createDataFrame([("5d", "kstest", "delta", ks), ("5d", "kstest", "temp", ks / 2)], "selection string, category string, metric string, value double")
        tables.write_stats(rows, str(tmp_path), f"h202401010{k}")
    history = tables.stats_history(spark, str(tmp_path)).filter("category = 'kstest'").select("datehour", "metric", F.col("value").alias("ks"))
    fired = {r.datehour.hour: r for r in alerts.shift_alert(history).collect()}
    assert len(fired) == 4 and fired[0].max_ks == 0.05


def test_hourly_drift_history_fires_over_stored_refreshes(spark, tmp_path):
    hours = spark.range(24 * 5).select((F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), "id")).alias("datehour"), "id")
    series = hours.select("datehour", F.lit("n_rows").alias("metric"), (F.col("id") % 24 + F.when(F.col("id") >= 72, 100).otherwise(0)).alias("value"))
    stats = drift.drift_history(series)
    for _ in range(2):  # a repeated write replaces its own parts
        tables.write_stats_history(stats, str(tmp_path))
    history = tables.stats_history(spark, str(tmp_path))
    assert history.select("datehour").distinct().count() == history.count() == 96
    rows = alerts.shift_alert(history.select("datehour", "metric", F.col("value").alias("ks"))).collect()
    at = {(r.datehour.day - 1) * 24 + r.datehour.hour: r for r in rows}
    assert at[71].max_ks == 0 and at[95].max_ks == 1 and at[119].max_ks == 0
    assert [h for h, r in at.items() if r.firing and h >= 48] and all(74 <= h < 120 for h, r in at.items() if r.firing and h >= 48)


def test_rows_without_time_or_station_leave_the_flow_unique(spark):
    import datetime as dt

    from dockflow.operators.grid import densify, hourly_observations

    t = dt.datetime(2024, 1, 1)
    hour = lambda n: t + dt.timedelta(hours=n)
    schema = "status_id bigint, station string, bikes int, capacity int, lat double, lon double, name string, dt timestamp_ntz"
    row = lambda i, s, at: (i, s, 5, 30, 48.0, 2.0, f"n{s}", at)
    rows = [row(1, "a", None), row(2, "a", hour(0)), row(3, "a", None), row(4, "a", hour(5)), row(5, "b", None), row(6, "c", hour(3)), row(7, None, hour(2)), row(8, "c", None)]
    dense = densify(hourly_observations(spark.createDataFrame(rows, schema)))
    keys = [(r.station, r.datehour) for r in dense.collect()]
    assert len(keys) == len(set(keys)) == 12 and {s for s, _ in keys} == {"a", "c"}
    hourly = spark.createDataFrame([("a", None, 1.0), ("a", hour(1), 2.0), ("a", hour(3), 4.0), (None, hour(2), 1.0)], "station string, datehour timestamp_ntz, bikes double")
    assert sorted(r.datehour for r in densify(hourly).collect()) == [hour(1), hour(2), hour(3)]


@pytest.mark.parametrize("bad", ["median", "x"])
def test_unknown_outlier_method(spark, bad):
    from dockflow.operators.outliers import outlier_borders

    with pytest.raises(ValueError):
        outlier_borders(spark.range(3).withColumn("n", F.col("id")), method=bad)
