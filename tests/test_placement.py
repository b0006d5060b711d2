"""Station tables are placed once; lag histories are sorted once per key."""

from datetime import datetime, timedelta

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.operators import lags
from dockflow.registry import base
from dockflow.session import shuffle_width


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_readers_of_stored_station_hours_shuffle_nothing(spark):
    start = datetime(2024, 1, 1)
    rows = [(str(k % 40), start + timedelta(hours=k // 40), float(k % 7)) for k in range(4000)] * 2
    made = spark.createDataFrame(rows, "station string, datehour timestamp_ntz, delta double")
    got = base.stored(spark, "test-placement", "hours", lambda: made, by_station=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, made.collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = got.withColumn("before", F.lag("delta").over(W.partitionBy("station").orderBy("datehour")))
        days = got.groupBy("station", F.to_date("datehour").alias("date")).agg(F.sum("delta").alias("d"))
        assert "Exchange" not in _plan(seen) and "Exchange" not in _plan(days)
        assert "Exchange" not in _plan(seen.join(days, "station"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _lags(spark, leak_free):
    start = datetime(2024, 1, 1)
    hour = lambda d: start + timedelta(days=7 * d)
    req = spark.createDataFrame([("a", hour(d), 0, 0, 0, 0) for d in range(6)] + [("b", hour(1), 0, 0, 0, 0)],
                                "station string, datehour timestamp_ntz, weekday int, hour int, holiday int, pont int")
    hist = spark.createDataFrame([("a", hour(d), 0, 0, 0, v, v, v, v, v) for d, v in ((1, None), (2, 2.0), (4, 4.0))],
                                 "station string, datehour timestamp_ntz, weekday int, hour int, dayoff int, " + ", ".join(f"{c} double" for c in lags.LAG_COLUMNS))
    return lags.join_lags(req, hist, leak_free=leak_free)


def test_known_history_fills_backward_with_the_first_known_value(spark):
    got = {(r.station, r.datehour.day + 31 * (r.datehour.month - 1)): tuple(r[c] for c in lags.LAG_COLUMNS) for r in _lags(spark, False).collect()}
    assert got == {**{("a", 1 + 7 * d): (v,) * 5 for d, v in enumerate((2.0, 2.0, 2.0, 2.0, 4.0, 4.0))}, ("b", 8): (None,) * 5}


def test_known_history_sorts_once_per_key_in_parts_of_bounded_size(spark):
    plan = _plan(_lags(spark, False))
    assert plan.count("Sort [") <= 2 and "datehour#" in plan and f", {lags.STACK_PARTS * shuffle_width(spark)})" in plan
