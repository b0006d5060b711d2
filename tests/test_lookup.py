"""Requests open their own buckets and days of a table laid out by station."""

import datetime as dt

from pyspark.sql import functions as F

from dockflow.operators import lags, lookup, weather
from dockflow.operators.filters import WEATHER_COLUMNS
from tests.helpers import START, hours


def opened_files(df):
    """Files the scans of an executed query opened."""
    df.collect()
    def scans(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return scans(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return scans(node.plan())
        own = [(node.metadata().apply("Location"), node.metrics().apply("numFiles").value())] if name == "FileSourceScanExec" else []
        children = node.children()
        return own + [x for k in range(children.size()) for x in scans(children.apply(k))]
    return [n for at, n in scans(df._jdf.queryExecution().executedPlan())]


def table(spark, tmp_path, stations=12, days=40):
    rows = [(f"s{k}", h, float(k), h.weekday(), h.hour, 0) for k in range(stations) for h in hours(24 * days)]
    df = spark.createDataFrame(rows, "station string, datehour timestamp_ntz, lagged_value double, weekday int, hour int, dayoff int")
    return df, lookup.save_by_station(df.repartition(4), str(tmp_path / "t"), 6)


def request(spark, stations, day):
    at = START + dt.timedelta(days=day, hours=7)
    return spark.createDataFrame([(s, at, at.weekday(), 7, 0, 0) for s in stations], "station string, datehour timestamp_ntz, weekday int, hour int, holiday int, pont int")


def test_one_station_reads_its_bucket_up_to_its_day(spark, tmp_path):
    plain, laid = table(spark, tmp_path)
    req = request(spark, ["s3"], 20)
    got, want = (lags.join_lags(req, h, ["lagged_value"]) for h in (laid, plain))
    text = got._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in text.splitlines() if "PartitionFilters" in line and "bucket" in line)
    assert "Subquery" in filters and "day" in filters, "buckets and days are pruned when the query runs"
    assert sorted(got.collect()) == sorted(want.collect())
    assert max(opened_files(got)) <= 21, "one bucket of six, 21 days of 40"


def test_weather_of_past_hours_reads_the_requested_days(spark, tmp_path):
    plain, _ = table(spark, tmp_path)
    flow = plain.select("station", "datehour", *[F.col("lagged_value").alias(c) for c in WEATHER_COLUMNS])
    laid = lookup.save_by_station(flow, str(tmp_path / "flow"), 6)
    req = request(spark, ["s3", "s5"], 20).select("station", "datehour")
    got, want = (weather.join_weather_auto(req, f, flow.limit(0)) for f in (laid, flow))
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() == 2
    assert max(opened_files(weather.join_weather_past(req, laid))) <= 2


def test_layout_keeps_its_number_of_buckets(spark, tmp_path):
    _, laid = table(spark, tmp_path, stations=2, days=1)
    assert lookup.bucket_count(laid) == 6 and lookup.bucket_count(laid.drop("bucket")) == 0
