import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.operators import dedup, grid, outliers
from dockflow.session import scratch_path
from dockflow.sources.tables import write_and_read
from tests.helpers import START

SCHEMA = "status_id bigint, station string, bikes int, capacity int, lat double, lon double, name string, dt timestamp_ntz"


def log(spark, n=3000, seed=0):
    """Log in which one station holds a third of the rows and copies abound."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        s = "hot" if rng.random() < 0.34 else str(rng.integers(0, 6))
        t = START + dt.timedelta(minutes=int(rng.integers(0, 60 * 24 * 6) // 20 * 20))
        rows.append((i, s, int(rng.integers(0, 3)), 30, 48.8, 2.3, f"n{i % 2}", t))
    return rows, spark.createDataFrame(rows, SCHEMA)


def pandas_log(rows):
    return pd.DataFrame(rows, columns=["status_id", "station", "bikes", "capacity", "lat", "lon", "name", "dt"])


def test_exact_copies_and_first_per_hour(spark):
    rows, df = log(spark)
    pdf = pandas_log(rows).sort_values(["dt", "status_id"])
    keep = pdf.drop_duplicates(["dt", "bikes", "capacity", "station"])
    assert sorted(r.status_id for r in dedup.drop_exact(df).collect()) == sorted(keep["status_id"])
    first = keep.assign(h=keep["dt"].dt.floor("h")).drop_duplicates(["station", "h"])
    assert sorted(r.status_id for r in dedup.first_per_hour(df).collect()) == sorted(first["status_id"])
    report = {r.kind: r for r in dedup.duplicate_report(df).collect()}
    assert report["exact"].duplicates == len(pdf) - len(keep)
    assert report["hour"].duplicates == len(keep) - len(first)


def test_delta_on_the_raw_log_crosses_blocks_and_ties(spark):
    rows, df = log(spark, 2000, 1)
    pdf = pandas_log(rows).sort_values(["station", "dt", "status_id"])
    want = dict(zip(pdf["status_id"], pdf.groupby("station")["bikes"].diff()))
    got = {r.status_id: r.delta for r in grid.add_delta_log(df).collect()}
    assert got.keys() == want.keys()
    assert all((got[k] is None) == np.isnan(v) and (got[k] is None or got[k] == v) for k, v in want.items())


def test_delta_of_a_burst_is_spread_over_ranges(spark):
    """A million reports of one station in one instant, between few others: no range holds a large part of them."""
    burst = spark.range(1_000_000).select(
        F.col("id").alias("status_id"), F.lit("hot").alias("station"), F.xxhash64("id").alias("bikes"), F.lit(START).cast("timestamp_ntz").alias("dt"))
    burst = burst.withColumn("bikes", F.pmod("bikes", F.lit(30)).cast("int"))
    edges = spark.createDataFrame(
        [(-1, "hot", 3, START - dt.timedelta(days=1)), (-2, "a", 4, START), (2_000_000, "z", 5, START), (2_000_001, "z", 9, START + dt.timedelta(days=9)),
         (2_000_002, None, 1, START), (2_000_003, None, 7, START), (2_000_004, "z", None, None)], "status_id bigint, station string, bikes int, dt timestamp_ntz")
    log_rows = burst.unionByName(edges)
    sizes = []

    def stage(out):
        stored = write_and_read(out, scratch_path(spark, "burst"))
        sizes.extend(r["count"] for r in stored.filter("not _last").groupBy("_part").count().collect())
        return stored

    got = grid.add_delta_log(log_rows, width=16, stage=stage)
    assert sum(sizes) == 1_000_007 and len(sizes) > 12 and max(sizes) < 150_000
    w = W.partitionBy("station").orderBy("dt", "status_id")
    want = log_rows.withColumn("delta", F.col("bikes") - F.lag("bikes").over(w))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_delta_of_empty_logs_and_more_ranges_than_rows(spark):
    rows, df = log(spark, 5, 1)
    assert grid.add_delta_log(df.filter("false")).collect() == []
    w = W.partitionBy("station").orderBy("dt", "status_id")
    want = df.withColumn("delta", F.col("bikes") - F.lag("bikes").over(w))
    for width in (1, 3, 40):
        assert sorted(map(str, grid.add_delta_log(df, width=width).collect())) == sorted(map(str, want.collect()))


def test_latest_attributes_and_capacity(spark):
    rows, df = log(spark, 500, 2)
    pdf = pandas_log(rows).sort_values(["dt", "status_id"])
    want = pdf.groupby("station")["name"].last().to_dict()
    assert {r.station: r.name for r in dedup.station_dim(df).collect()} == want
    top = pdf.groupby("station")["bikes"].max().to_dict()
    assert {(r.station, r.capacity) for r in dedup.fix_capacity(df).collect()} == set(top.items())


def test_dense_series_is_complete_unique_and_equal_to_a_grid_join(spark):
    _, df = log(spark, 800, 3)
    hourly = grid.hourly_observations(df)
    dense = grid.densify(hourly)
    joined = grid.hour_grid(hourly).join(hourly.select("station", "datehour", "bikes"), ["station", "datehour"], "left")
    a = sorted(map(str, dense.select("station", "datehour", "bikes").collect()))
    b = sorted(map(str, joined.select("station", "datehour", "bikes").collect()))
    assert a == b
    assert dense.select("station", "datehour").distinct().count() == len(a)


def test_incomplete_first_report_leaves_a_gap(spark):
    h = START + dt.timedelta(hours=1)
    rows = [
        (1, "a", None, 30, 1.0, 2.0, "x", START), (2, "a", 5, 30, 1.0, 2.0, "x", START + dt.timedelta(minutes=5)),
        (3, "a", 9, 30, 1.0, 2.0, "y", h),
    ]
    out = grid.hourly_observations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.datehour, r.bikes, r.capacity, r.name) for r in out] == [(h, 9.0, 9.0, "y")]


def test_outlier_labels(spark):
    counts = spark.createDataFrame([(str(i), 10 + i % 3) for i in range(20)] + [("lo", 1), ("hi", 99)], "station string, n bigint")
    labels = {r.station: r.label for r in outliers.outlier_labels(counts).collect()}
    assert labels["lo"] == "low" and labels["hi"] == "high" and labels["3"] == "normal"
    hard = {r.station: r.label for r in outliers.outlier_labels(counts, k=5, method="hard").collect()}
    assert hard["lo"] == "low" and hard["hi"] == "normal"
    rows = counts.select("station", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    kept = {r.station for r in outliers.drop_outliers(rows, "station").select("station").distinct().collect()}
    assert "hi" not in kept and "lo" not in kept and "3" in kept
    assert outliers.drop_outliers(rows, "station", legacy=True).count() == rows.count()
