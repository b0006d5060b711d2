import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockflow.functions.numeric import cyclic
from dockflow.operators import features, lags, models, scores
from tests.helpers import START, grid_frame, hours, same, to_spark

FLOW = "station string, datehour timestamp_ntz, delta double"


def flow(spark, seed=0, weeks=6, stations=2):
    rng = np.random.default_rng(seed)
    rows = [(str(s), h, float(rng.integers(-5, 6))) for s in range(stations) for h in hours(24 * 7 * weeks)]
    pdf = pd.DataFrame(rows, columns=["station", "datehour", "delta"])
    df = to_spark(spark, pdf, FLOW).withColumns(
        {
            "date": F.to_date("datehour"), "hour": F.hour("datehour"), "weekday": F.weekday("datehour"),
            "holiday": F.lit(0), "pont": F.lit(0),
        }
    )
    return pdf, df


@pytest.mark.parametrize("window", [3, 4, 5])
def test_smoothing_matches_centred_time_windows(spark, window):
    pdf = grid_frame(4, stations=2, n=200, known=0.7).rename(columns={"bikes": "delta"})
    df = to_spark(spark, pdf.sample(frac=0.8, random_state=1).sort_values(["station", "datehour"]), FLOW)
    pdf = df.orderBy("station", "datehour").toPandas()
    want = pdf.groupby("station", group_keys=False)[["datehour", "delta"]].apply(
        lambda g: g.rolling(f"{window}h", on="datehour", center=True, min_periods=1)["delta"].mean()
    )
    got = lags.smooth(df, window).orderBy("station", "datehour").toPandas()["delta"]
    same(got, want)


def test_smoothing_can_be_off(spark):
    _, df = flow(spark, weeks=1)
    assert lags.smooth(df, 0) is df


def test_seasonal_mean_is_shifted_and_needs_three_values(spark):
    pdf, df = flow(spark, 1, weeks=12)
    pdf["weekday"], pdf["hour"] = pdf["datehour"].dt.weekday, pdf["datehour"].dt.hour
    want = pdf.groupby(["station", "weekday", "hour"])["delta"].transform(lambda s: s.rolling(8, min_periods=3).mean().shift(1))
    got = lags.seasonal_mean(df).orderBy("station", "datehour").toPandas()["mean_value"]
    same(got, want)


def test_incomplete_days_have_no_peaks(spark):
    _, df = flow(spark, 2, weeks=1, stations=1)
    gap = df.filter(~((F.col("date") == "2024-01-02") & (F.col("hour") == 8)))
    assert {r.date for r in lags.day_peaks(gap).collect()} == {dt.date(2024, 1, d) for d in (1, 3, 4, 5, 6, 7)}
    kept = {r.date.day: r.morning_peak for r in lags.day_peaks(gap, keep_incomplete=True).collect()}
    assert kept[2] is None and kept[3] is not None


def test_peak_means_use_earlier_days_only(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=7 * i), float(i), float(-i)) for i in range(12)]
    days = spark.createDataFrame(rows, "station string, date date, morning_peak double, evening_peak double")
    got = {r.date: r.mean_6_12 for r in lags.peak_means(days).collect()}
    assert len(got) == 8 and got[rows[4][1]] == 1.5 and got[rows[11][1]] == np.mean(range(3, 11))


def test_lags_never_use_the_row_they_describe(spark):
    _, df = flow(spark, 3)
    out = lags.join_lags(df, lags.lag_history(df)).orderBy("station", "datehour").toPandas()
    same(out["lagged_value"], out.groupby("station")["delta"].shift(168))
    last = df.agg(F.max("datehour")).first()[0]
    changed = df.withColumn("delta", F.when(F.col("datehour") == last, 1000.0).otherwise(F.col("delta")))
    again = lags.join_lags(changed, lags.lag_history(changed)).orderBy("station", "datehour").toPandas()
    for c in lags.LAG_COLUMNS:
        keep = out["datehour"] == last
        same(out.loc[keep, c], again.loc[keep, c])
    known = lags.join_lags(df, lags.lag_history(df), leak_free=False).orderBy("station", "datehour").toPandas()
    same(known["lagged_value"], known["delta"])


def test_requests_after_the_history_carry_the_last_value(spark):
    _, df = flow(spark, 4, weeks=5, stations=1)
    req = df.filter("datehour >= timestamp_ntz'2024-01-29 00:00:00'").withColumn("datehour", F.col("datehour") + F.expr("interval 14 days"))
    out = lags.join_lags(req, lags.lag_history(df), ["lagged_value"]).orderBy("datehour").toPandas()
    same(out["lagged_value"], req.orderBy("datehour").toPandas()["delta"])
    assert len(out) == req.count()


def test_lag_lead_matrix(spark):
    _, df = flow(spark, 5, weeks=1, stations=2)
    out = lags.lag_lead(df.select("station", "datehour", "delta"), 3)
    assert out.count() == 2 * (168 - 6)
    r = out.filter("station = '0'").orderBy("datehour").first()
    base = [x.delta for x in df.filter("station = '0'").orderBy("datehour").limit(7).collect()]
    assert [r.lag_3, r.lag_2, r.lag_1, r.delta_0, r.delta_1, r.delta_2, r.delta_3] == base


def test_day_matrix_drops_incomplete_days(spark):
    _, df = flow(spark, 6, weeks=1, stations=1)
    gap = df.withColumn("delta", F.when((F.col("date") == "2024-01-03") & (F.col("hour") == 3), None).otherwise(F.col("delta")))
    rows = lags.day_matrix(gap, ["delta", "hour"]).collect()
    assert len(rows) == 6 and all([v[1] for v in r.matrix] == list(range(24)) for r in rows)


def test_scaling_and_onehot_edges(spark):
    df = spark.createDataFrame([(1.0, 5, "a"), (3.0, 5, "b")], "x double, k int, c string")
    bounds = features.minmax_fit(df, ["x", "k"])
    out = features.minmax_apply(df, bounds, ["x", "k"]).orderBy("x").collect()
    assert [(r.x, r.k) for r in out] == [(0.0, 0.0), (1.0, 0.0)]
    vocabulary = features.onehot_fit(df, ["c"])
    unseen = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    got = {r.c: (r.c_a, r.c_b) for r in features.onehot_apply(unseen, vocabulary).collect()}
    assert got == {"a": (1.0, 0.0), "zz": (0.0, 0.0), None: (0.0, 0.0)}


def test_onehot_vectors_of_fifty_thousand_values(spark):
    df = spark.range(50_000).select(F.format_string("v%06d", "id").alias("c"), F.col("id"))
    more = df.unionByName(spark.createDataFrame([("zz", -1), (None, -2)], "c string, id bigint"))
    got = {r.id: r.c_onehot for r in features.onehot_vectors(more, {"c": features.index_fit(df, "c")}).collect()}
    assert len(got) == 50_002 and {v.size for v in got.values()} == {50_000}
    assert all(list(got[i].indices) == [i] and list(got[i].values) == [1.0] for i in range(50_000))
    assert list(got[-1].indices) == list(got[-2].indices) == []


def test_cyclic_default_period_is_the_distinct_count(spark):
    df = spark.createDataFrame([(i % 4,) for i in range(8)], "x int")
    r = cyclic(df, ["x"]).filter("x = 1").first()
    assert r.sin_x == pytest.approx(1) and r.cos_x == pytest.approx(0, abs=1e-12)


def test_tail_split_keeps_whole_hours_below_the_share(spark):
    _, df = flow(spark, 7, weeks=1, stations=3)
    head, tail = features.tail_split(df, 0.3)
    n, t = df.count(), tail.count()
    assert head.count() + t == n and 0.3 * n - 3 < t <= 0.3 * n
    assert head.agg(F.max("datehour")).first()[0] < tail.agg(F.min("datehour")).first()[0]


def test_rebalance_keeps_every_rush_row_and_is_repeatable(spark):
    df = spark.range(20000).select("id", F.when(F.col("id") % 20 == 0, 9.0).otherwise(0.0).alias("delta"))
    rush = F.col("delta") > 5
    out = features.rebalance(df, rush, ["id"], 3.0, 2)
    assert out.filter(rush).count() == 2000 and out.filter(rush).select("id").distinct().count() == 1000
    calm = out.filter(~rush)
    assert abs(calm.count() - 3000) < 250
    assert calm.exceptAll(features.rebalance(df, rush, ["id"], 3.0, 2).filter(~rush)).count() == 0


def test_scores_and_weights(spark):
    rows = [("a", dt.date(2024, 1, 4), h, float(h % 5 - 2), 0.0) for h in range(24)]
    df = spark.createDataFrame(rows, "station string, date date, hour int, delta_test double, delta_pred double")
    e = np.array([r[3] for r in rows])
    s = scores.regression_scores(df).first()
    assert s.rmse == pytest.approx(np.sqrt((e ** 2).mean())) and s.mae == pytest.approx(abs(e).mean())
    peak = scores.peak_scores(df, F.lit(-1.5), F.lit(1.5)).first()
    assert peak.pic_mae == 2 and peak.pic_rmse == 2
    hr = np.arange(24)
    morning, evening = e[(hr >= 6) & (hr <= 12)].sum(), e[(hr >= 15) & (hr <= 22)].sum()
    r = scores.rush_error(df, "a").first()
    assert r.mare == r.date_station_mare == pytest.approx((abs(morning) + abs(evening)) / 2)
    assert scores.rush_error(df, "b").first().station_mare is None
    w = features.rush_weights(df, F.lit(-1.5), F.lit(1.5), 2, 3, "delta_test")
    weights = np.where(e > 1.5, 3, np.where(e < -1.5, 2, 1))
    losses = scores.weighted_losses(w).first()
    assert losses.wmae == pytest.approx((weights * abs(e)).mean()) and losses.wmse == pytest.approx((weights * e * e).mean())


def test_parameter_grid_links(spark):
    spec = spark.createDataFrame([(["3", "5"], ["@wl"], ["a", "b"])], "wl array<string>, wh array<string>, loss array<string>")
    grid = models.param_grid(spec, ["wl", "wh", "loss"])
    assert sorted(map(tuple, grid.collect())) == [("3", "3", "a"), ("3", "3", "b"), ("5", "5", "a"), ("5", "5", "b")]
    done = spark.createDataFrame([("3", "3", "a")], "wl string, wh string, loss string")
    assert models.pending_grid(grid, done).count() == 3


def test_start_is_a_monday():
    assert START.weekday() == 0
