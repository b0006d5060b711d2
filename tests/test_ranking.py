import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import features, ranking
from dockflow.operators.drift import profile

RNG = np.random.default_rng(5)
SAMPLES = {
    "normal": (RNG.normal(size=700).round(3), RNG.normal(0.3, size=500).round(3)),
    "ties": (RNG.integers(0, 4, 900).astype(float), RNG.integers(1, 5, 300).astype(float)),
    "constant": (np.ones(50), np.ones(70)),
    "disjoint": (np.arange(40.0), np.arange(100.0, 140.0)),
}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")


@pytest.mark.parametrize("name", SAMPLES)
def test_quantiles_and_ks_match_numpy(spark, name):
    a, b = SAMPLES[name]
    q = ranking.exact_quantiles(frame(spark, a), ["x"], [0.0, 0.25, 0.5, 0.9, 1.0]).first()
    assert np.allclose([q[f"q_{i}"] for i in range(5)], np.quantile(a, [0, 0.25, 0.5, 0.9, 1]))
    both = np.concatenate([a, b])
    want = max(abs((a <= v).mean() - (b <= v).mean()) for v in both)
    assert ranking.ks_stat(frame(spark, a), frame(spark, b), ["x"]).first()["ks"] == pytest.approx(want)


def test_same_sample_has_no_drift_and_disjoint_full(spark):
    a, b = SAMPLES["disjoint"]
    assert ranking.ks_stat(frame(spark, a), frame(spark, a), ["x"]).first()["ks"] == 0
    assert ranking.ks_stat(frame(spark, a), frame(spark, b), ["x"]).first()["ks"] == 1


def test_profile_counts_outliers_with_both_fences(spark):
    x = np.concatenate([RNG.normal(size=300), [50.0, 60.0, -70.0]])
    df = frame(spark, x)
    got = {r.metric: r.value for r in profile(df, ["x"]).collect()}
    q1, q3 = np.quantile(x, [0.25, 0.75])
    iqr = (q3 - q1) * 1.5
    assert got["all"] == 304 and got["na"] == 1 and got["x_na"] == 1
    assert got["x_outliers_top"] == (x > q3 + iqr).sum() and got["x_outliers_bottom"] == (x < q1 - iqr).sum()
    assert got["x_low"] == pytest.approx(q1 - iqr) and got["x_high"] == pytest.approx(q3 + iqr)


def test_prefix_sums_do_not_depend_on_the_number_of_ranges(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"), F.col("id").alias("n"))
    want = {(k, v): sum(x for x in range(1000) if x % 2 == k and x <= v) for k, v in [(0, 500), (1, 999), (0, 0)]}
    rows = {(r.k, r.v): r.cum_n for r in ranking.prefix_sums(df, ["k"], "v", ["n"]).collect()}
    assert all(rows[k] == v for k, v in want.items())


def test_index_is_dense_in_value_order_and_unknown_is_minus_one(spark):
    known = spark.createDataFrame([(f"s{i:03d}",) for i in range(200)] * 2, "station string")
    d = features.index_fit(known, "station")
    assert {r.station: r.station_index for r in d.collect()} == {f"s{i:03d}": i for i in range(200)}
    out = features.index_apply(spark.createDataFrame([("s007",), ("zz",), (None,)], "station string"), d, "station")
    assert sorted(r.station_index for r in out.collect()) == [-1, -1, 7]


def test_ranges_keep_the_order_of_doubles(spark):
    x = np.concatenate([RNG.normal(size=400) * 10.0 ** RNG.integers(-300, 300, 400), [0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, np.inf, -np.inf]])
    rows = spark.createDataFrame([(float(v),) for v in x], "x double").select("x", ranking.value_range(F.col("x")).alias("r")).collect()
    rows = sorted(rows, key=lambda r: r.x)
    assert all(a.r <= b.r for a, b in zip(rows, rows[1:]))
    assert spark.createDataFrame([(float("nan"),)], "x double").select(ranking.value_range(F.col("x"))).first()[0] > rows[-1].r


def test_quantiles_of_wide_and_negative_values(spark):
    x = np.concatenate([-(10.0 ** RNG.uniform(-5, 5, 300)), 10.0 ** RNG.uniform(-5, 5, 333), np.zeros(40)])
    q = ranking.exact_quantiles(frame(spark, x), ["x"], [0.1, 0.33, 0.5, 0.77]).first()
    assert np.allclose([q[f"q_{i}"] for i in range(4)], np.quantile(x, [0.1, 0.33, 0.5, 0.77])) and q["low"] == x.min() and q["high"] == x.max() and q["n"] == 673


def test_ks_inside_one_range_and_of_an_empty_sample(spark):
    a, b = 1000 + RNG.uniform(0, 0.5, 300), 1000 + RNG.uniform(0.1, 0.6, 200)
    want = max(abs((a <= v).mean() - (b <= v).mean()) for v in np.concatenate([a, b]))
    assert ranking.ks_stat(frame(spark, a), frame(spark, b), ["x"]).first()["ks"] == pytest.approx(want)
    assert ranking.ks_stat(frame(spark, a), frame(spark, []), ["x"]).first()["ks"] is None


def test_building_statistics_runs_no_job(spark):
    df, tracker = frame(spark, SAMPLES["normal"][0]), spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    ranking.margins(df, "x"), ranking.ks_stat(df, df, ["x"]), profile(df, ["x"])
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_only_ranges_with_a_wanted_rank_are_opened(spark):
    df = spark.range(200_000).select((F.col("id") * 1.0).alias("x"))
    q = ranking.exact_quantiles(df, ["x"], [0.5])
    q.collect()
    text = q._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "repartition" not in text.lower()
    assert q.first()["q_0"] == 99_999.5
