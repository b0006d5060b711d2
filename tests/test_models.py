import itertools
import json
import uuid

import numpy as np
import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from dockflow.operators import clusters, filters, models
from dockflow.plans import jobs
from dockflow.plans.pipeline import FeaturePipeline, PipelineConfig
from dockflow.registry import base
from dockflow.registry import models as reg
from dockflow.registry.features import shifted_forecast
from dockflow.sources.tables import publish, recent_slice

STATION = "cluster int, station string, lon double, lat double"


def ring(feature):
    geometry = json.loads(feature)["geometry"]
    assert geometry["type"] == "Polygon" and len(geometry["coordinates"]) == 1
    points = geometry["coordinates"][0]
    assert points[0] == points[-1]
    return [tuple(p) for p in points[:-1]]


def hull_by_brute_force(points):
    """Points that lie on a line with all others on one side."""
    out = set()
    for a, b in itertools.permutations(points, 2):
        side = [(b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0]) for c in points]
        if min(side) >= 0 and sum(s == 0 for s in side) == 2:
            out |= {a, b}
    return out


def test_borders_match_brute_force_over_many_batches(spark):
    rng = np.random.default_rng(0)
    rows = [(int(c), f"{c}-{i}", float(rng.random()), float(rng.random())) for c in range(2) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {r.cluster: r for r in clusters.cluster_borders(spark.createDataFrame(rows, STATION).repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    for c in range(2):
        points = [(r[2], r[3]) for r in rows if r[0] == c]
        found = ring(got[c].feature)
        assert set(found) == hull_by_brute_force(points) and got[c].n_stations == 60
        area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(found, found[1:] + found[:1]))
        assert area > 0, "counter-clockwise"


def test_small_and_collinear_clusters(spark):
    rows = [(1, "a", 1.0, 1.0), (2, "b", 5.0, 5.0), (2, "a", 4.0, 4.0), (3, "a", 0.0, 0.0), (3, "b", 1.0, 1.0), (3, "c", 2.0, 2.0),
            (4, "a", 0.0, 0.0), (4, "b", 1.0, 0.0), (4, "c", 0.0, 1.0)]
    got = {r.cluster: ring(r.feature) for r in clusters.cluster_borders(spark.createDataFrame(rows, STATION)).collect()}
    assert got[1] == [(1.0, 1.0)] and got[2] == [(4.0, 4.0)]
    assert set(got[3]) == {(0.0, 0.0), (2.0, 2.0)} and len(got[4]) == 3


def blobs(spark, n=600, groups=9, seed=1):
    rng = np.random.default_rng(seed)
    at = rng.uniform(0, 9000, (groups, 4)) * [1, 1, 1e-3, 1e-3]
    x = at[rng.integers(0, groups, n)] + rng.normal(0, 300, (n, 4)) * [1, 1, 1e-3, 1e-3]
    schema = "station string, " + ", ".join(f"{c} double" for c in clusters.FEATURES)
    return x, spark.createDataFrame([(f"s{i}", *map(float, r)) for i, r in enumerate(x)], schema).repartition(5)


def test_batched_kmeans_equals_single_fits_from_the_same_seeds(spark):
    x, points = blobs(spark)
    ks = [2, 5, 9, 14]
    start = clusters.seeds(points, clusters.FEATURES, max(ks))
    assert len(start) == max(ks) and len(np.unique(start, axis=0)) == max(ks)
    got = clusters.batched_kmeans(points, clusters.FEATURES, {k: start[:k] for k in ks})
    scores = clusters.silhouettes(points, clusters.FEATURES, got)
    for k in ks:
        c = start[:k].copy()
        for _ in range(clusters.MAX_ITERATIONS):
            label = ((x[:, None] - c) ** 2).sum(2).argmin(1)
            new = np.array([x[label == j].mean(0) if (label == j).any() else c[j] for j in range(k)])
            still = ((new - c) ** 2).sum(1).max() <= clusters.TOLERANCE**2
            c = new
            if still:
                break
        assert np.allclose(got[k], c, rtol=0, atol=1e-6)
        label = ((x[:, None] - c) ** 2).sum(2).argmin(1)
        frame = spark.createDataFrame([(Vectors.dense(r), int(j)) for r, j in zip(x, label)], ["features", "prediction"])
        assert scores[k] == pytest.approx(ClusteringEvaluator().evaluate(frame), abs=1e-9)


def jobs_of(spark, run):
    group = f"jobs-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_jobs_do_not_grow_with_the_candidates(spark):
    _, points = blobs(spark)
    start = clusters.seeds(points, clusters.FEATURES, 40)
    def run(ks):
        centres = clusters.batched_kmeans(points, clusters.FEATURES, {k: start[:k] for k in ks}, iterations=3)
        clusters.silhouettes(points, clusters.FEATURES, centres)
    assert jobs_of(spark, lambda: run(range(38, 41))) == jobs_of(spark, lambda: run(range(10, 41))) > 0


def test_kmeans_of_few_equal_or_no_stations(spark):
    schema = "station string, " + ", ".join(f"{c} double" for c in clusters.FEATURES)
    same = spark.createDataFrame([(str(i), 1.0, 2.0, 3.0, 4.0) for i in range(5)], schema)
    assert [(r.k, r.score) for r in clusters.silhouette_sweep(same, [2, 3, 9]).collect()] == [(2, None), (3, None), (9, None)]
    assert [r.score for r in clusters.silhouette_sweep(same.filter("false"), [2, 3]).collect()] == [None, None]
    two = same.unionByName(spark.createDataFrame([("z", 1.0, 2.0, 3.0, 5.0)], schema))
    assert {r.k: r.score for r in clusters.silhouette_sweep(two, [2]).collect()}[2] == pytest.approx(5 / 6)


def test_every_station_gets_one_cluster(spark, sf):
    labels = reg.labels(spark, sf).collect()
    assert len({r.station for r in labels}) == len(labels) == 15
    assert 1 < len({r.cluster for r in labels}) <= len(labels) and 1 < len({r.metacluster for r in labels}) <= max(clusters.REGION_RANGE)


@pytest.mark.parametrize("kind", models.KINDS)
def test_weighted_models_beat_zero_and_season_on_a_learnable_flow(spark, kind):
    hour = (F.col("id") % 24).cast("double")
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 - 0.5)
    df = spark.range(24 * 60).select(
        "id", hour.alias("hour"), (F.floor(F.col("id") / 24) % 7).cast("double").alias("weekday"),
        F.when(hour.between(6, 9), 6.0).when(hour.between(16, 19), -6.0).otherwise(0.0).alias("rush"), noise.alias("noise"),
    ).withColumn("delta", F.col("rush") + 0.5 * F.col("weekday") + F.col("noise"))
    train, test = df.filter("id < 1000"), df.filter("id >= 1000")
    out = {r.model: r for r in models.compare_models(
        models.with_rush_weights(train, 5, 5), test, ["hour", "weekday", "rush"], (kind,),
        {"zero": F.lit(0.0), "season": F.col("rush")},
    ).collect()}
    assert out[kind].rmse < out["season"].rmse < out["zero"].rmse and out[kind].mae < out["season"].mae


CONFIG = dict(cluster_ks=[3], region_ks=[2])


def test_pipeline_has_no_nulls_and_ignores_test_rows(spark, sf, tmp_path):
    _, train, test = filters.time_split(base.flow(spark, sf), split=reg.SPLIT)
    fitted = FeaturePipeline.fit(train, PipelineConfig(**CONFIG))
    out = fitted.transform(test)
    assert out.columns == ["station", "datehour", *fitted.feature_columns, "delta"]
    assert filters.null_audit(out).first().null_cells == 0 and out.count() == test.count()
    assert all(t == "double" for c, t in out.dtypes if c in fitted.feature_columns)
    changed = test.withColumn("delta", F.col("delta") + 100)
    key = ["station", "datehour", *fitted.feature_columns]
    rounded = lambda df: df.select("station", "datehour", *[F.round(c, 9).alias(c) for c in fitted.feature_columns])
    assert rounded(out.select(key)).exceptAll(rounded(fitted.transform(changed).select(key))).count() == 0
    fitted.save(str(tmp_path / "p"))
    again = FeaturePipeline.load(spark, str(tmp_path / "p"))
    assert again.feature_columns == fitted.feature_columns
    assert rounded(out).exceptAll(rounded(again.transform(test))).count() == 0


def test_pipeline_switches(spark, sf):
    _, train, test = filters.time_split(base.flow(spark, sf), split=reg.SPLIT)
    config = PipelineConfig(clusterize=False, hotencode=[], geoencode=True, reconstructed=False, mean_peaks=False, mean_value=False)
    fitted = FeaturePipeline.fit(train, config)
    out = fitted.transform(test)
    assert "reconstructed" not in out.columns and "mean_6_12" not in out.columns
    assert out.count() == test.filter("not reconstructed").count()
    box = out.agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first()
    assert min(box) >= 0 and max(box) <= 1


def test_predictions_cover_the_request(spark, sf):
    rest = (*jobs.load_model(spark, reg.retrained(spark, sf)), base.flow(spark, sf), shifted_forecast(spark, sf), base.calendars(spark))
    pipeline, model, dim, flow, forecast, cal = rest
    days = reg.next_days(spark, sf)
    assert days.count() == 2
    out = jobs.predict_day(days, pipeline, model, dim, flow, forecast, cal)
    rows = out.collect()
    assert len(rows) == 15 * 48 == len({(r.station, r.datehour) for r in rows})
    assert all(np.isfinite(r.prediction) for r in rows)
    wanted = spark.createDataFrame([("3",), ("nowhere",)], "station string")
    one = jobs.predict_station_day(wanted, days, pipeline, model, dim, flow, forecast, cal).collect()
    assert {r.station for r in one} == {"3"} and len(one) == 48
    by_key = {(r.station, r.datehour): r.prediction for r in rows}
    assert all(by_key[r.station, r.datehour] == pytest.approx(r.prediction) for r in one)


def test_fit_rows_have_no_guessed_lags(spark, sf):
    flow = base.flow(spark, sf)
    pipeline = FeaturePipeline.fit(flow, PipelineConfig(clusterize=False, hotencode=[], mean_peaks=False))
    fitted, all_rows = pipeline.transform(flow, fitting=True), pipeline.transform(flow)
    assert filters.null_audit(fitted).first().null_cells == 0 and 0 < fitted.count() < all_rows.count()
    known = pipeline.history.select("station", "weekday", "hour", "dayoff", "datehour", "lagged_value")
    first = known.filter("lagged_value is not null").groupBy("station", "weekday", "hour", "dayoff").agg(F.min("datehour").alias("first"))
    keyed = fitted.select("station", "datehour").join(flow.withColumn("dayoff", F.greatest("holiday", "pont")), ["station", "datehour"])
    assert keyed.join(first, ["station", "weekday", "hour", "dayoff"]).filter("datehour <= first").count() == 0


def test_stored_model_and_recent_slice_predict(spark, sf, tmp_path):
    root, path, cal = str(tmp_path / "data"), reg.retrained(spark, sf), base.calendars(spark)
    flow = base.flow(spark, sf)
    publish(recent_slice(flow), f"{root}/flow_recent")
    hours = flow.select((F.col("datehour") + F.expr("interval 12 hours")).alias("datehour")).distinct().filter("datehour > timestamp_ntz'2024-01-30 00:00:00'")
    wanted = flow.select("station").distinct().limit(3)
    got = jobs.predict_stored(spark, root, path, wanted, hours, shifted_forecast(spark, sf), cal)
    pipeline, model, dim = jobs.load_model(spark, path)
    want = jobs.predict(wanted, hours, pipeline, model, dim, flow, shifted_forecast(spark, sf), cal)
    assert sorted(got.collect()) == sorted(want.collect()) and got.count() > 0


def test_vectors_of_a_wide_column_survive_saving_and_feed_the_fit(spark, sf, tmp_path):
    flow = base.flow(spark, sf).filter("datehour >= timestamp_ntz'2024-01-20'")
    config = PipelineConfig(clusterize=False, hotencode=[], hotvectors=["name"], lagged_value=False, lagged_value_3hours_mean=False, mean_value=False, mean_peaks=False)
    pipeline = FeaturePipeline.fit(flow, config)
    pipeline.save(str(tmp_path))
    loaded = FeaturePipeline.load(spark, str(tmp_path))
    rows = loaded.transform(flow)
    assert loaded.feature_columns[-2:] == ["name_onehot", "reconstructed"]
    names = flow.select("name").distinct().count()
    got = rows.groupBy("station").agg(F.collect_set(unwrap_udt("name_onehot")["indices"]).alias("at"), F.max(unwrap_udt("name_onehot")["size"]).alias("size")).collect()
    assert sorted(r["at"][0][0] for r in got) == list(range(names)) and {r["size"] for r in got} == {names}
    model = models.fit_flow(rows, loaded.feature_columns, "linear", weight_col=None)
    assert len(model.stages[-1].coefficients) == len(loaded.feature_columns) - 1 + names
