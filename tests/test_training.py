import pytest
from pyspark.sql import functions as F

from dockflow.operators import models
from dockflow.operators.reports import run_summary
from dockflow.plans import training
from dockflow.registry import base


def noisy(spark, n=24 * 80):
    """Hourly rows whose flow follows the hour at first and is noise at the end."""
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 100 - 5
    hour = (F.col("id") % 24).cast("double")
    flow = F.when(hour.between(6, 9), 6.0).when(hour.between(16, 19), -6.0).otherwise(0.0)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(n).select(
        F.lit("s").alias("station"), (start + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datehour"), hour.alias("hour"),
        (F.pmod(F.xxhash64(F.col("id") + 7), F.lit(1000)) / 1000).alias("x"), (flow + noise).alias("delta"), F.lit(1.0).alias("weight"),
    )


def test_trees_stop_where_the_tail_gets_no_better(spark):
    rows, mark = models.mark_tail(noisy(spark), 0.3)
    assert rows.filter(mark).count() == int(0.3 * rows.count())
    stopped = models.fit_flow(rows, ["hour", "x"], "trees", validation_col=mark, maxIter=40, maxDepth=3)
    full = models.fit_flow(rows.filter(~F.col(mark)), ["hour", "x"], "trees", maxIter=40, maxDepth=3)
    assert 1 <= models.rounds(stopped) < 40 == models.rounds(full)
    error = lambda m: models.scored(m, rows.filter(mark)).agg(F.sqrt(F.avg(F.pow(F.col("delta_test") - F.col("delta_pred"), 2)))).first()[0]
    assert error(stopped) <= error(full) * 1.01


def test_linear_fit_ignores_the_tail(spark):
    rows, mark = models.mark_tail(noisy(spark), 0.3)
    a = models.fit_flow(rows, ["hour", "x"], "linear", validation_col=mark).stages[-1]
    b = models.fit_flow(rows.withColumn("delta", F.when(F.col(mark), 1e6).otherwise(F.col("delta"))), ["hour", "x"], "linear", validation_col=mark).stages[-1]
    assert list(a.coefficients) == pytest.approx(list(b.coefficients)) and models.rounds(models.fit_flow(rows, ["x"], "linear")) is None


def test_a_short_table_has_no_tail(spark):
    rows, mark = models.mark_tail(noisy(spark, 2), 0.3)
    assert mark is None and "validation" not in rows.columns


def grid(spark):
    spec = spark.createDataFrame([(["linear", "trees"], ["1", "5"], ["@wl"], ["4"])], "kind array<string>, wl array<string>, wh array<string>, maxIter array<string>")
    return models.param_grid(spec, ["kind", "wl", "wh", "maxIter"])


def test_a_killed_grid_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    rows, root, fits = noisy(spark), str(tmp_path), []
    train, test = rows.filter("datehour < timestamp_ntz'2024-03-01'"), rows.filter("datehour >= timestamp_ntz'2024-03-01'")
    args = (spark, root, "trial", grid(spark), train, test, ["hour", "x"])
    real = training.fit_flow

    def watched(*a, **k):
        fits.append(a[2])
        if len(fits) == 2:
            raise KeyboardInterrupt
        if len(fits) == 4:
            raise ValueError("no luck")
        return real(*a, **k)

    monkeypatch.setattr(training, "fit_flow", watched)
    with pytest.raises(KeyboardInterrupt):
        training.run_grid(*args)
    first = {r.run_id: r.status for r in training.runs(spark, root).collect()}
    assert sorted(first.values()) == ["FINISHED", "RUNNING"]
    second = {r.run_id: r.status for r in training.run_grid(*args).collect()}
    assert sorted(second.values()) == ["FAILED", "FINISHED", "FINISHED", "FINISHED"] and len(fits) == 5 and set(first) <= set(second)
    third = training.run_grid(*args).collect()
    assert len(fits) == 6 and {r.status for r in third} == {"FINISHED"} and len(third) == 4
    training.run_grid(*args)
    assert len(fits) == 6, "nothing is fitted twice"
    for r in third:
        assert {"rmse", "mae", "mare", "zero_rmse", "validation_rmse", "n_validation"} <= set(r.metrics)
        assert r.params["wl"] == r.params["wh"] and ("rounds" in r.metrics) == (r.params["kind"] == "trees")
    best = training.best_run(training.runs(spark, root), "trial").first()
    assert best.validation_rmse == min(r.metrics["validation_rmse"] for r in third) and best.params in [r.params for r in third]
    summary = run_summary(training.runs(spark, root)).first()
    assert (summary.n_runs, summary.starter, summary.finished) == (4, "grid", 1) and summary.duration_seconds >= 0
    records = training.run_records(spark, root).groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in records} == {"RUNNING": 6, "FINISHED": 4, "FAILED": 1}


def test_unknown_parameters_are_logged_as_failed(spark, tmp_path):
    rows = noisy(spark, 24 * 10)
    odd = spark.createDataFrame([("linear", "3")], "kind string, layers string")
    out = training.run_grid(spark, str(tmp_path), "odd", odd, rows, rows, ["hour"]).first()
    assert out.status == "FAILED" and "layers" in out.tags["error"]
    assert training.best_run(training.runs(spark, str(tmp_path)), "odd").count() == 0
    with pytest.raises(ValueError):
        training.retrain_best(spark, str(tmp_path), "odd", rows, str(tmp_path / "m"))


def test_features_are_prepared_once_and_the_best_is_retrained(spark, sf, tmp_path):
    from dockflow.operators import filters
    from dockflow.plans.jobs import load_model
    from dockflow.plans.pipeline import FeaturePipeline, PipelineConfig
    from dockflow.registry.models import SPLIT

    flow, root = base.flow(spark, sf), str(tmp_path)
    _, train, test = filters.time_split(flow, split=SPLIT)
    config = PipelineConfig(clusterize=False, hotencode=[], mean_peaks=False)
    a, b, pipeline = training.prepare_rows(spark, root, train, test, config)
    before = sorted(a.inputFiles())
    again = training.prepare_rows(spark, root, train, test, config)
    assert sorted(again[0].inputFiles()) == before and again[2].feature_columns == pipeline.feature_columns
    specs = spark.createDataFrame([("linear", ""), ("trees", "3")], "kind string, maxIter string")
    out = training.run_grid(spark, root, "flow", specs, a, b, pipeline.feature_columns, station="3").collect()
    assert {r.status for r in out} == {"FINISHED"} and all(r.metrics["n_test"] == test.count() and "station_mare" in r.metrics for r in out)
    training.retrain_best(spark, root, "flow", train, f"{root}/best", config)
    fitted, model, stations = load_model(spark, f"{root}/best")
    best = training.best_run(training.runs(spark, root), "flow").first()
    assert (models.rounds(model) is None) == (best.params["kind"] == "linear")
    assert isinstance(fitted, FeaturePipeline) and stations.count() == 15
