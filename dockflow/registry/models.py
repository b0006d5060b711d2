"""Clusters, feature pipeline, models and jobs; checked by row invariants and tests, not SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators import clusters, filters, lags, models
from dockflow.plans import jobs, training
from dockflow.plans.pipeline import FeaturePipeline, PipelineConfig
from dockflow.registry.base import FLOW, FLOW_VALUES, SCORED, calendars, flow, query, rounded, s4, scored, status, stored, weather
from dockflow.registry.features import shifted_forecast
from dockflow.session import scratch_path
from dockflow.sources.tables import load_table

SPLIT = date(2024, 1, 24)

_RETRAINED: dict[tuple[str, str], str] = {}


def labels(spark, sf) -> DataFrame:
    return stored(spark, sf, "labels", lambda: clusters.cluster_stations(flow(spark, sf)))


def config() -> PipelineConfig:
    return PipelineConfig(
        encode_time={"hour": 24, "weekday": 7, "month": 12}
    )


def retrained(spark, sf) -> str:
    """Folder of a model trained on the flow before the split."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RETRAINED:
        path = scratch_path(spark, "model")
        _, train, _ = filters.time_split(flow(spark, sf), split=SPLIT)
        jobs.retrain(train, path, config(), "trees")
        _RETRAINED[key] = path
    return _RETRAINED[key]


def next_days(spark, sf, n: int = 2) -> DataFrame:
    """The last flow days and the following ones as a request."""
    days = flow(spark, sf).groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    newest = days.agg(F.max("date").alias("d")).scalar()
    return days.filter(F.col("date") > F.date_sub(newest, n)).select(F.date_add("date", 1).alias("date"))


@query("j05_cluster_stations")
def _(spark, sf):
    return labels(spark, sf)


@query("j06_silhouette_sweep")
def _(spark, sf):
    return clusters.silhouette_sweep(clusters.cluster_features(flow(spark, sf)), clusters.CLUSTER_RANGE)


@query("j07_cluster_borders")
def _(spark, sf):
    return clusters.cluster_borders(labels(spark, sf))


@query("d09_join_clusters")
def _(spark, sf):
    f = flow(spark, sf).select("station", "datehour", "delta")
    return clusters.join_clusters(f, labels(spark, sf))


@query("d09_join_clusters_of_some", f"""WITH {FLOW} SELECT station, datehour, delta, CASE WHEN CAST(station AS BIGINT) % 5 > 0 THEN CAST(CAST(station AS BIGINT) % 9 AS INTEGER) END AS cluster,
CASE WHEN CAST(station AS BIGINT) % 5 > 0 THEN CAST(CAST(station AS BIGINT) % 3 AS INTEGER) END AS metacluster FROM flow""")
def _(spark, sf):
    """Every row stays; a station without labels has none."""
    f, n = flow(spark, sf), F.col("station").cast("long")
    some = f.select("station").distinct().filter(n % 5 > 0).withColumns({"cluster": (n % 9).cast("int"), "metacluster": (n % 3).cast("int")})
    return clusters.join_clusters(f.select("station", "datehour", "delta"), some)


MODEL_FEATURES = ["hour", "weekday", "weekend", "holiday", "temp", "precip", "vent", "bikes", "delta_pred"]


@query("j11_fit_flow_linear")
def _(spark, sf):
    return _fitted(spark, sf, "linear")


@query("j11_fit_flow_trees")
def _(spark, sf):
    return _fitted(spark, sf, "trees")


def _fitted(spark, sf, kind: str, **params) -> DataFrame:
    _, train, test = filters.time_split(scored(spark, sf), split=date(2024, 1, 28))
    model = models.fit_flow(models.with_rush_weights(train, 5.0, 5.0), MODEL_FEATURES, kind, **params)
    columns = ["station", "datehour", F.col("delta").alias("delta_test"), F.col("prediction").alias("delta_pred")]
    return model.transform(test).select(*columns)


@query("j12_compare_models")
def _(spark, sf):
    rows = models.with_rush_weights(scored(spark, sf).withColumnRenamed("delta_pred", "season"), 5.0, 5.0)
    _, train, test = filters.time_split(rows, split=date(2024, 1, 28))
    features = [c if c != "delta_pred" else "season" for c in MODEL_FEATURES]
    return models.compare_models(
        train, test, features, baselines={"zero": F.lit(0.0), "season": F.col("season")}
    )


@query("j14_grid_job", f"""WITH {SCORED}, split AS (SELECT *, datehour >= TIMESTAMP '2024-01-28' AS is_test FROM scored),
per_hour AS (SELECT datehour, sum(count(*)) OVER (ORDER BY datehour DESC) AS tail, sum(count(*)) OVER () AS total FROM split WHERE NOT is_test GROUP BY 1),
held AS (SELECT count(*) AS n FROM split WHERE NOT is_test AND datehour >= (SELECT min(datehour) FROM per_hour WHERE tail <= 0.3 * total)),
params(kind, wh, wl) AS (VALUES ('linear', '1', '1'), ('linear', '5', '5'), ('trees', '1', '1'), ('trees', '5', '5'))
SELECT kind, wl, wh, 'FINISHED' AS status, CAST(count(*) AS BIGINT) AS n_test, (SELECT CAST(n AS BIGINT) FROM held) AS n_validation,
{s4("sqrt(avg(delta * delta))")} AS zero_rmse, {s4("sqrt(avg((delta - delta_pred) * (delta - delta_pred)))")} AS season_rmse, true AS has_rmse
FROM split, params WHERE is_test GROUP BY kind, wl, wh""")
def _(spark, sf):
    """Ledger of a grid job on the rows before the split, scored after it."""
    rows = scored(spark, sf).withColumnRenamed("delta_pred", "season").drop("delta_test")
    _, train, test = filters.time_split(rows, split=date(2024, 1, 28))
    spec = spark.createDataFrame([(["linear", "trees"], ["1", "5"], ["@wl"], ["5"])], "kind array<string>, wl array<string>, wh array<string>, maxIter array<string>")
    grid = models.param_grid(spec, ["kind", "wl", "wh", "maxIter"])
    features = [c if c != "delta_pred" else "season" for c in MODEL_FEATURES]
    runs = training.run_grid(spark, scratch_path(spark, "grid"), "grid", grid, train, test, features, baselines={"season": "season"})
    m = lambda name: F.try_element_at("metrics", F.lit(name))
    return runs.select(
        "params.kind", "params.wl", "params.wh", "status", m("n_test").cast("long").alias("n_test"), m("n_validation").cast("long").alias("n_validation"),
        F.round(m("zero_rmse"), 4).alias("zero_rmse"), F.round(m("season_rmse"), 4).alias("season_rmse"), m("rmse").isNotNull().alias("has_rmse"),
    )


@query("j17_fit_transform_features")
def _(spark, sf):
    _, train, test = filters.time_split(lags.smooth(flow(spark, sf)), split=SPLIT)
    return FeaturePipeline.fit(train, config()).transform(test)


def _predict(spark, sf, kind: str) -> DataFrame:
    pipeline, model, dim = jobs.load_model(spark, retrained(spark, sf))
    rest = (pipeline, model, dim, flow(spark, sf), shifted_forecast(spark, sf), calendars(spark))
    days = next_days(spark, sf)
    if kind == "day":
        return jobs.predict_day(days, *rest)
    if kind == "station_day":
        wanted = dim.select("station").unionByName(dim.select(F.concat(F.lit("x"), "station").alias("station")))
        return jobs.predict_station_day(wanted, days, *rest)
    hours = flow(spark, sf).groupBy("datehour").agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    newest = hours.agg((F.max("datehour") - F.expr("interval 12 hours")).alias("t")).scalar()
    ahead = hours.filter(F.col("datehour") > newest).select((F.col("datehour") + F.expr("interval 6 hours")).alias("datehour"))
    return jobs.predict(dim, ahead, *rest)


@query("j18_predict")
def _(spark, sf):
    return _predict(spark, sf, "hours")


@query("j19_predict_day")
def _(spark, sf):
    return _predict(spark, sf, "day")


@query("j19_predict_station_day")
def _(spark, sf):
    return _predict(spark, sf, "station_day")


@query("j20_retrain_stations")
def _(spark, sf):
    return load_table(spark, f"{retrained(spark, sf)}/stations")


@query("j20_retrain_attributes", f"""WITH {FLOW} SELECT station, max_by(lat, datehour) AS lat, max_by(lon, datehour) AS lon, max_by(name, datehour) AS name,
max_by(capacity, datehour) AS capacity FROM flow WHERE datehour < TIMESTAMP '{SPLIT}' GROUP BY station""")
def _(spark, sf):
    return load_table(spark, f"{retrained(spark, sf)}/stations").drop("cluster", "metacluster")


@query("a13_refresh_job", f"WITH {FLOW} SELECT * FROM flow")
def _(spark, sf):
    """Two refreshes: half of the log, then everything up to now."""
    root, s = scratch_path(spark, "refresh"), status(spark, sf)
    wx, cal = weather(spark, sf), calendars(spark)
    half = F.lit("2024-01-15 07:30:00").cast("timestamp_ntz")
    jobs.refresh(spark, root, s.filter(F.col("dt") < half), wx, cal, days=5, buckets=4)
    return rounded(jobs.refresh(spark, root, s, wx, cal, days=15, buckets=4), *FLOW_VALUES)
