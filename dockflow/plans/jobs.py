"""Refresh, retrain and predict jobs."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.days import add_calendar
from dockflow.functions.timefn import day_hours
from dockflow.operators.drift import profile_report
from dockflow.operators.features import rush_weights
from dockflow.operators.filters import drop_incomplete, valid_stations
from dockflow.operators.lags import smooth
from dockflow.operators.models import fit_flow, mark_tail
from dockflow.operators.weather import join_weather_auto
from dockflow.plans.flow import stage_hours
from dockflow.plans.incremental import FlowStore
from dockflow.plans.pipeline import FeaturePipeline, PipelineConfig
from dockflow.session import shuffle_width
from dockflow.sources.status import append_batches
from dockflow.sources.tables import append_status, append_weather, current_table, load_table, newer_than, publish, recent_slice, save_table, write_stats


@dataclass
class Calendars:
    holidays: DataFrame
    breaks: DataFrame
    uni_breaks: DataFrame


def merged_log(raw: DataFrame, incoming: DataFrame) -> DataFrame:
    """Stored log plus the incoming rows after its newest hour mark."""
    return append_batches(raw, newer_than(incoming, raw))


def refresh(
    spark: SparkSession, root: str, incoming: DataFrame, weather: DataFrame, cal: Calendars, days: int = 30, **options,
) -> DataFrame:
    """Append newer rows to the stored log and the weather to its log, merge them into the flow, and publish the flow's
    7-day slice and this refresh's statistics.

    Newer means after the hour of the newest row merged before, which the store's manifest names: the log is not read again.
    The flow with its weather is stored once, since the statistics read it about ten times and the caller once more.
    A failed refresh that is run again appends its rows twice; merging and de-duplication take them once.
    """
    store = flow_store(spark, root, **options)
    state = store.state()
    if state and state.mark:
        incoming = incoming.filter(F.col("dt") > F.lit(str(state.mark.replace(minute=0, second=0, microsecond=0))).cast("timestamp_ntz"))
    append_status(incoming, f"{root}/status")
    store.merge(incoming)
    state = store.state()
    mark = state.mark.strftime("%Y%m%d%H")
    known = append_weather(weather, f"{root}/weather", f"h{mark}")
    flow = stage_hours(store.flow(known, cal.holidays, cal.breaks, cal.uni_breaks))
    latest = store.flow(known, cal.holidays, cal.breaks, cal.uni_breaks, since=max(state.days, default=state.mark.date()) - timedelta(days=8))
    publish(recent_slice(latest), f"{root}/flow_recent")
    write_stats(profile_report(flow, days), f"{root}/stats", f"h{mark}")
    return flow


def flow_store(spark: SparkSession, root: str, **options) -> FlowStore:
    return FlowStore(spark, f"{root}/flow", **options)


def retrain(
    flow: DataFrame, path: str, config: PipelineConfig | None = None, kind: str = "trees",
    wl: float = 5.0, wh: float = 5.0, holdout: float = 0.3, **params,
) -> tuple[FeaturePipeline, PipelineModel]:
    """Smooth, fit the feature pipeline and the weighted model, and save them with the stations.

    The transformed rows are stored once, because the trees read them every iteration. The newest ``holdout`` of them aren't fitted on: trees
    stop by their error there.
    """
    config = config or PipelineConfig()
    smoothed = smooth(flow, config.smooth_window)
    save_table(smoothed, f"{path}/smoothed")
    train = load_table(flow.sparkSession, f"{path}/smoothed")
    pipeline = FeaturePipeline.fit(train, config)
    pipeline.save(f"{path}/pipeline")
    stations = train.groupBy("station").agg(
        F.max_by(F.struct("lat", "lon", "name", "capacity"), "datehour").alias("s")
    ).select("station", "s.*")
    if pipeline.clusters is not None:
        stations = stations.join(pipeline.clusters.select("station", "cluster", "metacluster"), "station", "left")
    save_table(stations, f"{path}/stations")
    save_table(pipeline.transform(train, fitting=True), f"{path}/features")
    rows = rush_weights(
        load_table(flow.sparkSession, f"{path}/features"), F.lit(pipeline.low), F.lit(pipeline.high), wl, wh
    )
    rows, validation = mark_tail(rows, holdout)
    model = fit_flow(rows, pipeline.feature_columns, kind, validation_col=validation, **params)
    model.write().overwrite().save(f"{path}/model")
    return pipeline, model


def load_model(spark: SparkSession, path: str) -> tuple[FeaturePipeline, PipelineModel, DataFrame]:
    return (
        FeaturePipeline.load(spark, f"{path}/pipeline"), PipelineModel.load(f"{path}/model"),
        load_table(spark, f"{path}/stations"),
    )


def request_grid(stations: DataFrame, hours: DataFrame) -> DataFrame:
    """Every requested station at every requested hour.

    The hours, bounded by the calendar, travel as one array that each station row unrolls; the
    stations are spread first so that the rows of a long request come from many tasks.
    """
    wanted = hours.agg(F.array_sort(F.collect_set("datehour")).alias("h")).scalar()
    spread = stations.select("station").distinct().repartition(shuffle_width(stations.sparkSession), "station")
    return spread.withColumn("datehour", F.explode(wanted))


def join_station(req: DataFrame, dim: DataFrame) -> DataFrame:
    """Request rows with position and capacity, null for an unknown station."""
    return req.join(dim.select("station", "lat", "lon", "capacity"), "station", "left")


def prediction_rows(
    stations: DataFrame, hours: DataFrame, dim: DataFrame, flow: DataFrame, forecast: DataFrame, cal: Calendars,
) -> DataFrame:
    """Complete model input rows of a request; requests without weather or station are dropped."""
    req = join_station(request_grid(stations, hours), dim)
    req = add_calendar(req, cal.holidays, cal.breaks, cal.uni_breaks)
    req = join_weather_auto(req, flow, forecast)
    return drop_incomplete(req).withColumns({"reconstructed": F.lit(False)})


def predict(
    stations: DataFrame, hours: DataFrame, pipeline: FeaturePipeline, model: PipelineModel, dim: DataFrame,
    flow: DataFrame, forecast: DataFrame, cal: Calendars,
) -> DataFrame:
    """(station, datehour, prediction) for every requested station and hour."""
    rows = prediction_rows(stations, hours, dim, flow, forecast, cal)
    return model.transform(pipeline.transform(rows)).select("station", "datehour", "prediction")


def predict_stored(
    spark: SparkSession, root: str, model_path: str, stations: DataFrame, hours: DataFrame, forecast: DataFrame, cal: Calendars,
) -> DataFrame:
    """Predictions from what the jobs left: the model with its stations, and the flow's published 7-day slice for hours
    already recorded. The whole flow isn't opened."""
    pipeline, model, dim = load_model(spark, model_path)
    recent = current_table(spark, f"{root}/flow_recent")
    return predict(valid_stations(stations, dim), hours, pipeline, model, dim, recent, forecast, cal)


def predict_day(dates: DataFrame, pipeline, model, dim: DataFrame, flow: DataFrame, forecast: DataFrame, cal: Calendars) -> DataFrame:
    """All stations for every hour of the given dates."""
    return predict(dim, day_hours(dates), pipeline, model, dim, flow, forecast, cal)


def predict_station_day(
    stations: DataFrame, dates: DataFrame, pipeline, model, dim: DataFrame, flow: DataFrame, forecast: DataFrame, cal: Calendars,
) -> DataFrame:
    """The known ones among the requested stations for every hour of the given dates."""
    return predict(valid_stations(stations, dim), day_hours(dates), pipeline, model, dim, flow, forecast, cal)
