"""Grid search with a run ledger: fits scored and logged one by one, restarted where they stopped, the best handed on.

The ledger is an append-only table: a run's record is written when it starts and again when it ends, and its newest record counts. A run's
id is a hash of experiment, data set and parameters, so a job that starts again finds what is finished by an anti join. Two jobs on one
ledger may fit a combination twice, to the same record.
"""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.operators.features import rush_weights
from dockflow.operators.models import fit_flow, mark_tail, pending_grid, rounds, scored
from dockflow.operators.ranking import margins
from dockflow.operators.reports import dataset_id, latest_rows
from dockflow.operators.scores import PRED, TRUE, _mae, _rmse, is_peak, rush_error
from dockflow.plans.jobs import retrain
from dockflow.plans.pipeline import FeaturePipeline, PipelineConfig
from dockflow.sources.tables import exists, load_table, save_table

RUN = """experiment string, run_id string, status string, created timestamp_ntz, start_time timestamp_ntz, end_time timestamp_ntz,
params map<string, string>, tags map<string, string>, metrics map<string, double>"""

# What a parameter of a combination is read as; an empty one takes its default.
PARAMETERS = {
    "kind": str, "wl": float, "wh": float, "holdout": float, "maxIter": int, "maxDepth": int, "stepSize": float, "regParam": float,
    "subsamplingRate": float, "validationTol": float, "seed": int,
}


def run_records(spark: SparkSession, root: str) -> DataFrame:
    """Every record of the ledger; none if it isn't there yet."""
    path = f"{root}/runs"
    return spark.read.schema(RUN).parquet(path) if exists(spark, path) else spark.createDataFrame([], RUN)


def runs(spark: SparkSession, root: str) -> DataFrame:
    """The newest record of every run, in the columns that ``run_summary`` reads."""
    record = F.struct("status", "created", "start_time", "end_time", "params", "tags", "metrics")
    # of two records of one moment the end of a run comes after its start
    order = F.struct("created", (F.col("status") != "RUNNING").alias("ended"))
    latest = run_records(spark, root).groupBy("experiment", "run_id").agg(F.max_by(record, order).alias("r"))
    return latest.select("experiment", "run_id", "r.*")


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class Run:
    """One fit's place in the ledger."""

    def __init__(self, spark: SparkSession, root: str, experiment: str, dataset: str, params: dict[str, str], starter: str) -> None:
        text = "|".join([experiment, dataset, *(f"{k}={params[k]}" for k in sorted(params))])
        self.spark, self.root, self.experiment, self.params = spark, root, experiment, params
        self.run_id = hashlib.sha256(text.encode()).hexdigest()[:32]
        self.tags = {"starter": starter, "dataset": dataset}
        self.started = _now()
        self.record("RUNNING")

    def record(self, status: str, metrics: dict[str, float] | None = None, **tags: str) -> None:
        now = _now()
        ended = None if status == "RUNNING" else now
        row = (self.experiment, self.run_id, status, now, self.started, ended, self.params, {**self.tags, **tags}, metrics or {})
        self.spark.createDataFrame([row], RUN).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    @property
    def model_path(self) -> str:
        return f"{self.root}/models/{self.run_id}"

    @property
    def predictions_path(self) -> str:
        return f"{self.root}/predictions/{self.run_id}"


def measures(df: DataFrame, low: Column, high: Column, station: str | None = None, baselines: dict[str, Column] | None = None) -> dict[str, float]:
    """Scores of predictions (station, datehour, true and predicted flow): all, peaks, rush sums, and each baseline's error."""
    peak = is_peak(low, high)
    errors = [F.sqrt(F.avg(F.pow(F.col(TRUE) - guess, 2))).alias(f"{name}_rmse") for name, guess in (baselines or {}).items()]
    first = df.agg(
        F.count(F.lit(1)).cast("double").alias("n_test"), _rmse().alias("rmse"), _mae().alias("mae"), _rmse(peak).alias("pic_rmse"),
        _mae(peak).alias("pic_mae"), *errors,
    ).first()
    timed = df.withColumns({"hour": F.hour("datehour"), "date": F.to_date("datehour")})
    second = rush_error(timed, station or "").first()
    return {k: v for k, v in {**first.asDict(), **second.asDict()}.items() if v is not None}


def _typed(params: dict[str, str]) -> dict:
    unknown = sorted(set(params) - set(PARAMETERS))
    if unknown:
        raise ValueError(f"unknown parameters: {', '.join(unknown)}")
    return {k: PARAMETERS[k](v) for k, v in params.items() if v != ""}


def train_run(
    run: Run, train: DataFrame, test: DataFrame, features: list[str], low: float, high: float,
    station: str | None = None, baselines: dict[str, str] | None = None, target: str = "delta",
) -> dict[str, float]:
    """Fit with hold-out and early stop, save model and predictions, and score them.

    ``validation_rmse``, the error on the newest part of the fit rows, is what combinations are compared by: the test rows choose nothing.
    """
    options = _typed(run.params)
    wl, wh, kind, holdout = options.pop("wl", 5.0), options.pop("wh", 5.0), options.pop("kind", "trees"), options.pop("holdout", 0.3)
    rows, validation = mark_tail(rush_weights(train, F.lit(low), F.lit(high), wl, wh, target), holdout)
    model = fit_flow(rows, features, kind, target=target, validation_col=validation, **options)
    model.write().overwrite().save(run.model_path)
    extra = sorted(set((baselines or {}).values()))
    save_table(scored(model, test, target).select("station", "datehour", TRUE, PRED, *extra), run.predictions_path)
    predicted = load_table(run.spark, run.predictions_path)
    guesses = {"zero": F.lit(0.0), **{name: F.col(c) for name, c in (baselines or {}).items()}}
    out = measures(predicted, F.lit(low), F.lit(high), station, guesses)
    if validation:
        tail = scored(model, rows.filter(validation), target).agg(_rmse().alias("validation_rmse"), F.count(F.lit(1)).cast("double").alias("n_validation"))
        out |= tail.first().asDict()
    kept = rounds(model)
    return out if kept is None else out | {"rounds": float(kept)}


def finished_params(spark: SparkSession, root: str, experiment: str, dataset: str, names: list[str]) -> DataFrame:
    """Parameters of the finished runs on a data set, a column each."""
    mine = runs(spark, root).filter((F.col("experiment") == experiment) & (F.col("status") == "FINISHED"))
    same = mine.filter((F.try_element_at("tags", F.lit("dataset")) == dataset) & (F.size("params") == len(names)))
    return same.select(*[F.try_element_at("params", F.lit(n)).alias(n) for n in names])


def run_grid(
    spark: SparkSession, root: str, experiment: str, grid: DataFrame, train: DataFrame, test: DataFrame, features: list[str],
    station: str | None = None, baselines: dict[str, str] | None = None, starter: str = "grid", target: str = "delta",
) -> DataFrame:
    """Fit, score and log every combination of the grid that isn't finished on this data set; returns the ledger's runs.

    A combination that fails is logged as failed with its error, the others go on, and the next call tries it again. ``train`` and ``test``
    hold feature rows (``prepare_rows``); ``baselines`` names columns of the test rows that are scored beside the model.
    """
    dataset = dataset_id(train).first()["dataset_id"]
    sample = f"{root}/datasets/{dataset}"
    if not exists(spark, f"{sample}/_SUCCESS"):
        save_table(latest_rows(train), sample)
    edge = margins(train, target).first()
    names = grid.columns
    done = finished_params(spark, root, experiment, dataset, names)
    pending = pending_grid(grid.select(*[F.col(n).cast("string").alias(n) for n in names]).fillna(""), done)
    for row in sorted(pending.distinct().collect()):  # one row per model to fit
        run = Run(spark, root, experiment, dataset, row.asDict(), starter)
        try:
            found = train_run(run, train, test, features, edge["low"], edge["high"], station, baselines, target)
        except Exception as error:
            run.record("FAILED", error=f"{type(error).__name__}: {error}"[:1000])
        else:
            run.record("FINISHED", found)
    return runs(spark, root)


def best_run(all_runs: DataFrame, experiment: str, metric: str = "validation_rmse", dataset: str | None = None) -> DataFrame:
    """One row, the finished run with the lowest ``metric`` (of equals the lowest id): run_id, params, and the metric."""
    mine = all_runs.filter((F.col("experiment") == experiment) & (F.col("status") == "FINISHED"))
    if dataset:
        mine = mine.filter(F.try_element_at("tags", F.lit("dataset")) == dataset)
    value = F.try_element_at("metrics", F.lit(metric))
    best = mine.filter(value.isNotNull() & ~F.isnan(value)).agg(F.min_by(F.struct("run_id", "params", value.alias(metric)), F.struct(value, "run_id")).alias("r"))
    return best.filter("r is not null").select("r.*")


def prepare_rows(spark: SparkSession, root: str, train: DataFrame, test: DataFrame, config: PipelineConfig | None = None) -> tuple[DataFrame, DataFrame, FeaturePipeline]:
    """Feature rows of train and test by a pipeline fitted on the train rows, stored once per data set for all combinations."""
    path = f"{root}/prepared/{dataset_id(train).first()['dataset_id']}"
    if not exists(spark, f"{path}/test/_SUCCESS"):
        pipeline = FeaturePipeline.fit(train, config)
        pipeline.save(f"{path}/pipeline")
        save_table(pipeline.transform(train, fitting=True), f"{path}/train")
        save_table(pipeline.transform(test), f"{path}/test")
    return load_table(spark, f"{path}/train"), load_table(spark, f"{path}/test"), FeaturePipeline.load(spark, f"{path}/pipeline")


def retrain_best(spark: SparkSession, root: str, experiment: str, flow: DataFrame, path: str, config: PipelineConfig | None = None) -> tuple[FeaturePipeline, PipelineModel]:
    """Retrain on the given flow with the parameters of the experiment's best run."""
    best = best_run(runs(spark, root), experiment).first()
    if best is None:
        raise ValueError(f"no finished run of {experiment}")
    given = _typed(best["params"])
    return retrain(flow, path, config, **{"kind": "trees", **given})
