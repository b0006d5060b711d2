"""Weighted flow regressors, their comparison, and parameter grids."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.operators.features import rush_weights, tail_boundary
from dockflow.operators.ranking import margins
from dockflow.operators.scores import PRED, TRUE, _mae, _rmse, is_peak

KINDS = ("linear", "trees")


def with_rush_weights(df: DataFrame, wl: float, wh: float, col: str = "delta") -> DataFrame:
    """Rush weights from the frame's own margins."""
    m = margins(df, col).first()
    return rush_weights(df, F.lit(m["low"]), F.lit(m["high"]), wl, wh, col)


def fit_flow(
    df: DataFrame, features: list[str], kind: str = "linear", weight_col: str | None = "weight",
    target: str = "delta", seed: int = 0, validation_col: str | None = None, **params,
) -> PipelineModel:
    """Fit a weighted linear model or boosted trees on the feature columns.

    A loss weighted by the true value alone is the same as a weight per row. Rows marked by ``validation_col`` aren't fitted on; trees stop
    at the round from which their error falls no further (``validationTol``).
    """
    options = {"featuresCol": "features", "labelCol": target, "predictionCol": "prediction", **params}
    if weight_col:
        options["weightCol"] = weight_col
    if validation_col and kind == "linear":
        df = df.filter(~F.col(validation_col))
    elif validation_col:
        options["validationIndicatorCol"] = validation_col
    if kind == "linear":
        model = LinearRegression(**{"regParam": 1e-3, **options})
    elif kind == "trees":
        model = GBTRegressor(**{"maxIter": 20, "maxDepth": 5, "seed": seed, **options})
    else:
        raise ValueError(f"unknown model {kind!r}: {', '.join(KINDS)}")
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), model]).fit(df)


def mark_tail(df: DataFrame, frac: float, target: str = "validation") -> tuple[DataFrame, str | None]:
    """Rows with a mark on the newest ``frac`` of them in whole hours, and the mark's name; unmarked and None if no whole hour fits."""
    at = tail_boundary(df, frac).first()["boundary"]
    return (df, None) if at is None else (df.withColumn(target, F.col("datehour") >= F.lit(at)), target)


def rounds(model: PipelineModel) -> int | None:
    """Trees that a fitted model kept; None for a linear one."""
    last = model.stages[-1]
    return last.getNumTrees if hasattr(last, "getNumTrees") else None


def scored(model: PipelineModel, df: DataFrame, target: str = "delta") -> DataFrame:
    """Test rows with true and predicted flow."""
    out = model.transform(df).drop("features")
    return out.withColumnRenamed("prediction", PRED).withColumn(TRUE, F.col(target))


def score_row(df: DataFrame, name: str, low: Column, high: Column) -> DataFrame:
    peak = is_peak(low, high)
    return df.agg(
        _rmse().alias("rmse"), _mae().alias("mae"), _rmse(peak).alias("pic_rmse"), _mae(peak).alias("pic_mae")
    ).select(F.lit(name).alias("model"), "rmse", "mae", "pic_rmse", "pic_mae")


def compare_models(
    train: DataFrame, test: DataFrame, features: list[str], kinds: tuple[str, ...] = KINDS,
    baselines: dict[str, Column] | None = None, **params,
) -> DataFrame:
    """Scores of every model kind and of constant or column baselines on the test rows."""
    m = margins(train).first()
    low, high = F.lit(m["low"]), F.lit(m["high"])
    parts = [
        score_row(test.withColumns({TRUE: F.col("delta"), PRED: guess}), name, low, high)
        for name, guess in (baselines or {}).items()
    ]
    for kind in kinds:
        model = fit_flow(train, features, kind, **(params if kind == "trees" else {}))
        parts.append(score_row(scored(model, test), kind, low, high))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def param_grid(spec: DataFrame, params: list[str]) -> DataFrame:
    """Every combination of the candidate arrays of each specification row.

    ``spec`` holds one array of strings per parameter; a value ``@name`` takes the value that
    the row's other parameter has in the same combination.
    """
    out = spec
    for p in params:
        out = out.withColumn(p, F.explode(p))
    links = {
        p: F.when(
            F.col(p).startswith("@"),
            F.coalesce(*[F.when(F.col(p) == f"@{other}", F.col(other)) for other in params if other != p]),
        ).otherwise(F.col(p))
        for p in params
    }
    return out.withColumns(links) if len(params) > 1 else out


def pending_grid(grid: DataFrame, done: DataFrame) -> DataFrame:
    """Combinations not marked as done."""
    keys = [c for c in grid.columns if c in done.columns]
    return grid.join(done.select(*keys), keys, "left_anti")
