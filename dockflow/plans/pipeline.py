"""Feature pipeline: fitted on training rows, applied to any rows."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.numeric import cyclic, to_metres
from dockflow.operators.clusters import CLUSTER_RANGE, REGION_RANGE, cluster_stations, join_clusters
from dockflow.operators.features import index_fit, minmax_apply, minmax_fit, onehot_apply, onehot_fit, onehot_vectors
from dockflow.operators.filters import float_features, observed_only
from dockflow.operators.lags import HISTORY_DAYS, LAG_COLUMNS, PEAK_MEANS, join_lags, lag_history
from dockflow.operators.lookup import load_by_station, save_by_station
from dockflow.operators.ranking import margins
from dockflow.session import scratch_path
from dockflow.sources.tables import last_days, load_table, save_table, write_and_read


# Names of the switches and column lists of a stored parameter file, and their defaults.
@dataclass
class PipelineConfig:
    """Switches and column lists of the pipeline."""

    encode_time: dict[str, int] = field(default_factory=lambda: {"hour": 24, "weekday": 7})
    geoencode: bool = False
    hotencode: list[str] = field(default_factory=lambda: ["cluster"])
    scale: list[str] = field(default_factory=lambda: ["capacity", "temp", "precip", "gel", "vent", "lat", "lon"])
    nonscale: list[str] = field(
        default_factory=lambda: ["weekend", "holiday", "preholiday", "postholiday", "pont", "vacances", "vacances_uni"]
    )
    target: str = "delta"
    smooth_window: int = 3
    reconstructed: bool = True
    clusterize: bool = True
    lagged_value: bool = True
    lagged_value_3hours_mean: bool = True
    mean_value: bool = True
    mean_peaks: bool = True
    leak_free: bool = True
    cluster_ks: list[int] = field(default_factory=lambda: list(CLUSTER_RANGE))
    region_ks: list[int] = field(default_factory=lambda: list(REGION_RANGE))
    hotvectors: list[str] = field(default_factory=list)

    @property
    def lag_columns(self) -> list[str]:
        on = {c: getattr(self, c) for c in LAG_COLUMNS if c not in PEAK_MEANS} | dict.fromkeys(PEAK_MEANS, self.mean_peaks)
        return [c for c in LAG_COLUMNS if on[c]]


@dataclass
class FeaturePipeline:
    """Fitted state: tables for clusters and lag history, small dictionaries for the rest."""

    config: PipelineConfig
    clusters: DataFrame | None = None
    history: DataFrame | None = None
    bounds: dict = field(default_factory=dict)
    lag_bounds: dict = field(default_factory=dict)
    lag_means: dict = field(default_factory=dict)
    vocabulary: list = field(default_factory=list)
    dictionaries: dict[str, DataFrame] = field(default_factory=dict)
    low: float | None = None
    high: float | None = None

    @classmethod
    def fit(cls, df: DataFrame, config: PipelineConfig | None = None) -> "FeaturePipeline":
        config = config or PipelineConfig()
        spark = df.sparkSession
        out = cls(config)
        keyed = df
        if config.clusterize:
            labels = cluster_stations(df, config.cluster_ks, config.region_ks)
            out.clusters = write_and_read(labels, scratch_path(spark, "clusters"))
            keyed = join_clusters(df, out.clusters)
        lags = config.lag_columns
        if lags:
            out.history = write_and_read(lag_history(df), scratch_path(spark, "history"))
            means = out.history.agg(*[F.avg(c).alias(c) for c in lags]).first()
            out.lag_bounds = minmax_fit(out.history, lags).first().asDict()
            out.lag_means = means.asDict()
        scaled = keyed
        if config.geoencode:
            corner = df.agg(F.min("lat").alias("lat"), F.min("lon").alias("lon")).first()
            out.bounds.update({"corner_lat": corner["lat"], "corner_lon": corner["lon"]})
            scaled = to_metres(keyed, origin=out._corner())
        out.bounds.update(minmax_fit(scaled, config.scale).first().asDict())
        if config.hotencode:
            out.vocabulary = onehot_fit(keyed, config.hotencode)
        for c in config.hotvectors:
            out.dictionaries[c] = write_and_read(index_fit(keyed, c), scratch_path(spark, "dictionary"))
        m = margins(df, config.target).first()
        out.low, out.high = m["low"], m["high"]
        return out

    def _corner(self):
        return F.struct(F.lit(self.bounds["corner_lat"]).alias("lat"), F.lit(self.bounds["corner_lon"]).alias("lon"))

    @property
    def feature_columns(self) -> list[str]:
        c = self.config
        time = [f"{f}_{n}" for f in ("sin", "cos") for n in c.encode_time]
        hot = [f"{a}_{b}" for a, b in self.vocabulary]
        marker = ["reconstructed"] if c.reconstructed else []
        return [*c.scale, *c.nonscale, *c.lag_columns, *time, *hot, *self.vector_columns, *marker]

    @property
    def vector_columns(self) -> list[str]:
        return [f"{c}_onehot" for c in self.config.hotvectors]

    def transform(self, df: DataFrame, fitting: bool = False) -> DataFrame:
        """Station, hour, every feature as a double without nulls (columns of ``hotvectors`` as sparse vectors), and the target if present.

        A lag that isn't known yet takes its mean over the history; rows to fit on (``fitting``) are dropped instead, as a model would learn
        from guesses. A lag that no row of the history has, as it is too short for it, is 0 everywhere.
        """
        c = self.config
        out = df if c.reconstructed else observed_only(df)
        if self.clusters is not None:
            out = join_clusters(out, self.clusters)
        lags = c.lag_columns
        if lags:
            out = join_lags(out, self.history, lags, c.leak_free)
            if fitting:
                out = out.na.drop(subset=[k for k in lags if self.lag_means[k] is not None])
            out = out.withColumns({k: F.coalesce(k, F.lit(self.lag_means[k]), F.lit(0.0)) for k in lags})
            out = minmax_apply(out, {k: v or 0.0 for k, v in self.lag_bounds.items()}, lags)
        if c.encode_time:
            out = cyclic(out, list(c.encode_time), list(c.encode_time.values()))
        if self.vocabulary:
            out = onehot_apply(out, self.vocabulary)
        out = onehot_vectors(out, self.dictionaries)
        if c.geoencode:
            out = to_metres(out, origin=self._corner())
        out = minmax_apply(out, self.bounds, c.scale)
        target = [c.target] if c.target in df.columns else []
        return float_features(out.select("station", "datehour", *self.feature_columns, *target), keep=(c.target, *self.vector_columns))

    def save(self, path: str) -> None:
        """Tables, with the lag history cut to its last 57 days, and one JSON row of parameters."""
        if self.clusters is not None:
            save_table(self.clusters, f"{path}/clusters")
        if self.history is not None:
            save_by_station(last_days(self.history, HISTORY_DAYS, strict=True), f"{path}/history")
        for c, dictionary in self.dictionaries.items():
            save_table(dictionary, f"{path}/onehot/{c}")
        state = {k: getattr(self, k) for k in ("bounds", "lag_bounds", "lag_means", "vocabulary", "low", "high")}
        text = json.dumps({"config": asdict(self.config), **state})
        spark = SparkSession.active()
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/state")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeaturePipeline":
        state = json.loads(spark.read.text(f"{path}/state").first()["value"])
        config = PipelineConfig(**state.pop("config"))
        state["vocabulary"] = [tuple(v) for v in state["vocabulary"]]
        out = cls(config, **state)
        if config.clusterize:
            out.clusters = load_table(spark, f"{path}/clusters")
        if config.lag_columns:
            out.history = load_by_station(spark, f"{path}/history")
        out.dictionaries = {c: load_table(spark, f"{path}/onehot/{c}") for c in config.hotvectors}
        return out
