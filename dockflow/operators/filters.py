"""Projections, filters and null audits."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column types of the extract and layout of the hourly flow table.
EXTRACT_TYPES = {
    "station": "string", "lat": "double", "lon": "double", "name": "string",
    "capacity": "double", "bikes": "double", "delta": "double",
}
BASE_COLUMNS = ["datehour", "date", "station", "lat", "lon", "name"]
CALENDAR_COLUMNS = [
    "hour", "month", "weekday", "weekend", "holiday", "preholiday", "postholiday", "pont",
    "vacances", "vacances_uni",
]
TARGET_COLUMNS = ["capacity", "bikes", "delta"]
WEATHER_COLUMNS = ["temp", "precip", "gel", "vent"]


def fix_types(df: DataFrame) -> DataFrame:
    """Cast the extract columns that are present."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in EXTRACT_TYPES.items() if c in df.columns})


def select_flow(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Base, calendar, marker and target columns in their fixed order."""
    marker = ["reconstructed"] if "reconstructed" in df.columns else []
    return df.select(*BASE_COLUMNS, *CALENDAR_COLUMNS, *marker, *TARGET_COLUMNS, *(extra or []))


def time_split(
    df: DataFrame, low: date | None = None, split: date | None = None, cut: date | None = None,
    col: str = "datehour",
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """(all, train, test): dates from ``low``, before ``cut``, train strictly before ``split``.

    Bounds are compared with the timestamp itself, which a Parquet scan can push down.
    """
    def bound(d: date):
        return F.lit(str(d)).cast("date").cast("timestamp_ntz")
    whole = df
    if low is not None:
        whole = whole.filter(F.col(col) >= bound(low))
    if cut is not None:
        whole = whole.filter(F.col(col) < bound(cut))
    if split is None:
        return whole, None, None
    return whole, whole.filter(F.col(col) < bound(split)), whole.filter(F.col(col) >= bound(split))


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=subset)


def observed_only(df: DataFrame) -> DataFrame:
    """Complete rows that were not reconstructed."""
    return drop_incomplete(df).filter(~F.col("reconstructed"))


def clamp_stock(df: DataFrame, col: str = "bikes") -> DataFrame:
    """No negative stock; an unknown stock counts as 0."""
    return df.withColumn(col, F.greatest(F.coalesce(F.col(col), F.lit(0.0)), F.lit(0.0)))


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value, found in one counting pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if counts[c] > 0])


def null_audit(df: DataFrame) -> DataFrame:
    """One row: nulls per column (``<col>_nulls``), null cells and rows with any null."""
    nulls = [F.col(f"`{c}`").isNull() for c in df.columns]
    per_column = [F.count_if(n).alias(f"{c}_nulls") for c, n in zip(df.columns, nulls)]
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *per_column,
        F.coalesce(F.sum(reduce(lambda a, b: a + b, [n.cast("long") for n in nulls])), F.lit(0)).alias("null_cells"),
        F.count_if(reduce(lambda a, b: a | b, nulls)).alias("null_rows"),
    )


def require_no_nulls(df: DataFrame) -> DataFrame:
    """The frame itself, or an error naming how many rows carry a null."""
    bad = null_audit(df).first()["null_rows"]
    if bad:
        raise ValueError(f"{bad} rows with missing values")
    return df


def valid_stations(requested: DataFrame, dim: DataFrame) -> DataFrame:
    """Requested stations that exist."""
    return requested.join(dim.select("station"), "station", "left_semi")


def float_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every numeric or boolean column as double, except those in ``keep``."""
    def wanted(f: T.StructField) -> bool:
        return isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in keep
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields if wanted(f)})


def select_stations(
    dim: DataFrame, ids: list[str] | None = None, names: list[str] | None = None,
    clusters: list[int] | None = None,
) -> DataFrame:
    """Stations matching any given id, name or cluster; the whole dimension without criteria."""
    tests = [
        F.col(c).isin(list(v))
        for c, v in (("station", ids), ("name", names), ("cluster", clusters)) if v is not None
    ]
    return dim.filter(reduce(lambda a, b: a | b, tests)) if tests else dim
