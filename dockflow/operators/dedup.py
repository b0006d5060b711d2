"""De-duplication of the status log.

A busy station or a burst of copies may hold a large share of the log, so nothing here sorts a
whole key group: each operator is an aggregate that is first combined inside every map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockflow.functions.timefn import arrival_key, hour_floor

COPY_KEYS = ["dt", "bikes", "capacity", "station"]


#: Types whose values a hash aggregate keeps in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def first_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first row in (dt, status_id) order of every key; rows without a time come first.

    Columns of fixed width follow their row's arrival number in a hash table. Strings can't, so they group first, which
    leaves a key with one row per different text; only these few are reduced as whole rows.
    """
    number = F.coalesce(F.col("status_id").cast("decimal(19,0)"), F.expr("-9300000000000000000BD"))
    key = F.coalesce(arrival_key(), (number - F.expr("9000000000000000000000000000000000000BD")).cast("decimal(38,0)"))
    rest = [c for c in df.columns if c not in keys]
    fixed = [c for c in rest if isinstance(df.schema[c].dataType, FIXED_WIDTH)]
    wide = [c for c in rest if c not in fixed]
    seen = df.withColumn("_key", key).groupBy(*keys, *wide).agg(F.min("_key").alias("_first"), *[F.min_by(c, "_key").alias(c) for c in fixed])
    if not wide:
        return seen.select(*df.columns)
    first = F.min_by(F.struct(*rest), "_first").alias("_row")
    return seen.groupBy(*keys).agg(first).select(*keys, "_row.*").select(*df.columns)


def drop_exact(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per (dt, bikes, capacity, station): the one with the lowest status_id."""
    return first_rows(df, keys or COPY_KEYS)


def first_per_hour(df: DataFrame) -> DataFrame:
    """First row per (station, hour) in (dt, status_id) order, with its ``datehour``."""
    hourly = df.withColumn("datehour", hour_floor(F.col("dt")))
    return first_rows(hourly, ["station", "datehour"])


def duplicate_report(df: DataFrame) -> DataFrame:
    """Rows beyond the first per exact-copy key and per (station, hour): count and percent."""
    def one(kind: str, frame: DataFrame, keys: list[str]) -> DataFrame:
        groups = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        return groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        ).select(F.lit(kind).alias("kind"), "n_rows", "duplicates")

    hourly = drop_exact(df).select("station", hour_floor(F.col("dt")).alias("datehour"))
    both = one("exact", df, COPY_KEYS).unionByName(one("hour", hourly, ["station", "datehour"]))
    return both.withColumn("percent", F.round(F.col("duplicates") * 100 / F.col("n_rows"), 2))


def station_dim(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Latest attributes per station.

    The log is first reduced to its distinct attributes, a hash aggregate with a fixed-width buffer; only
    that small table is reduced by structs.
    """
    at, number = (*(order or ["dt", "status_id"]), None)[:2]
    attrs = [c for c in ("lat", "lon", "name", "capacity") if c in df.columns]
    seen = df.groupBy("station", *attrs).agg(F.max(arrival_key(at, number)).alias("_key"))
    last = F.max_by(F.struct(*attrs), "_key").alias("_last")
    return seen.groupBy("station").agg(last).select("station", "_last.*")


def fix_capacity(df: DataFrame) -> DataFrame:
    """Capacity becomes the station's largest stock; aggregated and joined back rather than
    windowed, so that a hot station is split by the skew join instead of sorted in one task."""
    top = df.groupBy("station").agg(F.max("bikes").alias("_top"))
    out = df.join(top, "station").withColumn("capacity", F.col("_top"))
    return out.select(*df.columns)
