"""Tables laid out for lookups by station and day, and requests that open only their part of them.

A table lies in folders ``bucket=B/day=D``, the bucket being a hash of the station. A request's buckets and its newest day are scalar subqueries
over the requests, which the scan takes as partition filters when the query runs: nothing is collected while it is built, and folders of other
stations or later days aren't opened. Rows of the opened folders are then semi-joined to the requested stations before anything is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 16
LAYOUT = ("bucket", "day")


def station_bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64("station"), F.lit(buckets)).cast("int")


def save_by_station(df: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Write a table of stations and hours in the layout and read it back; a bucket's day is one file unless it is large."""
    placed = df.withColumns({"bucket": station_bucket(buckets), "day": F.to_date("datehour")})
    placed.hint("rebalance", "bucket", "day").write.mode("overwrite").partitionBy(*LAYOUT).parquet(path)
    # The number of buckets travels with the table, as its readers hash with it.
    df.sparkSession.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(f"{path}/_layout")
    return load_by_station(df.sparkSession, path)


def load_by_station(spark, path: str) -> DataFrame:
    buckets = spark.read.parquet(f"{path}/_layout").first()["buckets"]
    return spark.read.parquet(path).withMetadata("bucket", {"buckets": buckets})


def bucket_count(table: DataFrame) -> int:
    """Buckets of a table in the layout, 0 for any other."""
    if not set(LAYOUT) <= set(table.columns):
        return 0
    return table.schema["bucket"].metadata.get("buckets", 0)


def requested_part(table: DataFrame, req: DataFrame, since: bool = False, until: bool = True) -> DataFrame:
    """Rows of requested stations, from the first and up to the last requested day where asked for; layout columns dropped."""
    buckets = bucket_count(table)
    out = table
    if buckets:
        wanted = req.agg(F.collect_set(station_bucket(buckets)).alias("b")).scalar()
        out = out.filter(F.array_contains(wanted, F.col("bucket")))
        if until:
            out = out.filter(F.col("day") <= req.agg(F.max(F.to_date("datehour")).alias("d")).scalar())
        if since:
            out = out.filter(F.col("day") >= req.agg(F.min(F.to_date("datehour")).alias("d")).scalar())
        out = out.drop(*LAYOUT)
    return out.join(req.select("station").distinct(), "station", "left_semi")
