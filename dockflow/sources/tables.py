"""Table sinks, recent slices and the statistics document."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.timefn import hour_floor
from dockflow.session import shuffle_width


def append_status(df: DataFrame, path: str) -> None:
    """Append status rows to the log, one folder per day so that later reads prune by date.

    Rows are rebalanced by day before they are written: few tasks open a day, and adaptive execution splits
    a busy one by its measured size.
    """
    dated = df.withColumn("day", F.to_date("dt"))
    dated.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def save_table(df: DataFrame, path: str, partition_by: str | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def publish(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write a new version of a table and switch to it; readers see the old one until the new one is complete.

    The switch is one record in a folder of its own number, which only one of two writers can create: the other fails and
    changes nothing. A crash in between leaves the old version current. The newest ``keep`` versions stay for readers
    that began before the switch, older ones are removed.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    numbers = published_numbers(spark, f"{path}/published")
    save_table(df, f"{path}/versions/{version}")
    number = max(numbers, default=-1) + 1
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.json(f"{path}/published/number={number}")
    for old in sorted(numbers)[:max(len(numbers) + 1 - keep, 0)]:
        gone = spark.read.schema("version string").json(f"{path}/published/number={old}").first()
        remove(spark, f"{path}/published/number={old}")
        if gone:
            remove(spark, f"{path}/versions/{gone['version']}")
    return current_table(spark, path)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The published version of a table."""
    number = max(published_numbers(spark, f"{path}/published"))
    newest = spark.read.schema("version string").json(f"{path}/published/number={number}").first()
    return load_table(spark, f"{path}/versions/{newest['version']}")


def _folder(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def published_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished ``number=N`` folders; one without its success mark belongs to a writer that died."""
    return sorted(int(n.split("=")[1]) for n in folders(spark, path) if n.startswith("number=") and exists(spark, f"{path}/{n}/_SUCCESS"))


def folders(spark: SparkSession, path: str) -> list[str]:
    files, at = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(at) if s.isDirectory()] if files.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    files, at = _folder(spark, path)
    return files.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    files, at = _folder(spark, path)
    files.delete(at, True)


def append_weather(df: DataFrame, path: str, loaded: str) -> DataFrame:
    """Keep the hourly weather of every refresh; the table read back holds each hour's latest load."""
    save_table(df, f"{path}/loaded={loaded}")
    stored = load_table(df.sparkSession, path)
    values = [c for c in df.columns if c != "datehour"]
    latest = F.max_by(F.struct(*values), F.col("loaded").cast("string")).alias("_w")
    return stored.groupBy("datehour").agg(latest).select("datehour", "_w.*").select(*df.columns)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Materialise a stage boundary as a table: a lost executor then re-reads it instead of
    recomputing the history."""
    save_table(df, path)
    return load_table(df.sparkSession, path)


def write_by_station(df: DataFrame, path: str) -> DataFrame:
    """Materialise a stage boundary as a table in buckets by station, as many as a shuffle has partitions.

    Rows already placed by station are written where they are, a file per bucket; joins, groups and windows keyed by station that read
    the table find it placed, so no reader shuffles it again.
    """
    spark, width = df.sparkSession, shuffle_width(df.sparkSession)
    name = f"stage_{uuid.uuid4().hex}"
    df.repartition(width, "station").write.option("path", path).bucketBy(width, "station").saveAsTable(name)
    return spark.table(name)


def last_days(df: DataFrame, days: int, col: str = "datehour", strict: bool = False) -> DataFrame:
    """Rows not older than ``days`` before the newest row; ``strict`` excludes the bound itself."""
    cut = df.agg((F.max(col) - F.expr(f"interval {days} days")).alias("cut")).scalar()
    return df.filter(F.col(col) > cut if strict else F.col(col) >= cut)


def recent_slice(df: DataFrame, days: int = 7, col: str = "datehour") -> DataFrame:
    """The short table kept beside the full one for predictions."""
    return last_days(df, days, col)


def newer_than(incoming: DataFrame, raw: DataFrame, col: str = "dt") -> DataFrame:
    """Incoming rows after the hour of the newest stored row; all of them when nothing is stored."""
    mark = raw.agg(F.max(col).alias("mark")).select(hour_floor(F.col("mark")).alias("mark")).scalar()
    return incoming.filter(mark.isNull() | (F.col(col) > mark))


def stats_document(stats: DataFrame) -> DataFrame:
    """Long statistics rows (selection, category, metric, value) as one JSON document.

    The document holds one number per profiled column and statistic, so gathering it in one row
    is bounded by the profile's width, not by the data.
    """
    def by_key(key: str):
        return lambda a, b: F.when(a[key] < b[key], -1).when(a[key] > b[key], 1).otherwise(0)

    def pack(key: str, value: Column) -> Column:
        pairs = F.collect_list(F.struct(F.col(key), value.alias("v")))
        return F.map_from_entries(F.array_sort(pairs, by_key(key)))

    per_category = stats.groupBy("selection", "category").agg(pack("metric", F.col("value")).alias("m"))
    per_selection = per_category.groupBy("selection").agg(pack("category", F.col("m")).alias("m"))
    return per_selection.agg(F.to_json(pack("selection", F.col("m"))).alias("document"))


def write_stats(stats: DataFrame, path: str, refreshed: str) -> None:
    """Write the statistics of one refresh both as a long table and as the JSON document, beside the earlier ones.

    ``refreshed`` names the refresh by its newest hour, as hYYYYMMDDHH; a repeated refresh replaces its own part.
    """
    save_table(stats, f"{path}/long/refreshed={refreshed}")
    document = stats_document(stats.sparkSession.read.parquet(f"{path}/long/refreshed={refreshed}"))
    document.write.mode("overwrite").text(f"{path}/document/refreshed={refreshed}")


def write_stats_history(stats: DataFrame, path: str) -> None:
    """Statistics of many refreshes at once (long rows with their ``refreshed``), each replacing its own part of the table."""
    placed = stats.repartition("refreshed")
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("refreshed").parquet(f"{path}/long")


def stats_history(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of every refresh: datehour (the newest hour it saw) and the long columns."""
    hour = F.substring(F.col("refreshed"), 2, 10)
    return load_table(spark, f"{path}/long").withColumn("datehour", F.to_timestamp_ntz(hour, F.lit("yyyyMMddHH"))).drop("refreshed")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    parts = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, t in sorted(tables.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
