"""Dense hourly grid and flow differences.

After the log is reduced to one row per station and hour, a station holds at most one row per
hour of history and every station exactly the same number once densified: partitions keyed by
station are then bounded by the calendar and balanced whatever the skew of the raw log.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.timefn import ONE_HOUR, arrival_key, hour_floor, hour_index
from dockflow.session import scratch_path, shuffle_width
from dockflow.sources.tables import write_and_read

ATTRIBUTES = ["lat", "lon", "name", "capacity"]


def by_hour(*keys: str, order: str = "datehour") -> W:
    return W.partitionBy(*(keys or ("station",))).orderBy(order)


def hour_bounds(df: DataFrame, col: str = "datehour") -> Column:
    """(low, high) hour of a frame as a scalar struct."""
    return df.agg(F.struct(F.min(col).alias("low"), F.max(col).alias("high")).alias("bounds")).scalar()


def hour_axis(df: DataFrame) -> DataFrame:
    """Every hour from the first to the last one of a frame."""
    b = hour_bounds(df)
    hours = F.sequence(b.getField("low"), b.getField("high"), F.expr(ONE_HOUR))
    return df.sparkSession.range(1).select(F.explode(hours).alias("datehour"))


def hour_grid(hourly: DataFrame, stations: DataFrame | None = None) -> DataFrame:
    """Every hour between the first and the last one for every station.

    The station list is spread over a fixed number of partitions before it is unrolled: it is
    tiny, so left alone it would be coalesced into one task that then emits the whole grid.
    """
    dim = stations if stations is not None else hourly.select("station").distinct()
    bounds = hour_bounds(hourly)
    hours = F.sequence(bounds.getField("low"), bounds.getField("high"), F.expr(ONE_HOUR))
    spread = dim.repartition(shuffle_width(dim.sparkSession), "station")
    return spread.withColumn("datehour", F.explode(hours))


def densify(hourly: DataFrame, value: str = "bikes", max_gap: int = 0, until: Column | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """Grid left join observations, without the join.

    Each observed hour is unrolled up to the hour before the station's next observation, and
    the station's first one also back to the first hour of the network. One shuffle by station
    replaces the grid's and the join's, and the result is already placed for the station windows.
    As each run of hours knows both its ends, gaps up to ``max_gap`` hours can be interpolated
    here without another window: linear between two observations, repeated after the last one.
    With ``until`` a station's hours run from its own first row to that hour; ``carried`` names further columns to keep.
    """
    attrs = [*(c for c in ATTRIBUTES if c in hourly.columns), *carried]
    hourly = hourly.filter("station is not null and datehour is not null")
    w = by_hour()
    step = F.expr(ONE_HOUR)
    if until is None:
        bounds = hour_bounds(hourly)
        until = bounds.getField("high")
        start_hour = F.when(F.lag("datehour").over(w).isNull(), bounds.getField("low")).otherwise(F.col("datehour"))
    else:
        start_hour = F.col("datehour")
    placed = hourly.select("station", "datehour", value, *attrs).repartition(
        shuffle_width(hourly.sparkSession), "station"
    )
    runs = placed.withColumns({"_from": start_hour, "_to": F.coalesce(F.lead("datehour").over(w) - step, until)})
    # Hours are counted once per run: its rows know their place in it.
    ahead = hour_index(F.col("datehour")) - hour_index(F.col("_from"))
    length = hour_index(F.col("_to")) - hour_index(F.col("datehour"))
    runs = runs.withColumns({"_ahead": ahead, "_length": length})
    if max_gap:
        runs = runs.withColumn("_end", F.lead(value).over(w).cast("double"))
    kept = [c for c in runs.columns if c != "datehour"]
    dense = runs.select(*kept, F.posexplode(F.sequence("_from", "_to", step)).alias("_place", "datehour"))
    start, offset = F.col(value).cast("double"), F.col("_place") - F.col("_ahead")
    filled = F.when(offset == 0, start)
    if max_gap:
        line = F.coalesce(start + (F.col("_end") - start) * offset / (F.col("_length") + 1), start)
        filled = filled.when((offset > 0) & (F.col("_length") <= max_gap), line)
    return dense.select("station", "datehour", *attrs, filled.alias(value))


def add_delta(df: DataFrame, value: str = "bikes", target: str = "delta", fill: Column | None = None) -> DataFrame:
    """Difference with the station's previous hourly row; the first row is null or ``fill``."""
    diff = F.col(value) - F.lag(value).over(by_hour())
    return df.withColumn(target, diff if fill is None else F.coalesce(diff, fill))


def add_delta_log(df: DataFrame, value: str = "bikes", target: str = "delta", width: int | None = None, stage=None) -> DataFrame:
    """Difference with the station's previous row in the raw log by (dt, status_id), null on its first row.

    A segmented scan: the log is cut in ranges of (station, dt, status_id), so that neither a hot station nor a burst of
    reports within one hour or one instant is one task's work. A task differences its sorted rows batch by batch and keeps one value between
    batches. As ranges follow the order, only a range's first row can have its previous one elsewhere: in the nearest range before it, as that one's last row.
    Range ends, two small rows a range, are stored with the rows, since the cuts have to be the same for both even when tasks
    are run again; ``stage`` says how (default: a table below the shared folder). Rows without a time come first, rows without a station form a group of their own.
    """
    spark = df.sparkSession
    stage = stage or (lambda out: write_and_read(out, scratch_path(spark, "ranges")))
    columns = [c for c in df.columns if c != target]
    keys = ["station", "dt", "status_id"]
    ranged = df.select(*columns, F.col(value).alias("_value")).repartitionByRange(width or shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    typed = ranged.withColumns({"_part": F.spark_partition_id(), "_prev": F.lit(None).cast(df.schema[value].dataType), "_head": F.lit(False), "_last": F.lit(False)})
    stored = stage(typed.mapInArrow(_segment, typed.schema))
    ends = stored.filter("_head or _last").select("_part", "station", "_value", "_head", "_last")
    # Of every range its first and its last row: the row before a first row, in the order of ranges, is the last one of the range before it.
    before = W.orderBy("_part", F.col("_last"))
    carried = ends.withColumns({"_carry": F.lag("_value").over(before), "_same": F.lag("station").over(before).eqNullSafe(F.col("station"))})
    known = carried.filter("_head and not _last and _same").select("_part", "_carry", F.lit(True).alias("_head"))
    joined = stored.filter("not _last").join(F.broadcast(known), ["_part", "_head"], "left")
    prev = F.when(F.col("_head"), F.col("_carry")).otherwise(F.col("_prev"))
    return joined.withColumn(target, F.col(value) - prev).select(*columns, target)


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Previous value of every sorted row of a range, its first row marked, and a copy of its last row marked as such."""
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        station, number = batch["station"], batch["_value"]
        head = last is None
        ahead = [a.slice(0, n - 1) if head else pa.concat_arrays([last[c], a.slice(0, n - 1)]) for c, a in (("station", station), ("_value", number))]
        if head:
            ahead = [pa.concat_arrays([pa.nulls(1, a.type), a]) for a in ahead]
        both_null = pc.and_(pc.is_null(ahead[0]), pc.is_null(station))
        same = pc.or_(pc.fill_null(pc.equal(ahead[0], station), False), both_null)
        if head:
            same = pa.concat_arrays([pa.array([False]), same.slice(1)])
        out = {"_prev": pc.if_else(same, ahead[1], pa.nulls(n, number.type))}
        if head:
            out["_head"] = pa.array([True] + [False] * (n - 1))
        yield _with_columns(batch, out)
        last = batch.slice(n - 1)
    if last is not None:
        yield _with_columns(last, {"_last": pa.array([True])})


def _with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(name, batch[name]) for name in batch.schema.names], schema=batch.schema)


def reduce_log(status: DataFrame) -> DataFrame:
    """Raw log to its hourly observations in a single pass.

    One aggregate, combined map-side in a hash table, yields per station and hour the first row's stock and
    whether that row is complete. Exact copies share their hour and never win over the original, so dropping
    them first would change nothing. Rows without a time or a station belong to no hour.
    """
    key = arrival_key()
    complete = F.col("bikes").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("name").isNotNull()
    return dated(status).groupBy("station", hour_floor(F.col("dt")).alias("datehour")).agg(
        F.min_by("bikes", key).alias("bikes"), F.min_by(complete, key).alias("complete"),
    )


def dated(status: DataFrame) -> DataFrame:
    return status.filter("dt is not null and station is not null")


def hourly_observations(status: DataFrame, stage=lambda df: df) -> DataFrame:
    """Complete hourly observations (station, datehour, bikes, lat, lon, name, capacity).

    The stock is the hour's first report, dropped when that report is incomplete. Capacity is
    the station's largest stock in any report and its attributes are the latest ones. All three come from one reduction
    of the log per station, hour and attributes, which ``stage`` may store: the log is then read once.
    """
    key = arrival_key()
    attributes = ["lat", "lon", "name"]
    seen = stage(dated(status).groupBy("station", hour_floor(F.col("dt")).alias("datehour"), *attributes).agg(
        F.min(key).alias("first"), F.min_by("bikes", key).cast("double").alias("bikes"), F.max("bikes").cast("double").alias("top"), F.max(key).alias("last"),
    ))
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("bikes", *attributes)])
    first = seen.groupBy("station", "datehour").agg(F.min_by("bikes", "first").alias("bikes"), F.min_by(complete, "first").alias("complete"))
    latest = seen.groupBy("station", *attributes).agg(F.max("last").alias("last"), F.max("top").alias("top"))
    dim = latest.groupBy("station").agg(F.max_by(F.struct(*attributes), "last").alias("a"), F.max("top").alias("capacity")).select("station", "a.*", "capacity")
    return first.filter("complete").drop("complete").join(dim, "station").select("station", "datehour", "bikes", *attributes, "capacity")
