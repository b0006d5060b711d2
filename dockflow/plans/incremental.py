"""The hourly flow kept up to date batch by batch.

Three tables live below one root, in folders ``version=V/bucket=B/day=D`` (bucket: hash of the station):
- ``hourly``: first report per station and hour with its arrival key, a state that batches are merged into;
- ``stations``: largest stock, latest attributes, coverage and whether the station is kept;
- ``rebuilt``: the reconstructed series before attributes, calendar and weather, which are joined when it is read, with what a later rebuild needs
  to go on from any row: last known seasonal median, running flow and anchor of the stock.
A manifest names the live version of every bucket and day and holds the count of complete rows per day. A batch writes new versions of the
partitions it changes and then one manifest; until then readers, and a batch that is run again, see the old state. Old manifests and the
versions only they name are removed.

What a batch can change is bounded: interpolation looks back two days at most, a seasonal median at the two previous kept days of its weekday, stock
and neighbouring medians go on from the row before. So the days from two before the first touched (or formerly newest) hour are rebuilt from
about four weeks of ``hourly``. Further back only this reaches, and is followed: a day that starts or stops being an outlier (all days from there), a
station that is new or starts or stops being one, a station whose trailing rows waited for a next known median or a first known stock
(these stations' buckets, all days), and a new first hour of the network (everything).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.days import add_calendar
from dockflow.functions.timefn import ONE_HOUR, arrival_key, hour_floor
from dockflow.operators.filters import clamp_stock, select_flow
from dockflow.operators.grid import add_delta, by_hour, dated, densify
from dockflow.operators.outliers import outlier_labels
from dockflow.operators.rebuild import LEAD_IN, interpolate_night, neighbour_mean, seasonal_median
from dockflow.plans.flow import join_calendar, stage_tables, with_weather
from dockflow.sources.tables import folders, published_numbers, remove

REACH = timedelta(days=2)
CONTEXT = timedelta(days=3)
HOUR = timedelta(hours=1)

PLACE = ", version string, bucket int, day date"
TABLES = {
    "hourly": "station string, datehour timestamp_ntz, key decimal(38,0), bikes double, complete boolean" + PLACE,
    "rebuilt": "station string, datehour timestamp_ntz, bikes double, delta double, reconstructed boolean, seasonal_median double, "
               "past double, flow double, anchor double, anchor_flow double" + PLACE,
}
STATIONS = "station string, capacity double, lat double, lon double, name string, key decimal(38,0), n_seen long, n long, kept boolean"
MANIFEST = "kind string, name string, bucket int, day date, version string, low timestamp_ntz, high timestamp_ntz, n long, kept boolean"


@dataclass
class State:
    """What one manifest says. ``parts``: (table, bucket, day) to (version, first and last complete hour)."""
    batch: int = -1
    mark: datetime | None = None
    stations: str | None = None
    parts: dict = field(default_factory=dict)
    days: dict = field(default_factory=dict)

    @property
    def low(self) -> datetime | None:
        return min((p[1] for k, p in self.parts.items() if k[0] == "hourly" and p[1]), default=None)

    @property
    def high(self) -> datetime | None:
        return max((p[2] for k, p in self.parts.items() if k[0] == "hourly" and p[2]), default=None)


def midnight(d: date) -> datetime:
    return datetime(d.year, d.month, d.day)


def instant(t: datetime):
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


class FlowStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, drop_stations: bool = True, drop_days: bool = True, legacy_outliers: bool = False, keep: int = 2):
        self.spark, self.root, self.buckets, self.keep = spark, root, buckets, keep
        self.drop_stations, self.drop_days, self.legacy = drop_stations, drop_days, legacy_outliers

    # manifest

    def state(self) -> State | None:
        numbers = published_numbers(self.spark, f"{self.root}/manifest")
        if not numbers:
            return None
        out = State()
        for r in self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest/number={numbers[-1]}").collect():  # buckets x days
            if r["kind"] == "part":
                out.parts[r["name"], r["bucket"], r["day"]] = (r["version"], r["low"], r["high"])
            elif r["kind"] == "day":
                out.days[r["day"]] = (r["n"], r["kept"])
            else:
                out.batch, out.mark, out.stations = r["n"], r["high"], r["version"]
        return out

    def commit(self, state: State) -> None:
        numbers = published_numbers(self.spark, f"{self.root}/manifest")
        rows = [("state", None, None, None, state.stations, None, state.mark, state.batch, None)]
        rows += [("part", t, b, d, v, low, high, None, None) for (t, b, d), (v, low, high) in state.parts.items()]
        rows += [("day", None, None, d, None, None, None, n, kept) for d, (n, kept) in state.days.items()]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.json(f"{self.root}/manifest/number={(numbers or [-1])[-1] + 1}")
        self.expire()

    def expire(self) -> None:
        """Remove all but the newest manifests, and the versions that none of these names."""
        for old in published_numbers(self.spark, f"{self.root}/manifest")[:-self.keep]:
            remove(self.spark, f"{self.root}/manifest/number={old}")
        rows = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest").select("kind", "name", "version", "bucket", "day").distinct().collect()
        live = {(r["name"], r["version"], r["bucket"], str(r["day"])) for r in rows if r["kind"] == "part"}
        states = {r["version"] for r in rows if r["kind"] == "state"}
        for table in TABLES:
            for version in folders(self.spark, f"{self.root}/{table}"):
                name, base = version.split("=")[1], f"{self.root}/{table}/{version}"
                if not any(x[:2] == (table, name) for x in live):
                    remove(self.spark, base)
                    continue
                for bucket in folders(self.spark, base):
                    for day in folders(self.spark, f"{base}/{bucket}"):
                        if day.startswith("day=") and (table, name, int(bucket.split("=")[1]), day.split("=")[1]) not in live:
                            remove(self.spark, f"{base}/{bucket}/{day}")
        for version in folders(self.spark, f"{self.root}/stations"):
            if version.split("=")[1] not in states:
                remove(self.spark, f"{self.root}/stations/{version}")

    # tables

    def read(self, table: str, state: State | None, wanted=lambda bucket, day: True) -> DataFrame:
        """Live partitions of a table, named one by one: nothing else is listed or opened."""
        paths = [
            f"{self.root}/{table}/version={p[0]}/bucket={b}/day={d}"
            for (t, b, d), p in (state.parts.items() if state else ()) if t == table and wanted(b, d)]
        if not paths:
            return self.spark.createDataFrame([], TABLES[table]).drop("version")
        return self.spark.read.schema(TABLES[table]).option("basePath", f"{self.root}/{table}").parquet(*paths).drop("version")

    def bucket(self):
        return F.pmod(F.xxhash64("station"), F.lit(self.buckets)).cast("int")

    def placed(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"bucket": self.bucket(), "day": F.to_date("datehour")})

    def write(self, df: DataFrame, table: str, version: str) -> dict:
        """Write partitions of a version and return their entries for the manifest."""
        path = f"{self.root}/{table}/version={version}"
        columns = [c.split()[0] for c in TABLES[table].split(", ")]
        rows = self.placed(df).select(*[c for c in columns if c != "version"])
        rows.hint("rebalance", "bucket", "day").write.partitionBy("bucket", "day").parquet(path)
        seen = F.when(F.col("complete"), F.col("datehour")) if table == "hourly" else F.col("datehour")
        back = self.spark.read.schema(TABLES[table]).parquet(path).groupBy("bucket", "day").agg(F.min(seen).alias("low"), F.max(seen).alias("high"))
        return {(table, r["bucket"], r["day"]): (version, r["low"], r["high"]) for r in back.collect()}

    def stations(self, state: State | None) -> DataFrame:
        if state is None or state.stations is None:
            return self.spark.createDataFrame([], STATIONS)
        return self.spark.read.schema(STATIONS).parquet(f"{self.root}/stations/version={state.stations}")

    # merging a batch

    def merge(self, rows: DataFrame, batch: int = -1) -> None:
        """Merge status rows into the store. A batch number that is already in does nothing."""
        old = self.state()
        if old and 0 <= batch <= old.batch:
            return
        version = uuid.uuid4().hex
        log = dated(rows)
        key = arrival_key()
        complete = F.col("bikes").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("name").isNotNull()
        fresh = stage_tables(self.placed(log.groupBy("station", hour_floor(F.col("dt")).alias("datehour")).agg(
            F.min(key).alias("key"), F.min_by("bikes", key).cast("double").alias("bikes"), F.min_by(complete, key).alias("complete"), F.max("dt").alias("newest"))))
        touched = fresh.groupBy("bucket", "day").agg(F.min("datehour").alias("first"), F.max("newest").alias("newest")).collect()
        if not touched:
            return
        places = {(r["bucket"], r["day"]) for r in touched}
        before = self.read("hourly", old, lambda b, d: (b, d) in places)
        columns = ["station", "datehour", "key", "bikes", "complete"]
        merged = before.select(*columns).unionByName(fresh.select(*columns)).groupBy("station", "datehour").agg(
            F.min("key").alias("key"), F.min_by("bikes", "key").alias("bikes"), F.min_by("complete", "key").alias("complete"))
        new = State(batch, max(filter(None, [old.mark if old else None, *(r["newest"] for r in touched)])), version, dict(old.parts) if old else {})
        new.parts.update(self.write(merged, "hourly", version))
        self.rebuild(old, new, log, min(r["first"] for r in touched), version)
        self.commit(new)

    def rebuild(self, old: State | None, new: State, log: DataFrame, first: datetime, version: str) -> None:
        low, high = new.low, new.high
        whole = low is None or old is None or old.low != low
        start = low.date() if whole and low else (min(first, old.high) - REACH).date() if old and old.high else first.date()
        if low and start <= low.date():
            start = low.date()
        since = min(filter(None, [start, old.low.date() if old and old.low else None])) if whole else start
        stations = self.merged_stations(old, new, log, since, version)
        if low is None:
            return
        was = self.stations(old).select("station", F.col("kept").alias("was"))
        turned = stations.select("station", "kept").join(was, "station", "full").na.fill(False, ["kept", "was"])
        turned = turned.withColumn("turned", F.lit(True) if whole else F.col("kept") != F.col("was")).where("kept or was")
        turned = stage_tables(turned)
        buckets = self.buckets_of(turned.where("turned"))

        # Days: complete rows of kept stations, on the days that may have changed and by the stations that turned.
        context = max(low, midnight(start) - CONTEXT)
        origin = F.when(F.col("turned"), instant(low)).otherwise(instant(context))
        basic = self.basic(new, turned.where("kept or turned").withColumn("start", origin), context, buckets, high)
        counts = basic.where("bikes is not null and delta is not null").groupBy("kept", "turned", F.to_date("datehour").alias("day")).agg(F.count("*").alias("n"))
        days = {d: n for d, (n, _) in old.days.items() if d < start} if old and not whole else {}
        for r in counts.collect():  # four rows a day at most
            if r["day"] >= start and r["kept"]:
                days[r["day"]] = days.get(r["day"], 0) + r["n"]
            elif r["day"] < start and r["turned"]:
                days[r["day"]] = days.get(r["day"], 0) + (r["n"] if r["kept"] else -r["n"])
        new.days = self.labelled_days(days, low.date(), high.date())
        kept_days = sorted(d for d, (_, kept) in new.days.items() if kept)
        if not whole:
            changed = [d for d in {*old.days, *new.days} if d < start and old.days.get(d, (0, False))[1] != new.days.get(d, (0, False))[1]]
            start = min([start, *changed])
        past_days = [d for d in kept_days if d < start]
        if not past_days:
            whole, start = True, low.date()
            turned = turned.withColumn("turned", F.lit(True))
            buckets = set(range(self.buckets))

        # Series of the kept stations: from the first hour for those that turned, else from the last kept day before.
        seasons = [d for k in range(7) for d in [x for x in past_days if x.weekday() == k][-2:]]
        context = low if whole else max(low, midnight(min(seasons)) - CONTEXT)
        origin = F.when(F.col("turned"), instant(low)).otherwise(instant(context))
        wanted = turned.where("kept").withColumn("start", origin)
        carry = None if whole else self.read("rebuilt", old, lambda b, d: d == past_days[-1]).where(F.col("datehour") == instant(midnight(past_days[-1]) + 23 * HOUR))
        series = stage_tables(self.series(new, wanted, context, buckets, high, kept_days, start, carry))
        reset = turned.where("turned").select("station")
        if not whole:
            waiting = stage_tables(self.waiting(old, series, carry.join(reset, "station", "left_anti"), past_days[-1], start))
            more = self.buckets_of(waiting)
            if more:
                again = waiting.withColumns({"kept": F.lit(True), "turned": F.lit(True), "start": instant(low)})
                series = series.join(waiting, "station", "left_anti").unionByName(self.series(new, again, midnight(high.date()) + 24 * HOUR, more, high, kept_days, start, None))
                reset, buckets = reset.unionByName(waiting), buckets | more
            stay = self.read("rebuilt", old, lambda b, d: b in buckets and d < start).drop("bucket", "day").join(reset, "station", "left_anti")
            series = series.unionByName(stay)
        new.parts = {k: p for k, p in new.parts.items() if k[0] != "rebuilt" or not (whole or k[2] >= start or k[1] in buckets)}
        new.parts.update(self.write(series, "rebuilt", version))

    def buckets_of(self, stations: DataFrame) -> set[int]:
        return {r[0] for r in stations.select(self.bucket().alias("b")).distinct().collect()}

    def merged_stations(self, old: State | None, new: State, log: DataFrame, since: date, version: str) -> DataFrame:
        """Stations with the batch's reports in and coverage counted anew from ``since`` on."""
        before = self.stations(old)
        attributes = ["lat", "lon", "name"]
        seen = log.groupBy("station", *attributes).agg(F.max(arrival_key()).alias("key")).unionByName(before.select("station", *attributes, "key"))
        latest = seen.groupBy("station").agg(F.max_by(F.struct(*attributes), "key").alias("a"), F.max("key").alias("key")).select("station", "a.*", "key")
        top = log.groupBy("station").agg(F.max("bikes").cast("double").alias("capacity")).unionByName(before.select("station", "capacity"))
        top = top.groupBy("station").agg(F.max("capacity").alias("capacity"))

        def coverage(state: State | None, sign: int) -> DataFrame:
            seen = self.read("hourly", state, lambda b, d: d >= since - timedelta(days=1)).where("complete")
            seen = seen.withColumn("ok", F.lag("datehour").over(by_hour()) == F.col("datehour") - F.expr(ONE_HOUR)).where(F.col("datehour") >= instant(midnight(since)))
            return seen.groupBy("station").agg((F.count("*") * sign).alias("n_seen"), (F.count_if("ok") * sign).alias("n"))

        counts = before.select("station", "n_seen", "n").unionByName(coverage(new, 1)).unionByName(coverage(old, -1))
        counts = counts.groupBy("station").agg(F.sum("n_seen").alias("n_seen"), F.sum("n").alias("n"))
        out = stage_tables(latest.join(top, "station").join(counts, "station", "left").na.fill(0, ["n_seen", "n"]))
        if not self.drop_stations:
            out = out.withColumn("kept", F.col("n_seen") > 0)
        elif self.legacy:
            out = out.withColumn("kept", F.col("n") > 0)
        else:
            normal = outlier_labels(out.where("n > 0").select("station", "n"), "n", 3).where("label = 'normal'").select("station", F.lit(True).alias("kept"))
            out = out.join(normal, "station", "left").na.fill(False, ["kept"])
        out.select(*[c.split()[0] for c in STATIONS.split(", ")]).write.parquet(f"{self.root}/stations/version={version}")
        return self.stations(new)

    def labelled_days(self, counts: dict, first: date, last: date) -> dict:
        every = [first + timedelta(days=k) for k in range((last - first).days + 1)]
        if not self.drop_days:
            return {d: (counts.get(d, 0), True) for d in every}
        rows = [Row(day=d, n=n) for d, n in counts.items() if n > 0]
        if not rows:
            return {}
        frame = self.spark.createDataFrame(rows, "day date, n long")
        normal = {r["day"] for r in frame.collect()} if self.legacy else {r["day"] for r in outlier_labels(frame, "n", 3).where("label = 'normal'").collect()}
        return {r["day"]: (r["n"], r["day"] in normal) for r in rows}

    def basic(self, state: State, stations: DataFrame, context: datetime, buckets: set[int], high: datetime) -> DataFrame:
        """Dense rows from each station's ``start`` with short and night gaps interpolated: station, kept, turned, start, datehour, bikes, delta.

        A row before the first hour, without a stock, makes a station's hours begin at ``start`` whether it reported or not.
        """
        seen = self.read("hourly", state, lambda b, d: d >= context.date() or b in buckets).where("complete").select("station", "datehour", "bikes")
        extra = ("kept", "turned", "start")
        stations = stations.select("station", *extra)
        seen = seen.join(stations, "station").where("datehour >= start")
        edge = stations.withColumns({"datehour": F.col("start") - F.expr(ONE_HOUR), "bikes": F.lit(None).cast("double")})
        dense = densify(seen.unionByName(edge), max_gap=2, until=instant(high), carried=extra).where("datehour >= start")
        return add_delta(interpolate_night(dense))

    def series(self, state, stations, context, buckets, high, kept_days: list[date], start: date, carry: DataFrame | None) -> DataFrame:
        """Rebuilt rows: all of stations that turned, from ``start`` on of the others, which go on from their row in ``carry``."""
        rows = self.basic(state, stations, context, buckets, high)
        rows = rows.where(F.to_date("datehour").isin(kept_days)).withColumns({"weekday": F.weekday("datehour"), "hour": F.hour("datehour")})
        rows = seasonal_median(rows).where(F.col("turned") | (F.col("datehour") >= instant(midnight(start))))
        rows = rows.select("station", "datehour", "bikes", "delta", "seasonal_median", F.lit(False).alias("seed"), *[F.lit(None).cast("double").alias(c) for c in ("stock", "anchor", "anchor_flow")])
        if carry is not None:
            going_on = stations.where("not turned").select("station")
            rows = rows.unionByName(carry.join(going_on, "station", "left_semi").select(
                "station", "datehour", F.lit(None).cast("double").alias("bikes"), F.col("flow").alias("delta"), F.col("past").alias("seasonal_median"),
                F.lit(True).alias("seed"), F.col("bikes").alias("stock"), "anchor", "anchor_flow"))
        w = by_hour().rowsBetween(*LEAD_IN)
        rows = neighbour_mean(rows, "seasonal_median").withColumns({
            "past": F.last("seasonal_median", ignorenulls=True).over(w), "reconstructed": F.col("delta").isNull(),
            "delta": F.coalesce("delta", "seasonal_median", "neighbour_mean")})
        rows = rows.withColumn("flow", F.sum(F.coalesce("delta", F.lit(0.0))).over(w))
        first = F.when(F.col("seed") & F.col("anchor").isNotNull(), F.struct("datehour", F.col("anchor").alias("b"), F.col("anchor_flow").alias("c")))
        first = first.when(F.col("bikes").isNotNull(), F.struct("datehour", F.col("bikes").alias("b"), F.col("flow").alias("c")))
        rows = rows.withColumn("a", F.min(first).over(W.partitionBy("station")))
        rows = clamp_stock(rows.withColumn("bikes", F.coalesce("bikes", F.col("a.b") + F.col("flow") - F.col("a.c"))))
        rows = rows.withColumn("bikes", F.when(F.col("seed"), F.col("stock")).otherwise(F.col("bikes")))
        rows = add_delta(rows, fill=F.col("delta").cast("int").cast("double")).where("not seed")
        return rows.select("station", "datehour", "bikes", "delta", "reconstructed", "seasonal_median", "past", "flow", F.col("a.b").alias("anchor"), F.col("a.c").alias("anchor_flow"))

    def waiting(self, old: State, series: DataFrame, carry: DataFrame, last: date, start: date) -> DataFrame:
        """Stations whose rows before ``start`` waited for a median or a first stock and now see another one."""
        known = F.when(F.col("seasonal_median").isNotNull() & (F.col("datehour") >= instant(midnight(start))), F.col("datehour"))
        before = self.read("rebuilt", old, lambda b, d: d >= start).groupBy("station").agg(F.min_by("seasonal_median", known).alias("old_next"))
        after = series.groupBy("station").agg(F.min_by("seasonal_median", known).alias("new_next"), F.max("anchor").alias("new_anchor"))
        ends = carry.select("station", "seasonal_median", "anchor").join(before, "station", "left").join(after, "station", "left")
        moved = F.col("seasonal_median").isNull() & ~F.col("old_next").eqNullSafe(F.col("new_next"))
        return ends.where(moved | (F.col("anchor").isNull() & F.col("new_anchor").isNotNull())).select("station")

    # reading

    def station_flow(self, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame, since: date | None = None) -> DataFrame:
        """Flow with attributes and calendar, before weather; ``since`` opens the days from there on only."""
        state = self.state()
        rows = self.read("rebuilt", state, lambda b, d: since is None or d >= since).select("station", "datehour", "bikes", "delta", "reconstructed")
        rows = rows.join(self.stations(state).select("station", "lat", "lon", "name", "capacity"), "station")
        if state is None or state.low is None:
            return select_flow(add_calendar(rows, holidays, breaks, uni_breaks))
        hours = F.explode(F.sequence(instant(state.low), instant(state.high), F.expr(ONE_HOUR)))
        return select_flow(join_calendar(rows, self.spark.range(1).select(hours.alias("datehour")), holidays, breaks, uni_breaks))

    def flow(self, wx: DataFrame, holidays: DataFrame, breaks: DataFrame, uni_breaks: DataFrame, since: date | None = None) -> DataFrame:
        return with_weather(self.station_flow(holidays, breaks, uni_breaks, since), wx)
