"""Registration, bindings of the domain tables to the test tables, and their SQL twins.

Stations are the users of ``events``: their number grows with the data, and so does the grid.
Values that later steps compare are rounded on both sides: base values to 6 places, means of
them to 4, where a mean of few values cannot fall half-way between two results.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.timefn import hour_floor
from dockflow.plans.flow import build_flow
from dockflow.plans.jobs import Calendars
from dockflow.session import scratch_path
from dockflow.sources.calendars import break_ranges, holiday_dates
from dockflow.sources.tables import write_and_read, write_by_station

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Test calendar. Two Thursdays make their Fridays bridge days.
HOLIDAYS = [date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 25)]
BREAKS = [(date(2024, 1, 1), date(2024, 1, 7)), (date(2024, 1, 20), date(2024, 1, 22))]
UNI_BREAKS = [(date(2024, 1, 8), date(2024, 1, 8)), (date(2024, 1, 15), date(2024, 1, 19))]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL twin where SQL can express it."""
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def r6(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


def rounded(df: DataFrame, *cols: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in cols})


def s6(expr: str) -> str:
    """SQL rounding that cannot yield a negative zero."""
    return f"(round({expr}, 6) + CAST(0 AS DOUBLE))"


def s4(expr: str) -> str:
    return f"(round({expr}, 4) + CAST(0 AS DOUBLE))"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- status log -----------------------------------------------------------------------------

def status(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("user_id")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("status_id"),
        u.cast("string").alias("station"),
        (F.floor("value").cast("int") % 30).alias("bikes"),
        F.lit(30).alias("capacity"),
        ((u * 37 % 101).cast("double") / 1000 + F.lit(48.8)).alias("lat"),
        ((u * 53 % 97).cast("double") / 1000 + F.lit(2.25)).alias("lon"),
        F.concat(F.lit("S-"), u.cast("string")).alias("name"),
        F.col("ts").alias("dt"),
        (F.col("ts") + F.expr("interval 5 minutes")).alias("poll_dt"),
    )


STATUS = """status AS (
  SELECT event_id AS status_id, CAST(user_id AS VARCHAR) AS station,
         CAST(CAST(floor(value) AS BIGINT) % 30 AS INTEGER) AS bikes, 30 AS capacity,
         CAST(user_id * 37 % 101 AS DOUBLE) / 1000 + CAST(48.8 AS DOUBLE) AS lat,
         CAST(user_id * 53 % 97 AS DOUBLE) / 1000 + CAST(2.25 AS DOUBLE) AS lon,
         concat('S-', CAST(user_id AS VARCHAR)) AS name, ts AS dt, ts + INTERVAL 5 MINUTE AS poll_dt
  FROM events)"""


def copied_status(spark: SparkSession, sf: str) -> DataFrame:
    """The log with times cut to the hour and few stock levels, which makes many exact copies."""
    return status(spark, sf).withColumns({"dt": hour_floor(F.col("dt")), "bikes": F.col("bikes") % 2})


COPIED = STATUS + """, copied AS (
  SELECT * REPLACE (date_trunc('hour', dt) AS dt, CAST(bikes % 2 AS INTEGER) AS bikes) FROM status)"""


# --- dense series ---------------------------------------------------------------------------

HOURLY = STATUS + """, hourly AS (
  SELECT station, date_trunc('hour', dt) AS datehour, CAST(bikes AS DOUBLE) AS bikes, dt, status_id
  FROM status QUALIFY row_number() OVER (PARTITION BY station, date_trunc('hour', dt) ORDER BY dt, status_id) = 1),
dim AS (
  SELECT station, lat, lon, name, CAST(max(bikes) OVER (PARTITION BY station) AS DOUBLE) AS capacity
  FROM status QUALIFY row_number() OVER (PARTITION BY station ORDER BY dt DESC, status_id DESC) = 1)"""

DENSE = HOURLY + """, hours AS (
  SELECT unnest(generate_series(min(datehour), max(datehour), INTERVAL 1 HOUR)) AS datehour FROM hourly),
grid AS (SELECT station, datehour FROM dim CROSS JOIN hours),
dense AS (
  SELECT g.station, g.datehour, h.bikes,
         h.bikes - lag(h.bikes) OVER (PARTITION BY g.station ORDER BY g.datehour) AS delta
  FROM grid g LEFT JOIN hourly h ON g.station = h.station AND g.datehour = h.datehour)"""


def interp_sql(src: str, out: str, col: str, keys: str, max_len: int | None) -> str:
    part = f"PARTITION BY {keys} ORDER BY datehour" if keys else "ORDER BY datehour"
    part0 = f"PARTITION BY {keys}" if keys else ""
    limit = f"WHEN coalesce(ni, cnt + 1) - pi - 1 > {max_len} THEN NULL" if max_len is not None else ""
    return f""", {out}_a AS (
  SELECT *, row_number() OVER ({part}) AS i, count(*) OVER ({part0}) AS cnt FROM {src}),
{out}_b AS (
  SELECT *, last_value(CASE WHEN {col} IS NOT NULL THEN i END IGNORE NULLS) OVER wp AS pi,
         last_value({col} IGNORE NULLS) OVER wp AS pv,
         first_value(CASE WHEN {col} IS NOT NULL THEN i END IGNORE NULLS) OVER wn AS ni,
         first_value({col} IGNORE NULLS) OVER wn AS nv
  FROM {out}_a
  WINDOW wp AS ({part} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wn AS ({part} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{out} AS (
  SELECT * EXCLUDE (i, cnt, pi, pv, ni, nv) REPLACE (
    CASE WHEN {col} IS NOT NULL THEN {col} WHEN pv IS NULL THEN NULL {limit}
         WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (i - pi) / (ni - pi) END AS {col})
  FROM {out}_b)"""


def night_sql(src: str, out: str) -> str:
    return (
        f", {out}_n AS (SELECT *, (hour(datehour) < 6 OR hour(datehour) > 22) AS night, bikes AS raw FROM {src})"
        + interp_sql(f"{out}_n", f"{out}_i", "bikes", "station, night", 3)
        + f", {out} AS (SELECT * EXCLUDE (night, raw) REPLACE (CASE WHEN night THEN bikes ELSE raw END AS bikes) FROM {out}_i)"
    )


def outlier_sql(src: str, out: str, key: str) -> str:
    """Keep keys whose number of complete rows lies within three interquartile ranges."""
    return f""", {out}_c AS (
  SELECT {key} AS k, count(*) AS n FROM {src} WHERE bikes IS NOT NULL AND delta IS NOT NULL GROUP BY 1),
{out}_q AS (SELECT quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3 FROM {out}_c),
{out} AS (
  SELECT * FROM {src} WHERE {key} IN (
    SELECT k FROM {out}_c, {out}_q WHERE n >= q1 - 3 * (q3 - q1) AND n <= q3 + 3 * (q3 - q1)))"""


BASIC = (
    DENSE + outlier_sql("dense", "kept", "station") + interp_sql("kept", "short", "bikes", "station", 2)
    + night_sql("short", "nights") + """, basic AS (
  SELECT * REPLACE (bikes - lag(bikes) OVER (PARTITION BY station ORDER BY datehour) AS delta) FROM nights)"""
    + outlier_sql("basic", "dated", "CAST(datehour AS DATE)")
)

MEDIANS = BASIC + """, med AS (
  SELECT *, quantile_cont(delta, 0.5) OVER (
    PARTITION BY station, isodow(datehour), hour(datehour) ORDER BY datehour
    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS seasonal_median
  FROM dated),
near AS (
  SELECT *, last_value(seasonal_median IGNORE NULLS) OVER (
      PARTITION BY station ORDER BY datehour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS past,
    first_value(seasonal_median IGNORE NULLS) OVER (
      PARTITION BY station ORDER BY datehour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nxt
  FROM med)"""

FILLED = MEDIANS + """, filled AS (
  SELECT station, datehour, bikes, delta IS NULL AS reconstructed,
         coalesce(delta, seasonal_median, (coalesce(past, nxt) + coalesce(nxt, past)) / 2) AS delta
  FROM near)"""

REBUILT = FILLED + """, run AS (
  SELECT *, sum(coalesce(delta, 0)) OVER (PARTITION BY station ORDER BY datehour
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS flow FROM filled),
anchored AS (
  SELECT *, first_value(bikes IGNORE NULLS) OVER w AS b0,
         first_value(CASE WHEN bikes IS NOT NULL THEN flow END IGNORE NULLS) OVER w AS c0
  FROM run WINDOW w AS (PARTITION BY station ORDER BY datehour
    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
stocked AS (
  SELECT station, datehour, reconstructed, delta, coalesce(bikes, b0 + flow - c0) AS bikes FROM anchored),
rebuilt AS (
  SELECT station, datehour, reconstructed, bikes,
         coalesce(bikes - lag(bikes) OVER (PARTITION BY station ORDER BY datehour), trunc(delta)) AS delta
  FROM (SELECT * REPLACE (greatest(coalesce(bikes, 0), 0) AS bikes) FROM stocked))"""


# --- weather and calendar -------------------------------------------------------------------

def weather(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly observations with hours and values missing."""
    def pick(kind: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col("value"))
    return table(spark, sf, "events").groupBy(hour_floor(F.col("ts")).alias("datehour")).agg(
        F.max(pick("view")).alias("temp"), F.round(F.sum(pick("click")) / 100, 4).alias("precip"),
        F.sum(F.when(F.col("event_type") == "error", 1)).cast("double").alias("gel"),
        F.max(pick("purchase")).alias("vent"),
    )


WEATHER = """wx AS (
  SELECT date_trunc('hour', ts) AS datehour,
         max(CASE WHEN event_type = 'view' THEN value END) AS temp,
         round(sum(CASE WHEN event_type = 'click' THEN value END) / 100, 4) AS precip,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 END) AS DOUBLE) AS gel,
         max(CASE WHEN event_type = 'purchase' THEN value END) AS vent
  FROM events GROUP BY 1)"""

COMPLETE_WEATHER = (
    WEATHER + """, wx_dense AS (
  SELECT a.datehour, temp, coalesce(precip, 0) AS precip, coalesce(gel, 0) AS gel, vent
  FROM (SELECT unnest(generate_series(min(datehour), max(datehour), INTERVAL 1 HOUR)) AS datehour FROM wx) a
  LEFT JOIN wx ON a.datehour = wx.datehour)"""
    + interp_sql("wx_dense", "wx_temp", "temp", "", None) + interp_sql("wx_temp", "wx_full", "vent", "", None)
)


def calendars(spark: SparkSession) -> Calendars:
    return Calendars(holiday_dates(spark, HOLIDAYS), break_ranges(spark, BREAKS), break_ranges(spark, UNI_BREAKS))


def _dates(values: list[date]) -> str:
    return ", ".join(f"DATE '{d}'" for d in values)


def _between(d: str, ranges: list[tuple[date, date]]) -> str:
    return "(" + " OR ".join(f"{d} BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in ranges) + ")"


def calendar_sql(t: str = "datehour") -> str:
    """Select-list of the calendar columns of a timestamp expression."""
    d, hol = f"CAST({t} AS DATE)", _dates(HOLIDAYS)
    post = f"({d} NOT IN ({hol}) AND CAST({d} - INTERVAL 1 DAY AS DATE) IN ({hol}))"
    return f"""CAST(hour({t}) AS INTEGER) AS hour, CAST(month({t}) AS INTEGER) AS month, {d} AS date,
    CAST(isodow({t}) - 1 AS INTEGER) AS weekday, CAST(isodow({t}) >= 6 AS INTEGER) AS weekend,
    CAST({d} IN ({hol}) AS INTEGER) AS holiday,
    CAST({d} NOT IN ({hol}) AND CAST({d} + INTERVAL 1 DAY AS DATE) IN ({hol}) AS INTEGER) AS preholiday,
    CAST({post} AS INTEGER) AS postholiday, CAST({post} AND isodow({t}) = 5 AS INTEGER) AS pont,
    CAST({_between(d, BREAKS)} AS INTEGER) AS vacances, CAST({_between(d, UNI_BREAKS)} AS INTEGER) AS vacances_uni"""


# --- flow table -----------------------------------------------------------------------------

FLOW_VALUES = ["bikes", "delta", "temp", "precip", "gel", "vent"]

FLOW = REBUILT + ", " + COMPLETE_WEATHER + f""", flow AS (
  SELECT r.datehour, r.station, d.lat, d.lon, d.name, {calendar_sql("r.datehour")}, reconstructed, d.capacity,
         {", ".join(f"{s6(c)} AS {c}" for c in FLOW_VALUES)}
  FROM rebuilt r JOIN dim d ON r.station = d.station JOIN wx_full w ON r.datehour = w.datehour
  WHERE temp IS NOT NULL AND vent IS NOT NULL AND delta IS NOT NULL)"""


def fresh_flow(spark: SparkSession, sf: str, **options) -> DataFrame:
    cal = calendars(spark)
    flow = build_flow(status(spark, sf), weather(spark, sf), cal.holidays, cal.breaks, cal.uni_breaks, weather_places=6, **options)
    return rounded(flow, "bikes", "delta")


_STORED: dict[tuple[str, str, str], DataFrame] = {}


def stored(spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame], by_station: bool = False) -> DataFrame:
    """A table written below the shared folder once per application, as the jobs keep their
    processed tables; reports and models read it instead of repeating the whole history.
    Tables of station hours lie in buckets ``by_station``, which their windows and joins are keyed by."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        _STORED[key] = (write_by_station if by_station else write_and_read)(build(), scratch_path(spark, name))
    return _STORED[key]


def flow(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "flow", lambda: fresh_flow(spark, sf), by_station=True)


# --- scored rows ----------------------------------------------------------------------------

SCORED = FLOW + f""", scored AS (
  SELECT * FROM (
    SELECT *, delta AS delta_test, {s4("avg(delta) OVER w")} AS delta_pred, count(delta) OVER w AS seen FROM flow
    WINDOW w AS (PARTITION BY station, weekday, hour ORDER BY datehour ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))
  WHERE seen >= 3)"""

MARGINS = """, edge AS (
  SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high
  FROM (SELECT quantile_cont({col}, 0.25) AS q1, quantile_cont({col}, 0.75) AS q3 FROM {src}))"""


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Flow rows scored against their seasonal mean."""
    from dockflow.operators.lags import seasonal_mean

    def build() -> DataFrame:
        rows = seasonal_mean(flow(spark, sf), target="delta_pred").filter("delta_pred is not null")
        return rows.withColumns({"delta_pred": F.round("delta_pred", 4), "delta_test": F.col("delta")})
    return stored(spark, sf, "scored", build, by_station=True)


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("station", "datehour", F.col("delta_pred").alias("prediction"))


PREDICTIONS = SCORED + ", pred AS (SELECT station, datehour, delta_pred AS prediction FROM scored)"


# --- hourly health --------------------------------------------------------------------------

HEALTH = STATUS + """, health AS (
  SELECT date_trunc('hour', dt) AS datehour, count(*) AS n_rows, count(DISTINCT station) AS n_stations
  FROM status GROUP BY 1)"""
