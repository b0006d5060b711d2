"""Sources, filters, de-duplication, grid and reconstruction."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions import days, numeric, timefn
from dockflow.operators import dedup, filters, grid, outliers, rebuild, weather as wx_ops
from dockflow.registry.base import (
    COMPLETE_WEATHER, COPIED, DENSE, FILLED, FLOW, HOURLY, MEDIANS, REBUILT, STATUS, WEATHER,
    calendar_sql, calendars, copied_status, flow, fresh_flow, interp_sql, outlier_sql, night_sql, query, r6, rounded, s6, status,
    stored, table, weather, HOLIDAYS, BREAKS, _between, _dates,
)
from dockflow.session import scratch_path
from dockflow.sources import calendars as cal_src
from dockflow.sources import status as status_src
from dockflow.sources import tables, weather as wx_src
from dockflow.plans.flow import dense_series
from dockflow.plans.jobs import merged_log

ALL_STATUS = "status_id, station, bikes, capacity, lat, lon, name, dt, poll_dt"


def hourly(spark, sf) -> DataFrame:
    return stored(spark, sf, "hourly", lambda: grid.hourly_observations(status(spark, sf)))


def dense(spark, sf) -> DataFrame:
    return dense_series(hourly(spark, sf))


# --- sources ---

@query("a01_read_status", f"""WITH {STATUS}
SELECT status_id, station, lat, lon, 0 AS delta, bikes, capacity, name, dt FROM status
WHERE dt > TIMESTAMP '2024-01-05 10:00:00' AND dt < TIMESTAMP '2024-01-20 18:00:00'""")
def _(spark, sf):
    return status_src.read_status(status(spark, sf), datetime(2024, 1, 5, 10, 23), datetime(2024, 1, 20, 18, 59))


def status_payloads(spark, sf) -> DataFrame:
    """Two-station snapshots: the second station has no type list and no capacity keys."""
    s = status(spark, sf)
    one = F.struct(
        F.col("station").alias("station_id"), F.col("bikes").alias("num_bikes_available"),
        (30 - F.col("bikes")).alias("num_docks_available"),
        F.when(F.col("status_id") % 5 == 0, F.array().cast("array<map<string,int>>")).otherwise(
            F.array(
                F.create_map(F.lit("mechanical"), F.col("bikes") % 7), F.create_map(F.lit("ebike"), F.col("bikes") % 5)
            )
        ).alias("num_bikes_available_types"),
        F.lit(1).alias("is_installed"), F.lit(1).alias("is_returning"), (F.col("bikes") % 2).alias("is_renting"),
        F.unix_seconds(F.col("dt").cast("timestamp")).alias("last_reported"),
    )
    two = one.withField("station_id", F.concat(F.lit("x"), "station")).withField(
        "num_bikes_available_types", F.lit(None).cast("array<map<string,int>>")
    ).withField("num_docks_available", F.lit(None).cast("int"))
    payload = F.to_json(F.struct(F.struct(F.array(one, two).alias("stations")).alias("data")))
    return s.select(payload.alias("payload"), "poll_dt")


STATUS_ROWS = """SELECT station, bikes, 30 - bikes AS max_bikes,
    CASE WHEN status_id % 5 <> 0 THEN bikes % 7 END AS mechanical,
    CASE WHEN status_id % 5 <> 0 THEN bikes % 5 END AS ebike, 1 AS is_installed, 1 AS is_returning,
    bikes % 2 AS is_renting, date_trunc('second', dt) AS dt, poll_dt FROM status
  UNION ALL
  SELECT 'x' || station, bikes, NULL, NULL, NULL, 1, 1, bikes % 2, date_trunc('second', dt), poll_dt FROM status"""


@query("a02_parse_status", f"WITH {STATUS} {STATUS_ROWS}")
def _(spark, sf):
    return status_src.parse_status(status_payloads(spark, sf))


@query("a03_parse_stations", """
SELECT CAST(c_custkey AS VARCHAR) AS station, CAST(c_nationkey AS VARCHAR) AS lat,
       CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_nationkey + 1 AS VARCHAR) END AS lon, c_name AS name,
       CASE WHEN c_custkey % 4 <> 0 THEN c_nationkey END AS capacity
FROM customer""")
def _(spark, sf):
    key = F.col("c_custkey")
    station = F.struct(
        key.cast("string").alias("station_id"), F.col("c_nationkey").cast("string").alias("lat"),
        F.when(key % 3 != 0, (F.col("c_nationkey") + 1).cast("string")).alias("lon"), F.col("c_name").alias("name"),
        F.when(key % 4 != 0, F.col("c_nationkey")).alias("capacity"), F.lit("other").alias("extra"),
    )
    payload = F.to_json(F.struct(F.struct(F.array(station).alias("stations")).alias("data")))
    return status_src.parse_stations(table(spark, sf, "customer").select(payload.alias("payload")))


def weather_csv(spark, sf) -> str:
    """Observations as the semicolon file with decimal commas."""
    path = scratch_path(spark, "weather-csv")
    comma = lambda c: F.replace(F.col(c).cast("decimal(18,6)").cast("string"), F.lit("."), F.lit(","))
    weather(spark, sf).select(
        F.date_format(F.col("datehour").cast("timestamp"), "yyyyMMddHH").alias("DATE"), F.lit("x").alias("POSTE"),
        comma("temp").alias("T"), comma("precip").alias("RR1"), comma("gel").alias("DG"), comma("vent").alias("FF"),
    ).write.csv(path, sep=";", header=True)
    return path


@query("a04_read_weather_obs", f"WITH {WEATHER} SELECT * FROM wx")
def _(spark, sf):
    return rounded(wx_src.read_weather_obs(spark, weather_csv(spark, sf)), "temp", "precip", "gel", "vent")


def forecast_payloads(spark, sf) -> DataFrame:
    """One payload per 3-hour step of the observed weather, with keys missing."""
    w = weather(spark, sf).filter(F.hour("datehour") % 3 == 0)
    step = F.struct(
        F.unix_seconds(F.col("datehour").cast("timestamp")).alias("dt"),
        F.struct(F.coalesce(F.col("temp") - 12, F.lit(0.0)).alias("temp")).alias("main"),
        F.when(F.col("precip").isNotNull(), F.struct(F.col("precip").alias("3h"))).alias("rain"),
        F.when(F.col("gel").isNotNull(), F.struct(F.col("gel").alias("3h"))).alias("snow"),
        F.when(F.col("vent").isNotNull(), F.struct(F.col("vent").alias("speed"))).alias("wind"),
    )
    return w.select(F.lit("net").alias("station"), F.to_json(F.struct(F.array(step).alias("list"))).alias("payload"))


def forecast(spark, sf) -> DataFrame:
    return wx_src.parse_forecast(forecast_payloads(spark, sf))


FORECAST = WEATHER + """, step AS (
  SELECT datehour, coalesce(temp - 12, 0) AS temp, coalesce(precip, 0) + coalesce(gel, 0) AS precip,
         coalesce(vent, 0) AS vent FROM wx WHERE hour(datehour) % 3 = 0),
fc AS (
  SELECT 'net' AS station, datehour, temp, precip,
         CAST(CASE WHEN temp >= 0 THEN 0 ELSE least(-temp * 20, 60) END AS DOUBLE) AS gel, vent FROM step)"""
WX_COLS = ", ".join(f"{s6(c)} AS {c}" for c in ("temp", "precip", "gel", "vent"))


@query("a05_parse_forecast", f"WITH {FORECAST} SELECT station, datehour, {WX_COLS} FROM fc")
def _(spark, sf):
    return rounded(forecast(spark, sf), "temp", "precip", "gel", "vent")


@query("a06_read_holidays", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders")
def _(spark, sf):
    path = scratch_path(spark, "holidays-csv")
    day = F.to_date("o_orderdate")
    table(spark, sf, "orders").select(
        F.date_format(day, "yyyy-MM-dd").alias("﻿date"), F.lit("Jour").alias("name"), F.year(day).alias("year")
    ).write.csv(path, sep=";", header=True)
    return cal_src.read_holidays(spark, path)


@query("a07_read_breaks", """
SELECT CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate + INTERVAL 5 DAY AS DATE) AS end_date
FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) >= 1996""")
def _(spark, sf):
    path = scratch_path(spark, "breaks-csv")
    day = F.to_date("o_orderdate")
    stamp = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T23:00:00+00:00"))
    table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("Académies"), stamp(day).alias("Date de début"),
        stamp(F.date_add(day, 5)).alias("Date de fin"),
    ).write.csv(path, sep=";", header=True)
    return cal_src.read_breaks(spark, path, "1-URGENT", 1996)


@query("a08_break_ranges", f"""
SELECT CAST(ts AS DATE) AS date, count(*) AS n_events FROM events
WHERE {_between("CAST(ts AS DATE)", BREAKS)} GROUP BY 1""")
def _(spark, sf):
    per_day = table(spark, sf, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n_events"))
    return days.break_flags(per_day, cal_src.break_ranges(spark, BREAKS), "f").filter("f = 1").drop("f")


@query("a09_append_status", f"""WITH {STATUS}
SELECT {ALL_STATUS}, CAST(dt AS DATE) AS day FROM status UNION ALL
SELECT {ALL_STATUS}, CAST(dt AS DATE) FROM status WHERE bikes > 20""")
def _(spark, sf):
    path, s = scratch_path(spark, "log"), status(spark, sf)
    tables.append_status(s, path)
    tables.append_status(s.filter("bikes > 20"), path)
    return tables.load_table(spark, path)


@query("a10_save_load_table", f"WITH {STATUS} SELECT {ALL_STATUS} FROM status")
def _(spark, sf):
    path = scratch_path(spark, "saved")
    tables.save_table(status(spark, sf), path)
    return tables.load_table(spark, path)


@query("a11_recent_slice", f"""WITH {STATUS}
SELECT {ALL_STATUS} FROM status WHERE dt >= (SELECT max(dt) FROM status) - INTERVAL 7 DAY""")
def _(spark, sf):
    return tables.recent_slice(status(spark, sf), 7, "dt")


@query("a13_refresh_log", f"""WITH {STATUS}, raw AS (SELECT * FROM status WHERE dt < TIMESTAMP '2024-01-15 07:30:00')
SELECT {ALL_STATUS} FROM raw UNION ALL SELECT {ALL_STATUS} FROM status
WHERE dt > (SELECT date_trunc('hour', max(dt)) FROM raw)""")
def _(spark, sf):
    s = status(spark, sf)
    return merged_log(s.filter(F.col("dt") < F.lit("2024-01-15 07:30:00").cast("timestamp_ntz")), s)


# --- projections and filters ---

@query("b01_fix_types", f"""WITH {STATUS} SELECT status_id, station, CAST(bikes AS DOUBLE) AS bikes,
CAST(capacity AS DOUBLE) AS capacity, lat, lon, name, dt, poll_dt FROM status""")
def _(spark, sf):
    return filters.fix_types(status(spark, sf))


B02_COLUMNS = "datehour, date, station, lat, lon, name, hour, month, weekday, weekend, holiday, preholiday, postholiday, pont, vacances, vacances_uni, reconstructed, capacity, bikes, delta"


@query("b02_select_flow", f"WITH {FLOW} SELECT {B02_COLUMNS} FROM flow")
def _(spark, sf):
    return filters.select_flow(flow(spark, sf))


@query("b03_time_split", f"""WITH {FLOW}
SELECT 'all' AS part, * FROM (SELECT station, datehour, delta FROM flow WHERE date >= DATE '2024-01-03' AND date < DATE '2024-01-28')
UNION ALL SELECT 'train', station, datehour, delta FROM flow WHERE date >= DATE '2024-01-03' AND date < DATE '2024-01-21'
UNION ALL SELECT 'test', station, datehour, delta FROM flow WHERE date >= DATE '2024-01-21' AND date < DATE '2024-01-28'""")
def _(spark, sf):
    parts = filters.time_split(
        flow(spark, sf).select("station", "datehour", "delta"), date(2024, 1, 3), date(2024, 1, 21), date(2024, 1, 28)
    )
    named = [p.select(F.lit(n).alias("part"), "*") for n, p in zip(("all", "train", "test"), parts)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("b04_drop_incomplete", f"WITH {DENSE} SELECT * FROM dense WHERE bikes IS NOT NULL AND delta IS NOT NULL")
def _(spark, sf):
    return filters.drop_incomplete(dense(spark, sf))


@query("b05_observed_only", f"WITH {FLOW} SELECT station, datehour, bikes, delta FROM flow WHERE NOT reconstructed")
def _(spark, sf):
    return filters.observed_only(flow(spark, sf)).select("station", "datehour", "bikes", "delta")


@query("b06_clamp_stock", f"""WITH {STATUS}
SELECT status_id, CAST(greatest(coalesce(CASE WHEN status_id % 4 <> 0 THEN bikes - 10 END, 0), 0) AS DOUBLE) AS bikes FROM status""")
def _(spark, sf):
    s = status(spark, sf)
    return filters.clamp_stock(
        s.select("status_id", F.when(F.col("status_id") % 4 != 0, F.col("bikes") - 10).cast("double").alias("bikes"))
    )


@query("b07_drop_empty_columns", f"WITH {STATUS} SELECT status_id, station, bikes FROM status")
def _(spark, sf):
    s = status(spark, sf).select("status_id", "station", "bikes")
    return filters.drop_empty_columns(s.withColumns({"empty": F.lit(None).cast("int"), "void": F.lit(None).cast("string")}))


@query("b08_null_audit", f"""WITH {DENSE} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS station_nulls, CAST(0 AS BIGINT) AS datehour_nulls,
count(*) - count(bikes) AS bikes_nulls, count(*) - count(delta) AS delta_nulls,
2 * count(*) - count(bikes) - count(delta) AS null_cells,
count(*) FILTER (WHERE bikes IS NULL OR delta IS NULL) AS null_rows FROM dense""")
def _(spark, sf):
    return filters.null_audit(dense(spark, sf))


@query("b09_last_days", f"""WITH {FLOW}
SELECT station, datehour FROM flow WHERE datehour > (SELECT max(datehour) FROM flow) - INTERVAL 12 DAY""")
def _(spark, sf):
    return tables.last_days(flow(spark, sf).select("station", "datehour"), 12, strict=True)


@query("b10_valid_stations", f"""WITH {HOURLY}
SELECT CAST(c_custkey AS VARCHAR) AS station FROM customer WHERE CAST(c_custkey AS VARCHAR) IN (SELECT station FROM dim)""")
def _(spark, sf):
    requested = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("station"))
    return filters.valid_stations(requested, dedup.station_dim(status(spark, sf)))


@query("b11_float_features", f"""WITH {FLOW} SELECT station, datehour, CAST(hour AS DOUBLE) AS hour,
CAST(weekend AS DOUBLE) AS weekend, CAST(reconstructed AS DOUBLE) AS reconstructed, bikes FROM flow""")
def _(spark, sf):
    return filters.float_features(flow(spark, sf).select("station", "datehour", "hour", "weekend", "reconstructed", "bikes"))


@query("b12_select_stations", f"""WITH {HOURLY}
SELECT station, lat, lon, name FROM dim WHERE station IN ('3', '7') OR name IN ('S-11', 'S-12') OR CAST(station AS BIGINT) % 9 IN (4)""")
def _(spark, sf):
    dim = dedup.station_dim(status(spark, sf)).withColumn("cluster", F.col("station").cast("long") % 9)
    return filters.select_stations(dim, ["3", "7"], ["S-11", "S-12"], [4]).select("station", "lat", "lon", "name")


# --- de-duplication ---

@query("c01_drop_exact", f"""WITH {COPIED} SELECT {ALL_STATUS} FROM copied
QUALIFY row_number() OVER (PARTITION BY dt, bikes, capacity, station ORDER BY dt, status_id) = 1""")
def _(spark, sf):
    return dedup.drop_exact(copied_status(spark, sf))


@query("c02_first_per_hour", f"""WITH {STATUS} SELECT {ALL_STATUS}, date_trunc('hour', dt) AS datehour FROM status
QUALIFY row_number() OVER (PARTITION BY station, date_trunc('hour', dt) ORDER BY dt, status_id) = 1""")
def _(spark, sf):
    return dedup.first_per_hour(status(spark, sf))


@query("c03_duplicate_report", f"""WITH {COPIED}, one AS (SELECT DISTINCT dt, bikes, capacity, station FROM copied),
rep AS (
  SELECT 'exact' AS kind, (SELECT count(*) FROM copied) AS n_rows, (SELECT count(*) FROM copied) - (SELECT count(*) FROM one) AS duplicates
  UNION ALL
  SELECT 'hour', (SELECT count(*) FROM one), (SELECT count(*) FROM one) - (SELECT count(*) FROM (SELECT DISTINCT dt, station FROM one)))
SELECT kind, n_rows, duplicates, round(duplicates * 100 / CAST(n_rows AS DOUBLE), 2) AS percent FROM rep""")
def _(spark, sf):
    return dedup.duplicate_report(copied_status(spark, sf))


@query("c04_station_dim", f"""WITH {STATUS} SELECT station, lat, lon, name, bikes AS capacity FROM status
QUALIFY row_number() OVER (PARTITION BY station ORDER BY dt DESC, status_id DESC) = 1""")
def _(spark, sf):
    return dedup.station_dim(status(spark, sf).withColumn("capacity", F.col("bikes")))


# --- joins on the log and grid ---

@query("d01_status_view", f"""WITH {HOURLY}
SELECT s.status_id, s.station, s.bikes, s.dt, s.poll_dt, d.lat, d.lon, d.name, d.capacity,
       CAST(hour(s.dt) AS INTEGER) AS hour, CAST(isodow(s.dt) AS INTEGER) AS weekday
FROM status s JOIN dim d ON s.station = d.station""")
def _(spark, sf):
    s = status(spark, sf)
    return status_src.status_view(s, hourly(spark, sf).groupBy("station").agg(
        F.max_by(F.struct("lat", "lon", "name", "capacity"), "datehour").alias("d")).select("station", "d.*"))


@query("d02_hour_grid", f"WITH {DENSE} SELECT station, datehour FROM grid")
def _(spark, sf):
    return grid.hour_grid(hourly(spark, sf))


@query("d03_densify", f"WITH {DENSE} SELECT g.station, g.datehour, d.lat, d.lon, d.name, d.capacity, g.bikes FROM dense g JOIN dim d ON g.station = d.station")
def _(spark, sf):
    return grid.densify(hourly(spark, sf))


@query("d12_holiday_flags", f"""SELECT event_id, CAST(ts AS DATE) AS date,
CAST(CAST(ts AS DATE) IN ({_dates(HOLIDAYS)}) AS INTEGER) AS is_holiday,
CAST(CAST(ts + INTERVAL 1 DAY AS DATE) IN ({_dates(HOLIDAYS)}) AS INTEGER) AS before_holiday,
CAST(CAST(ts - INTERVAL 1 DAY AS DATE) IN ({_dates(HOLIDAYS)}) AS INTEGER) AS after_holiday FROM events""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("date"))
    return days.holiday_flags(ev, calendars(spark).holidays)


@query("d13_break_flags", f"""SELECT event_id, CAST(ts AS DATE) AS date,
CAST({_between("CAST(ts AS DATE)", BREAKS)} AS INTEGER) AS vacances FROM events""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("date"))
    return days.break_flags(ev, calendars(spark).breaks, "vacances")


# --- coverage and outliers ---

@query("e01_fix_capacity", f"""WITH {STATUS}
SELECT status_id, station, bikes, max(bikes) OVER (PARTITION BY station) AS capacity, dt FROM status""")
def _(spark, sf):
    return dedup.fix_capacity(status(spark, sf).select("status_id", "station", "bikes", "capacity", "dt"))


@query("e02_coverage_counts", f"WITH {DENSE} SELECT station, count(*) AS n FROM dense WHERE bikes IS NOT NULL AND delta IS NOT NULL GROUP BY 1")
def _(spark, sf):
    return outliers.coverage_counts(dense(spark, sf), "station")


def _label_sql(method: str, k: float) -> str:
    borders = {
        "IQR": f"quantile_cont(n, 0.25) - (quantile_cont(n, 0.75) - quantile_cont(n, 0.25)) * {k} AS low, quantile_cont(n, 0.75) + (quantile_cont(n, 0.75) - quantile_cont(n, 0.25)) * {k} AS high",
        "zscore": f"avg(n) - stddev_pop(n) * {k} AS low, avg(n) + stddev_pop(n) * {k} AS high",
        "hard": f"CAST({k} AS DOUBLE) AS low, CAST(max(n) AS DOUBLE) AS high",
    }[method]
    return f"""WITH {STATUS}, c AS (SELECT station, count(*) AS n FROM status GROUP BY 1), b AS (SELECT {borders} FROM c)
SELECT station, n, {s6("low")} AS low, {s6("high")} AS high,
CASE WHEN n > high THEN 'high' WHEN n < low THEN 'low' ELSE 'normal' END AS label FROM c, b"""


def _labels(method: str, k: float):
    def run(spark, sf):
        counts = outliers.coverage_counts(status(spark, sf), "station")
        return rounded(outliers.outlier_labels(counts, "n", k, method), "low", "high")
    return run


query("e03_outlier_labels_iqr", _label_sql("IQR", 0.9))(_labels("IQR", 0.9))
query("e03_outlier_labels_zscore", _label_sql("zscore", 1.3))(_labels("zscore", 1.3))
query("e03_outlier_labels_hard", _label_sql("hard", 60))(_labels("hard", 60))


@query("e04_drop_outlier_days", f"""WITH {DENSE}, c AS (SELECT CAST(datehour AS DATE) AS date, count(*) AS n FROM dense WHERE delta IS NOT NULL GROUP BY 1),
b AS (SELECT quantile_cont(n, 0.25) AS q1, quantile_cont(n, 0.75) AS q3 FROM c)
SELECT CAST(datehour AS DATE) AS date, station, datehour, bikes, delta FROM dense WHERE CAST(datehour AS DATE) IN (
SELECT date FROM c, b WHERE n BETWEEN q1 - 0.5 * (q3 - q1) AND q3 + 0.5 * (q3 - q1))""")
def _(spark, sf):
    return outliers.drop_outliers(dense(spark, sf).withColumn("date", F.to_date("datehour")), "date", k=0.5)


@query("e04_drop_outlier_stations", f"WITH {DENSE}{outlier_sql('dense', 'kept', 'station')} SELECT * FROM kept")
def _(spark, sf):
    return outliers.drop_outliers(dense(spark, sf), "station")


@query("e04_drop_outlier_stations_legacy", f"""WITH {DENSE} SELECT * FROM dense WHERE station IN (SELECT station FROM dense WHERE delta IS NOT NULL)""")
def _(spark, sf):
    return outliers.drop_outliers(dense(spark, sf), "station", legacy=True)


# --- gaps and reconstruction ---

@query("f01_add_delta", f"WITH {DENSE} SELECT station, datehour, bikes, delta FROM dense")
def _(spark, sf):
    return dense(spark, sf).select("station", "datehour", "bikes", "delta")


@query("f01_add_delta_log", f"""WITH {STATUS}
SELECT {ALL_STATUS}, bikes - lag(bikes) OVER (PARTITION BY station ORDER BY dt, status_id) AS delta FROM status""")
def _(spark, sf):
    return grid.add_delta_log(status(spark, sf))


RUNS = DENSE + """, runs_a AS (
  SELECT station, datehour, bikes, delta, bikes IS NULL AND coalesce(lag(bikes IS NULL) OVER w, FALSE) = FALSE AS starts FROM dense
  WINDOW w AS (PARTITION BY station ORDER BY datehour)),
runs_b AS (SELECT *, CASE WHEN bikes IS NULL THEN CAST(sum(CAST(starts AS INTEGER)) OVER (PARTITION BY station ORDER BY datehour) AS BIGINT) END AS run_id FROM runs_a),
runs AS (SELECT *, CASE WHEN run_id IS NOT NULL THEN count(*) OVER (PARTITION BY station, run_id) END AS run_length FROM runs_b)"""


@query("f02_null_runs", f"WITH {RUNS} SELECT station, datehour, bikes, run_id, run_length FROM runs")
def _(spark, sf):
    return rebuild.null_runs(dense(spark, sf), "bikes").drop("delta")


@query("f03_interpolate_gaps", f"WITH {DENSE} {interp_sql('dense', 'short', 'bikes', 'station', 2)} SELECT station, datehour, {s6('bikes')} AS bikes FROM short")
def _(spark, sf):
    return rounded(rebuild.interpolate_gaps(dense(spark, sf), "bikes", 2).drop("delta"), "bikes")


@query("f04_interpolate_night", f"WITH {DENSE} {night_sql('dense', 'nights')} SELECT station, datehour, {s6('bikes')} AS bikes FROM nights")
def _(spark, sf):
    return rounded(rebuild.interpolate_night(dense(spark, sf)).drop("delta"), "bikes")


def basic(spark, sf) -> DataFrame:
    """Short gaps filled, outlier stations and days dropped, keyed for the seasonal windows."""
    def build() -> DataFrame:
        kept = rebuild.rebuild_short_gaps(outliers.drop_outliers(dense(spark, sf), "station"))
        dated = outliers.drop_outliers(kept.withColumn("date", F.to_date("datehour")), "date").drop("date")
        return dated.withColumns({"weekday": F.weekday("datehour"), "hour": F.hour("datehour")})
    return stored(spark, sf, "basic", build, by_station=True)


@query("f05_seasonal_median", f"WITH {MEDIANS} SELECT station, datehour, {s6('seasonal_median')} AS seasonal_median FROM med")
def _(spark, sf):
    return rounded(rebuild.seasonal_median(basic(spark, sf)), "seasonal_median").select("station", "datehour", "seasonal_median")


@query("f06_neighbour_mean", f"WITH {MEDIANS} SELECT station, datehour, {s6('(coalesce(past, nxt) + coalesce(nxt, past)) / 2')} AS neighbour_mean FROM near")
def _(spark, sf):
    out = rebuild.neighbour_mean(rebuild.seasonal_median(basic(spark, sf)), "seasonal_median")
    return rounded(out, "neighbour_mean").select("station", "datehour", "neighbour_mean")


@query("f07_fill_delta", f"WITH {FILLED} SELECT station, datehour, reconstructed, {s6('delta')} AS delta FROM filled")
def _(spark, sf):
    return rounded(rebuild.fill_delta(basic(spark, sf)), "delta").select("station", "datehour", "reconstructed", "delta")


@query("f08_fill_stock", f"WITH {REBUILT} SELECT station, datehour, {s6('bikes')} AS bikes FROM stocked")
def _(spark, sf):
    return rounded(rebuild.fill_stock(rebuild.fill_delta(basic(spark, sf))), "bikes").select("station", "datehour", "bikes")


def _run_cumsum_sql(order: str) -> str:
    return f"""WITH {RUNS}, v AS (SELECT r.*, CAST(hour(datehour) AS BIGINT) AS source FROM runs r)
SELECT station, datehour, CASE WHEN run_id IS NOT NULL THEN CAST(sum(source) OVER (PARTITION BY station, run_id ORDER BY datehour {order}) AS BIGINT) END AS total FROM v"""


@query("f09_run_cumsum_forward", _run_cumsum_sql("ASC"))
def _(spark, sf):
    d = dense(spark, sf).withColumn("source", F.hour("datehour"))
    return rebuild.run_cumsum(d, "bikes", "source", "total").select("station", "datehour", "total")


@query("f09_run_cumsum_reverse", _run_cumsum_sql("DESC"))
def _(spark, sf):
    d = dense(spark, sf).withColumn("source", F.hour("datehour"))
    return rebuild.run_cumsum(d, "bikes", "source", "total", reverse=True).select("station", "datehour", "total")


@query("e28_reconstruction_report", f"""WITH {FLOW} SELECT count(*) AS n_rows, count(*) FILTER (WHERE reconstructed) AS rebuilt,
round(count(*) FILTER (WHERE reconstructed) * 100 / CAST(count(*) AS DOUBLE), 2) AS percent FROM flow""")
def _(spark, sf):
    return rebuild.reconstruction_report(flow(spark, sf))


# --- weather ---

@query("f17_complete_weather", f"WITH {COMPLETE_WEATHER} SELECT datehour, {WX_COLS} FROM wx_full")
def _(spark, sf):
    return rounded(wx_ops.complete_weather(weather(spark, sf)), "temp", "precip", "gel", "vent")


HOURLY_FORECAST = (
    FORECAST + """, fc_dense AS (
  SELECT 'net' AS station, a.datehour, temp, coalesce(precip, 0) AS precip, gel, vent
  FROM (SELECT unnest(generate_series(min(datehour) - INTERVAL 2 HOUR, max(datehour) + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datehour FROM fc) a
  LEFT JOIN fc ON a.datehour = fc.datehour),
fc_rain AS (SELECT * REPLACE (avg(precip) OVER (ORDER BY datehour ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS precip) FROM fc_dense)"""
    + interp_sql("fc_rain", "fc_t", "temp", "", None) + interp_sql("fc_t", "fc_g", "gel", "", None)
    + interp_sql("fc_g", "fc_v", "vent", "", None) + """, fc_hour AS (
  SELECT station, datehour, coalesce(temp, first_value(temp IGNORE NULLS) OVER w) AS temp, precip,
         coalesce(gel, first_value(gel IGNORE NULLS) OVER w) AS gel, coalesce(vent, first_value(vent IGNORE NULLS) OVER w) AS vent
  FROM fc_v WINDOW w AS (ORDER BY datehour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
)


@query("f18_hourly_forecast", f"WITH {HOURLY_FORECAST} SELECT station, datehour, {WX_COLS} FROM fc_hour")
def _(spark, sf):
    return rounded(wx_ops.hourly_forecast(forecast(spark, sf)), "temp", "precip", "gel", "vent")


@query("d04_join_weather", f"""WITH {DENSE}, {COMPLETE_WEATHER} SELECT d.station, d.datehour, bikes, delta, {WX_COLS}
FROM dense d JOIN wx_full w ON d.datehour = w.datehour WHERE delta IS NOT NULL AND temp IS NOT NULL AND vent IS NOT NULL""")
def _(spark, sf):
    out = wx_ops.join_weather(dense(spark, sf), wx_ops.complete_weather(weather(spark, sf)))
    return rounded(out, "temp", "precip", "gel", "vent").select("station", "datehour", "bikes", "delta", "temp", "precip", "gel", "vent")


# --- whole job and scalars ---

FLOW_COLUMNS = B02_COLUMNS + ", temp, precip, gel, vent"


@query("j21_build_flow", f"WITH {FLOW} SELECT {FLOW_COLUMNS} FROM flow")
def _(spark, sf):
    return fresh_flow(spark, sf)


@query("i01_hour_floor", "SELECT event_id, date_trunc('hour', ts) AS datehour FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", timefn.hour_floor(F.col("ts")).alias("datehour"))


@query("i02_i03_calendar", f"SELECT event_id, ts AS datehour, {calendar_sql('ts')} FROM events")
def _(spark, sf):
    cal = calendars(spark)
    ev = table(spark, sf, "events").select("event_id", F.col("ts").alias("datehour"))
    return days.add_calendar(ev, cal.holidays, cal.breaks, cal.uni_breaks)


@query("i04_day_off", f"""WITH c AS (SELECT event_id, {calendar_sql('ts')} FROM events)
SELECT event_id, greatest(holiday, pont) AS dayoff FROM c""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.to_date("ts").alias("date"))
    return days.special_days(ev, calendars(spark).holidays).select("event_id", days.day_off().alias("dayoff"))


@query("i05_utc_to_local", "SELECT l_orderkey, l_linenumber, timezone('UTC', l_shipdate + INTERVAL 1 HOUR * l_linenumber) AT TIME ZONE 'Europe/Paris' AS local FROM lineitem")
def _(spark, sf):
    t = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", timefn.utc_to_local(t).alias("local"))


@query("i06_local_to_utc", """SELECT l_orderkey, l_linenumber, timezone('Europe/Paris', l_shipdate + INTERVAL 12 HOUR) AT TIME ZONE 'UTC' AS utc FROM lineitem""")
def _(spark, sf):
    t = F.col("l_shipdate") + F.expr("interval 12 hours")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", timefn.local_to_utc(t).alias("utc"))


@query("i07_parse_hour_stamp", "SELECT event_id, date_trunc('hour', ts) AS datehour FROM events")
def _(spark, sf):
    stamp = F.concat(F.date_format(F.to_date("ts"), "yyyyMMdd"), F.lpad(F.hour("ts").cast("string"), 2, "0"))
    return table(spark, sf, "events").select("event_id", timefn.parse_hour_stamp(stamp).alias("datehour"))


@query("i08_parse_decimal_comma", "SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS number FROM events")
def _(spark, sf):
    text = F.replace(F.col("value").cast("string"), F.lit("."), F.lit(","))
    text = F.when(F.col("event_type") == "view", F.lit("n/a")).otherwise(text)
    return table(spark, sf, "events").select("event_id", numeric.parse_decimal_comma(text).alias("number"))


@query("i09_cyclic", f"""WITH c AS (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS weekday FROM events),
p AS (SELECT CAST(count(DISTINCT weekday) AS DOUBLE) AS p FROM c)
SELECT event_id, hour, weekday, {s6('sin(hour / 24.0 * 2 * pi())')} AS sin_hour, {s6('cos(hour / 24.0 * 2 * pi())')} AS cos_hour,
{s6('sin(weekday / p * 2 * pi())')} AS sin_weekday, {s6('cos(weekday / p * 2 * pi())')} AS cos_weekday FROM c, p""")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"), F.weekday("ts").alias("weekday"))
    return rounded(numeric.cyclic(ev, ["hour", "weekday"], [24, None]), "sin_hour", "cos_hour", "sin_weekday", "cos_weekday")


@query("i10_to_metres", f"""WITH {HOURLY} SELECT station, {s6('(lat - (SELECT min(lat) FROM dim)) * 111000')} AS lat,
{s6('(lon - (SELECT min(lon) FROM dim)) * 72987')} AS lon FROM dim""")
def _(spark, sf):
    return rounded(numeric.to_metres(dedup.station_dim(status(spark, sf)).select("station", "lat", "lon")), "lat", "lon")


@query("i11_frost_minutes", f"SELECT event_id, {s6('CASE WHEN value - 100 >= 0 THEN 0 ELSE least(-(value - 100) * 20, 60) END')} AS gel FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", r6(numeric.frost_minutes(F.col("value") - 100)).alias("gel"))


@query("i12_day_hours", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, unnest(generate_series(date_trunc('day', o_orderdate),
date_trunc('day', o_orderdate) + INTERVAL 23 HOUR, INTERVAL 1 HOUR)) AS datehour FROM orders""")
def _(spark, sf):
    return timefn.day_hours(table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date")))


@query("i13_range_hours", """SELECT event_id, unnest(generate_series(date_trunc('hour', ts), date_trunc('hour', ts) +
INTERVAL 1 HOUR * (event_id % 4) - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS datehour FROM events WHERE event_id % 4 > 0""")
def _(spark, sf):
    start = timefn.hour_floor(F.col("ts"))
    end = start + F.make_dt_interval(F.lit(0), (F.col("event_id") % 4).cast("int"))
    ev = table(spark, sf, "events").select("event_id", start.alias("start"), end.alias("end"))
    return timefn.range_hours(ev).select("event_id", "datehour")


@query("i14_epoch_to_ts", "SELECT event_id, date_trunc('second', ts) AS dt FROM events")
def _(spark, sf):
    epoch = F.unix_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", timefn.epoch_to_ts(epoch).alias("dt"))


@query("i15_first_key", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS BIGINT) WHEN event_id % 3 = 1 THEN user_id + 1 END AS first
FROM events""")
def _(spark, sf):
    u, m = F.col("user_id"), F.col("event_id") % 3
    a = F.create_map(F.lit("a"), F.when(m == 0, u))
    b = F.create_map(F.lit("b"), u)
    c = F.create_map(F.lit("a"), u + 1)
    lists = F.when(m == 2, F.array(b)).otherwise(F.array(b, a, c))
    return table(spark, sf, "events").select("event_id", numeric.first_key(lists, "a").alias("first"))


@query("i16_weekday_label", """SELECT event_id, ['Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam', 'Dim'][isodow(ts)] AS label FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", timefn.weekday_label(F.weekday("ts")).alias("label"))


@query("h01_append_batches", f"WITH {STATUS} SELECT {ALL_STATUS} FROM status UNION ALL SELECT {ALL_STATUS} FROM status WHERE bikes < 5")
def _(spark, sf):
    s = status(spark, sf)
    return status_src.append_batches(s, s.filter("bikes < 5"))
