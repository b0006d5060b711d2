"""Scores, profiles, drift, usage reports, monitoring and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators import alerts, drift, ranking, scores
from dockflow.operators import reports as rep
from dockflow.registry.base import (
    DENSE, FLOW, FLOW_VALUES, HEALTH, MARGINS, PREDICTIONS, SCORED, flow, predictions, query, r6, rounded, s4, s6,
    scored, status, stored, table,
)
from dockflow.registry.cleaning import dense
from dockflow.registry.features import flow_margins
from dockflow.session import scratch_path
from dockflow.sources import tables

EDGE = SCORED + MARGINS.format(col="delta", src="flow")


# --- scores ---

@query("e07_margins", f"WITH {FLOW} {MARGINS.format(col='delta', src='flow')} SELECT {s6('low')} AS low, {s6('high')} AS high FROM edge")
def _(spark, sf):
    return rounded(ranking.margins(flow(spark, sf)), "low", "high")


RUSH = SCORED + """, sums AS (
  SELECT station, date, hour <= 12 AS morning, sum(delta_test) AS delta_test, sum(delta_pred) AS delta_pred FROM scored
  WHERE hour BETWEEN 6 AND 12 OR hour BETWEEN 15 AND 22 GROUP BY 1, 2, 3)"""


@query("e11_rush_error", f"""WITH {RUSH}, t AS (SELECT min(date) AS d FROM scored WHERE weekday = 3), e AS (SELECT *, abs(delta_test - delta_pred) AS e FROM sums)
SELECT {s4('avg(e)')} AS mare, {s4("avg(e) FILTER (WHERE station = '7')")} AS station_mare,
{s4('avg(e) FILTER (WHERE date = (SELECT d FROM t))')} AS date_mare,
{s4("avg(e) FILTER (WHERE date = (SELECT d FROM t) AND station = '7')")} AS date_station_mare FROM e""")
def _(spark, sf):
    out = scores.rush_error(scored(spark, sf), "7")
    return rounded(out, *out.columns, places=4)


@query("e12_regression_scores", f"""WITH {SCORED} SELECT {s6('sqrt(avg((delta_test - delta_pred) * (delta_test - delta_pred)))')} AS rmse,
{s6('avg(abs(delta_test - delta_pred))')} AS mae FROM scored""")
def _(spark, sf):
    return rounded(scores.regression_scores(scored(spark, sf)), "rmse", "mae")


@query("e13_peak_scores", f"""WITH {EDGE}, p AS (SELECT delta_test - delta_pred AS e FROM scored, edge WHERE delta_test < low OR delta_test > high)
SELECT {s6('sqrt(avg(e * e))')} AS pic_rmse, {s6('avg(abs(e))')} AS pic_mae FROM p""")
def _(spark, sf):
    return rounded(scores.peak_scores(scored(spark, sf), *flow_margins(spark, sf)), "pic_rmse", "pic_mae")


@query("e14_station_scores", f"""WITH {EDGE}, p AS (SELECT station, delta_test - delta_pred AS e, delta_test < low OR delta_test > high AS peak FROM scored, edge)
SELECT station, {s6('sqrt(avg(e * e))')} AS rmse, {s6('sqrt(avg(e * e) FILTER (WHERE peak))')} AS pic_rmse FROM p GROUP BY 1""")
def _(spark, sf):
    return rounded(scores.station_scores(scored(spark, sf), *flow_margins(spark, sf)), "rmse", "pic_rmse")


@query("e15_rush_share", f"""WITH {FLOW} {MARGINS.format(col='delta', src='flow')}
SELECT {s6('avg(CASE WHEN delta < low OR delta > high THEN 1.0 ELSE 0.0 END)')} AS rush_share FROM flow, edge""")
def _(spark, sf):
    return rounded(scores.rush_share(flow(spark, sf), *flow_margins(spark, sf)), "rush_share")


@query("e29_peak_demand", f"""WITH {RUSH} SELECT station, date, morning, {s4('delta_test')} AS delta_test, {s4('delta_pred')} AS delta_pred,
{s4('greatest(-delta_test, 0)')} AS bikes_needed, {s4('greatest(delta_test, 0)')} AS places_needed,
{s4('greatest(-delta_pred, 0)')} AS bikes_predicted, {s4('greatest(delta_pred, 0)')} AS places_predicted FROM sums""")
def _(spark, sf):
    out = scores.peak_demand(scored(spark, sf))
    return rounded(out, *[c for c in out.columns if c not in ("station", "date", "morning")], places=4)


# --- profiles and drift ---

VALUES = drift.PROFILE_VALUES


def profile_sql(src: str, selection: str) -> str:
    """Long profile rows of one selection."""
    parts = [f"SELECT '{selection}' AS selection, 'count' AS category, 'all' AS metric, CAST(count(*) AS DOUBLE) AS value FROM {src}",
             f"SELECT '{selection}', 'count', 'na', CAST(0 AS DOUBLE)"]
    for v in VALUES:
        q = f"(SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS q2, quantile_cont({v}, 0.75) AS q3, min({v}) AS lo, max({v}) AS hi FROM {src})"
        fence = f"FROM {src}, {q}"
        top = f"{v} > q3 + (q3 - q1) * 1.5"
        bottom = f"{v} < q1 - (q3 - q1) * 1.5"
        parts.append(f"SELECT '{selection}', 'count', '{v}_na', CAST(count(*) - count({v}) AS DOUBLE) FROM {src}")
        for name, cond in (("outliers_top", top), ("outliers_bottom", bottom), ("outliers", f"{top} OR {bottom}")):
            parts.append(f"SELECT '{selection}', 'count', '{v}_{name}', CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) {fence}")
        for name, e in (("q1", "q1"), ("q2", "q2"), ("q3", "q3"), ("high", "q3 + (q3 - q1) * 1.5"), ("low", "q1 - (q3 - q1) * 1.5"), ("min", "lo"), ("max", "hi")):
            parts.append(f"SELECT '{selection}', 'stats', '{v}_{name}', {s6(e)} FROM {q}")
    return " UNION ALL ".join(parts)


PERIODS = FLOW + """, recent AS (SELECT * FROM flow WHERE datehour >= (SELECT max(datehour) FROM flow) - INTERVAL 15 DAY),
previous AS (SELECT * FROM flow WHERE datehour < (SELECT max(datehour) FROM flow) - INTERVAL 15 DAY
  AND datehour >= (SELECT max(datehour) FROM flow) - INTERVAL 30 DAY)"""


def ks_sql(v: str) -> str:
    return f"""SELECT '{v}' AS metric, {s6('max(abs(fa - fb))')} AS ks FROM (
  SELECT v, sum(sum(a)) OVER (ORDER BY v) / sum(sum(a)) OVER () AS fa, sum(sum(b)) OVER (ORDER BY v) / sum(sum(b)) OVER () AS fb
  FROM (SELECT {v} AS v, CAST(1 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b FROM recent UNION ALL SELECT {v}, 0, 1 FROM previous) GROUP BY v)"""


KS = " UNION ALL ".join(ks_sql(v) for v in VALUES)


@query("e05_profile", f"WITH {FLOW} {profile_sql('flow', 'full')}")
def _(spark, sf):
    return rounded(drift.profile(flow(spark, sf)), "value")


@query("e08_ks_stat", f"WITH {PERIODS} {KS}")
def _(spark, sf):
    return rounded(drift.drift_stats(flow(spark, sf), 15), "ks")


REPORT = f"""{profile_sql('flow', 'full')} UNION ALL {profile_sql('recent', '15d')}
UNION ALL SELECT '15d', 'kstest', metric, ks FROM ({KS})"""


def stats(spark, sf) -> DataFrame:
    return stored(spark, sf, "stats", lambda: rounded(drift.profile_report(flow(spark, sf), 15), "value"))


@query("e06_profile_report", f"WITH {PERIODS} {REPORT}")
def _(spark, sf):
    return stats(spark, sf)


@query("a12_e27_stats_document", f"WITH {PERIODS} {REPORT}")
def _(spark, sf):
    from dockflow.session import scratch_path

    path = scratch_path(spark, "stats")
    tables.write_stats(stats(spark, sf), path, "h2024013100")
    return rep.stats_to_long(spark.read.text(f"{path}/document"), "value")


@query("e27_dataset_limits", f"WITH {FLOW} SELECT min(datehour) AS start_dt, max(datehour) AS end_dt FROM flow")
def _(spark, sf):
    return rep.dataset_limits(flow(spark, sf))


# --- monitoring ---

@query("e16_last_hour_counts", f"""WITH {HEALTH} SELECT count(*) AS n_rows, count(DISTINCT station) AS n_stations FROM status
WHERE poll_dt >= (SELECT max(poll_dt) FROM status) - INTERVAL 1 HOUR""")
def _(spark, sf):
    return rep.last_hour_counts(status(spark, sf))


COUNTED = [
    "benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation", "orders",
    "pages", "part", "region", "supplier",
]


@query("e17_table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED))
def _(spark, sf):
    return tables.table_counts({t: table(spark, sf, t) for t in COUNTED})


STATION_HOURS = DENSE + ", known AS (SELECT datehour, count(DISTINCT station) AS n_stations FROM dense WHERE bikes IS NOT NULL GROUP BY 1)"


@query("e18_stations_per_hour", f"WITH {STATION_HOURS} SELECT * FROM known")
def _(spark, sf):
    return rep.stations_per_hour(dense(spark, sf))


@query("e19_box_summary", f"""WITH {STATION_HOURS}, q AS (SELECT CAST(min(n_stations) AS DOUBLE) AS lo, quantile_cont(n_stations, 0.25) AS q1,
quantile_cont(n_stations, 0.5) AS q2, quantile_cont(n_stations, 0.75) AS q3, CAST(max(n_stations) AS DOUBLE) AS hi FROM known)
SELECT lo AS min, q1, q2 AS median, q3, hi AS max, q1 - (q3 - q1) * 1.5 AS low_fence, q3 + (q3 - q1) * 1.5 AS high_fence FROM q""")
def _(spark, sf):
    return rep.box_summary(rep.stations_per_hour(dense(spark, sf)), "n_stations")


@query("e20_usage_by_hour", f"""WITH {FLOW}, n AS (SELECT datehour, sum(delta) AS flow FROM flow GROUP BY 1)
SELECT CAST(hour(datehour) AS INTEGER) AS hour, {s4('min(flow)')} AS min_flow, {s4('avg(flow)')} AS mean_flow, {s4('max(flow)')} AS max_flow FROM n GROUP BY 1""")
def _(spark, sf):
    return rounded(rep.usage_by_hour(flow(spark, sf)), "min_flow", "mean_flow", "max_flow", places=4)


@query("e21_weather_corr", f"WITH {FLOW} SELECT {s6('corr(delta, temp)')} AS corr_temp, {s6('corr(delta, precip)')} AS corr_precip FROM flow")
def _(spark, sf):
    return rounded(rep.weather_corr(flow(spark, sf)), "corr_temp", "corr_precip")


@query("b13_station_week", f"""WITH {FLOW} SELECT date, hour, delta, {s4('sm')} AS smoothed FROM (
  SELECT *, avg(delta) OVER (PARTITION BY station ORDER BY datehour RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR FOLLOWING) AS sm FROM flow)
WHERE station = '7' AND week(datehour) = 3""")
def _(spark, sf):
    return rounded(rep.station_week(flow(spark, sf), "7", 3), "smoothed", places=4)


# --- prediction reports ---

@query("e22_flow_totals", f"""WITH {PREDICTIONS} SELECT abs(round(sum(least(prediction, 0)))) AS taken, round(sum(greatest(prediction, 0))) AS returned,
round(sum(prediction), 2) + CAST(0 AS DOUBLE) AS net FROM pred""")
def _(spark, sf):
    return rep.flow_totals(predictions(spark, sf))


@query("e23_flow_per_hour", f"WITH {PREDICTIONS} SELECT datehour, {s4('sum(prediction)')} AS flow FROM pred GROUP BY 1")
def _(spark, sf):
    return rounded(rep.flow_per_hour(predictions(spark, sf)), "flow", places=4)


@query("e24_g03_flow_per_day", f"""WITH {PREDICTIONS} SELECT CAST(datehour AS DATE) AS date,
['Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam', 'Dim'][isodow(min(datehour))] AS dayofweek,
round(abs(sum(least(prediction, 0)))) AS taken, round(sum(greatest(prediction, 0))) AS returned, round(sum(prediction)) + CAST(0 AS DOUBLE) AS total,
round(sum(CASE WHEN hour(datehour) < 12 THEN prediction ELSE 0 END)) + CAST(0 AS DOUBLE) AS morning,
round(sum(CASE WHEN hour(datehour) >= 12 THEN prediction ELSE 0 END)) + CAST(0 AS DOUBLE) AS afternoon
FROM pred GROUP BY 1 ORDER BY 1""")
def _(spark, sf):
    return rep.flow_per_day(predictions(spark, sf))


@query("e25_dataset_id", f"""WITH {FLOW} SELECT strftime(min(datehour), '%Y%m%d_%H') || '-' || strftime(max(datehour), '%Y%m%d_%H') || '_train' AS dataset_id FROM flow""")
def _(spark, sf):
    return rep.dataset_id(flow(spark, sf))


# Run log: orders as training runs, one experiment per priority.
def runs(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders")
    key, st = F.col("o_orderkey"), F.col("o_orderstatus")
    return o.select(
        F.col("o_orderpriority").alias("experiment"), key.alias("run_id"),
        F.when(st == "F", "FINISHED").when(st == "O", "RUNNING").otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("created"), F.col("o_orderdate").alias("start_time"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), (key % 50).cast("int"))).alias("end_time"),
        F.when(key % 2 == 0, F.create_map(F.lit("wh"), (key % 7).cast("string"))).otherwise(F.create_map().cast("map<string,string>")).alias("params"),
        F.create_map(F.lit("starter"), F.lit("job")).alias("tags"),
        F.create_map(F.lit("rmse"), F.col("o_totalprice"), F.lit("mae"), F.col("o_totalprice") / 2).alias("metrics"),
    )


RUNS = """runs AS (
  SELECT o_orderpriority AS experiment, o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
         o_orderdate AS created, o_totalprice FROM orders WHERE o_orderstatus <> 'O'),
latest AS (
  SELECT *, count(*) OVER (PARTITION BY experiment) AS n_runs FROM runs
  QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY created DESC, run_id DESC) = 1)"""


@query("e26_run_summary", f"""WITH {RUNS} SELECT experiment, n_runs, run_id, 'job' AS starter,
CASE WHEN run_id % 2 = 0 THEN CAST(run_id % 7 AS VARCHAR) ELSE 'unknown' END AS wh, 'unknown' AS batch_size, 'unknown' AS loss_fn,
CAST((run_id % 50) * 60 AS BIGINT) AS duration_seconds, CAST(status = 'FINISHED' AS INTEGER) AS finished,
CAST(status = 'RUNNING' AS INTEGER) AS running, CAST(status = 'FAILED' AS INTEGER) AS failed FROM latest""")
def _(spark, sf):
    return rep.run_summary(runs(spark, sf)).drop("metrics")


@query("e26_run_metrics", f"""WITH {RUNS} SELECT experiment, 'rmse' AS metric, o_totalprice AS value FROM latest WHERE status = 'FINISHED'
UNION ALL SELECT experiment, 'mae', o_totalprice / 2 FROM latest WHERE status = 'FINISHED'""")
def _(spark, sf):
    return rep.run_metrics(rep.run_summary(runs(spark, sf)))


@query("g01_latest_rows", f"WITH {FLOW} SELECT station, datehour, bikes, delta FROM flow ORDER BY datehour DESC, station DESC LIMIT 100")
def _(spark, sf):
    return rep.latest_rows(flow(spark, sf).select("station", "datehour", "bikes", "delta"), 100)


@query("g02_best_candidate", """WITH s AS (SELECT p_size AS k, CAST(count(*) AS DOUBLE) AS score FROM part GROUP BY 1)
SELECT k, score FROM s ORDER BY score DESC, k LIMIT 1""")
def _(spark, sf):
    s = table(spark, sf, "part").groupBy(F.col("p_size").alias("k")).agg(F.count(F.lit(1)).cast("double").alias("score"))
    return rep.best_candidate(s)


# --- metric functions and alerts ---

def health(spark, sf) -> DataFrame:
    return stored(spark, sf, "health", lambda: rep.hourly_health(status(spark, sf)))


def metrics(spark, sf) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in ("n_rows", "n_stations")])
    return health(spark, sf).select("datehour", F.inline(pairs))


METRICS = HEALTH + """, metrics AS (
  SELECT datehour, 'n_rows' AS metric, CAST(n_rows AS DOUBLE) AS value FROM health
  UNION ALL SELECT datehour, 'n_stations', CAST(n_stations AS DOUBLE) FROM health)"""
DAY = "(PARTITION BY metric ORDER BY datehour RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)"

for _fn, _sql in (("avg", "avg(value)"), ("last", "last_value(value)"), ("median", "quantile_cont(value, 0.5)")):
    query(f"f19_{_fn}_over_time", f"WITH {METRICS} SELECT datehour, metric, value, {s6(f'{_sql} OVER {DAY}')} AS {_fn}_value FROM metrics")(
        lambda spark, sf, fn=_fn: rounded(alerts.over_time(metrics(spark, sf), fn, 24), f"{fn}_value")
    )


def sustained_sql(src: str, cond: str, keys: str, hold: int) -> str:
    """Firing where the last ``hold`` + 1 hours are all on."""
    part = f"PARTITION BY {keys} " if keys else ""
    w = f"({part}ORDER BY datehour ROWS BETWEEN {hold} PRECEDING AND CURRENT ROW)"
    return f"SELECT *, count(*) FILTER (WHERE {cond}) OVER {w} = {hold + 1} AS firing FROM {src}"


DENSE_HEALTH = HEALTH + """, axis AS (SELECT unnest(generate_series(min(datehour), max(datehour), INTERVAL 1 HOUR)) AS datehour FROM health),
dh AS (SELECT a.datehour, coalesce(n_rows, 0) AS n_rows, coalesce(n_stations, 0) AS n_stations FROM axis a LEFT JOIN health h ON a.datehour = h.datehour)"""


@query("f20_sustained", f"WITH {DENSE_HEALTH} {sustained_sql('dh', 'n_rows > n_stations', '', 2)}")
def _(spark, sf):
    d = alerts.dense_hours(health(spark, sf), {"n_rows": 0, "n_stations": 0})
    return alerts.sustained(d, F.col("n_rows") > F.col("n_stations"), 2)


@query("l01_duplicate_alert", f"WITH {HEALTH} SELECT *, n_rows - n_stations AS extra_rows FROM health WHERE n_rows > n_stations")
def _(spark, sf):
    return alerts.duplicate_alert(health(spark, sf))


@query("l02_station_drop_alert", f"""WITH {DENSE_HEALTH}, m AS (SELECT *, quantile_cont(n_stations, 0.5) OVER (ORDER BY datehour
ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS day_median FROM dh) {sustained_sql('m', 'day_median > n_stations + 1', '', 1)}""")
def _(spark, sf):
    return alerts.station_drop_alert(health(spark, sf), 1, 1)


@query("l03_shift_alert", f"""WITH {METRICS}, days AS (SELECT DISTINCT CAST(datehour AS DATE) AS d FROM metrics),
pairs AS (SELECT d.d, m.metric, m.value, CAST(m.datehour AS DATE) = d.d AS cur FROM days d JOIN metrics m ON CAST(m.datehour AS DATE) IN (d.d, CAST(d.d - INTERVAL 1 DAY AS DATE))),
sized AS (SELECT d, metric, value, cur, count(*) FILTER (WHERE cur) OVER (PARTITION BY d, metric) AS na, count(*) FILTER (WHERE NOT cur) OVER (PARTITION BY d, metric) AS nb FROM pairs),
cum AS (SELECT d, metric, value, count(*) FILTER (WHERE cur) OVER w / CAST(na AS DOUBLE) AS fa, count(*) FILTER (WHERE NOT cur) OVER w / CAST(nb AS DOUBLE) AS fb FROM sized WHERE na > 0 AND nb > 0 WINDOW w AS (PARTITION BY d, metric ORDER BY value)),
ks AS (SELECT d, metric, round(max(abs(fa - fb)), 6) AS ks FROM cum GROUP BY 1, 2),
h AS (SELECT CAST(d AS TIMESTAMP) + INTERVAL 1 HOUR * (date_diff('day', (SELECT min(d) FROM ks), d) - 24 * date_diff('day', (SELECT min(d) FROM ks), d)) AS datehour, {s6('avg(ks)')} AS avg_ks, max(ks) AS max_ks FROM ks GROUP BY 1)
{sustained_sql('h', 'avg_ks > 0.2 OR max_ks > 0.3', '', 2)}""")
def _(spark, sf):
    m = metrics(spark, sf).withColumn("d", F.to_date("datehour"))
    both = m.withColumn("cur", F.lit(1)).unionByName(m.withColumns({"d": F.date_add("d", 1), "cur": F.lit(0)}))
    counts = both.withColumn("metric", F.concat_ws("|", F.col("d").cast("string"), "metric")).groupBy("metric", "value").agg(
        F.sum("cur").alias("n_a"), F.sum(1 - F.col("cur")).alias("n_b")
    )
    ks = ranking.ks_of_counts(counts).filter("ks is not null").select(
        F.to_date(F.substring_index("metric", "|", 1)).alias("d"), F.substring_index("metric", "|", -1).alias("metric"), r6("ks").alias("ks")
    )
    first = ks.agg(F.min("d").alias("d")).scalar()
    hour = F.col("d").cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.date_diff("d", first) * 23)
    out = alerts.shift_alert(ks.withColumn("datehour", hour), 0.2, 0.3, 2)
    return rounded(out, "avg_ks")


@query("l03_shift_alert_stored", f"""WITH {METRICS}, axis AS (SELECT unnest(generate_series(min(datehour), max(datehour), INTERVAL 1 HOUR)) AS t FROM metrics),
pairs AS (SELECT t, metric, value, m.datehour > t - INTERVAL 24 HOUR AS cur FROM axis JOIN metrics m ON m.datehour <= t AND m.datehour > t - INTERVAL 48 HOUR),
sized AS (SELECT *, count(*) FILTER (WHERE cur) OVER (PARTITION BY t, metric) AS na, count(*) FILTER (WHERE NOT cur) OVER (PARTITION BY t, metric) AS nb FROM pairs),
cum AS (SELECT t, metric, count(*) FILTER (WHERE cur) OVER w / CAST(na AS DOUBLE) AS fa, count(*) FILTER (WHERE NOT cur) OVER w / CAST(nb AS DOUBLE) AS fb FROM sized WHERE na > 0 AND nb > 0 WINDOW w AS (PARTITION BY t, metric ORDER BY value)),
ks AS (SELECT t, metric, max(abs(fa - fb)) AS ks FROM cum GROUP BY 1, 2),
seen AS (SELECT t AS datehour, avg(ks) AS avg_ks, max(ks) AS max_ks FROM ks GROUP BY 1),
h AS (SELECT a.t AS datehour, avg_ks, max_ks FROM axis a LEFT JOIN seen s ON a.t = s.datehour WHERE a.t >= (SELECT min(datehour) FROM seen))
SELECT datehour, {s6('avg_ks')} AS avg_ks, {s6('max_ks')} AS max_ks, firing FROM ({sustained_sql('h', 'avg_ks > 0.2 OR max_ks > 0.3', '', 2)})""")
def _(spark, sf):
    """Alert over the statistics of hourly refreshes, stored and read back as the jobs keep them."""
    path = scratch_path(spark, "stats")
    tables.write_stats_history(drift.drift_history(metrics(spark, sf)), path)
    kept = tables.stats_history(spark, path).filter("category = 'kstest'").select("datehour", "metric", F.col("value").alias("ks"))
    return rounded(alerts.shift_alert(kept, 0.2, 0.3, 2), "avg_ks", "max_ks")


@query("l04_stale_alert", f"WITH {DENSE_HEALTH} SELECT datehour FROM dh WHERE n_rows = 0")
def _(spark, sf):
    return alerts.stale_alert(health(spark, sf))


@query("l04_stale_alert_purchases", """WITH seen AS (SELECT DISTINCT date_trunc('hour', ts) AS datehour FROM events WHERE event_type = 'purchase'),
axis AS (SELECT unnest(generate_series(min(datehour), max(datehour), INTERVAL 1 HOUR)) AS datehour FROM seen)
SELECT datehour FROM axis WHERE datehour NOT IN (SELECT datehour FROM seen)""")
def _(spark, sf):
    """Hours without any purchase, the rarer of the reports, where the whole log has none."""
    bought = table(spark, sf, "events").filter("event_type = 'purchase'").select(F.col("user_id").cast("string").alias("station"), F.col("ts").alias("dt"))
    return alerts.stale_alert(rep.hourly_health(bought))


@query("l05_uptime", f"""WITH {DENSE_HEALTH} SELECT datehour, {s6('avg(CASE WHEN n_rows > 0 THEN 100.0 ELSE 0.0 END) OVER (ORDER BY datehour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)')} AS uptime FROM dh""")
def _(spark, sf):
    return rounded(alerts.uptime(health(spark, sf)), "uptime")
