"""Joins of requests, lags, scaling, encoding and hold-out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from dockflow.operators import dedup, features, lags, scores
from dockflow.operators import models as model_ops
from dockflow.operators import reports as report_ops
from dockflow.operators import weather as wx_ops
from dockflow.operators.lookup import load_by_station, save_by_station
from dockflow.operators.ranking import margins
from dockflow.plans import jobs
from dockflow.registry.base import (
    FLOW, HOURLY, MARGINS, SCORED, STATUS, WEATHER, flow, query, rounded, s4, s6, scored, status, table,
)
from dockflow.registry.cleaning import HOURLY_FORECAST, WX_COLS, forecast
from dockflow.session import scratch_path

# Requests: every flow hour, and the same hours five days later, which reach past the newest one.
REQUEST = FLOW + """, req AS (
  SELECT station, datehour FROM flow UNION SELECT station, datehour + INTERVAL 5 DAY FROM flow)"""


def requests(spark, sf) -> DataFrame:
    """Every station-hour of the flow and those up to five days after the newest one."""
    known = flow(spark, sf).select("station", "datehour")
    return known.unionByName(known.withColumn("datehour", F.col("datehour") + F.expr("interval 5 days"))).distinct()


def flow_by_station(spark, sf) -> DataFrame:
    """The flow in the layout that lookups by station and day prune."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LAID_OUT:
        _LAID_OUT[key] = scratch_path(spark, "flow-by-station")
        save_by_station(flow(spark, sf), _LAID_OUT[key], 4)
    return load_by_station(spark, _LAID_OUT[key])


_LAID_OUT: dict[tuple[str, str], str] = {}


@query("d05_join_station", f"""WITH {HOURLY}, r AS (SELECT CAST(c_custkey AS VARCHAR) AS station, c_name FROM customer)
SELECT r.station, c_name, lat, lon, capacity FROM r LEFT JOIN dim ON r.station = dim.station""")
def _(spark, sf):
    req = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("station"), "c_name")
    dim = dedup.station_dim(dedup.fix_capacity(status(spark, sf)))
    return jobs.join_station(req, dim.withColumn("capacity", F.col("capacity").cast("double")))


@query("d06_join_weather_past", f"""WITH {REQUEST} SELECT r.station, r.datehour, temp, precip, gel, vent FROM req r
JOIN flow f ON r.station = f.station AND r.datehour = f.datehour""")
def _(spark, sf):
    return wx_ops.join_weather_past(requests(spark, sf), flow_by_station(spark, sf))


def shifted_forecast(spark, sf) -> DataFrame:
    """The hourly forecast, moved so that it covers the hours after the flow."""
    hourly = wx_ops.hourly_forecast(forecast(spark, sf))
    return hourly.withColumn("datehour", F.col("datehour") + F.expr("interval 28 days"))


FUTURE = HOURLY_FORECAST[len(WEATHER) + 2:] + """, later AS (SELECT datehour + INTERVAL 28 DAY AS datehour, temp, precip, gel, vent FROM fc_hour)"""


@query("d07_join_weather_future", f"""WITH {REQUEST}, {FUTURE}
SELECT r.station, r.datehour, {WX_COLS} FROM req r LEFT JOIN later w ON r.datehour = w.datehour""")
def _(spark, sf):
    out = wx_ops.join_weather_future(requests(spark, sf), shifted_forecast(spark, sf))
    return rounded(out, "temp", "precip", "gel", "vent")


@query("d08_join_weather_auto", f"""WITH {REQUEST}, {FUTURE}
SELECT station, datehour, {WX_COLS} FROM (
  SELECT r.station, r.datehour, temp, precip, gel, vent FROM req r JOIN flow f ON r.station = f.station AND r.datehour = f.datehour
  UNION ALL
  SELECT r.station, r.datehour, temp, precip, gel, vent FROM req r LEFT JOIN later w ON r.datehour = w.datehour
  WHERE r.datehour > (SELECT max(datehour) FROM flow))""")
def _(spark, sf):
    out = wx_ops.join_weather_auto(requests(spark, sf), flow_by_station(spark, sf), shifted_forecast(spark, sf))
    return rounded(out, "temp", "precip", "gel", "vent")


# --- peaks ---

PEAKS = FLOW + """, peaks AS (
  SELECT * FROM (
    SELECT station, date, CASE WHEN count(*) FILTER (WHERE hour BETWEEN 5 AND 11) = 7 THEN sum(delta) FILTER (WHERE hour BETWEEN 5 AND 11) END AS morning_peak,
           CASE WHEN count(*) FILTER (WHERE hour BETWEEN 15 AND 21) = 7 THEN sum(delta) FILTER (WHERE hour BETWEEN 15 AND 21) END AS evening_peak,
           arg_min(lat, datehour) AS lat, arg_min(lon, datehour) AS lon
    FROM flow GROUP BY 1, 2) WHERE morning_peak IS NOT NULL AND evening_peak IS NOT NULL)"""


@query("e09_day_peaks", f"WITH {PEAKS} SELECT station, date, {s6('morning_peak')} AS morning_peak, {s6('evening_peak')} AS evening_peak, lat, lon FROM peaks")
def _(spark, sf):
    return rounded(lags.day_peaks(flow(spark, sf)), "morning_peak", "evening_peak")


@query("e10_station_peaks", f"""WITH {PEAKS} SELECT station, {s4('avg(morning_peak)')} AS morning_peak, {s4('avg(evening_peak)')} AS evening_peak,
arg_min(lat, date) AS lat, arg_min(lon, date) AS lon FROM peaks GROUP BY 1""")
def _(spark, sf):
    return rounded(lags.station_peaks(flow(spark, sf)), "morning_peak", "evening_peak", places=4)


def peak_means_sql(src: str, rows: int, minimum: int) -> str:
    return f""", pm AS (
  SELECT station, date, mean_6_12, mean_16_22 FROM (
    SELECT station, date, avg(morning_peak) OVER w AS mean_6_12, avg(evening_peak) OVER w AS mean_16_22, count(*) OVER w AS seen
    FROM {src} WINDOW w AS (PARTITION BY station, isodow(date) ORDER BY date ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING))
  WHERE seen >= {minimum})"""


# Long daily history: one station per customer nation, seven years of order days.
ORDER_DAYS = """od AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS station, CAST(o_orderdate AS DATE) AS date,
         CAST(count(*) AS DOUBLE) AS morning_peak, CAST(count(DISTINCT o_orderpriority) AS DOUBLE) AS evening_peak
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def order_days(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return o.groupBy(F.col("c_nationkey").cast("string").alias("station"), F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).cast("double").alias("morning_peak"),
        F.count_distinct("o_orderpriority").cast("double").alias("evening_peak"),
    )


PM_COLS = f"station, date, {s4('mean_6_12')} AS mean_6_12, {s4('mean_16_22')} AS mean_16_22"


@query("f12_peak_means", f"WITH {ORDER_DAYS} {peak_means_sql('od', 8, 4)} SELECT {PM_COLS} FROM pm")
def _(spark, sf):
    return rounded(lags.peak_means(order_days(spark, sf)), "mean_6_12", "mean_16_22", places=4)


@query("d10_join_peaks", f"""WITH {PEAKS} {peak_means_sql('peaks', 8, 4)}
SELECT f.station, f.datehour, f.date, {s4('mean_6_12')} AS mean_6_12, {s4('mean_16_22')} AS mean_16_22
FROM flow f LEFT JOIN pm ON f.station = pm.station AND f.date = pm.date""")
def _(spark, sf):
    f = flow(spark, sf)
    out = lags.join_peaks(f.select("station", "datehour", "date"), lags.peak_means(lags.day_peaks(f)))
    return rounded(out, "mean_6_12", "mean_16_22", places=4)


# --- smoothing and lags ---

def smooth_sql(name: str, hours: int) -> str:
    low, high = (hours + 1) // 2 - 1, hours // 2
    return f"""WITH {FLOW} SELECT station, datehour, {s4(f'''avg(delta) OVER (PARTITION BY station ORDER BY datehour
RANGE BETWEEN INTERVAL {low} HOUR PRECEDING AND INTERVAL {high} HOUR FOLLOWING)''')} AS delta FROM flow"""


@query("f10_smooth_3h", smooth_sql("f10", 3))
def _(spark, sf):
    return rounded(lags.smooth(flow(spark, sf).select("station", "datehour", "delta"), 3), "delta", places=4)


@query("f10_smooth_4h", smooth_sql("f10", 4))
def _(spark, sf):
    return rounded(lags.smooth(flow(spark, sf).select("station", "datehour", "delta"), 4), "delta", places=4)


SEASON = """avg({c}) OVER (PARTITION BY station, weekday, hour ORDER BY datehour ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)"""
SEEN = """count({c}) OVER (PARTITION BY station, weekday, hour ORDER BY datehour ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)"""


@query("f11_seasonal_mean", f"""WITH {FLOW} SELECT station, datehour,
{s4(f"CASE WHEN {SEEN.format(c='delta')} >= 3 THEN {SEASON.format(c='delta')} END")} AS mean_value FROM flow""")
def _(spark, sf):
    return rounded(lags.seasonal_mean(flow(spark, sf)), "mean_value", places=4).select("station", "datehour", "mean_value")


HISTORY = PEAKS + peak_means_sql("peaks", 8, 4) + f""", hist AS (
  SELECT f.datehour, f.station, weekday, hour, greatest(holiday, pont) AS dayoff, delta AS lagged_value,
         avg(delta) OVER (PARTITION BY f.station ORDER BY datehour RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR FOLLOWING) AS lagged_value_3hours_mean,
         CASE WHEN {SEEN.replace('station', 'f.station').format(c='delta')} >= 3 THEN {SEASON.replace('station', 'f.station').format(c='delta')} END AS mean_value,
         mean_6_12, mean_16_22
  FROM flow f LEFT JOIN pm ON f.station = pm.station AND f.date = pm.date)"""


def history(spark, sf) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf + "#history")
    if key not in _LAID_OUT:
        _LAID_OUT[key] = scratch_path(spark, "history")
        save_by_station(lags.lag_history(flow(spark, sf)), _LAID_OUT[key], 4)
    return load_by_station(spark, _LAID_OUT[key])


def lag_requests(spark, sf) -> DataFrame:
    """Every flow hour and the same hours two weeks later."""
    known = flow(spark, sf).select("station", "datehour", "weekday", "hour", "holiday", "pont")
    return known.unionByName(known.withColumn("datehour", F.col("datehour") + F.expr("interval 14 days")))


LAG_REQ = HISTORY + """, lreq AS (
  SELECT station, datehour, weekday, hour, holiday, pont FROM flow
  UNION ALL
  SELECT station, datehour + INTERVAL 14 DAY, weekday, hour, holiday, pont FROM flow)"""


def carried_sql(cols: list[str], leak_free: bool) -> str:
    """Carried lags by an as-of lookup per column, independent of stacking and windows."""
    parts, select = [], []
    for n, c in enumerate(cols):
        keys = ["station", "weekday"] if c.startswith("mean_6") or c.startswith("mean_16") else ["station", "weekday", "dayoff", "hour"]
        own = not leak_free or c.startswith("mean_")
        on = " AND ".join(f"r.{k} = h.{k}" for k in keys)
        # peak means are repeated over the hours of a day: one row per hour keeps the lookup unique
        src = f"(SELECT {', '.join(keys)}, datehour, {c} FROM hist WHERE {c} IS NOT NULL)"
        parts.append(f"ASOF LEFT JOIN {src} h{n} ON {on.replace('h.', f'h{n}.')} AND r.datehour {'>=' if own else '>'} h{n}.datehour")
        value = f"h{n}.{c}"
        if not leak_free:
            parts.append(f"LEFT JOIN (SELECT {', '.join(keys)}, arg_min({c}, datehour) AS {c} FROM hist WHERE {c} IS NOT NULL GROUP BY {', '.join(keys)}) b{n} ON {on.replace('h.', f'b{n}.')}")
            value = f"coalesce(h{n}.{c}, b{n}.{c})"
        select.append(f"{s4(value)} AS {c}")
    return f"""WITH {LAG_REQ}, r AS (SELECT *, greatest(holiday, pont) AS dayoff FROM lreq)
SELECT r.station, r.datehour, {', '.join(select)} FROM r {' '.join(parts)}"""


def carried(columns: list[str], leak_free: bool = True):
    def run(spark, sf):
        out = lags.join_lags(lag_requests(spark, sf), history(spark, sf), columns, leak_free)
        return rounded(out.select("station", "datehour", *columns), *columns, places=4)
    return run


query("f13_last_similar", carried_sql(["lagged_value"], True))(carried(["lagged_value"]))
query("f14_last_similar_3h", carried_sql(["lagged_value_3hours_mean"], True))(carried(["lagged_value_3hours_mean"]))
query("f15_carry_means", carried_sql(["mean_value", *lags.PEAK_MEANS], True))(carried(["mean_value", *lags.PEAK_MEANS]))
query("d11_join_lags", carried_sql(lags.LAG_COLUMNS, True))(carried(lags.LAG_COLUMNS))
query("d11_join_lags_known_history", carried_sql(lags.LAG_COLUMNS, False))(carried(lags.LAG_COLUMNS, False))


def lag_lead_sql(hours: int) -> str:
    cols = ["delta AS delta_0"] + [
        f"lag(delta, {h}) OVER w AS lag_{h}, lead(delta, {h}) OVER w AS delta_{h}" for h in range(1, hours + 1)
    ]
    return f"""WITH {FLOW} SELECT * FROM (SELECT station, datehour, delta, {', '.join(cols)} FROM flow
WINDOW w AS (PARTITION BY station ORDER BY datehour)) WHERE lag_{hours} IS NOT NULL AND delta_{hours} IS NOT NULL"""


@query("f16_lag_lead", lag_lead_sql(12))
def _(spark, sf):
    return lags.lag_lead(flow(spark, sf).select("station", "datehour", "delta"), 12)


@query("d14_request_grid", f"""WITH {FLOW} SELECT s.station, h.datehour FROM (SELECT DISTINCT station FROM flow) s
CROSS JOIN (SELECT DISTINCT datehour + INTERVAL 7 DAY AS datehour FROM flow) h""")
def _(spark, sf):
    f = flow(spark, sf)
    hours = f.select((F.col("datehour") + F.expr("interval 7 days")).alias("datehour"))
    return jobs.request_grid(f.select("station"), hours)


@query("d15_name_predictions", f"""WITH {SCORED} SELECT station, datehour, delta_pred AS prediction, name FROM scored""")
def _(spark, sf):
    pred = scored(spark, sf).select("station", "datehour", F.col("delta_pred").alias("prediction"))
    return report_ops.name_predictions(pred, dedup.station_dim(status(spark, sf)))


# --- scaling, encoding, weights, hold-out ---

@query("j01_minmax", f"""WITH {FLOW}, b AS (SELECT min(temp) AS tl, max(temp) AS th, min(bikes) AS bl, max(bikes) AS bh FROM flow WHERE date < DATE '2024-01-21')
SELECT station, datehour, {s6('(temp - tl) / (th - tl)')} AS temp, {s6('(bikes - bl) / (bh - bl)')} AS bikes, CAST(0 AS DOUBLE) AS constant FROM flow, b""")
def _(spark, sf):
    f = flow(spark, sf).select("station", "datehour", "date", "temp", "bikes", F.lit(5).alias("constant"))
    cols = ["temp", "bikes", "constant"]
    bounds = features.minmax_fit(f.filter("date < date'2024-01-21'"), cols)
    return rounded(features.minmax_apply(f, bounds, cols), "temp", "bikes").drop("date")


ONEHOT_TYPES = ["click", "error", "purchase", "signup"]


@query("j02_onehot", "SELECT event_id, " + ", ".join(
    f"CAST(event_type = '{t}' AS DOUBLE) AS event_type_{t}" for t in ONEHOT_TYPES) + " FROM events")
def _(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type")
    vocabulary = features.onehot_fit(ev.filter("event_type <> 'view'"), ["event_type"])
    return features.onehot_apply(ev, vocabulary).drop("event_type")


@query("j02_onehot_vectors", """SELECT event_id, CAST(user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase') AS INTEGER) AS n_set,
CAST((SELECT count(DISTINCT user_id) FROM events WHERE event_type = 'purchase') AS INTEGER) AS width,
CASE WHEN user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase')
THEN (SELECT CAST(count(DISTINCT user_id) AS INTEGER) FROM events b WHERE event_type = 'purchase' AND b.user_id < e.user_id) END AS place FROM events e""")
def _(spark, sf):
    """Sparse vectors of a dictionary of all users with a purchase, shown by width and place of the one entry."""
    ev = table(spark, sf, "events")
    out = features.onehot_vectors(ev.select("event_id", "user_id"), {"user_id": features.index_fit(ev.filter("event_type = 'purchase'"), "user_id")})
    v = unwrap_udt("user_id_onehot")
    return out.select("event_id", F.size(v["indices"]).alias("n_set"), v["size"].alias("width"), F.get(v["indices"], F.lit(0)).alias("place"))


@query("j03_geo_features", f"""WITH {HOURLY}, m AS (SELECT station, (lat - (SELECT min(lat) FROM dim)) * 111000 AS y, (lon - (SELECT min(lon) FROM dim)) * 72987 AS x FROM dim)
SELECT station, {s6('(y - (SELECT min(y) FROM m)) / (SELECT max(y) - min(y) FROM m)')} AS lat, {s6('(x - (SELECT min(x) FROM m)) / (SELECT max(x) - min(x) FROM m)')} AS lon FROM m""")
def _(spark, sf):
    return rounded(features.geo_features(dedup.station_dim(status(spark, sf)).select("station", "lat", "lon")), "lat", "lon")


@query("j04_category_index", f"""WITH {STATUS}, known AS (SELECT station, CAST(row_number() OVER (ORDER BY station) - 1 AS INTEGER) AS i
FROM (SELECT DISTINCT station FROM status WHERE dt < TIMESTAMP '2024-01-04'))
SELECT s.status_id, s.station, coalesce(i, -1) AS station_index FROM status s LEFT JOIN known k ON s.station = k.station""")
def _(spark, sf):
    s = status(spark, sf)
    dictionary = features.index_fit(s.filter("dt < timestamp_ntz'2024-01-04'"), "station")
    return features.index_apply(s.select("status_id", "station"), dictionary, "station")


WEIGHTED = SCORED + MARGINS.format(col="delta", src="flow") + """, weighted AS (
  SELECT s.*, CASE WHEN delta > high THEN 3.0 WHEN delta < low THEN 2.0 ELSE 1.0 END AS weight FROM scored s, edge)"""


def flow_margins(spark, sf):
    edge = margins(flow(spark, sf)).select(F.struct("low", "high").alias("edge")).scalar()
    return edge.getField("low"), edge.getField("high")


def weighted(spark, sf) -> DataFrame:
    low, high = flow_margins(spark, sf)
    return features.rush_weights(scored(spark, sf), low, high, 2.0, 3.0)


@query("j08_rush_weights", f"WITH {WEIGHTED} SELECT station, datehour, delta, CAST(weight AS DOUBLE) AS weight FROM weighted")
def _(spark, sf):
    return weighted(spark, sf).select("station", "datehour", "delta", "weight")


@query("j09_weighted_losses", f"""WITH {WEIGHTED}, e AS (SELECT CAST(weight AS DOUBLE) AS w, delta_test - delta_pred AS e FROM weighted)
SELECT {s6('avg(w * abs(e))')} AS wmae, {s6('avg(w * e * e)')} AS wmse, {s6('avg(abs(e))')} AS mae, {s6('avg(e * e)')} AS mse FROM e""")
def _(spark, sf):
    return rounded(scores.weighted_losses(weighted(spark, sf)), "wmae", "wmse", "mae", "mse")


@query("j10_tail_split", f"""WITH {FLOW}, t AS (SELECT datehour, count(*) AS n FROM flow GROUP BY 1),
c AS (SELECT datehour, sum(n) OVER (ORDER BY datehour DESC) AS tail FROM t),
b AS (SELECT min(datehour) AS boundary FROM c WHERE tail <= (SELECT count(*) FROM flow) * CAST(0.3 AS DOUBLE))
SELECT station, datehour, CASE WHEN datehour >= boundary THEN 'tail' ELSE 'head' END AS part FROM flow, b""")
def _(spark, sf):
    parts = features.tail_split(flow(spark, sf).select("station", "datehour"), 0.3)
    head, tail = (p.withColumn("part", F.lit(n)) for p, n in zip(parts, ("head", "tail")))
    return head.unionByName(tail)


@query("j13_param_grid", """WITH g AS (SELECT o_orderpriority AS experiment, o_orderstatus AS wl, CAST(year(o_orderdate) AS VARCHAR) AS batch FROM orders)
SELECT DISTINCT a.experiment, a.wl, CASE WHEN b.wh = '@wl' THEN a.wl ELSE '1' END AS wh, c.batch
FROM (SELECT DISTINCT experiment, wl FROM g) a JOIN (SELECT DISTINCT experiment, batch FROM g) c ON a.experiment = c.experiment
CROSS JOIN (SELECT unnest(['@wl', '1']) AS wh) b""")
def _(spark, sf):
    return param_grid(spark, sf)


def param_grid(spark, sf) -> DataFrame:
    """Candidate arrays per experiment, of columns with a handful of values each."""
    spec = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("experiment")).agg(
        F.collect_set("o_orderstatus").alias("wl"),
        F.array(F.lit("@wl"), F.lit("1")).alias("wh"),
        F.collect_set(F.year("o_orderdate").cast("string")).alias("batch"),
    )
    return model_ops.param_grid(spec, ["wl", "wh", "batch"])


@query("j14_pending_grid", """WITH g AS (SELECT o_orderpriority AS experiment, o_orderstatus AS wl, CAST(year(o_orderdate) AS VARCHAR) AS batch, o_totalprice AS p FROM orders),
grid AS (SELECT DISTINCT a.experiment, a.wl, CASE WHEN b.wh = '@wl' THEN a.wl ELSE '1' END AS wh, c.batch
FROM (SELECT DISTINCT experiment, wl FROM g) a JOIN (SELECT DISTINCT experiment, batch FROM g) c ON a.experiment = c.experiment
CROSS JOIN (SELECT unnest(['@wl', '1']) AS wh) b)
SELECT * FROM grid WHERE (experiment, wl, batch) NOT IN (SELECT experiment, wl, batch FROM g GROUP BY 1, 2, 3 HAVING avg(p) > 250000)""")
def _(spark, sf):
    done = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("experiment"), F.col("o_orderstatus").alias("wl"),
        F.year("o_orderdate").cast("string").alias("batch"),
    ).agg(F.avg("o_totalprice").alias("p")).filter("p > 250000").select("experiment", "wl", "batch")
    return model_ops.pending_grid(param_grid(spark, sf), done)


@query("j15_rebalance")
def _(spark, sf):
    low, high = flow_margins(spark, sf)
    rush = scores.is_peak(low, high, "delta")
    return features.rebalance(flow(spark, sf), rush, ["station", "datehour"], 3.0, 2).select("station", "datehour", "delta", "copy")


@query("j15_rebalance_rush", f"""WITH {FLOW} {MARGINS.format(col='delta', src='flow')} SELECT station, datehour, delta, CAST(unnest([1, 2]) AS INTEGER) AS copy FROM flow, edge WHERE delta < low OR delta > high""")
def _(spark, sf):
    """The rush rows of the rebalanced flow, each of them twice."""
    low, high = flow_margins(spark, sf)
    rush = scores.is_peak(low, high, "delta")
    return features.rebalance(flow(spark, sf), rush, ["station", "datehour"], 3.0, 2).filter(rush).select("station", "datehour", "delta", "copy")


@query("j16_day_matrix", f"""WITH {FLOW} SELECT station, date, list([delta, temp] ORDER BY hour) AS matrix FROM flow GROUP BY 1, 2 HAVING count(*) = 24""")
def _(spark, sf):
    return lags.day_matrix(flow(spark, sf), ["delta", "temp"])
