import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from dockflow.operators import weather as ops
from dockflow.sources import calendars, status, tables, weather
from tests.helpers import START, hours, same

WX = "datehour timestamp_ntz, temp double, precip double, gel double, vent double"


def test_observation_file(spark, tmp_path):
    (tmp_path / "obs.csv").write_text("POSTE;DATE;RR1;FF;T;DG;QX\n1;2024010100;0,2;3,5;-1,5;30;9\n1;2024010101;;;2;;\n")
    rows = weather.read_weather_obs(spark, str(tmp_path / "obs.csv")).orderBy("datehour").collect()
    assert tuple(rows[0]) == (START, -1.5, 0.2, 30.0, 3.5)
    assert tuple(rows[1]) == (START + dt.timedelta(hours=1), 2.0, None, None, None)


def test_completion_matches_pandas(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"datehour": hours(200), **{c: rng.normal(size=200) for c in ("temp", "precip", "gel", "vent")}})
    for c in ("temp", "precip", "gel", "vent"):
        pdf.loc[rng.random(200) < 0.5, c] = np.nan
    pdf = pdf[rng.random(200) < 0.8]
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in (r[0].to_pydatetime(), *r[1:])) for r in pdf.itertuples(index=False)]
    want = pdf.set_index("datehour").resample("h").asfreq()
    want[["precip", "gel"]] = want[["precip", "gel"]].fillna(0)
    want = want.interpolate()
    got = ops.complete_weather(spark.createDataFrame(rows, WX)).orderBy("datehour").toPandas()
    for c in ("temp", "precip", "gel", "vent"):
        same(got[c], want[c])


def test_forecast_payload_and_hours(spark):
    payload = (
        '{"list":[{"dt":1704078000,"main":{"temp":-1.0},"rain":{"3h":3.0},"wind":{"speed":2.0}},'
        '{"dt":1704088800,"main":{"temp":2.0},"snow":{"3h":1.5}}]}'
    )
    fc = weather.parse_forecast(spark.createDataFrame([("a", payload)], "station string, payload string"))
    rows = fc.orderBy("datehour").collect()
    assert [(r.temp, r.precip, r.gel, r.vent) for r in rows] == [(-1.0, 3.0, 20.0, 2.0), (2.0, 1.5, 0.0, 0.0)]
    out = ops.hourly_forecast(fc).orderBy("datehour").collect()
    assert [r.datehour.hour for r in out] == [1, 2, 3, 4, 5, 6, 7]
    assert [round(r.precip, 6) for r in out] == [0, 1, 1, 1, 0.5, 0.5, 0.75]
    assert [round(r.temp, 6) for r in out] == [-1, -1, -1, 0, 1, 2, 2]


def test_past_future_and_both(spark):
    flow = spark.createDataFrame([("a", h, float(i), 0.0, 0.0, 0.0) for i, h in enumerate(hours(5))], "station string, " + WX)
    fc = spark.createDataFrame([(START + dt.timedelta(hours=i), 100.0 + i, 0.0, 0.0, 0.0) for i in range(3, 7)], WX)
    req = spark.createDataFrame([("a", START + dt.timedelta(hours=i)) for i in range(3, 9)] + [("b", START)], "station string, datehour timestamp_ntz")
    got = {r.datehour.hour: r.temp for r in ops.join_weather_auto(req, flow, fc).collect()}
    assert got == {3: 3.0, 4: 4.0, 5: 105.0, 6: 106.0, 7: None, 8: None}


def test_status_payload_edges(spark):
    payload = (
        '{"data":{"stations":[{"station_id":"1","num_bikes_available":3,"num_bikes_available_types":[{"ebike":1},{"mechanical":2},{"mechanical":9}],"last_reported":1704067200},'
        '{"station_id":"2","num_bikes_available_types":[]},{"station_id":"3","num_bikes_available_types":null}]}}'
    )
    df = spark.createDataFrame([(payload, START)], "payload string, poll_dt timestamp_ntz")
    rows = {r.station: r for r in status.parse_status(df).collect()}
    assert (rows["1"].mechanical, rows["1"].ebike, rows["1"].bikes, rows["1"].dt) == (2, 1, 3, START)
    assert rows["2"].mechanical is None and rows["3"].ebike is None and rows["2"].dt is None


def test_time_window_is_open_and_cut_to_the_hour(spark):
    df = spark.createDataFrame([(h,) for h in hours(5)], "dt timestamp_ntz")
    kept = df.filter(status.time_window(F.col("dt"), dt.datetime(2024, 1, 1, 1, 40), dt.datetime(2024, 1, 1, 4, 20))).collect()
    assert [r.dt.hour for r in kept] == [2, 3]


def test_calendar_files(spark, tmp_path):
    (tmp_path / "h.csv").write_text("﻿date;férié;année\n2028-04-17;Lundi;2028\n2028-04-17;Lundi;2028\n", encoding="utf-8")
    assert [r.date for r in calendars.read_holidays(spark, str(tmp_path / "h.csv")).collect()] == [dt.date(2028, 4, 17)]
    (tmp_path / "b.csv").write_text(
        "Académies;Date de début;Date de fin\nParis;2024-02-10T23:00:00+00:00;2024-02-25\nLyon;2024-02-10;2024-02-25\nParis;2023-02-10;2023-02-25\n",
        encoding="utf-8",
    )
    rows = calendars.read_breaks(spark, str(tmp_path / "b.csv"), "Paris").collect()
    assert [tuple(r) for r in rows] == [(dt.date(2024, 2, 10), dt.date(2024, 2, 25))]


def test_log_is_appended_by_day(spark, tmp_path):
    df = spark.createDataFrame([("a", START), ("b", START + dt.timedelta(days=1))], "station string, dt timestamp_ntz")
    path = str(tmp_path / "log")
    tables.append_status(df, path)
    tables.append_status(df, path)
    back = tables.load_table(spark, path)
    assert back.count() == 4 and back.filter("day = date'2024-01-02'").count() == 2
