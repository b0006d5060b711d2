"""The flow kept batch by batch equals the flow built from the whole log, and a batch touches a bounded part of the tables."""

import datetime as dt
import random

from dockflow.plans.flow import build_station_flow
from dockflow.plans.incremental import FlowStore
from dockflow.registry import base
from dockflow.sources.tables import folders, published_numbers

SCHEMA = "status_id bigint, station string, bikes int, capacity int, lat double, lon double, name string, dt timestamp_ntz"
START = dt.datetime(2024, 1, 1)
KEY = ["station", "datehour", "name", "capacity", "lat", "reconstructed", "round(bikes, 6)", "round(delta, 6)"]


def same_flow(spark, store, rows):
    cal = base.calendars(spark)
    got = store.station_flow(cal.holidays, cal.breaks, cal.uni_breaks).selectExpr(*KEY)
    want = build_station_flow(spark.createDataFrame(rows, SCHEMA).repartition(4), cal.holidays, cal.breaks, cal.uni_breaks).selectExpr(*KEY)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def reports(rng, first_day, days, number):
    """Reports of nine stations: one appears on day 20, one is silent for two weeks, one nearly so for good; every eleventh day is almost empty."""
    rows = []
    for h in range(first_day * 24, (first_day + days) * 24):
        for k in range(9):
            if (k == 8 and h < 24 * 20) or (k == 7 and 24 * 14 < h < 24 * 28) or (k == 6 and h > 72 and rng.random() < 0.97):
                continue
            if rng.random() < (0.05 if h // 24 % 11 == 5 else (0.95, 0.7)[k % 2]):
                number += 1
                stock = rng.choice([None, *range(30)])
                rows.append((number, f"s{k}", stock, 30, 48.0 + k, 2.0, f"n{k}-{h // 100}" if rng.random() < 0.98 else None, START + dt.timedelta(hours=h, minutes=rng.randrange(60))))
    return rows


def test_batches_equal_the_whole(spark, tmp_path):
    rng, store, sent, day = random.Random(5), FlowStore(spark, str(tmp_path), buckets=2), [], 0
    for k, span in enumerate([13, 2, 14, 3]):
        rows = reports(rng, day, span, len(sent) + 100_000 * k)
        late = [(900_000 + 10 * k + i, *r[1:2], rng.randrange(30), *r[3:7], r[7] - dt.timedelta(minutes=rng.randrange(3000))) for i, r in enumerate(rng.sample(sent, 5))] if k % 2 else []
        store.merge(spark.createDataFrame(rows + late, SCHEMA).repartition(4), k)
        sent += rows + late
        day += span
        if k > 1:
            same_flow(spark, store, sent)


def test_one_day_touches_few_partitions(spark, tmp_path):
    store, opened = FlowStore(spark, str(tmp_path), buckets=2), []
    hour = lambda h, k: (h * 4 + k, f"s{k}", (h * 7 + k * 3) % 20, 30, 48.0, 2.0, f"n{k}", START + dt.timedelta(hours=h))
    history = [hour(h, k) for h in range(24 * 40) for k in range(4)]
    store.merge(spark.createDataFrame(history, SCHEMA).repartition(4), 0)
    earlier = store.station_flow(*(lambda c: (c.holidays, c.breaks, c.uni_breaks))(base.calendars(spark)))
    n_earlier = 24 * 39 * 4  # the first day, whose first hours have no delta, counts as an outlier
    read = store.read
    store.read = lambda table, state, wanted=lambda b, d: True: opened.extend((table, b, d) for (t, b, d) in (state.parts if state else ()) if t == table and wanted(b, d)) or read(table, state, wanted)
    for k in range(2):
        opened.clear()
        day = [hour(h, j) for h in range(24 * (40 + k), 24 * (41 + k)) for j in range(4)]
        store.merge(spark.createDataFrame(day, SCHEMA), k + 1)
        newest = max(n for n in published_numbers(spark, f"{tmp_path}/manifest"))
        state = store.state()
        written = {(t, b, d) for (t, b, d), p in state.parts.items() if p[0] == state.stations}
        since = (START + dt.timedelta(days=40 + k - 30)).date()
        assert {d for _, _, d in opened} and min(d for _, _, d in opened) > since, "four weeks back at most"
        assert min(d for _, _, d in written) >= (START + dt.timedelta(days=40 + k - 4)).date() and len(written) <= 2 * 2 * 5
        if k == 0:
            assert earlier.count() == n_earlier, "a reader of the version before is unharmed"
    assert newest == 2 and published_numbers(spark, f"{tmp_path}/manifest") == [1, 2]
    named = {p[0] for p in store.state().parts.values()}
    for table in ("hourly", "rebuilt"):
        assert len(folders(spark, f"{tmp_path}/{table}")) <= len(named) + 1
    assert len(folders(spark, f"{tmp_path}/stations")) == 2
    same_flow(spark, store, history + [hour(h, j) for h in range(24 * 40, 24 * 42) for j in range(4)])


def test_reports_without_a_complete_hour(spark, tmp_path):
    store = FlowStore(spark, str(tmp_path), buckets=2)
    store.merge(spark.createDataFrame([], SCHEMA))
    assert store.state() is None
    cal = base.calendars(spark)
    rows = [(1, "a", None, 30, 48.0, 2.0, "n", START), (2, None, 3, 30, 48.0, 2.0, "n", START), (3, "a", 3, 30, 48.0, 2.0, "n", None)]
    store.merge(spark.createDataFrame(rows, SCHEMA))
    assert store.station_flow(cal.holidays, cal.breaks, cal.uni_breaks).count() == 0
    more = [(10 + h, "a", h % 5, 30, 48.0, 2.0, "n", START + dt.timedelta(hours=h)) for h in range(1, 80)]
    store.merge(spark.createDataFrame(more, SCHEMA))
    same_flow(spark, store, rows + more)
