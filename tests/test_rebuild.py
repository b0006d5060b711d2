import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockflow.operators import rebuild
from dockflow.operators.grid import add_delta
from tests.helpers import START, grid_frame, hours, interp, same, to_spark

SCHEMA = "station string, datehour timestamp_ntz, bikes double"


def frame(spark, seed=0, **kw):
    pdf = grid_frame(seed, **kw)
    return pdf, to_spark(spark, pdf, SCHEMA)


def collect(df, col):
    return df.orderBy("station", "datehour").select(col).toPandas()[col].tolist()


@pytest.mark.parametrize("max_len", [1, 2, 3])
def test_short_gaps_match_loops(spark, max_len):
    pdf, df = frame(spark, 1)
    want = [x for _, g in pdf.groupby("station") for x in interp(g["bikes"], max_len)]
    same(collect(rebuild.interpolate_gaps(df, "bikes", max_len), "bikes"), want)


@pytest.mark.parametrize(
    "values, want",
    [
        ([None, 2, 4], [None, 2, 4]),
        ([1, None, 3], [1, 2, 3]),
        ([1, None, None, 4], [1, 2, 3, 4]),
        ([1, None, None, None, 5], [1, None, None, None, 5]),
        ([1, 5, None], [1, 5, 5]),
        ([1, 5, None, None], [1, 5, 5, 5]),
        ([1, 5, None, None, None], [1, 5, None, None, None]),
        ([None], [None]),
        ([7], [7]),
    ],
)
def test_gap_at_head_middle_and_tail(spark, values, want):
    rows = [("a", h, None if v is None else float(v)) for h, v in zip(hours(len(values)), values)]
    out = rebuild.interpolate_gaps(spark.createDataFrame(rows, SCHEMA), "bikes", 2)
    assert [r.bikes for r in out.orderBy("datehour").collect()] == want


def test_night_pass_runs_over_midnight_and_across_days(spark):
    pdf, df = frame(spark, 2, known=0.4)
    want = []
    for _, g in pdf.groupby("station"):
        g = g.copy()
        night = (g["datehour"].dt.hour < 6) | (g["datehour"].dt.hour > 22)
        g.loc[night, "bikes"] = interp(g.loc[night, "bikes"], 3)
        want += g["bikes"].tolist()
    same(collect(rebuild.interpolate_night(df), "bikes"), want)


def test_null_runs_and_run_sums(spark):
    rows = [("a", h, v) for h, v in zip(hours(7), [None, None, 1.0, None, 2.0, None, None])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = rebuild.null_runs(df, "bikes").orderBy("datehour").collect()
    assert [r.run_id for r in out] == [1, 1, None, 2, None, 3, 3]
    assert [r.run_length for r in out] == [2, 2, None, 1, None, 2, 2]
    src = df.withColumn("x", F.hour("datehour") + 1)
    ahead = rebuild.run_cumsum(src, "bikes", "x", "t").orderBy("datehour").collect()
    back = rebuild.run_cumsum(src, "bikes", "x", "t", reverse=True).orderBy("datehour").collect()
    assert [r.t for r in ahead] == [1, 3, None, 4, None, 6, 13]
    assert [r.t for r in back] == [3, 2, None, 4, None, 13, 7]


def mirror(g):
    """Seasonal fill, stock rebuild and final delta of one station by pandas and loops."""
    g = g.sort_values("datehour").reset_index(drop=True)
    med = g.groupby(["weekday", "hour"])["delta"].transform(lambda s: s.rolling(3, min_periods=1).median())
    near = pd.concat([med.ffill().bfill(), med.bfill().ffill()], axis=1).mean(axis=1)
    filled = g["delta"].fillna(med).fillna(near)
    bikes, delta = g["bikes"].tolist(), filled.fillna(0).tolist()
    first = next((i for i, b in enumerate(bikes) if not np.isnan(b)), None)
    if first is not None:
        walk = list(bikes)
        for i in range(first - 1, -1, -1):
            walk[i] = walk[i + 1] - delta[i + 1]
        for i in range(first + 1, len(walk)):
            walk[i] = walk[i - 1] + delta[i]
        bikes = [w if np.isnan(b) else b for b, w in zip(bikes, walk)]
    bikes = pd.Series(bikes).fillna(0).clip(lower=0)
    out = bikes.diff()
    if not np.isnan(filled[0]):
        out[0] = int(filled[0])
    return pd.DataFrame({"station": g["station"], "med": med, "filled": filled, "bikes": bikes, "delta": out, "reconstructed": g["delta"].isna()})


def test_reconstruction_matches_loops(spark):
    pdf, df = frame(spark, 3, known=0.6)
    pdf["delta"] = pdf.groupby("station")["bikes"].diff()
    pdf["weekday"], pdf["hour"] = pdf["datehour"].dt.weekday, pdf["datehour"].dt.hour
    want = pd.concat([mirror(g) for _, g in pdf.groupby("station")])
    keyed = add_delta(df).withColumns({"weekday": F.weekday("datehour"), "hour": F.hour("datehour")})
    same(collect(rebuild.seasonal_median(keyed), "seasonal_median"), want["med"])
    same(collect(rebuild.fill_delta(keyed), "delta"), want["filled"])
    done = rebuild.rebuild_long_gaps(keyed)
    same(collect(done, "bikes"), want["bikes"])
    same(collect(done, "delta"), want["delta"])
    assert collect(done, "reconstructed") == want["reconstructed"].tolist()


def test_station_without_any_value_stays_unknown_but_clamped(spark):
    rows = [("a", h, None) for h in hours(5)]
    keyed = add_delta(spark.createDataFrame(rows, SCHEMA)).withColumns({"weekday": F.lit(0), "hour": F.hour("datehour")})
    out = rebuild.rebuild_long_gaps(keyed).orderBy("datehour").collect()
    assert [r.bikes for r in out] == [0.0] * 5
    assert out[0].delta is None and [r.delta for r in out[1:]] == [0.0] * 4
    assert START == out[0].datehour
