"""Small frames and pandas mirrors shared by the tests."""

import datetime as dt

import numpy as np
import pandas as pd

START = dt.datetime(2024, 1, 1)


def hours(n, start=START):
    return [start + dt.timedelta(hours=i) for i in range(n)]


def grid_frame(seed=0, stations=4, n=24 * 21, known=0.5):
    """Random dense grid with gaps; station "3" has none known, station "2" few."""
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(stations):
        share = {2: 0.02, 3: 0.0}.get(s, known)
        value = rng.integers(0, 30, n).astype(float)
        value[rng.random(n) > share] = np.nan
        rows += [(str(s), h, None if np.isnan(v) else float(v)) for h, v in zip(hours(n), value)]
    return pd.DataFrame(rows, columns=["station", "datehour", "bikes"])


def to_spark(spark, pdf, schema):
    rows = [tuple(None if (isinstance(v, float) and np.isnan(v)) or v is pd.NaT else (v.to_pydatetime() if isinstance(v, pd.Timestamp) else v) for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, schema)


def interp(values, max_len):
    """Interpolation of short gaps by plain loops."""
    v = list(values)
    out, n, i = list(v), len(v), 0
    while i < n:
        if not np.isnan(v[i]):
            i += 1
            continue
        j = i
        while j < n and np.isnan(v[j]):
            j += 1
        if j - i <= max_len and i > 0:
            for k in range(i, j):
                out[k] = v[i - 1] if j == n else v[i - 1] + (v[j] - v[i - 1]) * (k - i + 1) / (j - i + 1)
        i = j
    return out


def same(left, right):
    a, b = np.array(left, dtype=float), np.array(right, dtype=float)
    assert a.shape == b.shape
    assert np.array_equal(np.isnan(a), np.isnan(b)), "null positions differ"
    assert np.allclose(a, b, equal_nan=True, atol=1e-9)
