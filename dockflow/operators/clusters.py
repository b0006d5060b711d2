"""Station clusters, the choice of their number, and cluster borders."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.functions.numeric import to_metres
from dockflow.operators.lags import station_peaks
from dockflow.session import scratch_path
from dockflow.sources.tables import last_days, write_and_read

# Candidate numbers of clusters and regions, the history used, and the clustered columns.
CLUSTER_RANGE = range(25, 126)
REGION_RANGE = range(10, 21)
CLUSTER_DAYS = 29
FEATURES = ["y", "x", "morning_peak", "evening_peak"]

MAX_ITERATIONS = 20
TOLERANCE = 1e-4
SEED_ROUNDS = 4

Centres = dict[int, np.ndarray]


def cluster_features(df: DataFrame, keep_incomplete: bool = False) -> DataFrame:
    """Position in metres and mean peaks per station over the last four weeks.

    Written as a table because every iteration reads it again.
    """
    peaks = station_peaks(last_days(df, CLUSTER_DAYS), keep_incomplete)
    metres = to_metres(peaks.withColumns({"y": F.col("lat"), "x": F.col("lon")}), "y", "x")
    return write_and_read(metres.na.drop(), scratch_path(df.sparkSession, "stations"))


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    d = x @ centres.T
    d *= -2
    d += (x * x).sum(1)[:, None]
    d += (centres * centres).sum(1)
    return np.maximum(d, 0.0, out=d)


def _totals(points: DataFrame, columns: list[str], centres: Centres) -> dict[int, pd.DataFrame]:
    """Per candidate and cluster the number of points (n), their vectors' sum, summed squared norms (psi) and summed squared distances (cost).

    One job for all candidates: a task adds its points up in a table of as many rows as there are centres, and the tables are summed.
    """
    fields = ["n", "psi", "cost", *[f"s{i}" for i in range(len(columns))]]
    schema = "k int, cluster int, " + ", ".join(f"{f} double" for f in fields)
    parts = points.select(*columns).mapInPandas(lambda batches: _added_up(batches, centres, fields), schema)
    rows = parts.groupBy("k", "cluster").agg(*[F.sum(f).alias(f) for f in fields]).toPandas()
    return {int(k): g.set_index("cluster").sort_index() for k, g in rows.groupby("k")}


def _added_up(batches: Iterator[pd.DataFrame], centres: Centres, fields: list[str]) -> Iterator[pd.DataFrame]:
    """One frame for all candidates: a frame each would cost more than the adding."""
    tables = {k: np.zeros((len(c), len(fields))) for k, c in centres.items()}
    for batch in batches:
        x = batch.to_numpy(dtype=float)
        row = np.column_stack([np.ones(len(x)), (x * x).sum(1), np.zeros(len(x)), x])
        for k, c in centres.items():
            d = _distances(x, c)
            label = d.argmin(1)
            row[:, 2] = d[np.arange(len(x)), label]
            tables[k] += np.column_stack([np.bincount(label, column, len(c)) for column in row.T])
    numbers = np.array([(k, i) for k, t in tables.items() for i in range(len(t))], int).reshape(-1, 2)
    rows = np.concatenate([np.zeros((0, len(fields))), *tables.values()])
    used = np.flatnonzero(rows[:, 0])
    if len(used):
        yield pd.DataFrame(rows[used], columns=fields).assign(k=numbers[used, 0], cluster=numbers[used, 1])[["k", "cluster", *fields]]


def seeds(points: DataFrame, columns: list[str], most: int, seed: int = 0) -> np.ndarray:
    """Up to ``most`` first centres in an order whose every beginning is a choice of its own, so that one order serves all candidates.

    Scalable k-means++: in every round a station is drawn with a probability proportional to its squared distance, about twice ``most`` of
    them, by a hash of its name, so that a task run again draws the same. The drawn ones, weighted by the stations nearest to them, are
    ordered by weighted k-means++ on the driver; their number doesn't depend on the number of stations.
    """
    mark = F.xxhash64(F.lit(seed), "station")
    first = points.agg(F.min_by(F.array(*[F.col(c).cast("double") for c in columns]), F.struct(mark, "station")).alias("x")).first()["x"]
    if first is None:
        return np.empty((0, len(columns)))
    drawn = np.array([first])
    for step in range(SEED_ROUNDS):
        cost = sum(t["cost"].sum() for t in _totals(points, columns, {0: drawn}).values())
        if cost <= 0:
            break
        chance = (F.pmod(F.xxhash64(F.lit(seed), F.lit(step), "station"), F.lit(1 << 30)) / float(1 << 30)).alias("_chance")

        def draw(batches: Iterator[pd.DataFrame], drawn: np.ndarray = drawn, cost: float = cost) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = batch[columns].to_numpy(dtype=float)
                yield batch.loc[batch["_chance"].to_numpy() < 2 * most * _distances(x, drawn).min(1) / cost, columns]

        typed = points.select(*[F.col(c).cast("double").alias(c) for c in columns], chance)
        more = typed.mapInPandas(draw, ", ".join(f"{c} double" for c in columns)).toPandas()
        drawn = np.unique(np.vstack([drawn, more.to_numpy(dtype=float).reshape(-1, len(columns))]), axis=0)
    nearest = _totals(points, columns, {0: drawn})[0]["n"]
    weight = nearest.reindex(range(len(drawn)), fill_value=0.0).to_numpy()
    rng = np.random.default_rng(seed)
    order = [int(rng.choice(len(drawn), p=weight / weight.sum()))]
    gap = _distances(drawn, drawn[order]).min(1)
    while len(order) < most and (weight * gap).sum() > 0:
        order.append(int(rng.choice(len(drawn), p=weight * gap / (weight * gap).sum())))
        gap = np.minimum(gap, _distances(drawn, drawn[order[-1:]])[:, 0])
        gap[order] = 0.0
    return drawn[order]


def batched_kmeans(points: DataFrame, columns: list[str], centres: Centres, iterations: int = MAX_ITERATIONS) -> Centres:
    """Centres of every candidate after Lloyd's iterations from the given ones: one job an iteration for all candidates that still move.

    A candidate rests once none of its centres moves by more than the tolerance; a cluster without points keeps its centre.
    """
    out, moving = dict(centres), set(centres)
    for _ in range(iterations):
        if not moving:
            break
        totals = _totals(points, columns, {k: out[k] for k in moving})
        for k in sorted(moving):
            t = totals.get(k)
            if t is None:
                moving.discard(k)
                continue
            new = out[k].copy()
            new[t.index] = t.filter(regex=r"^s\d+$").to_numpy() / t[["n"]].to_numpy()
            if ((new - out[k]) ** 2).sum(1).max() <= TOLERANCE**2:
                moving.discard(k)
            out[k] = new
    return out


def silhouettes(points: DataFrame, columns: list[str], centres: Centres) -> dict[int, float]:
    """Mean silhouette of every candidate by squared distances, in two jobs for all of them.

    The mean squared distance of a point to a cluster follows from the cluster's size, sum and summed squared norms, so no pair of points is
    formed. A point alone in its cluster counts 0.
    """
    totals = {k: t for k, t in _totals(points, columns, centres).items() if len(t) > 1}
    stats = {k: (t.index.to_numpy(), t["n"].to_numpy(), t["psi"].to_numpy(), t.filter(regex=r"^s\d+$").to_numpy()) for k, t in totals.items()}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = {k: np.zeros(2) for k in stats}
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            at = np.arange(len(x))
            for k, (clusters, n, psi, total) in stats.items():
                own = np.searchsorted(clusters, _distances(x, centres[k]).argmin(1))
                mean = (x * x).sum(1)[:, None] + psi / n - 2 * (x @ total.T) / n
                inside = mean[at, own] * n[own] / np.maximum(n[own] - 1, 1)
                mean[at, own] = np.inf
                other = mean.min(1)
                top = np.maximum(inside, other)
                value = np.where((n[own] > 1) & (top > 0), (other - inside) / np.where(top > 0, top, 1.0), 0.0)
                found[k] += (value.sum(), len(x))
        yield pd.DataFrame([(k, *v) for k, v in found.items()], columns=["k", "total", "n"])

    rows = points.select(*columns).mapInPandas(score, "k int, total double, n double").groupBy("k").agg((F.sum("total") / F.sum("n")).alias("score"))
    return {r["k"]: r["score"] for r in rows.collect()}


def _fit_all(points: DataFrame, ks: Iterable[int]) -> tuple[Centres, dict[int, float | None]]:
    """Centres and score of every candidate."""
    ks, n = sorted(set(ks)), points.count()
    start = seeds(points, FEATURES, max(ks))
    centres = batched_kmeans(points, FEATURES, {k: start[:k] for k in ks if len(start)})
    scored = silhouettes(points, FEATURES, {k: c for k, c in centres.items() if 1 < k < n})
    return centres, {k: scored.get(k) for k in ks}


def silhouette_sweep(features: DataFrame, ks: Iterable[int]) -> DataFrame:
    """(k, score) of every candidate. A silhouette needs two clusters and at least one shared one, so the
    score of a candidate outside 2 .. number of stations - 1 is null.

    All candidates are fitted together: the number of jobs doesn't depend on how many there are.
    """
    return features.sparkSession.createDataFrame(list(_fit_all(features, ks)[1].items()), "k int, score double")


def cluster_stations(
    df: DataFrame, ks: Iterable[int] = CLUSTER_RANGE, region_ks: Iterable[int] = REGION_RANGE,
    keep_incomplete: bool = False,
) -> DataFrame:
    """(station, lat, lon, cluster, metacluster) for the best-scoring fine and regional clusterings.

    Both ranges of candidates are fitted together. The smaller of equally good ones is taken; where no candidate has a score, as in a
    network smaller than all of them, the smallest one.
    """
    features = cluster_features(df, keep_incomplete)
    centres, scores = _fit_all(features, [*ks, *region_ks])
    chosen = [min(c, key=lambda k: (-(scores[k] if scores[k] is not None else -np.inf), k)) for c in (ks, region_ks)]
    pair = [centres.get(k) for k in chosen]

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[FEATURES].to_numpy(dtype=float)
            out = batch[["station", "lat", "lon"]].copy()
            for name, c in zip(("cluster", "metacluster"), pair):
                out[name] = _distances(x, c).argmin(1)
            yield out

    schema = features.select("station", "lat", "lon", *[F.lit(0).alias(c) for c in ("cluster", "metacluster")]).schema
    return features.select("station", "lat", "lon", *FEATURES).mapInPandas(label, schema)


def join_clusters(df: DataFrame, labels: DataFrame) -> DataFrame:
    return df.join(labels.select("station", "cluster", "metacluster"), "station", "left")


def _hull(points: pd.DataFrame) -> pd.DataFrame:
    """Counter-clockwise convex hull of (lon, lat) rows, from the westernmost point."""
    p = points.sort_values(["lon", "lat", "station"]).drop_duplicates(["lon", "lat"])
    if len(p) < 3:
        return p
    xy = p[["lon", "lat"]].to_numpy()

    def chain(order: Iterable[int]) -> list[int]:
        out: list[int] = []
        for i in order:
            while len(out) > 1:
                (ax, ay), (bx, by), (cx, cy) = xy[out[-2]], xy[out[-1]], xy[i]
                if (bx - ax) * (cy - ay) - (by - ay) * (cx - ax) > 0:
                    break
                out.pop()
            out.append(i)
        return out[:-1]

    return p.iloc[chain(range(len(p))) + chain(range(len(p) - 1, -1, -1))]


def _partial_hulls(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            yield pd.concat([_hull(g) for _, g in batch.groupby("cluster")])


def cluster_borders(stations: DataFrame) -> DataFrame:
    """GeoJSON border polygon per cluster: (cluster, n_stations, feature).

    The hull of partial hulls is the hull of all points, so every batch is reduced to its hull
    points before the shuffle and no group receives a whole cluster. A cluster with fewer than
    three stations is drawn by its first station alone.
    """
    spark = stations.sparkSession
    points = stations.select(
        F.col("cluster").cast("int").alias("cluster"), "station", F.col("lon").cast("double").alias("lon"),
        F.col("lat").cast("double").alias("lat"),
    ).na.drop()
    counts = points.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_stations"), F.min(F.struct("station", "lon", "lat")).alias("first"))
    partial = points.mapInPandas(_partial_hulls, points.schema)

    def border(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        hull = _hull(group)
        ring = [[float(a), float(b)] for a, b in zip(hull["lon"], hull["lat"])]
        return pd.DataFrame({"cluster": [key[0]], "ring": [ring]})

    rings = partial.groupBy("cluster").applyInPandas(border, "cluster int, ring array<array<double>>")
    small = F.array(F.array("first.lon", "first.lat"))
    ring = F.when(F.col("n_stations") < 3, small).otherwise(F.col("ring"))
    closed = F.concat(ring, F.slice(ring, 1, 1))
    feature = F.to_json(
        F.struct(
            F.lit("Feature").alias("type"),
            F.create_map().cast("map<string,string>").alias("properties"),
            F.col("cluster").alias("id"),
            F.struct(F.lit("Polygon").alias("type"), F.array(closed).alias("coordinates")).alias("geometry"),
        )
    )
    return counts.join(rings, "cluster").select("cluster", "n_stations", feature.alias("feature"))
