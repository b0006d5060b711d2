"""Scaling, encoding, weights, sampling and hold-out."""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.numeric import to_metres
from dockflow.operators.ranking import prefix_sums


def minmax_fit(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row with the low and high of every column."""
    aggs = [f(F.col(c).cast("double")).alias(f"{c}_{n}") for c in cols for n, f in (("low", F.min), ("high", F.max))]
    return df.agg(*aggs)


def minmax_apply(df: DataFrame, bounds: DataFrame | Row, cols: list[str]) -> DataFrame:
    """Columns scaled by stored bounds; a constant column becomes 0."""
    if isinstance(bounds, DataFrame):
        box = bounds.select(F.struct(*bounds.columns).alias("b")).scalar()
        bound = lambda name: box.getField(name)
    else:
        bound = lambda name: F.lit(bounds[name]).cast("double")

    def scaled(c: str) -> Column:
        low, span = bound(f"{c}_low"), bound(f"{c}_high") - bound(f"{c}_low")
        return (F.col(c).cast("double") - low) / F.when(span == 0, F.lit(1.0)).otherwise(span)

    return df.withColumns({c: scaled(c) for c in cols})


def onehot_fit(df: DataFrame, cols: list[str]) -> list[tuple[str, str]]:
    """Sorted (column, value) vocabulary. Every entry becomes an output column of the plan; columns with many values take ``onehot_vectors``."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.c", "p.v").filter("v is not null").distinct()
    return sorted((r.c, r.v) for r in values.collect())


def onehot_apply(df: DataFrame, vocabulary: list[tuple[str, str]]) -> DataFrame:
    """One 0/1 column ``<column>_<value>`` per vocabulary entry; unseen values are all zeros."""
    def flag(c: str, v: str) -> Column:
        return F.coalesce((F.col(c).cast("string") == v).cast("double"), F.lit(0.0))
    return df.withColumns({f"{c}_{v}": flag(c, v) for c, v in vocabulary})


def index_fit(df: DataFrame, col: str) -> DataFrame:
    """Dictionary (value, index), numbered from 0 in value order without a single-task sort."""
    values = df.filter(F.col(col).isNotNull()).select(col).distinct().withColumn("_n", F.lit(1))
    ranked = prefix_sums(values, [], col, ["_n"])
    return ranked.select(col, (F.col("cum__n") - 1).cast("int").alias(f"{col}_index"))


def index_apply(df: DataFrame, dictionary: DataFrame, col: str) -> DataFrame:
    """Index of a category by dictionary, -1 for an unknown one."""
    out = df.join(dictionary, col, "left")
    return out.withColumn(f"{col}_index", F.coalesce(f"{col}_index", F.lit(-1)))


def onehot_vectors(df: DataFrame, dictionaries: dict[str, DataFrame]) -> DataFrame:
    """One sparse vector ``<column>_onehot`` per column, of any width, by its dictionary of ``index_fit``; unseen and null values are all zeros.

    A row carries the one entry it has. The vectors are made once per dictionary entry and joined, without names of their entries: neither
    the plan nor the driver grows with the vocabulary.
    """
    out = df
    for c, dictionary in dictionaries.items():
        size = dictionary.count()
        vector = F.udf(lambda i, size=size: SparseVector(size, [i], [1.0]) if i >= 0 else SparseVector(size, [], []), VectorUDT())
        none = df.sparkSession.range(1).select(vector(F.lit(-1)).alias("v")).scalar()
        vectors = dictionary.select(c, vector(f"{c}_index").alias("_vector"))
        out = out.join(vectors, c, "left").withColumn(f"{c}_onehot", F.coalesce("_vector", none)).drop("_vector")
    return out


def geo_features(df: DataFrame) -> DataFrame:
    """Position in metres from the south-west corner, scaled to [0, 1]."""
    metres = to_metres(df)
    return minmax_apply(metres, minmax_fit(metres, ["lat", "lon"]), ["lat", "lon"])


def rush_weights(df: DataFrame, low: Column, high: Column, wl: float, wh: float, col: str = "delta") -> DataFrame:
    """``weight``: wh above the high margin, wl below the low one, 1 between."""
    value = F.col(col)
    weight = F.when(value > high, F.lit(float(wh))).when(value < low, F.lit(float(wl))).otherwise(F.lit(1.0))
    return df.withColumn("weight", weight)


def tail_boundary(df: DataFrame, frac: float = 0.3, col: str = "datehour") -> DataFrame:
    """One row: the earliest hour from which at most ``frac`` of all rows remain.

    Rows are counted per hour and only those totals, bounded by the calendar, are accumulated.
    """
    totals = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    w = W.orderBy(F.col(col).desc()).rowsBetween(W.unboundedPreceding, 0)
    tail = totals.withColumn("tail", F.sum("n").over(w))
    total = df.agg(F.count(F.lit(1)).alias("total")).scalar()
    return tail.filter(F.col("tail") <= total * F.lit(frac)).agg(F.min(col).alias("boundary"))


def tail_split(df: DataFrame, frac: float = 0.3, col: str = "datehour") -> tuple[DataFrame, DataFrame]:
    """(head, tail) by time, the tail holding the newest ``frac`` of the rows in whole hours."""
    boundary = tail_boundary(df, frac, col).scalar()
    at = F.col(col) >= boundary
    return df.filter(~at | boundary.isNull()), df.filter(at)


def rebalance(
    df: DataFrame, is_rush: Column, keys: list[str], ratio: float = 3.0, copies: int = 1, seed: int = 0,
) -> DataFrame:
    """Undersample the calm rows to ``ratio`` times the rush rows and repeat the rush rows.

    A row's fate is a hash of its key, so a re-run task keeps the same rows.
    """
    counts = df.agg(
        F.struct(F.count_if(is_rush).alias("rush"), F.count_if(~is_rush).alias("calm")).alias("c")
    ).scalar()
    share = counts.getField("rush") * F.lit(ratio) / counts.getField("calm")
    draw = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) / F.lit(1_000_000.0)
    kept = df.filter(is_rush | (draw < share))
    return kept.withColumn("copy", F.explode(F.when(is_rush, F.sequence(F.lit(1), F.lit(copies))).otherwise(F.array(F.lit(1)))))
