"""Number parsing, weather scalars, nested payload access and geography."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metres per degree at the network's latitude; frost model.
METRES_PER_LAT = 111000
METRES_PER_LON = 72987
FROST_SLOPE = 20
FROST_MAX = 60


def parse_decimal_comma(col: Column) -> Column:
    """Number written with a decimal comma; anything else is null."""
    return F.replace(col, F.lit(","), F.lit(".")).try_cast("double")


def frost_minutes(temp: Column) -> Column:
    """Frost minutes in an hour, from the temperature."""
    return F.when(temp >= 0, F.lit(0.0)).otherwise(F.least(-temp * FROST_SLOPE, F.lit(float(FROST_MAX))))


def first_key(col: Column, key: str) -> Column:
    """First non-null value of ``key`` in an array of maps; null for a null or empty array."""
    values = F.filter(F.transform(col, lambda m: F.try_element_at(m, F.lit(key))), lambda v: v.isNotNull())
    return F.try_element_at(values, F.lit(1))


def to_metres(df: DataFrame, lat: str = "lat", lon: str = "lon", origin: Column | None = None) -> DataFrame:
    """Degrees to metres from the south-west corner of the data (or of a fitted origin)."""
    if origin is None:
        origin = df.agg(
            F.struct(F.min(lat).alias("lat"), F.min(lon).alias("lon")).alias("origin")
        ).scalar()
    return df.withColumns(
        {
            lat: (F.col(lat) - origin.getField("lat")) * METRES_PER_LAT,
            lon: (F.col(lon) - origin.getField("lon")) * METRES_PER_LON,
        }
    )


def cyclic(df: DataFrame, cols: list[str], periods: list[int | None] | None = None) -> DataFrame:
    """``sin_``/``cos_`` columns of periodic values; a missing period is the distinct count."""
    periods = list(periods or []) + [None] * (len(cols) - len(periods or []))
    added = {}
    for name, period in zip(cols, periods):
        p = F.lit(float(period)) if period else df.agg(F.count_distinct(name).cast("double").alias("p")).scalar()
        angle = F.col(name) / p * F.lit(2.0) * F.pi()
        added[f"sin_{name}"] = F.sin(angle)
        added[f"cos_{name}"] = F.cos(angle)
    return df.withColumns(added)
