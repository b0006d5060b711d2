"""Time columns.

Event times are ``timestamp_ntz`` on one UTC clock. ``date_trunc`` and ``unix_micros`` would pass
through the session zone, so the helpers below only use zone-free arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Weekday labels, Monday first.
WEEKDAY_LABELS = ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]

ONE_HOUR = "interval 1 hour"


def hour_floor(col: Column) -> Column:
    """Timestamp cut to the hour."""
    seconds = F.extract(F.lit("SECOND"), col)
    return col - F.make_dt_interval(F.lit(0), F.lit(0), F.minute(col), seconds)


def hour_index(col: Column) -> Column:
    """Hours since 1970-01-01 as a long, for range frames and hour arithmetic."""
    return F.unix_date(F.to_date(col)).cast("long") * 24 + F.hour(col)


def micros(col: Column) -> Column:
    """Microseconds since 1970-01-01 on the column's own clock."""
    seconds = F.extract(F.lit("SECOND"), col) * 1_000_000
    return hour_index(col) * 3_600_000_000 + F.minute(col).cast("long") * 60_000_000 + seconds.cast("long")


def as_instant(col: Column) -> Column:
    """The wall clock as an instant, read as UTC: what streams need for watermarks, whatever the session zone."""
    return F.timestamp_micros(micros(col))


def as_clock(col: Column) -> Column:
    """An instant back to its UTC wall clock."""
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    us = F.unix_micros(col)
    days = F.floor(us / 86_400_000_000).cast("int")
    seconds = (F.pmod(us, F.lit(86_400_000_000)).cast("decimal(18,0)") / 1_000_000).cast("decimal(18,6)")
    return origin + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def arrival_key(at: str = "dt", number: str | None = "status_id") -> Column:
    """Order of arrival as one fixed-width number, which hash aggregates hold where a struct would make them sort.

    Ids fill less than the 2 x 10^19 steps between two microseconds; a null id comes before the others.
    """
    clock = micros(F.col(at)).cast("decimal(18,0)") * F.expr("20000000000000000000BD")
    if number is None:
        return clock.cast("decimal(38,0)")
    return (clock + F.coalesce(F.col(number).cast("decimal(19,0)"), F.expr("-9300000000000000000BD"))).cast("decimal(38,0)")


def epoch_to_ts(col: Column) -> Column:
    """Epoch seconds to a UTC timestamp without zone."""
    days = F.floor(col / 86400).cast("int")
    seconds = F.pmod(col, F.lit(86400)).cast("decimal(18,6)")
    origin = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return origin + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def utc_to_local(col: Column, zone: str = "Europe/Paris") -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col)


def local_to_utc(col: Column, zone: str = "Europe/Paris") -> Column:
    """Local wall clock to UTC; a time inside the spring gap moves forward by the gap length and
    the repeated autumn hour takes its first occurrence."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), col)


def parse_hour_stamp(col: Column) -> Column:
    return F.to_timestamp_ntz(col, F.lit("yyyyMMddHH"))


def weekday_label(weekday: Column) -> Column:
    """Label of a weekday number, 0 for Monday."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAY_LABELS]), weekday.cast("int") + 1)


def calendar_parts(df: DataFrame, col: str = "datehour") -> DataFrame:
    """hour, month, date, weekday (0 = Monday) and weekend of a timestamp column."""
    t = F.col(col)
    return df.withColumns(
        {
            "hour": F.hour(t),
            "month": F.month(t),
            "date": F.to_date(t),
            "weekday": F.weekday(t),
            "weekend": (F.weekday(t) >= 5).cast("int"),
        }
    )


def day_hours(df: DataFrame, col: str = "date") -> DataFrame:
    """Each day becomes its 24 hours."""
    start = F.col(col).cast("timestamp_ntz")
    return df.withColumn(
        "datehour", F.explode(F.sequence(start, start + F.expr("interval 23 hours"), F.expr(ONE_HOUR)))
    )


def range_hours(df: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Each [start, end) range becomes its hours; an empty range gives no row."""
    first, last = F.col(start), F.col(end) - F.expr(ONE_HOUR)
    return df.filter(first <= last).withColumn(
        "datehour", F.explode(F.sequence(first, last, F.expr(ONE_HOUR)))
    )
