"""Time rules: parsing, whole epoch seconds, ISO text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_time(text: Column) -> Column:
    """Text to zone-less timestamp; what does not parse becomes null instead of raising under ANSI."""
    return text.try_cast("timestamp_ntz")


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole seconds since the epoch (floor), for both timestamp types.

    A zone-less timestamp is counted on its own clock, so the session zone does not matter.
    """
    time = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampNTZType):
        days = F.unix_date(F.to_date(time)).cast("long")
        return days * 86_400 + F.hour(time) * 3_600 + F.minute(time) * 60 + F.second(time)
    return F.unix_timestamp(time)


def iso_millis(time: Column) -> Column:
    """Timestamp as ``yyyy-MM-ddTHH:mm:ss.SSS``.

    Built from the timestamp's own text: formatting would read a zone-less one in the session's zone, where an hour may be
    missing.
    """
    text = time.cast("string")
    return F.concat(F.translate(F.substring(text, 1, 19), " ", "T"), F.lit("."), F.rpad(F.substring(text, 21, 3), 3, "0"))


def on_day(df: DataFrame, name: str, day: str) -> Column:
    """Whether a typed time falls on ``day``, as a range that reaches the Parquet scan."""
    kind = df.schema[name].dataType
    start = F.lit(day).cast("date")
    return (F.col(name) >= start.cast(kind)) & (F.col(name) < F.date_add(start, 1).cast(kind))
