"""Time-axis helpers (P7-P10). All return Columns; none depends on the session time zone.

Canonical representation: ``ts_event`` is TIMESTAMP_NTZ holding UTC wall-clock time.
The exchange view (``et``) is TIMESTAMP_NTZ holding New York wall-clock time.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Time-axis candidates, first present wins (fixed order).
TIME_AXIS_CANDIDATES = ("Datetime", "datetime", "ts_event", "timestamp", "index")


def pick_time_axis(columns) -> str | None:
    for cand in TIME_AXIS_CANDIDATES:
        if cand in columns:
            return cand
    return None


def to_utc_ntz(col: Column, dtype: T.DataType) -> Column:
    """Canonical UTC wall clock. Naive input is taken as UTC; an instant is converted."""
    if isinstance(dtype, T.TimestampNTZType):
        return col
    if isinstance(dtype, T.TimestampType):
        # two-argument form: source zone = session zone, so any session works
        return F.convert_timezone(None, F.lit("UTC"), col)
    if isinstance(dtype, (T.StringType, T.DateType)):
        return col.cast("timestamp_ntz")
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        # integer epochs are nanoseconds (vendor convention)
        return F.convert_timezone(None, F.lit("UTC"), F.timestamp_micros(F.floor(col / 1000)))
    return col.cast("timestamp_ntz")


def utc_to_local(utc_ntz: Column, tz: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc_ntz)


def seconds_of_day(ntz: Column) -> Column:
    """Whole seconds since local midnight (fractional part dropped: session bounds are whole seconds)."""
    return F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz)


def plus_seconds(ntz: Column, seconds: Column) -> Column:
    return ntz + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def utc_offset_str(utc_ntz: Column, local_ntz: Column) -> Column:
    """'-05:00' style offset of the local view against UTC."""
    mins = F.timestamp_diff("MINUTE", utc_ntz, local_ntz)
    sign = F.when(mins < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(mins)
    return F.format_string("%s%02d:%02d", sign, (a / 60).cast("int"), a % 60)


def iso_local(utc_ntz: Column, tz: str) -> Column:
    """'2024-01-02 11:00:00-05:00': local wall clock with its offset."""
    loc = utc_to_local(utc_ntz, tz)
    return F.concat(F.date_format(loc, "yyyy-MM-dd HH:mm:ss"), utc_offset_str(utc_ntz, loc))
