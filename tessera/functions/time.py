"""Date and time scalars (epoch millis, date codes, calendar attributes).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Functions that take a TIMESTAMP_NTZ column are independent of the session
time zone; those that take epoch millis render in the session zone, which
jobs here pin to UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ntz_millis(col) -> Column:
    """Epoch millis of a zone-less timestamp (TIMESTAMP_NTZ), zone-independent;
    floors, also before 1970."""
    micros = F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(col).cast("timestamp_ntz"))
    return F.floor(micros / F.lit(1000).cast("decimal(4,0)")).cast("bigint")


def millis_text(millis: int) -> str:
    """Epoch millis -> timestamp text with millisecond precision (a constant
    for predicates on raw timestamps)."""
    return (datetime(1970, 1, 1) + timedelta(milliseconds=millis)).isoformat(sep=" ", timespec="milliseconds")


def millis_to_timestamp(col) -> Column:
    """Epoch millis -> TIMESTAMP (floor semantics for negative values)."""
    return F.timestamp_millis(_c(col))


def millis_to_ntz(col) -> Column:
    """Epoch millis -> zone-less TIMESTAMP_NTZ (UTC wall clock), independent
    of the session time zone."""
    return F.timestamp_add("MILLISECOND", _c(col), _epoch_ntz())


def millis_to_date_text(col) -> Column:
    """Epoch millis -> 'yyyy-MM-dd'.  Unlike from_unixtime(x / 1000), which
    truncates toward zero, this floors, so -1500 ms is 1969-12-31."""
    return F.date_format(F.timestamp_millis(_c(col)), "yyyy-MM-dd")


def millis_to_timestamp_text(col) -> Column:
    """Epoch millis -> 'yyyy-MM-dd HH:mm:ss' in the session zone."""
    return F.date_format(F.timestamp_millis(_c(col)), "yyyy-MM-dd HH:mm:ss")


def now_millis() -> Column:
    """Current time as epoch millis (non-deterministic)."""
    return F.unix_millis(F.current_timestamp())


def now_minus_hours(hours: int = 1) -> Column:
    return F.current_timestamp() - F.expr(f"INTERVAL {int(hours)} HOURS")


def date_code(col) -> Column:
    """DATE/TIMESTAMP -> integer yyyymmdd."""
    d = F.to_date(_c(col))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_weekday(col) -> Column:
    """ISO weekday, 1 = Monday .. 7 = Sunday (``dayofweek`` is 1 = Sunday)."""
    return (F.weekday(F.to_date(_c(col))) + 1).cast("int")


def is_weekend(col) -> Column:
    return iso_weekday(col).isin(6, 7)


def month_name(col) -> Column:
    return F.date_format(F.to_date(_c(col)), "MMMM")


def day_name(col) -> Column:
    return F.date_format(F.to_date(_c(col)), "EEEE")


def parse_day_first(col, pattern: str = "dd/MM/yyyy") -> Column:
    """Day-first date text -> DATE; malformed text gives NULL."""
    return F.try_to_timestamp(_c(col), F.lit(pattern)).cast("date")


def hour_parts(ts_col) -> dict[str, Column]:
    """year/month/day/hour partition values of an event time, as the
    zero-padded text a time-based file partitioner writes."""
    ts = _c(ts_col)
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def minute_floor(col) -> Column:
    """Round a timestamp down to the minute, for tolerant comparisons."""
    return F.date_trunc("minute", _c(col))


def duration_seconds(start, end) -> Column:
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def iso_timestamp_text(col) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss")


def file_stamp(col=None) -> Column:
    """'yyyyMMdd_HHmmss' stamp used in snapshot file names."""
    return F.date_format(_c(col) if col is not None else F.current_timestamp(), "yyyyMMdd_HHmmss")


def ntz_to_instant(col) -> Column:
    """Zone-less timestamp read as UTC -> TIMESTAMP (an instant), without
    depending on the session zone; watermarks need this type."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _c(col).cast("timestamp_ntz")))


def instant_to_ntz(col) -> Column:
    """TIMESTAMP -> zone-less UTC wall clock, independent of the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), _epoch_ntz())
