"""Local time, day bounds and the text forms of dates in a snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value.
LOCAL_ZONE = "Asia/Almaty"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def moment(value: Column | dt.datetime | str) -> Column:
    """A literal or a column as TIMESTAMP_NTZ."""
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast("timestamp_ntz")


def utc_wall(column: Column | str) -> Column:
    """An instant as the wall time of a UTC clock, whatever the session's zone."""
    seconds = (F.unix_micros(_col(column)).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def now_utc() -> Column:
    """The start of the query, in UTC; the same for all rows and known before the scan."""
    return utc_wall(F.current_timestamp())


def local_time(column: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """UTC wall time -> wall time in ``zone``, by the zone's history of offsets."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(column).cast("timestamp_ntz"))


def local_day_start(
    as_of: Column | DataFrame | dt.datetime | str, zone: str = LOCAL_ZONE, days_back: int = 0
) -> Column:
    """The UTC wall time at which the local day of ``as_of`` (minus ``days_back``) begins.

    Comparing the raw column with it is the same test as comparing local dates,
    but it leaves the column bare and the bound a single value, so the filter reaches
    the Parquet scan. ``as_of`` is UTC: a value, ``now_utc()``, or a frame of one row and
    one column, which becomes a scalar subquery.
    """
    if isinstance(as_of, DataFrame):
        (name,) = as_of.columns
        return as_of.select(local_day_start(F.col(name), zone, days_back)).scalar()
    day = F.date_sub(F.to_date(local_time(moment(as_of), zone)), days_back)
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), day.cast("timestamp_ntz"))


def period_id(column: Column | str) -> Column:
    """YYYYMM as an integer."""
    column = _col(column)
    return (F.year(column) * 100 + F.month(column)).cast("int")


def fmt_day(column: Column | str) -> Column:
    """``yyyy-MM-dd``. Cut from the plain text of the time: formatting functions would read
    it in the session's zone and shift what falls into a clock change."""
    return F.substring(_col(column).cast("string"), 1, 10)


def fmt_ts(column: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, in the same way."""
    return F.substring(_col(column).cast("string"), 1, 19)


def wall_instant(column: Column | str) -> Column:
    """Wall time as the instant at which a UTC clock shows it, whatever the session's zone."""
    return F.concat(_col(column).cast("string"), F.lit("Z")).cast("timestamp")


def instant_day(column: Column | str) -> Column:
    """The UTC date of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(column)) / 86400).cast("int"))


def read_time(column: Column | str) -> Column:
    """Text -> TIMESTAMP_NTZ; unreadable text -> NULL."""
    return _col(column).try_cast("timestamp_ntz")
