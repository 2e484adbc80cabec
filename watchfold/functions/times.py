"""Timestamp expressions. Everything is zone-less (``timestamp_ntz``)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "jan,feb,mar,apr,may,jun,jul,aug,sep,oct,nov,dec"


def year_text(year: int | Column | None = None) -> Column:
    """A year as text; the current one by default."""
    if year is None:
        year = F.year(F.current_date())
    elif not isinstance(year, Column):
        year = F.lit(year)
    return F.lpad(year.cast("string"), 4, "0")


def stamp_time(year: Column, month: Column, day_time: Column) -> Column:
    """Time from a year, an English month name and ``d h:m:s``; NULL if there is no such time.

    The parts become ISO text and are cast, which needs no session time zone and
    no formatter per row.
    """
    place = F.instr(F.lit(MONTHS), F.lower(month))
    number = F.when((F.length(month) == 3) & (place > 0), F.shiftright(place + 3, 2))
    return F.concat(year, F.lit("-"), number.cast("string"), F.lit("-"), day_time).try_cast(
        "timestamp_ntz"
    )


def web_time(stamp: Column) -> Column:
    """``10/Jan/2024:13:55:36 +0000`` without its zone; NULL if it does not parse."""
    shape = r"(?s)^(\d{1,2})/([A-Za-z]{3})/(\d{4}):(\d{1,2}:\d{1,2}:\d{1,2})(?:\s.*)?$"
    part = F.split(F.regexp_replace(stamp, shape, "\n$3\n$2\n$1 $4"), "\n")
    return stamp_time(F.get(part, F.lit(1)), F.get(part, F.lit(2)), F.get(part, F.lit(3)))


def ssh_time(stamp: Column, year: int | Column | None = None) -> Column:
    """``Jan  5 13:55:36`` in an assumed year (the current one by default)."""
    part = F.split(F.regexp_replace(stamp, r"^(\S+)\s+(\S+)\s+(\S+)$", "\n$1\n$2 $3"), "\n")
    return stamp_time(year_text(year), F.get(part, F.lit(1)), F.get(part, F.lit(2)))


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 as ``decimal(18,6)``, exact to the microsecond and zone-free."""
    since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return since.cast("interval second").cast("decimal(18,6)")


def as_instant(ts: Column) -> Column:
    """A zone-less time as the instant that shows it in UTC; watermarks need instants."""
    return F.timestamp_micros((epoch_seconds(ts) * 1000000).cast("bigint"))


def as_local(instant: Column) -> Column:
    """The zone-less UTC time of an instant, whatever the session's zone."""
    seconds = (F.unix_micros(instant) / F.lit(Decimal(1000000))).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)
