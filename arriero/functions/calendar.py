"""Dates, months and zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arriero.functions.text import _col

LOCAL_ZONE = "America/Santiago"
OPEN_END = "9999-12-31"


def date_key(c: Column | str) -> Column:
    """Date to the integer YYYYMMDD."""
    d = _col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_of(c: Column | str) -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def month_start(mes: Column | str) -> Column:
    """First day of a ``yyyy-MM`` month."""
    return F.concat(_col(mes), F.lit("-01")).try_cast("date")


def previous_month(c: Column | str) -> Column:
    return month_of(F.add_months(F.trunc(_col(c), "MM"), -1))


def iso_weekday(c: Column | str) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(_col(c)) + 1


def to_local(ts_utc: Column | str, zone: str = LOCAL_ZONE) -> Column:
    """A UTC wall clock (TIMESTAMP_NTZ) as the wall clock of ``zone``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts_utc).cast("timestamp_ntz"))


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    """Hours as a double, to the microsecond."""
    micros = F.timestamp_diff("MICROSECOND", _col(earlier), _col(later))
    return micros / F.lit(3_600_000_000.0)
