"""Text parsers. Malformed input gives NULL, never an error, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """The empty string becomes NULL; other text is unchanged."""
    return F.nullif(_col(c), F.lit(""))


def decimal_comma(c: Column | str, precision: int = 20, scale: int = 4) -> Column:
    """Text with a decimal comma to DECIMAL: ``' 1,5 '`` is 1.5; blanks and ``'1.234,56'`` are NULL."""
    plain = F.replace(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(","), F.lit("."))
    return plain.try_cast(f"decimal({precision},{scale})")


def decimal_point(c: Column | str, precision: int, scale: int) -> Column:
    return _col(c).try_cast(f"decimal({precision},{scale})")


def whole_number(c: Column | str, to: str = "int") -> Column:
    """Text to an integer type; a fraction is cut off, as a lenient SQL cast does."""
    return _col(c).try_cast("decimal(38,6)").try_cast(to)


def iso_date(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def iso_timestamp(c: Column | str) -> Column:
    return _col(c).cast("string").try_cast("timestamp")


def yes_flag(c: Column | str, yes: str = "Si") -> Column:
    """TRUE for the affirmative word, FALSE for other text, NULL for NULL."""
    return _col(c) == F.lit(yes)


def day_first_timestamp(c: Column | str) -> Column:
    """``dd-mm-yyyy hh:mm:ss`` to TIMESTAMP_NTZ (a UTC wall clock, whatever the session zone is)."""
    s = _col(c)
    iso = F.concat(F.substring(s, 7, 4), F.lit("-"), F.substring(s, 4, 2), F.lit("-"), F.substring(s, 1, 2), F.substring(s, 11, 9))
    return F.when(s.rlike(r"^\d{2}-\d{2}-\d{4} \d{2}:\d{2}:\d{2}$"), iso.try_cast("timestamp_ntz"))


def last_letter(c: Column | str, allowed: tuple[str, ...]) -> Column:
    """The last character when it is one of ``allowed``, else NULL."""
    tail = F.right(_col(c), F.lit(1))
    return F.when(tail.isin(*allowed), tail)


def reads_as_number(c: Column | str) -> Column:
    return _col(c).try_cast("double")
