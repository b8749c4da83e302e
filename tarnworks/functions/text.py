"""Texts of bytes, numbers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def low_bytes(text: Column) -> Column:
    """The low byte of each UTF-16 unit of a text, as binary: bytes that were read as characters become bytes again."""
    return F.unhex(F.regexp_replace(F.hex(F.encode(text, "UTF-16BE")), "..(..)", "$1"))


def grouped(number: Column, digits: int = 0) -> Column:
    """A number with commas between thousands and a fixed number of digits."""
    return F.format_number(number, digits)


def fixed(number: Column, digits: int) -> Column:
    """A number with a fixed number of digits, half away from zero."""
    return F.format_string(f"%.{digits}f", number.cast("double"))


def compact_time(at: Column) -> Column:
    """A timestamp as ``20240131T235959Z`` in UTC; its first eight characters are the date."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")
