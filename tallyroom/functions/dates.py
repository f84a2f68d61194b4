"""Date and time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from .text import blank_to_null


def parse_instant(
    value: Column,
    source_type: DataType,
    assume_utc: bool = False,
    blank_is_null: bool = False,
    exact_format: str | None = None,
) -> Column:
    """Raw text (or an already typed column) to an instant.

    ``assume_utc`` is for text without an offset, e.g. ``2023-01-05 10:00:00``.
    ``exact_format`` accepts only text of that pattern, in the session time
    zone.  Text that is no timestamp fails the job; so does blank text unless
    ``blank_is_null``.
    """
    if not isinstance(source_type, StringType):
        return value.cast("timestamp")
    text = blank_to_null(value) if blank_is_null else value
    if exact_format is not None:
        return F.to_timestamp(text, exact_format)
    return (F.concat(text, F.lit(" UTC")) if assume_utc else text).cast("timestamp")


def parse_local(value: Column) -> Column:
    """Raw text (or a typed column) to a wall-clock timestamp without zone; an offset is ignored."""
    return value.cast("timestamp_ntz")


def parse_civil_date(value: Column, source_type: DataType, blank_is_null: bool = False) -> Column:
    """The date as written; an offset in the text does not move it."""
    return (blank_to_null(value) if blank_is_null and isinstance(source_type, StringType) else value).cast("date")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_number(since: Column, month: Column) -> Column:
    """Calendar months from ``since`` to ``month`` (days ignored)."""
    return (F.year(month) - F.year(since)) * 12 + F.month(month) - F.month(since)


def whole_seconds(start: Column, end: Column) -> Column:
    """Seconds from ``start`` to ``end``, rounded half away from zero."""
    span = end - start
    seconds = (
        F.extract(F.lit("DAY"), span) * 86400
        + F.extract(F.lit("HOUR"), span) * 3600
        + F.extract(F.lit("MINUTE"), span) * 60
        + F.extract(F.lit("SECOND"), span)
    )
    return F.round(seconds, 0).cast("int")
