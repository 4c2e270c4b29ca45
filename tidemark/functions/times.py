"""Time expressions.  The batch clock is always a parameter."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def clock(now: datetime | str | Column) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp")


def iso(text: Column) -> Column:
    """ISO-8601 text (``Z`` or offset allowed) to an instant, else null.

    The date must be written out: the plain conversion also takes words such as "yesterday".
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def parse_iso(text: Column, now) -> Column:
    return F.coalesce(iso(text), clock(now))


def duration_seconds(text: Column) -> Column:
    """ISO-8601 duration to whole seconds; anything unreadable is 0."""
    number = r"(\d+(?:[.,]\d+)?)"
    time_part = F.regexp_extract(text, r"T(.*)$", 1)
    date_part = F.regexp_extract(text, r"^P([^T]*)", 1)

    def part(source: Column, unit: str) -> Column:
        found = F.replace(F.regexp_extract(source, number + unit, 1), F.lit(","), F.lit("."))
        return F.coalesce(found.try_cast("double"), F.lit(0.0))

    total = (
        part(date_part, "W") * 604800 + part(date_part, "D") * 86400
        + part(time_part, "H") * 3600 + part(time_part, "M") * 60 + part(time_part, "S")
    )
    well_formed = text.rlike(
        r"^P(?=.)(\d+([.,]\d+)?W)?(\d+([.,]\d+)?D)?(T(?=.)(\d+([.,]\d+)?H)?(\d+([.,]\d+)?M)?(\d+([.,]\d+)?S)?)?$")
    return F.when(well_formed, total.cast("long")).otherwise(F.lit(0).cast("long"))


def hours_between(a: Column, b: Column) -> Column:
    return F.abs(F.unix_micros(a) - F.unix_micros(b)) / F.lit(3.6e9)


def linear_decay(a: Column, b: Column, span_hours: float = 24.0) -> Column:
    """1 when the two instants coincide, 0 from ``span_hours`` apart; 0.5 if either is missing."""
    hours = hours_between(a, b)
    return F.when(hours.isNull(), 0.5).otherwise(
        F.greatest(F.lit(0.0), 1.0 - hours / span_hours))


def daily_id(query: Column, now) -> Column:
    return F.concat_ws("_", query, F.date_format(clock(now), "yyyyMMdd"))
