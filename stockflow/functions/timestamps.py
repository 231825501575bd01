"""Event-time parsing and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.fixed_values import ISO_Z, LENIENT_FORMATS, PLAIN_SECONDS


def parse_iso(text: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text to timestamp; anything else gives null."""
    return F.try_to_timestamp(text, F.lit(ISO_Z))


def parse_lenient(text: Column, formats: list[str] = LENIENT_FORMATS) -> Column:
    """First of ``formats`` that fits, else null."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])


def render(ts: Column, fmt: str = PLAIN_SECONDS) -> Column:
    """Timestamp as text, the form the stored tables use."""
    return F.date_format(ts, fmt)


def plus_days(ts: Column, days: Column | int) -> Column:
    days = F.lit(days) if isinstance(days, int) else days
    return ts + F.make_dt_interval(days=days)


def date_parts(ts: Column) -> list[Column]:
    """The calendar features ``day``, ``month``, ``year``."""
    return [
        F.dayofmonth(ts).alias("day"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
    ]
