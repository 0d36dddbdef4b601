"""Date and time decoding for change-event payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.functions.json_fns import path


def epoch() -> Column:
    """1970-01-01, the origin of epoch-day payload dates."""
    return F.lit("1970-01-01").cast("date")


def epoch_day_to_date(days: Column) -> Column:
    return F.date_add(epoch(), days.cast("int"))


def variant_date(v: Column, json_path: str) -> Column:
    """A payload date sent as epoch days (connector default) or as ISO text."""
    as_days = path(v, json_path, "int")
    as_text = F.try_to_date(path(v, json_path, "string"))
    return F.coalesce(epoch_day_to_date(as_days), as_text)


def variant_timestamp(v: Column, json_path: str) -> Column:
    """ISO-8601 text with zone -> UTC timestamp (naive text is taken as UTC)."""
    return F.try_to_timestamp(path(v, json_path, "string"))


def iso_utc_text(ts: Column) -> Column:
    """Timestamp -> ``YYYY-MM-DDTHH:MM:SSZ`` text as a connector emits it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
