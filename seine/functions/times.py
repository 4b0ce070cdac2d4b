"""Times from text and numbers; intervals; clamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first(text: Column, formats: tuple[str, ...]) -> Column:
    return F.coalesce(*(F.try_to_timestamp(text, F.lit(f)) for f in formats))


def rfc3339(text: Column) -> Column:
    return F.coalesce(F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"), text.try_cast("timestamp")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def typed_time(text: Column, kind: Column, form: str) -> Column:
    """Milliseconds or seconds of numbers, a date or RFC 3339 of strings; null for the wrong kind."""
    number = F.when(kind == "number", text.try_cast("double").cast("long"))
    string = F.when(kind == "string", text)
    return {"unix_ms": F.timestamp_millis(number), "unix_s": F.timestamp_seconds(number), "date": F.try_to_timestamp(string, F.lit("yyyy-MM-dd"))}.get(form, rfc3339(string))


def any_time(text: Column) -> Column:
    """The first of five layouts that fits."""
    return F.coalesce(rfc3339(text), _first(text, ("yyyy-MM-dd", "MMMM d, yyyy")))


def plus_hours(at: Column, hours: int) -> Column:
    return at + F.make_dt_interval(hours=F.lit(hours))


def clamp_ttl(seconds: Column) -> Column:
    return F.greatest(F.lit(60), F.least(F.lit(300), seconds))


def run_id(at: Column) -> Column:
    return F.date_format(at, "yyyyMMdd_HHmmss")


def rate(done: Column, seconds: Column) -> Column:
    return done / F.nullif(seconds, F.lit(0))
