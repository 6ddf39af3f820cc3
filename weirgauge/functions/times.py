"""Rendering times inside the engine, where the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def iso_millis(moment: Column) -> Column:
    return F.date_format(moment, ISO_MILLIS)


def parse_moment(text: Column) -> Column:
    """Timestamp from ISO text, NULL when it is not one."""
    return text.cast("string").try_cast("timestamp")


def clock(moment: Column, missing: str = "Unavailable") -> Column:
    return F.coalesce(F.date_format(moment, "HH:mm:ss"), F.lit(missing))
