"""Calendar columns and day filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

NAME_WIDTH = 9  # fixed value: names are blank-padded to nine characters


def padded_day_name(day: str | Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def padded_month_name(day: str | Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def weekend_text(day: str | Column) -> Column:
    """``'true'`` on ISO weekdays 6 and 7, as text."""
    iso_weekday = F.weekday(day) + 1
    return F.when(iso_weekday.isin(6, 7), "true").otherwise("false")


def on_day(ts: str | Column, ds: str | dt.date) -> Column:
    """Rows of one day as a half-open range, so that the scan can prune on it."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    start = ds if isinstance(ds, dt.date) else dt.date.fromisoformat(ds)
    end = start + dt.timedelta(days=1)
    return (ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp"))
