"""Newest rows and the small reports over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest(df: DataFrame, ts: str, n: int, tie_break: list[str] | None = None) -> DataFrame:
    """The ``n`` newest rows, nulls first as PostgreSQL sorts them.

    Sort and limit in one step: each task keeps ``n`` rows, the driver merges them.
    """
    order = [F.desc_nulls_first(ts), *[F.desc_nulls_first(c) for c in tie_break or []]]
    return df.orderBy(*order).limit(n)
