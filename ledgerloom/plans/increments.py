"""Views from stored sums by day, of which only those of changed days are made again.

A view's first aggregation, sums per day and surrogate keys, is kept as a table
in folders of ``PERIOD`` days. When days of the fact change, the sums of these
days are made again from the fact; the other days of their folders are carried
over. So a view reads sums and no facts, and a day is counted once however
often it is refreshed.

Which days changed is a table too: a load names its days before it writes them
and they are struck off after the sums are written, so a job that stops in
between leaves days that the next refresh takes up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import tables

PERIOD = 32  # days of one folder
_FOLDER = "period"
Sums = Callable[[DataFrame], DataFrame]


def _with_period(sums: DataFrame) -> DataFrame:
    return sums.withColumn(_FOLDER, F.floor(F.col("time_key") / PERIOD).cast("int"))


def build(facts: DataFrame, sums: Sums, path: str) -> None:
    """The sums of all days; without any, a folder without rows keeps the columns."""
    rows = tables.stored(_with_period(sums(facts)), "sums")
    if not rows.isEmpty():
        tables.overwrite(rows, path, _FOLDER)
    elif tables.exists(facts.sparkSession, path):
        tables.replace_partitions(rows, path, _FOLDER)
    else:
        tables.replace_partition(rows, path, _FOLDER, 0)


def refresh(facts: DataFrame, sums: Sums, path: str, days: Iterable[int]) -> None:
    """The sums of ``days`` (values of ``time_key``) again; a day without facts has none.

    Reads the facts of these days and the folders they are in. There are as many
    days as the calendar has at most.
    """
    days = sorted(set(days))
    if not days:
        return
    periods = sorted({d // PERIOD for d in days})
    changed = F.col("time_key").isin(days)
    held = tables.read(facts.sparkSession, path)
    kept = held.where(F.col(_FOLDER).isin(periods) & ~changed)
    new = _with_period(sums(facts.where(changed))).select(*held.columns)
    tables.replace_partitions(kept.unionByName(new), path, _FOLDER, periods)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The sums of all days."""
    return tables.read(spark, path).drop(_FOLDER)


class ChangedDays:
    """(view, time_key) of the days whose sums are behind their facts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def held(self) -> DataFrame:
        schema = "view string, time_key bigint"
        if not tables.exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return tables.read(self.spark, self.path, schema)

    def add(self, view: str, days: Iterable[int]) -> None:
        rows = self.spark.createDataFrame([(view, int(d)) for d in days], "view string, time_key bigint")
        tables.append(rows.coalesce(1), self.path)

    def of(self, view: str) -> list[int]:
        return [r[0] for r in self.held().where(F.col("view") == view).select("time_key").distinct().collect()]

    def strike(self, view: str) -> None:
        tables.rewrite(self.held().where(F.col("view") != view).coalesce(1), self.path)
