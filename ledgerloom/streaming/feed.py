"""The live feed as state: the newest events, kept up batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.operators import tables
from ledgerloom.operators.topk import newest
from ledgerloom.plans.monitor import FEED_ROWS
from ledgerloom.streaming.landing import BATCH_COLUMN, Sink

EVENTS = "public.realtime_transactions"


def feed_sink(path: str, rows: int = FEED_ROWS, tie_break: tuple[str, ...] = ("event_id",)) -> Sink:
    """Keeps the ``rows`` newest events of all batches in one small table.

    A batch costs a scan of itself: each task hands on its newest rows, which meet
    the rows held so far. No landed event is read again. A replayed batch takes
    its own rows out first. What it pushed out the first time it would push out
    again, so the table is the same as if it had come once.
    """

    def write(batch: DataFrame, batch_id: object) -> None:
        spark, order = batch.sparkSession, list(tie_break)
        found = newest(batch, "timestamp", rows, order).withColumn(BATCH_COLUMN, F.lit(str(batch_id)))
        held = _held(spark, path).where(F.col(BATCH_COLUMN) != str(batch_id))
        tables.overwrite(newest(held.unionByName(found), "timestamp", rows, order).coalesce(1), path)

    return write


def _held(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*schemas.struct_of(EVENTS), T.StructField(BATCH_COLUMN, T.StringType())])
    return tables.read(spark, path, schema) if tables.exists(spark, path) else spark.createDataFrame([], schema)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The events that the feed holds."""
    return _held(spark, path).drop(BATCH_COLUMN)
