"""Landing of parsed events through ``foreachBatch``."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from ledgerloom import schemas
from ledgerloom.functions.dates import on_day
from ledgerloom.operators import swap, tables
from ledgerloom.sources.readers import jdbc_append
from ledgerloom.streaming.parse import judged_events, landing_rows, parse_events

Sink = Callable[[DataFrame, object], None]
MONTH_COLUMN = "event_month"
BATCH_COLUMN = "batch_id"
LOADED = "load-"  # begins the name of a batch that a file load puts into the table
PACKED = "packed-"  # begins the name of a batch that compaction has made
SMALL_BYTES = 32 << 20  # folders below it are packed
TARGET_BYTES = 128 << 20  # of a packed file


def month_of(day: Column) -> Column:
    return F.to_date(F.trunc(day, "month"))


def _dated(rows: DataFrame, batch: object) -> DataFrame:
    """The one layout of the table: folders by month of the event, and in each by batch."""
    rows = rows.withColumn(MONTH_COLUMN, month_of(F.to_date("timestamp")))
    return rows.withColumn(BATCH_COLUMN, F.lit(str(batch)))


def folder_sink(path: str) -> Sink:
    """Each batch owns its sub-folders, so a replayed batch replaces itself.

    The folders are by month of the event first. A daily job lists one month and
    skips, by the bounds of the timestamps in the files, the batches of other
    days; a backfill over years writes a folder for each month and not for each
    day. Events without a readable timestamp have a folder of their own.
    """

    def write(batch: DataFrame, batch_id: object) -> None:
        rows = _dated(batch, batch_id).hint("rebalance", MONTH_COLUMN)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH_COLUMN, BATCH_COLUMN).parquet(path, compression=swap.CODEC)

    return write


def reload_landed(rows: DataFrame, path: str) -> None:
    """Truncate and full reload of the landing table, in its layout.

    Every load is a batch of its own name, so a daily run sees that it is new.
    Each task writes the months of its own rows: a load has all events at once,
    and to shuffle them for fewer files costs more than it saves.
    """
    batch = f"{LOADED}{uuid.uuid4().hex}"
    tables.overwrite(_dated(rows, batch), path, (MONTH_COLUMN, BATCH_COLUMN), dealt=False)


def jdbc_sink(url: str, table: str, **options) -> Sink:
    """Append to a database table; a batch replayed after a crash is appended again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        jdbc_append(batch, url, table, **options)

    return write


def dead_letter_sink(path: str) -> Sink:
    """The texts of events that lost something on landing; a replayed batch replaces its own."""

    def write(batch: DataFrame, batch_id: object) -> None:
        rows = batch.where("reason IS NOT NULL").select("value", "reason", F.lit(str(batch_id)).alias(BATCH_COLUMN))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BATCH_COLUMN).parquet(path)

    return write


def dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """(value, reason, batch_id) of all dead letters; none where none was written."""
    schema = f"value string, reason string, {BATCH_COLUMN} string"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps with its checkpoint over restarts."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def to_sinks(*sinks: Sink, checkpoint: str | None = None) -> Sink:
    """Feed non-empty batches to every sink.

    Batch numbers begin at 0 in every query. With ``checkpoint`` a batch is named
    after its query and its number, so that a second query, or a new checkpoint,
    never replaces what another one has landed.

    With several sinks the batch is kept for their duration, so the source is
    read once. It is kept on disk alone: a batch may be a day's backlog with all
    its texts, which in memory would crowd out the writes. The emptiness test
    reads one row of a batch that is not kept.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if len(sinks) > 1:
            batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            if not batch.isEmpty():
                name: object = batch_id
                if checkpoint is not None:
                    name = f"{query_id(batch.sparkSession, checkpoint)}-{batch_id}"
                for sink in sinks:
                    sink(batch, name)
        finally:
            if len(sinks) > 1:
                batch.unpersist()

    return write


def _landing_part(sink: Sink) -> Sink:
    return lambda batch, name: sink(landing_rows(batch.drop("value", "reason")), name)


def start_landing(
    raw: DataFrame, checkpoint: str, *sinks: Sink, available_now: bool = False, dead: Sink | None = None
) -> StreamingQuery:
    """Parse and land a raw stream. Runs until stopped, or over what is there now.

    The checkpoint holds the offsets: a restarted query goes on where it ended.
    All events land, also those that cannot be read, as rows of nulls. With
    ``dead`` the texts of these are kept, from the same batch and the same parse.
    """
    if dead is None:
        rows = landing_rows(parse_events(raw))
    else:
        rows, sinks = judged_events(raw), (*[_landing_part(s) for s in sinks], dead)
    writer = rows.writeStream.foreachBatch(to_sinks(*sinks, checkpoint=checkpoint))
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_console(raw: DataFrame, checkpoint: str) -> StreamingQuery:
    """Print each batch, for a look at a new feed."""
    writer = parse_events(raw).writeStream.format("console").option("truncate", False)
    return writer.option("checkpointLocation", checkpoint).start()


def landed(spark: SparkSession, path: str, ds: str | None = None) -> DataFrame:
    """The landing table for batch jobs; only the month's folder, and in it the day, when ``ds`` is given.

    Spark would ignore files beside these folders without a word, so a table of
    another layout is refused.
    """
    declared = schemas.struct_of("public.realtime_transactions")
    rows = with_batches(spark, path)
    if ds is not None:
        rows = rows.where(in_months([ds])).where(on_day("timestamp", ds))
    return rows.select(*declared.names)


def in_months(days: list) -> Column:
    """The folders of these days; None stands for events without one."""
    months = sorted({f"{str(d)[:7]}-01" for d in days if d is not None})
    named = F.col(MONTH_COLUMN).isin([F.lit(m).cast("date") for m in months]) if months else F.lit(False)
    return named | F.col(MONTH_COLUMN).isNull() if None in days else named


def with_batches(spark: SparkSession, path: str) -> DataFrame:
    """The landing table with the month and the batch of each event."""
    declared = schemas.struct_of("public.realtime_transactions")
    swap.settle(spark, path)
    names = [n for n in tables.children(spark, path) if not n.startswith(("_", "."))]
    odd = [n for n in names if not n.startswith(f"{MONTH_COLUMN}=")]
    if odd:
        raise ValueError(f"{path} is not in folders by month: {odd[0]}")
    if not names:
        return spark.createDataFrame([], declared).withColumns(
            {MONTH_COLUMN: F.lit(None).cast("date"), BATCH_COLUMN: F.lit(None).cast("string")})
    return spark.read.schema(_layout()).parquet(path)


def _layout() -> T.StructType:
    declared = schemas.struct_of("public.realtime_transactions")
    return T.StructType([*declared, T.StructField(MONTH_COLUMN, T.DateType()), T.StructField(BATCH_COLUMN, T.StringType())])


def batch_folders(spark: SparkSession, path: str) -> DataFrame:
    """(event_month, batch_id, bytes) of the landing table's folders, from their listing; no file is opened."""
    swap.settle(spark, path)
    if not any(n.startswith(f"{MONTH_COLUMN}=") for n in tables.children(spark, path)):
        return spark.createDataFrame([], f"{MONTH_COLUMN} date, {BATCH_COLUMN} string, bytes long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.groupBy(F.col(MONTH_COLUMN).cast("date"), F.col(BATCH_COLUMN).cast("string")).agg(
        F.sum("length").alias("bytes"))


def replayable(folders: DataFrame) -> DataFrame:
    """(batch_id) of the newest landed batch of each streaming query: the only one it may write again."""
    own = folders.where(~F.col(BATCH_COLUMN).startswith(LOADED) & ~F.col(BATCH_COLUMN).startswith(PACKED))
    number = F.regexp_extract(BATCH_COLUMN, r"(\d+)$", 1).try_cast("long")
    query = F.regexp_replace(BATCH_COLUMN, r"\d+$", "")
    return own.groupBy(query.alias("query")).agg(F.max_by(BATCH_COLUMN, number).alias(BATCH_COLUMN)).select(BATCH_COLUMN)


def compact(
    spark: SparkSession, path: str, settled: DataFrame, small: int = SMALL_BYTES, target: int = TARGET_BYTES
) -> tuple[str, DataFrame] | None:
    """Pack small folders of a month into files of about ``target`` bytes; the new batch and the folders it replaces.

    ``settled`` names the (event_month, batch_id) that may go; of these the newest
    batch of a query stays, which a restart may replay: were it packed, its rows
    would be there twice. Folders are dealt into bins by a running sum of their
    sizes. One exchange puts the packed folders in the place of the others.
    """
    folders = tables.stored(batch_folders(spark, path), "folders")
    same = F.col("s.month").eqNullSafe(F.col(f"f.{MONTH_COLUMN}")) & (F.col("s.batch") == F.col(f"f.{BATCH_COLUMN}"))
    known = settled.select(F.col(MONTH_COLUMN).alias("month"), F.col(BATCH_COLUMN).alias("batch")).distinct()
    little = folders.alias("f").where(F.col("bytes") < small).join(known.alias("s"), same, "left_semi")
    little = little.join(replayable(folders), BATCH_COLUMN, "left_anti")
    by_batch = Window.partitionBy(MONTH_COLUMN).orderBy(BATCH_COLUMN)
    before = F.sum("bytes").over(by_batch) - F.col("bytes")
    bins = little.withColumn("bin", F.floor(before / target))
    bins = bins.withColumn("folders", F.count(F.lit(1)).over(Window.partitionBy(MONTH_COLUMN, "bin")))
    bins = tables.stored(bins.where("folders > 1").select(MONTH_COLUMN, BATCH_COLUMN, "bin"), "bins")
    members = [f"{MONTH_COLUMN}={r[0] or tables.NO_VALUE}/{BATCH_COLUMN}={r[1]}" for r in bins.collect()]
    if not members:
        return None
    name = f"{PACKED}{uuid.uuid4().hex}"
    rows = spark.read.schema(_layout()).option("basePath", path).parquet(*[f"{path}/{m}" for m in members])
    bin_of = bins.select(F.col(MONTH_COLUMN).alias("month"), F.col(BATCH_COLUMN).alias("batch"), "bin")
    same = F.col("month").eqNullSafe(F.col(MONTH_COLUMN)) & (F.col("batch") == F.col(BATCH_COLUMN))
    rows = rows.join(bin_of, same).repartition(MONTH_COLUMN, "bin").sortWithinPartitions(MONTH_COLUMN, "bin", "timestamp")
    exchange = swap.of_entries(spark, path)
    packed = rows.withColumn(BATCH_COLUMN, F.lit(name)).select(_layout().names)
    swap.write_checked(packed, exchange.new, (MONTH_COLUMN, BATCH_COLUMN))
    months = [n for n in tables.children(spark, exchange.new) if n.startswith(f"{MONTH_COLUMN}=")]
    exchange.commit(put=[f"{m}/{BATCH_COLUMN}={name}" for m in months], drop=members)
    return name, bins.select(MONTH_COLUMN, BATCH_COLUMN)
