"""Batch and streaming scans.

Kafka and JDBC need their connector jars on the cluster; the functions only
assemble the reader, so the same plans run over files without them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import schemas
from ledgerloom.operators.swap import settle

# Fixed values of the event feed.
TOPIC = "realtime_transactions"
STARTING_OFFSETS = "latest"
JDBC_BATCH_SIZE = 500


def kafka_options(servers: str, topic: str = TOPIC, **more: str) -> dict[str, str]:
    """Offsets apply to the first start only; later starts resume from the checkpoint."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": STARTING_OFFSETS,
        **more,
    }


def kafka_events(spark: SparkSession, servers: str, topic: str = TOPIC, **more: str) -> DataFrame:
    """Raw events as a ``value`` column. ``maxOffsetsPerTrigger`` and
    ``minPartitions`` bound and spread a batch."""
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topic, **more))
    return reader.load().selectExpr("CAST(value AS STRING) AS value")


def file_events(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same raw events from a folder of JSON lines, one text line per event."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def jdbc_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    lower: str | None = None,
    upper: str | None = None,
    partitions: int | None = None,
    **more: str,
) -> dict[str, str]:
    """With a partition column the scan runs as ``partitions`` range queries."""
    options = {"url": url, "dbtable": table, "batchsize": str(JDBC_BATCH_SIZE), **more}
    if partition_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a partitioned scan needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def jdbc_append(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()


def declared_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The declared columns of the table in ``root/<table>``.

    Columns added to the declaration later read as null from older files, and
    columns that only name sub-folders are left out.
    """
    declared = schemas.struct_of(table)
    path = f"{root.rstrip('/')}/{table}"
    settle(spark, path)
    rows = spark.read.schema(declared).parquet(path)
    return rows.select(*declared.names)
