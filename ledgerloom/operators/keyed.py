"""Tables kept by key: bucketed and sorted files, so that what is held is not shuffled again.

An insert that ignores conflicts, a delete and a check of uniqueness all compare
rows by key. Over a plain folder each of them shuffles every key that the table
holds. Here the table is dealt into buckets once, when it is written; an insert
shuffles the incoming rows only, into the same buckets, and a count by key
shuffles nothing. While a bucket is a single file its order holds as well, and
the held side is not sorted either; ``pack`` makes it one file again after
inserts.

The folder is the table. A session's catalogue holds its name and buckets, and
``attach`` gives them to another session.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


@dataclass(frozen=True)
class KeyedTable:
    """``name`` in the catalogue of the session, files at ``path`` in ``buckets`` buckets of ``key``."""

    name: str
    path: str
    key: str
    buckets: int

    def rows(self, spark: SparkSession) -> DataFrame:
        spark.conf.set(ORDERED_SCAN, "true")  # Spark trusts the order only of buckets with one file
        return spark.table(self.name)


def _name() -> str:
    return f"keyed_{uuid.uuid4().hex}"


def _dealt(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """One task for each bucket, dealt by the hash that buckets go by."""
    return rows.repartition(buckets, key)


def _write(rows: DataFrame, table: KeyedTable, mode: str) -> None:
    """``rows`` are dealt by the key, so that each bucket gets one file."""
    (rows.write.format("parquet").mode(mode).bucketBy(table.buckets, table.key).sortBy(table.key)
     .option("path", table.path).saveAsTable(table.name))


def create(rows: DataFrame, path: str, key: str, buckets: int | None = None) -> KeyedTable:
    """``rows`` as a new keyed table at ``path``, where nothing is yet.

    By default there are as many buckets as shuffle partitions. With fewer ones
    Spark would rather have more tasks and shuffles the held rows as well; with
    more the incoming rows are dealt a second time. Rows with a null key share a
    bucket.
    """
    spark = rows.sparkSession
    table = KeyedTable(_name(), path, key, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    _write(_dealt(rows, key, table.buckets), table, "errorifexists")
    return table


def attach(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> KeyedTable:
    """The keyed table that an earlier session wrote to ``path``, with the columns and buckets it was made with."""
    table = KeyedTable(_name(), path, key, buckets)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(f"CREATE TABLE {table.name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return table


def conflict_free(table: KeyedTable, incoming: DataFrame) -> DataFrame:
    """The incoming rows that an insert ignoring conflicts would add, dealt into the buckets of ``table``.

    One row for each key, and none whose key the table holds; a null key
    conflicts with nothing. Repeated keys collapse within their tasks first, so
    a hot key crosses the shuffle once for each task.
    """
    key, held = table.key, table.rows(incoming.sparkSession)
    others = [F.first(F.struct(*[c for c in incoming.columns if c != key])).alias("_others")]
    alone = incoming.columns == [key]
    keyed = incoming.where(F.col(key).isNotNull())
    once = keyed.dropDuplicates([key]) if alone else keyed.groupBy(key).agg(*others).select(key, "_others.*")
    if table.buckets != int(incoming.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        once = _dealt(once, key, table.buckets)  # otherwise the exchange of the grouping deals them
    fresh = once.join(held.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return fresh.select(*incoming.columns).unionByName(incoming.where(F.col(key).isNull()))


def insert_ignore(table: KeyedTable, incoming: DataFrame) -> None:
    """Add the rows without a conflict. A repeated insert of the same keys adds nothing."""
    columns = table.rows(incoming.sparkSession).columns
    _write(_dealt(conflict_free(table, incoming).select(*columns), table.key, table.buckets), table, "append")


def pack(spark: SparkSession, table: KeyedTable, path: str) -> KeyedTable:
    """The table at a new ``path`` with one file for each bucket; the old files stay."""
    # read as plain files: of a bucketed scan Spark would drop the exchange, and then the buckets with it
    return create(spark.read.parquet(table.path), path, table.key, table.buckets)
