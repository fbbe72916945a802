"""Table maintenance over Parquet folders.

A table is a folder; a daily table is partitioned by one column. Spark has no
row-level delete on Parquet, so each operation exchanges folders, or the files
that hold a matching row. New files are complete before old ones go, see
:mod:`ledgerloom.operators.swap`: a plan may read what it replaces, and a write
that fails leaves the table as it was.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import swap
from ledgerloom.session import scratch_path


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # the folder of rows without a day


def _dealt(df: DataFrame, partition_by: str | None) -> DataFrame:
    """One partition column gets rebalanced first: few files per folder, and a
    folder with many rows is split over several tasks by adaptive execution."""
    return df if partition_by is None else df.hint("rebalance", partition_by)


def _writer(df: DataFrame, partition_by: str | None) -> DataFrameWriter:
    writer = _dealt(df, partition_by).write
    return writer if partition_by is None else writer.partitionBy(partition_by)


def overwrite(
    df: DataFrame, path: str, partition_by: str | tuple[str, ...] | None = None, dealt: bool = True
) -> None:
    """Truncate and full reload; the plan may read the table itself.

    Of several partition columns the first one deals the rows to the tasks. Not
    ``dealt``, each task writes the rows it has, a file for each of their
    folders: no shuffle, and as many files in a folder as there are tasks.
    """
    columns = (partition_by,) if isinstance(partition_by, str) else partition_by or ()
    exchange, name = swap.of_table(df.sparkSession, path)
    rows = _dealt(df, columns[0] if columns and dealt else None)
    swap.write_checked(rows, f"{exchange.new}/{name}", columns)
    exchange.commit(put=[name])


def append(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    _writer(df, partition_by).mode("append").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    swap.settle(spark, path)
    return swap.Files(spark, path).exists(path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    return swap.Files(spark, path).names(path)


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """An empty table where there is none; True when it was created.

    For tables without partitions: a partitioned one begins with its first day.
    """
    if exists(spark, path):
        return False
    overwrite(spark.createDataFrame([], schema), path)
    return True


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """With a schema, columns that older files lack read as null."""
    swap.settle(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def add_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` that the frame lacks, as nulls at the end."""
    missing = [f for f in schema if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def without_conflicts(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The incoming rows that an insert ignoring conflicts would add.

    One row per key, and none whose key the target holds. A null key conflicts
    with nothing. The duplicates collapse before the join, so a hot key reaches
    it as one row.
    """
    keyed = incoming.where(F.col(key).isNotNull()).dropDuplicates([key])
    held = target.select(key).where(F.col(key).isNotNull())
    fresh = keyed.join(held, key, "left_anti").select(*incoming.columns)
    return fresh.unionByName(incoming.where(F.col(key).isNull()))


def insert_ignore(spark: SparkSession, path: str, incoming: DataFrame, key: str) -> None:
    target = read(spark, path)
    append(without_conflicts(target, incoming, key).select(*target.columns), path)


def _folder(column: str, value: object) -> str:
    return f"{column}={NO_VALUE if value is None else value}"


def replace_partition(df: DataFrame, path: str, column: str, value: object) -> None:
    """Delete-then-insert of one day as one exchange of that day's folder.

    The folder is written even when ``df`` is empty, so that the table keeps its
    columns when all its days are cleared.
    """
    exchange, name = swap.of_entries(df.sparkSession, path), _folder(column, value)
    swap.write_checked(df.drop(column), f"{exchange.new}/{name}")
    exchange.commit(put=[name])


def replace_partitions(df: DataFrame, path: str, column: str, values: list | None = None) -> None:
    """Delete-then-insert of several days as one exchange.

    Days of ``values`` without rows are cleared, None among them being the rows
    without a day; without ``values`` all days are. The plan may read the table.
    """
    spark = df.sparkSession
    exchange = swap.of_entries(spark, path)
    swap.write_checked(_dealt(df, column), exchange.new, (column,))
    written = [n for n in children(spark, exchange.new) if n.startswith(f"{column}=")]
    held = [n for n in children(spark, path) if n.startswith(f"{column}=")]
    named = held if values is None else [_folder(column, v) for v in values]
    cleared = sorted(set(held) & set(named) - set(written))
    if cleared and not written and set(held) <= set(cleared):
        # the last day stays as a folder without rows, which keeps the columns
        empty = spark.createDataFrame([], T.StructType([f for f in df.schema if f.name != column]))
        swap.write_checked(empty, f"{exchange.new}/{cleared[0]}")
        written = [cleared.pop(0)]
    exchange.commit(put=written, drop=cleared)


def clear_partition(spark: SparkSession, path: str, column: str, value: object) -> None:
    """Delete one day."""
    schema = T.StructType([f for f in read(spark, path).schema if f.name != column])
    replace_partition(spark.createDataFrame([], schema), path, column, value)


def stored(df: DataFrame, label: str = "step") -> DataFrame:
    """The frame written to the shared folder and read back.

    For a frame that several steps read: it is computed once, its size is known
    to the joins that follow, and a lost executor costs no recomputation of what
    came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=swap.CODEC)
    return read(df.sparkSession, path, df.schema)


def rewrite(kept: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite a table with a plan that reads the same table: its files go when the new ones are there."""
    overwrite(kept, path, partition_by)


def delete_matching(facts: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Facts without the rows whose key is among ``keys`` (a delete through a join)."""
    return facts.join(keys.select(on).distinct(), on, "left_anti").select(*facts.columns)


def matched_files(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """(file) of a stored table that holds a key of ``keys``."""
    return table.select(on, F.col("_metadata.file_path").alias("file")).join(keys, on, "left_semi").select("file").distinct()


def delete_using(spark: SparkSession, path: str, keys: DataFrame, on: str, partition_by: str | None = None) -> int:
    """Delete the stored rows whose key is among ``keys``; the number of files that were written anew.

    A first join reads the keys and the names of the files alone. Only files
    that hold a matching row are read whole and replaced, the others stay as
    they are, byte for byte.
    """
    table = read(spark, path)
    wanted = stored(keys.select(on).distinct(), "keys")
    # as many names as there are files with a match; the scan's own list of files is longer
    touched = [unquote(r[0]) for r in matched_files(table, wanted, on).collect()]
    if not touched:
        return 0
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*touched)
    _exchange_files(delete_matching(rows, wanted, on), path, touched, partition_by)
    return len(touched)


def update_using(
    spark: SparkSession, path: str, changes: DataFrame, on: str, value: str, partition_by: str | None = None
) -> int:
    """Where ``on`` is a key of ``changes`` it becomes that row's ``value``; the number of files that were written anew.

    Keys of ``changes`` are unique. As in ``delete_using`` only files with a
    matching row are read whole and replaced.
    """
    table = read(spark, path)
    wanted = stored(changes.select(on, value), "changes")
    touched = [unquote(r[0]) for r in matched_files(table, wanted, on).collect()]
    if not touched:
        return 0
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(*touched)
    new = F.coalesce(value, on).cast(table.schema[on].dataType).alias(on)
    moved = rows.join(wanted, on, "left").select(*[new if c == on else F.col(c) for c in table.columns])
    _exchange_files(moved, path, touched, partition_by)
    return len(touched)


def _exchange_files(rows: DataFrame, path: str, touched: list[str], partition_by: str | None) -> None:
    """Put ``rows`` in the place of the files ``touched``."""
    spark = rows.sparkSession
    exchange = swap.of_entries(spark, path)
    columns = () if partition_by is None else (partition_by,)
    swap.write_checked(_dealt(rows, partition_by), exchange.new, columns)
    folders = [f"{n}/" for n in children(spark, exchange.new) if "=" in n] if columns else [""]
    put = [f"{folder}{n}" for folder in folders for n in children(spark, f"{exchange.new}/{folder}") if n.endswith(".parquet")]
    depth = len(columns) + 1  # a file's name, and the folder it is in
    exchange.commit(put=put, drop=["/".join(f.split("/")[-depth:]) for f in touched])
