"""Loading a folder of delimited files, one sub-folder or file per table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.text import normalise_headers
from ledgerloom.operators import tables
from ledgerloom.streaming.landing import reload_landed

# Tables whose header is replaced by position.
POSITIONAL = {
    "ewallet.balance": [
        "account_id", "current_balance", "available_balance", "frozen_amount", "last_updated",
    ],
}
SKIPPED = "README"
REJECTS = "public.load_rejects"
MALFORMED, BAD_CELL = "MALFORMED_RECORD", "BAD_CELL"
CORRUPT, FILE, PLACE = MARKS = ("_corrupt_record", "_file", "_place")
LANDING_TABLE = "public.realtime_transactions"
_BLANK_HEADER = re.compile(r"_c\d+")  # what the CSV reader calls a blank header


def tidy(df: DataFrame, table: str) -> DataFrame:
    """Rows that hold a value, under clean column names, without unnamed columns; ``MARKS`` stay as they are."""
    marks = [c for c in MARKS if c in df.columns]
    given = [c for c in df.columns if c not in marks]
    rows = df.dropna(how="all", subset=given)
    if table in POSITIONAL:
        names = POSITIONAL[table]
        named = given[: len(names)]
    else:
        named = [c for c in given if c.strip() and not _BLANK_HEADER.fullmatch(c)]
        names = normalise_headers(named)
    return rows.select(*[F.col(f"`{c}`") for c in [*named, *marks]]).toDF(*names[: len(named)], *marks)


def read_table(spark: SparkSession, path: str, table: str, kind: str = "csv", multi_line: bool = True) -> DataFrame:
    """The rows of a path's files, under clean names, with ``MARKS``.

    In delimited files a quoted cell may hold the delimiter, doubled quotes and
    line breaks. A file with line breaks in cells cannot be split, so it is read
    by one task; ``multi_line=False`` lets tasks share files that have none.
    """
    reader = spark.read
    if kind == "csv":
        reader = reader.options(header=True, quote='"', escape='"', multiLine=multi_line)
        names = reader.csv(path).columns
        # with a schema of its own, a record with too many or too few cells is told apart
        fields = [T.StructField(n, T.StringType()) for n in [*names, CORRUPT]]
        reader = reader.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.format(kind).load(path)
    if kind != "csv":
        rows = rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    rows = rows.withColumns({FILE: F.col("_metadata.file_path"), PLACE: F.monotonically_increasing_id()})
    return tidy(tables.stored(rows, "files"), table)


def _bad_cells(rows: DataFrame, table: str) -> Column:
    """(column_name, cell) of the cells that their declared type cannot take."""
    found = [F.lit(None).cast("struct<column_name:string,cell:string>")]
    for field in schemas.struct_of(table) if table in schemas.TABLES else ():
        if field.name in rows.columns and not isinstance(field.dataType, T.StringType):
            cell = F.col(f"`{field.name}`")
            unread = cell.isNotNull() & cell.try_cast(field.dataType).isNull()
            found.append(F.when(unread, F.struct(F.lit(field.name).alias("column_name"), cell.cast("string").alias("cell"))))
    return F.filter(F.array(*found), lambda c: c.isNotNull())


def accepted(rows: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Rows that the declared types can take, and the rejects: one for each bad cell or malformed record."""
    judged = rows.withColumn("_bad", _bad_cells(rows, table))
    good = F.col(CORRUPT).isNull() & (F.size("_bad") == 0)
    first = rows.groupBy(F.col(FILE).alias("_of")).agg(F.min(PLACE).alias("_first"))
    broken = judged.where(~good).join(first, F.col(FILE) == F.col("_of"))
    record = F.when(F.col(CORRUPT).isNotNull(), F.array(F.struct(
        F.lit(None).cast("string").alias("column_name"), F.col(CORRUPT).alias("cell"))))
    rejects = broken.select(
        F.lit(table).alias("table_name"), F.col(FILE).alias("file_name"),
        (F.col(PLACE) - F.col("_first") + 1).alias("row_number"),
        F.when(F.col(CORRUPT).isNotNull(), MALFORMED).otherwise(BAD_CELL).alias("reason"),
        F.explode(F.coalesce(record, F.col("_bad"))).alias("_c"),
    ).select("table_name", "file_name", "row_number", "reason", "_c.column_name", "_c.cell")
    return judged.where(good).drop("_bad", *MARKS), rejects


def load_folder(
    spark: SparkSession, paths: dict[str, str], target: str, kind: str = "csv", multi_line: bool = True
) -> list[str]:
    """Truncate and reload ``target/<table>`` for every named path; the tables loaded.

    Names that contain README and tables without data rows are skipped. A table
    with a declaration gets its declared columns, types and defaults. Rows with
    a cell that its type cannot take, and malformed records, go to the table of
    rejects with file, row and text; the other rows load.
    """
    loaded = []
    for table, path in paths.items():
        if SKIPPED in table.upper():
            continue
        rows, rejects = accepted(read_table(spark, path, table, kind, multi_line), table)
        held = f"{target.rstrip('/')}/{REJECTS}"
        if tables.exists(spark, held) or not rejects.isEmpty():
            tables.replace_partitions(rejects, held, "table_name", [table])
        if rows.isEmpty():
            continue
        if table in schemas.TABLES:
            rows = schemas.conform(rows, table)
        path = f"{target.rstrip('/')}/{table}"
        if table == LANDING_TABLE:
            reload_landed(rows, path)
        else:
            tables.overwrite(rows, path)
        loaded.append(table)
    return loaded
