"""Quality checks: what a database would enforce, as reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import iso_timestamp

INVALID_AMOUNT = "INVALID_AMOUNT"


UNDATED = "MISSING_TIMESTAMP"


def row_json(df: DataFrame, without: tuple[str, ...] = ()):
    """The row as JSON with nulls kept and timestamps in ISO form."""
    fields = [
        iso_timestamp(name).alias(name) if kind.startswith("timestamp") else F.col(name)
        for name, kind in df.dtypes if name not in without
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def invalid_amounts(facts: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows for amounts of zero or less; a null amount is not selected.

    ``also`` names columns that stay beside the payload and out of it.
    """
    return facts.where(F.col("base_amount") <= 0).select(
        "source_system", row_json(facts, also).alias("raw_payload"),
        F.lit(INVALID_AMOUNT).alias("error_type"), *also,
    )


def undated(facts: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Quarantine rows for facts whose event had no readable timestamp."""
    return facts.where(F.col("trans_timestamp").isNull()).select(
        "source_system", row_json(facts, also).alias("raw_payload"), F.lit(UNDATED).alias("error_type"), *also,
    )


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """``(table_name, column_name, null_rows)`` for each column, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
    return counts.select(F.explode(F.array(*pairs)).alias("_n")).select(
        F.lit(table).alias("table_name"), "_n.column_name", "_n.null_rows"
    )


def assert_no_nulls(reports: list[DataFrame]) -> DataFrame:
    """One row ``passed = true``, or a failing job when any report counts a null."""
    total = reduce(DataFrame.unionByName, reports).agg(F.sum("null_rows").alias("null_rows"))
    failed = F.raise_error(F.concat(F.lit("rows without a key: "), F.col("null_rows").cast("string")))
    return total.select(
        F.when(F.col("null_rows") > 0, failed.cast("boolean")).otherwise(F.lit(True)).alias("passed")
    )


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that break a not-null rule, with the first column that breaks it."""
    broken = F.coalesce(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.withColumn("missing_column", broken).where(F.col("missing_column").isNotNull())


def orphan_keys(facts: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    """``(key_value, fact_rows)`` of fact keys the dimension lacks.

    The facts are counted per key before the join, so a hot key crosses the
    shuffle once per task. A null key breaks no foreign key.
    """
    used = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return used.join(dim.select(key), key, "left_anti").select(
        F.col(key).cast("string").alias("key_value"), "fact_rows"
    )


def foreign_key_report(facts: DataFrame, table: str, dims: dict[str, DataFrame]) -> DataFrame:
    """Orphans of every foreign key of a fact table."""
    reports = [
        orphan_keys(facts, key, dim).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("column_name"),
            "key_value", "fact_rows",
        )
        for key, dim in dims.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """``(key_value, copies)`` of key values held more than once, nulls left out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
        .select(F.col(key).cast("string").alias("key_value"), "copies")
    )


def constraint_report(
    held: dict[str, DataFrame], required: dict[str, tuple[str, ...]], unique: dict[str, tuple[str, ...]],
    foreign: dict[str, dict[str, str]],
) -> DataFrame:
    """``(table_name, column_name, rule, broken_rows)`` of every constraint whose tables are in ``held``."""
    reports = []

    def add(table: str, column: str, rule: str, count: DataFrame) -> None:
        reports.append(count.select(
            F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), F.lit(rule).alias("rule"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("broken_rows")))

    for table, columns in required.items():
        if table in held:
            reports.append(null_counts(held[table], table, list(columns)).select(
                "table_name", "column_name", F.lit("required").alias("rule"), F.col("null_rows").alias("broken_rows")))
    for table, columns in unique.items():
        for column in columns if table in held else ():
            copies = duplicates(held[table], column)
            add(table, column, "unique", copies.agg(F.sum(F.col("copies") - 1).alias("n")))
    for table, keys in foreign.items():
        for column, other in keys.items() if table in held else ():
            if other in held:
                orphans = orphan_keys(held[table], column, held[other].select(F.col(column)))
                add(table, column, "foreign key", orphans.agg(F.sum("fact_rows").alias("n")))
    return reduce(DataFrame.unionByName, reports)
