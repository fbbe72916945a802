"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.schemas import FIRST_SK

_NULL = "\\N"


def key_bucket(natural: list[str], hex_digits: int) -> Column:
    """Bucket of a natural key: the first hex digits of its MD5."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in natural]
    return F.substring(F.md5(F.concat_ws("|", *parts)), 1, hex_digits)


def assign_keys(
    df: DataFrame, key: str, natural: list[str], start: int = FIRST_SK, hex_digits: int = 3
) -> DataFrame:
    """Dense keys ``start, start+1, ..`` in the order (bucket, natural key).

    ``natural`` must identify a row. The numbering never sorts the whole frame
    in one task: rows are counted per hash bucket, the counts become bucket
    offsets, and each bucket numbers its own rows. Hashing a unique key spreads
    the rows evenly, and the order depends on the values only, so a recomputed
    partition after a lost executor gets the same keys again.

    The only broadcast is the offset table, at most ``16 ** hex_digits`` rows.
    ``df`` is read twice, once for its natural key alone; give a stored frame
    when it is costly to compute.
    """
    bucketed = df.withColumn("_bucket", key_bucket(natural, hex_digits))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in natural])
    return (
        bucketed.withColumn("_position", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_position") + (start - 1)).alias(key), *df.columns)
    )


def keys_after(dim: DataFrame, rows: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """Keys for ``rows`` that continue behind the highest key of ``dim``."""
    highest = dim.agg(F.greatest(F.coalesce(F.max(key), F.lit(0)), F.lit(FIRST_SK - 1))).scalar()
    return assign_keys(rows, key, natural, start=1).withColumn(key, F.col(key) + highest)


def extend_keys(
    dim: DataFrame, rows: DataFrame, key: str, natural: list[str], tie: list[str] | None = None,
    looser: list[list[str]] | None = None, keep: Callable[[DataFrame], DataFrame] = lambda df: df,
    used: DataFrame | None = None,
) -> DataFrame:
    """Keys kept for the members ``dim`` already has; only new members are numbered.

    ``natural`` names a member in ``dim`` and in ``rows``; null-safe equality
    lets a member with a null in it keep its number too. Members with the same
    natural key are told apart by their place among them, in order of the key in
    ``dim`` and of ``tie`` in ``rows``, so a repeated member never multiplies.
    Rows that are left are compared by each list of ``looser`` columns, where
    these are not null, with the members that are left. ``keep`` stores each
    step, which the next ones read. ``used`` holds keys of members that are gone, which
    are not given again.
    """
    tie = tie or []
    todo, known, kept = rows, dim, []
    for columns in [natural, *(looser or [])]:
        there = known.select(key, *[F.col(c).alias(f"_known_{c}") for c in columns])
        here, apart = todo, None
        if columns != natural:
            present = reduce(and_, [F.col(c).isNotNull() for c in columns])
            here, apart = todo.where(present), todo.where(~present)
        place = Window.partitionBy(*columns).orderBy(*[F.col(c).asc_nulls_first() for c in [*natural, *tie]])
        known_place = Window.partitionBy(*[f"_known_{c}" for c in columns]).orderBy(key)
        there = there.withColumn("_known_place", F.row_number().over(known_place))
        here = here.withColumn("_place", F.row_number().over(place))
        same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in columns]
        matched = keep(here.join(there, [*same, F.col("_place") == F.col("_known_place")], "left").select(
            key, *rows.columns))
        kept.append(matched.where(F.col(key).isNotNull()))
        todo = matched.where(F.col(key).isNull()).drop(key)
        if apart is not None:
            todo = todo.unionByName(apart)
        known = known.join(kept[-1].select(key), key, "left_anti")
    taken = dim.select(key) if used is None else dim.select(key).unionByName(used.select(key))
    return reduce(DataFrame.unionByName, [*kept, keys_after(taken, todo, key, [*natural, *tie])])


def serial_ids(df: DataFrame, key: str, start: int | Column = 1, tasks: int | None = None) -> DataFrame:
    """Unique but not dense row ids for append-only tables.

    A task owns 2**33 ids. With ``tasks`` the write fails when a task beyond
    that number gives ids, so that ids cannot run into another range.

    A dense number would cost a shuffle of the whole fact table and nothing
    reads one, so the ids follow partition and row position. Use it right
    before a write, because the numbers are fixed only by writing them.
    """
    ids = F.monotonically_increasing_id() + start
    if tasks is not None:
        beyond = F.raise_error(F.lit(f"more than {tasks} tasks write rows of one id range"))
        ids = F.when(F.spark_partition_id() < tasks, ids).otherwise(beyond.cast("bigint"))
    return df.select(ids.alias(key), *df.columns)
