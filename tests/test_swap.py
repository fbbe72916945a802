import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import swap, tables

D1, D2, D3 = (dt.date(2024, 1, n) for n in (1, 2, 3))


class Stopped(Exception):
    pass


def days(spark, values):
    return spark.createDataFrame(values, "id long, day date")


def failing(spark, values):
    return days(spark, values).withColumn("id", F.when(F.col("id") < 0, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")))


@pytest.fixture
def table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.overwrite(days(spark, [(1, D1), (2, D2), (3, None)]), path, "day")
    return path


def held(spark, path):
    return {(r.id, r.day) for r in tables.read(spark, path).collect()}


def no_remains(path):
    return not [n for folder in (path, os.path.dirname(path)) for n in os.listdir(folder) if n.startswith(swap.PREFIX)]


WRITERS = {
    "table": lambda spark, df, path: tables.overwrite(df, path, "day"),
    "day": lambda spark, df, path: tables.replace_partition(df, path, "day", D2),
    "days": lambda spark, df, path: tables.replace_partitions(df, path, "day", [D1, D2]),
}


@pytest.mark.parametrize("kind", WRITERS)
def test_a_write_that_fails_half_way_changes_nothing(spark, table, kind):
    before = held(spark, table)
    rows = failing(spark, [(n, D2) for n in range(50)] + [(-1, D2)]).repartition(4)
    with pytest.raises(Exception, match="stop"):
        WRITERS[kind](spark, rows, table)
    assert held(spark, table) == before
    WRITERS[kind](spark, days(spark, [(9, D2)]), table)
    assert (9, D2) in held(spark, table) and no_remains(table)


@pytest.mark.parametrize("kind", WRITERS)
@pytest.mark.parametrize("moves", range(6))
def test_an_exchange_that_stops_is_finished_by_the_next_reader(spark, table, kind, moves, monkeypatch):
    expected = {"table": {(9, D2)}, "day": {(1, D1), (9, D2), (3, None)}, "days": {(9, D2), (3, None)}}[kind]
    before, done, move = held(spark, table), [], swap.Files.move

    def stopping(files, source, target):
        if len(done) == moves:
            raise Stopped
        done.append(move(files, source, target))

    monkeypatch.setattr(swap.Files, "move", stopping)
    try:
        WRITERS[kind](spark, days(spark, [(9, D2)]), table)
        stopped = False
    except Stopped:
        stopped = True
    monkeypatch.undo()
    # the first move puts the journal in its place
    assert held(spark, table) == (before if stopped and moves == 0 else expected)
    if moves:
        assert no_remains(table)


def test_new_files_are_read_before_the_exchange(spark, table, monkeypatch):
    before, check = held(spark, table), swap.check

    def damaged(session, path):
        name = next(os.path.join(folder, n) for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet"))
        with open(name, "r+b") as file:
            file.truncate(20)
        for crc in [os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")]:
            os.remove(crc)
        return check(session, path)

    monkeypatch.setattr(swap, "check", damaged)
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        tables.replace_partition(days(spark, [(9, D2)]), table, "day", D2)
    monkeypatch.undo()
    assert held(spark, table) == before


def test_days_without_rows_and_rows_without_a_day(spark, table):
    tables.replace_partitions(days(spark, []), table, "day", [None, D3])
    assert held(spark, table) == {(1, D1), (2, D2)}
    tables.replace_partitions(days(spark, [(4, None)]), table, "day", [None, D1])
    assert held(spark, table) == {(2, D2), (4, None)}
    tables.replace_partitions(days(spark, []), table, "day")
    assert held(spark, table) == set() and tables.read(spark, table).columns == ["id", "day"]


def test_a_plan_may_read_what_it_replaces(spark, table):
    tables.replace_partitions(tables.read(spark, table).withColumn("id", F.col("id") + 10), table, "day", [D1, D2])
    assert held(spark, table) == {(11, D1), (12, D2), (13, None)}


def files(path):
    return {os.path.relpath(os.path.join(folder, n), path): open(os.path.join(folder, n), "rb").read()
            for folder, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


@pytest.mark.parametrize("partition_by", [None, "day"])
def test_a_delete_leaves_other_files_as_they_are(spark, tmp_path, partition_by):
    path = f"{tmp_path}/facts"
    rows = spark.range(0, 400, 1, 8).select("id", (F.col("id") / 50).cast("int").alias("day"), F.lit("x").alias("note"))
    (rows.write.partitionBy("day") if partition_by else rows.write).parquet(path)
    before = files(path)
    keys = spark.createDataFrame([(60,), (61,), (61,), (None,), (9999,)], "id long")
    assert tables.delete_using(spark, path, keys, "id", partition_by) == 1
    after = files(path)
    assert sorted(r.id for r in tables.read(spark, path).collect()) == [n for n in range(400) if n not in (60, 61)]
    same = {n for n in before if after.get(n) == before[n]}
    assert len(same) == len(before) - 1 and no_remains(path)
    assert tables.delete_using(spark, path, keys, "id", partition_by) == 0
    assert files(path) == after


def test_a_delete_of_all_rows_of_a_file(spark, tmp_path):
    path = f"{tmp_path}/facts"
    spark.range(0, 40, 1, 4).write.parquet(path)
    tables.delete_using(spark, path, spark.range(10, 20), "id")
    assert tables.read(spark, path).count() == 30


def test_the_search_for_files_reads_keys_alone(spark, tmp_path, plan_of):
    path = f"{tmp_path}/facts"
    spark.range(40).select("id", F.lit("x").alias("note")).write.parquet(path)
    place = tables.matched_files(tables.read(spark, path), spark.range(3), "id")
    assert "ReadSchema: struct<id:bigint>" in plan_of(place)
