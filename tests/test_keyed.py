import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import keyed, quality, tables

SHAPE = "k string, v long"


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def ids(spark, a, b):
    return spark.range(a, b).selectExpr("CAST(id AS STRING) AS k", "id AS v")



@pytest.mark.parametrize("buckets", [8, 16])
def test_only_incoming_rows_are_shuffled(spark, plan_of, no_broadcast, tmp_path, buckets):
    held = keyed.create(ids(spark, 0, 100), f"{tmp_path}/t", "k", buckets)
    incoming = ids(spark, 90, 120)
    for table in (held, keyed.pack(spark, held, f"{tmp_path}/packed")):
        plan = plan_of(keyed.conflict_free(table, incoming))
        incoming_side, held_side = plan[:plan.rindex("Range")], plan[plan.rindex("Range"):]
        assert "Bucketed: true" in held_side
        # one file for each bucket: neither shuffled nor sorted
        assert "Exchange" not in held_side and "Sort" not in held_side
        assert incoming_side.count("Exchange") == (1 if buckets == 8 else 2)
    assert "Exchange" not in plan_of(quality.duplicates(held.rows(spark), "k"))


@pytest.mark.parametrize("buckets", [8, 3])
def test_inserts_ignore_conflicts(spark, rows, tmp_path, buckets):
    start = spark.createDataFrame([("a", 1), (None, 2)], SHAPE)
    held = keyed.create(start, f"{tmp_path}/t", "k", buckets)
    incoming = spark.createDataFrame([("a", 9), ("b", 3), ("b", 3), (None, 4), (None, 5)], SHAPE)
    assert rows(keyed.conflict_free(held, incoming)) == rows(tables.without_conflicts(start, incoming, "k"))
    keyed.insert_ignore(held, incoming)
    keyed.insert_ignore(held, incoming.where("k IS NOT NULL"))
    expected = sorted([("a", 1), (None, 2), ("b", 3), (None, 4), (None, 5)], key=repr)
    packed = keyed.pack(spark, held, f"{tmp_path}/packed")
    again = keyed.attach(spark, packed.path, start.schema, "k", buckets)
    for table in (held, packed, again):
        assert rows(table.rows(spark)) == expected
    assert rows(quality.duplicates(again.rows(spark), "k")) == []
    assert len(list((tmp_path / "packed").glob("*.parquet"))) <= buckets


def test_one_key_holds_most_incoming_rows(spark, tmp_path):
    held = keyed.create(ids(spark, 0, 10), f"{tmp_path}/t", "k")
    hot = spark.range(30000).selectExpr("IF(id % 3 < 2, 'hot', CAST(id AS STRING)) AS k", "id % 2 AS v")
    keyed.insert_ignore(held, hot)
    found = held.rows(spark)
    assert found.where("k = 'hot'").count() == 1
    assert found.count() == found.select("k").distinct().count() == 10 + 1 + len([i for i in range(10, 30000) if i % 3 == 2])


def test_a_failed_insert_leaves_the_table(spark, rows, tmp_path):
    held = keyed.create(ids(spark, 0, 5), f"{tmp_path}/t", "k")
    before = rows(held.rows(spark))
    broken = ids(spark, 3, 9).withColumn(
        "v", F.when(F.col("v") == 8, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        keyed.insert_ignore(held, broken)
    assert rows(held.rows(spark)) == before
    keyed.insert_ignore(held, ids(spark, 3, 9))
    assert held.rows(spark).count() == 9


def test_an_empty_table(spark, rows, tmp_path):
    held = keyed.create(ids(spark, 0, 0), f"{tmp_path}/t", "k")
    keyed.insert_ignore(held, ids(spark, 0, 0))
    assert rows(held.rows(spark)) == []
    keyed.insert_ignore(held, ids(spark, 0, 2))
    assert rows(held.rows(spark)) == [("0", 0), ("1", 1)]
