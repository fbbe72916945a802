import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import (
    full_outer_on_key,
    left_lookup,
    member_lookup,
    natural_id,
    natural_id_bridge,
    with_constant_match,
)

KEYS = ["a", "b", "c", "d", "e", None, None]


def sides(spark, seed):
    rng = random.Random(seed)
    left = [(f"l{i}", rng.choice(KEYS)) for i in range(rng.randrange(0, 12))]
    right = [(f"r{i}", rng.choice(KEYS + ["x", "y"])) for i in range(rng.randrange(0, 12))]
    return (
        spark.createDataFrame(left, "l string, k string"),
        spark.createDataFrame(right, "r string, k string"),
    )


@pytest.mark.parametrize("seed", range(6))
def test_full_outer_equals_the_plain_join(spark, rows, seed):
    left, right = sides(spark, seed)
    plain = left.join(right.withColumnRenamed("k", "k2"), F.col("k") == F.col("k2"), "full_outer")
    got = full_outer_on_key(left, right, "k", ["l"], ["r"])
    assert rows(got.select("l", "r")) == rows(plain.select("l", "r"))


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_lookup_equals_the_plain_join(spark, rows, seed, how):
    left, right = sides(spark, seed)
    plain = left.join(right, "k", how).select(*left.columns, *(["r"] if how == "left" else []))
    got = left_lookup(left, right, "k", ["l"], how=how)
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_null_keys_do_not_share_one_partition(spark):
    facts = spark.range(20000).selectExpr("id", "CAST(NULL AS STRING) AS k")
    lookup = spark.range(10).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = left_lookup(facts, lookup, "k", ["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 20000 and len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_a_hot_key_is_split_by_adaptive_execution(spark):
    """A third of the facts share one key: several tasks join it, and no row is lost."""
    facts = spark.range(0, 300000, 1, 8).selectExpr(
        "id", "IF(id % 3 = 0, 'hot', CAST(id % 5000 AS STRING)) AS k", "repeat('x', 40) AS pad"
    )
    lookup = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "id AS v").union(
        spark.range(1).selectExpr("'hot'", "-1L")
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = left_lookup(facts, lookup, "k", ["id"])
        hot = joined.where("v = -1").select("id", F.spark_partition_id().alias("p"), "pad")
        hot_rows = hot.collect()
        plain = joined.select("id", "v", "pad")
        plain.collect()
        final = plain._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(hot_rows) == 100000
    assert "skew=true" in final


SOURCES = {"PAYMENT": "bank_cif", "EWALLET": "wallet_user_id"}
EVENT = {"PAYMENT": "cif", "EWALLET": "wallet_id"}


def test_bridge_equals_the_disjunction_without_a_nested_loop(spark, rows, plan_of):
    dim = spark.createDataFrame(
        [(1, None, None), (2, "c1", None), (3, "c2", "w2"), (4, "c2", "w3"), (5, None, "c1")],
        "customer_sk long, bank_cif string, wallet_user_id string",
    )
    events = spark.createDataFrame(
        [("e1", "PAYMENT", "c1", None), ("e2", "PAYMENT", "c2", "w3"), ("e3", "EWALLET", "c2", "w3"),
         ("e4", "EWALLET", None, "zz"), ("e5", "OTHER", "c1", "w2"), ("e6", "PAYMENT", None, "w2")],
        "event_id string, source_system string, cif string, wallet_id string",
    )
    either = ((F.col("source_system") == "PAYMENT") & (F.col("bank_cif") == F.col("cif"))) | (
        (F.col("source_system") == "EWALLET") & (F.col("wallet_user_id") == F.col("wallet_id"))
    )
    plain = events.join(dim, either, "left").select("event_id", "customer_sk")
    bridge = natural_id_bridge(dim, "customer_sk", SOURCES)
    got = left_lookup(
        events.withColumn("natural_id", natural_id(EVENT)), bridge, "natural_id", ["event_id"],
        also=["source_system"],
    ).select("event_id", "customer_sk")
    assert rows(got) == rows(plain)
    assert "NestedLoop" in plan_of(plain) and "NestedLoop" not in plan_of(got)


@pytest.mark.parametrize("codes, expected", [([], [None]), (["X"], [None]), (["X", "MAIN"], [2])])
def test_constant_match_keeps_left_join_semantics(spark, plan_of, codes, expected):
    dim = spark.createDataFrame(
        [(i + 1, c) for i, c in enumerate(codes)], "branch_key long, branch_code string"
    )
    facts = spark.range(2)
    got = with_constant_match(facts, dim, F.col("branch_code") == "MAIN", "branch_key")
    for i in range(2):
        assert [r.branch_key for r in got.where(f"id = {i}").orderBy("branch_key").collect()] == expected
    assert "Join" not in plan_of(got) and "collect_list" not in plan_of(got)


def test_a_constant_match_of_several_rows_fails(spark):
    dim = spark.createDataFrame([(1, "MAIN"), (2, "MAIN")], "branch_key long, branch_code string")
    with pytest.raises(Exception, match="several rows"):
        with_constant_match(spark.range(2), dim, F.col("branch_code") == "MAIN", "branch_key").collect()


def test_full_outer_shuffles_the_left_side_once(spark):
    left = spark.range(2000).selectExpr("id AS l", "CAST(id AS STRING) AS k", "concat('n', id) AS name")
    right = spark.range(1000, 4000).selectExpr("id AS r", "CAST(id AS STRING) AS k")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        got = full_outer_on_key(left, right, "k", ["l"], ["r"]).select("l", "name", "r")
        assert len(got.collect()) == 4000
        assert "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_facts_of_the_unknown_member_are_not_shuffled(spark, rows, plan_of):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (2, "d"), (9, "e"), (None, "f")], "sk long, fact string")
    dim = spark.createDataFrame([(1, "N/A"), (2, "x"), (3, "y")], "sk long, name string")
    joined = member_lookup(facts, dim, "sk", 1)
    assert rows(joined) == rows(facts.join(dim, "sk"))
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(member_lookup(facts, dim, "sk", 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
