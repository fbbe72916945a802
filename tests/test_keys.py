import random

import pytest

from ledgerloom.operators.keys import assign_keys, extend_keys, key_bucket, keys_after, serial_ids


def members(spark, n, parts=3):
    return spark.range(0, n, 1, parts).selectExpr("concat('m', id) AS name", "id % 7 AS kind")


def test_keys_are_dense_and_start_behind_the_unknown_member(spark):
    got = assign_keys(members(spark, 5000), "sk", ["name"])
    assert got.columns == ["sk", "name", "kind"]
    assert sorted(r.sk for r in got.collect()) == list(range(2, 5002))


def test_keys_do_not_depend_on_the_partitioning(spark):
    names = [f"m{i}" for i in range(500)]
    shuffled = names[:]
    random.Random(1).shuffle(shuffled)
    first = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    second = spark.createDataFrame([(n,) for n in shuffled], "name string").repartition(2)
    one = {r.name: r.sk for r in assign_keys(first, "sk", ["name"]).collect()}
    two = {r.name: r.sk for r in assign_keys(second, "sk", ["name"]).collect()}
    assert one == two


def test_a_null_is_one_natural_key(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None)], "x string, y string")
    got = assign_keys(df, "sk", ["x", "y"])
    assert sorted(r.sk for r in got.collect()) == [2, 3, 4]


def test_buckets_are_even(spark):
    df = members(spark, 40000).select(key_bucket(["name"], 1).alias("b")).groupBy("b").count()
    sizes = [r["count"] for r in df.collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)


def test_only_bucket_counts_meet_in_one_task(spark, plan_of):
    plan = plan_of(assign_keys(members(spark, 100), "sk", ["name"]))
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1
    below = plan[plan.index("Exchange SinglePartition"):].splitlines()[1]
    assert "HashAggregate(keys=[_bucket" in below and "count(1)" in below


def test_keys_after_an_existing_dimension(spark):
    dim = spark.createDataFrame([(1, "u"), (9, "a")], "sk long, name string")
    new = spark.createDataFrame([("b",), ("c",)], "name string")
    assert sorted(r.sk for r in keys_after(dim, new, "sk", ["name"]).collect()) == [10, 11]
    none = dim.where("sk > 100")
    assert sorted(r.sk for r in keys_after(none, new, "sk", ["name"]).collect()) == [2, 3]


def test_known_members_keep_their_keys(spark):
    dim = spark.createDataFrame(
        [(5, "c1", None), (6, "c2", "w2"), (7, None, "w3")], "sk long, cif string, wallet string"
    )
    rows = spark.createDataFrame(
        [("c1", None), ("c2", "w2"), (None, "w3"), ("c4", None)], "cif string, wallet string"
    )
    got = {(r.cif, r.wallet): r.sk for r in extend_keys(dim, rows, "sk", ["cif", "wallet"]).collect()}
    assert got == {("c1", None): 5, ("c2", "w2"): 6, (None, "w3"): 7, ("c4", None): 8}


def test_repeated_members_neither_multiply_nor_move(spark):
    rows = spark.createDataFrame(
        [("c1", "w1", 1), ("c1", "w1", 2), ("c1", "w1", 3), (None, "w2", 4), ("c3", None, None)],
        "cif string, wallet string, account int")
    dim = assign_keys(rows.where("account = 1 OR account IS NULL"), "sk", ["cif", "wallet", "account"])
    for _ in range(3):
        dim = extend_keys(dim, rows, "sk", ["cif", "wallet"], ["account"])
    assert dim.count() == 5 and sorted(r.sk for r in dim.collect()) == [2, 3, 4, 5, 6]


def test_a_member_goes_on_when_its_other_id_arrives(spark):
    dim = spark.createDataFrame([(5, "c1", None), (6, None, "w2"), (7, "c3", "w3")], "sk long, cif string, wallet string")
    rows = spark.createDataFrame(
        [("c1", "w1"), ("c1", "w9"), ("c2", "w2"), ("c3", "w3"), ("c4", None)], "cif string, wallet string")
    got = extend_keys(dim, rows, "sk", ["cif", "wallet"], [], looser=[["wallet"], ["cif"]])
    keys = {(r.cif, r.wallet): r.sk for r in got.collect()}
    assert {k: keys[k] for k in [("c1", "w1"), ("c2", "w2"), ("c3", "w3")]} == {
        ("c1", "w1"): 5, ("c2", "w2"): 6, ("c3", "w3"): 7}
    assert sorted(keys.values()) == [5, 6, 7, 8, 9]


def test_too_many_tasks_for_an_id_range_fail(spark):
    with pytest.raises(Exception, match="more than 3 tasks"):
        serial_ids(members(spark, 100, 8), "id", tasks=3).collect()


def test_serial_ids_are_unique(spark):
    got = [r.id for r in serial_ids(members(spark, 1000, 8), "id", start=100).collect()]
    assert len(set(got)) == 1000 and min(got) == 100
