import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.joins import as_of_lookup

FACTS = "id long, k string, at timestamp"
VERSIONS = "k string, since date, until date, sk long, name string"


def brute(facts, versions):
    """Of the versions that began by then the last one, if it has not ended."""
    out = []
    for i, k, at in facts:
        begun = [v for v in versions if k is not None and at is not None and v[0] == k and v[1] is not None
                 and dt.datetime.combine(v[1], dt.time()) <= at]
        last = max(begun, key=lambda v: (v[1], v[3]), default=None)
        if last and last[2] is not None and dt.datetime.combine(last[2], dt.time()) <= at:
            last = None
        out.append((i, last[4] if last else None))
    return sorted(out, key=repr)


def looked_up(spark, facts, versions):
    return as_of_lookup(
        spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), "k", "at", "since", "until",
        ["sk"], ["id"])


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(spark, rows, seed):
    rng = random.Random(seed)
    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(0, 100, 9)] + [dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    versions = [
        (rng.choice(["a", "b", "c", None]), rng.choice([*days, None]), rng.choice([*days, None, None]), n, f"v{n}")
        for n in range(rng.randrange(0, 25))]
    facts = [
        (i, rng.choice(["a", "a", "b", "x", None]),
         rng.choice([None, *[dt.datetime.combine(d, dt.time(rng.choice([0, 13]))) for d in days]]))
        for i in range(40)]
    got = looked_up(spark, facts, versions)
    assert got.columns == ["id", "k", "at", "since", "until", "sk", "name"]
    assert rows(got.select("id", "name")) == brute(facts, versions)


def test_an_hour_before_and_after_a_change(spark, rows):
    versions = [("a", dt.date(2024, 1, 1), dt.date(2024, 1, 9), 1, "old"), ("a", dt.date(2024, 1, 9), None, 2, "new")]
    facts = [(1, "a", dt.datetime(2024, 1, 8, 23)), (2, "a", dt.datetime(2024, 1, 9)), (3, "a", dt.datetime(2031, 5, 5)),
             (4, "a", dt.datetime(2023, 12, 31, 23))]
    assert rows(looked_up(spark, facts, versions).select("id", "name")) == [(1, "old"), (2, "new"), (3, "new"), (4, None)]


def test_empty_sides(spark, rows):
    fact = (1, "a", dt.datetime(2024, 1, 8))
    assert rows(looked_up(spark, [fact], []).select("id", "name")) == [(1, None)]
    assert rows(looked_up(spark, [], [("a", dt.date(2024, 1, 1), None, 1, "v")])) == []


def test_a_hot_member_does_not_meet_in_one_task(spark):
    """No window over facts: a member's facts are joined, which adaptive execution may split."""
    facts = spark.range(60000).select(
        "id", F.lit("hot").alias("k"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours=(F.col("id") % 5000).cast("int"))).alias("at"))
    versions = spark.range(2000).select(
        F.lit("hot").alias("k"), F.date_add(F.lit("2023-06-01").cast("date"), F.col("id").cast("int")).alias("since"),
        F.lit(None).cast("date").alias("until"), F.col("id").alias("sk"), F.col("id").cast("string").alias("name"))
    got = as_of_lookup(facts, versions, "k", "at", "since", "until", ["sk"], ["id"])
    assert got.count() == 60000
    assert got.where(F.to_date("at") != F.col("since")).isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert windows and not any("id#" in line for line in windows)
