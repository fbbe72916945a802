import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import tables
from ledgerloom.plans import daily, increments, views
from test_daily import DAY, put, warehouse  # noqa: F401 - the fixture


def loans(spark, rows):
    df = spark.createDataFrame(rows, "time_key long, branch_key long, total_outstanding double, risk_bucket string")
    return schemas.conform(df, "star.fact_debt_status")


def some(seed, days=(1, 90)):
    rng = random.Random(seed)
    return [(rng.randint(*days), rng.randint(1, 3), float(rng.randint(0, 50)), rng.choice(["NPL", "CURRENT"]))
            for _ in range(120)]


@pytest.mark.parametrize("seed", range(3))
def test_refreshed_sums_equal_those_of_all_facts(spark, rows, tmp_path, seed):
    path = f"{tmp_path}/sums"
    before, rng = some(seed), random.Random(seed)
    increments.build(loans(spark, before), views.debt_days, path)
    changed = {rng.randint(1, 90) for _ in range(5)} | {200}
    after = [r for r in before if r[0] not in changed] + [r for r in some(seed + 50) if r[0] in changed]
    after.append((200, 1, 7.0, "NPL"))  # a day of a period that no day was in
    emptied = min(changed)
    after = [r for r in after if r[0] != emptied]
    for _ in range(2):
        increments.refresh(loans(spark, after), views.debt_days, path, changed)
        assert rows(increments.read(spark, path)) == rows(views.debt_days(loans(spark, after)))


def test_only_the_folders_of_changed_days_are_written(spark, tmp_path):
    path = f"{tmp_path}/sums"
    facts = loans(spark, [(n, 1, 1.0, "NPL") for n in range(1, 100)])
    increments.build(facts, views.debt_days, path)

    def files():
        named = tables.read(spark, path).select("period", F.col("_metadata.file_path").alias("f")).distinct().collect()
        return {r.period: r.f for r in named}

    before = files()
    increments.refresh(facts, views.debt_days, path, [40])
    after = files()
    assert [p for p in before if before[p] != after[p]] == [1]
    increments.refresh(facts, views.debt_days, path, [])
    assert files() == after


def test_facts_without_rows(spark, rows, tmp_path):
    path, none, one = f"{tmp_path}/sums", loans(spark, [(1, 1, 1.0, "NPL")]).limit(0), loans(spark, [(70, 1, 1.0, "NPL")])
    for _ in range(2):
        increments.build(none, views.debt_days, path)
        increments.refresh(none, views.debt_days, path, [70])
        assert rows(increments.read(spark, path)) == []
        increments.refresh(one, views.debt_days, path, [70])
        assert rows(increments.read(spark, path)) == rows(views.debt_days(one))
    increments.refresh(none, views.debt_days, path, [70])
    assert rows(increments.read(spark, path)) == []


def test_days_wait_until_their_sums_are_made(spark, tmp_path):
    changed = increments.ChangedDays(spark, f"{tmp_path}/changed")
    assert changed.of("a") == []
    changed.add("a", [3, 4])
    changed.add("b", [3])
    changed.add("a", [4])
    assert sorted(changed.of("a")) == [3, 4]
    changed.strike("a")
    assert changed.of("a") == [] and changed.of("b") == [3]


def test_a_stopped_refresh_is_made_up_for(warehouse, monkeypatch):  # noqa: F811
    w = warehouse
    daily.load_calendar(w, "2024-01-01", "2024-01-09")
    put(w, "star.dim_customer", [(2, "W1"), (3, "77"), (4, "C2")], "customer_key long, cif_number string")
    put(w, "star.dim_branch", [(1, "B0", "zero", "r"), (7, "MAIN", "main", "r"), (8, "B1", "one", "r")],
        "branch_key long, branch_code string, branch_name string, region_name string")
    put(w, "star.dim_merchant", [(9, "m", "Shop", "food")],
        "merchant_key long, merchant_code string, merchant_name string, merchant_category string")
    put(w, "star.dim_channel", [(1, "app")], "channel_key long, channel_name string")

    def spent(amount):
        put(w, "ewallet.transaction", [(1, 1, "TOP_UP", amount, "2024-01-02 01:00:00")],
            "txn_id long, account_id long, txn_type string, txn_amount double, txn_date string")

    def served():
        return {name: [tuple(r) for r in df.collect()] for name, df in daily.serve_views(w).items()}

    def total():
        return [float(r.total_amount) for r in daily.serve_views(w)["ewallet_monthly"].collect()]

    spent(9.0)
    daily.run_star_day(w, DAY)
    assert total() == [9.0]
    first = served()
    assert all(len(rows) == 1 for rows in first.values())
    spent(5.0)
    with monkeypatch.context() as m:
        m.setattr(increments, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            daily.run_star_day(w, DAY)
    assert total() == [9.0]
    daily.run_star_day(w, "2024-01-05")  # another day; the first one is still on the list
    assert total() == [5.0]
