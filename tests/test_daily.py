import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import tables
from ledgerloom.plans import daily
from ledgerloom.streaming.landing import folder_sink

DAY = "2024-01-02"


def put(w, table, data, shape):
    w.reload(table, w.spark.createDataFrame(data, shape))


@pytest.fixture
def warehouse(spark, tmp_path):
    w = daily.Warehouse(spark, str(tmp_path))
    put(w, "corebank.customer", [("C1", "ann", "ID1", "1"), ("C2", "bo", "ID2", "2")],
        "cif string, full_name string, national_id string, phone string")
    put(w, "ewallet.account", [(1, "W1", "3", "ann", "ID1"), (2, "W2", "4", "cy", "ID9")],
        "account_id long, user_id string, phone_number string, full_name string, national_id string")
    put(w, "corebank.mortgage_loan", [("L1", "C2", "B1", 50.0, 50.0, DAY), ("L2", "C2", "B1", 60.0, 60.0, "2024-01-05")],
        "contract_no string, cif string, branch_code string, principal_amount double, total_outstanding double, "
        "disbursement_date string")
    put(w, "public.realtime_transactions",
        [("e1", "PAYMENT", "C1", None, "Shop", 5.0, "2024-01-02 10:00:00", 77, 5.0, "Shop"),
         ("e2", "EWALLET", None, "W2", None, -3.0, "2024-01-02 11:00:00", None, None, None),
         ("e3", "EWALLET", None, "W7", None, 4.0, "2024-01-03 00:00:00", None, None, None)],
        "event_id string, source_system string, cif string, wallet_id string, merchant_name string, base_amount double, "
        "timestamp string, account_id long, amount double, merchant string")
    return w


def enterprise(w):
    return sorted(
        (r.source_trans_id, r.customer_sk, str(r.base_amount), str(r.trans_date))
        for r in w.stored("mdm.fact_enterprise_transaction").collect()
    )


def test_the_daily_load_is_idempotent(warehouse):
    w = warehouse
    daily.run_daily(w, DAY)
    first = enterprise(w)
    sk = {(r.bank_cif, r.wallet_user_id): r.customer_sk for r in w.table("mdm.dim_customer").collect()}
    assert first == sorted([
        ("e1", sk[("C1", "W1")], "5.00", DAY), ("e2", sk[(None, "W2")], "-3.00", DAY),
        ("LND_B1", sk[("C2", None)], "50.00", DAY), ("e3", 1, "4.00", "2024-01-03"),
    ])
    daily.run_daily(w, DAY)
    assert enterprise(w) == first
    daily.run_daily(w, "2024-01-03")
    assert enterprise(w) == first
    ids = [r.fact_id for r in w.stored("mdm.fact_enterprise_transaction").collect()]
    assert len(set(ids)) == 4
    log = w.stored("mdm.dq_quarantine_log").collect()
    assert [(r.source_system, r.error_type, str(r.log_date)) for r in log] == [("EWALLET", "INVALID_AMOUNT", DAY)]
    assert '"fact_id":' in log[0].raw_payload and '"source_trans_id":"e2"' in log[0].raw_payload
    merged = w.table("mdm.mdm_deduplication_log").collect()
    assert [r.merged_source_id for r in merged] == ["W1"] and merged[0].created_at is not None


def natural(w):
    """Facts with the natural ids of their customer and product."""
    customers = w.table("mdm.dim_customer").select("customer_sk", "bank_cif", "wallet_user_id")
    products = w.table("mdm.dim_product_account").select("product_sk", "source_account_id")
    rows = w.stored("mdm.fact_enterprise_transaction").join(customers, "customer_sk").join(products, "product_sk")
    return {(r.source_trans_id, r.bank_cif, r.wallet_user_id, r.source_account_id) for r in rows.collect()}


def test_members_keep_their_keys_on_the_next_day(warehouse):
    w = warehouse
    daily.run_daily(w, DAY)
    first = natural(w)
    put(w, "corebank.customer", [("A0", "al", "ID0", "9"), ("C1", "ann", "ID1", "1"), ("C2", "bo", "ID2", "2"),
                                 ("C9", "cy", "ID9", "4")],
        "cif string, full_name string, national_id string, phone string")
    daily.run_daily(w, "2024-01-05")
    renamed = {(t, "C9" if u == "W2" else c, u, a) for t, c, u, a in first}
    assert renamed <= natural(w)
    # the loan of the second day, under the account id of the first one's
    assert len(enterprise(w)) == len(first) + 1


def test_late_and_undated_events_become_facts(warehouse):
    w = warehouse
    daily.run_daily(w, DAY)
    sink = folder_sink(w.path("public.realtime_transactions"))
    late = w.spark.createDataFrame(
        [("late", "EWALLET", "W2", 7.0, "2024-01-02 23:00:00"), ("never", "EWALLET", "W2", -8.0, None)],
        "event_id string, source_system string, wallet_id string, base_amount double, timestamp string")
    sink(schemas.conform(late, "public.realtime_transactions"), "q-1")
    for _ in range(2):
        daily.run_daily(w, "2024-01-04")
        got = {(r[0], r[3]) for r in enterprise(w)}
        assert got == {("e1", DAY), ("e2", DAY), ("LND_B1", DAY), ("late", DAY), ("e3", "2024-01-03"), ("never", "None")}
        log = sorted((r.error_type, str(r.log_date)) for r in w.stored("mdm.dq_quarantine_log").collect())
        assert log == [("INVALID_AMOUNT", DAY), ("INVALID_AMOUNT", "None"), ("MISSING_TIMESTAMP", "None")]
    ids = [r.fact_id for r in w.stored("mdm.fact_enterprise_transaction").collect()]
    assert len(set(ids)) == 6


def test_a_failed_write_leaves_the_days_as_they_were(warehouse):
    w = warehouse
    daily.run_daily(w, DAY)
    before = enterprise(w)
    stop = F.raise_error(F.lit("stop")).cast("bigint")
    rows = w.stored("mdm.fact_enterprise_transaction").withColumn("fact_id", stop)
    with pytest.raises(Exception, match="stop"):
        tables.replace_partitions(rows, w.path("mdm.fact_enterprise_transaction"), daily.FACT_DAY)
    assert enterprise(w) == before


def test_constraints_of_what_is_stored(warehouse):
    w = warehouse
    put(w, "corebank.customer", [("C1", None, "ID1", "1"), ("C1", "bo", None, "2")],
        "cif string, full_name string, national_id string, phone string")
    found = {(r.table_name, r.column_name, r.rule): r.broken_rows for r in daily.constraint_report(w).collect()}
    assert found[("corebank.customer", "full_name", "required")] == 1
    assert found[("corebank.customer", "cif", "unique")] == 1
    assert found[("ewallet.account", "account_id", "unique")] == 0


def test_each_bound_of_the_calendar_has_its_own_default(warehouse):
    w = warehouse
    daily.load_calendar(w, start="2026-12-30")
    assert w.table("star.dim_time").count() == 2


def test_a_day_can_be_cleared(warehouse):
    w = warehouse
    daily.run_daily(w, DAY)
    daily.run_daily(w, "2024-01-03")
    tables.clear_partition(w.spark, w.path("mdm.fact_enterprise_transaction"), daily.FACT_DAY, DAY)
    assert [r[0] for r in enterprise(w)] == ["e3"]


def test_the_calendar_grows_and_star_days_are_replaced(warehouse):
    w = warehouse
    daily.load_calendar(w, "2024-01-01", "2024-01-03")
    daily.load_calendar(w, "2024-01-01", "2024-01-05")
    days = {r.full_date: r.time_key for r in w.table("star.dim_time").collect()}
    assert len(days) == 5 and len(set(days.values())) == 5
    assert days[dt.date(2024, 1, 2)] == 2

    put(w, "star.dim_customer", [(2, "W1"), (3, "77"), (4, "C2")], "customer_key long, cif_number string")
    put(w, "star.dim_branch", [(7, "MAIN"), (8, "B1")], "branch_key long, branch_code string")
    put(w, "star.dim_merchant", [(9, "m", "Shop")], "merchant_key long, merchant_code string, merchant_name string")
    put(w, "ewallet.transaction", [(1, 1, "TOP_UP", 9.0, "2024-01-02 01:00:00")],
        "txn_id long, account_id long, txn_type string, txn_amount double, txn_date string")
    for _ in range(2):
        daily.run_star_day(w, DAY)
    wallet = w.table("star.fact_ewallet_transaction").collect()
    assert [(r.customer_key, r.time_key, r.txn_count, str(r.txn_amount)) for r in wallet] == [(2, 2, 1, "9.00")]
    debt = w.table("star.fact_debt_status").collect()
    assert [(r.customer_key, r.branch_key, r.days_past_due) for r in debt] == [(4, 8, 0)]
    pay = w.table("star.fact_payment_transaction").collect()
    assert [(r.customer_key, r.merchant_key, r.branch_key, str(r.refund_amount)) for r in pay] == [(3, 9, 7, "0.00")]
    with pytest.raises(ValueError):
        daily.run_star_day(w, "2030-01-01")


def test_facts_without_a_timestamp_are_looked_for_in_their_partition(warehouse, plan_of):
    w = warehouse
    daily.run_daily(w, DAY)
    plan = plan_of(daily._broken(w.stored("mdm.fact_enterprise_transaction")))
    assert "PartitionFilters: [isnull(trans_date" in plan


def test_a_load_of_events_is_not_shuffled(warehouse):
    w = warehouse
    events = w.table("public.realtime_transactions")
    twice = events.unionByName(events.withColumn("event_id", F.concat("event_id", F.lit("x")))).repartition(4, "event_id")
    tasks = {r[0] for r in twice.select(F.spark_partition_id()).distinct().collect()}
    w.reload("public.realtime_transactions", twice)
    landed = w.table("public.realtime_transactions")
    assert landed.count() == 6
    files = {r[0] for r in landed.select(F.input_file_name()).distinct().collect()}
    assert len(files) == len(tasks) > 1 and all(".zstd." in f for f in files)
