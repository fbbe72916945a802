import datetime as dt
from decimal import Decimal

import pytest

from ledgerloom import schemas
from ledgerloom.plans import dims, facts

CUSTOMERS = "customer_sk long, bank_cif string, wallet_user_id string"


@pytest.fixture
def customers(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "C1", "W1"), (3, "C1", "W2"), (4, "C2", None)], CUSTOMERS
    )
    return schemas.conform(df, "mdm.dim_customer")


def landed(spark, data):
    df = spark.createDataFrame(
        data, "event_id string, source_system string, cif string, wallet_id string, merchant_name string, "
        "base_amount double, currency string, timestamp string"
    )
    return schemas.conform(df, "public.realtime_transactions")


EVENTS = [
    ("e1", "PAYMENT", "C2", None, "Shop", 5.0, "USD", "2024-01-01 10:00:00"),
    ("e2", "PAYMENT", "C1", None, None, 6.0, "USD", "2024-01-02 00:00:00"),
    ("e3", "EWALLET", "C2", "W2", "Gone", -1.0, "USD", "2024-01-02 23:59:59.5"),
    ("e4", "EWALLET", None, "W9", "Shop", 0.0, "USD", "2024-01-03 00:00:00"),
    ("e5", "OTHER", "C1", "W1", None, None, None, None),
]


def test_realtime_facts_fall_back_to_the_unknown_members(spark, customers, rows):
    merchants = dims.merchant_dimension(landed(spark, EVENTS[:2]))
    shop = {r.merchant_name: r.merchant_sk for r in merchants.collect()}["Shop"]
    got = facts.realtime_facts(landed(spark, EVENTS), customers, merchants)
    assert got.columns == schemas.struct_of(facts.ENTERPRISE).names
    assert rows(got.select("source_trans_id", "customer_sk", "merchant_sk", "product_sk", "status")) == [
        ("e1", 4, shop, 1, "COMPLETED"),
        ("e2", 2, 1, 1, "COMPLETED"),  # the customer is held twice, so is the fact
        ("e2", 3, 1, 1, "COMPLETED"),
        ("e3", 3, 1, 1, "COMPLETED"),
        ("e4", 1, shop, 1, "COMPLETED"),
        ("e5", 1, 1, 1, "COMPLETED"),
    ]
    day = facts.realtime_facts(landed(spark, EVENTS), customers, merchants, "2024-01-02")
    assert sorted({r.source_trans_id for r in day.collect()}) == ["e2", "e3"]


def test_day_filter_reaches_the_scan(spark, customers, plan_of, tmp_path):
    path = f"{tmp_path}/landing"
    landed(spark, EVENTS).write.parquet(path)
    events = spark.read.parquet(path)
    merchants = dims.merchant_dimension(events)
    plan = plan_of(facts.realtime_facts(events, customers, merchants, "2024-01-02"))
    pushed = [line for line in plan.splitlines() if "GreaterThanOrEqual(timestamp" in line]
    assert pushed and "LessThan(timestamp" in pushed[0] and "is_fraud_flag" not in pushed[0]


def loans(spark):
    df = spark.createDataFrame(
        [("L1", "C1", "B1", 100.0, "2024-01-02"), ("L2", "C1", "B1", 200.0, "2024-01-02"),
         ("L3", "C2", "B2", 300.0, "2024-01-03"), ("L4", "none", "B2", 400.0, "2024-01-02")],
        "contract_no string, cif string, branch_code string, principal_amount double, disbursement_date string",
    )
    return schemas.conform(df, "corebank.mortgage_loan")


def test_lending_facts_take_one_product_each(spark, customers, rows):
    wallets = schemas.empty(spark, "ewallet.account")
    products = dims.product_dimension(wallets, loans(spark), customers)
    by_id = {}
    for r in products.collect():
        by_id.setdefault((r.customer_sk, r.source_account_id), []).append(r.product_sk)
    got = facts.lending_facts(loans(spark), customers, products)
    picked = rows(got.select("customer_sk", "product_sk", "merchant_sk", "source_trans_id", "base_amount", "status"))
    one = [
        (c, min(by_id[(c, i)]), 1, "LND_" + i.split("_")[0], Decimal(a), "DISBURSED")
        for c, i, a in [(2, "B1_C1", "100.00"), (2, "B1_C1", "200.00"), (3, "B1_C1", "100.00"),
                        (3, "B1_C1", "200.00"), (4, "B2_C2", "300.00")]
    ]
    assert picked == sorted(one, key=repr)
    assert facts.lending_facts(loans(spark), customers, products, "2024-01-03").count() == 1
    # no account ever has this type, so the load stays empty
    assert facts.lending_facts(loans(spark), customers, products, product_type="LOAN_CONTRACT").count() == 0


def test_a_deleted_day_leaves_missing_timestamps(spark):
    left = facts.without_day(landed(spark, EVENTS), "timestamp", "2024-01-02").collect()
    assert sorted(r.event_id for r in left) == ["e1", "e4", "e5"]


@pytest.fixture
def star(spark):
    time = dims.missing_days(spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-01-05')) AS full_date"), None)
    holder = schemas.conform(
        spark.createDataFrame([(2, "W1"), (3, "C1"), (4, "77"), (5, "C1")], "customer_key long, cif_number string"),
        "star.dim_customer",
    )
    branch = schemas.conform(
        spark.createDataFrame([(7, "MAIN"), (8, "B1")], "branch_key long, branch_code string"), "star.dim_branch"
    )
    shop = schemas.conform(
        spark.createDataFrame([(9, "m", "Shop")], "merchant_key long, merchant_code string, merchant_name string"),
        "star.dim_merchant",
    )
    return {"time": time, "holder": holder, "branch": branch, "shop": shop}


def test_wallet_star_facts(spark, star, rows):
    txns = schemas.conform(
        spark.createDataFrame(
            [(1, 10, "2024-01-02 05:00:00"), (2, 11, "2024-01-02 06:00:00"), (3, 99, "2024-01-03 00:00:00"),
             (4, 10, "2030-01-01 00:00:00")], "txn_id long, account_id long, txn_date string"
        ).selectExpr("*", "'TOP_UP' AS txn_type", "CAST(txn_id AS DECIMAL(18,2)) AS txn_amount"),
        "ewallet.transaction",
    )
    accounts = schemas.conform(
        spark.createDataFrame([(10, "W1"), (11, "W5")], "account_id long, user_id string"), "ewallet.account"
    )
    got = facts.wallet_facts(txns, accounts, star["holder"], star["time"])
    assert rows(got.select("customer_key", "branch_key", "time_key", "channel_key", "txn_amount")) == [
        (1, 1, 2, 1, Decimal("2.00")), (1, 1, 3, 1, Decimal("3.00")), (2, 1, 2, 1, Decimal("1.00")),
    ]
    assert facts.wallet_facts(txns, accounts, star["holder"], star["time"], "2024-01-02").count() == 2


def test_debt_star_facts(spark, star, rows):
    got = facts.debt_facts(loans(spark), star["holder"], star["branch"], star["time"])
    assert rows(got.select("customer_key", "branch_key", "product_key", "time_key", "risk_bucket")) == sorted(
        [(3, 8, 1, 2, "CURRENT"), (5, 8, 1, 2, "CURRENT")] * 2
        + [(1, 1, 1, 3, "CURRENT"), (1, 1, 1, 2, "CURRENT")]
    )


def test_payment_star_facts_need_a_known_customer(spark, star, rows):
    events = schemas.conform(
        spark.createDataFrame(
            [("a", 77, 5.0, "Shop", "2024-01-02 01:00:00"), ("b", 77, 6.0, None, "2024-01-02 02:00:00"),
             ("c", 78, 7.0, "Shop", "2024-01-02 03:00:00")],
            "event_id string, account_id long, amount double, merchant string, timestamp string",
        ),
        "public.realtime_transactions",
    )
    args = (star["holder"], star["shop"], star["branch"], star["time"])
    got = facts.payment_facts(events, *args)
    assert rows(got.select("customer_key", "merchant_key", "branch_key", "time_key", "txn_count", "net_amount")) == [
        (4, 1, 7, 2, 1, Decimal("6.00")), (4, 9, 7, 2, 1, Decimal("5.00")),
    ]
    without_main = star["branch"].where("branch_code <> 'MAIN'")
    lost = facts.payment_facts(events, star["holder"], star["shop"], without_main, star["time"])
    assert {r.branch_key for r in lost.collect()} == {1}


def payments(spark):
    return schemas.conform(
        spark.createDataFrame(
            [("t1", 1, 100.0, 2.0, "SUCCESS", "2024-01-02"), ("t2", 1, 50.0, 1.0, "SUCCESS", "2024-01-02"),
             ("t3", 1, 9.0, 1.0, "FAILED", "2024-01-02"), ("t4", 2, 7.0, 0.5, "SUCCESS", "2024-01-03")],
            "txn_id string, merchant_id long, txn_amount double, fee_amount double, txn_status string, "
            "settlement_date string",
        ),
        "payment.transaction",
    )


def test_settlements(spark, rows):
    assert rows(facts.settlements(payments(spark))) == [
        (1, dt.date(2024, 1, 2), 2, Decimal("150.00"), Decimal("3.00"), Decimal("147.00")),
        (2, dt.date(2024, 1, 3), 1, Decimal("7.00"), Decimal("0.50"), Decimal("6.50")),
    ]


def test_refunds_are_netted_once_per_payment(spark):
    refunds = schemas.conform(
        spark.createDataFrame(
            [("t1", 10.0, "COMPLETED"), ("t1", 5.0, "COMPLETED"), ("t2", 50.0, "PENDING")],
            "original_txn_id string, refund_amount double, refund_status string",
        ),
        "payment.refund",
    )
    got = {r.txn_id: (str(r.refund_amount), str(r.net_amount))
           for r in facts.net_of_refunds(payments(spark), refunds).collect()}
    assert got == {"t1": ("15.00", "83.00"), "t2": ("0.00", "49.00"), "t3": ("0.00", "8.00"), "t4": ("0.00", "6.50")}
