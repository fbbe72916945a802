import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import quality
from ledgerloom.plans import monitor, views


def fact(spark, table, data, shape):
    return schemas.conform(spark.createDataFrame(data, shape), table)


@pytest.fixture
def dims_of(spark):
    return {
        "time": fact(spark, "star.dim_time", [(1, 2024, 1, 1), (2, 2024, 1, 1), (3, 2024, 2, 1)],
                     "time_key long, year int, month int, quarter int"),
        "branch": fact(spark, "star.dim_branch", [(1, "North", "R1"), (2, "South", "R2")],
                       "branch_key long, branch_name string, region_name string"),
        "customer": fact(spark, "star.dim_customer", [(2, "C2", "Ann", True), (3, "C3", "Bo", True), (4, "C4", "Cy", False)],
                         "customer_key long, cif_number string, full_name string, is_current boolean"),
    }


DEBT = "customer_key long, branch_key long, time_key long, total_outstanding double, risk_bucket string, days_past_due int"


def test_npl_ratio_with_a_zero_denominator(spark, dims_of):
    debt = fact(spark, "star.fact_debt_status",
                [(2, 1, 1, 100.0, "NPL", 95), (2, 1, 2, 200.0, "CURRENT", 0), (3, 2, 1, 0.0, "NPL", 99),
                 (3, 9, 1, 5.0, "NPL", 99)], DEBT)
    got = views.npl_by_branch_month(debt, dims_of["time"], dims_of["branch"]).collect()
    assert [(r.branch_name, r.total_loans, str(r.npl_amount), r.npl_ratio_pct and str(r.npl_ratio_pct)) for r in got] == [
        ("North", 2, "100.00", "33.33"), ("South", 1, "0.00", None),
    ]


def test_average_days_ignore_missing_ones(spark, dims_of):
    debt = fact(spark, "star.fact_debt_status",
                [(2, 1, 1, 1.0, "NPL", 91), (2, 1, 2, 1.0, "NPL", None), (2, 1, 2, 1.0, "NPL", 100)], DEBT
                ).withColumn("product_key", F.lit(1).cast("long"))
    product = fact(spark, "star.dim_product", [(1, "MORTGAGE")], "product_key long, product_type string")
    got = views.risk_distribution(debt, dims_of["time"], product).collect()
    assert [(r.loan_count, r.avg_days_past_due) for r in got] == [(3, 95.5)]


def test_wallet_volume(spark, dims_of):
    wallet = fact(spark, "star.fact_ewallet_transaction",
                  [(2, 1, 1, 10.0, 1.0, "TOP_UP", "SUCCESS"), (2, 1, 2, None, 1.0, "TOP_UP", "SUCCESS"),
                   (2, 1, 3, 4.0, 1.0, "TOP_UP", "SUCCESS")],
                  "customer_key long, branch_key long, time_key long, txn_amount double, fee_amount double, "
                  "txn_type string, txn_status string")
    got = views.ewallet_monthly_summary(wallet, dims_of["time"], dims_of["branch"]).collect()
    assert [(r.month, r.txn_count, str(r.total_amount), float(r.avg_txn_amount)) for r in got] == [
        (1, 2, "10.00", 10.0), (2, 1, "4.00", 4.0),
    ]


def test_payments_meet_channels_and_branches_as_sums(spark, rows):
    """Few keys, few tasks: joined before the sums, channels would put all days into as many tasks."""
    day = [(t, b, c, m, 1, *map(Decimal, (10, 1, 0, 9))) for t in (1, 2) for b in (1, 2) for c in (1, 2, None) for m in (1, 2, 9)]
    days = spark.createDataFrame(
        day, "time_key bigint, branch_key bigint, channel_key bigint, merchant_key bigint, txn_count bigint, "
        "gross_amount decimal(28,2), total_fee decimal(28,2), total_refund decimal(28,2), net_revenue decimal(28,2)")
    time = spark.createDataFrame([(1, 2024, 1, 1), (2, 2024, 1, 1)], "time_key bigint, year int, quarter int, month int")
    merchants = spark.createDataFrame([(1, "A"), (2, None)], "merchant_key bigint, merchant_category string")
    channels = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x")], "channel_key bigint, channel_name string")
    branches = spark.createDataFrame([(1, "N"), (2, "N")], "branch_key bigint, region_name string")
    found = views.payment_of_days(days, time, merchants, channels, branches)
    seen = [(r.merchant_category, r.channel_name, r.region_name, r.txn_count, float(r.gross_amount)) for r in found.collect()]
    assert sorted(seen, key=str) == sorted(
        [(c, n, "N", k, 10.0 * k) for c in ("A", None) for n, k in (("x", 8), ("y", 4))], key=str)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    joins = [line.split("(")[1].split("#")[0] for line in plan.splitlines() if "Join Inner" in line]
    assert joins == ["channel_key", "branch_key", "merchant_key", "time_key"]  # the last one first


def test_segments_of_current_customers_only(spark, dims_of):
    debt = fact(spark, "star.fact_debt_status", [(2, 1, 1, 100.0, "NPL", 95)] * 2 + [(4, 1, 1, 7.0, "NPL", 9)], DEBT)
    wallet = fact(spark, "star.fact_ewallet_transaction", [(2, 5.0)], "customer_key long, txn_amount double")
    pay = fact(spark, "star.fact_payment_transaction", [(4, 5.0)], "customer_key long, txn_amount double")
    got = views.customer_product_activity(dims_of["customer"], debt, wallet, pay).orderBy("cif_number").collect()
    assert [(r.cif_number, r.loan_count, float(r.total_loan_outstanding), r.ewallet_txn_count, r.customer_segment)
            for r in got] == [("C2", 2, 200.0, 1, "2-Product"), ("C3", 0, 0.0, 0, "1-Product")]


def enterprise(spark, data):
    return fact(spark, "mdm.fact_enterprise_transaction", data,
                "source_system string, source_trans_id string, base_amount double, trans_timestamp string")


FACTS = [("PAYMENT", "a", -1.5, "2024-01-01 00:00:00"), ("EWALLET", "b", 0.0, None),
         ("PAYMENT", "c", None, "2024-01-02 00:00:00"), ("PAYMENT", "d", 1.0, "2024-01-03 01:02:03.5")]


def test_quarantine_payload_keeps_nulls(spark):
    got = {json.loads(r.raw_payload)["source_trans_id"]: r for r in quality.invalid_amounts(enterprise(spark, FACTS)).collect()}
    assert set(got) == {"a", "b"} and {r.error_type for r in got.values()} == {"INVALID_AMOUNT"}
    assert '"base_amount":-1.50' in got["a"].raw_payload
    assert json.loads(got["a"].raw_payload)["trans_timestamp"] == "2024-01-01T00:00:00"
    payload = json.loads(got["b"].raw_payload)
    assert payload["trans_timestamp"] is None and list(payload) == schemas.struct_of(
        "mdm.fact_enterprise_transaction").names


def test_assertion_passes_and_fails_the_job(spark):
    good = quality.null_counts(spark.range(3), "t", ["id"])
    assert quality.assert_no_nulls([good]).first().passed is True
    bad = quality.null_counts(spark.range(3).selectExpr("nullif(id, 1) AS id"), "t", ["id"])
    assert bad.first().null_rows == 1
    with pytest.raises(Exception, match="rows without a key: 1"):
        quality.assert_no_nulls([good, bad]).collect()


def test_foreign_keys(spark, rows):
    facts = spark.createDataFrame([(1,), (5,), (5,), (None,)], "channel_key long")
    dim = spark.createDataFrame([(2,), (1,)], "channel_key long")
    assert rows(quality.foreign_key_report(facts, "f", {"channel_key": dim})) == [("f", "channel_key", "5", 2)]


def test_unique_and_required(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", "x"), (None, "y"), (None, "z")], "k string, v string")
    assert rows(quality.duplicates(df, "k")) == [("a", 2)]
    assert rows(quality.null_rows(df, ["k", "v"]).select("v", "missing_column")) == sorted(
        [(None, "v"), ("y", "k"), ("z", "k")], key=repr
    )


def test_counts_flags_and_newest(spark, rows):
    facts = enterprise(spark, FACTS)
    assert monitor.fact_count(facts).first()[0] == 4
    flags = spark.createDataFrame([(True, True), (True, False), (True, True)], "is_wallet_user boolean, is_borrower boolean")
    assert rows(monitor.customers_by_flag(flags)) == [(True, False, 1), (True, True, 2)]
    stamps = [r.trans_timestamp for r in monitor.newest_facts(facts).collect()]
    assert stamps[0] is None and stamps[1] == dt.datetime(2024, 1, 3, 1, 2, 3, 500000)


def events(spark, n):
    return schemas.conform(
        spark.range(n).selectExpr(
            "concat('event-', id) AS event_id", "id + 0.5D AS amount", "'PAYMENT' AS txn_type", "'VND' AS currency",
            "timestamp_seconds(1700000000 + id) AS timestamp", "'Shop' AS merchant", "CAST(id % 10 = 0 AS INT) AS is_fraud_flag",
            "id AS account_id",
        ),
        "public.realtime_transactions",
    )


def test_live_feed_and_metrics(spark, plan_of):
    feed = monitor.live_feed(events(spark, 1200), ["event_id"])
    rows = feed.collect()
    assert len(rows) == 50
    assert rows[0].amount_label == "1,199.5 VND" and rows[0].event_id_short == "event-11..." and rows[0].account_label == "#1199"
    assert rows[9].status_text == monitor.FRAUD_TEXT and rows[0].status_text == monitor.VALID_TEXT
    assert "TakeOrderedAndProject" in plan_of(feed)
    many = monitor.live_metrics(events(spark, 1200)).first()
    assert (many.rows_label, float(many.newest_amount), many.flagged_rows) == (">= 50", 1199.5, 5)
    few = monitor.live_metrics(events(spark, 3)).first()
    assert (few.rows_label, float(few.newest_amount), few.flagged_rows) == ("3", 2.5, 1)
    none = monitor.live_metrics(events(spark, 0)).first()
    assert (none.rows_label, none.newest_amount, none.flagged_rows) == ("0", None, 0)
    assert monitor.amount_series(events(spark, 60)).count() == 50
