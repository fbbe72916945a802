"""Fact loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.dates import on_day
from ledgerloom.operators.joins import (
    left_lookup,
    natural_id,
    natural_id_bridge,
    with_constant_match,
)
from ledgerloom.plans.dims import LOAN_PRODUCT

# Which customer column identifies a customer of which source.
CUSTOMER_SOURCES = {"PAYMENT": "bank_cif", "EWALLET": "wallet_user_id"}
EVENT_SOURCES = {"PAYMENT": "cif", "EWALLET": "wallet_id"}
ENTERPRISE = "mdm.fact_enterprise_transaction"
MAIN_BRANCH = "MAIN"


def _known(column: str):
    return F.coalesce(F.col(column), F.lit(schemas.UNKNOWN_SK)).cast("bigint").alias(column)


def realtime_facts(
    events: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame, ds: str | None = None
) -> DataFrame:
    """Enterprise facts of landed events; of one day when ``ds`` is given.

    Unresolved customers and merchants fall back to the unknown member. A
    customer held more than once multiplies its facts.
    """
    rows = events if ds is None else events.where(on_day("timestamp", ds))
    rows = rows.withColumn("natural_id", natural_id(EVENT_SOURCES))
    bridge = natural_id_bridge(dim_customer, "customer_sk", CUSTOMER_SOURCES)
    # merchants are few: their key, and not the name, goes through the shuffle by customer
    rows = left_lookup(
        rows, dim_merchant.select("merchant_name", "merchant_sk"), "merchant_name", ["event_id"]
    )
    rows = left_lookup(rows, bridge, "natural_id", ["event_id"], also=["source_system"])
    return schemas.conform(
        rows.select(
            _known("customer_sk"), _known("merchant_sk"),
            F.lit(schemas.UNKNOWN_SK).alias("product_sk"),
            "source_system", F.col("event_id").alias("source_trans_id"), "base_amount",
            F.col("currency").alias("currency_code"),
            F.col("timestamp").alias("trans_timestamp"),
            F.lit("COMPLETED").alias("status"),
        ),
        ENTERPRISE,
    )


def lending_facts(
    loans: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    ds: str | None = None,
    product_type: str = LOAN_PRODUCT,
) -> DataFrame:
    """Disbursements as enterprise facts.

    A loan takes the product of its own account id; several loans under one id
    share the lowest key, so a customer with many loans gets one fact per loan
    and not one per pair of loans. The product column set keeps the default
    merchant.
    """
    rows = loans if ds is None else loans.where(F.col("disbursement_date") == F.lit(ds).cast("date"))
    rows = rows.select(
        "cif", "branch_code", "principal_amount", "disbursement_date",
        F.concat("branch_code", F.lit("_"), "cif").alias("source_account_id"),
    )
    products = (
        dim_product.where(F.col("product_type") == product_type)
        .groupBy("customer_sk", "source_account_id")
        .agg(F.min("product_sk").alias("product_sk"))
    )
    customers = dim_customer.select("customer_sk", F.col("bank_cif").alias("cif"))
    accounts = products.join(customers, "customer_sk")
    resolved = rows.join(accounts, ["cif", "source_account_id"])
    return schemas.conform(
        resolved.select(
            "customer_sk", "product_sk", F.lit("COREBANK").alias("source_system"),
            F.concat(F.lit("LND_"), F.col("branch_code")).alias("source_trans_id"),
            F.col("principal_amount").alias("base_amount"), F.lit("USD").alias("currency_code"),
            F.col("disbursement_date").cast("timestamp").alias("trans_timestamp"),
            F.lit("DISBURSED").alias("status"),
        ),
        ENTERPRISE,
    )


def without_day(facts: DataFrame, ts: str, ds: str) -> DataFrame:
    """Facts with one day deleted; a missing timestamp belongs to no day."""
    return facts.where(F.col(ts).isNull() | ~on_day(ts, ds))


def wallet_facts(
    txns: DataFrame, accounts: DataFrame, dim_customer: DataFrame, dim_time: DataFrame,
    ds: str | None = None,
) -> DataFrame:
    """E-wallet star facts with the default branch and channel.

    Accounts are resolved to customers first, so the transactions are joined
    once and not once per step.
    """
    rows = txns if ds is None else txns.where(on_day("txn_date", ds))
    rows = rows.withColumn("full_date", F.to_date("txn_date"))
    owners = accounts.select("account_id", F.col("user_id").alias("cif_number")).join(
        dim_customer.select("cif_number", "customer_key"), "cif_number", "left"
    ).select("account_id", "customer_key")
    rows = rows.join(dim_time.select("full_date", "time_key"), "full_date")
    rows = rows.join(owners, "account_id", "left")
    return rows.select(
        _known("customer_key"), F.lit(1).cast("bigint").alias("branch_key"), "time_key",
        F.lit(1).cast("bigint").alias("channel_key"), "txn_amount", "fee_amount", "txn_type",
        "txn_status",
    )


def debt_facts(
    loans: DataFrame, dim_customer: DataFrame, dim_branch: DataFrame, dim_time: DataFrame,
    ds: str | None = None,
) -> DataFrame:
    """Debt star facts, all in the current bucket and of the default product."""
    rows = loans if ds is None else loans.where(F.col("disbursement_date") == F.lit(ds).cast("date"))
    rows = rows.join(
        dim_time.select(F.col("full_date").alias("disbursement_date"), "time_key"),
        "disbursement_date",
    )
    rows = rows.join(
        dim_customer.select(F.col("cif_number").alias("cif"), "customer_key"), "cif", "left"
    )
    rows = rows.join(dim_branch.select("branch_code", "branch_key"), "branch_code", "left")
    return rows.select(
        _known("customer_key"), _known("branch_key"), F.lit(1).cast("bigint").alias("product_key"),
        "time_key", "principal_amount", "total_outstanding", F.lit("CURRENT").alias("risk_bucket"),
    )


def payment_facts(
    events: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame, dim_branch: DataFrame,
    dim_time: DataFrame, ds: str | None = None,
) -> DataFrame:
    """Payment star facts of events of known customers, at the main branch and free of fees."""
    rows = events if ds is None else events.where(on_day("timestamp", ds))
    rows = rows.select(
        "event_id", "amount", "merchant",
        F.col("account_id").cast("string").alias("cif_number"),
        F.to_date("timestamp").alias("full_date"),
    )
    rows = rows.join(dim_time.select("full_date", "time_key"), "full_date")
    rows = rows.join(dim_customer.select("cif_number", "customer_key"), "cif_number")
    merchants = dim_merchant.select(F.col("merchant_name").alias("merchant"), "merchant_key")
    rows = left_lookup(rows, merchants, "merchant", ["event_id"])
    rows = with_constant_match(rows, dim_branch, F.col("branch_code") == MAIN_BRANCH, "branch_key")
    return rows.select(
        _known("customer_key"), _known("merchant_key"), _known("branch_key"), "time_key",
        F.lit(1).cast("bigint").alias("channel_key"), F.lit(1).alias("txn_count"),
        F.col("amount").alias("txn_amount"), F.col("amount").alias("net_amount"),
        F.lit("SUCCESS").alias("txn_status"),
    )


def settlements(txns: DataFrame) -> DataFrame:
    """Totals of successful payments per merchant and settlement day."""
    return (
        txns.where(F.col("txn_status") == "SUCCESS")
        .groupBy("merchant_id", "settlement_date")
        .agg(
            F.count(F.lit(1)).alias("total_txn_count"),
            F.sum("txn_amount").alias("gross_amount"),
            F.sum("fee_amount").alias("total_fee"),
        )
        .withColumn("net_amount", F.col("gross_amount") - F.col("total_fee"))
    )


def net_of_refunds(txns: DataFrame, refunds: DataFrame) -> DataFrame:
    """Payments with their completed refunds and the amount that remains.

    Refunds are summed per payment before the join, so the payments keep their
    number of rows.
    """
    returned = (
        refunds.where(F.col("refund_status") == "COMPLETED")
        .groupBy(F.col("original_txn_id").alias("txn_id"))
        .agg(F.sum("refund_amount").alias("refund_amount"))
    )
    back = F.coalesce(F.col("refund_amount"), F.lit(0)).cast("decimal(18,2)")
    return txns.join(returned, "txn_id", "left").select(
        "txn_id", "merchant_id", "txn_amount", "fee_amount", back.alias("refund_amount"),
        (F.col("txn_amount") - F.col("fee_amount") - back).alias("net_amount"),
    )
