"""Analytic views over the star schema, as lazy frames.

Facts are summed per surrogate key before they meet a dimension. That first
aggregation combines inside each task, so a hot merchant or branch crosses the
shuffle as one row per task, and the joins run on sums instead of facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.measures import average, customer_segment, safe_ratio_pct


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(column: str) -> Column:
    return F.sum(column).alias(column)


def debt_days(debt: DataFrame) -> DataFrame:
    """Loans by day and branch."""
    bad = F.when(F.col("risk_bucket") == "NPL", F.col("total_outstanding")).otherwise(F.lit(0))
    return debt.groupBy("time_key", "branch_key").agg(
        _rows().alias("total_loans"), _total("total_outstanding"),
        F.sum(bad).alias("npl_amount"),
    )


def npl_by_branch_month(debt: DataFrame, dim_time: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """Outstanding and non-performing amounts by branch and month."""
    return npl_of_days(debt_days(debt), dim_time, dim_branch)


def npl_of_days(days: DataFrame, dim_time: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """The same from the sums by day."""
    named = days.join(dim_time.select("time_key", "year", "month", "month_name"), "time_key").join(
        dim_branch.select("branch_key", "branch_name", "region_name"), "branch_key"
    )
    return (
        named.groupBy("year", "month", "month_name", "branch_name", "region_name")
        .agg(_total("total_loans"), _total("total_outstanding"), _total("npl_amount"))
        .withColumn(
            "npl_ratio_pct",
            safe_ratio_pct(F.col("npl_amount"), F.col("total_outstanding"), 2),
        )
        .orderBy("year", "month", "branch_name")
    )


def customer_debt_summary(
    debt: DataFrame, dim_customer: DataFrame, dim_branch: DataFrame, dim_product: DataFrame,
    dim_time: DataFrame,
) -> DataFrame:
    """Loan rows of current customers."""
    current = dim_customer.where(F.col("is_current")).select(
        "customer_key", "cif_number", "full_name"
    )
    return (
        debt.join(current, "customer_key")
        .join(dim_product.select("product_key", "product_type"), "product_key")
        .join(dim_branch.select("branch_key", "branch_name"), "branch_key")
        .join(dim_time.select("time_key", F.col("full_date").alias("snapshot_date")), "time_key")
        .select(
            "cif_number", "full_name", "branch_name", "product_type", "total_outstanding",
            "days_past_due", "risk_bucket", "snapshot_date",
        )
    )


def risk_distribution(debt: DataFrame, dim_time: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Loans by quarter, bucket and product. Products are as many as contracts,
    so a sum per product before the join would save nothing."""
    return (
        debt.join(dim_product.select("product_key", "product_type"), "product_key")
        .groupBy("time_key", "risk_bucket", "product_type")
        .agg(
            _rows().alias("loan_count"), _total("total_outstanding"),
            F.sum("days_past_due").alias("_days"), F.count("days_past_due").alias("_day_rows"),
        )
        .join(dim_time.select("time_key", "year", "quarter"), "time_key")
        .groupBy("year", "quarter", "risk_bucket", "product_type")
        .agg(
            _total("loan_count"), _total("total_outstanding"),
            (F.sum("_days") / F.nullif(F.sum("_day_rows"), F.lit(0))).alias("avg_days_past_due"),
        )
        .orderBy("year", "quarter", "risk_bucket")
    )


def wallet_days(wallet: DataFrame) -> DataFrame:
    """E-wallet volume by day, branch, type and status."""
    return wallet.groupBy("time_key", "branch_key", "txn_type", "txn_status").agg(
        _rows().alias("txn_count"), F.sum("txn_amount").alias("total_amount"),
        F.sum("fee_amount").alias("total_fee"), F.count("txn_amount").alias("_amounts"),
    )


def ewallet_monthly_summary(
    wallet: DataFrame, dim_time: DataFrame, dim_branch: DataFrame
) -> DataFrame:
    """E-wallet volume by month, branch, type and status."""
    return ewallet_of_days(wallet_days(wallet), dim_time, dim_branch)


def ewallet_of_days(days: DataFrame, dim_time: DataFrame, dim_branch: DataFrame) -> DataFrame:
    """The same from the sums by day."""
    named = days.join(dim_time.select("time_key", "year", "month", "month_name"), "time_key").join(
        dim_branch.select("branch_key", "branch_name", "region_name"), "branch_key"
    )
    return (
        named.groupBy(
            "year", "month", "month_name", "branch_name", "region_name", "txn_type", "txn_status"
        )
        .agg(
            _total("txn_count"), _total("total_amount"), _total("total_fee"),
            average(F.sum("total_amount"), F.sum("_amounts")).alias("avg_txn_amount"),
        )
        .orderBy("year", "month")
    )


def payment_days(payments: DataFrame) -> DataFrame:
    """Payment volume, fees and refunds by day, branch, channel and merchant."""
    return payments.groupBy("time_key", "branch_key", "channel_key", "merchant_key").agg(
        _rows().alias("txn_count"), F.sum("txn_amount").alias("gross_amount"),
        F.sum("fee_amount").alias("total_fee"), F.sum("refund_amount").alias("total_refund"),
        F.sum("net_amount").alias("net_revenue"),
    )


def _payment_sums(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        _total("txn_count"), _total("gross_amount"), _total("total_fee"), _total("total_refund"), _total("net_revenue"),
    )


def payment_revenue_summary(
    payments: DataFrame, dim_time: DataFrame, dim_merchant: DataFrame, dim_channel: DataFrame,
    dim_branch: DataFrame,
) -> DataFrame:
    """Payment volume, fees and refunds by month, merchant category and channel."""
    return payment_of_days(payment_days(payments), dim_time, dim_merchant, dim_channel, dim_branch)


def payment_of_days(
    days: DataFrame, dim_time: DataFrame, dim_merchant: DataFrame, dim_channel: DataFrame, dim_branch: DataFrame
) -> DataFrame:
    """The same from the sums by day.

    Channels and branches are few, so a shuffle by their keys puts most rows into
    a few tasks. They are joined last, to sums by month and merchant category.
    """
    months = days.join(dim_time.select("time_key", "year", "quarter", "month"), "time_key")
    per_merchant = _payment_sums(months, "year", "quarter", "month", "branch_key", "channel_key", "merchant_key")
    merchants = dim_merchant.select("merchant_key", "merchant_category")
    per_category = _payment_sums(
        per_merchant.join(merchants, "merchant_key"),
        "year", "quarter", "month", "merchant_category", "branch_key", "channel_key",
    )
    named = per_category.join(dim_branch.select("branch_key", "region_name"), "branch_key").join(
        dim_channel.select("channel_key", "channel_name"), "channel_key"
    )
    return (
        _payment_sums(named, "year", "quarter", "month", "merchant_category", "channel_name", "region_name")
        .withColumn("fee_rate_pct", safe_ratio_pct(F.col("total_fee"), F.col("gross_amount"), 3))
        .orderBy("year", "month")
    )


def customer_product_activity(
    dim_customer: DataFrame, debt: DataFrame, wallet: DataFrame, payments: DataFrame
) -> DataFrame:
    """Loans, wallet and payment totals of each current customer, with a segment."""

    def rollup(facts: DataFrame, amount: str, rows: str, total: str) -> DataFrame:
        return facts.groupBy("customer_key").agg(
            _rows().alias(rows), F.sum(amount).alias(total)
        )

    joined = (
        dim_customer.where(F.col("is_current")).select("customer_key", "cif_number", "full_name")
        .join(rollup(debt, "total_outstanding", "loan_count", "total_loan_outstanding"),
              "customer_key", "left")
        .join(rollup(wallet, "txn_amount", "ewallet_txn_count", "ewallet_total_amount"),
              "customer_key", "left")
        .join(rollup(payments, "txn_amount", "payment_txn_count", "payment_total_amount"),
              "customer_key", "left")
    )
    measures = [
        "loan_count", "total_loan_outstanding", "ewallet_txn_count", "ewallet_total_amount",
        "payment_txn_count", "payment_total_amount",
    ]
    return joined.select(
        "cif_number", "full_name", *[F.coalesce(c, F.lit(0)).alias(c) for c in measures],
        customer_segment(
            F.col("loan_count"), F.col("ewallet_txn_count"), F.col("payment_txn_count")
        ).alias("customer_segment"),
    )
