"""Result checks, the live feed and its headline figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import amount_label, clock, short_id
from ledgerloom.operators.topk import newest

FEED_ROWS = 50  # fixed value: length of the live feed
CHECK_ROWS = 10  # fixed value: length of the newest-facts check
# Status texts of the feed.
FRAUD_TEXT = "Cảnh báo (Fraud)"
VALID_TEXT = "Hợp lệ"


def fact_count(facts: DataFrame) -> DataFrame:
    return facts.agg(F.count(F.lit(1)).alias("fact_rows"))


def customers_by_flag(dim_customer: DataFrame) -> DataFrame:
    return dim_customer.groupBy("is_wallet_user", "is_borrower").agg(
        F.count(F.lit(1)).alias("customers")
    )


def newest_facts(facts: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    rows = newest(facts, "trans_timestamp", CHECK_ROWS, tie_break)
    return rows.select("source_system", "base_amount", "currency_code", "trans_timestamp")


def latest_events(events: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    return newest(events, "timestamp", FEED_ROWS, tie_break)


def live_feed(events: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """The latest events as the feed shows them."""
    return latest_events(events, tie_break).select(
        clock("timestamp").alias("time_short"),
        short_id("event_id").alias("event_id_short"),
        F.concat(F.lit("#"), F.col("account_id").cast("string")).alias("account_label"),
        "txn_type",
        amount_label("amount", "currency").alias("amount_label"),
        "merchant",
        F.when(F.col("is_fraud_flag") == 1, FRAUD_TEXT).otherwise(VALID_TEXT).alias("status_text"),
    )


def live_metrics(events: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """Rows, newest amount and flagged rows of the latest events."""
    nulls_first = [x for c in ["timestamp", *(tie_break or [])] for x in (F.isnull(c), F.col(c))]
    order = F.struct(*[x.alias(f"o{i}") for i, x in enumerate(nulls_first)])
    latest = latest_events(events, tie_break).withColumn("_order", order)
    rows = F.count(F.lit(1))
    newest_amount = F.max_by("amount", "_order")
    return latest.agg(
        F.when(rows < FEED_ROWS, rows.cast("string"))
        .otherwise(F.concat(F.lit(">= "), rows.cast("string"))).alias("rows_label"),
        newest_amount.alias("newest_amount"),
        F.coalesce(F.sum("is_fraud_flag"), F.lit(0)).alias("flagged_rows"),
    )


def amount_series(events: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """The chart's points: time and amount of the latest events."""
    return latest_events(events, tie_break).select("timestamp", "amount")
