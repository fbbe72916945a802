"""Generated rows: series, calendars and seed members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import padded_id

# Fixed values of the seed rows.
SEED_CUSTOMERS = 200
SEED_WALLETS = 250
WALLET_OFFSET = 500
CALENDAR_START = "2023-01-01"
CALENDAR_END = "2026-12-31"


def series(spark: SparkSession, n: int) -> DataFrame:
    """Integers ``1..n`` in a column ``gs``."""
    return spark.range(1, n + 1).withColumnRenamed("id", "gs")


def days_between(bounds: DataFrame, first: str | Column, last: str | Column) -> DataFrame:
    """Every day of each row's range, both ends included, as ``full_date``."""
    return bounds.select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date"))


def calendar(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    one = spark.range(0, 1, 1, 1)
    return days_between(one, F.lit(start).cast("date"), F.lit(end).cast("date"))


def seed_customers(numbers: DataFrame) -> DataFrame:
    """Bank customers for the numbers in ``gs``."""
    return numbers.select(
        padded_id("CIF", "gs", 6).alias("cif"),
        F.concat(F.lit("Customer "), F.col("gs").cast("string")).alias("full_name"),
        padded_id("0", "gs", 9).alias("national_id"),
        padded_id("09", "gs", 8).alias("phone"),
    )


def kyc_tier(number: str | Column) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return (
        F.when(number % 3 == 0, "ADVANCED").when(number % 2 == 0, "STANDARD").otherwise("BASIC")
    )


def seed_wallets(numbers: DataFrame) -> DataFrame:
    """Wallet accounts for the numbers in ``gs``; users are offset by 500."""
    return numbers.select(
        padded_id("W", F.col("gs") + WALLET_OFFSET, 6).alias("user_id"),
        padded_id("08", "gs", 8).alias("phone_number"),
        F.concat(F.lit("Wallet User "), F.col("gs").cast("string")).alias("full_name"),
        padded_id("1", "gs", 9).alias("national_id"),
        kyc_tier("gs").alias("kyc_level"),
    )
