"""Dimension loads."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions.dates import padded_day_name, padded_month_name, weekend_text
from ledgerloom.functions.text import clean_name, digits_only
from ledgerloom.operators.joins import full_outer_on_key, left_lookup
from ledgerloom.operators.keys import assign_keys, extend_keys, keys_after

# Fixed values of the identity match.
BANK_TIER = "TIER_2"
PHONE_ID = "PH_"  # stored in place of a missing national id
PHONE_KEY = "P_"  # compared in place of a missing national id
MATCH_CONFIDENCE = "0.95"
WALLET_PRODUCT = "WALLET_ACCOUNT"
LOAN_PRODUCT = "MORTGAGE_LOAN"
GENERAL_CATEGORY = "General"

CUSTOMER_NUMBERING = ["bank_cif", "account_id"]

# What to do with rows that are about to be numbered, and so read twice: leave
# them lazy, or store them (``operators.tables.stored``) as the daily load does.
Keep = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    return df


def _party(df: DataFrame, side: str, phone: str, **own: str) -> DataFrame:
    """One side of the match: cleansed attributes under the side's prefix."""
    number = digits_only(phone)
    return df.select(
        *[F.col(source).alias(name) for name, source in own.items()],
        F.col("national_id").alias(f"{side}_national_id"),
        number.alias(f"{side}_phone"),
        clean_name("full_name").alias(f"{side}_name"),
        F.coalesce("national_id", F.concat(F.lit(PHONE_KEY), number)).alias("match_key"),
    )


def resolve_customers(bank: DataFrame, wallet: DataFrame) -> DataFrame:
    """Bank customers and wallet accounts as master customers, not yet numbered.

    Rows match on national id or, where that is missing, on the phone number.
    A row without both matches nothing and is kept. ``account_id`` comes along
    because ``(bank_cif, account_id)`` identifies a row for the numbering.
    """
    left = _party(bank, "b", "phone", bank_cif="cif")
    right = _party(
        wallet, "w", "phone_number",
        wallet_user_id="user_id", account_id="account_id", w_kyc="kyc_level",
    )
    pairs = full_outer_on_key(left, right, "match_key", ["bank_cif"], ["account_id"])
    in_bank = F.col("bank_cif").isNotNull()
    return pairs.select(
        F.coalesce(
            "b_national_id", "w_national_id", F.concat(F.lit(PHONE_ID), F.col("w_phone"))
        ).alias("national_id"),
        F.coalesce("b_phone", "w_phone").alias("phone_number"),
        F.coalesce("b_name", "w_name").alias("full_name"),
        F.col("wallet_user_id").isNotNull().alias("is_wallet_user"),
        in_bank.alias("is_borrower"),
        F.when(in_bank, BANK_TIER).otherwise(F.col("w_kyc")).alias("kyc_level"),
        "bank_cif", "wallet_user_id", "account_id",
    )


def customer_dimension(bank: DataFrame, wallet: DataFrame, keep: Keep = lazily) -> DataFrame:
    """Full reload of the master customers behind the unknown member."""
    rows = keep(resolve_customers(bank, wallet))
    members = assign_keys(rows, "customer_sk", CUSTOMER_NUMBERING)
    return schemas.unknown_member(bank.sparkSession, "mdm.dim_customer").unionByName(
        schemas.conform(members, "mdm.dim_customer")
    )


def customer_dimension_keeping_keys(
    bank: DataFrame, wallet: DataFrame, existing: DataFrame, keep: Keep = lazily, retired: DataFrame | None = None
) -> DataFrame:
    """Reload in which known customers keep their key.

    A full reload numbers anew, while older facts keep the numbers they were
    written with. Here only new members are numbered. A member is known by its
    pair of bank and wallet id; where one of the two has arrived since, by the
    wallet id or else by the bank id alone. Where two members turn out to be one
    person, the row keeps the key of its wallet. Keys of ``retired`` members are
    not given again.
    """
    rows = keep(resolve_customers(bank, wallet))
    known = existing.where(F.col("customer_sk") != schemas.UNKNOWN_SK)
    members = extend_keys(
        known, rows, "customer_sk", ["bank_cif", "wallet_user_id"], ["account_id"],
        looser=[["wallet_user_id"], ["bank_cif"]], keep=keep, used=retired,
    )
    return schemas.unknown_member(bank.sparkSession, "mdm.dim_customer").unionByName(
        schemas.conform(members, "mdm.dim_customer")
    )


def retired_customers(before: DataFrame, after: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """Members that facts may point at and ``after`` lacks, each with the key that took its place.

    ``before`` is the dimension as it was, ``earlier`` what this function gave at
    the last reload. A member survives in the row with its wallet id, or else
    with its bank id; of several rows in the one with the lowest key. One whose
    ids are both gone goes where it went before, and on from there if that
    member is gone by now, so every way has one step. It is null for a member
    that nothing took the place of.
    """
    ids = ["bank_cif", "wallet_user_id"]
    held = after.select("customer_sk", *ids)
    rows = before.select("customer_sk", *ids, F.lit(None).cast("bigint").alias("surviving_customer_sk"))
    if earlier is not None:
        rows = earlier.unionByName(rows.join(earlier.select("customer_sk"), "customer_sk", "left_anti"))
    rows = rows.join(held.select("customer_sk"), "customer_sk", "left_anti")
    for column in ids:
        lowest = held.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("customer_sk").alias(f"_by_{column}"))
        rows = left_lookup(rows, lowest, column, ["customer_sk"])
    rows = rows.withColumn("_found", F.coalesce("_by_wallet_user_id", "_by_bank_cif"))
    onward = rows.select(
        F.col("customer_sk").alias("surviving_customer_sk"), F.col("_found").alias("_next"), F.lit(True).alias("_gone"))
    rows = left_lookup(rows, onward, "surviving_customer_sk", ["customer_sk"])
    before_that = F.when(F.col("_gone"), F.col("_next")).otherwise(F.col("surviving_customer_sk"))
    return rows.select("customer_sk", *ids, F.coalesce("_found", before_that).alias("surviving_customer_sk"))


def under_survivors(rows: DataFrame, retired: DataFrame) -> DataFrame:
    """``rows`` with the keys of retired customers replaced by those of their survivors."""
    moved = retired.where(F.col("surviving_customer_sk").isNotNull()).select("customer_sk", "surviving_customer_sk")
    found = rows.join(moved, "customer_sk", "left")
    key = F.coalesce("surviving_customer_sk", "customer_sk").alias("customer_sk")
    return found.select(*[key if c == "customer_sk" else F.col(c) for c in rows.columns])


def deduplication_log(dim_customer: DataFrame) -> DataFrame:
    """Customers known to both businesses, with the confidence of the match."""
    both = F.col("bank_cif").isNotNull() & F.col("wallet_user_id").isNotNull()
    return dim_customer.where(both).select(
        F.col("customer_sk").alias("surviving_customer_sk"),
        F.col("wallet_user_id").alias("merged_source_id"),
        F.lit(MATCH_CONFIDENCE).cast("decimal(5,2)").alias("confidence_score"),
    )


def _numbered(
    rows: DataFrame, existing: DataFrame | None, key: str, natural: list[str], tie: list[str], keep: Keep
) -> DataFrame:
    """All rows numbered anew, or only those that ``existing`` does not hold."""
    if existing is None:
        return assign_keys(rows, key, natural)
    known = existing.where(F.col(key) != schemas.UNKNOWN_SK)
    return extend_keys(known, rows, key, natural, tie, keep=keep)


def merchant_dimension(
    events: DataFrame, keep: Keep = lazily, existing: DataFrame | None = None
) -> DataFrame:
    """Distinct merchants of the events, a missing name being one of them.

    Merchants of ``existing`` keep their key.

    A merchant named like the unknown member's source id would conflict with it
    and is left out.
    """
    unknown_id = schemas.UNKNOWN_MEMBERS["mdm.dim_merchant"]["source_merchant_id"]
    names = (
        events.select("merchant_name").distinct()
        .where(~F.col("merchant_name").eqNullSafe(F.lit(unknown_id)))
        .withColumn("source_merchant_id", F.col("merchant_name"))
    )
    members = _numbered(keep(names), existing, "merchant_sk", ["merchant_name"], [], keep)
    return schemas.unknown_member(events.sparkSession, "mdm.dim_merchant").unionByName(
        schemas.conform(members, "mdm.dim_merchant")
    )


def product_dimension(
    accounts: DataFrame, loans: DataFrame, dim_customer: DataFrame, keep: Keep = lazily,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Wallet accounts and loans of resolved customers.

    Several loans may share a ``branch_cif`` id, so rows are numbered by the
    key of their source table instead. Products of ``existing`` keep their key;
    of loans under one id the first ones do.
    """
    wallets = accounts.join(
        dim_customer.select("customer_sk", F.col("wallet_user_id").alias("user_id")), "user_id"
    ).select(
        "customer_sk", F.lit(WALLET_PRODUCT).alias("product_type"),
        F.col("account_id").cast("string").alias("source_account_id"),
        F.col("account_status").alias("status"),
        F.col("account_id").cast("string").alias("_source_key"),
    )
    mortgages = loans.join(
        dim_customer.select("customer_sk", F.col("bank_cif").alias("cif")), "cif"
    ).select(
        "customer_sk", F.lit(LOAN_PRODUCT).alias("product_type"),
        F.concat("branch_code", F.lit("_"), "cif").alias("source_account_id"),
        F.lit("ACTIVE").alias("status"),
        F.col("contract_no").alias("_source_key"),
    )
    rows = keep(wallets.unionByName(mortgages))
    if existing is None:
        members = assign_keys(rows, "product_sk", ["product_type", "_source_key", "customer_sk"])
    else:
        members = _numbered(
            rows, existing, "product_sk", ["product_type", "source_account_id", "customer_sk"], ["_source_key"], keep
        )
    return schemas.unknown_member(accounts.sparkSession, "mdm.dim_product_account").unionByName(
        schemas.conform(members, "mdm.dim_product_account")
    )


def missing_days(
    days: DataFrame, existing: DataFrame | None, first_key: int = 1, first_day: str | None = None
) -> DataFrame:
    """Calendar rows for the days in ``full_date`` that ``existing`` lacks.

    The key counts days from ``first_day``, which has ``first_key``, so no sort
    is needed to number them; ``first_key`` continues after the keys of an older
    calendar. Without ``first_day`` it is the first of the days given.
    """
    start = F.lit(first_day).cast("date") if first_day else days.agg(F.min("full_date")).scalar()
    rows = days.select(
        (F.datediff("full_date", start) + first_key).cast("bigint").alias("time_key"),
        "full_date",
        F.dayofmonth("full_date").alias("day"),
        F.month("full_date").alias("month"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        padded_day_name("full_date").alias("day_name"),
        padded_month_name("full_date").alias("month_name"),
        weekend_text("full_date").alias("is_weekend"),
    )
    if existing is not None:
        rows = rows.join(existing.select("full_date"), "full_date", "left_anti")
    return schemas.conform(rows, "star.dim_time")


def new_merchants(events: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    """Merchants of the events that the dimension lacks, by name.

    A missing name equals nothing, so it is always new. The rows have no code:
    the not-null report on the dimension names them.
    """
    names = events.select(F.col("merchant").alias("merchant_name")).distinct()
    fresh = names.join(dim_merchant.select("merchant_name"), "merchant_name", "left_anti")
    return fresh.select("merchant_name", F.lit(GENERAL_CATEGORY).alias("merchant_category"))


def scd2_merge(
    dim: DataFrame, incoming: DataFrame, key: str, natural: str, tracked: list[str], ds: str,
    keep: Keep = lazily,
) -> DataFrame:
    """Versioned reload: a changed member is closed on ``ds`` and reopened.

    Members that ``incoming`` does not name stay as they are. A member named
    twice with the same values counts once; with different ones the job fails,
    since nothing says which is newer. Only current versions are joined, once;
    ``keep`` stores the join, from which versions and new members are taken.
    """
    day = F.lit(ds).cast("date")
    values = F.struct(*[F.col(c) for c in tracked])
    differ = F.raise_error(F.concat(F.lit("named twice with different values: "), F.col(natural).cast("string")))
    arrived = incoming.groupBy(natural).agg(F.min(values).alias("_new"), F.max(values).alias("_other"))
    one = F.when(F.col("_new").eqNullSafe(F.col("_other")), F.col("_new"))
    arrived = arrived.select(natural, one.otherwise(differ.cast(arrived.schema["_new"].dataType)).alias("_new"))
    current = dim.where("is_current").withColumn("_held", F.lit(True))
    joined = keep(current.join(arrived, natural, "full"))

    new = F.col("_new").isNotNull()
    held = F.coalesce(F.col("_held"), F.lit(False))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_new.{c}")) for c in tracked])
    closes = held & new & ~same
    ended = {
        "expiry_date": F.when(closes, day).otherwise(F.col("expiry_date")),
        "is_current": ~closes,
    }
    versions = joined.where(held).select(*[ended.get(c, F.col(c)).alias(c) for c in dim.columns])
    opened = joined.where(new & (~held | ~same)).select(
        natural, *[F.col(f"_new.{c}").alias(c) for c in tracked],
        day.alias("effective_date"), F.lit(True).alias("is_current"),
    )
    past = dim.where(~F.coalesce(F.col("is_current"), F.lit(False)))
    numbered = keys_after(dim, opened, key, [natural])
    return versions.unionByName(past).unionByName(numbered, allowMissingColumns=True)
