"""Declared tables: columns, defaults, unknown members and constraints.

Two star schemas live side by side: ``star`` (debt, e-wallet and payment facts,
``*_key`` columns) and ``mdm`` (the enterprise model, ``*_sk`` columns).
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNKNOWN_SK = 1
FIRST_SK = 2

# Column names and types of the declared tables.
TABLES: dict[str, str] = {
    "corebank.customer": (
        "cif string, full_name string, national_id string, phone string, email string, "
        "current_address string, created_at timestamp"
    ),
    "corebank.mortgage_loan": (
        "contract_no string, cif string, branch_code string, product_type string, "
        "principal_amount decimal(18,2), interest_rate decimal(5,4), "
        "total_outstanding decimal(18,2), disbursement_date date, maturity_date date, status string"
    ),
    "corebank.loan_detail": (
        "id int, contract_no string, installment_due_date date, installment_amount decimal(18,2), "
        "principal_component decimal(18,2), interest_component decimal(18,2), "
        "last_payment_date date, last_payment_amount decimal(18,2), status string"
    ),
    "card.user": (
        "user_id int, national_id string, mobile_number string, email_address string, "
        "full_name string, created_at timestamp"
    ),
    "card.card_account": (
        "card_no string, user_id int, branch_code string, product_type string, "
        "credit_limit decimal(18,2), current_balance decimal(18,2), "
        "available_credit decimal(18,2), open_date date, status string"
    ),
    "card.statement": (
        "statement_id int, card_no string, statement_date date, payment_due_date date, "
        "closing_balance decimal(18,2), minimum_amount decimal(18,2), last_payment_date date, "
        "last_payment_amount decimal(18,2), days_past_due int"
    ),
    "ewallet.account": (
        "account_id bigint, user_id string, phone_number string, full_name string, "
        "national_id string, email string, account_status string, kyc_level string, "
        "branch_code string, created_at timestamp"
    ),
    "ewallet.balance": (
        "account_id bigint, current_balance decimal(18,2), available_balance decimal(18,2), "
        "frozen_amount decimal(18,2), last_updated timestamp"
    ),
    "ewallet.transaction": (
        "txn_id bigint, account_id bigint, txn_type string, txn_amount decimal(18,2), "
        "fee_amount decimal(18,2), txn_status string, source_channel string, "
        "receiver_account string, description string, txn_date timestamp, branch_code string"
    ),
    "ewallet.topup": (
        "topup_id bigint, account_id bigint, amount decimal(18,2), source_type string, "
        "source_ref string, status string, topup_date timestamp"
    ),
    "payment.merchant": (
        "merchant_id bigint, merchant_code string, merchant_name string, merchant_category string, "
        "branch_code string, region string, status string, registered_at date"
    ),
    "payment.transaction": (
        "txn_id string, merchant_id bigint, customer_ref string, txn_amount decimal(18,2), "
        "fee_amount decimal(18,2), payment_method string, txn_status string, currency string, "
        "description string, txn_date timestamp, settlement_date date, branch_code string"
    ),
    "payment.refund": (
        "refund_id string, original_txn_id string, refund_amount decimal(18,2), "
        "refund_reason string, refund_status string, refund_date timestamp"
    ),
    "payment.settlement": (
        "settlement_id bigint, merchant_id bigint, settlement_date date, total_txn_count bigint, "
        "gross_amount decimal(18,2), total_fee decimal(18,2), net_amount decimal(18,2), status string"
    ),
    "public.realtime_transactions": (
        "event_id string, account_id bigint, amount decimal(18,2), txn_type string, "
        "currency string, timestamp timestamp, merchant string, is_fraud_flag int, "
        "source_system string, cif string, wallet_id string, merchant_name string, "
        "base_amount decimal(18,2)"
    ),
    "star.dim_customer": (
        "customer_key bigint, cif_number string, full_name string, national_id string, "
        "phone_number string, current_address string, email string, effective_date date, "
        "expiry_date date, is_current boolean"
    ),
    "star.dim_branch": "branch_key bigint, branch_code string, branch_name string, region_name string",
    "star.dim_product": (
        "product_key bigint, contract_number string, product_type string, "
        "interest_rate decimal(5,4), maturity_date date"
    ),
    "star.dim_time": (
        "time_key bigint, full_date date, day int, month int, quarter int, year int, "
        "day_name string, month_name string, is_weekend string"
    ),
    "star.dim_merchant": (
        "merchant_key bigint, merchant_code string, merchant_name string, "
        "merchant_category string, region string, branch_code string, status string"
    ),
    "star.dim_channel": (
        "channel_key bigint, channel_code string, channel_name string, channel_type string, "
        "product_line string"
    ),
    "star.fact_debt_status": (
        "customer_key bigint, branch_key bigint, product_key bigint, time_key bigint, "
        "principal_amount decimal(18,2), interest_amount decimal(18,2), "
        "total_outstanding decimal(18,2), days_past_due int, risk_bucket string"
    ),
    "star.fact_ewallet_transaction": (
        "customer_key bigint, branch_key bigint, time_key bigint, channel_key bigint, "
        "txn_count int, txn_amount decimal(18,2), fee_amount decimal(18,2), "
        "net_amount decimal(18,2), txn_type string, txn_status string, closing_balance decimal(18,2)"
    ),
    "star.fact_payment_transaction": (
        "customer_key bigint, merchant_key bigint, branch_key bigint, time_key bigint, "
        "channel_key bigint, txn_count int, txn_amount decimal(18,2), fee_amount decimal(18,2), "
        "net_amount decimal(18,2), refund_amount decimal(18,2), payment_method string, "
        "txn_status string, merchant_category string"
    ),
    "mdm.dim_customer": (
        "customer_sk bigint, national_id string, phone_number string, full_name string, "
        "is_wallet_user boolean, is_borrower boolean, kyc_level string, bank_cif string, "
        "wallet_user_id string"
    ),
    "mdm.dim_merchant": "merchant_sk bigint, source_merchant_id string, merchant_name string",
    "mdm.dim_product_account": (
        "product_sk bigint, customer_sk bigint, product_type string, source_account_id string, "
        "status string"
    ),
    "mdm.fact_enterprise_transaction": (
        "customer_sk bigint, merchant_sk bigint, product_sk bigint, source_system string, "
        "source_trans_id string, base_amount decimal(18,2), currency_code string, "
        "trans_timestamp timestamp, status string"
    ),
    "mdm.mdm_deduplication_log": (
        "surviving_customer_sk bigint, merged_source_id string, confidence_score decimal(5,2), "
        "created_at timestamp"
    ),
    "mdm.dq_quarantine_log": (
        "source_system string, raw_payload string, error_type string, created_at timestamp"
    ),
}

# The event fields kept by the stream parser.
EVENT_FIELDS = (
    "source_system string, event_id string, cif string, wallet_id string, merchant_name string, "
    "base_amount double, currency string, timestamp string"
)

# Column defaults that apply when an insert leaves the column out.
NOW = object()
TODAY = object()
DEFAULTS: dict[str, dict[str, object]] = {
    "corebank.customer": {"created_at": NOW},
    "corebank.mortgage_loan": {"status": "ACTIVE"},
    "corebank.loan_detail": {"status": "PENDING"},
    "card.user": {"created_at": NOW},
    "card.card_account": {"current_balance": 0, "status": "ACTIVE"},
    "card.statement": {"days_past_due": 0},
    "ewallet.account": {"account_status": "ACTIVE", "kyc_level": "BASIC", "created_at": NOW},
    "ewallet.balance": {
        "current_balance": 0, "available_balance": 0, "frozen_amount": 0, "last_updated": NOW,
    },
    "ewallet.transaction": {"fee_amount": 0, "txn_status": "SUCCESS", "txn_date": NOW},
    "ewallet.topup": {"status": "SUCCESS", "topup_date": NOW},
    "payment.merchant": {"status": "ACTIVE"},
    "payment.transaction": {
        "fee_amount": 0, "txn_status": "SUCCESS", "currency": "VND", "txn_date": NOW,
    },
    "payment.refund": {"refund_status": "COMPLETED", "refund_date": NOW},
    "payment.settlement": {
        "total_txn_count": 0, "gross_amount": 0, "total_fee": 0, "net_amount": 0,
        "status": "SETTLED",
    },
    "star.dim_customer": {"effective_date": TODAY, "is_current": True},
    "star.fact_debt_status": {"days_past_due": 0},
    "star.fact_ewallet_transaction": {"txn_count": 1},
    "star.fact_payment_transaction": {"txn_count": 1, "refund_amount": 0},
    "mdm.dim_customer": {"is_wallet_user": False, "is_borrower": False},
    "mdm.fact_enterprise_transaction": {
        "customer_sk": UNKNOWN_SK, "merchant_sk": UNKNOWN_SK, "product_sk": UNKNOWN_SK,
    },
    "mdm.mdm_deduplication_log": {"created_at": NOW},
    "mdm.dq_quarantine_log": {"created_at": NOW},
}

# The unknown member of each enterprise dimension.
UNKNOWN_MEMBERS: dict[str, dict[str, object]] = {
    "mdm.dim_customer": {
        "customer_sk": UNKNOWN_SK, "national_id": "N/A", "phone_number": "N/A",
        "full_name": "General/Unknown/N/A", "is_wallet_user": False, "is_borrower": False,
        "kyc_level": "TIER_0",
    },
    "mdm.dim_merchant": {
        "merchant_sk": UNKNOWN_SK, "source_merchant_id": "NA", "merchant_name": "General/Unknown",
    },
    "mdm.dim_product_account": {
        "product_sk": UNKNOWN_SK, "customer_sk": UNKNOWN_SK, "product_type": "N/A",
        "source_account_id": "N/A", "status": "N/A",
    },
}

# Declared constraints, checked by the quality jobs.
REQUIRED: dict[str, tuple[str, ...]] = {
    "corebank.customer": ("cif", "full_name", "national_id"),
    "corebank.mortgage_loan": (
        "contract_no", "cif", "branch_code", "product_type", "principal_amount",
        "interest_rate", "disbursement_date", "maturity_date",
    ),
    "ewallet.account": ("account_id", "user_id", "phone_number"),
    "ewallet.transaction": ("txn_id", "account_id", "txn_type", "txn_amount"),
    "payment.merchant": ("merchant_id", "merchant_code", "merchant_name"),
    "payment.transaction": ("txn_id", "merchant_id", "txn_amount", "payment_method"),
    "payment.refund": ("refund_id", "original_txn_id", "refund_amount"),
    "payment.settlement": ("settlement_id", "merchant_id", "settlement_date"),
    "star.dim_customer": ("customer_key", "cif_number", "effective_date"),
    "star.dim_merchant": ("merchant_key", "merchant_code"),
    "star.dim_time": ("time_key", "full_date", "day", "month", "quarter", "year"),
    "star.fact_debt_status": ("customer_key", "branch_key", "product_key", "time_key"),
    "star.fact_ewallet_transaction": ("customer_key", "branch_key", "time_key", "channel_key"),
    "star.fact_payment_transaction": (
        "customer_key", "merchant_key", "branch_key", "time_key", "channel_key",
    ),
}
UNIQUE: dict[str, tuple[str, ...]] = {
    "corebank.customer": ("cif", "national_id"),
    "corebank.mortgage_loan": ("contract_no",),
    "ewallet.account": ("account_id", "phone_number"),
    "payment.merchant": ("merchant_id", "merchant_code"),
    "star.dim_time": ("time_key", "full_date"),
    "mdm.dim_customer": ("customer_sk",),
    "mdm.dim_merchant": ("merchant_sk", "source_merchant_id"),
    "mdm.dim_product_account": ("product_sk",),
}
FOREIGN_KEYS: dict[str, dict[str, str]] = {
    "star.fact_debt_status": {
        "customer_key": "star.dim_customer", "branch_key": "star.dim_branch",
        "product_key": "star.dim_product", "time_key": "star.dim_time",
    },
    "star.fact_ewallet_transaction": {
        "customer_key": "star.dim_customer", "branch_key": "star.dim_branch",
        "time_key": "star.dim_time", "channel_key": "star.dim_channel",
    },
    "star.fact_payment_transaction": {
        "customer_key": "star.dim_customer", "merchant_key": "star.dim_merchant",
        "branch_key": "star.dim_branch", "time_key": "star.dim_time",
        "channel_key": "star.dim_channel",
    },
}


@cache
def struct_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A frame of the declared shape without rows."""
    return spark.createDataFrame([], struct_of(table))


def _default_sql(value: object) -> str:
    if value is NOW:
        return "current_timestamp()"
    if value is TODAY:
        return "current_date()"
    if value is None:
        return "NULL"
    return f"'{value}'" if isinstance(value, str) else str(value)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in declared order and type.

    A column the frame leaves out gets its declared default, or null. A null
    that the frame does carry stays null.
    """
    defaults = DEFAULTS.get(table, {})
    given = set(df.columns)
    columns = []
    for field in struct_of(table):
        name, kind = field.name, field.dataType.simpleString()
        value = f"`{name}`" if name in given else _default_sql(defaults.get(name))
        columns.append(f"CAST({value} AS {kind}) AS `{name}`")
    return df.selectExpr(*columns)


def unknown_member(spark: SparkSession, table: str) -> DataFrame:
    """The one-row frame that facts fall back to."""
    row = spark.range(0, 1, 1, 1).select(
        *[F.lit(value).alias(name) for name, value in UNKNOWN_MEMBERS[table].items()]
    )
    return conform(row, table)
