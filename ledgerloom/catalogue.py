"""Named queries over the given tables.

Every query takes ``(spark, folder of tables)`` and gives a lazy frame. Money
is shown as double and timestamps without a zone, so that the results compare
with any engine; the jobs themselves keep decimals and zoned timestamps.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import measures
from ledgerloom.operators import keyed, quality, tables
from ledgerloom.operators.joins import as_of_lookup, member_lookup
from ledgerloom.operators.tables import stored
from ledgerloom.plans import daily, dims, facts, fraud, increments, monitor, views
from ledgerloom.session import scratch_path, use_defaults
from ledgerloom.sources import bindings as b
from ledgerloom.sources import files, seeds
from ledgerloom.sources.readers import file_events
from ledgerloom.streaming import feed, landing, parse
from ledgerloom.streaming.landing import folder_sink, landed, reload_landed, start_landing
from ledgerloom.streaming.parse import landing_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Days of the run parameter, one for each source.
EVENT_DAY = "2024-01-15"
LOAN_DAY = "1997-08-23"
PAYMENT_DAY = "1996-11-01"
CHANGE_DAY = "2002-01-01"


def plain(df: DataFrame) -> DataFrame:
    def show(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    return df.select(*[show(name, kind) for name, kind in df.dtypes])


def query(fn: Query) -> Query:
    @wraps(fn)
    def run(spark: SparkSession, d: str) -> DataFrame:
        use_defaults(spark)
        return plain(fn(spark, d))

    QUERIES[fn.__name__] = run
    return fn


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return dims.customer_dimension(b.bank_customer(spark, d), b.wallet_account(spark, d), stored)


def _merchants(spark: SparkSession, d: str) -> DataFrame:
    return dims.merchant_dimension(b.realtime_transactions(spark, d), stored)


def _products(spark: SparkSession, d: str, customers: DataFrame) -> DataFrame:
    return dims.product_dimension(
        b.wallet_account(spark, d), b.mortgage_loan(spark, d), customers, stored
    )


def _calendar(spark: SparkSession, d: str) -> DataFrame:
    return dims.missing_days(seeds.calendar(spark, *b.date_bounds(d)), None, first_day=b.EPOCH)


def _realtime(
    spark: SparkSession, d: str, customers: DataFrame, ds: str | None = None
) -> DataFrame:
    merchants = stored(_merchants(spark, d), "dim_merchant")
    return facts.realtime_facts(b.realtime_transactions(spark, d), customers, merchants, ds)


def _lending(
    spark: SparkSession, d: str, customers: DataFrame, ds: str | None = None, **options
) -> DataFrame:
    products = stored(_products(spark, d, customers), "dim_product_account")
    return facts.lending_facts(b.mortgage_loan(spark, d), customers, products, ds, **options)


def _stored_customers(spark: SparkSession, d: str) -> DataFrame:
    return stored(_customers(spark, d), "dim_customer")


def _enterprise(spark: SparkSession, d: str) -> DataFrame:
    customers = _stored_customers(spark, d)
    return _realtime(spark, d, customers).unionByName(_lending(spark, d, customers))


# --- enterprise dimensions -------------------------------------------------


@query
def dim_customer(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d)


@query
def dim_customer_keeping_keys(spark: SparkSession, d: str) -> DataFrame:
    """The wallets arrive after a first load of the bank customers alone; then it is loaded twice more."""
    bank, wallet = b.bank_customer(spark, d), b.wallet_account(spark, d)
    members = dims.customer_dimension(bank, schemas.empty(spark, "ewallet.account"))
    for _ in range(3):
        members = dims.customer_dimension_keeping_keys(bank, wallet, stored(members), stored)
    return members


@query
def fact_survivors(spark: SparkSession, d: str) -> DataFrame:
    """All events as facts before the wallets had an id to be matched by, read when they have.

    Customers of the bank that turn out to own wallets lose their key to the
    wallet's; their facts come back under the ids of the member that stays.
    """
    bank, wallet = b.bank_customer(spark, d), b.wallet_account(spark, d)
    no_id = F.lit(None).cast("string")
    apart = wallet.withColumn("national_id", no_id).withColumn("phone_number", no_id)
    before = stored(dims.customer_dimension(bank, apart, stored))
    held = stored(_realtime(spark, d, before), "facts")
    after = stored(dims.customer_dimension_keeping_keys(bank, wallet, before, stored))
    retired = stored(dims.retired_customers(before, after), "retired")
    ids = after.select("customer_sk", "bank_cif", "wallet_user_id")
    return dims.under_survivors(held, retired).join(ids, "customer_sk").select(
        "source_system", "source_trans_id", "base_amount", "bank_cif", "wallet_user_id")


@query
def mdm_dedup_log(spark: SparkSession, d: str) -> DataFrame:
    return dims.deduplication_log(_customers(spark, d))


@query
def dim_merchant(spark: SparkSession, d: str) -> DataFrame:
    return _merchants(spark, d)


@query
def dim_product_account(spark: SparkSession, d: str) -> DataFrame:
    return _products(spark, d, _stored_customers(spark, d))


# --- enterprise facts ------------------------------------------------------


@query
def fact_realtime(spark: SparkSession, d: str) -> DataFrame:
    return _realtime(spark, d, _stored_customers(spark, d))


@query
def fact_realtime_day(spark: SparkSession, d: str) -> DataFrame:
    return _realtime(spark, d, _stored_customers(spark, d), EVENT_DAY)


@query
def fact_lending(spark: SparkSession, d: str) -> DataFrame:
    return _lending(spark, d, _stored_customers(spark, d))


@query
def fact_lending_day(spark: SparkSession, d: str) -> DataFrame:
    return _lending(spark, d, _stored_customers(spark, d), LOAN_DAY)


@query
def fact_lending_literal(spark: SparkSession, d: str) -> DataFrame:
    """With the product type that no account has, the load gives no rows."""
    return _lending(
        spark, d, _stored_customers(spark, d), product_type="LOAN_CONTRACT"
    )


@query
def fact_lending_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Facts and amounts under the type that the accounts have, beside the literal that none has."""
    customers = _stored_customers(spark, d)
    kinds = []
    for kind in ("MORTGAGE_LOAN", "LOAN_CONTRACT"):
        found = _lending(spark, d, customers, product_type=kind)
        kinds.append(found.agg(F.count(F.lit(1)).alias("fact_rows"), F.sum("base_amount").alias("base_amount")).select(
            F.lit(kind).alias("product_type"), "fact_rows", "base_amount"))
    return kinds[0].unionByName(kinds[1])


@query
def fact_enterprise(spark: SparkSession, d: str) -> DataFrame:
    return _enterprise(spark, d)


def _warehouse(spark: SparkSession, d: str) -> daily.Warehouse:
    """A warehouse that holds the source tables."""
    w = daily.Warehouse(spark, scratch_path(spark, "warehouse"))
    w.reload("corebank.customer", b.bank_customer(spark, d))
    w.reload("corebank.mortgage_loan", b.mortgage_loan(spark, d))
    w.reload("ewallet.account", b.wallet_account(spark, d))
    w.reload("public.realtime_transactions", b.realtime_transactions(spark, d))
    return w


def _after_daily_runs(spark: SparkSession, d: str) -> daily.Warehouse:
    """Two days, the first of them loaded twice."""
    w = _warehouse(spark, d)
    daily.load_dimensions(w)
    for ds in (LOAN_DAY, PAYMENT_DAY, LOAN_DAY):
        daily.load_enterprise_facts(w, ds)
        daily.monitor_quality(w, ds)
    return w


@query
def daily_run(spark: SparkSession, d: str) -> DataFrame:
    return _after_daily_runs(spark, d).stored("mdm.fact_enterprise_transaction").drop("fact_id")


@query
def daily_run_quarantine(spark: SparkSession, d: str) -> DataFrame:
    log = _after_daily_runs(spark, d).stored("mdm.dq_quarantine_log")
    return log.select("source_system", "error_type", "log_date")


@query
def daily_run_two_days(spark: SparkSession, d: str) -> DataFrame:
    """Natural ids of all facts after a second day, before which most of the bank arrived.

    On the first day every landed event loads, with the customers known by then;
    the bank customers that join them later must not move a key.
    """
    w = daily.Warehouse(spark, scratch_path(spark, "warehouse"))
    bank, loans = b.bank_customer(spark, d), b.mortgage_loan(spark, d)
    early = F.substring("cif", -1, 1).isin("0", "3", "6")
    w.reload("public.realtime_transactions", b.realtime_transactions(spark, d))
    w.reload("ewallet.account", b.wallet_account(spark, d))
    w.reload("corebank.customer", bank.where(early))
    w.reload("corebank.mortgage_loan", loans.where(early))
    daily.run_daily(w, LOAN_DAY)
    w.reload("corebank.customer", bank)
    w.reload("corebank.mortgage_loan", loans)
    daily.run_daily(w, PAYMENT_DAY)
    customers = w.table("mdm.dim_customer").select("customer_sk", "bank_cif", "wallet_user_id")
    products = w.table("mdm.dim_product_account").select("product_sk", "source_account_id")
    merchants = w.table("mdm.dim_merchant").select("merchant_sk", "source_merchant_id")
    held = w.stored("mdm.fact_enterprise_transaction")
    held = member_lookup(held, products, "product_sk", schemas.UNKNOWN_SK).join(merchants, "merchant_sk")
    return held.join(customers, "customer_sk").select(
        "source_system", "source_trans_id", "base_amount", "trans_date", "bank_cif", "wallet_user_id",
        "source_account_id", "source_merchant_id")


def _after_late_events(spark: SparkSession, d: str) -> daily.Warehouse:
    """Raw events in two batches, the second after its days were loaded; some without a timestamp."""
    w = daily.Warehouse(spark, scratch_path(spark, "warehouse"))
    w.reload("corebank.customer", b.bank_customer(spark, d))
    w.reload("corebank.mortgage_loan", b.mortgage_loan(spark, d))
    w.reload("ewallet.account", b.wallet_account(spark, d))
    rows = landing_rows(parse.parse_events(b.raw_events(spark, d)))
    late = F.coalesce(F.substring("event_id", -1, 1).isin("1", "4", "7"), F.lit(False))
    sink = folder_sink(w.path("public.realtime_transactions"))
    sink(rows.where(~late), "query-0")
    daily.run_daily(w, EVENT_DAY)
    sink(rows.where(late), "query-1")
    daily.run_daily(w, "2024-01-16")
    return w


@query
def daily_run_late_events(spark: SparkSession, d: str) -> DataFrame:
    facts_held = _after_late_events(spark, d).stored("mdm.fact_enterprise_transaction")
    return facts_held.select("source_system", "source_trans_id", "base_amount", "trans_timestamp", "trans_date")


@query
def daily_run_late_quarantine(spark: SparkSession, d: str) -> DataFrame:
    log = _after_late_events(spark, d).stored("mdm.dq_quarantine_log")
    named = F.get_json_object("raw_payload", "$.source_trans_id").alias("source_trans_id")
    return log.select("source_system", named, "error_type", "log_date")


@query
def daily_run_reloaded(spark: SparkSession, d: str) -> DataFrame:
    """The landing table loaded twice, with a daily run after each load.

    The first load lacks a part of the events; the second one has them, and has
    lost all events of one day.
    """
    w = _warehouse(spark, d)
    events = b.realtime_transactions(spark, d)
    late = F.substring("event_id", -1, 1).isin("1", "4", "7")
    w.reload("public.realtime_transactions", events.where(~late))
    daily.run_daily(w, EVENT_DAY)
    w.reload("public.realtime_transactions", facts.without_day(events, "timestamp", PAYMENT_DAY))
    daily.run_daily(w, "2024-01-16")
    return w.stored("mdm.fact_enterprise_transaction").select(
        "customer_sk", "source_system", "source_trans_id", "base_amount", "trans_timestamp", "trans_date")


@query
def star_day_run(spark: SparkSession, d: str) -> DataFrame:
    """The older daily loads over stored dimensions, one day loaded twice."""
    w = _warehouse(spark, d)
    w.reload("ewallet.transaction", b.wallet_transaction(spark, d))
    w.reload("star.dim_time", _calendar(spark, d))
    w.reload("star.dim_customer", b.star_customer(spark, d))
    w.reload("star.dim_branch", b.star_branch(spark, d))
    w.reload("star.dim_merchant", b.star_merchant(spark, d))
    for _ in range(2):
        daily.run_star_day(w, LOAN_DAY)
    debt = w.table("star.fact_debt_status").select(
        F.lit("debt").alias("fact"), "time_key", "customer_key",
        F.col("total_outstanding").alias("amount"),
    )
    payment = w.table("star.fact_payment_transaction").select(
        F.lit("payment").alias("fact"), "time_key", "customer_key", F.col("txn_amount").alias("amount")
    )
    return debt.unionByName(payment)


@query
def enterprise_summary(spark: SparkSession, d: str) -> DataFrame:
    """Rows and amounts by source and by what is known about the customer."""
    customers = _stored_customers(spark, d)
    flags = customers.select("customer_sk", "is_wallet_user", "is_borrower")
    return (
        _realtime(spark, d, customers)
        .groupBy("source_system", "customer_sk")
        .agg(F.count(F.lit(1)).alias("fact_rows"), F.sum("base_amount").alias("base_amount"))
        .join(flags, "customer_sk")
        .groupBy("source_system", "is_wallet_user", "is_borrower")
        .agg(
            F.sum("fact_rows").alias("fact_rows"),
            F.sum("base_amount").alias("base_amount"),
        )
    )


# --- table maintenance -----------------------------------------------------


@query
def fact_minus_day(spark: SparkSession, d: str) -> DataFrame:
    events = b.realtime_transactions(spark, d).select("event_id", "source_system", "timestamp")
    return facts.without_day(events, "timestamp", EVENT_DAY)


@query
def fact_delete_using(spark: SparkSession, d: str) -> DataFrame:
    """A stored fact without one day; only the files that hold the day's key are written anew."""
    path = scratch_path(spark, "delete-using")
    tables.overwrite(b.debt_fact(spark, d).repartitionByRange("time_key").sortWithinPartitions("time_key"), path)
    day = _calendar(spark, d).where(F.col("full_date") == F.lit(LOAN_DAY).cast("date"))
    tables.delete_using(spark, path, day, "time_key")
    return tables.read(spark, path).select("customer_key", "product_key", "time_key", "principal_amount")


@query
def replace_day(spark: SparkSession, d: str) -> DataFrame:
    """All events by day, then one day replaced by the same rows at twice the amount, as read from the table."""
    path = scratch_path(spark, "replace-day")
    rows = b.realtime_transactions(spark, d).select(
        "event_id", "base_amount", F.to_date("timestamp").alias("trans_date")
    )
    tables.overwrite(rows, path, "trans_date")
    day = tables.read(spark, path).where(F.col("trans_date") == F.lit(EVENT_DAY).cast("date"))
    doubled = day.withColumn("base_amount", (F.col("base_amount") * 2).cast("decimal(18,2)"))
    tables.replace_partition(doubled, path, "trans_date", EVENT_DAY)
    return tables.read(spark, path)


@query
def clear_day(spark: SparkSession, d: str) -> DataFrame:
    """The same table with the day deleted."""
    path = scratch_path(spark, "clear-day")
    rows = b.realtime_transactions(spark, d).select(
        "event_id", "base_amount", F.to_date("timestamp").alias("trans_date")
    )
    tables.overwrite(rows, path, "trans_date")
    tables.clear_partition(spark, path, "trans_date", EVENT_DAY)
    return tables.read(spark, path)


@query
def create_and_append(spark: SparkSession, d: str) -> DataFrame:
    """A table that is created once, gets its rows in two appends, and dates them itself."""
    path = scratch_path(spark, "append")
    rows = b.bank_customer(spark, d).drop("created_at")
    made = [tables.create_if_absent(spark, path, schemas.struct_of("corebank.customer")) for _ in range(2)]
    late = F.substring("cif", -1, 1).isin("1", "4", "7")
    for part in (rows.where(~late), rows.where(late)):
        tables.append(schemas.conform(part, "corebank.customer"), path)
    return tables.read(spark, path).select(
        "cif", "full_name", F.col("created_at").isNotNull().alias("dated"),
        F.lit(made == [True, False]).alias("created_once"))


@query
def insert_ignore(spark: SparkSession, d: str) -> DataFrame:
    """National ids of the wallets that an insert into the bank's would add."""
    held = b.bank_customer(spark, d).select("national_id")
    return tables.without_conflicts(
        held, b.wallet_account(spark, d).select("national_id"), "national_id"
    )


@query
def keyed_insert(spark: SparkSession, d: str) -> DataFrame:
    """National ids of a keyed table of bank customers after wallets went in, those with an id twice."""
    wallets = b.wallet_account(spark, d).select("national_id")
    held = keyed.create(
        b.bank_customer(spark, d).select("national_id"), scratch_path(spark, "keyed"), "national_id")
    for rows in (wallets, wallets.where("national_id IS NOT NULL")):
        keyed.insert_ignore(held, rows)
    return keyed.pack(spark, held, scratch_path(spark, "keyed")).rows(spark)


@query
def keyed_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """National ids that several wallets share, counted in a keyed table without a shuffle."""
    held = keyed.create(
        b.wallet_account(spark, d).select("national_id"), scratch_path(spark, "keyed"), "national_id")
    return quality.duplicates(held.rows(spark), "national_id")


@query
def schema_evolution(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the older event shape beside rows of the extended one."""
    older = b.payment_events(spark, d).select(
        "event_id", "account_id", "amount", "txn_type", "currency", "timestamp", "merchant",
        "is_fraud_flag",
    )
    declared = schemas.struct_of("public.realtime_transactions")
    newer = b.wallet_events(spark, d).select(
        "event_id", "currency", "timestamp", "source_system", "wallet_id", "base_amount"
    )
    return tables.add_columns(older, declared).unionByName(newer, allowMissingColumns=True)


# --- quality ---------------------------------------------------------------


@query
def dq_invalid_amount(spark: SparkSession, d: str) -> DataFrame:
    return quality.invalid_amounts(_enterprise(spark, d))


@query
def dq_null_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_counts(
        b.payment_fact(spark, d), "star.fact_payment_transaction", ["customer_key"]
    ).unionByName(
        quality.null_counts(b.debt_fact(spark, d), "star.fact_debt_status", ["customer_key"])
    ).unionByName(
        quality.null_counts(
            b.realtime_transactions(spark, d), "public.realtime_transactions",
            ["cif", "wallet_id", "merchant_name", "base_amount"],
        )
    )


@query
def dq_keys_present(spark: SparkSession, d: str) -> DataFrame:
    """Fails the job if a fact lacks its customer."""
    return quality.assert_no_nulls(
        [
            quality.null_counts(b.payment_fact(spark, d), "payment", ["customer_key"]),
            quality.null_counts(b.debt_fact(spark, d), "debt", ["customer_key"]),
        ]
    )


@query
def dq_orphan_keys(spark: SparkSession, d: str) -> DataFrame:
    return quality.foreign_key_report(
        b.payment_fact(spark, d),
        "star.fact_payment_transaction",
        {
            "customer_key": b.star_customer(spark, d),
            "merchant_key": b.star_merchant(spark, d),
            "branch_key": b.star_branch(spark, d),
            "channel_key": b.star_channel(spark, d),
            "time_key": _calendar(spark, d),
        },
    )


@query
def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    required = list(schemas.REQUIRED["corebank.customer"])
    broken = quality.null_rows(b.bank_customer(spark, d), required)
    return broken.select("cif", "missing_column")


@query
def dq_all_constraints(spark: SparkSession, d: str) -> DataFrame:
    """The declared constraints of the source tables and enterprise dimensions, and of one star fact."""
    customers = _stored_customers(spark, d)
    held = {
        "corebank.customer": b.bank_customer(spark, d), "ewallet.account": b.wallet_account(spark, d),
        "mdm.dim_customer": customers, "mdm.dim_merchant": _merchants(spark, d),
        "star.fact_debt_status": b.debt_fact(spark, d), "star.dim_time": _calendar(spark, d),
    }
    return quality.constraint_report(held, schemas.REQUIRED, schemas.UNIQUE, schemas.FOREIGN_KEYS)


@query
def dq_duplicates(spark: SparkSession, d: str) -> DataFrame:
    wallets = quality.duplicates(b.wallet_account(spark, d), "national_id")
    customers = quality.duplicates(_customers(spark, d), "bank_cif")
    return wallets.withColumn("column_name", F.lit("national_id")).unionByName(
        customers.withColumn("column_name", F.lit("bank_cif"))
    )


# --- star schema -----------------------------------------------------------


@query
def dim_time(spark: SparkSession, d: str) -> DataFrame:
    return _calendar(spark, d)


@query
def dim_time_missing(spark: SparkSession, d: str) -> DataFrame:
    """Days that a calendar of the events' days lacks."""
    seen = b.realtime_transactions(spark, d).select(F.to_date("timestamp").alias("full_date")).distinct()
    return dims.missing_days(seeds.calendar(spark, *b.date_bounds(d)), seen, first_day=b.EPOCH)


@query
def new_merchants(spark: SparkSession, d: str) -> DataFrame:
    return dims.new_merchants(b.realtime_transactions(spark, d), b.star_merchant(spark, d))


def _wallet_facts(spark: SparkSession, d: str, ds: str | None) -> DataFrame:
    return facts.wallet_facts(
        b.wallet_transaction(spark, d), b.wallet_account(spark, d), b.star_customer(spark, d),
        _calendar(spark, d), ds,
    )


@query
def fact_ewallet(spark: SparkSession, d: str) -> DataFrame:
    return _wallet_facts(spark, d, None)


@query
def fact_ewallet_day(spark: SparkSession, d: str) -> DataFrame:
    return _wallet_facts(spark, d, EVENT_DAY)


def _debt_facts(spark: SparkSession, d: str, ds: str | None) -> DataFrame:
    return facts.debt_facts(
        b.mortgage_loan(spark, d), b.star_customer(spark, d), b.star_branch(spark, d),
        _calendar(spark, d), ds,
    )


@query
def fact_debt(spark: SparkSession, d: str) -> DataFrame:
    return _debt_facts(spark, d, None)


@query
def fact_debt_day(spark: SparkSession, d: str) -> DataFrame:
    return _debt_facts(spark, d, LOAN_DAY)


def _payment_facts(spark: SparkSession, d: str, ds: str | None) -> DataFrame:
    return facts.payment_facts(
        b.realtime_transactions(spark, d), b.star_customer(spark, d), b.star_merchant(spark, d),
        b.star_branch(spark, d), _calendar(spark, d), ds,
    )


@query
def fact_payment(spark: SparkSession, d: str) -> DataFrame:
    return _payment_facts(spark, d, None)


@query
def fact_payment_day(spark: SparkSession, d: str) -> DataFrame:
    return _payment_facts(spark, d, PAYMENT_DAY)


# --- views -----------------------------------------------------------------


@query
def npl_by_branch_month(spark: SparkSession, d: str) -> DataFrame:
    return views.npl_by_branch_month(
        b.debt_fact(spark, d), _calendar(spark, d), b.star_branch(spark, d)
    )


def _incremental(spark: SparkSession, d: str, rows: DataFrame, sums: increments.Sums, day: str, column: str) -> DataFrame:
    """Stored sums by day that were made before a day arrived and while another one's amounts were wrong.

    Then the sums of the two days are made again from the facts as they are.
    """
    path = scratch_path(spark, "sums")
    late = _calendar(spark, d).where(F.col("full_date") == F.lit(day).cast("date")).first()["time_key"]
    wrong = F.when(F.col("time_key") == late + 1, F.col(column) * 2).otherwise(F.col(column))
    before = rows.where(F.col("time_key") != late).withColumn(column, wrong.cast("decimal(18,2)"))
    increments.build(before, sums, path)
    increments.refresh(rows, sums, path, [late, late + 1])
    return increments.read(spark, path)


@query
def npl_incremental(spark: SparkSession, d: str) -> DataFrame:
    days = _incremental(spark, d, b.debt_fact(spark, d), views.debt_days, LOAN_DAY, "total_outstanding")
    return views.npl_of_days(days, _calendar(spark, d), b.star_branch(spark, d))


@query
def ewallet_monthly_incremental(spark: SparkSession, d: str) -> DataFrame:
    days = _incremental(spark, d, b.wallet_fact(spark, d), views.wallet_days, EVENT_DAY, "txn_amount")
    return views.ewallet_of_days(days, _calendar(spark, d), b.star_branch(spark, d))


@query
def payment_revenue_incremental(spark: SparkSession, d: str) -> DataFrame:
    days = _incremental(spark, d, b.payment_fact(spark, d), views.payment_days, PAYMENT_DAY, "txn_amount")
    return views.payment_of_days(
        days, _calendar(spark, d), b.star_merchant(spark, d), b.star_channel(spark, d), b.star_branch(spark, d))


@query
def customer_debt_summary(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_debt_summary(
        b.debt_fact(spark, d), b.star_customer(spark, d), b.star_branch(spark, d),
        b.star_product(spark, d), _calendar(spark, d),
    )


@query
def risk_distribution(spark: SparkSession, d: str) -> DataFrame:
    return views.risk_distribution(
        b.debt_fact(spark, d), _calendar(spark, d), b.star_product(spark, d)
    )


@query
def ewallet_monthly(spark: SparkSession, d: str) -> DataFrame:
    return views.ewallet_monthly_summary(
        b.wallet_fact(spark, d), _calendar(spark, d), b.star_branch(spark, d)
    )


@query
def payment_revenue(spark: SparkSession, d: str) -> DataFrame:
    return views.payment_revenue_summary(
        b.payment_fact(spark, d), _calendar(spark, d), b.star_merchant(spark, d),
        b.star_channel(spark, d), b.star_branch(spark, d),
    )


@query
def customer_activity(spark: SparkSession, d: str) -> DataFrame:
    return views.customer_product_activity(
        b.star_customer(spark, d), b.debt_fact(spark, d), b.wallet_fact(spark, d),
        b.payment_fact(spark, d),
    )


# --- checks and live monitor -----------------------------------------------


@query
def fact_count(spark: SparkSession, d: str) -> DataFrame:
    return monitor.fact_count(_enterprise(spark, d))


@query
def customers_by_flag(spark: SparkSession, d: str) -> DataFrame:
    return monitor.customers_by_flag(_customers(spark, d))


@query
def newest_facts(spark: SparkSession, d: str) -> DataFrame:
    return monitor.newest_facts(_enterprise(spark, d), ["source_trans_id"])


@query
def latest_events(spark: SparkSession, d: str) -> DataFrame:
    return monitor.latest_events(b.realtime_transactions(spark, d), ["event_id"])


@query
def live_feed(spark: SparkSession, d: str) -> DataFrame:
    return monitor.live_feed(b.payment_events(spark, d), ["event_id"])


@query
def live_metrics(spark: SparkSession, d: str) -> DataFrame:
    return monitor.live_metrics(b.payment_events(spark, d), ["event_id"])


@query
def amount_series(spark: SparkSession, d: str) -> DataFrame:
    return monitor.amount_series(b.payment_events(spark, d), ["event_id"])


# --- seeds, files and streams ----------------------------------------------


@query
def seed_customers(spark: SparkSession, d: str) -> DataFrame:
    numbers = b.given(spark, d, "customer").select((F.col("c_custkey") + 1).alias("gs"))
    return seeds.seed_customers(numbers)


@query
def seed_wallets(spark: SparkSession, d: str) -> DataFrame:
    numbers = b.given(spark, d, "customer").select((F.col("c_custkey") + 1).alias("gs"))
    return seeds.seed_wallets(numbers)


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def _loaded(spark: SparkSession, d: str, table: str) -> DataFrame:
    """Write the bank's customers and balances as untidy files and load them."""
    base = scratch_path(spark, "files")
    bank = b.bank_customer(spark, d)
    no_value = F.lit(None).cast("string")
    untidy = bank.select(
        F.col("cif").alias(" CIF"), F.trim("full_name").alias("Full_Name "),
        F.col("national_id").alias("National_ID"), F.col("phone").alias("PHONE"),
        no_value.alias(""),
    )
    empty_rows = bank.select(*[no_value.alias(c) for c in untidy.columns])
    balances = b.given(spark, d, "customer").select(
        F.col("c_custkey").alias("col a"), F.expr(b.money("c_acctbal")).alias("col b"),
        F.expr(b.money("c_acctbal")).alias("col c"), F.lit(0).alias("col d"),
        F.lit("2024-01-01 00:00:00").alias("col e"), F.lit("note").alias("col f"),
    )
    paths = {
        "README notes": _write_csv(balances, f"{base}/in/readme"),
        "corebank.customer": _write_csv(untidy.unionAll(empty_rows), f"{base}/in/customer"),
        "ewallet.balance": _write_csv(balances, f"{base}/in/balance"),
        "ewallet.topup": _write_csv(empty_rows, f"{base}/in/topup"),
    }
    files.load_folder(spark, paths, f"{base}/out")
    return spark.read.parquet(f"{base}/out/{table}")


@query
def load_files(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d, "corebank.customer").drop("created_at")


@query
def load_files_by_position(spark: SparkSession, d: str) -> DataFrame:
    return _loaded(spark, d, "ewallet.balance")


def _loaded_with_rejects(spark: SparkSession, d: str) -> str:
    """Balances with some amounts and times that are none, and notes over two lines, loaded from files."""
    base = scratch_path(spark, "rejects")
    key = F.col("c_custkey")
    balances = b.given(spark, d, "customer").select(
        key.alias("col a"),
        F.when(key % 20 == 3, F.lit('n/a, "later"')).otherwise(F.expr(b.money("c_acctbal")).cast("string")).alias("col b"),
        F.expr(b.money("c_acctbal")).alias("col c"), F.lit(0).alias("col d"),
        F.when(key % 30 == 3, F.lit("line one\nline two")).otherwise(F.lit("2024-01-01 00:00:00")).alias("col e"))
    writer = balances.write.option("header", True).option("escape", '"')
    writer.csv(f"{base}/in")
    files.load_folder(spark, {"ewallet.balance": f"{base}/in"}, f"{base}/out")
    return f"{base}/out"


@query
def load_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The accounts that load, and the cells for which the others do not."""
    out = _loaded_with_rejects(spark, d)
    none = F.lit(None).cast("string")
    held = spark.read.parquet(f"{out}/ewallet.balance").select(
        F.col("account_id"), none.alias("reason"), none.alias("column_name"), none.alias("cell"))
    rejects = tables.read(spark, f"{out}/{files.REJECTS}")
    return held.unionByName(rejects.select(
        F.lit(None).cast(held.schema["account_id"].dataType).alias("account_id"), "reason", "column_name", "cell"))


@query
def parse_events(spark: SparkSession, d: str) -> DataFrame:
    return parse.parse_events(b.raw_events(spark, d))


TEXT_ROWS = 1 << 18  # of one file of raw events, which one task reads


def _write_texts(raw: DataFrame, path: str) -> None:
    """Raw events as text files for a stream to read. They are compressed, and so bounded: such a file is not split."""
    writer = raw.write.mode("append").option("compression", "lz4").option("maxRecordsPerFile", TEXT_ROWS)
    writer.text(path)


@query
def stream_landing(spark: SparkSession, d: str) -> DataFrame:
    """The raw events as text files, streamed into the landing table until none is left."""
    base = scratch_path(spark, "stream")
    _write_texts(b.raw_events(spark, d), f"{base}/in")
    stream = start_landing(
        file_events(spark, f"{base}/in"), f"{base}/checkpoint", folder_sink(f"{base}/out"),
        available_now=True,
    )
    stream.awaitTermination()
    return landed(spark, f"{base}/out")


def _streamed(spark: SparkSession, base: str, checkpoint: str) -> None:
    start_landing(
        file_events(spark, f"{base}/in"), f"{base}/{checkpoint}", folder_sink(f"{base}/out"), available_now=True,
    ).awaitTermination()


@query
def stream_restart(spark: SparkSession, d: str) -> DataFrame:
    """Half of the raw events, a restart, the other half, a restart, then all again under a new checkpoint."""
    base = scratch_path(spark, "stream")
    raw = b.raw_events(spark, d)
    odd = F.pmod(F.crc32("value"), F.lit(2)) == 1
    _write_texts(raw.where(odd), f"{base}/in")
    _streamed(spark, base, "one")
    _write_texts(raw.where(~odd), f"{base}/in")
    _streamed(spark, base, "one")
    _streamed(spark, base, "one")
    _streamed(spark, base, "two")
    counted = landed(spark, f"{base}/out").groupBy("event_id", "wallet_id", "base_amount", "timestamp")
    return counted.agg(F.count(F.lit(1)).alias("copies"))


@query
def stream_two_sinks(spark: SparkSession, d: str) -> DataFrame:
    """Every batch reaches two tables; rows and amounts of both."""
    base = scratch_path(spark, "stream")
    _write_texts(b.raw_events(spark, d), f"{base}/in")
    start_landing(
        file_events(spark, f"{base}/in"), f"{base}/checkpoint", folder_sink(f"{base}/one"), folder_sink(f"{base}/two"),
        available_now=True,
    ).awaitTermination()
    both = [landed(spark, f"{base}/{n}").withColumn("sink", F.lit(n)) for n in ("one", "two")]
    return both[0].unionByName(both[1]).groupBy("sink", "wallet_id").agg(
        F.count(F.lit(1)).alias("events"), F.sum("base_amount").alias("base_amount"))


@query
def stream_after_load(spark: SparkSession, d: str) -> DataFrame:
    """All events loaded as a table, then the raw events streamed into it."""
    base = scratch_path(spark, "stream")
    reload_landed(schemas.conform(b.realtime_transactions(spark, d), "public.realtime_transactions"), f"{base}/out")
    _write_texts(b.raw_events(spark, d), f"{base}/in")
    _streamed(spark, base, "one")
    return landed(spark, f"{base}/out").select("event_id", "wallet_id", "base_amount", "timestamp")


@query
def stream_compacted(spark: SparkSession, d: str) -> DataFrame:
    """The raw events in many small batches; what a daily run took up is packed, then all batches land once more."""
    base = scratch_path(spark, "compact")
    w = daily.Warehouse(spark, base)
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    _write_texts(b.raw_events(spark, d).repartition(max(6, slots), F.crc32("value")), f"{base}/in")
    texts = [n for n in tables.children(spark, f"{base}/in") if n.startswith("part-")]
    held = w.path("public.realtime_transactions")

    def stream(files_at_once: int | None) -> None:
        start_landing(
            file_events(spark, f"{base}/in", files_at_once), f"{base}/checkpoint", folder_sink(held), available_now=True,
        ).awaitTermination()

    stream(-(-len(texts) // 6) or None)
    daily.Arrivals(w).record(w)
    daily.compact_landing(w)
    _write_texts(b.raw_events(spark, d).where(F.col("value").startswith("{broken")), f"{base}/in")
    stream(None)
    return landed(spark, held)


@query
def stream_live_feed(spark: SparkSession, d: str) -> DataFrame:
    """The newest events as a stream keeps them, over three starts of it."""
    base = scratch_path(spark, "feed")
    part = F.pmod(F.crc32("value"), F.lit(3))
    for n in range(3):
        _write_texts(b.raw_events(spark, d).where(part == n), f"{base}/in")
        start_landing(
            file_events(spark, f"{base}/in"), f"{base}/checkpoint", feed.feed_sink(f"{base}/feed"), available_now=True,
        ).awaitTermination()
    return feed.latest(spark, f"{base}/feed").select("event_id", "source_system", "base_amount", "timestamp")


@query
def dead_letters(spark: SparkSession, d: str) -> DataFrame:
    """Every raw event once: as it landed, or with the text of its dead letter."""
    base = scratch_path(spark, "dead")
    _write_texts(b.raw_events(spark, d), f"{base}/in")
    start_landing(
        file_events(spark, f"{base}/in"), f"{base}/checkpoint", folder_sink(f"{base}/out"),
        dead=landing.dead_letter_sink(f"{base}/dead"), available_now=True,
    ).awaitTermination()
    letters = landing.dead_letters(spark, f"{base}/dead")
    letters = letters.select(
        F.get_json_object("value", "$.event_id").alias("event_id"), "reason",
        F.when(F.col("reason") == parse.NOT_JSON, F.col("value")).alias("text"),
        F.nullif(F.regexp_extract("value", r'"base_amount":"?([^",]*)', 1), F.lit("")).alias("amount_text"),
        F.get_json_object("value", "$.timestamp").alias("timestamp_text"))
    whole = landed(spark, f"{base}/out").where("event_id IS NOT NULL").join(letters, "event_id", "left_anti")
    none = F.lit(None).cast("string")
    return letters.unionByName(whole.select(
        "event_id", none.alias("reason"), none.alias("text"), none.alias("amount_text"), none.alias("timestamp_text")))


# --- fraud -----------------------------------------------------------------


@query
def fraud_training_set(spark: SparkSession, d: str) -> DataFrame:
    return fraud.training_set(b.wallet_transaction(spark, d))


def _to_score(spark: SparkSession, d: str) -> DataFrame:
    return b.wallet_transaction(spark, d).select(
        "txn_id", "txn_type", F.col("txn_amount").alias("amount")
    )


@query
def fraud_rule_score(spark: SparkSession, d: str) -> DataFrame:
    return fraud.score(_to_score(spark, d), None)


@query
def fraud_type_codes(spark: SparkSession, d: str) -> DataFrame:
    """Codes as training sees the types and as scoring sees them."""
    return b.wallet_transaction(spark, d).select(
        "txn_id", fraud.txn_type_code("txn_type").alias("training_code"),
        fraud.txn_type_code("txn_type", ignore_case=True).alias("scoring_code"),
    )


@query
def fraud_model_score(spark: SparkSession, d: str) -> DataFrame:
    """Train, save, load, and score the same transactions."""
    path = scratch_path(spark, "fraud-model")
    fraud.train(b.wallet_transaction(spark, d), path)
    return fraud.score(_to_score(spark, d), fraud.load_model(spark, path))


@query
def fraud_model_checks(spark: SparkSession, d: str) -> DataFrame:
    """What does not depend on the trees: rows, bounds, flags, rows without an amount, save and load."""
    path = scratch_path(spark, "fraud-model")
    txns = b.wallet_transaction(spark, d)
    fraud.train(txns, path)
    unknown = F.when(F.col("txn_id") % 10 != 3, F.col("amount"))
    to_score = _to_score(spark, d).withColumn("amount", unknown)
    first = fraud.score(to_score, fraud.load_model(spark, path))
    again = fraud.score(to_score, fraud.load_model(spark, path)).select(
        "txn_id", F.col("risk_score").alias("second_score"))
    learn, test = fraud.split(fraud.training_set(txns))
    n_learn, n_test = learn.count(), test.count()
    checked = first.join(again, "txn_id").agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.count_if(F.col("risk_score").between(0, 1)).alias("within_bounds"),
        F.count_if(F.col("is_fraud") == (F.col("risk_score") > 0.5)).alias("flags_agree"),
        F.count_if(F.col("risk_score") == F.col("second_score")).alias("same_after_load"),
        F.count_if(F.col("amount").isNull() & F.col("risk_score").isNull() & F.col("is_fraud").isNull())
        .alias("unscored"),
    )
    share = n_test / max(1, n_learn + n_test)
    return checked.withColumn("split_rows", F.lit(n_learn + n_test).cast("bigint")).withColumn(
        "a_fifth_for_tests", F.lit(0.1 <= share <= 0.3))


# --- declared by the schema ------------------------------------------------


@query
def risk_bucket(spark: SparkSession, d: str) -> DataFrame:
    debt = b.debt_fact(spark, d).select("product_key", "days_past_due")
    return debt.withColumn("risk_bucket", measures.risk_bucket("days_past_due"))


@query
def scd2_customer(spark: SparkSession, d: str) -> DataFrame:
    """Names in capitals arrive for the customers below a balance, every customer named twice."""
    current = b.star_customer(spark, d).select(
        "customer_key", "cif_number", "full_name", "phone_number", "effective_date",
        "expiry_date", "is_current",
    )
    arrived = b.star_customer(spark, d).join(
        b.given(spark, d, "customer").select(
            (F.col("c_custkey") + 2).alias("customer_key"), "c_acctbal"
        ), "customer_key",
    ).select(
        "cif_number",
        F.when(F.col("c_acctbal") < 1000, F.upper("full_name")).otherwise(F.col("full_name"))
        .alias("full_name"),
        "phone_number",
    )
    return dims.scd2_merge(
        current, arrived.unionAll(arrived), "customer_key", "cif_number", ["full_name", "phone_number"],
        CHANGE_DAY, stored,
    )


@query
def fact_as_of(spark: SparkSession, d: str) -> DataFrame:
    """Loans, payments and wallet transactions with the name and validity their customer had then."""
    holders = b.star_customer(spark, d)
    kept = ["customer_key", "cif_number", "full_name", "effective_date", "expiry_date", "is_current"]
    small = b.given(spark, d, "customer").select((F.col("c_custkey") + 2).alias("customer_key"), "c_acctbal")
    name = F.when(F.col("c_acctbal") < 1000, F.upper("full_name")).otherwise(F.col("full_name"))
    arrived = holders.join(small, "customer_key").select("cif_number", name.alias("full_name"))
    versions = stored(dims.scd2_merge(
        holders.select(*kept), arrived, "customer_key", "cif_number", ["full_name"], PAYMENT_DAY, stored))
    users = b.wallet_account(spark, d).select("account_id", F.col("user_id").alias("cif_number"))

    def moved(kind: str, rows: DataFrame, id_: str, at: str, amount: str) -> DataFrame:
        return rows.select(
            F.lit(kind).alias("fact"), F.col(id_).cast("string").alias("id"), "cif_number",
            F.col(at).cast("timestamp").alias("at"), F.col(amount).alias("amount"))

    movements = moved(
        "debt", b.mortgage_loan(spark, d).withColumnRenamed("cif", "cif_number"), "contract_no", "disbursement_date",
        "principal_amount",
    ).unionByName(moved(
        "payment", b.payment_events(spark, d).withColumn("cif_number", F.col("account_id").cast("string")), "event_id",
        "timestamp", "amount",
    )).unionByName(moved(
        "wallet", b.wallet_transaction(spark, d).join(users, "account_id", "left"), "txn_id", "txn_date", "txn_amount"))
    return as_of_lookup(
        movements, versions.select("cif_number", "full_name", "effective_date", "expiry_date", "customer_key"),
        "cif_number", "at", "effective_date", "expiry_date", ["customer_key"], ["id"],
    ).drop("expiry_date", "customer_key")


@query
def settlement(spark: SparkSession, d: str) -> DataFrame:
    return facts.settlements(b.payment_transaction(spark, d))


@query
def refund_net(spark: SparkSession, d: str) -> DataFrame:
    return facts.net_of_refunds(b.payment_transaction(spark, d), b.payment_refund(spark, d))
