"""The daily load over a warehouse folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import quality, tables
from ledgerloom.operators.keys import serial_ids
from ledgerloom.plans import dims, facts, increments, views
from ledgerloom.sources.readers import declared_table
from ledgerloom.sources.seeds import CALENDAR_END, CALENDAR_START, calendar
from ledgerloom.streaming.landing import (
    BATCH_COLUMN,
    MONTH_COLUMN,
    batch_folders,
    compact,
    in_months,
    landed,
    month_of,
    reload_landed,
    with_batches,
)

LANDING = "public.realtime_transactions"
FACTS = "mdm.fact_enterprise_transaction"
RETIRED = "mdm.retired_customer"  # customers that facts may point at and the dimension lacks, and their survivors
LEDGER = "mdm.loaded_batches"  # the batches of the landing table that daily runs have taken up, and their days
TASKS = 1 << 15  # of one write: a task owns 2**33 row ids, and a day 2**48
FACT_DAY = "trans_date"
LOG_DAY = "log_date"
STAR_DAY = "time_key"
CHANGED = "serving.changed_days"
# The stored sums of a view, of which fact, and how they are made.
SUMS = {
    "serving.debt_days": ("star.fact_debt_status", views.debt_days),
    "serving.ewallet_days": ("star.fact_ewallet_transaction", views.wallet_days),
    "serving.payment_days": ("star.fact_payment_transaction", views.payment_days),
}


class Warehouse:
    """Tables as Parquet folders ``root/<schema.table>``.

    The enterprise fact is partitioned by day and the quarantine log by the day
    it was checked for, so a day is replaced by replacing one folder. The star
    facts are partitioned by ``time_key``, which stands for one day.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, table: str) -> DataFrame:
        """The declared columns of a table."""
        return declared_table(self.spark, self.root, table)

    def events(self, ds: str) -> DataFrame:
        """Landed events of one day."""
        return landed(self.spark, self.path(LANDING), ds)

    def stored(self, table: str) -> DataFrame:
        """A table with all stored columns, row ids and partition columns included."""
        return tables.read(self.spark, self.path(table))

    def ledger(self) -> DataFrame:
        """(batch_id, day): what daily runs have taken up of the landing table."""
        schema = f"{BATCH_COLUMN} string, day date"
        if tables.exists(self.spark, self.path(LEDGER)):
            return tables.read(self.spark, self.path(LEDGER), schema)
        return self.spark.createDataFrame([], schema)

    def retired(self) -> DataFrame:
        """(customer_sk, bank_cif, wallet_user_id, surviving_customer_sk) of members that are gone."""
        schema = "customer_sk bigint, bank_cif string, wallet_user_id string, surviving_customer_sk bigint"
        if tables.exists(self.spark, self.path(RETIRED)):
            return tables.read(self.spark, self.path(RETIRED), schema)
        return self.spark.createDataFrame([], schema)

    def facts(self) -> DataFrame:
        """The enterprise facts under the keys of the customers that the dimension has now."""
        return dims.under_survivors(self.stored(FACTS), self.retired())

    def existing_path(self, table: str) -> bool:
        return tables.exists(self.spark, self.path(table))

    def existing(self, table: str) -> DataFrame | None:
        return self.table(table) if self.existing_path(table) else None

    def reload(self, table: str, rows: DataFrame) -> None:
        rows = schemas.conform(rows, table)
        if table == LANDING:
            reload_landed(rows, self.path(table))
        else:
            tables.overwrite(rows, self.path(table))

    def revise(self, table: str, rows: DataFrame) -> None:
        """Reload with rows that were made from the table itself."""
        tables.rewrite(schemas.conform(rows, table), self.path(table))

    def replace_day(self, table: str, rows: DataFrame, column: str, value: object,
                    row_id: str | None = None) -> None:
        """Replace one partition, with row ids of the day's own range when asked for."""
        rows = schemas.conform(rows, table)
        if row_id:
            rows = serial_ids(rows, row_id, start=_first_id(value), tasks=TASKS)
        tables.replace_partition(rows, self.path(table), column, value)


def _first_id(ds: object) -> int:
    """Row ids of a day start at its number since 2000 times 2**48.

    Days before 2000 have negative ids. Days cannot collide, since a write with
    2**15 tasks or more fails and a task owns 2**33 ids.
    """
    return (dt.date.fromisoformat(str(ds)) - dt.date(2000, 1, 1)).days << 48


def together(spark: SparkSession, *jobs: Callable[[], None]) -> None:
    """Run independent loads at the same time, so that one fills the other's idle tasks."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]:
            running.result()


def load_dimensions(w: Warehouse, renumber: bool = False, events: DataFrame | None = None) -> None:
    """Customers with their match log beside merchants, then product accounts.

    New merchants are looked for in ``events``, without it in all landed ones.

    Members that the tables hold keep their keys, because facts of earlier days
    point at them. Customers that are gone, most of them because two turned out
    to be one person, are kept with the key that took their place, see
    ``Warehouse.facts``; their accounts keep their product key. ``renumber``
    numbers everything anew; all facts have to be loaded again after that.
    """
    wallet = w.table("ewallet.account")

    def held(table: str) -> DataFrame | None:
        return None if renumber else w.existing(table)

    def customers() -> None:
        bank, known = w.table("corebank.customer"), held("mdm.dim_customer")
        if known is None:
            if w.existing_path(RETIRED):
                tables.rewrite(w.retired().limit(0), w.path(RETIRED))
            w.reload("mdm.dim_customer", dims.customer_dimension(bank, wallet, tables.stored))
        else:
            rows = tables.stored(
                dims.customer_dimension_keeping_keys(bank, wallet, known, tables.stored, w.retired()), "customers")
            # first the ways of the keys that go, then the dimension without them
            tables.rewrite(dims.retired_customers(known, rows, w.retired()), w.path(RETIRED))
            w.revise("mdm.dim_customer", rows)
        log = dims.deduplication_log(w.table("mdm.dim_customer"))
        w.reload("mdm.mdm_deduplication_log", log)

    def merchants() -> None:
        known = held("mdm.dim_merchant")
        named = w.table(LANDING)
        if known is not None and events is not None:
            members = known.where(F.col("merchant_sk") != schemas.UNKNOWN_SK)
            named = events.select("merchant_name").unionByName(members.select("merchant_name"))
        w.revise("mdm.dim_merchant", dims.merchant_dimension(named, tables.stored, known))

    together(w.spark, customers, merchants)
    accounts = held("mdm.dim_product_account")
    if accounts is not None:
        accounts = dims.under_survivors(accounts, w.retired())
    products = dims.product_dimension(
        wallet, w.table("corebank.mortgage_loan"), w.table("mdm.dim_customer"), tables.stored, accounts
    )
    w.revise("mdm.dim_product_account", products)


def load_enterprise_facts(w: Warehouse, ds: str) -> None:
    """The day's events and disbursements, replacing what the day held before."""
    customers = w.table("mdm.dim_customer")
    realtime = facts.realtime_facts(w.events(ds), customers, w.table("mdm.dim_merchant"))
    lending = facts.lending_facts(
        w.table("corebank.mortgage_loan"), customers, w.table("mdm.dim_product_account"), ds
    )
    w.replace_day(FACTS, realtime.unionByName(lending), FACT_DAY, ds, "fact_id")


def monitor_quality(w: Warehouse, ds: str) -> None:
    """Quarantine the day's invalid amounts; a second run replaces the first."""
    day = w.stored(FACTS).where(F.col(FACT_DAY) == F.lit(ds).cast("date"))
    row = day.select("fact_id", *schemas.struct_of(FACTS).names)
    w.replace_day("mdm.dq_quarantine_log", quality.invalid_amounts(row), LOG_DAY, ds, "log_id")


class Arrivals:
    """What the landing table holds and the ledger does not, and the other way round.

    A batch is known by its name and the month of its events. Batches that a
    reload took away count too: their days have to be loaded again without them.
    Names and days are joined as tables; only the days, a row for each day of
    the calendar at most, come to the driver.
    """

    def __init__(self, w: Warehouse) -> None:
        landing, folders = w.path(LANDING), batch_folders(w.spark, w.path(LANDING))
        folders = folders.select(F.col(MONTH_COLUMN).alias("month"), F.col(BATCH_COLUMN).alias("batch"))
        ledger = tables.stored(w.ledger().withColumn("known_month", month_of(F.col("day"))), "ledger")
        same = F.col("month").eqNullSafe(F.col("known_month")) & (F.col("batch") == F.col(BATCH_COLUMN))
        new = tables.stored(folders.join(ledger, same, "left_anti"), "new")
        self.kept = ledger.join(folders, same, "left_semi").select(BATCH_COLUMN, "day")
        gone = ledger.join(folders, same, "left_anti").select(BATCH_COLUMN, "day")
        rows = with_batches(w.spark, landing)
        here = F.col("month").eqNullSafe(F.col(MONTH_COLUMN)) & (F.col("batch") == F.col(BATCH_COLUMN))
        self.events = rows.join(new, here, "left_semi")
        found = self.events.select(BATCH_COLUMN, F.to_date("timestamp").alias("day")).distinct()
        self.found = tables.stored(found, "found")
        self.days = [r[0] for r in self.found.select("day").union(gone.select("day")).distinct().collect()]

    def record(self, w: Warehouse) -> None:
        """Their facts are loaded: the ledger is as the landing table was."""
        tables.overwrite(self.kept.unionByName(self.found), w.path(LEDGER))


def _on_days(day: str | Column, days: list) -> Column:
    """Rows of these days; None stands for rows without one."""
    day = F.col(day) if isinstance(day, str) else day
    dated = F.coalesce(day.isin([d for d in days if d is not None]), F.lit(False))
    return dated | day.isNull() if None in days else dated


def _with_day_ids(rows: DataFrame, key: str, day: str) -> DataFrame:
    """Row ids in each day's own range, see ``_first_id``; below all days for rows without one."""
    number = F.coalesce(F.datediff(day, F.lit("2000-01-01").cast("date")), F.lit(-20000)).cast("bigint")
    return serial_ids(rows, key, start=F.shiftleft(number, 48), tasks=TASKS)


def _broken(loaded: DataFrame) -> DataFrame:
    """Quarantine rows of stored facts; those without a timestamp are all in the partition without a day."""
    undated = quality.undated(loaded.where(F.col(FACT_DAY).isNull()), (FACT_DAY,))
    return quality.invalid_amounts(loaded, (FACT_DAY,)).unionByName(undated)


def catch_up(w: Warehouse, ds: str, arrived: Arrivals) -> None:
    """Load the days of all events that have come or gone since the last run, ``ds`` aside.

    An event counts by its arrival: a late one has its day loaded again, and one
    without a readable timestamp goes to the partition without a day and to the
    quarantine. A day that a reload of the landing table emptied is emptied too.
    So after a run the facts are those of the landed events. Disbursements of
    those days come along.
    """
    landing = with_batches(w.spark, w.path(LANDING))
    touched = [d for d in arrived.days if str(d) != ds]
    if touched:
        events = landing.where(in_months(touched)).where(_on_days(F.to_date("timestamp"), touched))
        customers = w.table("mdm.dim_customer")
        realtime = facts.realtime_facts(
            events.select(*schemas.struct_of(LANDING).names), customers, w.table("mdm.dim_merchant")
        )
        loans = w.table("corebank.mortgage_loan").where(_on_days("disbursement_date", touched))
        loans = loans.where(F.col("disbursement_date").isNotNull())
        lending = facts.lending_facts(loans, customers, w.table("mdm.dim_product_account"))
        rows = schemas.conform(realtime.unionByName(lending), FACTS)
        rows = _with_day_ids(rows.withColumn(FACT_DAY, F.to_date("trans_timestamp")), "fact_id", FACT_DAY)
        tables.replace_partitions(rows, w.path(FACTS), FACT_DAY, touched)

        names = ["fact_id", *schemas.struct_of(FACTS).names, FACT_DAY]
        loaded = w.stored(FACTS).where(_on_days(FACT_DAY, touched)).select(*names)
        broken = _broken(loaded)
        log = broken.withColumnRenamed(FACT_DAY, LOG_DAY).withColumn("created_at", F.current_timestamp())
        log = _with_day_ids(log, "log_id", LOG_DAY)
        tables.replace_partitions(log, w.path("mdm.dq_quarantine_log"), LOG_DAY, touched)


def move_facts(w: Warehouse) -> int:
    """Write the facts of retired customers under their survivors; the number of files that were written anew."""
    moved = w.retired().where(F.col("surviving_customer_sk").isNotNull())
    return tables.update_using(w.spark, w.path(FACTS), moved, "customer_sk", "surviving_customer_sk", FACT_DAY)


def compact_landing(w: Warehouse, **sizes: int) -> bool:
    """Pack the small batches that daily runs have taken up, and rename them in the ledger; False if there are none.

    Stopped between the two, the next run takes the packed batch for a new one
    and loads its days once more.
    """
    ledger = tables.stored(w.ledger().withColumn(MONTH_COLUMN, month_of(F.col("day"))), "ledger")
    packed = compact(w.spark, w.path(LANDING), ledger, **sizes)
    if packed is None:
        return False
    name, gone = packed
    gone = gone.select(F.col(MONTH_COLUMN).alias("month"), F.col(BATCH_COLUMN).alias("batch"))
    same = F.col("month").eqNullSafe(F.col(MONTH_COLUMN)) & (F.col("batch") == F.col(BATCH_COLUMN))
    batch = F.when(F.col("batch").isNull(), F.col(BATCH_COLUMN)).otherwise(F.lit(name))
    renamed = ledger.join(gone, same, "left").select(batch.alias(BATCH_COLUMN), "day").distinct()
    tables.overwrite(renamed, w.path(LEDGER))
    return True


def constraint_report(w: Warehouse) -> DataFrame:
    """``(table_name, column_name, rule, broken_rows)`` for the declared constraints of all stored tables.

    Broken rows are those without a required value, those beyond the first of a
    unique value, and those whose key the named table lacks.
    """
    held = {t: w.table(t) for t in schemas.TABLES if tables.exists(w.spark, w.path(t))}
    return quality.constraint_report(held, schemas.REQUIRED, schemas.UNIQUE, schemas.FOREIGN_KEYS)


def run_daily(w: Warehouse, ds: str) -> None:
    """Dimensions, facts and quality checks of the day and of late events, in that order.

    The ledger is written last, so a run that stops is made up for by the next.
    """
    arrived = Arrivals(w)
    load_dimensions(w, events=arrived.events)
    catch_up(w, ds, arrived)
    load_enterprise_facts(w, ds)
    monitor_quality(w, ds)
    arrived.record(w)


def load_calendar(w: Warehouse, start: str | None = None, end: str | None = None) -> None:
    """Add the missing days of the calendar; keys of the days already there stay."""
    days = calendar(w.spark, start or CALENDAR_START, end or CALENDAR_END)
    path = w.path("star.dim_time")
    existing = None
    first_key = 1
    if tables.exists(w.spark, path):
        existing = w.table("star.dim_time")
        last = existing.agg(F.max("time_key")).first()[0]
        first_key = (last or 0) + 1
    tables.append(dims.missing_days(days, existing, first_key, start or CALENDAR_START), path)


def run_star_day(w: Warehouse, ds: str) -> None:
    """The day's star facts of wallet, lending and payment, each replacing its day."""
    time = w.table("star.dim_time")
    customers = w.table("star.dim_customer")
    branches = w.table("star.dim_branch")
    # full_date is unique in the calendar, so this is one row at most
    keys = time.where(F.col("full_date") == F.lit(ds).cast("date")).select("time_key").take(2)
    if len(keys) != 1:
        raise ValueError(f"the calendar holds {len(keys)} rows for {ds}")
    time_key = keys[0][0]
    loads = {
        "star.fact_ewallet_transaction": facts.wallet_facts(
            w.table("ewallet.transaction"), w.table("ewallet.account"), customers, time, ds
        ),
        "star.fact_debt_status": facts.debt_facts(
            w.table("corebank.mortgage_loan"), customers, branches, time, ds
        ),
        "star.fact_payment_transaction": facts.payment_facts(
            w.events(ds), customers, w.table("star.dim_merchant"), branches, time
        ),
    }
    changed = increments.ChangedDays(w.spark, w.path(CHANGED))
    for name in SUMS:
        changed.add(name, [time_key])
    together(
        w.spark,
        *[partial(w.replace_day, table, rows, STAR_DAY, time_key) for table, rows in loads.items()],
    )
    refresh_sums(w)


def refresh_sums(w: Warehouse) -> None:
    """Make the stored sums of the views again for the days whose star facts have changed; all of them the first time."""
    changed = increments.ChangedDays(w.spark, w.path(CHANGED))
    for name, (fact, sums) in SUMS.items():
        if not w.existing_path(fact):
            continue
        rows = w.stored(fact)
        if w.existing_path(name):
            increments.refresh(rows, sums, w.path(name), changed.of(name))
        else:
            increments.build(rows, sums, w.path(name))
        changed.strike(name)


def serve_views(w: Warehouse) -> dict[str, DataFrame]:
    """The lending, wallet and payment views, from the stored sums."""
    time, branches = w.table("star.dim_time"), w.table("star.dim_branch")
    debt, wallet, payment = [increments.read(w.spark, w.path(name)) for name in SUMS]
    return {
        "npl_by_branch_month": views.npl_of_days(debt, time, branches),
        "ewallet_monthly": views.ewallet_of_days(wallet, time, branches),
        "payment_revenue": views.payment_of_days(
            payment, time, w.table("star.dim_merchant"), w.table("star.dim_channel"), branches),
    }
