"""The driver's test tables seen as the source tables of the three businesses.

Projections only, apart from the region of a merchant, so that a query over
them grows with the given tables and the check SQL can repeat them. They are
written as SQL expressions: the driver then builds each one in a single call.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom import schemas

WIDTH = 12
BRANCHES = 25
EPOCH = "1995-01-01"  # time_key 1 of the bound facts


@cache
def _columns_of(path: str) -> T.StructType:
    """The schema in the file's footer, read once per table."""
    return SparkSession.active().read.parquet(path).schema


def given(spark: SparkSession, d: str, name: str) -> DataFrame:
    path = f"{d.rstrip('/')}/{name}.parquet"
    return spark.read.schema(_columns_of(path)).parquet(path)


def padded(prefix: str, number: str, width: int = WIDTH) -> str:
    digits = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def money(value: str) -> str:
    return f"CAST({value} AS DECIMAL(18,2))"


def cif(number: str) -> str:
    return padded("CIF", number)


def wallet(number: str) -> str:
    return padded("W", f"{number} + 500")


def branch(number: str) -> str:
    return padded("BR", f"{number} % {BRANCHES}", 2)


def day_number(ts: str) -> str:
    return f"CAST(datediff({ts}, DATE '{EPOCH}') + 1 AS BIGINT)"


def bind(df: DataFrame, table: str, **columns: str) -> DataFrame:
    """``df`` in the shape of a declared table, one SQL expression per column."""
    return schemas.conform(
        df.selectExpr(*[f"{text} AS `{name}`" for name, text in columns.items()]), table
    )


def bank_customer(spark: SparkSession, d: str) -> DataFrame:
    """Every eleventh customer lacks the national id and falls back to the phone."""
    return bind(
        given(spark, d, "customer"), "corebank.customer",
        cif=cif("c_custkey"),
        full_name="concat(' ', lower(c_name), ' ')",
        national_id=f"CASE WHEN c_custkey % 11 <> 7 THEN {padded('0', 'c_custkey')} END",
        phone=padded("09-", "c_custkey"),
        created_at=f"TIMESTAMP '{EPOCH}'",
    )


def mortgage_loan(spark: SparkSession, d: str) -> DataFrame:
    return bind(
        given(spark, d, "orders"), "corebank.mortgage_loan",
        contract_no=padded("LN", "o_orderkey"),
        cif=cif("o_custkey"),
        branch_code=branch("o_custkey"),
        product_type=PRODUCT,
        principal_amount=money("o_totalprice"),
        interest_rate="(o_orderkey % 900) / 10000",
        total_outstanding=f"CASE WHEN o_orderstatus = 'F' THEN 0 ELSE {money('o_totalprice')} END",
        disbursement_date="to_date(o_orderdate)",
        maturity_date="date_add(o_orderdate, 3650)",
        status="CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END",
    )


PRODUCT = "CASE WHEN o_orderpriority LIKE '1%' THEN 'MORTGAGE' ELSE 'HOME_EQUITY' END"


def wallet_account(spark: SparkSession, d: str) -> DataFrame:
    """One account per user of the event stream.

    Accounts of users divisible by three carry a bank customer's national id,
    two of them the same one; the next third has no national id, and of those
    some share a bank phone and some have no phone at all.
    """
    users = given(spark, d, "events").selectExpr("user_id AS n").distinct()
    return bind(
        users, "ewallet.account",
        account_id="n",
        user_id=wallet("n"),
        phone_number=f"""CASE WHEN n % 3 = 1 AND n % 5 = 0 THEN NULL
            WHEN n % 3 = 1 AND n % 2 = 0 THEN {padded('(09) ', 'n')} ELSE {padded('08', 'n')} END""",
        full_name="concat('wallet user ', CAST(n AS STRING))",
        national_id=f"""CASE n % 3 WHEN 0 THEN {padded('0', 'n - n % 6')}
            WHEN 2 THEN {padded('1', 'n')} END""",
        account_status="CASE WHEN n % 20 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END",
        kyc_level="""CASE WHEN n % 3 = 0 THEN 'ADVANCED' WHEN n % 2 = 0 THEN 'STANDARD'
            ELSE 'BASIC' END""",
        branch_code=branch("n"),
        created_at=f"TIMESTAMP '{EPOCH}'",
    )


WALLET_TXN_TYPE = """CASE event_type WHEN 'click' THEN 'PAYMENT' WHEN 'error' THEN 'TRANSFER'
    WHEN 'purchase' THEN 'TOP_UP' WHEN 'signup' THEN 'WITHDRAW' ELSE 'withdrawal' END"""
WALLET_AMOUNT = f"{money('value')} * 20"
WALLET_FEE = f"{money('event_id % 300')} / 100"


def wallet_transaction(spark: SparkSession, d: str) -> DataFrame:
    return bind(
        given(spark, d, "events"), "ewallet.transaction",
        txn_id="event_id",
        account_id="user_id",
        txn_type=WALLET_TXN_TYPE,
        txn_amount=WALLET_AMOUNT,
        fee_amount=WALLET_FEE,
        txn_status="""CASE event_id % 10 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'PENDING'
            ELSE 'SUCCESS' END""",
        txn_date="ts",
        branch_code=branch("user_id"),
    )


def merchant(spark: SparkSession, d: str) -> DataFrame:
    nation = given(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    places = nation.join(given(spark, d, "region"), "r_regionkey")
    supplier = given(spark, d, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    return bind(
        supplier.join(places, "n_nationkey"), "payment.merchant",
        merchant_id="s_suppkey",
        merchant_code=padded("M", "s_suppkey"),
        merchant_name="s_name",
        merchant_category="""element_at(array('RETAIL', 'FOOD', 'TRAVEL', 'EDUCATION', 'HEALTHCARE'),
            CAST(s_suppkey % 5 + 1 AS INT))""",
        branch_code=branch("n_nationkey"),
        region="r_name",
    )


LINE_ID = "concat_ws('-', 'P', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
LINE_PRICE = money("l_extendedprice")
# some amounts are negative, zero or missing
LINE_AMOUNT = f"""CASE WHEN l_linestatus = 'F' AND l_quantity = 48 THEN -{LINE_PRICE}
    WHEN l_linestatus = 'F' AND l_quantity = 49 THEN 0
    WHEN l_linestatus = 'F' AND l_quantity = 47 THEN NULL ELSE {LINE_PRICE} END"""
LINE_MERCHANT = f"CASE WHEN l_suppkey % 50 <> 7 THEN {padded('Supplier#', 'l_suppkey', 9)} END"
# the merchant column of the older event shape has names of its own
OLDER_MERCHANT = f"""CASE WHEN l_linenumber = 7 THEN {padded('Kiosk#', 'l_suppkey', 9)}
    ELSE {LINE_MERCHANT} END"""


def payment_events(spark: SparkSession, d: str) -> DataFrame:
    """Payment events; part numbers beyond the customers leave them unresolved."""
    return bind(
        given(spark, d, "lineitem"), "public.realtime_transactions",
        event_id=LINE_ID,
        source_system="'PAYMENT'",
        cif=cif("l_partkey"),
        merchant_name=LINE_MERCHANT,
        base_amount=LINE_AMOUNT,
        currency="'USD'",
        timestamp="l_shipdate",
        account_id="l_partkey",
        amount=LINE_AMOUNT,
        txn_type="CASE WHEN l_returnflag = 'R' THEN 'TRANSFER' ELSE 'PAYMENT' END",
        merchant=OLDER_MERCHANT,
        is_fraud_flag="CAST(l_linenumber = 1 AND l_discount > 0.05D AS INT)",
    )


def wallet_events(spark: SparkSession, d: str) -> DataFrame:
    """Wallet events; some wallets are unknown and some rows name an unknown source."""
    user = "CASE WHEN event_id % 7 = 0 THEN user_id + 1000000000 ELSE user_id END"
    return bind(
        given(spark, d, "events"), "public.realtime_transactions",
        event_id="concat('E-', CAST(event_id AS STRING))",
        source_system="""CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN 'LEGACY'
            ELSE 'EWALLET' END""",
        wallet_id=wallet(user),
        base_amount=money("value"),
        currency="'USD'",
        timestamp="ts",
    )


def realtime_transactions(spark: SparkSession, d: str) -> DataFrame:
    return payment_events(spark, d).unionByName(wallet_events(spark, d))


def raw_events(spark: SparkSession, d: str) -> DataFrame:
    """The same events as JSON text in ``value``, some of them broken.

    By the number of its payload: broken JSON, text in the amount, a bad
    timestamp. The payload also carries fields that the parser drops.
    """

    def payload(n: str, amount: str, at: str, **texts: str) -> str:
        """JSON text; a field whose value is null is left out."""
        fields = [
            f"""coalesce(concat('"{name}":"', {value}, '",'), '')""" for name, value in texts.items()
        ]
        number = f"""CASE WHEN {n} % 89 = 1 THEN '"many"' ELSE CAST({money(amount)} AS STRING) END"""
        stamp = f"""CASE WHEN {n} % 83 = 1 THEN 'soon'
            ELSE date_format({at}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END"""
        body = ", ".join(fields)
        return f"""CASE WHEN {n} % 97 = 1 THEN '{{broken' ELSE concat('{{', {body},
            '"currency":"USD","card_bin":"450630XXXX","base_amount":', {number},
            ',"timestamp":"', {stamp}, '"}}') END AS value"""

    lines = given(spark, d, "lineitem").selectExpr(
        payload(
            "l_partkey", "l_extendedprice", "l_shipdate", source_system="'PAYMENT'",
            event_id=LINE_ID, cif=cif("l_partkey"), merchant_name=LINE_MERCHANT,
        )
    )
    clicks = given(spark, d, "events").selectExpr(
        payload(
            "event_id", "value", "ts", source_system="'EWALLET'",
            event_id="concat('E-', CAST(event_id AS STRING))", wallet_id=wallet("user_id"),
        )
    )
    return lines.unionByName(clicks)


LINE_FEE = "CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_tax AS DECIMAL(4,2))"


def payment_transaction(spark: SparkSession, d: str) -> DataFrame:
    return bind(
        given(spark, d, "lineitem"), "payment.transaction",
        txn_id=LINE_ID,
        merchant_id="l_suppkey",
        customer_ref=cif("l_partkey"),
        txn_amount=LINE_PRICE,
        fee_amount=LINE_FEE,
        payment_method="CASE WHEN l_linestatus = 'O' THEN 'CARD' ELSE 'QR_CODE' END",
        txn_status="CASE l_returnflag WHEN 'R' THEN 'REFUNDED' WHEN 'A' THEN 'FAILED' ELSE 'SUCCESS' END",
        txn_date="l_shipdate",
        settlement_date="date_add(l_shipdate, 1)",
        branch_code=branch("l_suppkey"),
    )


def payment_refund(spark: SparkSession, d: str) -> DataFrame:
    """Two refunds for each returned line, one of them still pending."""
    returned = given(spark, d, "lineitem").where("l_returnflag = 'R'")
    return bind(
        returned, "payment.refund",
        refund_id=f"concat('R', {LINE_ID})",
        original_txn_id=LINE_ID,
        refund_amount=money("l_quantity"),
        refund_status="explode(array('COMPLETED', 'PENDING'))",
        refund_date="l_shipdate",
    )


def star_customer(spark: SparkSession, d: str) -> DataFrame:
    """The customer number takes all three forms that the daily loads join on."""
    return bind(
        given(spark, d, "customer"), "star.dim_customer",
        customer_key="c_custkey + 2",
        cif_number=f"""CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS STRING)
            WHEN 1 THEN {cif('c_custkey')} ELSE {wallet('c_custkey')} END""",
        full_name="c_name",
        national_id=padded("0", "c_custkey"),
        phone_number=padded("09", "c_custkey"),
        effective_date=f"DATE '{EPOCH}'",
        expiry_date="CASE WHEN c_custkey % 7 = 0 THEN DATE '2020-01-01' END",
        is_current="c_custkey % 7 <> 0",
    )


def star_branch(spark: SparkSession, d: str) -> DataFrame:
    nation = given(spark, d, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return bind(
        nation.join(given(spark, d, "region"), "r_regionkey"), "star.dim_branch",
        branch_key="n_nationkey + 1",
        branch_code=f"CASE WHEN n_nationkey = 0 THEN 'MAIN' ELSE {padded('BR', 'n_nationkey', 2)} END",
        branch_name="n_name",
        region_name="r_name",
    )


def star_product(spark: SparkSession, d: str) -> DataFrame:
    return bind(
        given(spark, d, "orders"), "star.dim_product",
        product_key="o_orderkey + 1",
        contract_number=padded("LN", "o_orderkey"),
        product_type=PRODUCT,
        interest_rate="(o_orderkey % 900) / 10000",
        maturity_date="date_add(o_orderdate, 3650)",
    )


def star_merchant(spark: SparkSession, d: str) -> DataFrame:
    rows = merchant(spark, d).selectExpr("*", "merchant_id + 1 AS merchant_key")
    return schemas.conform(rows, "star.dim_merchant")


def star_channel(spark: SparkSession, d: str) -> DataFrame:
    """One channel per type of event in the stream."""
    codes = given(spark, d, "events").select("event_type").distinct().selectExpr(
        """CASE event_type WHEN 'click' THEN 'EWALLET' WHEN 'error' THEN 'CARD'
        WHEN 'purchase' THEN 'QR_CODE' WHEN 'signup' THEN 'BANK_TRANSFER' ELSE 'ATM' END AS code"""
    )
    return bind(
        codes, "star.dim_channel",
        channel_key="array_position(array('EWALLET', 'CARD', 'QR_CODE', 'BANK_TRANSFER', 'ATM'), code)",
        channel_code="code",
        channel_name="initcap(code)",
        channel_type="CASE WHEN code = 'ATM' THEN 'PHYSICAL' ELSE 'DIGITAL' END",
        product_line="'PAYMENT'",
    )


def debt_fact(spark: SparkSession, d: str) -> DataFrame:
    days = "CAST(o_orderkey % 120 AS INT)"
    return bind(
        given(spark, d, "orders"), "star.fact_debt_status",
        customer_key="o_custkey + 2",
        branch_key=f"o_custkey % {BRANCHES} + 1",
        product_key="o_orderkey + 1",
        time_key=day_number("o_orderdate"),
        principal_amount=money("o_totalprice"),
        interest_amount=f"{money('o_orderkey % 700')} / 100",
        total_outstanding=f"""CASE WHEN o_custkey % {BRANCHES} = 3 THEN 0
            ELSE {money('o_totalprice')} END""",
        days_past_due=days,
        risk_bucket=f"""CASE WHEN {days} <= 0 THEN 'CURRENT' WHEN {days} <= 30 THEN '1-30 DPD'
            WHEN {days} <= 60 THEN '31-60 DPD' WHEN {days} <= 90 THEN '61-90 DPD' ELSE 'NPL' END""",
    )


def wallet_fact(spark: SparkSession, d: str) -> DataFrame:
    return bind(
        given(spark, d, "events"), "star.fact_ewallet_transaction",
        customer_key="user_id + 2",
        branch_key=f"user_id % {BRANCHES} + 1",
        time_key=day_number("ts"),
        channel_key="event_id % 5 + 1",
        txn_amount=WALLET_AMOUNT,
        fee_amount=WALLET_FEE,
        net_amount=f"{WALLET_AMOUNT} - {WALLET_FEE}",
        txn_type=WALLET_TXN_TYPE,
        txn_status="CASE WHEN event_id % 10 = 0 THEN 'FAILED' ELSE 'SUCCESS' END",
    )


def payment_fact(spark: SparkSession, d: str) -> DataFrame:
    """Keys run a little beyond the dimensions, so the key reports find orphans."""
    return bind(
        given(spark, d, "lineitem"), "star.fact_payment_transaction",
        customer_key="l_partkey + 2",
        merchant_key="l_suppkey + 1",
        branch_key=f"l_suppkey % {BRANCHES + 1} + 1",
        time_key=day_number("l_shipdate"),
        channel_key="l_linenumber % 6 + 1",
        txn_amount=LINE_PRICE,
        fee_amount=LINE_FEE,
        net_amount=f"{LINE_PRICE} - {LINE_FEE}",
        refund_amount=f"CASE WHEN l_returnflag = 'R' THEN {LINE_PRICE} ELSE 0 END",
        payment_method="CASE WHEN l_linestatus = 'O' THEN 'CARD' ELSE 'QR_CODE' END",
        txn_status="CASE WHEN l_returnflag = 'R' THEN 'REFUNDED' ELSE 'SUCCESS' END",
    )


@cache
def date_bounds(d: str) -> tuple[str, str]:
    """First and last day that any bound fact can carry, read once for a folder of tables.

    The first day is that of the data where it lies before the day of key 1:
    keys count on below 1, and no fact is without its day.
    """
    spark = SparkSession.active()
    ends = [
        given(spark, d, table).selectExpr(f"to_date(min({ts})) AS first", f"to_date(max({ts})) AS last")
        for table, ts in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    row = ends[0].unionByName(ends[1]).unionByName(ends[2]).selectExpr(
        f"CAST(least(min(first), DATE '{EPOCH}') AS STRING) AS first",
        f"CAST(greatest(max(last), DATE '{EPOCH}') AS STRING) AS last",
    ).first()
    return row["first"], row["last"]
