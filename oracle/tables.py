"""Named subqueries. Names start with ``t_`` so that no column is mistaken for one."""


def pad(prefix: str, number: str, width: int = 12) -> str:
    return f"'{prefix}' || lpad(cast({number} as varchar), {width}, '0')"


def bucket(*columns: str) -> str:
    key = " || '|' || ".join(f"coalesce(cast({c} as varchar), '\\N')" for c in columns)
    return f"substr(md5({key}), 1, 3)"


def numbered(*columns: str) -> str:
    order = ", ".join([bucket(*columns), *[f"{c} nulls first" for c in columns]])
    return f"row_number() over (order by {order})"


LINE_ID = (
    "'P-' || cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) || '-' || "
    "cast(l_partkey as varchar) || '-' || cast(l_suppkey as varchar)"
)
TXN_TYPE = (
    "case event_type when 'click' then 'PAYMENT' when 'error' then 'TRANSFER' "
    "when 'purchase' then 'TOP_UP' when 'signup' then 'WITHDRAW' else 'withdrawal' end"
)
CODE_TYPE = "case {0} when 'WITHDRAWAL' then 1 when 'TOP_UP' then 2 else 0 end"

TABLES: dict[str, str] = {}

# --- source tables -----------------------------------------------------------

TABLES["t_bank"] = f"""
select {pad('CIF', 'c_custkey')} as cif,
       ' ' || lower(c_name) || ' ' as full_name,
       case when c_custkey % 11 <> 7 then {pad('0', 'c_custkey')} end as national_id,
       {pad('09-', 'c_custkey')} as phone
from customer"""

TABLES["t_wallet"] = f"""
select n as account_id,
       {pad('W', 'n + 500')} as user_id,
       case when n % 3 = 1 and n % 5 = 0 then null
            when n % 3 = 1 and n % 2 = 0 then {pad('(09) ', 'n')}
            else {pad('08', 'n')} end as phone,
       'wallet user ' || cast(n as varchar) as full_name,
       case n % 3 when 0 then {pad('0', 'n - n % 6')} when 2 then {pad('1', 'n')} end as national_id,
       case when n % 20 = 0 then 'SUSPENDED' else 'ACTIVE' end as account_status,
       case when n % 3 = 0 then 'ADVANCED' when n % 2 = 0 then 'STANDARD' else 'BASIC' end as kyc_level
from (select distinct user_id as n from events)"""

TABLES["t_loan"] = f"""
select {pad('LN', 'o_orderkey')} as contract_no,
       {pad('CIF', 'o_custkey')} as cif,
       {pad('BR', 'o_custkey % 25', 2)} as branch_code,
       cast(o_totalprice as decimal(18,2)) as principal,
       case when o_orderstatus = 'F' then 0 else cast(o_totalprice as decimal(18,2)) end as outstanding,
       cast(o_orderdate as date) as paid_out
from orders"""

TABLES["t_wallet_txn"] = f"""
select event_id as txn_id, user_id as account_id, {TXN_TYPE} as txn_type,
       cast(value as decimal(18,2)) * 20 as amount,
       cast((event_id % 300) / 100.0 as decimal(18,2)) as fee,
       case event_id % 10 when 0 then 'FAILED' when 1 then 'PENDING' else 'SUCCESS' end as txn_status,
       ts
from events"""

TABLES["t_pay"] = f"""
select {LINE_ID} as event_id, 'PAYMENT' as source_system,
       {pad('CIF', 'l_partkey')} as cif, cast(null as varchar) as wallet_id,
       case when l_suppkey % 50 <> 7 then {pad('Supplier#', 'l_suppkey', 9)} end as merchant_name,
       case when l_linestatus = 'F' and l_quantity = 48 then -cast(l_extendedprice as decimal(18,2))
            when l_linestatus = 'F' and l_quantity = 49 then 0
            when l_linestatus = 'F' and l_quantity = 47 then null
            else cast(l_extendedprice as decimal(18,2)) end as amount,
       l_shipdate as ts, l_partkey as account_id,
       case when l_returnflag = 'R' then 'TRANSFER' else 'PAYMENT' end as txn_type,
       case when l_linenumber = 7 then {pad('Kiosk#', 'l_suppkey', 9)}
            when l_suppkey % 50 <> 7 then {pad('Supplier#', 'l_suppkey', 9)} end as merchant,
       case when l_linenumber = 1 and l_discount > 0.05 then 1 else 0 end as flag
from lineitem"""

TABLES["t_click"] = f"""
select 'E-' || cast(event_id as varchar) as event_id,
       case when event_type = 'error' and event_id % 10 = 0 then 'LEGACY' else 'EWALLET' end as source_system,
       cast(null as varchar) as cif,
       {pad('W', 'case when event_id % 7 = 0 then user_id + 1000000000 else user_id end + 500')} as wallet_id,
       cast(null as varchar) as merchant_name,
       cast(value as decimal(18,2)) as amount, ts
from events"""

TABLES["t_event"] = """
select event_id, source_system, cif, wallet_id, merchant_name, amount, ts from t_pay
union all
select event_id, source_system, cif, wallet_id, merchant_name, amount, ts from t_click"""

TABLES["t_payment"] = f"""
select {LINE_ID} as txn_id, l_suppkey as merchant_id,
       cast(l_extendedprice as decimal(18,2)) as amount,
       cast(round(l_quantity * l_tax * 100) as bigint) / 100.0 as fee,
       case l_returnflag when 'R' then 'REFUNDED' when 'A' then 'FAILED' else 'SUCCESS' end as txn_status,
       cast(l_shipdate as date) + 1 as settled_on,
       l_returnflag, l_quantity
from lineitem"""

# --- enterprise dimensions -----------------------------------------------------

# A wallet belongs to the bank customer with its key: the national id or, without one, the phone.
# First the wallets with what the bank knows of them, then the bank rows whose key no wallet has.
TABLES["t_party"] = """
with bank_keys as (
  select cif, national_id, regexp_replace(phone, '[^0-9]', '', 'g') as digits, upper(trim(full_name)) as shown
  from t_bank
), wallet_keys as (
  select account_id, user_id, national_id, kyc_level, upper(trim(full_name)) as shown,
         regexp_replace(phone, '[^0-9]', '', 'g') as digits
  from t_wallet
), looked_up as (
  select w.*, b.cif, b.digits as bank_digits, b.shown as bank_shown
  from wallet_keys w left join bank_keys b
    on ifnull(b.national_id, 'P_' || b.digits) = ifnull(w.national_id, 'P_' || w.digits)
)
select cif, account_id, user_id, ifnull(national_id, 'PH_' || digits) as national_id,
       ifnull(bank_digits, digits) as phone, ifnull(bank_shown, shown) as full_name,
       if(cif is null, kyc_level, 'TIER_2') as kyc
from looked_up
union all
select cif, null, null, national_id, digits, shown, 'TIER_2'
from bank_keys b
where not exists (select 1 from wallet_keys w
                  where ifnull(w.national_id, 'P_' || w.digits) = ifnull(b.national_id, 'P_' || b.digits))"""

TABLES["t_customer"] = f"""
select 1 as customer_sk, 'N/A' as national_id, 'N/A' as phone_number,
       'General/Unknown/N/A' as full_name, false as is_wallet_user, false as is_borrower,
       'TIER_0' as kyc_level, cast(null as varchar) as bank_cif, cast(null as varchar) as wallet_user_id
union all
select 1 + {numbered('cif', 'account_id')}, national_id, phone, full_name,
       user_id is not null, cif is not null, kyc, cif, user_id
from t_party"""

TABLES["t_merchant"] = f"""
select 1 as merchant_sk, 'NA' as source_merchant_id, 'General/Unknown' as merchant_name
union all
select 1 + {numbered('merchant_name')}, merchant_name, merchant_name
from (select distinct merchant_name from t_event)"""

TABLES["t_owned"] = """
select c.customer_sk, 'WALLET_ACCOUNT' as product_type, cast(w.account_id as varchar) as own_id,
       w.account_status as status, cast(w.account_id as varchar) as source_key
from t_wallet w, t_customer c where c.wallet_user_id = w.user_id
union all
select c.customer_sk, 'MORTGAGE_LOAN', l.branch_code || '_' || l.cif, 'ACTIVE', l.contract_no
from t_loan l, t_customer c where c.bank_cif = l.cif"""

TABLES["t_product"] = f"""
select 1 as product_sk, 1 as customer_sk, 'N/A' as product_type, 'N/A' as source_account_id, 'N/A' as status
union all
select 1 + {numbered('product_type', 'source_key', 'customer_sk')},
       customer_sk, product_type, own_id, status
from t_owned"""

# --- enterprise facts -----------------------------------------------------------

TABLES["t_realtime"] = """
select coalesce(p.customer_sk, w.customer_sk, 1) as customer_sk,
       coalesce(m.merchant_sk, 1) as merchant_sk, cast(1 as bigint) as product_sk,
       e.source_system, e.event_id as source_trans_id, e.amount as base_amount,
       'USD' as currency_code, e.ts as trans_timestamp, 'COMPLETED' as status
from t_event e
left join t_customer p on e.source_system = 'PAYMENT' and e.cif = p.bank_cif
left join t_customer w on e.source_system = 'EWALLET' and e.wallet_id = w.wallet_user_id
left join t_merchant m on e.merchant_name = m.merchant_name"""

TABLES["t_lending"] = """
select c.customer_sk, cast(1 as bigint) as merchant_sk,
       (select min(p.product_sk) from t_product p
        where p.product_type = 'MORTGAGE_LOAN' and p.customer_sk = c.customer_sk
          and p.source_account_id = l.branch_code || '_' || l.cif) as product_sk,
       'COREBANK' as source_system, 'LND_' || l.branch_code as source_trans_id,
       l.principal as base_amount, 'USD' as currency_code,
       cast(l.paid_out as timestamp) as trans_timestamp, 'DISBURSED' as status
from t_loan l join t_customer c on c.bank_cif = l.cif"""

TABLES["t_enterprise"] = "select * from t_realtime union all by name select * from t_lending"

# --- star schema -----------------------------------------------------------------

TABLES["t_last_day"] = """
select max(d) as d from (select max(cast(o_orderdate as date)) as d from orders
  union all select max(cast(l_shipdate as date)) from lineitem
  union all select max(cast(ts as date)) from events)"""

TABLES["t_time"] = """
select date_diff('day', date '1995-01-01', full_date) + 1 as time_key, full_date,
       cast(day(full_date) as integer) as day, cast(month(full_date) as integer) as month,
       cast(quarter(full_date) as integer) as quarter, cast(year(full_date) as integer) as year,
       rpad(dayname(full_date), 9, ' ') as day_name, rpad(monthname(full_date), 9, ' ') as month_name,
       case when isodow(full_date) >= 6 then 'true' else 'false' end as is_weekend
from (select cast(unnest(generate_series(timestamp '1995-01-01', cast(d as timestamp), interval 1 day)) as date)
             as full_date from t_last_day)"""

TABLES["t_holder"] = f"""
select c_custkey + 2 as customer_key,
       case c_custkey % 3 when 0 then cast(c_custkey as varchar) when 1 then {pad('CIF', 'c_custkey')}
            else {pad('W', 'c_custkey + 500')} end as cif_number,
       c_name as full_name, {pad('09', 'c_custkey')} as phone_number,
       date '1995-01-01' as effective_date,
       case when c_custkey % 7 = 0 then date '2020-01-01' end as expiry_date,
       c_custkey % 7 <> 0 as is_current, c_acctbal
from customer"""

TABLES["t_branch"] = f"""
select n_nationkey + 1 as branch_key,
       case when n_nationkey = 0 then 'MAIN' else {pad('BR', 'n_nationkey', 2)} end as branch_code,
       n_name as branch_name, r_name as region_name
from nation join region on r_regionkey = n_regionkey"""

TABLES["t_shop"] = """
select s_suppkey + 1 as merchant_key, s_name as merchant_name,
       case s_suppkey % 5 when 0 then 'RETAIL' when 1 then 'FOOD' when 2 then 'TRAVEL'
            when 3 then 'EDUCATION' else 'HEALTHCARE' end as merchant_category
from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey"""

TABLES["t_channel"] = """
select distinct case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                     when 'signup' then 4 else 5 end as channel_key,
       case event_type when 'click' then 'Ewallet' when 'error' then 'Card' when 'purchase' then 'Qr_code'
            when 'signup' then 'Bank_transfer' else 'Atm' end as channel_name
from events"""

TABLES["t_debt"] = """
select o_custkey + 2 as customer_key, o_custkey % 25 + 1 as branch_key, o_orderkey + 1 as product_key,
       date_diff('day', date '1995-01-01', cast(o_orderdate as date)) + 1 as time_key,
       cast(o_totalprice as decimal(18,2)) as principal,
       case when o_custkey % 25 = 3 then 0 else cast(o_totalprice as decimal(18,2)) end as outstanding,
       cast(o_orderkey % 120 as integer) as days_late,
       case when o_orderkey % 120 = 0 then 'CURRENT' when o_orderkey % 120 between 1 and 30 then '1-30 DPD'
            when o_orderkey % 120 between 31 and 60 then '31-60 DPD'
            when o_orderkey % 120 between 61 and 90 then '61-90 DPD' else 'NPL' end as risk,
       case when o_orderpriority like '1%' then 'MORTGAGE' else 'HOME_EQUITY' end as product_type
from orders"""

TABLES["t_wallet_fact"] = f"""
select user_id + 2 as customer_key, user_id % 25 + 1 as branch_key,
       date_diff('day', date '1995-01-01', cast(ts as date)) + 1 as time_key,
       cast(value as decimal(18,2)) * 20 as amount,
       cast((event_id % 300) / 100.0 as decimal(18,2)) as fee, {TXN_TYPE} as txn_type,
       case when event_id % 10 = 0 then 'FAILED' else 'SUCCESS' end as txn_status
from events"""

TABLES["t_payment_fact"] = """
select l_partkey + 2 as customer_key, l_suppkey + 1 as merchant_key, l_suppkey % 26 + 1 as branch_key,
       date_diff('day', date '1995-01-01', cast(l_shipdate as date)) + 1 as time_key,
       l_linenumber % 6 + 1 as channel_key,
       cast(l_extendedprice as decimal(18,2)) as amount,
       cast(round(l_quantity * l_tax * 100) as bigint) as fee_cents,
       case when l_returnflag = 'R' then cast(l_extendedprice as decimal(18,2)) else 0 end as refund
from lineitem"""

# --- stream ------------------------------------------------------------------------

TABLES["t_raw"] = f"""
select {LINE_ID} as event_id, 'PAYMENT' as source_system, {pad('CIF', 'l_partkey')} as cif,
       cast(null as varchar) as wallet_id,
       case when l_suppkey % 50 <> 7 then {pad('Supplier#', 'l_suppkey', 9)} end as merchant_name,
       l_extendedprice as amount, l_shipdate as happened, l_partkey as n
from lineitem
union all
select 'E-' || cast(event_id as varchar), 'EWALLET', null, {pad('W', 'user_id + 500')}, null, value, ts, event_id
from events"""

TABLES["t_parsed"] = """
select case when n % 97 <> 1 then source_system end as source_system,
       case when n % 97 <> 1 then event_id end as event_id,
       case when n % 97 <> 1 then cif end as cif,
       case when n % 97 <> 1 then wallet_id end as wallet_id,
       case when n % 97 <> 1 then merchant_name end as merchant_name,
       case when n % 97 <> 1 and n % 89 <> 1 then amount end as base_amount,
       case when n % 97 <> 1 then 'USD' end as currency,
       case when n % 97 <> 1 and n % 83 <> 1 then happened end as timestamp
from t_raw"""
