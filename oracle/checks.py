"""The catalogue's queries for DuckDB, under the same names and columns."""

from oracle.tables import CODE_TYPE, numbered, pad

CHECKS: dict[str, str] = {}

ENTERPRISE_COLUMNS = """customer_sk, merchant_sk, product_sk, source_system, source_trans_id,
       cast(base_amount as double) as base_amount, currency_code, trans_timestamp, status"""

# --- enterprise dimensions -----------------------------------------------------

CHECKS["dim_customer"] = "select * from t_customer"

CHECKS["dim_customer_keeping_keys"] = f"""
, first_load as (
  select 1 + {numbered('cif', "cast(null as bigint)")} as sk, cif from t_bank
), arrived as (
  -- the first wallet that joins a bank customer goes on with its key
  select p.* exclude (place), f.sk
  from (select *, row_number() over (partition by cif order by user_id nulls first, account_id nulls first) as place
        from t_party) p
  left join first_load f on p.place = 1 and f.cif = p.cif
), fresh as (
  select (select max(sk) from first_load) + {numbered('cif', 'user_id', 'account_id')} as sk, * exclude (sk)
  from arrived where sk is null
)
select 1 as customer_sk, 'N/A' as national_id, 'N/A' as phone_number,
       'General/Unknown/N/A' as full_name, false as is_wallet_user, false as is_borrower,
       'TIER_0' as kyc_level, cast(null as varchar) as bank_cif, cast(null as varchar) as wallet_user_id
union all
select sk, national_id, phone, full_name, user_id is not null, cif is not null, kyc, cif, user_id
from (select * from arrived where sk is not null union all by name select * from fresh)"""

CHECKS["mdm_dedup_log"] = """
select customer_sk as surviving_customer_sk, wallet_user_id as merged_source_id,
       cast(0.95 as double) as confidence_score
from t_customer where is_wallet_user and is_borrower"""

CHECKS["fact_survivors"] = f"""
, day_one as (
  select 1 + {numbered('cif', 'account_id')} as sk, user_id
  from (select cif, cast(null as bigint) as account_id, cast(null as varchar) as user_id from t_bank
        union all select null, account_id, user_id from t_wallet)
), owner as (
  -- of a customer's wallets the one with the lowest key holds the facts
  select p.cif, arg_min(p.user_id, d.sk) as user_id
  from t_party p left join day_one d on d.user_id = p.user_id
  where p.cif is not null group by p.cif
)
select e.source_system, e.event_id as source_trans_id, cast(e.amount as double) as base_amount,
       coalesce(o.cif, w.cif) as bank_cif, coalesce(o.user_id, w.user_id) as wallet_user_id
from t_event e
left join owner o on e.source_system = 'PAYMENT' and o.cif = e.cif
left join t_party w on e.source_system = 'EWALLET' and w.user_id = e.wallet_id"""

CHECKS["dim_merchant"] = "select * from t_merchant"
CHECKS["dim_product_account"] = "select * from t_product"

# --- enterprise facts -------------------------------------------------------------

CHECKS["fact_realtime"] = f"select {ENTERPRISE_COLUMNS} from t_realtime"
CHECKS["fact_realtime_day"] = (
    f"select {ENTERPRISE_COLUMNS} from t_realtime "
    "where cast(trans_timestamp as date) = date '2024-01-15'"
)
CHECKS["fact_lending"] = f"select {ENTERPRISE_COLUMNS} from t_lending"
CHECKS["fact_lending_day"] = (
    f"select {ENTERPRISE_COLUMNS} from t_lending "
    "where cast(trans_timestamp as date) = date '1997-08-23'"
)
CHECKS["fact_lending_literal"] = f"""
select {ENTERPRISE_COLUMNS} from t_lending
where exists (select 1 from t_product p where p.product_type = 'LOAN_CONTRACT'
              and p.customer_sk = t_lending.customer_sk)"""
CHECKS["fact_enterprise"] = f"select {ENTERPRISE_COLUMNS} from t_enterprise"
CHECKS["fact_lending_by_type"] = """
select 'MORTGAGE_LOAN' as product_type, count(*) as fact_rows, cast(sum(base_amount) as double) as base_amount
from t_lending
union all select 'LOAN_CONTRACT', 0, null"""
CHECKS["create_and_append"] = """
select cif, full_name, true as dated, true as created_once from t_bank"""
CHECKS["daily_run"] = f"""
select {ENTERPRISE_COLUMNS}, cast(trans_timestamp as date) as trans_date from t_enterprise
where cast(trans_timestamp as date) in (date '1997-08-23', date '1996-11-01')"""
CHECKS["daily_run_quarantine"] = """
select source_system, 'INVALID_AMOUNT' as error_type, cast(trans_timestamp as date) as log_date
from t_enterprise
where base_amount <= 0 and cast(trans_timestamp as date) in (date '1997-08-23', date '1996-11-01')"""
CHECKS["daily_run_two_days"] = """
, dated as (
  select *, cast(ts as date) as day from t_event
), early as (
  select * from t_party where right(cif, 1) in ('0', '3', '6')
)
select e.source_system, e.event_id as source_trans_id, cast(e.amount as double) as base_amount,
       e.day as trans_date, coalesce(p.cif, w.cif) as bank_cif, coalesce(p.user_id, w.user_id) as wallet_user_id,
       'N/A' as source_account_id, coalesce(e.merchant_name, 'NA') as source_merchant_id
from dated e
left join (select *, false as whole from early union all select *, true from t_party) p
  on e.source_system = 'PAYMENT' and p.cif = e.cif and p.whole = (e.day = date '1996-11-01')
left join t_party w on e.source_system = 'EWALLET' and w.user_id = e.wallet_id
union all
select 'COREBANK', 'LND_' || l.branch_code, cast(l.principal as double), l.paid_out, p.cif, p.user_id,
       l.branch_code || '_' || l.cif, 'NA'
from t_loan l join t_party p on p.cif = l.cif
where l.paid_out = date '1996-11-01'
   or right(l.cif, 1) in ('0', '3', '6') and (l.paid_out = date '1997-08-23' or l.paid_out in (select day from dated))"""
LATE_EVENTS = """
, late_facts as (
  select e.source_system, e.event_id as source_trans_id,
         cast(cast(e.base_amount as decimal(18,2)) as double) as base_amount,
         e.timestamp as trans_timestamp, cast(e.timestamp as date) as trans_date
  from t_parsed e
  left join t_party p on e.source_system = 'PAYMENT' and p.cif = e.cif
  left join t_party w on e.source_system = 'EWALLET' and w.user_id = e.wallet_id
  union all
  select 'COREBANK', 'LND_' || l.branch_code, cast(l.principal as double), cast(l.paid_out as timestamp), l.paid_out
  from t_loan l join t_party p on p.cif = l.cif
  where l.paid_out in (select cast(timestamp as date) from t_parsed)
)"""
CHECKS["daily_run_late_events"] = LATE_EVENTS + """
select * from late_facts"""
CHECKS["daily_run_late_quarantine"] = LATE_EVENTS + """
select source_system, source_trans_id, 'INVALID_AMOUNT' as error_type, trans_date as log_date
from late_facts where base_amount <= 0
union all
select source_system, source_trans_id, 'MISSING_TIMESTAMP', null from late_facts where trans_timestamp is null"""
CHECKS["daily_run_reloaded"] = """
select customer_sk, source_system, source_trans_id, cast(base_amount as double) as base_amount, trans_timestamp,
       cast(trans_timestamp as date) as trans_date
from t_realtime where cast(trans_timestamp as date) <> date '1996-11-01'
union all
select customer_sk, source_system, source_trans_id, cast(base_amount as double), trans_timestamp,
       cast(trans_timestamp as date)
from t_lending
where cast(trans_timestamp as date) in (
  select cast(ts as date) from t_event
  where cast(ts as date) <> date '1996-11-01' or right(event_id, 1) not in ('1', '4', '7'))"""
CHECKS["fact_as_of"] = """
, version as (
  select cif_number, c_name, cast(effective_date as timestamp) as since,
         cast(if(is_current and c_acctbal < 1000, date '1996-11-01', expiry_date) as timestamp) as until
  from (select *, full_name as c_name from t_holder)
  union all
  select cif_number, if(c_acctbal < 1000, upper(full_name), full_name), timestamp '1996-11-01', null
  from t_holder where not is_current or c_acctbal < 1000
), movement as (
  select 'debt' as fact, contract_no as id, cif as cif_number, cast(paid_out as timestamp) as at, principal as amount
  from t_loan
  union all
  select 'payment', event_id, cast(account_id as varchar), cast(ts as timestamp), amount from t_pay
  union all
  select 'wallet', cast(t.txn_id as varchar), w.user_id, cast(t.ts as timestamp), t.amount
  from t_wallet_txn t left join t_wallet w using (account_id)
)
select m.fact, m.id, m.cif_number, m.at, cast(m.amount as double) as amount,
       case when v.until is null or m.at < v.until then v.c_name end as full_name,
       case when v.until is null or m.at < v.until then cast(v.since as date) end as effective_date
from movement m asof left join version v on m.cif_number = v.cif_number and m.at >= v.since"""
CHECKS["star_day_run"] = """
, every_fact as (
  select paid_out as full_date, 'debt' as fact, customer_key, outstanding as amount
  from t_loan left join t_holder on cif_number = cif
  union all
  select cast(ts as date), 'payment', customer_key, amount
  from t_pay join t_holder on cif_number = cast(account_id as varchar)
)
select fact, time_key, coalesce(customer_key, 1) as customer_key, cast(amount as double) as amount
from every_fact join t_time using (full_date) where full_date = date '1997-08-23'"""
CHECKS["enterprise_summary"] = """
select r.source_system, c.is_wallet_user, c.is_borrower, count(*) as fact_rows,
       cast(sum(r.base_amount) as double) as base_amount
from t_realtime r join t_customer c using (customer_sk)
group by r.source_system, c.is_wallet_user, c.is_borrower"""

# --- table maintenance --------------------------------------------------------------

CHECKS["fact_minus_day"] = """
select event_id, source_system, ts as timestamp from t_event
where cast(ts as date) <> date '2024-01-15'"""
CHECKS["fact_delete_using"] = """
select customer_key, product_key, time_key, cast(principal as double) as principal_amount
from t_debt where time_key not in (select time_key from t_time where full_date = date '1997-08-23')"""
CHECKS["replace_day"] = """
select event_id, cast(ts as date) as trans_date,
       cast(case when cast(ts as date) = date '2024-01-15' then 2 * amount else amount end as double)
         as base_amount
from t_event"""
CHECKS["clear_day"] = """
select event_id, cast(ts as date) as trans_date, cast(amount as double) as base_amount
from t_event where cast(ts as date) <> date '2024-01-15'"""
CHECKS["insert_ignore"] = """
select distinct national_id from t_wallet
where national_id not in (select national_id from t_bank where national_id is not null)
union all
select null from t_wallet where national_id is null"""
CHECKS["keyed_insert"] = "select national_id from t_bank union all" + CHECKS["insert_ignore"]
CHECKS["keyed_duplicates"] = """
select national_id as key_value, count(*) as copies
from t_wallet where national_id is not null group by national_id having count(*) > 1"""
CHECKS["schema_evolution"] = """
select event_id, account_id, cast(amount as double) as amount, txn_type, 'USD' as currency,
       ts as timestamp, merchant, cast(flag as integer) as is_fraud_flag,
       cast(null as varchar) as source_system, cast(null as varchar) as cif,
       cast(null as varchar) as wallet_id, cast(null as varchar) as merchant_name,
       cast(null as double) as base_amount
from t_pay
union all
select event_id, null, null, null, 'USD', ts, null, null, source_system, null, wallet_id, null,
       cast(amount as double)
from t_click"""

# --- quality --------------------------------------------------------------------------

CHECKS["dq_invalid_amount"] = """
select source_system, 'INVALID_AMOUNT' as error_type,
       '{"customer_sk":' || cast(customer_sk as varchar) || ',"merchant_sk":' || cast(merchant_sk as varchar)
       || ',"product_sk":' || cast(product_sk as varchar) || ',"source_system":"' || source_system
       || '","source_trans_id":"' || source_trans_id || '","base_amount":'
       || cast(cast(base_amount as decimal(18,2)) as varchar) || ',"currency_code":"USD","trans_timestamp":"'
       || strftime(trans_timestamp, '%Y-%m-%dT%H:%M:%S')
       || case when microsecond(trans_timestamp) % 1000000 = 0 then ''
               else rtrim(strftime(trans_timestamp, '.%f'), '0') end
       || '","status":"' || status || '"}' as raw_payload
from t_enterprise where base_amount <= 0"""
CHECKS["dq_null_keys"] = """
select 'star.fact_payment_transaction' as table_name, 'customer_key' as column_name,
       count(*) - count(customer_key) as null_rows from t_payment_fact
union all select 'star.fact_debt_status', 'customer_key', count(*) - count(customer_key) from t_debt
union all select 'public.realtime_transactions', 'cif', count(*) - count(cif) from t_event
union all select 'public.realtime_transactions', 'wallet_id', count(*) - count(wallet_id) from t_event
union all select 'public.realtime_transactions', 'merchant_name', count(*) - count(merchant_name) from t_event
union all select 'public.realtime_transactions', 'base_amount', count(*) - count(amount) from t_event"""
CHECKS["dq_keys_present"] = """
select (select count(*) from t_payment_fact where customer_key is null)
     + (select count(*) from t_debt where customer_key is null) = 0 as passed"""


def _orphans(key: str, dim: str) -> str:
    return (
        f"select 'star.fact_payment_transaction' as table_name, '{key}' as column_name, "
        f"cast({key} as varchar) as key_value, count(*) as fact_rows from t_payment_fact "
        f"where {key} not in (select {key} from {dim}) group by {key}"
    )


CHECKS["dq_orphan_keys"] = "\nunion all ".join(
    _orphans(key, dim)
    for key, dim in (
        ("customer_key", "t_holder"), ("merchant_key", "t_shop"), ("branch_key", "t_branch"),
        ("channel_key", "t_channel"), ("time_key", "t_time"),
    )
)
CHECKS["dq_not_null"] = """
select cif, 'national_id' as missing_column from t_bank where national_id is null"""
def _required(table: str, source: str, **columns: str) -> list[str]:
    return [f"select '{table}' as table_name, '{name}' as column_name, 'required' as rule, "
            f"count(*) filter ({own} is null) as broken_rows from {source}" for name, own in columns.items()]


def _unique(table: str, source: str, **columns: str) -> list[str]:
    return [f"select '{table}', '{name}', 'unique', count({own}) - count(distinct {own}) from {source}"
            for name, own in columns.items()]


CHECKS["dq_all_constraints"] = "\nunion all\n".join([
    *_required("corebank.customer", "t_bank", cif="cif", full_name="full_name", national_id="national_id"),
    *_required("ewallet.account", "t_wallet", account_id="account_id", user_id="user_id", phone_number="phone"),
    *_required("star.dim_time", "t_time", time_key="time_key", full_date="full_date", day="day", month="month",
               quarter="quarter", year="year"),
    *_required("star.fact_debt_status", "t_debt", customer_key="customer_key", branch_key="branch_key",
               product_key="product_key", time_key="time_key"),
    *_unique("corebank.customer", "t_bank", cif="cif", national_id="national_id"),
    *_unique("ewallet.account", "t_wallet", account_id="account_id", phone_number="phone"),
    *_unique("star.dim_time", "t_time", time_key="time_key", full_date="full_date"),
    *_unique("mdm.dim_customer", "t_customer", customer_sk="customer_sk"),
    *_unique("mdm.dim_merchant", "t_merchant", merchant_sk="merchant_sk", source_merchant_id="source_merchant_id"),
    "select 'star.fact_debt_status', 'time_key', 'foreign key', count(*) from t_debt "
    "where time_key is not null and time_key not in (select time_key from t_time)",
])
CHECKS["dq_duplicates"] = """
select national_id as key_value, count(*) as copies, 'national_id' as column_name
from t_wallet where national_id is not null group by national_id having count(*) > 1
union all
select bank_cif, count(*), 'bank_cif' from t_customer
where bank_cif is not null group by bank_cif having count(*) > 1"""

# --- star schema --------------------------------------------------------------------------

CHECKS["dim_time"] = "select * from t_time"
CHECKS["dim_time_missing"] = """
select * from t_time where full_date not in (select cast(ts as date) from t_event)"""
CHECKS["new_merchants"] = """
select distinct merchant as merchant_name, 'General' as merchant_category
from (select merchant from t_pay union all select null from t_click) s
where not exists (select 1 from t_shop where t_shop.merchant_name = s.merchant)"""

WALLET_FACT = """
select coalesce(h.customer_key, 1) as customer_key, cast(1 as bigint) as branch_key, t.time_key,
       cast(1 as bigint) as channel_key,
       cast(x.amount as double) as txn_amount, cast(x.fee as double) as fee_amount, x.txn_type, x.txn_status
from t_wallet_txn x
join t_time t on t.full_date = cast(x.ts as date)
left join t_wallet a using (account_id)
left join t_holder h on h.cif_number = a.user_id"""
CHECKS["fact_ewallet"] = WALLET_FACT
CHECKS["fact_ewallet_day"] = WALLET_FACT + "\nwhere t.full_date = date '2024-01-15'"

DEBT_FACT = """
select coalesce(h.customer_key, 1) as customer_key, cast(coalesce(br.branch_key, 1) as bigint) as branch_key,
       cast(1 as bigint) as product_key, t.time_key, cast(l.principal as double) as principal_amount,
       cast(l.outstanding as double) as total_outstanding, 'CURRENT' as risk_bucket
from t_loan l
join t_time t on t.full_date = l.paid_out
left join t_holder h on h.cif_number = l.cif
left join t_branch br using (branch_code)"""
CHECKS["fact_debt"] = DEBT_FACT
CHECKS["fact_debt_day"] = DEBT_FACT + "\nwhere l.paid_out = date '1997-08-23'"

PAYMENT_FACT = """
select h.customer_key, coalesce(s.merchant_key, 1) as merchant_key,
       cast(coalesce((select branch_key from t_branch where branch_code = 'MAIN'), 1) as bigint) as branch_key,
       t.time_key, cast(1 as bigint) as channel_key, cast(1 as integer) as txn_count,
       cast(e.amount as double) as txn_amount, cast(e.amount as double) as net_amount,
       'SUCCESS' as txn_status
from t_pay e
join t_holder h on h.cif_number = cast(e.account_id as varchar)
join t_time t on t.full_date = cast(e.ts as date)
left join t_shop s on s.merchant_name = e.merchant"""
CHECKS["fact_payment"] = PAYMENT_FACT
CHECKS["fact_payment_day"] = PAYMENT_FACT + "\nwhere t.full_date = date '1996-11-01'"

# --- views -----------------------------------------------------------------------------------

CHECKS["npl_by_branch_month"] = """
select t.year, t.month, t.month_name, br.branch_name, br.region_name, count(*) as total_loans,
       cast(sum(f.outstanding) as double) as total_outstanding,
       cast(sum(f.outstanding) filter (f.risk = 'NPL') as double) as npl_some,
       coalesce(npl_some, 0) as npl_amount,
       case when sum(f.outstanding) <> 0
            then round(100 * coalesce(npl_some, 0) / cast(sum(f.outstanding) as double), 2) end as npl_ratio_pct
from t_debt f join t_time t using (time_key) join t_branch br using (branch_key)
group by all"""
CHECKS["npl_by_branch_month"] = f"""
select * exclude (npl_some) from ({CHECKS["npl_by_branch_month"]})"""

CHECKS["customer_debt_summary"] = """
select h.cif_number, h.full_name, br.branch_name, f.product_type,
       cast(f.outstanding as double) as total_outstanding, f.days_late as days_past_due,
       f.risk as risk_bucket, t.full_date as snapshot_date
from t_holder h join t_debt f using (customer_key) join t_branch br using (branch_key)
join t_time t using (time_key)
where h.is_current"""
CHECKS["risk_distribution"] = """
select t.year, t.quarter, f.risk as risk_bucket, f.product_type, count(*) as loan_count,
       cast(sum(f.outstanding) as double) as total_outstanding, avg(f.days_late) as avg_days_past_due
from t_debt f join t_time t using (time_key)
group by all"""
CHECKS["ewallet_monthly"] = """
select t.year, t.month, t.month_name, br.branch_name, br.region_name, f.txn_type, f.txn_status,
       count(*) as txn_count, cast(sum(f.amount) as double) as total_amount,
       cast(sum(f.fee) as double) as total_fee,
       cast(sum(f.amount) as double) / count(*) as avg_txn_amount
from t_wallet_fact f join t_time t using (time_key) join t_branch br using (branch_key)
group by all"""
CHECKS["payment_revenue"] = """
select t.year, t.quarter, t.month, s.merchant_category, ch.channel_name, br.region_name,
       count(*) as txn_count, cast(sum(f.amount) as double) as gross_amount,
       cast(sum(f.fee_cents) as double) / 100 as total_fee, cast(sum(f.refund) as double) as total_refund,
       cast(cast(sum(f.amount) * 100 as bigint) - sum(f.fee_cents) as double) / 100 as net_revenue,
       round(cast(sum(f.fee_cents) as double) / cast(sum(f.amount) as double), 3) as fee_rate_pct
from t_payment_fact f join t_time t using (time_key) join t_shop s using (merchant_key)
join t_channel ch using (channel_key) join t_branch br using (branch_key)
group by all"""
CHECKS["customer_activity"] = """
, used as (
  select customer_key, 'l' as kind, outstanding as amount from t_debt
  union all select customer_key, 'e', amount from t_wallet_fact
  union all select customer_key, 'p', amount from t_payment_fact
), totals as (
  select h.customer_key, h.cif_number, h.full_name,
         count(*) filter (kind = 'l') as l, coalesce(sum(amount) filter (kind = 'l'), 0) as l_sum,
         count(*) filter (kind = 'e') as e, coalesce(sum(amount) filter (kind = 'e'), 0) as e_sum,
         count(*) filter (kind = 'p') as p, coalesce(sum(amount) filter (kind = 'p'), 0) as p_sum
  from t_holder h left join used using (customer_key) where h.is_current
  group by all
)
select cif_number, full_name, l as loan_count, cast(l_sum as double) as total_loan_outstanding,
       e as ewallet_txn_count, cast(e_sum as double) as ewallet_total_amount,
       p as payment_txn_count, cast(p_sum as double) as payment_total_amount,
       cast(greatest(least(l, 1) + least(e, 1) + least(p, 1), 1) as varchar) || '-Product' as customer_segment
from totals"""

# --- checks and live monitor ------------------------------------------------------------------

CHECKS["fact_count"] = "select count(*) as fact_rows from t_enterprise"
CHECKS["customers_by_flag"] = """
select is_wallet_user, is_borrower, count(*) as customers from t_customer group by all"""
CHECKS["newest_facts"] = """
select source_system, cast(base_amount as double) as base_amount, currency_code, trans_timestamp
from t_enterprise
order by trans_timestamp desc nulls first, source_trans_id desc nulls first limit 10"""
CHECKS["latest_events"] = """
select event_id, cast(null as bigint) as account_id, cast(null as double) as amount,
       cast(null as varchar) as txn_type, 'USD' as currency, ts as timestamp,
       cast(null as varchar) as merchant, cast(null as integer) as is_fraud_flag, source_system, cif,
       wallet_id, merchant_name, cast(amount as double) as base_amount
from t_event order by ts desc, event_id desc limit 50"""
LATEST = "(select * from t_pay order by ts desc, event_id desc limit 50)"
CHECKS["live_feed"] = f"""
select strftime(ts, '%H:%M:%S') as time_short, substr(event_id, 1, 8) || '...' as event_id_short,
       '#' || cast(account_id as varchar) as account_label, txn_type,
       regexp_replace(format('{{:,.2f}}', cast(amount as double)), '\\.?0+$', '') || ' USD' as amount_label,
       merchant, case when flag = 1 then 'Cảnh báo (Fraud)' else 'Hợp lệ' end as status_text
from {LATEST}"""
CHECKS["live_metrics"] = f"""
select case when count(*) < 50 then cast(count(*) as varchar)
            else '>= ' || cast(count(*) as varchar) end as rows_label,
       cast(arg_max(amount, struct_pack(a := ts, b := event_id)) as double) as newest_amount,
       cast(sum(flag) as bigint) as flagged_rows
from {LATEST}"""
CHECKS["amount_series"] = f"select ts as timestamp, cast(amount as double) as amount from {LATEST}"

# --- seeds, files and streams -------------------------------------------------------------------

CHECKS["seed_customers"] = f"""
select {pad('CIF', 'c_custkey + 1', 6)} as cif, 'Customer ' || cast(c_custkey + 1 as varchar) as full_name,
       {pad('0', 'c_custkey + 1', 9)} as national_id, {pad('09', 'c_custkey + 1', 8)} as phone
from customer"""
CHECKS["seed_wallets"] = f"""
select {pad('W', 'c_custkey + 501', 6)} as user_id, {pad('08', 'c_custkey + 1', 8)} as phone_number,
       'Wallet User ' || cast(c_custkey + 1 as varchar) as full_name,
       {pad('1', 'c_custkey + 1', 9)} as national_id,
       case when (c_custkey + 1) % 3 = 0 then 'ADVANCED' when (c_custkey + 1) % 2 = 0 then 'STANDARD'
            else 'BASIC' end as kyc_level
from customer"""
CHECKS["load_files"] = """
select cif, trim(full_name) as full_name, national_id, phone, cast(null as varchar) as email,
       cast(null as varchar) as current_address
from t_bank"""
CHECKS["load_files_by_position"] = """
select c_custkey as account_id, c_acctbal as current_balance, c_acctbal as available_balance,
       cast(0 as double) as frozen_amount, timestamp '2024-01-01 00:00:00' as last_updated
from customer"""
CHECKS["parse_events"] = "select * from t_parsed"
CHECKS["stream_landing"] = """
select event_id, cast(null as bigint) as account_id, cast(null as double) as amount,
       cast(null as varchar) as txn_type, currency, timestamp, cast(null as varchar) as merchant,
       cast(null as integer) as is_fraud_flag, source_system, cif, wallet_id, merchant_name, base_amount
from t_parsed"""

CHECKS["stream_restart"] = """
select event_id, wallet_id, cast(base_amount as double) as base_amount, timestamp, 2 * count(*) as copies
from t_parsed group by all"""
CHECKS["stream_two_sinks"] = """
select s.sink, e.wallet_id, count(*) as events, cast(sum(cast(e.base_amount as decimal(18,2))) as double) as base_amount
from t_parsed e, (values ('one'), ('two')) s(sink) group by all"""
CHECKS["stream_after_load"] = """
select event_id, wallet_id, cast(amount as double) as base_amount, ts as timestamp from t_event
union all
select event_id, wallet_id, cast(base_amount as double), timestamp from t_parsed"""
CHECKS["stream_compacted"] = CHECKS["stream_landing"] + """
union all
select event_id, null, null, null, currency, timestamp, null, null, source_system, cif, wallet_id, merchant_name, base_amount
from t_parsed where source_system is null"""

CHECKS["stream_live_feed"] = """
select event_id, source_system, cast(cast(base_amount as decimal(18,2)) as double) as base_amount, timestamp
from t_parsed order by timestamp desc nulls first, event_id desc nulls first limit 50"""
CHECKS["dead_letters"] = """
, reasons as (
  select *, case when n % 97 = 1 then 'NOT_JSON' when n % 89 = 1 then 'BAD_FIELD' when n % 83 = 1 then 'BAD_TIMESTAMP' end
           as reason
  from t_raw
)
select case when n % 97 <> 1 then event_id end as event_id, reason,
       case when n % 97 = 1 then '{broken' end as text,
       case when reason = 'BAD_FIELD' then 'many'
            when reason = 'BAD_TIMESTAMP' then cast(cast(amount as decimal(18,2)) as varchar) end as amount_text,
       case when n % 97 = 1 or reason is null then null when n % 83 = 1 then 'soon'
            else strftime(happened, '%Y-%m-%dT%H:%M:%S.%fZ') end as timestamp_text
from reasons"""
CHECKS["load_rejects"] = """
select c_custkey as account_id, null as reason, null as column_name, null as cell from customer
where c_custkey % 20 <> 3 and c_custkey % 30 <> 3
union all
select null, 'BAD_CELL', 'current_balance', 'n/a, "later"' from customer where c_custkey % 20 = 3
union all
select null, 'BAD_CELL', 'last_updated', 'line one' || chr(10) || 'line two' from customer where c_custkey % 30 = 3"""

# --- fraud ------------------------------------------------------------------------------------------

CHECKS["fraud_training_set"] = f"""
select txn_id, cast({CODE_TYPE.format('txn_type')} as integer) as txn_type,
       cast(amount as double) as amount,
       cast(case when txn_status = 'FAILED' then 1 else 0 end as integer) as is_fraud
from t_wallet_txn"""
CHECKS["fraud_rule_score"] = """
select txn_id, txn_type, cast(amount as double) as amount,
       cast(case when amount > 3000 then 0.8 else 0.1 end as double) as risk_score,
       amount > 3000 as is_fraud,
       cast(case when amount > 3000 then 80 else 10 end as double) as risk_pct
from t_wallet_txn"""
CHECKS["fraud_model_checks"] = """
select count(*) as scored_rows, count(*) filter (txn_id % 10 <> 3) as within_bounds,
       count(*) filter (txn_id % 10 <> 3) as flags_agree, count(*) filter (txn_id % 10 <> 3) as same_after_load,
       count(*) filter (txn_id % 10 = 3) as unscored, count(*) as split_rows, true as a_fifth_for_tests
from t_wallet_txn"""
CHECKS["fraud_type_codes"] = f"""
select txn_id, cast({CODE_TYPE.format('txn_type')} as integer) as training_code,
       cast({CODE_TYPE.format('upper(txn_type)')} as integer) as scoring_code
from t_wallet_txn"""

# --- declared by the schema -------------------------------------------------------------------------

CHECKS["risk_bucket"] = """
select product_key, days_late as days_past_due, risk as risk_bucket from t_debt"""
CHECKS["scd2_customer"] = f"""
, changed as (
  select *, is_current and c_acctbal < 1000 and upper(full_name) <> full_name as closes from t_holder
)
select customer_key, cif_number, full_name, phone_number, effective_date,
       case when closes then date '2002-01-01' else expiry_date end as expiry_date,
       is_current and not closes as is_current
from changed
union all
select (select max(customer_key) from changed) + {numbered('cif_number')}, cif_number,
       case when c_acctbal < 1000 then upper(full_name) else full_name end, phone_number,
       date '2002-01-01', null, true
from changed where closes or not is_current"""
CHECKS["settlement"] = """
select merchant_id, settled_on as settlement_date, count(*) as total_txn_count,
       cast(sum(amount) as double) as gross_amount,
       cast(sum(cast(round(fee * 100) as bigint)) as double) / 100 as total_fee,
       cast(cast(sum(amount) * 100 as bigint) - sum(cast(round(fee * 100) as bigint)) as double) / 100
         as net_amount
from t_payment where txn_status = 'SUCCESS' group by all"""
CHECKS["refund_net"] = """
, back as (
  select txn_id, sum(cast(l_quantity as bigint)) as refunded from t_payment
  where l_returnflag = 'R' group by txn_id
)
select p.txn_id, p.merchant_id, cast(p.amount as double) as txn_amount, cast(p.fee as double) as fee_amount,
       cast(coalesce(b.refunded, 0) as double) as refund_amount,
       cast(cast(p.amount * 100 as bigint) - cast(round(p.fee * 100) as bigint)
            - 100 * coalesce(b.refunded, 0) as double) / 100 as net_amount
from t_payment p left join back b using (txn_id)"""

# --- views from stored sums: the same as from the facts ------------------------------

CHECKS["npl_incremental"] = CHECKS["npl_by_branch_month"]
CHECKS["ewallet_monthly_incremental"] = CHECKS["ewallet_monthly"]
CHECKS["payment_revenue_incremental"] = CHECKS["payment_revenue"]
