"""The curated tables and reports, built end to end."""

import datetime as dt

from pyspark.sql import functions as F

from siltstone.plans import accounts, customers, funnel, ingest, risk
from siltstone.queries import inputs as i
from siltstone.queries.inputs import frame, sub
from siltstone.queries.registry import query
from siltstone.queries.scalars import _bucket_case
from siltstone.session import work_path

AS_OF = dt.date(2024, 2, 10)
NOW = dt.datetime(2024, 2, 10, 12, 30)

_AGE = "date_sub('year', try_cast(date_of_birth as date), date '2024-02-10')"


_TIMELINE_SQL = f"""
with log as (select *, coalesce(key_id, alt_key_id) user_id from {sub(i.CHANGE_LOG)} where updated_at is not null),
last_ as (select * from (select *, row_number() over (partition by user_id order by updated_at desc nulls last, status) rn from log) where rn = 1),
first_ as (select user_id, min(updated_at) first_join_date from log group by user_id)
select l.user_id, updated_at, status, nationality, address_country, address_status, idv_status, brand_id,
  case when trim(phone, ' ') <> '' then 1 else 0 end phone_populated,
  case when trim(email, ' ') <> '' then 1 else 0 end email_populated,
  case when trim(nickname, ' ') <> '' then 1 else 0 end nickname_populated,
  case when {_AGE} between 17 and 23 then '17_to_23' when {_AGE} between 24 and 30 then '24_to_30'
       when {_AGE} between 31 and 45 then '31_to_45' when {_AGE} >= 46 then '46+' end age_range,
  cast({_AGE} as integer) age,
  case when gender like 'Female%' then 1 when gender like 'Male%' then 0 end gender_code,
  push_marketing, sms_marketing, email_marketing, first_join_date, '20240210' as "date"
from last_ l left join first_ f on l.user_id = f.user_id
"""


@query(_TIMELINE_SQL)
def q_timeline(t):
    """Customer timeline."""
    return customers.timeline(frame(t, i.CHANGE_LOG), AS_OF)


@query(_TIMELINE_SQL)
def q_timeline_by_deltas(t):
    """Customer timeline from stored states, the log arriving in three parts; the second one comes twice."""
    log, root = frame(t, i.CHANGE_LOG), work_path(t.spark, "timeline")
    part = F.pmod(F.coalesce(F.datediff("updated_at", F.lit("2020-01-01")), F.lit(0)), F.lit(3))
    for number in (0, 1, 1, 2):
        rows = customers.refresh_timeline(log.where(part == number), root, f"part-{number}", AS_OF, buckets=8)
    return rows


@query(f"""
with log as (select * from {sub(i.CHANGE_LOG)}),
newest as (select l.* from log l join (select key_id, max(updated_at) m from log group by key_id) x
  on l.key_id = x.key_id and l.updated_at = x.m),
b as (select distinct key_id, try_cast(date_of_birth as date) birthday from newest
  where date_of_birth is not null and date_of_birth <> ' ')
select distinct key_id user_id, case when date_sub('year', birthday, date '2024-02-10') between 16 and 23 then 1 else 0 end is_student from b
""")
def q_student_flag(t):
    """Age flag from the newest birthday."""
    return customers.student_flag(frame(t, i.CHANGE_LOG), AS_OF)


@query(f"""
with sums as (select parent_account_key, currency_code,
    cast(sum(case when channel_id = 'CARD-FAST' then cast(amount as decimal(20,2)) end) as double) card,
    cast(sum(case when channel_id in ('OUT_DOMESTIC', 'OUT_LOCAL') then cast(amount as decimal(20,2)) end) as double) transfer
  from {sub(i.TRANSACTIONS)} where type = 'WITHDRAWAL' and channel_id in ('CARD-FAST', 'OUT_DOMESTIC', 'OUT_LOCAL')
  group by all),
customers as (select * from (select coalesce(key_id, alt_key_id, image_id) user_id, card_ordered,
    row_number() over (partition by coalesce(key_id, alt_key_id, image_id) order by updated_at desc nulls last, status, card_ordered) rn
  from {sub(i.CHANGE_LOG)}) where rn = 1),
clients as (select * from (select *, row_number() over (partition by encoded_key, id order by last_modified_date desc nulls last, state) rn
  from {sub(i.CLIENTS)}) where rn = 1),
accounts as (select * from (select *, row_number() over (partition by account_holder_key, account_type, id
    order by last_modified_date desc nulls last, encoded_key) rn from {sub(i.ACCOUNTS)}) where rn = 1),
cards as (select * from (select *, row_number() over (partition by user_id order by updated_at desc nulls last, state nulls last) rn
  from {sub(i.CARDS)}) where rn = 1)
select a.name account, a.id account_id, a.account_type, cast(a.balances_total_balance as double) account_total_balance,
  a.encoded_key account_encoded_key, a.account_holder_key, a.currency_code, a.account_state,
  strptime(left(a.last_modified_date, 10), '%Y-%m-%d') account_last_modified,
  strptime(left(a.approved_date, 10), '%Y-%m-%d') account_approved,
  strptime(left(a.activation_date, 10), '%Y-%m-%d') account_activated,
  d.user_id, c.state client_state, d.card_ordered, coalesce(nullif(k.state, ''), 'UNKNOWN') card_state,
  s.card outbound_card_amount, s.transfer outbound_transfer_amount
from customers d join clients c on c.id = d.user_id join accounts a on a.account_holder_key = c.encoded_key
join cards k on k.user_id = c.id
left join sums s on s.parent_account_key = a.encoded_key and s.currency_code = a.currency_code
""")
def q_account_360(t):
    """Account 360."""
    rows = accounts.account_360(
        frame(t, i.CHANGE_LOG), frame(t, i.CLIENTS), frame(t, i.ACCOUNTS), frame(t, i.CARDS),
        frame(t, i.TRANSACTIONS), ["CARD-FAST"], ["OUT_DOMESTIC", "OUT_LOCAL"],
    )
    times = ("account_last_modified", "account_approved", "account_activated")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


@query(f"""
with customers as (select * from (select *, coalesce(key_id, alt_key_id, image_id) user_id,
    row_number() over (partition by coalesce(key_id, alt_key_id, image_id) order by updated_at desc nulls last, status) rn
  from {sub(i.CHANGE_LOG)}) where rn = 1),
numbered as (select *, row_number() over (order by user_id nulls last) customer_id_generated from customers),
clients as (select * from (select *, row_number() over (partition by id, encoded_key order by last_modified_date desc nulls last, state) rn
  from {sub(i.CLIENTS)}) where rn = 1),
accounts as (select * from (select *, row_number() over (partition by id order by last_modified_date desc nulls last, encoded_key) rn
  from {sub(i.ACCOUNTS)}) where rn = 1)
select n.customer_id_generated, n.nationality, n.address_country, a.currency_code,
  cast(a.balances_total_balance as double) total_balance, a.accrued_interest profit_accrued, a.name account_type,
  left(a.approved_date, 10) account_open_date, left(a.maturity_date, 10) maturity_date, a.interest_rate profit_rate
from numbered n left join clients c on c.id = n.user_id left join accounts a on a.account_holder_key = c.encoded_key
where n.status = 'APPROVED'
""")
def q_risk_report(t):
    """Monthly risk report."""
    rows = accounts.risk_report(
        frame(t, i.CHANGE_LOG), frame(t, i.CLIENTS), frame(t, i.ACCOUNTS), rows_per_bucket=40
    )
    return rows.withColumns(
        {
            "total_balance": F.col("total_balance").cast("double"),
            "account_open_date": F.col("account_open_date").cast("string"),
            "maturity_date": F.col("maturity_date").cast("string"),
        }
    )


# Repeated items per order: line numbers 1..7 become items 0..6.
_ITEMS = range(7)


def _score_input(t):
    """Scores with an item array; the cells are conditional maxima, so rows combine early."""
    at = {n: F.col("l_linenumber") == n + 1 for n in _ITEMS}
    wide = t.lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("updated_at"),
        *[F.max(F.when(at[n], F.col("l_partkey"))).alias(f"p{n}") for n in _ITEMS],
        *[F.max(F.when(at[n], F.col("l_suppkey"))).alias(f"s{n}") for n in _ITEMS],
    )

    def amount(n):
        part, supp = F.col(f"p{n}"), F.col(f"s{n}")
        return F.struct(
            F.when(part % 4 != 0, "GBP").alias("code"), part.alias("from"), (part + supp).alias("to")
        )

    def item(n):
        part = F.col(f"p{n}")
        kind = (
            F.when(part % 5 == 0, "INCOME_FROM_PERSONAL_SAVINGS")
            .when(part % 5 == 1, "SAVINGS_FROM_SALARY_OR_EARNINGS")
            .when(part.isNotNull() & (part % 5 != 4), "PROPERTY")
        )
        return F.struct(kind.alias("type"), amount(n).alias("converted"), amount(n).alias("local"))

    worth = F.struct(
        amount(0).alias("converted"), amount(1).alias("local"),
        F.lit("GBP").alias("code"), F.col("p0").alias("from"), F.col("s0").alias("to"),
    )
    order = F.col("l_orderkey").cast("string")
    return wide.select(
        F.when(F.col("l_orderkey") % 2 == 0, order).alias("customer_id"),
        order.alias("alt_customer_id"),
        F.when(F.col("l_orderkey") % 10 != 0, F.col("updated_at")).alias("updated_at"),
        F.array(*[item(n) for n in _ITEMS]).alias("items"),
        worth.alias("net_worth"),
    )


_SCORE_BASE = "select l_orderkey, max(l_shipdate) updated_at, " + ", ".join(
    f"max(case when l_linenumber = {n + 1} then l_partkey end) p{n}, "
    f"max(case when l_linenumber = {n + 1} then l_suppkey end) s{n}"
    for n in _ITEMS
) + " from lineitem group by l_orderkey"


def _range_sql(n):
    return f"case when p{n} % 4 <> 0 then 'GBP' end || '_' || p{n} || '_' || (p{n} + s{n})"


def _type_sql(n):
    return (
        f"case p{n} % 5 when 0 then 'INCOME_FROM_PERSONAL_SAVINGS' when 1 then 'SAVINGS_FROM_SALARY_OR_EARNINGS' "
        f"when 2 then 'PROPERTY' when 3 then 'PROPERTY' end"
    )


_SCORE_SQL = (
    "select cast(l_orderkey as varchar) customer_id, updated_at updated_timestamp, "
    "strftime(updated_at, '%Y-%m-%d') as \"date\", "
    + ", ".join(
        f"{_type_sql(n)} item_{n}_type, {_range_sql(n)} item_{n}_converted, {_range_sql(n)} item_{n}_local"
        for n in _ITEMS
    )
    + f", {_range_sql(0)} total_converted, {_range_sql(1)} total_local, 'GBP' worth_code, "
    "cast(p0 as varchar) worth_min, cast(s0 as varchar) worth_max "
    f"from ({_SCORE_BASE}) where l_orderkey % 10 <> 0"
)


@query(_SCORE_SQL)
def q_score_table(t):
    """Risk score wide table."""
    return risk.score_table(_score_input(t), items=len(_ITEMS))


def _class_sql(listed: bool) -> str:
    terms = []
    for n in _ITEMS:
        test = f"coalesce({_type_sql(n)} in ('INCOME_FROM_PERSONAL_SAVINGS', 'SAVINGS_FROM_SALARY_OR_EARNINGS'), false)"
        low = f"case when ({_range_sql(n)}) is null then 0 else p{n} end"
        terms.append(f"case when {test if listed else 'not ' + test} then {low} else 0 end")
    return " + ".join(terms)


@query(f"""
with scored as (select distinct o_custkey, {", ".join(f"{_type_sql(n)} t{n}, {_range_sql(n)} r{n}, p{n}" for n in _ITEMS)},
    cast({_class_sql(True)} as decimal(38,6)) income, cast({_class_sql(False)} as decimal(38,6)) wealth
  from ({_SCORE_BASE}) join orders on o_orderkey = l_orderkey where l_orderkey % 10 <> 0)
select cast(o_custkey as varchar) customer_id, cast(sum(income) as decimal(38,6)) income_salary,
  cast(sum(wealth) as decimal(38,6)) wealth from scored group by o_custkey
""")
def q_wealth_income(t):
    """Wealth and income per customer over all scores of the customer's orders."""
    orders = t.orders.select(F.col("o_orderkey").cast("string").alias("alt_customer_id"), "o_custkey")
    scores = _score_input(t).join(orders, "alt_customer_id").withColumn("customer_id", F.col("o_custkey").cast("string"))
    return risk.wealth_and_income(scores)


@query("""
select c_custkey, c_acctbal from customer where c_mktsegment = 'MACHINERY'
""")
def q_form_projection(t):
    """Risk form projection: wanted columns that exist, one partition value."""
    form = t.customer.withColumnRenamed("c_mktsegment", "date")
    return risk.form_projection(form, ["c_custkey", "c_form", "c_acctbal", "c_notes"], "MACHINERY")


@query(f"""
with f as (select customer_id, updated_at, rtrim(c0 || '| ' || c1, ' |') circumstance from {sub(i.FORMS)}),
y as (select *, case when circumstance is null then null when contains(circumstance, 'SELF_EMPLOYED')
   or contains(circumstance, 'BUSINESS_OWNER') then 'Y' else 'N' end flag from f),
ranked as (select *, row_number() over (partition by customer_id order by (flag is null), updated_at desc, flag desc) rn from y)
select customer_id, flag self_employed from ranked where rn = 1
""")
def q_flag_nonnull_pref(t):
    """Y/N per customer with preference for a value."""
    return funnel.self_employed(frame(t, i.FORMS), ["c0", "c1"])


_APPLICANTS = f"""
log as (select *, coalesce(key_id, alt_key_id) uid from {sub(i.CHANGE_LOG)} where address_country = 'ARE'),
last_ as (select * from (select *, row_number() over (partition by uid order by updated_at desc nulls last, status) rn from log) where rn = 1),
firsts as (select uid, min(updated_at) join_ts, min(case when address_status = 'AWAITING_QR_SCAN' then updated_at end) wait_ts from log group by uid),
people as (select l.uid user_id, first_name, last_name, email, phone,
  case when {_AGE} = 16 then '16' when {_AGE} between 17 and 23 then '17_to_23' when {_AGE} between 24 and 30 then '24_to_30'
       when {_AGE} between 31 and 45 then '31_to_45' when {_AGE} >= 46 then '46+' end age_range,
  case when gender like 'Female%' then 'Female' when gender like 'Male%' then 'Male' end gender,
  status application_status, idv_status, address_status, brand_id, strftime(join_ts, '%Y-%m-%d') join_date,
  {_bucket_case('idv_status', 'address_status', 'status')} bucket,
  case when address_status = 'AWAITING_QR_SCAN' and floor(epoch(timestamp '2024-02-10 12:30:00' - wait_ts) / 604800) >= 3 then '3 weeks or more' end weeks_waiting,
  case pep_passed when 'True' then 'N' when 'False' then 'Y' end pep, nickname
  from last_ l join firsts f on l.uid = f.uid where join_ts >= timestamp '2023-04-16')
"""


@query(f"with {_APPLICANTS} select * from people")
def q_applicants(t):
    """Funnel state per applicant."""
    return funnel.applicants(frame(t, i.CHANGE_LOG), NOW)


@query(f"""
with {_APPLICANTS},
flags as (select customer_id, flag from (select customer_id, flag, row_number() over (partition by customer_id order by (flag is null), updated_at desc, flag desc) rn
  from (select customer_id, updated_at, case when c0 is null then null when contains(c0 || '| ' || c1, 'SELF_EMPLOYED') then 'Y' else 'N' end flag from {sub(i.FORMS_FEW)})) where rn = 1),
today as (select p.*, flag self_employed, case when exists (select 1 from {sub(i.REWORKS)} r where r.user_id = p.user_id) then 'Y' else ' ' end rework
  from people p left join flags on customer_id = p.user_id),
prev as (select * from {sub(i.PREVIOUS)})
select o.user_id, o.first_name, o.last_name, o.email, o.phone, n.age_range, n.gender, o.application_status, o.idv_status,
  o.address_status, o.brand_id, o.join_date, replace(o.original_bucket, '}}', ']') original_bucket, n.weeks_waiting,
  case when n.rework = 'Y' then 'Y' else o.rework end rework, n.pep, n.self_employed, o.called,
  replace(case when n.application_status = 'APPROVED' then 'Y' else o.onboarded end, 'nan', 'N') onboarded, n.nickname,
  case when n.application_status in ('APPROVED', 'REJECTED', 'AWAITING_EXIT_PERIOD', 'CEASED', 'CLOSED', 'AWAITING_BANK_ACCOUNT_CREATION')
    then n.application_status else n.bucket end latest_bucket,
  case when replace(o.original_bucket, '}}', ']') is distinct from n.bucket then 'Y' else 'N' end moved
from prev o left join today n on n.user_id = o.user_id
union all
select user_id, first_name, last_name, email, phone, age_range, gender, application_status, idv_status, address_status, brand_id,
  join_date, bucket, weeks_waiting, rework, pep, self_employed, 'N', 'N', nickname, '', ''
from today where user_id not in (select user_id from prev) and application_status not in ('APPROVED', 'REJECTED')
""")
def q_funnel_report(t):
    """Onboarding funnel report merged into the previous snapshot."""
    return funnel.funnel_report(
        frame(t, i.CHANGE_LOG), frame(t, i.REWORKS), frame(t, i.FORMS_FEW), ["c0", "c1"],
        frame(t, i.PREVIOUS), NOW,
    )


@query("""
with a as (select distinct user_id from events where cast(ts as date) = date '2024-01-15'),
     b as (select distinct user_id from events where cast(ts as date) = date '2024-01-14'),
     d as ((select * from a except select * from b) union (select * from b except select * from a))
select o_custkey user_id, o_orderkey, o_totalprice from orders where o_custkey in (select user_id from d)
""")
def q_changed_children(t):
    """Child records of ids that appeared or disappeared between two days."""
    day = F.to_date("ts")
    today = t.events.where(day == dt.date(2024, 1, 15)).select("user_id")
    before = t.events.where(day == dt.date(2024, 1, 14)).select("user_id")
    children = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderkey", "o_totalprice")
    renamed = children.withColumnRenamed("user_id", "parent")
    return ingest.changed_children(today, before, renamed, "user_id", "parent").withColumnRenamed("parent", "user_id")
