"""Job inputs derived from the test tables.

Each text is plain SQL that Spark and the oracle both accept, so a job and its oracle
start from the same rows; the jobs themselves are written twice.
"""

from pyspark.sql import DataFrame

CHANGE_LOG = """
select
  case when e.event_id % 3 <> 0 then cast(e.user_id as string) end as key_id,
  case when e.event_id % 3 = 0 then cast(e.user_id as string) end as alt_key_id,
  cast(e.user_id as string) as image_id,
  case when e.event_id % 97 <> 0 then e.ts end as updated_at,
  case e.event_type when 'purchase' then 'APPROVED' when 'error' then 'REJECTED'
    when 'signup' then 'AWAITING_SUBMISSION' when 'click' then 'AWAITING_MANUAL_REVIEW'
    else 'AWAITING_APPROVAL' end as status,
  case when c.c_custkey % 11 = 0 then 'unknown' when c.c_custkey % 13 = 0 then ' '
    when c.c_custkey % 17 = 0 then cast(null as string)
    else cast(date '1955-01-01' + cast(c.c_custkey * 211 % 19000 as int) as string) end as date_of_birth,
  case c.c_custkey % 3 when 0 then 'Female (F)' when 1 then 'Male' else 'Other' end as gender,
  case when e.event_id % 5 = 0 then '  ' else c.c_name end as phone,
  case when e.event_id % 7 <> 0 then lower(c.c_name) end as email,
  c.c_mktsegment as nickname,
  cast(c.c_nationkey as string) as nationality,
  case when c.c_nationkey < 20 then 'ARE' else 'GBR' end as address_country,
  case e.event_id % 6 when 0 then 'AWAITING_MANUAL_REVIEW' when 1 then 'AWAITING_QR_SCAN'
    when 2 then 'VERIFIED' when 3 then 'AWAITING_MANUAL_INPUT' when 4 then 'AWAITING_PROVIDER_SELECTION'
    else 'AWAITING_DOCUMENT_UPLOAD' end as address_status,
  case e.event_id % 4 when 0 then 'PASSED' when 1 then 'UNKNOWN' when 2 then 'PENDING'
    else 'AWAITING_CUSTOMER_RETRY' end as idv_status,
  e.event_type as brand_id,
  case when e.event_id % 10 = 0 then cast(null as string) when e.event_id % 2 = 0 then 'True' else 'False' end as pep_passed,
  case when e.event_id % 2 = 0 then 'yes' else 'no' end as card_ordered,
  c.c_name as first_name, c.c_mktsegment as last_name,
  e.event_id % 2 = 0 as push_marketing, e.event_id % 3 = 0 as sms_marketing, e.event_id % 5 = 0 as email_marketing
from events e left join customer c on c.c_custkey = e.user_id
"""

CLIENTS = """
select 'enc-' || cast(c_custkey as string) as encoded_key, cast(c_custkey as string) as id,
  'INACTIVE' as state, '2024-01-01T00:00:00Z' as last_modified_date from customer where c_custkey % 9 <> 4
union all
select 'enc-' || cast(c_custkey as string), cast(c_custkey as string), 'ACTIVE', '2024-01-02T00:00:00Z'
from customer where c_custkey % 9 <> 4
"""

ACCOUNTS = """
select 'acc-' || cast(o_orderkey as string) as id, 'key-' || cast(o_orderkey as string) as encoded_key,
  'enc-' || cast(o_custkey as string) as account_holder_key,
  case when o_orderkey % 2 = 0 then 'CURRENT' else 'SAVINGS' end as account_type,
  o_orderpriority as name, case o_orderstatus when 'F' then 'GBP' when 'O' then 'USD' else 'EUR' end as currency_code,
  o_orderstatus as account_state, cast(cast(o_totalprice as decimal(20,2)) as string) as balances_total_balance,
  {iso} as last_modified_date, {iso} as approved_date, {iso} as activation_date,
  case when o_orderkey % 2 = 1 then {iso} end as maturity_date,
  o_orderstatus as accrued_interest, '1.5' as interest_rate
from orders
"""

CARDS = """
select cast(user_id as string) as user_id, ts as updated_at,
  case event_type when 'error' then '' when 'view' then cast(null as string) else event_type end as state
from events
"""

TRANSACTIONS = """
select 'key-' || cast(l_orderkey as string) as parent_account_key,
  case l_returnflag when 'A' then 'GBP' when 'R' then 'USD' else 'EUR' end as currency_code,
  cast(cast(l_extendedprice as decimal(20,2)) as string) as amount,
  case l_linenumber % 4 when 0 then 'CARD-FAST' when 1 then 'OUT_DOMESTIC'
    when 2 then 'OUT_LOCAL' else 'OTHER' end as channel_id,
  case l_linestatus when 'O' then 'WITHDRAWAL' else 'DEPOSIT' end as type
from lineitem
"""

FORMS = """
select cast(user_id as string) as customer_id, ts as updated_at,
  case when event_id % 4 <> 0 then event_type end as c0,
  case when event_id % 3 = 0 then 'SELF_EMPLOYED' when event_id % 3 = 1 then 'BUSINESS_OWNER_X' else ' ' end as c1
from events
"""

FORMS_FEW = """
select cast(user_id as string) as customer_id, ts as updated_at,
  case when event_id % 4 <> 0 then event_type end as c0,
  case when user_id % 3 = 0 and event_id % 3 = 0 then 'SELF_EMPLOYED' else ' ' end as c1
from events
"""

REWORKS = """
select cast(o_custkey as string) as user_id from orders where o_orderpriority = '1-URGENT' and o_orderstatus = 'F'
"""

PREVIOUS = """
select distinct cast(user_id as string) as user_id, 'f' as first_name, 'l' as last_name, 'e' as email, 'p' as phone,
  '16' as age_range, 'Male' as gender, 's' as application_status, 'i' as idv_status, 'a' as address_status,
  'b' as brand_id, '2024-01-01' as join_date,
  case user_id % 3 when 0 then '[Complete IDV, Awaiting QR Scan]' when 1 then '[Complete IDV, Awaiting QR Scan}}'
    else cast(null as string) end as original_bucket,
  cast(null as string) as weeks_waiting, case when user_id % 2 = 0 then 'Y' else ' ' end as rework,
  'N' as pep, 'N' as self_employed, 'Y' as called, case when user_id % 5 = 0 then 'nan' else 'N' end as onboarded,
  'n' as nickname, '' as latest_bucket, '' as moved
from events where user_id % 4 <> 1
"""

TABLES = ("events", "customer", "orders", "lineitem", "supplier", "nation")
SPARK_ISO = "date_format(o_orderdate, 'yyyy-MM-dd') || 'T00:00:00+0000'"
ORACLE_ISO = "strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+0000'"


def frame(t, text: str) -> DataFrame:
    """The input as a Spark frame."""
    for name in TABLES:
        getattr(t, name).createOrReplaceTempView(name)
    return t.spark.sql(text.format(iso=SPARK_ISO))


def sub(text: str) -> str:
    """The input as an oracle subquery."""
    return "(" + text.format(iso=ORACLE_ISO) + ")"
