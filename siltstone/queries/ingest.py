"""Landing jobs re-aimed on the test tables."""

import datetime as dt
import re

from pyspark.sql import functions as F

from siltstone.plans import ingest
from siltstone.queries.registry import query
from siltstone.queries.scalars import FILE_NAMES, file_names
from siltstone.session import work_path
from siltstone.sources.readers import list_files

DAY = dt.date(2024, 2, 10)
FIRST, LAST = dt.date(1996, 1, 1), dt.date(1996, 12, 31)
NOW = dt.datetime(2024, 2, 10, 12, 30)


@query("""
select cast(event_id as varchar) event_id, event_type, user_id, cast(value as varchar) os_version, '{"brandId": "' || event_type || '"}' event_properties,
  case when event_id % 4 <> 0 then cast(event_id as double) end dma,
  event_type "brandId", '' as "type", '' "marketingId", '2024' as "year", '02' as "month", '10' as "day" from events
""")
def q_curated_events(t):
    """Event export: selected columns, partition text, coerced code, extracted properties."""
    dma = F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("event_id").cast("string"))
    bag = F.concat(F.lit('{"brandId": "'), "event_type", F.lit('"}'))
    rows = t.events.select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", "user_id", "props",
        F.col("value").alias("os_version"), dma.alias("dma"), bag.alias("event_properties"),
    )
    columns = ["event_id", "event_type", "user_id", "os_version", "dma", "event_properties", "absent"]
    return ingest.curated_events(rows, DAY, columns)


_PLAN = f"""
select path, split_part(path, '/', 2) filename, first_day, last_day, file_group,
  case when first_day is null then 'undated'
    when last_day < '2031-06-20' or first_day > '2031-08-15' then 'out of range'
    when file_group is null then 'no group' when s_suppkey % 7 = 0 then 'exists' else 'copied' end outcome
from (select path, s_suppkey,
  case s_suppkey % 5 when 0 then '2031-07-04' when 1 then '2031-07-04' when 4 then '2030-01-01' end first_day,
  case s_suppkey % 5 when 0 then '2031-07-04' when 1 then '2031-08-02' when 4 then '2030-01-01' end last_day,
  case s_suppkey % 4 when 0 then 'fees' when 1 then 'interchange' when 2 then 'presentments' end file_group
  from {FILE_NAMES})
"""


def _plan(t):
    files = file_names(t)
    done = files.where(F.col("s_suppkey") % 7 == 0).select("path")
    return ingest.backfill_plan(files.select("path"), done, dt.date(2031, 6, 20), dt.date(2031, 8, 15))


@query(_PLAN)
def q_backfill_plan(t):
    """What a date-range backfill does with every file."""
    return _plan(t).withColumns({c: F.col(c).cast("string") for c in ("first_day", "last_day")})


@query(f"""
select count(*) filter (where outcome in ('copied', 'exists', 'no group')) processed,
  count(*) filter (where outcome = 'copied') copied,
  count(*) filter (where outcome in ('exists', 'no group', 'undated')) skipped from ({_PLAN})
""")
def q_backfill_summary(t):
    """Backfill counts."""
    return ingest.backfill_summary(_plan(t))


_SCHEMA = {
    "amount_instructedAmount": "double", "amount_currency": "string",
    "counterpartAccount_identification_iban": "string",
    "counterpartAccount_identification_other_schemeName_code": "string",
    "debitCreditCode": "string", "transactionId": "string", "status": "string",
    "ultimateRemitterAccount_id": "string", "notDelivered": "string",
    "date": "string", "timestamp_extracted": "timestamp_ntz",
}


@query("""
select l_quantity "amount_instructedAmount", 'GBP' amount_currency,
  case when l_linenumber % 3 <> 0 then 'IBAN' || l_suppkey end "counterpartAccount_identification_iban",
  case when l_linenumber % 3 <> 0 then 'BBAN' end "counterpartAccount_identification_other_schemeName_code",
  l_returnflag "debitCreditCode", l_orderkey || '-' || l_linenumber "transactionId", l_linestatus status,
  null::varchar "ultimateRemitterAccount_id", '2024-02-10' as "date", timestamp '2024-02-10 12:30:00' timestamp_extracted
from lineitem
""")
def q_raw_transactions(t):
    """Transactions with document columns as JSON and as literal text, flattened and aligned."""
    amount = F.to_json(F.struct(F.col("l_quantity").alias("instructedAmount"), F.lit("GBP").alias("currency")))
    account = F.when(
        F.col("l_linenumber") % 3 != 0,
        F.concat(
            F.lit("{'identification': {'iban': 'IBAN"), F.col("l_suppkey").cast("string"),
            F.lit("', 'reference': None, 'other': {'schemeName': {'code': 'BBAN'}}}}"),
        ),
    )
    pages = t.lineitem.select(
        amount.alias("amount"),
        account.alias("counterpartAccount"),
        F.col("l_returnflag").alias("debitCreditCode"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("transactionId"),
        F.col("l_linestatus").alias("status"),
        F.lit("none").alias("ultimateRemitterAccount"),
        F.lit("old").alias("date"),
    )
    return ingest.raw_transactions(pages, _SCHEMA, DAY, NOW)


def _positions(t):
    record = F.struct(
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("date"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dateAsString"),
        F.col("o_totalprice").alias("amount"),
    )
    responses = t.orders.select(
        F.col("o_custkey").alias("portfolio_id"),
        F.to_date("o_orderdate").alias("request_date"),
        F.when(F.col("o_orderkey") % 10 != 0, F.array(record, record)).alias("records"),
    )
    portfolios = t.customer.select(F.col("c_custkey").alias("portfolio_id"))
    return ingest.positions(responses, portfolios, dt.date(1996, 3, 1), dt.date(1996, 3, 7), NOW)


@query("""
select o_custkey portfolio_id, strftime(o_orderdate, '%Y%m%d') as "date", strftime(o_orderdate, '%d/%m/%Y') "dateAsString",
  o_totalprice amount, timestamp '2024-02-10 12:30:00' timestamp_extracted
from orders, (values (1), (2)) twice where o_orderkey % 10 <> 0
""")
def q_positions(t):
    """Position records with the date fields exchanged."""
    return _positions(t)[0]


@query("""
select c_custkey portfolio_id, coalesce(days, 0) processed, 7 - coalesce(days, 0) failed, cast(coalesce(n, 0) as bigint) records,
  case when coalesce(days, 0) = 7 then 'completed' else 'partial' end status
from customer left join (select o_custkey, count(distinct o_orderdate) as days, count(*) * 2 n from orders
  where o_orderkey % 10 <> 0 and o_orderdate >= date '1996-03-01' and o_orderdate < date '1996-03-08' group by 1)
on o_custkey = c_custkey
""")
def q_positions_summary(t):
    """Outcome per portfolio over the requested days."""
    return _positions(t)[1]


@query("""
select strftime(ts, '%Y-%m-%d') asked_at, min(case when event_type = 'click' then value end) "GBPUSD",
  min(case when event_type = 'view' then value end) "GBPEUR", '20240210' as "date",
  timestamp '2024-02-10 12:30:00' timestamp_extracted, 'application/json' record_format,
  'https://feed.example/v2/detailed' extract_url, 'rates_detailed' table_name from events group by 1
""")
def q_rate_row(t):
    """One column per currency pair, stamped."""
    pair = F.when(F.col("event_type") == "click", "GBPUSD").when(F.col("event_type") == "view", "GBPEUR")
    rates = t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("asked_at"), pair.alias("pair"), F.col("value").alias("rate")
    )
    return ingest.rate_row(rates, ["GBPUSD", "GBPEUR"], DAY, NOW, "https://feed.example/v2/detailed")


@query("""
select cast(p_partkey as integer) id, p_retailprice owner_price, p_type owner_kind, 20230506 made,
  null::varchar hollow, '20240210' as "date", timestamp '2024-02-10 12:30:00' timestamp_extracted,
  'application/json' record_format, 'https://feed.example/v2/accounts' extract_url, 'feed_accounts' table_name from part
""")
def q_typed_records(t):
    """Records of pages flattened and typed by whole-column truth."""
    record = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.struct(F.col("p_retailprice").cast("string").alias("price"), F.col("p_type").alias("kind")).alias("owner"),
        F.lit("20230506").alias("made"),
        F.lit(None).cast("string").alias("hollow"),
    )
    pages = t.part.select(F.array(record).alias("records"))
    return ingest.typed_records(pages, "records", DAY, NOW, "https://feed.example/v2/accounts")


_FEES = {"orderkey": "bigint", "linenumber": "bigint", "fee": "double", "note": "string"}


@query("""
select l_orderkey orderkey, l_linenumber linenumber, l_extendedprice fee, 'line ' || l_linestatus || chr(10) || '"' || l_returnflag || '", end' note
from lineitem
""")
def q_card_files(t):
    """Delivered CSV files of two column orders, with quoted line breaks, loaded by name; a second run finds none."""
    note = F.concat(F.lit("line "), "l_linestatus", F.lit('\n"'), "l_returnflag", F.lit('", end'))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("OrderKey"), F.col("l_linenumber").alias("LINENUMBER"), F.col("l_extendedprice").alias("Fee"),
        note.alias("note"), F.lit("x").alias("junk"),
    )
    landed, folder = work_path(t.spark, "cards-parts"), work_path(t.spark, "cards")
    options = {"header": "true", "escape": "\\", "quoteAll": "true"}
    one, two = lines.where(F.col("LINENUMBER") % 2 == 0), lines.where(F.col("LINENUMBER") % 2 == 1)
    one.write.options(**options).csv(landed)
    two.select("note", "junk", "Fee", "OrderKey", "LINENUMBER").write.mode("append").options(**options).csv(landed)
    _deliver(t, landed, folder, lambda n, _: f"x_Fees_{n}.csv")
    frames, done = ingest.load_card_files(t.spark, folder, _no_paths(t), {"fees": _FEES})
    rows = frames["fees"].select(*_FEES)
    seen, _ = ingest.load_card_files(t.spark, folder, done, {"fees": _FEES})
    assert not seen
    return rows


def _no_paths(t):
    return t.spark.createDataFrame([], "path string")


def _deliver(t, landed, folder, name):
    """Give the part files of a written table the names that deliveries have: ``name(number, path)``."""
    paths = t.spark._jvm.org.apache.hadoop.fs.Path
    store = paths(landed).getFileSystem(t.spark._jsc.hadoopConfiguration())
    store.mkdirs(paths(folder))
    parts = [r["path"] for r in list_files(t.spark, landed, "part-*").orderBy("path").collect()]
    for number, part in enumerate(parts):
        store.rename(paths(part), paths(f"{folder}/{name(number, part)}"))


# Rows of a delivered report file, about.
_REPORT_ROWS = 20_000


@query(f"""
select o_orderkey id, o_orderpriority kind, cast(o_orderdate as date) booked, o_totalprice amount, strftime(o_orderdate, '%Y%m') || '01' as "date",
  timestamp '2024-02-10 12:30:00' timestamp_extracted
from orders where o_orderdate >= date '{FIRST}' and o_orderdate < date '{LAST + dt.timedelta(days=1)}'
""")
def q_report_files(t):
    """JSON-array report files of each month, of a day range, typed and dated by their file names."""
    landed, folder = work_path(t.spark, "report-parts"), work_path(t.spark, "reports")
    record = F.struct(
        F.col("o_orderkey").alias("Id"), F.col("o_orderpriority").alias("KIND"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Booked"), F.col("o_totalprice").alias("Amount"),
    )
    month = F.date_format("o_orderdate", "yyyyMM")
    orders = t.orders.withColumn("month", month).where("month is not null")
    # A month is dealt over as many files as its rows fill: none is gathered whole, and files grow with rows, not with the span of keys.
    sizes = orders.groupBy("month").agg(F.count("*").alias("n"))
    files = F.ceil(F.col("n") / _REPORT_ROWS)
    dealt = orders.join(F.broadcast(sizes), "month").withColumn("part", F.pmod(F.xxhash64("o_orderkey"), files))
    reports = dealt.groupBy("month", "part").agg(F.to_json(F.collect_list(record)).alias("value"))
    reports.select("month", "value").write.partitionBy("month").option("maxRecordsPerFile", 1).text(landed)
    _deliver(t, landed, folder, lambda n, path: f"Balances_{re.search('month=([0-9]+)', path)[1]}01{n:06d}.json")
    paths = ingest.report_files(t.spark, folder, "Balances", FIRST, LAST)
    return ingest.load_report(t.spark, paths, NOW)
