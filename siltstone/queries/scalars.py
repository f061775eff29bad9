"""Text, date, null, money and file-name expressions over the test tables."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from siltstone.functions import dates, rules, text
from siltstone.operators import stamp
from siltstone.operators.nested import parse_map, props
from siltstone.plans.funnel import BUCKET_RULES, bucket
from siltstone.queries.registry import query

AS_OF = dt.date(2020, 1, 1)
NOW = dt.datetime(2024, 2, 10, 12, 30)


@query("""
select doc_id, case when text is not null and trim(text, ' ') <> '' then 1 else 0 end text_populated,
  case when nullif(lang, 'en') is not null then 1 else 0 end lang_populated from documents
""")
def q_populated(t):
    """Populated flags."""
    return t.documents.select(
        "doc_id",
        rules.populated(F.col("text")).alias("text_populated"),
        rules.populated(F.nullif("lang", F.lit("en"))).alias("lang_populated"),
    )


@query("""
select o_orderkey, cast(date_sub('year', b, date '2020-01-01') as integer) as years,
  case when date_sub('year', b, date '2020-01-01') between 17 and 23 then '17_to_23'
       when date_sub('year', b, date '2020-01-01') between 24 and 30 then '24_to_30'
       when date_sub('year', b, date '2020-01-01') between 31 and 45 then '31_to_45'
       when date_sub('year', b, date '2020-01-01') >= 46 then '46+' end age_range
from (select o_orderkey, cast(o_orderdate as date) - cast(o_orderkey % 16000 as integer) b from orders)
""")
def q_age_band(t):
    """Complete years at a fixed day, and the age band."""
    back = (F.col("o_orderkey") % 16000).cast("int")
    born = t.orders.select("o_orderkey", F.date_sub(F.to_date("o_orderdate"), back).alias("b"))
    years = born.withColumn("years", dates.age_years(F.col("b"), AS_OF))
    return years.select("o_orderkey", "years", dates.band(F.col("years"), dates.AGE_BANDS).alias("age_range"))


@query("""
select user_id, weeks, case when weeks >= 3 then '3 weeks or more' end waiting from (
  select user_id, cast(floor(epoch(timestamp '2024-02-10 12:30:00' - min(ts)) / 604800) as bigint) as weeks
  from events where event_type = 'signup' group by user_id)
""")
def q_stale_label(t):
    """Whole weeks since the first signup, with a label from three weeks on."""
    first = t.events.where(F.col("event_type") == "signup").groupBy("user_id").agg(F.min("ts").alias("ts"))
    weeks = first.withColumn("weeks", dates.whole_weeks(F.col("ts"), NOW))
    return weeks.select("user_id", "weeks", F.when(F.col("weeks") >= 3, "3 weeks or more").alias("waiting"))


@query("""
select event_id, coalesce(json_extract_string(props, '$.k'), '') k, '' missing,
  cast(json_extract_string(props, '$.k') as bigint) k_number from events
""")
def q_props(t):
    """Property bag keys with default, and numeric coercion."""
    rows = props(t.events.select("event_id", "props"), "props", ["k", "missing"])
    return rows.withColumn("k_number", rules.to_number(F.col("k"), "bigint")).drop("props")


@query(r"""
select doc_id, replace(replace(replace(replace(text, chr(10), ' '), chr(13), ' '), chr(9), ' '), '  ', ' ') as text
from documents
""")
def q_clean_text(t):
    """Line breaks to spaces, one pass of double spaces."""
    return t.documents.select("doc_id", text.clean_text(F.col("text")).alias("text"))


@query("""
select page_id, replace(replace(replace(replace(html, chr(10), ' '), chr(13), ' '), chr(9), ' '), '  ', ' ') html,
  replace(replace(replace(replace(url, chr(10), ' '), chr(13), ' '), chr(9), ' '), '  ', ' ') url from pages
""")
def q_clean_nested(t):
    """The same on strings inside an array of structs."""
    doc = t.pages.select("page_id", F.array(F.struct("html", "url")).alias("d"))
    cleaned = doc.withColumn("d", text.clean_nested(F.col("d"), doc.schema["d"].dataType))
    return cleaned.select("page_id", F.col("d")[0]["html"].alias("html"), F.col("d")[0]["url"].alias("url"))


@query("""
select p_partkey, rtrim(p_name || ' | ' || '| ', ' |') stripped,
  replace(p_name, 'red', 'RED') replaced, lpad(cast(p_size as varchar), 4, '0') padded,
  contains(p_name, 'ring') or contains(p_name, 'bolt') hit, lower(p_brand) lowered from part
""")
def q_text_ops(t):
    """Strip, replace, pad, contains, lower."""
    name = F.col("p_name")
    return t.part.select(
        "p_partkey",
        text.strip_end(F.concat(name, F.lit(" | | ")), " |").alias("stripped"),
        text.replace_literal(name, "red", "RED").alias("replaced"),
        text.zero_pad(F.col("p_size"), 4).alias("padded"),
        text.contains_any(name, "ring", "bolt").alias("hit"),
        F.lower("p_brand").alias("lowered"),
    )


@query("""
select p_partkey, cur || '_' || cast(p_size as varchar) || '_' || cast(p_size * 10 as varchar) range_text,
  case when cur is null then 0 else p_size end low from
  (select p_partkey, p_size, case when p_partkey % 5 <> 0 then p_brand end cur from part)
""")
def q_range_string(t):
    """Range text, null when a part is null, and its lower bound read back."""
    cur = F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand"))
    rows = t.part.select(
        "p_partkey", text.range_string(cur, F.col("p_size"), F.col("p_size") * 10).alias("range_text")
    )
    low = text.token(F.coalesce("range_text", F.lit("0_0_0")), 2, default="0").try_cast("int")
    return rows.withColumn("low", low)


@query("""
select doc_id, regexp_matches(text, '[À-ÿ]') accented, doc_id % 3 = 0 and contains(text, 'e') arabic from documents
""")
def q_has_script(t):
    """Script detection over whole texts; every third text gets Arabic letters for its e."""
    mixed = F.when(F.col("doc_id") % 3 == 0, F.replace("text", F.lit("e"), F.lit("\u0639"))).otherwise(F.col("text"))
    return t.documents.select(
        "doc_id",
        text.has_script(F.col("text"), [("À", "ÿ")]).alias("accented"),
        text.has_script(mixed).alias("arabic"),
    )


@query("""
select s_suppkey, 'in box/' || s_name || '+a b.csv' plus_kept, 'in box/' || s_name || ' a b.csv' plus_space from supplier
""")
def q_decode_key(t):
    """URL-decoded object keys, both treatments of the plus sign."""
    key = F.concat(F.lit("in%20box/"), F.replace("s_name", F.lit("#"), F.lit("%23")), F.lit("+a%20b.csv"))
    return t.supplier.select(
        "s_suppkey",
        text.decode_key(key, plus_is_space=False).alias("plus_kept"),
        text.decode_key(key).alias("plus_space"),
    )


@query("""
select o_orderkey, coalesce(nullif(case when o_orderkey % 4 = 0 then '' when o_orderkey % 4 = 1 then null
  else o_orderstatus end, ''), 'UNKNOWN') state,
  coalesce(case when o_orderkey % 4 <> 1 then o_orderpriority end, '0_0_0') filled from orders
""")
def q_defaults(t):
    """Blank and null fallbacks."""
    part = F.col("o_orderkey") % 4
    status = F.when(part == 0, "").when(part == 1, None).otherwise(F.col("o_orderstatus"))
    return t.orders.select(
        "o_orderkey",
        rules.blank_to(status).alias("state"),
        rules.or_default(F.when(part != 1, F.col("o_orderpriority")), "0_0_0").alias("filled"),
    )


@query("""
select doc_id, case quality when 1 then 'Y' else 'N' end good,
  case toxic when 1 then 'N' else 'Y' end clean from labels
""")
def q_yes_no(t):
    """Boolean text to Y/N, plain and inverted."""
    return t.labels.select(
        "doc_id",
        rules.yes_no(F.col("quality") == 1).alias("good"),
        rules.yes_no(F.when(F.col("toxic") == 1, "True").otherwise("False"), invert=True).alias("clean"),
    )


@query("""
select o_orderkey, sha256(cast(o_orderkey as varchar) || chr(31) || o_orderstatus) row_id from orders
""")
def q_row_key(t):
    """Repeatable row id."""
    return t.orders.select(
        "o_orderkey", rules.row_key(F.col("o_orderkey"), F.col("o_orderstatus")).alias("row_id")
    )


@query("""
select o_orderkey, case when o_orderkey % 7 <> 0 then strftime(o_orderdate, '%Y-%m-%d') end safe,
  strftime(o_orderdate, '%Y-%m-%d') day_first, o_orderdate iso,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '.000000' filled from orders
""")
def q_date_parse(t):
    """Safe cast, day-first text, ISO text with zone, missing fraction."""
    d = F.col("o_orderdate")
    part = F.col("o_orderkey") % 4
    mixed = (
        F.when(part == 0, F.date_format(d, "dd/MM/yyyy"))
        .when(part == 1, F.date_format(d, "d-M-yyyy"))
        .when(part == 2, F.date_format(d, "yyyy-MM-dd"))
        .otherwise(F.date_format(d, "yyyyMMdd"))
    )
    zone = F.when(part == 0, "Z").when(part == 1, "+0000").when(part == 2, ".000Z").otherwise("")
    iso = F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), zone)
    shaky = F.when(F.col("o_orderkey") % 7 == 0, "not a date").otherwise(F.date_format(d, "yyyy-MM-dd"))
    return t.orders.select(
        "o_orderkey",
        dates.safe_date(shaky).cast("string").alias("safe"),
        dates.parse_date(mixed).cast("string").alias("day_first"),
        dates.iso_timestamp(iso).cast("timestamp_ntz").alias("iso"),
        dates.fill_fraction(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).alias("filled"),
    )


@query("""
select event_id, case when event_id % 7 = 6 then null when event_id % 7 = 1 then date_trunc('minute', ts)
  else date_trunc('second', ts) end parsed from events
""")
def q_multi_format_ts(t):
    """Timestamps rendered in six layouts (and one bad one) read back."""
    layouts = (
        "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyyMMddHHmm", "MMM d, yyyy, hh:mm:ss a",
        "M/d/yyyy h:mm:ss a", "yyyy-MM-dd HH:mm:ss", "dd-MM-yyyy HH:mm:ss", "'at' HH 'h'",
    )
    part = F.col("event_id") % len(layouts)
    shown = rules.decide([(part == i, F.date_format("ts", f)) for i, f in enumerate(layouts)])
    return t.events.select("event_id", dates.parse_ts(shown).cast("timestamp_ntz").alias("parsed"))


@query("""
select event_id, ts from events where ts >= timestamp '2024-01-10' and ts < timestamp '2024-01-13'
""")
def q_day_window(t):
    """Events of three whole days, half-open and pushed to the scan."""
    days = dates.day_window(F.col("ts"), dt.date(2024, 1, 10), dt.date(2024, 1, 12))
    return t.events.where(days).select("event_id", "ts")


@query("""
select event_id, json_extract_string(props, '$.k') k, case when event_id % 4 = 3 then null else event_type end kind,
  event_id % 4 = 3 as none_kind from events
""")
def q_parse_map(t):
    """Property text rewritten as literal text, parsed to a map."""
    number = F.get_json_object("props", "$.k")
    kind = F.when(F.col("event_id") % 4 == 3, "None").otherwise(F.concat(F.lit("'"), "event_type", F.lit("'")))
    literal = F.concat(F.lit("{'k': "), number, F.lit(", 'kind': "), kind, F.lit(", 'ok': True}"))
    bag = parse_map(literal)
    return t.events.select(
        "event_id", bag["k"].alias("k"), bag["kind"].alias("kind"), bag["kind"].isNull().alias("none_kind")
    )


@query("""
select o_orderkey, cast(case o_orderstatus when 'F' then cast(o_totalprice as decimal(20,2))
  when 'O' then cast(o_totalprice as decimal(20,2)) * 0.78 end as double) converted from orders
""")
def q_convert(t):
    """Fixed-rate conversion, exact; a currency without rate is null."""
    rates = {"F": Decimal("1"), "O": Decimal("0.78")}
    money = rules.convert(F.col("o_totalprice"), F.col("o_orderstatus"), rates)
    return t.orders.select("o_orderkey", money.cast("double").alias("converted"))


@query("""
select p_partkey, case when p_partkey % 3 = 0 then null else p_size end as_null,
  case when p_partkey % 3 = 0 then 0 else p_size end as_zero from part
""")
def q_to_number(t):
    """Bad numbers to null or to zero."""
    shaky = F.when(F.col("p_partkey") % 3 == 0, "n/a").otherwise(F.col("p_size").cast("string"))
    return t.part.select(
        "p_partkey",
        rules.to_number(shaky, "int").alias("as_null"),
        rules.to_number(shaky, "int", "zero").alias("as_zero"),
    )


# Card-like file names built from supplier rows.
_NAME = """
select s_suppkey, 'in/x_' || case s_suppkey % 4 when 0 then 'Fees' when 1 then 'INTERCHANGE'
  when 2 then 'presentments' else 'other' end || '_' ||
  case s_suppkey % 5 when 0 then '20310704' when 1 then '20310704_to_20310802' when 2 then '20310231'
  when 3 then 'summer' else '20300101' end || '_' || cast(s_suppkey as {text}) || '.csv' as path from supplier
"""


def file_names(t):
    t.supplier.createOrReplaceTempView("supplier")
    return t.spark.sql(_NAME.format(text="string"))


FILE_NAMES = "(" + _NAME.format(text="varchar") + ")"


@query(f"""
select s_suppkey, case when contains(lower(path), '_fees_') then 'fees'
  when contains(lower(path), '_interchange_') then 'interchange'
  when contains(lower(path), '_presentments_') then 'presentments' end file_group,
  strftime(try_strptime(d1, '%Y%m%d'), '%Y-%m-%d') first_day,
  strftime(try_strptime(case when d2 = '' then d1 else d2 end, '%Y%m%d'), '%Y-%m-%d') last_day
from (select *, regexp_extract(path, '_([0-9]{{8}})(?:_to_([0-9]{{8}}))?', 1) d1,
  regexp_extract(path, '_([0-9]{{8}})(?:_to_([0-9]{{8}}))?', 2) d2 from {FILE_NAMES})
""")
def q_file_class(t):
    """Group and day range from file names."""
    name = text.base_name(F.col("path"))
    first, last = rules.file_dates(name)
    groups = {"_fees_": "fees", "_interchange_": "interchange", "_presentments_": "presentments"}
    return file_names(t).select(
        "s_suppkey",
        rules.file_group(name, groups).alias("file_group"),
        first.cast("string").alias("first_day"),
        last.cast("string").alias("last_day"),
    )


@query("""
select page_id, case split_part(p, '/', 1) when 'http:' then 'plain' when 'https:' then 'secure' else 'other' end target,
  case when contains(lower(url), 'example.com') then 'com' when contains(lower(url), 'example.org') then 'org' end site
from (select page_id, url, url p from pages)
""")
def q_route(t):
    """Target by first path segment; class by substring."""
    return t.pages.select(
        "page_id",
        rules.route(F.col("url"), {"http:": "plain", "https:": "secure"}, "other").alias("target"),
        rules.file_group(F.col("url"), {"example.com": "com", "example.org": "org"}).alias("site"),
    )


@query("""
select o_orderkey, strftime(o_orderdate, '%Y%m%d') as "day" from orders
""")
def q_name_date(t):
    """Day from a report file name."""
    name = F.concat(F.lit("in/Balances_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("0730_x.json"))
    return t.orders.select("o_orderkey", rules.name_date(name).alias("day"))


_LOW, _HIGH = dt.date(1996, 3, 1), dt.date(1996, 12, 31)


@query("""
select o_custkey, first_day, last_day from (select o_custkey, min(o_orderdate) first_day,
  max(case when o_custkey % 2 = 0 and o_orderstatus <> 'F' then o_orderdate end) last_day from orders group by 1)
where first_day is not null and last_day is not null
  and last_day >= date '1996-03-01' and first_day <= date '1996-12-31'
""")
def q_overlap(t):
    """Customers whose order span meets a window; open spans drop out when one is asked for."""
    closed = (F.col("o_custkey") % 2 == 0) & (F.col("o_orderstatus") != "F")
    spans = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_day"),
        F.max(F.when(closed, F.col("o_orderdate"))).alias("last_day"),
    )
    return spans.where(rules.overlaps(F.col("first_day"), F.col("last_day"), _LOW, _HIGH))


@query("""
select o_orderkey, '20240210' as "date", timestamp '2024-02-10 12:30:00' timestamp_extracted,
  'application/json' record_format, 'https://feed.example/orders' extract_url,
  strftime(o_orderdate, '%Y') as "year", strftime(o_orderdate, '%m') as "month", strftime(o_orderdate, '%d') as "day" from orders
""")
def q_ingest_stamp(t):
    """Ingest metadata and text partition columns."""
    rows = stamp.stamp(
        t.orders.select("o_orderkey", "o_orderdate"), NOW.date(), NOW,
        record_format="application/json", extract_url="https://feed.example/orders",
    )
    return stamp.date_parts(rows, F.col("o_orderdate")).drop("o_orderdate")


@query("""
select o_orderkey, cast(year(o_orderdate) as integer) as "year", cast(month(o_orderdate) as integer) as "month",
  cast(day(o_orderdate) as integer) as "day" from orders
""")
def q_date_parts_int(t):
    """Integer partition columns."""
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return stamp.date_parts(rows, F.col("o_orderdate"), as_text=False).drop("o_orderdate")


@query("""
select o_orderkey, strftime(o_orderdate, '%Y') as "year", strftime(o_orderdate, '%m') as "month", strftime(o_orderdate, '%d') as "day" from orders
""")
def q_date_parts_text(t):
    """Partition columns cut from date text."""
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return stamp.date_parts_of_text(rows, "d").drop("d")


@query("""
select o_orderkey, strftime(o_orderdate, '%Y%m%d') as "date", strftime(o_orderdate, '%d %b') "dateAsString",
  'N' called, '' moved from orders
""")
def q_swap_defaults(t):
    """Raw date and partition text exchanged, constants filled in."""
    rows = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "dd MMM").alias("date"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("dateAsString"),
    )
    return stamp.constants(stamp.swap_date(rows), {"called": "N", "moved": ""})


def _bucket_case(idv: str, address: str, status: str) -> str:
    def among(column, values):
        return f"{column} in ({', '.join(repr(v) for v in values)})"

    lines = []
    for idvs, addresses, statuses, label in BUCKET_RULES:
        cond = f"{among(idv, idvs)} and {among(address, addresses)}"
        if statuses:
            cond += f" and {among(status, statuses)}"
        quoted = label.replace("'", "''")
        lines.append(f"when {cond} then '[{quoted}]'")
    return "case " + " ".join(lines) + " end"


_STATUSES = """
select event_id,
  case event_id % 5 when 0 then 'PASSED' when 1 then 'UNKNOWN' when 2 then 'PENDING'
    when 3 then 'AWAITING_CUSTOMER_RETRY' else 'PASSED' end idv_status,
  case user_id % 7 when 0 then 'AWAITING_MANUAL_REVIEW' when 1 then 'AWAITING_QR_SCAN' when 2 then 'VERIFIED'
    when 3 then 'AWAITING_MANUAL_INPUT' when 4 then 'AWAITING_DOCUMENT_UPLOAD'
    when 5 then 'AWAITING_PROVIDER_SELECTION' else 'VERIFIED' end address_status,
  case event_type when 'click' then 'AWAITING_SUBMISSION' when 'view' then 'AWAITING_MANUAL_REVIEW'
    when 'error' then 'AWAITING_APPROVAL' when 'signup' then 'AWAITING_ADDITIONAL_DOCUMENTS' else 'OTHER' end status
from events
"""


@query(f"""
select event_id, {_bucket_case('idv_status', 'address_status', 'status')} bucket from ({_STATUSES})
""")
def q_funnel_bucket(t):
    """Ordered decision table over three statuses."""
    t.events.createOrReplaceTempView("events")
    rows = t.spark.sql(_STATUSES)
    value = bucket(F.col("idv_status"), F.col("address_status"), F.col("status"))
    return rows.select("event_id", value.alias("bucket"))
