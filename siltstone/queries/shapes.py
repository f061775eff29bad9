"""Projection to schemas, nested documents, profiles and inference."""

import datetime as dt

from pyspark.sql import functions as F

from siltstone import schema as sc
from siltstone.functions.dates import date_span
from siltstone.operators import conform as c
from siltstone.operators import nested as n
from siltstone.operators import profile
from siltstone.operators.joins import work_list
from siltstone.operators.profile import infer_schema
from siltstone.queries.registry import query
from siltstone.session import work_path
from siltstone.sources.readers import list_columns, read_table
from siltstone.sources.writers import write_table

# ---------------------------------------------------------------- projection


@query("""
select cast(c_custkey as varchar) c_custkey, c_acctbal, cast(null as integer) region,
  try_cast(c_mktsegment as double) c_mktsegment from customer
""")
def q_conform(t):
    """Declared columns, order and types; missing ones null-filled, extra ones dropped."""
    schema = {"c_custkey": "string", "c_acctbal": "double", "region": "int", "c_mktsegment": "double"}
    return c.conform(t.customer, schema)


@query("""
select cast(p_partkey as integer) p_partkey, case when p_partkey % 3 = 0 then 0.0 else p_retailprice end price from part
""")
def q_conform_zero(t):
    """Aligned without filling; bad numbers become 0."""
    price = F.when(F.col("p_partkey") % 3 == 0, "?").otherwise(F.col("p_retailprice").cast("string"))
    rows = t.part.withColumn("price", price)
    return c.conform(rows, {"p_partkey": "int", "price": "double", "absent": "int"}, False, "zero")


@query("select c_custkey, c_name, c_acctbal from customer")
def q_keep_list(t):
    """Listed columns that exist, input order."""
    return c.keep_listed(t.customer, ["c_acctbal", "c_name", "nope", "c_custkey"])


@query("select c_acctbal, c_custkey from customer")
def q_keep_declared(t):
    """Listed columns that exist, list order."""
    return c.keep_declared(t.customer, ["c_acctbal", "nope", "c_custkey"])


@query("""
select s_suppkey supplier_key, s_name as "name", s_acctbal balance, '' halt from supplier
""")
def q_renamed(t):
    """Drop, rename by map, fill an expected column, drop by prefix."""
    rows = t.supplier.withColumn("links_self", F.lit("x")).withColumn("links_next", F.lit("y"))
    kept = c.drop_prefixed(c.drop_present(rows, "s_nationkey", "nope"), "links")
    named = c.rename(kept, {"s_suppkey": "supplier_key", "s_name": "name", "s_acctbal": "balance"})
    return c.fill_blank(named, ["halt", "name"])


@query("select s_suppkey a, s_name b, s_nationkey c, s_acctbal d from supplier")
def q_renamed_positional(t):
    """Rename by position."""
    return c.rename_positional(t.supplier, ["a", "b", "c", "d"])


@query("select n_nationkey nation_key, n_name nation_name, n_regionkey region_id from nation")
def q_snake_case(t):
    """camelCase and upper-case names to snake_case and lower case."""
    rows = c.snake_case(t.nation.toDF("nationKey", "NationName", "regionID"))
    return c.lower_names(rows.toDF(*[x.upper() for x in rows.columns]))


@query("select s_suppkey, s_acctbal from supplier")
def q_dynamic_projection(t):
    """Wanted columns that the table has, read from catalog metadata."""
    t.supplier.createOrReplaceTempView("supplier_raw")
    existing = list_columns(t.spark, "supplier_raw")
    wanted = [w for w in ("s_suppkey", "s_phone", "s_acctbal", "s_comment") if w in existing]
    return c.project_existing(t.spark.table("supplier_raw"), wanted)


@query("""
select p_partkey, p_name from part where p_type in ('ECONOMY', 'STANDARD') and p_name like 'red%' and p_size > 10
""")
def q_named_projection(t):
    """One entry of a projection catalog."""
    catalog = {
        "all": (["p_partkey"], None),
        "red": (
            ["p_partkey", "p_name"],
            F.col("p_type").isin("ECONOMY", "STANDARD") & F.col("p_name").like("red%") & (F.col("p_size") > 10),
        ),
    }
    return c.named_projection(t.part, catalog, "red")


# ---------------------------------------------------------------- nested


@query("""
select o_orderkey id, o_orderstatus state_code, o_orderpriority state_prio_text,
  split_part(o_orderpriority, '-', 1) state_prio_parts_0, nullif(split_part(o_orderpriority, '-', 2), '') state_prio_parts_1,
  o_custkey items_0_cust, o_totalprice items_0_price,
  case when o_orderkey % 2 = 0 then o_custkey + 1 end items_1_cust, case when o_orderkey % 2 = 0 then 0.5 end items_1_price
from orders
""")
def q_flatten(t):
    """Structs and arrays to flat columns; widths measured in one pass, one root key ignored."""
    first = F.struct(F.col("o_custkey").alias("cust"), F.col("o_totalprice").alias("price"))
    second = F.struct((F.col("o_custkey") + 1).alias("cust"), F.lit(0.5).alias("price"))
    doc = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.struct(
            F.col("o_orderstatus").alias("code"),
            F.struct(
                F.col("o_orderpriority").alias("text"),
                F.slice(F.split("o_orderpriority", "-"), 1, 2).alias("parts"),
            ).alias("prio"),
        ).alias("state"),
        F.when(F.col("o_orderkey") % 2 == 0, F.array(first, second)).otherwise(F.array(first)).alias("items"),
        F.struct(F.lit("x").alias("href")).alias("links"),
    )
    return n.flatten(doc, ignore=["links"])


@query("""
select event_id, event_type, k amount_value, case when event_id % 5 <> 0 then 'USD' end amount_unit_code,
  case when event_id % 3 <> 0 then user_id end owner_id from
  (select *, case when event_id % 5 <> 0 then cast(json_extract_string(props, '$.k') as bigint) end k from events)
""")
def q_flatten_columns(t):
    """Document columns flattened row by row; null documents keep their row."""
    number = F.get_json_object("props", "$.k")
    amount = F.when(
        F.col("event_id") % 5 != 0,
        F.concat(F.lit("{'value': "), number, F.lit(", 'unit': {'code': 'USD', 'old': None}}")),
    )
    owner = F.when(F.col("event_id") % 3 != 0, F.struct(F.col("user_id").alias("id")))
    rows = t.events.select("event_id", amount.alias("amount"), "event_type", owner.alias("owner"))
    return n.flatten_columns(
        rows, {"amount": "value bigint, unit struct<code: string>", "owner": None, "absent": None}
    )


@query("""
select p_partkey, cast(pos as integer) position, word from
 (select p_partkey, unnest(string_split(p_name, ' ')) word, generate_subscripts(string_split(p_name, ' '), 1) - 1 pos from part)
""")
def q_explode_items(t):
    """Array items to rows with their position."""
    rows = t.part.select("p_partkey", F.split("p_name", " ").alias("words"))
    return n.explode_items(rows, "words", "position", "word")


@query("""
select event_id, user_id, event_type, value from events
""")
def q_envelope(t):
    """Events wrapped in a JSON envelope and unwrapped again."""
    record = F.struct(F.lit("feed").alias("source"), F.struct("event_id", "user_id", "event_type", "value").alias("row"))
    noise = F.struct(F.lit("other").alias("source"), F.struct("event_id", "user_id", "event_type", "value").alias("row"))
    body = F.to_json(F.struct(F.array(record, noise).alias("Records")))
    ddl = "Records array<struct<source: string, `row`: struct<event_id: bigint, user_id: bigint, event_type: string, value: double>>>"
    rows = n.unwrap(
        t.events.select(body.alias("body")), "body", ddl, "Records", where=F.col("record.source") == "feed"
    )
    return rows.select("record.row.*")


@query("""
select o_orderkey, o_totalprice total, [o_orderstatus, 'x'][1] first_tag, null::bigint absent from orders
""")
def q_pick_objects(t):
    """Chosen top-level objects of a response; absent ones are null."""
    response = F.to_json(
        F.struct(
            F.struct(F.col("o_totalprice").alias("amount")).alias("total"),
            F.array(F.col("o_orderstatus"), F.lit("x")).alias("tags"),
            F.struct(F.lit(1).alias("pages")).alias("pagination"),
        )
    )
    objects = {"total": "struct<amount: double>", "tags": "array<string>", "absent": "bigint"}
    picked = n.pick_objects(t.orders.select("o_orderkey", response.alias("r")), "r", objects, ["o_orderkey"])
    return picked.select(
        "o_orderkey", F.col("total.amount").alias("total"), F.col("tags")[0].alias("first_tag"), "absent"
    )


@query("""
select l_orderkey, """ + ", ".join(
    f"min(case when l_linenumber = {i + 1} then l_partkey end) part_{i}, "
    f"min(case when l_linenumber = {i + 1} then l_returnflag end) flag_{i}" for i in range(7)
) + """ from lineitem group by l_orderkey
""")
def q_items_to_columns(t):
    """One row per item to numbered columns, one row per key."""
    rows = t.lineitem.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("place"),
        F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"),
    )
    return n.items_to_columns(rows, ["l_orderkey"], "place", ["part", "flag"], 7)


@query("""
select 'lake' bucket, 'in/' || s_name || ' x.csv' as "key" from supplier where s_suppkey % 3 = 1
""")
def q_arrivals(t):
    """Object-created notifications to object rows; test and foreign events skipped."""
    key = F.concat(F.lit("in/"), F.replace("s_name", F.lit("#"), F.lit("%23")), F.lit("+x.csv"))
    event = F.struct(
        F.when(F.col("s_suppkey") % 3 == 1, "aws:s3").otherwise("aws:other").alias("eventSource"),
        F.struct(
            F.struct(F.lit("lake").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
        ).alias("s3"),
    )
    foreign = event.withField("eventSource", F.lit("aws:sns"))
    body = F.when(F.col("s_suppkey") % 3 == 0, F.lit('{"Event": "s3:TestEvent"}')).otherwise(
        F.to_json(F.struct(F.array(event, foreign).alias("Records")))
    )
    return n.arrivals(t.supplier.select(body.alias("body")), "body")


@query("""
select 'K-' || o_orderkey as "key", 'order ' || o_orderkey summary,
  case when o_orderkey % 3 <> 0 then o_orderstatus end resolution, o_orderpriority priority,
  'open' status, 'todo' status_catergory, '' defect_severity, '' development_bug,
  sha256('K-' || o_orderkey || chr(31) || strftime(o_orderdate, '%Y-%m-%d')) id
from orders
""")
def q_issue_rows(t):
    """Issue documents (JSON) to flat rows with null-safe paths and blank defaults."""
    resolution = F.when(F.col("o_orderkey") % 3 != 0, F.struct(F.col("o_orderstatus").alias("name")))
    fields = F.struct(
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("summary"),
        resolution.alias("resolution"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        F.struct(
            F.lit("open").alias("name"), F.struct(F.lit("todo").alias("name")).alias("statusCategory")
        ).alias("status"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"),
    )
    key = F.concat(F.lit("K-"), F.col("o_orderkey").cast("string"))
    docs = t.orders.select(F.to_json(F.struct(key.alias("key"), fields.alias("fields"))).alias("doc"))
    return n.issue_rows(docs, "doc").select(
        "id", "key", "summary", "resolution", "priority", "status", "status_catergory",
        "defect_severity", "development_bug",
    )


@query("""
select c_custkey "Id", c_name owner_name from customer
""")
def q_page_records(t):
    """Pages of records to flat rows, technical attributes dropped."""
    record = F.struct(
        F.struct(F.lit("T").alias("type"), F.lit("u").alias("url")).alias("attributes"),
        F.col("c_custkey").alias("Id"),
        F.struct(F.col("c_name").alias("name")).alias("owner"),
    )
    return n.page_records(t.customer.select(F.array(record).alias("records")), "records")


# ---------------------------------------------------------------- profiles

_TEXTS = """
select cast(o_orderkey as {s}) whole, cast(cast(o_orderkey as bigint) * 3000000000 as {s}) big,
  case when o_orderkey % 2 = 0 then cast(o_orderkey as {s}) else cast(o_orderkey as {s}) || '.5' end mixed,
  case when o_orderkey % 2 = 0 then 'true' else 'False' end flag,
  case when o_orderkey % 9 = 0 then 'None' else {d} end order_day,
  {ts} stamp, o_orderpriority word, case when o_orderkey % 2 = 0 then '' end hollow
from orders
"""


def _texts(t):
    t.orders.createOrReplaceTempView("orders")
    return t.spark.sql(
        _TEXTS.format(
            s="string", d="date_format(o_orderdate, 'yyyy-MM-dd')",
            ts="date_format(o_orderdate, 'yyyy-MM-dd') || 'T10:20:30'",
        )
    )


_TEXTS_ORACLE = _TEXTS.format(
    s="varchar", d="strftime(o_orderdate, '%Y-%m-%d')", ts="strftime(o_orderdate, '%Y-%m-%d') || 'T10:20:30'"
)


def _profile_sql() -> str:
    columns = ("whole", "big", "mixed", "flag", "order_day", "stamp", "word", "hollow")
    # (column, is integer text, float text, boolean text, date text, midnight date)
    parts = []
    for col in columns:
        text = f"case when {col} not in ('None', '') then {col} end"
        parts.append(
            f"select '{col}' column_name, count(*) n, count({text}) n_set, "
            f"count(*) filter (where regexp_full_match({text}, '-?[0-9]+')) n_int, "
            f"count(*) filter (where regexp_full_match({text}, '-?[0-9]+([.][0-9]+)?')) n_float, "
            f"count(*) filter (where lower({text}) in ('true', 'false')) n_bool from texts"
        )
    return f"with texts as ({_TEXTS_ORACLE}) " + " union all ".join(parts)


@query(_profile_sql())
def q_profile(t):
    """One-pass column profile of text columns."""
    return profile.profile(_texts(t), ("n", "n_set", "n_int", "n_float", "n_bool"))


@query(f"""
with texts as ({_TEXTS_ORACLE})
select 'whole' column_name, case when max(try_cast(whole as bigint)) <= 2147483647 and bool_and(try_cast(whole as bigint) is not null) then 'int' end kind from texts
union all select 'big', case when bool_and(try_cast(big as bigint) is not null) and max(try_cast(big as bigint)) > 2147483647 then 'bigint' end from texts
union all select 'mixed', case when bool_and(try_cast(mixed as double) is not null) then 'double' end from texts
union all select 'flag', case when bool_and(lower(flag) in ('true', 'false')) then 'boolean' end from texts
union all select 'order_day', case when bool_and(try_cast(nullif(order_day, 'None') as date) is not null or order_day = 'None') then 'date' end from texts
union all select 'stamp', case when bool_and(try_cast(stamp as timestamp) is not null) then 'timestamp' end from texts
union all select 'word', case when bool_or(try_cast(word as timestamp) is null) then 'string' end from texts
union all select 'hollow', case when bool_and(coalesce(hollow, '') = '') then 'string' end from texts
""")
def q_infer_schema(t):
    """Content-based column types; the one-row profile decides."""
    rows = _texts(t)
    found = profile.infer_schema(rows)
    # The inferred types as rows of the profiled table's own profile.
    kinds = profile.profile(rows).select("column_name")
    mapping = F.create_map(*[x for name, kind in found.items() for x in (F.lit(name), F.lit(kind))])
    return kinds.select("column_name", F.try_element_at(mapping, F.col("column_name")).alias("kind"))


@query(f"""
with texts as ({_TEXTS_ORACLE})
select cast(whole as integer) whole, cast(big as bigint) big, cast(mixed as double) mixed, lower(flag) = 'true' flag,
  strftime(try_cast(order_day as date), '%Y-%m-%d') order_day, cast(stamp as timestamp) stamp, word, hollow from texts
""")
def q_typed_by_inference(t):
    """Text columns cast to their inferred types in one projection."""
    rows = _texts(t)
    typed = c.conform(rows, profile.infer_schema(rows))
    return typed.withColumns(
        {"order_day": F.col("order_day").cast("string"), "stamp": F.col("stamp").cast("timestamp_ntz")}
    )


@query("""
with described(column_name, type, comment, catalog_comment) as (values
  ('event_id', 'float', 'This is the event id column.', 'This is the event id column.'),
  ('event_type', 'string', 'kind of event', 'kind of event'),
  ('value', 'float', 'This is the value column.', 'This is the value column.'),
  ('is_late', 'boolean', 'This is the is late column.', 'This is the is late column.'),
  ('timestamp_extracted', 'timestamp', 'This is the timestamp extracted column.', 'This is the timestamp extracted column.'))
select event_id, column_name, type, comment, catalog_comment from events, described
""")
def q_describe_schema(t):
    """Types and comments of a generated catalog entry, and the comments that a written table carries."""
    rows = t.events.select(
        "event_id", "event_type", "value", (F.col("value") > 5).alias("is_late"), F.col("ts").cast("string").alias("timestamp_extracted")
    )
    types, comments = sc.describe_schema(rows, {"event_type": "kind of event"})
    path = work_path(t.spark, "described")
    write_table(rows, path, comments=comments)
    written = read_table(t.spark, path)
    entry = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.lit(types[f.name]).alias("type"), F.lit(comments[f.name]).alias("comment"),
            F.lit(f.metadata.get("comment")).alias("catalog_comment"),
        )
        for f in written.schema
    ]
    return written.select("event_id", F.inline(F.array(*entry)))


@query("""
select s_suppkey, strftime(d, '%Y-%m-%d') as "date" from supplier,
  (select unnest(generate_series(date '2024-02-27', date '2024-03-02', interval 1 day)) d)
""")
def q_date_span(t):
    """Suppliers with every day of a span given as text."""
    first, last = date_span("20240227", "20240302", dt.date(2024, 5, 5))
    rows = work_list(t.supplier.select("s_suppkey"), first, last)
    return rows.select("s_suppkey", F.col("date").cast("string").alias("date"))


@query("""
select o_orderkey, 'date' as day_text, 'string' as mixed_text, 'timestamp' as native_time, 'bigint' as native_number from orders
""")
def q_date_columns(t):
    """Text columns whose values are all dates, by the dates rule; the others by their types."""
    rows = t.orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day_text"),
        F.when(F.col("o_orderkey") % 1000 == 7, "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("mixed_text"),
        F.col("o_orderdate").alias("native_time"), F.col("o_custkey").alias("native_number"),
    )
    found = infer_schema(rows, "dates")
    return rows.select("o_orderkey", *[F.lit(found[c]).alias(c) for c in rows.columns[1:]])
