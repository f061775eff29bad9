"""Per-key selection, deduplication, numbering."""

import datetime as dt

from pyspark.sql import functions as F

from siltstone.operators import keys as k
from siltstone.queries.registry import query


@query("""
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc nulls last, event_id) rn
  from events) where rn = 1
""")
def q_latest_event(t):
    """Newest event per user."""
    return k.latest_per_key(t.events, ["user_id"], "ts", ["event_id"])


@query("""
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts nulls last, event_id) rn
  from events) where rn = 1
""")
def q_first_event(t):
    """Oldest event per user."""
    return k.first_per_key(t.events, ["user_id"], "ts", ["event_id"])


@query("""
select * exclude (rn) from (
  select user_id, event_type, ts, event_id,
         row_number() over (partition by user_id, event_type order by ts nulls last, event_id) rn
  from events) where rn = 1
""")
def q_first_per_state(t):
    """When a user first entered each state."""
    rows = t.events.select("user_id", "event_type", "ts", "event_id")
    return k.first_per_key(rows, ["user_id", "event_type"], "ts", ["event_id"])


@query("""
select o.* from orders o
join (select o_custkey, max(o_orderdate) d from orders group by o_custkey) m
  on o.o_custkey = m.o_custkey and o.o_orderdate = m.d
""")
def q_latest_with_ties(t):
    """All orders of a customer's last order day."""
    return k.latest_with_ties(t.orders, ["o_custkey"], "o_orderdate")


@query("""
select e.event_id, e.user_id, e.ts, m.first_seen from events e
join (select user_id, min(ts) first_seen from events group by user_id) m using (user_id)
""")
def q_first_seen(t):
    """Events with the first time their user was seen."""
    return k.first_seen(t.events.select("event_id", "user_id", "ts"), ["user_id"], "ts")


@query("""
select event_id, e.user_id, ts, first_seen from events e
join (select user_id, min(ts) first_seen from events group by user_id
      having min(ts) >= timestamp '2024-01-01 06:00:00') m on e.user_id = m.user_id
""")
def q_joined_since(t):
    """Events of users first seen from a given time on."""
    rows = t.events.select("event_id", "user_id", "ts")
    return k.first_seen(rows, ["user_id"], "ts", since=dt.datetime(2024, 1, 1, 6))


@query("""
select l_orderkey, l_linenumber, max(l_shipdate) l_shipdate
from lineitem group by l_orderkey, l_linenumber
""")
def q_exact_dedup_newest(t):
    """One row per (order, line), newest ship date."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    return k.dedup_newest(rows, "l_shipdate")


@query("""
select text, lang, max(doc_id) doc_id from documents group by text, lang
""")
def q_dedup_documents(t):
    """One row per distinct text and language, newest id; copies meet whole texts."""
    return k.dedup_newest(t.documents.select("text", "lang", "doc_id"), "doc_id")


@query("""
select c_custkey, c_name, row_number() over (order by c_name) id from customer
""")
def q_surrogate_id(t):
    """Dense ids in name order, numbered in value-based buckets."""
    rows = t.customer.select("c_custkey", "c_name")
    return k.surrogate_id(rows, ["c_name"], rows_per_bucket=200)


@query("""
select o_orderkey, o_orderpriority,
       row_number() over (order by o_orderpriority nulls last, o_orderkey) id
from (select o_orderkey, nullif(o_orderpriority, '5-LOW') o_orderpriority from orders)
""")
def q_surrogate_id_hot(t):
    """Dense ids where the leading key has few values and nulls; the tie-break splits them."""
    rows = t.orders.select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority")
    )
    return k.surrogate_id(rows, ["o_orderpriority", "o_orderkey"], rows_per_bucket=1000)


@query("""
select user_key, ts, event_id from (
  select coalesce(a, b, c) user_key, ts, event_id,
         row_number() over (partition by coalesce(a, b, c) order by ts desc nulls last, event_id) rn
  from (select case when event_id % 3 = 0 then user_id end a,
               case when event_id % 3 = 1 then user_id end b,
               case when event_id % 3 = 2 then user_id end c, ts, event_id from events))
where rn = 1
""")
def q_coalesced_key(t):
    """Newest event per user whose id sits in one of three columns."""
    part = F.col("event_id") % 3
    rows = t.events.select(
        *[F.when(part == i, F.col("user_id")).alias(c) for i, c in enumerate("abc")],
        "ts", "event_id",
    )
    keyed = rows.select(F.coalesce("a", "b", "c").alias("user_key"), "ts", "event_id")
    return k.latest_per_key(keyed, ["user_key"], "ts", ["event_id"])


@query("select distinct l_orderkey, l_partkey from lineitem")
def q_distinct_pairs(t):
    """Distinct (order, part) pairs."""
    return k.dedup(t.lineitem, ["l_orderkey", "l_partkey"])


@query("""
select user_id, event_type, ts from events group by user_id, event_type, ts
""")
def q_distinct_rows(t):
    """Full-row duplicates removed."""
    return k.dedup(t.events.select("user_id", "event_type", "ts"))


@query("""
select o_custkey, min(o_orderdate) first_order, max(o_orderdate) last_order
from orders group by o_custkey
""")
def q_min_max(t):
    """First and last order per customer."""
    return t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
