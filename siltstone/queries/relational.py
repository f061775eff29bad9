"""Joins, differences, unions, merges and sums."""

import datetime as dt

from pyspark.sql import functions as F

from siltstone.operators import aggregates, joins, profile, sets
from siltstone.operators.joins import skew_join
from siltstone.operators.keys import latest_per_key
from siltstone.queries.registry import query


@query("""
select o_orderkey, o_totalprice, c_name, n_name from orders
left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey
""")
def q_lookup(t):
    """Orders enriched with customer and nation."""
    people = t.customer.select("c_custkey", "c_name", "c_nationkey")
    rows = joins.lookup(t.orders, people, {"o_custkey": "c_custkey"})
    named = joins.lookup(rows, t.nation.select("n_nationkey", "n_name"), {"c_nationkey": "n_nationkey"})
    return named.select("o_orderkey", "o_totalprice", "c_name", "n_name")


@query("""
select l_orderkey, l_linenumber, l_shipdate, o_orderdate, o_orderstatus
from lineitem join orders on l_orderkey = o_orderkey where l_shipdate >= o_orderdate
""")
def q_join_detail(t):
    """Line items joined to their order with a residual condition."""
    orders = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    rows = joins.lookup(lines, orders, {"l_orderkey": "o_orderkey"}, "inner")
    return rows.where(F.col("l_shipdate") >= F.col("o_orderdate"))


@query("""
select l.l_suppkey, l.l_partkey, n, total from
 (select l_suppkey, l_partkey, count(*) n from lineitem group by all) l
left join (select l_suppkey, l_partkey, cast(sum(cast(l_quantity as decimal(20,2))) as double) total
  from lineitem where l_returnflag = 'R' group by all) r
on l.l_suppkey = r.l_suppkey and l.l_partkey = r.l_partkey
""")
def q_two_key_join(t):
    """Left join on two columns between two grouped tables."""
    keys = ["l_suppkey", "l_partkey"]
    lines = t.lineitem.groupBy(*keys).agg(F.count("*").alias("n"))
    returned = aggregates.filtered_sums(
        t.lineitem, keys, F.col("l_quantity"), {"total": F.lit(True)}, F.col("l_returnflag") == "R"
    )
    return lines.join(returned, keys, "left")


@query("""
select * from customer where not exists (select 1 from events where user_id = c_custkey)
""")
def q_new_keys(t):
    """Customers without events."""
    return joins.anti(t.customer, t.events.withColumnRenamed("user_id", "c_custkey"), ["c_custkey"])


@query("""
select * from customer where exists
 (select 1 from orders where o_custkey = c_custkey and o_totalprice > 400000)
""")
def q_semi(t):
    """Customers with a large order."""
    large = t.orders.where(F.col("o_totalprice") > 400000).withColumnRenamed("o_custkey", "c_custkey")
    return joins.semi(t.customer, large, ["c_custkey"])


@query("""
select c_custkey, case when exists (select 1 from orders where o_custkey = c_custkey
  and o_orderpriority = '1-URGENT') then 'Y' else ' ' end urgent from customer
""")
def q_matched_flag(t):
    """Y for customers with an urgent order, else blank."""
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT")
    urgent = urgent.withColumnRenamed("o_custkey", "c_custkey")
    return joins.matched_flag(t.customer.select("c_custkey"), urgent, ["c_custkey"], "urgent")


@query("""
select c_custkey, o_orderkey from customer left join orders on o_custkey = c_custkey
""")
def q_one_to_many(t):
    """Customers with all their orders, customers without any kept."""
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    return joins.one_to_many(t.customer.select("c_custkey"), orders, ["c_custkey"])


@query("""
select c_custkey, strftime(d, '%Y%m%d') as "date" from customer
cross join (select unnest(generate_series(date '2024-01-30', date '2024-02-02', interval 1 day)) d)
""")
def q_work_list(t):
    """Every customer for every day of a span."""
    days = joins.work_list(t.customer.select("c_custkey"), dt.date(2024, 1, 30), dt.date(2024, 2, 2))
    return days.withColumn("date", F.date_format("date", "yyyyMMdd"))


@query("""
select strftime(ts, '%Y%m%d') as "day",
  min(case when event_type = 'click' then value end) click,
  min(case when event_type = 'view' then value end) "view",
  min(case when event_type = 'purchase' then value end) purchase
from events group by 1
""")
def q_pivot_pairs(t):
    """One column per event type, one row per day."""
    rows = t.events.select(F.date_format("ts", "yyyyMMdd").alias("day"), "event_type", "value")
    return joins.pairs_to_columns(rows, ["day"], "event_type", "value", ["click", "view", "purchase"])


def _days(t):
    day = F.to_date("ts")
    ids = t.events.select("user_id", day.alias("d"))
    return ids.where(F.col("d") == dt.date(2024, 1, 15)), ids.where(F.col("d") == dt.date(2024, 1, 14))


@query("""
with a as (select distinct user_id from events where ts >= date '2024-01-15' and ts < date '2024-01-16'),
     b as (select distinct user_id from events where ts >= date '2024-01-14' and ts < date '2024-01-15')
select coalesce(a.user_id, b.user_id) user_id,
  case when b.user_id is null then 'Only in Today' else 'Only in Yesterday' end difference_type
from a full join b on a.user_id = b.user_id where a.user_id is null or b.user_id is null
""")
def q_id_diff_labelled(t):
    """Users active on one of two days only, with the side."""
    return sets.id_diff(*_days(t), "user_id")


@query("""
with a as (select user_id from events where cast(ts as date) = date '2024-01-15'),
     b as (select user_id from events where cast(ts as date) = date '2024-01-14')
(select * from a except select * from b) union all (select * from b except select * from a)
""")
def q_id_symdiff(t):
    """The same users without the label."""
    return sets.id_diff(*_days(t), "user_id", labelled=False)


@query("""
select o_custkey k from orders except select user_id from events
""")
def q_sorted_new(t):
    """Work list: distinct keys not handled yet, sorted."""
    fresh = sets.new_items(
        t.orders.select(F.col("o_custkey").alias("k")),
        t.events.select(F.col("user_id").alias("k")),
        "k",
    )
    return fresh.distinct().orderBy("k")


@query("""
select o_custkey k from orders union select c_custkey from customer
""")
def q_mark_seen(t):
    """Manifest after a run."""
    return sets.mark_seen(
        t.orders.select(F.col("o_custkey").alias("k")),
        t.customer.select(F.col("c_custkey").alias("k")),
        "k",
    )


@query("""
select c_name as name, c_acctbal acctbal, c_mktsegment segment, null::bigint suppkey from customer
union all select s_name, s_acctbal, null, s_suppkey from supplier
""")
def q_union_evolve(t):
    """Union of tables with different columns."""
    people = t.customer.selectExpr("c_name name", "c_acctbal acctbal", "c_mktsegment segment")
    firms = t.supplier.selectExpr("s_name name", "s_acctbal acctbal", "s_suppkey suppkey")
    return sets.union_evolve(people, firms)


@query("""
select c_nationkey nation from customer union select s_nationkey from supplier
""")
def q_union_distinct(t):
    """Set union."""
    return sets.union_distinct(
        t.customer.selectExpr("c_nationkey nation"), t.supplier.selectExpr("s_nationkey nation")
    )


@query("""
select l_suppkey, l_returnflag,
  sum(case when l_linestatus = 'O' then l_quantity * 0.125 end) open_amount,
  sum(case when l_linestatus = 'F' and l_tax > 0.02 then l_quantity * 0.125 end) taxed_amount, cast(0 as bigint) unreadable
from lineitem where l_quantity > 5 group by l_suppkey, l_returnflag
""")
def q_channel_sums(t):
    """Two differently filtered sums of amounts with three decimals in one pass."""
    return aggregates.filtered_sums(
        t.lineitem,
        ["l_suppkey", "l_returnflag"],
        F.col("l_quantity") * 0.125,
        {
            "open_amount": F.col("l_linestatus") == "O",
            "taxed_amount": (F.col("l_linestatus") == "F") & (F.col("l_tax") > 0.02),
        },
        where=F.col("l_quantity") > 5,
        unreadable="unreadable",
    )


@query("""
select strftime(ts, '%Y%m%d') as "day", count(*) filter (where event_type <> 'error') processed,
  count(*) filter (where event_type = 'error') failed,
  count(*) filter (where event_type <> 'error') records,
  case when count(*) filter (where event_type = 'error') = 0 then 'completed' else 'partial' end status
from events group by 1
""")
def q_summary(t):
    """Processed and failed counts per day with a status."""
    rows = t.events.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    return profile.run_summary(rows, ["day"], F.col("event_type") != "error")


@query("""
select cast(sum(p) as bigint) processed, cast(sum(f) as bigint) failed, cast(sum(p) as bigint) records,
  case when max(f) > 0 then 'partial' else 'completed' end status
from (select user_id, count(*) filter (where event_type <> 'error') p,
      count(*) filter (where event_type = 'error') f from events group by 1)
""")
def q_overall_status(t):
    """One-row status over all units."""
    return profile.overall_status(
        profile.run_summary(t.events, ["user_id"], F.col("event_type") != "error")
    )


@query("""
select cast(sum(length(o_orderpriority) + length(o_orderstatus)) as bigint) n_bytes, count(*) n_rows from orders
""")
def q_size_estimate(t):
    """Text size of two columns."""
    return profile.size_estimate(t.orders, ["o_orderpriority", "o_orderstatus"])


_CUT = "timestamp '2024-01-20 00:00:00'"


@query(f"""
with s as (select user_id, event_type status, ts, event_id,
       row_number() over (partition by user_id order by ts desc nulls last, event_id) rn_all from events),
now_ as (select user_id, status from s where rn_all = 1),
prev as (select user_id, event_type status, 'N' done from (
   select user_id, event_type, row_number() over (partition by user_id order by ts desc nulls last, event_id) rn
   from events where ts < {_CUT} and user_id % 4 <> 0) where rn = 1)
select coalesce(p.user_id, n.user_id) user_id,
  coalesce(p.status, n.status) original,
  case when p.user_id is null then '' when n.status = 'purchase' then 'APPROVED' else n.status end latest,
  case when p.user_id is null then '' when p.status is distinct from n.status then 'Y' else 'N' end moved,
  case when p.user_id is null then 'N' when n.status = 'purchase' then 'Y' else p.done end done
from prev p full join now_ n on p.user_id = n.user_id
where p.user_id is not null or n.status not in ('purchase')
""")
def q_snapshot_merge(t):
    """Yesterday's state per user brought up to date; new users join unless finished."""
    rows = t.events.select("user_id", F.col("event_type").alias("status"), "ts", "event_id")

    def state(df):
        return latest_per_key(df, ["user_id"], "ts", ["event_id"]).select("user_id", "status")

    cut = dt.datetime(2024, 1, 20)
    before = rows.where((F.col("ts") < cut) & (F.col("user_id") % 4 != 0))
    prev = state(before).withColumn("done", F.lit("N"))

    def carried(old, new):
        finished = new("status") == "purchase"
        return [
            old("user_id").alias("user_id"),
            old("status").alias("original"),
            F.when(finished, "APPROVED").otherwise(new("status")).alias("latest"),
            F.when(~old("status").eqNullSafe(new("status")), "Y").otherwise("N").alias("moved"),
            F.when(finished, "Y").otherwise(old("done")).alias("done"),
        ]

    def fresh(new):
        return [
            new("user_id").alias("user_id"),
            new("status").alias("original"),
            F.lit("").alias("latest"),
            F.lit("").alias("moved"),
            F.lit("N").alias("done"),
        ]

    return sets.snapshot_merge(
        prev, state(rows), "user_id", carried, fresh, lambda new: new("status") != "purchase"
    )


@query("""
select l_orderkey, l_linenumber, l_quantity, o_custkey from lineitem
left join orders on l_orderkey = o_orderkey
""")
def q_skew_join(t):
    """Line items with their customer; two orders are treated as hot."""
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return skew_join(lines, orders, ["l_orderkey"], hot=[(1,), (7,)])
