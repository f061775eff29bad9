"""Stored states: large files read in ranges, states, digests, snapshots and file lists kept between runs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from siltstone.operators import id_digests, latest_state, nested, stored_profile
from siltstone.operators.keys import dedup
from siltstone.queries.registry import query
from siltstone.session import work_path
from siltstone.sources import compaction, evolution, readers, snapshots, split_scan, writers
from siltstone.streaming import arrivals, dead_letters


# A delivered file holds about so many records, or bytes of text: more than a task's range, and never a whole large table.
_FILE_ROWS = 2_000_000
_FILE_BYTES = 256 << 20


@query("select o_orderkey, o_orderstatus, o_totalprice, '{\"' || o_orderpriority || '\"},\n[' as note from orders")
def q_json_array_ranges(t):
    """All orders in large JSON array files, read by sixteen tasks or more; quotes, braces and line breaks stand in their texts."""
    path = work_path(t.spark, "orders-array")
    note = F.concat(F.lit('{"'), "o_orderpriority", F.lit('"},\n['))
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", note.alias("note"))
    files = max(1, -(-rows.count() // _FILE_ROWS))
    # A file's lines are streamed by one task: the bracket, the objects, the end.
    number = F.pmod(F.xxhash64("o_orderkey"), F.lit(files)).alias("file")
    lines = rows.select(number, F.lit(1).alias("part"), F.concat(F.to_json(F.struct(*rows.columns)), F.lit(",")).alias("value"))
    border = [F.struct(F.lit(at).alias("part"), F.lit(v).alias("value")) for at, v in ((0, "["), (2, '{"o_orderkey": null, "note": "end"}]'))]
    ends = t.spark.range(files).select(F.col("id").alias("file"), F.inline(F.array(*border)))
    dealt = lines.unionByName(ends).repartition("file").sortWithinPartitions("file", "part")
    dealt.select("file", "value").write.partitionBy("file").text(path)
    read = split_scan.read_json_array(t.spark, path, rows.schema, min_tasks=16)
    return read.where("o_orderkey is not null").select(*rows.columns)


@query("select doc_id, text, lang from documents where text is not null and text <> ''")
def q_csv_ranges(t):
    """Whole texts in large CSV files, line breaks in quotes, read by sixteen tasks or more."""
    path = work_path(t.spark, "documents-csv")
    rows = t.documents.select("doc_id", "text", "lang").where("text is not null and text <> ''")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(1, -(-size // _FILE_BYTES))
    rows.repartition(files, "doc_id").write.options(header="true", quoteAll="true", escape='"').csv(path)
    read = split_scan.read_csv(t.spark, path, rows.schema, min_tasks=16, options={"escape": '"'})
    return read.select(*rows.columns)


def _landed_events(t) -> tuple[str, list[str]]:
    """The events as a log partitioned by day, and its days: a month has some thirty."""
    path = work_path(t.spark, "event-log")
    writers.write_table(t.events.withColumn("day", F.date_format("ts", "yyyy-MM-dd")), path, partition_by=["day"], balanced=True)
    return path, sorted(r[0] for r in dedup(t.spark.read.parquet(path), ["day"]).collect())


@query("""
select * exclude (rn) from (
  select *, row_number() over (partition by user_id order by ts desc nulls last, event_id) rn
  from events) where rn = 1
""")
def q_latest_by_deltas(t):
    """Newest event per user, as a state that three parts of the log bring up to date; the second one comes twice."""
    path, days = _landed_events(t)
    root = work_path(t.spark, "latest-state")
    third = -(-len(days) // 3)
    for i in (0, 1, 1, 2):
        part = days[i * third : (i + 1) * third]
        delta = t.spark.read.parquet(path).where(F.col("day").isin(part)).drop("day")
        latest_state.advance(delta, root, f"part-{i}", ["user_id"], "ts", ["event_id"], buckets=8)
    return latest_state.state(t.spark, root)


@query("""
with a as (select distinct user_id, ts::date d from events where event_type = 'purchase'),
last as (select max(d) d from a),
now as (select distinct user_id from a where d > (select d - 3 from last)),
prev as (select distinct user_id from a where d > (select d - 4 from last) and d <= (select d - 1 from last))
select user_id, 'Only in Today' difference_type from now where user_id not in (select user_id from prev)
union all select user_id, 'Only in Yesterday' from prev where user_id not in (select user_id from now)
""")
def q_id_diff_by_digests(t):
    """Users of the last three days against those of the three days that ended a day before, by bucket digests."""
    active = t.events.where("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("d"))
    last = active.agg(F.max("d")).first()[0]
    root = work_path(t.spark, "ids")
    for day, back in (("today", 0), ("yesterday", 1)):
        end = F.date_sub(F.lit(last), back)
        id_digests.write_ids(active.where((F.col("d") <= end) & (F.col("d") > F.date_sub(F.lit(last), back + 3))), "user_id", root, day)
    return id_digests.changed_ids(t.spark, root, "user_id", "today", "yesterday")


@query("""
with prev as (select o_custkey, count(*) n, max(o_orderdate) seen from orders where o_orderdate < '1998-01-01' group by 1),
now as (select o_custkey, count(*) n, max(o_orderdate) seen from orders where o_orderdate >= '1998-01-01' group by 1)
select coalesce(p.o_custkey, t.o_custkey) o_custkey, coalesce(p.n, 0) + coalesce(t.n, 0) n,
  coalesce(t.seen, p.seen) seen, case when p.o_custkey is null then 'new' when t.o_custkey is null then 'kept' else 'moved' end state
from prev p full join now t on p.o_custkey = t.o_custkey where p.o_custkey is not null or t.n > 1
""")
def q_bucketed_merge(t):
    """Order counts per customer as a bucketed snapshot, merged with the later orders and stored as the next one."""
    name = f"snapshot_{uuid.uuid4().hex}"

    def counted(rows):
        return rows.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("seen"))

    start = F.lit("1998-01-01").cast("timestamp_ntz")
    before, later = t.orders.where(F.col("o_orderdate") < start), t.orders.where(F.col("o_orderdate") >= start)
    first = counted(before).withColumn("state", F.lit("old"))
    snapshots.write_snapshot(first, f"{name}_1", work_path(t.spark, "snapshot-1"), "o_custkey")

    def carried(old, new):
        state = F.when(new("o_custkey").isNull(), "kept").otherwise("moved")
        return [
            old("o_custkey").alias("o_custkey"),
            (old("n") + F.coalesce(new("n"), F.lit(0))).alias("n"),
            F.coalesce(new("seen"), old("seen")).alias("seen"),
            state.alias("state"),
        ]

    def fresh(new):
        return [new("o_custkey").alias("o_custkey"), new("n").alias("n"), new("seen").alias("seen"), F.lit("new").alias("state")]

    merged = snapshots.merge_into_next(f"{name}_1", counted(later), "o_custkey", carried, fresh, lambda new: new("n") > 1)
    snapshots.write_snapshot(merged, f"{name}_2", work_path(t.spark, "snapshot-2"), "o_custkey")
    return t.spark.table(f"{name}_2")


@query("select event_id, user_id, event_type, value from events")
def q_compact_small_files(t):
    """Events in many small files, compacted twice by type; the manifest's files hold the same rows."""
    root = work_path(t.spark, "events-by-type")
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    for part in range(4):
        writers.write_table(rows.where(F.col("event_id") % 4 == part), root, partition_by=["event_type"], max_rows=2_000)
    compaction.register(t.spark, root)
    compaction.compact_small_files(t.spark, root, "first", ["event_type"], target_mb=1)
    compaction.compact_small_files(t.spark, root, "second", ["event_type"], target_mb=1)
    return compaction.read_live(t.spark, root).select(*rows.columns)


_PROFILED = ("o_orderkey", "o_orderstatus", "o_totalprice", "note")


def _stored_profile_sql() -> str:
    notes = "case when o_orderkey % 3 = 0 then '12' when o_orderkey % 3 = 1 then 'None' else '7.5' end"
    parts = []
    for c in _PROFILED:
        text = f"case when {c}::varchar not in ('None', '') then {c}::varchar end"
        parts.append(
            f"select '{c}' column_name, count(*) n, count({text}) n_set, "
            f"count(*) filter (where regexp_full_match({text}, '-?[0-9]+')) n_int, "
            f"count(*) filter (where regexp_full_match({text}, '-?[0-9]+([.][0-9]+)?')) n_float, "
            f"min(try_cast({text} as bigint)) filter (where regexp_full_match({text}, '-?[0-9]+')) min_int from noted"
        )
    return f"with noted as (select *, {notes} note from orders) " + " union all ".join(parts)


@query(_stored_profile_sql())
def q_stored_profile(t):
    """Profiles of the orders' files, three deliveries of them, merged; each run reads its new files only."""
    landed, root = work_path(t.spark, "orders-landed"), work_path(t.spark, "orders-profile")
    rest = F.col("o_orderkey") % 3
    note = F.when(rest == 0, "12").when(rest == 1, "None").otherwise("7.5")
    rows = t.orders.withColumn("note", note).select(*_PROFILED)
    for part in range(3):
        rows.where(rest == part).write.mode("append").parquet(landed)
        stored_profile.profile_new_files(t.spark, landed, root, f"delivery-{part}", glob="*.parquet")
    return stored_profile.merged_profile(t.spark, root).select("column_name", "n", "n_set", "n_int", "n_float", "min_int")


@query("""
select case when o_orderkey % 3 = 2 then 'K' || o_orderkey else o_orderkey::varchar end o_orderkey,
  case when o_orderkey % 3 = 0 then o_custkey::double else o_totalprice end amount,
  case when o_orderkey % 3 > 0 then o_orderstatus end o_orderstatus,
  case when o_orderkey % 3 = 2 then o_orderdate::date else date '1970-01-01' end as day from orders
""")
def q_schema_versions(t):
    """Three versions of one table: whole numbers of 32 bits, of 64 bits, then text; a column comes, one widens."""
    root = work_path(t.spark, "orders-versions")
    part = F.col("o_orderkey") % 3
    start = F.lit("1970-01-01").cast("date").alias("day")
    number, money = F.col("o_orderkey"), F.col("o_totalprice").alias("amount")
    evolution.append(t.orders.where(part == 0).select(number.cast("int").alias("o_orderkey"), F.col("o_custkey").cast("int").alias("amount"), start), root, "a")
    evolution.append(t.orders.where(part == 1).select(number, money, "o_orderstatus", start), root, "b")
    late = t.orders.where(part == 2).select(F.concat(F.lit("K"), "o_orderkey").alias("o_orderkey"), money, "o_orderstatus", F.to_date("o_orderdate").alias("day"))
    evolution.append(late, root, "c")
    evolution.append(late, root, "c")  # a repeated batch
    return evolution.read_evolved(t.spark, root).select("o_orderkey", "amount", "o_orderstatus", "day")


@query("""
select event_id, (props::json ->> 'k')::bigint document_k,
  case when event_id % 3 = 0 then user_id::varchar when event_id % 3 = 1 then event_type else '{"t":"' || event_type || '"}' end document_who,
  case when event_id % 2 = 0 then user_id end document_list_0_id, case when event_id % 2 = 0 then user_id + 1 end document_list_1_id,
  case when event_id % 4 = 0 then event_type end "document_odd name" from events
""")
def q_flatten_unknown(t):
    """Documents of undeclared shape, a field's type changing by row, to columns."""
    key = F.get_json_object("props", "$.k")
    who = (
        F.when(F.col("event_id") % 3 == 0, F.col("user_id").cast("string"))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit('"'), "event_type", F.lit('"')))
        .otherwise(F.concat(F.lit('{"t": "'), "event_type", F.lit('"}')))
    )
    items = F.concat(F.lit(', "list": [{"id": '), "user_id", F.lit('}, {"id": '), F.col("user_id") + 1, F.lit("}]"))
    odd = F.concat(F.lit(', "odd name": "'), "event_type", F.lit('"'))
    text = F.concat(
        F.lit('{"k": '), key, F.lit(', "who": '), who,
        F.when(F.col("event_id") % 2 == 0, items).otherwise(""), F.when(F.col("event_id") % 4 == 0, odd).otherwise(""), F.lit("}"),
    )
    return nested.flatten_json(t.events.select("event_id", text.alias("document")), "document")


@query("""
select s_suppkey, 'read' outcome from supplier where s_suppkey % 5 <> 2 union all select null, 'dead, 2 attempts'
""")
def q_dead_letters(t):
    """Gzip files of suppliers arrive, one of them cut short: the others are read, it is named after two attempts."""
    landing, table, ledger = (work_path(t.spark, n) for n in ("landing", "suppliers", "ledger"))
    rows = t.supplier.select("s_suppkey", "s_name", F.pmod("s_suppkey", F.lit(5)).alias("part"))
    rows.repartition("part").write.partitionBy("part").option("compression", "gzip").json(landing)
    hadoop = t.spark._jvm.org.apache.hadoop
    fs = hadoop.fs.Path(landing).getFileSystem(t.spark._jsc.hadoopConfiguration())
    whole = [f.getPath() for f in fs.listStatus(hadoop.fs.Path(f"{landing}/part=2")) if f.getPath().getName().endswith(".gz")]
    content = t.spark.read.format("binaryFile").load(whole[0].toString()).first()["content"]
    out = fs.create(whole[0], True)
    out.write(content[: len(content) // 2])
    out.close()
    stream = dead_letters.path_stream(t.spark, f"{landing}/part=*", "*.json.gz")
    sink = arrivals.batch_writer(table, quarantine=f"{table}-bad")
    arrivals.run_available(stream, dead_letters.sifting(sink, ledger, rows.drop("part").schema, attempts=2), work_path(t.spark, "checkpoint"))
    read = readers.read_table(t.spark, table).select("s_suppkey", F.lit("read").alias("outcome"))
    dead = dead_letters.dead_letters(t.spark, ledger, 2)
    named = dead.where(F.col("file").contains("part=2")).select(
        F.lit(None).cast("bigint").alias("s_suppkey"), F.concat(F.lit("dead, "), "attempts", F.lit(" attempts")).alias("outcome")
    )
    return read.unionByName(named)


@query("select 'lake' bucket, 'in/' || s_name || ' x.csv' as \"key\" from supplier where s_suppkey % 2 = 1")
def q_stream_envelope(t):
    """Notifications arrive as a stream of JSON lines and are unwrapped in it; foreign and test events drop out."""
    key = F.concat(F.lit("in/"), F.replace("s_name", F.lit("#"), F.lit("%23")), F.lit("+x.csv"))
    event = F.struct(
        F.lit("aws:s3").alias("eventSource"),
        F.struct(F.struct(F.lit("lake").alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")).alias("s3"),
    )
    foreign = event.withField("eventSource", F.lit("aws:sns"))
    body = F.when(F.col("s_suppkey") % 2 == 0, F.lit('{"Event": "s3:TestEvent"}')).otherwise(F.to_json(F.struct(F.array(foreign, event).alias("Records"))))
    landing, table = work_path(t.spark, "notices"), work_path(t.spark, "objects")
    t.supplier.select(body.alias("body")).write.option("compression", "gzip").json(landing)
    checkpoint = work_path(t.spark, "checkpoint")
    for _ in range(2):
        stream = nested.arrivals(arrivals.file_stream(t.spark, landing, "body string"), "body")
        arrivals.run_available(stream, arrivals.batch_writer(table), checkpoint)
    return readers.read_table(t.spark, table).select("bucket", "key")
