"""Sources, sinks and streams: written to the shared folder and read back."""

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from siltstone.operators.sets import mark_seen, new_items
from siltstone.plans.ingest import compact_balances
from siltstone.queries.registry import query
from siltstone.session import work_path
from siltstone.sources import readers, writers
from siltstone.streaming import arrivals


@query("select n_name, r_name from nation join region on n_regionkey = r_regionkey")
def q_sql_source(t):
    """SQL text over tables."""
    text = "select n_name, r_name from {nation} join {region} on n_regionkey = r_regionkey"
    return readers.read_sql(t.spark, text, {"nation": t.nation, "region": t.region})


@query("""
select o_orderkey, case when o_orderstatus = 'P' then 0.0 else o_totalprice end o_totalprice, o_orderstatus from orders
""")
def q_partition_overwrite(t):
    """A partitioned table of which one partition is replaced."""
    path = work_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    writers.write_table(rows, path, mode="overwrite", partition_by=["o_orderstatus"])
    fixed = rows.where(F.col("o_orderstatus") == "P").withColumn("o_totalprice", F.lit(0.0))
    writers.write_table(fixed, path, mode="overwrite_partitions", partition_by=["o_orderstatus"])
    return readers.read_table(t.spark, path)


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def q_partition_scan(t):
    """One partition of a written table, pruned."""
    path = work_path(t.spark, "orders")
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("date"))
    writers.write_table(rows, path, partition_by=["date"])
    return readers.read_partition(t.spark, path, "F").drop("date")


@query("select doc_id, text, lang from documents")
def q_csv_roundtrip(t):
    """Whole texts through CSV and back."""
    path = work_path(t.spark, "documents-csv")
    rows = t.documents.select("doc_id", "text", "lang")
    writers.write_table(rows, path, "csv")
    return readers.read_table(t.spark, path, "csv", rows.schema, multiLine="true")


@query("select doc_id, text, lang from documents")
def q_json_gz_roundtrip(t):
    """Whole texts through gzip JSON lines and back."""
    path = work_path(t.spark, "documents-json")
    rows = t.documents.select("doc_id", "text", "lang")
    rows.write.option("compression", "gzip").json(path)
    return readers.read_table(t.spark, path, "json.gz", rows.schema)


@query("select event_id, strftime(ts, '%Y-%m-%d') \"day\", case when user_id % 3 <> 0 then props end props from events")
def q_json_sink(t):
    """The JSON lines sink: dates as text, nulls kept as fields."""
    path = work_path(t.spark, "events-json")
    props = F.when(F.col("user_id") % 3 != 0, F.col("props"))
    writers.write_table(t.events.select("event_id", F.to_date("ts").alias("day"), props.alias("props")), path, "json")
    return readers.read_table(t.spark, path, "json", "event_id bigint, day string, props string")


@query("select s_suppkey, s_name, 'written' side from supplier union all select s_suppkey, s_name, 'kept' from supplier")
def q_fallback_sink(t):
    """Rows reach the table, or the fallback when the table cannot be written."""
    rows = t.supplier.select("s_suppkey", "s_name")
    path, kept = work_path(t.spark, "table"), work_path(t.spark, "fallback")
    writers.write_with_fallback(rows, path, kept)
    try:  # the folder exists, so this write is refused
        writers.write_with_fallback(rows, path, kept, mode="errorifexists")
    except AnalysisException:
        pass
    first = readers.read_table(t.spark, path).withColumn("side", F.lit("written"))
    second = readers.read_table(t.spark, kept, "json", rows.schema).withColumn("side", F.lit("kept"))
    return first.unionByName(second)


@query("select o_orderkey, o_orderstatus, o_totalprice from orders")
def q_json_array_scan(t):
    """JSON-array files of at most 10,000 records each."""
    path = work_path(t.spark, "orders-arrays")
    record = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    chunk = F.floor(F.col("o_orderkey") / 10_000)
    # Order keys are unique, so a chunk is bounded by its key range.
    arrays = t.orders.groupBy(chunk.alias("chunk")).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    schema = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").schema
    return readers.read_table(t.spark, path, "json-array", schema)


@query("select s_suppkey, s_name from supplier")
def q_snapshot(t):
    """An earlier snapshot, and one that was never written."""
    rows = t.supplier.select("s_suppkey", "s_name")
    path = work_path(t.spark, "snapshot")
    absent = readers.read_snapshot(t.spark, path, rows.schema)
    writers.write_table(rows, path)
    return readers.read_snapshot(t.spark, path, rows.schema).unionByName(absent)


@query("select c_custkey, c_name from customer")
def q_report_sink(t):
    """A dated report written and read back."""
    rows = t.customer.select("c_custkey", "c_name")
    path = writers.write_report(rows, work_path(t.spark, "reports"), dt.date(2024, 2, 10))
    return readers.read_table(t.spark, path, "csv", rows.schema)


@query("select distinct cast(c_nationkey as varchar) nation, true has_bytes from customer")
def q_file_manifest(t):
    """The files of a table written by nation, found by listing; contents are not read."""
    path = work_path(t.spark, "customer-by-nation")
    writers.write_table(t.customer, path, partition_by=["c_nationkey"])
    files = readers.list_files(t.spark, path, "*.parquet")
    nation = F.regexp_extract("path", "c_nationkey=([^/]*)/", 1)
    return files.groupBy(nation.alias("nation")).agg((F.sum("length") > 0).alias("has_bytes"))


@query("""
select event_id, event_type, case when value < 1 or event_type = 'error' then
  concat_ws(',', case when value < 1 then 'value' end, case when event_type = 'error' then 'type' end) end failed_rules from events
""")
def q_split_valid(t):
    """Valid rows and quarantined rows with the rules they break."""
    rows = t.events.select("event_id", "event_type", "value")
    good, bad = writers.split_valid(
        rows, {"value": F.col("value") >= 1, "type": F.col("event_type") != "error"}
    )
    return good.unionByName(bad, allowMissingColumns=True).drop("value")


@query("""
select l_orderkey, l_partkey, l_quantity, l_returnflag as "date", max(l_shipdate) timestamp_extracted
from lineitem group by all
""")
def q_compaction(t):
    """Exact repeats dropped, rewritten into large files by partition, read back."""
    path = work_path(t.spark, "balances")
    rows = t.lineitem.select(
        "l_orderkey", "l_partkey", "l_quantity", F.col("l_returnflag").alias("date"),
        F.col("l_shipdate").alias("timestamp_extracted"),
    )
    compact_balances(rows, path)
    return readers.read_table(t.spark, path)


@query("select event_id, user_id, event_type, value from events")
def q_stream_arrivals(t):
    """Arriving gzip JSON files, each once: the second run adds nothing."""
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    landing, table = work_path(t.spark, "landing"), work_path(t.spark, "events")
    rows.write.option("compression", "gzip").json(landing)
    checkpoint = work_path(t.spark, "checkpoint")
    for _ in range(2):
        stream = arrivals.file_stream(t.spark, landing, rows.schema)
        arrivals.run_available(stream, arrivals.batch_writer(table), checkpoint)
    return readers.read_table(t.spark, table).drop("run", "batch_id")


@query("""
select event_id, value, case when value >= 1 then 'good' else 'bad' end side from events
""")
def q_stream_quarantine(t):
    """A stream that sets bad rows aside instead of failing; Parquet files arrive."""
    rows = t.events.select("event_id", "value")
    table, bad = work_path(t.spark, "good"), work_path(t.spark, "bad")
    stream = arrivals.file_stream(t.spark, t.folder, t.events.schema, "parquet", "events.parquet")
    sink = arrivals.batch_writer(table, rules={"value": F.col("value") >= 1}, quarantine=bad)
    arrivals.run_available(stream.select(*rows.columns), sink, work_path(t.spark, "checkpoint"))
    good_rows = readers.read_table(t.spark, table).select("event_id", "value", F.lit("good").alias("side"))
    bad_rows = readers.read_table(t.spark, bad).select("event_id", "value", F.lit("bad").alias("side"))
    return good_rows.unionByName(bad_rows)


@query("select event_id, user_id, event_type, value from events")
def q_stream_continuous(t):
    """A stream in micro-batches of one file until all files are in; then it is stopped."""
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    landing, table = work_path(t.spark, "landing"), work_path(t.spark, "events")
    rows.repartition(3).write.option("compression", "gzip").json(landing)
    stream = arrivals.file_stream(t.spark, landing, rows.schema, files_per_batch=1)
    running = arrivals.run_continuous(stream, arrivals.batch_writer(table), work_path(t.spark, "checkpoint"), 0.1)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return readers.read_table(t.spark, table).drop("run", "batch_id")


@query("""
select s_suppkey, case when s_suppkey % 5 = 0 then '{"s_suppkey": ' || s_suppkey || ', "s_name": ' end broken_text,
  case when s_suppkey % 5 <> 0 then s_name end s_name from supplier
""")
def q_stream_broken(t):
    """Records that are no JSON go to the quarantine with their text and file; the others arrive."""
    good = F.to_json(F.struct("s_suppkey", "s_name"))
    cut = F.concat(F.lit('{"s_suppkey": '), F.col("s_suppkey").cast("string"), F.lit(', "s_name": '))
    landing, table, bad = (work_path(t.spark, n) for n in ("landing", "table", "bad"))
    t.supplier.select(F.when(F.col("s_suppkey") % 5 == 0, cut).otherwise(good).alias("value")).write.option(
        "compression", "gzip"
    ).text(landing)
    stream = arrivals.file_stream(t.spark, landing, "s_suppkey bigint, s_name string", "json", keep_broken=True)
    arrivals.run_available(stream, arrivals.batch_writer(table, quarantine=bad), work_path(t.spark, "checkpoint"))
    text = F.col(arrivals.BROKEN)
    kept = readers.read_table(t.spark, bad).where(F.col(arrivals.FILE).isNotNull()).select(
        F.regexp_extract(text, "([0-9]+)", 1).cast("bigint").alias("s_suppkey"), text.alias("broken_text"),
        F.lit(None).cast("string").alias("s_name"),
    )
    arrived = readers.read_table(t.spark, table).select("s_suppkey", F.lit(None).cast("string").alias("broken_text"), "s_name")
    return arrived.unionByName(kept)


@query("select c_custkey k from customer where c_custkey % 3 = 0")
def q_manifest(t):
    """Two runs over a growing input with a written manifest: the second sees only new keys."""
    keys = t.customer.select(F.col("c_custkey").alias("k"))
    first = keys.where(F.col("k") % 3 != 0)
    path = work_path(t.spark, "manifest")
    seen = readers.read_snapshot(t.spark, path, keys.schema)
    writers.write_table(mark_seen(seen, new_items(first, seen, "k"), "k"), path)
    return new_items(keys, readers.read_snapshot(t.spark, path, keys.schema), "k")
