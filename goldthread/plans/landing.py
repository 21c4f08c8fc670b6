"""Queries on sources, sinks and streams. Files they need are derived from the tables by Spark."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import text as tx
from goldthread.operators.sharing import number_files
from goldthread.plans.registry import Tables, query
from goldthread.session import new_path
from goldthread.sources import files as fs, history as hs, jdbc, snapshots as sn, topics as tp
from goldthread.streaming import ingest, state as st, windows as wn


def _at(text: str) -> F.Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


def _write_documents(df: DataFrame, label: str) -> str:
    """One JSON file per row. Each task moves its own files to the folder, which is new and read only after the write; else the driver moves them all, one by one."""
    path = new_path(df.sparkSession, label)
    text = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    text.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(path)
    return path


@query("src1_json_documents", "SELECT page_id, url, strlen(html) AS bytes, 1::BIGINT AS files FROM pages")
def json_documents(t: Tables) -> DataFrame:
    path = _write_documents(t.pages.select(F.col("page_id").alias("@Id"), "url", "html"), "documents")
    landed = fs.land(fs.read_documents(t.spark, path), "WEB", 1, ["$.Header.Id", "$['@Id']"])
    per_file = landed.groupBy("source_file", "document_uuid").agg(F.count(F.lit(1)).alias("files"), F.first("raw_payload").alias("p"))
    return per_file.select(
        F.col("document_uuid").cast("bigint").alias("page_id"), F.get_json_object("p", "$.url").alias("url"),
        F.octet_length(F.get_json_object("p", "$.html")).cast("bigint").alias("bytes"), "files")


@query("src2_active_domains", "SELECT 'WEB' AS domain_code, count(*) AS documents FROM pages UNION ALL SELECT 'MARK', count(*) FROM benchmark")
def domains(t: Tables) -> DataFrame:
    paths = {n: _write_documents(df, n) for n, df in (("WEB", t.pages), ("MARK", t.benchmark), ("OFF", t.region))}
    config = [{"domain_code": n, "path": p, "document_ids": ["$.page_id", "$.item_id"], "active_flag": n != "OFF"} for n, p in paths.items()]
    return fs.land_domains(t.spark, config, 1).groupBy("domain_code").agg(F.count(F.lit(1)).alias("documents"))


@query("src3_skip_landed", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'")
def skip_landed(t: Tables) -> DataFrame:
    named = t.orders.withColumn("source_file", F.concat(F.lit("f_"), F.date_format("o_orderdate", "yyyyMM")))
    landed = named.filter(F.col("o_orderdate") < _at("1998-01-01")).select("source_file").distinct()
    return fs.skip_landed(named, landed).select("o_orderkey")


def _marks(t: Tables) -> DataFrame:
    return t.events.filter("event_type IN ('click', 'view')").groupBy("event_type").agg(
        F.min("ts").alias("_first")).select("event_type", _at("2024-01-10").alias("end_time"))


_READ = """(event_type = 'click' OR event_type = 'view') AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' OR event_type = 'signup' AND ts < TIMESTAMP '2024-01-20'"""


def _bounded(t: Tables) -> DataFrame:
    return fs.read_since(t.events, _marks(t), ["click", "view", "signup"], "event_type", "ts", _at("2024-01-20"))


@query("src4_bounded_topic_read", f"SELECT event_id, event_type FROM events WHERE {_READ}")
def bounded_read(t: Tables) -> DataFrame:
    return _bounded(t).select("event_id", "event_type")


@query("src5_high_watermarks", f"""
SELECT event_type, count(*) FILTER ({_READ}) AS read_record_count, TIMESTAMP '2024-01-20' AS end_time, 'T1' AS task_id FROM events GROUP BY event_type""")
def watermarks(t: Tables) -> DataFrame:
    return fs.next_marks(_bounded(t), t.events.select("event_type").distinct(), "event_type", _at("2024-01-20"), "T1")


def _event_files(t: Tables, label: str) -> str:
    path = new_path(t.spark, label)
    t.events.repartitionByRange(4, "ts").write.parquet(path)
    return path


@query("src6_stream_ingest_once", "SELECT event_id, user_id, value FROM events")
def ingest_once(t: Tables) -> DataFrame:
    """The stream is run twice and fed the same rows twice; every message is stored once."""
    spark, source = t.spark, _event_files(t, "stream-in")
    target, checkpoint = new_path(spark, "stream-out"), new_path(spark, "stream-checkpoint")
    schema = t.events.schema
    stream = ingest.file_stream(spark, source, schema, files_per_batch=2)
    ingest.run_once(stream, checkpoint, ingest.insert_batch(target, ["event_id"], day="ts"))
    t.events.write.mode("append").parquet(source)
    ingest.run_once(stream, checkpoint, ingest.insert_batch(target, ["event_id"], day="ts"))
    return ingest.read_target(spark, target, schema).select("event_id", "user_id", "value")


@query("str3_stream_newer_wins", "SELECT user_id, max(event_id) AS event_id, max(ts) AS ts FROM events GROUP BY user_id")
def stream_merge(t: Tables) -> DataFrame:
    spark, source = t.spark, _event_files(t, "merge-in")
    target = new_path(spark, "merge-out")
    schema = t.events.schema
    batches: list[int] = []
    write = ingest.merge_batch(target, ["user_id"], "ts", ["event_id"])

    def each(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        batches.append(batch_id)

    ingest.run_once(ingest.file_stream(spark, source, schema, files_per_batch=1), new_path(spark, "merge-checkpoint"), each)
    return spark.read.schema(schema).parquet(f"{target}/version={max(batches)}").select("user_id", "event_id", "ts")


@query("str3_stream_state_view", "SELECT user_id, max(event_id) AS event_id, max(ts) AS ts FROM events GROUP BY user_id")
def stream_view(t: Tables) -> DataFrame:
    spark, target = t.spark, new_path(t.spark, "view-out")
    stream = ingest.file_stream(spark, _event_files(t, "view-in"), t.events.schema, files_per_batch=2)
    ingest.run_once(stream, new_path(spark, "view-checkpoint"), ingest.insert_batch(target, ["event_id"]))
    return ingest.current_rows(spark, target, t.events.schema, ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "ts")


@query("str2_watermark_dedup", "SELECT event_id, user_id, value FROM events")
def watermark_dedup(t: Tables) -> DataFrame:
    """Messages delivered twice in one batch, in the next batch, and in another run are stored once, without a look at the target."""
    spark, source = t.spark, _event_files(t, "dedup-in")
    t.events.filter("event_id % 3 = 0").coalesce(1).write.mode("append").parquet(source)
    target, checkpoint = new_path(spark, "dedup-out"), new_path(spark, "dedup-checkpoint")
    stream = ingest.file_stream(spark, source, t.events.schema, files_per_batch=2)
    for again in (False, True):
        if again:
            t.events.filter("event_id % 2 = 0").coalesce(1).write.mode("append").parquet(source)
        wn.store_messages(stream, checkpoint, target, ["event_id"], "ts", "90 days")
    return spark.read.parquet(target).select("event_id", "user_id", "value")


_CUTS = ("2024-01-09", "2024-01-16")
_LATE = f"(ts < TIMESTAMP '{_CUTS[0]}' AND date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE ts >= TIMESTAMP '{_CUTS[0]}' AND ts < TIMESTAMP '{_CUTS[1]}') - INTERVAL 10 DAY)"


@query("dq6_streamed_volume", f"""
SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, event_type, count(*) AS rows FROM events WHERE NOT {_LATE} GROUP BY ALL
UNION ALL SELECT NULL, 'late', count(*) FROM events WHERE {_LATE}""")
def streamed_volume(t: Tables) -> DataFrame:
    """Volumes per hour and type; the early events come after the middle ones, and those more than 10 days behind come too late."""
    spark, source = t.spark, new_path(t.spark, "volume-in")
    target, log, checkpoint, log_checkpoint = (new_path(spark, n) for n in ("volume-out", "volume-log", "volume-checkpoint", "log-checkpoint"))
    first, second = (_at(c) for c in _CUTS)
    ts = F.col("ts")
    hour_end = F.date_trunc("hour", ts) + F.expr("INTERVAL 1 HOUR")
    for rows in ((ts >= first) & (ts < second), ts < first, ts >= second):
        t.events.filter(rows).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, t.events.schema)
        wn.store_volumes(stream, checkpoint, target, "ts", "1 hour", ["event_type"], "10 days")
        wn.run_available(stream, log_checkpoint, wn.log_arrivals(log, "ts", F.expr("INTERVAL 10 DAYS"), hour_end))
    volume = wn.current_volumes(spark, target, ["event_type"]).select(F.col("window_start").cast("timestamp_ntz").alias("hour"), "event_type", "rows")
    late = wn.arrivals(spark, log).agg(F.lit(None).cast("timestamp_ntz").alias("hour"), F.lit("late").alias("event_type"), F.sum("n_late").alias("rows"))
    return volume.unionByName(late)


@query("str3_keyed_state", """
SELECT user_id, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS event_id, max(ts) AS ts FROM events
GROUP BY user_id HAVING arg_max(event_type, struct_pack(t := ts, i := event_id)) <> 'error'""")
def keyed_state(t: Tables) -> DataFrame:
    """The middle of the events, then the early ones (late), then the first ones once more and the rest, in three runs of one checkpoint."""
    spark, schema = t.spark, t.events.schema
    source, target, checkpoint = (new_path(spark, n) for n in ("keyed-in", "keyed-out", "keyed-checkpoint"))
    first, second = (_at(c) for c in _CUTS)
    ts = F.col("ts")
    for rows in ((ts >= first) & (ts < second), ts < first, ts >= first):
        t.events.filter(rows).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.file_stream(spark, source, schema, files_per_batch=1)
        st.keep_newest(stream, checkpoint, target, ["user_id"], "ts", ["event_id"], F.col("event_type") == "error", late="90 days")
    return st.current_state(spark, target, schema, ["user_id"], "ts", ["event_id"]).select("user_id", "event_id", "ts")


@query("src6_two_checkpoints", "SELECT event_id, user_id, value FROM events")
def two_checkpoints(t: Tables) -> DataFrame:
    """Two queries with checkpoints of their own fill one target from overlapping sources; every message is stored once."""
    spark, target = t.spark, new_path(t.spark, "shared-out")
    halves = t.events.filter(F.col("ts") < _at(_CUTS[1])), t.events.filter(F.col("ts") >= _at(_CUTS[0]))
    for rows in halves:
        source = new_path(spark, "half-in")
        rows.coalesce(2).write.parquet(source)
        stream = ingest.file_stream(spark, source, t.events.schema, files_per_batch=1)
        ingest.run_once(stream, new_path(spark, "half-checkpoint"), ingest.insert_batch(target, ["event_id"], day="ts"))
    return ingest.read_target(spark, target, t.events.schema).select("event_id", "user_id", "value")


@query("str4_stream_change_feed", f"""
WITH cuts AS (SELECT * FROM (VALUES (0, TIMESTAMP '{_CUTS[0]}'), (1, TIMESTAMP '{_CUTS[1]}'), (2, TIMESTAMP '2100-01-01')) v(state_version, cut)),
newest AS (SELECT state_version, user_id, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS event_id, arg_max(event_type, struct_pack(t := ts, i := event_id)) AS kind
           FROM cuts JOIN events ON ts < cut GROUP BY ALL),
state AS (SELECT state_version, user_id, event_id FROM newest WHERE kind <> 'error'),
feed AS (SELECT coalesce(b.state_version, a.state_version + 1) AS state_version, CASE WHEN a.user_id IS NULL THEN 'I' WHEN b.user_id IS NULL THEN 'D' ELSE 'U' END AS code, a.event_id AS e0, b.event_id AS e1
         FROM state a FULL JOIN state b ON a.user_id = b.user_id AND b.state_version = a.state_version + 1)
SELECT state_version, code, count(*) AS rows FROM feed WHERE state_version < 3 AND e0 IS DISTINCT FROM e1 GROUP BY ALL""")
def stream_changes(t: Tables) -> DataFrame:
    """Three batches; a user whose newest event is an error leaves the state."""
    spark, source = t.spark, new_path(t.spark, "feed-in")
    target, feed, checkpoint = (new_path(spark, n) for n in ("feed-state", "feed-out", "feed-checkpoint"))
    write = ingest.merge_batch(target, ["user_id"], "ts", ["event_id"], feed, F.col("event_type") == "error")
    first, second = (_at(c) for c in _CUTS)
    for rows in (F.col("ts") < first, (F.col("ts") >= first) & (F.col("ts") < second), F.col("ts") >= second):
        t.events.filter(rows).coalesce(1).write.mode("append").parquet(source)
        ingest.run_once(ingest.file_stream(spark, source, t.events.schema), checkpoint, write)
    changes = spark.read.parquet(feed).groupBy("state_version", F.col("CDC_CODE").alias("code")).agg(F.count(F.lit(1)).alias("rows"))
    return changes.withColumn("state_version", F.col("state_version").cast("int"))


@query("src7_csv_read", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv(t: Tables) -> DataFrame:
    path = new_path(t.spark, "csv")
    t.customer.write.option("header", True).csv(path)
    return fs.read_csv(t.spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def _dated_extracts(t: Tables) -> str:
    path = new_path(t.spark, "extracts")
    for day in ("2024-01-05", "2024-03-01", "2024-02-10"):
        t.supplier.withColumn("day", F.lit(day)).coalesce(1).write.option("header", True).csv(f"{path}/stores_{day}")
    return path


@query("src8_newest_file", "SELECT DATE '2024-03-01' AS file_order, count(*) AS rows FROM supplier")
def newest(t: Tables) -> DataFrame:
    path = _dated_extracts(t)
    files = fs.list_files(t.spark, path, "*.csv")
    newest = fs.newest_file(files, fs.date_in_name(F.col("path")))
    rows = fs.read_csv(t.spark, [f"{path}/stores_*"]).withColumn("path", F.col("_metadata.file_path"))
    folder = lambda c: F.regexp_extract(c, r"stores_[0-9-]+", 0)
    hit = rows.withColumn("f", folder(F.col("path"))).join(newest.select(folder(F.col("path")).alias("f"), "file_order"), "f")
    return hit.groupBy("file_order").agg(F.count(F.lit(1)).alias("rows"))


@query("src9_csv_projection", "SELECT s_suppkey AS store_id, s_name AS store_name, '2024-02-10' AS extract_day FROM supplier")
def csv_projection(t: Tables) -> DataFrame:
    df = fs.read_csv(t.spark, f"{_dated_extracts(t)}/stores_2024-02-10")
    out = fs.project_csv(df, {"s_suppkey": "store_id", "s_name": "store_name"}, extract_day=F.date_format(F.col("day").cast("date"), "yyyy-MM-dd"))
    return out.withColumn("store_id", F.col("store_id").cast("bigint"))


def _slices(df: DataFrame, predicates) -> DataFrame:
    """Every slice predicate of a parallel read applied to a table: each row must fall into exactly one."""
    index = F.lit(None).cast("int")
    for i, p in enumerate(predicates):
        index = F.when(F.expr(p), i).otherwise(index)
    hits = sum((F.when(F.expr(p), 1).otherwise(0) for p in predicates), F.lit(0))
    return df.withColumns({"slice": index, "hits": hits})


@query("snk2_partition_delete", """
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderpriority <> '2-HIGH' AND NOT (o_orderpriority = '5-LOW' AND o_custkey % 3 = 0)""")
def partition_delete(t: Tables) -> DataFrame:
    """A merge that deletes all rows of one partition and some of another."""
    path, keys = new_path(t.spark, "delete-parts"), ["o_orderkey", "o_orderpriority"]
    columns = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    columns.write.partitionBy("o_orderpriority").parquet(path)
    gone = columns.filter("o_orderpriority = '2-HIGH' OR (o_orderpriority = '5-LOW' AND o_custkey % 3 = 0)")
    sn.merge_partitions(t.spark, path, gone, keys, ["o_orderpriority"], delete_when=lambda target, source: F.lit(True))
    return t.spark.read.schema(columns.schema).parquet(path).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("src10_integer_slices", """
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) + 1 AS hi FROM orders), p AS (SELECT lo, hi, (hi - 1 - lo) // 1000 + 1 AS n FROM b)
SELECT floor((o_orderkey - lo)::DOUBLE * n / (hi - lo))::BIGINT + 1 AS slice, count(*) AS rows FROM orders, p GROUP BY 1""")
def integer_slices(t: Tables) -> DataFrame:
    """Rows that each slice of the plan's bounds reads."""
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    plan = jdbc.integer_plan("o_orderkey", low, high, per_slice=1000)
    bucket = F.width_bucket(F.col("o_orderkey").cast("double"), F.lit(float(plan.lower)), F.lit(float(plan.upper)), F.lit(plan.partitions).cast("bigint"))
    return t.orders.groupBy(bucket.alias("slice")).agg(F.count(F.lit(1)).alias("rows"))


@query("src11_text_buckets", "SELECT c_custkey, 1 AS hits FROM customer")
def text_buckets(t: Tables) -> DataFrame:
    return _slices(t.customer, jdbc.text_plan("c_name").predicates).select("c_custkey", "hits")


@query("src12_time_slices", "SELECT o_orderkey, 1 AS hits FROM orders")
def time_slices(t: Tables) -> DataFrame:
    plan = jdbc.time_plan("o_orderdate", date(1995, 1, 1), date(2001, 9, 1), 90)
    return _slices(t.orders, [p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '") for p in plan.predicates]).select("o_orderkey", "hits")


@query("src13_uuid_slices", "SELECT c_custkey, 1 AS hits FROM customer")
def uuid_slices(t: Tables) -> DataFrame:
    keyed = t.customer.withColumn("pk", F.md5("c_name"))
    return _slices(keyed, jdbc.uuid_plan("pk", 16).predicates).select("c_custkey", "hits")


@query("src14_key_type_dispatch", "SELECT count(*) AS rows, true AS files_within_limit FROM orders")
def dispatch(t: Tables) -> DataFrame:
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    plan = jdbc.plan_for("o_orderkey", "bigint", {"min": low, "max": high})
    path = new_path(t.spark, "history")
    jdbc.write_history(t.orders.repartitionByRange(plan.partitions, plan.column), path, rows_per_file=4000)
    files = t.spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg(F.sum("n").alias("rows"), (F.max("n") <= 4000).alias("files_within_limit"))


@query("src15_key_list_read", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')")
def key_list(t: Tables) -> DataFrame:
    wanted = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_linenumber")
    return fs.rows_with_keys(t.lineitem, wanted, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_quantity")


def _versions(t: Tables) -> str:
    """Three versions of the orders of ever more months."""
    path = new_path(t.spark, "versions")
    for i, end in enumerate(("1997-01-01", "1999-01-01", "2002-01-01")):
        sn.commit(t.orders.filter(F.col("o_orderdate") < _at(end)), path, i, F.expr(f"TIMESTAMP '2024-01-0{i + 1} 00:00:00'"))
    return path


@query("src16_read_at_version", "SELECT o_orderkey, 'v1' AS version FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' UNION ALL SELECT o_orderkey, 'latest' FROM orders")
def at_version(t: Tables) -> DataFrame:
    path = _versions(t)
    one = sn.read_version(t.spark, path, 1).select("o_orderkey", F.lit("v1").alias("version"))
    return one.unionByName(sn.read_version(t.spark, path).select("o_orderkey", F.lit("latest").alias("version")))


@query("src17_change_feed", """SELECT o_orderkey, 'I' AS "CDC_CODE", 1::BIGINT AS "CDC_OperationVersion" FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def change_feed(t: Tables) -> DataFrame:
    return sn.changes_of(t.spark, _versions(t), 1, ["o_orderkey"]).select("o_orderkey", "CDC_CODE", "CDC_OperationVersion")


@query("src18_market_union", "SELECT c_custkey, 'N' || c_nationkey AS market_code FROM customer")
def market_union(t: Tables) -> DataFrame:
    path = new_path(t.spark, "markets")
    t.customer.withColumn("market", F.concat(F.lit("N"), "c_nationkey")).write.partitionBy("market").parquet(path)
    paths = {f"N{r[0]}": f"{path}/market=N{r[0]}" for r in t.nation.select("n_nationkey").collect()}  # 25 configured markets
    held = t.customer.select("c_nationkey").distinct()
    present = {f"N{r[0]}" for r in held.collect()}
    return fs.read_markets(t.spark, {m: p for m, p in paths.items() if m in present}).select("c_custkey", "market_code")


@query("snk13_messages_per_topic", "SELECT event_type AS topic, event_id::VARCHAR AS key, props AS value FROM events")
def topic_sink(t: Tables) -> DataFrame:
    path = new_path(t.spark, "topics")
    tp.send_to_folder(tp.messages(t.events, F.col("event_type"), F.col("event_id"), F.col("props")), path)
    return tp.read_folder(t.spark, path)


@query("snk14_numbered_files", "SELECT o_orderkey, CAST(ceil(row_number() OVER (ORDER BY o_orderkey) / 1000.0) AS BIGINT) AS file_no FROM orders")
def numbered_files(t: Tables) -> DataFrame:
    return number_files(t.orders, 1000, ["o_orderkey"]).select("o_orderkey", "file_no")


@query("snk18_archived_source_files", "SELECT event_id FROM events")
def archived(t: Tables) -> DataFrame:
    """Processed source files move to the archive folder; the rows are all there."""
    spark, source = t.spark, _event_files(t, "to-archive")
    target = new_path(spark, "archived-out")
    stream = ingest.file_stream(spark, source, t.events.schema, 1, archive=new_path(spark, "archive"))
    ingest.run_once(stream, new_path(spark, "archive-checkpoint"), ingest.insert_batch(target, ["event_id"]))
    return ingest.read_target(spark, target, t.events.schema).select("event_id")


@query("snk19_point_in_time_restore", "SELECT o_orderkey, 3 AS version FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'")
def restore(t: Tables) -> DataFrame:
    path = _versions(t)
    version = sn.restore(t.spark, path, F.expr("TIMESTAMP '2024-01-03 00:00:00'"), F.expr("TIMESTAMP '2024-01-09 00:00:00'"))
    return sn.read_version(t.spark, path).select("o_orderkey", F.lit(version).alias("version"))


@query("snk20_snapshot_copy", "SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'suppliers', count(*) FROM supplier")
def snapshot_copy(t: Tables) -> DataFrame:
    spark, target = t.spark, new_path(t.spark, "copies")
    suppliers = new_path(spark, "suppliers")
    sn.commit(t.supplier, suppliers, 0)
    sn.copy_tables(spark, {"orders": _versions(t), "suppliers": suppliers}, target)
    from goldthread.operators.quality import table_counts
    return table_counts({n: sn.read_version(spark, f"{target}/{n}") for n in ("orders", "suppliers")})


@query("snk2_partition_overwrite", """
SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderpriority < '3' AND o_orderstatus = 'F' THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice FROM orders""")
def partition_overwrite(t: Tables) -> DataFrame:
    """Only two of the five partitions are read and written again."""
    columns = ["o_orderkey", "o_totalprice", "o_orderpriority"]
    path = new_path(t.spark, "partitioned")
    t.orders.select(*columns).write.partitionBy("o_orderpriority").parquet(path)
    fresh = t.orders.filter("o_orderpriority < '3' AND o_orderstatus = 'F'").select(*columns).withColumn("o_totalprice", F.lit(0.0))
    sn.merge_partitions(t.spark, path, fresh, ["o_orderkey", "o_orderpriority"], ["o_orderpriority"])
    return t.spark.read.schema(fresh.schema).parquet(path).select(*columns)


@query("snk2_null_partition", """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority,
       CASE WHEN o_orderpriority >= '4' AND o_orderkey % 4 = 0 THEN 0.0::DOUBLE ELSE o_totalprice END AS o_totalprice
FROM orders WHERE NOT (o_orderpriority = '4-NOT SPECIFIED' AND o_orderkey % 4 = 0)""")
def null_partition(t: Tables) -> DataFrame:
    """A merge that changes some rows of the null partition, and deletes some of another one; all other rows stay."""
    keys, path = ["o_orderkey", "o_orderpriority"], new_path(t.spark, "null-parts")
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    rows = t.orders.select("o_orderkey", "o_totalprice", priority.alias("o_orderpriority"))
    rows.write.partitionBy("o_orderpriority").parquet(path)
    some = rows.filter("o_orderkey % 4 = 0 AND coalesce(o_orderpriority, '4') LIKE '4%'").withColumn("o_totalprice", F.lit(0.0))
    sn.merge_partitions(t.spark, path, some, keys, ["o_orderpriority"], null_safe_keys=True, delete_when=lambda target, source: target["o_orderpriority"].isNotNull())
    return t.spark.read.schema(rows.schema).parquet(path).select("o_orderkey", "o_orderpriority", "o_totalprice")


# --- history loads

@query("hl1_history_load", """
SELECT 'N' || c_nationkey || '-' || lpad(c_custkey::VARCHAR, 9, '0') AS parent_id, 'N' || c_nationkey AS market, o_orderkey AS child_id, 'HISTORY' AS origin, CAST(o_totalprice AS DECIMAL(19, 4)) AS total
FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT c_acctbal < 0""")
def history_load(t: Tables) -> DataFrame:
    from pyspark.sql.types import DecimalType, LongType, StringType, StructType
    parents = t.customer.select(F.col("c_custkey").alias("id"), F.concat(F.lit("N"), "c_nationkey").alias("market"), "c_acctbal")
    kept = hs.rekey_parents(parents, "id", "market", F.col("c_acctbal") < 0)
    schema = StructType().add("parent_id", StringType()).add("market", StringType()).add("child_id", LongType()).add("origin", StringType()).add("total", DecimalType(19, 4))
    children = t.orders.select(F.col("o_custkey").alias("parent_id"), F.col("o_orderkey").alias("old_child"), F.col("o_totalprice").alias("TOTAL"))
    return hs.load_children(children, kept, "id", "parent_id", "market", schema, {"old_child": "child_id"}, {"origin": F.lit("HISTORY")})


@query("hl2_store_history_load", """
SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 3 = 0 THEN s_name END, 'NAME-' || s_suppkey) AS s_name, DATE '2024-02-10' AS extract_day, 'home' AS origin FROM supplier WHERE s_nationkey < 15
UNION ALL SELECT s_suppkey, s_name, DATE '2024-02-10', 'foreign' FROM supplier WHERE s_nationkey >= 15""")
def store_history(t: Tables) -> DataFrame:
    day = fs.date_in_name(F.lit("stores_2024-02-10.csv"))
    home = t.supplier.filter("s_nationkey < 15").withColumn("s_name", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")))
    landed = t.supplier.select("s_suppkey", F.to_json(F.struct(F.struct(F.concat(F.lit("NAME-"), "s_suppkey").alias("Name")).alias("Store"))).alias("payload"))
    filled = hs.backfill(home.select("s_suppkey", "s_name"), landed, ["s_suppkey"], "payload", {"s_name": "$.Store.Name"})
    a = filled.withColumn("origin", F.lit("home"))
    b = t.supplier.select("s_suppkey", "s_name").withColumn("origin", F.lit("foreign"))
    return hs.only_if_absent(a, b, ["s_suppkey"]).withColumn("extract_day", day)


@query("hl3_market_probe", "SELECT c_nationkey % 5 AS extract_market, c_custkey % 5 AS record_market, count(*) AS rows, c_nationkey % 5 = c_custkey % 5 AS is_match FROM customer GROUP BY ALL")
def market_probe(t: Tables) -> DataFrame:
    from goldthread.operators.quality import market_match_counts
    rows = t.customer.select((F.col("c_nationkey") % 5).alias("extract_market"), (F.col("c_custkey") % 5).alias("record_market"))
    return market_match_counts(rows, "extract_market", "record_market")


@query("jn19_snapshot_fallback", "SELECT user_id, CASE WHEN user_id IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01') THEN 'current' ELSE 'snapshot' END AS place FROM (SELECT DISTINCT user_id FROM events WHERE user_id IN (SELECT o_custkey FROM orders))")
def snapshot_fallback(t: Tables) -> DataFrame:
    from goldthread.operators.sharing import lookup_with_fallback
    path = new_path(t.spark, "old-orders")
    sn.commit(t.orders.filter(F.col("o_orderdate") < _at("1999-01-01")), path, 0)
    now = t.orders.filter(F.col("o_orderdate") >= _at("1999-01-01"))
    one = lambda df, place: df.select(F.col("o_custkey").alias("user_id")).distinct().withColumn("place", F.lit(place))
    return lookup_with_fallback(t.events.select("user_id").distinct(), one(now, "current"), one(sn.read_version(t.spark, path), "snapshot"), ["user_id"])


@query("str1_resumed_stream", "SELECT event_id, 1 + (ts >= TIMESTAMP '2024-01-16')::INTEGER AS run FROM events")
def resumed(t: Tables) -> DataFrame:
    """The second run reads only files that came after the first one."""
    spark, source = t.spark, new_path(t.spark, "resume-in")
    target, checkpoint = new_path(spark, "resume-out"), new_path(spark, "resume-checkpoint")
    for run, rows in enumerate((t.events.filter(F.col("ts") < _at("2024-01-16")), t.events.filter(F.col("ts") >= _at("2024-01-16")))):
        rows.coalesce(2).write.mode("append").parquet(source)

        def write(batch: DataFrame, batch_id: int, run: int = run) -> None:
            batch.select("event_id", F.lit(run + 1).alias("run")).write.mode("append").parquet(target)

        ingest.run_once(ingest.file_stream(spark, source, t.events.schema), checkpoint, write)
    return spark.read.parquet(target)


@query("str2_replayed_batch", "SELECT event_id, user_id FROM events")
def replayed(t: Tables) -> DataFrame:
    """Every batch is delivered twice, as after a lost commit; the target is unchanged by the second."""
    spark, target = t.spark, new_path(t.spark, "replay-out")
    write = ingest.insert_batch(target, ["event_id"])

    def twice(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        write(batch, batch_id)

    stream = ingest.file_stream(spark, _event_files(t, "replay-in"), t.events.schema, 2)
    ingest.run_once(stream, new_path(spark, "replay-checkpoint"), twice)
    return ingest.read_target(spark, target, t.events.schema).select("event_id", "user_id")
