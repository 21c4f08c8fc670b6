"""Queries on sharing, sending again, batch allocation, erasure, retention and monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import codes
from goldthread.operators import erasure as er, prefilter as pf, quality as dq, runlog, sharing as sh
from goldthread.operators.projection import SinkSpec, decrypt
from goldthread.plans.fixtures import KEYED_CTE, keyed
from goldthread.plans.registry import Tables, plain, query
from goldthread.session import new_path


def _at(text: str) -> F.Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


_FEED = "SELECT user_id, event_type, event_id, ts AS op_time FROM {events}"


def _log(t: Tables, config: str) -> DataFrame:
    """Share log: one earlier run per event day of the receiver."""
    days = t.events.filter(F.col("ts") < _at("2024-01-20")).select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("second_time")).distinct()
    return days.withColumn("config_id", F.lit(config))


@query("dl1_incremental_share", f"""
WITH f AS ({plain(_FEED)}), n AS (SELECT * FROM f WHERE op_time > (SELECT max(date_trunc('day', ts)) FROM events WHERE ts < TIMESTAMP '2024-01-20')
 QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY op_time DESC) = 1)
SELECT event_id, upper(event_type) AS "MarketCode" FROM n WHERE event_type = 'click' AND user_id > 10""")
def incremental(t: Tables) -> DataFrame:
    spec = SinkSpec({"MarketCode": "upper(event_type)"}, market="CLICK", condition="user_id > 10", include=("event_id", "MarketCode"))
    feed = t.sql(_FEED)
    return sh.incremental_share(feed, feed.limit(0), _log(t, "c1"), "c1", ["user_id", "event_type"], "op_time", spec)


@query("dl1_first_share_is_snapshot", "SELECT user_id, max(ts) AS op_time FROM events GROUP BY user_id")
def first_share(t: Tables) -> DataFrame:
    snapshot = t.events.groupBy("user_id").agg(F.max("ts").alias("op_time"))
    return sh.incremental_share(t.sql(_FEED), snapshot, _log(t, "other"), "c1", ["user_id"], "op_time", SinkSpec())


@query("dl4_full_share", "SELECT c_custkey, c_name FROM customer")
def full_share(t: Tables) -> DataFrame:
    spec = SinkSpec(exclude=("c_nationkey", "c_acctbal", "c_mktsegment"))
    return sh.incremental_share(t.customer, t.customer, _log(t, "c1"), "c1", ["c_custkey"], "c_custkey", spec, full=True)


@query("dl5_redrive_sources", """
WITH l AS (SELECT * FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
SELECT event_id, printf('%04d', CAST(ceil(row_number() OVER (ORDER BY ts, event_id) / 10.0) AS INTEGER)) AS batch_number FROM l""")
def redrive(t: Tables) -> DataFrame:
    wanted = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return sh.redrive_sources(t.events, wanted, ["user_id"], ["ts"], 10, id="event_id").select("event_id", "batch_number")


@query("dl6_resend_to_source_topic", "SELECT event_type AS topic, event_id::VARCHAR AS key, json_extract_string(props, '$.k') AS value FROM events")
def resend_source(t: Tables) -> DataFrame:
    landed = t.events.withColumn("landed_topic", F.concat("event_type", F.lit("-retry"))).withColumn("payload", F.concat(F.lit('{"source":'), "props", F.lit("}")))
    return sh.resend_to_source_topic(landed, "landed_topic", "-retry", F.get_json_object("payload", "$.source.k"), F.col("event_id"))


@query("dl7_resend_outputs", """
SELECT 'out.' || r_name || '.N' || n_nationkey AS topic, c_custkey::VARCHAR AS key, CASE WHEN c_acctbal >= 0 THEN c_name ELSE 'old ' || c_name END AS value
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def resend_outputs(t: Tables) -> DataFrame:
    data = t.customer.filter("c_acctbal >= 0").select("c_custkey", F.col("c_name").alias("body"))
    old = t.customer.select("c_custkey", F.concat(F.lit("old "), "c_name").alias("body"))
    topics = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name", "n_nationkey")
    return sh.resend_outputs(t.customer.select("c_custkey"), data, old, ["c_custkey"], topics, ["c_custkey"], "out.{r_name}.N{n_nationkey}", "body")


@query("dl7_clear_sent", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def clear_sent(t: Tables) -> DataFrame:
    sent = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return sh.clear_sent(t.customer.select("c_custkey"), sent, ["c_custkey"])


# One batch per user and type, as the ingest log holds them.
_LOG = """SELECT event_type AS topic, user_id AS batch_number, min(ts) AS creation_time, count(*) AS read_record_count, max(value) < 20 AS is_handle
FROM {events} GROUP BY event_type, user_id"""


def _allocated(batches: str, room: str) -> str:
    """Batches ``o`` of ``batches`` taken one by one in round order; a topic is closed by the first that does not fit."""
    fits = f"(NOT list_contains(r.closed, d.topic) AND r.total + d.n <= {room})"
    return f"""
WITH RECURSIVE {batches},
b AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY creation_time, batch_number) AS seq FROM o),
d AS (SELECT topic, batch_number, n, ceil(seq / priority)::BIGINT AS round, row_number() OVER (ORDER BY ceil(seq / priority), -priority, topic, seq) AS pos FROM b),
r AS (SELECT 0::BIGINT AS pos, 0::BIGINT AS total, []::VARCHAR[] AS closed, ''::VARCHAR AS topic, 0::BIGINT AS batch_number, 0::BIGINT AS round, false AS ok
      UNION ALL SELECT d.pos, r.total + CASE WHEN {fits} THEN d.n ELSE 0 END, CASE WHEN {fits} THEN r.closed ELSE list_append(r.closed, d.topic) END,
                       d.topic, d.batch_number, d.round, {fits} FROM r JOIN d ON d.pos = r.pos + 1)
SELECT topic, batch_number, round, total AS task_rows FROM r WHERE ok"""


@query("dl8_batch_allocation", _allocated(f"""
p AS (SELECT DISTINCT event_type AS topic, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 ELSE 1 END AS priority, (SELECT count(*) FROM events) // 10 AS topic_quota FROM events WHERE event_type <> 'error'),
a AS (SELECT l.*, priority, topic_quota, sum(read_record_count) OVER (PARTITION BY topic ORDER BY creation_time, batch_number) AS c FROM ({plain(_LOG)}) l JOIN p USING (topic) WHERE NOT is_handle),
o AS (SELECT topic, batch_number, creation_time, read_record_count AS n, priority FROM a WHERE c <= topic_quota)""", "(SELECT count(*) FROM events) // 4"))
def allocation(t: Tables) -> DataFrame:
    rows = t.events.count()
    rank = F.when(F.col("topic") == "click", 3).when(F.col("topic") == "view", 2).otherwise(1)
    priority = t.events.select(F.col("event_type").alias("topic")).distinct().select(
        "topic", rank.alias("priority"), F.lit(rows // 10).alias("topic_quota"), (F.col("topic") != "error").alias("is_active"))
    return sh.allocate_batches(t.sql(_LOG), priority, rows // 4).select("topic", "batch_number", "round", "task_rows")


@query("dl8_oversized_batch", _allocated(f"""
p AS (SELECT DISTINCT event_type AS topic, CASE event_type WHEN 'click' THEN 3 WHEN 'view' THEN 2 ELSE 1 END AS priority FROM events),
o AS (SELECT topic, batch_number, creation_time, read_record_count * CASE WHEN batch_number % 5 = 0 THEN 1000 ELSE 1 END AS n, priority FROM ({plain(_LOG)}) l JOIN p USING (topic) WHERE NOT is_handle)""", "900"))
def oversized(t: Tables) -> DataFrame:
    """Batches larger than the whole task close their topic and leave the room to the others."""
    rank = F.when(F.col("topic") == "click", 3).when(F.col("topic") == "view", 2).otherwise(1)
    priority = t.events.select(F.col("event_type").alias("topic")).distinct().select(
        "topic", rank.alias("priority"), F.lit(10**12).alias("topic_quota"), F.lit(True).alias("is_active"))
    large = F.when(F.col("batch_number") % 5 == 0, F.lit(1000)).otherwise(F.lit(1))
    log = t.sql(_LOG).withColumn("read_record_count", F.col("read_record_count") * large)
    return sh.allocate_batches(log, priority, 900).select("topic", "batch_number", "round", "task_rows")


# --- erasure

@query("an1_due_requests", """
SELECT o_custkey AS entity_id, o_orderpriority AS entity_source, o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate + INTERVAL 30 DAY <= TIMESTAMP '1999-01-01'
 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def due(t: Tables) -> DataFrame:
    requests = t.orders.filter("o_orderstatus = 'F'").select(
        "o_orderkey", (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("grace_date"), F.create_map("o_custkey", "o_orderpriority").alias("ids"))
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return er.due_requests(requests, _at("1999-01-01"), completed=done, keys=["o_orderkey"], ids="ids").select("entity_id", "entity_source", "o_orderkey")


@query("an2_rate_limit", """
WITH u AS (SELECT o_orderpriority AS market, o_custkey, min(o_orderdate) AS first_at FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY first_at, o_custkey) AS n FROM u)
SELECT o_orderkey FROM orders JOIN r ON o_orderpriority = market AND orders.o_custkey = r.o_custkey WHERE n <= CASE market WHEN '1-URGENT' THEN 2000 WHEN '2-HIGH' THEN 5 WHEN '5-LOW' THEN 1000000000 ELSE 0 END""")
def limit(t: Tables) -> DataFrame:
    quota = F.when(F.col("o_orderpriority") == "1-URGENT", 2000).when(F.col("o_orderpriority") == "2-HIGH", 5)
    quotas = t.orders.select("o_orderpriority").distinct().withColumn("quota", quota).filter("quota IS NOT NULL OR o_orderpriority = '5-LOW'")
    return er.rate_limit(t.orders, quotas, "o_orderpriority", ["o_custkey"], ["o_orderdate"]).select("o_orderkey")


@query("an3_exact_id_sets", """
WITH a AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS m FROM lineitem WHERE l_returnflag = 'R'), b AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS m FROM lineitem),
x AS (SELECT k, list_sort(list(m)) AS l FROM a GROUP BY 1), y AS (SELECT k, list_sort(list(m)) AS l FROM b GROUP BY 1) SELECT k FROM x JOIN y USING (k) WHERE x.l = y.l""")
def exact_sets(t: Tables) -> DataFrame:
    pairs = t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_suppkey").alias("m"), "l_returnflag")
    return er.same_members(pairs.filter("l_returnflag = 'R'"), pairs, ["k"], ["m"]).filter("is_equal").select("k")


@query("an4_key_strategy", """
WITH r AS (SELECT DISTINCT o_custkey::VARCHAR AS k, o_orderpriority AS b FROM orders WHERE o_orderstatus = 'P'), h AS (SELECT DISTINCT o_custkey::VARCHAR AS k, o_orderpriority AS b FROM orders),
x AS (SELECT DISTINCT k FROM h WHERE k IN (SELECT k FROM r) AND (k, b) NOT IN (SELECT k, b FROM r))
SELECT DISTINCT k, CASE WHEN k IN (SELECT k FROM x) THEN sha256('erased|' || k) ELSE k END AS new_key, CASE WHEN k IN (SELECT k FROM x) THEN 'NEW' ELSE 'SAME' END AS strategy FROM r""")
def strategy(t: Tables) -> DataFrame:
    held = t.orders.select(F.col("o_custkey").cast("string").alias("k"), F.col("o_orderpriority").alias("b"), "o_orderstatus")
    return er.key_strategy(held.filter("o_orderstatus = 'P'"), held, "k", "b")


_GONE = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


@query("an5_blank_personal_data", f"""
SELECT c_custkey, CASE WHEN c_custkey NOT IN ({_GONE}) THEN c_name END AS c_name, c_mktsegment, c_custkey IN ({_GONE}) AS is_deleted FROM customer""")
def blank(t: Tables) -> DataFrame:
    gone = t.customer.filter("c_acctbal < 0").select("c_custkey")
    table = t.customer.withColumn("is_deleted", F.lit(False))
    return er.blank_personal(table, gone, ["c_custkey"], ["c_name"], {"is_deleted": F.lit(True)}).select("c_custkey", "c_name", "c_mktsegment", "is_deleted")


@query("an6_requeue_other_brands", f"""
SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) AND (o_custkey, o_orderpriority) NOT IN (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P') THEN 'T9' ELSE 'T0' END AS task_id FROM orders""")
def other_brands(t: Tables) -> DataFrame:
    from goldthread.operators.master import requeue
    o = t.orders.withColumn("task_id", F.lit("T0"))
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    asked = o.filter("o_orderstatus = 'P'").select("o_custkey", "o_orderpriority")
    rest = o.join(gone, "o_custkey", "left_semi").join(asked, ["o_custkey", "o_orderpriority"], "left_anti")
    return requeue(o, rest, ["o_orderkey"], "task_id", F.lit("T9")).select("o_orderkey", "task_id")


@query("an7_purged_backups", f"""
SELECT o_orderkey FROM orders WHERE o_custkey IN ({_GONE}) AND NOT CAST(o_orderdate AS DATE) + 90 < DATE '1999-01-01'""")
def purged(t: Tables) -> DataFrame:
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    saved = er.backup_rows(t.orders, gone, ["o_custkey"], "T1", F.to_date("o_orderdate"), 90)
    return er.purge_expired(saved, F.to_date(F.lit("1999-01-01"))).select("o_orderkey")


@query("an8_cascading_delete", f"""
SELECT 'customer' AS table_name, count(*) AS rows FROM customer WHERE c_custkey NOT IN ({_GONE}) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_custkey NOT IN ({_GONE})
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_custkey IN ({_GONE})) UNION ALL SELECT 'events', count(*) FROM events WHERE user_id NOT IN ({_GONE})""")
def cascade(t: Tables) -> DataFrame:
    gone = t.customer.filter("c_acctbal < 0").select("c_custkey")
    orders = t.orders.join(gone, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select("o_orderkey")
    left = er.cascade_delete(gone, {
        "customer": er.Cascade(t.customer, {"c_custkey": "c_custkey"}), "orders": er.Cascade(t.orders, {"o_custkey": "c_custkey"}),
        "events": er.Cascade(t.events, {"user_id": "c_custkey"})})
    left |= er.cascade_delete(orders, {"lineitem": er.Cascade(t.lineitem, {"l_orderkey": "o_orderkey"})})
    return dq.table_counts(left)


@query("an8_key_graph", """
WITH n AS (SELECT n_nationkey FROM nation WHERE n_regionkey = 1), c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (FROM n)),
s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (FROM n) OR s_acctbal < 0), o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM c))
SELECT 'nation' AS table_name, count(*) AS rows FROM nation WHERE n_nationkey NOT IN (FROM n) UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey NOT IN (FROM c)
UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_suppkey NOT IN (FROM s) UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (FROM o)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (FROM o) AND l_suppkey NOT IN (FROM s)
UNION ALL SELECT 'events', count(*) FROM events WHERE user_id NOT IN (FROM c)""")
def cascade_layers(t: Tables) -> DataFrame:
    """Nations go, and all that points to them over up to three other layers; some suppliers are named themselves."""
    names = ("nation", "customer", "supplier", "orders", "lineitem", "events")
    links = [
        er.KeyLink("orders", "lineitem", {"l_orderkey": "o_orderkey"}), er.KeyLink("customer", "orders", {"o_custkey": "c_custkey"}),
        er.KeyLink("nation", "customer", {"c_nationkey": "n_nationkey"}), er.KeyLink("nation", "supplier", {"s_nationkey": "n_nationkey"}),
        er.KeyLink("supplier", "lineitem", {"l_suppkey": "s_suppkey"}), er.KeyLink("customer", "events", {"user_id": "c_custkey"})]
    seeds = {"nation": t.nation.filter("n_regionkey = 1").select("n_nationkey"), "supplier": t.supplier.filter("s_acctbal < 0").select("s_suppkey")}
    return dq.table_counts(er.cascade_graph({n: getattr(t, n) for n in names}, links, seeds))


@query("an8_prefiltered_delete", """
SELECT 'left' AS part, l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 100 <> 7 UNION ALL SELECT 'gone', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey % 100 = 7""")
def prefiltered(t: Tables) -> DataFrame:
    """One percent of the orders go: the other rows of the large table are cleared by a bitmap and do not move."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    gone = t.orders.filter("o_orderkey % 100 = 7").select(F.col("o_orderkey").alias("l_orderkey"))
    parts = {"left": pf.without_keys(lines, gone, ["l_orderkey"]), "gone": pf.semi_by_keys(lines, gone, ["l_orderkey"])}
    left, taken = (df.select(F.lit(n).alias("part"), "*") for n, df in parts.items())
    return left.unionByName(taken)


@query("an9_encrypted_and_complete", f"""
SELECT o_orderkey, CASE WHEN o_custkey IN ({_GONE}) THEN 'COMPLETE' ELSE 'OPEN' END AS status, o_custkey IN ({_GONE}) AS is_hidden, o_custkey::VARCHAR AS plain_id FROM orders""")
def encrypted(t: Tables) -> DataFrame:
    key = F.lit("0123456789abcdef")  # a test key; real keys are parameters
    log = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("entity_id"), F.lit("OPEN").alias("status"))
    done = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("entity_id"))
    out = er.hash_and_complete(log, done, ["entity_id"], "entity_id", key, mode="ECB")
    hidden = F.col("status") == "COMPLETE"
    return out.select("o_orderkey", "status", (F.length("entity_id") == 32).alias("is_hidden"), F.when(hidden, decrypt(F.col("entity_id"), key, "ECB")).otherwise(F.col("entity_id")).alias("plain_id"))


@query("an10_expired_datasets", """
SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2001-03-01' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))""")
def expired(t: Tables) -> DataFrame:
    from goldthread.operators.merge import delete_keys
    master = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    keys = er.expired_keys(t.orders, master, ["o_custkey"], "o_orderdate", _at("2001-03-01"))
    return delete_keys(t.orders, keys, ["o_custkey"]).select("o_orderkey")


@query("an11_resend_backups", """
SELECT c_custkey::VARCHAR AS key, unnest(CASE WHEN c_nationkey % 2 = 0 THEN ['even', 'all'] ELSE ['all'] END) AS topic, c_name AS value FROM customer""")
def resend_backups(t: Tables) -> DataFrame:
    topics = F.when(F.col("c_nationkey") % 2 == 0, "even, all").otherwise("all")
    return sh.spread_to_topics(t.customer, topics, F.col("c_custkey"), "c_name")


# --- checks and monitors

@query("dq1_orphans", """
SELECT 'orders' AS "check", count(*) AS bad_rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
UNION ALL SELECT 'events', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def orphans(t: Tables) -> DataFrame:
    return dq.orphans({"orders": (t.orders, "o_custkey"), "events": (t.events, "user_id")}, t.customer.filter("c_acctbal > 0"), "c_custkey")


@query("dq2_must_be_zero", f"""
WITH {KEYED_CTE} SELECT 'duplicate_lines' AS "check", count(*) AS bad_rows FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_customers', 0 UNION ALL SELECT 'deleted_with_phone', count(*) FROM keyed WHERE action = 'DELETE' AND phone IS NOT NULL""")
def zero(t: Tables) -> DataFrame:
    return dq.must_be_zero(
        {"duplicate_lines": (t.lineitem, ["l_orderkey", "l_linenumber"]), "duplicate_customers": (t.customer, ["c_custkey"])},
        {"deleted_with_phone": (keyed(t), (F.col("action") == "DELETE") & F.col("phone").isNotNull())})


@query("dq3_missing_batches", "SELECT DISTINCT user_id, event_type FROM events EXCEPT SELECT user_id, event_type FROM events WHERE value > 150")
def missing(t: Tables) -> DataFrame:
    expected = t.events.select("user_id", "event_type").distinct()
    return dq.missing_keys(expected, t.events.filter("value > 150"), ["user_id", "event_type"])


@query("dq4_oversized_documents", """
SELECT 'documents' AS dataset, doc_id::VARCHAR AS key, strlen(text) AS bytes FROM documents WHERE strlen(text) > 5000 UNION ALL SELECT 'pages', page_id::VARCHAR, strlen(html) FROM pages WHERE strlen(html) > 5000""")
def oversized(t: Tables) -> DataFrame:
    return dq.oversized_documents({"documents": (t.documents, ["doc_id"], "text"), "pages": (t.pages, ["page_id"], "html")}, 5000)


@query("dq5_invalid_samples", f"""
WITH {KEYED_CTE}, c AS (SELECT src_id, CASE WHEN email IS NULL AND phone IS NULL THEN 'ExcludeByPkMiss' WHEN balance < 0 THEN 'FailByClearMiss' END AS exclude_type FROM keyed)
SELECT exclude_type, src_id FROM c WHERE exclude_type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY exclude_type ORDER BY src_id) <= 5""")
def samples(t: Tables) -> DataFrame:
    kind = F.when(F.col("email").isNull() & F.col("phone").isNull(), codes.PK_MISS).when(F.col("balance") < 0, codes.CLEAR_MISS)
    return dq.sample_per_type(keyed(t).withColumn("exclude_type", kind), "exclude_type", [F.col("src_id")], 5).select("exclude_type", "src_id")


@query("dq6_daily_volume", "SELECT date_trunc('day', ts)::DATE AS day, event_type, " + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24)) + ", count(*) AS total FROM events GROUP BY 1, 2")
def daily_volume(t: Tables) -> DataFrame:
    return dq.hourly_volume(t.events.withColumn("day", F.to_date("ts")), ["day", "event_type"], "ts")


@query("dq7_topic_ratio", """
WITH c AS (SELECT event_type AS topic, count(*) AS n FROM events GROUP BY 1), p AS (SELECT * FROM (VALUES ('click', 'view'), ('error', 'signup'), ('view', 'nothing'), ('nothing', 'click'), ('void', 'nothing')) v(raw_topic, valid_topic)),
j AS (SELECT raw_topic, valid_topic, coalesce(a.n, 0) AS raw_rows, coalesce(b.n, 0) AS valid_rows FROM p LEFT JOIN c a ON a.topic = raw_topic LEFT JOIN c b ON b.topic = valid_topic)
SELECT *, abs(raw_rows - valid_rows)::DOUBLE / nullif(raw_rows, 0) AS gap,
 CASE WHEN raw_rows = 0 THEN valid_rows > 0 WHEN valid_rows = 0 THEN true ELSE abs(raw_rows - valid_rows)::DOUBLE / raw_rows >= 0.8 END AS is_alert FROM j""")
def topic_ratio(t: Tables) -> DataFrame:
    pairs = t.spark.createDataFrame([("click", "view"), ("error", "signup"), ("view", "nothing"), ("nothing", "click"), ("void", "nothing")], "raw_topic string, valid_topic string")
    return dq.topic_pair_alert(t.events, pairs, "event_type", 0.8)


@query("dq8_no_log_alert", "SELECT count(*) AS log_rows, count(*) = 0 AS is_alert FROM events WHERE event_type = 'error' AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'")
def no_log(t: Tables) -> DataFrame:
    return dq.no_log_alert(t.events.filter("event_type = 'error'"), "ts", _at("2024-01-10"), _at("2024-01-11"))


@query("dq10_column_fill", f"""
WITH {KEYED_CTE}, c AS (SELECT market_code, count(*) AS n, count(fn) AS a, count(phone) AS p, count(email) AS e FROM keyed GROUP BY 1)
SELECT market_code, unnest(['fn', 'phone', 'email']) AS column_name, n AS total_rows, unnest([a, p, e]) AS filled, round(unnest([a, p, e])::DOUBLE / n, 6) AS filled_share FROM c""")
def column_fill(t: Tables) -> DataFrame:
    return dq.fill_profile(keyed(t), ["fn", "phone", "email"], ["market_code"]).withColumn("filled_share", F.round("filled_share", 6))


@query("dq11_home_market", """
WITH r AS (SELECT o_custkey AS id, o_orderkey % 4 AS found_in, o_custkey % 4 AS home FROM orders), h AS (SELECT DISTINCT id FROM r WHERE found_in = home)
SELECT id, found_in, home <> 3 AND (found_in = home OR id NOT IN (SELECT id FROM h)) AS is_retained, count(*) AS rows FROM r GROUP BY ALL""")
def home_market(t: Tables) -> DataFrame:
    r = t.orders.select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 4).alias("found_in"), (F.col("o_custkey") % 4).alias("home"))
    return dq.keep_home_market(r, ["id"], "found_in", "home", [0, 1, 2]).groupBy("id", "found_in", "is_retained").agg(F.count(F.lit(1)).alias("rows"))


@query("dq12_step_log", "SELECT 'load' AS step, 'SUCCESS' AS status, '' AS message, (SELECT count(*) FROM orders) AS rows UNION ALL SELECT 'check', 'WARNING', 'duplicates', (SELECT count(*) FROM lineitem) UNION ALL SELECT 'send', 'FAILED', 'ValueError: no receiver', (SELECT count(*) FROM events)")
def step_log(t: Tables) -> DataFrame:
    """Three steps over the tables; their counts are joined to the log rows they left."""
    path = new_path(t.spark, "steps")
    with runlog.StepLog(t.spark, path, "T1", "load"):
        t.orders.write.format("noop").mode("overwrite").save()
    with runlog.StepLog(t.spark, path, "T1", "check") as log:
        if not dq.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]).isEmpty():
            log.warn("duplicates")
    try:
        with runlog.StepLog(t.spark, path, "T1", "send"):
            raise ValueError("no receiver")
    except ValueError:
        pass
    rows = dq.table_counts({"load": t.orders, "check": t.lineitem, "send": t.events}).withColumnRenamed("table_name", "step")
    return t.spark.read.schema(runlog.STEP_SCHEMA).parquet(path).join(rows, "step").select("step", "status", "message", "rows")


@query("dq13_ready_batches", """
WITH l AS (SELECT event_type AS domain_code, max(user_id) AS batch_id FROM events WHERE value > 5 GROUP BY 1), p AS (SELECT DISTINCT event_type AS domain_code, user_id AS batch_id FROM events WHERE event_type = 'click')
SELECT * FROM l WHERE (domain_code, batch_id) NOT IN (SELECT domain_code, batch_id FROM p)""")
def ready(t: Tables) -> DataFrame:
    log = t.events.select(F.col("event_type").alias("domain_code"), F.col("user_id").alias("batch_id"), "value")
    status = F.when(F.col("value") > 5, "COMPLETED").otherwise("FAILED")
    landed = log.withColumn("status", status).select("domain_code", "batch_id", "status").distinct()
    parsed = log.filter("domain_code = 'click'").withColumn("status", F.lit("COMPLETED"))
    return runlog.ready_batches(landed, parsed).select("domain_code", "batch_id")
