"""Queries on table mutation and change capture."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from goldthread.operators import changes as ch, merge as mg
from goldthread.operators.dedup import latest_action, latest_per_key
from goldthread.plans.fixtures import MESSAGES_CTE, SPLIT_DATE, messages
from goldthread.plans.registry import Tables, query
from goldthread.session import new_path, stage

_AT = f"TIMESTAMP '{SPLIT_DATE} 00:00:00'"
_KEY = ["user_id", "event_type"]


def _newest() -> list[F.Column]:
    return [F.col("ts").desc(), F.col("event_id").desc()]


def _split() -> F.Column:
    return F.expr(f"TIMESTAMP_NTZ '{SPLIT_DATE} 00:00:00'")


def _target(t: Tables) -> DataFrame:
    return latest_per_key(messages(t).filter(F.col("ts") < _split()), _KEY, _newest())


def _source(t: Tables) -> DataFrame:
    return latest_per_key(messages(t).filter(F.col("ts") >= _split()), _KEY, _newest())


def _latest(name: str, condition: str) -> str:
    return f"""{name} AS (SELECT * FROM messages WHERE {condition} QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""


_SIDES = f"WITH {MESSAGES_CTE}, {_latest('tgt', f'ts < {_AT}')}, {_latest('src', f'ts >= {_AT}')}"


@query("snk4_merge_upsert", _SIDES + """
SELECT coalesce(s.event_id, t.event_id) AS event_id, user_id, event_type, coalesce(s.ts, t.ts) AS ts, coalesce(s.value, t.value) AS value, coalesce(s.action, t.action) AS action
FROM tgt t FULL JOIN src s USING (user_id, event_type)""")
def merge_upsert(t: Tables) -> DataFrame:
    return mg.merge(_target(t), mg.check_unique(_source(t), _KEY), _KEY)


@query("snk5_merge_changed_only", _SIDES + """
SELECT user_id, event_type, CASE WHEN t.user_id IS NULL OR s.action IS DISTINCT FROM t.action OR s.value IS DISTINCT FROM t.value THEN s.event_id ELSE t.event_id END AS event_id
FROM (SELECT * FROM tgt) t FULL JOIN src s USING (user_id, event_type) WHERE s.user_id IS NOT NULL
UNION ALL SELECT user_id, event_type, event_id FROM tgt WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM src)""")
def merge_changed(t: Tables) -> DataFrame:
    out = mg.merge(_target(t), _source(t), _KEY, update_when=mg.changed(["action", "value"]))
    return out.select("user_id", "event_type", "event_id")


@query("snk6_merge_newer_wins", f"""
WITH {MESSAGES_CTE}, {_latest('low', 'value < 30')}, {_latest('high', 'value >= 30')}
SELECT user_id, event_type, CASE WHEN o.ts IS NULL OR e.ts > o.ts THEN e.event_id ELSE o.event_id END AS event_id,
       CASE WHEN o.ts IS NULL OR e.ts > o.ts THEN e.ts ELSE o.ts END AS ts
FROM low o FULL JOIN high e USING (user_id, event_type)""")
def newer_wins(t: Tables) -> DataFrame:
    m = messages(t)
    low = latest_per_key(m.filter("value < 30"), _KEY, _newest())
    high = latest_per_key(m.filter("value >= 30"), _KEY, _newest())
    return mg.upsert_newer(low, high, _KEY, "ts").select("user_id", "event_type", "event_id", "ts")


@query("snk7_action_routing", f"""
WITH {MESSAGES_CTE}, tgt AS (SELECT * FROM messages WHERE ts < {_AT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
src AS (SELECT * FROM messages WHERE ts >= {_AT} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CASE action WHEN 'DELETE' THEN 1 WHEN 'CHANGE' THEN 2 ELSE 3 END, event_id DESC) = 1)
SELECT user_id, CASE WHEN s.action IS NULL OR (s.action = 'DELETE') THEN t.event_type ELSE s.event_type END AS event_type,
       CASE WHEN s.action IS NULL THEN t.value WHEN s.action = 'DELETE' THEN NULL ELSE s.value END AS value,
       coalesce(s.action, t.action) AS action, coalesce(s.action = 'DELETE', false) AS is_deleted
FROM tgt t FULL JOIN src s USING (user_id) WHERE t.user_id IS NOT NULL OR s.action <> 'DELETE'""")
def action_routing(t: Tables) -> DataFrame:
    m = messages(t)
    target = latest_per_key(m.filter(F.col("ts") < _split()), ["user_id"], _newest()).withColumn("is_deleted", F.lit(False))
    source = latest_action(m.filter(F.col("ts") >= _split()), ["user_id"], "ts", "action", F.col("event_id").desc())
    out = mg.route_actions(target, source, ["user_id"], "ts", "action", ["value"])
    return out.select("user_id", "event_type", "value", "action", "is_deleted")


@query("snk8_merge_delete", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def merge_delete(t: Tables) -> DataFrame:
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return mg.delete_keys(t.orders, gone, ["o_custkey"]).select("o_orderkey")


@query("snk10_insert_only", f"""
WITH m AS (SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS slot, ts FROM events)
SELECT DISTINCT user_id, event_type, slot FROM m WHERE ts >= {_AT} EXCEPT SELECT user_id, event_type, slot FROM m WHERE ts < {_AT}""")
def insert_only(t: Tables) -> DataFrame:
    keys = [*_KEY, "slot"]
    m = t.events.withColumn("slot", F.floor(F.col("value") / 10)).select(*keys, "ts")
    old, fresh = m.filter(F.col("ts") < _split()), m.filter(F.col("ts") >= _split())
    return mg.insert_missing(old.select(*keys), fresh.select(*keys), keys)


@query("snk10_null_keys", f"""
WITH m AS (SELECT user_id, CASE WHEN value < 50 THEN NULL ELSE event_type END AS event_type, ts FROM events)
SELECT user_id, event_type, 'inserted' AS part FROM (SELECT user_id, event_type FROM m EXCEPT SELECT user_id, event_type FROM m WHERE ts < {_AT})""")
def insert_null_keys(t: Tables) -> DataFrame:
    """Keys that hold nulls; the same insert again finds nothing to do."""
    m = t.events.withColumn("event_type", F.when(F.col("value") >= 50, F.col("event_type"))).select("user_id", "event_type", "ts")
    old, fresh = m.filter(F.col("ts") < _split()).select(*_KEY), m.select(*_KEY)
    once = mg.insert_missing(old, fresh, _KEY)
    again = mg.insert_missing(old.unionByName(once), fresh, _KEY)
    return once.withColumn("part", F.lit("inserted")).unionByName(again.withColumn("part", F.lit("again")))


@query("snk10_insert_winner", f"""
WITH m AS (SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS slot, event_id, value, ts FROM events),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, slot ORDER BY value DESC, event_id) AS n FROM m WHERE ts >= {_AT})
SELECT user_id, event_type, slot, event_id, value FROM w WHERE n = 1 AND (user_id, event_type, slot) NOT IN (SELECT user_id, event_type, slot FROM m WHERE ts < {_AT})""")
def insert_winner(t: Tables) -> DataFrame:
    keys = [*_KEY, "slot"]
    m = t.events.withColumn("slot", F.floor(F.col("value") / 10)).select(*keys, "event_id", "value", "ts")
    old, fresh = m.filter(F.col("ts") < _split()), m.filter(F.col("ts") >= _split())
    return mg.insert_missing(old, fresh, keys, [F.col("value").desc(), F.col("event_id")]).drop("ts")


@query("snk3_cast_losses", """
SELECT 'p_container' AS column_name, count(p_brand) AS filled, count(*) FILTER (p_brand IS NOT NULL AND TRY_CAST(p_brand AS INTEGER) IS NULL) AS lost FROM part
UNION ALL SELECT 'p_size', count(p_size), 0 FROM part UNION ALL SELECT 'p_name', count(x), count(*) FILTER (x IS NOT NULL AND TRY_CAST(x AS BIGINT) IS NULL)
FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_partkey::VARCHAR END AS x FROM part)""")
def cast_losses(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_brand").alias("P_CONTAINER"), "p_size", F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_partkey").cast("string")).alias("p_name"))
    wanted = StructType([StructField("p_container", IntegerType()), StructField("p_size", LongType()), StructField("p_name", LongType()), StructField("note", StringType())])
    return mg.cast_losses(rows, wanted)


@query("snk1_append_coerced", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::VARCHAR AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'SUPPLIER' FROM supplier""")
def append_coerced(t: Tables) -> DataFrame:
    target = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    fresh = t.supplier.select(F.col("s_suppkey").cast("string").alias("ID"), F.col("s_name").alias("Name"),
                              F.col("s_acctbal").cast("string").alias("balance"), F.lit("SUPPLIER").alias("segment"))
    return mg.append_evolving(target, fresh)


@query("snk2_slice_overwrite", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, 0.0::DOUBLE FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000""")
def slice_overwrite(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    fresh = o.filter("o_orderstatus = 'F' AND o_totalprice > 200000").withColumn("o_totalprice", F.lit(0.0))
    once = mg.replace_slice(o, fresh, F.col("o_orderstatus") == "F")
    return mg.replace_slice(once, fresh, F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")


_WANTED = StructType([
    StructField("C_CUSTKEY", IntegerType()), StructField("c_Name", StringType()), StructField("c_acctbal", LongType()), StructField("note", StringType()),
])


@query("snk3_schema_align", """SELECT CAST(c_custkey AS INTEGER) AS "C_CUSTKEY", c_name AS "c_Name", CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, NULL::VARCHAR AS note FROM customer""")
def schema_align(t: Tables) -> DataFrame:
    return mg.align_schema(t.customer, _WANTED)


@query("snk3_schema_report", """
SELECT * FROM (VALUES ('c_acctbal', 'double', 'bigint', 'type_differs'), ('c_custkey', 'bigint', 'int', 'type_differs'), ('c_mktsegment', 'string', NULL, 'extra'),
 ('c_name', 'string', 'string', 'same'), ('c_nationkey', 'int', NULL, 'extra'), ('note', NULL, 'string', 'missing')) v(column_name, source_type, target_type, status)""")
def schema_report(t: Tables) -> DataFrame:
    return mg.schema_report(t.customer, _WANTED)


@query("snk12_truncate_and_reload", """
SELECT nation, CAST(sum(n) AS BIGINT) AS customers FROM (SELECT c_nationkey AS nation, 1 AS n FROM customer) GROUP BY nation""")
def reload(t: Tables) -> DataFrame:
    from goldthread.sources.snapshots import reload_guarded
    old = t.nation.select(F.col("n_nationkey").alias("nation"), F.lit(0).cast("bigint").alias("customers"))
    fresh = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("customers"))
    return reload_guarded(reload_guarded(old, fresh), fresh.filter("false"))


@query("snk15_backup_copy", """
SELECT o_orderkey, 'T1' AS task_id, DATE '2001-08-01' + 90 AS expired_date FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def backup(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import backup_rows
    keys = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    saved = backup_rows(t.orders, keys, ["o_custkey"], "T1", F.to_date(F.lit("2001-08-01")), 90)
    return saved.select("o_orderkey", "task_id", "expired_date")


@query("snk16_archive_and_delete", """
SELECT o_orderkey, 'archived' AS place FROM orders WHERE o_orderdate < TIMESTAMP '1996-06-01' UNION ALL SELECT o_orderkey, 'kept' FROM orders WHERE NOT o_orderdate < TIMESTAMP '1996-06-01'""")
def archive(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import split_by_retention
    old, kept = split_by_retention(t.orders, "o_orderdate", F.expr("TIMESTAMP_NTZ '1996-06-01'"))
    return old.select("o_orderkey", F.lit("archived").alias("place")).unionByName(kept.select("o_orderkey", F.lit("kept").alias("place")))


def _archive_rules(t: Tables) -> list:
    from goldthread.operators.erasure import ArchiveRule
    return [
        ArchiveRule("orders", t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day")), "day", 1000),
        ArchiveRule("broken", t.customer, "no_such_column", 10),
        ArchiveRule("lines", t.lineitem.select("l_orderkey", F.col("l_shipdate").cast("date").alias("day")), "day", 400),
    ]


_ARCHIVED = """
WITH c AS (SELECT 'orders' AS "group", count(*) FILTER (o_orderdate::DATE < DATE '2000-01-01' - 1000) AS archived, count(*) AS n FROM orders
 UNION ALL SELECT 'lines', count(*) FILTER (l_shipdate::DATE < DATE '2000-01-01' - 400), count(*) FROM lineitem)
"""


@query("snk16_archive_run", _ARCHIVED + """
SELECT "group", 'SUCCESS' AS status, archived, n - archived AS kept, archived AS in_archive, n - archived AS in_table FROM c
UNION ALL SELECT 'broken', 'FAILED', 0, 0, 0, 0""")
def archive_groups(t: Tables) -> DataFrame:
    """What the run reports, beside what its files hold; the group in the middle fails and stops nothing."""
    from goldthread.operators.erasure import archive_run
    folder = new_path(t.spark, "archive")
    report = archive_run(t.spark, _archive_rules(t), F.lit("2000-01-01").cast("date"), folder).drop("message")
    def held(place: str, name: str) -> DataFrame:
        parts = [t.spark.read.parquet(f"{folder}/{place}/{g}").select(F.lit(g).alias("group")) for g in ("orders", "lines")]
        return parts[0].unionByName(parts[1]).groupBy("group").agg(F.count(F.lit(1)).alias(name))
    return report.join(held("archive", "in_archive"), "group", "left").join(held("kept", "in_table"), "group", "left").na.fill(0)


@query("snk16_dry_run", _ARCHIVED + """SELECT "group", 'DRY_RUN' AS status, archived, n - archived AS kept, '' AS message FROM c""")
def archive_dry(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import archive_run
    rules = [r for r in _archive_rules(t) if r.group != "broken"]
    return archive_run(t.spark, rules, F.lit("2000-01-01").cast("date"), new_path(t.spark, "archive-dry"), dry_run=True)


@query("snk17_update_and_delete", """
SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN NULL ELSE c_name END AS c_name FROM customer WHERE NOT c_acctbal < -500""")
def update_delete(t: Tables) -> DataFrame:
    kept = mg.delete_where(t.customer, F.col("c_acctbal") < -500)
    return mg.update_where(kept, F.col("c_nationkey") == 3, {"c_name": F.lit(None).cast("string")}).select("c_custkey", "c_name")


# --- change tables

def _state(t: Tables, before: str) -> DataFrame:
    rows = messages(t).filter(F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{before}'"))
    newest = latest_per_key(rows, ["user_id", "event_type"], _newest())
    return newest.filter((F.col("action") != "DELETE") | (F.col("value") > 40)).select(*_KEY, "event_id", "action")


def _state_sql(name: str, before: str) -> str:
    return f"""{name} AS (SELECT user_id, event_type, event_id, action FROM (SELECT * FROM messages WHERE ts < TIMESTAMP '{before}'
      QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1) WHERE action <> 'DELETE' OR value > 40)"""


_CUTS = ("2024-01-08", "2024-01-16", "2024-01-24", "2024-02-10")
_STATES = f"WITH {MESSAGES_CTE}, " + ", ".join(_state_sql(f"s{i}", c) for i, c in enumerate(_CUTS))


def _diff_sql(old: str, new: str) -> str:
    return f"""SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_type, o.event_type) AS event_type, CASE WHEN n.event_id IS NULL THEN o.event_id ELSE n.event_id END AS event_id,
      CASE WHEN o.event_id IS NULL THEN 'I' WHEN n.event_id IS NULL THEN 'D' ELSE 'U' END AS "CDC_CODE"
      FROM {old} o FULL JOIN {new} n ON o.user_id = n.user_id AND o.event_type = n.event_type
      WHERE o.event_id IS NULL OR n.event_id IS NULL OR o.event_id <> n.event_id OR o.action <> n.action"""


@query("snk9_snapshot_diff", f"{_STATES} {_diff_sql('s2', 's3')}")
def diff(t: Tables) -> DataFrame:
    return ch.snapshot_diff(_state(t, _CUTS[2]), _state(t, _CUTS[3]), _KEY).drop("action")


@query("src17_change_feed_first_version", f"""{_STATES} SELECT user_id, event_type, event_id, 'I' AS "CDC_CODE", 0::BIGINT AS "CDC_OperationVersion" FROM s3""")
def first(t: Tables) -> DataFrame:
    return ch.first_version(_state(t, _CUTS[3]), version=0).drop("action")


_FEED = f"""{_STATES}, feed AS (SELECT *, 1 AS v FROM ({_diff_sql('s0', 's1')}) UNION ALL SELECT *, 2 FROM ({_diff_sql('s1', 's2')}) UNION ALL SELECT *, 3 FROM ({_diff_sql('s2', 's3')}))"""


def _feed(t: Tables) -> DataFrame:
    """The change table of three steps; every state is computed once, and the feed is a table, as receivers read it."""
    states = [stage(_state(t, c), "state") for c in _CUTS]
    parts = [ch.snapshot_diff(a, b, _KEY, version=i + 1) for i, (a, b) in enumerate(zip(states, states[1:]))]
    return stage(parts[0].unionByName(parts[1]).unionByName(parts[2]), "feed")


@query("dl2_collapse_versions", f"""{_FEED} SELECT user_id, event_type, arg_max(event_id, v) AS event_id, arg_max("CDC_CODE", v) AS "CDC_CODE" FROM feed GROUP BY user_id, event_type""")
def collapse(t: Tables) -> DataFrame:
    return ch.collapse_versions(_feed(t), _KEY, "CDC_OperationVersion").select(*_KEY, "event_id", "CDC_CODE")


@query("dl3_net_changes", f"""{_FEED}, e AS (SELECT user_id, event_type, arg_min("CDC_CODE", v) AS f, arg_max("CDC_CODE", v) AS l, arg_max(event_id, v) AS event_id FROM feed GROUP BY 1, 2)
SELECT user_id, event_type, event_id, CASE WHEN f = 'I' THEN 'I' WHEN l = 'D' THEN 'D' ELSE 'U' END AS "CDC_CODE" FROM e WHERE NOT (f = 'I' AND l = 'D')""")
def net(t: Tables) -> DataFrame:
    return ch.net_changes(_feed(t), _KEY, "CDC_OperationVersion").select(*_KEY, "event_id", "CDC_CODE")


@query("snk9_apply_changes", f"{_STATES} SELECT * FROM s3")
def apply(t: Tables) -> DataFrame:
    old, new = _state(t, _CUTS[0]), _state(t, _CUTS[3])
    return ch.apply_changes(old, ch.snapshot_diff(old, new, _KEY), _KEY)


@query("jn14_null_safe_merge_key", """
WITH a AS (SELECT CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS k, min(c_name) AS name FROM customer WHERE c_acctbal < 0 GROUP BY 1),
b AS (SELECT CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS k, max(c_name) AS name FROM customer WHERE c_acctbal > 9000 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, coalesce(b.name, a.name) AS name FROM a FULL JOIN b ON a.k IS NOT DISTINCT FROM b.k""")
def null_safe(t: Tables) -> DataFrame:
    c = t.customer.withColumn("k", F.when(F.col("c_nationkey") >= 5, F.col("c_nationkey")))
    a = c.filter("c_acctbal < 0").groupBy("k").agg(F.min("c_name").alias("name"))
    b = c.filter("c_acctbal > 9000").groupBy("k").agg(F.max("c_name").alias("name"))
    return mg.merge(a, b, ["k"], null_safe_keys=True)
