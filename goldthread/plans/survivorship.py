"""Queries on survivorship, documents and master maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import jsonfn
from goldthread.operators import documents as dc, master as ms, survive as sv
from goldthread.operators.dedup import latest_per_key
from goldthread.plans.fixtures import KEYED_CTE, MESSAGES_CTE, keyed, messages
from goldthread.plans.registry import Tables, plain, query


def _at(text: str) -> F.Column:
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


# --- best records

@query("ms9_best_record", """
SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, i := o_orderkey)) AS latest_o_orderkey, arg_max(o_totalprice, struct_pack(d := o_orderdate, i := o_orderkey)) AS latest_o_totalprice,
 arg_min(o_orderpriority, struct_pack(d := o_orderdate, i := o_orderkey)) AS earliest_o_orderpriority,
 arg_max(o_orderkey, struct_pack(d := o_totalprice, i := o_orderkey)) FILTER (o_orderstatus = 'F') AS largest_o_orderkey, count(*) AS contributors FROM orders GROUP BY o_custkey""")
def best_record(t: Tables) -> DataFrame:
    return sv.best_record(t.orders, ["o_custkey"], [
        sv.Facet("latest", ("o_orderkey", "o_totalprice"), ("o_orderdate", "o_orderkey")),
        sv.Facet("earliest", ("o_orderpriority",), ("o_orderdate", "o_orderkey"), latest=False),
        sv.Facet("largest", ("o_orderkey",), ("o_totalprice", "o_orderkey"), F.col("o_orderstatus") == "F"),
    ], contributors=F.count(F.lit(1)))


@query("ms9_priority_value", """
SELECT o_custkey, coalesce(max(o_orderdate) FILTER (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'), max(o_orderdate) FILTER (o_orderstatus = 'F'), max(o_orderdate)) AS decided FROM orders GROUP BY 1""")
def priority_value(t: Tables) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return sv.priority_max(t.orders, ["o_custkey"], [done & (F.col("o_orderpriority") == "1-URGENT"), done, None], "o_orderdate", "decided")


@query("wn17_golden_rollup", f"""
WITH {MESSAGES_CTE}, c AS (SELECT user_id, event_type, ts, event_id, value, action = 'DELETE' AS dead FROM messages), a AS (
 SELECT user_id, count(*) FILTER (NOT dead) AS n, arg_max(event_id, struct_pack(t := ts, i := event_id)) FILTER (NOT dead) AS live, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS latest FROM c GROUP BY 1)
SELECT a.user_id, event_id AS primary_id, value, n AS contributor_count, n = 0 AS is_deleted FROM a JOIN c ON event_id = coalesce(live, latest)""")
def golden(t: Tables) -> DataFrame:
    m = messages(t).withColumn("dead", F.col("action") == "DELETE")
    return sv.golden_rollup(m, ["user_id"], "dead", "ts", "event_id", "ts", ["value"])


@query("wn16_best_contact", """
SELECT o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_orderdate DESC, o_orderkey DESC) = 1""")
def best_contact(t: Tables) -> DataFrame:
    valid = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    return sv.best_contact(t.orders.withColumn("valid", valid), ["o_custkey", "o_orderpriority"], "valid", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderpriority", "o_orderkey")


# Orders as contact rows of a customer: type, value, consent, quality, source.
_CONTACTS = """SELECT o_custkey AS person, CASE WHEN o_orderkey % 3 = 0 THEN 'mail' ELSE 'text' END AS type_code, 'v' || CAST(o_orderkey % 2 AS STRING) AS value,
  'S' || CAST(o_orderkey % 4 AS STRING) AS source_code, o_orderpriority = '5-LOW' AS is_deleted, CASE WHEN o_totalprice > 200000 THEN 'ok' ELSE 'bad' END AS quality,
  date_trunc('month', o_orderdate) AS optin_date, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS optin_flag, o_orderdate AS source_timestamp,
  date_trunc('year', o_orderdate) AS update_dt, o_custkey AS record_id, o_orderkey AS contact_id FROM {orders}"""


def _survivor_sql() -> str:
    tr, al, va, ag = "source_code NOT IN ('S3')", "NOT is_deleted", "quality = 'ok'", "optin_flag = 1"
    w = "max(optin_date) FILTER ({}) OVER {}"
    def levels(conditions, over, col="optin_date"):
        return "coalesce(" + ", ".join(f"max({col}) FILTER ({c}) OVER {over}" for c in conditions) + f", max({col}) OVER {over})"
    by_value = levels([f"{tr} AND {al}", tr, al], "v")
    by_type = levels([f"{tr} AND {va} AND {ag}", f"{tr} AND {va}", f"{tr} AND {ag}", tr, f"{va} AND {ag}", va, ag], "k")
    fallback = levels([f"{tr} AND {al} AND {va}", f"{tr} AND {al}", f"{al} AND {va}", al], "k", "source_timestamp")
    return f"""WITH c AS ({plain(_CONTACTS)}), a AS (SELECT *, {by_value} AS vd FROM c WINDOW v AS (PARTITION BY person, type_code, value)),
 b AS (SELECT *, {by_type} AS td FROM a WHERE optin_date = vd WINDOW k AS (PARTITION BY person, type_code)),
 d AS (SELECT person, type_code, max(source_timestamp) AS ts1 FROM b WHERE optin_date = td GROUP BY 1, 2),
 f AS (SELECT *, {fallback} AS ts2 FROM c WINDOW k AS (PARTITION BY person, type_code))
SELECT person, type_code, value, contact_id, optin_flag, quality FROM f LEFT JOIN d USING (person, type_code)
QUALIFY row_number() OVER (PARTITION BY person, type_code ORDER BY CASE WHEN source_timestamp = coalesce(ts1, ts2) THEN 0 ELSE 1 END, update_dt DESC, record_id DESC, contact_id DESC) = 1"""


@query("ms10_contact_survivor", _survivor_sql())
def contact_survivor(t: Tables) -> DataFrame:
    out = sv.contact_survivor(t.sql(_CONTACTS), ["person"], sv.ContactRules(weak_sources=("S3",)))
    return out.select("person", "type_code", "value", "contact_id", "optin_flag", "quality")


_CHANNELS = """WITH o AS (SELECT o_custkey AS owner, o_orderpriority AS p, o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'KOR' ELSE 'AUS' END AS market_code,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'mblprs' WHEN '2-HIGH' THEN 'hmeprs' ELSE 'mblprf' END AS type_code FROM {orders})"""


@query("ms10_consent_channels", plain(_CHANNELS) + """, c AS (SELECT user_id AS owner, CASE WHEN user_id % 2 = 0 THEN 'KOR' ELSE 'AUS' END AS market_code, CASE event_type WHEN 'click' THEN 'sms' WHEN 'view' THEN 'mms' ELSE 'eml' END AS channel, max(ts) AS optin_date FROM events GROUP BY 1, 2, 3)
SELECT o_orderkey, channel, optin_date FROM o LEFT JOIN c ON o.owner = c.owner AND o.market_code = c.market_code AND channel IN ('sms', 'mms') AND (o.market_code = 'KOR' OR type_code IN ('mblprs', 'mblprf'))""")
def consent_channels(t: Tables) -> DataFrame:
    from goldthread.functions import codes
    contacts = t.sql(_CHANNELS + " SELECT * FROM o")
    market = F.when(F.col("user_id") % 2 == 0, "KOR").otherwise("AUS")
    channel = F.when(F.col("event_type") == "click", "sms").when(F.col("event_type") == "view", "mms").otherwise("eml")
    consents = t.events.groupBy(F.col("user_id").alias("owner"), market.alias("market_code"), channel.alias("channel")).agg(F.max("ts").alias("optin_date")).withColumn("optin_flag", F.lit(1))
    return codes.attach_consents(contacts, consents, "phone", ["owner", "market_code"]).select("o_orderkey", "channel", "optin_date")


@query("ms11_consent_merge", f"""
WITH d AS (SELECT o_custkey AS person, o_orderpriority AS channel, max(o_orderdate) AS consent_date, 'derived' AS origin FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2),
o AS (SELECT o_custkey AS person, o_orderpriority AS channel, max(o_orderdate) AS consent_date, 'own' AS origin FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2)
SELECT * FROM d UNION ALL SELECT * FROM o WHERE (person, channel) NOT IN (SELECT person, channel FROM d)""")
def consent_merge(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("channel"), F.col("o_orderdate").alias("consent_date"), "o_orderstatus")
    derived = o.filter("o_orderstatus = 'F'").drop("o_orderstatus").withColumn("origin", F.lit("derived"))
    own = o.filter("o_orderstatus <> 'F'").drop("o_orderstatus").withColumn("origin", F.lit("own"))
    return sv.merge_consents(derived, own, ["person", "channel"], "consent_date")


@query("ms12_attribute_merge", """
WITH a AS (SELECT o_custkey AS person, o_orderpriority AS name, o_orderstatus AS value, o_orderdate AS at_time FROM orders)
SELECT person, name, CASE WHEN name = '1-URGENT' THEN max(value) ELSE arg_max(value, struct_pack(t := at_time, v := value)) END AS value FROM a GROUP BY 1, 2
UNION ALL SELECT c_custkey, 'Debtor', CASE WHEN c_acctbal < 0 THEN 'true' ELSE 'false' END FROM customer UNION ALL SELECT c_custkey, 'Rich', 'true' FROM customer WHERE c_acctbal > 9000""")
def attribute_merge(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("person"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("value"), F.col("o_orderdate").alias("at_time"))
    groups = t.customer.select(F.col("c_custkey").alias("person"), "c_acctbal")
    flags = {"Debtor": F.col("c_acctbal") < 0, "Rich": F.when(F.col("c_acctbal") > 9000, F.lit(True))}
    return sv.merge_attributes(a, ["person"], "name", "value", "at_time", ["1-URGENT"], flags, groups)


@query("ms15_touched_scope", """
WITH s AS (SELECT * FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
SELECT o_orderkey FROM s WHERE o_custkey IN (SELECT o_custkey FROM s GROUP BY 1 HAVING count(*) <= 12)""")
def scope(t: Tables) -> DataFrame:
    return _scope(t)[0].select("o_orderkey")


@query("ms15_oversized_keys", """
WITH s AS (SELECT * FROM orders WHERE o_custkey IN (SELECT user_id FROM events WHERE event_type = 'signup') AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0))
SELECT o_custkey, count(*) AS rows FROM s GROUP BY 1 HAVING count(*) > 12""")
def oversized(t: Tables) -> DataFrame:
    """The keys that the scope leaves out, with their number of records."""
    return _scope(t)[1]


def _scope(t: Tables) -> tuple[DataFrame, DataFrame]:
    touched = t.events.filter("event_type = 'signup'").select(F.col("user_id").alias("o_custkey"))
    excluded = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return sv.touched_scope(t.orders, touched, ["o_custkey"], 12, excluded)


# --- documents

def _order_lists(t: Tables) -> dict[str, dc.ChildList]:
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    seen = t.events.withColumnRenamed("user_id", "c_custkey")
    return {
        "Orders": dc.ChildList(orders, {"Id": "o_orderkey", "Total": "o_totalprice", "Code": "o_orderpriority"}, ("o_orderdate", "o_orderkey")),
        "Events": dc.ChildList(seen, {"Id": "event_id", "Type": "event_type"}, ("ts", "event_id")),
    }


_DOC_SQL = """SELECT c_custkey, c_name AS name, coalesce(no, 0) AS n_orders, o1 AS first_order, coalesce(ne, 0) AS n_events, e1 AS last_event FROM customer
 LEFT JOIN (SELECT o_custkey, count(*) AS no, arg_min(o_orderkey, struct_pack(d := o_orderdate, i := o_orderkey)) AS o1 FROM orders GROUP BY 1) ON o_custkey = c_custkey
 LEFT JOIN (SELECT user_id, count(*) AS ne, arg_max(event_id, struct_pack(d := ts, i := event_id)) AS e1 FROM events GROUP BY 1) ON user_id = c_custkey"""


@query("ms14_document_lists", _DOC_SQL)
def document_lists(t: Tables) -> DataFrame:
    d = dc.assemble(t.customer.select("c_custkey", "c_name"), _order_lists(t), ["c_custkey"])
    return d.select(
        "c_custkey", F.col("c_name").alias("name"), F.coalesce(F.size("Orders"), F.lit(0)).cast("bigint").alias("n_orders"),
        F.try_element_at("Orders", F.lit(1))["Id"].alias("first_order"), F.coalesce(F.size("Events"), F.lit(0)).cast("bigint").alias("n_events"),
        F.try_element_at("Events", F.lit(-1))["Id"].alias("last_event"))


@query("sc19_document_assembly", _DOC_SQL.replace("c_name AS name", "nullif(c_name, '') AS name"))
def document_text(t: Tables) -> DataFrame:
    """The same documents as JSON text, read back by path."""
    d = dc.assemble(t.customer.select("c_custkey", "c_name"), _order_lists(t), ["c_custkey"])
    body = jsonfn.document(F.struct(
        F.struct(F.lit("CREATE").alias("@Action")).alias("Header"),
        F.struct(F.col("c_name").alias("Name"), F.lit(None).cast("string").alias("Middle"), F.col("Orders").alias("OrderList"), F.col("Events").alias("EventList")).alias("Person")))
    p = d.select("c_custkey", body.alias("body"))
    size = lambda name: F.coalesce(F.json_array_length(jsonfn.node(F.col("body"), "Person", name)), F.lit(0)).cast("bigint")
    events = F.from_json(jsonfn.node(F.col("body"), "Person", "EventList"), "array<struct<Id:bigint>>")
    return p.filter(F.col("body").contains('"Middle":null')).select(
        "c_custkey", jsonfn.node(F.col("body"), "Person", "Name").alias("name"), size("OrderList").alias("n_orders"),
        F.get_json_object("body", "$.Person.OrderList[0].Id").cast("bigint").alias("first_order"), size("EventList").alias("n_events"),
        F.try_element_at(events, F.lit(-1))["Id"].alias("last_event"))


@query("ms13_nested_lists", "SELECT o_custkey, o_orderpriority, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS ids FROM orders GROUP BY 1, 2")
def nested_lists(t: Tables) -> DataFrame:
    n = dc.nest_children(t.orders, ["o_custkey", "o_orderpriority"], {"Id": F.col("o_orderkey").cast("string")}, ["o_orderkey"])
    return n.select("o_custkey", "o_orderpriority", F.array_join(F.transform("items", lambda x: x["Id"]), ",").alias("ids"))


@query("ms18_documents_without_personal_data", """
SELECT c_custkey, n_name AS nation, CASE WHEN c_nationkey < 5 THEN 'special' ELSE 'main' END AS dataset, true AS has_no_name, count(o_orderkey) AS n_orders
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL""")
def without_personal(t: Tables) -> DataFrame:
    heads = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lists = {"Orders": _order_lists(t)["Orders"]}
    d = dc.assemble(heads.select("c_custkey", "c_nationkey", "n_name"), lists, ["c_custkey"])
    body = jsonfn.document(F.struct(F.col("n_name").alias("Nation"), F.col("Orders").alias("OrderList")))
    special = F.col("c_nationkey") < 5
    out = d.select("c_custkey", body.alias("body"), F.when(special, "special").otherwise("main").alias("dataset"))
    return out.select(
        "c_custkey", jsonfn.node(F.col("body"), "Nation").alias("nation"), "dataset", (~F.col("body").contains("Customer#")).alias("has_no_name"),
        F.coalesce(F.json_array_length(jsonfn.node(F.col("body"), "OrderList")), F.lit(0)).cast("bigint").alias("n_orders"))


@query("ms19_document_changed_only", """
SELECT s_suppkey, CASE WHEN s_nationkey < 10 THEN s_acctbal + 1 ELSE s_acctbal END AS balance, CASE WHEN s_nationkey < 10 THEN 2 ELSE 1 END AS version FROM supplier""")
def changed_only(t: Tables) -> DataFrame:
    from goldthread.operators.merge import changed, merge
    old = t.supplier.select("s_suppkey", F.col("s_acctbal").alias("balance"), F.lit(1).alias("version"))
    new = t.supplier.select("s_suppkey", F.when(F.col("s_nationkey") < 10, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal")).alias("balance"), F.lit(2).alias("version"))
    return merge(old, new, ["s_suppkey"], update_when=changed(["balance"]))


def _docs(t: Tables, changed: bool) -> DataFrame:
    o = t.orders
    total = F.when((F.col("o_orderkey") % 10 == 0) & F.lit(changed), F.col("o_orderkey") + 1).otherwise(F.col("o_orderkey"))
    empty = F.when(F.lit(changed), F.lit("")).otherwise(F.lit(None).cast("string"))
    a = F.struct(F.lit("a").alias("Code"), F.col("o_orderpriority").alias("V"))
    b = F.struct(F.lit("b").alias("Code"), F.when((F.col("o_orderkey") % 15 == 0) & F.lit(changed), "X").otherwise("Y").alias("V"))
    items = F.array(b, a) if changed else F.array(a, b)
    body = F.struct(
        F.struct(F.lit(str(changed)).alias("Sent")).alias("Header"),
        F.struct(F.col("o_orderstatus").alias("Status"), total.alias("Total"), empty.alias("Note"), items.alias("List")).alias("Body"))
    return o.select("o_orderkey", "o_custkey", "o_orderdate", jsonfn.document(body).alias("payload"))


@query("dq9_document_diff", """
WITH latest AS (SELECT o_custkey, arg_max(o_orderkey, struct_pack(d := o_orderdate, i := o_orderkey)) AS k FROM orders GROUP BY 1)
SELECT o_custkey, 'Body.Total' AS path, 'value' AS kind, k::VARCHAR AS left_value, (k + 1)::VARCHAR AS right_value FROM latest WHERE k % 10 = 0
UNION ALL SELECT o_custkey, 'Body.List[b].V', 'value', 'Y', 'X' FROM latest WHERE k % 15 = 0""")
def document_diff(t: Tables) -> DataFrame:
    rules = dc.CompareRules(ignore=("Header",), keyed={"Body.List": "Code"})
    newest = [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()]
    return dc.document_diff(_docs(t, False), _docs(t, True), ["o_custkey"], "payload", rules, newest)


def _payloads(t: Tables, body: Column) -> DataFrame:
    return t.orders.select("o_orderkey", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


@query("dq9_unwrap_single", """
SELECT o_orderkey, 'Status[1]' AS path, 'value' AS kind, o_orderstatus AS left_value, o_orderpriority AS right_value FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, 'Status', 'value', o_orderstatus, 'changed' FROM orders WHERE o_orderkey % 3 = 2""")
def unwrap_single(t: Tables) -> DataFrame:
    """A list of one element against the element alone, equal (0) and changed (2), and lists of two elements (1)."""
    key, status, other = F.col("o_orderkey") % 3, F.col("o_orderstatus"), F.col("o_orderpriority")
    pair = lambda second: F.struct(F.array(status, second).alias("Status"))
    one, bare = F.to_json(F.struct(F.array(status).alias("Status"))), lambda c: F.to_json(F.struct(c.alias("Status")))
    left = t.orders.select("o_orderkey", F.when(key == 1, F.to_json(pair(status))).otherwise(one).alias("payload"))
    right = t.orders.select("o_orderkey", F.when(key == 1, F.to_json(pair(other))).when(key == 0, bare(status)).otherwise(bare(F.lit("changed"))).alias("payload"))
    return dc.document_diff(left, right, ["o_orderkey"], "payload", dc.CompareRules(unwrap_single=True))


@query("dq9_unordered_lists", """
SELECT o_orderkey, 'value' AS kind, '1' AS left_value, '2' AS right_value FROM orders WHERE o_orderkey % 4 = 0""")
def unordered_lists(t: Tables) -> DataFrame:
    """Lists without a key in another order; in some documents one member of one element differs."""
    item = lambda name, v: F.struct(F.lit(name).alias("Name"), F.col("o_orderstatus").alias("Status"), v.alias("V"))
    v = F.when(F.col("o_orderkey") % 4 == 0, F.lit(2)).otherwise(F.lit(1))
    left = _payloads(t, F.struct(F.array(item("a", F.lit(1)), item("b", F.lit(1)), item("c", F.lit(9))).alias("List")))
    right = _payloads(t, F.struct(F.array(item("c", F.lit(9)), item("b", v), item("a", F.lit(1))).alias("List")))
    return dc.document_diff(left, right, ["o_orderkey"], "payload", dc.CompareRules(unordered=("List",))).drop("path")


@query("dq9_odd_names", """
SELECT o_orderkey, u.path, 'value' AS kind, '1' AS left_value, '2' AS right_value
FROM orders, (VALUES ('VOIDED'), ('VARIANT_ID'), ('OBJECT.VOID'), ('`a.b`'), ('x: VOID')) u(path) WHERE o_orderkey % 2 = 0""")
def odd_names(t: Tables) -> DataFrame:
    """Members whose names look like types or hold the signs of paths."""
    def body(v: Column) -> Column:
        return F.struct(v.alias("VOIDED"), v.alias("VARIANT_ID"), F.struct(v.alias("VOID")).alias("OBJECT"), v.alias("a.b"), v.alias("x: VOID"))
    other = F.when(F.col("o_orderkey") % 2 == 0, F.lit(2)).otherwise(F.lit(1))
    return dc.document_diff(_payloads(t, body(F.lit(1))), _payloads(t, body(other)), ["o_orderkey"], "payload")


def _texts(t: Tables, body: Column) -> DataFrame:
    return t.orders.select("o_orderkey", body.alias("payload"))


@query("dq9_root_list", """
SELECT o_orderkey, kind, CASE kind WHEN 'list' THEN '[1].q' ELSE '' END AS path, 'value' AS difference, o_orderkey::VARCHAR AS left_value, (o_orderkey + 1)::VARCHAR AS right_value
FROM orders, (VALUES ('list'), ('scalar'), ('mixed')) v(kind) WHERE o_orderkey % 2 = 0 AND (kind <> 'mixed')
UNION ALL SELECT o_orderkey, 'mixed', CASE WHEN o_orderkey % 3 = 0 THEN '[1].q' ELSE '' END, 'value', o_orderkey::VARCHAR, (o_orderkey + 1)::VARCHAR FROM orders WHERE o_orderkey % 2 = 0""")
def root_list(t: Tables) -> DataFrame:
    """Documents whose root is a list, a scalar, or either."""
    key = F.col("o_orderkey")
    other = F.when(key % 2 == 0, key + 1).otherwise(key)
    listed = lambda v: F.concat(F.lit('[{"p":"x"},{"q":'), v.cast("string"), F.lit("}]"))
    bodies = {"list": listed, "scalar": lambda v: v.cast("string"), "mixed": lambda v: F.when(key % 3 == 0, listed(v)).otherwise(v.cast("string"))}
    out = None
    for kind, body in bodies.items():
        found = dc.document_diff(_texts(t, body(key)), _texts(t, body(other)), ["o_orderkey"], "payload")
        found = found.select("o_orderkey", F.lit(kind).alias("kind"), "path", F.col("kind").alias("difference"), "left_value", "right_value")
        out = found if out is None else out.unionByName(found)
    return out


@query("dq9_mixed_members", """
WITH k AS (SELECT o_orderkey, o_orderkey % 4 AS r FROM orders)
SELECT o_orderkey, 'm.a.y[b].v' AS path, 'value' AS kind, '1' AS left_value, '2' AS right_value FROM k WHERE r = 1
UNION ALL SELECT o_orderkey, 'm.a', 'value', '7', '8' FROM k WHERE r = 2
UNION ALL SELECT o_orderkey, 'm.a', 'missing_right', '7', NULL FROM k WHERE r = 3
UNION ALL SELECT o_orderkey, 'm.a.`x.z`', 'missing_left', NULL, 'w' FROM k WHERE r = 3""")
def mixed_members(t: Tables) -> DataFrame:
    """Member a is an object in some rows and a number in others: members in another order (0), a nested change (1), another number (2), another type (3)."""
    r = F.col("o_orderkey") % 4
    left = F.when(r <= 1, F.lit('{"m":{"a":{"x":1,"y":[{"k":"a","v":0},{"k":"b","v":1}]}}}')).otherwise(F.lit('{"m":{"a":7}}'))
    right = (
        F.when(r == 0, F.lit('{"m":{"a":{"y":[{"k":"b","v":1},{"v":0,"k":"a"}],"x":1}}}')).when(r == 1, F.lit('{"m":{"a":{"y":[{"k":"b","v":2},{"k":"a","v":0}],"x":1}}}'))
        .when(r == 2, F.lit('{"m":{"a":8}}')).otherwise(F.lit('{"m":{"a":{"x.z":"w"}}}')))
    rules = dc.CompareRules(keyed={"m.a.y": "k"})
    return dc.document_diff(_texts(t, left), _texts(t, right), ["o_orderkey"], "payload", rules)


# --- master maintenance

@query("ms1_parent_upsert", f"""
WITH {MESSAGES_CTE}, tgt AS (SELECT * FROM messages WHERE ts < TIMESTAMP '2024-01-16' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
src AS (SELECT * FROM messages WHERE ts >= TIMESTAMP '2024-01-16' AND event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, coalesce(t.event_id, s.event_id) AS master_id, CASE WHEN s.user_id IS NULL THEN t.value WHEN s.action = 'DELETE' THEN NULL ELSE s.value END AS value,
 coalesce(s.action, t.action) AS action FROM tgt t FULL JOIN src s USING (user_id)""")
def parent_upsert(t: Tables) -> DataFrame:
    m = messages(t).withColumnRenamed("event_id", "master_id")
    order = [F.col("ts").desc(), F.col("master_id").desc()]
    old = latest_per_key(m.filter(F.col("ts") < _at("2024-01-16")), ["user_id"], order)
    batch = m.filter(F.col("ts") >= _at("2024-01-16")).withColumn("action", F.when(F.col("event_type") == "view", "UNBIND").otherwise(F.col("action")))
    out = ms.upsert_parents(old, batch, ["user_id"], "ts", "action", ["value"], keep=["master_id"], tie="master_id")
    return out.select("user_id", "master_id", "value", "action")


_LINES = "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity, l_shipdate FROM {lineitem}"
_ONE_LINE = f"""lines AS (SELECT * FROM ({plain(_LINES)}) QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_suppkey DESC, l_partkey DESC, l_quantity DESC) = 1)"""


def _lines(t: Tables) -> DataFrame:
    order = [F.col(c).desc() for c in ("l_shipdate", "l_suppkey", "l_partkey", "l_quantity")]
    return latest_per_key(t.sql(_LINES), ["l_orderkey", "l_linenumber"], order)


@query("ms2_changed_children", f"""
WITH {_ONE_LINE} SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 0 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, CASE WHEN l_suppkey % 10 = 0 THEN 'new' ELSE 'old' END AS version
FROM lines WHERE l_linenumber <> 1 UNION ALL SELECT l_orderkey, 1, CASE WHEN l_suppkey % 10 = 0 THEN l_quantity + 1 ELSE l_quantity END, 'new' FROM lines WHERE l_linenumber = 1""")
def changed_children(t: Tables) -> DataFrame:
    lines = _lines(t).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    old = lines.filter("l_linenumber <> 1").withColumn("version", F.lit("old"))
    new = lines.withColumn("l_quantity", F.when(F.col("l_suppkey") % 10 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).withColumn("version", F.lit("new"))
    out = ms.replace_changed_children(old, new, ["l_orderkey", "l_linenumber"], ["l_quantity"])
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "version")


@query("ms2_newer_unbind", f"""
WITH {_ONE_LINE} SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 5 = 0 AND l_partkey % 2 = 0 THEN '' ELSE 'S' || l_suppkey END AS address,
 CASE WHEN l_suppkey % 5 = 0 AND l_partkey % 2 = 0 THEN l_shipdate + INTERVAL 1 DAY WHEN l_linenumber = 1 OR l_suppkey % 10 <> 0 THEN l_shipdate ELSE l_shipdate - INTERVAL 9 DAY END AS ts FROM lines""")
def newer_unbind(t: Tables) -> DataFrame:
    """Addresses replaced by a batch; those unbound after the batch row's time become empty, earlier unbindings do nothing."""
    days = lambda n: F.col("l_shipdate") + F.expr(f"INTERVAL {n} DAYS")
    keys, address = ["l_orderkey", "l_linenumber"], F.concat(F.lit("S"), "l_suppkey").alias("address")
    lines = _lines(t)
    batch = lines.select(*keys, address, F.col("l_shipdate").alias("ts"))
    same = F.when(F.col("l_suppkey") % 10 == 0, F.concat(F.lit("S"), "l_suppkey")).otherwise("elsewhere").alias("address")
    old = lines.filter("l_linenumber <> 1").select(*keys, same, days(-9).alias("ts"))
    each = F.when(F.col("l_partkey") % 2 == 0, F.array(days(1), days(-3))).otherwise(F.array(days(-1)))
    unbound = lines.filter("l_suppkey % 5 = 0").select(*keys, F.explode(each).alias("unbound_at"))
    return ms.replace_changed_children(old, batch, keys, ["address"], blank=["address"], ts="ts", unbound=unbound)


@query("ms3_replaced_children", f"""
WITH {_ONE_LINE}, p AS (SELECT DISTINCT l_orderkey FROM lines WHERE l_shipdate >= TIMESTAMP '1998-01-01')
SELECT l_orderkey, l_linenumber, 'old' AS version FROM lines WHERE l_orderkey NOT IN (SELECT l_orderkey FROM p) UNION ALL SELECT l_orderkey, l_linenumber, 'new' FROM lines WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def replaced_children(t: Tables) -> DataFrame:
    lines = _lines(t).select("l_orderkey", "l_linenumber", "l_shipdate")
    new = lines.filter(F.col("l_shipdate") >= _at("1998-01-01")).withColumn("version", F.lit("new"))
    return ms.replace_children(lines.withColumn("version", F.lit("old")), new, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "version")


@query("ms4_children_also_triggered", f"""
WITH {_ONE_LINE} SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 0 OR l_partkey % 7 = 0 THEN 'new' ELSE 'old' END AS version FROM lines""")
def also_triggered(t: Tables) -> DataFrame:
    lines = _lines(t).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity")
    new = lines.withColumn("l_quantity", F.when(F.col("l_suppkey") % 10 == 0, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).withColumn("version", F.lit("new"))
    out = ms.replace_changed_children(lines.withColumn("version", F.lit("old")), new, ["l_orderkey", "l_linenumber"], ["l_quantity"], F.col("l_partkey") % 7 == 0)
    return out.select("l_orderkey", "l_linenumber", "version")


@query("ms5_blank_deleted_children", f"""
WITH {MESSAGES_CTE}, d AS (SELECT user_id, max(ts) AS gone FROM messages WHERE action = 'DELETE' GROUP BY 1)
SELECT o_orderkey, CASE WHEN gone IS NULL THEN o_orderpriority END AS o_orderpriority, coalesce(gone, o_orderdate) AS changed_at FROM orders LEFT JOIN d ON user_id = o_custkey""")
def blank_children(t: Tables) -> DataFrame:
    d = messages(t).filter("action = 'DELETE'").select(F.col("user_id").alias("o_custkey"), F.col("ts").alias("changed_at"))
    o = t.orders.withColumnRenamed("o_orderdate", "changed_at")
    return ms.blank_deleted_children(o, d, ["o_custkey"], ["o_orderpriority"], "changed_at").select("o_orderkey", "o_orderpriority", "changed_at")


@query("ms6_unbind_owners", f"""
WITH {MESSAGES_CTE}, d AS (SELECT event_type, CAST(floor(value) AS BIGINT) AS contact, max(ts) AS gone FROM messages WHERE action = 'DELETE' OR value > 80 GROUP BY 1, 2)
SELECT DISTINCT user_id FROM messages m JOIN d ON d.event_type = m.event_type AND d.contact = CAST(floor(value) AS BIGINT) WHERE gone > ts""")
def unbind_owners(t: Tables) -> DataFrame:
    m = messages(t).withColumn("contact", F.floor("value"))
    _, owners = ms.unbind(m, m.filter("action = 'DELETE' OR value > 80"), ["event_type", "contact"], "ts", ["contact"], "user_id")
    return owners


@query("ms7_touch_sharers", f"""
WITH {KEYED_CTE}, ch AS (SELECT src_id FROM keyed WHERE action = 'CHANGE'), v AS (SELECT DISTINCT phone FROM keyed WHERE phone IS NOT NULL AND src_id IN (SELECT src_id FROM ch))
SELECT src_id, CASE WHEN phone IN (SELECT phone FROM v) AND src_id NOT IN (SELECT src_id FROM ch) AND balance >= 0 THEN 'T2' ELSE 'T1' END AS task_id FROM keyed""")
def touch(t: Tables) -> DataFrame:
    k = keyed(t).withColumn("task_id", F.lit("T1"))
    hit = ms.touch_sharers(k.filter("phone IS NOT NULL").select("src_id", "phone"), k.filter("action = 'CHANGE'").select("src_id"), "src_id", ["phone"], k.filter("balance < 0").select("src_id"))
    return ms.requeue(k, hit, ["src_id"], "task_id", F.lit("T2")).select("src_id", "task_id")


@query("ms8_expired_programs", """
WITH p AS (SELECT o_custkey AS owner, o_orderpriority AS program, max(o_orderdate) AS end_date FROM orders GROUP BY 1, 2), c AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS program FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01')
SELECT owner, program, CASE WHEN owner IN (SELECT owner FROM c) AND (owner, program) NOT IN (SELECT owner, program FROM c) THEN TIMESTAMP '2002-01-01' ELSE end_date END AS end_date FROM p""")
def expired_programs(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("program"), F.col("o_orderdate").alias("end_date"))
    programs = o.groupBy("owner", "program").agg(F.max("end_date").alias("end_date"))
    current = o.filter(F.col("end_date") >= _at("1999-01-01"))
    return ms.expire_vanished(programs, current, ["owner", "program"], ["owner"], "end_date", _at("2002-01-01"))


@query("ms16_reference_data_master", """
WITH st AS (SELECT l_suppkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) SELECT s_suppkey, n_name AS nation, CASE WHEN s_nationkey >= 12 THEN last_ship ELSE coalesce(last_ship, s0) END AS last_ship
FROM (SELECT *, TIMESTAMP '1990-01-01' AS s0 FROM supplier) JOIN nation ON s_nationkey = n_nationkey LEFT JOIN st ON l_suppkey = s_suppkey WHERE last_ship IS NOT NULL OR s_nationkey < 12""")
def reference_master(t: Tables) -> DataFrame:
    stage = t.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), F.col("l_shipdate").alias("last_ship"), "l_orderkey", "l_linenumber").join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey")
    dim = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation"))
    old = t.supplier.filter("s_nationkey < 12").join(dim, "s_nationkey").select("s_suppkey", "nation", _at("1990-01-01").alias("last_ship"))
    return ms.reference_master(old, stage, ["s_suppkey"], [F.col("last_ship").desc()], dim, ["s_nationkey"], [F.col("nation").desc()], ["last_ship", "nation"])


@query("ms17_fill_in_order", """
WITH a AS (SELECT o_custkey AS person, min(o_orderpriority) AS v, 'orders' AS origin FROM orders WHERE o_orderstatus = 'P' GROUP BY 1), b AS (SELECT user_id AS person, min(event_type) AS v, 'events' AS origin FROM events GROUP BY 1),
c AS (SELECT c_custkey AS person, c_mktsegment AS v, 'customer' AS origin FROM customer)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE person NOT IN (SELECT person FROM a) UNION ALL SELECT * FROM c WHERE person NOT IN (SELECT person FROM a) AND person NOT IN (SELECT person FROM b)""")
def fill(t: Tables) -> DataFrame:
    a = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("person")).agg(F.min("o_orderpriority").alias("v")).withColumn("origin", F.lit("orders"))
    b = t.events.groupBy(F.col("user_id").alias("person")).agg(F.min("event_type").alias("v")).withColumn("origin", F.lit("events"))
    c = t.customer.select(F.col("c_custkey").alias("person"), F.col("c_mktsegment").alias("v"), F.lit("customer").alias("origin"))
    return ms.fill_in_order([a, b, c], ["person"])
