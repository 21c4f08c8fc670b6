"""Queries on matching, components and key assignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import codes, text as tx
from goldthread.operators import components as cc, keys as ky, rules as ru
from goldthread.operators.dedup import latest_per_key
from goldthread.operators.merge import merge_two_keys
from goldthread.plans.fixtures import CHAIN, KEYED_CTE, keyed, profiles
from goldthread.plans.registry import Tables, plain, query
from goldthread.session import stage


def _config(*rows) -> list[dict]:
    """Rule rows: match type, category, mode, contact, threshold, review, priority, weights."""
    names = ("match_type", "match_category", "comparison_mode", "secondary_key", "threshold", "requires_review", "priority",
             "weight_component_a", "weight_component_b", "weight_contact")
    return [dict(zip(names, r), enabled=True, deterministic_field_a="source_entity_id", deterministic_field_b="brand_code") for r in rows]


CONFIG = _config(
    ("MT7", "deterministic", "EXACT", None, 1.0, False, 1, 50, 50, None),
    ("MT1", "name_key", "EXACT", "phone", 0.85, False, 2, 25, 25, 50),
    ("MT2", "name_key", "EXACT", "email", 0.85, False, 3, 25, 25, 50),
    ("MT3", "name_key", "EXACT", "city", 0.85, True, 4, 25, 25, 50),
    ("MT4", "full_name_key", "EXACT", "phone", 0.85, False, 5, 50, None, 50),
    ("MT5", "full_name_key", "EXACT", "email", 0.85, False, 6, 50, None, 50),
)
_NAMES = {"market": "market_code", "first": "fn", "last": "ln", "full": "full"}


def _records(t: Tables) -> DataFrame:
    return keyed(t).withColumn("full", F.concat_ws(" ", "fn", "ln"))


def _links(t: Tables, config=CONFIG) -> DataFrame:
    return ru.match_links(_records(t), ru.rules_from_config(config, **_NAMES), "src_id")


# Pair conditions of the two contact rules, and the components they give, as SQL over all pairs.
_CONTACT_PAIRS = f"""WITH RECURSIVE {KEYED_CTE}, pairs AS (
  SELECT a.src_id AS a, b.src_id AS b FROM keyed a JOIN keyed b ON a.market_code = b.market_code AND a.src_id <> b.src_id
   AND least(a.fn, a.ln) = least(b.fn, b.ln) AND greatest(a.fn, a.ln) = greatest(b.fn, b.ln) AND a.fn IS NOT NULL AND a.ln IS NOT NULL
   AND b.fn IS NOT NULL AND b.ln IS NOT NULL AND (a.phone = b.phone OR a.email = b.email)),
reach AS (SELECT src_id AS node, src_id AS other FROM keyed UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.other),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node)"""


def _contact_components(t: Tables) -> DataFrame:
    chosen = [c for c in CONFIG if c["match_type"] in ("MT1", "MT2")]
    links = _links(t, chosen)
    return cc.with_singletons(cc.connected_components(ru.auto_edges(links)), _records(t).select(F.col("src_id").alias("node")))


@query("er7_components_exact", _CONTACT_PAIRS + """
SELECT node AS src_id, root AS component_root, CAST(count(*) OVER (PARTITION BY root) AS BIGINT) AS group_size FROM roots""")
def components_exact(t: Tables) -> DataFrame:
    sized = cc.with_group_size(_contact_components(t))
    return sized.select(F.col("node").alias("src_id"), F.col("root").alias("component_root"), "group_size")


@query("er8_components_chain", f"""
WITH e AS ({plain(CHAIN)}), n AS (SELECT src AS node FROM e UNION SELECT dst FROM e) SELECT node, node - node % 64 AS root FROM n""")
def components_chain(t: Tables) -> DataFrame:
    return cc.connected_components(t.sql(CHAIN))


# Edges of three batches between customers: each batch adds paths of other lengths, and edges between what earlier ones joined.
_GROWING = """
SELECT a.c_custkey AS src, b.c_custkey AS dst, CAST(CASE WHEN b.c_custkey % 3 <> 0 THEN 0 WHEN b.c_custkey % 9 <> 0 THEN 1 ELSE 2 END AS INT) AS batch
FROM {customer} a JOIN {customer} b ON b.c_custkey = a.c_custkey + 1 WHERE b.c_custkey % 45 <> 0
UNION ALL SELECT c_custkey, c_custkey - 90, 2 FROM {customer} WHERE c_custkey % 180 = 135
UNION ALL SELECT c_custkey, c_custkey, 1 FROM {customer} WHERE c_custkey % 45 = 7
"""
_GROWN = f"""
WITH RECURSIVE e AS ({plain(_GROWING)}), cuts AS (SELECT unnest([0, 1, 2])::INT AS upto),
pairs AS (SELECT src, dst, batch FROM e UNION SELECT dst, src, batch FROM e),
nodes AS (SELECT DISTINCT upto, src AS node FROM pairs, cuts WHERE batch <= upto),
reach AS (SELECT upto, node, node AS other FROM nodes UNION SELECT r.upto, r.node, b.dst FROM reach r JOIN pairs b ON b.src = r.other AND b.batch <= r.upto)
SELECT upto AS batch, node, min(other) AS root FROM reach GROUP BY ALL"""


@query("er8_incremental", _GROWN)
def components_grown(t: Tables) -> DataFrame:
    """The components after each of three batches; each batch meets only the roots of the one before."""
    edges, out = stage(t.sql(_GROWING), "growing"), None
    roots = t.spark.createDataFrame([], "node bigint, root bigint")
    for batch in range(3):
        roots = stage(cc.add_edges(roots, edges.filter(F.col("batch") == batch)), "roots")
        now = roots.select(F.lit(batch).alias("batch"), "node", "root")
        out = now if out is None else out.unionByName(now)
    return out


@query("er16_removed_edges", f"""
WITH RECURSIVE e AS ({plain(_GROWING)}), cuts AS (SELECT unnest([0, 1, 2])::INT AS gone),
pairs AS (SELECT src, dst, batch FROM e UNION SELECT dst, src, batch FROM e), nodes AS (SELECT DISTINCT gone, src AS node FROM pairs, cuts),
reach AS (SELECT gone, node, node AS other FROM nodes UNION SELECT r.gone, r.node, b.dst FROM reach r JOIN pairs b ON b.src = r.other AND b.batch < 3 - r.gone)
SELECT gone, node, min(other) AS root FROM reach GROUP BY ALL""")
def components_shrunk(t: Tables) -> DataFrame:
    """All edges, then without the last batch, then without the last two; only components that lost an edge are resolved again."""
    edges, out = stage(t.sql(_GROWING), "growing"), None
    ends = edges.select(F.col("src").alias("node")).union(edges.select("dst"))
    roots = stage(cc.with_singletons(cc.connected_components(edges), ends), "roots")
    for gone in range(3):
        if gone:
            batch = F.col("batch")
            roots = stage(cc.remove_edges(roots, edges.filter(batch < 3 - gone), edges.filter(batch == 3 - gone)), "roots")
        now = roots.select(F.lit(gone).alias("gone"), "node", "root")
        out = now if out is None else out.unionByName(now)
    return out


@query("ag3_component_size", _CONTACT_PAIRS + ", s AS (SELECT root, count(*) AS n FROM roots GROUP BY root) SELECT CAST(n AS BIGINT) AS group_size, count(*) AS groups FROM s GROUP BY n")
def component_size_counts(t: Tables) -> DataFrame:
    return cc.component_sizes(_contact_components(t)).groupBy("group_size").agg(F.count(F.lit(1)).alias("groups"))


def _rule_sql(name: str, priority: int, review: str, key: str, condition: str) -> str:
    return f"""SELECT src_id AS id, min(src_id) OVER (PARTITION BY {key}) AS anchor, '{name}' AS rule, {priority} AS priority,
     100.0::DOUBLE AS score, {review} AS review, count(*) OVER (PARTITION BY {key}) AS n FROM keyed WHERE {condition}"""


_NAME_PAIR = "market_code, least(fn, ln), greatest(fn, ln)"
_HAVE_NAMES = "fn IS NOT NULL AND ln IS NOT NULL"
_LINKS_CTE = f"{KEYED_CTE}, l AS (" + " UNION ALL ".join([
    _rule_sql("MT7", 1, "false", "source_entity_id, brand_code", "true"),
    _rule_sql("MT1", 2, "false", f"{_NAME_PAIR}, phone", f"{_HAVE_NAMES} AND phone IS NOT NULL"),
    _rule_sql("MT2", 3, "false", f"{_NAME_PAIR}, email", f"{_HAVE_NAMES} AND email IS NOT NULL"),
    _rule_sql("MT3", 4, "true", f"{_NAME_PAIR}, city", f"{_HAVE_NAMES} AND city IS NOT NULL"),
    _rule_sql("MT4", 5, "false", f"{_NAME_PAIR}, phone", f"{_HAVE_NAMES} AND phone IS NOT NULL"),
    _rule_sql("MT5", 6, "false", f"{_NAME_PAIR}, email", f"{_HAVE_NAMES} AND email IS NOT NULL"),
]) + "), links AS (SELECT id, anchor, rule, priority, score, review FROM l WHERE n > 1)"


@query("er1_rule_links", f"WITH {_LINKS_CTE} SELECT * FROM links")
def rule_links(t: Tables) -> DataFrame:
    return _links(t).drop("similarity")


@query("er2_accepted_by_threshold", f"""
WITH {_LINKS_CTE} SELECT id, anchor, rule, score FROM links WHERE rule IN ('MT7', 'MT2')""")
def accepted(t: Tables) -> DataFrame:
    weak = _config(
        ("MT7", "deterministic", "EXACT", None, 1.0, False, 1, 50, 50, None),
        ("MT1", "name_key", "EXACT", "phone", 0.85, False, 2, 25, 25, 30),  # 80 of 100: below its threshold
        ("MT2", "name_key", "EXACT", "email", 0.85, False, 3, 25, 25, 50))
    return _links(t, weak).select("id", "anchor", "rule", "score")


@query("er3_review_links", f"WITH {_LINKS_CTE} SELECT id, anchor, rule FROM links WHERE review")
def review_links(t: Tables) -> DataFrame:
    return _links(t).filter("review").select("id", "anchor", "rule")


@query("ag4_edge_labels", f"""
WITH {_LINKS_CTE} SELECT id, anchor, array_to_string(list_sort(list(DISTINCT rule)), ',') AS match_types FROM links GROUP BY id, anchor""")
def edge_labels(t: Tables) -> DataFrame:
    return ru.edge_labels(_links(t))


@query("wn15_best_rule", f"""
WITH {_LINKS_CTE}, p AS (SELECT a.src_id, b.src_id AS other, CASE WHEN a.source_entity_id = b.source_entity_id AND a.brand_code = b.brand_code THEN 1
   WHEN a.phone = b.phone THEN 2 WHEN a.email = b.email THEN 3 END AS p FROM keyed a JOIN keyed b ON a.src_id <> b.src_id
   AND ((a.source_entity_id = b.source_entity_id AND a.brand_code = b.brand_code)
     OR (a.market_code = b.market_code AND least(a.fn, a.ln) = least(b.fn, b.ln) AND greatest(a.fn, a.ln) = greatest(b.fn, b.ln)
         AND (a.phone = b.phone OR a.email = b.email))))
SELECT src_id AS id, CASE min(p) WHEN 1 THEN 'MT7' WHEN 2 THEN 'MT1' ELSE 'MT2' END AS match_type, 100.0::DOUBLE AS confidence_score FROM p GROUP BY src_id""")
def best_rules(t: Tables) -> DataFrame:
    return ru.best_rule(_links(t))


@query("jn10_deterministic_match", f"WITH {_LINKS_CTE} SELECT id, anchor FROM links WHERE rule = 'MT7'")
def deterministic(t: Tables) -> DataFrame:
    return _links(t, CONFIG[:1]).select("id", "anchor")


@query("jn8_name_either_order", f"WITH {_LINKS_CTE} SELECT id, anchor FROM links WHERE rule = 'MT1'")
def either_order(t: Tables) -> DataFrame:
    return _links(t, [CONFIG[1]]).select("id", "anchor")


@query("jn9_full_name_reversed", f"WITH {_LINKS_CTE} SELECT id, anchor FROM links WHERE rule = 'MT5'")
def reversed_name(t: Tables) -> DataFrame:
    return _links(t, [CONFIG[5]]).select("id", "anchor")


# Suppliers and customers with close names: nations are blocks, the digits differ.
_CLOSE = "SELECT c_nationkey AS nation, c_custkey AS id, c_mktsegment || ' ' || CAST(c_custkey % 30 AS STRING) AS label FROM {customer}"


@query("sc10_edit_similar_names", f"""
WITH n AS (SELECT DISTINCT nation, label FROM ({plain(_CLOSE)}))
SELECT a.nation, a.label AS a, b.label AS b FROM n a JOIN n b ON a.nation = b.nation AND a.label < b.label
WHERE 1.0::DOUBLE - levenshtein(a.label, b.label)::DOUBLE / greatest(length(a.label), length(b.label)) >= 0.85""")
def edit_pairs(t: Tables) -> DataFrame:
    from goldthread.operators.similar import edit_similar
    names = t.sql(_CLOSE).select(F.col("nation").alias("block"), F.col("label").alias("text")).distinct()
    return edit_similar(names, 0.85).select(F.col("block").alias("nation"), "a", "b")


_PAIRED = """SELECT c_nationkey AS nation, c_custkey AS id,
  CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE substr(c_mktsegment, 1, 5) || CAST(c_custkey % 3 AS STRING) END AS fn,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'LAST' || CAST(c_custkey % 7 AS STRING) END AS ln FROM {customer}"""


@query("er1_fuzzy_name_links", f"""
WITH n AS (SELECT nation, fn, ln, min(id) AS id FROM ({plain(_PAIRED)}) GROUP BY nation, fn, ln),
p AS (SELECT a.id AS a, b.id AS b, 50 + greatest(25 * jaro_winkler_similarity(a.fn, b.fn) + 25 * jaro_winkler_similarity(a.ln, b.ln),
   25 * jaro_winkler_similarity(a.fn, b.ln) + 25 * jaro_winkler_similarity(a.ln, b.fn)) AS s FROM n a JOIN n b ON a.nation = b.nation AND a.id < b.id)
SELECT a, b, round(s, 6) AS score FROM p WHERE s / 100.0 >= 0.92""")
def fuzzy_links(t: Tables) -> DataFrame:
    rule = ru.NameRule("MT1F", (F.col("nation"),), (F.col("fn"), F.col("ln")), (25, 25), 50, threshold=0.92)
    links = ru.name_links(t.sql(_PAIRED), rule, "id")
    return links.filter("id < anchor").select(F.col("id").alias("a"), F.col("anchor").alias("b"), F.round("score", 6).alias("score"))


@query("er4_person_rules", f"""
WITH {KEYED_CTE}, u AS (SELECT *, concat_ws('_', least(fn, ln), greatest(fn, ln)) AS nk FROM keyed),
r AS (SELECT src_id AS id, min(src_id) OVER w AS anchor, count(*) OVER w AS n, 'FullName_Phone_Match' AS rule FROM u WHERE phone IS NOT NULL WINDOW w AS (PARTITION BY market_code, phone, nk)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'FullName_Email_Match' FROM u WHERE email IS NOT NULL WINDOW w AS (PARTITION BY market_code, email, nk)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'LocalName_Email_Match' FROM u WHERE email IS NOT NULL WINDOW w AS (PARTITION BY market_code, email, fn, ln)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'LocalName_Phone_Match' FROM u WHERE phone IS NOT NULL WINDOW w AS (PARTITION BY market_code, phone, fn, ln)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'ConsumerId_Match' FROM u WINDOW w AS (PARTITION BY market_code, brand_code, source_code, source_entity_id))
SELECT id, anchor, rule FROM r WHERE n > 1""")
def person_rules(t: Tables) -> DataFrame:
    records = keyed(t).withColumns({
        "blocking_class": F.lit("Normal"),
        "name_asc": tx.sorted_name_key([(F.col("fn"), F.col("ln"), F.lit(None).cast("string"))])["asc"],
    })
    spec = ru.PersonRules(contacts={"Email": ("email",), "Phone": ("phone",)}, local=("fn", "ln"),
                          business_id=("brand_code", "source_code", "source_entity_id"))
    return ru.match_links(records, spec.build(), "src_id").select("id", "anchor", "rule")


@query("er5_transaction_rules", f"""
WITH {KEYED_CTE}, u AS (SELECT *, concat_ws('_', least(fn, ln), greatest(fn, ln)) AS nk FROM keyed),
r AS (SELECT src_id AS id, min(src_id) OVER w AS anchor, count(*) OVER w AS n, 'FullName_Email_Phone_Match' AS rule FROM u WHERE phone IS NOT NULL AND email IS NOT NULL WINDOW w AS (PARTITION BY market_code, phone, email, nk)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'LocalName_Email_Phone_Match' FROM u WHERE phone IS NOT NULL AND email IS NOT NULL WINDOW w AS (PARTITION BY market_code, phone, email, fn, ln)
 UNION ALL SELECT src_id, min(src_id) OVER w, count(*) OVER w, 'OrderId_Match' FROM u WINDOW w AS (PARTITION BY market_code, source_entity_id))
SELECT id, anchor, rule FROM r WHERE n > 1""")
def transaction_rules(t: Tables) -> DataFrame:
    records = keyed(t).withColumn("name_asc", tx.sorted_name_key([(F.col("fn"), F.col("ln"), F.lit(None).cast("string"))])["asc"])
    names = ru.PersonRules(blocking=None, contacts={"Email_Phone": ("email", "phone")}, local=("fn", "ln"))
    built = ru.transaction_rules(names, order_key=("source_entity_id",))
    return ru.match_links(records, built, "src_id").select("id", "anchor", "rule")


@query("er6_match_keys", f"WITH {KEYED_CTE} SELECT src_id, fn, ln, phone, email FROM keyed")
def match_keys(t: Tables) -> DataFrame:
    return keyed(t).select("src_id", "fn", "ln", "phone", "email")


# --- batch against master: rows before the split date are the master and carry a key.

_SPLIT = "TIMESTAMP '2024-01-12 00:00:00'"
_MASTER_KEY = "'G' || CAST(CAST(floor(src_id / 4) AS BIGINT) AS STRING)"


def _is_batch() -> F.Column:
    return F.col("source_timestamp") >= F.expr("TIMESTAMP '2024-01-12 00:00:00'")


def _with_master(t: Tables) -> DataFrame:
    key = F.concat(F.lit("G"), F.floor(F.col("src_id") / 4).cast("string"))
    return _records(t).withColumn("is_batch", _is_batch()).withColumn("old_key", F.when(~F.col("is_batch"), key))


_UNIVERSE_CTE = f"""{KEYED_CTE}, universe AS (SELECT *, source_timestamp >= {_SPLIT} AS is_batch,
  CASE WHEN source_timestamp < {_SPLIT} THEN {_MASTER_KEY.replace('STRING', 'VARCHAR')} END AS old_key FROM keyed)"""

_BATCH_ROOTS = f"""WITH RECURSIVE {_UNIVERSE_CTE}, pairs AS (
  SELECT a.src_id AS a, b.src_id AS b FROM universe a JOIN universe b ON a.market_code = b.market_code AND a.src_id <> b.src_id
   AND least(a.fn, a.ln) = least(b.fn, b.ln) AND greatest(a.fn, a.ln) = greatest(b.fn, b.ln) AND (a.phone = b.phone OR a.email = b.email)
   AND (a.is_batch OR b.is_batch)),
reach AS (SELECT src_id AS node, src_id AS other FROM universe UNION SELECT r.node, p.b FROM reach r JOIN pairs p ON p.a = r.other),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
known AS (SELECT root, arg_min(old_key, struct_pack(t := source_timestamp, i := src_id)) AS k FROM roots JOIN universe ON node = src_id WHERE old_key IS NOT NULL GROUP BY root),
assigned AS (SELECT node, root, k, old_key, source_entity_id, market_code, brand_code, is_batch, source_timestamp FROM roots LEFT JOIN known USING (root) JOIN universe ON node = src_id)"""


def _assigned(t: Tables) -> DataFrame:
    records = _with_master(t)
    chosen = ru.rules_from_config([c for c in CONFIG if c["match_type"] in ("MT1", "MT2")], **_NAMES)
    links = ru.match_links(records, chosen, "src_id", batch="is_batch")
    members = cc.with_singletons(cc.connected_components(ru.auto_edges(links)), records.select(F.col("src_id").alias("node")))
    known = records.select(F.col("src_id").alias("node"), "old_key", "source_timestamp")
    return ky.assign_keys(members, known, "old_key", ["source_timestamp", "node"], "RETAIL")


@query("er9_new_vs_existing", _BATCH_ROOTS + """
SELECT node AS src_id, coalesce(k, sha256('RETAIL|' || root)) AS group_key, k IS NULL AS is_new FROM assigned""")
def new_vs_existing(t: Tables) -> DataFrame:
    return _assigned(t).select(F.col("node").alias("src_id"), "group_key", "is_new")


@query("er10_final_assignment", _BATCH_ROOTS + """, b AS (SELECT a.src_id, min(CASE WHEN a.phone = b.phone THEN 2 ELSE 3 END) AS p
 FROM universe a JOIN universe b ON a.market_code = b.market_code AND a.src_id <> b.src_id AND least(a.fn, a.ln) = least(b.fn, b.ln)
  AND greatest(a.fn, a.ln) = greatest(b.fn, b.ln) AND (a.phone = b.phone OR a.email = b.email) AND (a.is_batch OR b.is_batch) GROUP BY a.src_id)
SELECT node AS src_id, k IS NULL AS is_new, CASE p WHEN 2 THEN 'MT1' WHEN 3 THEN 'MT2' ELSE 'NEW' END AS match_type, 100.0::DOUBLE AS confidence_score
FROM assigned LEFT JOIN b ON node = src_id WHERE is_batch""")
def final_assignment(t: Tables) -> DataFrame:
    records = _with_master(t)
    chosen = ru.rules_from_config([c for c in CONFIG if c["match_type"] in ("MT1", "MT2")], **_NAMES)
    best = ru.best_rule(ru.match_links(records, chosen, "src_id", batch="is_batch"))
    done = ky.final_assignment(_assigned(t), best).withColumnRenamed("node", "src_id")
    fresh = records.filter("is_batch").select("src_id")
    return done.join(fresh, "src_id", "left_semi").select("src_id", "is_new", "match_type", "confidence_score")


@query("wn14_earliest_master_key", _BATCH_ROOTS + "SELECT root, k AS old_key FROM known")
def earliest_key(t: Tables) -> DataFrame:
    known = _with_master(t).filter("old_key IS NOT NULL").select(F.col("src_id").alias("node"), "old_key", "source_timestamp")
    joined = _assigned(t).select("node", "root").join(known, "node")
    return joined.groupBy("root").agg(F.min_by("old_key", F.struct(*ky.earliest_first("node", "source_timestamp")[:1], "source_timestamp", "node")).alias("old_key"))


@query("wn14_history_first", """
WITH n AS (SELECT o_custkey AS root, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR ELSE lpad(o_orderkey::VARCHAR, 40, '0') END AS node, o_orderdate AS created,
 CASE WHEN o_orderkey % 5 <> 0 THEN 'K' || o_orderkey END AS k FROM orders),
f AS (SELECT root, k, row_number() OVER (PARTITION BY root ORDER BY length(node) >= 36, CASE WHEN length(node) >= 36 THEN created END NULLS FIRST, node) AS r FROM n WHERE k IS NOT NULL)
SELECT node, n.root, coalesce(f.k, sha256('H|' || n.root)) AS group_key, f.k IS NULL AS is_new FROM n LEFT JOIN f ON f.root = n.root AND r = 1""")
def history_first(t: Tables) -> DataFrame:
    """Keys of first-load records (short ids) before all others, then the earliest created; all terms of the order count."""
    key = F.col("o_orderkey")
    node = F.when(key % 3 == 0, key.cast("string")).otherwise(F.lpad(key.cast("string"), 40, "0"))
    rows = t.orders.select(F.col("o_custkey").alias("root"), node.alias("node"), F.col("o_orderdate").alias("created"),
                           F.when(key % 5 != 0, F.concat(F.lit("K"), key)).alias("k"))
    known = rows.filter("k IS NOT NULL").select("node", "k", "created")
    return ky.assign_keys(rows.select("node", "root"), known, "k", ky.earliest_first("node", "created"), "H")


@query("er11_master_in_scope", f"""
WITH {_UNIVERSE_CTE} SELECT m.src_id FROM universe m WHERE NOT m.is_batch AND (m.phone IN (SELECT phone FROM universe WHERE is_batch AND phone IS NOT NULL)
 OR m.email IN (SELECT email FROM universe WHERE is_batch AND email IS NOT NULL) OR m.source_entity_id IN (SELECT source_entity_id FROM universe WHERE is_batch))""")
def master_scope(t: Tables) -> DataFrame:
    u = _with_master(t)
    return ru.scope_master(u.filter("NOT is_batch"), u.filter("is_batch"), ["phone", "email", "source_entity_id"], "src_id").select("src_id")


@query("jn16_candidate_paths", f"""
WITH {_UNIVERSE_CTE}, b AS (SELECT * FROM universe WHERE is_batch), m AS (SELECT * FROM universe WHERE NOT is_batch)
SELECT m.src_id, 'phone' AS path FROM m WHERE phone IN (SELECT phone FROM b WHERE phone IS NOT NULL)
UNION SELECT m.src_id, 'email' FROM m WHERE email IN (SELECT email FROM b WHERE email IS NOT NULL)
UNION SELECT m.src_id, 'id' FROM m WHERE source_entity_id IN (SELECT source_entity_id FROM b)""")
def candidate_paths(t: Tables) -> DataFrame:
    u = _with_master(t)
    m, b = u.filter("NOT is_batch"), u.filter("is_batch")
    parts = [ru.scope_master(m, b, [k], "src_id").select("src_id", F.lit(p).alias("path")) for k, p in (("phone", "phone"), ("email", "email"), ("source_entity_id", "id"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_ENTITY = "SELECT source_entity_id, brand_code FROM assigned"


@query("er12_key_conflicts", _BATCH_ROOTS + """, a AS (SELECT node, old_key, source_entity_id, root FROM assigned),
o AS (SELECT old_key FROM a WHERE old_key IS NOT NULL GROUP BY old_key HAVING count(DISTINCT root) > 1),
e AS (SELECT source_entity_id FROM a GROUP BY source_entity_id HAVING count(DISTINCT root) > 1)
SELECT node AS src_id, old_key IS NOT NULL AND old_key IN (SELECT old_key FROM o) AS key_conflict, source_entity_id IN (SELECT source_entity_id FROM e) AS id_conflict FROM a""")
def key_conflicts(t: Tables) -> DataFrame:
    a = _assigned(t).select(F.col("node").alias("src_id"), "root").join(_with_master(t).select("src_id", "old_key", "source_entity_id"), "src_id")
    flagged = ky.flag_conflicts(a, "root", {"key_conflict": ["old_key"], "id_conflict": ["source_entity_id"]}, ["src_id"])
    return flagged.select("src_id", "key_conflict", "id_conflict")


@query("er12_quarantined", _BATCH_ROOTS + """, e AS (SELECT source_entity_id FROM assigned GROUP BY source_entity_id HAVING count(DISTINCT root) > 1)
SELECT node AS src_id, source_entity_id NOT IN (SELECT source_entity_id FROM e) OR NOT is_batch AS is_include,
  CASE WHEN is_batch AND source_entity_id IN (SELECT source_entity_id FROM e) THEN 'ExcludeByCidDuplicate' END AS exclude_type FROM assigned""")
def quarantined(t: Tables) -> DataFrame:
    records = _with_master(t)
    a = _assigned(t).select(F.col("node").alias("src_id"), "root").join(records.select("src_id", "source_entity_id", "is_batch"), "src_id")
    _, bad = ky.quarantine(ky.flag_conflicts(a, "root", {"id_conflict": ["source_entity_id"]}, ["src_id"]), ["id_conflict"])
    base = records.select("src_id", F.lit(True).alias("is_include"), F.lit(None).cast("string").alias("exclude_type"))
    return ky.mark_excluded(base, bad.filter("is_batch"), ["src_id"], codes.CID_DUPLICATE)


@query("er13_attach_special_source", f"""
WITH {_UNIVERSE_CTE}, k AS (SELECT src_id, source_entity_id, market_code, city, email, brand_code, old_key, source_timestamp FROM universe),
s AS (SELECT * FROM k WHERE old_key IS NULL), m AS (SELECT * FROM k WHERE old_key IS NOT NULL),
l1 AS (SELECT source_entity_id, arg_max(old_key, struct_pack(t := source_timestamp, i := src_id)) AS v FROM m GROUP BY 1),
l2 AS (SELECT email, arg_max(old_key, struct_pack(t := source_timestamp, i := src_id)) AS v FROM m WHERE email IS NOT NULL GROUP BY 1),
l3 AS (SELECT market_code, brand_code, city, arg_max(old_key, struct_pack(t := source_timestamp, i := src_id)) AS v FROM m GROUP BY 1, 2, 3)
SELECT s.src_id, coalesce(l1.v, l2.v, l3.v) AS attached_key FROM s LEFT JOIN l1 USING (source_entity_id) LEFT JOIN l2 USING (email) LEFT JOIN l3 USING (market_code, brand_code, city)""")
def attach(t: Tables) -> DataFrame:
    u = _with_master(t).select("src_id", "source_entity_id", "market_code", "brand_code", "city", "email", "old_key", "source_timestamp")
    special, master = u.filter("old_key IS NULL").drop("old_key"), u.filter("old_key IS NOT NULL")
    newest = [F.col("source_timestamp").desc(), F.col("src_id").desc()]
    lookups = [(master, ["source_entity_id"], newest), (master.filter("email IS NOT NULL"), ["email"], newest), (master, ["market_code", "brand_code", "city"], newest)]
    return ky.attach_by_lookup(special, lookups, "old_key").select("src_id", "attached_key")


@query("jn13_other_source_same_id", f"""
WITH {KEYED_CTE} SELECT a.src_id, arg_max(b.src_id, struct_pack(t := b.source_timestamp, i := b.src_id)) AS other_id
FROM keyed a JOIN keyed b ON a.source_entity_id = b.source_entity_id AND a.source_code <> b.source_code GROUP BY a.src_id""")
def other_source(t: Tables) -> DataFrame:
    k = keyed(t).select("src_id", "source_entity_id", "source_code", "source_timestamp")
    newest = latest_per_key(k, ["source_entity_id", "source_code"], [F.col("source_timestamp").desc(), F.col("src_id").desc()])
    b = newest.select("source_entity_id", F.col("source_code").alias("c"), F.col("src_id").alias("o"), F.col("source_timestamp").alias("s"))
    joined = k.join(b, "source_entity_id").filter("c <> source_code")
    return joined.groupBy("src_id").agg(F.max_by("o", F.struct("s", "o")).alias("other_id"))


@query("er14_rebind_orphans", f"""
WITH {_UNIVERSE_CTE}, owners AS (SELECT email, arg_max(old_key, struct_pack(t := source_timestamp, i := src_id)) AS old_key FROM universe WHERE old_key IS NOT NULL AND email IS NOT NULL GROUP BY email)
SELECT u.src_id, o.old_key FROM universe u JOIN owners o USING (email) WHERE u.old_key IS NULL""")
def rebind(t: Tables) -> DataFrame:
    u = _with_master(t)
    owners = u.filter("old_key IS NOT NULL AND email IS NOT NULL").select("email", "old_key", "source_timestamp", "src_id")
    newest = [F.col("source_timestamp").desc(), F.col("src_id").desc()]
    return ky.rebind_orphans(u.select("src_id", "email", "old_key"), owners, ["email"], "old_key", newest).select("src_id", "old_key")


@query("er15_rekey_propagation", _BATCH_ROOTS + """, moved AS (SELECT old_key, arg_min(k, node) AS new_key FROM assigned WHERE old_key <> k GROUP BY old_key),
tx AS (SELECT o_orderkey, 'G' || CAST(floor(o_custkey / 4) AS BIGINT)::VARCHAR AS old_key FROM orders)
SELECT o_orderkey, coalesce(new_key, old_key) AS owner_key FROM tx LEFT JOIN moved USING (old_key)""")
def rekey(t: Tables) -> DataFrame:
    a = _assigned(t).join(_with_master(t).select(F.col("src_id").alias("node"), "old_key"), "node")
    moves = ky.key_changes(a, "old_key", "group_key", [F.col("node")])
    transactions = t.orders.select("o_orderkey", F.concat(F.lit("G"), F.floor(F.col("o_custkey") / 4).cast("string")).alias("owner_key"))
    return ky.repoint(transactions, "owner_key", moves)


@query("snk11_merge_two_keys", """
WITH a AS (SELECT n_nationkey AS c_nationkey, 'N' || n_nationkey AS tag FROM nation WHERE n_regionkey = 1),
b AS (SELECT DISTINCT c_mktsegment, 'S' || c_mktsegment AS tag FROM customer WHERE c_mktsegment LIKE 'M%')
SELECT c_custkey, coalesce(a.tag, b.tag, c_name) AS tag FROM customer LEFT JOIN a USING (c_nationkey) LEFT JOIN b USING (c_mktsegment)""")
def two_keys(t: Tables) -> DataFrame:
    target = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_name").alias("tag"))
    a = t.nation.filter("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("N"), "n_nationkey").alias("tag"))
    b = t.customer.filter("c_mktsegment LIKE 'M%'").select("c_mktsegment").distinct().withColumn("tag", F.concat(F.lit("S"), "c_mktsegment"))
    return merge_two_keys(target, a, ["c_nationkey"], b, ["c_mktsegment"], "tag").select("c_custkey", "tag")


@query("er16_split_entity", f"""
WITH {_LINKS_CTE}, e AS (SELECT src_id, min(src_id) OVER (PARTITION BY market_code, least(fn, ln), greatest(fn, ln), email) AS root FROM keyed WHERE email IS NOT NULL AND {_HAVE_NAMES})
SELECT k.src_id, coalesce(e.root, k.src_id) AS root FROM keyed k LEFT JOIN e USING (src_id)""")
def split(t: Tables) -> DataFrame:
    """Resolve all members again by the e-mail rule only."""
    links = _links(t, [CONFIG[2]])
    members = cc.with_singletons(cc.connected_components(ru.auto_edges(links)), _records(t).select(F.col("src_id").alias("node")))
    return ky.check_no_empty(members, "root").select(F.col("node").alias("src_id"), "root")


_FIXES = """SELECT DISTINCT CAST(o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE 100000000 END AS BIGINT) AS c_custkey, 'FIXED' AS c_name
FROM {orders} WHERE o_orderstatus = 'F'"""


@query("er17_manual_correction", f"""
WITH f AS ({plain(_FIXES)}) SELECT c_custkey, coalesce(f.c_name, c.c_name) AS c_name, 'table' AS part FROM customer c LEFT JOIN f USING (c_custkey)
UNION ALL SELECT c_custkey, f.c_name, 'unmatched' FROM f WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def manual(t: Tables) -> DataFrame:
    fixed, refused = ky.correct_keys(t.customer.select("c_custkey", "c_name"), t.sql(_FIXES), ["c_custkey"], "c_name")
    return fixed.withColumn("part", F.lit("table")).unionByName(refused.withColumnRenamed("reason", "part"))


_CLASHES = """SELECT DISTINCT o_custkey AS c_custkey, CASE WHEN o_orderpriority = '5-LOW' THEN ' ' WHEN o_orderpriority = '1-URGENT' THEN 'A' ELSE 'B' END AS c_name
FROM {orders} WHERE o_orderpriority < '3' OR o_orderpriority = '5-LOW'"""


@query("er17_clashing_corrections", f"""
WITH f AS ({plain(_CLASHES)}), g AS (SELECT * FROM f WHERE c_name <> ' '), n AS (SELECT c_custkey, count(*) AS n FROM g GROUP BY 1), ok AS (SELECT g.* FROM g JOIN n USING (c_custkey) WHERE n = 1)
SELECT c_custkey, coalesce(ok.c_name, c.c_name) AS c_name, 'table' AS part FROM customer c LEFT JOIN ok USING (c_custkey)
UNION ALL SELECT *, 'blank' FROM f WHERE c_name = ' ' UNION ALL SELECT g.*, 'clash' FROM g JOIN n USING (c_custkey) WHERE n > 1
UNION ALL SELECT *, 'unmatched' FROM ok WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)""")
def clashing(t: Tables) -> DataFrame:
    fixed, refused = ky.correct_keys(t.customer.select("c_custkey", "c_name"), t.sql(_CLASHES), ["c_custkey"], "c_name")
    return fixed.withColumn("part", F.lit("table")).unionByName(refused.withColumnRenamed("reason", "part"))


@query("er15_key_chain", """
SELECT o_orderkey, CASE WHEN o_custkey % 7 = 0 THEN o_custkey ELSE o_custkey - o_custkey % 7 END AS owner_key FROM orders""")
def key_chain(t: Tables) -> DataFrame:
    """Runs 1 to 6: the keys with that remainder, from 6 down, move to the one below: chains of up to six steps."""
    moves = t.orders.select(F.col("o_custkey").alias("c")).distinct()
    steps = moves.withColumn("old_key", F.explode(F.sequence(F.col("c") - F.col("c") % 7, F.col("c")))).filter("old_key % 7 <> 0")
    runs = steps.select((7 - F.col("old_key") % 7).alias("run"), "old_key", (F.col("old_key") - 1).alias("new_key")).distinct()
    return ky.repoint(t.orders.select("o_orderkey", F.col("o_custkey").alias("owner_key")), "owner_key", ky.final_keys(runs))


@query("er15_swap", """
SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_custkey + 1 ELSE o_custkey - 1 END AS owner_key FROM orders""")
def key_swap(t: Tables) -> DataFrame:
    """One run in which each even key and the next odd one change places."""
    other = F.col("o_custkey") + F.when(F.col("o_custkey") % 2 == 0, 1).otherwise(-1)
    swaps = t.orders.select(F.col("o_custkey").alias("old_key"), other.alias("new_key"))
    return ky.repoint(t.orders.select("o_orderkey", F.col("o_custkey").alias("owner_key")), "owner_key", swaps)


_RUNS = """SELECT DISTINCT CAST(o_custkey % 3 AS INT) AS run, o_custkey AS old_key, o_custkey + CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 3 END AS new_key FROM {orders}"""


@query("er15_simultaneous", f"""
WITH RECURSIVE m AS ({plain(_RUNS)}), walk AS (
  SELECT o_orderkey, o_custkey AS owner_key, -1 AS done FROM orders
  UNION ALL SELECT o_orderkey, coalesce(m.new_key, owner_key), done + 1 FROM walk LEFT JOIN m ON m.old_key = owner_key AND m.run = done + 1 WHERE done < 2)
SELECT o_orderkey, owner_key FROM walk WHERE done = 2""")
def key_runs(t: Tables) -> DataFrame:
    """Three runs: a move into a key that the same or an earlier run re-keys ends there, a later run moves it on."""
    return ky.repoint(t.orders.select("o_orderkey", F.col("o_custkey").alias("owner_key")), "owner_key", ky.final_keys(t.sql(_RUNS)))


_PROGRAMS = "SELECT o_custkey AS owner, o_orderpriority AS program, o_orderdate FROM {orders}"


@query("er18_membership_mapping", f"""
WITH p AS ({plain(_PROGRAMS)}), cur AS (SELECT DISTINCT owner, program FROM p WHERE o_orderdate >= TIMESTAMP '1999-01-01'),
prev AS (SELECT DISTINCT owner, program FROM p WHERE o_orderdate < TIMESTAMP '1999-01-01'), del AS (SELECT c_custkey AS owner FROM customer WHERE c_acctbal < 0)
SELECT owner, program, 'CREATE' AS mapping_action FROM cur WHERE owner NOT IN (SELECT owner FROM del)
UNION ALL SELECT owner, program, 'DELETE' FROM prev WHERE owner NOT IN (SELECT owner FROM del) AND owner IN (SELECT owner FROM cur) AND (owner, program) NOT IN (SELECT owner, program FROM cur)
UNION ALL SELECT owner, program, 'DELETE' FROM prev WHERE owner IN (SELECT owner FROM del)""")
def membership(t: Tables) -> DataFrame:
    p = t.sql(_PROGRAMS)
    split = F.expr("TIMESTAMP_NTZ '1999-01-01'")
    gone = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("owner"))
    return ky.membership_mapping(p.filter(F.col("o_orderdate") >= split), p.filter(F.col("o_orderdate") < split), gone, ["owner"], ["program"])


@query("er19_transaction_reemit", """
SELECT o_orderkey, o_custkey AS owner, round(o_totalprice, 2) AS total FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def reemit(t: Tables) -> DataFrame:
    from goldthread.functions import jsonfn
    touched = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    body = jsonfn.document(F.struct(F.col("o_orderkey").alias("Id"), F.struct(F.col("o_custkey").alias("Owner"), F.col("o_totalprice").alias("Total")).alias("Order")))
    out = ky.reemit_touched(t.orders, touched, ["o_custkey"], body)
    d = F.col("document")
    return out.select("o_orderkey", jsonfn.node(d, "Order", "Owner").cast("bigint").alias("owner"), F.round(jsonfn.node(d, "Order", "Total").cast("double"), 2).alias("total"))


@query("ag1_contact_pivot", """
WITH l AS (SELECT o_custkey AS id, o_orderpriority AS phone_match_key, o_orderstatus = 'F' AS is_primary, o_totalprice > 50000 AS valid_contact FROM orders)
SELECT c_custkey AS id, coalesce(max(phone_match_key) FILTER (valid_contact AND is_primary), max(phone_match_key) FILTER (valid_contact)) AS phone_match_key, bool_or(valid_contact) AS valid_phone,
 max(phone_match_key) FILTER (valid_contact) AS email_match_key FROM customer LEFT JOIN l ON c_custkey = id GROUP BY c_custkey""")
def contact_pivot(t: Tables) -> DataFrame:
    c = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("phone_match_key"),
                        (F.col("o_orderstatus") == "F").alias("is_primary"), (F.col("o_totalprice") > 50000).alias("valid_contact"))
    emails = c.withColumnRenamed("phone_match_key", "email_match_key")
    return ru.contact_candidates(t.customer.select(F.col("c_custkey").alias("id")), c, emails).drop("valid_email")


@query("jn4_exclusion_lists", """
SELECT c_custkey FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 3) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice > 450000)""")
def exclusion(t: Tables) -> DataFrame:
    nations = t.nation.filter("n_regionkey = 3").select(F.col("n_nationkey").alias("c_nationkey"))
    rejects = t.orders.filter("o_orderstatus = 'P' AND o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return ru.exclude_keys(t.customer, (nations, ["c_nationkey"]), (rejects, ["c_custkey"])).select("c_custkey")
