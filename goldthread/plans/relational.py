"""Queries on joins, aggregates, windows, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from goldthread.functions import text as tx
from goldthread.operators import dedup as dd, ordering as od, quality as dq, sketches as sk, survive as sv
from goldthread.operators.asof import as_of_join
from goldthread.operators.skew import with_group_values
from goldthread.plans.fixtures import KEYED_CTE, MESSAGES_CTE, PROFILES_CTE, keyed, messages, profiles
from goldthread.plans.registry import Tables, query
from goldthread.session import stage

_MONEY = "CAST(sum(CAST({c} AS DECIMAL(18, 2))) AS DOUBLE)"


def _money(c: str) -> F.Column:
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


# --- joins

@query("jn1_composite_equi_join", """
WITH s AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') SELECT l.l_orderkey, l.l_suppkey, count(*) AS lines
FROM lineitem l JOIN s ON l.l_orderkey = s.l_orderkey AND l.l_suppkey = s.l_suppkey GROUP BY ALL""")
def composite_join(t: Tables) -> DataFrame:
    s = t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey", "l_suppkey").distinct()
    return t.lineitem.join(s, ["l_orderkey", "l_suppkey"]).groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("lines"))


@query("jn2_contacts_without_fanout", """
SELECT c_custkey AS id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS events FROM customer""")
def no_fanout(t: Tables) -> DataFrame:
    """Two 1:N tables per record, each reduced before its join."""
    o = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.count(F.lit(1)).alias("orders"))
    e = t.events.groupBy(F.col("user_id").alias("id")).agg(F.count(F.lit(1)).alias("events"))
    out = t.customer.select(F.col("c_custkey").alias("id")).join(o, "id", "left").join(e, "id", "left")
    return out.na.fill(0, ["orders", "events"])


@query("jn3_semi_prefilter", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi(t: Tables) -> DataFrame:
    keys = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(keys, "o_custkey", "left_semi").select("o_orderkey")


@query("jn5_missing_in_right", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing(t: Tables) -> DataFrame:
    placed = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.join(placed, "c_custkey", "left_anti").select("c_custkey")


@query("jn6_star_self_join", f"""
WITH {KEYED_CTE}, g AS (SELECT market_code, phone, min(src_id) AS anchor FROM keyed WHERE phone IS NOT NULL GROUP BY 1, 2)
SELECT src_id AS dst, anchor AS src FROM keyed JOIN g USING (market_code, phone) WHERE src_id > anchor""")
def star_self_join(t: Tables) -> DataFrame:
    from goldthread.operators.rules import ExactRule, exact_links
    rule = ExactRule("phone", (F.col("market_code"), F.col("phone")))
    return exact_links(keyed(t), [rule], "src_id").filter("id <> anchor").select(F.col("anchor").alias("src"), F.col("id").alias("dst"))


@query("jn7_or_of_rules", f"""
WITH {KEYED_CTE}, p AS (SELECT a.src_id FROM keyed a JOIN keyed b ON a.src_id <> b.src_id AND a.market_code = b.market_code
  AND (a.phone = b.phone OR a.email = b.email OR a.source_entity_id = b.source_entity_id)) SELECT DISTINCT src_id FROM p""")
def or_of_rules(t: Tables) -> DataFrame:
    """Records that match any other record by any of three rules: one pass, no OR join."""
    from goldthread.operators.rules import ExactRule, exact_links
    rules = [ExactRule(c, (F.col("market_code"), F.col(c))) for c in ("phone", "email", "source_entity_id")]
    return exact_links(keyed(t), rules, "src_id").select(F.col("id").alias("src_id")).distinct()


@query("jn11_date_bounded_override", """
WITH c AS (SELECT o_custkey, max(o_orderdate) AS camp FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderdate <= camp THEN camp ELSE o_orderdate END AS effective FROM orders LEFT JOIN c USING (o_custkey)""")
def bounded_override(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", F.lit("q").alias("quality"), F.col("o_orderdate").alias("optin_date"), F.lit(1).alias("optin_flag"))
    campaign = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        "o_custkey", F.lit("c").alias("quality"), F.col("o_orderdate").alias("optin_date"), F.lit(1).alias("optin_flag"))
    return sv.campaign_override(o, campaign, ["o_custkey"]).select("o_orderkey", F.col("optin_date").alias("effective"))


@query("jn12_newer_unbind", f"""
WITH {MESSAGES_CTE}, u AS (SELECT user_id, max(ts) AS gone FROM messages WHERE action = 'DELETE' GROUP BY 1)
SELECT event_id, CASE WHEN gone > ts THEN NULL ELSE value END AS value FROM messages LEFT JOIN u USING (user_id) WHERE action <> 'DELETE'""")
def newer_unbind(t: Tables) -> DataFrame:
    from goldthread.operators.master import unbind
    m = messages(t)
    after, _ = unbind(m.filter("action <> 'DELETE'"), m.filter("action = 'DELETE'"), ["user_id"], "ts", ["value"], "user_id")
    return after.select("event_id", "value")


@query("jn15_unknown_join_key", f"""
WITH {KEYED_CTE}, s AS (SELECT coalesce(email, 'UNKNOWN') AS e, market_code, count(*) AS n FROM keyed GROUP BY 1, 2)
SELECT src_id, n FROM keyed k JOIN s ON coalesce(k.email, 'UNKNOWN') = s.e AND k.market_code = s.market_code""")
def unknown_key(t: Tables) -> DataFrame:
    """A null value is a group of its own."""
    out = with_group_values(keyed(t).select("src_id", "email", "market_code"), ["email", "market_code"], ["src_id"], n=F.count(F.lit(1)))
    return out.select("src_id", "n")


_SHARED = "CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END"


@query("jn17_value_at_time", f"""
WITH e AS (SELECT {_SHARED} AS k, event_id, ts, event_type = 'signup' AS is_value FROM events),
u AS (SELECT *, last_value(CASE WHEN is_value THEN event_id END IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts, is_value DESC, event_id ROWS UNBOUNDED PRECEDING) AS before,
 last_value(CASE WHEN is_value THEN event_id END IGNORE NULLS) OVER (PARTITION BY k ORDER BY ts DESC, is_value DESC, event_id ROWS UNBOUNDED PRECEDING) AS after FROM e)
SELECT event_id, before AS last_signup, after AS next_signup FROM u WHERE NOT is_value""")
def value_at_time(t: Tables) -> DataFrame:
    """For each event the last sign-up of its key until then and the next one; a third of the rows have one key."""
    e = t.events.select("event_id", "ts", "event_type", F.expr(_SHARED).alias("k"))
    signups = e.filter("event_type = 'signup'").select("k", F.col("ts").alias("since"), "event_id")
    out = as_of_join(e.filter("event_type <> 'signup'"), signups, ["k"], "ts", "since", {"last_signup": "event_id"}, ties=["event_id"])
    out = as_of_join(out, signups, ["k"], "ts", "since", {"next_signup": "event_id"}, forward=True, ties=["event_id"])
    return out.select("event_id", "last_signup", "next_signup")


@query("jn17_dimension_enrichment", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def enrichment(t: Tables) -> DataFrame:
    dims = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))  # Spark broadcasts by measured size
    newest = dd.latest_per_key(dims, ["n_nationkey"], [F.col("r_regionkey").desc()])
    return t.customer.join(newest, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", "n_name", "r_name")


@query("jn18_set_equality", """
WITH a AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS p FROM orders WHERE o_orderstatus <> 'F'),
s AS (SELECT owner, list_sort(list(p)) AS l FROM a GROUP BY 1), r AS (SELECT owner, list_sort(list(p)) AS l FROM b GROUP BY 1)
SELECT owner, s.l = coalesce(r.l, []) AS is_equal, list_has_all(s.l, coalesce(r.l, [])) AS left_contains_right, list_has_all(coalesce(r.l, []), s.l) AS right_contains_left FROM s LEFT JOIN r USING (owner)""")
def set_equality(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import same_members
    o = t.orders.select(F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("p"), "o_orderstatus")
    return same_members(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'"), ["owner"], ["p"])


@query("jn19_fallback_lookup", """
SELECT c_custkey, 'orders' AS found_in FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL
SELECT c_custkey, 'events' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) AND c_custkey IN (SELECT user_id FROM events)""")
def fallback_lookup(t: Tables) -> DataFrame:
    from goldthread.operators.sharing import lookup_with_fallback
    first = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("found_in", F.lit("orders"))
    second = t.events.select(F.col("user_id").alias("c_custkey")).distinct().withColumn("found_in", F.lit("events"))
    return lookup_with_fallback(t.customer.select("c_custkey"), first, second, ["c_custkey"])


@query("jn20_list_combinations", """
WITH p AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS p FROM orders), s AS (SELECT DISTINCT o_custkey AS owner, o_orderstatus AS s FROM orders),
e AS (SELECT DISTINCT user_id AS owner, event_type AS e FROM events) SELECT owner, p, s, e FROM p JOIN s USING (owner) JOIN e USING (owner)""")
def combinations(t: Tables) -> DataFrame:
    from goldthread.operators.master import combine_lists
    p = t.orders.select(F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("p")).distinct()
    s = t.orders.select(F.col("o_custkey").alias("owner"), F.col("o_orderstatus").alias("s")).distinct()
    e = t.events.select(F.col("user_id").alias("owner"), F.col("event_type").alias("e")).distinct()
    return combine_lists(["owner"], {"p": p, "s": s, "e": e})


# --- aggregates

@query("ag2_counts_and_ratios", f"""
WITH {KEYED_CTE} SELECT market_code, count(*) AS total, count(DISTINCT fn) AS names, count(*) - count(phone) AS no_phone,
 round(100.0::DOUBLE * count(email) / count(*), 4) AS email_share FROM keyed GROUP BY market_code""")
def counts(t: Tables) -> DataFrame:
    return keyed(t).groupBy("market_code").agg(
        F.count(F.lit(1)).alias("total"), F.countDistinct("fn").alias("names"), F.count(F.when(F.col("phone").isNull(), 1)).alias("no_phone"),
        F.round(100.0 * F.count("email") / F.count(F.lit(1)), 4).alias("email_share"))


@query("ag7_max_over_sources", """
SELECT id, max(seen) AS last_seen FROM (SELECT o_custkey AS id, o_orderdate AS seen FROM orders UNION ALL SELECT user_id, ts FROM events) GROUP BY id""")
def max_over_sources(t: Tables) -> DataFrame:
    o = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("at"))
    e = t.events.select(F.col("user_id").alias("id"), F.col("ts").alias("at"))
    return sv.max_over_sources([(o, "at"), (e, "at")], ["id"], "last_seen")


@query("ag8_group_action", f"""
WITH {MESSAGES_CTE} SELECT user_id, event_type, CASE WHEN bool_and(action = 'DELETE') THEN 'DELETE' ELSE 'CREATE' END AS action FROM messages GROUP BY ALL""")
def group_action(t: Tables) -> DataFrame:
    return messages(t).groupBy("user_id", "event_type").agg(sv.group_action(F.col("action")).alias("action"))


@query("ag9_expired_latest", """
SELECT o_custkey, max(o_orderdate) AS last_time FROM orders GROUP BY 1 HAVING max(o_orderdate) < TIMESTAMP '2001-01-01' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)""")
def expired(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import expired_keys
    master = t.customer.filter("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return expired_keys(t.orders, master, ["o_custkey"], "o_orderdate", F.expr("TIMESTAMP_NTZ '2001-01-01'"))


@query("ag10_hourly_pivot", "SELECT event_type, " + ", ".join(f"count(*) FILTER (hour(ts) = {h}) AS h{h:02d}" for h in range(24)) + ", count(*) AS total FROM events GROUP BY event_type")
def hourly_pivot(t: Tables) -> DataFrame:
    return dq.hourly_volume(t.events, ["event_type"], "ts")


@query("ag11_groups_above", "SELECT o_custkey, count(*) AS rows FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def groups_above(t: Tables) -> DataFrame:
    return sv.oversized_keys(t.orders, ["o_custkey"], 15)


@query("ag12_score_histogram", "SELECT CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS bucket, count(*) AS n FROM customer GROUP BY 1")
def histogram(t: Tables) -> DataFrame:
    return dq.histogram(t.customer, "c_acctbal", 1000)


@query("ag13_null_profile", f"""
WITH {KEYED_CTE}, c AS (SELECT count(*) AS n, count(fn) AS a, count(ln) AS b, count(phone) AS p, count(email) AS e FROM keyed)
SELECT unnest(['fn', 'ln', 'phone', 'email']) AS column_name, n AS total_rows, unnest([a, b, p, e]) AS filled FROM c""")
def null_profile(t: Tables) -> DataFrame:
    return dq.fill_profile(keyed(t), ["fn", "ln", "phone", "email"]).select("column_name", "total_rows", "filled")


@query("ag14_count_reconciliation", """
SELECT n_nationkey AS key, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS left_rows, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS right_rows,
 (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) = (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS is_equal FROM nation
 WHERE n_nationkey IN (SELECT c_nationkey FROM customer) OR n_nationkey IN (SELECT s_nationkey FROM supplier)""")
def reconciliation(t: Tables) -> DataFrame:
    return dq.compare_counts(t.customer.select(F.col("c_nationkey").alias("key")), t.supplier.select(F.col("s_nationkey").alias("key")), ["key"])


@query("ag15_ratio_alert", """
WITH a AS (SELECT event_type, count(*) AS raw_rows FROM events WHERE value < 50 GROUP BY 1), b AS (SELECT event_type, count(*) AS valid_rows FROM events WHERE value < 10 GROUP BY 1)
SELECT event_type, coalesce(raw_rows, 0) AS raw_rows, coalesce(valid_rows, 0) AS valid_rows, CASE WHEN coalesce(raw_rows, 0) = 0 THEN coalesce(valid_rows, 0) > 0 ELSE valid_rows IS NULL OR abs(raw_rows - valid_rows)::DOUBLE / raw_rows >= 0.8 END AS is_alert
FROM a FULL JOIN b USING (event_type)""")
def ratio_alert(t: Tables) -> DataFrame:
    return dq.ratio_alert(t.events.filter("value < 50"), t.events.filter("value < 10"), ["event_type"], 0.8).drop("gap")


@query("ag16_topic_volume", "SELECT event_type, count(*) AS messages, min(ts) AS first_time, max(ts) AS last_time FROM events GROUP BY event_type")
def topic_volume(t: Tables) -> DataFrame:
    return dq.topic_volume(t.events, ["event_type"], "ts")


@query("ag17_distinct_subset", "SELECT o_custkey, o_orderpriority, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1, 2")
def distinct_subset(t: Tables) -> DataFrame:
    return dd.drop_duplicates(t.orders, ["o_custkey", "o_orderpriority"], [F.col("o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderkey")


# --- windows

@query("wn1_latest_per_key", "SELECT user_id, event_type, arg_max(event_id, struct_pack(t := ts, i := event_id)) AS event_id FROM events GROUP BY 1, 2")
def latest(t: Tables) -> DataFrame:
    return dd.latest_per_key(t.events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_type", "event_id")


@query("wn2_latest_with_count", "SELECT user_id, max(event_id) AS event_id, count(*) AS duplicate_count FROM events GROUP BY 1")
def latest_count(t: Tables) -> DataFrame:
    return dd.latest_with_count(t.events, ["user_id"], [F.col("event_id").desc()]).select("user_id", "event_id", "duplicate_count")


@query("wn3_action_priority", f"""
WITH {MESSAGES_CTE} SELECT user_id, date_trunc('day', ts) AS day, action, event_id FROM messages
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts) DESC, CASE action WHEN 'DELETE' THEN 1 WHEN 'CHANGE' THEN 2 ELSE 3 END, event_id) = 1""")
def action_priority(t: Tables) -> DataFrame:
    m = messages(t).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    return dd.latest_action(m, ["user_id"], "day", "action", F.col("event_id")).select("user_id", "day", "action", "event_id")


@query("wn4_batch_number", """
SELECT event_id, event_type, printf('%04d', CAST(ceil(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) / 100.0) AS INTEGER)) AS batch_number FROM events""")
def batch_number(t: Tables) -> DataFrame:
    return od.batch_numbers(t.events, 100, ["ts", "event_id"], ["event_type"]).select("event_id", "event_type", "batch_number")


@query("wn5_surrogate_keys", "SELECT c_custkey, CAST(1000 + row_number() OVER (ORDER BY c_acctbal, c_custkey) AS BIGINT) AS id FROM customer")
def surrogate(t: Tables) -> DataFrame:
    return od.surrogate_ids(t.customer, ["c_acctbal", "c_custkey"], 1000).select("c_custkey", "id")


@query("wn6_priority_max", """
SELECT o_orderkey, coalesce(max(o_orderdate) FILTER (o_orderstatus = 'F' AND o_totalprice > 300000) OVER w, max(o_orderdate) FILTER (o_orderstatus = 'F') OVER w, max(o_orderdate) OVER w) AS decided
FROM orders WINDOW w AS (PARTITION BY o_custkey)""")
def priority_max(t: Tables) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return sv.with_priority_max(t.orders, ["o_custkey"], [done & (F.col("o_totalprice") > 300000), done, None], "o_orderdate", "decided", ["o_orderkey"]).select("o_orderkey", "decided")


@query("wn7_distinct_in_group", "SELECT o_orderkey, n FROM orders JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1) USING (o_custkey)")
def distinct_in_group(t: Tables) -> DataFrame:
    return with_group_values(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"], n=F.countDistinct("o_orderpriority")).select("o_orderkey", "n")


@query("wn8_approx_distinct_in_group", "SELECT o_orderkey, n FROM orders JOIN (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n FROM orders GROUP BY 1) USING (o_custkey)")
def approx_in_group(t: Tables) -> DataFrame:
    """Approximate counts of at most five values are exact."""
    return with_group_values(t.orders.select("o_orderkey", "o_custkey", "o_orderpriority"), ["o_custkey"], ["o_orderkey"], n=sk.approx_distinct("o_orderpriority", 0.01)).select("o_orderkey", "n")


def _monthly(t: Tables, groups: list[str], key: str | None = None, value: str | None = None) -> DataFrame:
    """Sketches per month and group, written as a nightly job would."""
    rows = t.orders.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return stage(sk.batch_sketches(rows, ["month", *groups], key, value), "sketches")


@query("wn8_sketched_counts", """
SELECT o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers, true AS within, true AS within_hll FROM orders GROUP BY 1""")
def sketched_counts(t: Tables) -> DataFrame:
    """Distinct customers per priority, merged from the sketches of all months, against the exact counts."""
    merged = sk.merge_sketches(_monthly(t, ["o_orderpriority"], "o_custkey"), ["o_orderpriority"])
    exact = t.orders.groupBy("o_orderpriority").agg(F.countDistinct("o_custkey").alias("customers"))
    near = lambda estimate: F.abs(estimate - F.col("customers")) <= sk.DISTINCT_ERROR * F.col("customers")
    out = merged.join(exact, "o_orderpriority")
    return out.select("o_orderpriority", "n", "customers", near(sk.distinct_count()).alias("within"), near(sk.distinct_count_hll()).alias("within_hll"))


@query("ag2_sketched_overlap", """
WITH k AS (SELECT DISTINCT o_orderpriority AS p, o_custkey FROM orders)
SELECT a.p AS one, b.p AS other, count(*) AS shared, true AS within, true AS within_only FROM k a JOIN k b ON a.o_custkey = b.o_custkey AND a.p < b.p GROUP BY 1, 2""")
def sketched_overlap(t: Tables) -> DataFrame:
    """Customers that two priorities share, from stored sketches, against the exact counts."""
    merged = stage(sk.merge_sketches(_monthly(t, ["o_orderpriority"], "o_custkey"), ["o_orderpriority"]), "sketches")
    side = lambda name, keys: merged.select(F.col("o_orderpriority").alias(name), F.col("keys").alias(keys))
    pairs = side("one", "a").join(side("other", "b"), F.col("one") < F.col("other"))  # one row per priority
    k = t.orders.select("o_orderpriority", "o_custkey").distinct()
    own = k.groupBy(F.col("o_orderpriority").alias("one")).agg(F.count(F.lit(1)).alias("total"))
    exact = k.withColumnRenamed("o_orderpriority", "one").join(k.withColumnRenamed("o_orderpriority", "other"), "o_custkey").filter("one < other")
    exact = exact.groupBy("one", "other").agg(F.count(F.lit(1)).alias("shared")).join(own, "one")
    out = pairs.join(exact, ["one", "other"]).withColumn("union", sk.distinct_count(F.theta_union("a", "b")))
    near = lambda estimate, count: F.abs(estimate - count) <= sk.OVERLAP_ERROR * F.col("union")
    return out.select(
        "one", "other", "shared", near(sk.overlap("a", "b"), F.col("shared")).alias("within"),
        near(sk.only_left("a", "b"), F.col("total") - F.col("shared")).alias("within_only"))


@query("ag12_sketched_quantiles", """
SELECT o_orderstatus, q::DOUBLE AS q, count(*) AS n, true AS within FROM orders, (VALUES (0.05), (0.5), (0.95)) v(q) GROUP BY 1, 2""")
def sketched_quantiles(t: Tables) -> DataFrame:
    """Quantiles of the price per status from merged sketches: their rank among all prices is within the stated error."""
    merged = sk.merge_sketches(_monthly(t, ["o_orderstatus"], value="o_totalprice"), ["o_orderstatus"])
    marks = F.explode(F.array(*[F.struct(F.lit(q).alias("q"), sk.quantile("values", q).alias("at")) for q in (0.05, 0.5, 0.95)]))
    marks = stage(merged.select("o_orderstatus", marks.alias("m")).select("o_orderstatus", "m.*"), "quantiles")  # three per status
    below = t.orders.join(F.broadcast(marks), "o_orderstatus").groupBy("o_orderstatus", "q").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_totalprice") < F.col("at")).alias("less"), F.count_if(F.col("o_totalprice") <= F.col("at")).alias("upto"))
    within = (F.col("less") <= (F.col("q") + sk.RANK_ERROR) * F.col("n") + 1) & (F.col("upto") >= (F.col("q") - sk.RANK_ERROR) * F.col("n") - 1)
    return below.select("o_orderstatus", "q", "n", within.alias("within"))


@query("wn9_conflict_flag", "SELECT o_orderkey, n > 1 AS has_conflict FROM orders JOIN (SELECT o_custkey, count(DISTINCT o_orderstatus) AS n FROM orders GROUP BY 1) USING (o_custkey)")
def conflict(t: Tables) -> DataFrame:
    from goldthread.operators.keys import flag_conflicts
    return flag_conflicts(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderstatus", {"has_conflict": ["o_custkey"]}, ["o_orderkey"]).select("o_orderkey", "has_conflict")


@query("wn10_mixed_membership", """
WITH g AS (SELECT o_custkey, bool_or(o_orderstatus = 'P') AS p, bool_or(o_orderstatus <> 'P') AS np FROM orders GROUP BY 1)
SELECT o_orderkey, CASE WHEN p AND np AND o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders JOIN g USING (o_custkey)""")
def mixed(t: Tables) -> DataFrame:
    return sv.blank_when_mixed(t.orders, ["o_custkey"], F.col("o_orderstatus") == "P", ["o_orderpriority"], ["o_orderkey"]).select("o_orderkey", "o_orderpriority")


@query("wn10_drop_weak_members", """
WITH g AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f FROM orders GROUP BY 1) SELECT o_orderkey FROM orders JOIN g USING (o_custkey) WHERE NOT (o_orderstatus = 'P' AND f)""")
def drop_weak(t: Tables) -> DataFrame:
    return sv.drop_when_mixed(t.orders, ["o_custkey"], F.col("o_orderstatus") == "P", F.col("o_orderstatus") == "F", ["o_orderkey"]).select("o_orderkey")


@query("wn11_best_by_quality_class", """
SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 0 WHEN o_orderstatus = 'F' THEN 1
 WHEN o_totalprice > 300000 THEN 2 ELSE 3 END, o_orderkey DESC) = 1""")
def best_class(t: Tables) -> DataFrame:
    done, big = F.col("o_orderstatus") == "F", F.col("o_totalprice") > 300000
    return sv.best_by_class(t.orders, ["o_custkey"], [done & big, done, big], F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey")


@query("wn12_max_version_then_date", """
SELECT o_custkey, o_orderpriority, max(struct_pack(v := o_orderstatus, d := o_orderdate)).v AS version, max(struct_pack(v := o_orderstatus, d := o_orderdate)).d AS at FROM orders GROUP BY 1, 2""")
def max_version(t: Tables) -> DataFrame:
    got = t.orders.groupBy("o_custkey", "o_orderpriority").agg(F.max(F.struct("o_orderstatus", "o_orderdate")).alias("m"))
    return got.select("o_custkey", "o_orderpriority", F.col("m.o_orderstatus").alias("version"), F.col("m.o_orderdate").alias("at"))


@query("wn13_sample_per_group", "SELECT event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 3")
def sample(t: Tables) -> DataFrame:
    return dd.top_per_key(t.events, ["event_type"], [F.col("ts"), F.col("event_id")], 3).select("event_type", "event_id")


# --- ordering and sets

@query("st1_global_sort", "SELECT doc_id, strlen(text) AS bytes FROM documents ORDER BY bytes DESC, doc_id")
def global_sort(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes")).orderBy(F.desc("bytes"), "doc_id")


@query("st2_quota_per_group", """
WITH f AS (SELECT c_nationkey, c_custkey, min(o_orderdate) AS first_at FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY first_at, c_custkey) AS n FROM f)
SELECT o_orderkey, o_custkey FROM orders JOIN r ON o_custkey = c_custkey WHERE n <= c_nationkey % 4""")
def quota(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import rate_limit
    quotas = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), (F.col("n_nationkey") % 4).alias("quota"))
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rate_limit(rows, quotas, "c_nationkey", ["c_custkey"], ["o_orderdate"]).select("o_orderkey", "o_custkey")


@query("st3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("so1_union_by_name", "SELECT c_custkey AS id, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, NULL FROM supplier")
def union(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_mktsegment").alias("segment"), F.col("c_custkey").alias("id"))
    return a.unionByName(t.supplier.select(F.col("s_suppkey").alias("id")), allowMissingColumns=True)


@query("so2_set_difference", "SELECT DISTINCT user_id FROM events EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def difference(t: Tables) -> DataFrame:
    placed = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("user_id"))
    return t.events.select("user_id").distinct().join(placed, "user_id", "left_anti")


@query("so3_array_difference", """
WITH a AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS p FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS owner, o_orderpriority AS p FROM orders WHERE o_orderstatus <> 'F')
(SELECT owner, p, 'left' AS side FROM a EXCEPT SELECT owner, p, 'left' FROM b) UNION ALL (SELECT owner, p, 'right' FROM b EXCEPT SELECT owner, p, 'right' FROM a)""")
def array_difference(t: Tables) -> DataFrame:
    from goldthread.operators.erasure import member_differences
    o = t.orders.select(F.col("o_custkey").alias("owner"), F.col("o_orderpriority").alias("p"), "o_orderstatus")
    return member_differences(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus <> 'F'"), ["owner", "p"])


@query("so4_distinct_union", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def distinct_union(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@query("ag5_nested_collect", """
SELECT o_custkey, count(*) AS orders, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey) AS order_ids FROM orders GROUP BY o_custkey""")
def nested_collect(t: Tables) -> DataFrame:
    from goldthread.operators.documents import nest_children
    n = nest_children(t.orders, ["o_custkey"], {"id": F.col("o_orderkey").cast("string"), "total": "o_totalprice"}, ["o_orderkey"])
    return n.select("o_custkey", F.size("items").cast("bigint").alias("orders"), F.array_join(F.transform("items", lambda x: x["id"]), ",").alias("order_ids"))


@query("ag6_sorted_structs", """
SELECT conv_id, first(text ORDER BY turn) AS opening, last(role ORDER BY turn) AS last_role FROM conversations GROUP BY conv_id""")
def sorted_structs(t: Tables) -> DataFrame:
    from goldthread.operators.documents import nest_children
    n = nest_children(t.conversations, ["conv_id"], {"role": "role", "text": "text"}, ["turn"])
    return n.select("conv_id", F.element_at("items", 1)["text"].alias("opening"), F.element_at("items", -1)["role"].alias("last_role"))
