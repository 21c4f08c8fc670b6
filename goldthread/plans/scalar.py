"""Queries on scalar functions, projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import codes, contact, jsonfn, similarity, text as tx
from goldthread.operators import projection as pj, rules
from goldthread.operators.documents import nest_children
from goldthread.plans.fixtures import KEYED_CTE, PROFILES_CTE, profiles
from goldthread.plans.registry import Tables, query


@query("sc1_match_key", """
SELECT p_partkey, nullif(upper(trim(regexp_replace(p_name || '  #' || p_brand, '[^A-Za-z0-9 ]', '', 'g'))), '') AS match_key
FROM part""")
def match_key(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", tx.alnum_key(F.concat("p_name", F.lit("  #"), "p_brand")).alias("match_key"))


@query("sc2_email_validity", f"""
WITH {PROFILES_CTE}, e AS (SELECT src_id, lower(trim(email_address)) AS email FROM profiles),
v AS (SELECT *, coalesce(regexp_matches(email, '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{{2,}}$'), false) AS ok FROM e)
SELECT src_id, email, ok AS valid_contact, CASE WHEN ok THEN 'VALID' ELSE 'INVALID' END AS quality_code,
       CASE WHEN coalesce(email, '') = '' THEN 'empty' WHEN NOT ok THEN 'malformed' ELSE 'ok' END AS reason
FROM v""")
def email_validity(t: Tables) -> DataFrame:
    c = F.col("email")
    return profiles(t).select("src_id", contact.clean_email(F.col("email_address")).alias("email")).select(
        "src_id", "email", contact.valid_email(c).alias("valid_contact"),
        contact.quality(contact.valid_email(c)).alias("quality_code"), contact.email_reason(c).alias("reason"),
    )


@query("sc3_phone_validity", f"""
WITH {PROFILES_CTE}, e AS (SELECT src_id, regexp_replace(phone_number, '[^0-9]', '', 'g') AS phone FROM profiles)
SELECT src_id, phone, length(phone) BETWEEN 7 AND 15 AS valid_contact,
       CASE WHEN phone = '' THEN 'empty' WHEN length(phone) < 7 THEN 'too_short' WHEN length(phone) > 15 THEN 'too_long' ELSE 'ok' END AS reason FROM e""")
def phone_validity(t: Tables) -> DataFrame:
    c = F.col("phone")
    return profiles(t).select("src_id", contact.clean_phone(F.col("phone_number")).alias("phone")).select(
        "src_id", "phone", contact.valid_phone(c).alias("valid_contact"), contact.phone_reason(c).alias("reason")
    )


_ADDRESS = """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE ' Street ' || c_custkey % 9 END AS line1,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END AS city, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE r_name END AS province,
  CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lpad(CAST(c_nationkey AS STRING), 5, '0') END AS postal
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey"""


@query("sc4_address_validity", f"""
WITH a AS ({_ADDRESS.replace('{', '').replace('}', '')})
SELECT c_custkey, upper(trim(coalesce(line1, '')) || '|' || trim(coalesce(city, '')) || '|' || trim(coalesce(province, ''))
       || '|' || trim(coalesce(postal, ''))) AS address_key,
       CASE WHEN city IS NULL AND province IS NULL THEN 'no_city,no_province' WHEN city IS NULL THEN 'no_city'
            WHEN province IS NULL THEN 'no_province' ELSE 'ok' END AS reason FROM a""")
def address_validity(t: Tables) -> DataFrame:
    a = t.sql(_ADDRESS)
    return a.select(
        "c_custkey", tx.piped_address_key(F.col("line1"), F.col("city"), F.col("province"), F.col("postal")).alias("address_key"),
        contact.address_reason(F.col("city"), F.col("province")).alias("reason"),
    )


@query("sc5_address_key", f"""
WITH a AS ({_ADDRESS.replace('{', '').replace('}', '')})
SELECT c_custkey, nullif(concat_ws('', lower(nullif(trim(line1), '')), lower(nullif(trim(city), '')),
       lower(nullif(trim(province), '')), lower(nullif(trim(postal), ''))), '') AS address_key FROM a""")
def address_key(t: Tables) -> DataFrame:
    a = t.sql(_ADDRESS)
    return a.select("c_custkey", tx.address_key(*[F.col(c) for c in ("line1", "city", "province", "postal")]).alias("address_key"))


_NAMED = """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'null' ELSE c_mktsegment END AS fn,
  CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE c_name END AS ln,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name || '  ' || c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN ' X' ELSE '' END END AS whole
  FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""
_NAMED_CTE = f"n AS ({_NAMED.replace('{', '').replace('}', '')})"


@query("sc6_full_name", f"""
WITH {_NAMED_CTE}, c AS (SELECT c_custkey, whole, CASE WHEN upper(trim(fn)) NOT IN ('-','','N/A','UNKNOWN','NULL','NA') THEN trim(fn) END AS f,
  CASE WHEN upper(trim(ln)) NOT IN ('-','','N/A','UNKNOWN','NULL','NA') THEN trim(ln) END AS l FROM n)
SELECT c_custkey, CASE WHEN f IS NOT NULL OR l IS NOT NULL THEN concat_ws(' ', f, l) ELSE whole END AS full_name FROM c""")
def full_names(t: Tables) -> DataFrame:
    first, last = tx.clean_name(F.col("fn")), tx.clean_name(F.col("ln"))
    return t.sql(_NAMED).select("c_custkey", tx.full_name(first, last, F.col("whole")).alias("full_name"))


@query("sc7_sorted_name_key", f"""
WITH {_NAMED_CTE}, c AS (SELECT c_custkey,
  CASE WHEN fn IS NULL OR trim(fn) = '' OR lower(fn) = 'null' THEN '' ELSE lower(regexp_replace(fn, '\\s+', '', 'g')) END AS f,
  CASE WHEN ln IS NULL OR trim(ln) = '' OR lower(ln) = 'null' THEN '' ELSE lower(regexp_replace(ln, '\\s+', '', 'g')) END AS l,
  CASE WHEN whole IS NULL THEN '' ELSE lower(trim(regexp_replace(whole, '\\s+', ' ', 'g'))) END AS w FROM n),
k AS (SELECT c_custkey, CASE WHEN f <> '' AND l <> '' THEN [f, l] WHEN w <> '' AND len(string_split(w, ' ')) > 2 THEN [replace(w, ' ', '')]
  WHEN w <> '' THEN string_split(w, ' ') WHEN f <> '' THEN [f] WHEN l <> '' THEN [l] END AS tokens FROM c)
SELECT c_custkey, array_to_string(list_sort(list_distinct(tokens)), '_') AS name_asc,
       array_to_string(list_reverse_sort(list_distinct(tokens)), '_') AS name_desc FROM k""")
def sorted_names(t: Tables) -> DataFrame:
    key = tx.sorted_name_key([(F.col("fn"), F.col("ln"), F.col("whole"))], "_")
    return t.sql(_NAMED).select("c_custkey", key.alias("k")).select(
        "c_custkey", F.col("k.asc").alias("name_asc"), F.col("k.desc").alias("name_desc"))


@query("sc8_contact_key", f"""
WITH {PROFILES_CTE} SELECT src_id, CASE WHEN phone_number IS NULL THEN NULL WHEN trim(phone_number) = '' THEN '' ELSE lower(phone_number) END AS phone_key,
  CASE WHEN trim(email_address) <> '' THEN lower(email_address) END AS email_key, CASE WHEN email_address IS NULL THEN '' ELSE lower(email_address) END AS email_text
FROM profiles""")
def contact_keys(t: Tables) -> DataFrame:
    return profiles(t).select(
        "src_id", tx.lower_keep_blank(F.col("phone_number")).alias("phone_key"),
        tx.lower_or_null(F.col("email_address")).alias("email_key"), tx.lower_or_empty(F.col("email_address")).alias("email_text"))


@query("sc9_token_reversal", "SELECT p_partkey, array_to_string(list_reverse(string_split(trim(p_name), ' ')), ' ') AS reversed FROM part")
def token_reversal(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", tx.reverse_tokens(F.col("p_name")).alias("reversed"))


@query("sc10_edit_similarity", """
SELECT p_partkey, round(1.0::DOUBLE - levenshtein(p_name, p_type)::DOUBLE / greatest(length(p_name), length(p_type)), 9) AS similarity FROM part""")
def edit_similarity(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(similarity.levenshtein_similarity(F.col("p_name"), F.col("p_type")), 9).alias("similarity"))


@query("sc11_jaro_winkler", """
SELECT p_partkey, round(jaro_winkler_similarity(upper(p_name), p_type), 9) AS similarity FROM part""")
def jaro(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(similarity.jaro_winkler(F.upper("p_name"), F.col("p_type")), 9).alias("similarity"))


@query("sc12_birth_date", """
SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 11 <> 0 THEN (1950 + c_custkey % 60) || '-' || lpad((c_custkey % 13)::VARCHAR, 2, '0')
       || '-' || lpad((c_custkey % 32)::VARCHAR, 2, '0') END AS DATE) AS birth_date FROM customer""")
def birth_dates(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    year = F.when(k % 11 != 0, (1950 + k % 60).cast("int"))
    return t.customer.select("c_custkey", tx.birth_date(year, (k % 13).cast("int"), (k % 32).cast("int")).alias("birth_date"))


@query("sc13_timezone_stripped", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS local_time FROM events""")
def timezones(t: Tables) -> DataFrame:
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.when(F.col("event_id") % 3 == 0, "Z").when(F.col("event_id") % 3 == 1, "+08:00").otherwise("-05:30")
    return t.events.select("event_id", tx.strip_timezone(F.concat(stamp, zone)).alias("local_time"))


@query("sc14_date_arithmetic", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day_text, CAST(o_orderdate AS DATE) - 30 AS month_before,
       o_orderdate < TIMESTAMP '2001-08-01' - INTERVAL 1000 DAY AS expired FROM orders""")
def date_arithmetic(t: Tables) -> DataFrame:
    cutoff = F.expr("TIMESTAMP_NTZ '2001-08-01' - INTERVAL 1000 DAYS")
    return t.orders.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day_text"),
        F.date_sub("o_orderdate", 30).alias("month_before"), (F.col("o_orderdate") < cutoff).alias("expired"))


@query("sc15_object_or_array", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 3 = 1 AS was_list FROM events""")
def object_or_array(t: Tables) -> DataFrame:
    shaped = t.events.withColumn("node", F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")))
    rows = jsonfn.explode_list(shaped, F.col("node"), "struct<k:bigint>", ["event_id", "node"])
    return rows.select("event_id", "item.k", F.col("node").startswith("[").alias("was_list"))


def _conversations(t: Tables) -> DataFrame:
    """One JSON document per conversation (several for one with very many turns)."""
    nested = nest_children(t.conversations, ["conv_id"], {"@No": "turn", "Role": "role", "Text": "text"}, ["turn", "role", "text"], "Turn")
    return nested.select("conv_id", F.to_json(F.struct(F.struct("Turn").alias("TurnList"))).alias("payload"))


@query("sc16_json_list_explode", "SELECT conv_id, turn, role, text, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS BIGINT) AS item_pos FROM conversations")
def list_explode(t: Tables) -> DataFrame:
    rows = jsonfn.explode_list(
        _conversations(t), jsonfn.node(F.col("payload"), "TurnList", "Turn"), "struct<`@No`:bigint,Role:string,Text:string>", ["conv_id"])
    return rows.select("conv_id", F.col("item_pos").cast("bigint"), F.col("item.`@No`").alias("turn"), F.col("item.Role").alias("role"), F.col("item.Text").alias("text"))


@query("sc17_element_by_attribute", """
SELECT conv_id, arg_min(text, turn) FILTER (role = 'assistant') AS first_answer FROM conversations GROUP BY conv_id""")
def element(t: Tables) -> DataFrame:
    turns = F.from_json(jsonfn.node(F.col("payload"), "TurnList", "Turn"), "array<struct<`@No`:bigint,Role:string,Text:string>>")
    return _conversations(t).select("conv_id", jsonfn.element_by(turns, "Role", "assistant")["Text"].alias("first_answer"))


@query("sc18_higher_order", """
SELECT conv_id, CAST(sum(length(text)) FILTER (role = 'user') AS BIGINT) AS user_chars, count(*) FILTER (role = 'user') AS user_turns
FROM conversations GROUP BY conv_id""")
def higher_order(t: Tables) -> DataFrame:
    turns = F.from_json(jsonfn.node(F.col("payload"), "TurnList", "Turn"), "array<struct<Role:string,Text:string>>")
    mine = F.filter(turns, lambda x: x["Role"] == "user")
    chars = F.aggregate(F.transform(mine, lambda x: F.length(x["Text"]).cast("bigint")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return _conversations(t).select(
        "conv_id", F.when(F.size(mine) > 0, chars).alias("user_chars"), F.size(mine).cast("bigint").alias("user_turns"))


@query("sc20_json_cleanup", """
SELECT o_orderkey, '{"Id":' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN ',"Codes":["' || o_orderstatus || '"]' ELSE '' END || '}' AS body FROM orders""")
def json_cleanup(t: Tables) -> DataFrame:
    codes = F.when(F.col("o_orderkey") % 2 == 0, F.array("o_orderstatus")).otherwise(F.array().cast("array<string>"))
    body = jsonfn.document(F.struct(F.col("o_orderkey").alias("Id"), codes.alias("Codes"), F.lit(None).cast("string").alias("Gone")))
    return t.orders.select("o_orderkey", jsonfn.drop_null_members(jsonfn.drop_empty_lists(body, ["Codes"]), ["Gone"]).alias("body"))


@query("sc21_mapping_envelope", f"""
WITH {PROFILES_CTE} SELECT src_id, action AS action, source_code AS code, source_entity_id AS mapped FROM profiles""")
def envelope(t: Tables) -> DataFrame:
    p = profiles(t)
    empty = F.lit(None).cast("string")
    body = jsonfn.mapping_envelope(
        F.col("action"), F.date_format("source_timestamp", "yyyy-MM-dd HH:mm:ss"), empty, empty, empty, F.col("source_code"),
        F.col("src_id").cast("string"), F.col("brand_code"), F.col("source_entity_id"), F.col("market_code"), F.col("brand_code"))
    top = ("ConsumerMappingList",)
    d = F.col("body")
    return p.select(body.alias("body")).select(
        jsonfn.node(d, *top, "ConsumerMapping", "MasterConsumer", "Id").cast("bigint").alias("src_id"),
        jsonfn.node(d, *top, "Header", "@Action").alias("action"),
        jsonfn.node(d, *top, "ConsumerMapping", "MasterConsumer", "@TypeCode").alias("code"),
        jsonfn.node(d, *top, "ConsumerMapping", "MappingConsumerList", "MappingConsumer", "Id").alias("mapped"))


@query("sc23_topic_list_explode", """
SELECT n_nationkey, unnest(CASE WHEN r_name = 'ASIA' THEN ['as.one', 'as.two'] WHEN r_name = 'EUROPE' THEN ['eu.one'] ELSE ['other'] END) AS topic
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def topics(t: Tables) -> DataFrame:
    joined = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    listed = tx.mapped(F.col("r_name"), {"ASIA": "as.one, as.two", "EUROPE": "eu.one"}, F.lit("other"))
    return pj.split_rows(joined, listed, "topic").select("n_nationkey", "topic")


@query("sc24_byte_size", "SELECT doc_id, CAST(strlen(text) AS BIGINT) AS bytes FROM documents")
def byte_size(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))


@query("sc25_encrypt_roundtrip", "SELECT c_custkey, c_name AS decrypted, true AS changed FROM customer")
def encryption(t: Tables) -> DataFrame:
    key = F.lit("0123456789abcdef")  # a test key; real keys are parameters
    hidden = t.customer.select("c_custkey", "c_name", pj.encrypt(F.col("c_name"), key).alias("hidden"))
    return hidden.select("c_custkey", pj.decrypt(F.col("hidden"), key).alias("decrypted"), (F.col("hidden") != F.col("c_name")).alias("changed"))


@query("sc26_truthy", "SELECT event_id, event_type IN ('click', 'view') AS flag FROM events")
def truthy(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "click", "TRUE").when(F.col("event_type") == "view", "1").when(F.col("event_type") == "error", "0")
    return t.events.select("event_id", tx.truthy(text).alias("flag"))


@query("sc27_padded_id", "SELECT c_custkey, 'MKT-' || lpad(c_custkey::VARCHAR, 9, '0') AS id, concat_ws('_', c_nationkey, c_custkey) AS lineage FROM customer")
def padded(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", tx.padded_id(F.col("c_custkey"), "MKT-").alias("id"), F.concat_ws("_", "c_nationkey", "c_custkey").alias("lineage"))


@query("sc22_array_helpers", """
SELECT o_custkey, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS statuses, bool_or(o_orderstatus = 'F') AS has_f FROM orders GROUP BY o_custkey""")
def arrays(t: Tables) -> DataFrame:
    got = t.orders.groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("s"))  # at most as long as the code list
    return got.select("o_custkey", F.array_join(F.array_sort(F.array_compact("s")), ",").alias("statuses"), F.array_contains("s", "F").alias("has_f"))


# --- projections and filters

@query("prj1_json_projection", "SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_projection(t: Tables) -> DataFrame:
    payload = t.events.select(F.to_json(F.struct(
        F.struct(F.col("event_id").alias("@Id"), F.col("event_type").alias("Type")).alias("Header"),
        F.struct("user_id", "props").alias("Body"))).alias("payload"))
    return pj.project_json(payload, "payload", "struct<Header:struct<`@Id`:bigint,Type:string>,Body:struct<user_id:bigint,props:string>>", {
        "event_id": "Header.`@Id`", "event_type": "Header.Type", "user_id": "Body.user_id",
        "k": F.get_json_object("doc.Body.props", "$.k").cast("bigint")})


@query("prj2_field_name_map", "SELECT c_custkey AS entity_id, c_name AS name, 'RETAIL' AS domain FROM customer UNION ALL SELECT s_suppkey, s_name, 'SUPPLY' FROM supplier")
def field_map(t: Tables) -> DataFrame:
    maps = {"RETAIL": {"entity_id": "c_custkey", "name": "c_name"}, "SUPPLY": {"entity_id": "s_suppkey", "name": "s_name"}}
    return pj.project_domains({"RETAIL": t.customer, "SUPPLY": t.supplier}, maps, "domain")


@query("prj3_sentinel_cleaning", f"WITH {_NAMED_CTE} SELECT c_custkey, CASE WHEN upper(trim(fn)) NOT IN ('-','','N/A','UNKNOWN','NULL','NA') THEN trim(fn) END AS fn FROM n")
def sentinels(t: Tables) -> DataFrame:
    return t.sql(_NAMED).select("c_custkey", tx.clean_name(F.col("fn")).alias("fn"))


_RULES = [("M0", "balance < 0"), ("M1", "fn IS NULL OR balance > 5000"), ("M2", "city = 'BUILDING'")]


@query("prj4_rule_table_filter", f"""
WITH {KEYED_CTE} SELECT src_id, market_code FROM keyed WHERE (market_code = 'M0' AND balance < 0)
 OR (market_code = 'M1' AND (fn IS NULL OR balance > 5000)) OR (market_code = 'M2' AND city = 'BUILDING')""")
def rule_filter(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    return pj.rows_hit_by_rules(keyed(t), "market_code", _RULES).select("src_id", "market_code")


@query("prj5_row_quality", f"""
WITH {KEYED_CTE}, c AS (SELECT src_id, CASE WHEN email IS NULL AND phone IS NULL THEN 'ExcludeByPkMiss' WHEN balance < 0 THEN 'FailByClearMiss'
  WHEN market_code = 'M2' AND city = 'BUILDING' THEN 'ExcludeByConfig' END AS exclude_type FROM keyed)
SELECT src_id, exclude_type, exclude_type IS NULL AS is_include FROM c""")
def row_quality(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    return pj.classify_rows(keyed(t), [
        (codes.PK_MISS, F.col("email").isNull() & F.col("phone").isNull()), (codes.CLEAR_MISS, F.col("balance") < 0),
        (codes.CONFIG, pj.rule_condition("market_code", [_RULES[2]]))]).select("src_id", "exclude_type", "is_include")


@query("prj6_fallback", f"WITH {PROFILES_CTE} SELECT src_id, CASE WHEN trim(coalesce(phone_number, '')) = '' THEN email_address ELSE phone_number END AS best_contact FROM profiles")
def fallbacks(t: Tables) -> DataFrame:
    return profiles(t).select("src_id", tx.fallback(F.col("phone_number"), F.col("email_address")).alias("best_contact"))


@query("prj7_sink_projection", """
SELECT o_orderkey, 'M' || substr(o_orderpriority, 1, 1) AS "MarketCode", o_totalprice * 2 AS doubled FROM orders WHERE o_orderpriority LIKE '3%' AND o_orderstatus = 'F'""")
def sink_projection(t: Tables) -> DataFrame:
    spec = pj.SinkSpec(value_map={"MarketCode": "concat('M', substring(o_orderpriority, 1, 1))", "doubled": "o_totalprice * 2"},
                       market="M3", condition="o_orderstatus = 'F'", include=("o_orderkey", "MarketCode", "doubled"))
    return pj.project_for_sink(t.orders, spec)


@query("prj8_store_types", """
WITH b AS (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Brand.com' WHEN 'STANDARD' THEN 'Free Standing' WHEN 'PROMO' THEN 'Not assigned' WHEN 'SMALL' THEN NULL ELSE p_type END AS t FROM part),
c AS (SELECT p_partkey, CASE t WHEN 'Brand.com' THEN 'onl' WHEN 'Free Standing' THEN 'frestnstr' WHEN 'Not assigned' THEN '' ELSE coalesce(t, '') END AS type_code FROM b)
SELECT p_partkey, type_code, CASE WHEN p_partkey % 10 = 0 OR type_code = 'onl' THEN 'Online' ELSE 'Offline' END AS channel, CASE WHEN type_code IN ('frestnstr', 'crpstr', 'onl') THEN 'true' ELSE 'false' END AS is_direct FROM c""")
def store_types(t: Tables) -> DataFrame:
    kind = F.col("p_type")
    business = F.when(kind == "ECONOMY", "Brand.com").when(kind == "STANDARD", "Free Standing").when(kind == "PROMO", "Not assigned").when(kind != "SMALL", kind)
    door = F.when(F.col("p_partkey") % 10 == 0, "Y").otherwise("N")
    typed = t.part.select("p_partkey", codes.store_type(business).alias("type_code"), door.alias("door"))
    return typed.select("p_partkey", "type_code", codes.store_channel(F.col("door"), F.col("type_code")).alias("channel"), codes.is_direct_store(F.col("type_code")).alias("is_direct"))


@query("prj8_category_recode", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'E' WHEN 'STANDARD' THEN 'S' WHEN 'PROMO' THEN 'P' ELSE 'OTHER' END AS category, p_size >= 25 AS is_large FROM part""")
def recode(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", tx.mapped(F.col("p_type"), {"ECONOMY": "E", "STANDARD": "S", "PROMO": "P"}, F.lit("OTHER")).alias("category"), (F.col("p_size") >= 25).alias("is_large"))


@query("prj9_expression_by_market", f"""
WITH {KEYED_CTE} SELECT src_id, CASE market_code WHEN 'M0' THEN fn IS NOT NULL AND ln IS NOT NULL WHEN 'M1' THEN fn IS NOT NULL OR ln IS NOT NULL ELSE fn IS NOT NULL END AS name_filled FROM keyed""")
def by_market(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    fn, ln = F.col("fn").isNotNull(), F.col("ln").isNotNull()
    return keyed(t).select("src_id", pj.by_group(F.col("market_code"), {"M0": fn & ln, "M1": fn | ln}, fn).alias("name_filled"))


@query("prj9_name_filled_flag", f"""
WITH {KEYED_CTE}, q AS (SELECT *, CASE WHEN balance < 0 THEN 'inv' END AS quality FROM keyed)
SELECT src_id, CASE WHEN market_code = 'M0' THEN (fn IS NOT NULL OR email IS NOT NULL OR phone IS NOT NULL) WHEN market_code = 'M1' THEN fn IS NOT NULL OR email IS NOT NULL
 ELSE fn IS NOT NULL OR email IS NOT NULL END AND (market_code = 'M1' OR quality IS DISTINCT FROM 'inv') AS is_filled FROM q""")
def name_filled(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    quality = F.when(F.col("balance") < 0, codes.INVALID)
    flag = codes.name_filled(F.col("market_code"), [quality], [F.col("fn"), F.col("email")], {"M0": [F.col("phone")]}, ("M1",))
    return keyed(t).select("src_id", (flag == 1).alias("is_filled"))


@query("prj4_failing_keys_of_tables", """
SELECT 'N' || c_nationkey AS market, c_custkey AS id FROM customer WHERE c_nationkey = 1 AND c_acctbal < 0
UNION SELECT 'N' || c_nationkey, c_custkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE c_nationkey = 2 AND o_totalprice > 400000""")
def failing_keys(t: Tables) -> DataFrame:
    market = F.concat(F.lit("N"), "c_nationkey")
    people = t.customer.withColumn("market", market)
    orders = t.orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    rules = [("N1", "person", "c_acctbal < 0"), ("N2", "order", "o_totalprice > 400000")]
    return pj.failing_keys({"person": (people, "market", "c_custkey"), "order": (orders, "market", "o_custkey")}, rules)


@query("prj10_blocking_class", """
SELECT c_custkey, CASE WHEN c_nationkey = 1 THEN 'Normal' WHEN c_nationkey = 2 AND c_mktsegment = 'BUILDING' THEN 'Special'
 WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 0 THEN 'Staff' ELSE 'Normal' END AS blocking FROM customer""")
def blocking(t: Tables) -> DataFrame:
    group = F.when(F.col("c_acctbal") > 0, "empl")
    c = rules.blocking_class(F.col("c_nationkey").cast("string"), F.col("c_mktsegment"), group, ["1"], {("2", "BUILDING"): "Special"}, "MACHINERY", "empl")
    return t.customer.select("c_custkey", c.alias("blocking"))


@query("prj11_name_exclusion", f"WITH {KEYED_CTE} SELECT src_id, fn FROM keyed WHERE coalesce(fn NOT IN ('FN1', 'FN7'), true) AND action <> 'DELETE'")
def name_exclusion(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    return rules.exclude_values(keyed(t), "fn", ["FN1", "FN7"]).filter("action <> 'DELETE'").select("src_id", "fn")


@query("prj12_column_lookup", "SELECT c_custkey, c_name AS label FROM customer")
def column_lookup(t: Tables) -> DataFrame:
    name = pj.find_column(t.customer, ["full_name", "C_NAME", "name"])
    return t.customer.select("c_custkey", F.col(name).alias("label"))


@query("prj13_path_placeholders", "SELECT o_orderkey, 'out/' || strftime(o_orderdate, '%Y%m%d') || '/M' || o_custkey % 5 || '.json' AS path FROM orders")
def placeholders(t: Tables) -> DataFrame:
    path = pj.expand_path("out/{yyyyMMdd}/{market}.json", F.col("o_orderdate"), {"market": F.concat(F.lit("M"), (F.col("o_custkey") % 5).cast("string"))})
    return t.orders.select("o_orderkey", path.alias("path"))


@query("prj14_source_whitelist", """
SELECT c_custkey, c_name FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2) OR (c_mktsegment LIKE 'MA%' AND c_mktsegment LIKE '%RY')""")
def whitelist(t: Tables) -> DataFrame:
    codes = t.nation.filter("n_regionkey = 2").select(F.col("n_nationkey").alias("c_nationkey"))
    return pj.whitelist(t.customer, codes, ["c_nationkey"], "c_custkey", F.col("c_mktsegment"), "MA", "RY").select("c_custkey", "c_name")


@query("prj15_exclusion_downgrade", f"""
WITH {KEYED_CTE}, bad AS (SELECT DISTINCT phone FROM keyed WHERE balance < -900)
SELECT src_id, CASE WHEN k.phone IN (SELECT phone FROM bad WHERE phone IS NOT NULL) THEN 'inv' ELSE 'ok' END AS quality FROM keyed k""")
def downgrade(t: Tables) -> DataFrame:
    from goldthread.plans.fixtures import keyed
    k = keyed(t).withColumn("quality", F.lit("ok"))
    return pj.downgrade_listed(k, k.filter("balance < -900").select("phone"), ["phone"], "quality").select("src_id", "quality")


# --- functions that users call by name

@query("u1_lower_or_empty", f"WITH {PROFILES_CTE} SELECT src_id, CASE WHEN trim(coalesce(email_address, '')) = '' THEN '' ELSE lower(email_address) END AS name_text FROM profiles")
def u1(t: Tables) -> DataFrame:
    return profiles(t).select("src_id", tx.lower_or_empty(F.col("email_address")).alias("name_text"))


@query("u2_contact_match_keys", f"WITH {PROFILES_CTE} SELECT src_id, CASE WHEN trim(email_address) <> '' THEN lower(email_address) END AS email_key, CASE WHEN trim(phone_number) <> '' THEN lower(phone_number) END AS phone_key FROM profiles")
def u2(t: Tables) -> DataFrame:
    return profiles(t).select("src_id", tx.lower_or_null(F.col("email_address")).alias("email_key"), tx.lower_or_null(F.col("phone_number")).alias("phone_key"))


@query("u3_five_part_address_key", f"""
WITH a AS ({_ADDRESS.replace('{', '').replace('}', '')})
SELECT c_custkey, nullif(concat_ws('', lower(nullif(trim(line1), '')), lower(nullif(trim(city), '')), lower(nullif(trim(province), '')), lower(nullif(trim(city), '')), lower(nullif(trim(postal), ''))), '') AS address_key FROM a""")
def u3(t: Tables) -> DataFrame:
    parts = [F.col(c) for c in ("line1", "city", "province", "city", "postal")]
    return t.sql(_ADDRESS).select("c_custkey", tx.address_key(*parts).alias("address_key"))


@query("u4_name_key_by_priority", f"""
WITH {_NAMED_CTE}, l AS (SELECT c_custkey, lower(fn) AS lf, lower(whole) AS w FROM n WHERE true),
k AS (SELECT c_custkey, CASE WHEN lf IS NOT NULL AND lf <> 'null' THEN [lf] WHEN trim(w) <> '' THEN
  CASE WHEN len(string_split(regexp_replace(trim(w), '\\s+', ' ', 'g'), ' ')) > 2 THEN [regexp_replace(w, '\\s+', '', 'g')] ELSE string_split(regexp_replace(trim(w), '\\s+', ' ', 'g'), ' ') END END AS tokens FROM l)
SELECT c_custkey, array_to_string(list_sort(list_distinct(tokens)), '') AS name_key FROM k""")
def u4(t: Tables) -> DataFrame:
    """Local name first, English name when it is missing; the run-together form."""
    none = F.lit(None).cast("string")
    key = tx.sorted_name_key([(F.col("fn"), none, none), (none, none, F.col("whole"))], "")
    return t.sql(_NAMED).select("c_custkey", key["asc"].alias("name_key"))


@query("u5_mapping_contact_keys", f"WITH {PROFILES_CTE} SELECT src_id, CASE WHEN phone_number IS NULL THEN NULL WHEN trim(phone_number) = '' THEN '' ELSE lower(phone_number) END AS phone_key FROM profiles")
def u5(t: Tables) -> DataFrame:
    return profiles(t).select("src_id", tx.lower_keep_blank(F.col("phone_number")).alias("phone_key"))


@query("u6_mapping_document", f"WITH {PROFILES_CTE} SELECT src_id, market_code AS market, true AS keeps_nulls FROM profiles")
def u6(t: Tables) -> DataFrame:
    empty = F.lit(None).cast("string")
    body = jsonfn.mapping_envelope(
        F.col("action"), empty, empty, empty, empty, F.col("source_code"), F.col("src_id").cast("string"), F.col("brand_code"),
        F.col("source_entity_id"), F.col("market_code"), F.col("brand_code"))
    return profiles(t).select("src_id", body.alias("body")).select(
        "src_id", jsonfn.node(F.col("body"), "ConsumerMappingList", "ConsumerMapping", "MasterConsumer", "MarketCode").alias("market"),
        F.col("body").contains('"DocumentUUID":null').alias("keeps_nulls"))


@query("u7_jaro_in_sql", "SELECT s_suppkey, round(jaro_winkler_similarity(upper(s_name), 'SUPPLIERS'), 9) AS similarity FROM supplier")
def u7(t: Tables) -> DataFrame:
    similarity.register(t.spark)
    return t.sql("SELECT s_suppkey, round(jaro_sim(upper(s_name), 'SUPPLIERS'), 9) AS similarity FROM {supplier}")


@query("u8_generated_ids", "SELECT count(*) AS rows, count(*) AS distinct_ids, 36 AS id_length FROM customer")
def u8(t: Tables) -> DataFrame:
    similarity.register(t.spark)
    ids = t.sql("SELECT c_custkey, gen_uuid() AS id FROM {customer}")
    return ids.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("id").alias("distinct_ids"), F.max(F.length("id")).alias("id_length"))
