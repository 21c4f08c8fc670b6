"""Master-data tables derived from the given tables, in SQL that runs the same on Spark and elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from goldthread.functions import contact, text as tx
from goldthread.plans.registry import Tables, plain

# Three source records per person: natural name with phone and e-mail, swapped name with phone only,
# natural name with e-mail only; a hub phone, bad e-mails, mixed case, signs and blanks.
PROFILES = """
SELECT c_custkey AS src_id,
       'M' || CAST(CAST(floor(c_custkey / 3) AS INT) % 5 AS STRING) AS market_code,
       'B' || CAST(c_custkey % 4 AS STRING) AS brand_code,
       'S' || CAST(c_custkey % 2 AS STRING) AS source_code,
       'C' || CAST(CAST(floor(c_custkey / 6) AS BIGINT) AS STRING) AS source_entity_id,
       CASE WHEN c_custkey % 3 = 1 THEN 'Ln' || CAST(CAST(floor(c_custkey / 3) AS INT) % 97 AS STRING)
            ELSE ' fn-' || CAST(CAST(floor(c_custkey / 3) AS INT) % 89 AS STRING) END AS first_name,
       CASE WHEN c_custkey % 3 = 1 THEN 'Fn' || CAST(CAST(floor(c_custkey / 3) AS INT) % 89 AS STRING)
            ELSE 'LN' || CAST(CAST(floor(c_custkey / 3) AS INT) % 97 AS STRING) END AS last_name,
       CASE WHEN c_custkey % 3 = 2 THEN ''
            WHEN CAST(floor(c_custkey / 3) AS BIGINT) % 25 = 0 THEN '000-0000'
            ELSE '(080) 55' || lpad(CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING), 6, '0') END AS phone_number,
       CASE WHEN c_custkey % 3 = 1 THEN NULL
            WHEN c_custkey % 30 = 0 THEN 'not-an-email'
            ELSE 'User' || CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) || '@Ex.com' END AS email_address,
       CASE WHEN c_custkey % 17 = 0 THEN 'DELETE' WHEN c_custkey % 5 = 0 THEN 'CHANGE' ELSE 'CREATE' END AS action,
       TIMESTAMP '2024-01-01 00:00:00' + INTERVAL '1' HOUR * CAST((c_custkey * 37) % 500 AS INT) AS source_timestamp,
       c_mktsegment AS city, c_acctbal AS balance
FROM {customer}
"""

HUB_PHONE = "0000000"

# The same records with their match keys, as an SQL statement of what the normalisers must give.
_CLEAN = """
SELECT src_id, market_code, brand_code, source_code, source_entity_id, action, source_timestamp, city, balance,
       nullif(upper(trim(regexp_replace(first_name, '[^A-Za-z0-9 ]', '', 'g'))), '') AS fn,
       nullif(upper(trim(regexp_replace(last_name, '[^A-Za-z0-9 ]', '', 'g'))), '') AS ln,
       CASE WHEN length(regexp_replace(phone_number, '[^0-9]', '', 'g')) BETWEEN 7 AND 15
             AND regexp_replace(phone_number, '[^0-9]', '', 'g') <> '0000000'
            THEN regexp_replace(phone_number, '[^0-9]', '', 'g') END AS phone,
       CASE WHEN regexp_matches(lower(trim(email_address)), '^[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}$')
            THEN lower(trim(email_address)) END AS email
FROM profiles
"""

PROFILES_CTE = f"profiles AS ({plain(PROFILES)})"
KEYED_CTE = f"{PROFILES_CTE}, keyed AS ({_CLEAN})"


def profiles(t: Tables) -> DataFrame:
    return t.sql(PROFILES)


def keyed(t: Tables) -> DataFrame:
    """Profiles with match keys; invalid contacts and the hub phone are null."""
    p = profiles(t)
    phone, email = contact.clean_phone(F.col("phone_number")), contact.clean_email(F.col("email_address"))
    return p.select(
        "src_id", "market_code", "brand_code", "source_code", "source_entity_id", "action", "source_timestamp",
        "city", "balance",
        tx.alnum_key(F.col("first_name")).alias("fn"), tx.alnum_key(F.col("last_name")).alias("ln"),
        F.when(contact.valid_phone(phone) & (phone != HUB_PHONE), phone).alias("phone"),
        F.when(contact.valid_email(email), email).alias("email"),
    )


# Events as a source log: one key per user and type; errors are deletions.
MESSAGES = """
SELECT event_id, user_id, event_type, ts, value,
       CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'CREATE' ELSE 'CHANGE' END AS action
FROM {events}
"""
MESSAGES_CTE = f"messages AS ({plain(MESSAGES)})"
SPLIT_DATE = "2024-01-16"


def messages(t: Tables) -> DataFrame:
    return t.sql(MESSAGES)


# Paths of up to 64 nodes: k - (k + 1) unless k + 1 is a multiple of 64.
CHAIN = """
SELECT a.c_custkey AS src, b.c_custkey AS dst
FROM {customer} a JOIN {customer} b ON b.c_custkey = a.c_custkey + 1
WHERE b.c_custkey % 64 <> 0
"""
