"""Code lists, and the expressions that use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.functions.text import blank, mapped

# Store type codes by business type; an unknown type is kept as it is.
STORE_TYPES = {
    "Distributors": "distrib",
    "Perfumery/Pharmacy": "prfphr",
    "Specialty Multi": "smc",
    "Other": "other",
    "Free Standing": "frestnstr",
    "Corp Sales": "crpstr",
    "Salon/Spa": "spasln",
    "Online Pure Play": "onlpureply",
    "Department Stores": "dprstr",
    "Intercompany": "intrcmp",
    "Off Price": "offprcrtl",
    "Brand.com": "onl",
    "Online 3PP": "3pp",
    "Travel": "trvrtl",
    "Not assigned": "",
    "No Business Type": "",
}
ONLINE_STORE = "onl"
DIRECT_STORES = ("frestnstr", "crpstr", "onl")

# Consent channels by contact kind and type.
EMAIL_CHANNELS = {"emlprs": "eml", "emlprf": "eml", "mblemlprs": "mbleml", "mblemlprf": "mbleml"}
PHONE_CHANNELS = ("sms", "mms")
MOBILE_TYPES = ("mblprs", "mblprf")
ANY_PHONE_MARKETS = ("KOR",)
ADDRESS_CHANNEL = "drcml"

# Why a row is left out, and the quality code of an invalid one.
PK_MISS, CLEAR_MISS, CONFIG = "ExcludeByPkMiss", "FailByClearMiss", "ExcludeByConfig"
CID_DUPLICATE, UID_DUPLICATE = "ExcludeByCidDuplicate", "ExcludeByUidDuplicate"
INVALID = "inv"


def store_type(business_type: Column) -> Column:
    return F.coalesce(mapped(business_type, STORE_TYPES), business_type, F.lit(""))


def store_channel(online_door: Column, type_code: Column) -> Column:
    return F.when((online_door == "Y") | (type_code == ONLINE_STORE), "Online").otherwise("Offline")


def is_direct_store(type_code: Column) -> Column:
    return F.when(type_code.isin(*DIRECT_STORES), "true").otherwise("false")


def consent_channels(kind: str, type_code: Column, market: Column) -> Column:
    """Channels whose consent applies to a contact: e-mail by type, mobile phones (any phone in some
    markets) for text messages, addresses for direct mail."""
    if kind == "email":
        return F.array_compact(F.array(mapped(type_code, EMAIL_CHANNELS)))
    if kind == "phone":
        return F.when(market.isin(*ANY_PHONE_MARKETS) | type_code.isin(*MOBILE_TYPES), F.array(*[F.lit(c) for c in PHONE_CHANNELS]))
    return F.array(F.lit(ADDRESS_CHANNEL))


def attach_consents(contacts: DataFrame, consents: DataFrame, kind: str, owner: list[str], type_code: str = "type_code", market: str = "market_code") -> DataFrame:
    """Contacts with the consent rows (``channel, optin_date, optin_flag``) of their channels; a contact
    without consent is kept. ``owner`` must hold the market."""
    c = contacts.withColumn("_channels", consent_channels(kind, F.col(type_code), F.col(market))).alias("c")
    o = consents.select(*owner, "channel", "optin_date", "optin_flag").alias("o")
    same = F.array_contains("c._channels", F.col("o.channel"))
    for k in owner:
        same = (F.col(f"c.{k}") == F.col(f"o.{k}")) & same
    return c.join(o, same, "left").select(*[F.col(f"c.{x}") for x in contacts.columns], "o.channel", "o.optin_date", "o.optin_flag")


def name_filled(market: Column, quality: list[Column], fields: list[Column], more_fields: dict[str, list[Column]], any_quality: tuple[str, ...] = ()) -> Column:
    """1 when a name field is filled and not every name is of invalid quality, else 0.

    Some markets look at more fields, some ignore the quality codes.
    """
    def empty(columns: list[Column]) -> Column:
        out = F.lit(True)
        for c in columns:
            out = out & blank(c)
        return out

    none = empty(fields)
    for name, extra in more_fields.items():
        none = F.when(market == name, empty([*fields, *extra])).otherwise(none)
    bad = F.lit(True)
    for q in quality:
        bad = bad & (F.coalesce(q, F.lit("")) == INVALID)
    if any_quality:
        bad = bad & ~market.isin(*any_quality)
    return F.when(none | bad, 0).otherwise(1)
