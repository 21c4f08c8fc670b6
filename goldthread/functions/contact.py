"""E-mail and phone normalisers with validity, and what is wrong with a contact as a list of findings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Accepted e-mail form and phone length.
EMAIL_FORM = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"
PHONE_DIGITS = (7, 15)


def clean_email(c: Column) -> Column:
    return F.lower(F.trim(c))


def valid_email(c: Column) -> Column:
    return F.coalesce(c.rlike(EMAIL_FORM), F.lit(False))


def clean_phone(c: Column) -> Column:
    """Digits only; empty when there are none."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), "[^0-9]", "")


def valid_phone(c: Column) -> Column:
    low, high = PHONE_DIGITS
    return F.coalesce(F.length(c).between(low, high), F.lit(False))


def quality(valid: Column) -> Column:
    return F.when(valid, "VALID").otherwise("INVALID")


def findings(**faults: Column) -> Column:
    """The names of the faults that hold, sorted by position and joined by a comma; ``ok`` when none does."""
    found = F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), name) for name, test in faults.items()]))
    return F.when(F.size(found) == 0, "ok").otherwise(F.array_join(found, ","))


def email_reason(c: Column) -> Column:
    blank = F.coalesce(c, F.lit("")) == ""
    return findings(empty=blank, malformed=~blank & ~valid_email(c))


def phone_reason(c: Column) -> Column:
    low, high = PHONE_DIGITS
    digits = F.length(F.coalesce(c, F.lit("")))
    return findings(empty=digits == 0, too_short=digits.between(1, low - 1), too_long=digits > high)


def address_reason(city: Column, province: Column) -> Column:
    return findings(no_city=city.isNull(), no_province=province.isNull())
