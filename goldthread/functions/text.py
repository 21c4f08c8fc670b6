"""Name, address and text normalisers as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Texts that mean "no name".
NO_VALUE = ("-", "", "N/A", "UNKNOWN", "NULL", "NA")

WIDE_SPACE = "　"


def blank(c: Column) -> Column:
    """Null or only white space."""
    return c.isNull() | (F.trim(c) == "")


def not_blank(c: Column) -> Column:
    return ~blank(c)


def blank_to_null(c: Column) -> Column:
    return F.when(not_blank(c), c)


def fallback(first: Column, second: Column) -> Column:
    """``first`` unless it is blank, then ``second``."""
    return F.when(blank(first), second).otherwise(first)


def clean_name(c: Column, sentinels: Sequence[str] = NO_VALUE) -> Column:
    """Trimmed name; null for blanks and placeholder texts."""
    return F.when(~F.upper(F.trim(c)).isin(*sentinels), F.trim(c))


def alnum_key(c: Column, blank_is_null: bool = True) -> Column:
    """Upper-case match key of letters, digits and spaces.

    ``blank_is_null`` keeps empty keys out of matching (an empty name must not equal an empty name).
    """
    key = F.upper(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9 ]", "")))
    return F.when(key != "", key) if blank_is_null else key


def full_name(first: Column, last: Column, full: Column) -> Column:
    """First and last name when at least one is known, else the given full name."""
    return F.when(first.isNotNull() | last.isNotNull(), F.concat_ws(" ", first, last)).otherwise(full)


def reverse_tokens(c: Column) -> Column:
    """``RAJU DUDE`` -> ``DUDE RAJU``."""
    return F.array_join(F.reverse(F.split(F.trim(c), " ")), " ")


def lower_or_empty(c: Column) -> Column:
    return F.when(blank(c), "").otherwise(F.lower(c))


def lower_or_null(c: Column) -> Column:
    return F.when(not_blank(c), F.lower(c))


def lower_keep_blank(c: Column) -> Column:
    """Null stays null, blank becomes the empty text, else lower case."""
    return F.when(c.isNull(), None).when(F.trim(c) == "", "").otherwise(F.lower(c))


def address_key(*parts: Column) -> Column:
    """Lower-cased, trimmed, non-blank parts run together; null when nothing is left."""
    key = F.concat_ws("", *[F.lower(F.trim(blank_to_null(p))) for p in parts])
    return F.when(key != "", key)


def piped_address_key(*parts: Column) -> Column:
    """Upper-cased parts joined by ``|``; a missing part leaves its place empty."""
    return F.upper(F.concat_ws("|", *[F.trim(F.coalesce(p, F.lit(""))) for p in parts]))


def _name_text(c: Column, space: str) -> Column:
    """Lower case with white space (the wide space too) replaced by ``space``; blank and ``null`` -> empty."""
    squeezed = F.lower(F.regexp_replace(c, r"(?U)\s+", space))
    return F.when(c.isNull() | (F.trim(squeezed) == "") | (F.lower(c) == "null"), "").otherwise(F.trim(squeezed))


def name_tokens(first: Column, last: Column, full: Column) -> Column:
    """Distinct sorted name parts: first + last, else a full name of up to two words, else one of them.

    A full name of more than two words is one token. Null when no name is given.
    """
    f, l, whole = _name_text(first, ""), _name_text(last, ""), _name_text(full, " ")
    words = F.split(whole, " ")
    from_full = F.when(F.size(words) > 2, F.array(F.replace(whole, F.lit(" ")))).otherwise(words)
    tokens = (
        F.when((f != "") & (l != ""), F.array(f, l))
        .when(whole != "", from_full)
        .when(f != "", F.array(f))
        .when(l != "", F.array(l))
    )
    return F.array_sort(F.array_distinct(tokens))


def sorted_name_key(names: Sequence[tuple[Column, Column, Column]], separator: str = "\u001f") -> Column:
    """Struct ``(asc, desc)`` of the first name triple that holds a name, most trusted triple first.

    With the default separator two different token sets never share a key. ``separator=""`` gives the
    run-together form, in which they can.
    """
    tokens = F.coalesce(*[name_tokens(*triple) for triple in names])
    return F.struct(
        F.array_join(tokens, separator).alias("asc"),
        F.array_join(F.reverse(tokens), separator).alias("desc"),
    )


def strip_timezone(c: Column) -> Column:
    """Drop a trailing ``Z`` or ``+hh:mm`` from a timestamp text."""
    return F.regexp_replace(c.cast("string"), r"(Z|[+-]\d\d:\d\d)$", "")


def truthy(c: Column) -> Column:
    """True for true / 1 / yes in any case, else false."""
    return F.coalesce(F.lower(c.cast("string")).isin("true", "1", "yes"), F.lit(False))


def birth_date(year: Column, month: Column, day: Column) -> Column:
    """Date from its parts; null when a part is missing or the date does not exist."""
    text = F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0"))
    complete = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(complete, F.try_to_date(text, "yyyy-MM-dd"))


def padded_id(c: Column, prefix: str = "", width: int = 9) -> Column:
    """``MKT-000000001`` style ids."""
    return F.concat(F.lit(prefix), F.format_string(f"%0{width}d", c))


def mapped(c: Column, values: dict[str, str], default: Column | None = None) -> Column:
    """Look a value up in a small literal map."""
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, default)
