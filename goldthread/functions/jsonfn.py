"""JSON columns: object-or-array nodes, typed lists, element lookup, clean-up, envelopes."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType, VariantType


def as_array_text(c: Column) -> Column:
    """JSON text that is always an array: ``{..}`` becomes ``[{..}]``, blank becomes null."""
    text = F.trim(c)
    return F.when(text.startswith("{"), F.concat(F.lit("["), text, F.lit("]"))).when(text != "", text)


def parse_list(c: Column, element: DataType | str) -> Column:
    """Array of ``element`` from a node that holds one object or an array of them."""
    if isinstance(element, DataType):
        return F.from_json(as_array_text(c), ArrayType(element))
    return F.from_json(as_array_text(c), f"array<{element}>")


def node(c: Column, *path: str) -> Column:
    """JSON text below ``path`` (names may hold ``@`` and other signs)."""
    return F.get_json_object(c, "$" + "".join(f"['{p}']" for p in path))


def explode_list(
    df: DataFrame, json: Column, element: DataType | str, keep: Sequence[str], keep_empty: bool = False,
    alias: str = "item",
) -> DataFrame:
    """Child rows of a JSON list: the ``keep`` columns and one struct per element, with its position."""
    generator = F.posexplode_outer if keep_empty else F.posexplode
    return df.select(*keep, generator(parse_list(json, element)).alias(f"{alias}_pos", alias))


def element_by(arr: Column, field: str, value: str) -> Column:
    """First array element whose ``field`` equals ``value``, else null."""
    return F.try_element_at(F.filter(arr, lambda x: x[field] == value), F.lit(1))


def document(value: Column) -> Column:
    """JSON text that keeps null members."""
    return F.to_json(value, {"ignoreNullFields": "false"})


def drop_empty_lists(c: Column, names: Sequence[str]) -> Column:
    """Remove the named members that hold an empty array."""
    out = c
    for name in names:
        out = F.regexp_replace(out, rf'"{name}":\[\],?', "")
    return F.regexp_replace(out, r",\}", "}")


def empty_lists_to_null(c: Column) -> Column:
    return F.regexp_replace(c, r":\[\]", ":null")


def drop_null_members(c: Column, names: Sequence[str]) -> Column:
    """Remove the named members that hold null."""
    out = c
    for name in names:
        out = F.regexp_replace(out, rf'"{name}":null,?', "")
    return F.regexp_replace(out, r",\}", "}")


def mapping_envelope(
    action: Column, document_timestamp: Column, document_uuid: Column, record_uuid: Column, mapping_timestamp: Column,
    source_type: Column, source_id: Column, target_code: Column, target_id: Column, market: Column, brand: Column,
) -> Column:
    """Message that links a record of one source to its mapped identity."""
    def party(code_name: str, code: Column, ident: Column) -> Column:
        return F.struct(
            code.alias(code_name), market.alias("MarketCode"), brand.alias("BrandCode"), ident.alias("Id")
        )

    header = F.struct(
        action.alias("@Action"), document_timestamp.alias("DocumentTimestamp"), document_uuid.alias("DocumentUUID")
    )
    mapping = F.struct(
        record_uuid.alias("@RecordUUID"),
        mapping_timestamp.alias("MappingTimestamp"),
        party("@TypeCode", source_type, source_id).alias("MasterConsumer"),
        F.struct(party("@Code", target_code, target_id).alias("MappingConsumer")).alias("MappingConsumerList"),
    )
    body = F.struct(header.alias("Header"), mapping.alias("ConsumerMapping"))
    return document(F.struct(body.alias("ConsumerMappingList")))


_JSON_SPACE = " \t\r\n"  # what JSON allows before a value


# A quoted name, or a type that stands where a type can stand: at the start, after a name's colon, or inside ARRAY<>.
_TYPES = re.compile(r"`(?:[^`]|``)*`|(?:(?<=: )|(?<=ARRAY<)|^)(OBJECT|VARIANT|VOID)(?=[<,>]|$)")


def infer_schema(df: DataFrame, json: str, mixed: str = "STRING") -> str:
    """Schema of a JSON column over all of its rows (one aggregate), as DDL text for ``from_json``.

    Names stay as they are; ``mixed`` is the type of a member that holds different types in different rows. With VARIANT the
    root may be of any type too.
    """
    found = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(json))).alias("ddl")).first()[0]
    types = {"OBJECT": "STRUCT", "VARIANT": mixed, "VOID": "STRING"}
    ddl = _TYPES.sub(lambda m: types[m[1]] if m[1] else m[0], found)
    if mixed == "VARIANT" and not ddl.startswith("STRUCT<"):
        return ddl if ddl.startswith("ARRAY<") else "VARIANT"  # a list, a scalar, or different types at the root
    return ddl if ddl.startswith("STRUCT<") else "STRUCT<>"


def opens(json: Column) -> Column:
    """Whether a text, if it is JSON, is an object or array."""
    return F.coalesce(F.substr(F.ltrim(json, F.lit(_JSON_SPACE)), F.lit(1), F.lit(1)).isin("{", "["), F.lit(False))


def path_name(name: str) -> str:
    """A member's name in a path; quoted when it holds a sign that paths use."""
    return f"`{name}`" if re.search(r"[.\[\]`]", name) else name


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, which is computed once however often ``use`` names it, also inside lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def flatten_paths(
    schema: DataType, value: Column, path: str = "", keyed: Mapping[str, str | Sequence[str]] | None = None, unwrap: bool = False,
    full: Column | None = None,
) -> Column:
    """Array of ``(path, type, value)`` for every leaf below ``value``, following its declared type.

    An array element's place in the path is its index, or the value of its key member when ``keyed``
    names one for that array path (``a``, ``a[].b``), so that unordered lists can be compared by key.
    A key may be several members (``("Code", "Source.Id")``); ``*`` is the element's whole content.
    An array itself is a leaf too, with its length as value. With ``unwrap`` a list of one element is that element.
    An object or array in a variant is one leaf of type ``variant``, with its text as value; ``variant_children`` opens it.
    ``path`` is without places; ``full`` is the path with them, below a list.
    """
    keyed = keyed or {}
    at = F.lit(path) if full is None else full
    if isinstance(schema, StructType):
        parts = []
        for f in schema:
            name = f".{path_name(f.name)}" if path else path_name(f.name)
            inner = None if full is None else F.concat(full, F.lit(name))
            parts.append(flatten_paths(f.dataType, value.getField(f.name), path + name, keyed, unwrap, inner))
        inside = F.concat(*parts) if parts else _leaf(at, "object", F.lit("{}"))
        return F.when(value.isNotNull(), inside).otherwise(_leaf(at, "null", F.lit(None)))
    if isinstance(schema, ArrayType):
        element = lambda x, i: _element_paths(schema.elementType, x, i, path, keyed, unwrap, at)
        leaves = F.concat(_leaf(at, "array", F.size(value)), F.flatten(F.transform(value, element)))
        if unwrap:
            leaves = F.when(F.size(value) == 1, flatten_paths(schema.elementType, F.get(value, F.lit(0)), path, keyed, unwrap, full)).otherwise(leaves)
        return F.when(value.isNull(), _leaf(at, "null", F.lit(None))).otherwise(leaves)
    if isinstance(schema, VariantType):
        return F.array(variant_leaf(at, value))
    return F.when(value.isNull(), _leaf(at, "null", F.lit(None))).otherwise(
        _leaf(at, schema.simpleString(), value.cast("string"))
    )


def _element_paths(
    schema: DataType, x: Column, i: Column, path: str, keyed: Mapping[str, str | Sequence[str]], unwrap: bool, at: Column,
) -> Column:
    """The leaves of the element ``x`` with index ``i`` of the list ``path`` (``at``, with places)."""
    member = keyed.get(path)

    def inside(place: Column) -> Column:
        return flatten_paths(schema, x, f"{path}[]", keyed, unwrap, F.concat(at, F.lit("["), place, F.lit("]")))

    if member == "*":
        return _bound(F.md5(F.to_json(F.struct(x.alias("x")))), inside)
    if member:
        parts = [reduce(lambda v, name: v[name], p.split("."), x) for p in ([member] if isinstance(member, str) else member)]
        return _bound(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), inside)
    return inside(i.cast("string"))


def root_list_paths(
    schema: ArrayType, n: Column, x: Column, i: Column, keyed: Mapping[str, str | Sequence[str]], unwrap: bool,
) -> Column:
    """What ``flatten_paths`` gives for a list at the root, from its rows by ``posexplode_outer``: ``x`` with index ``i`` of ``n`` elements.

    The row of the first element holds the list's own leaf too; a list that is empty (``n`` 0) or null (``n`` null) is one row.
    """
    root = F.lit("")
    length = _leaf(root, "array", n)
    inside = _element_paths(schema.elementType, x, i, "", keyed, unwrap, root)
    leaves = F.concat(F.slice(length, F.lit(1), F.when(i == 0, 1).otherwise(0)), inside)
    if unwrap:
        leaves = F.when(n == 1, flatten_paths(schema.elementType, x, "", keyed, unwrap)).otherwise(leaves)
    return F.when(n.isNull(), _leaf(root, "null", F.lit(None))).when(n == 0, length).otherwise(leaves)


def _leaf(path: Column, kind: str, value: Column) -> Column:
    return F.array(
        F.struct(path.alias("path"), F.lit(kind).alias("type"), value.cast("string").alias("value"))
    )


def variant_leaf(path: Column, value: Column) -> Column:
    """``(path, type, value)`` of a variant: the value of a scalar, the text of an object or array (type ``variant``)."""
    return _bound(variant_kind(value), lambda kind: variant_struct(path, kind, value))


def variant_kind(value: Column) -> Column:
    """The type of a variant's leaf."""
    return _bound(F.schema_of_variant(value), _variant_kind)


def _variant_kind(found: Column) -> Column:
    """The type of a leaf, from the schema of its variant."""
    starts = lambda *names: reduce(lambda a, b: a | b, [found.startswith(n) for n in names])
    return (
        F.when(found.isNull() | (found == "VOID"), "null").when(starts("OBJECT<", "ARRAY<"), "variant")
        .when(starts("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "number").otherwise(F.lower(found)))


def variant_struct(path: Column, kind: Column, value: Column) -> Column:
    text = F.when(kind == "variant", F.to_json(value)).when(kind != "null", F.try_variant_get(value, "$", "string"))
    return F.struct(path.alias("path"), kind.alias("type"), text.alias("value"))


def variant_children(
    level: DataFrame, keys: Sequence[str], keyed: Mapping[str, str | Sequence[str]] | None = None, unwrap: bool = False,
) -> DataFrame:
    """``keys, path, type, value`` one level below ``level`` (``keys, path, value``, the text of an object or array); names and places as in
    ``flatten_paths``. A text that is no JSON has no children.

    Every child is a row of its own (``variant_explode``), so its leaf is compiled code and not a lambda over a list.
    """
    listed = F.ltrim(F.col("value"), F.lit(_JSON_SPACE)).startswith("[")
    parsed = level.select(*keys, F.col("path").alias("_at"), listed.alias("_list"), F.try_parse_json("value").alias("_v"))
    size = F.when(F.col("_list"), F.size(F.try_variant_get("_v", "$", "array<variant>")))
    parsed = parsed.select("*", size.alias("_n"), F.col("_v").isNull().alias("_none"))
    children = level.sparkSession.tvf.variant_explode_outer(F.col("_v").outer()).toDF("_i", "_name", "_x")
    rows = parsed.lateralJoin(children).drop("_v")
    at, i, x = F.col("_at"), F.col("_i"), F.col("_x")
    place = i.cast("string")
    for of, member in (keyed or {}).items():
        if member == "*":
            key = F.md5(F.to_json(x))
        else:
            names = [member] if isinstance(member, str) else member
            inside = ["$" + "".join(f"['{n}']" for n in name.split(".")) for name in names]
            key = F.concat_ws("|", *[F.coalesce(F.try_variant_get(x, n, "string"), F.lit("")) for n in inside])
        place = F.when(F.regexp_replace("_at", r"\[[^\]]*\]", "[]") == of, key).otherwise(place)
    name = F.when(F.col("_name").rlike(r"[.\[\]`]"), F.concat(F.lit("`"), "_name", F.lit("`"))).otherwise(F.col("_name"))
    path = F.when(F.col("_list"), F.concat("_at", F.lit("["), place, F.lit("]"))).when(at == "", name).otherwise(F.concat("_at", F.lit("."), name))
    rows = rows.select(*keys, "_at", "_list", "_i", "_n", "_none", path.alias("_path"), "_x", _variant_kind(F.schema_of_variant("_x")).alias("_kind"))
    child = F.array(variant_struct(F.col("_path"), F.col("_kind"), x))
    length = _leaf(at, "array", F.col("_n"))
    empty = F.when(F.col("_list"), length).otherwise(_leaf(at, "object", F.lit("{}")))
    found = F.when(F.col("_list") & (i == 0), F.concat(length, child)).otherwise(child)
    if unwrap:
        found = F.when(F.col("_n") == 1, F.array(variant_struct(at, F.col("_kind"), x))).otherwise(found)
    return rows.select(*keys, F.explode(F.when(~F.col("_none"), F.when(i.isNull(), empty).otherwise(found))).alias("_l")).select(*keys, "_l.*")
