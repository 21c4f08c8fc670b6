"""Nested documents: child lists, assembly, and comparison of documents by path."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, FractionalType, IntegralType, NullType, StringType, StructType

from goldthread.functions.jsonfn import flatten_paths, infer_schema, opens, root_list_paths, variant_children, variant_kind, variant_struct
from goldthread.operators.dedup import latest_per_key
from goldthread.operators.ordering import number_rows
from goldthread.session import stage


_OUTSIDE_NAMES = re.compile(r"`(?:[^`]|``)*`")  # the quoted names of a schema text


@dataclass(frozen=True)
class ChildList:
    """Child rows that become one list of the document: what an element holds, and its order."""

    rows: DataFrame
    element: Mapping[str, Column | str]
    order: tuple[str, ...]


def nest_children(rows: DataFrame, keys: Sequence[str], element: Mapping[str, Column | str], order: Sequence[str],
                  name: str = "items") -> DataFrame:
    """``keys, <name>``: the children of each key as one sorted list."""
    return nest_lists({name: ChildList(rows, element, tuple(order))}, keys)


def nest_lists(lists: Mapping[str, ChildList], keys: Sequence[str]) -> DataFrame:
    """Several child lists per key in one shuffle, always one row per key: a tagged union and a single aggregation.

    Map tasks gather their share of a list; only the last step holds a whole key, as the resulting row does. Where lists need
    not be one value, ``numbered_children`` gives the same elements as rows.
    """
    keys, names = list(keys), list(lists)
    payload = {}
    for name, c in lists.items():
        payload[name] = c.rows.select(*keys, F.struct(F.struct(*c.order).alias("o"), _element(c).alias("e")).alias(f"_{name}"))
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), payload.values())
    gathered = union.groupBy(*keys).agg(*[F.array_sort(F.collect_list(f"_{n}")).alias(n) for n in names])
    return gathered.select(*keys, *[F.transform(n, lambda x: x["e"]).alias(n) for n in names])


def _element(c: ChildList) -> Column:
    return F.struct(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in c.element.items()])


def numbered_children(children: ChildList, keys: Sequence[str]) -> DataFrame:
    """``keys, position, element``: the elements of the lists as rows, numbered from 1 without gathering a key in a task."""
    rows = children.rows.select(*keys, *[F.col(c).alias(f"_o{i}") for i, c in enumerate(children.order)], _element(children).alias("element"))
    order = [f"_o{i}" for i in range(len(children.order))]
    return number_rows(rows, [*order, "element"], keys, "position").drop(*order)


def assemble(heads: DataFrame, lists: Mapping[str, ChildList], keys: Sequence[str]) -> DataFrame:
    """Heads with all their lists (null when a head has none), one row per head."""
    joined = heads.join(nest_lists(lists, keys), list(keys), "left")
    return joined.withColumns({n: F.when(F.size(n) > 0, F.col(n)) for n in lists})


@dataclass(frozen=True)
class CompareRules:
    """Paths are without array places: ``a.b[].c``.

    ``keyed`` lists are matched by a key. ``unordered`` ones have none: equal elements match whatever their place, and of
    the rest those that share most leaves are compared with each other. ``unwrap_single`` takes a list of one element as that
    element.
    """

    ignore: tuple[str, ...] = ()
    trim: tuple[str, ...] = ()
    keyed: Mapping[str, str | Sequence[str]] | None = None
    unordered: tuple[str, ...] = ()
    null_equals_empty: bool = True
    unwrap_single: bool = False


def open_variants(leaves: DataFrame, level: DataFrame, keys: Sequence[str], keyed: Mapping[str, str | Sequence[str]], unwrap: bool) -> DataFrame:
    """``leaves`` (``keys, path, type, value``) and all that ``level`` (``keys, path, value``: texts of objects and arrays) holds.

    One level of all documents at a time, by each row's own type; a level is written once, and there are as many as the deepest one has.
    """
    while not level.isEmpty():
        below = stage(variant_children(level, keys, keyed, unwrap), "variants")
        leaves, level = leaves.unionByName(below.filter("type <> 'variant'")), below.filter("type = 'variant'")
    return leaves


def _root_variants(df: DataFrame, keys: Sequence[str], json: str) -> tuple[DataFrame, DataFrame]:
    """Of documents of any shape the leaves (scalars, nulls and texts that are no JSON) and the level of objects and arrays.

    The first sign of a text tells which it is, so neither side parses the other's texts, except to find those that are no JSON.
    """
    text, nested = F.col(json), opens(F.col(json))
    rest = df.select(*keys, text.alias("_text"), F.try_parse_json(text).alias("_d"), nested.alias("_nested")).filter("NOT _nested OR _d IS NULL")
    rest = rest.select(*keys, "_text", "_d", variant_kind(F.col("_d")).alias("_kind"))
    unread = F.struct(F.lit("").alias("path"), F.lit("unreadable").alias("type"), F.col("_text").alias("value"))
    leaf = F.when(F.col("_text").isNotNull() & F.col("_d").isNull(), unread).otherwise(variant_struct(F.lit(""), F.col("_kind"), F.col("_d")))
    return rest.select(*keys, leaf.alias("_l")).select(*keys, "_l.*"), df.filter(nested).select(*keys, F.lit("").alias("path"), text.alias("value"))


def _declared_paths(df: DataFrame, keys: Sequence[str], json: str, ddl: str, places: Mapping[str, str | Sequence[str]], unwrap: bool) -> DataFrame:
    broken = F.col(json).isNotNull() & F.try_parse_json(F.col(json)).isNull()
    body = df.select(*keys, F.from_json(json, ddl).alias("_d"), F.when(broken, F.col(json)).alias("_text"))
    kind = body.schema["_d"].dataType
    if isinstance(kind, ArrayType):  # a row per element: expressions on rows are compiled, lambdas are not
        held = F.when(F.col("_text").isNull(), F.col("_d"))
        body = body.select(*keys, "_text", held.alias("_d")).select("*", F.when(F.col("_d").isNotNull(), F.size("_d")).alias("_n"))
        body = body.select(*keys, "_text", "_n", F.posexplode_outer("_d").alias("_i", "_x"))
        flat = root_list_paths(kind, F.col("_n"), F.col("_x"), F.col("_i"), places, unwrap)
    else:
        flat = flatten_paths(kind, F.col("_d"), keyed=places, unwrap=unwrap)
    unread = F.array(F.struct(F.lit("").alias("path"), F.lit("unreadable").alias("type"), F.col("_text").alias("value")))
    leaves = body.select(*keys, F.explode(F.when(F.col("_text").isNotNull(), unread).otherwise(flat)).alias("_l"))
    return leaves.select(*keys, "_l.*")


def document_paths(df: DataFrame, keys: Sequence[str], json: str, ddl: str, rules: CompareRules) -> DataFrame:
    """``keys, path, type, value``: one row per leaf of the document; a text that is no JSON is one leaf of type unreadable.

    What ``ddl`` declares is flattened in one expression. Its variants (members, or whole documents, whose type differs by row) are
    opened level by level.
    """
    places = {**(rules.keyed or {}), **dict.fromkeys(rules.unordered, "*")}
    if ddl == "VARIANT":
        leaves = open_variants(*_root_variants(df, keys, json), keys, places, rules.unwrap_single)
    else:
        leaves = _declared_paths(df, keys, json, ddl, places, rules.unwrap_single)
        if "VARIANT" in _OUTSIDE_NAMES.sub("", ddl):
            level = stage(leaves.filter("type = 'variant'"), "variants")
            leaves = open_variants(leaves.filter("type <> 'variant'"), level, keys, places, rules.unwrap_single)
    leaves = leaves.withColumn("_plain", F.regexp_replace("path", r"\[[^\]]*\]", "[]"))
    for path in rules.ignore:
        leaves = leaves.filter(~F.col("_plain").rlike(rf"^{re.escape(path)}([.\[]|$)"))
    if rules.trim:
        leaves = leaves.withColumn("value", F.when(F.col("_plain").isin(*rules.trim), F.trim("value")).otherwise(F.col("value")))
    if rules.null_equals_empty:
        leaves = leaves.withColumn("value", F.when(F.col("value") != "", F.col("value")))
    if not places:
        return leaves.select(*keys, "path", "type", "value")
    # A path can repeat only inside one document (elements of a list with the same key).
    return leaves.groupBy(*keys, "path").agg(
        F.max("type").alias("type"), F.array_join(F.sort_array(F.collect_list("value")), "\u001e").alias("value"),
        F.count("value").alias("_filled"),
    ).withColumn("value", F.when(F.col("_filled") > 0, F.col("value"))).drop("_filled")


_PLAIN_PATH = re.compile(r"\w+(\.\w+)*")
_PRINTED = (StringType, BooleanType, IntegralType, FractionalType, NullType)  # what to_json prints so that different values differ


def _is_printed(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_is_printed(f.dataType) for f in kind.fields)
    return _is_printed(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, _PRINTED)


def _kind_at(kind: DataType, path: str) -> DataType | None:
    for name in path.split("."):
        kind = kind[name].dataType if isinstance(kind, StructType) and name in kind.names else None
    return kind


def _digests(df: DataFrame, keys: Sequence[str], json: str, ddl: str, unordered: Sequence[str]) -> DataFrame | None:
    """``keys`` and a digest of the key's documents: sums of their hashes, so that neither their order nor that of ``unordered`` lists counts.

    A document counts by what it holds as ``ddl`` reads it, printed again; None where not every difference would be printed.
    """
    broken = F.col(json).isNotNull() & F.try_parse_json(F.col(json)).isNull()
    body = df.select(*keys, F.from_json(json, ddl).alias("_d"), F.when(broken, F.col(json)).alias("_text"))
    kind = body.schema["_d"].dataType
    if not _is_printed(kind):
        return None
    held = F.col("_d")
    for path in unordered:  # other places of lists keep their order: equal lists in another order are then compared leaf by leaf
        if _PLAIN_PATH.fullmatch(path) and isinstance(_kind_at(kind, path), ArrayType):
            held = F.when(held[path.split(".")[0]].isNotNull(), held.withField(path, F.sort_array(reduce(lambda c, n: c[n], path.split("."), F.col("_d"))))).otherwise(held)
    body = body.select(*keys, F.to_json(F.struct(held.alias("d"), F.col("_text").alias("t"))).alias("_text"))
    parts = []
    for seed in (0, 1):
        hash_ = F.xxhash64(F.lit(seed), F.col("_text"))
        parts += [F.sum(F.shiftright(hash_, 32)), F.sum(hash_.bitwiseAND(F.lit(0xFFFFFFFF)))]
    return body.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[p.alias(f"_h{i}") for i, p in enumerate(parts)])


def without_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], json: str, ddl: str, unordered: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides without the keys that hold the same documents on both: they have no differences, and most documents seldom change.

    Rows with a null in their keys stay, as these match nothing. Only digests meet, then documents with the keys that go.
    """
    a, b = (_digests(d, keys, json, ddl, unordered) for d in (left, right))
    if a is None:
        return left, right
    digest = ["_n", *[f"_h{i}" for i in range(4)]]
    equal = stage(a.join(b, [*keys, *digest]).select(*keys), "equal")
    return left.join(equal, list(keys), "left_anti"), right.join(equal, list(keys), "left_anti")


PAIRS_PER_LEAF = 1024  # a leaf whose free elements make more pairs is common: it pairs by rank, never with all


def _dominant(edges: DataFrame, names: Sequence[str]) -> DataFrame:
    """A matching of weighted ``edges`` (``names, _left, _right, _n``): what taking the heaviest edge first gives.

    Rounds over all lists at once: an edge that is the best of both its ends is taken, the edges of matched elements go.
    Equal weights are ordered by a hash of the edge, so the rounds are few however many ties a list has.
    """
    order = F.struct((-F.col("_n")).alias("w"), F.xxhash64("_left", "_right").alias("h"), "_left", "_right")
    edges, found = stage(edges.withColumn("_order", order), "edges"), None
    while not edges.isEmpty():
        best = lambda side: edges.groupBy(*names, side).agg(F.min("_order").alias("_order"))
        tops = best("_left").select(*names, "_order").intersect(best("_right").select(*names, "_order"))
        taken = stage(tops.select(*names, "_order._left", "_order._right"), "matched")
        found = taken if found is None else found.unionByName(taken)
        for side in ("_left", "_right"):
            edges = edges.join(taken.select(*names, side), [*names, side], "left_anti")
        edges = stage(edges, "edges")
    return found


def _by_rank(lefts: DataFrame, rights: DataFrame, groups: Sequence[str], names: Sequence[str]) -> DataFrame:
    """The first element of each group on one side with the first on the other, and so on; numbered without gathering a group."""
    left, right = number_rows(lefts, ["_left"], groups, "_i"), number_rows(rights, ["_right"], groups, "_i")
    return left.join(right.select(*groups, "_i", "_right"), [*groups, "_i"]).select(*names, "_left", "_right")


def match_elements(lefts: DataFrame, rights: DataFrame, names: Sequence[str]) -> DataFrame:
    """``names, _left, _right``: elements of two sides of a list paired by equal leaves, each at most once.

    ``lefts`` and ``rights`` hold ``names`` (of the list), ``_left`` or ``_right`` and ``_leaf``, one row per leaf. Rare leaves first: where a
    leaf's free elements make at most ``PAIRS_PER_LEAF`` pairs, these are weighed by all their equal leaves and matched (:func:`_dominant`). When only
    common leaves are left, elements with the same open leaves are paired by rank, then those with the same rarest leaf. So
    work grows with the leaves, also where all elements of a long list share one.
    """
    names = list(names)
    key = [*names, "_leaf"]
    found = None
    lefts, rights = stage(lefts, "lefts"), stage(rights, "rights")
    while True:
        sizes = lefts.groupBy(*key).agg(F.count(F.lit(1)).alias("_l")).join(rights.groupBy(*key).agg(F.count(F.lit(1)).alias("_r")), key)
        sizes = stage(sizes.select(*key, (F.col("_l") * F.col("_r")).alias("_pairs")), "leaf-sizes")
        top = sizes.agg(F.count(F.lit(1)).alias("n"), F.min("_pairs").alias("least")).first()
        if not top["n"]:
            return found if found is not None else lefts.join(rights, key).select(*names, "_left", "_right").limit(0)
        if top["least"] <= PAIRS_PER_LEAF:
            rare = sizes.filter(F.col("_pairs") <= PAIRS_PER_LEAF).select(*key)
            near = stage(lefts.join(rare, key).join(rights, key).select(*names, "_left", "_right").distinct(), "near")
            equal = near.join(lefts, [*names, "_left"]).join(rights, [*names, "_right", "_leaf"])
            taken = _dominant(equal.groupBy(*names, "_left", "_right").agg(F.count(F.lit(1)).alias("_n")), names)
        else:
            open_ = lambda rows, side: stage(rows.join(sizes, key).groupBy(*names, side).agg(
                F.xxhash64(F.sort_array(F.collect_list("_leaf"))).alias("_all"), F.min(F.struct("_pairs", "_leaf")).getField("_leaf").alias("_rarest"),
            ), "open")
            a, b = open_(lefts, "_left"), open_(rights, "_right")
            taken = stage(_by_rank(a, b, [*names, "_all"], names), "matched")
            a, b = a.join(taken, [*names, "_left"], "left_anti"), b.join(taken, [*names, "_right"], "left_anti")
            taken = taken.unionByName(stage(_by_rank(a, b, [*names, "_rarest"], names), "matched"))
        found = taken if found is None else found.unionByName(taken)
        lefts = stage(lefts.join(taken, [*names, "_left"], "left_anti"), "lefts")
        rights = stage(rights.join(taken, [*names, "_right"], "left_anti"), "rights")


def align_unordered(lefts: DataFrame, rights: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """``rights`` with the elements of the unordered list ``path`` renamed after the elements of ``lefts`` they are closest to.

    Both hold leaves whose path the other side has not. An element's place is the hash of its content, so equal elements agree already and
    are not among them; the others are paired by equal leaves (:func:`match_elements`), all lists of all documents at once.
    """
    inside = re.escape(path).replace(re.escape("[]"), r"\[[^\]]*\]")
    form = rf"^({inside}\[)[0-9a-f]{{32}}\].*$"
    names = [*keys, "_list"]

    def parts(df: DataFrame, list_: str, name: str, sub: str) -> DataFrame:
        """With the list, the element's hash and what follows, all cut from one match of the path; null where the path is not inside."""
        head = F.length(F.nullif(F.regexp_extract("path", form, 1), F.lit("")))
        cut = df.withColumn("_at", head)
        at = F.col("_at")
        return cut.withColumns({
            list_: F.substr("path", F.lit(1), at - 1), name: F.substr("path", at + 1, F.lit(32)), sub: F.substr("path", at + 34)})

    def split(df: DataFrame, name: str) -> DataFrame:
        leaf = F.sha2(F.concat_ws("\u001f", "_sub", "value"), 256).alias("_leaf")
        return parts(df, "_list", name, "_sub").filter("_at IS NOT NULL AND value IS NOT NULL").select(*names, name, leaf)

    pairs = match_elements(split(lefts, "_left"), split(rights, "_right"), names).withColumnsRenamed({"_list": "_l", "_right": "_r"})
    joined = parts(rights, "_l", "_r", "_s").join(pairs, [*keys, "_l", "_r"], "left")
    moved = F.concat("_l", F.lit("["), "_left", F.lit("]"), "_s")
    return joined.withColumn("path", F.when(F.col("_left").isNotNull(), moved).otherwise(F.col("path"))).select(*rights.columns)


def _sides(a: DataFrame, b: DataFrame, keys: Sequence[str], rules: CompareRules) -> DataFrame:
    """``a`` and ``b`` (``keys, path, type, value``) side by side with the ``kind`` of their difference, null where they are equal.

    ``_only`` is a or b where the other side has no such path.
    """
    a = a.withColumnsRenamed({"type": "_ta", "value": "left_value"}).withColumn("_a", F.lit(True))
    b = b.withColumnsRenamed({"type": "_tb", "value": "right_value"}).withColumn("_b", F.lit(True))
    joined = a.join(b, [*keys, "path"], "full_outer")
    same = F.col("left_value").eqNullSafe(F.col("right_value"))
    equal = same if rules.null_equals_empty else same & F.col("_ta").isNotNull() & F.col("_tb").isNotNull()
    kind = (
        F.when(equal, None)
        .when((F.col("_ta") == "unreadable") | (F.col("_tb") == "unreadable"), "unreadable")
        .when(F.coalesce("_ta", F.lit("null")) == "null", "missing_left")
        .when(F.coalesce("_tb", F.lit("null")) == "null", "missing_right")
        .when((F.col("_ta") == "array") & (F.col("_tb") == "array"), "length")
        .when((F.col("_ta") != F.col("_tb")), "type")
        .when(~same, "value")
    )
    only = F.when(F.col("_b").isNull(), "a").when(F.col("_a").isNull(), "b")
    return joined.select(*keys, "path", "_ta", "_tb", "left_value", "right_value", kind.alias("kind"), only.alias("_only"))


def document_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], json: str, rules: CompareRules = CompareRules(),
                  latest: Sequence[Column] = (), ddl: str | None = None) -> DataFrame:
    """Differences of two sets of documents: ``keys, path, kind, left_value, right_value``.

    ``kind`` is missing_left or missing_right (absent or null there), type, length (of a list), value, or unreadable (a text that is
    no JSON); ``latest`` picks
    one document per key and side. Both sides become rows, so one large document or one large key is spread like any other data.
    """
    if latest:
        columns = [*keys, json]  # written once: read for the schema and again for the leaves
        left, right = (stage(latest_per_key(d, keys, latest).select(*columns), "documents") for d in (left, right))
    ddl = ddl or infer_schema(left.select(json).unionByName(right.select(json)), json, "VARIANT")
    if rules.unordered:
        left, right = without_equal(left, right, keys, json, ddl, rules.unordered)
    a, b = (document_paths(d, keys, json, ddl, rules) for d in (left, right))
    sides = _sides(a, b, keys, rules)
    for path in sorted(rules.unordered, key=len):  # outer lists first: inner ones are compared inside paired elements
        open_ = stage(sides.filter("kind IS NOT NULL OR _only IS NOT NULL"), "open")  # equal leaves have done their part
        a = open_.filter("_only = 'a'").select(*keys, "path", F.col("_ta").alias("type"), F.col("left_value").alias("value"))
        b = open_.filter("_only = 'b'").select(*keys, "path", F.col("_tb").alias("type"), F.col("right_value").alias("value"))
        sides = open_.filter("_only IS NULL").unionByName(_sides(a, align_unordered(a, b, keys, path), keys, rules))
    return sides.filter("kind IS NOT NULL").select(*keys, "path", "kind", "left_value", "right_value")
