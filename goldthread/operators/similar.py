"""Similarity joins inside blocks that find every similar pair without comparing all pairs.

Both joins compare distinct texts of a block, not records, and reach candidates by equi-joins on text
pieces that any sufficiently similar pair must share. Candidates are then verified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from goldthread.functions.similarity import BOOST_ABOVE, PREFIX_LENGTH, PREFIX_WEIGHT, jaro_winkler, levenshtein_similarity
from goldthread.operators.skew import join_groups
from goldthread.session import stage

_EPS = 1e-9
LONG_TEXT = 48
GRAM = 4


def _floor(c: Column) -> Column:
    return F.floor(c + F.lit(_EPS)).cast("int")


def _segment_count(length: Column, threshold: float) -> Column:
    """One more segment than the largest distance any accepted partner of this length can have."""
    return _floor(length * F.lit((1 - threshold) / threshold)) + 1


def _segment_bounds(length: Column, k: Column, i: Column) -> tuple[Column, Column]:
    start = F.floor(i * length / k).cast("int")
    return start + 1, F.floor((i + 1) * length / k).cast("int") - start


def edit_similar(names: DataFrame, threshold: float, long: int = LONG_TEXT) -> DataFrame:
    """Pairs ``(block, a, b, similarity)`` of texts with edit similarity >= ``threshold``, ``a < b``.

    ``names`` has distinct ``(block, text)``. Pairs of texts up to ``long`` characters meet by segments, which are few and selective there; where
    the longer text is longer they meet by q-grams, whose number grows in proportion to the text.
    """
    sized = names.filter(F.length("text") > 0).withColumn("len", F.length("text"))
    pairs = _by_segments(sized.filter(F.col("len") <= long), threshold)
    if not sized.filter(F.col("len") > long).isEmpty():
        pairs = pairs.unionByName(_by_grams(sized.filter(F.col("len") >= threshold * (long + 1) - _EPS), threshold, long))
    return pairs.withColumn("similarity", levenshtein_similarity(F.col("a"), F.col("b"))).filter(F.col("similarity") >= threshold)


def _by_grams(sized: DataFrame, threshold: float, long: int) -> DataFrame:
    """``(block, a, b)`` with a text over ``long`` characters that may be within the distance.

    An edit touches at most q of a text's q-grams (with q - 1 marks before and after it). So of each text the q * d + 1 rarest
    grams are enough: one of them is common, at places at most d apart. q is the largest that leaves a text more grams than d edits can touch.
    """
    q = max(1, min(GRAM, int(threshold / (1 - threshold) + _EPS)))
    if q * (1 - threshold) / threshold > 1:
        raise ValueError("threshold too low: no pair of long texts can be ruled out without comparing all pairs")
    texts = stage(sized.withColumn("id", F.monotonically_increasing_id()), "texts")
    marked = F.concat(F.repeat(F.lit("\u0001"), F.lit(q - 1)), "text", F.repeat(F.lit("\u0002"), F.lit(q - 1)))
    cut = F.regexp_extract_all(marked, F.lit(rf"(?s)(?=(.{{{q}}}))."), F.lit(1))
    grams = texts.select("block", "id", "len", F.posexplode(cut).alias("at", "gram"))
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("_rows")).withColumn("n", F.col("_rows"))
    ranked = join_groups(grams, counts, ["gram"], ["id", "at"])
    kept = q * _floor(F.col("len") * F.lit((1 - threshold) / threshold)) + 1
    first = ranked.groupBy("block", "id", "len").agg(F.sort_array(F.collect_list(F.struct("n", "gram", "at"))).alias("all"))
    first = first.select("block", "id", "len", F.explode(F.slice("all", F.lit(1), kept)).alias("g")).select("block", "id", "len", "g.gram", "g.at")
    first = stage(first, "grams")
    side = lambda s: first.select("block", "gram", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "len", "at")])
    longer = F.greatest("len_a", "len_b")
    met = side("a").join(side("b"), ["block", "gram"]).filter("id_a < id_b").filter(
        (longer > long) & (F.least("len_a", "len_b") >= threshold * longer - _EPS)
        & (F.abs(F.col("at_a") - F.col("at_b")) <= _floor(longer * F.lit(1 - threshold))))
    met = met.select("block", "id_a", "id_b").distinct()
    text = lambda s: texts.select(F.col("id").alias(f"id_{s}"), F.col("text").alias(f"text_{s}"))
    both = met.join(text("a"), "id_a").join(text("b"), "id_b").filter("text_a <> text_b")
    return both.select("block", F.least("text_a", "text_b").alias("a"), F.greatest("text_a", "text_b").alias("b"))


def _by_segments(sized: DataFrame, threshold: float) -> DataFrame:
    """``(block, a, b)`` that may be within the distance: a text cut into d + 1 segments shares at least one whole segment, shifted by at
    most d, with any text within distance d (pigeonhole)."""
    length = F.col("len")

    def index_segment(i: Column) -> Column:
        k = _segment_count(length, threshold)
        start, size = _segment_bounds(length, k, i)
        return F.struct(length.alias("l"), i.alias("i"), F.substr("text", start, size).alias("seg"))

    index = sized.select(
        "block", F.col("text").alias("short"),
        F.explode(F.transform(F.sequence(F.lit(0), _segment_count(length, threshold) - 1), index_segment)).alias("p"),
    ).select("block", "short", "p.*")

    distance = _floor(length * F.lit(1 - threshold))

    def probes(l: Column) -> Column:
        k = _segment_count(l, threshold)

        def at(i: Column) -> Column:
            start, size = _segment_bounds(l, k, i)
            low, high = F.greatest(F.lit(1), start - distance), F.least(length - size + 1, start + distance)
            places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
            return F.transform(places, lambda p: F.struct(l.alias("l"), i.alias("i"), F.substr("text", p, size).alias("seg")))

        return F.flatten(F.transform(F.sequence(F.lit(0), k - 1), at))

    shortest = F.greatest(F.lit(1), F.ceil(length * F.lit(threshold) - F.lit(_EPS)).cast("int"))
    probe = sized.select(
        "block", F.col("text").alias("long"),
        F.explode(F.array_distinct(F.flatten(F.transform(F.sequence(shortest, length), probes)))).alias("p"),
    ).select("block", "long", "p.*")

    return (
        probe.join(index, ["block", "l", "i", "seg"])
        .filter(F.col("long") != F.col("short"))
        .select("block", F.least("long", "short").alias("a"), F.greatest("long", "short").alias("b"))
        .distinct()
    )


FREQUENT_TOKENS = 256  # so many most frequent tokens get a rank; all others are rarer than these


def _jaro_floor(threshold: float, prefix: int) -> float:
    """Least Jaro value of a pair with this Jaro-Winkler value whose common prefix (at most 4 counted) has this length."""
    boost = prefix * PREFIX_WEIGHT
    return threshold if threshold <= BOOST_ABOVE else max(BOOST_ABOVE, (threshold - boost) / (1 - boost))


def _char_tokens(text: Column) -> Column:
    """Characters numbered by occurrence (``a1``, ``a2``): a set standing for the multiset."""
    chars = F.split(text, "")
    numbered = F.transform(chars, lambda c, i: F.concat(c, F.size(F.filter(F.slice(chars, 1, i + 1), lambda x: x == c)).cast("string")))
    return F.when(text == "", F.array().cast("array<string>")).otherwise(numbered)


def _rare_first(texts: DataFrame) -> Column:
    """The most frequent tokens as a constant, rare ones first; a bounded number, whatever the alphabet."""
    counts = texts.select(F.explode(_char_tokens(F.col("text"))).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT_TOKENS).collect()
    return F.array(*[F.lit(r["token"]) for r in reversed(top)]).cast("array<string>")


def jaro_candidates(names: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(block, id_a, id_b)``, ``id_a < id_b``, that hold every pair of texts with Jaro-Winkler >= threshold.

    ``names`` has ``(block, id, text)``; an id may have several texts (first and last name). Two texts with l common letters
    at the start need a Jaro value that falls with l, and so a number of common characters, which are the l letters and characters
    of what follows. So texts are joined, for each l up to 4, by those letters and by one of the rarest characters that follow: as many as the
    least number of common ones leaves open, which depends on which text is longer. A pair is taken at its first common character,
    if enough follow and all common characters together are enough; so it is met once, and what is scored could be similar.
    """
    needs = [3 * _jaro_floor(threshold, n) - 1 for n in range(PREFIX_LENGTH + 1)]
    if min(needs) <= 1:
        raise ValueError("threshold too low: no pair can be ruled out without comparing all pairs")
    sized = names.filter(F.length("text") > 0).select("block", "id", "text", F.length("text").alias("len"))
    ranks = _rare_first(sized)

    def level(n: int) -> Column:
        rest = _char_tokens(F.substring("text", n + 1, 1 << 30))
        ordered = F.array_sort(F.transform(rest, lambda t: F.struct(F.array_position(ranks, t).alias("r"), t.alias("t"))))
        return F.when(F.col("len") >= n, F.struct(
            F.lit(n).alias("n"), F.lit(needs[n]).alias("need"), F.substring("text", 1, n).alias("head"), F.transform(ordered, lambda x: x["t"]).alias("rest")))

    levels = F.filter(F.array(*[level(n) for n in range(PREFIX_LENGTH + 1)]), lambda x: x.isNotNull())
    rows = sized.select("block", "id", "text", "len", F.explode(levels).alias("_l")).select("block", "id", "text", "len", "_l.*")

    def common(x: Column, y: Column) -> Column:
        """How many characters of the rests must be common."""
        return F.ceil(F.col("need") * x * y / (x + y) - F.lit(_EPS)).cast("int") - F.col("n")

    def by_token(least: Column, side: str) -> DataFrame:
        prefix = F.when(least > 0, F.slice("rest", F.lit(1), F.greatest(F.lit(0), F.size("rest") - least + 1))).otherwise(F.concat("rest", F.array(F.lit(""))))
        out = rows.select("block", "n", "need", "head", "id", "text", "len", "rest", F.posexplode(prefix).alias("at", "token"))
        return out.withColumnsRenamed({c: f"{c}_{side}" for c in ("id", "text", "len", "rest", "at")})

    length = F.col("len")
    shortest = F.greatest(F.col("n"), F.ceil(length * (F.col("need") - 1) - F.lit(_EPS)).cast("int"), F.lit(1))
    longer, shorter = by_token(common(length, shortest), "x"), by_token(common(length, length), "y").drop("need")
    needed = common(F.col("len_x"), F.col("len_y"))
    left = F.least(F.size("rest_x") - F.col("at_x"), F.size("rest_y") - F.col("at_y"))
    met = longer.join(shorter, ["block", "n", "head", "token"]).filter(
        ((F.col("len_x") > F.col("len_y")) | ((F.col("len_x") == F.col("len_y")) & (F.col("id_x") < F.col("id_y")))) & (F.col("id_x") != F.col("id_y")))
    after = lambda c: F.substr(c, F.col("n") + 1, F.lit(1))
    whole_prefix = (F.col("n") == PREFIX_LENGTH) | (F.col("len_y") == F.col("n")) | (after(F.col("text_x")) != after(F.col("text_y")))
    met = met.filter(whole_prefix & (needed <= F.col("len_y") - F.col("n")) & ((F.col("token") == "") | (left >= needed)))
    met = met.withColumn("shared", F.array_intersect("rest_x", "rest_y"))
    met = met.filter((F.coalesce(F.get("shared", F.lit(0)), F.lit("")) == F.col("token")) & (F.size("shared") >= needed))
    return met.select("block", F.least("id_x", "id_y").alias("id_a"), F.greatest("id_x", "id_y").alias("id_b")).distinct()


def weighted_name_score(pairs: DataFrame, a: tuple[str, ...], b: tuple[str, ...], weights: tuple[float, ...]) -> DataFrame:
    """Add ``name_score`` and ``similarity``: the better of natural and swapped order.

    One name column per side compares that text, and the token-reversed one as ``b[1]``.
    """
    if len(a) == 1:
        natural, turned = jaro_winkler(a[0], b[0]), jaro_winkler(a[0], b[1])
        scored = pairs.withColumn("similarity", F.greatest(natural, turned))
        return scored.withColumn("name_score", F.col("similarity") * F.lit(float(weights[0])))
    scored = pairs.select(
        "*", jaro_winkler(a[0], b[0]).alias("_ff"), jaro_winkler(a[1], b[1]).alias("_ll"),
        jaro_winkler(a[0], b[1]).alias("_fl"), jaro_winkler(a[1], b[0]).alias("_lf"),
    )
    wa, wb = (F.lit(float(w)) for w in weights[:2])
    return scored.withColumn(
        "name_score", F.greatest(wa * F.col("_ff") + wb * F.col("_ll"), wa * F.col("_fl") + wb * F.col("_lf"))
    ).withColumn(
        "similarity", F.greatest(F.least("_ff", "_ll"), F.least("_fl", "_lf"))
    ).drop("_ff", "_ll", "_fl", "_lf")
