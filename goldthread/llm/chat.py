"""Chat formatting in Spark expressions alone.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged into one
block, whose texts stay apart by a separator mark; blocks are concatenated to

    <|im_start|>role\\ntext<|im_sep|>text<|im_end|>\\n

Marks begin with ``<|``. In texts and roles every ``<``, any number of ``\\``, ``|`` gets one more ``\\``, so a text can
hold no mark, and taking one ``\\`` away restores it. A line feed in a role becomes the mark ``<|nl|>``.

``loss`` lists the spans (start, end in code points) of the texts of assistant turns, marks excluded. ``parse`` reads text
and spans back into turns.

A conversation is one text by definition, so the last step holds a whole conversation; turns are gathered by a partially
aggregated list, and positions are running sums, linear in the number of turns.

Defined cases: a null role or text is empty; null is a conversation of its own; turns with one number come in
the order of role and text, repeated ones are all kept; a null turn comes first; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from goldthread.session import stage

START, SEP, END, NEWLINE = "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|nl|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_mark(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def format_chats(turns: DataFrame, learned: str = LEARNED) -> DataFrame:
    """``(conv_id, formatted, loss)`` of every conversation; ``loss`` is an array of (start, end), from 0, end excluded."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", empty("role").alias("role"), empty("text").alias("text"))
    held = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    role_at = lambda i: F.col("turns")[i]["role"]
    marked = F.transform("turns", lambda t, i: F.struct(
        t["role"].alias("role"), escape(t["text"]).alias("text"),
        ((i == 0) | (role_at(F.greatest(i - 1, F.lit(0))) != t["role"])).alias("opens"),
        ((i == F.size("turns") - 1) | (role_at(F.least(i + 1, F.size("turns") - 1)) != t["role"])).alias("ends"),
    ))
    pieces = held.select("conv_id", F.posexplode(marked).alias("i", "t")).select(
        "conv_id", "i",
        F.when(F.col("t.opens"), F.concat(F.lit(START), _role_mark(F.col("t.role")), F.lit("\n"))).otherwise(F.lit(SEP)).alias("head"),
        F.col("t.text").alias("text"), F.when(F.col("t.ends"), F.lit(END + "\n")).otherwise(F.lit("")).alias("tail"),
        (F.col("t.role") == learned).alias("learned"),
    ).withColumn("piece", F.concat("head", "text", "tail"))
    order = Window.partitionBy("conv_id").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("piece")).over(order), F.lit(0)) + F.char_length("head")
    placed = pieces.withColumn("start", start).select(
        "conv_id", "i", "piece", F.when(F.col("learned"), F.struct("start", (F.col("start") + F.char_length("text")).alias("end"))).alias("span"),
    )
    ordered = placed.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("i", "piece"))).alias("pieces"), F.sort_array(F.collect_list("span")).alias("loss"),
    )
    return ordered.select("conv_id", F.array_join(F.col("pieces.piece"), "").alias("formatted"), "loss")


def parse(formatted: DataFrame) -> DataFrame:
    """The turns of formatted conversations: conv_id, i (from 0), role, text, and loss (whether a span covers the text).

    Turns and spans are rows and meet by (conversation, start), so a row carries its own text and nothing of its conversation.
    """
    blocks = F.split("formatted", r"<\|im_end\|>\n", -1)
    cut = formatted.select("conv_id", F.posexplode(F.slice(blocks, 1, F.size(blocks) - 1)).alias("b", "block"))
    head = F.substring_index("block", "\n", 1)
    role = unescape(F.replace(F.substring(head, F.lit(len(START) + 1), F.char_length(head)), F.lit(NEWLINE), F.lit("\n")))
    texts = F.split(F.substring(F.col("block"), F.char_length(head) + 2, F.char_length("block")), r"<\|im_sep\|>", -1)
    turns = cut.select("conv_id", "b", F.char_length(head).alias("head"), role.alias("role"), F.posexplode(texts).alias("k", "text"))
    before = F.when(F.col("k") == 0, F.col("head") + 1).otherwise(F.lit(len(SEP)))
    after = F.lit(len(END) + 1)
    order = Window.partitionBy("conv_id").orderBy("b", "k")
    so_far = F.sum(before + F.char_length("text")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = turns.withColumn("until", so_far + F.col("b") * after).withColumn("i", F.row_number().over(order) - 1)
    placed = placed.withColumn("start", F.col("until") - F.char_length("text"))
    spans = formatted.select(F.col("conv_id").alias("_conv"), F.explode("loss").alias("s")).select("_conv", F.col("s.start").alias("_start"), F.col("s.end").alias("_end")).distinct()
    covers = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("start") == F.col("_start")) & (F.col("until") == F.col("_end"))
    return placed.join(spans, covers, "left").select("conv_id", "i", "role", unescape(F.col("text")).alias("text"), F.col("_start").isNotNull().alias("loss"))


def chat_report(turns: DataFrame) -> DataFrame:
    """Format all conversations, write them, and describe what is read back."""
    written = stage(format_chats(turns), "chats")
    read = parse(written)
    line = F.concat("role", F.lit("\n"), "text", F.lit("\n"))
    texts = read.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_turns"), F.sort_array(F.collect_list(F.struct("i", line.alias("line")))).alias("lines"),
        F.sort_array(F.collect_list(F.when(F.col("loss"), F.struct("i", "text")))).alias("learned"),
    )
    learned = F.array_join(F.col("learned.text"), "")
    described = texts.select(
        F.col("conv_id").alias("_conv"), "n_turns", F.sha2(F.array_join(F.col("lines.line"), ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
    )
    lengths = written.select("conv_id", F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    return lengths.join(described, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
