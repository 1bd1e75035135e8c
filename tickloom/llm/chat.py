"""Chat formatting by prefix-target expansion.

Turns become marked segments. A conversation's text is its segments in order, and every assistant turn makes an example of
its own: all that precedes it is the context, its reply alone is trained on. An example is thus a prefix of the
conversation's text, with the span of its last reply.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END, BREAK = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escaped(text: Column) -> Column:
    """Free of `<|`, and so of every control string; the bar of each is led by a backslash, as is a backslash."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _role(text: Column) -> Column:
    """A role ends at the line's end, so its own line breaks become a control string."""
    return F.replace(escaped(text), F.lit("\n"), F.lit(BREAK))


def expand_prefixes(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant") -> DataFrame:
    """One row (conv_id, example, text, loss_start, loss_chars, is_last) for every assistant turn.

    `example` is the turn's place from 1. `loss_start` counts code points from 0 within `text`; the context is what stands
    before. If the last turn is not an assistant's, one more row has the whole conversation and nothing to train on
    (loss_chars 0), so the last row of a conversation always has all its turns. Turns sort by turn, role and text, null
    first; repeated rows are repeated turns; a null role or text is empty; a null conv_id is a conversation; an empty
    table gives an empty one. A conversation is one text, and so must fit in a row; examples grow with the product of
    its length and its replies, as the method has it.
    """
    said, name = F.coalesce(text, F.lit("")), F.coalesce(role, F.lit(""))
    # Turns move once and as they are; what the template makes of them is added where they have arrived.
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), name.alias("role"), said.alias("said")).repartition("conv_id")
    rows = rows.withColumn("body", escaped(F.col("said"))).withColumn("segment", F.concat(F.lit(START), _role(F.col("role")), F.lit("\n"), "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "said")
    rows = rows.select(
        "conv_id", "segment", F.row_number().over(order).alias("example"), (F.col("role") == trained).alias("trained"), F.length("body").alias("body_chars"),
        F.sum(F.length("segment")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("end"),
    )
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("example", "segment", "trained", "body_chars", "end"))).alias("turns"))
    whole = whole.select("conv_id", "turns", F.array_join(F.transform("turns", lambda x: x.segment), "").alias("whole"))
    is_last = lambda x: x.example == F.size("turns")
    wanted = F.transform(F.filter("turns", lambda x: x.trained | is_last(x)), lambda x: F.struct(x.example.alias("example"), x.trained.alias("trained"), x.body_chars.alias("body_chars"), x.end.alias("end"), is_last(x).alias("is_last")))
    each = whole.select("conv_id", "whole", F.explode(wanted).alias("x")).select("conv_id", "whole", "x.*")
    end = F.col("end").cast("int")
    return each.select(
        "conv_id", "example", F.substring("whole", F.lit(1), end).alias("text"),
        F.when(F.col("trained"), end - len(END) - F.col("body_chars")).alias("loss_start"),
        F.when(F.col("trained"), F.col("body_chars")).otherwise(0).alias("loss_chars"), "is_last",
    )


def read_back(text: Column) -> Column:
    """The turns (role, text) of a formatted text, unescaped."""
    segments = F.filter(F.split(text, r"<\|im_end\|>\n", -1), lambda s: s != "")
    bodies = F.transform(segments, lambda s: F.substring(s, F.lit(len(START) + 1), F.length(s)))
    head = lambda s: F.substring_index(s, "\n", 1)
    return F.transform(bodies, lambda s: F.struct(
        unescaped(F.replace(head(s), F.lit(BREAK), F.lit("\n"))).alias("role"),
        unescaped(F.substring(s, F.length(head(s)) + 2, F.length(s))).alias("text"),
    ))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """What the examples of each conversation hold, read back from their texts."""
    trained = unescaped(F.substring("text", F.col("loss_start") + 1, F.col("loss_chars")))
    per_conv = examples.groupBy("conv_id").agg(
        F.max(F.when(F.col("is_last"), F.col("text"))).alias("whole"),
        F.sort_array(F.collect_list(F.when(F.col("loss_start").isNotNull(), F.struct("example", trained.alias("reply"))))).alias("replies"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("replies", lambda x: x.reply), "")
    per_conv = per_conv.select("conv_id", read_back(F.col("whole")).alias("turns"), loss.alias("loss"), "formatted_chars")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return per_conv.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
    )
