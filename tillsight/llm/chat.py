"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are context, and only that
reply lies under the loss mask. Turns after the last reply would be in no example; such a
conversation gets a closing example with an empty mask, so that the output holds every turn.

A turn is written as ``<|im_start|>`` role, newline, text, ``<|im_end|>``, newline. In roles and texts
``\\``, ``<`` and ``[`` become ``\\s``, ``\\l`` and ``\\b``, and in roles newline becomes ``\\n``. No
control string of this or another bracketed template survives inside a text, and since a backslash
is always followed by its letter, replacing back in reverse order restores the text exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
REPLY = "assistant"
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))


def escaped(column, role: bool = False):
    """Text without control strings."""
    for plain, code in ESCAPES:
        column = F.replace(column, F.lit(plain), F.lit(code))
    return F.replace(column, F.lit("\n"), F.lit("\\n")) if role else column


def unescaped(column, role: bool = False):
    """The text that ``escaped`` was given."""
    if role:
        column = F.replace(column, F.lit("\\n"), F.lit("\n"))
    for plain, code in reversed(ESCAPES):
        column = F.replace(column, F.lit(code), F.lit(plain))
    return column


def examples(turns: DataFrame) -> DataFrame:
    """conv_id, example, text, loss_start and loss_end of every assistant turn, and of closing examples.

    ``turns`` has conv_id, turn, role and text; the mask covers characters loss_start to loss_end of
    text, in code points from 0. ``example`` is the place of the example's last turn, from 0. Rows
    are ordered by turn, nulls first, then role and text, so ties and repeated rows have a fixed
    place and none is dropped. Null roles and texts are empty, rows with a null conv_id are one
    conversation. A conversation is one row here and must fit one. Other columns have no influence;
    an empty table gives no examples.
    """
    piece = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escaped(t["role"], True), F.lit("\n"))
    marked = whole.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == REPLY).alias("reply"), head(t).alias("head"), escaped(t["text"]).alias("body"))).alias("turns"))
    each = marked.select("conv_id", "turns", F.posexplode("turns").alias("example", "last"))
    each = each.filter(F.col("last.reply") | (F.col("example") == F.size("turns") - 1))
    before = F.array_join(F.transform(F.slice("turns", F.lit(1), F.col("example")), lambda t: F.concat(
        t["head"], t["body"], F.lit(CLOSE))), "")
    each = each.select("conv_id", F.col("example").cast("bigint").alias("example"), "last",
                       F.concat(before, "last.head").alias("context"))
    end = F.length("context") + F.length("last.body")
    return each.select(
        "conv_id", "example", F.concat("context", "last.body", F.lit(CLOSE)).alias("text"),
        F.when(F.col("last.reply"), F.length("context")).otherwise(end).cast("bigint").alias("loss_start"),
        end.cast("bigint").alias("loss_end"))


def read_back(made: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), replies, and formatted_chars, from the examples alone."""
    masked = F.expr("substring(text, cast(loss_start as int) + 1, cast(loss_end - loss_start as int))")
    trained = F.col("loss_end") > F.col("loss_start")
    grouped = made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("transcript"),
        F.array_sort(F.collect_list(F.when(trained, F.struct("example", masked.alias("reply"))))).alias("replies"),
        F.sum(F.length("text")).cast("bigint").alias("formatted_chars"))
    lines = F.split(F.col("transcript"), r"<\|im_end\|>\n")
    lines = F.slice(lines, F.lit(1), F.size(lines) - 1)  # nothing follows the last end mark
    body = lambda t: F.substr(t, F.lit(len(OPEN) + 1))
    role = lambda t: F.substring_index(t, "\n", 1)
    turns = F.transform(lines, lambda t: F.struct(
        unescaped(role(body(t)), True).alias("role"),
        unescaped(F.substr(body(t), F.length(role(body(t))) + 2)).alias("text")))
    return grouped.select("conv_id", turns.alias("turns"),
                          F.transform("replies", lambda r: unescaped(r["reply"])).alias("replies"), "formatted_chars")
