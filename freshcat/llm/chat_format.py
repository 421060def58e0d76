"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context and
only its text is trainable. The template is

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

Inside roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``; a line feed in a
role becomes ``\\n``. No role or text can therefore hold a marker, and :func:`read_back`
restores the exact strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(doubled, F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    # a doubled backslash separates the pieces; inside a piece a backslash starts an escape
    piece = lambda p: F.replace(F.replace(p, F.lit("\\|"), F.lit("|")), F.lit("\\n"), F.lit("\n"))
    return F.array_join(F.transform(F.split(text, r"\\\\"), piece), "\\")


def prefix_target_examples(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", target_role: str = "assistant",
) -> DataFrame:
    """(conv_id, example, target_turn, text, loss_start, loss_length) examples.

    ``text`` is the formatted context and reply, ``loss_start``/``loss_length`` the code
    points of it that train: the reply's text alone. Examples of a conversation are numbered
    from 0 by turn. Turns after the last reply are in no context; they (or a conversation
    without a reply) end in one more example with nothing to train (``loss_length`` null).

    Turns are ordered by turn, then role and text (null turns first), repeated rows are
    repeated turns; null roles and texts are empty. A null conversation id is one
    conversation. An empty table gives no rows.

    A conversation's turns are gathered into one row, since each example holds its whole
    context anyway; examples are then made one at a time (a generator), never all in memory.
    """
    turns = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    header = lambda t: F.concat(
        F.lit(START), F.replace(escape(t["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    rendered = whole.select(
        "conv_id",
        F.transform("turns", header).alias("heads"),
        F.transform("turns", lambda t: escape(t["text"])).alias("bodies"),
        F.transform("turns", lambda t: t["role"] == F.lit(target_role)).alias("targets"),
    )
    n = F.size("targets")
    replies = F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("targets", i))
    numbered = rendered.select(
        "conv_id", "heads", "bodies", "targets",
        F.posexplode(F.when(F.element_at("targets", -1), replies).otherwise(F.concat(replies, F.array(n)))).alias("example", "at"),
    )
    trains = F.element_at("targets", F.col("at"))
    context = F.array_join(
        F.zip_with(
            F.slice("heads", F.lit(1), F.col("at") - 1), F.slice("bodies", F.lit(1), F.col("at") - 1),
            lambda h, b: F.concat(h, b, F.lit(END + "\n")),
        ), "")
    parts = numbered.select(
        "conv_id", "example", F.col("at").alias("target_turn"), trains.alias("trains"),
        F.concat(context, F.element_at("heads", F.col("at"))).alias("before"),
        F.element_at("bodies", F.col("at")).alias("body"),
    )
    return parts.select(
        "conv_id", "example", "target_turn",
        F.concat("before", "body", F.lit(END + "\n")).alias("text"),
        F.when(F.col("trains"), F.length("before")).alias("loss_start"),
        F.when(F.col("trains"), F.length("body")).alias("loss_length"),
    )


def read_back(examples: DataFrame) -> DataFrame:
    """(conv_id, turns, losses, formatted_chars) from the examples alone.

    ``turns``: array of (role, text), parsed from the last example, whose context holds all
    turns; ``losses``: the unescaped strings under the loss masks in order. The examples of a
    conversation are still together, so this needs no shuffle of its own.
    """
    loss = F.when(
        F.col("loss_start").isNotNull(),
        F.struct("example", unescape(F.substring("text", F.col("loss_start") + 1, F.col("loss_length"))).alias("said")),
    )
    gathered = examples.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("last"),
        F.array_sort(F.collect_list(loss)).alias("losses"),
        F.sum(F.length("text")).cast("long").alias("formatted_chars"),
    )

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        length = F.length(piece) - F.length(role) - F.lit(1 + len(END) + 1)
        return F.struct(unescape(role).alias("role"), unescape(F.substring(piece, F.length(role) + 2, length)).alias("text"))

    pieces = F.split("last", START.replace("|", "\\|"))
    return gathered.select(
        "conv_id",
        F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn).alias("turns"),
        F.transform("losses", lambda x: x["said"]).alias("losses"),
        "formatted_chars",
    )
