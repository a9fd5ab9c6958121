"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only its reply is trainable. What no reply covers, that is a
conversation without assistant turns or the turns after the last reply, becomes
one last example with an empty target, so that no turn is lost.

A turn is written ``<s>[role]text</s>``. Texts and roles are escaped: a
backslash becomes ``\\0``, ``<`` ``\\1``, ``[`` ``\\2`` and ``]`` ``\\3``. So
control strings in a formatted example come from the template alone, and
replacing the codes in the reverse order gives back the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CODES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))


def escape(text: Column) -> Column:
    for plain, code in _CODES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_CODES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def opening(role: Column) -> Column:
    return F.concat(F.lit("<s>["), escape(role), F.lit("]"))


def prefix_targets(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    reply_role: str = "assistant",
) -> DataFrame:
    """One row per example: conv_id, target (number of its last turn, from 1), covers_all,
    text, loss_start and loss_length (code points of ``text`` under the loss mask).

    covers_all marks the one example of a conversation that holds all its turns.
    Turns go by (turn, role, text), nulls first, so repeated turn numbers have one
    order; repeated rows are turns of their own. A null role or text is an empty
    one, a null id is a conversation like any other, an empty table gives an empty
    result. Only the named columns are read, so others may have any name.

    The examples of a conversation grow with the square of its turns: that is the
    method. A conversation itself is held by one task, as its longest example is.
    """
    role = F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(""))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"),
        F.struct(
            F.col(f"`{turn_col}`").alias("turn"),
            role.alias("role"),
            text.alias("text"),
        ).alias("said"),
    )
    talks = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    count = F.size("said")
    replies = F.filter(
        F.sequence(F.lit(1), count), lambda i: F.element_at("said", i)["role"] == reply_role
    )
    ends = F.when(F.element_at("said", -1)["role"] == reply_role, replies).otherwise(
        F.concat(replies, F.array(count + 1))
    )
    marked = talks.withColumn(
        "marked",
        F.transform("said", lambda s: F.concat(opening(s["role"]), escape(s["text"]), F.lit("</s>"))),
    ).withColumn("ends", ends)
    each = marked.select("conv_id", "said", "marked", F.explode("ends").alias("target"))
    context = F.array_join(F.slice("marked", 1, F.col("target") - 1), "")
    last = F.get("said", F.col("target") - 1)
    parts = each.select(
        "conv_id",
        "target",
        (F.col("target") >= F.size("said")).alias("covers_all"),
        F.concat(context, F.when(last.isNotNull(), opening(last["role"])).otherwise("")).alias("before"),
        escape(last["text"]).alias("reply"),
    )
    return parts.select(
        "conv_id",
        "target",
        "covers_all",
        F.when(F.col("reply").isNull(), F.col("before"))
        .otherwise(F.concat("before", "reply", F.lit("</s>")))
        .alias("text"),
        F.length("before").cast("long").alias("loss_start"),
        F.coalesce(F.length("reply"), F.lit(0)).cast("long").alias("loss_length"),
    )


def trained_text(text: Column, start: Column, length: Column) -> Column:
    """What the loss mask covers, with its escapes undone."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def turns_of(text: Column) -> Column:
    """Read a formatted example back: an array of (role, text)."""
    pieces = F.filter(F.split(text, "</s>", -1), lambda p: p != "")

    def turn(piece: Column) -> Column:
        # "<s>[" is four characters; the first "]" ends the role, as "]" is escaped in it
        end = F.locate("]", piece)
        return F.struct(
            unescape(F.substring(piece, F.lit(5), end - 5)).alias("role"),
            unescape(F.substring(piece, end + 1, F.length(piece))).alias("text"),
        )

    return F.transform(pieces, turn)
