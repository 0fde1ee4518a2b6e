"""Chat formatting: every dialogue once from each participant's side.

Native. A rendering is a table of segments, one per turn, so a conversation of any length is
many rows in many tasks and no task holds a whole one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of a segment, and the role that is shown but takes no side.
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
CONTEXT_ROLE = "system"


def _escaped(text: Column) -> Column:
    """Text that can't be taken for a mark."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, speaker, chat_role, segment, loss_start, loss_end, trained) from (conv_id, turn, role, text).

    For every participant of a conversation (each distinct role but ``system``) all its turns are
    rendered: the participant's own as assistant, ``system`` as system, the others as user with
    their name. Only the assistant's text and end mark are trained on: loss_start and loss_end are
    code point positions in the segment, equal where nothing is. Segments joined in the order of
    turn, speaker, segment are the rendering. A null text is empty; a null role is the participant
    ``unknown``; a null conv_id is one conversation; repeated rows are rendered each time. A
    conversation without participants gives no row.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce(F.nullif(F.trim("role"), F.lit("")), F.lit("unknown")).alias("speaker"), _escaped(F.col("text")).alias("said"))
    sides = said.where(F.col("speaker") != CONTEXT_ROLE).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    both = said.join(sides, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    role = F.when(F.col("speaker") == CONTEXT_ROLE, CONTEXT_ROLE).when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user")
    name = F.regexp_replace("speaker", r"[\s<|>]+", "_")
    head = F.concat(F.lit(BEGIN), F.col("chat_role"), F.when(F.col("chat_role") == "user", F.concat(F.lit(" name="), name)).otherwise(""), F.lit("\n"))
    return both.withColumn("chat_role", role).withColumn("_head", head).withColumn("trained", F.col("chat_role") == "assistant").select(
        "conv_id", "perspective", "turn", "speaker", "chat_role", F.concat("_head", "said", F.lit(END)).alias("segment"),
        F.char_length("_head").cast("long").alias("loss_start"),
        (F.char_length("_head") + F.when(F.col("trained"), F.char_length("said") + len(END)).otherwise(0)).cast("long").alias("loss_end"), "trained")
