"""Perspective rotation of dialogues with several speakers.

For every speaker of a conversation the dialogue is rendered once with that speaker as the
assistant, all others as users who carry their name, and system turns as they are.  The mask
covers what the assistant says, end mark included: character spans of the rendered text.

A dialogue is rendered in parts of a bounded number of turns: blocks of ``BLOCK`` turn numbers,
and a block that holds more than ``MOST`` rows because turn numbers repeat is cut further, after
every ``MOST`` rows of its order.  Rows are ranked by a range partition and running counts, so no
conversation, however long, meets in one task; the parts of a dialogue in their order are the
dialogue.  Without a bound (``most=None``) every block is one part.

Defined cases: turns order by number (null first), equal numbers by speaker and text; a null
speaker is called ``unknown``, a null text is empty; rows with a null conversation form a
conversation; repeated rows are repeated turns; a conversation of system turns only has no
speaker and gives no rows, nor does an empty table.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

BLOCK = 64
MOST = 512
SYSTEM = "system"
END = "<|end|>\n"


def numbered(rows: DataFrame, most: int) -> DataFrame:
    """``(conv_id, block, number, said)``: the rows of every block in their order, ``most`` to a number.

    Equal rows are counted first, so their ranks are a range that numbers may cut.
    """
    counted = rows.groupBy("conv_id", "block", "turn", "speaker", "text").agg(F.count("*").alias("times"))
    order = ["conv_id", "block", "turn", "speaker", "text"]
    placed = cut(counted.repartitionByRange(*order).sortWithinPartitions(*order)
                 .withColumns({"slice": F.spark_partition_id(), "place": F.monotonically_increasing_id()}))
    earlier = Window.partitionBy("of_conv", "of_block").orderBy("of_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (placed.groupBy(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), F.col("slice").alias("of_slice"))
              .agg(F.sum("times").alias("held")).withColumn("before", F.coalesce(F.sum("held").over(earlier), F.lit(0))))
    upto = Window.partitionBy("conv_id", "block", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.withColumn("upto", F.sum("times").over(upto)).join(
        slices, F.col("conv_id").eqNullSafe(F.col("of_conv")) & F.col("block").eqNullSafe(F.col("of_block"))
        & (F.col("slice") == F.col("of_slice")))
    ranked = ranked.withColumn("end", F.col("before") + F.col("upto")).withColumn("start", F.col("end") - F.col("times"))
    ranked = ranked.withColumn("number", F.explode(F.sequence(F.floor(F.col("start") / most), F.floor((F.col("end") - 1) / most))))
    here = F.least(F.col("end"), (F.col("number") + 1) * most) - F.greatest(F.col("start"), F.col("number") * most)
    return ranked.withColumn("here", here.cast("int")).groupBy("conv_id", "block", "number").agg(
        F.flatten(F.collect_list(F.array_repeat(F.struct("turn", "speaker", "text"), F.col("here")))).alias("said"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", most: int | None = MOST) -> DataFrame:
    """``(conv_id, perspective, part, turns, text, masks)``; masks are ``[start, stop)`` in ``text``.

    ``part`` is a struct whose order is the order of the parts.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("block", F.floor(F.col("turn") / BLOCK))
    said = F.struct("turn", "speaker", "text")
    parts = rows
    if most is not None:
        crowded = cut(rows.groupBy(F.col("conv_id").alias("c"), F.col("block").alias("b")).agg(F.count("*").alias("n"))
                      .filter(F.col("n") > most))
        same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b"))
        parts = rows.join(crowded, same, "left_anti")
    parts = (parts.groupBy("conv_id", "block").agg(F.collect_list(said).alias("said"))
             .withColumn("number", F.lit(0).cast("long")))
    if most is not None:
        parts = parts.unionByName(numbered(rows.join(crowded, same, "left_semi"), most))
    # Null turn numbers come first in this order, as do nulls inside the sorted structs.
    parts = parts.withColumn("said", F.array_sort("said"))
    speakers = (rows.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of_conv"), F.col("speaker").alias("perspective"))
                .distinct())
    seen = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of_conv")))
    head = lambda t: (F.when(t.speaker == F.col("perspective"), F.lit("<|assistant|>\n"))
                      .when(t.speaker == SYSTEM, F.lit("<|system|>\n"))
                      .otherwise(F.concat(F.lit("<|user name="), t.speaker, F.lit("|>\n"))))
    lines = F.transform("said", lambda t: F.struct(
        (t.speaker == F.col("perspective")).alias("mine"), F.char_length(head(t)).alias("head"),
        F.concat(head(t), t.text, F.lit(END)).alias("line")))
    seen = seen.withColumn("lines", lines)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("masks"))
    step = lambda a, x: F.struct(
        (a.at + F.char_length(x.line)).alias("at"),
        F.when(x.mine, F.concat(a.masks, F.array(F.struct((a.at + x.head).alias("start"),
                                                          (a.at + F.char_length(x.line)).alias("stop")))))
        .otherwise(a.masks).alias("masks"))
    part = F.struct(F.col("block").alias("block"), F.col("number").alias("number")).alias("part")
    return seen.select("conv_id", "perspective", part, F.size("said").alias("turns"),
                       F.array_join(F.transform("lines", lambda x: x.line), "").alias("text"),
                       F.aggregate("lines", start, step).masks.alias("masks"))

