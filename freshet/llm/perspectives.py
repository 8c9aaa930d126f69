"""Chat formatting by rotating perspectives (SQL functions only).

For every participant of a dialogue, the dialogue is rendered with that speaker
as the assistant and all others as users with their names. Instructions (the
roles in INSTRUCTIONS) are nobody's perspective and stand as such in all. The mask
covers what the assistant is to learn: its words and the end mark behind them.

One row per perspective and turn, with its place in the rendering: a dialogue is
never gathered in one task. Offsets are sums in two steps, over CHUNK turn numbers and
over the chunks before, which are found from lengths alone; texts are shuffled once.
Turns without a number, or of equal ones, are one chunk. `dialogues` joins the rows to
whole strings.

A null text is empty. A null role is a user named `unknown` and has no
perspective. Turns sort by number, then role, then text; null numbers come last.
Repeated rows are turns of their own. A null conv_id is a dialogue like others.
A dialogue of instructions alone has no perspective and no rows. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSTRUCTIONS = ("system",)
UNKNOWN = "unknown"
END = "<|end|>\n"
#: Turns whose offsets are summed together.
CHUNK = 4096


def rotated(turns: DataFrame, instructions: tuple[str, ...] = INSTRUCTIONS) -> DataFrame:
    """conv_id, speaker, place, turn, role (assistant, user or system), name,
    segment, start, n_chars, mask_start, mask_end (null where nothing is learned)
    of turns (conv_id, turn, role, text). Offsets count code points."""
    rows = turns.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").alias("said_by"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).withColumn("_key", F.struct("conv_id", F.floor(F.col("turn") / CHUNK).alias("chunk")))
    instruction = F.coalesce(F.col("said_by").isin(*instructions), F.lit(False))
    role = F.when(instruction, F.lit("system")).otherwise(F.lit("user"))
    bodies = rows.select("_key", "said_by", (F.length(_head(role, "said_by")) + F.length("text") + len(END)).alias("n"))
    parts = bodies.groupBy("_key", "said_by").agg(F.sum("n").alias("_n"), F.count("*").alias("_t"))
    starts = _starts(parts, instructions)
    # A turn's text is shuffled here once, to the place of its chunk. All its perspectives arise and
    # are ordered there, which a broadcast join would undo.
    views = rows.repartition("_key").join(starts.hint("merge"), "_key")
    own = F.coalesce(F.col("said_by") == F.col("speaker"), F.lit(False))
    views = views.withColumns({"role": F.when(own, F.lit("assistant")).otherwise(role), "name": F.coalesce("said_by", F.lit(UNKNOWN))})
    views = views.withColumn("_head", _head(F.col("role"), "said_by"))
    views = views.withColumn("segment", F.concat("_head", "text", F.lit(END)))
    views = views.withColumn("n_chars", F.length("segment").cast("long"))
    order = [F.col("turn").asc_nulls_last(), F.col("said_by").asc_nulls_last(), F.col("text")]
    inside = Window.partitionBy("_key", "speaker").orderBy(*order)
    to_here = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = views.withColumns({"_end": F.sum("n_chars").over(to_here), "_nth": F.row_number().over(inside)})
    start = F.coalesce("_chars", F.lit(0)) + F.col("_end") - F.col("n_chars")
    placed = placed.withColumn("start", start.cast("long"))
    learned = F.col("role") == "assistant"
    return placed.select(
        "conv_id", "speaker", (F.coalesce("_turns", F.lit(0)) + F.col("_nth") - 1).cast("long").alias("place"), "turn", "role", "name",
        "segment", "start", "n_chars",
        F.when(learned, F.col("start") + F.length("_head")).cast("long").alias("mask_start"),
        F.when(learned, F.col("start") + F.col("n_chars")).cast("long").alias("mask_end"),
    )


def _head(role: Column, said_by: str) -> Column:
    named = F.concat(F.lit("<|user name="), F.coalesce(said_by, F.lit(UNKNOWN)), F.lit("|>\n"))
    return F.when(role == "user", named).otherwise(F.concat(F.lit("<|"), role, F.lit("|>\n")))


def _starts(parts: DataFrame, instructions: tuple[str, ...]) -> DataFrame:
    """_key, speaker, _chars, _turns: what lies before each chunk in each speaker's rendering.

    ``parts`` counts the characters and turns of everyone in a chunk, all as others.
    The speaker's own turns have another head.
    """
    conv = F.struct(F.col("_key")["conv_id"].alias("conv_id")).alias("_conv")
    chunks = parts.groupBy("_key").agg(F.sum("_n").alias("_n"), F.sum("_t").alias("_t")).withColumn("_conv", conv)
    said = parts.filter(F.col("said_by").isNotNull() & ~F.col("said_by").isin(*instructions)).withColumnRenamed("said_by", "speaker")
    longer = F.length(_head(F.lit("assistant"), "speaker")) - F.length(_head(F.lit("user"), "speaker"))
    own = said.select("_key", "speaker", (F.col("_t") * longer).alias("_more"))
    all_chunks = chunks.join(said.select(conv, "speaker").distinct(), "_conv").join(own, ["_key", "speaker"], "left")
    before = Window.partitionBy("_conv", "speaker").orderBy(F.col("_key")["chunk"].asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    chars = F.sum(F.col("_n") + F.coalesce("_more", F.lit(0))).over(before)
    return all_chunks.select("_key", "speaker", chars.alias("_chars"), F.sum("_t").over(before).alias("_turns"))


def dialogues(rows: DataFrame) -> DataFrame:
    """conv_id, speaker, text, masks: whole renderings, for dialogues that fit in memory."""
    turns = F.sort_array(F.collect_list(F.struct("start", "segment", "mask_start", "mask_end")))
    masks = F.transform(F.filter("t", lambda t: t["mask_start"].isNotNull()), lambda t: F.struct(t["mask_start"].alias("start"), t["mask_end"].alias("end")))
    return rows.groupBy("conv_id", "speaker").agg(turns.alias("t")).select(
        "conv_id", "speaker", F.array_join(F.transform("t", lambda t: t["segment"]), "").alias("text"), masks.alias("masks")
    )
