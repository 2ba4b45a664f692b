"""Chat formatting of multi-party dialogues, once from the perspective of every participant.

A dialogue is rendered once for each speaker: that speaker's turns are the assistant's, all others' are
turns of users with a name, and only the assistant's text and end mark are trained on. A rendering is
returned as its segments, one a turn, with their character offsets, so that a dialogue of any length
never has to fit into one row or one task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The marks around a turn.
START, END = "<|im_start|>", "<|im_end|>"
CHUNK = 256  # turns
LEAD = 2  # characters


def _same(rows: DataFrame, found: DataFrame, on: list[str], value: str) -> DataFrame:
    """``rows`` with ``value`` of the row of ``found`` that has the same keys, nulls being equal."""
    a, b = rows.alias("a"), found.alias("b")
    equal = reduce(and_, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on])
    return a.join(b, equal, "left").select("a.*", f"b.{value}")


def render_perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    context_roles: tuple[str, ...] = ("system",),
) -> DataFrame:
    """``(conv_id, perspective, turn, speaker, role, segment, start, mask_start, mask_end)``.

    One row for each turn and each perspective: every role of the conversation other than the context
    roles, which are rendered as ``system`` in every perspective. ``segment`` is the rendered turn,
    ``start`` its offset in characters in the rendered dialogue; ``mask_start`` to ``mask_end`` is the
    part that is trained on, null in others' turns. Turns are ordered by number, role and text, null first;
    repeated rows stay. An empty table gives an empty table. A null role is a user without a name and is no perspective; a null text is
    empty. A row with a null conversation stands alone, with equal ones at most, so that such rows meet none of
    the others' speakers. A conversation without a speaker (context only) has no rendering. Dialogues and texts may
    be of any length. Extra columns are ignored, whatever their names.
    """
    rows = turns.select(
        F.col(conversation).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )
    alone = F.sha2(F.to_json(F.struct("turn", "speaker", "body")), 256)
    rows = rows.withColumn("alone", F.when(F.col("conv_id").isNull(), alone))
    people = rows.where(F.col("speaker").isNotNull() & ~F.col("speaker").isin(*context_roles))
    people = people.select(F.col("conv_id").alias("c"), F.col("alone").alias("d"), F.col("speaker").alias("perspective")).distinct()
    both = rows.join(people, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("alone").eqNullSafe(F.col("d"))).drop("c", "d")
    both = both.withColumn(
        "role",
        F.when(F.col("speaker").isin(*context_roles), "system")
        .when(F.col("speaker") == F.col("perspective"), "assistant").otherwise("user"),
    )
    name = F.when((F.col("role") == "user") & F.col("speaker").isNotNull(), F.concat(F.lit(" name="), "speaker"))
    head = F.concat(F.lit(START), "role", F.coalesce(name, F.lit("")), F.lit("\n"))
    both = both.withColumn("head", F.length(head)).withColumn("segment", F.concat(head, "body", F.lit(END + "\n")))
    both = both.withColumn("n", F.length("segment").cast("bigint"))
    # A running sum in three steps, so that no window has to hold a long dialogue: over chunks of turns, over
    # the cells of a chunk, and over the rows of a cell, which differ in nothing but the text behind LEAD.
    both = both.withColumn("chunk", F.floor(F.col("turn") / CHUNK)).withColumn("lead", F.substring("body", 1, LEAD))
    earlier = (Window.unboundedPreceding, -1)

    def before(column: str, by: list[str], *order: str) -> Column:
        return F.coalesce(F.sum(column).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(*earlier)), F.lit(0))

    group = ["conv_id", "alone", "perspective"]
    key = [*group, "chunk", "turn", "speaker", "lead"]
    cells = both.groupBy(*key).agg(F.sum("n").alias("whole"))
    chunks = cells.groupBy(*group, "chunk").agg(F.sum("whole").alias("sum"))
    chunks = chunks.select(*group, "chunk", before("sum", group, "chunk").alias("base"))
    cells = cells.select(*key, before("whole", [*group, "chunk"], "turn", "speaker", "lead").alias("first"))
    cells = _same(cells, chunks, [*group, "chunk"], "base").select(*key, (F.col("base") + F.col("first")).alias("base"))
    out = _same(both.withColumn("within", before("n", key, "body")), cells, key, "base")
    out = out.withColumn("start", F.col("base") + F.col("within"))
    trained = F.col("role") == "assistant"
    return out.select(
        "conv_id", "perspective", "turn", "speaker", "role", "segment", "start",
        F.when(trained, F.col("start") + F.col("head")).alias("mask_start"),
        F.when(trained, F.col("start") + F.col("n") - 1).alias("mask_end"),
    )
