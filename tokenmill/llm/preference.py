"""Preference formatting: the shared turns of two conversations once as prompt, what follows as two masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.session import cut_lineage

# fixed values: chat markup
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"))


def preference_rows(turns: DataFrame) -> DataFrame:
    """(pair_id, side, turn, role, text) to (pair_id, part, turn, role, rendered, loss_start, loss_end, usable).

    ``side`` is "chosen" or "rejected". The common prefix is all turns before the first turn number
    at which the two sides' messages differ. Its messages come once, as part "prompt"; later ones
    as part "chosen" or "rejected", also where both sides have them again. ``loss_start`` to
    ``loss_end`` (code points of ``rendered``, end exclusive) is what a loss may count: text and end
    mark of assistant messages in completions; both are null elsewhere. A pair is ``usable`` if each
    completion has such a message; a pair of equal sides is all prompt.

    A part's text is its rows' ``rendered`` in order of (turn, role, rendered); rows are not gathered
    into one value, so a conversation may have any length. One shuffle by (pair, turn, message), so
    no pair meets in one task; what a pair needs to know is three numbers, summed up in tasks first.

    Rows without pair, side or turn, or with another side, belong to no conversation and are left
    out. A null role is "user", a null text is empty. Messages repeated in one side and turn count
    once. Other columns are not read.
    """
    side = F.col("side")
    messages = (
        turns.where(F.col("pair_id").isNotNull() & F.col("turn").isNotNull() & side.isin("chosen", "rejected"))
        .groupBy(
            "pair_id",
            "turn",
            F.coalesce("role", F.lit("user")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .agg(F.max(side == "chosen").alias("in_chosen"), F.max(side == "rejected").alias("in_rejected"))
    )
    # tables of their own, so that joins may split a long conversation's rows
    messages = cut_lineage(messages)
    trained = F.col("role") == TRAINED_ROLE
    bounds = messages.groupBy("pair_id").agg(
        F.min(F.when(F.col("in_chosen") != F.col("in_rejected"), F.col("turn"))).alias("cut"),
        F.max(F.when(trained & F.col("in_chosen"), F.col("turn"))).alias("last_chosen"),
        F.max(F.when(trained & F.col("in_rejected"), F.col("turn"))).alias("last_rejected"),
    )
    shared = F.col("cut").isNull() | (F.col("turn") < F.col("cut"))
    part = F.when(shared, F.array(F.lit("prompt"))).otherwise(
        F.array_compact(
            F.array(F.when(F.col("in_chosen"), F.lit("chosen")), F.when(F.col("in_rejected"), F.lit("rejected")))
        )
    )
    usable = F.coalesce(
        (F.col("last_chosen") >= F.col("cut")) & (F.col("last_rejected") >= F.col("cut")), F.lit(False)
    )
    rendered = F.concat(header(F.col("role")), F.col("text"), F.lit(CLOSE))
    counted = trained & (F.col("part") != "prompt")
    return (
        messages.join(cut_lineage(bounds), "pair_id")
        .select("pair_id", F.explode(part).alias("part"), "turn", "role", "text", usable.alias("usable"))
        .select(
            "pair_id",
            "part",
            "turn",
            "role",
            rendered.alias("rendered"),
            F.when(counted, F.length(header(F.col("role")))).cast("bigint").alias("loss_start"),
            # the line break behind the end mark is not learned
            F.when(counted, F.length(rendered) - 1).cast("bigint").alias("loss_end"),
            "usable",
        )
    )


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs from plain conversations: each as chosen, and as rejected with the last reply of conversation ``conv_id + 1``.

    A conversation without a reply of its own, or without a next one that has a reply (also where ids have a gap), keeps its
    chosen side and has a rejected one without that reply. Rows with a null ``conv_id`` go; of several last replies
    at one turn the greatest text is swapped in; repeated rows stay. Other columns are not read.
    """
    known = conversations.where(F.col("conv_id").isNotNull())
    replies = (
        known.where(F.col("role") == TRAINED_ROLE)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("reply"))
    )
    own = replies.select("conv_id", F.col("reply.turn").alias("last_turn"))
    other = replies.select((F.col("conv_id") - 1).alias("conv_id"), F.col("reply.text").alias("other"))
    facts = cut_lineage(own.join(other, "conv_id", "left"))
    rows = known.select("conv_id", "turn", "role", "text").join(facts, "conv_id", "left")
    is_last = F.coalesce((F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("last_turn")), F.lit(False))
    sides = F.when(
        is_last & F.col("other").isNull(), F.array(F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said")))
    ).otherwise(
        F.array(
            F.struct(F.lit("chosen").alias("side"), F.col("text").alias("said")),
            F.struct(
                F.lit("rejected").alias("side"), F.when(is_last, F.col("other")).otherwise(F.col("text")).alias("said")
            ),
        )
    )
    return rows.select(F.col("conv_id").alias("pair_id"), "turn", "role", F.explode(sides).alias("s")).select(
        "pair_id", F.col("s.side").alias("side"), "turn", "role", F.col("s.said").alias("text")
    )
