"""Fixed-size training rows and the order batches are drawn in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import arrays
from tokenmill.operators import sampling
from tokenmill.operators.ordering import ROWS_PER_SEGMENT, SHUFFLE_KEY_RANGE, positions


def sft_tensors(
    examples: DataFrame, block_size: int = C.BLOCK_SIZE, mask_align: str = "input", overflow: str = "truncate"
) -> DataFrame:
    """Adds ``x, y, m`` of length ``block_size``: cut, shift by one, pad.

    ``mask_align="input"`` takes the mask at the input position, ``"target"`` at the target's.
    ``overflow="truncate"`` keeps the head of an example, later parts are not read.
    ``"windows"`` gives all of it: one row per ``block_size`` targets with ``start``, the place of
    its first token. A window takes the token behind it as its last target; only the first token
    of a later part of an example has no window that predicts it.
    """
    shift_mask = {"input": arrays.inputs, "target": arrays.targets}[mask_align]
    kept = [c for c in examples.columns if c not in ("tokens", "loss_mask", "start")]
    if overflow == "windows":
        last = F.greatest(F.size("tokens") - 2, F.lit(0))
        whole = examples.withColumn("_at", F.explode(F.sequence(F.lit(0), last, F.lit(block_size))))
        tokens = F.slice("tokens", F.col("_at") + 1, F.lit(block_size + 1))
        mask = F.slice("loss_mask", F.col("_at") + 1, F.lit(block_size + 1))
        kept.append((F.col("start") + F.col("_at")).alias("start"))
    else:
        whole = examples.where(F.col("start") == 0)
        tokens = arrays.head(F.col("tokens"), block_size + 1)
        mask = arrays.head(F.col("loss_mask"), block_size + 1)
    return whole.select(
        *kept,
        arrays.pad(arrays.inputs(tokens), block_size, C.PAD_TOKEN).alias("x"),
        arrays.pad(arrays.targets(tokens), block_size, C.IGNORE_INDEX).alias("y"),
        arrays.pad(shift_mask(mask), block_size, 0).alias("m"),
    )


def sft_targets(tensors: DataFrame) -> DataFrame:
    """Masked targets become the ignore index; ``n_targets`` are left for the loss."""
    masked = tensors.withColumn("y", arrays.ignore_masked(F.col("y"), F.col("m")))
    return masked.withColumn("n_targets", F.size(F.filter("y", lambda t: t != C.IGNORE_INDEX)))


def batch_plan(
    blocks: DataFrame,
    epochs: int,
    batch_size: int = C.BATCH_SIZE,
    accumulation: int = C.ACCUMULATION_STEPS,
    id_column: str = "block_id",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """(epoch, step, micro_step, slot, id): every epoch reshuffled, short last batch kept.

    Ids are shuffled, never token rows. Steps run on over the end of an epoch.
    """
    per_epoch = -(-blocks.count() // batch_size)
    drawn = blocks.select(id_column, F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch"))
    drawn = drawn.withColumn("_draw", F.concat_ws(":", "epoch", id_column))
    placed = positions(
        sampling.keyed(drawn, "_draw", "epoch"),
        sampling.KEYS,
        group=["epoch"],
        rows_per_segment=rows_per_segment,
        even_range=SHUFFLE_KEY_RANGE,
    )
    batch = F.expr(f"epoch * {per_epoch}L + pos div {batch_size}")
    return placed.withColumn("_batch", batch).select(
        "epoch",
        F.expr(f"_batch div {accumulation}").alias("step"),
        F.expr(f"_batch % {accumulation}").cast("int").alias("micro_step"),
        F.expr(f"pos % {batch_size}").cast("int").alias("slot"),
        id_column,
    )
