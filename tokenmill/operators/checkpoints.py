"""Which checkpoints are still to be evaluated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C


def iteration(path: Column) -> Column:
    return F.regexp_extract(path, r"ckpt_(\d+)\.pt$", 1)


def evaluable(files: DataFrame, every: int = C.EVALUATE_EVERY) -> DataFrame:
    """(path, iter) of numbered checkpoints at a multiple of ``every``, not the first."""
    named = files.select("path", iteration(F.col("path")).alias("_digits")).where(F.col("_digits") != "")
    numbered = named.select("path", F.col("_digits").cast("bigint").alias("iter"))
    return numbered.where((F.col("iter") % every == 0) & (F.col("iter") != 0))


def pending(files: DataFrame, done: DataFrame, every: int = C.EVALUATE_EVERY) -> DataFrame:
    """Evaluable checkpoints whose path is not in the done list."""
    return evaluable(files, every).join(done.select("path"), "path", "left_anti")


def next_pending(files: DataFrame, done: DataFrame, every: int = C.EVALUATE_EVERY) -> DataFrame:
    """The pending checkpoint of the lowest iteration: one per call."""
    return pending(files, done, every).orderBy("iter", "path").limit(1)
