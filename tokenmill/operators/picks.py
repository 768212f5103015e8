"""From scores to predictions and accuracy. Each task has its own tie rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.operators import requests
from tokenmill.operators.ordering import ROWS_PER_SEGMENT, Running, running
from tokenmill.operators.scoring import ScoreTable, next_token


def pick_choice(scores: DataFrame) -> DataFrame:
    """(item_id, label, pred, hit): highest score, the first choice among equals."""
    best = F.max_by("choice_idx", F.struct("score", (-F.col("choice_idx")).alias("order")))
    picked = scores.groupBy("item_id").agg(best.alias("pred"), F.first("label").alias("label"))
    return picked.withColumn("hit", (F.col("pred") == F.col("label")).cast("int"))


def pick_labelled(scores: DataFrame) -> DataFrame:
    """The same for choices that carry a label, compared with the answer key."""
    best = F.max_by("choice_label", F.struct("score", (-F.col("choice_idx")).alias("order")))
    picked = scores.groupBy("item_id").agg(best.alias("pred"), F.first("answer_key").alias("answer_key"))
    return picked.withColumn("hit", (F.col("pred") == F.col("answer_key")).cast("int"))


def pick_option(scores: DataFrame) -> DataFrame:
    """Two-way pick: "1" only where it scores strictly higher."""
    both = scores.groupBy("item_id").agg(
        F.max(F.when(F.col("choice_idx") == 0, F.col("score"))).alias("first"),
        F.max(F.when(F.col("choice_idx") == 1, F.col("score"))).alias("second"),
        F.first("answer").alias("answer"),
    )
    pred = F.when(F.col("first") > F.col("second"), "1").otherwise("2")
    return both.select("item_id", pred.alias("pred"), "answer", (pred == F.col("answer")).cast("int").alias("hit"))


def pick_last_word(
    asked: DataFrame, scores: ScoreTable, tokenizer, block_size: int = C.BLOCK_SIZE
) -> DataFrame:
    """Hit where the most likely next token is the first token of the last word.

    The best-token table has a row per vocabulary entry; it is broadcast if counted to be small.
    """
    context = requests.last_word_context(tokenizer.encode(F.col("context")), block_size)
    coded = asked.select(
        "item_id",
        requests.last_token(context, tokenizer.end_of_text()).alias("prev"),
        F.try_element_at(tokenizer.encode(F.col("continuation")), F.lit(1)).alias("wanted"),
    ).where(F.col("wanted").isNotNull())
    best = F.broadcast(next_token(scores)) if scores.broadcast_floors else next_token(scores)
    guessed = coded.join(best, "prev", "left")
    hit = F.coalesce((F.col("next") == F.col("wanted")).cast("int"), F.lit(0))
    return guessed.select("item_id", F.col("next").alias("pred"), "wanted", hit.alias("hit"))


def accuracy(picks: DataFrame, task: str) -> DataFrame:
    """(task, n, correct, acc) over the items that were scored; 0.0 without any."""
    return picks.agg(
        F.lit(task).alias("task"),
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("correct"),
        F.coalesce(F.try_divide(F.sum("hit"), F.count(F.lit(1))), F.lit(0.0)).alias("acc"),
    )


def running_accuracy(picks: DataFrame, every: int, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """(task, n, acc) after every ``every`` items of a task, in item order."""
    measures = [Running("n", "count"), Running("correct", "sum", F.col("hit"))]
    counted = running(picks, ["item_id"], measures, group=["task"], rows_per_segment=rows_per_segment)
    n, correct = F.col("n") + 1, F.col("correct") + F.col("hit")
    return counted.select("task", n.alias("n"), (correct / n).alias("acc")).where(F.col("n") % every == 0)
