"""How the given tables stand in for the inputs of each job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.sources import readers

BLOCK = 256  # training block
SFT_BLOCK = 2048  # between the lengths of the examples, so some are cut and some are padded
REQUEST_BLOCK = 64  # short enough that contexts are cut; for the request queries only
TOP_K, TOP_P = 5, 0.9
EVAL_EVERY = 2
RUNNING_EVERY = 10
EPOCHS = 2
SAMPLE_SHARE = 0.5  # of the conversations; of the documents for the blend's head; of that head

# ---- fixed values: event type -> metric it stands for; tokens of the small rank table ----
METRICS = {
    "click": "eval/hellaswag_acc",
    "error": "eval/lambada_acc",
    "purchase": "eval/arc_easy_acc",
    "signup": "eval/winogrande_acc",
    "view": "eval/val_loss",
}
MERGES = [
    " t", "he", "in", "er", "on", "an", "re", " a", "th", "en", "es", "ou", "nd", " o", "is", "ei", "ch", "ti",
    " the", "ing", "and", "tion",
]
# ---- end of fixed values ----


def choice_items(spark: SparkSession, folder: str) -> DataFrame:
    """(item_id, ctx, endings, label): an item's last three words against those of the next
    three items, the true ending placed at ``item_id % 4``."""
    parts = readers.table(spark, folder, "benchmark", "item_id", "text")
    n = parts.count()
    cut = r"(?s)^(.*) ([^ ]* [^ ]* [^ ]*)$"
    parts = parts.select(
        "item_id",
        F.regexp_extract("text", cut, 1).alias("ctx"),
        F.regexp_extract("text", cut, 2).alias("ending"),
        F.expr("int(item_id % 4)").alias("label"),
    )
    wanted = parts.select("item_id", "ctx", "label", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("place"))
    source = (F.col("item_id") + F.pmod(F.col("place") - F.col("label"), F.lit(4))) % n
    others = parts.select(F.col("item_id").alias("source"), "ending")
    placed = wanted.withColumn("source", source).join(others, "source")
    gathered = placed.groupBy("item_id").agg(
        F.first("ctx").alias("ctx"),
        F.sort_array(F.collect_list(F.struct("place", "ending"))).alias("four"),
        F.first("label").alias("label"),
    )
    return gathered.select("item_id", "ctx", F.col("four.ending").alias("endings"), "label")


def labelled_items(spark: SparkSession, folder: str) -> DataFrame:
    """The same items in the labelled shape, with letters."""
    letters = F.array(*[F.lit(x) for x in "ABCD"])
    return choice_items(spark, folder).select(
        "item_id",
        F.col("ctx").alias("question"),
        F.struct(F.col("endings").alias("text"), letters.alias("label")).alias("choices"),
        F.element_at(letters, F.col("label") + 1).alias("answer_key"),
    )


def cloze_items(spark: SparkSession, folder: str) -> DataFrame:
    """(item_id, sentence, option1, option2, answer): the middle word is the blank; the other
    option is the next item's middle word."""
    items = readers.table(spark, folder, "benchmark", "item_id", "text")
    n = items.count()
    words = items.withColumn("words", F.split("text", " ")).withColumn("at", F.expr("size(words) div 2"))
    words = words.select(
        "item_id",
        F.array_join(
            F.concat(
                F.slice("words", F.lit(1), F.col("at").cast("int")),
                F.array(F.lit("_")),
                F.slice("words", (F.col("at") + 2).cast("int"), F.size("words")),
            ),
            " ",
        ).alias("sentence"),
        F.element_at("words", (F.col("at") + 1).cast("int")).alias("word"),
    )
    others = words.select(F.pmod(F.col("item_id") - 1, F.lit(n)).alias("item_id"), F.col("word").alias("other"))
    even = F.col("item_id") % 2 == 0
    return words.join(others, "item_id").select(
        "item_id",
        "sentence",
        F.when(even, F.col("word")).otherwise(F.col("other")).alias("option1"),
        F.when(even, F.col("other")).otherwise(F.col("word")).alias("option2"),
        F.when(even, "1").otherwise("2").alias("answer"),
    )


def metric_name(event_type: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(part) for pair in METRICS.items() for part in pair]), event_type)


def metric_log(events: DataFrame) -> DataFrame:
    """(run, step, metric, value, logged_at): a user's events as the log of a run."""
    return events.select(
        F.col("user_id").alias("run"),
        F.col("event_id").alias("step"),
        metric_name(F.col("event_type")).alias("metric"),
        "value",
        F.col("ts").alias("logged_at"),
    )


def resumed_log(events: DataFrame) -> DataFrame:
    """The log with steps a thousandth as fine, so that steps repeat as after a resume."""
    return metric_log(events).withColumn("step", F.expr("step div 1000"))


def checkpoint_files(events: DataFrame) -> DataFrame:
    return events.select(_checkpoint_path(F.col("event_id")).alias("path"))


def done_list(events: DataFrame) -> DataFrame:
    return checkpoint_files(events.where(F.col("event_type") == "view"))


def _checkpoint_path(event_id: Column) -> Column:
    return F.format_string("ckpt_%07d.pt", event_id * 500)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return readers.table(spark, folder, "events", "event_id", "ts", "user_id", "event_type", "value")


def share(rows: int) -> int:
    """Size of a sample, so that it grows with the table it is drawn from."""
    return int(rows * SAMPLE_SHARE)
