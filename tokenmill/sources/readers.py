"""Scans. All are lazy and splittable; file listings and rank tables are the bounded ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill import schemas
from tokenmill.functions.tokenizers import parse_ranks
from tokenmill.operators.corpus import inputs_and_targets
from tokenmill.sources import packed


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents", "doc_id", "text")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations", "conv_id", "turn", "role", "text")


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line under a declared schema, failing on a malformed line."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def sft_examples(spark: SparkSession, path: str) -> DataFrame:
    """Written instruction data, with the split as a partition column."""
    return json_rows(spark, path, schemas.SFT_FILE + ", split STRING")


def text_log(spark: SparkSession, path: str) -> DataFrame:
    """(log, line_no, line) of every file under ``path``, splittable.

    ``line_no`` orders the lines of a log: start of the file block, then place within it.
    """
    lines = spark.read.text(path)
    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")
    )
    return lines.select(F.col("_metadata.file_path").alias("log"), place.alias("line_no"), F.col("value").alias("line"))


def named_logs(spark: SparkSession, path: str) -> DataFrame:
    """(log, line_no, line) of files as ``write_logs`` leaves them: the name before the first tab is that of the log; none is null."""
    name, line = F.substring_index("line", "\t", 1), F.expr("substring(line, locate('\t', line) + 1)")
    return text_log(spark, path).select(F.nullif(name, F.lit("")).alias("log"), "line_no", line.alias("line"))


def checkpoint_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of numbered checkpoints; contents are never read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "ckpt_*.pt").load(folder)
    return files.select("path")


def result_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RESULTS).option("multiLine", True).json(path)


def results_lines(spark: SparkSession, path: str) -> DataFrame:
    """Result objects as ``write_results`` leaves them, one per line with the name of its log."""
    return json_rows(spark, path, "log BIGINT, " + schemas.RESULTS)


def choice_items(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, schemas.CHOICE_ITEMS)


def labelled_items(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, schemas.LABELLED_ITEMS)


def last_word_items(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, schemas.LAST_WORD_ITEMS)


def cloze_items(spark: SparkSession, path: str) -> DataFrame:
    return json_rows(spark, path, schemas.CLOZE_ITEMS)


def instructions(spark: SparkSession, path: str) -> DataFrame:
    """Single-turn instruction rows, (pair_id, instruction, input, output)."""
    return json_rows(spark, path, schemas.INSTRUCTIONS)


def rank_table(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Byte-pair ranks from lines of ``base64 rank``; bounded by 16-bit token ids."""
    lines = spark.read.text(path).limit(C.MAX_TOKEN_ID + 2).collect()
    if len(lines) > C.MAX_TOKEN_ID + 1:
        raise ValueError("more ranks than 16-bit token ids")
    return parse_ranks(row["value"] for row in lines)


def packed_blocks(
    spark: SparkSession, folder: str, read_bytes: int = packed.READ_BYTES, split: str | None = None
) -> DataFrame:
    """(split, block_id, x, y) from exported records; a task reads about ``read_bytes`` of the part files."""
    records = packed.read_records(spark, folder, split, read_bytes)
    return records.select("split", "block_id", *inputs_and_targets(F.col("record")))
