"""Sinks. Spark's committer decides what counts as written; task retries leave no trace."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill.operators import sampling
from tokenmill.operators.corpus import block_records, flat_records, pack_blocks
from tokenmill.operators.ordering import SHUFFLE_KEY_LIMIT
from tokenmill.session import cut_lineage
from tokenmill.sources import packed
from tokenmill.sources.files import claimed, is_complete, move, remove


#: Examples in one JSON file, some 100 MB of tokens as text.
ROWS_PER_FILE = 20_000


def write_token_store(store: DataFrame, path: str) -> None:
    """Canonical form of the tokenized corpus: Parquet, one folder per split."""
    store.write.mode("overwrite").partitionBy("split").parquet(path)


def write_sft_json(dataset: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """One example per line, one folder per split, files in shuffled order.

    The shuffle key is uniform, so equal ranges of it are equal files: no sampling pass. Range
    number i goes to partition i. The dataset is written once before, so counting it does not run its plan again.
    """
    dataset = cut_lineage(dataset)
    files = max(1, -(-dataset.select(*sampling.KEYS).count() // rows_per_file))
    span = -(-SHUFFLE_KEY_LIMIT // files)
    number = F.expr(f"int(`{sampling.KEYS[0]}` div {span}L)")
    placed = dataset.repartitionById(files, number).sortWithinPartitions("split", *sampling.KEYS, "start")
    columns = ["split", "example_id", "source", "start", "tokens", "loss_mask"]
    placed.select(*columns).write.mode("overwrite").partitionBy("split").json(path)


def append_metrics(log: DataFrame, path: str) -> None:
    """Append to a metric log; repeats are told apart by ``logged_at`` when it is read."""
    log.select("run", "step", "metric", "value", "logged_at").write.mode("append").parquet(path)


def write_logs(lines: DataFrame, path: str) -> None:
    """(log, line_no, line) as text files of many logs each; every line begins with the name of its log and a tab.

    A log is whole in one file, in the order of its lines, so there are as many files as partitions, however many logs
    there are. A line with line breaks is several lines of its log, null is an empty one. Names have no tab or line break.
    """
    name = F.coalesce(F.col("log").cast("string"), F.lit(""))
    parts = F.split(F.coalesce("line", F.lit("")), r"\r\n|\r|\n")
    text = F.array_join(F.transform(parts, lambda part: F.concat(name, F.lit("\t"), part)), "\n")
    placed = lines.repartition("log").sortWithinPartitions("log", "line_no")
    placed.select(text.alias("value")).write.mode("overwrite").text(path)


def write_results(results: DataFrame, path: str) -> None:
    """One JSON object per log, as text lines."""
    results.select("json").write.mode("overwrite").text(path)


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """Digest of names, sizes and times of the input files; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    facts = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    total, count = files.agg(F.sum(facts), F.count(F.lit(1))).first()
    return f"{count}-{int(total) % (1 << 64):016x}" if count else "empty"


def build_once(
    spark: SparkSession, folder: str, fingerprint: str, build: Callable[[], DataFrame], stale: float = 600, poll: float = 2
) -> DataFrame:
    """The table built from these inputs: read if a committed one is there, else built, by one builder at a time.

    A builder claims the name by creating a file that must not exist, refreshes it while it builds aside, and
    publishes by a rename. Others wait and read. A claim that was not refreshed for ``stale`` seconds is taken
    over; of several that try, the rename of the old claim lets one through. A write that broke off has no success marker
    and is replaced.
    """
    path = f"{folder}/{fingerprint}"
    while not is_complete(spark, path):
        with claimed(spark, f"{path}.claim", stale) as mine:
            if not mine:
                time.sleep(poll)
            elif not is_complete(spark, path):
                staged = f"{path}.staged-{uuid.uuid4().hex}"
                try:
                    build().write.parquet(staged)
                    remove(spark, path)
                    move(spark, staged, path)
                finally:
                    remove(spark, staged)
    return spark.read.parquet(path)


def export_blocks(
    store: DataFrame, folder: str, block_size: int, blocks_per_file: int = 1 << 16, overlap: bool = True
) -> DataFrame:
    """Packs a token store into fixed-length binary records of 16-bit tokens, in block order;
    returns the part list.

    A record is a block and, with ``overlap``, the next token, so that it stands alone. Without
    it the parts of a split in block order are its flat token stream, whole: a last record may be
    shorter and is a part of its own. See ``export_corpus`` where the documents are at hand.
    """
    order = ["split", "file", "block_id"]
    if overlap:
        blocks = pack_blocks(store, block_size, blocks_per_file)
        records = blocks.select(*order, F.concat("x", F.slice("y", -1, 1)).alias("record"))
    else:
        records = flat_records(store, block_size, blocks_per_file)
    packed.write_records(records.sortWithinPartitions(*order), folder)
    return packed.parts(store.sparkSession, folder)


def export_corpus(docs: DataFrame, tokenizer, folder: str, block_size: int, overlap: bool = True, **options) -> DataFrame:
    """As ``export_blocks`` from documents, with one shuffle of texts; a file holds the blocks of one segment."""
    packed.write_records(block_records(docs, tokenizer, block_size, 1 if overlap else 0, **options), folder)
    return packed.parts(docs.sparkSession, folder)
