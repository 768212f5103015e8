"""Pick up new checkpoints, each once, a few at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tokenmill import constants as C
from tokenmill.operators import checkpoints
from tokenmill.session import cut_lineage


LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def batch_files(files: int, least: int, most_batches: int = 16) -> int:
    """Files in a batch: ``least``, more in a large folder, since each batch costs commits and writes of its own however small it is."""
    return max(least, -(-files // most_batches))


@contextmanager
def _listed_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Spark looks up the files of a batch by a job, with a task for each file unless it is told otherwise."""
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, str(2 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(LISTING, before)


def checkpoint_stream(spark: SparkSession, folder: str, files_per_batch: int = 1) -> DataFrame:
    """Checkpoint files as they appear; the source's log takes the place of a lock and a list."""
    schema = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
    files = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("pathGlobFilter", "ckpt_*.pt")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return files.select("path")


def pick_up(
    files: DataFrame,
    done_path: str,
    checkpoint: str,
    evaluate: Callable[[DataFrame], None] | None = None,
    every: int = C.EVALUATE_EVERY,
) -> None:
    """Hand each evaluable checkpoint to ``evaluate``, then list it as done.

    Paths that were handed over are stream state, keyed by path, so a batch looks up its own paths and does not read
    the list. A batch that fails before it is listed is handed over again: at least once. Each
    batch writes its own part of the list, so a repeated batch replaces it.
    """
    found = checkpoints.evaluable(files, every).dropDuplicates(["path"])

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = cut_lineage(batch)  # evaluated and listed from one read of the state
        if evaluate is not None:
            evaluate(batch)
        batch.write.mode("overwrite").parquet(f"{done_path}/batch_id={batch_id}")

    with _listed_in_few_tasks(files.sparkSession):
        query = (
            found.writeStream.foreachBatch(take)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
