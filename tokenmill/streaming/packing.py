"""Training blocks of a growing corpus: arriving documents extend the stream, nothing is packed again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.operators.corpus import DOCS_PER_SEGMENT, extend_blocks
from tokenmill.session import cut_lineage
from tokenmill.sources.files import exists

LEDGER = "batch_id BIGINT, n_docs BIGINT, tok_end BIGINT, tail_start BIGINT, tail ARRAY<INT>"
BLOCKS = "block_id BIGINT, record ARRAY<INT>, batch_id BIGINT"
OFFSETS = "doc_id BIGINT, n_tokens BIGINT, tok_start BIGINT, batch_id BIGINT"


def pack_batch(
    docs: DataFrame, batch_id: int, tokenizer, folder: str, block_size: int, docs_per_segment: int = DOCS_PER_SEGMENT
) -> None:
    """Appends one batch of documents, by id, to the stream under ``folder``.

    The ledger has a row for each batch: where its tokens end and the open tail, the tokens behind the last
    whole block (a block at most). A batch goes on from the last row before its own, so a repeated batch replaces its
    blocks, offsets and row and gives the same.
    """
    spark = docs.sparkSession
    before = None
    if exists(spark, f"{folder}/ledger"):
        rows = spark.read.schema(LEDGER).parquet(f"{folder}/ledger").where(F.col("batch_id") < batch_id)
        before = rows.orderBy(F.desc("batch_id")).first()
    start, tail_start, tail = (before["tok_end"], before["tail_start"], before["tail"]) if before else (0, 0, [])
    offsets, blocks, rest = extend_blocks(docs, tokenizer, block_size, start, tail_start, tail, docs_per_segment)
    part = f"batch_id={batch_id}"
    offsets.write.mode("overwrite").parquet(f"{folder}/offsets/{part}")
    blocks.write.mode("overwrite").parquet(f"{folder}/blocks/{part}")
    seen = spark.read.schema(OFFSETS).parquet(f"{folder}/offsets/{part}")
    n_docs, end = seen.agg(F.count(F.lit(1)), F.coalesce(F.max(F.col("tok_start") + F.col("n_tokens")), F.lit(start))).first()
    open_from = max(end - 1, 0) // block_size * block_size
    left = rest.where(F.col("block_id") == open_from // block_size).first()  # one row of a block's tokens at most
    row = (n_docs, end, open_from, list(left["record"]) if left else [])
    state = spark.createDataFrame([row], "n_docs BIGINT, tok_end BIGINT, tail_start BIGINT, tail ARRAY<INT>")
    state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/ledger/{part}")


def pack_stream(
    docs: DataFrame, tokenizer, folder: str, checkpoint: str, block_size: int = C.BLOCK_SIZE, docs_per_segment: int = DOCS_PER_SEGMENT
) -> None:
    """Take in what has arrived and stop. Later batches lie behind earlier ones, documents of a batch are in order of their ids."""

    def take(batch: DataFrame, batch_id: int) -> None:
        pack_batch(cut_lineage(batch.select("doc_id", "text")), batch_id, tokenizer, folder, block_size, docs_per_segment)

    query = docs.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")


def read_offsets(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(OFFSETS).parquet(f"{folder}/offsets")
