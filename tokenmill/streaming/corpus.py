"""Tokenize documents as files arrive, appending to a token table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tokenmill import schemas
from tokenmill.operators.corpus import tokenize_documents


def document_stream(
    spark: SparkSession, folder: str, glob: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schemas.DOCUMENTS).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """The stream of the table ``name.parquet`` of a folder, be it one file or a folder of part files.

    A name filter would hold for the part files too. The path is a pattern since a stream's plain path has to be a folder.
    """
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}")


def tokenize_stream(
    docs: DataFrame, tokenizer, target: str, checkpoint: str, spread_over: int | None = None
) -> None:
    """Take in what is there and stop. Stateless; a restart goes on behind the last commit.

    ``spread_over`` redistributes each batch, for arrivals of few files for many cores.
    Split and packing need positions over the whole corpus and follow as batch steps.
    """
    if spread_over:
        docs = docs.repartition(spread_over, "doc_id")
    tokens = tokenize_documents(docs, tokenizer)
    query = (
        tokens.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
