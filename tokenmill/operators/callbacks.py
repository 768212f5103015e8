"""Scores from a function of the caller, as a model gives them: token sequences in batches, one number for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tokenmill.session import cut_lineage

#: A batch of sequences, padded to its longest, and where each one's scored part begins -> summed log-probabilities.
Scorer = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]

TOKENS_PER_TASK = 4_000_000
BATCH_TOKENS = 65_536


def callback_scores(
    coded: DataFrame,
    make_scorer: Callable[[], Scorer],
    keys: list[str],
    tokens_per_task: int = TOKENS_PER_TASK,
    batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """(keys, score) of ``loglik_requests``, by a scorer that each worker task sets up once, before its first batch.

    ``scorer(tokens, lengths, starts)`` gets int32 ``tokens[i, :lengths[i]]``, zeros behind them, and gives the summed log-probability
    of the tokens from ``starts[i]`` on. Requests are dealt by length: those of a task differ in length by less than two,
    so little is padding, and a task has about ``tokens_per_task`` tokens; a batch has at most ``batch_tokens`` with padding,
    or one request. Requests without a continuation are 0 and not asked for. The driver gets one row per power of two.
    """
    sized = coded.select(*keys, "tokens", "cont_start", F.size("tokens").cast("bigint").alias("_n"))
    asked = cut_lineage(sized.withColumn("_size", F.bin(F.col("_n"))).withColumn("_size", F.length("_size")))
    totals = asked.groupBy("_size").agg(F.sum("_n").alias("total"), F.count(F.lit(1)).alias("rows")).orderBy("_size").collect()
    first, tasks, number = 0, {}, F.lit(None).cast("int")
    for row in totals:  # at most one for each bit of a length
        count = max(1, min(row["rows"], -(-row["total"] // tokens_per_task)))
        tasks[row["_size"]] = count
        dealt = F.lit(first) + F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int")
        number = F.when(F.col("_size") == row["_size"], dealt).otherwise(number)
        first += count
    schema = T.StructType([coded.schema[k] for k in keys]).add("score", T.DoubleType())
    if not tasks:
        return coded.sparkSession.createDataFrame([], schema)
    arrow, width = to_arrow_schema(schema), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            starts = batch.column(width + 1).to_numpy().astype(np.int64)
            lengths = batch.column(width).value_lengths().to_numpy().astype(np.int64)
            flat, ends = batch.column(width).flatten().to_numpy(), np.cumsum(lengths)
            scores = np.zeros(len(lengths))
            order = np.argsort(lengths, kind="stable")
            order = order[starts[order] < lengths[order]]
            at = 0
            while at < len(order):
                fits = lengths[order[at:]] * np.arange(1, len(order) - at + 1) <= batch_tokens
                some = order[at : at + max(1, int(fits.sum()))]
                tokens = np.zeros((len(some), int(lengths[some].max())), np.int32)
                for i, row in enumerate(some.tolist()):
                    tokens[i, : lengths[row]] = flat[ends[row] - lengths[row] : ends[row]]
                scorer = scorer or make_scorer()
                scores[some] = scorer(tokens, lengths[some], starts[some])
                at += len(some)
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(width)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], schema=arrow)

    placed = asked.repartitionById(first, number)
    return placed.select(*keys, "tokens", "cont_start").mapInArrow(run, schema)
