"""Samples without replacement, as predicates that stay in the scan.

Sizes are row counts, or functions of the number of rows drawn from.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.operators.ordering import (
    SHUFFLE_KEY_RANGE,
    kth_key,
    positions,
    precedes,
    shuffle_keys,
    shuffled_before,
)
from tokenmill.session import cut_lineage

KEYS = ["_k1", "_k2"]
Size = int | Callable[[int], int]


def keyed(ids: DataFrame, id_column: str, stage: str) -> DataFrame:
    """Adds the two shuffle keys of ``stage``."""
    first, second = shuffle_keys(stage, F.col(id_column))
    return ids.withColumn(KEYS[0], first).withColumn(KEYS[1], second)


def written_keys(ids: DataFrame, id_column: str, stage: str) -> DataFrame:
    """(id, keys) in the shared folder: hashed once for the passes that look for a border."""
    return cut_lineage(keyed(ids.select(id_column), id_column, stage))


def border(keys: DataFrame, n: Size) -> tuple | None:
    """Shuffle key of the first row that is not among the first ``n``."""
    return kth_key(keys, KEYS, n, key_range=SHUFFLE_KEY_RANGE)


def in_sample(ids: DataFrame, id_column: str, n: Size, stage: str) -> Column:
    """Predicate: the id is among the first ``n`` of ``ids`` in shuffled order.

    It needs no join, so a sample is drawn before any text is tokenized or moved.
    """
    return shuffled_before(stage, F.col(id_column), border(written_keys(ids, id_column, stage), n))


def in_head(ids: DataFrame, id_column: str, n: Size) -> Column:
    """Predicate: the id is among the ``n`` smallest."""
    return precedes([F.col(id_column)], kth_key(ids, [id_column], n))


def ranked_sample(ids: DataFrame, id_column: str, n: Size, stage: str) -> DataFrame:
    """(id, rank) of the sample, rank 0 first."""
    keys = written_keys(ids, id_column, stage)
    first_left_out = border(keys, n)
    sample = keys.where(precedes([F.col(k) for k in KEYS], first_left_out))
    top = SHUFFLE_KEY_RANGE[1] if first_left_out is None else first_left_out[0]
    return positions(sample, KEYS, "rank", even_range=(0, top)).drop(*KEYS)


def blend_predicate(
    docs: DataFrame, head: Size, take: Size, stage: str = "blend", before: tuple | None = None
) -> Column:
    """Predicate on ``doc_id``: a seeded sample of ``take`` among the first ``head`` documents."""
    behind = kth_key(docs, ["doc_id"], head)
    first = precedes([F.col("doc_id")], behind)
    if before is not None and (behind is None or behind > before):
        raise ValueError("the blend's documents reach into the validation part of the corpus")
    return first & in_sample(docs.where(first), "doc_id", take, stage)


def blend_sample(docs: DataFrame, head: Size, take: Size, stage: str = "blend") -> DataFrame:
    """(doc_id, rank) of the blend."""
    return ranked_sample(docs.where(in_head(docs, "doc_id", head)), "doc_id", take, stage)
