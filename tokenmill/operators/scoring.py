"""Next-token scores as a table: a bigram provider, look-up of tokens, losses, candidates.

Log-probabilities are whole micro-nats, so sums do not depend on the order of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions.tokenizers import STRETCH, ByteTokenizer, document_tokens, parts
from tokenmill.session import cut_lineage, spread

MICRO = 1_000_000
BROADCAST_PAIRS = 1_000_000  # about 40 MB as a hash table


@dataclass(frozen=True)
class ScoreTable:
    """``pairs(prev, next, n, logprob_micro)`` and ``floors(prev, floor_micro)`` for pairs
    never seen. ``floors`` has one row per token that comes first in a pair. What is broadcast has
    been counted (see ``of_table``)."""

    pairs: DataFrame
    floors: DataFrame
    unseen_micro: int
    broadcast_pairs: bool
    broadcast_floors: bool = False

    @staticmethod
    def of_table(pairs: DataFrame, floors: DataFrame, unseen_micro: int) -> ScoreTable:
        """A table from any provider; both sides are counted before they may be broadcast."""
        small = (df.count() <= BROADCAST_PAIRS for df in (pairs, floors))
        return ScoreTable(pairs, floors, unseen_micro, *small)


def bigram_counts(docs: DataFrame, tokenizer) -> DataFrame:
    """(prev, next, n, logprob_micro) with add-one smoothing over the vocabulary.

    Every document starts and ends at end-of-text, which makes the pairs those of the packed
    stream. Pairs are counted before they are shuffled.
    """
    texts = spread(docs.select("doc_id", "text"), "doc_id")
    if isinstance(tokenizer, ByteTokenizer):  # few enough ids for a table of counts in each task
        seen = texts.where(F.col("text").isNotNull()).select("text").mapInArrow(_byte_pairs, "prev INT, next INT, n BIGINT")
        counts = seen.groupBy("prev", "next").agg(F.sum("n").alias("n"))
    else:
        end = F.array(tokenizer.end_of_text())
        tokens = texts.select(document_tokens(tokenizer, F.col("text")).alias("tokens"))
        shifted = F.concat(end, F.slice("tokens", F.lit(1), F.size("tokens") - 1))
        pairs = tokens.select(F.explode(F.arrays_zip(shifted.alias("prev"), F.col("tokens").alias("next"))).alias("p"))
        counts = pairs.groupBy(F.col("p.prev").alias("prev"), F.col("p.next").alias("next")).agg(
            F.count(F.lit(1)).alias("n")
        )
    context = F.sum("n").over(Window.partitionBy("prev"))  # at most one row per vocabulary entry
    return counts.withColumn("n_prev", context).withColumn(
        "logprob_micro", _micro((F.col("n") + 1) / (F.col("n_prev") + C.VOCAB_SIZE))
    )


def _byte_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(prev, next, n) of a task's texts as bytes, each between two ends of text: one table of counts, 257 times 257."""
    ids, totals = 257, np.zeros(257 * 257, np.int64)
    for batch in batches:
        for texts in parts(batch.column(0), pc.binary_length(batch.column(0))):
            lengths = pc.binary_length(texts).to_numpy().astype(np.int64)
            stream = np.full(lengths.sum() + len(texts) + 1, ids - 1, np.uint16)
            inside = np.ones(len(stream), bool)
            inside[np.concatenate(([0], np.cumsum(lengths + 1)))] = False
            stream[inside] = np.frombuffer(b"".join([t.as_buffer() for t in texts]), np.uint8)
            for at in range(0, len(stream) - 1, STRETCH):
                part = stream[at : at + STRETCH + 1].astype(np.int64)
                totals += np.bincount(part[:-1] * ids + part[1:], minlength=ids * ids)
    found = np.flatnonzero(totals)
    pair = [np.where(p == ids - 1, C.END_OF_TEXT, p).astype(np.int32) for p in (found // ids, found % ids)]
    yield pa.RecordBatch.from_arrays([*map(pa.array, pair), pa.array(totals[found])], names=["prev", "next", "n"])


def _micro(probability: Column) -> Column:
    return F.round(F.ln(probability) * MICRO).cast("bigint")


def fit_bigram(docs: DataFrame, tokenizer) -> ScoreTable:
    """Count once, write the counts to the shared folder, serve every look-up from there."""
    model = cut_lineage(bigram_counts(docs, tokenizer))
    floors = model.groupBy("prev").agg(F.first("n_prev").alias("n_prev")).select(
        "prev", _micro(F.lit(1.0) / (F.col("n_prev") + C.VOCAB_SIZE)).alias("floor_micro")
    )
    floors = cut_lineage(floors)  # a table, so that a join may split it and no look-up groups again
    return ScoreTable.of_table(model, floors, round(-math.log(C.VOCAB_SIZE) * MICRO))


def score_pairs(pairs: DataFrame, scores: ScoreTable) -> DataFrame:
    """Adds ``logprob_micro`` for (prev, next).

    A score table within the checked size is broadcast. A larger one is shuffled by both tokens; callers count
    equal pairs together first (``n_pairs``), so a frequent pair is a few rows. Floors beyond the size are
    looked up by ``with_floors``.
    """
    known = scores.pairs.select("prev", "next", "logprob_micro")
    if scores.broadcast_pairs:
        found = pairs.join(F.broadcast(known), ["prev", "next"], "left")
    else:
        found = pairs.join(known, ["prev", "next"], "left")
    if scores.broadcast_floors:
        floored = found.join(F.broadcast(scores.floors), "prev", "left")
    else:
        floored = with_floors(found, scores.floors)
    score = F.coalesce("logprob_micro", "floor_micro", F.lit(scores.unseen_micro))
    return floored.withColumn("logprob_micro", score).drop("floor_micro")


def with_floors(found: DataFrame, floors: DataFrame) -> DataFrame:
    """Adds ``floor_micro`` by ``prev``, where the floors are too many to broadcast and some ``prev`` fill much of the rows.

    A ``prev`` with more rows than a task's fair share is a heavy hitter; there are fewer of them than tasks, so only their floors
    are broadcast and their rows stay where they are. The others are shuffled. Rows are written first: counting and
    looking up read them twice.
    """
    tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = cut_lineage(found)
    counts = cut_lineage(found.where("prev is not null").groupBy("prev").agg(F.count(F.lit(1)).alias("n")))
    share = -(-(counts.agg(F.sum("n")).first()[0] or 0) // tasks)
    heavy = cut_lineage(floors.join(F.broadcast(counts.where(F.col("n") > share).select("prev")), "prev", "left_semi"))
    named = F.broadcast(heavy.select("prev"))
    stay = found.join(named, "prev", "left_semi").join(F.broadcast(heavy), "prev", "left")
    return stay.unionByName(found.join(named, "prev", "left_anti").join(floors, "prev", "left"))


def loglik_scores(coded: DataFrame, scores: ScoreTable, keys: list[str]) -> DataFrame:
    """(keys, score): summed log-probability of each continuation; 0 for an empty one."""
    padded = F.concat(F.array(F.lit(C.END_OF_TEXT)), F.col("tokens"))
    scored = F.size("tokens") - F.col("cont_start")
    prev = F.slice(padded, F.col("cont_start") + 1, scored)
    following = F.slice(padded, F.col("cont_start") + 2, scored)
    zipped = F.arrays_zip(prev.alias("prev"), following.alias("next"))
    scored_pairs = score_pairs(_counted(_unfold(coded, keys, zipped), keys), scores)
    micro = F.when(F.col("next").isNull(), F.lit(0)).otherwise(F.col("logprob_micro") * F.col("n_pairs"))
    return scored_pairs.groupBy(*keys).agg((F.sum(micro) / MICRO).alias("score"))


def next_token(scores: ScoreTable) -> DataFrame:
    """(prev, next): the most likely token behind each, the smallest among equals."""
    best = F.min_by("next", F.struct((-F.col("n")).alias("order"), "next"))
    return scores.pairs.groupBy("prev").agg(best.alias("next"))


# ---- losses -------------------------------------------------------------------------


def _unfold(rows: DataFrame, keys: list[str], pairs: Column) -> DataFrame:
    """(keys, prev, next), one row per pair; a row without pairs stays, with NULLs."""
    return rows.select(*keys, F.explode_outer(pairs).alias("p")).select(*keys, "p.prev", "p.next")


def _counted(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, prev, next, n_pairs): equal pairs of a key counted, in tasks first."""
    return pairs.groupBy(*keys, "prev", "next").agg(F.count(F.lit(1)).alias("n_pairs"))


def target_pairs(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, prev, next) of every target that is not ignored; NULLs where none is left."""
    zipped = F.arrays_zip(F.col("x").alias("prev"), F.col("y").alias("next"))
    return _unfold(rows, keys, F.filter(zipped, lambda p: p["next"] != C.IGNORE_INDEX))


def masked_loss(targets: DataFrame, scores: ScoreTable, keys: list[str]) -> DataFrame:
    """(keys, loss): mean over the targets that count, NULL where none does."""
    scored = score_pairs(_counted(target_pairs(targets, keys), keys), scores)
    total, n = _weighed()
    return scored.groupBy(*keys).agg((-total / F.nullif(n, F.lit(0)) / MICRO).alias("loss"))


def masked_loss_of_examples(examples: DataFrame, scores: ScoreTable, keys: list[str]) -> DataFrame:
    """``masked_loss`` of whole examples (tokens, loss_mask, mask taken at the input position), without tensors.

    Each token but the last of a row predicts the next one, as in the windows of ``sft_tensors``, so the pairs are taken
    from the tokens as they are and only those that count leave the row.
    """
    behind = F.size("tokens") - 1
    inner = F.greatest(behind, F.lit(0))
    trios = F.arrays_zip(
        F.slice("tokens", F.lit(1), inner).alias("prev"),
        F.slice("tokens", F.lit(2), inner).alias("next"),
        F.slice("loss_mask", F.lit(1), inner).alias("counts"),
    )
    pairs = _unfold(examples, keys, F.filter(trios, lambda t: t["counts"] == 1))
    scored = score_pairs(_counted(pairs, keys), scores)
    total, n = _weighed()
    return scored.groupBy(*keys).agg((-total / F.nullif(n, F.lit(0)) / MICRO).alias("loss"))


def _weighed() -> tuple[Column, Column]:
    """Sum of log-probabilities and number of targets, over counted pairs."""
    is_target = F.col("next").isNotNull()
    total = F.sum(F.when(is_target, F.col("logprob_micro") * F.col("n_pairs")))
    return total, F.coalesce(F.sum(F.when(is_target, F.col("n_pairs"))), F.lit(0))


def val_loss(
    blocks: DataFrame, scores: ScoreTable, batch_size: int = C.BATCH_SIZE, eval_iters: int | None = None
) -> DataFrame:
    """One row: mean of batch means, token mean, perplexity.

    ``blocks`` has ``block_id, x, y``; ignored targets do not count, a batch without any other
    is left out. The short last batch weighs as much as the others. All batches count; with
    ``eval_iters`` the mean of means, and only that, is over so many first ones.
    """
    batched = blocks.withColumn("batch", F.expr(f"block_id div {batch_size}"))
    scored = score_pairs(_counted(target_pairs(batched, ["batch"]), ["batch"]), scores)
    total, n = _weighed()
    batches = scored.groupBy("batch").agg(total.alias("total"), n.alias("n"))
    # per-batch means as micro-nats, so that the mean of means is the same in every plan
    counted = batches.where(F.col("n") > 0)
    means = counted.withColumn("batch_micro", F.round(-F.col("total") / F.col("n")).cast("bigint"))
    token_mean = -F.sum("total") / F.nullif(F.sum("n"), F.lit(0)) / MICRO
    first = F.lit(True) if eval_iters is None else F.col("batch") < eval_iters
    batch_micro = F.when(first, F.col("batch_micro"))
    return means.agg(
        (F.sum(batch_micro) / F.nullif(F.count(batch_micro), F.lit(0)) / MICRO).alias("mean_of_means"),
        token_mean.alias("token_mean"),
        F.exp(token_mean).alias("perplexity"),
    )


# ---- candidates ---------------------------------------------------------------------


def nucleus_candidates(
    scores: DataFrame, top_k: int, top_p: float, temperature: float = 1.0, vocabulary: int = C.VOCAB_SIZE
) -> DataFrame:
    """(prev, next, n_tokens, p): the tokens a sampler may draw behind each token, ``p`` for each of them.

    The k best stay, with all that tie with the k-th; then those whose mass before them is
    within ``top_p``; the rest is renormalised. Where fewer than k tokens were seen, all unseen
    ones tie at the border: they are one row, with ``next`` NULL and their number. Groups are
    bounded by the vocabulary.
    """
    context = Window.partitionBy("prev")
    by_count = context.orderBy(F.desc("n"))
    ranked = scores.select(
        "prev", "next", "n", F.rank().over(by_count).alias("_rank"), F.count(F.lit(1)).over(context).alias("_seen")
    ).where(F.col("_rank") <= top_k)
    # softmax of log-probabilities over a temperature; whole numbers at temperature 1
    weight = F.col("n") + 1 if temperature == 1.0 else F.pow(F.col("n") + 1, F.lit(1.0 / temperature))
    best = ranked.select("prev", "next", weight.cast("double").alias("_weight"), F.lit(1).cast("bigint").alias("n_tokens"), "_seen")
    unseen = best.where((F.col("_seen") < top_k) & (F.col("_seen") < vocabulary)).select("prev", "_seen").distinct()
    rest = unseen.select(
        "prev",
        F.lit(None).cast(scores.schema["next"].dataType).alias("next"),
        F.lit(1.0).alias("_weight"),
        (F.lit(vocabulary) - F.col("_seen")).cast("bigint").alias("n_tokens"),
        "_seen",
    )
    mass = F.sum(F.col("_weight") * F.col("n_tokens"))
    ordered = context.orderBy(F.desc("_weight"), F.col("next").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    massed = best.unionByName(rest).select(
        "prev",
        "next",
        "_weight",
        "n_tokens",
        F.coalesce(mass.over(ordered), F.lit(0.0)).alias("_before"),
        mass.over(context).alias("_all"),
    )
    # of a row of equal tokens so many begin within the mass
    within = F.floor((F.lit(top_p) * F.col("_all") - F.col("_before")) / F.col("_weight")) + 1
    kept = massed.withColumn("n_tokens", F.least(F.col("n_tokens"), within)).where(F.col("n_tokens") > 0)
    return kept.select("prev", "next", "n_tokens", (F.col("_weight") / mass.over(context)).alias("p"))
