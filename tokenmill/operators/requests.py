"""Benchmark items to score requests: (item_id, choice_idx, context, continuation)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import arrays, text


def _first_valid(items: DataFrame, valid: Column, limit: int | None) -> DataFrame:
    """Items that can be asked; a limit counts these, by id."""
    kept = items.where(valid)
    return kept if limit is None else kept.orderBy("item_id").limit(limit)


def choice_requests(
    items: DataFrame, context: str = "ctx", endings: str = "endings", limit: int | None = None
) -> DataFrame:
    """One request per ending, in order; other columns ride along. Items without endings are skipped."""
    items = _first_valid(items, F.size(endings) > 0, limit)
    kept = [c for c in items.columns if c not in ("item_id", context, endings)]
    return items.select(
        "item_id", F.posexplode(endings).alias("choice_idx", "ending"), F.col(context).alias("context"), *kept
    ).select("item_id", "choice_idx", "context", F.concat(F.lit(" "), "ending").alias("continuation"), *kept)


def labelled_choice_requests(items: DataFrame, limit: int | None = None) -> DataFrame:
    """The same from ``question, choices{text, label}``; each request carries its label."""
    items = _first_valid(items, F.size("choices.text") > 0, limit)
    zipped = F.arrays_zip(F.col("choices.text").alias("text"), F.col("choices.label").alias("label"))
    kept = [c for c in items.columns if c not in ("item_id", "question", "choices")]
    return items.select(
        "item_id", F.posexplode(zipped).alias("choice_idx", "choice"), F.col("question").alias("context"), *kept
    ).select(
        "item_id",
        "choice_idx",
        "context",
        F.concat(F.lit(" "), "choice.text").alias("continuation"),
        F.col("choice.label").alias("choice_label"),
        *kept,
    )


def last_word_requests(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Text up to the last space, and the word behind it. Items without a space are skipped."""
    valid = _first_valid(items, F.instr("text", " ") > 0, limit)
    return valid.select(
        "item_id",
        F.lit(0).alias("choice_idx"),
        text.before_last_space(F.col("text")).alias("context"),
        F.concat(F.lit(" "), text.after_last_space(F.col("text"))).alias("continuation"),
    )


def cloze_requests(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Two requests per sentence with exactly one blank: each option and what follows it."""
    parts = F.split(F.col("sentence"), "_")
    valid = _first_valid(items, F.size(parts) == 2, limit)
    options = F.array("option1", "option2")
    return valid.select(
        "item_id", "answer", F.posexplode(options).alias("choice_idx", "option"), parts.alias("parts")
    ).select(
        "item_id",
        "choice_idx",
        F.col("parts")[0].alias("context"),
        F.concat(F.col("option"), F.col("parts")[1]).alias("continuation"),
        "answer",
    )


def loglik_requests(requests: DataFrame, tokenizer, block_size: int = C.BLOCK_SIZE) -> DataFrame:
    """Adds ``tokens`` and where the continuation starts.

    Of the context the last tokens are kept that leave ``block_size`` in all. The continuation is
    what gets scored, so it is never cut, not even where it alone is longer.
    """
    kept = [c for c in requests.columns if c not in ("context", "continuation")]
    coded = requests.select(
        *kept,
        tokenizer.encode(F.col("context")).alias("_context"),
        tokenizer.encode(F.col("continuation")).alias("_continuation"),
    )
    scored = F.size("_continuation")
    context = arrays.last(F.col("_context"), F.greatest(F.lit(block_size) - scored, F.lit(0)))
    tokens = coded.select(*kept, scored.alias("n_scored"), F.concat(context, "_continuation").alias("tokens"))
    return tokens.withColumn("cont_start", F.size("tokens") - F.col("n_scored"))


def last_word_context(tokens: Column, block_size: int = C.BLOCK_SIZE) -> Column:
    """The end of a context that leaves room for the one token asked for."""
    return arrays.last(tokens, block_size - 1)


def last_token(tokens: Column, end: Column) -> Column:
    """The token that predicts the next one; end-of-text in front of an empty context."""
    return F.coalesce(F.try_element_at(tokens, F.lit(-1)), end)
