"""Whole jobs, from input tables to written results. Sizes of samples are given by the caller (the
published ones are in ``constants``): none is drawn in silence."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.operators import corpus, instruct, picks, requests, scoring
from tokenmill.operators.sampling import Size
from tokenmill.operators.scoring import ScoreTable
from tokenmill.sources import readers, writers


def prepare_corpus(docs: DataFrame, tokenizer, path: str, fraction: float = C.CORPUS_VAL_FRACTION) -> DataFrame:
    """Write the token store; returns documents, tokens and bytes per split."""
    writers.write_token_store(corpus.token_store(docs, tokenizer, fraction), path)
    written = docs.sparkSession.read.parquet(path)
    return written.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n_tokens").alias("n_tokens"),
        (F.sum("n_tokens") * 2).alias("n_bytes"),
    )


def prepare_single_turn(
    rows: DataFrame,
    docs: DataFrame,
    tokenizer,
    path: str,
    head: Size,
    take: Size,
) -> DataFrame:
    """Write single-turn examples with a corpus blend; returns examples per split and source."""
    return _write_sft(instruct.single_turn_dataset(rows, docs, tokenizer, head, take), path)


def prepare_chat(
    turns: DataFrame,
    docs: DataFrame,
    tokenizer,
    path: str,
    cap: Size,
    head: Size,
    take: Size,
) -> DataFrame:
    """Write sampled multi-turn examples with a corpus blend; returns examples per split and source."""
    return _write_sft(instruct.chat_dataset(turns, docs, tokenizer, cap, head, take), path)


def _write_sft(dataset: DataFrame, path: str) -> DataFrame:
    writers.write_sft_json(dataset, path)
    written = readers.sft_examples(dataset.sparkSession, path)
    return written.groupBy("split", "source").agg(F.count_if(F.col("start") == 0).alias("n"))


def evaluate(
    scores: ScoreTable,
    tokenizer,
    run: int,
    step: int,
    logged_at: datetime,
    choices: dict[str, DataFrame] | None = None,
    labelled: dict[str, DataFrame] | None = None,
    last_words: dict[str, DataFrame] | None = None,
    clozes: dict[str, DataFrame] | None = None,
    block_size: int = C.BLOCK_SIZE,
    limit: int | None = None,
) -> DataFrame:
    """Accuracy of each task as rows of a metric log. Items come by task name, in the shape of
    their kind; ``limit`` is the number of valid items of each task to score, all without it."""

    def scored(asked: DataFrame) -> DataFrame:
        kept = [c for c in asked.columns if c not in ("context", "continuation")]
        return scoring.loglik_scores(requests.loglik_requests(asked, tokenizer, block_size), scores, kept)

    picked = {}
    for task, items in (choices or {}).items():
        picked[task] = picks.pick_choice(scored(requests.choice_requests(items, limit=limit)))
    for task, items in (labelled or {}).items():
        picked[task] = picks.pick_labelled(scored(requests.labelled_choice_requests(items, limit)))
    for task, items in (last_words or {}).items():
        picked[task] = picks.pick_last_word(requests.last_word_requests(items, limit), scores, tokenizer, block_size)
    for task, items in (clozes or {}).items():
        picked[task] = picks.pick_option(scored(requests.cloze_requests(items, limit)))

    rows = None
    for task, chosen in picked.items():
        row = picks.accuracy(chosen, task)
        rows = row if rows is None else rows.unionByName(row)
    if rows is None:
        raise ValueError("no task to evaluate")
    return rows.select(
        F.lit(run).cast("bigint").alias("run"),
        F.lit(step).cast("bigint").alias("step"),
        F.concat(F.lit("eval/"), "task", F.lit("_acc")).alias("metric"),
        F.col("acc").alias("value"),
        F.lit(logged_at.isoformat(sep=" ")).cast("timestamp_ntz").alias("logged_at"),
    )
