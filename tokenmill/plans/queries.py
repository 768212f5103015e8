"""The registered queries: every operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill import schemas
from tokenmill.functions import arrays, formats, rows, text
from tokenmill.functions.tokenizers import BpeTokenizer, ByteTokenizer, PieceTokenizer, ranks_from_merges
from tokenmill.operators import callbacks, checkpoints, corpus, instruct, metrics, picks, requests, sampling, scoring, tensors
from tokenmill.operators.ordering import positions
from tokenmill.plans import bindings
from tokenmill.session import cut_lineage, fresh_path, spread
from tokenmill.sources import files, metric_log, readers, writers
from tokenmill.streaming import best as best_stream
from tokenmill.streaming import checkpoints as checkpoint_stream
from tokenmill.streaming import corpus as corpus_stream
from tokenmill.streaming import packing as packing_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
BYTES, PIECES = ByteTokenizer(), PieceTokenizer()


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# ---- corpus -------------------------------------------------------------------------


@query
def corpus_stats(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.corpus_stats(readers.documents(spark, folder), BYTES)


@query
def corpus_split(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.split_positions(readers.documents(spark, folder))


def _token_digests(docs: DataFrame, tokenizer) -> DataFrame:
    coded = corpus.tokenize_documents(docs, tokenizer)
    return coded.select("doc_id", "n_tokens", arrays.digest(F.col("tokens")).alias("tok_md5"))


@query
def tokenize_bytes(spark: SparkSession, folder: str) -> DataFrame:
    return _token_digests(readers.documents(spark, folder), BYTES)


@query
def tokenize_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(readers.documents(spark, folder), "doc_id")
    coded = docs.select("doc_id", PIECES.encode(F.col("text")).alias("p"))
    return coded.select(
        "doc_id", F.size("p").alias("n_pieces"), F.md5(F.array_join("p", "|")).alias("pieces_md5")
    )


@query
def tokenize_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = BpeTokenizer(ranks_from_merges(bindings.MERGES))
    return _token_digests(readers.documents(spark, folder), tokenizer)


def _store(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.token_store(readers.documents(spark, folder), BYTES)


@query
def token_store(spark: SparkSession, folder: str) -> DataFrame:
    return _store(spark, folder).select(
        "doc_id", "split", "n_tokens", "tok_start", arrays.digest(F.col("tokens")).alias("tok_md5")
    )


def _block_digests(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "split", "block_id", arrays.digest(F.col("x")).alias("x_md5"), arrays.digest(F.col("y")).alias("y_md5")
    )


@query
def pack_blocks(spark: SparkSession, folder: str) -> DataFrame:
    records = corpus.block_records(readers.documents(spark, folder), BYTES, bindings.BLOCK)
    return _block_digests(records.select("split", "block_id", *corpus.inputs_and_targets(F.col("record"))))


@query
def packed_export(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "packed")
    writers.export_corpus(readers.documents(spark, folder), BYTES, target, bindings.BLOCK)
    return _block_digests(readers.packed_blocks(spark, target))


# ---- instruction data ---------------------------------------------------------------


@query
def alpaca_format(spark: SparkSession, folder: str) -> DataFrame:
    return instruct.format_single_turn(instruct.single_turn(readers.turns(spark, folder)))


@query
def alpaca_tokens(spark: SparkSession, folder: str) -> DataFrame:
    examples = instruct.single_turn_examples(instruct.single_turn(readers.turns(spark, folder)), BYTES)
    return _example_digests(examples, "pair_id").drop("start")


def _example_digests(examples: DataFrame, id_column: str = "conv_id") -> DataFrame:
    return examples.select(
        id_column,
        "start",
        F.size("tokens").alias("n_tokens"),
        F.size(F.filter("loss_mask", lambda m: m == 1)).alias("n_trainable"),
        arrays.digest(F.col("tokens")).alias("tok_md5"),
        arrays.digest(F.col("loss_mask")).alias("mask_md5"),
    )


@query
def chatml_render(spark: SparkSession, folder: str) -> DataFrame:
    rendered = instruct.render_conversations(readers.turns(spark, folder))
    return rendered.select("conv_id", "start", "n_turns", F.md5("text").alias("text_md5"))


@query
def chatml_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return _example_digests(instruct.chat_examples(readers.turns(spark, folder), BYTES))


@query
def sft_skipped(spark: SparkSession, folder: str) -> DataFrame:
    return instruct.skipped(readers.turns(spark, folder))


@query
def chat_prompt(spark: SparkSession, folder: str) -> DataFrame:
    rows = instruct.single_turn(readers.turns(spark, folder))
    return rows.select("pair_id", text.chat_prompt(F.col("instruction"), F.col("input")).alias("prompt"))


@query
def trim_completion(spark: SparkSession, folder: str) -> DataFrame:
    half = F.expr("length(text) div 2").cast("int")
    first, second = F.substring(F.col("text"), F.lit(1), half), F.substring(F.col("text"), half + 1, F.length("text"))
    marked = F.concat(F.lit(" \n"), first, F.lit("\t <|im_end|>\n"), second)
    # a completion as a model gives it: tokens, an end, and what was drawn behind it
    drawn = F.concat(BYTES.encode(marked), F.array(BYTES.end_of_text()), BYTES.encode(second))
    completion = BYTES.decode(text.cut_at_end_of_text(drawn))
    return readers.turns(spark, folder).select("conv_id", "turn", text.trim_completion(completion).alias("text"))


@query
def instruction_sample(spark: SparkSession, folder: str) -> DataFrame:
    ids = readers.turns(spark, folder).select("conv_id").distinct()
    return sampling.ranked_sample(ids, "conv_id", bindings.share, "instruction")


@query
def blend_sample(spark: SparkSession, folder: str) -> DataFrame:
    return sampling.blend_sample(readers.documents(spark, folder), bindings.share, bindings.share)


def _chat_dataset(spark: SparkSession, folder: str) -> DataFrame:
    turns, docs = readers.turns(spark, folder), readers.documents(spark, folder)
    return instruct.chat_dataset(turns, docs, BYTES, bindings.share, bindings.share, bindings.share)


@query
def sft_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return instruct.dataset_summary(_chat_dataset(spark, folder))


@query
def sft_dataset_single_turn(spark: SparkSession, folder: str) -> DataFrame:
    turns, docs = readers.turns(spark, folder), readers.documents(spark, folder)
    rows = instruct.single_turn(turns)
    data = instruct.single_turn_dataset(rows, docs, BYTES, bindings.share, bindings.share)
    return instruct.dataset_summary(data)


@query
def sft_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "sft")
    writers.write_sft_json(_chat_dataset(spark, folder), target)
    back = readers.sft_examples(spark, target)
    return back.groupBy("split").agg(
        F.count_if(F.col("start") == 0).alias("n"),
        F.sum(F.size("tokens")).alias("n_tokens"),
        F.sum(F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, t: a + t)).alias("tokens_sum"),
        F.sum(F.aggregate("loss_mask", F.lit(0), lambda a, m: a + m)).alias("mask_sum"),
    )


def _tensors(spark: SparkSession, folder: str, align: str = "input", overflow: str = "windows") -> DataFrame:
    examples = instruct.chat_examples(readers.turns(spark, folder), BYTES)
    return tensors.sft_tensors(examples, bindings.SFT_BLOCK, align, overflow)


@query
def sft_tensors(spark: SparkSession, folder: str) -> DataFrame:
    return _tensors(spark, folder, overflow="truncate").select(
        "conv_id", *[arrays.digest(F.col(c)).alias(f"{c}_md5") for c in ("x", "y", "m")]
    )


@query
def sft_targets(spark: SparkSession, folder: str) -> DataFrame:
    aligned = [
        tensors.sft_targets(_tensors(spark, folder, align)).select(
            "conv_id", "start", F.lit(align).alias("align"), "n_targets", arrays.digest(F.col("y")).alias("y_md5")
        )
        for align in ("input", "target")
    ]
    return aligned[0].unionByName(aligned[1])


@query
def batch_plan(spark: SparkSession, folder: str) -> DataFrame:
    stats = corpus.corpus_stats(readers.documents(spark, folder), BYTES)
    tokens = stats.where(F.col("split") == "train").select("n_tokens").first()[0]
    ids = spark.range(corpus.block_count(tokens, bindings.BLOCK)).withColumnRenamed("id", "block_id")
    return tensors.batch_plan(ids, bindings.EPOCHS)


@query
def data_budget(spark: SparkSession, folder: str) -> DataFrame:
    return instruct.data_budget(_chat_dataset(spark, folder))


@query
def mapped_turns(spark: SparkSession, folder: str) -> DataFrame:
    """A row function over all turns: drops turns without a word, gives one row per sentence, replaces columns."""

    def sentences(row: dict):
        if not (row["text"] or "").strip(" "):
            return None
        parts = [p.strip(" ") for p in row["text"].split(".")]
        return [{"role": row["role"].upper(), "place": i, "sentence": p} for i, p in enumerate(parts) if p]

    return rows.map_rows(readers.turns(spark, folder), sentences, "role STRING, place INT, sentence STRING", ["text"])


# ---- evaluation ---------------------------------------------------------------------


def _choices(spark: SparkSession, folder: str) -> DataFrame:
    return requests.choice_requests(bindings.choice_items(spark, folder))


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return requests.labelled_choice_requests(bindings.labelled_items(spark, folder))


def _clozes(spark: SparkSession, folder: str) -> DataFrame:
    return requests.cloze_requests(bindings.cloze_items(spark, folder))


def _last_words(spark: SparkSession, folder: str) -> DataFrame:
    return requests.last_word_requests(readers.table(spark, folder, "benchmark", "item_id", "text"))


@query
def mc_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _choices(spark, folder)


@query
def labelled_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _labelled(spark, folder)


@query
def cloze_requests(spark: SparkSession, folder: str) -> DataFrame:
    return _clozes(spark, folder)


@query
def lastword_requests(spark: SparkSession, folder: str) -> DataFrame:
    asked = _last_words(spark, folder)
    # the context keeps room for one more token
    kept = requests.last_word_context(BYTES.encode(F.col("context")), bindings.REQUEST_BLOCK)
    return asked.select("item_id", "context", "continuation", arrays.digest(kept).alias("context_md5"))


@query
def loglik_requests(spark: SparkSession, folder: str) -> DataFrame:
    coded = requests.loglik_requests(_choices(spark, folder), BYTES, bindings.REQUEST_BLOCK)
    return coded.select(
        "item_id",
        "choice_idx",
        F.size("tokens").alias("n_tokens"),
        "cont_start",
        arrays.digest(F.col("tokens")).alias("tok_md5"),
    )


def _train_docs(spark: SparkSession, folder: str) -> DataFrame:
    return corpus.with_split(readers.documents(spark, folder)).where(F.col("split") == "train")


def _fit(spark: SparkSession, folder: str) -> scoring.ScoreTable:
    return scoring.fit_bigram(_train_docs(spark, folder), BYTES)


def _scored(asked: DataFrame, scores: scoring.ScoreTable) -> DataFrame:
    kept = [c for c in asked.columns if c not in ("context", "continuation")]
    return scoring.loglik_scores(requests.loglik_requests(asked, BYTES), scores, kept)


@query
def bigram_model(spark: SparkSession, folder: str) -> DataFrame:
    counts = scoring.bigram_counts(_train_docs(spark, folder), BYTES)
    return counts.select("prev", "next", "n", (F.col("logprob_micro") / scoring.MICRO).alias("logprob"))


@query
def loglik_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _scored(_choices(spark, folder), _fit(spark, folder)).select("item_id", "choice_idx", "score")


@query
def loglik_callback(spark: SparkSession, folder: str) -> DataFrame:
    """The scores of ``loglik_scores`` from a scorer function instead of a table."""
    scores = _fit(spark, folder)
    # at most one row per pair of byte tokens
    rows = scores.pairs.select("prev", "next", "logprob_micro").toArrow()
    floors = scores.floors.toArrow()
    known = {(p, n): micro for p, n, micro in zip(*(rows.column(i).to_pylist() for i in range(3)), strict=True)}
    least = dict(zip(floors.column("prev").to_pylist(), floors.column("floor_micro").to_pylist(), strict=True))
    table = spark.sparkContext.broadcast((known, least, scores.unseen_micro))
    end, micro = C.END_OF_TEXT, scoring.MICRO

    def make_scorer():
        pairs, floor, unseen = table.value

        def scorer(tokens, lengths, starts):
            totals = []
            for row, length, start in zip(tokens.tolist(), lengths.tolist(), starts.tolist(), strict=True):
                before = [end, *row][start:length]
                totals.append(sum(pairs.get(p, floor.get(p[0], unseen)) for p in zip(before, row[start:length], strict=True)))
            return np.array(totals) / micro

        return scorer

    asked = requests.loglik_requests(_choices(spark, folder), BYTES)
    return callbacks.callback_scores(asked, make_scorer, ["item_id", "choice_idx"])


@query
def mc_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scores = _fit(spark, folder)
    plain = picks.accuracy(picks.pick_choice(_scored(_choices(spark, folder), scores)), "choice")
    labelled = picks.accuracy(picks.pick_labelled(_scored(_labelled(spark, folder), scores)), "labelled")
    return plain.unionByName(labelled)


@query
def cloze_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return picks.accuracy(picks.pick_option(_scored(_clozes(spark, folder), _fit(spark, folder))), "cloze")


@query
def lastword_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return picks.accuracy(_guessed_words(spark, folder), "lastword")


def _guessed_words(spark: SparkSession, folder: str) -> DataFrame:
    # pieces: the first token of " word" is the word, not its space
    scores = scoring.fit_bigram(_train_docs(spark, folder), PIECES)
    return picks.pick_last_word(_last_words(spark, folder), scores, PIECES)


@query
def running_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    scores = _fit(spark, folder)
    picked = {
        "choice": picks.pick_choice(_scored(_choices(spark, folder), scores)),
        "cloze": picks.pick_option(_scored(_clozes(spark, folder), scores)),
        "lastword": _guessed_words(spark, folder),
    }
    each = [p.select(F.lit(task).alias("task"), "item_id", "hit") for task, p in picked.items()]
    hits = cut_lineage(each[0].unionByName(each[1]).unionByName(each[2]))
    return picks.running_accuracy(hits, bindings.RUNNING_EVERY)


@query
def masked_loss(spark: SparkSession, folder: str) -> DataFrame:
    examples = instruct.chat_examples(readers.turns(spark, folder), BYTES)
    return scoring.masked_loss_of_examples(examples, _fit(spark, folder), ["conv_id"])


@query
def val_loss(spark: SparkSession, folder: str) -> DataFrame:
    blocks = corpus.validation_blocks(readers.documents(spark, folder), BYTES, bindings.BLOCK)
    loss = scoring.val_loss(blocks, _fit(spark, folder))
    return loss.select("mean_of_means", "token_mean", F.round("perplexity", 6).alias("perplexity"))


@query
def sft_val_loss(spark: SparkSession, folder: str) -> DataFrame:
    val = _chat_dataset(spark, folder).where(F.col("split") == "val")
    targets = tensors.sft_targets(tensors.sft_tensors(val, bindings.SFT_BLOCK, overflow="windows"))
    placed = positions(cut_lineage(targets), [*sampling.KEYS, "start"], "block_id")
    loss = scoring.val_loss(placed, _fit(spark, folder))
    return loss.select("mean_of_means", "token_mean", F.round("perplexity", 6).alias("perplexity"))


@query
def nucleus_candidates(spark: SparkSession, folder: str) -> DataFrame:
    counts = scoring.bigram_counts(_train_docs(spark, folder), BYTES)
    return scoring.nucleus_candidates(counts, bindings.TOP_K, bindings.TOP_P)


# ---- metrics ------------------------------------------------------------------------


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.metric_log(bindings.events(spark, folder))


@query
def metric_resolved(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.resolve_resumed(bindings.resumed_log(bindings.events(spark, folder))).drop("logged_at")


@query
def metric_latest(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.metric_latest(_log(spark, folder))


@query
def metric_wide(spark: SparkSession, folder: str) -> DataFrame:
    wide = metrics.wide_metrics(metrics.metric_latest(_log(spark, folder)), list(bindings.METRICS.values()))
    return wide.toDF("run", *[name.replace("eval/", "") for name in bindings.METRICS.values()])


@query
def metric_report(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.metric_report(metrics.metric_latest(_log(spark, folder)))


@query
def best_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    log = bindings.resumed_log(bindings.events(spark, folder))
    return metrics.best_checkpoints(log, eval_every=bindings.EVAL_EVERY)


@query
def throughput(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.throughput(bindings.resumed_log(bindings.events(spark, folder)))


@query
def scaling_gap(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.scaling_gap(_log(spark, folder).where(F.col("metric") == "eval/val_loss"))


@query
def pending_checkpoints(spark: SparkSession, folder: str) -> DataFrame:
    events = bindings.events(spark, folder)
    return checkpoints.pending(bindings.checkpoint_files(events), bindings.done_list(events))


@query
def next_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    events = bindings.events(spark, folder)
    return checkpoints.next_pending(bindings.checkpoint_files(events), bindings.done_list(events))


def _report_lines(spark: SparkSession, folder: str) -> DataFrame:
    line = formats.report_line(F.col("metric"), F.col("value"))
    return _log(spark, folder).select(F.col("run").alias("log"), F.col("step").alias("line_no"), line.alias("line"))


@query
def parse_eval_log(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.parse_log(_report_lines(spark, folder))


@query
def eval_log_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Report lines to log files, these to result objects in files, and back to metrics."""
    logs, results = fresh_path(spark, "logs"), fresh_path(spark, "results")
    writers.write_logs(_report_lines(spark, folder), logs)
    named = readers.named_logs(spark, logs).withColumn("log", F.col("log").cast("bigint"))
    writers.write_results(metrics.results_json(metrics.parse_log(named), named=True), results)
    return metrics.long_results(readers.results_lines(spark, results), ["log"])


@query
def metric_append(spark: SparkSession, folder: str) -> DataFrame:
    """A log written in two appends, as before and after a resume, then resolved."""
    target, log = fresh_path(spark, "metrics"), bindings.resumed_log(bindings.events(spark, folder))
    halves = F.pmod(F.xxhash64("run", "step", "metric", "logged_at"), F.lit(2)) == 0
    for part in (halves, ~halves):
        writers.append_metrics(log.where(part), target)
    written = spark.read.schema(schemas.METRIC_LOG).parquet(target)
    return metrics.resolve_resumed(written).drop("logged_at")


@query
def metric_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The log in four appends, compacted after the second and the third, read as snapshot and tail."""
    target, log = fresh_path(spark, "metric-log"), bindings.resumed_log(bindings.events(spark, folder))
    part = F.pmod(F.xxhash64("run", "step", "metric", "logged_at"), F.lit(4))
    for k in range(4):
        metric_log.append(log.where(part == k), target)
        if k in (1, 2):
            metric_log.compact(spark, target)
    return metrics.resolve_resumed(metric_log.read(spark, target)).drop("logged_at")


@query
def version_compare(spark: SparkSession, folder: str) -> DataFrame:
    latest = metrics.metric_latest(_log(spark, folder)).select(
        F.expr("run div 2").alias("pair"), "metric", F.col("run") % 2 == 1, F.col("value")
    ).toDF("pair", "metric", "second", "value")
    latest = cut_lineage(latest)  # one row per run and metric: the log is read once
    return metrics.version_compare(latest.where(~F.col("second")), latest.where("second"), ["pair", "metric"])


# ---- streams ------------------------------------------------------------------------


@query
def stream_corpus_tokens(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "tokens")
    docs = corpus_stream.table_stream(spark, folder, "documents", schemas.DOCUMENTS)
    corpus_stream.tokenize_stream(docs, BYTES, target, target + "-state", spark.sparkContext.defaultParallelism)
    stored = spark.read.schema("doc_id BIGINT, tokens ARRAY<INT>, n_tokens INT").parquet(target)
    return stored.select("doc_id", "n_tokens", arrays.digest(F.col("tokens")).alias("tok_md5"))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_stream.table_stream(spark, folder, "events", schemas.EVENTS)


@query
def stream_checkpoint_pickup(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "picked")
    files = bindings.checkpoint_files(_event_stream(spark, folder))
    checkpoint_stream.pick_up(files, target, target + "-state")
    return spark.read.schema("path STRING, iter BIGINT").parquet(target).select("path", "iter")


def _checkpoint_folder(spark: SparkSession, folder: str) -> str:
    """One checkpoint file for each supplier, numbered by 500 steps, and one that is no numbered checkpoint."""
    target = fresh_path(spark, "checkpoints")
    numbers = readers.table(spark, folder, "supplier", "s_suppkey").select((F.col("s_suppkey") * 500).alias("iter"))
    names = numbers.select(F.format_string("ckpt_%07d.pt", F.col("iter").cast("bigint")).alias("name"))
    files.make_files(names.union(spark.createDataFrame([("latest.pt",)], "name STRING")), target, b"weights")
    return target


@query
def checkpoint_listing(spark: SparkSession, folder: str) -> DataFrame:
    found = readers.checkpoint_files(spark, _checkpoint_folder(spark, folder))
    name = F.element_at(F.split("path", "/"), -1)
    return found.select(name.alias("file"), checkpoints.iteration(F.col("path")).cast("bigint").alias("iter"))


@query
def stream_checkpoint_files(spark: SparkSession, folder: str) -> DataFrame:
    """Pickup of checkpoint files as they lie in a folder, some per batch."""
    source, target = _checkpoint_folder(spark, folder), fresh_path(spark, "picked")
    at_once = checkpoint_stream.batch_files(readers.table(spark, folder, "supplier").count(), least=400)
    stream = checkpoint_stream.checkpoint_stream(spark, source, files_per_batch=at_once)
    checkpoint_stream.pick_up(stream, target, target + "-state")
    picked = spark.read.schema("path STRING, iter BIGINT").parquet(target)
    return picked.select(F.element_at(F.split("path", "/"), -1).alias("file"), "iter")


@query
def stream_pack_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks of the whole corpus as one stream, by incremental packing."""
    target = fresh_path(spark, "stream-blocks")
    docs = corpus_stream.table_stream(spark, folder, "documents", schemas.DOCUMENTS)
    packing_stream.pack_stream(docs, BYTES, target, target + "-state", bindings.BLOCK)
    x, y = corpus.inputs_and_targets(F.col("record"))
    found = packing_stream.read_blocks(spark, target).select("block_id", x, y)
    return found.select("block_id", arrays.digest(F.col("x")).alias("x_md5"), arrays.digest(F.col("y")).alias("y_md5"))


@query
def stream_best_flags(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of ``best_checkpoints``, flagged as they arrive."""
    target = fresh_path(spark, "flags")
    log = bindings.resumed_log(_event_stream(spark, folder))
    best_stream.track_flags(log, target, target + "-state", eval_every=bindings.EVAL_EVERY)
    return best_stream.read_flags(spark, target)


@query
def stream_best_metric(spark: SparkSession, folder: str) -> DataFrame:
    target = fresh_path(spark, "best")
    best_stream.track_best(bindings.metric_log(_event_stream(spark, folder)), target, target + "-state")
    return best_stream.read_best(spark, target)
