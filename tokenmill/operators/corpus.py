"""Corpus preparation: split by position, statistics, token store, training blocks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import arrays
from tokenmill.functions.tokenizers import STRETCH, document_length, document_tokens
from tokenmill.operators.ordering import SEGMENT, Running, kth_key, positions, precedes, running
from tokenmill.session import cut_lineage, spread

# documents one task tokenizes and holds in order; they carry their text
DOCS_PER_SEGMENT = 100_000


def validation_count(rows: int, fraction: float) -> int:
    return int(rows * fraction)


def first_validation_doc(docs: DataFrame, fraction: float = C.CORPUS_VAL_FRACTION) -> tuple | None:
    """Key of the first document of the validation part, which is the tail of the corpus."""
    return kth_key(docs, ["doc_id"], lambda rows: rows - validation_count(rows, fraction))


def with_split(docs: DataFrame, fraction: float = C.CORPUS_VAL_FRACTION) -> DataFrame:
    """Adds ``split``. One comparison per row: nothing is shuffled."""
    border = first_validation_doc(docs, fraction)
    return docs.withColumn("split", F.when(precedes([F.col("doc_id")], border), "train").otherwise("val"))


def split_positions(docs: DataFrame, fraction: float = C.CORPUS_VAL_FRACTION) -> DataFrame:
    """Global position and split of every document. Only ids are shuffled."""
    return with_split(positions(docs.select("doc_id"), ["doc_id"]), fraction)


def corpus_stats(docs: DataFrame, tokenizer, fraction: float = C.CORPUS_VAL_FRACTION) -> DataFrame:
    """Documents, tokens and bytes at two bytes per token, per split."""
    lengths = with_split(docs, fraction).select("split", document_length(tokenizer, F.col("text")).alias("n"))
    return lengths.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum("n").alias("n_tokens"),
        (F.sum("n") * 2).alias("n_bytes"),
    )


def tokenize_documents(docs: DataFrame, tokenizer) -> DataFrame:
    """(doc_id, tokens, n_tokens); row by row, so it serves batch and stream."""
    texts = spread(docs.select("doc_id", "text"), "doc_id")
    coded = texts.select("doc_id", document_tokens(tokenizer, F.col("text")).alias("tokens"))
    return coded.withColumn("n_tokens", F.size("tokens"))


def token_store(
    docs: DataFrame,
    tokenizer,
    fraction: float = C.CORPUS_VAL_FRACTION,
    docs_per_segment: int = DOCS_PER_SEGMENT,
) -> DataFrame:
    """(doc_id, split, tokens, n_tokens, tok_start): the two flat token streams, by document.

    One shuffle, by key range. It moves the text where lengths are known without encoding.
    Otherwise every document is encoded once, into a table in the shared folder, since both
    the offsets and the rows need the result.
    """
    split = with_split(docs.select("doc_id", "text"), fraction)
    return _with_offsets(split, tokenizer, docs_per_segment)


def _with_offsets(docs: DataFrame, tokenizer, docs_per_segment: int, keep_segments: bool = False) -> DataFrame:
    if tokenizer.counts_cheaply:
        sized = docs.withColumn("n_tokens", document_length(tokenizer, F.col("text")))
    else:
        sized = spread(docs, "doc_id").withColumn("tokens", document_tokens(tokenizer, F.col("text"))).drop("text")
        sized = cut_lineage(sized.withColumn("n_tokens", F.size("tokens").cast("bigint")))
    placed = running(
        sized,
        ["doc_id"],
        [Running("tok_start", "sum", F.col("n_tokens"))],
        group=["split"],
        rows_per_segment=docs_per_segment,
        min_segments=4 * docs.sparkSession.sparkContext.defaultParallelism,
        keep_segments=keep_segments,
    )
    if keep_segments:  # where the segment's tokens begin and end
        segment = Window.partitionBy("_group", SEGMENT)
        placed = placed.withColumn("low", F.min("tok_start").over(segment)).withColumn(
            "high", F.max(F.col("tok_start") + F.col("n_tokens")).over(segment)
        )
        return placed
    if tokenizer.counts_cheaply:
        placed = placed.withColumn("tokens", document_tokens(tokenizer, F.col("text")))
    return placed.select("doc_id", "split", "tokens", "n_tokens", "tok_start")


def block_count(tokens: int, block_size: int = C.BLOCK_SIZE) -> int:
    """Whole blocks in a stream: each needs one more token for its last target."""
    return max(tokens - 1, 0) // block_size


def pack_blocks(
    store: DataFrame, block_size: int = C.BLOCK_SIZE, blocks_per_file: int | None = None
) -> DataFrame:
    """(split, block_id, x, y): the stream of each split cut at multiples of ``block_size``.

    A document gives one slice per block it touches, never one row per token; a block has at
    most ``block_size + 1`` slices. The rest of the stream behind the last block is left out.
    With ``blocks_per_file`` there is a ``file`` column too, and the blocks of a file come in
    one task by the same shuffle.
    """
    keys = ["split", "block_id", *(["file"] if blocks_per_file else [])]
    # a block needs one token more, so the last token of the block before begins here too
    blocks = _gathered(store, block_size, 1, blocks_per_file).where(F.size("block") == block_size + 1)
    return blocks.select(*keys, *inputs_and_targets(F.col("block")))


def inputs_and_targets(record: Column) -> tuple[Column, Column]:
    """x and y of a block with the next token behind it."""
    return arrays.inputs(record).alias("x"), arrays.targets(record).alias("y")


def flat_records(store: DataFrame, block_size: int, blocks_per_file: int) -> DataFrame:
    """(split, file, block_id, record): the stream of each split, every token once, the last record short."""
    blocks = _gathered(store, block_size, 0, blocks_per_file)
    return blocks.select("split", "file", "block_id", F.col("block").alias("record"))


def block_records(
    docs: DataFrame,
    tokenizer,
    block_size: int = C.BLOCK_SIZE,
    extra: int = 1,
    fraction: float = C.CORPUS_VAL_FRACTION,
    docs_per_segment: int = DOCS_PER_SEGMENT,
) -> DataFrame:
    """(split, block_id, record): the blocks of ``pack_blocks`` over ``token_store``, with one shuffle of the texts.

    A task that holds a segment of documents in order cuts the blocks that lie inside it where it
    is. Only blocks across the border of two segments, one or a few a segment, are gathered by a second, small
    shuffle; their documents are encoded again, the other ones once. A record has ``extra`` tokens of the next block;
    without any, every token is in one record and the last record of a split may be short.
    """
    split = with_split(docs.select("doc_id", "text"), fraction)
    placed = _placed(split, tokenizer, block_size, extra, docs_per_segment)
    pieces = _border_pieces(placed, tokenizer, block_size, extra)
    joined = pieces.groupBy("split", "block_id").agg(_joined().alias("record"))
    if extra:
        joined = joined.where(F.size("record") == block_size + extra)
    return _inner_blocks(placed, tokenizer, block_size, extra).unionByName(joined.sortWithinPartitions("split", "block_id"))


def extend_blocks(
    docs: DataFrame, tokenizer, block_size: int, start: int, tail_start: int, tail: list[int], docs_per_segment: int = DOCS_PER_SEGMENT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents behind ``start`` tokens, of which ``tail`` (from ``tail_start`` on) is not in a whole block yet:
    (doc_id, n_tokens, tok_start), (block_id, record) of the whole blocks, and the same of blocks that lack tokens.

    Records have the next token, as in ``block_records``; the tail goes to its block as one more piece.
    """
    whole = docs.select("doc_id", "text", F.lit("all").alias("split"))
    placed = _placed(whole, tokenizer, block_size, 1, docs_per_segment, start)
    pieces = _border_pieces(placed, tokenizer, block_size, 1)
    if tail:
        kept = docs.sparkSession.createDataFrame(
            [("all", tail_start // block_size, tail_start, tail)], "split STRING, block_id BIGINT, at BIGINT, part ARRAY<INT>"
        )
        pieces = pieces.unionByName(kept)
    joined = cut_lineage(pieces.groupBy("block_id").agg(_joined().alias("record")))
    full = F.size("record") == block_size + 1
    inner = _inner_blocks(placed, tokenizer, block_size, 1).select("block_id", "record")
    return placed.select("doc_id", "n_tokens", "tok_start"), inner.unionByName(joined.where(full)), joined.where(~full)


def _inner_blocks(placed: DataFrame, tokenizer, block_size: int, extra: int) -> DataFrame:
    """(split, block_id, record) of the blocks inside a segment, cut in its task."""
    ordered = placed.where("n_tokens > 0 and first <= last").sortWithinPartitions("_group", SEGMENT, "doc_id")
    # a window leaves a segment in one task and in this order; the sort is none, and gaps are noticed
    inner = _encoded(ordered, tokenizer).select("split", SEGMENT, "tok_start", "first", "last", "tokens")
    return inner.mapInArrow(partial(_cut_blocks, block_size, extra), "split STRING, block_id BIGINT, record ARRAY<INT>")


def block_pieces(
    docs: DataFrame,
    tokenizer,
    block_size: int = C.BLOCK_SIZE,
    extra: int = 1,
    fraction: float = C.CORPUS_VAL_FRACTION,
    docs_per_segment: int = DOCS_PER_SEGMENT,
) -> DataFrame:
    """What ``block_records`` sends through its second shuffle: (split, block_id, at, part), a segment's share of a block in one row."""
    split = with_split(docs.select("doc_id", "text"), fraction)
    return _border_pieces(_placed(split, tokenizer, block_size, extra, docs_per_segment), tokenizer, block_size, extra)


def _placed(split: DataFrame, tokenizer, block_size: int, extra: int, docs_per_segment: int, start: int = 0) -> DataFrame:
    """Documents (doc_id, text, split) with their offsets from ``start`` on, and the first and last block that lie inside their segment."""
    placed = _with_offsets(split, tokenizer, docs_per_segment, keep_segments=True)
    if start:
        placed = placed.withColumns({c: F.col(c) + F.lit(start) for c in ("tok_start", "low", "high")})
    last = F.when(F.col("high") < block_size + extra, F.lit(-1)).otherwise(F.expr(f"(high - {block_size + extra}) div {block_size}"))
    return placed.withColumn("first", F.expr(f"(low + {block_size - 1}) div {block_size}")).withColumn("last", last)


def _encoded(rows: DataFrame, tokenizer) -> DataFrame:
    if tokenizer.counts_cheaply:
        rows = rows.withColumn("tokens", document_tokens(tokenizer, F.col("text")))
    return rows


def _border_pieces(placed: DataFrame, tokenizer, block_size: int, extra: int) -> DataFrame:
    begins, ends = F.col("tok_start"), F.col("tok_start") + F.col("n_tokens")
    inside = (F.col("first") <= F.col("last")) & (begins >= F.col("first") * block_size + extra) & (ends <= (F.col("last") + 1) * block_size)
    slices = _slices(_encoded(placed.where(~inside), tokenizer), block_size, extra).where("block_id < first or block_id > last")
    # still in the segment's task: the grouping keys hold those that the rows are dealt by
    joined = slices.groupBy("_group", SEGMENT, "split", "block_id").agg(F.min("at").alias("at"), _joined().alias("part"))
    return joined.select("split", "block_id", "at", "part")


def _cut_blocks(block_size: int, extra: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks ``first`` to ``last`` of each segment, from rows (split, segment, tok_start, first, last, tokens) in order."""
    width = block_size + extra
    segment, rest, at, last = None, np.zeros(0, np.int32), 0, -1
    for batch in batches:
        splits, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        starts, firsts, lasts = (batch.column(i).to_numpy() for i in (2, 3, 4))
        column = batch.column(5)
        tokens, offsets = column.flatten().to_numpy(), np.concatenate(([0], np.cumsum(column.value_lengths().to_numpy())))
        keys = list(zip(splits, numbers, strict=True))
        begin = 0
        while begin < len(keys):
            end = begin + 1
            # a batch is cut by rows: its tokens are copied some at a time
            while end < len(keys) and keys[end] == keys[begin] and offsets[end + 1] - offsets[begin] <= STRETCH:
                end += 1
            if keys[begin] != segment:
                if at <= last:
                    raise RuntimeError(f"segment {segment} is not in one task")
                segment, rest, at, last = keys[begin], np.zeros(0, np.int32), int(firsts[begin]), int(lasts[begin])
                expected = int(starts[begin])
                skip = at * block_size - expected  # tokens before the first block
            if (starts[begin:end] != expected + offsets[begin:end] - offsets[begin]).any():
                raise RuntimeError(f"documents of segment {segment} do not follow each other")
            expected += int(offsets[end] - offsets[begin])
            part = tokens[offsets[begin] : offsets[end]]
            if skip:
                part, skip = part[skip:], max(0, skip - len(part))
            rest = np.concatenate([rest, part])
            count = min((len(rest) - extra) // block_size, last - at + 1) if len(rest) >= width else 0
            if count > 0:
                rows = np.lib.stride_tricks.sliding_window_view(rest, width)[: (count - 1) * block_size + 1 : block_size]
                rest = rest[count * block_size :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([segment[0]] * count),
                        pa.array(np.arange(at, at + count)),
                        pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * width), pa.array(rows.ravel())),
                    ],
                    names=["split", "block_id", "record"],
                )
                at += count
            if at > last:
                rest = rest[:0]
            begin = end
    if at <= last:
        raise RuntimeError(f"segment {segment} is not in one task")


def _joined() -> Column:
    return F.flatten(F.sort_array(F.collect_list(F.struct("at", "part")))["part"])


def _gathered(store: DataFrame, block_size: int, extra: int, blocks_per_file: int | None) -> DataFrame:
    """(split, block_id[, file], block): tokens from each multiple of ``block_size``, ``extra`` beyond the next."""
    slices = _slices(store, block_size, extra)
    keys = ["split", "block_id"]
    if blocks_per_file:
        keys.append("file")
        slices = slices.withColumn("file", F.expr(f"block_id div {blocks_per_file}")).repartition("split", "file")
    return slices.groupBy(*keys).agg(_joined().alias("block"))


def _slices(store: DataFrame, block_size: int, extra: int) -> DataFrame:
    """``store`` with one row for each block that a document touches: ``block_id`` and its ``part`` from stream position ``at``."""
    size, start, n = F.lit(block_size), F.col("tok_start"), F.col("n_tokens")
    first = F.expr(f"greatest(tok_start - {extra}, 0) div {block_size}")
    final = F.expr(f"(tok_start + n_tokens - 1) div {block_size}")
    touched = store.where("n_tokens > 0").withColumn("block_id", F.explode(F.sequence(first, final)))
    origin = F.col("block_id") * size
    skip = F.greatest(origin - start, F.lit(0))
    take = F.least(origin + size + extra - start, n) - skip
    part = F.slice("tokens", (skip + 1).cast("int"), take.cast("int"))
    return touched.withColumn("at", F.greatest(start, origin)).withColumn("part", part).drop("tokens")


def validation_blocks(
    docs: DataFrame, tokenizer, block_size: int = C.BLOCK_SIZE, fraction: float = C.CORPUS_VAL_FRACTION
) -> DataFrame:
    """Blocks of the validation stream alone; the training documents are not read for it."""
    tail = with_split(docs.select("doc_id", "text"), fraction).where(F.col("split") == "val")
    return pack_blocks(_with_offsets(tail, tokenizer, DOCS_PER_SEGMENT), block_size)


