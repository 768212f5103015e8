"""Instruction data: single-turn and multi-turn examples with loss masks, blended and split.

An example is ``(example_id, start, tokens, loss_mask)``. Examples longer than
``part_tokens`` are kept whole as consecutive rows, each with the token offset it starts at;
all others are one row with ``start = 0``. So no row or task grows with a runaway
conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import arrays, text
from tokenmill.functions.tokenizers import document_tokens
from tokenmill.operators import sampling
from tokenmill.operators.corpus import first_validation_doc
from tokenmill.operators.ordering import ROWS_PER_SEGMENT, SEGMENT, Running, running, shuffled_before
from tokenmill.operators.sampling import Size

PART_TOKENS = 1 << 22


# ---- single-turn --------------------------------------------------------------------


def single_turn(turns: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> DataFrame:
    """(pair_id, instruction, input, output) from a turn table: every user turn that an assistant
    turn follows, with the conversation's first system text as input.

    System turns do not come between question and answer; a question without an answer behind
    it, or an answer without a question before it, gives no row. ``pair_id`` is the conversation
    and the question's turn.
    """
    said = known_turns(turns)
    system = said.where(F.col("role") == "system").groupBy("conv_id").agg(F.min_by("text", "turn").alias("input"))
    talk = running(
        said.where(F.col("role") != "system"),
        ["turn"],
        [Running("asked", "last", F.struct("role", "text", "turn"))],
        group=["conv_id"],
        few_groups=False,
        rows_per_segment=rows_per_segment,
    )
    pairs = talk.where((F.col("role") == "assistant") & (F.col("asked.role") == "user"))
    return pairs.join(system, "conv_id", "left").select(
        F.concat_ws(":", "conv_id", "asked.turn").alias("pair_id"),
        F.col("asked.text").alias("instruction"),
        F.coalesce("input", F.lit("")).alias("input"),
        F.col("text").alias("output"),
    )


def format_single_turn(rows: DataFrame, id_column: str = "pair_id") -> DataFrame:
    return rows.select(
        id_column,
        text.instruction_prompt(F.col("instruction"), F.col("input")).alias("prompt"),
        F.col("output").alias("response"),
    )


def single_turn_examples(rows: DataFrame, tokenizer, id_column: str = "pair_id") -> DataFrame:
    """Prompt and response are encoded apart; the response closes with end-of-text."""
    coded = format_single_turn(rows, id_column).select(
        id_column,
        tokenizer.encode(F.col("prompt")).alias("asked"),
        document_tokens(tokenizer, F.col("response")).alias("answered"),
    )
    return coded.select(
        id_column,
        F.lit(0).cast("bigint").alias("start"),
        F.concat("asked", "answered").alias("tokens"),
        F.concat(arrays.repeat(0, F.size("asked")), arrays.repeat(1, F.size("answered"))).alias("loss_mask"),
    )


# ---- multi-turn ---------------------------------------------------------------------


def turns_from_nested(rows: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Flat turn table from ``conversations array<struct<from, value>>``. A turn keeps its
    place, a missing role or text is empty. A conversation without turns gives one row without
    a role, so that it is counted as skipped."""
    flat = rows.select(id_column, F.posexplode_outer("conversations").alias("turn", "said"))
    return flat.select(
        F.col(id_column).alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("said.from"), F.lit("")).alias("role"),
        F.coalesce(F.col("said.value"), F.lit("")).alias("text"),
    )


def known_turns(turns: DataFrame) -> DataFrame:
    """Turns with a role of the format, under its rendered name."""
    named = turns.withColumn("role", text.normalize_role(F.col("role")))
    said = F.coalesce("text", F.lit("")).alias("text")
    return named.where(F.col("role").isNotNull()).select("conv_id", "turn", "role", said)


def render_conversations(
    turns: DataFrame, part_chars: int = PART_TOKENS, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """(conv_id, start, n_turns, text): turns in order, as marked-up text."""
    rendered = known_turns(turns).select(
        "conv_id", "turn", text.render_turn(F.col("role"), F.col("text")).alias("text")
    )
    sized = rendered.withColumn("n", F.length("text").cast("bigint"))
    parts = _in_parts(sized, part_chars, rows_per_segment, [F.col("text")])
    return parts.select(
        "conv_id",
        "start",
        F.size("items").alias("n_turns"),
        F.array_join(F.col("items.text"), "").alias("text"),
    )


def chat_examples(
    turns: DataFrame,
    tokenizer,
    part_tokens: int = PART_TOKENS,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """(conv_id, start, tokens, loss_mask) of conversations with an assistant turn.

    Header, text and footer are encoded apart, so no token crosses a border. The mask covers
    assistant turns whole, header included, and the closing end-of-text.
    """
    said = known_turns(turns).withColumn("trained", (F.col("role") == "assistant").cast("int"))
    segments = [text.turn_header(F.col("role")), F.col("text"), text.turn_footer()]
    if tokenizer.counts_cheaply:
        sized = said.withColumn("n", sum((tokenizer.count(s) for s in segments), F.lit(0)).cast("bigint"))
        payload = [F.col("role"), F.col("text")]
    else:
        coded = F.concat(*[tokenizer.encode(s) for s in segments])
        sized = said.withColumn("tokens", coded).withColumn("n", F.size("tokens").cast("bigint"))
        sized = sized.select("conv_id", "turn", "trained", "n", "tokens")
        payload = [F.col("tokens")]

    parts = _in_parts(sized, part_tokens, rows_per_segment, [*payload, F.col("trained"), F.col("n")], "trained")
    parts = parts.where(F.col("any_trained") > 0)

    def tokens_of(item: Column) -> Column:
        if not tokenizer.counts_cheaply:
            return item["tokens"]
        pieces = [text.turn_header(item["role"]), item["text"], text.turn_footer()]
        return F.concat(*[tokenizer.encode(piece) for piece in pieces])

    closing = F.when(F.col("is_last"), F.array(tokenizer.end_of_text()))
    closing_mask = F.when(F.col("is_last"), F.array(F.lit(1)))
    masks = F.transform("items", lambda i: F.array_repeat(i["trained"], i["n"].cast("int")))
    body = F.flatten(F.transform("items", tokens_of))
    return parts.select(
        "conv_id",
        "start",
        F.concat(body, F.coalesce(closing, F.slice(F.array(tokenizer.end_of_text()), 1, 0))).alias("tokens"),
        F.concat(F.flatten(masks), F.coalesce(closing_mask, F.slice(F.array(F.lit(1)), 1, 0))).alias("loss_mask"),
    )


def _in_parts(
    sized: DataFrame, part_size: int, rows_per_segment: int, payload: list[Column], flag: str | None = None
) -> DataFrame:
    """Turns of a conversation gathered in order: (conv_id, start, items, is_last, any_<flag>).

    A row holds turns whose offsets fall in one stretch of ``part_size``. The grouping keys
    contain the keys the offsets were computed by, so the rows are shuffled once.
    """
    measures = [Running("start", "sum", F.col("n")), Running("_whole", "total", F.col("n"))]
    if flag:
        measures.append(Running(f"any_{flag}", "total", F.col(flag)))
    placed = running(
        sized,
        ["turn"],
        measures,
        group=["conv_id"],
        few_groups=False,
        rows_per_segment=rows_per_segment,
        keep_segments=True,
    )
    flags = [F.first(f"any_{flag}").alias(f"any_{flag}")] if flag else []
    gathered = placed.groupBy("_group", SEGMENT, F.expr(f"start div {part_size}").alias("_part")).agg(
        F.min("start").alias("start"),
        F.max(F.col("start") + F.col("n") == F.col("_whole")).alias("is_last"),
        *flags,
        F.sort_array(F.collect_list(F.struct("turn", *payload))).alias("items"),
    )
    kept = [f"any_{flag}"] if flag else []
    return gathered.select(F.col("_group.conv_id").alias("conv_id"), "start", "items", "is_last", *kept)


def skipped(turns: DataFrame) -> DataFrame:
    """One row: conversations kept, and conversations without anything to train on."""
    answers = (text.normalize_role(F.col("role")) == "assistant").cast("int")
    per_conversation = turns.groupBy("conv_id").agg(F.max(F.coalesce(answers, F.lit(0))).alias("kept"))
    return per_conversation.agg(
        F.count_if(F.col("kept") == 1).alias("n_kept"), F.count_if(F.col("kept") == 0).alias("n_skipped")
    )


# ---- blend, shuffle, split ----------------------------------------------------------


def sft_dataset(
    examples: DataFrame,
    example_ids: DataFrame,
    docs: DataFrame,
    tokenizer,
    head: Size,
    take: Size,
    source: str,
    stage: str = "sft",
    fraction: float = C.SFT_VAL_FRACTION,
) -> DataFrame:
    """Instruction examples and a corpus blend, shuffled by key, the first part for validation.

    ``example_ids`` lists the ids of ``examples``; the border is found on ids alone and every
    row then knows its split. Blend rows train on every token; their documents must end before
    the corpus's validation part.
    """
    blended = sampling.blend_predicate(docs, head, take, before=first_validation_doc(docs))
    blend_ids = docs.where(blended).select(_example_id("corpus", "doc_id"))
    ids = example_ids.select(_example_id(source, example_ids.columns[0])).unionByName(blend_ids)
    border = sampling.border(
        sampling.written_keys(ids, "example_id", stage), lambda rows: max(1, int(rows * fraction))
    )

    corpus = docs.where(blended).select(
        _example_id("corpus", "doc_id"),
        F.lit("corpus").alias("source"),
        F.lit(0).cast("bigint").alias("start"),
        document_tokens(tokenizer, F.col("text")).alias("tokens"),
    )
    corpus = corpus.withColumn("loss_mask", arrays.repeat(1, F.size("tokens")))
    instruction = examples.select(
        _example_id(source, examples.columns[0]), F.lit(source).alias("source"), "start", "tokens", "loss_mask"
    )
    both = sampling.keyed(instruction.unionByName(corpus), "example_id", stage)
    is_val = shuffled_before(stage, F.col("example_id"), border)
    return both.withColumn("split", F.when(is_val, "val").otherwise("train"))


def _example_id(source: str, column: str) -> Column:
    return F.concat(F.lit(f"{source}:"), F.col(column).cast("string")).alias("example_id")


def answered_ids(turns: DataFrame) -> DataFrame:
    """Ids of conversations that give an example; only ids and roles are read."""
    answers = text.normalize_role(F.col("role")) == "assistant"
    return turns.where(answers).select("conv_id").distinct()


def chat_dataset(
    turns: DataFrame, docs: DataFrame, tokenizer, cap: Size, head: Size, take: Size, **options
) -> DataFrame:
    """Multi-turn variant: sample conversations first, then tokenize, drop, blend and split."""
    ids = turns.select("conv_id").distinct()
    sampled = turns.where(sampling.in_sample(ids, "conv_id", cap, "instruction"))
    return sft_dataset(
        chat_examples(sampled, tokenizer, **options), answered_ids(sampled), docs, tokenizer, head, take, "chat"
    )


def single_turn_dataset(
    rows: DataFrame, docs: DataFrame, tokenizer, head: Size, take: Size, id_column: str = "pair_id"
) -> DataFrame:
    """Single-turn variant over (id, instruction, input, output): every row, no cap."""
    examples = single_turn_examples(rows, tokenizer, id_column)
    return sft_dataset(examples, rows.select(id_column), docs, tokenizer, head, take, "single")


def dataset_summary(dataset: DataFrame) -> DataFrame:
    """Per example: source, split, tokens and trainable tokens."""
    return dataset.groupBy("example_id", "source", "split").agg(
        F.sum(F.size("tokens")).alias("n_tokens"),
        F.sum(F.aggregate("loss_mask", F.lit(0), lambda a, m: a + m)).alias("n_trainable"),
    )


def data_budget(
    dataset: DataFrame,
    steps: int = C.SFT_STEPS,
    batch_size: int = C.BATCH_SIZE,
    accumulation: int = C.ACCUMULATION_STEPS,
    block_size: int = C.BLOCK_SIZE,
) -> DataFrame:
    """One row: examples and tokens of the training split, tokens per step, epochs in ``steps``."""
    train = dataset.where(F.col("split") == "train")
    per_step = batch_size * accumulation
    return train.agg(
        F.count_if(F.col("start") == 0).alias("rows"), F.sum(F.size("tokens")).alias("tokens")
    ).select(
        "rows",
        "tokens",
        F.lit(per_step * block_size).cast("bigint").alias("tokens_per_step"),
        F.round(F.lit(float(steps * per_step)) / F.col("rows"), 6).alias("epochs"),
    )
