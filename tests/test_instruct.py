import pytest
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import text
from tokenmill.functions.tokenizers import BpeTokenizer, ByteTokenizer, ranks_from_merges
from tokenmill.operators import instruct, tensors
from tokenmill.sources import readers

E = C.END_OF_TEXT
TURNS = "conv_id bigint, turn bigint, role string, text string"


def test_single_turn_template(spark):
    rows = spark.createDataFrame(
        [(1, "Do", "  ", "x"), (2, "Do", " a ", "x"), (3, "Do", None, "x"), (4, "Do", " \x1f", "x")],
        "pair_id bigint, instruction string, input string, output string",
    )
    got = {r.pair_id: r.prompt for r in instruct.format_single_turn(rows).collect()}
    bare = "### Instruction:\nDo\n\n### Response:\n"
    assert got == {1: bare, 2: "### Instruction:\nDo\n\n### Input:\n a \n\n### Response:\n", 3: bare, 4: bare}


def test_single_turn_mask(spark):
    rows = spark.createDataFrame(
        [(1, "Do", "", "ok")], "pair_id bigint, instruction string, input string, output string"
    )
    row = instruct.single_turn_examples(rows, ByteTokenizer()).first()
    assert row.tokens[-3:] == [*b"ok", E]
    assert row.loss_mask == [0] * (len(row.tokens) - 3) + [1, 1, 1]


def test_every_question_with_its_answer(spark):
    turns = [
        (1, 0, "system", "S"), (1, 1, "user", "q1"), (1, 2, "gpt", "a1"), (1, 3, "human", "q2"), (1, 4, "system", "T"),
        (1, 5, "assistant", "a2"), (1, 6, "assistant", "again"), (2, 0, "assistant", "first"), (2, 1, "user", "open"), (3, 0, "tool", "x"),
    ]
    turns += [(9, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(40)]
    rows = spark.createDataFrame(turns, TURNS)
    want = {("1:1", "q1", "S", "a1"), ("1:3", "q2", "S", "a2")} | {(f"9:{i}", f"t{i}", "", f"t{i + 1}") for i in range(0, 40, 2)}
    for size in (1_000_000, 7):  # whole, and with conversations cut
        assert {tuple(r) for r in instruct.single_turn(rows, size).collect()} == want


def test_chat_prompt(spark):
    rows = spark.createDataFrame([("Sum up.", " a\n"), ("Hi ", " ")], "i string, x string")
    got = [r[0] for r in rows.select(text.chat_prompt(F.col("i"), F.col("x"))).collect()]
    head = "<|im_start|>system\nYou are a helpful assistant.<|im_end|>\n<|im_start|>user\n"
    tail = "<|im_end|>\n<|im_start|>assistant\n"
    assert got == [head + "Sum up.\n\n a" + tail, head + "Hi " + tail]


def test_completion_is_cut_and_stripped(spark):
    rows = spark.createDataFrame([(" a b <|im_end|>c<|im_end|>",), ("\n x \t",)], "t string")
    assert [r[0] for r in rows.select(text.trim_completion(F.col("t"))).collect()] == ["a b", "x"]
    ids = spark.createDataFrame([([5, E, 6, E],), ([7],), ([E],)], "t array<int>")
    assert [r[0] for r in ids.select(text.cut_at_end_of_text(F.col("t"))).collect()] == [[5], [7], []]


def _rendered(role, said):
    return list(f"<|im_start|>{role}\n{said}<|im_end|>\n".encode())


def test_nested_conversations(spark):
    rows = spark.createDataFrame(
        [
            (1, [("tool", "t"), ("human", "h")]),
            (2, []),
            (3, [("system", "s"), ("human", "h"), ("odd", "?"), ("gpt", None), ("human", "é")]),
        ],
        "conv_id bigint, conversations array<struct<`from`: string, value: string>>",
    )
    turns = instruct.turns_from_nested(rows)
    assert tuple(instruct.skipped(turns).first()) == (1, 2)
    got = instruct.chat_examples(turns, ByteTokenizer()).collect()
    assert len(got) == 1 and got[0].conv_id == 3 and got[0].start == 0
    asked = _rendered("system", "s") + _rendered("user", "h")
    answer, more = _rendered("assistant", ""), _rendered("user", "é")
    assert got[0].tokens == asked + answer + more + [E]
    assert got[0].loss_mask == [0] * len(asked) + [1] * len(answer) + [0] * len(more) + [1]


def test_skipped_counts(spark):
    rows = [(1, 0, "tool", "a"), (1, 1, "human", "b"), (2, 0, "gpt", "c"), (3, 0, None, "d")]
    assert tuple(instruct.skipped(spark.createDataFrame(rows, TURNS)).first()) == (1, 2)


@pytest.mark.parametrize("tokenizer", [ByteTokenizer(), BpeTokenizer(ranks_from_merges(["ti", "he"]))])
def test_a_runaway_conversation_is_kept_whole_in_parts(spark, tokenizer):
    turns = [(9, i, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(400)]
    turns += [(8, i, "user", "never answered") for i in range(300)]
    turns += [(i, t, r, "hi") for i in range(10, 60) for t, r in ((0, "user"), (1, "assistant"))]
    df = spark.createDataFrame(turns, TURNS).repartition(7)
    whole = {r.conv_id: r for r in instruct.chat_examples(df, tokenizer).collect()}
    parts = instruct.chat_examples(df, tokenizer, part_tokens=500, rows_per_segment=100)
    pieces = {}
    for r in parts.orderBy("conv_id", "start").collect():
        tokens, mask, rows = pieces.setdefault(r.conv_id, ([], [], []))
        assert r.start == len(tokens)
        tokens += r.tokens
        mask += r.loss_mask
        rows.append(len(r.tokens))
    assert set(whole) == set(pieces) == {9, *range(10, 60)}
    for conv_id, (tokens, mask, rows) in pieces.items():
        assert (tokens, mask) == (whole[conv_id].tokens, whole[conv_id].loss_mask)
        assert max(rows) < 600 and len(rows) == (1 if conv_id != 9 else len(rows))
    assert len(pieces[9][2]) > 4


def test_conversations_are_shuffled_once(spark, tiny):
    examples = instruct.chat_examples(readers.turns(spark, tiny), ByteTokenizer())
    plan = examples._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_split_sizes_and_blend(spark, tiny):
    turns, docs = readers.turns(spark, tiny), readers.documents(spark, tiny)
    data = instruct.chat_dataset(turns, docs, ByteTokenizer(), cap=1000, head=100, take=40)
    rows = instruct.dataset_summary(data).collect()
    n = len(rows)
    assert sum(r.source == "corpus" for r in rows) == 40
    assert sum(r.split == "val" for r in rows) == max(1, int(n * 0.02))
    assert all(r.n_tokens == r.n_trainable for r in rows if r.source == "corpus")
    again = instruct.chat_dataset(turns.repartition(11), docs.repartition(3), ByteTokenizer(), 1000, 100, 40)
    assert sorted(map(tuple, instruct.dataset_summary(again).collect())) == sorted(map(tuple, rows))


def _example(spark, tokens, mask):
    return spark.createDataFrame(
        [("a", 0, tokens, mask)], "example_id string, start bigint, tokens array<int>, loss_mask array<int>"
    )


def test_tensor_is_shifted_and_padded(spark):
    example = _example(spark, [10, 11, 20, 21, E], [0, 0, 1, 1, 1])
    row = tensors.sft_tensors(example, 6).first()
    assert row.x == [10, 11, 20, 21, 0, 0]
    assert row.y == [11, 20, 21, E, -100, -100]
    assert row.m == [0, 0, 1, 1, 0, 0]
    targets = {
        align: tensors.sft_targets(tensors.sft_tensors(example, 6, align)).first() for align in ("input", "target")
    }
    assert [t for t in targets["input"].y if t != -100] == [21, E] and targets["input"].n_targets == 2
    assert [t for t in targets["target"].y if t != -100] == [20, 21, E]


def test_tensor_is_truncated(spark):
    row = tensors.sft_tensors(_example(spark, [1, 2, 3, 4, 5, 6], [1] * 6), 3).first()
    assert (row.x, row.y, row.m) == ([1, 2, 3], [2, 3, 4], [1, 1, 1])


def test_batches_keep_a_short_last_one_and_cover_each_epoch(spark):
    blocks = spark.range(10).withColumnRenamed("id", "block_id")
    plan = tensors.batch_plan(blocks, epochs=3, batch_size=4, accumulation=2, rows_per_segment=3).collect()
    for epoch in range(3):
        rows = [r for r in plan if r.epoch == epoch]
        assert sorted(r.block_id for r in rows) == list(range(10))
        assert sorted(r.step * 2 + r.micro_step for r in rows) == sorted(3 * epoch + i // 4 for i in range(10))
    orders = [[r.block_id for r in sorted(plan, key=lambda r: (r.step, r.micro_step, r.slot)) if r.epoch == e] for e in range(3)]
    assert orders[0] != orders[1] != orders[2]


def test_budget(spark):
    rows = [("a", "x", "train", 0, [1, 2], [1, 1]), ("b", "x", "val", 0, [1], [1]), ("c", "x", "train", 0, [3], [1])]
    df = spark.createDataFrame(
        rows, "example_id string, source string, split string, start bigint, tokens array<int>, loss_mask array<int>"
    )
    assert tuple(instruct.data_budget(df).first()) == (2, 3, 262144, 256000.0)
