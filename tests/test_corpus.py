import pytest
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import arrays
from tokenmill.functions.tokenizers import (
    BpeTokenizer,
    ByteTokenizer,
    PieceTokenizer,
    document_tokens,
    ranks_from_merges,
)
from tokenmill.operators import corpus, sampling
from tokenmill.sources import readers

E = C.END_OF_TEXT


def _store(spark, docs, split="train"):
    rows, at = [], 0
    for i, tokens in enumerate(docs):
        rows.append((i, split, tokens, len(tokens), at))
        at += len(tokens)
    return spark.createDataFrame(
        rows, "doc_id bigint, split string, tokens array<int>, n_tokens bigint, tok_start bigint"
    )


def _blocks(blocks):
    return [(r.block_id, r.x, r.y) for r in blocks.orderBy("block_id").collect()]


def test_packing_crosses_documents(spark):
    store = _store(spark, [[1, 2, E], [3, E], [4, 5, 6, E]])
    assert _blocks(corpus.pack_blocks(store, 4)) == [
        (0, [1, 2, E, 3], [2, E, 3, E]),
        (1, [E, 4, 5, 6], [4, 5, 6, E]),
    ]


def test_packing_drops_a_block_without_its_last_target(spark):
    store = _store(spark, [[1, 2, 3, 4, 5, 6, 7, E]])
    assert _blocks(corpus.pack_blocks(store, 4)) == [(0, [1, 2, 3, 4], [2, 3, 4, 5])]
    assert corpus.block_count(8, 4) == 1 and corpus.block_count(9, 4) == 2 and corpus.block_count(0, 4) == 0


def test_packing_of_one_long_and_many_short_documents(spark):
    docs = [[i % 250] * (1 + i % 3) + [E] for i in range(200)]
    docs.insert(60, [j % 199 for j in range(5000)] + [E])
    stream = [t for d in docs for t in d]
    got = _blocks(corpus.pack_blocks(_store(spark, docs), 16))
    assert len(got) == (len(stream) - 1) // 16
    assert [t for _, x, _ in got for t in x] == stream[: 16 * len(got)]
    assert [t for _, _, y in got for t in y] == stream[1 : 16 * len(got) + 1]


def test_byte_tokens(spark):
    rows = spark.createDataFrame([("é",), ("",), ("a\x00ÿ",)], "text string")
    got = [r[0] for r in rows.select(document_tokens(ByteTokenizer(), F.col("text"))).collect()]
    assert got == [[195, 169, E], [E], [97, 0, 195, 191, E]]


def test_pieces_follow_the_published_pattern(spark):
    text = "I'll  go\n\n now: 12 times  x don't  "
    row = spark.createDataFrame([(text,)], "text string").select(PieceTokenizer().encode(F.col("text"))).first()
    assert row[0] == ["I", "'ll", " ", " go", "\n\n", " now", ":", " 12", " times", " ", " ", "x", " don", "'t", "  "]


def test_byte_pairs_and_markers_as_plain_text(spark):
    tokenizer = BpeTokenizer(ranks_from_merges([" t", "he", " the"]))
    rows = spark.createDataFrame([(1, "he the"), (2, "<|im_end|>"), (3, None), (4, "")], "i int, text string")
    got = {r[0]: r[1] for r in rows.select("i", tokenizer.encode(F.col("text"))).collect()}
    assert got == {1: [257, 258], 2: list(b"<|im_end|>"), 3: None, 4: []}
    back = rows.select("i", "text", tokenizer.decode(tokenizer.encode(F.col("text"))).alias("back"))
    assert back.where("not (text <=> back)").count() == 0


def test_long_texts_are_taken_in_stretches(spark):
    texts = ["é\r\nx\x85\u2028" * 300, "", "abc", None, "a" * 64, "a" * 65]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r[0]: r[1] for r in rows.select("i", ByteTokenizer(stretch=64).encode(F.col("text"))).collect()}
    assert got == {i: None if t is None else list(t.encode()) for i, t in enumerate(texts)}


def test_bytes_decode(spark):
    ids = spark.createDataFrame([([195, 169, 10],), ([],), ([97, 195],)], "t array<int>")
    got = [r[0] for r in ids.select(ByteTokenizer().decode(F.col("t"))).collect()]
    assert got == ["é\n", "", "a\ufffd"]


def test_wide_jobs_take_tokens_or_text_through_the_shuffle_alike(spark, tiny):
    docs = readers.documents(spark, tiny)
    plain = BpeTokenizer(ranks_from_merges([]))  # bytes, but not counted cheaply
    one = corpus.pack_blocks(corpus.token_store(docs, ByteTokenizer()), 128)
    two = corpus.pack_blocks(corpus.token_store(docs, plain, docs_per_segment=9), 128)
    assert one.exceptAll(two).count() == 0 and one.count() == two.count()


def test_blocks_are_the_token_stream(spark, tiny):
    docs = readers.documents(spark, tiny)
    stream = []
    for row in docs.where("doc_id < 199").orderBy("doc_id").collect():
        stream += [*row.text.encode(), E]
    store = corpus.token_store(docs, ByteTokenizer(), docs_per_segment=13)
    got = _blocks(corpus.pack_blocks(store, 64).where("split = 'train'"))
    assert [t for _, x, _ in got for t in x] == stream[: len(got) * 64]
    assert len(got) == corpus.block_count(len(stream), 64)


def test_split_is_the_tail_and_loses_nothing(spark, tiny):
    docs = readers.documents(spark, tiny)
    split = corpus.with_split(docs, 0.1).groupBy("split").agg(F.count("*"), F.min("doc_id"), F.max("doc_id"))
    assert sorted(tuple(r) for r in split.collect()) == [("train", 180, 0, 179), ("val", 20, 180, 199)]
    assert {r[0] for r in corpus.with_split(docs.limit(100), 0.005).select("split").distinct().collect()} == {"train"}


def test_split_is_a_filter_on_the_scan(spark, tiny):
    val = corpus.with_split(readers.documents(spark, tiny), 0.1).where("split = 'val'")
    plan = val._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_samples(spark, tiny):
    docs = readers.documents(spark, tiny)
    blend = {r.doc_id: r["rank"] for r in sampling.blend_sample(docs, 50, 25).collect()}
    assert len(blend) == 25 and max(blend) < 50 and sorted(blend.values()) == list(range(25))
    assert docs.where(sampling.blend_predicate(docs, 50, 25)).count() == 25
    val = {r.doc_id for r in corpus.with_split(docs).where("split = 'val'").collect()}
    assert not val & set(blend)
    assert sampling.ranked_sample(docs, "doc_id", 10_000, "x").count() == 200


@pytest.mark.parametrize("n", [0, 1, 5, 6, 9])
def test_last_and_head(spark, n):
    row = spark.range(1).select(arrays.last(F.array(*[F.lit(i) for i in range(6)]), n)).first()
    assert row[0] == list(range(6))[max(6 - n, 0) :]


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_blocks_do_not_depend_on_partitioning(spark, tiny, partitions):
    docs = readers.documents(spark, tiny)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        store = corpus.token_store(docs.repartition(partitions), ByteTokenizer(), docs_per_segment=200 // partitions)
        blocks = corpus.pack_blocks(store, 128)
        found = blocks.agg(F.count("*"), F.sum(F.xxhash64("split", "block_id", "x", "y").cast("decimal(38,0)"))).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    whole = corpus.pack_blocks(corpus.token_store(docs, ByteTokenizer()), 128)
    want = whole.agg(F.count("*"), F.sum(F.xxhash64("split", "block_id", "x", "y").cast("decimal(38,0)"))).first()
    assert tuple(found) == tuple(want)


def test_a_batch_of_long_texts_is_encoded_in_parts():
    import pyarrow as pa

    from tokenmill.functions.tokenizers import STRETCH, BpeTokenizer, ranks_from_merges

    tokenizer = BpeTokenizer(ranks_from_merges(["ab"]))
    texts = ["abc" * 200_000, None, "", "é" * 300_000, *["abc" * 100] * 3000, "x" * (STRETCH + 1), None]
    parts = list(tokenizer._encode.func(iter([pa.array(texts), pa.array([], pa.string())])))
    assert max(len(p.flatten()) for p in parts) <= STRETCH + 1 and len(parts) > 3
    got = [row for p in parts for row in p.to_pylist()]
    assert got[:3] == [[256, ord("c")] * 200_000, None, []] and got[3] == [0xC3, 0xA9] * 300_000
    assert got[4:] == [*[[256, ord("c")] * 100] * 3000, [ord("x")] * (STRETCH + 1), None]
    back = [t for p in tokenizer._decode.func(iter(parts)) for t in p.to_pylist()]
    assert back == texts
