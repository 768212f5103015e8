import glob
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenmill.functions.tokenizers import BpeTokenizer, ByteTokenizer, ranks_from_merges
from tokenmill.operators import corpus
from tokenmill.sources import packed, readers, writers


def _documents(spark, n, seed, longest=300):
    rng = random.Random(seed)
    rows = [(i * 3, "x" * rng.choice([0, 1, 5, rng.randrange(longest)])) for i in range(n)]
    rows[n // 2] = (rows[n // 2][0], "long" * 900)
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


def _plain(docs, block, extra, fraction=0.1):
    """Blocks by cutting each split's whole stream."""
    want = {}
    rows = corpus.with_split(docs, fraction).orderBy("doc_id").collect()
    for split in ("train", "val"):
        stream = [t for r in rows if r.split == split for t in [*r.text.encode(), 256]]
        whole = [stream[i : i + block + extra] for i in range(0, len(stream), block)]
        want.update({(split, i): b for i, b in enumerate(whole) if not extra or len(b) == block + extra})
    return {(s, i): tuple(256 if t == 256 else t for t in b) for (s, i), b in want.items()}


@pytest.mark.parametrize("per_segment", [3, 40, 10_000])
@pytest.mark.parametrize("block, extra", [(16, 1), (7, 0), (4000, 1), (1, 1)])
def test_records_are_the_stream_for_any_segments(spark, per_segment, block, extra):
    docs = _documents(spark, 260, 1)
    end = ByteTokenizer().end_of_text()
    eot = spark.range(1).select(end).first()[0]
    found = corpus.block_records(docs, ByteTokenizer(), block, extra, 0.1, per_segment).collect()
    want = {k: tuple(eot if t == 256 else t for t in b) for k, b in _plain(docs, block, extra).items()}
    assert {(r.split, r.block_id): tuple(r.record) for r in found} == want and len(found) == len(want)


def test_records_of_a_tokenizer_that_must_encode(spark, tiny):
    docs = readers.documents(spark, tiny)
    plain = BpeTokenizer(ranks_from_merges([]))
    one = corpus.block_records(docs, plain, 64, docs_per_segment=20)
    two = corpus.block_records(docs, ByteTokenizer(), 64)
    assert one.exceptAll(two).count() == 0 and one.count() == two.count() > 1000


def test_records_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert corpus.block_records(docs, ByteTokenizer(), 8).count() == 0


def test_the_second_shuffle_is_of_border_pieces(spark, tiny):
    """Texts pass one exchange, which both branches share; the other ones move segment sums and at most two pieces a segment."""
    docs = readers.documents(spark, tiny)
    records = corpus.block_records(docs, ByteTokenizer(), 64, docs_per_segment=20)
    records.collect()
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    placed = corpus._with_offsets(corpus.with_split(docs), ByteTokenizer(), 20, keep_segments=True)
    segments = placed.select("_group", "_segment").distinct().count()
    pieces = corpus.block_pieces(docs, ByteTokenizer(), 64, docs_per_segment=20)
    assert segments > 8 and pieces.count() <= 2 * segments


def test_the_source_round_trip_and_one_split(spark, tiny, tmp_path):
    docs = readers.documents(spark, tiny)
    records = corpus.block_records(docs, ByteTokenizer(), 64, fraction=0.1, docs_per_segment=20)
    listed = writers.export_corpus(docs, ByteTokenizer(), f"{tmp_path}/p", 64, fraction=0.1, docs_per_segment=20)
    assert listed.agg(F.sum("records")).first()[0] == records.count()
    for read_bytes in (500, 1 << 20):
        back = packed.read_records(spark, f"{tmp_path}/p", read_bytes=read_bytes)
        assert back.exceptAll(records).count() == 0 and back.count() == records.count()
    val = packed.read_records(spark, f"{tmp_path}/p", split="val")
    assert val.count() == records.where("split = 'val'").count() > 0
    assert val.where("split <> 'val'").count() == 0


def _rows(spark, blocks, split="train"):
    return spark.createDataFrame([(split, b, [b, b + 1]) for b in blocks], packed.RECORDS).coalesce(1).sortWithinPartitions("block_id")


def test_append_and_overwrite_leave_what_is_listed(spark, tmp_path):
    folder = f"{tmp_path}/p"
    packed.write_records(_rows(spark, range(5)), folder)
    packed.write_records(_rows(spark, [9, 11, 12]), folder, "append")
    blocks = [r.block_id for r in packed.read_records(spark, folder).orderBy("block_id").collect()]
    assert blocks == [0, 1, 2, 3, 4, 9, 11, 12]
    packed.write_records(_rows(spark, [7]), folder)
    assert [tuple(r) for r in packed.read_records(spark, folder).collect()] == [("train", 7, [7, 8])]
    assert len(glob.glob(f"{folder}/*.bin")) == 1 and len(os.listdir(f"{folder}/manifest")) == 1


def test_a_failed_write_changes_nothing(spark, tmp_path):
    folder = f"{tmp_path}/p"
    packed.write_records(_rows(spark, range(3)), folder)
    before = sorted(os.listdir(folder))
    bad = _rows(spark, range(100)).unionByName(_rows(spark, [70_000]))  # one task ends, the other fails
    with pytest.raises(Exception, match="16 bits"):
        packed.write_records(bad, folder)
    assert sorted(os.listdir(folder)) == before
    assert packed.read_records(spark, folder).count() == 3


def test_only_committed_attempts_stay(tmp_path):
    writer = packed.PackedWriter(f"file://{tmp_path}/p", overwrite=True)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["train"] * 3), pa.array([0, 1, 5]), pa.array([[1, 2], [2, 3], [9, 9]], pa.list_(pa.int32()))],
        names=["split", "block_id", "record"],
    )
    lost, kept = writer.write(iter([batch])), writer.write(iter([batch]))  # as a repeated task
    assert len(glob.glob(f"{tmp_path}/p/*.bin")) == 4 and lost.parts[0][1] != kept.parts[0][1]
    writer.commit([kept, None])
    left = {f"file://{f}" for f in glob.glob(f"{tmp_path}/p/*.bin")}
    assert left == {p[1] for p in kept.parts} and [p[2:] for p in kept.parts] == [(0, 2, 2, 0), (5, 1, 2, 0)]


def test_blocks_of_a_large_batch_are_cut_some_at_a_time():
    import numpy as np
    import pyarrow as pa

    from tokenmill.functions.tokenizers import STRETCH
    from tokenmill.operators.corpus import _cut_blocks

    n, each, size = 300, 12_345, 256
    tokens = (np.arange(n * each) % 50_000).astype(np.int32)
    last = (n * each - size - 1) // size
    columns = [pa.array(["train"] * n), pa.array([0] * n, pa.int32()), pa.array(np.arange(n) * each)]
    columns += [pa.array([0] * n, pa.int64()), pa.array([last] * n, pa.int64())]
    columns.append(pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * each), pa.array(tokens)))
    batch = pa.RecordBatch.from_arrays(columns, names=["split", "segment", "tok_start", "first", "last", "tokens"])
    made = list(_cut_blocks(size, 1, iter([batch])))
    assert max(len(b.column(2).flatten()) for b in made) <= 1.1 * STRETCH
    assert [i for b in made for i in b.column(1).to_pylist()] == list(range(last + 1))
    for block, record in enumerate(r for b in made for r in b.column(2).to_pylist()):
        assert record == tokens[block * size : block * size + size + 1].tolist()
