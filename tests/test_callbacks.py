import os
import threading
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenmill.functions.rows import map_rows
from tokenmill.functions.tokenizers import ByteTokenizer
from tokenmill.operators import callbacks, corpus, scoring
from tokenmill.sources import files, readers, writers
from tokenmill.streaming import corpus as corpus_stream
from tokenmill.streaming import packing


def test_rows_are_mapped_dropped_and_multiplied(spark):
    df = spark.createDataFrame([(1, "a b", [1]), (2, None, None), (3, "", [2]), (4, "c", [])], "id int, text string, keep array<int>")

    def words(row):
        return None if row["text"] is None else ({"word": w, "id": row["id"] * 10} for w in row["text"].split())

    got = map_rows(df, words, "id BIGINT, word STRING, other DOUBLE", ["text"])
    assert got.dtypes == [("keep", "array<int>"), ("id", "bigint"), ("word", "string"), ("other", "double")]
    assert sorted(map(tuple, got.collect()), key=str) == [([1], 10, "a", None), ([1], 10, "b", None), ([], 40, "c", None)]
    one = map_rows(df, lambda row: {"n": len(row["text"] or "")}, "n INT", ["text", "keep"])
    assert sorted(map(tuple, one.collect())) == [(1, 3), (2, 0), (3, 0), (4, 1)]
    assert map_rows(df.where("false"), words, "word STRING").count() == 0


def test_wrong_columns_of_a_row_function_fail(spark):
    df = spark.range(3)
    with pytest.raises(ValueError, match="no columns"):
        map_rows(df, dict, "x INT", ["gone"])
    with pytest.raises(Exception, match="not in the schema"):
        map_rows(df, lambda row: {"y": 1}, "x INT").collect()


def test_a_scorer_is_set_up_once_a_task_and_gets_bounded_batches(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(0, 99, n := int(rng.choice([0, 1, 3, 40, 41, 700]))).tolist(), int(rng.integers(0, n + 1))) for i in range(500)]
    coded = spark.createDataFrame(rows, "id bigint, tokens array<int>, cont_start int")
    folder = str(tmp_path)

    def make_scorer():
        with open(f"{folder}/{time.time_ns()}-{os.getpid()}", "w"):
            pass

        def scorer(tokens, lengths, starts):
            assert tokens.size <= 2000 or len(tokens) == 1
            assert lengths.max() < 2 * lengths.min() or lengths.max() == 1
            at = np.arange(tokens.shape[1])
            inside = (at >= starts[:, None]) & (at < lengths[:, None])
            assert (tokens[at >= lengths[:, None]] == 0).all()
            return (tokens * inside).sum(axis=1).astype(float)

        return scorer

    found = callbacks.callback_scores(coded, make_scorer, ["id"], tokens_per_task=20_000, batch_tokens=2000)
    assert {r.id: r.score for r in found.collect()} == {i: float(sum(t[s:])) for i, t, s in rows}
    assert 5 <= len(os.listdir(folder)) <= 40
    assert callbacks.callback_scores(coded.where("false"), make_scorer, ["id"]).count() == 0


def test_a_heavy_first_token_does_not_fill_one_task(spark):
    """Half of all pairs have one ``prev``; nothing is small enough to be broadcast whole."""
    pairs = spark.range(40_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise((F.col("id") % 500 + 100).cast("int")).cast("int").alias("prev"),
        (F.col("id") % 977).cast("int").alias("next"),
        F.lit(1).cast("bigint").alias("n_pairs"),
    ).unionByName(spark.sql("select cast(null as int) prev, cast(null as int) next, 1L n_pairs"))
    known = pairs.groupBy("prev", "next").agg(F.lit(-5).cast("bigint").alias("logprob_micro")).where("next % 3 = 0 and prev is not null")
    floors = pairs.where("prev is not null").groupBy("prev").agg(F.lit(-9).cast("bigint").alias("floor_micro")).where("prev < 550")
    options = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    try:
        found = scoring.score_pairs(pairs, scoring.ScoreTable(known, floors, -11, False))
        got = found.select("prev", "next", "logprob_micro").collect()
        sizes = [r["count"] for r in scoring.with_floors(pairs.select("prev", "next"), floors).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = lambda p, n: -11 if p is None else -5 if n % 3 == 0 else -9 if p < 550 else -11
    assert len(got) == 40_001 and all(r.logprob_micro == want(r.prev, r.next) for r in got)
    assert max(sizes) <= 2 * float(np.median(sizes))


@pytest.mark.parametrize("cuts", [[200], [120, 200], [1, 2, 70, 71, 200]])
def test_blocks_of_arrivals_are_those_of_one_run(spark, tiny, tmp_path, cuts):
    docs = readers.documents(spark, tiny)
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    low = 0
    for high in cuts:
        docs.where(f"doc_id >= {low} and doc_id < {high}").coalesce(1).write.mode("append").parquet(source)
        packing.pack_stream(corpus_stream.document_stream(spark, source), ByteTokenizer(), target, state, 64, docs_per_segment=30)
        low = high
    want = corpus.block_records(docs, ByteTokenizer(), 64, fraction=0.0).select("block_id", "record")
    got = packing.read_blocks(spark, target).select("block_id", "record")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    offsets = packing.read_offsets(spark, target).select("doc_id", "tok_start")
    store = corpus.token_store(docs, ByteTokenizer(), 0.0).select("doc_id", "tok_start")
    assert offsets.exceptAll(store).count() == 0 and offsets.count() == 200


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    parts = [spark.createDataFrame([(3 * k + i, f"text {k} " * (i + k)) for i in range(3)], "doc_id bigint, text string") for k in range(3)]
    empty = parts[0].where("false")
    for number, part in ((0, parts[0]), (1, empty), (2, parts[1]), (2, parts[1]), (3, parts[2]), (2, parts[1])):
        packing.pack_batch(part, number, ByteTokenizer(), f"{tmp_path}/p", 16)
    whole = parts[0].union(parts[1]).union(parts[2])
    want = corpus.block_records(whole, ByteTokenizer(), 16, fraction=0.0).select("block_id", "record")
    got = packing.read_blocks(spark, f"{tmp_path}/p").select("block_id", "record")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_two_builders_build_once(spark, tmp_path):
    calls, results = [], []

    def build():
        calls.append(1)
        time.sleep(2)
        return spark.range(5)

    def run():
        results.append(writers.build_once(spark, f"{tmp_path}/c", "f", build, poll=0.2).count())

    threads = [threading.Thread(target=run) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert results == [5, 5, 5] and len(calls) == 1
    assert sorted(n for n in os.listdir(f"{tmp_path}/c") if not n.startswith(".")) == ["f"]


def test_a_broken_claim_is_taken_over_and_a_live_one_is_not(spark, tmp_path):
    os.makedirs(f"{tmp_path}/c")
    claim = f"{tmp_path}/c/f.claim"
    open(claim, "w").close()
    os.utime(claim, (time.time() - 100, time.time() - 100))
    with files.claimed(spark, claim, stale=1000) as mine:
        assert not mine
    assert writers.build_once(spark, f"{tmp_path}/c", "f", lambda: spark.range(2), stale=50, poll=0.1).count() == 2
    with files.claimed(spark, claim, stale=1) as mine:
        time.sleep(2.5)  # longer than a claim that is not refreshed
        with files.claimed(spark, claim, stale=1) as other:
            assert mine and not other
    assert not os.path.exists(claim)


def test_a_failed_build_leaves_the_name_free(spark, tmp_path):
    def fail():
        raise RuntimeError("broke")

    with pytest.raises(RuntimeError):
        writers.build_once(spark, f"{tmp_path}/c", "f", fail)
    assert writers.build_once(spark, f"{tmp_path}/c", "f", lambda: spark.range(3)).count() == 3
