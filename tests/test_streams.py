import os
import shutil
import time
from datetime import datetime

import pytest
from pyspark.sql import Row

from tokenmill.functions.tokenizers import ByteTokenizer
from tokenmill.operators import corpus, metrics
from tokenmill.plans import bindings
from tokenmill.plans.queries import QUERIES
from tokenmill.sources import readers
from tokenmill.streaming import best, checkpoints
from tokenmill.streaming import corpus as corpus_stream


def test_documents_arrive_in_two_goes(spark, tiny, tmp_path):
    docs = readers.documents(spark, tiny)
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    for low, high in ((0, 120), (120, 200)):
        part = docs.where(f"doc_id >= {low} and doc_id < {high}").repartition(3)
        part.write.mode("append").parquet(source)
        stream = corpus_stream.document_stream(spark, source, files_per_batch=2)
        corpus_stream.tokenize_stream(stream, ByteTokenizer(), target, state)
    got = spark.read.parquet(target)
    want = corpus.tokenize_documents(docs, ByteTokenizer())
    assert got.count() == 200 and got.exceptAll(want).count() == 0


@pytest.mark.parametrize("files", [1, 3])
def test_a_streamed_table_may_be_a_file_or_a_folder(spark, tmp_path, files):
    rows = [(i, f"text number {i} " * 40) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    docs.repartition(files).write.parquet(f"{tmp_path}/parts")
    if files == 1:  # a table that is one file
        part = next(f for f in os.listdir(f"{tmp_path}/parts") if f.endswith(".parquet"))
        os.mkdir(f"{tmp_path}/in")
        shutil.copy(f"{tmp_path}/parts/{part}", f"{tmp_path}/in/documents.parquet")
    else:
        shutil.copytree(f"{tmp_path}/parts", f"{tmp_path}/in/documents.parquet")
    want = QUERIES["tokenize_bytes"](spark, f"{tmp_path}/in")
    got = QUERIES["stream_corpus_tokens"](spark, f"{tmp_path}/in")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 50
    blocks = QUERIES["stream_pack_blocks"](spark, f"{tmp_path}/in")
    assert blocks.count() == (sum(len(text) + 1 for _, text in rows) - 1) // bindings.BLOCK


def _touch(folder, *iterations):
    os.makedirs(folder, exist_ok=True)
    for i in iterations:
        with open(f"{folder}/ckpt_{i:07d}.pt", "wb") as f:
            f.write(b"w")
        time.sleep(0.05)


def test_checkpoints_are_handed_over_once_each(spark, tmp_path):
    folder, done, state = (f"{tmp_path}/{n}" for n in ("ckpt", "done", "state"))
    seen = []

    def evaluate(batch):
        seen.extend(r.iter for r in batch.collect())

    _touch(folder, 0, 5000, 7000, 10000)
    checkpoints.pick_up(checkpoints.checkpoint_stream(spark, folder), done, state, evaluate)
    assert sorted(seen) == [5000, 10000]
    _touch(folder, 15000)
    checkpoints.pick_up(checkpoints.checkpoint_stream(spark, folder), done, state, evaluate)
    assert sorted(seen) == [5000, 10000, 15000]
    assert sorted(r.iter for r in spark.read.parquet(done).collect()) == [5000, 10000, 15000]


def test_a_failed_evaluation_is_tried_again(spark, tmp_path):
    folder, done, state = (f"{tmp_path}/{n}" for n in ("ckpt", "done", "state"))
    seen = []

    def fail(batch):
        raise RuntimeError("evaluation broke")

    def evaluate(batch):
        seen.extend(r.iter for r in batch.collect())

    _touch(folder, 5000)
    with pytest.raises(Exception, match="evaluation broke"):
        checkpoints.pick_up(checkpoints.checkpoint_stream(spark, folder), done, state, fail)
    checkpoints.pick_up(checkpoints.checkpoint_stream(spark, folder), done, state, evaluate)
    checkpoints.pick_up(checkpoints.checkpoint_stream(spark, folder), done, state, evaluate)
    assert seen == [5000]


def test_the_batches_of_a_large_folder_are_few(spark, tmp_path):
    assert [checkpoints.batch_files(n, least=400) for n in (0, 1000, 6400)] == [400, 400, 400]
    assert -(-360_000 // checkpoints.batch_files(360_000, least=400)) <= 16
    folder, done, state = (f"{tmp_path}/{n}" for n in ("ckpt", "done", "state"))
    os.makedirs(folder)
    for i in range(70):
        with open(f"{folder}/ckpt_{i * 5000:07d}.pt", "wb") as f:
            f.write(b"w")
    before, sizes = spark.conf.get(checkpoints.LISTING), []
    stream = checkpoints.checkpoint_stream(spark, folder, checkpoints.batch_files(70, least=1))
    checkpoints.pick_up(stream, done, state, lambda batch: sizes.append(batch.count()))
    assert len(sizes) == 14 and sum(sizes) == 69 and spark.conf.get(checkpoints.LISTING) == before


def test_null_and_nan_are_never_best(spark):
    rows = [(1, 1, "m", 2.0), (1, 2, "m", None), (1, 3, "m", 1.0), (1, 4, "m", float("nan")), (2, 1, "m", None)]
    log = spark.createDataFrame(rows, "run bigint, step bigint, metric string, value double")
    assert [tuple(r) for r in best.best_so_far(log).collect()] == [(1, "m", 3, 1.0)]


def test_best_survives_a_restart_and_equals_batch(spark, tiny, tmp_path):
    log = bindings.metric_log(bindings.events(spark, tiny))
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    for part in ("step < 400", "step >= 400"):
        log.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).parquet(source)
        best.track_best(stream, target, state)
    got = best.read_best(spark, target)
    flagged = metrics.best_checkpoints(log).where("is_best").drop("is_best", "is_saved")
    want = best.best_so_far(flagged)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 50


def _flags(rows):
    return sorted(str((r.run, r.metric, r.step, r.value, r.is_best, r.is_saved)) for r in rows)


@pytest.mark.parametrize("parts", [1, 3])
def test_flags_of_a_stream_equal_the_batch(spark, tiny, tmp_path, parts):
    """Files in any order of steps, with resumed steps in later files, and a restart between files."""
    log = bindings.resumed_log(bindings.events(spark, tiny))
    odd = [(1, 3, "m", 2.0, 1), (1, 3, "m", None, 1), (1, 4, "m", float("nan"), 2), (1, 6, "m", 1.5, 3), (1, 2, "m", 0.5, 4)]
    odd += [(1, 2, "m", 9.0, 9), (1, 8, "m", 1.0, 5), (None, 2, None, 1.0, 6), (None, 4, None, 1.0, 7), (None, 0, None, 1.0, None)]
    extra = spark.createDataFrame(odd, "run bigint, step bigint, metric string, value double, t int")
    extra = extra.selectExpr("run", "step", "metric", "value", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,t) as logged_at")
    log = log.unionByName(extra)
    source, target, state = (f"{tmp_path}/{n}" for n in ("in", "out", "state"))
    rows = sorted(log.collect(), key=lambda r: hash((r.run, r.step, r.value)))
    for k in range(parts):
        spark.createDataFrame(rows[k::parts], log.schema).repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(source)
        best.track_flags(stream, target, state, eval_every=2)
    want = metrics.best_checkpoints(log, eval_every=2).collect()
    assert _flags(best.read_flags(spark, target).collect()) == _flags(want)


class _Value:
    held = None

    def get(self):
        return self.held

    def exists(self):
        return self.held is not None

    def update(self, value):
        self.held = value


class _Map(dict):
    calls = 0

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self[key] = value

    def containsKey(self, key):  # noqa: N802
        return key in self

    def getValue(self, key):  # noqa: N802
        return self[key]

    def iterator(self):
        return iter(list(self.items()))


def test_steps_that_arrive_together_are_one_entry_and_have_one_flag():
    flags = best.BestFlags(2, 500, 0)
    flags.top, flags.steps = _Value(), _Map()
    row = lambda step, value, second: Row(step=step, value=value, logged_at=datetime(2024, 1, 1, 0, 0, second))
    first = list(flags.handleInputRows((1, "m"), iter([row(i, 1000.0 - i, 1) for i in range(1, 800)]), None))
    assert [r.step for r in first if r.is_best] == list(range(2, 800, 2)) and flags.steps.calls == 1
    # an older value of step 4 changes nothing; a later one is below all others, and the step behind the last one sees it
    assert not list(flags.handleInputRows((1, "m"), iter([row(4, 1.0, 0)]), None))
    again = list(flags.handleInputRows((1, "m"), iter([row(4, 1.0, 2), row(800, 2.0, 2), row(0, None, 2)]), None))
    given = {r.step: (r.value, r.is_best) for r in again}
    assert len(given) == len(again) == 400 and given[4] == (1.0, True) and given[800] == (2.0, False) and given[0] == (None, False)
    assert all(not is_best for step, (_, is_best) in given.items() if step > 4) and flags.steps.calls == 3
