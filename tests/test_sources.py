import base64
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tokenmill import session
from tokenmill.functions.tokenizers import ByteTokenizer
from tokenmill.operators import corpus, instruct, metrics
from tokenmill.plans import queries
from tokenmill.sources import files, readers, writers


@pytest.fixture
def docs(spark, tiny):
    return readers.documents(spark, tiny)


def test_sft_json_round_trip(spark, tiny, docs, tmp_path):
    data = instruct.chat_dataset(readers.turns(spark, tiny), docs, ByteTokenizer(), 1000, 100, 50)
    writers.write_sft_json(data, f"{tmp_path}/sft")
    back = readers.sft_examples(spark, f"{tmp_path}/sft")
    columns = ["split", "example_id", "source", "start", "tokens", "loss_mask"]
    assert back.select(columns).exceptAll(data.select(columns)).count() == 0 and back.count() == data.count()
    assert {d for d in os.listdir(f"{tmp_path}/sft") if d.startswith("split")} == {"split=train", "split=val"}


def test_malformed_json_fails(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"tokens": [1], "loss_mask": [1]}\n{"tokens": [1')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_rows(spark, str(tmp_path), "tokens array<int>, loss_mask array<int>").collect()


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_packed_records_round_trip(spark, docs, tmp_path, scheme):
    store = corpus.token_store(docs, ByteTokenizer())
    blocks = corpus.pack_blocks(store, 64).cache()
    parts = writers.export_blocks(store, f"{scheme}{tmp_path}/packed", 64, blocks_per_file=700)
    assert parts.agg(F.sum("records")).first()[0] == blocks.count()
    for read in (1000, 16 << 20):
        back = readers.packed_blocks(spark, f"{scheme}{tmp_path}/packed", read_bytes=read)
        assert back.exceptAll(blocks).count() == 0 and back.count() == blocks.count()


def _tokens(part):
    """A part's tokens; parts of single records share a file."""
    path, count = part.path.removeprefix("file://"), part.records * part.record_tokens
    return np.fromfile(path, "<u2", count, offset=2 * part.first_token)


def test_flat_export_is_the_token_stream(spark, docs, tmp_path):
    store = corpus.token_store(docs, ByteTokenizer())
    writers.export_blocks(store, f"{tmp_path}/flat", 64, blocks_per_file=1000, overlap=False)
    parts = spark.read.parquet(f"{tmp_path}/flat/manifest").where("split = 'train'").orderBy("first_block").collect()
    stream = np.concatenate([_tokens(p) for p in parts])
    rows = store.where("split = 'train'").orderBy("tok_start").select("tokens").collect()
    whole = np.concatenate([r.tokens for r in rows])
    assert np.array_equal(stream, whole)


def test_a_short_flat_stream_loses_nothing(spark, tmp_path):
    for n in (1, 8, 55, 64):
        rows = [("train", list(range(n)), n, 0)]
        store = spark.createDataFrame(rows, "split string, tokens array<int>, n_tokens bigint, tok_start bigint")
        parts = writers.export_blocks(store, f"{tmp_path}/f{n}", 8, blocks_per_file=3, overlap=False)
        read = [_tokens(p) for p in parts.orderBy("first_block").collect()]
        assert np.concatenate(read).tolist() == list(range(n))


def test_paths_name_the_same_store_for_spark_and_tasks(spark, tmp_path):
    from pyarrow import fs

    assert files.qualified(spark, str(tmp_path)) == f"file://{tmp_path}"
    assert files.filesystem(f"file://{tmp_path}/x")[1] == f"{tmp_path}/x"
    if hasattr(fs, "S3FileSystem"):
        store, inner = files.filesystem("s3a://bucket/corpus?region=eu-west-1")
        assert store.type_name == "s3" and inner == "bucket/corpus"


def test_sft_files_are_even_and_in_order(spark, tmp_path):
    from tokenmill.operators import sampling

    ids = spark.range(3000).select(F.col("id").cast("string").alias("example_id"))
    data = sampling.keyed(ids, "example_id", "sft").select(
        "*", F.lit("s").alias("source"), F.lit(0).cast("bigint").alias("start"), F.array(F.lit(1)).alias("tokens"),
        F.array(F.lit(1)).alias("loss_mask"), F.lit("train").alias("split"),
    )
    writers.write_sft_json(data, f"{tmp_path}/even", rows_per_file=100)
    names = sorted(f for f in os.listdir(f"{tmp_path}/even/split=train") if f.endswith(".json"))
    sizes = [sum(1 for _ in open(f"{tmp_path}/even/split=train/{f}")) for f in names]
    assert len(names) == 30 and min(sizes) > 50 and max(sizes) < 160
    want = [r.example_id for r in data.orderBy(*sampling.KEYS).collect()]
    import json

    got = [json.loads(line)["example_id"] for f in names for line in open(f"{tmp_path}/even/split=train/{f}")]
    assert got == want


def test_export_checks_the_range(spark, tmp_path):
    bad = spark.createDataFrame(
        [("train", [1, 70000, 2], 3, 0)], "split string, tokens array<int>, n_tokens bigint, tok_start bigint"
    )
    with pytest.raises(Exception, match="16 bits"):
        writers.export_blocks(bad, f"{tmp_path}/bad", 2)


def test_token_store_is_partitioned(spark, docs, tmp_path):
    writers.write_token_store(corpus.token_store(docs, ByteTokenizer()), f"{tmp_path}/store")
    back = spark.read.parquet(f"{tmp_path}/store")
    assert back.where("split = 'val'").count() == 1 and back.count() == 200
    assert files.is_complete(spark, f"{tmp_path}/store")


def test_built_once(spark, docs, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return corpus.tokenize_documents(docs, ByteTokenizer())

    first = writers.build_once(spark, f"{tmp_path}/cache", "f1", build)
    assert writers.build_once(spark, f"{tmp_path}/cache", "f1", build).count() == first.count() == 200
    assert len(calls) == 1
    os.remove(f"{tmp_path}/cache/f1/_SUCCESS")  # as a write that broke off leaves it
    writers.build_once(spark, f"{tmp_path}/cache", "f1", build)
    writers.build_once(spark, f"{tmp_path}/cache", "f2", build)
    assert len(calls) == 3


def test_fingerprint_follows_the_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("one")
    first = writers.input_fingerprint(spark, f"{tmp_path}/in")
    assert first == writers.input_fingerprint(spark, f"{tmp_path}/in")
    (tmp_path / "in" / "b.txt").write_text("two")
    assert first != writers.input_fingerprint(spark, f"{tmp_path}/in")


def test_checkpoint_listing_reads_names_only(spark, tmp_path):
    for name in ("ckpt_0005000.pt", "latest.pt", "ckpt_x.txt"):
        (tmp_path / name).write_bytes(b"weights")
    listed = readers.checkpoint_files(spark, str(tmp_path))
    assert [os.path.basename(r.path) for r in listed.collect()] == ["ckpt_0005000.pt"]


def test_log_file_and_results(spark, tmp_path):
    (tmp_path / "log").mkdir()
    lines = ["noise"] * 50 + ["  Lambada   35.30%"] + ["x"] * 50 + ["  Lambada   1.00%", "  Val Loss  1.3704"]
    (tmp_path / "log" / "eval.log").write_text("\n".join(lines))
    parsed = metrics.parse_log(readers.text_log(spark, f"{tmp_path}/log"))
    writers.write_results(metrics.results_json(parsed), f"{tmp_path}/out")
    row = readers.result_json(spark, f"{tmp_path}/out").first()
    assert (row.lambada, row.val_loss, row.hellaswag) == (35.3, 1.3704, None)


def test_logs_share_files_in_the_order_of_their_lines(spark, tmp_path):
    rows = [(log, n, f"line {n}\tof {log}") for log in range(300) for n in (3, 1, 2)]
    rows += [(-5, 1, None), (7, 4, "a\nb\r\nc\n"), (None, 1, "  Lambada   35.30%")]
    lines = spark.createDataFrame(rows, "log long, line_no long, line string").repartition(16)
    writers.write_logs(lines, f"{tmp_path}/logs")
    assert len([f for f in os.listdir(tmp_path / "logs") if f.startswith("part-")]) <= 16
    placed = F.sort_array(F.collect_list(F.struct("line_no", "line")))
    read = readers.named_logs(spark, f"{tmp_path}/logs").groupBy("log").agg(placed)
    found = {log: [r.line for r in part] for log, part in read.collect()}
    expected = {str(log): [f"line {n}\tof {log}" for n in (1, 2, 3)] for log in range(300)}
    expected["7"] += ["a", "b", "c", ""]
    assert found == expected | {"-5": [""], None: ["  Lambada   35.30%"]}


def test_log_roundtrip_writes_files_by_partition(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).selectExpr(
        "id event_id", "timestamp_ntz'2024-01-01 00:00:00' ts", "id % 2000 user_id", "'purchase' event_type", "id * 0.01D value"
    )
    rows.write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(queries, "fresh_path", lambda spark, name: f"{tmp_path}/{name}")
    found = queries.QUERIES["eval_log_roundtrip"](spark, str(tmp_path))
    assert sorted(found.collect(), key=str) == sorted(queries.QUERIES["parse_eval_log"](spark, str(tmp_path)).collect(), key=str)
    assert sum(len(names) for _, _, names in os.walk(tmp_path / "logs")) < 200


def test_metric_log_is_appended(spark, tmp_path):
    log = spark.sql("select 1L run, 2L step, 'm' metric, 3.0D value, timestamp_ntz'2024-01-01 00:00:00' logged_at")
    later = log.withColumn("value", F.lit(4.0)).withColumn("logged_at", F.expr("logged_at + interval 1 hour"))
    writers.append_metrics(log, f"{tmp_path}/m")
    writers.append_metrics(later, f"{tmp_path}/m")
    assert metrics.resolve_resumed(spark.read.parquet(f"{tmp_path}/m")).first().value == 4.0


def test_rank_file(spark, tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"the"]
    (tmp_path / "ranks").write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)))
    assert readers.rank_table(spark, f"{tmp_path}/ranks") == {t: i for i, t in enumerate(tokens)}


class _Session:
    """Only what ``shared_dir`` asks a session for."""

    def __init__(self, conf, master):
        self.sparkContext, self.conf, self.master, self.folder = self, self, master, None
        self.get = lambda name, default=None: conf.get(name, default)
        self.getConf = lambda: self
        self.getCheckpointDir = lambda: self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_comes_from_the_session():
    cluster = _Session({session.CHECKPOINT_CONF: "hdfs://x/shared"}, "yarn")
    assert session.shared_dir(cluster) == "hdfs://x/shared" == cluster.folder
    assert session.fresh_path(cluster, "a").startswith("hdfs://x/shared/a-")


def test_a_cluster_never_gets_a_local_folder():
    with pytest.raises(ValueError, match=session.CHECKPOINT_CONF):
        session.shared_dir(_Session({}, "spark://head:7077"))
    assert os.path.isdir(session.shared_dir(_Session({}, "local[2]")))


def test_task_functions_need_no_installed_package():
    load = "import sys, pickle; print(pickle.loads(sys.stdin.buffer.read())('/a/b')[1])"
    done = subprocess.run(
        [sys.executable, "-c", load], input=cloudpickle.dumps(files.filesystem), cwd="/", capture_output=True
    )
    assert done.stdout.strip() == b"/a/b", done.stderr
