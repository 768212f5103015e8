import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tokenmill.llm.fertility import token_quality
from tokenmill.session import cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def prose(n, salt):
    return " ".join(f"{salt}{i * 7919 % 1009} walks near" for i in range(n))


@pytest.fixture
def docs(spark, documents):
    rows = [
        (900_001, prose(60, "oak"), "en", "s", 1), (900_002, prose(60, "oak"), "en", "s", 1),
        (900_003, prose(60, "oak").replace("oak0 ", "elm "), "en", "s", 1), (900_004, "short", "en", "s", 1),
        (900_005, prose(40, "fir") + " password=abcdef12345 then " + prose(9, "ash"), "en", None, 1),
        (None, None, None, None, None), (900_001, prose(60, "oak"), "en", "s", 1),
    ]
    return documents.unionByName(spark.createDataFrame(rows, documents.schema))


def test_quality_keeps_what_the_operator_keeps(spark, tiny, docs):
    kept = corpus_pipeline.quality(spark, docs, tiny)
    assert kept.columns == COLUMNS
    judged = token_quality(docs).where("kept").select("doc_id")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.collect())


def test_one_of_each_group_stays(spark, tiny, docs):
    kept = corpus_pipeline.near_copies(spark, docs, tiny)
    assert kept.columns == COLUMNS
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(900_001) == 1 and 900_002 not in ids and 900_003 not in ids and 900_004 in ids and 900_005 in ids


def test_contaminated_documents_go(spark, tiny, docs):
    from test_tables import brute_overlap

    kept = corpus_pipeline.decontaminate(spark, docs, tiny)
    assert kept.columns == COLUMNS
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in docs.collect() if brute_overlap(r.text, items)[1] == 0]
    assert sorted(map(str, clean)) == sorted(str(r.doc_id) for r in kept.collect())


def test_secrets_are_masked(spark, tiny, docs):
    from tokenmill.llm.secret_scan import secret_scan

    before = {r.doc_id: r.text for r in docs.collect()}
    spans = {r.doc_id: r.secrets for r in secret_scan(docs).collect()}
    after = corpus_pipeline.mask_secrets(spark, docs, tiny)
    assert after.columns == COLUMNS and after.count() == docs.count()
    for r in after.collect():
        text, out, at = before[r.doc_id], "", 0
        for s in spans[r.doc_id]:
            if s.start >= at:
                out += text[at : s.start] + corpus_pipeline.MASK
            at = max(at, s.end)
        assert r.text == (None if text is None else out + text[at:])
        if spans[r.doc_id]:
            assert r.n_chars == len(r.text) and "abcdef12345" not in r.text


def test_columns_of_any_name_and_type_come_through(spark, tiny, documents):
    """Names that the stages use inside, a map, a name with a dot; a very long text; null rows."""
    words = sorted({w for r in documents.collect() for w in r.text.split()})
    long = " ".join(random.Random(1).choices(words, k=150_000))
    rows = [(1, prose(60, "oak")), (2, prose(60, "oak")), (3, long), (4, None), (None, prose(50, "ash"))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "*", F.lit("s").alias("source"), F.lit("en").alias("lang"), F.length("text").cast("bigint").alias("n_chars"),
        *(F.lit(f"own {c}").alias(c) for c in ("_key", "_row", "_hash", "s", "fp", "component", "n_hit", "node", "a.b")),
        F.create_map(F.lit("k"), F.col("doc_id")).alias("facts"),
    )
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = cut_lineage(stage(spark, kept, tiny))
        assert kept.columns == docs.columns, name
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == {1, 3, None}
    want = {r.doc_id: r for r in docs.collect()}
    assert all(got[i] == want[i] for i in got)


def test_filtering_stages_equal_brute_force(spark, tiny, docs):
    """The first three stages in a row against plain loops; of the quality verdict only the bands are the operator's."""
    from test_dedup import brute_similar
    from test_scans import brute_counts
    from test_tables import brute_overlap

    inside = {r.doc_id for r in token_quality(docs).where("kept").collect()}
    rows = []
    for r in docs.collect():
        n_words, _, _, _, repeated = brute_counts(r.text)
        if n_words >= 20 and 100 * repeated <= 30 * n_words and r.doc_id in inside:
            rows.append((r.doc_id, r.text))
    least = {i for _, i in brute_similar(rows)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    want = sorted({i for i, t in rows if i in least and brute_overlap(t, items)[1] == 0})
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = cut_lineage(stage(spark, kept, tiny))
    assert sorted(r.doc_id for r in kept.collect()) == want and 50 < len(want) < docs.count()


def test_workers_need_not_have_the_package():
    """Every operator with Python workers, from another folder and without a search path."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = f"""
import sys; sys.path.insert(0, {root!r})
from tokenmill.session import local_session
from tokenmill.llm import queries
spark = local_session(2, 2)
spark.sparkContext.setLogLevel("OFF")
for name in sorted(queries.QUERIES):
    print(name, queries.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, flush=True)
from tokenmill.llm.similar import similar_documents
print("similar", similar_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).count() > 0)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True, timeout=900)
    lines = [line.split() for line in done.stdout.splitlines() if line.endswith(("True", "False"))]
    assert len(lines) == 14 and all(ok == "True" for _, ok in lines), done.stderr[-2000:]


def test_run_is_its_stages(spark, tiny):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality rules" and len(corpus_pipeline.STAGES) == 5
    got = corpus_pipeline.run(spark, tiny)
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, tiny))
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert got.columns == [*COLUMNS, "copy", "mix_key"]


def test_stages_of_an_empty_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, tiny))
    assert docs.count() == 0
