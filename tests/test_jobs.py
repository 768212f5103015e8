import datetime as dt

import pytest

from tokenmill.functions.tokenizers import ByteTokenizer
from tokenmill.operators import instruct, metrics, scoring
from tokenmill.plans import bindings, jobs
from tokenmill.plans.queries import QUERIES
from tokenmill.sources import readers, writers

BYTES = ByteTokenizer()


def test_corpus_job_equals_its_query(spark, tiny, tmp_path):
    got = jobs.prepare_corpus(readers.documents(spark, tiny), BYTES, f"{tmp_path}/store")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, QUERIES["corpus_stats"](spark, tiny).collect()))


def test_instruction_jobs(spark, tiny, tmp_path):
    turns, docs = readers.turns(spark, tiny), readers.documents(spark, tiny)
    chat = {(r.split, r.source): r.n for r in jobs.prepare_chat(turns, docs, BYTES, f"{tmp_path}/chat", 200_000, 150, 100).collect()}
    single = jobs.prepare_single_turn(instruct.single_turn(turns), docs, BYTES, f"{tmp_path}/one", 80, 40)
    single = {(r.split, r.source): r.n for r in single.collect()}
    assert sum(n for (_, source), n in chat.items() if source == "corpus") == 100
    assert sum(n for (_, source), n in single.items() if source == "corpus") == 40
    for counts in (chat, single):
        total = sum(counts.values())
        assert sum(n for (split, _), n in counts.items() if split == "val") == max(1, int(total * 0.02))


def test_a_blend_must_not_reach_validation_text(spark, tiny, tmp_path):
    turns, docs = readers.turns(spark, tiny), readers.documents(spark, tiny)
    with pytest.raises(ValueError, match="validation"):
        jobs.prepare_chat(turns, docs, BYTES, f"{tmp_path}/chat", 10, 20_000, 10)


def test_evaluation_job_appends_to_a_metric_log(spark, tiny, tmp_path):
    scores = scoring.fit_bigram(readers.documents(spark, tiny), BYTES)
    rows = jobs.evaluate(
        scores,
        BYTES,
        run=3,
        step=5000,
        logged_at=dt.datetime(2024, 5, 1, 12, 30),
        choices={"hellaswag": bindings.choice_items(spark, tiny)},
        labelled={"arc_easy": bindings.labelled_items(spark, tiny)},
        last_words={"lambada": readers.table(spark, tiny, "benchmark", "item_id", "text")},
        clozes={"winogrande": bindings.cloze_items(spark, tiny)},
    )
    writers.append_metrics(rows, f"{tmp_path}/log")
    latest = metrics.metric_latest(spark.read.parquet(f"{tmp_path}/log"))
    got = {r.metric: r.value for r in latest.collect()}
    assert set(got) == {f"eval/{t}_acc" for t in ("hellaswag", "arc_easy", "lambada", "winogrande")}
    assert got["eval/hellaswag_acc"] == got["eval/arc_easy_acc"] and all(0 <= v <= 1 for v in got.values())
    assert metrics.metric_report(latest).count() == 4


def test_evaluation_needs_a_task(spark, tiny):
    scores = scoring.fit_bigram(readers.documents(spark, tiny).limit(5), BYTES)
    with pytest.raises(ValueError):
        jobs.evaluate(scores, BYTES, 1, 1, dt.datetime(2024, 1, 1))


def test_own_tables_are_removed(spark, tiny):
    import os

    from tokenmill import session

    with session.own_tables(spark) as folder:
        kept = session.cut_lineage(readers.documents(spark, tiny).select("doc_id"))
        assert kept.count() == 200 and os.path.isdir(folder)
    assert not os.path.exists(folder)
