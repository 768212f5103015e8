import datetime as dt
import json

import pytest

from tokenmill.operators import checkpoints, metrics

LOG = "run bigint, step bigint, metric string, value double, logged_at timestamp_ntz"
T0 = dt.datetime(2024, 3, 10, 1, 59, 58)


def _log(spark, rows):
    full = [(run, step, metric, value, T0 + dt.timedelta(seconds=at)) for run, step, metric, value, at in rows]
    return spark.createDataFrame(full, LOG).repartition(3)


def test_best_so_far_and_save_rule(spark):
    values = {1000: 3.0, 1500: 9.0, 2000: 2.9, 3000: 2.9, 4000: 2.5, 4100: 0.1, 5000: float("nan")}
    log = _log(spark, [(1, s, "val", v, s) for s, v in values.items()] + [(1, 0, "val", 4.0, 0)])
    got = {r.step: (r.is_best, r.is_saved) for r in metrics.best_checkpoints(log, eval_every=1000).collect()}
    assert got == {
        0: (True, True),
        1000: (True, True),
        1500: (False, True),
        2000: (True, True),
        3000: (False, True),
        4000: (True, True),
        4100: (False, False),
        5000: (False, True),
    }


def test_first_nan_is_not_best(spark):
    log = _log(spark, [(1, 1, "m", float("nan"), 1), (1, 2, "m", 8.0, 2), (1, 3, "m", 7.0, 3)])
    assert [r.is_best for r in metrics.best_checkpoints(log).orderBy("step").collect()] == [False, True, True]


def test_one_run_with_most_rows_gives_the_same_flags(spark):
    rows = [(7, s, "m", float((s * 7919) % 1009), s) for s in range(1200)]
    rows += [(r, s, "m", float(s % 5), s) for r in range(20) for s in range(10)]
    log = _log(spark, rows)
    whole = metrics.best_checkpoints(log)
    cut = metrics.best_checkpoints(log, rows_per_segment=100)
    assert whole.exceptAll(cut).count() == 0 and whole.count() == cut.count() == len({r[:3] for r in rows})
    rate = metrics.throughput(log)
    assert rate.exceptAll(metrics.throughput(log, rows_per_segment=100)).count() == 0


def test_many_cut_groups_give_the_same_flags(spark):
    rows = [(r, s, "m", float((s * 7919 + r) % 11), s) for r in range(5000) for s in range(6)]
    log = _log(spark, rows)
    cut = metrics.best_checkpoints(log, rows_per_segment=4)
    assert metrics.best_checkpoints(log).exceptAll(cut).count() == 0 and cut.count() == len(rows)


def test_only_the_latest_value_of_a_step_is_judged(spark):
    log = _log(spark, [(1, 1, "m", 5.0, 1), (1, 2, "m", 3.0, 2), (1, 2, "m", 9.0, 8), (1, 3, "m", 4.0, 9)])
    got = {r.step: (r.value, r.is_best) for r in metrics.best_checkpoints(log).collect()}
    assert got == {1: (5.0, True), 2: (9.0, False), 3: (4.0, True)}
    tied = _log(spark, [(1, 1, "m", 5.0, 1), (1, 1, "m", 6.0, 1)])
    assert [r.value for r in metrics.resolve_resumed(tied).collect()] == [6.0]


def test_throughput_across_a_clock_change(spark):
    log = _log(spark, [(1, 100, "m", 1.0, 0), (1, 150, "m", 1.0, 4), (1, 200, "m", 1.0, 4)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.tokens_per_sec for r in metrics.throughput(log, tokens_per_step=10).orderBy("step").collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [None, 125.0, None]


def test_resumed_steps_and_latest(spark):
    log = _log(spark, [(1, 5, "m", 1.0, 10), (1, 5, "m", 2.0, 20), (1, 4, "m", 9.0, 30), (1, 9, "k", 3.0, 1)])
    assert sorted((r.step, r.metric, r.value) for r in metrics.resolve_resumed(log).collect()) == [
        (4, "m", 9.0),
        (5, "m", 2.0),
        (9, "k", 3.0),
    ]
    latest = metrics.metric_latest(log)
    assert sorted((r.metric, r.step, r.value) for r in latest.collect()) == [("k", 9, 3.0), ("m", 5, 2.0)]
    assert tuple(metrics.wide_metrics(latest, ["k", "m", "z"]).first()) == (1, 3.0, 2.0, None)


def test_report(spark):
    rows = [(1, 1, "eval/arc_easy_acc", 0.582, 0), (1, 1, "eval/val_loss", 1.37041, 0)]
    got = sorted(tuple(r) for r in metrics.metric_report(_log(spark, rows)).collect())
    assert got == [(1, "Arc Easy", "58.20%"), (1, "Val Loss", "1.3704")]


def test_scaling_law(spark):
    billions = [4.2, 6.0, 7.9, 9.7, 11.8]
    rows = [(1, int(b * 1000), "loss", 3.0, 0) for b in billions] + [(1, 0, "loss", 9.0, 0)]
    got = metrics.scaling_gap(_log(spark, rows), tokens_per_step=1_000_000).orderBy("step").collect()
    assert [r.tokens_b for r in got] == billions
    assert [r.predicted for r in got] == pytest.approx([3.0257, 2.9468, 2.8911, 2.8523, 2.8172], abs=2e-4)
    assert [r.gap for r in got] == pytest.approx([3 - r.predicted for r in got], abs=1e-4)


def test_log_parsing(spark):
    lines = ["  Hellaswag            37.60%", "  Val Loss             1.3704", "HellaSwag  1.00%", "Winogrande 12%"]
    rows = [("a", i, line) for i, line in enumerate(lines)] + [("b", 0, "nothing")]
    parsed = metrics.parse_log(spark.createDataFrame(rows, "log string, line_no int, line string"))
    got = {(r.log, r.metric): r.value for r in parsed.collect()}
    assert len(got) == 12
    assert {k: v for k, v in got.items() if v is not None} == {("a", "hellaswag"): 37.6, ("a", "val_loss"): 1.3704}
    text = {r.log: json.loads(r.json) for r in metrics.results_json(parsed).collect()}
    one = parsed.where("log = 'a'").groupBy().pivot("metric").agg({"value": "first"})
    assert {r.metric: r.value for r in metrics.long_results(one).collect()}["val_loss"] == 1.3704
    assert text["a"]["hellaswag"] == 37.6 and text["a"]["winogrande"] is None and len(text["b"]) == 6


def test_version_compare(spark):
    v1 = spark.createDataFrame([("h", 38.4), ("l", 34.0), ("only1", 1.0)], "metric string, value double")
    v2 = spark.createDataFrame([("h", 37.6), ("l", 35.3), ("only2", 2.0)], "metric string, value double")
    got = {r.metric: r.text for r in metrics.version_compare(v1, v2, ["metric"]).collect()}
    assert got == {
        "h": "38.40% | 37.60% | -0.80%",
        "l": "34.00% | 35.30% | +1.30%",
        "only1": "1.00% | TBD | TBD",
        "only2": "TBD | 2.00% | TBD",
    }


def test_pending_checkpoints(spark):
    names = ["ckpt_0000000.pt", "ckpt_0005000.pt", "ckpt_0007500.pt", "ckpt_0010000.pt", "latest.pt", "ckpt_0015000.pt"]
    files = spark.createDataFrame([(f"/m/{n}",) for n in names], "path string")
    done = spark.createDataFrame([("/m/ckpt_0005000.pt",), ("x/m/ckpt_0010000.pt",)], "path string")
    got = sorted(tuple(r) for r in checkpoints.pending(files, done).collect())
    assert got == [("/m/ckpt_0010000.pt", 10000), ("/m/ckpt_0015000.pt", 15000)]
    assert tuple(checkpoints.next_pending(files, done).first()) == got[0]
