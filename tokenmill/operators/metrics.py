"""Metric logs: (run, step, metric, value, logged_at), one row per logged value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.functions import formats
from tokenmill.operators.ordering import ROWS_PER_SEGMENT, Running, running
from tokenmill.session import cut_lineage


def resolve_resumed(log: DataFrame) -> DataFrame:
    """One value per (run, step, metric): a resumed run logs steps again, the latest counts.

    Of values logged at one time the greatest counts, so the result is determined.
    """
    newest = F.max(F.struct("logged_at", "value"))
    return log.groupBy("run", "step", "metric").agg(newest.alias("_newest")).select(
        "run", "step", "metric", F.col("_newest.value").alias("value"), F.col("_newest.logged_at").alias("logged_at")
    )


def metric_latest(log: DataFrame) -> DataFrame:
    """(run, metric, step, value) at the last step, one partial aggregation."""
    newest = F.struct("step", "logged_at")
    return log.groupBy("run", "metric").agg(F.max("step").alias("step"), F.max_by("value", newest).alias("value"))


def metric_report(latest: DataFrame) -> DataFrame:
    """(run, label, text) as printed in a summary."""
    metric, value = F.col("metric"), F.col("value")
    return latest.select(
        "run", formats.metric_label(metric).alias("label"), formats.metric_text(metric, value).alias("text")
    )


def wide_metrics(latest: DataFrame, metrics: list[str]) -> DataFrame:
    """One row per run, one column per metric."""
    return latest.groupBy("run").pivot("metric", metrics).agg(F.first("value"))


def best_checkpoints(
    log: DataFrame,
    eval_every: int = 1,
    save_every: int = C.SAVE_EVERY,
    start_step: int = 0,
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """(run, metric, step, value, is_best, is_saved).

    Only the latest value of a step counts (``resolve_resumed``).
    At an evaluation step a value strictly below all earlier evaluated ones is best and saved.
    Any other step is saved when it is periodic and after the start.
    """
    evaluated = F.col("step") % eval_every == 0
    value = F.when(evaluated, F.col("value"))
    past = running(
        cut_lineage(resolve_resumed(log).select("run", "metric", "step", "value")),  # read more than once
        ["step"],
        [Running("_lowest", "min", value)],
        group=["run", "metric"],
        few_groups=False,
        rows_per_segment=rows_per_segment,
    )
    # NaN sorts above infinity, so it is never best
    best = evaluated & (F.col("value") < F.coalesce("_lowest", F.lit(float("inf"))))
    periodic = (F.col("step") % save_every == 0) & (F.col("step") > start_step)
    return past.select(
        "run",
        "metric",
        "step",
        "value",
        F.coalesce(best, F.lit(False)).alias("is_best"),
        F.coalesce(best | periodic, F.lit(False)).alias("is_saved"),
    )


def throughput(
    log: DataFrame, tokens_per_step: int = C.TOKENS_PER_STEP, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """(run, step, tokens_per_sec) since the step before in the run; NULL for its first one.

    A step that was logged more than once counts at its latest time.
    """
    past = running(
        cut_lineage(log.groupBy("run", "step").agg(F.max("logged_at").alias("logged_at"))),
        ["step"],
        [Running("_past", "last", F.struct("step", "logged_at"))],
        group=["run"],
        few_groups=False,
        rows_per_segment=rows_per_segment,
    )
    steps = F.col("step") - F.col("_past.step")
    seconds = _micros_between(F.col("_past.logged_at"), F.col("logged_at")) / 1_000_000
    rate = F.try_divide((steps * tokens_per_step).cast("double"), seconds)
    return past.select("run", "step", F.round(rate, 4).alias("tokens_per_sec"))


def _micros_between(earlier: Column, later: Column) -> Column:
    """Microseconds between two times; from the interval, so no time zone comes in."""
    gap = later - earlier
    whole = F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
    whole = whole + F.extract(F.lit("HOUR"), gap) * 3600 + F.extract(F.lit("MINUTE"), gap) * 60
    return whole * 1_000_000 + (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")


def scaling_gap(
    losses: DataFrame,
    parameters: float = C.SCALING_PARAMETERS,
    tokens_per_step: int = C.TOKENS_PER_STEP,
) -> DataFrame:
    """Adds tokens seen (billions), predicted loss and actual minus predicted.

    ``losses`` has ``step`` and ``value``; steps before the first token are left out.
    """
    tokens = (F.col("step") * tokens_per_step).cast("double")
    floor = C.SCALING_E + C.SCALING_A / parameters**C.SCALING_ALPHA
    predicted = F.lit(floor) + F.lit(C.SCALING_B) / F.pow(tokens, F.lit(C.SCALING_BETA))
    kept = losses.where(F.col("step") > 0).withColumn("_predicted", predicted)
    return kept.select(
        "run",
        "step",
        F.round(tokens / 1e9, 6).alias("tokens_b"),
        F.col("value").alias("actual"),
        F.round("_predicted", 4).alias("predicted"),
        F.round(F.col("value") - F.col("_predicted"), 4).alias("gap"),
    )


def parse_log(lines: DataFrame) -> DataFrame:
    """(log, metric, value) from (log, line_no, line): the first match of each pattern.

    Every log gets all metrics, NULL where no line matches.
    """
    found = {
        metric: F.expr(f"nullif(regexp_extract(line, r'(?i){pattern}', 1), '')").cast("double")
        for metric, pattern in C.LOG_PATTERNS.items()
    }
    # each pattern once per line, in a step of its own
    values = lines.select("log", "line_no", F.array(*found.values()).alias("v"))
    firsts = []
    for i, metric in enumerate(found):
        value = F.col("v")[i]
        firsts.append(F.min_by(value, F.when(value.isNotNull(), F.col("line_no"))).alias(metric))
    wide = values.groupBy("log").agg(*firsts)
    return wide.unpivot("log", list(C.LOG_PATTERNS), "metric", "value")


def results_json(parsed: DataFrame, named: bool = False) -> DataFrame:
    """(log, json): one object per log, with its name if asked for; missing metrics are explicit nulls."""
    wide = parsed.groupBy("log").pivot("metric", list(C.LOG_PATTERNS)).agg(F.first("value"))
    names = [*([F.col("log")] if named else []), *(F.col(m) for m in C.LOG_PATTERNS)]
    return wide.select("log", F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("json"))


def long_results(results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """(keys, metric, value) of results objects, to compare two of them."""
    return results.unpivot(keys or [], list(C.LOG_PATTERNS), "metric", "value")


def version_compare(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, v1, v2, delta, text): two runs side by side; a metric of one run only stays."""
    first = before.select(*keys, F.col("value").alias("v1"))
    second = after.select(*keys, F.col("value").alias("v2"))
    both = first.join(second, keys, "full_outer")
    return both.select(
        *keys,
        "v1",
        "v2",
        F.round(F.col("v2") - F.col("v1"), 6).alias("delta"),
        F.concat_ws(
            " | ",
            formats.percent(F.col("v1")),
            formats.percent(F.col("v2")),
            formats.percent_change(F.col("v1"), F.col("v2")),
        ).alias("text"),
    )
