"""How metrics are written for people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenmill import constants as C


def metric_label(metric: Column) -> Column:
    plain = F.replace(F.replace(metric, F.lit("eval/"), F.lit("")), F.lit("_acc"), F.lit(""))
    return F.initcap(F.replace(plain, F.lit("_"), F.lit(" ")))


def metric_text(metric: Column, value: Column) -> Column:
    """Accuracies as percent with two decimals, the rest with four."""
    return F.when(F.contains(metric, F.lit("acc")), F.format_string("%.2f%%", value * 100)).otherwise(
        F.format_string("%.4f", value)
    )


def report_line(metric: Column, value: Column) -> Column:
    return F.format_string("  %-20s %s", metric_label(metric), metric_text(metric, value))


def percent(value: Column) -> Column:
    return F.when(value.isNull(), F.lit(C.MISSING_TEXT)).otherwise(F.format_string("%.2f%%", value))


def percent_change(before: Column, after: Column) -> Column:
    sign = F.when(after > before, F.lit("+")).otherwise(F.lit(""))
    return F.when(before.isNull() | after.isNull(), F.lit(C.MISSING_TEXT)).otherwise(
        F.concat(sign, F.format_string("%.2f%%", after - before))
    )
