"""Allow and block rules over URLs: a sort-merge range join of prefixes with a sweep over nested rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.common import ascii_lower
from tokenmill.session import cut_lineage

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Pages for one sweep; a sweep is never smaller than the rule table, so rules at most double the rows.
PAGES_PER_SWEEP = 200_000


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def canonical(labels: Column, path: Column) -> Column:
    """Key of labels, outermost first, and path. A host holds no "/", so the first one ends it."""
    return F.concat(F.array_join(labels, "."), F.lit("/"), path)


def outer_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's key with the stack of rules around it, outermost first, itself last.

    A rule around another one is a prefix of its key, so the prefixes of the keys are looked up: as
    many rows as the keys have characters. Of rules with one key the least verdict stands ("allow").
    """
    keyed = (
        rules.where(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .select(
            F.struct(
                canonical(outer_labels(ascii_lower(F.col("host"))), F.coalesce("path", F.lit(""))).alias("key"),
                F.concat(ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))).alias("rule"),
                "verdict",
            ).alias("r")
        )
        .groupBy(F.col("r.key").alias("key"))
        .agg(F.min("r").alias("r"))
    )
    lengths = F.sequence(F.lit(1), F.length("key"))
    prefixes = keyed.select("key", F.explode(lengths).alias("n")).select("key", F.expr("substr(key, 1, n)").alias("outer"))
    around = keyed.select(F.col("key").alias("outer"), "r")
    return (
        prefixes.join(around, "outer")
        .groupBy("key")
        # prefixes of one key: by key is by length
        .agg(F.array_sort(F.collect_list("r")).alias("stack"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow", pages_per_sweep: int = PAGES_PER_SWEEP
) -> DataFrame:
    """All columns of ``pages``, then ``host``, ``path``, ``rule``, ``verdict``.

    ``rules``: (host, path, verdict). A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest host and path together win, then the smaller text. No rule:
    ``rule`` is null and the verdict ``default``.

    With labels reversed, a rule covers one interval of keys: all that begin with its own. A URL
    has one key for each host above its own. Keys and rule starts are sorted together; the last
    rule start before a key carries its stack of nested rules, and what has ended by then does not
    begin the key. Distinct URLs only are judged and dealt by hash into sweeps of about
    ``pages_per_sweep``, each with all rule starts, so a hot host or URL never meets in one task and
    nothing is broadcast by hint.

    Null or malformed URLs have an empty host and path and fit rules with an empty host only. Rows
    stay as they are, also repeated ones; columns of ``pages`` named like the four are replaced.
    """
    names = ("host", "path", "rule", "verdict")
    kept = pages.drop(*(n for n in names if n != url_col))
    parsed = kept.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    urls = cut_lineage(parsed.select("host", "path").distinct())
    stacks = rule_stacks(rules)
    n_rules = stacks.count()
    sweep_size = max(pages_per_sweep, n_rules)
    sweeps = max(1, -(-urls.count() // sweep_size))

    labels = outer_labels(F.col("host"))
    levels = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda n: canonical(F.slice(labels, F.lit(1), n), F.col("path"))
    )
    probes = urls.select(
        F.pmod(F.xxhash64("host", "path"), F.lit(sweeps)).alias("sweep"),
        "host",
        "path",
        F.explode(levels).alias("key"),
        F.lit(None).cast(stacks.schema["stack"].dataType).alias("stack"),
    )
    starts = stacks.select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(sweeps - 1).cast("bigint"))).alias("sweep"),
        F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"),
        "key",
        "stack",
    )
    # a rule start comes before the keys equal to it: nulls first
    order = Window.partitionBy("sweep").orderBy("key", F.col("host").asc_nulls_first())
    stack = F.last("stack", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = starts.unionByName(probes).select("host", "path", "key", stack.alias("stack")).where(F.col("host").isNotNull())
    active = F.filter("stack", lambda r: F.col("key").startswith(r["key"]))
    best = (
        swept.select("host", "path", F.try_element_at(active, F.lit(-1)).alias("r"))
        .where(F.col("r").isNotNull())
        .groupBy("host", "path")
        .agg(F.min(F.struct((-F.length("r.rule")).alias("n"), "r.rule", "r.verdict")).alias("best"))
    )
    # as a table of its own, so that the join may split the rows of a hot URL
    return (
        parsed.join(cut_lineage(best), ["host", "path"], "left")
        .withColumns({"rule": F.col("best.rule"), "verdict": F.coalesce("best.verdict", F.lit(default))})
        .select(*kept.columns, *names)
    )
