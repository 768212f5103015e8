"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.session import cut_lineage

#: Up to so many values in all sources' step arrays (16 MB) they are broadcast; they are counted first.
BROADCAST_STEPS = 2_000_000
#: 13 hex digits are 52 bits, which a double holds exactly.
HEX_DIGITS, STEPS = 13, 2.0**52


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of seed and parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, HEX_DIGITS), 16, 10).cast("double") / STEPS


def source_sizes(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, size): UTF-8 bytes of each source, over all rows; null is a source of its own."""
    size = F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint"))
    return docs.groupBy(F.col(source_col).alias("source")).agg(size.alias("size"))


def smoothed_weights(sizes: DataFrame, exponent: float = 0.5) -> DataFrame:
    """(source, weight): size to the power of ``exponent``; 1 keeps proportions, 0 levels them."""
    return sizes.select("source", F.pow(F.col("size").cast("double"), F.lit(exponent)).alias("weight"))


def repetition_rates(sizes: DataFrame, weights: DataFrame, epochs: float) -> DataFrame:
    """(source, rate): how often a document of the source shall come on average.

    The mixture has ``epochs`` times the corpus's bytes, shared out by weight among the sources that
    have bytes. A source without a weight has rate 0.
    """
    joined = sizes.join(
        weights.select(F.col("source").alias("_source"), "weight"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).select("source", "size", F.when(F.col("size") > 0, F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))).alias("weight"))
    whole = joined.agg(F.sum("size"), F.sum("weight")).first()  # one row
    total, total_weight = float(whole[0] or 0), float(whole[1] or 0)
    if total_weight <= 0:
        return joined.select("source", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / F.lit(total_weight) * F.lit(epochs * total) / F.col("size")
    return joined.select("source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """(source, steps): the distribution function of Poisson(rate) at 0, 1, 2 ... as an array.

    Beyond rate + 12 roots + 30 the tail is below what 52 bits can tell. Probabilities are taken from
    logarithms, so large rates don't underflow.
    """
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30)
    ks = rates.where(F.col("rate") > 0).select("source", "rate", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("k"))
    up_to = Window.partitionBy("source").orderBy("k")
    log_factorial = F.sum(F.log(F.greatest(F.col("k"), F.lit(1)).cast("double"))).over(up_to)
    mass = F.exp(F.col("k") * F.log("rate") - F.col("rate") - F.col("log_factorial"))
    reached = ks.withColumn("log_factorial", log_factorial).select("source", "k", F.sum(mass).over(up_to).alias("p"))
    pairs = F.array_sort(F.collect_list(F.struct("k", "p")))
    return reached.groupBy("source").agg(F.transform(pairs, lambda s: s["p"]).alias("steps"))


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    epochs: float = 1.0,
    seed: str = "mix",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """All columns of ``docs``, then ``copy`` (from 1) and ``mix_key``: each document as often as drawn, in shuffled order.

    The count of a document is the inverse Poisson distribution, with its source's repetition rate as
    mean, at a uniform number hashed from seed, id and text: the same on every run and in any partitioning.
    ``weights``: (source, weight), relative; without it the sources' sizes to the power 0.5. Copies are
    dealt by the hash of (seed, id, text, copy) and sorted by it, which is a global shuffle.

    Sizes are summed in tasks and cover all rows. A hot source is only a rate that many rows look up,
    by broadcast if what it looks up was counted to be small, else by a join that may split it. A null
    source is a source; rows equal in id and text draw equal counts; null and empty texts count as
    rows of size 0 and follow their source's rate; of a source of empty texts only no row is drawn.
    Existing columns ``copy`` and ``mix_key`` are replaced.
    """
    sizes = cut_lineage(source_sizes(docs, source_col, text_col))
    wanted = smoothed_weights(sizes) if weights is None else weights
    steps = cut_lineage(poisson_steps(repetition_rates(sizes, wanted, epochs)))
    n_steps = steps.agg(F.sum(F.size("steps") + F.octet_length(F.coalesce("source", F.lit(""))))).first()[0] or 0
    if n_steps <= BROADCAST_STEPS:
        steps = F.broadcast(steps)
    kept = docs.drop(*({"copy", "mix_key"} - {id_col, source_col, text_col}))
    matched = kept.join(
        steps.select(F.col("source").alias("_source"), F.col("steps").alias("_steps")),
        kept[source_col].eqNullSafe(F.col("_source")),
    )
    named = (F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(text_col, F.lit(""))))
    draw = uniform(seed, *named)
    times = F.size(F.filter("_steps", lambda p: p <= F.col("_draw")))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), *named, "copy"))
    return (
        matched.withColumn("_draw", draw)
        .withColumn("_times", times)
        .where(F.col("_times") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times").cast("bigint"))))
        .withColumn("mix_key", key)
        .select(*kept.columns, "copy", "mix_key")
        .repartition("mix_key")
        .sortWithinPartitions("mix_key", id_col, "copy")
    )
