"""What the operators share: tables, words, Arrow tasks, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tokenmill.session import cut_lineage

#: Words of letters and digits, on lower-cased UTF-8: whatever is not ASCII counts as part of a word.
ALNUM_WORD = rb"[0-9a-z\x80-\xff]+"
#: The same over strings, for Spark and SQL.
ALNUM_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words between ASCII white space.
SPACED_WORD = r"[^\x20\x09-\x0D]+"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the quick way to the same result."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alnum_words(text: Column) -> Column:
    """Array of words; null has none."""
    spaced = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), ALNUM_GAPS, " "))
    return F.when(spaced == "", F.array().cast("array<string>")).otherwise(F.split(spaced, " "))


def map_texts(
    docs: DataFrame, id_col: str, text_col: str, fields: str, setup: Callable[[], Callable[[str], tuple]]
) -> DataFrame:
    """``id_col`` and, for each row, the tuple that the function made by ``setup`` gives for its whole text.

    Null texts arrive as "". ``setup`` runs once per task. Rows stay where they are: no shuffle.
    """
    ident = docs.schema[id_col]
    schema = T.StructType([ident, *T._parse_datatype_string(fields).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = setup()
        for batch in batches:
            texts = batch.column(1)
            made = [row(text.as_py() or "") for text in texts]
            columns = zip(*made, strict=True) if made else [()] * (len(arrow) - 1)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow.field(0).type), *arrays], schema=arrow)

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node that it reaches.

    Alternating stars: each node ties its larger neighbours to the least one it knows, then its
    smaller ones, until nothing changes. Rounds grow with the logarithm of the longest path. A
    round groups by node with sums made in tasks; these and the edges are written to the shared
    folder, so the joins read plain shuffles in which a hot node may be split, and a lost
    executor repeats one step at most.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = cut_lineage(pairs)
    state = None
    while True:
        # larger neighbours
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).union(pairs.select("b", "a"))
        least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = cut_lineage(large.where("a <> b").distinct())
        # smaller ones and the node itself
        down = cut_lineage(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        pairs = cut_lineage(small.union(down.select("a", F.col("m").alias("b"))).distinct())
        seen = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()  # one row
        if tuple(seen) == state:
            break
        state = tuple(seen)
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
