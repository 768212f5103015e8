"""Benchmark decontamination: a prefix-filtered join of item windows with documents, verified word by word."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenmill.llm.common import alnum_words
from tokenmill.session import cut_lineage

#: Words of a window and of a shingle; shorter items are windows, and shorter windows shingles, of their own length.
WINDOW, SHINGLE = 10, 3

#: Tables of up to so many shingles, with up to so many bytes of window words, are broadcast; both are counted first.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def item_windows(items: DataFrame, window: int, shingle: int, item_col: str, text_col: str) -> DataFrame:
    """(item, window_id, words, n, size): each item's runs of ``window`` words, or all its words if it has fewer."""
    worded = items.select(F.col(item_col).alias("item"), alnum_words(F.col(text_col)).alias("all")).where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - F.lit(window - 1), F.lit(1)))
    words = F.slice("all", F.col("at"), F.lit(window))
    return (
        worded.select("item", "all", F.explode(starts).alias("at"))
        .select("item", words.alias("words"))
        .withColumn("n", F.size("words"))
        .withColumn("size", F.least("n", F.lit(shingle)))
        .withColumn("window_id", F.md5(F.array_join("words", " ")))
    )


def shingle_of(words: str, at: Column, size: int) -> Column:
    """Number of the ``size`` words from ``at`` (0 is the first) on."""
    return F.xxhash64(F.lit(size), *(F.get(words, at + i) for i in range(size)))


def each_shingle(rows: DataFrame, words: str, size: int, with_rows: bool = False) -> DataFrame:
    """``rows`` for each place of a shingle, with ``at`` and ``h``; ``with_rows``: and once at -1, where ``h`` is null."""
    first = -1 if with_rows else 0
    last = F.size(words) - F.lit(size)
    kept = rows if with_rows else rows.where(F.size(words) >= size)
    placed = kept.withColumn("at", F.explode(F.sequence(F.lit(first), F.greatest(last, F.lit(first)))))
    h = shingle_of(words, F.col("at"), size)
    return placed.withColumn("h", F.when(F.col("at") >= 0, h) if with_rows else h)


def is_small(prefix: DataFrame, broadcast_rows: int) -> bool:
    n, size = prefix.agg(F.count("*"), F.sum(F.octet_length(F.array_join("held", " ")))).first()  # one row
    return n <= broadcast_rows and (size or 0) <= BROADCAST_BYTES


def document_key(id_col: str, text_col: str) -> Column:
    """Names a row by id and text; rows equal in both have equal results."""
    return F.md5(F.to_json(F.struct(F.col(id_col).cast("string").alias("i"), F.md5(text_col).alias("t"))))


def benchmark_overlap(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(``id_col``, n_words, n_hit, items): words inside any occurrence of an item's window, and the items they come from.

    1. Shingles of the windows are counted over all documents: that orders them by rarity.
    2. A document that contains a window contains all its shingles, so the necessary prefix of a
       window is its rarest shingle. Only these are joined with the documents' shingles.
    3. Positions: the shingle's place in the window fixes where the window must begin; it must lie
       inside the document. Length: the document must have the window's words behind that place.
    4. The words there are compared one by one, so the result is exact.

    Shingle tables are broadcast only if counted to be small, else joined by shuffle, carrying
    places, not texts; texts then meet the candidates by document. A shingle in a third of all
    documents is looked up in place, or split as a skewed join.

    Null and empty texts have no words and no hits; items without words are ignored. Items
    without an id count for hits and are not listed. Rows equal in id and text get equal results;
    none are dropped. Other columns are not read.
    """
    worded = docs.select(
        id_col, document_key(id_col, text_col).alias("key"), alnum_words(F.col(text_col)).alias("words")
    )
    windows = cut_lineage(item_windows(items, window, shingle, item_col, text_col))
    distinct = windows.dropDuplicates(["window_id"]).select("window_id", "words", "n", "size")
    sizes = sorted(r["size"] for r in windows.select("size").distinct().collect())  # numbers up to ``shingle``

    found, rows = [], None
    for size in sizes:
        sought = each_shingle(distinct.where(F.col("size") == size).withColumnRenamed("words", "held"), "held", size)
        sought = sought.select("window_id", "held", "n", F.col("at").alias("offset"), "h")
        wanted = cut_lineage(sought.select("h").distinct())
        small = wanted.count() <= broadcast_rows
        seen = each_shingle(worded.select("words"), "words", size).select("h")
        counts = cut_lineage(
            seen.join(F.broadcast(wanted) if small else wanted, "h").groupBy("h").agg(F.count("*").alias("n_seen"))
        )
        rarity = Window.partitionBy("window_id").orderBy("n_seen", "h", "offset")
        # a window with a shingle that no document has is in none, so it needs no row at all
        ranked = sought.join(counts, "h", "left").withColumn("n_seen", F.coalesce("n_seen", F.lit(0)))
        prefix = cut_lineage(
            ranked.withColumn("r", F.row_number().over(rarity)).where("r = 1 and n_seen > 0").drop("r", "n_seen")
        )
        # the first pass over the documents also gives each row and its number of words
        read = worded.select(id_col, "key", "words") if rows is None else worded.select("key", "words")
        if is_small(prefix, broadcast_rows):
            # outer only in the one row at -1: every other place needs its shingle in the table
            places = each_shingle(read, "words", size, with_rows=rows is None)
            places = places.join(F.broadcast(prefix), "h", "left").where("at < 0 or window_id is not null")
        else:
            places = (
                each_shingle(worded.select("key", "words"), "words", size)
                .select("key", "at", "h")
                .join(prefix, "h")
                .join(worded.dropDuplicates(["key"]).select("key", "words"), "key")
            )
        start = F.col("at") - F.col("offset")
        inside = (start >= 0) & (start + F.col("n") <= F.size("words"))
        same = F.when(inside, F.slice("words", start + 1, F.col("n")) == F.col("held")).otherwise(False)
        hit = places.where(F.col("at") >= 0).where(same).select("key", start.alias("start"), "n", "window_id")
        if rows is None and id_col in places.columns:
            n_words = F.size("words").cast("bigint").alias("n_words")
            both = cut_lineage(
                places.where((F.col("at") < 0) | same).select(id_col, "key", n_words, "at", start.alias("start"), "n", "window_id")
            )
            rows = both.where("at < 0").select(id_col, "key", "n_words")
            hit = both.where("at >= 0").select("key", "start", "n", "window_id")
        found.append(hit)

    if not found:
        return worded.select(
            id_col, F.size("words").cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_hit"),
            F.array().cast("array<string>").alias("items"),
        )
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    hits = cut_lineage(hits.distinct())
    covered = (
        hits.select("key", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("at"))
        .distinct()
        .groupBy("key")
        .agg(F.count("*").alias("n_hit"))
    )
    owners = windows.where(F.col("item").isNotNull()).select("window_id", F.col("item").cast("string").alias("item")).distinct()
    listed = (
        hits.select("key", "window_id").distinct().join(owners, "window_id").groupBy("key").agg(F.collect_set("item").alias("items"))
    )
    if rows is None:
        rows = worded.select(id_col, "key", F.size("words").cast("bigint").alias("n_words"))
    return (
        rows.join(covered, "key", "left")
        .join(listed, "key", "left")
        .select(
            id_col,
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.array_sort(F.coalesce("items", F.array().cast("array<string>"))).alias("items"),
        )
    )
