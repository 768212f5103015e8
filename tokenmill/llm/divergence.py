"""Source divergence: term shares of the sources of a language, compared over segment trees with shared nodes."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.session import cut_lineage

MIN_DOCS, TOP_TERMS = 3, 200
#: Shares are whole parts of this.
UNIT = 1_000_000_000

#: Terms under one segment tree, cells (terms x groups) that a task holds, groups on the left side of a task.
SPAN, CELLS, LEFT = 4096, 1 << 21, 256
#: Entries that a task adds up before it hands them on; bytes of a text that are split at once.
HELD, WINDOW = 500_000, 1 << 20


TERM, GAP = re.compile(rb"[a-z\x80-\xff]+"), re.compile(rb"[^a-z\x80-\xff]")


def terms_of(text: str) -> Iterator[list[bytes]]:
    """Terms of letters and non-ASCII signs in their order, A-Z lower-cased; a long text in portions."""
    data, at = text.encode().lower(), 0
    while at < len(data):
        cut = GAP.search(data, at + WINDOW)
        end = cut.start() if cut else len(data)
        yield TERM.findall(data, at, end)
        at = end


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; each group also has a row of null term.

    Tasks add up first, so a shuffle moves one row for each task, group and term at most.
    """
    schema = pa.schema(
        [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, found) in held.items():
                size = len(counts) + 1
                columns = [
                    pa.repeat(pa.scalar(lang, pa.string()), size),
                    pa.repeat(pa.scalar(source, pa.string()), size),
                    pa.array([None, *counts], pa.binary()).cast(pa.string()),
                    pa.array(np.fromiter(chain((0,), counts.values()), np.int64, size)),
                    pa.array(np.fromiter(chain((0,), map(found.__getitem__, counts)), np.int64, size)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
            held.clear()

        size = 0
        for batch in batches:
            groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for group, text in zip(groups, batch.column(2)):
                counts, found = held.setdefault(group, (Counter(), Counter()))
                before, own = len(counts), set()
                for terms in terms_of(text.as_py()):
                    counts.update(terms)
                    own.update(terms)
                found.update(own)
                size += len(counts) - before
                if size > HELD:
                    yield from rows()
                    size = 0
        yield from rows()

    plain = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_col, source_col, text_col)))
    counted = plain.toDF("lang", "source", "text").mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + 1) / (total + terms)), over decimals."""
    return F.lit(1) + F.call_function("div", F.lit(UNIT).cast("decimal(20,0)") * (count + 1), (total + terms).cast("decimal(20,0)"))


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """The same in numpy: long division, three decimal digits a step, so nothing overflows below 9e15 occurrences."""
    whole, rest = np.zeros_like(count), count + 1
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // (total + terms), rest % (total + terms)
    return whole + 1


class SharedTrees:
    """Segment trees of several groups over the same terms, built from the leaves; equal subtrees are one node.

    ``levels[0]`` numbers the counts, ``levels[k]`` the pairs of nodes of level k - 1; a row of a level has a group's
    nodes. Terms beyond the last one are a leaf of their own (number 0) that is priced 0.
    """

    def __init__(self, counts: np.ndarray):
        groups, size = counts.shape
        leaves = np.full((groups, 1 << max(0, size - 1).bit_length()), -1, np.int64)
        leaves[:, :size] = counts
        self.counts, ids = np.unique(np.concatenate([[-1], leaves.ravel()]), return_inverse=True)
        ids = ids[1:].reshape(leaves.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        while ids.shape[1] > 1:
            base = int(ids.max()) + 1
            nodes, inverse = np.unique(ids[:, ::2] * base + ids[:, 1::2], return_inverse=True)
            self.children.append((nodes // base, nodes % base))
            ids = inverse.reshape(groups, -1)
        self.roots = ids[:, 0]

    def leaf_pairs(self, one: int, others: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(other, count, other's count, times): the trees of ``one`` and each of ``others`` walked together.

        A pair of nodes that a pair of trees reaches more than once is opened once, with its times.
        """
        of, b, times = np.arange(len(others)), self.roots[others], np.ones(len(others), np.int64)
        a = np.full(len(others), self.roots[one])
        for left, right in reversed(self.children):
            n = len(left)
            a2, b2 = np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]])
            of, times = np.concatenate([of, of]), np.concatenate([times, times])
            wide = max(int(a2.max()), int(b2.max()), n) + 1
            key, at = np.unique((of * wide + a2) * wide + b2, return_inverse=True)
            times = np.bincount(at, weights=times, minlength=len(key)).astype(np.int64)
            b, a, of = key % wide, key // wide % wide, key // (wide * wide)
        real = self.counts[a] >= 0
        return of[real], self.counts[a[real]], self.counts[b[real]], times[real]


def pair_values(cells: DataFrame) -> DataFrame:
    """(lang, source, item, value) from cells (lang, block, left, source, at, n, total, terms): floor((p - q)^2 / q) over all terms.

    Cells of one block come together, ordered by source; a group without a term in the block has its head (``at`` -1) only.
    """
    names = ["lang", "source", "item", "value"]

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()

        def rows() -> pa.RecordBatch:
            columns = list(zip(*((*key, value) for key, value in sums.items()))) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64()]
            sums.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        def block(lang: str, left: int, parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts)
            source = rows.column("source").combine_chunks().dictionary_encode()
            at, n, group = (rows.column("at").to_numpy(), rows.column("n").to_numpy(), source.indices.to_numpy())
            groups, heads = source.dictionary.to_pylist(), at < 0
            total, terms = np.zeros(len(groups), np.int64), int(rows.column("terms")[0].as_py())
            total[group[heads]] = rows.column("total").to_numpy()[heads]
            own = np.zeros(len(groups), np.int64)
            own[group[heads]] = rows.column("part").to_numpy()[heads]
            counts = np.zeros((len(groups), int(at.max()) + 1), np.int64)
            counts[group[~heads], at[~heads]] = n[~heads]
            trees = SharedTrees(counts)
            for s in np.flatnonzero(own == left).tolist():
                # a pair is walked once, for the group that comes first, and priced both ways
                others = np.arange(s + 1, len(groups))
                if not len(others):
                    continue
                if terms == 0:
                    here = there = np.zeros(len(others), np.int64)
                else:
                    of, x, y, times = trees.leaf_pairs(s, others)
                    p, q = shares(x, np.full(len(x), total[s]), terms), shares(y, total[others[of]], terms)
                    here, there = np.zeros(len(others), np.int64), np.zeros(len(others), np.int64)
                    np.add.at(here, of, times * ((p - q) ** 2 // q))
                    np.add.at(there, of, times * ((p - q) ** 2 // p))
                for t, ahead, back in zip(others.tolist(), here.tolist(), there.tolist()):
                    sums[lang, groups[s], groups[t]] += ahead
                    sums[lang, groups[t], groups[s]] += back

        name, parts = None, []
        for batch in batches:
            numbers = [batch.column("lang").dictionary_encode().indices.to_numpy()]
            numbers += [batch.column(c).to_numpy() for c in ("block", "left")]
            changes = np.flatnonzero(np.any([np.diff(n) != 0 for n in numbers], axis=0)) + 1
            for start, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
                if start == end:
                    continue
                run = batch.slice(start, end - start)
                key = tuple(run.column(c)[0].as_py() for c in ("lang", "block", "left"))
                if key != name and parts:
                    block(name[0], name[2], parts)
                    parts = []
                    if len(sums) > HELD:
                        yield rows()
                name = key
                parts.append(run)
        if parts:
            block(name[0], name[2], parts)
        yield rows()

    dealt = cells.repartition("lang", "block", "left").sortWithinPartitions("lang", "block", "left", "source", "at")
    priced = dealt.mapInArrow(price, "lang string, source string, item string, value bigint")
    return priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top_terms: int = TOP_TERMS,
    span: int = SPAN,
    left: int = LEFT,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far a source's term shares are from others of its language.

    A language keeps the terms that ``min_docs`` of its documents have; p = 1 + floor(UNIT * (count + 1) /
    (all counts + number of terms)), a difference costs floor((p - q)^2 / q), all in whole numbers. Part ``pair``: each other
    source, over all kept terms. Part ``term``: the ``top_terms`` kept terms that the source has more of than its language.

    A language's terms are dealt by hash into blocks, numbered inside a block by falling frequency, so rare terms make
    equal subtrees. A task has one block of all sources at a time (fewer terms a block where there are many sources; the
    sources on the left are dealt to several tasks beyond ``left``) and adds up its blocks before it hands on a row a pair.

    Null language, source and text read as ''. Repeated rows are documents of their own. Groups without terms are compared
    like others; without any kept term all values are 0. Texts of any length are read in portions. An empty table
    gives no rows. Other columns are not read.
    """
    counts = cut_lineage(term_counts(docs, lang_col, source_col, text_col))
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all_n"))
    kept = cut_lineage(kept.where(F.col("docs") >= min_docs).select("lang", "term", "all_n"))
    sources = cut_lineage(counts.where("term is null").select("lang", "source"))
    langs = sources.groupBy("lang").agg(F.count("*").alias("n_sources")).join(
        kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("lang_total")), "lang", "left"
    )
    langs = langs.fillna(0, ["terms", "lang_total"])
    width = F.greatest(F.lit(16), F.least(F.lit(span), F.floor(F.lit(CELLS) / F.col("n_sources"))))
    langs = cut_lineage(langs.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("terms") / width))))

    numbered = kept.join(langs.select("lang", "terms", "lang_total", "blocks"), "lang")
    numbered = numbered.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    inside = Window.partitionBy("lang", "block").orderBy(F.desc("all_n"), "term")
    numbered = numbered.withColumn("at", F.row_number().over(inside).cast("bigint") - 1)
    cells = cut_lineage(counts.where("n > 0").select("lang", "source", "term", "n").join(numbered, ["lang", "term"]))

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = sources.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
    groups = groups.withColumn("parts", F.ceil(F.col("n_sources") / F.lit(left)))
    groups = cut_lineage(groups.withColumn("part", F.pmod(F.xxhash64("source"), F.col("parts"))))
    every_block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    none = F.lit(0).cast("bigint")
    heads = groups.select(
        "lang", every_block.alias("block"), "source", F.lit(-1).cast("bigint").alias("at"), none.alias("n"), "total", "terms", "part", "parts"
    )
    parts = langs.select("lang", F.ceil(F.col("n_sources") / F.lit(left)).alias("parts"))
    inner = cells.join(parts, "lang").select(
        "lang", "block", "source", "at", "n", none.alias("total"), "terms", none.alias("part"), "parts"
    )
    dealt = heads.unionByName(inner).withColumn("left", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    pairs = pair_values(dealt.drop("parts"))

    p = share(F.col("n"), F.col("total"), F.col("terms"))
    q = share(F.col("all_n"), F.col("lang_total"), F.col("terms"))
    known = cells.join(groups.select("lang", "source", "total"), ["lang", "source"])
    known = known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    terms = known.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top_terms))
