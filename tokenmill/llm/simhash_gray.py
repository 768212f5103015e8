"""SimHash near-duplicates: fingerprints in Gray order under nodes that hold the bits they share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import connected_components, map_texts
from tokenmill.session import cut_lineage

BITS = 64
SHINGLE, MAX_BITS = 4, 4

#: Fingerprints under one upper node at most; beyond it the node is divided. Dividing costs a fingerprint
#: (d + 1)^2 rows (some 240 microseconds at 10 bits), comparing within a node of this size about as much.
NODE_SIZE = 32_768
#: Fingerprints in a leaf, and leaves under a node inside a task.
LEAF = 32


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fp): bit i is 1 if more than half of the word shingles' XXH64 (seed 42) have it.

    Words are lower-cased in A-Z and divided at ASCII white space; repeated shingles count again. A
    text of fewer words is one shingle, one without words (null, empty) has fingerprint 0.
    """

    def setup():
        hashes_of = shingle_hasher(shingle)

        def fingerprint(text: str) -> tuple[int]:
            hashes = hashes_of(text)
            return (0,) if hashes is None else (majority(hashes),)

        return fingerprint

    return map_texts(docs, id_col, text_col, "fp bigint", setup)


def shingle_hasher(shingle: int) -> Callable[[str], np.ndarray | None]:
    """A function that gives the XXH64 (seed 42) of a text's word shingles in their order, None without words."""
    import xxhash

    spaced = re.compile(rb"[^\x20\x09-\x0D]+")
    hashed = xxhash.xxh64_intdigest

    def hashes_of(text: str) -> np.ndarray | None:
        words = spaced.findall(text.encode().lower())
        if not words:
            return None
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        last = ends[min(shingle, len(words)) - 1 :].tolist()
        return np.fromiter((hashed(joined[a:b], 42) for a, b in zip(starts.tolist(), last)), np.uint64, len(last))

    return hashes_of


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of shingle hashes, as a signed number."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")
    return value - (1 << BITS) if value >> (BITS - 1) else value


def blocks(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` in ``parts`` runs of nearly equal length."""
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:])]


def pattern(fp: Column, bits: list[int]) -> Column:
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << BITS) if mask >> (BITS - 1) else mask))


def upper_nodes(fps: DataFrame, max_bits: int, node_size: int) -> DataFrame:
    """(node, fp): nodes of at most ``node_size`` fingerprints that bring every linked pair together.

    Two fingerprints with at most d differing bits agree in one of d + 1 blocks of bits. A node holds
    those that share a block's masked pattern. A larger node is divided: the bits outside its
    block differ in d places at most, so they are cut into d + 1 blocks again. What is still
    larger is dealt by hash into chunks, and every two chunks meet in a node of their own. Hashed
    node names that collide only bring more together; distances are checked below.
    """
    parts = max_bits + 1
    first = blocks(list(range(BITS)), parts)
    level1 = F.array(*(F.struct(F.lit(j).alias("j"), pattern(F.col("fp"), b).alias("p")) for j, b in enumerate(first)))
    rows = fps.select("fp", F.explode(level1).alias("n")).select("fp", "n.j", F.xxhash64("n.j", "n.p").alias("node"))
    rows = with_size(rows)
    small = rows.where(F.col("size").between(2, node_size)).select("node", "fp")

    def inner(j: int) -> Column:
        rest = [b for k, block in enumerate(first) if k != j for b in block]
        return F.array(*(F.xxhash64("node", F.lit(i), pattern(F.col("fp"), b)) for i, b in enumerate(blocks(rest, parts))))

    chosen = reduce(lambda c, j: c.when(F.col("j") == j, inner(j)), range(1, parts), F.when(F.col("j") == 0, inner(0)))
    deeper = with_size(
        rows.where(F.col("size") > node_size).select("fp", F.explode(chosen).alias("node"))
    )
    middle = deeper.where(F.col("size").between(2, node_size)).select("node", "fp")

    chunks = F.ceil(F.col("size") * 2 / F.lit(node_size))
    own = F.pmod(F.xxhash64("fp"), chunks)
    crowded = deeper.where(F.col("size") > node_size).select("node", "fp", own.alias("own"), chunks.alias("chunks"))
    paired = crowded.select(
        "node", "fp", "own", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("other")
    ).select(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")).alias("node"), "fp")
    return small.unionByName(middle).unionByName(paired)


def with_size(rows: DataFrame) -> DataFrame:
    """Node sizes are counted in tasks first; as a table of their own, so that the join may split a large node."""
    return rows.join(cut_lineage(rows.groupBy("node").agg(F.count("*").alias("size"))), "node")


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(values: np.ndarray, groups: np.ndarray, masks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For runs that begin at ``groups``: mask of the bits that all have in common, and their pattern."""
    ones = np.bitwise_and.reduceat(values if masks is None else values & masks, groups)
    zeros = np.bitwise_and.reduceat(~values if masks is None else ~values & masks, groups)
    return ones | zeros, ones


def near_pairs(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """All pairs of distinct uint64 fingerprints within ``max_bits``, in portions (u, v, bits), u < v as indices.

    Sorted by Gray rank, runs of ``LEAF`` make leaves and runs of leaves make nodes, each with the
    masked pattern of its shared bits. Two nodes whose patterns differ in more than ``max_bits``
    bits that both fix have no link below; the others are opened.
    """
    order = np.argsort(gray_rank(values), kind="stable")
    fp = values[order]
    levels = [shared_bits(fp, np.arange(0, len(fp), LEAF))]
    while len(levels[-1][0]) > LEAF:
        mask, ones = levels[-1]
        levels.append(shared_bits(ones, np.arange(0, len(mask), LEAF), mask))

    def near(level, a, b):
        mask, ones = levels[level]
        return np.bitwise_count((ones[a] ^ ones[b]) & mask[a] & mask[b]) <= max_bits

    top = len(levels) - 1
    a, b = np.triu_indices(len(levels[top][0]))
    keep = near(top, a, b)
    a, b = a[keep], b[keep]
    step = np.arange(LEAF)
    for level in range(top - 1, -1, -1):
        n, opened = len(levels[level][0]), []
        for at in range(0, len(a), 2048):
            x = (a[at : at + 2048, None, None] * LEAF + step[:, None] + 0 * step).ravel()
            y = (b[at : at + 2048, None, None] * LEAF + step + 0 * step[:, None]).ravel()
            ok = (x < n) & (y < n) & (x <= y)
            x, y = x[ok], y[ok]
            keep = near(level, x, y)
            opened.append((x[keep], y[keep]))
        a, b = (np.concatenate(side) for side in zip(*opened)) if opened else (a, b)
    padded = np.concatenate([fp, np.zeros(-len(fp) % LEAF, np.uint64)]).reshape(-1, LEAF)
    for at in range(0, len(a), 2048):
        p, q = a[at : at + 2048], b[at : at + 2048]
        bits = np.bitwise_count(padded[p][:, :, None] ^ padded[q][:, None, :])
        k, i, j = np.nonzero(bits <= max_bits)
        u, v = p[k] * LEAF + i, q[k] * LEAF + j
        ok = (u < v) & (v < len(fp))
        u, v = order[u[ok]], order[v[ok]]
        yield np.minimum(u, v), np.maximum(u, v), bits[k, i, j][ok]


def linked(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, least index that it reaches over links inside this set), where the two differ."""
    label = np.arange(len(values))
    for u, v, _ in near_pairs(values, max_bits):
        join_labels(label, u, v)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return moved, label[moved]


def nearest(values: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, nearest one among those of smaller index), where there is one within ``max_bits``."""
    best = np.full(len(values), np.iinfo(np.int64).max)
    for u, v, bits in near_pairs(values, max_bits):
        np.minimum.at(best, v, (bits.astype(np.int64) << 40) + u)
    moved = np.flatnonzero(best < np.iinfo(np.int64).max)
    return moved, best[moved] & ((1 << 40) - 1)


def join_labels(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Labels become the least reached over edges (u, v); a label labels itself."""
    while len(u):
        x, y = label[u], label[v]
        apart = x != y
        if not apart.any():
            return
        u, v, x, y = u[apart], v[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def near_links(
    fps: DataFrame, max_bits: int = MAX_BITS, node_size: int = NODE_SIZE, links: Callable = linked
) -> DataFrame:
    """(a, b) with a > b over distinct fingerprints (fp): not all links, but edges with the same connected components.

    Each node gives, for every fingerprint in it, one row at most (``links``), so a set of m near
    copies gives m - 1 rows.
    """
    nodes = upper_nodes(fps, max_bits, node_size)

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(values: np.ndarray) -> pa.RecordBatch:
            unsigned = np.unique(values.view(np.uint64))
            signed = unsigned.view(np.int64)
            moved, to = links(unsigned, max_bits)
            p, q = signed[moved], signed[to]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(p, q)), pa.array(np.minimum(p, q))], names=["a", "b"])

        name, parts = None, []
        for batch in batches:
            keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(keys)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(keys)]):
                if start == end:
                    continue
                if keys[start] != name and parts:
                    yield of(np.concatenate(parts))
                    parts = []
                name = keys[start]
                parts.append(values[start:end])
        if parts:
            yield of(np.concatenate(parts))

    return nodes.repartition("node").sortWithinPartitions("node").mapInArrow(stars, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    node_size: int = NODE_SIZE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(``id_col``, fp, component): ``component`` is the least id reachable over fingerprints of at most ``max_bits`` differing bits.

    Equal fingerprints are one node from the start, so copies cost one row each. Links are sought
    between distinct fingerprints only, component search moves pairs of numbers only, and all
    of it is joined and grouped by fingerprint, where a hot one may be split. Nothing is
    broadcast or brought to the driver.

    Null and empty texts have fingerprint 0 and are linked like any other. A row with a null id gets
    the least id of its component, null if there is none. Repeated rows stay. Other columns are
    not read.
    """
    marked = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    fps = cut_lineage(marked.groupBy("fp").agg(F.min(id_col).alias("least")))
    return classes_of(marked, fps, near_links(fps.select("fp"), max_bits, node_size), id_col)


def classes_of(marked: DataFrame, nodes: DataFrame, links: DataFrame, id_col: str, key: str = "fp") -> DataFrame:
    """(``id_col``, fp, component) from rows (id, fp, ``key``), nodes (``key``, least id) and links between them."""
    roots = connected_components(links)
    joined = nodes.join(roots.select(F.col("node").alias(key), "root"), key, "left").select(
        key, "least", F.coalesce("root", key).alias("root")
    )
    # as a table of its own, so that the join may split a large component
    least = cut_lineage(joined.groupBy("root").agg(F.min("least").alias("component")))
    classes = joined.join(least, "root").select(key, "component")
    return marked.join(classes, key).select(id_col, "fp", "component")
