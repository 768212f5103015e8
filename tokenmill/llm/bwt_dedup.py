"""Exact repeated passages: positional Burrows-Wheeler transforms of shards, merged by interleave refinement."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.session import cut_lineage

#: Bytes of a repeat that counts, and of the anchors inside it.
LENGTH, ANCHOR = 400, 200
#: Pieces in one merge, and in one shard of it. Anchors with more distinct pieces take the way for crowded ones.
MERGE_PIECES, SHARD_PIECES = 16_384, 4_096

PAD = 0xFF  # no UTF-8 text has this byte
STRETCH = 1 << 20

# fixed values: an odd multiplier and a mixing factor
FACTOR, MIX = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


class Roller:
    """Hashes of all ``width``-byte strings of a text, from one running sum of a polynomial modulo 2^64."""

    def __init__(self, width: int):
        self.width = width
        size = STRETCH + LENGTH + 1
        self.powers, self.inverse = np.ones(size, np.uint64), np.ones(size, np.uint64)
        self.powers[1:], self.inverse[1:] = FACTOR, pow(FACTOR, -1, 1 << 64)
        self.powers = np.multiply.accumulate(self.powers)
        self.inverse = np.multiply.accumulate(self.inverse)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        n, k = len(data), self.width
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=sums[1:])
        found = (sums[k:] - sums[:-k]) * self.inverse[: n - k + 1]
        found ^= found >> np.uint64(32)
        found *= np.uint64(MIX)
        return found ^ (found >> np.uint64(32))


def anchors(data: np.ndarray, roller: Roller, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the least hash in every ``length``-byte window, the leftmost of equals.

    The choice depends on the window's bytes only, so equal windows choose equal anchors at equal
    places: two equal windows are found by their anchors.
    """
    window = length - roller.width + 1
    places, values = [], []
    for at in range(0, max(len(data) - length + 1, 0), STRETCH):
        hashes = roller.hashes(data[at : at + STRETCH + length - 1])
        m = len(hashes)
        # order by the upper 40 bits, then by place: one number for both
        keys = (hashes & np.uint64(0xFFFFFFFFFF000000)) | np.arange(m, dtype=np.uint64)
        rows = -(-m // window)
        grid = np.concatenate([keys, np.full(rows * window - m, np.uint64(2**64 - 1))]).reshape(rows, window)
        before = np.minimum.accumulate(grid, axis=1).ravel()
        after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[: m - window + 1], before[window - 1 : m]) & np.uint64(0xFFFFFF)
        chosen = least[np.concatenate(([True], least[1:] != least[:-1]))].astype(np.int64)
        places.append(chosen + at)
        values.append(hashes[chosen])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    places, values = np.concatenate(places), np.concatenate(values)
    new = np.concatenate(([True], places[1:] != places[:-1]))
    return places[new], values[new]


def cut(data: bytes, place: int, length: int, anchor: int) -> tuple[int, bytes]:
    """What windows with this anchor can hold, and how many bytes are missing on the left."""
    back = length - anchor
    return max(0, back - place), data[max(0, place - back) : place + length]


def name_of(piece: bytes, lead: int) -> int:
    """64 bits that tell apart the pieces of one anchor, itself known by 64 bits of its own."""
    named = hashlib.blake2b(piece, digest_size=8, salt=lead.to_bytes(4, "little")).digest()
    return int.from_bytes(named, "little", signed=True)


def transform(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positional transform of aligned rows: for each column, its symbols and the rows, sorted by what lies before."""
    n, width = matrix.shape
    symbols, orders = np.empty((width, n), np.uint8), np.empty((width + 1, n), np.uint16)
    order = np.arange(n)
    for c in range(width):
        orders[c] = order
        symbols[c] = matrix[order, c]
        order = order[np.argsort(symbols[c], kind="stable")]
    orders[width] = order
    return symbols, orders


def merged_repeats(shards: list[tuple[np.ndarray, np.ndarray]], length: int) -> np.ndarray:
    """For shards' transforms, (window, row): whether the window is equal in another row of any shard.

    The interleave tells from which shard each place of the merged order comes. One refinement
    step takes the next symbols of each shard in its own order and moves the interleave by a
    stable sort of these symbols; the shards' rows are not sorted again. With it goes, for each
    place, the column from which it agrees with the place before it: the maximum over what a
    step skips. Runs that agree for ``length`` columns are the repeated intervals.
    """
    sizes = [symbols.shape[1] for symbols, _ in shards]
    first_row = np.concatenate(([0], np.cumsum(sizes)))
    width, n = shards[0][0].shape[0], int(first_row[-1])
    repeats = np.zeros((width - length + 1, n), bool)
    interleave = np.repeat(np.arange(len(shards)), sizes)
    agrees_from = np.zeros(n, np.int64)
    for c in range(width):
        column = np.empty(n, np.uint8)
        for s, (symbols, _) in enumerate(shards):
            column[interleave == s] = symbols[c]
        step = np.argsort(column, kind="stable")
        interleave = interleave[step]
        moved = agrees_from[step]
        jumps = np.flatnonzero(np.diff(step) != 1) + 1
        sorted_column = column[step]
        same = sorted_column[jumps] == sorted_column[jumps - 1]
        moved[jumps[~same]] = c + 1
        jumps = jumps[same]
        if len(jumps):
            spans = np.column_stack((step[jumps - 1] + 1, step[jumps] + 1)).ravel()
            moved[jumps] = np.maximum.reduceat(np.append(agrees_from, 0), spans)[::2]
        # places that follow each other directly may still differ in this symbol
        moved[1:][sorted_column[1:] != sorted_column[:-1]] = c + 1
        moved[0] = c + 1
        agrees_from = moved
        start = c + 1 - length
        if start >= 0:
            like_before = agrees_from <= start
            found = like_before | np.append(like_before[1:], False)
            rows = np.empty(n, np.int64)
            for s, (_, orders) in enumerate(shards):
                rows[interleave == s] = orders[c + 1] + first_row[s]
            repeats[start, rows[found]] = True
    return repeats


def repeated_windows(pieces: list[bytes], leads: list[int], counts: list[int], length: int, anchor: int, shard: int) -> np.ndarray:
    """(piece, window): whether the window of ``length`` bytes is whole and comes again, here or in a copy of the piece."""
    width = 2 * length - anchor
    rows = b"".join(bytes([PAD]) * lead + p + bytes([PAD]) * (width - lead - len(p)) for p, lead in zip(pieces, leads))
    matrix = np.frombuffer(rows, np.uint8).reshape(len(pieces), width)
    shards = [transform(matrix[at : at + shard]) for at in range(0, len(pieces), shard)]
    repeats = merged_repeats(shards, length).T
    start = np.arange(width - length + 1)
    lead, end = np.array(leads)[:, None], np.array([a + len(p) for a, p in zip(leads, pieces)])[:, None]
    whole = (start >= lead) & (start + length <= end)
    return whole & (repeats | (np.array(counts)[:, None] > 1))


def runs_of(flags: np.ndarray) -> list[int]:
    """Begin and end (exclusive) of each run of true values, one after the other."""
    return np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))).tolist()


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    merge_pieces: int = MERGE_PIECES,
    shard_pieces: int = SHARD_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(``id_col``, n_bytes, spans: array of (start, end) of removed UTF-8 bytes, kept: binary).

    A byte is removed if a string of ``length`` bytes around it starts anywhere else in the
    documents. Exact; matches never cross documents.

    1. Every window has an anchor chosen by its own bytes; each anchor of a text gives a piece, all
       that windows with this anchor can hold, named by a digest. Texts stay where they are.
    2. Anchors are counted, summed in tasks first; pieces whose anchor comes once are done with. The others
       are counted by digest: copies are one piece with a count from here on.
    3. One representative of each other piece is cut from its text, and pieces meet by anchor, with
       anchors in the same column. Shards of them are transformed; the transforms are merged,
       and repeated intervals are read off the merged order.
    4. An anchor with more than ``merge_pieces`` distinct pieces is not merged in one task: its
       windows are counted by digest, spread over all tasks. The result is the same.
    5. Repeated windows go back to all places of the pieces, and texts meet them by document.

    Null and empty texts have no bytes and lose none. Rows equal in id and text are copies of each
    other; all stay as rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), F.struct(F.col(id_col).alias("i"), F.xxhash64(text).alias("x")).alias("key"), text.alias("text"))
    back = length - anchor

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(anchor)
        for batch in batches:
            parents, places, names, digests = [], [], [], []
            for row, value in enumerate(batch.column(1)):
                data = value.as_py().encode()
                at, hashes = anchors(np.frombuffer(data, np.uint8), roller, length)
                parents += [row] * len(at)
                places.append(at)
                names.append(hashes)
                for place in at.tolist():
                    lead, piece = cut(data, place, length, anchor)
                    digests.append(name_of(piece, lead))
            if parents:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(parents)),
                        pa.array(np.concatenate(names).view(np.int64)),
                        pa.array(digests, pa.int64()),
                        pa.array(np.concatenate(places)),
                    ],
                    names=["key", "anchor", "digest", "place"],
                )

    key_type = keyed.schema["key"].dataType.simpleString()
    places = cut_lineage(
        keyed.select("key", "text").mapInArrow(find, f"key {key_type}, anchor bigint, digest bigint, place bigint")
    )
    # a table, so that the join reads two plain shuffles and may split a hot anchor
    repeated = cut_lineage(places.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor"))
    places = cut_lineage(places.join(repeated, "anchor"))
    pieces = places.groupBy("anchor", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "place")).alias("where")
    )
    pieces = cut_lineage(pieces)
    sizes = cut_lineage(pieces.groupBy("anchor").agg(F.count("*").alias("different")))
    again = pieces.join(sizes, "anchor")
    wanted = again.groupBy(F.col("where.key").alias("key")).agg(
        F.collect_list(F.struct("anchor", "digest", "n", "different", F.col("where.place").alias("place"))).alias("cuts")
    )

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for value, cuts in zip(batch.column(0), batch.column(1)):
                data = value.as_py().encode()
                for c in cuts.as_py():
                    made.append((c["anchor"], c["digest"], c["n"], c["different"], *cut(data, c["place"], length, anchor)))
                    if len(made) == 20_000:
                        yield sliced(made)
                        made = []
            if made:
                yield sliced(made)

    def sliced(made: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        names = ["anchor", "digest", "n", "different", "lead", "piece"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=names)

    fields = "anchor bigint, digest bigint, n bigint, different bigint, lead int, piece binary"
    cut_pieces = cut_lineage(keyed.join(wanted, "key").select("text", "cuts").mapInArrow(slices, fields))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def of(rows: list[tuple]) -> pa.RecordBatch:
            _, _, counts, leads, parts = zip(*rows)
            flags = repeated_windows(parts, leads, counts, length, anchor, shard_pieces)
            found = [(r[0], r[1], runs_of(f)) for r, f in zip(rows, flags) if f.any()]
            columns = list(zip(*found)) if found else [(), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["anchor", "digest", "runs"])

        rows: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if rows and row[:2] == rows[-1][:2]:
                    continue  # cut from several rows of equal id and text
                if len(rows) >= merge_pieces // 2 and row[0] != rows[-1][0]:
                    yield of(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield of(rows)

    columns = ("anchor", "digest", "n", "lead", "piece")
    usual = cut_pieces.where(F.col("different") <= merge_pieces).select(*columns)
    usual = usual.repartition("anchor").sortWithinPartitions("anchor", "digest")
    runs = usual.mapInArrow(merge, "anchor bigint, digest bigint, runs array<bigint>")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            for name, digest, n, lead, piece in zip(*(column.to_pylist() for column in batch.columns)):
                made = [
                    (name, digest, n, lead + s, hashlib.blake2b(piece[s : s + length], digest_size=16).digest())
                    for s in range(len(piece) - length + 1)
                ]
                if made:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["anchor", "digest", "n", "at", "window"]
                    )

    crowded = cut_pieces.where(F.col("different") > merge_pieces).select(*columns).dropDuplicates(["anchor", "digest"])
    each = crowded.mapInArrow(windows, "anchor bigint, digest bigint, n bigint, at bigint, window binary")
    twice = each.groupBy("anchor", "at", "window").agg(F.sum("n").alias("times")).where("times > 1").drop("times")
    rest = (
        each.join(twice, ["anchor", "at", "window"])
        .groupBy("anchor", "digest")
        .agg(F.flatten(F.collect_list(F.array(F.col("at"), F.col("at") + 1))).alias("runs"))
    )
    runs = cut_lineage(runs.unionByName(rest))
    removed = (
        places.join(runs, ["anchor", "digest"])
        .groupBy("key")
        .agg(F.collect_set(F.struct((F.col("place") - F.lit(back)).alias("base"), "runs")).alias("found"))
    )
    ident = docs.schema[id_col]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for value, found in zip(batch.column(1), batch.column(2)):
                data = value.as_py().encode()
                edges = np.zeros(len(data) + 1, np.int32)
                for f in found.as_py() or ():
                    for first, end in zip(f["runs"][::2], f["runs"][1::2]):
                        edges[f["base"] + first] += 1
                        edges[f["base"] + end - 1 + length] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                borders = runs_of(gone)
                sizes.append(len(data))
                spans.append([{"start": a, "end": b} for a, b in zip(borders[::2], borders[1::2])])
                kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=["id", "n_bytes", "spans", "kept"],
            )

    return (
        keyed.join(removed, "key", "left")
        .select(F.col(id_col).alias("id"), "text", "found")
        .mapInArrow(
            keep,
            f"id {ident.dataType.simpleString()}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary",
        )
        .withColumnRenamed("id", id_col)
    )
