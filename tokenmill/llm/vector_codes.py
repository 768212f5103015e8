"""Vector codes: integer codebooks by rounds of assignment, entries found by equal-average search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tokenmill.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024

#: Vectors of like sums that search together, and entries that they look at in one step.
TILE, STEP = 256, 16


def nearest_entries(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of each row's nearest entry, ties to the lower index; whole numbers, exact.

    Equal-average search: (sum(x) - sum(c))^2 <= m |x - c|^2 for vectors of m components. Entries are
    sorted by their sum; a tile of rows of like sums starts at its own and goes outward to both sides.
    A side ends for a row where the squared gap of sums strictly exceeds m times its best distance.
    """
    m, total = x.shape[1], book.sum(axis=1)
    order = np.lexsort((np.arange(len(book)), total))
    sums, limit = total[order], (1 << 62) // max(m, 1)
    widest = max((int(np.abs(a).max()) for a in (x, book) if a.size), default=0)
    kind = np.float64 if max(m, 1) * (2 * widest) ** 2 < 1 << 53 else np.int64  # both exact here
    entries, rows = book[order].astype(kind), x.astype(kind)
    squares, own_squares, own = (entries**2).sum(axis=1), (rows**2).sum(axis=1), x.sum(axis=1)
    index, best = np.zeros(len(x), np.int64), np.full(len(x), limit)
    by_sum = np.argsort(own, kind="stable")
    for at in range(0, len(x), TILE):
        tile = by_sum[at : at + TILE]
        low = high = int(np.searchsorted(sums, own[tile[len(tile) // 2]]))
        left, right = tile, tile
        while len(left) or len(right):
            if low == 0:
                left = tile[:0]
            if high == len(sums):
                right = tile[:0]
            sides = []
            if len(left):
                gap = np.maximum(own[left] - sums[low - 1], 0)
                left = left[gap * gap <= best[left] * m]
                sides.append((left, max(0, low - STEP), low))
                low = max(0, low - STEP)
            if len(right):
                gap = np.maximum(sums[high] - own[right], 0)
                right = right[gap * gap <= best[right] * m]
                sides.append((right, high, min(len(sums), high + STEP)))
                high = min(len(sums), high + STEP)
            for active, a, b in sides:
                if len(active):
                    apart = own_squares[active][:, None] - 2 * (rows[active] @ entries[a:b].T) + squares[a:b]
                    least = apart.min(axis=1)
                    first = np.where(apart == least[:, None], order[a:b], len(book)).min(axis=1)
                    least = least.astype(np.int64)
                    closer = (least < best[active]) | ((least == best[active]) & (first < index[active]))
                    best[active[closer]], index[active[closer]] = least[closer], first[closer]
    return index, best


def whole_components(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def matrix(column: pa.ListArray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of this length as a matrix, and a mask of the rows that have it."""
    fits = pc.equal(pc.list_value_length(column), length).to_numpy(zero_copy_only=False)
    values = pc.list_flatten(column.filter(pa.array(fits))).to_numpy(zero_copy_only=False)
    return values.astype(np.int64).reshape(int(fits.sum()), max(length, 0)), fits


def halves(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """The matrix cut into ``parts`` equal consecutive parts."""
    m = x.shape[1] // parts
    return [np.ascontiguousarray(x[:, p * m : (p + 1) * m]) for p in range(parts)]


def cluster_sums(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(slot, total): for each part and entry the components' sums over the parts nearest to it, and their number.

    A slot is (part * entries + entry) * (m + 1) + component, the last one the number. Tasks add up first, so a
    task gives parts * entries * (m + 1) rows at most.
    """
    parts, (entries, m) = len(books), books[0].shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts, entries, m + 1), np.int64)
        for batch in batches:
            x, _ = matrix(batch.column(0), parts * m)
            for p, part in enumerate(halves(x, parts)):
                index, _ = nearest_entries(part, books[p])
                by = np.argsort(index, kind="stable")
                starts = np.flatnonzero(np.diff(index[by], prepend=-1))
                counted = np.column_stack([part, np.ones(len(part), np.int64)])
                if len(starts):
                    sums[p][index[by][starts]] += np.add.reduceat(counted[by], starts)
        used = np.flatnonzero(np.repeat(sums[:, :, m] > 0, m + 1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums.ravel()[used])], names=["slot", "value"])

    added = vectors.select("_vector").mapInArrow(add, "slot bigint, value bigint")
    return added.groupBy("slot").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("total"))


def moved(books: list[np.ndarray], sums: pa.Table) -> list[np.ndarray]:
    """Entries become the floor of their parts' mean; unused ones stay."""
    entries, m = books[0].shape
    total = {slot: int(value) for slot, value in zip(*(sums.column(c).to_pylist() for c in ("slot", "total")))}
    made = [book.copy() for book in books]
    for p, book in enumerate(made):
        for e in range(entries):
            base = (p * entries + e) * (m + 1)
            if base + m in total:
                book[e] = [total[base + i] // total[base + m] for i in range(m)]
    return made


def assigned(vectors: DataFrame, books: list[np.ndarray], length: int) -> DataFrame:
    """``vectors`` with ``code`` (entries in part order) and ``error`` in place of the vector."""
    carried = [f for f in vectors.schema.fields if f.name != "_vector"]
    schema = T.StructType(list(carried)).add("code", T.ArrayType(T.IntegerType())).add("error", T.LongType())
    arrow, parts = to_arrow_schema(schema), max(1, len(books))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fits = matrix(batch.column(len(carried)), length if books else -1)
            index, error = np.zeros((len(x), parts), np.int32), np.zeros(len(x), np.int64)
            for p, part in enumerate(halves(x, parts) if books else []):
                index[:, p], far = nearest_entries(part, books[p])
                error += far
            lengths = np.where(fits, parts, 0)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32))
            code = pa.ListArray.from_arrays(offsets, pa.array(index.ravel()), mask=pa.array(~fits))
            errors = np.zeros(len(fits), np.int64)
            errors[fits] = error
            columns = [batch.column(i).cast(arrow.field(i).type) for i in range(len(carried))]
            yield pa.RecordBatch.from_arrays([*columns, code, pa.array(errors, mask=~fits)], schema=arrow)

    return vectors.select(*(f"`{f.name}`" for f in carried), "_vector").mapInArrow(run, schema)


def vector_codes(
    vectors: DataFrame,
    keep: tuple[str, ...] = (),
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, list[np.ndarray]]:
    """((id, kept columns, code, error), codebooks): ``code`` has the nearest entry of each part, ``error`` their squared distances.

    Components become floor(scale * x). The codebooks start as the parts of the vectors of the
    ``entries`` smallest ids (ties by the vectors, null ids last; fewer vectors make fewer entries);
    a round assigns all parts and moves each used entry to the floor of its parts' mean. Every pass covers all
    rows; a task sends sums only, and what comes to the driver has parts * entries * (m + 1) rows.

    Rows whose vector is null or holds a null or non-finite component go. A vector of another length
    than that of the smallest id, or of one that ``parts`` does not divide, keeps its row with null code and error; empty
    vectors have code 0 everywhere and error 0. Repeated rows stay and count again; an empty table gives no rows and no
    codebooks. Components must leave room for exact squares in 64 bits (ValueError beyond; some 65,000 for parts of 16).
    """
    x = F.col(f"`{vector_col}`")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    columns = [F.col(f"`{c}`") for c in dict.fromkeys([id_col, *keep])]
    rows = vectors.where(x.isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = cut_lineage(rows.select(*columns, whole_components(x, scale).alias("_vector")))
    ordered = [F.col(f"`{id_col}`").asc_nulls_last(), F.col("_vector")]
    widest = rows.agg(F.max(F.array_max(F.transform("_vector", F.abs)))).first()[0] or 0
    first = rows.orderBy(*ordered).select(F.size("_vector")).first()
    length = first[0] if first else 0
    m = length // parts
    if not first or length % parts:
        return assigned(rows, [], length), []
    if (max(m, 1) * 2 * widest) ** 2 >= 1 << 62 or length * (2 * widest) ** 2 >= 1 << 63:
        raise ValueError(f"components up to {widest / scale} are too large for exact 64-bit distances")
    start = rows.where(F.size("_vector") == length).orderBy(*ordered).limit(entries).select("_vector").collect()
    books = halves(np.array([r[0] for r in start], np.int64).reshape(len(start), length), parts)
    for _ in range(rounds):
        books = moved(books, cluster_sums(rows, books).toArrow())
    return assigned(rows, books, length), books
