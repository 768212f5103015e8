"""Exact order over data that no single task could sort.

Three tools, all for non-null integer order keys:

``kth_key``   the key at a given rank. A split, a head or a capped sample then is a plain
              comparison with that key: no shuffle, and it reaches the Parquet scan.
``running``   per row, an aggregate over all earlier rows of its group. Groups too large for
              one task are cut into key ranges; per-range aggregates carry over the cuts.
``positions`` 0-based ranks, by ``running``.

The driver gets one histogram per refinement, a few cells for each segment; large groups are a table.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill import constants as C
from tokenmill.session import cut_lineage

HISTOGRAM_BINS = 4096
LEAF_ROWS = 100_000  # rows one task may sort to pick a key
ROWS_PER_SEGMENT = 1_000_000  # rows one task may hold in order
ROWS_PER_CUT = 128  # below this, cutting for parallelism does not pay
BROADCAST_GROUPS = 100_000

SEGMENT = "_segment"
SHUFFLE_KEY_LIMIT = 16**15
SHUFFLE_KEY_RANGE = (0, SHUFFLE_KEY_LIMIT - 1)  # shuffle keys lie evenly in it


# ---- shuffle keys -------------------------------------------------------------------


def shuffle_keys(stage: str, row_id: Column, seed: int = C.SEED) -> tuple[Column, Column]:
    """Two integers whose order is the order of md5(seed:stage:id): a seeded shuffle.

    They are the first and the next 15 hex digits, 120 bits in all, so ids do not tie.
    """
    digest = _shuffle_digest(stage, row_id, seed)
    return _hex_number(F.substring(digest, 1, 15)), _hex_number(F.substring(digest, 16, 15))


def shuffled_before(stage: str, row_id: Column, key: tuple | None, seed: int = C.SEED) -> Column:
    """Whether an id comes before ``key`` in shuffled order: ``precedes`` at one hash per row."""
    if key is None:
        return F.lit(True)
    return _shuffle_digest(stage, row_id, seed) < F.lit("".join(f"{part:015x}" for part in key))


def _shuffle_digest(stage: str, row_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{stage}:"), row_id.cast("string")))


def _hex_number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


# ---- selection ----------------------------------------------------------------------


def kth_key(
    df: DataFrame,
    keys: Sequence[str],
    k: int | Callable[[int], int],
    leaf_rows: int = LEAF_ROWS,
    key_range: tuple[int, int] | None = None,
) -> tuple | None:
    """The key tuple at 0-based rank ``k`` of the order by ``keys``; None past the end.

    Exactly ``k`` rows precede it (see ``precedes``); ``k`` may be a function of the row count,
    which is known here anyway. Each pass counts rows in equal ranges of the leading key and
    goes on within the range that holds the rank. A known ``key_range`` of the first key saves
    the pass that looks for it.
    """
    scope = df.select(*keys)
    for key in keys:
        low, high, rows = _extent(scope, key, key_range if key == keys[0] else None)
        if callable(k):
            k = k(rows)
        if k >= rows:
            return None
        while rows > leaf_rows and low < high:
            width = (high - low) // HISTOGRAM_BINS + 1
            bins = scope.groupBy(_bin(key, low, width).alias("bin")).count().orderBy("bin").collect()
            for found in bins:
                if k < found["count"]:
                    break
                k -= found["count"]
            low, high = low + found["bin"] * width, min(high, low + (found["bin"] + 1) * width - 1)
            rows = found["count"]
            scope = scope.where(F.col(key).between(low, high))
        if rows <= leaf_rows:
            return tuple(scope.orderBy(*keys).offset(k).limit(1).first())
    raise ValueError(f"order key {list(keys)} repeats too often to rank its rows")


def _extent(df: DataFrame, key: str, key_range: tuple[int, int] | None = None) -> tuple:
    """Lowest key, highest key and row count."""
    if key_range is not None:
        return *key_range, df.count()
    return tuple(df.agg(F.min(key), F.max(key), F.count(F.lit(1))).first())


def _bin(key: str, low: int, width: int) -> Column:
    return F.expr(f"(`{key}` - ({low}L)) div {width}L")


def precedes(columns: Sequence[Column], key: tuple | None) -> Column:
    """Whether a row comes before ``key``; all rows do when it is None."""
    if key is None:
        return F.lit(True)
    first, value = columns[0], F.lit(key[0]).cast("bigint")
    if len(key) == 1:
        return first < value
    return (first < value) | ((first == value) & precedes(columns[1:], key[1:]))


# ---- segments -----------------------------------------------------------------------


def segment_cuts(
    df: DataFrame,
    key: str,
    rows_per_segment: int,
    min_segments: int = 1,
    even_range: tuple[int, int] | None = None,
) -> tuple[int, list[int]]:
    """Lowest key and the ascending cuts (relative to it) that split ``df`` into key ranges
    of about equal row counts. Only a single key value that repeats can exceed the size.

    Keys that are spread evenly over ``even_range``, as shuffle keys of unique ids are, need
    no histogram.
    """
    low, high, rows = _extent(df, key, even_range)
    if not rows:
        return 0, []
    segments = max(math.ceil(rows / rows_per_segment), min(min_segments, rows // ROWS_PER_CUT))
    if segments <= 1 or low == high:
        return low, []
    if even_range is not None:
        return low, [(high - low + 1) * i // segments for i in range(1, segments)]
    size = math.ceil(rows / segments)
    offset = F.col(key) - F.lit(low)
    shift = max((high - low).bit_length() - max(HISTOGRAM_BINS, 4 * segments).bit_length(), 0)
    counts = _histogram(df, F.shiftright(offset, shift))
    cells = [(bin_ << shift, count) for bin_, count in counts.items()]
    while shift:  # crowded ranges: count again, 16 times finer
        crowded = [bin_ for bin_, count in counts.items() if count > size]
        if not crowded:
            break
        finer = max(shift - 4, 0)
        inside = df.where(F.shiftright(offset, shift).isin(crowded))
        dropped = {bin_ << shift for bin_ in crowded}
        counts = _histogram(inside, F.shiftright(offset, finer))
        cells = [cell for cell in cells if cell[0] not in dropped]
        cells += [(bin_ << finer, count) for bin_, count in counts.items()]
        shift = finer
    cuts, filled = [], 0
    for start, count in sorted(cells):
        if filled and filled + count > size:
            cuts.append(start)
            filled = 0
        filled += count
    return low, cuts


def _histogram(df: DataFrame, cell: Column) -> dict[int, int]:
    """Rows per cell. At most a few cells per segment, so a few megabytes for the driver."""
    cells = df.groupBy(cell.alias("cell")).count().toArrow()
    return dict(zip(cells["cell"].to_pylist(), cells["count"].to_pylist(), strict=True))


def _assign(df: DataFrame, key: str, low: int, cuts: list[int]) -> DataFrame:
    """Adds the segment number of each row by binary search over the cuts."""
    edges = sorted({float(cut) for cut in cuts})
    finder = Bucketizer(
        splits=[-math.inf, *edges, math.inf], inputCol="_offset", outputCol="_range", handleInvalid="error"
    )
    shifted = df.withColumn("_offset", (F.col(key) - F.lit(low)).cast("double"))
    found = finder.transform(shifted)
    return found.withColumn(SEGMENT, F.col("_range").cast("int")).drop("_offset", "_range")


def add_segments(
    df: DataFrame,
    key: str,
    group: Sequence[str] = (),
    few_groups: bool = True,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    min_segments: int = 1,
    even_range: tuple[int, int] | None = None,
) -> tuple[DataFrame, int]:
    """``df`` with a segment column, and the number of segments.

    ``few_groups``: all rows are cut by key range. Otherwise only groups that exceed what
    one task may hold are cut; the rest stay whole in segment 0. ``min_segments`` asks for
    more cuts than size demands, to spread heavy rows.
    """
    keys = df.select(*group, key)
    if few_groups:
        low, cuts = segment_cuts(keys, key, rows_per_segment, min_segments, even_range)
        if not cuts:
            return df.withColumn(SEGMENT, F.lit(0)), 1
        return _assign(df, key, low, cuts), len(cuts) + 1

    if keys.count() <= rows_per_segment:
        return df.withColumn(SEGMENT, F.lit(0)), 1
    names = [f"_hot_{name}" for name in group]
    hot = keys.groupBy(*group).count().where(F.col("count") > rows_per_segment).drop("count")
    # a table, however many there are; it is counted before it may be broadcast
    hot = cut_lineage(hot.toDF(*names).withColumn("_hot", F.lit(True)))
    n_hot = hot.count()
    if not n_hot:
        return df.withColumn(SEGMENT, F.lit(0)), 1
    listed = F.broadcast(hot) if n_hot <= BROADCAST_GROUPS else hot
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)]
    low, cuts = segment_cuts(keys.join(listed, same, "left_semi"), key, rows_per_segment, 1)
    if not cuts:
        return df.withColumn(SEGMENT, F.lit(0)), 1
    marked = _assign(df.join(listed, same, "left"), key, low, cuts)
    segment = F.when(F.col("_hot"), F.col(SEGMENT)).otherwise(F.lit(0))
    return marked.withColumn(SEGMENT, segment).drop("_hot", *names), len(cuts) + 1


# ---- running aggregates -------------------------------------------------------------


@dataclass(frozen=True)
class Running:
    """One aggregate over earlier rows: kind is sum, count, min, last or total.

    ``total`` is the sum over the whole group, earlier or not.
    """

    name: str
    kind: str
    value: Column | None = None


def running(
    df: DataFrame,
    order: Sequence[str],
    measures: Sequence[Running],
    group: Sequence[str] = (),
    few_groups: bool = True,
    rows_per_segment: int = ROWS_PER_SEGMENT,
    min_segments: int = 1,
    even_range: tuple[int, int] | None = None,
    keep_segments: bool = False,
) -> DataFrame:
    """Adds each measure over the rows before this one, in its group, by ``order``.

    ``order[0]`` is the integer key that segments are cut by. The rows pass through one
    shuffle by (group, segment); the carry table has one row per group and segment.
    """
    cut, segments = add_segments(df, order[0], group, few_groups, rows_per_segment, min_segments, even_range)
    # a struct compares as equal where its nulls agree, so null groups keep their carry
    members = F.struct(*[F.col(g) for g in group]) if group else F.struct(F.lit(0).alias("all"))
    cut = cut.withColumn("_group", members)
    parts = ["_group", SEGMENT]
    several = segments > 1
    if segments > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        cut = cut.repartition(segments, *parts)  # segments are sized for one task each
    whole = Window.partitionBy(*parts)
    before = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    local = cut
    for m in measures:
        over = whole if m.kind == "total" else before
        local = local.withColumn(m.name, _local(m).over(over))
    if several:
        carried = cut.groupBy(*parts).agg(*[_per_segment(m, order) for m in measures])
        earlier = Window.partitionBy("_group").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
        everywhere = Window.partitionBy("_group")
        carry = carried.select(
            *parts,
            *[
                _carry(m).over(everywhere if m.kind == "total" else earlier).alias(f"_carry_{m.name}")
                for m in measures
            ],
        )
        local = local.join(carry, parts, "left")
    for m in measures:
        carried_value = F.col(f"_carry_{m.name}") if several else None
        local = local.withColumn(m.name, _combine(m, F.col(m.name), carried_value))
    dropped = [f"_carry_{m.name}" for m in measures] if several else []
    return local.drop(*dropped, *([] if keep_segments else parts))


def positions(df: DataFrame, order: Sequence[str], name: str = "pos", **options) -> DataFrame:
    """0-based rank of each row by ``order``, within ``group`` if one is given."""
    return running(df, order, [Running(name, "count")], **options)


def _local(m: Running) -> Column:
    if m.kind == "count":
        return F.count(F.lit(1))
    if m.kind in ("sum", "total"):
        return F.sum(m.value)
    if m.kind == "min":
        return F.min(m.value)
    return F.last(F.struct(m.value.alias("value")))


def _per_segment(m: Running, order: Sequence[str]) -> Column:
    if m.kind == "last":
        by = F.struct(*[F.col(o) for o in order])
        return F.max_by(F.struct(m.value.alias("value")), by).alias(m.name)
    return _local(m).alias(m.name)


def _carry(m: Running) -> Column:
    if m.kind == "min":
        return F.min(m.name)
    if m.kind == "last":
        return F.last(m.name)
    return F.sum(m.name)


def _combine(m: Running, local: Column, carry: Column | None) -> Column:
    if m.kind == "total":
        return local if carry is None else carry
    if m.kind in ("sum", "count"):
        total = F.coalesce(local, F.lit(0))
        return total if carry is None else total + F.coalesce(carry, F.lit(0))
    if m.kind == "min":
        return local if carry is None else F.least(local, carry)
    return (local if carry is None else F.coalesce(local, carry))["value"]
