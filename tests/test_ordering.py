import random

import pytest
from pyspark.sql import functions as F

from tokenmill.operators import ordering, sampling
from tokenmill.operators.ordering import Running, kth_key, positions, precedes, running, segment_cuts


def _frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(5)


@pytest.mark.parametrize("k", [0, 1, 777, 1499, 1999])
def test_kth_key_is_exact_on_clustered_keys(spark, k):
    rng = random.Random(k)
    keys = sorted({rng.randrange(10) for _ in range(10)} | {10**12 + i for i in range(2000)})[:2000]
    df = _frame(spark, [(x,) for x in keys], "id bigint")
    border = kth_key(df, ["id"], k, leaf_rows=3)
    assert border == (keys[k],)
    assert df.where(precedes([F.col("id")], border)).count() == k


def test_kth_key_past_the_end(spark):
    df = _frame(spark, [(1,), (2,)], "id bigint")
    assert kth_key(df, ["id"], 2) is None
    assert df.where(precedes([F.col("id")], None)).count() == 2


def test_kth_key_goes_on_to_the_next_key_where_one_value_repeats(spark):
    rows = [(7, i) for i in range(300)] + [(i, 0) for i in range(7)] + [(8 + i, 0) for i in range(100)]
    df = _frame(spark, rows, "a bigint, b bigint")
    border = kth_key(df, ["a", "b"], 150, leaf_rows=10)
    assert border == sorted(rows)[150]
    assert df.where(precedes([F.col("a"), F.col("b")], border)).count() == 150


def test_kth_key_refuses_rows_it_cannot_tell_apart(spark):
    df = _frame(spark, [(7,)] * 50, "a bigint")
    with pytest.raises(ValueError):
        kth_key(df, ["a"], 20, leaf_rows=10)


def test_negative_keys(spark):
    keys = list(range(-500, 500))
    df = _frame(spark, [(x,) for x in keys], "id bigint")
    assert kth_key(df, ["id"], 250, leaf_rows=5) == (-250,)
    assert positions(df, ["id"], rows_per_segment=50).where("pos <> id + 500").count() == 0


def test_segments_stay_small_when_keys_crowd(spark):
    keys = list(range(5000)) + [10**15 + 10**9 * i for i in range(2500)]
    df = _frame(spark, [(x,) for x in keys], "id bigint")
    low, cuts = segment_cuts(df, "id", 100, 1)
    cut, segments = ordering.add_segments(df, "id", rows_per_segment=100)
    assert segments == len(cuts) + 1 > 50 and cuts == sorted(set(cuts))
    sizes = [r["count"] for r in cut.groupBy(ordering.SEGMENT).count().collect()]
    assert sum(sizes) == len(keys) and max(sizes) <= 200


def _expected(rows):
    out = {}
    for group in {r[0] for r in rows}:
        past, low, last, total = [], None, None, sum(r[2] for r in rows if r[0] == group)
        for g, at, value in sorted((r for r in rows if r[0] == group), key=lambda r: r[1]):
            out[(g, at)] = (len(past), sum(past), low, last, total)
            past.append(value)
            low = value if low is None else min(low, value)
            last = value
    return out


@pytest.mark.parametrize("few_groups", [True, False])
@pytest.mark.parametrize("rows_per_segment", [40, 1_000_000])
def test_running_equals_brute_force_with_a_hot_group(spark, few_groups, rows_per_segment):
    rng = random.Random(5)
    rows = [(rng.choice([None, None, *range(60)]), i, rng.randrange(1000)) for i in range(900)]
    rows += [(77, 10_000 + 3 * i, rng.randrange(1000)) for i in range(450)]  # a third in one group
    df = _frame(spark, rows, "g bigint, at bigint, v bigint")
    v = F.col("v")
    measures = [
        Running("n", "count"),
        Running("s", "sum", v),
        Running("lo", "min", v),
        Running("la", "last", v),
        Running("t", "total", v),
    ]
    got = running(df, ["at"], measures, ["g"], few_groups=few_groups, rows_per_segment=rows_per_segment)
    assert got.columns == ["g", "at", "v", "n", "s", "lo", "la", "t"]
    found = {(r.g, r.at): (r.n, r.s, r.lo, r.la, r.t) for r in got.collect()}
    assert found == _expected(rows)


def test_only_hot_groups_are_cut(spark):
    rows = [(1, i) for i in range(400)] + [(i, i) for i in range(2, 202)]
    df = _frame(spark, rows, "g bigint, at bigint")
    cut, segments = ordering.add_segments(df, "at", ["g"], few_groups=False, rows_per_segment=50)
    per_group = {r["g"]: r["n"] for r in cut.groupBy("g").agg(F.countDistinct(ordering.SEGMENT).alias("n")).collect()}
    assert segments >= 8 and per_group.pop(1) >= 8
    assert set(per_group.values()) == {1}


def test_last_keeps_a_null_value_apart_from_no_row(spark):
    rows = [(1, i, None if i % 3 == 0 else i) for i in range(300)]
    df = _frame(spark, rows, "g bigint, at bigint, v bigint")
    got = running(df, ["at"], [Running("p", "last", F.col("v"))], ["g"], rows_per_segment=20)
    found = {r.at: r.p for r in got.collect()}
    assert found == {i: (None if i == 0 or (i - 1) % 3 == 0 else i - 1) for i in range(300)}


@pytest.mark.parametrize("partitions", ["1", "4", "16"])
def test_positions_do_not_depend_on_partitioning(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        df = spark.range(3000).repartition(int(partitions)).select((F.col("id") * 17).alias("id"))
        assert positions(df, ["id"], rows_per_segment=100).where("pos * 17 <> id").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_even_keys_need_no_histogram(spark):
    ids = spark.range(4000).withColumnRenamed("id", "n")
    keyed = sampling.keyed(ids, "n", "stage")
    border = kth_key(keyed, sampling.KEYS, 1000, leaf_rows=50, key_range=ordering.SHUFFLE_KEY_RANGE)
    ordered = [tuple(r) for r in keyed.orderBy(*sampling.KEYS).select(*sampling.KEYS, "n").collect()]
    assert border == ordered[1000][:2]
    ranks = positions(keyed, sampling.KEYS, rows_per_segment=150, even_range=ordering.SHUFFLE_KEY_RANGE)
    assert {r.n: r.pos for r in ranks.collect()} == {n: i for i, (_, _, n) in enumerate(ordered)}
    cut, segments = ordering.add_segments(
        keyed, "_k1", rows_per_segment=150, even_range=ordering.SHUFFLE_KEY_RANGE
    )
    sizes = [r["count"] for r in cut.groupBy(ordering.SEGMENT).count().collect()]
    assert segments == len(sizes) == 27 and max(sizes) < 220
