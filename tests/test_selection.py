"""Order statistics and exact samples against brute force, with tiny
bucket counts so every refinement path runs."""

import random

import pytest
from pyspark.sql import types as T

from cardsight.operators.selection import kth_smallest
from cardsight.operators import sampling as smp


def _frame(spark, rows, vtype):
    schema = T.StructType(
        [T.StructField("g", T.IntegerType()), T.StructField("v", vtype), T.StructField("id", T.LongType())]
    )
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("num_buckets", [4, 4096])
def test_kth_smallest_integral_matches_sort(spark, num_buckets):
    rnd = random.Random(7)
    rows = [(i % 3, rnd.randrange(-(2**61), 2**61), i) for i in range(600)]
    rows += [(0, 5, 1000 + i) for i in range(40)]  # a heavy tie
    df = _frame(spark, rows, T.LongType())
    targets = [(0, 1), (0, 100), (0, 230), (1, 77), (2, 200), (2, 1), (1, 500)]
    got = kth_smallest(df, "g", "v", "id", targets, num_buckets=num_buckets)
    for g, k in targets:
        pairs = sorted((v, i) for gg, v, i in rows if gg == g)
        if k <= len(pairs):
            assert got[(g, k)] == pairs[k - 1]
        else:
            assert (g, k) not in got


def test_kth_smallest_double_with_ties(spark):
    rnd = random.Random(3)
    rows = [(0, round(rnd.random(), 3), i) for i in range(500)]
    df = _frame(spark, rows, T.DoubleType())
    targets = [(0, k) for k in (1, 17, 250, 499, 500)]
    got = kth_smallest(df, "g", "v", "id", targets, num_buckets=5)
    pairs = sorted((v, i) for _, v, i in rows)
    for _, k in targets:
        assert got[(0, k)] == pairs[k - 1]


def test_nan_and_null_are_ignored_and_infinity_refused(spark):
    rows = [(0, float(i % 9), i) for i in range(200)] + [(0, float("nan"), 300), (0, None, 301)]
    df = _frame(spark, rows, T.DoubleType())
    pairs = sorted((v, i) for _, v, i in rows[:200])
    got = kth_smallest(df, "g", "v", "id", [(0, 1), (0, 200), (0, 201)], num_buckets=4)
    assert got == {(0, 1): pairs[0], (0, 200): pairs[-1]}
    with pytest.raises(ValueError):
        kth_smallest(_frame(spark, [(0, float("inf"), 1), (0, 1.0, 2)], T.DoubleType()), "g", "v", "id", [(0, 1)])


def test_sample_per_class_is_first_k_by_seeded_order(spark):
    rows = [(i, 1 if i % 10 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, TX_FRAUD int")
    got = smp.sample_per_class(df, {0: 37, 1: 500}, seed=5)
    keyed = df.withColumn("k", smp.order_key(5)).collect()
    zeros = sorted((r["k"], r["TRANSACTION_ID"]) for r in keyed if r["TX_FRAUD"] == 0)[:37]
    ones = [r["TRANSACTION_ID"] for r in keyed if r["TX_FRAUD"] == 1]
    want = {i for _, i in zeros} | set(ones)
    assert {r["TRANSACTION_ID"] for r in got.collect()} == want


def test_undersample_balances_classes(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(700)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, TX_FRAUD int")
    counts = smp.class_count_map(smp.undersample(df))
    assert counts[0] == counts[1] == 100


def test_folds_match_contiguous_stratified_allocation(spark):
    # 23 negatives then 7 positives in id order; reference allocation by hand.
    rows = [(i, 1 if i >= 23 else 0) for i in range(30)]
    df = spark.createDataFrame(rows, "TRANSACTION_ID long, TX_FRAUD int")
    got = {r["TRANSACTION_ID"]: r["fold"] for r in smp.stratified_folds(df, 5).collect()}
    alloc = smp.fold_allocation({0: 23, 1: 7}, 5)
    assert alloc == {0: [5, 5, 5, 4, 4], 1: [1, 1, 1, 2, 2]}
    expect = []
    for cls in (0, 1):
        for fold, size in enumerate(alloc[cls]):
            expect += [fold] * size
    assert [got[i] for i in range(30)] == expect
    assert set(got.values()) == {0, 1, 2, 3, 4}
