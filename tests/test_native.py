"""Boosting in the JVM against the same steps in NumPy."""

import numpy as np
import pytest

from cardsight.operators import boosting as B
from cardsight.operators import models as md
from cardsight.operators import native
from tests.test_boosting import FEATURES, frame, table


def alike(one, two):
    assert [(t.features, t.borders) for t in one.trees] == [(t.features, t.borders) for t in two.trees]
    assert all(np.allclose(a.values, b.values, rtol=1e-9, atol=1e-12) for a, b in zip(one.trees, two.trees))


def test_the_jvm_grows_the_trees_of_numpy(spark, monkeypatch):
    x, y = table(900, seed=5)
    rows = frame(spark, x, y)
    for args in (dict(iterations=12, depth=5), dict(iterations=5, depth=9, l2_leaf_reg=0.1, learning_rate=0.5), dict(iterations=3, depth=3, max_bins=4)):
        monkeypatch.setattr(B, "JVM_WORK", 1 << 60)
        slow = B.fit_boosted(rows, FEATURES, **args)
        monkeypatch.setattr(B, "JVM_WORK", 0)
        calls, grown = [], native.grown
        monkeypatch.setattr(native, "grown", lambda *a: calls.append(grown(*a)) or calls[-1])
        quick = B.fit_boosted(rows, FEATURES, **args)
        assert calls and all(calls)
        alike(quick, slow)
        if args["iterations"] < 5:  # an exchange takes a second
            assert B.fit_boosted(rows, FEATURES, tasks=3, **args).trees == quick.trees
        assert B.fit_boosted(frame(spark, x[::-1], y[::-1], 7), FEATURES, rounds_per_stage=2, **args).trees == quick.trees
        monkeypatch.setattr(native, "grown", grown)


def test_without_a_compiler_numpy_goes_on(spark, monkeypatch):
    x, y = table(seed=6)
    rows = frame(spark, x, y)
    want = B.fit_boosted(rows, FEATURES, iterations=3)
    monkeypatch.setattr(B, "JVM_WORK", 0)
    monkeypatch.setattr(native, "_grower", lambda spark: None)
    assert B.fit_boosted(rows, FEATURES, iterations=3).trees == want.trees


def test_flat_features_and_no_rows_in_the_jvm(spark, monkeypatch):
    monkeypatch.setattr(B, "JVM_WORK", 0)
    x = np.ones((20, 3))
    flat = B.fit_boosted(frame(spark, x, np.r_[np.ones(15), np.zeros(5)]), FEATURES, iterations=2, learning_rate=1.0, l2_leaf_reg=1e-9)
    assert [t.features for t in flat.trees] == [(), ()]
    assert 1 / (1 + np.exp(-flat.margins(x[:1])[0])) == pytest.approx(0.75, abs=0.02)
    assert B.fit_boosted(frame(spark, x, np.ones(20)).limit(0), FEATURES, iterations=1).trees == []


def test_fits_of_a_training_set_share_their_binned_rows(spark, monkeypatch):
    x, y = table(500, seed=7)
    training = md.TrainingSet(frame(spark, x, y).checkpoint(), FEATURES, {c: (0.0, 1.0) for c in FEATURES}, "id")
    binned, packed = [], B.packed_rows
    monkeypatch.setattr(B, "packed_rows", lambda *a, **k: binned.append(1) or packed(*a, **k))
    for depth in (2, 10):
        model = md.fit_on(training, "boosted", {"iterations": 4, "depth": depth}).model
        alike(model, B.fit_boosted(training.rows, FEATURES, iterations=4, depth=depth, borders=training.cut()))
    assert len(binned) == 3  # once for the set, once for each fit of its own


def test_binned_margins_are_those_of_the_trees():
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(400, 3)), 1)
    x[:5] = np.nan, np.inf, -np.inf
    trees = []
    for levels in (0, 1, 7, 8, 9, 16):
        f = rng.integers(0, 3, levels)
        trees.append(B.Tree(tuple(f.tolist()), tuple(np.round(rng.normal(size=levels), 1).tolist()), tuple(rng.normal(size=1 << levels).tolist())))
    got = B.BoostedModel(FEATURES, trees).margins(x)
    assert (got == sum((t.margins(x) for t in trees), np.zeros(len(x)))).all()


def test_round_counts_send_one_row_a_block_and_round(spark, monkeypatch):
    x, y = table(600, seed=9)
    rows = frame(spark, x, y, 2)
    model = B.fit_boosted(rows, FEATURES, iterations=3, depth=3)
    got = [tuple(r) for r in B.metrics_by_round(B.round_counts(model, rows, "v")).orderBy("round").collect()]
    monkeypatch.setattr(B, "ROUND_ROWS", 100)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 60)
    try:
        again = [tuple(r) for r in B.metrics_by_round(B.round_counts(model, rows, "v")).orderBy("round").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r[1] for r in got] == [1, 2, 3] and all(a[2:] == pytest.approx(b[2:], rel=1e-12) for a, b in zip(got, again))
    for (_, i, loss, precision, recall, *_rest) in got:
        m = model.first(i).margins(x)
        assert loss == pytest.approx(np.logaddexp(0, np.where(y == 1, -m, m)).mean())
        assert recall == pytest.approx(((m > 0) & (y == 1)).sum() / (y == 1).sum())
        assert precision == pytest.approx(((m > 0) & (y == 1)).sum() / max(1, (m > 0).sum()))
