"""Boosted symmetric trees: brute force, layouts, restarts, rounds, search."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardsight.operators import boosting as B
from cardsight.operators import models as md

FEATURES = ["a", "b", "c"]


def table(n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=n) > 0.2).astype(float)
    x[rng.random(n) < 0.1, 2] = np.nan
    return x, y


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(float(t), *map(float, r), "extra") for r, t in zip(x, y)], "label double, a double, b double, c double, score string").repartition(parts)


def brute(x, y, borders, rounds, depth, rate, l2):
    """Every split of every level tried on the rows themselves; margins after each round."""
    margin, trees, unit = np.zeros(len(y)), [], 2.0**B.UNIT_BITS
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = np.rint((y - p) * unit) / unit, np.rint(p * (1 - p) * unit) / unit
        leaf, splits = np.zeros(len(y), int), []
        value = lambda leaf: sum(g[leaf == k].sum() ** 2 / (h[leaf == k].sum() + l2) for k in set(leaf))
        for level in range(depth):
            best = max(
                ((value(leaf + 2**level * (x[:, f] > b)), -f, -i) for f in range(x.shape[1]) for i, b in enumerate(borders[f])),
                key=lambda t: (round(t[0], 9), t[1], t[2]),
            )
            if best[0] - value(leaf) <= 1e-12:
                break
            f, b = -best[1], borders[-best[1]][-best[2]]
            splits.append((f, b))
            leaf = leaf + 2**level * (x[:, f] > b)
        margin = margin + np.array([rate * g[leaf == k].sum() / (h[leaf == k].sum() + l2) for k in leaf])
        trees.append(splits)
    return trees, margin


def test_equals_brute_force(spark):
    x, y = table()
    rows = frame(spark, x, y)
    borders = B.quantile_borders(rows, FEATURES, 8)
    assert all(len(b) <= 7 and b == sorted(set(b)) for b in borders)
    model = B.fit_boosted(rows, FEATURES, iterations=6, learning_rate=0.3, depth=3, l2_leaf_reg=2.0, borders=borders)
    trees, margin = brute(x, y, borders, 6, 3, 0.3, 2.0)
    assert [list(zip(t.features, t.borders)) for t in model.trees] == trees
    assert model.margins(x) == pytest.approx(margin, abs=1e-9)
    got = B.metrics_by_round(B.round_counts(model, rows, "training")).orderBy("round").collect()
    assert got[-1]["loss"] == pytest.approx(np.logaddexp(0, np.where(y == 1, -margin, margin)).mean(), rel=1e-9)
    assert [r["loss"] for r in got] == sorted((r["loss"] for r in got), reverse=True)


def test_level_sums_add_up_pairs_of_features(monkeypatch):
    rng = np.random.default_rng(3)
    n, n_nodes, n_bins = 5000, 3, 8
    bins, node = rng.integers(0, n_bins, (5, n)).astype(np.uint8), rng.integers(0, n_nodes, n)
    g, h = B.gradients(rng.normal(size=n), rng.integers(0, 2, n).astype(float))
    want = np.zeros((2, n_nodes, 5, n_bins), np.int64)
    for f in range(5):
        for i, w in enumerate((g, h)):
            np.add.at(want[i, :, f], (node, bins[f]), w.astype(np.int64))
    counted = []
    bincount = np.bincount
    monkeypatch.setattr(np, "bincount", lambda at, w, size: counted.append(len(at)) or bincount(at, w, size))
    for few, pairs, chunk, entries in ((0, 1 << 16, 1 << 21, 6 * n), (0, 0, 1 << 21, 10 * n), (0, 1 << 16, 999, 6 * n), (n, 0, 999, 10 * n)):
        monkeypatch.setattr(B, "FEW_ROWS", few)
        monkeypatch.setattr(B, "PAIR_CELLS", pairs)
        monkeypatch.setattr(B, "CHUNK", chunk)
        monkeypatch.setattr(B, "PIECE", 700)
        counted.clear()
        assert (B.level_sums(bins, node, g, h, n_nodes, n_bins) == want).all()
        assert sum(counted) == entries


def test_tasks_stages_and_row_order_make_no_difference(spark, monkeypatch):
    x, y = table(seed=1)
    rows = frame(spark, x, y)
    args = dict(iterations=3, depth=2, learning_rate=0.5, l2_leaf_reg=1.0, max_bins=16)
    one = B.fit_boosted(rows, FEATURES, tasks=1, **args)
    assert B.fit_boosted(rows, FEATURES, tasks=3, **args).trees == one.trees
    assert B.fit_boosted(frame(spark, x[::-1], y[::-1], 7), FEATURES, rounds_per_stage=2, **args).trees == one.trees
    monkeypatch.setattr(B, "CHUNK", 50)
    bins = B.binned(x, [np.array([0.0]), np.array([0.1, 0.5]), np.array([])])
    assert bins.max(axis=1).tolist() == [1, 2, 0]
    g, h = B.gradients(np.linspace(-2, 2, len(y)), y)
    node = np.arange(len(y)) % 4
    sums = B.level_sums(bins, node, g, h, 4, 3)
    assert sums[0, 2, 1, 1] == g[(node == 2) & (bins[1] == 1)].sum()
    assert (sums.sum(axis=(1, 3)) == np.array([g.sum(), h.sum()])[:, None]).all()


def test_a_shorter_fit_is_a_prefix_and_calls_are_counted(spark):
    x, y = table(seed=2)
    rows = frame(spark, x, y)
    long = B.fit_boosted(rows, FEATURES, iterations=9, depth=4)
    short = B.fit_boosted(rows, FEATURES, iterations=4, depth=4)
    assert long.first(4).trees == short.trees
    calls = {tuple(r)[:4]: r["n"] for r in B.prefix_calls([long, short], [[2, 9], [4]], rows).collect()}
    for place, model, n in ((0, long, 2), (0, long, 9), (1, short, 4)):
        called = model.first(n).margins(x) > 0
        for label in (0, 1):
            for call in (0, 1):
                assert calls.get((place, n, label, call), 0) == ((y == label) & (called == call)).sum()


def test_saved_scores_and_odd_rows(spark, tmp_path):
    x, y = table(seed=3)
    rows = frame(spark, x, y)
    model = B.fit_boosted(rows.unionByName(rows.limit(5).withColumn("label", F.lit(None).cast("double"))), FEATURES, iterations=5)
    assert model.trees == B.fit_boosted(rows, FEATURES, iterations=5).trees
    model.save(str(tmp_path / "m"))
    loaded = B.BoostedModel.load(str(tmp_path / "m"))
    assert loaded.trees == model.trees and loaded.features == FEATURES
    odd = spark.createDataFrame([(None, None, None), (1e300, -1e300, float("nan"))], "a double, b double, c double")
    got = loaded.transform(odd).collect()
    assert [r["score"] for r in got] == pytest.approx((1 / (1 + np.exp(-model.margins(np.array([[np.nan] * 3, [1e300, -1e300, np.nan]]))))).tolist())
    assert loaded.transform(odd.limit(0)).count() == 0


def test_one_class_constant_features_and_no_rows(spark):
    x = np.ones((20, 3))
    flat = B.fit_boosted(frame(spark, x, np.r_[np.ones(15), np.zeros(5)]), FEATURES, iterations=2, learning_rate=1.0, l2_leaf_reg=1e-9)
    assert [t.features for t in flat.trees] == [(), ()]
    assert 1 / (1 + np.exp(-flat.margins(x[:1])[0])) == pytest.approx(0.75, abs=0.02)
    none = frame(spark, x, np.ones(20)).limit(0)
    assert B.fit_boosted(none, FEATURES, iterations=1).margins(x[:1])[0] == 0
    with pytest.raises(ValueError):
        B.fit_boosted(none, FEATURES, depth=0)


def test_metrics_by_round_of_given_scores(spark):
    rows = [("v", 1, 1, 0.9), ("v", 1, 0, 0.8), ("v", 1, 1, 0.8), ("v", 1, 0, 0.1), ("v", 2, 0, 0.2), ("v", 2, 0, 0.3)]
    out = B.metrics_by_round(B.scored_counts(spark.createDataFrame(rows, "dataset string, round int, label int, score double")))
    one, two = out.orderBy("round").collect()
    assert (one["precision"], one["recall"], one["roc_auc"]) == pytest.approx((2 / 3, 1.0, 3.5 / 4))
    assert one["pr_auc"] == pytest.approx(0.5 * (1 + 1) / 2 + 0.5 * (2 / 3 + 1) / 2)
    assert one["loss"] == pytest.approx(-np.log([0.9, 0.2, 0.8, 0.9]).mean())
    assert (two["precision"], two["recall"], two["roc_auc"], two["pr_auc"]) == (0, None, None, None)


def test_trials_that_differ_in_rounds_share_a_fit(spark, tmp_path, monkeypatch):
    x, y = table(400, seed=4)
    rows = frame(spark, x, y).withColumn("id", F.monotonically_increasing_id())
    training = md.TrainingSet(rows, FEATURES, {c: (0.0, 1.0) for c in FEATURES}, "id")
    fits, fit = [], B.fit_boosted
    monkeypatch.setattr(B, "fit_boosted", lambda *a, **k: fits.append(k["iterations"]) or fit(*a, **k))
    trials = [(0, {"iterations": 3.0, "depth": 2.0}), (1, {"iterations": 8.0, "depth": 2.0}), (2, {"iterations": 5.0, "depth": 3.0})]
    got = md._prefix_trials(training, rows, trials, "recall", 2)
    assert sorted(fits) == [5, 8]
    for trial, params, value in got:
        own = fit(rows, FEATURES, iterations=int(params["iterations"]), depth=int(params["depth"]), borders=training.cut())
        assert value == pytest.approx(((own.margins(x) > 0) & (y == 1)).sum() / (y == 1).sum())
    assert [t for t, *_ in sorted(got)] == [0, 1, 2]


RESTART = """
import sys
sys.path.insert(0, {root!r})
import os
from cardsight import get_spark
from cardsight.operators import boosting as B
from pyspark.sql import functions as F
spark = get_spark("local[2,4]", shuffle_partitions=2)
rows = spark.range(200).select((F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 7).cast("double").alias("a"))
want = B.fit_boosted(rows, ["a"], iterations=2, depth=2, tasks=1).trees
grow = B.grow
def lost(*args):
    try:
        os.close(os.open({mark!r}, os.O_CREAT | os.O_EXCL))
    except FileExistsError:
        return grow(*args)
    raise OSError("a task is lost")
B.grow = lost
stage = B._grow_stage
B._grow_stage = lambda *a: (lambda run: lambda batches: (globals().update(x=setattr(sys.modules["cardsight.operators.boosting"], "grow", lost)) or run(batches)))(stage(*a))
got = B.fit_boosted(rows, ["a"], iterations=2, depth=2, tasks=1).trees
print("SAME", got == want, os.path.exists({mark!r}))
"""


def test_a_lost_task_restarts_the_stage(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = RESTART.format(root=root, mark=str(tmp_path / "mark"))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert "SAME True True" in out.stdout, out.stderr[-2000:]
