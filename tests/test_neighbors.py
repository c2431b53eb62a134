"""Exact kNN against brute force; SMOTE row counts and segment property."""

import os
import subprocess
import sys
import tempfile

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardsight.operators import neighbors as nb

FEATS = ["a", "b", "c"]


def knn_brute_force(queries, reference, features, k, id_col, exclude_self=True):
    """All distances, sorted (pandas in, pandas out)."""
    x, y = queries[features].to_numpy(float), reference[features].to_numpy(float)
    d = np.sqrt(((x[:, None, :] - y[None, :, :]) ** 2).sum(axis=2))
    rows = []
    for i, q in enumerate(queries[id_col]):
        near = sorted((d[i, j], int(r)) for j, r in enumerate(reference[id_col]) if not (exclude_self and r == q))[:k]
        rows += [(int(q), n + 1, r, dist) for n, (dist, r) in enumerate(near)]
    return pd.DataFrame(rows, columns=["q_id", "rank", "r_id", "distance"])


def _points(spark, n, seed, clustered=False):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3))
    if clustered:
        X[: n // 2] *= 0.01  # half the points in one tight cluster
    X = np.round(X, 2)  # creates distance ties
    pdf = pd.DataFrame(X, columns=FEATS)
    pdf.insert(0, "TRANSACTION_ID", np.arange(n, dtype="int64"))
    return spark.createDataFrame(pdf), pdf


@pytest.mark.parametrize("clustered", [False, True])
def test_knn_join_is_exact(spark, clustered):
    df, pdf = _points(spark, 400, 1, clustered)
    got = nb.knn_join(df, df, FEATS, k=5, box_rows=30, max_boxes=16, chunk=37, block=17).toPandas()
    want = knn_brute_force(pdf, pdf, FEATS, 5, "TRANSACTION_ID")
    got = got.sort_values(["q_id", "rank"]).reset_index(drop=True)
    assert (got[["q_id", "rank", "r_id"]].to_numpy() == want[["q_id", "rank", "r_id"]].to_numpy()).all()
    assert np.allclose(got["distance"], want["distance"])


def test_knn_join_other_side(spark):
    q, qp = _points(spark, 60, 2)
    r, rp = _points(spark, 250, 3)
    r = r.withColumn("TRANSACTION_ID", F.col("TRANSACTION_ID") + 1000)
    rp["TRANSACTION_ID"] += 1000
    got = nb.knn_join(q, r, FEATS, k=3, exclude_self=False, box_rows=20, chunk=16, block=40).toPandas()
    want = knn_brute_force(qp, rp, FEATS, 3, "TRANSACTION_ID", exclude_self=False)
    got = got.sort_values(["q_id", "rank"]).reset_index(drop=True)
    assert (got[["q_id", "rank", "r_id"]].to_numpy() == want[["q_id", "rank", "r_id"]].to_numpy()).all()


def test_smote_counts_and_segments(spark):
    rng = np.random.default_rng(4)
    n0, n1 = 300, 20
    X = rng.normal(size=(n0 + n1, 3))
    pdf = pd.DataFrame(X, columns=FEATS)
    pdf.insert(0, "TRANSACTION_ID", np.arange(n0 + n1, dtype="int64"))
    pdf["TX_FRAUD"] = [0] * n0 + [1] * n1
    df = spark.createDataFrame(pdf)
    out = nb.smote(df, FEATS, ratio=0.3, k=5, seed=9).toPandas()
    syn = out[out["TRANSACTION_ID"].isna()]
    assert len(syn) == int(0.3 * n0 - n1)
    assert (syn["TX_FRAUD"] == 1).all()
    mino = pdf[pdf.TX_FRAUD == 1][FEATS].to_numpy()
    nn = knn_brute_force(pdf[pdf.TX_FRAUD == 1], pdf[pdf.TX_FRAUD == 1], FEATS, 5, "TRANSACTION_ID")
    pairs = {(int(a), int(b)) for a, b in zip(nn.q_id, nn.r_id)}
    ids = pdf[pdf.TX_FRAUD == 1]["TRANSACTION_ID"].to_numpy()
    for x in syn[FEATS].to_numpy():
        # x = a + u (b - a) for some neighbour pair (a, b), 0 <= u < 1
        ok = False
        for a, b in pairs:
            pa, pb = mino[list(ids).index(a)], mino[list(ids).index(b)]
            d = pb - pa
            u = np.dot(x - pa, d) / np.dot(d, d)
            if -1e-9 <= u < 1 and np.allclose(pa + u * d, x, atol=1e-9):
                ok = True
                break
        assert ok
    with pytest.raises(ValueError):
        nb.smote(df, FEATS, ratio=0.01)


def test_features_without_value_raise(spark):
    df, _ = _points(spark, 40, 5)
    holed = df.withColumn("a", F.when(F.col("TRANSACTION_ID") != 7, F.col("a")))
    with pytest.raises(Exception, match="feature a has no value in row 7"):
        nb.knn_join(holed, holed, FEATS, k=3).collect()


def test_smote_needs_more_rows_than_neighbours(spark):
    df, _ = _points(spark, 60, 6)
    rows = df.withColumn("TX_FRAUD", (F.col("TRANSACTION_ID") < 5).cast("int"))
    with pytest.raises(ValueError, match="neighbours"):
        nb.smote(rows, FEATS, ratio=0.5, k=5)


def test_join_runs_where_workers_do_not_see_the_package():
    """Started from another folder, only the driver has the package on its path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from cardsight import get_spark
from cardsight.operators import neighbors as nb
spark = get_spark("local[2]", shuffle_partitions=2)
df = spark.range(30).selectExpr("id AS TRANSACTION_ID", "CAST(id * id AS DOUBLE) AS a")
print("rows", nb.knn_join(df, df, ["a"], k=2).count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    with tempfile.TemporaryDirectory() as folder:
        out = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 60" in out.stdout, out.stderr[-2000:]


def test_equal_training_rows_are_as_many_neighbours(spark):
    train = spark.createDataFrame(
        [(None, 0.0, 1.0), (None, 0.0, 1.0), (None, 0.0, 1.0), (1, 1.0, 0.0), (2, 2.0, 0.0), (3, 3.0, 0.0)],
        "TRANSACTION_ID long, a double, label double",
    )
    model = nb.KnnModel(train, ["a"], "TRANSACTION_ID", k=5)
    row = model.transform(spark.createDataFrame([(7, 0.0)], "TRANSACTION_ID long, a double")).first()
    assert (row["score"], row["prediction"]) == (0.6, 1.0)


def test_equal_rows_that_no_cut_divides(spark):
    rng = np.random.default_rng(8)
    X = np.r_[np.zeros((200, 3)), rng.integers(-9, 10, (300, 3)), np.full((40, 3), 30.0)]  # whole: exact distances
    pdf = pd.DataFrame(X, columns=FEATS)
    pdf.insert(0, "TRANSACTION_ID", np.arange(len(X), dtype="int64"))
    df = spark.createDataFrame(pdf).repartition(5)
    for k, block in ((4, 16), (30, 64)):
        got = nb.knn_join(df, df, FEATS, k=k, box_rows=25, chunk=50, block=block).toPandas()
        got = got.sort_values(["q_id", "rank"]).reset_index(drop=True)
        want = knn_brute_force(pdf, pdf, FEATS, k, "TRANSACTION_ID")
        assert (got[["q_id", "rank", "r_id"]].to_numpy() == want[["q_id", "rank", "r_id"]].to_numpy()).all()


def test_a_query_meets_only_the_boxes_of_its_ball():
    rng = np.random.default_rng(9)
    X = rng.normal(size=(2000, 3))
    tree = nb.Boxes(5, X[:500])
    box = tree.of(X)
    tree.bound({int(b): (X[box == b].min(axis=0), X[box == b].max(axis=0)) for b in set(box)}, 3)
    Q, theta = rng.normal(size=(50, 3)), np.full(50, 0.3)
    row, met = tree.met(Q, theta)
    near = [{int(b) for b in box[np.linalg.norm(X - x, axis=1) <= 0.3]} for x in Q]
    got = [set(met[row == i].tolist()) for i in range(50)]
    assert all(a <= b for a, b in zip(near, got))
    assert sum(map(len, got)) < 50 * 32 / 3


def test_rows_within_a_bound_are_found_by_a_product_and_measured_exactly(spark, monkeypatch):
    rng = np.random.default_rng(11)
    R = np.round(rng.normal(size=(500, 15)) + 1e6, 3)  # far from the origin, where products lose most
    R[250:] = R[:250]
    Q = np.r_[R[:40], np.round(rng.normal(size=(40, 15)) + 1e6, 3)]
    D = nb._dist(Q, R)
    theta = np.sort(D, axis=1)[:, 4]
    theta[3] = 0.0
    for bound in (theta, theta + 5.0):
        row, at, d = nb._within(Q, R, bound, 5, nb._shifted(R))
        assert set(zip(*np.nonzero(D <= theta[:, None]))) <= set(zip(row, at)) and (d == D[row, at]).all()
        assert len(row) < 4 * (D <= theta[:, None]).sum()
    low = np.arange(80) % 400
    row, at, d = nb._within(Q, R, theta + 5.0, 5, nb._shifted(R), (low, low + 3))
    D[np.arange(80)[:, None], low[:, None] + np.arange(3)] = np.inf
    assert set(zip(*np.nonzero(D <= np.sort(D, axis=1)[:, 4:5]))) <= set(zip(row, at)) and np.isfinite(D[row, at]).all()

    measured = []
    dist = nb._dist
    monkeypatch.setattr(nb, "_dist", lambda X, Y: measured.append(X.shape) or dist(X, Y))
    names = ["_g", "_query", "_id", "a", "_theta"]
    rows = [(0, False, i, float(i), None) for i in range(100)] + [(0, True, 50, 50.0, 2.0), (0, True, 200, 3.5, np.inf)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    found = [tuple(x.values()) for b in nb._meet(["a"], 3, True, bound=False)([batch]) for x in b.to_pylist()]
    assert found == [(50, 49, 1.0), (50, 51, 1.0), (50, 48, 2.0), (200, 3, 0.5), (200, 4, 0.5), (200, 2, 1.5)]
    assert measured == [(1, 1)]  # the query without a bound only
