"""Evaluation operators against NumPy brute force on the scored rows."""

import numpy as np
import pytest

from cardsight.operators import evaluate as ev
from cardsight.operators.ordered import ordered_scan
from tests.conftest import SF01


@pytest.fixture(scope="module")
def scored(spark):
    from cardsight.plans.evaluation_queries import scored_rows
    from cardsight.sources.transactions import load_transactions

    return scored_rows(load_transactions(spark, SF01))


def test_auc_and_average_precision_match_brute_force(scored):
    pdf = scored.toPandas()
    auc = {r["dataset"]: r["roc_auc"] for r in ev.roc_auc(scored).collect()}
    areas = {r["dataset"]: r for r in ev.pr_auc(scored).collect()}
    for ds, g in pdf.groupby("dataset"):
        y, s = g.label.values, g.score.values
        pos, neg = s[y == 1], s[y != 1]
        want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (
            len(pos) * len(neg)
        )
        assert auc[ds] == pytest.approx(want, abs=1e-12)
        order = np.argsort(-s, kind="stable")
        ys, ss = y[order], s[order]
        distinct = np.r_[np.diff(ss) != 0, True]
        tps = np.cumsum(ys == 1)[distinct]
        fps = np.cumsum(ys != 1)[distinct]
        prec = tps / (tps + fps)
        rec = tps / tps[-1]
        want_ap = np.sum(np.diff(np.r_[0, rec]) * prec)
        assert areas[ds]["average_precision"] == pytest.approx(want_ap, abs=1e-12)
        want_area = np.sum(np.diff(np.r_[0, rec]) * (prec + np.r_[1.0, prec[:-1]]) / 2)
        assert areas[ds]["pr_auc"] == pytest.approx(want_area, abs=1e-12)


def test_ordered_scan_across_many_buckets(spark):
    rows = [(g, float(v), 1) for g in ("a", "b") for v in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, one long")
    out = ordered_scan(df, "v", ["one"], ["v"], descending=True, group_cols=["g"], buckets=7).collect()
    for r in out:
        assert r["cum_one"] == 300 - int(r["v"])
        assert r["next_v"] == (r["v"] - 1 if r["v"] > 0 else None)


def test_metrics_zero_when_undefined(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    m = ev.metrics_map(df)
    assert m == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}


def test_report_rows(scored):
    rows = {r["class"]: r for r in ev.classification_report(scored).collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    acc = rows["accuracy"]
    assert acc["precision"] == acc["recall"] == acc["support"]
    assert rows["macro avg"]["support"] == rows["0"]["support"] + rows["1"]["support"]


def test_fold_summary_std_matches_numpy(spark):
    from cardsight.plans.evaluation_queries import METRICS, rule_fold_scores
    from cardsight.sources.transactions import load_transactions

    scores = rule_fold_scores(load_transactions(spark, SF01)).toPandas()
    summary = {r["model_name"]: r for r in ev.fold_metric_summary(spark.createDataFrame(scores), METRICS).collect()}
    for name, g in scores.groupby("model_name"):
        for m in METRICS:
            assert summary[name][f"std_{m}"] == pytest.approx(np.std(g[m].values), abs=1e-12)
            assert summary[name][f"mean_{m}"] == pytest.approx(np.mean(g[m].values), abs=1e-12)
