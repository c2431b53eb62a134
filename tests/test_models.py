"""Models: rows, seeded determinism, an AUC floor, resumable search, tracking tables."""

import pytest
from pyspark.sql import functions as F

from cardsight.operators import evaluate as ev
from cardsight.operators import models as md
from cardsight.operators import tracking as trk
from tests.conftest import SF01


@pytest.fixture(scope="module")
def splits(spark):
    from cardsight.operators import features as feat
    from cardsight.operators import split as sp
    from cardsight.sources.transactions import load_transactions

    features = feat.build_features(load_transactions(spark, SF01))
    train, validate, _ = sp.three_way_split(features, "2024-01-01", 21, 7, 7, 7)
    return train.checkpoint(eager=True), validate.checkpoint(eager=True)


def test_balanced_gbt_is_seeded_and_scores_well(spark, splits):
    train, validate = splits
    a = md.score(md.fit_balanced(train, "gbt", {"iterations": 10}), validate)
    b = md.score(md.fit_balanced(train, "gbt", {"iterations": 10}), validate)
    ra = sorted(a.collect())
    assert ra == sorted(b.collect())
    assert len(ra) == validate.count()
    # With SMOTE the synthetic rows carry fractional 0/1 flags that trees can
    # separate from real rows, so on this stand-in label (random within
    # amount > 100) the full pipeline is only clearly above chance...
    assert ev.roc_auc(a, by=()).first()["roc_auc"] > 0.6
    # ...while undersampling alone recovers the amount signal.
    plain = md.score(md.fit_balanced(train, "gbt", {"iterations": 10}, oversample=None), validate)
    assert ev.roc_auc(plain, by=()).first()["roc_auc"] > 0.9


def test_balanced_rows_are_one_to_one(spark, splits):
    train, _ = splits
    fitted = md.fit_balanced(train, "naive_bayes")
    counts = {r["label"]: r["count"] for r in fitted.training_rows.groupBy("label").count().collect()}
    assert counts[0.0] == counts[1.0]
    n_min = train.where(F.col("TX_FRAUD") == 1).count()
    n_maj = train.where(F.col("TX_FRAUD") == 0).count()
    assert counts[1.0] == n_min + int(0.3 * n_maj - n_min)


def test_search_resumes(spark, splits, tmp_path):
    train, validate = splits
    root = str(tmp_path / "track")
    space = {"iterations": ("int", 2, 4), "depth": ("int", 2, 3)}
    first = md.random_search(train, validate, "s", 2, space, root=root).collect()
    again = md.random_search(train, validate, "s", 3, space, root=root).collect()
    assert {r["trial"] for r in first} == {0, 1}
    assert {r["trial"] for r in again} == {0, 1, 2}
    old = {r["trial"]: r["value"] for r in first}
    assert all(old[r["trial"]] == r["value"] for r in again if r["trial"] in old)
    assert md.sample_params(space, 42, 1) == md.sample_params(space, 42, 1)
    best = md.best_trial(md.random_search(train, validate, "s", 3, space, root=root)).first()
    assert best["best_value"] == max(r["value"] for r in again)


def test_tracking_round_trip(spark, tmp_path):
    import datetime as dt

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    root = str(tmp_path / "track")
    df = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense([1.0]), 1.0)], ["features", "label"])
    model = LogisticRegression(maxIter=5).fit(df)
    run = trk.log_run(spark, "r", {"a": 1}, {"recall": 0.5}, "d", dt.datetime(2024, 1, 1), root=root)
    first = trk.register_model(spark, model, "m", run, root)
    path = trk.register_model(spark, model, "m", run, root)
    assert [(r["version"], r["path"]) for r in trk.model_versions(spark, root).orderBy("version").collect()] == [
        (1, first), (2, path)
    ]
    runs = trk.read_table(spark, "runs", root).collect()
    assert runs[0]["metrics"] == {"recall": 0.5} and runs[0]["params"]["a"] == "1"
    from pyspark.ml.classification import LogisticRegressionModel

    assert LogisticRegressionModel.load(path).coefficients == model.coefficients
    prof = trk.dataset_profile(df.select("label"), "x", "src")
    assert prof["num_rows"] == 2 and prof["num_elements"] == 2
    assert prof["digest"] == trk.dataset_profile(df.select("label").repartition(3), "x", "src")["digest"]


def test_digest_tells_repeated_rows_apart(spark):
    digest = lambda rows: trk.dataset_profile(spark.createDataFrame([(x,) for x in rows], "v int"), "x", "s")["digest"]
    assert digest([1, 2]) != digest([1, 2, 9, 9]) != digest([1, 2, 9])
    assert digest([1, 2, 9, 9]) == digest([9, 2, 1, 9])


@pytest.mark.parametrize("kind", ["boosted", "gbt", "naive_bayes", "knn"])
def test_saved_model_scores_raw_rows(spark, splits, tmp_path, kind):
    train, validate = splits
    fitted = md.fit_balanced(train, kind, {"iterations": 3})
    run = f"run-{kind}"
    path = trk.register_model(spark, fitted, "m", run, str(tmp_path / "track"))
    loaded = md.load_model(spark, path)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(md.score(loaded, validate)) == key(md.score(fitted, validate))


def test_another_setting_is_another_study(spark, splits, tmp_path):
    train, validate = splits
    root, space = str(tmp_path / "track"), {"iterations": ("int", 2, 3)}
    a = md.random_search(train, validate, "s", 1, space, root=root)
    b = md.random_search(train, validate, "s", 1, space, root=root, undersample=0.5)
    assert {r["study"] for r in a.collect()}.isdisjoint({r["study"] for r in b.collect()})


def test_class_weights_reach_the_estimator(spark, splits):
    train, validate = splits
    weighted = md.score(md.fit_weighted(train, "logistic"), validate)
    recall = {r["prediction"]: r["n"] for r in weighted.where("label = 1").groupBy("prediction").agg(F.count("*").alias("n")).collect()}
    assert recall.get(1, 0) > recall.get(0, 0)  # unweighted, hardly any fraud is called
    with pytest.raises(ValueError):
        md.fit_weighted(train, "mlp")


def test_competitors_have_whole_sizes(spark):
    sizes = {}
    for name, (kind, params) in md.COMPETITORS.items():
        if kind in ("gbt", "random_forest", "decision_tree"):
            estimator = md.make_estimator(kind, params)
            sizes[name] = {p: estimator.getOrDefault(p) for p in ("maxIter", "numTrees", "maxDepth") if estimator.hasParam(p)}
    assert md.COMPETITORS["Gradient Boosting"] == ("boosted", {"iterations": 200, "depth": 6})
    assert sizes == {
        "Random Forest": {"numTrees": 100, "maxDepth": 30},
        "Decision Tree": {"maxDepth": 30},
    }
