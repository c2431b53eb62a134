"""Forests in groups against Spark's own."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from cardsight.operators import models as md

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def training(spark):
    draw = np.random.default_rng(7)
    x = draw.normal(size=(900, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] + 0.3 * draw.normal(size=900) > 0).astype(float)
    rows = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))], "id long, a double, b double, c double, label double")
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).checkpoint()
    return md.TrainingSet(rows, FEATURES, {}, "id")


def test_large_forest_grows_in_groups(spark, training, monkeypatch, tmp_path):
    from pyspark.ml.classification import RandomForestClassificationModel

    params = {"trees": 7, "depth": 4}
    assert isinstance(md.fit_on(training, "random_forest", params).model, RandomForestClassificationModel)
    monkeypatch.setattr(md, "FOREST_ROWS", 3 * 900)
    fitted = md.fit_on(training, "random_forest", params)
    groups = [RandomForestClassificationModel.load(p) for p in fitted.model.paths]
    assert [g.getNumTrees for g in groups] == [3, 3, 1]
    raw = sum(np.array([r[0] for r in g.transform(training.rows).orderBy("id").select(md.vector_to_array("rawPrediction")).collect()]) for g in groups)
    found = fitted.model.transform(training.rows).orderBy("id").select("score", "prediction", "label").toPandas()
    assert np.allclose(found["score"], raw[:, 1] / 7) and list(found["prediction"]) == list((raw[:, 1] > raw[:, 0]).astype(float))
    assert (found["prediction"] == found["label"]).mean() > 0.8
    fitted.stats = {c: (0.0, 1.0) for c in FEATURES}
    fitted.save(str(tmp_path / "m"))
    again = md.load_model(spark, str(tmp_path / "m")).model.transform(training.rows).orderBy("id").select("score").toPandas()
    assert list(again["score"]) == list(found["score"])


def test_groups_of_few_nodes_score_in_one_pass(spark, training, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel

    monkeypatch.setattr(md, "FOREST_ROWS", 2 * 900)
    fitted = md.fit_on(training, "random_forest", {"trees": 6, "depth": 3})
    groups = [RandomForestClassificationModel.load(p) for p in fitted.model.paths]
    assert [g.getNumTrees for g in groups] == [2, 2, 2]
    raw = sum(np.array([r[0] for r in g.transform(training.rows).orderBy("id").select(md.vector_to_array("rawPrediction")).collect()]) for g in groups)
    written, checkpoint = [], md.materialize
    monkeypatch.setattr(md, "materialize", lambda df: written.append(1) or checkpoint(df))
    for limit, passes in ((64 * 900, 0), (1, 2)):
        written.clear()
        monkeypatch.setattr(md, "FOREST_ROWS", limit)
        found = fitted.model.transform(training.rows).orderBy("id").select("score", "prediction").toPandas()
        assert np.allclose(found["score"], raw[:, 1] / 6) and list(found["prediction"]) == list((raw[:, 1] > raw[:, 0]).astype(float))
        assert len(written) == passes
