"""The net: Spark's own fit as the measure, saving, and rows that no fit may take."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors

from cardsight.operators import models as md
from cardsight.operators import perceptron as pc
from cardsight.session import materialize

NAMES = ["a", "b", "c"]


def _rows(spark, n=700):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    y = (x[:, 0] * x[:, 1] + 0.3 * rng.normal(size=n) > 0).astype(float)
    data = [(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y))]
    # Three partitions: each ends in a short block.
    return materialize(md.assemble(spark.createDataFrame(data, ["id", *NAMES, "y"]).repartition(3, "id"), NAMES, "y"))


def _training(rows):
    return md.TrainingSet(rows, NAMES, {c: (0.0, 1.0) for c in NAMES}, "id")


def test_fit_is_that_of_sparks_perceptron(spark, monkeypatch):
    # Chunks and tasks of 128 rows, so that several make up a pass; no table is small.
    monkeypatch.setattr(pc, "SMALL_ROWS", 0)
    for name in ("CHUNK_ROWS", "SLICE_ROWS", "TASK_ROWS"):
        monkeypatch.setattr(pc, name, pc.BLOCK_ROWS)
    rows, params = _rows(spark), {"hidden": (8, 5), "max_iter": 15}
    own = md.fit_on(_training(rows), "mlp", params)
    assert isinstance(own.model, pc.PerceptronModel)
    theirs = md.make_estimator("mlp", params, 3).fit(rows)
    assert np.allclose(own.model.weights, theirs.weights.toArray(), rtol=1e-6, atol=1e-8)
    history = theirs.summary().objectiveHistory
    assert np.allclose(md.training_curve(own), history) and len(history) == 16
    scored = theirs.transform(rows).select("id", vector_to_array("probability")[1].alias("score"), "prediction")
    a, b = (sorted(df.select("id", "score", "prediction").collect()) for df in (own.model.transform(rows), scored))
    assert [(r["id"], r["prediction"]) for r in a] == [(r["id"], int(r["prediction"])) for r in b]
    assert np.allclose([r["score"] for r in a], [r["score"] for r in b])
    assert 0 < sum(r["prediction"] for r in a) < len(a)


def test_small_tables_are_fitted_by_spark_itself(spark):
    rows, params = _rows(spark, 200), {"hidden": (4,), "max_iter": 5}
    theirs = md.make_estimator("mlp", params, 3).fit(rows)
    assert list(md.fit_on(_training(rows), "mlp", params).model.weights) == list(theirs.weights.toArray())


def test_saved_net_scores_the_same(spark, tmp_path):
    rows = _rows(spark, 200)
    fitted = md.fit_on(_training(rows), "mlp", {"hidden": (4,), "max_iter": 3})
    fitted.save(str(tmp_path / "net"))
    loaded = md.load_model(spark, str(tmp_path / "net"))
    key = lambda m: sorted(md.score(m, rows.select("id", *NAMES, "y"), "y", "id").collect())
    assert key(loaded) == key(fitted) and loaded.model.history == fitted.model.history


def test_rows_that_cannot_be_fitted_are_refused(spark, monkeypatch):
    monkeypatch.setattr(pc, "SMALL_ROWS", 0)
    for x, y, says in (([float("nan")], 0.0, "finite"), ([1.0], 0.5, "whole"), ([1.0], 2.0, "whole"), ([1.0], None, "whole")):
        rows = spark.createDataFrame([(Vectors.dense([0.0]), 0.0), (Vectors.dense(x), y)], ["features", "label"])
        with pytest.raises(Exception, match=says):
            pc.fit_perceptron(rows, [1, 2, 2], 1, 42)


def test_missing_features_score_as_unknown(spark):
    rows = spark.createDataFrame([(Vectors.dense([float("nan")]),), (Vectors.dense([1.0]),)], ["features"])
    model = pc.PerceptronModel([1, 2, 2], np.linspace(-1, 1, 10))
    nan, known = (r for r in model.transform(rows.coalesce(1)).collect())
    assert np.isnan(nan["score"]) and nan["prediction"] == 0.0 and 0 < known["score"] < 1
