"""Spark ML training and scoring with fit-only rebalancing.

``fit_balanced`` is the sampling-aware pipeline: standard scaling fitted on
the training rows, then (optionally) SMOTE oversampling and random
undersampling of the training rows only, then the estimator. Scoring applies
only the scaling and the model. Model competition, seeded random search with
a resumable trials table, refit-and-register and training curves are built
on it; every fit and score is a distributed Spark ML job, and the driver only
loops over (model, fold) or trials.
"""

from __future__ import annotations

import json
import math
import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    NaiveBayesModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import boosting as bst
from cardsight.operators import evaluate as ev
from cardsight.operators import perceptron as pc
from cardsight.operators import sampling as smp
from cardsight.operators import tracking as trk
from cardsight.session import materialize, scratch_path

SEED = 42


# --------------------------------------------------------------------------- estimators


def make_estimator(kind: str, params: dict | None = None, n_features: int = len(S.FEATURE_COLUMNS), seed: int = SEED):
    """A Spark ML classifier on ``features``/``label``.

    Spark's boosted trees (``gbt``) take ``iterations`` -> maxIter, ``learning_rate``
    -> stepSize, ``depth`` -> maxDepth; ``boosted`` (``operators/boosting.py``) is no
    Spark ML estimator, ``fit_on`` fits it; it fits ``mlp`` by ``operators/perceptron.py``,
    with this estimator's layers, steps and seed.
    """
    p = dict(params or {})
    common = {"featuresCol": "features", "labelCol": "label"}
    if kind == "gbt":
        return GBTClassifier(
            maxIter=int(p.get("iterations", 20)),
            stepSize=float(p.get("learning_rate", 0.1)),
            maxDepth=int(p.get("depth", 5)),
            seed=seed,
            **common,
        )
    if kind == "logistic":
        return LogisticRegression(maxIter=int(p.get("max_iter", 100)), **common)
    if kind == "random_forest":
        return RandomForestClassifier(
            numTrees=int(p.get("trees", 20)), maxDepth=int(p.get("depth", 5)), seed=seed, **common
        )
    if kind == "decision_tree":
        return DecisionTreeClassifier(maxDepth=int(p.get("depth", 5)), seed=seed, **common)
    if kind == "naive_bayes":
        return NaiveBayes(modelType="gaussian", **common)
    if kind == "mlp":
        hidden = [int(h) for h in p.get("hidden", (500, 500))]
        return MultilayerPerceptronClassifier(
            layers=[n_features, *hidden, 2], maxIter=int(p.get("max_iter", 40)), seed=seed, **common
        )
    raise ValueError(f"unknown estimator {kind!r}")


MODEL_CLASSES = {
    "boosted": bst.BoostedModel,
    "gbt": GBTClassificationModel,
    "logistic": LogisticRegressionModel,
    "random_forest": RandomForestClassificationModel,
    "decision_tree": DecisionTreeClassificationModel,
    "naive_bayes": NaiveBayesModel,
    "mlp": pc.PerceptronModel,
}


# --------------------------------------------------------------------------- forests

#: Most rows times trees that are grown at once: the driver holds all nodes of one such group.
FOREST_ROWS = 8_000_000
#: Rows times trees that a node counts for where groups of grown trees score together.
NODE_ROWS = 32


class GroupedForest:
    """A forest whose trees are saved in groups, each a Spark forest of its own. One grows at a
    time; rows are scored by as many at once as their nodes allow. A row's votes are those of all
    trees, as in one forest."""

    def __init__(self, paths: Sequence[str]):
        self.paths = list(paths)

    @classmethod
    def fit(cls, rows: DataFrame, params: dict, n_features: int, seed: int, group: int) -> GroupedForest:
        trees = make_estimator("random_forest", params, n_features, seed).getNumTrees()
        folder, paths = scratch_path(rows.sparkSession, "forest"), []
        for first in range(0, trees, group):
            size = min(group, trees - first)
            paths.append(f"{folder}/{first}")
            make_estimator("random_forest", {**params, "trees": size}, n_features, seed + first).fit(rows).save(paths[-1])
        return cls(paths)

    def transform(self, df: DataFrame) -> DataFrame:
        votes, nodes = None, 0
        for path in self.paths:
            model = RandomForestClassificationModel.load(path)
            if votes is not None and (nodes + model.totalNumNodes) * NODE_ROWS > FOREST_ROWS:
                votes, nodes = materialize(votes), 0  # written now, so that the trees so far can go
            nodes += model.totalNumNodes
            own = vector_to_array("rawPrediction")
            scored = model.transform(df if votes is None else votes).withColumn(
                "_sum", own if votes is None else F.zip_with("_sum", own, lambda a, b: a + b)
            )
            votes = scored.drop("rawPrediction", "probability", "prediction")
        total = F.aggregate("_sum", F.lit(0.0), lambda a, b: a + b)
        return votes.withColumns({
            "score": F.when(total > 0, F.col("_sum")[1] / total).otherwise(0.0),
            "prediction": (F.col("_sum")[1] > F.col("_sum")[0]).cast("double"),
        }).drop("_sum")

    def save(self, path: str) -> None:
        for i, group in enumerate(self.paths):
            RandomForestClassificationModel.load(group).save(f"{path}/{i}")


# --------------------------------------------------------------------------- balanced pipeline


def assemble(df: DataFrame, features: Sequence[str], label: str | None = S.LABEL_COLUMN) -> DataFrame:
    """``features`` vector (doubles) plus a double ``label``; other columns kept."""
    cast = df.withColumns({c: F.col(c).cast("double") for c in features})
    out = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(cast)
    if label is not None:
        out = out.withColumn("label", F.col(label).cast("double"))
    return out


@dataclass
class BalancedModel:
    """Scaler statistics plus a fitted Spark model; ``transform`` scores raw
    feature rows, and a saved model does so after ``load_model``."""

    kind: str
    features: list[str]
    stats: dict
    model: object
    params: dict = field(default_factory=dict)
    training_rows: DataFrame | None = None

    def transform(self, df: DataFrame, label: str | None = S.LABEL_COLUMN) -> DataFrame:
        scaled = smp.apply_scaler(df, self.stats)
        scored = self.model.transform(assemble(scaled, self.features, label if label in df.columns else None))
        if "probability" in scored.columns:
            scored = scored.withColumn("score", vector_to_array("probability")[1])
        return scored.withColumn("prediction", F.col("prediction").cast("int"))

    def save(self, path: str) -> None:
        """Scaler, settings and fitted model in one folder."""
        spark = SparkSession.active()
        about = {"kind": self.kind, "features": self.features, "stats": self.stats, "params": self.params}
        if isinstance(self.model, GroupedForest):
            about["groups"] = len(self.model.paths)
        spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.parquet(f"{path}/about")
        if self.kind == "knn":
            self.model.training.write.parquet(f"{path}/model")
        else:
            self.model.save(f"{path}/model")


def load_model(spark: SparkSession, path: str) -> BalancedModel:
    """A model saved by ``BalancedModel.save``, ready to score raw feature rows."""
    about = json.loads(spark.read.schema("about string").parquet(f"{path}/about").first()["about"])
    stats = {c: tuple(v) for c, v in about["stats"].items()}
    kind = about["kind"]
    if kind == "knn":
        from cardsight.operators.neighbors import KnnModel

        model = KnnModel.of(spark.read.parquet(f"{path}/model"), about["features"], int(about["params"].get("k", 5)))
    elif "groups" in about:
        model = GroupedForest([f"{path}/model/{i}" for i in range(about["groups"])])
    else:
        model = MODEL_CLASSES[kind].load(f"{path}/model")
    return BalancedModel(kind, about["features"], stats, model, about["params"])


#: Rows of a partition of the training set: layout follows the data, not the cluster.
PARTITION_ROWS = 50_000


@dataclass
class TrainingSet:
    """Rebalanced training rows, materialised once and shared by any number of fits."""

    rows: DataFrame
    features: list[str]
    stats: dict
    id_col: str
    borders: list[list[float]] | None = None
    packed: tuple[int, DataFrame] | None = None

    def cut(self) -> list[list[float]]:
        """The borders of the features' bins, found once for all fits on these rows."""
        if self.borders is None:
            self.borders = bst.quantile_borders(self.rows, self.features)
        return self.borders

    def binned(self) -> tuple[int, DataFrame]:
        """The number of rows that have a label and their bins, written once for all boosted fits on them."""
        if self.packed is None:
            n = self.rows.where(F.col("label").isNotNull()).count()
            packed = bst.packed_rows(self.rows, self.features, self.cut())
            self.packed = n, materialize(packed.repartition(bst.n_tasks(self.rows, n)))
        return self.packed


def balance(
    train: DataFrame,
    features: Sequence[str] = S.FEATURE_COLUMNS,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    oversample: float | None = 0.3,
    undersample: float | None = 1.0,
    k_neighbors: int = 5,
    seed: int = SEED,
) -> TrainingSet:
    """scale -> SMOTE(oversample) -> undersample(ratio). With a fixed seed the
    rows depend on nothing else, so a fold or a study needs them once."""
    features = list(features)
    # Cut the lineage once: every statistic, sample and neighbour pass below
    # reads these materialised rows instead of re-running the feature plan.
    train = materialize(train.select(id_col, *features, label))
    stats = smp.fit_scaler(train, features)
    rows = smp.apply_scaler(train, stats)
    # Class counts once; SMOTE's effect on them is known exactly.
    counts = smp.class_count_map(train, label)
    if oversample:
        from cardsight.operators.neighbors import smote

        # Materialised: the undersampler's histogram rounds read these rows
        # several times, and each read would otherwise re-run the kNN plan.
        rows = materialize(
            smote(rows, features, label, id_col, ratio=oversample, k=k_neighbors, seed=seed, counts=counts)
        )
        n_maj = max((n for c, n in counts.items() if c != 1), default=0)
        counts = {**counts, 1: max(counts.get(1, 0), int(oversample * n_maj))}
    if undersample:
        rows = smp.undersample(rows, label, id_col, ratio=undersample, seed=seed, counts=counts)
        counts = {c: min(n, int(min(counts.values()) / undersample)) for c, n in counts.items()}
    partitions = max(1, -(-sum(counts.values()) // PARTITION_ROWS))
    return TrainingSet(materialize(assemble(rows, features, label).repartition(partitions)), features, stats, id_col)


def fit_on(training: TrainingSet, kind: str = "gbt", params: dict | None = None, seed: int = SEED) -> BalancedModel:
    """Fit one estimator on a rebalanced training set."""
    params = dict(params or {})
    if kind == "boosted":
        model = bst.fit_boosted(
            training.rows, training.features, iterations=int(params.get("iterations", 200)), depth=int(params.get("depth", 6)),
            learning_rate=float(params.get("learning_rate", 0.1)), l2_leaf_reg=float(params.get("l2_leaf_reg", 3.0)),
            borders=training.cut(), packed=training.binned(),
        )
    elif kind == "knn":
        from cardsight.operators.neighbors import KnnModel

        rows = training.rows.select(training.id_col, *training.features, "label")
        model = KnnModel(rows, training.features, training.id_col, k=int(params.get("k", 5)))
    else:
        estimator = make_estimator(kind, params, len(training.features), seed)
        group = max(1, FOREST_ROWS // max(1, training.rows.count())) if kind == "random_forest" else 0
        if kind == "mlp":
            model = pc.fit_perceptron(training.rows, estimator.getLayers(), estimator.getMaxIter(), seed)
        elif group and estimator.getNumTrees() > group:
            model = GroupedForest.fit(training.rows, params, len(training.features), seed, group)
        else:
            model = estimator.fit(training.rows)
    return BalancedModel(kind, training.features, training.stats, model, params, training.rows)


def fit_balanced(
    train: DataFrame, kind: str = "gbt", params: dict | None = None, seed: int = SEED, **settings
) -> BalancedModel:
    """``balance`` then ``fit_on``, for a single fit; resampling in fit only."""
    return fit_on(balance(train, seed=seed, **settings), kind, params, seed)


def fit_weighted(
    train: DataFrame,
    kind: str = "logistic",
    params: dict | None = None,
    features: Sequence[str] = S.FEATURE_COLUMNS,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    seed: int = SEED,
) -> BalancedModel:
    """Fit on all training rows, scaled and weighted by class instead of resampled."""
    estimator = make_estimator(kind, params, len(features), seed) if kind != "boosted" else None
    if estimator is None or not estimator.hasParam("weightCol"):
        raise ValueError(f"{kind} takes no class weights")
    train = materialize(train.select(id_col, *features, label))
    stats = smp.fit_scaler(train, features)
    weighted = smp.with_class_weights(smp.apply_scaler(train, stats), label, "weight")
    rows = materialize(assemble(weighted, features, label))
    return BalancedModel(kind, list(features), stats, estimator.setWeightCol("weight").fit(rows), dict(params or {}), rows)


def score(model: BalancedModel, df: DataFrame, label: str = S.LABEL_COLUMN, id_col: str = S.TRANSACTION_ID) -> DataFrame:
    """``id, label, score, prediction`` (the evaluation input)."""
    out = model.transform(df, label)
    cols = [F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")]
    cols.append(F.col("score") if "score" in out.columns else F.col("prediction").cast("double").alias("score"))
    return out.select(*cols, "prediction")


# --------------------------------------------------------------------------- M10: competition

# Settings near the original's library defaults: full trees (30 is the deepest that Spark grows),
# forests of 100; boosted trees as the recorded run.
BOOSTED = {"iterations": 200, "depth": 6}
FOREST = {"trees": 100, "depth": 30}
TREE = {"depth": 30}

# The competitors' display names.
COMPETITORS = {
    "Logistic Reg.": ("logistic", {}),
    "Gradient Boosting": ("boosted", BOOSTED),
    "Random Forest": ("random_forest", FOREST),
    "K-NN": ("knn", {"k": 5}),
    "Naive Bayes": ("naive_bayes", {}),
    "Decision Tree": ("decision_tree", TREE),
}


def compete(
    train: DataFrame,
    models: dict | None = None,
    n_splits: int = 5,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    seed: int = SEED,
    study: str | None = None,
    root: str | None = None,
    parallelism: int = 4,
    **settings,
) -> DataFrame:
    """Cross-validated fold scores: one row per (model, fold) with fit/score
    time and accuracy, F1, recall, precision and ROC AUC on the held-out fold.
    Resampling happens inside each training fold only. Fits run concurrently
    from ``parallelism`` driver threads (each fit is itself distributed).
    Every finished (model, fold) is appended to the ``competition`` table and
    skipped on a rerun, so an interrupted competition resumes."""
    spark = train.sparkSession
    models = models or COMPETITORS
    digest = trk.dataset_profile(train, "training", "folds")["digest"]
    study = f"{study or 'competition'}-{trk.key_of(digest, models, n_splits, label, seed, settings)}"
    table = trk.read_table(spark, "competition", root).where(F.col("study") == study)
    done = {(r["model_name"], r["fold"]) for r in table.select("model_name", "fold").collect()}
    todo = [(name, kind, params, fold) for name, (kind, params) in models.items()
            for fold in range(n_splits) if (name, fold) not in done]
    if todo:
        folded = materialize(smp.stratified_folds(train, n_splits, label, id_col))
        # One rebalanced training set for each fold, shared by all its fits.
        sets = {
            fold: balance(folded.where(F.col("fold") != fold).drop("fold"), label=label, id_col=id_col, seed=seed, **settings)
            for fold in sorted({t[3] for t in todo})
        }
        lock = threading.Lock()

        def one(task):
            name, kind, params, fold = task
            t0 = time.time()
            fitted = fit_on(sets[fold], kind, params, seed)
            t1 = time.time()
            scored = score(fitted, folded.where(F.col("fold") == fold).drop("fold"), label, id_col).cache()
            m = ev.metrics_map(scored)
            auc = ev.roc_auc(scored, by=()).first()["roc_auc"]
            t2 = time.time()
            scored.unpersist()
            row = (study, name, fold, t1 - t0, t2 - t1, m["accuracy"], m["f1"], m["recall"], m["precision"],
                   float(auc) if auc is not None else None)
            with lock:  # one writer at a time into the table folder
                trk.append(spark, "competition", [row], root)

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(one, todo))
    names = list(models)
    return (
        trk.read_table(spark, "competition", root)
        .where((F.col("study") == study) & F.col("model_name").isin(names) & (F.col("fold") < n_splits))
        .drop("study")
    )


# --------------------------------------------------------------------------- M11: seeded random search

#: Settings of the rebalancing steps, logged with every run.
PIPELINE_DEFAULTS = {"oversample": 0.3, "undersample": 1.0, "k_neighbors": 5}

# The tuned ranges (integers uniform, rates and the regulariser log-uniform).
REFERENCE_SPACE = {
    "iterations": ("int", 100, 1000),
    "learning_rate": ("log", 0.001, 0.1),
    "depth": ("int", 3, 10),
    "l2_leaf_reg": ("log", 0.1, 10.0),
}


def sample_params(space: dict, seed: int, trial: int) -> dict:
    """Trial ``trial``'s parameters: a pure function of (seed, trial), so a
    resumed search draws exactly what an uninterrupted one would."""
    rnd = random.Random(seed * 1_000_003 + trial)
    out = {}
    for name, (kind, lo, hi) in space.items():
        if kind == "int":
            out[name] = float(rnd.randint(int(lo), int(hi)))
        elif kind == "log":
            out[name] = math.exp(rnd.uniform(math.log(lo), math.log(hi)))
        else:
            out[name] = rnd.uniform(lo, hi)
    return out


def _longest_first(trials: list[tuple[int, dict]]) -> list[tuple[int, dict]]:
    """Trials by the work of their fits, those that share one together: a wave of
    like ones leaves no slot waiting for its longest."""
    rest = lambda p: str(sorted((k, v) for k, v in p.items() if k != "iterations"))
    work: dict[str, float] = {}
    for _, p in trials:
        work[rest(p)] = max(work.get(rest(p), 0), p.get("iterations", 200) * (1 + p.get("depth", 6)))
    return sorted(trials, key=lambda t: (-work[rest(t[1])], rest(t[1]), t[0]))


def _prefix_trials(training: TrainingSet, validate: DataFrame, trials: list[tuple[int, dict]], objective: str, parallelism: int) -> list[tuple[int, dict, float]]:
    """Values of boosted trials: trials that differ in their rounds only share the fit of the
    most rounds, and one pass over the validation rows scores all of them after theirs."""
    shared: dict[tuple, list[tuple[int, dict]]] = {}
    for trial, params in trials:
        shared.setdefault(tuple(sorted((k, v) for k, v in params.items() if k != "iterations")), []).append((trial, params))
    # The longest fits first, so that none is left alone at the end.
    cost = lambda p: p.get("iterations", 200) * (1 + p.get("depth", 6))
    groups = sorted(shared.values(), key=lambda g: -max(cost(p) for _, p in g))
    most = [max(g, key=lambda x: x[1].get("iterations", 200))[1] for g in groups]
    training.binned()
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        models = list(pool.map(lambda params: fit_on(training, "boosted", params).model, most))
    rounds = [[int(p.get("iterations", 200)) for _, p in g] for g in groups]
    calls = bst.prefix_calls(models, rounds, validate).collect()  # four rows a trial
    n = {(r["model"], r["rounds"], r["label"], r["prediction"]): r["n"] for r in calls}
    out = []
    for place, group in enumerate(groups):
        for trial, params in group:
            tn, fp, fn, tp = (n.get((place, int(params.get("iterations", 200)), y, p), 0) for y in (0, 1) for p in (0, 1))
            ratio = lambda a, b: a / b if b else 0.0
            value = {"accuracy": ratio(tp + tn, tp + tn + fp + fn), "precision": ratio(tp, tp + fp), "recall": ratio(tp, tp + fn),
                     "f1": ratio(2 * tp, 2 * tp + fp + fn)}[objective]
            out.append((trial, params, value))
    return out


def random_search(
    train: DataFrame,
    validate: DataFrame,
    study: str,
    n_trials: int = 100,
    space: dict = REFERENCE_SPACE,
    kind: str = "boosted",
    objective: str = "recall",
    seed: int = SEED,
    root: str | None = None,
    parallelism: int | None = None,
    **settings,
) -> DataFrame:
    """Maximise a validation metric over ``n_trials`` seeded draws. Draws are
    independent, so ``parallelism`` driver threads run their fits concurrently
    (each is itself distributed; by default as many as the session's slots hold).
    Boosted trials go in waves, each scored by one pass. Finished trials of
    ``study`` are read from the trials table and skipped, so a rerun resumes; the
    study's key covers the data, the space, the seed and the settings, so nothing
    else resumes it. The rebalanced training set and its bins are built once.
    Returns the study's trials."""
    spark = train.sparkSession
    digests = [trk.dataset_profile(df, "search", "split")["digest"] for df in (train, validate)]
    study = f"{study}-{trk.key_of(digests, space, kind, objective, seed, settings)}"
    done = {r["trial"] for r in trk.read_table(spark, "trials", root).where(F.col("study") == study).select("trial").collect()}
    todo = [(t, sample_params(space, seed, t)) for t in range(n_trials) if t not in done]
    if todo:
        training = balance(train, seed=seed, **settings)
        if kind == "boosted":
            training.cut()
            held = materialize(assemble(smp.apply_scaler(validate, training.stats), training.features))
            tasks = bst.n_tasks(training.rows, training.rows.count())
            fits = parallelism or max(1, spark.sparkContext.defaultParallelism // tasks)
            todo = _longest_first(todo)
            for at in range(0, len(todo), 4 * fits):
                found = _prefix_trials(training, held, todo[at : at + 4 * fits], objective, fits)
                trk.append(spark, "trials", [(study, trial, params, float(value)) for trial, params, value in found], root)
        else:
            validate = materialize(validate)
            lock = threading.Lock()

            def one(task: tuple[int, dict]) -> None:
                trial, params = task
                value = ev.metrics_map(score(fit_on(training, kind, params, seed), validate))[objective]
                with lock:  # one writer at a time into the table folder
                    trk.append(spark, "trials", [(study, trial, params, float(value))], root)

            with ThreadPoolExecutor(max_workers=parallelism or 2) as pool:
                list(pool.map(one, todo))
    return trk.read_table(spark, "trials", root).where(F.col("study") == study)


def best_trial(trials: DataFrame) -> DataFrame:
    """One row: the best parameters and the best value (ties: lowest trial)."""
    key = F.struct(F.col("value"), -F.col("trial"))
    return trials.agg(F.max_by("params", key).alias("best_params"), F.max("value").alias("best_value"))


# --------------------------------------------------------------------------- M12 + E9


def refit_and_register(
    train: DataFrame,
    validate: DataFrame,
    params: dict,
    model_name: str,
    run_name: str,
    source: str,
    kind: str = "boosted",
    seed: int = SEED,
    root: str | None = None,
    **settings,
) -> str:
    """Fit with the chosen parameters (the seed kept), score the validation
    rows, log the run with its metrics, the training data profile and the
    curves (boosted trees: every metric by round on training and validation rows;
    other models: the training loss), and register the model as the next version."""
    spark = train.sparkSession
    import datetime as dt

    start_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    profile = trk.dataset_profile(train, "training", source, "training")
    trk.log_dataset(spark, profile, root)
    fitted = fit_balanced(train, kind, params, seed=seed, **settings)
    metrics = ev.metrics_map(score(fitted, validate))
    run_id = trk.log_run(
        spark, run_name, {**PIPELINE_DEFAULTS, **settings, **params, "seed": seed, "kind": kind}, metrics,
        profile["digest"], start_ts, root=root
    )
    trk.register_model(spark, fitted, model_name, run_id, root)
    if kind == "boosted":
        trk.append(spark, "curves", [(run_id, *row) for row in round_metrics(fitted, validate)], root)
    else:
        curve = training_curve(fitted)
        if curve:
            trk.log_curve(spark, run_id, "logistic_loss", curve, root)
    return run_id


#: Metrics of a round, in the order of the curve table.
ROUND_METRICS = ["loss", "precision", "recall", "roc_auc", "pr_auc"]


def round_metrics(fitted: BalancedModel, validate: DataFrame, label: str = S.LABEL_COLUMN) -> list[tuple[int, str, float]]:
    """``iteration, metric, value`` of boosted trees: loss, precision, recall and areas after
    every round, on the rows that the model was fitted on and on ``validate``."""
    held = assemble(smp.apply_scaler(validate, fitted.stats), fitted.features, label)
    counts = bst.round_counts(fitted.model, fitted.training_rows, "training").union(bst.round_counts(fitted.model, held, "validation"))
    rows = bst.metrics_by_round(counts).collect()  # two rows a round
    return [(r["round"], f"{r['dataset']}_{m}", r[m]) for r in sorted(rows, key=lambda r: (r["dataset"], r["round"])) for m in ROUND_METRICS]


def training_curve(fitted: BalancedModel) -> list[float]:
    """Loss per iteration: boosted trees re-evaluated on their training rows,
    logistic regression from its objective history."""
    model = fitted.model
    if isinstance(model, pc.PerceptronModel):
        return list(model.history)
    if isinstance(model, bst.BoostedModel):
        losses = bst.metrics_by_round(bst.round_counts(model, fitted.training_rows, "training"))
        return [r["loss"] for r in losses.orderBy("round").select("loss").collect()]
    if hasattr(model, "evaluateEachIteration") and fitted.training_rows is not None:
        return list(model.evaluateEachIteration(fitted.training_rows))
    summary = getattr(model, "summary", None) if getattr(model, "hasSummary", False) else None
    if summary is not None and hasattr(summary, "objectiveHistory"):
        return list(summary.objectiveHistory)
    return []

