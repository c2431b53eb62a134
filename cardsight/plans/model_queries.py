"""Registered neighbour, model and tracking queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import boosting as bst
from cardsight.operators import evaluate as ev
from cardsight.operators import features as feat
from cardsight.operators import models as md
from cardsight.operators import neighbors as nb
from cardsight.operators import split as sp
from cardsight.operators import tracking as trk
from cardsight.plans import oracle_sql as Q
from cardsight.plans.catalog import register
from cardsight.sources.transactions import load_transactions
from cardsight.session import materialize

START = "2024-01-01"
# Integer-valued columns for the neighbour checks: squared distances are exact.
KNN_FEATURES = ["AMOUNT_CENTS", S.TX_TIME_DAYS, S.TERMINAL_ID]
# The recorded run's seed, oversampling ratio and neighbours.
SMOTE_SEED = 42
SMOTE_RATIO = 0.3
K = 5

TRIALS = 100
#: Rounds of given scores in the check of the metrics by round.
GIVEN_ROUNDS = 20


def _knn_rows(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    return tx.select(
        S.TRANSACTION_ID,
        F.round(F.col(S.TX_AMOUNT) * 100).cast("long").cast("double").alias("AMOUNT_CENTS"),
        F.col(S.TX_TIME_DAYS).cast("double").alias(S.TX_TIME_DAYS),
        F.col(S.TERMINAL_ID).cast("double").alias(S.TERMINAL_ID),
        S.TX_FRAUD,
    )


KNN_BASE = f"""m AS (SELECT TRANSACTION_ID AS id, CAST(round(TX_AMOUNT * 100) AS BIGINT) AS a,
                      CAST(TX_TIME_DAYS AS BIGINT) AS b, TERMINAL_ID AS c FROM tx WHERE TX_FRAUD = 1),
  p AS (SELECT q.id AS q_id, r.id AS r_id,
               sqrt(CAST((q.a - r.a) * (q.a - r.a) + (q.b - r.b) * (q.b - r.b) + (q.c - r.c) * (q.c - r.c) AS DOUBLE))
               AS distance
        FROM m q JOIN m r ON q.id <> r.id),
  nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, r_id) AS rank FROM p)
         WHERE rank <= {K})"""


@register(
    "j5_knn",
    f"WITH {Q.TX_CTE}, {KNN_BASE} SELECT q_id, CAST(rank AS INTEGER) AS rank, r_id, distance FROM nn",
)
def q_knn(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 nearest other fraudulent rows of every fraudulent row (exact)."""
    frauds = _knn_rows(spark, sf).where(F.col(S.TX_FRAUD) == 1)
    return nb.knn_join(frauds, frauds, KNN_FEATURES, K, S.TRANSACTION_ID, exclude_self=True)


def _smote_sql() -> str:
    def md5_int(seed: int, expr: str) -> str:
        return f"CAST(('0x' || substr(md5('{seed}:' || {expr}), 1, 8)) AS BIGINT)"

    src = "CAST(src AS VARCHAR) || ':' || CAST(copy AS VARCHAR)"
    return f"""WITH {Q.TX_CTE}, {KNN_BASE},
  cnt AS (SELECT sum(CASE WHEN TX_FRAUD = 1 THEN 1 ELSE 0 END) AS n_min,
                 sum(CASE WHEN TX_FRAUD = 0 THEN 1 ELSE 0 END) AS n_maj FROM tx),
  par AS (SELECT n_min, CAST(floor(CAST({SMOTE_RATIO} AS DOUBLE) * n_maj - n_min) AS BIGINT) AS n_new FROM cnt),
  ord AS (SELECT id, row_number() OVER (ORDER BY substr(md5('{SMOTE_SEED}:' || CAST(id AS VARCHAR)), 1, 15), id) AS o
          FROM m),
  cp AS (SELECT ord.id AS src, n_new // n_min + CASE WHEN o <= n_new % n_min THEN 1 ELSE 0 END AS copies
         FROM ord, par),
  ex AS (SELECT src, unnest(range(CAST(1 AS BIGINT), CAST(copies + 1 AS BIGINT))) AS copy FROM cp WHERE copies > 0),
  pick AS (SELECT src, copy, ({md5_int(SMOTE_SEED, src)} % {K}) + 1 AS nrank,
                  CAST({md5_int(SMOTE_SEED + 1, src)} AS DOUBLE) / 4294967296.0 AS u FROM ex)
  SELECT s.a + pick.u * (nb.a - s.a) AS AMOUNT_CENTS, s.b + pick.u * (nb.b - s.b) AS TX_TIME_DAYS,
         s.c + pick.u * (nb.c - s.c) AS TERMINAL_ID
  FROM pick JOIN nn ON nn.q_id = pick.src AND nn.rank = pick.nrank
            JOIN m s ON s.id = pick.src JOIN m nb ON nb.id = nn.r_id"""


@register("b2_smote", _smote_sql())
def q_smote(spark: SparkSession, sf: str) -> DataFrame:
    """Synthetic fraud rows: fraud/legit ratio raised to 0.3, k = 5, seed 42."""
    rows = _knn_rows(spark, sf)
    out = nb.smote(rows, KNN_FEATURES, S.TX_FRAUD, S.TRANSACTION_ID, SMOTE_RATIO, K, SMOTE_SEED)
    return out.where(F.col(S.TRANSACTION_ID).isNull()).select(*KNN_FEATURES)


# --------------------------------------------------------------------------- models


def _splits(spark: SparkSession, sf: str):
    # The split reads the feature table several times: materialise it once,
    # as the batch job does by writing it to Parquet.
    features = materialize(feat.build_features(load_transactions(spark, sf)))
    return sp.three_way_split(features, START, 21, 7, 7, 7)


def _model_query(kind: str, params: dict | None = None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        train, validate, _ = _splits(spark, sf)
        fitted = md.fit_balanced(train, kind, params)
        return md.score(fitted, validate)

    run.__doc__ = f"Balanced {kind} fitted on the training split, scored on validation: id, label, score, prediction."
    return run


for _name, _kind, _params in [
    ("m1_gbt", "boosted", md.BOOSTED),
    ("m2_logistic", "logistic", None),
    ("m3_random_forest", "random_forest", md.FOREST),
    ("m4_decision_tree", "decision_tree", md.TREE),
    ("m5_naive_bayes", "naive_bayes", None),
    ("m6_knn_vote", "knn", {"k": 5}),
    ("m7_mlp", "mlp", {"hidden": (500, 500), "max_iter": 40}),
]:
    register(_name)(_model_query(_kind, _params))


@register("b8_balanced_training_rows")
def q_balanced_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows a balanced fit trains on: scaled, SMOTE to 0.3, undersampled to 1:1."""
    train, _, _ = _splits(spark, sf)
    return md.balance(train).rows.select(*S.FEATURE_COLUMNS, "label")


@register("m2_weighted_logistic")
def q_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression with balanced class weights on all training rows, scored on validation."""
    train, validate, _ = _splits(spark, sf)
    return md.score(md.fit_weighted(train, "logistic"), validate)


def _class_counts_sql() -> str:
    from cardsight.plans.split_queries import _test_sql

    outer = _test_sql("tx", START, 21, 7, 7, p="outer_")
    inner = _test_sql("outer_train", START, 7, 7, 7, p="inner_")
    return f"""WITH {Q.TX_CTE}, {outer}, {inner},
      c AS (SELECT CAST(floor(CAST({SMOTE_RATIO} AS DOUBLE) * count(*) FILTER (TX_FRAUD = 0)
                   - count(*) FILTER (TX_FRAUD = 1)) AS BIGINT) + count(*) FILTER (TX_FRAUD = 1) AS n FROM inner_train)
      SELECT 0.0::DOUBLE AS label, n AS count FROM c UNION ALL SELECT 1.0::DOUBLE, n FROM c"""


@register("b8_class_counts", _class_counts_sql())
def q_balanced_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of either class that a balanced fit trains on."""
    train, _, _ = _splits(spark, sf)
    return md.balance(train).rows.groupBy("label").agg(F.count("*").alias("count"))


#: Quick fits whose scored rows are checked against SQL.
CHECKED = {
    "boosted": {"iterations": 20, "depth": 4}, "logistic": {}, "naive_bayes": {}, "decision_tree": {}, "knn": {"k": 5},
}


def _split_ctes() -> str:
    from cardsight.plans.split_queries import _test_sql

    return f"""WITH {Q.TX_CTE}, {_test_sql("tx", START, 21, 7, 7, p="outer_")}, {_test_sql("outer_train", START, 7, 7, 7, p="inner_")}"""


def _scored_sql() -> str:
    models = ", ".join(f"('{m}')" for m in CHECKED)
    return f"""{_split_ctes()} SELECT model, TRANSACTION_ID AS id, CAST(TX_FRAUD AS INTEGER) AS label, true AS is_probability, true AS is_call
      FROM inner_test, (VALUES {models}) AS m(model)"""


@register("m_scored_rows", _scored_sql())
def q_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every validation row once for each model (M1, M2, M4, M5, M6, M8, M9): its label, and
    whether the score is a probability and the prediction a call at one half."""
    train, validate, _ = _splits(spark, sf)
    training, validate = md.balance(train), materialize(validate)  # read by every model
    out = None
    for kind, params in CHECKED.items():
        scored = md.score(md.fit_on(training, kind, params), validate)
        is_call = (F.col("prediction") == (F.col("score") > 0.5).cast("int")) | (F.col("score") == 0.5)
        rows = scored.select(
            F.lit(kind).alias("model"), "id", "label", F.col("score").between(0, 1).alias("is_probability"), is_call.alias("is_call")
        )
        out = rows if out is None else out.union(rows)
    return out


@register("m10_competition")
def q_competition(spark: SparkSession, sf: str) -> DataFrame:
    """5-fold cross-validated scores of every competitor on the training split."""
    train, _, _ = _splits(spark, sf)
    return md.compete(train)


@register("e8_competition_ranking")
def q_competition_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Competitors ranked by mean fold F1, with mean and population std per metric."""
    train, _, _ = _splits(spark, sf)
    scores = md.compete(train)
    metrics = ["test_acc", "test_f1", "test_recall", "test_precision", "test_auc", "fit_time", "score_time"]
    return ev.rank_models(ev.fold_metric_summary(scores, metrics), "mean_test_f1")


@register("m11_search")
def q_search(spark: SparkSession, sf: str) -> DataFrame:
    """100 seeded trials over the tuned ranges, maximising validation recall; resumes from the trials table."""
    train, validate, _ = _splits(spark, sf)
    return md.random_search(train, validate, "card_fraud", TRIALS)


@register(
    "m11_trial_grid",
    f"SELECT CAST(range AS INTEGER) AS trial, {len(md.REFERENCE_SPACE)} AS n_in_range, true AS is_share FROM range({TRIALS})",
)
def q_trial_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Each trial once, how many of its draws lie in the tuned ranges, and whether its recall is a share."""
    trials = q_search(spark, sf)
    inside = [F.col("params")[name].between(low, high).cast("int") for name, (_, low, high) in md.REFERENCE_SPACE.items()]
    return trials.select(
        F.col("trial").cast("int").alias("trial"), sum(inside[1:], inside[0]).alias("n_in_range"), F.col("value").between(0, 1).alias("is_share")
    )


@register("a7_best_trial")
def q_best(spark: SparkSession, sf: str) -> DataFrame:
    train, validate, _ = _splits(spark, sf)
    return md.best_trial(md.random_search(train, validate, "card_fraud", TRIALS))


def _refit(spark: SparkSession, sf: str) -> str:
    train, validate, _ = _splits(spark, sf)
    trials = md.random_search(train, validate, "card_fraud", TRIALS)
    best = md.best_trial(trials).first()["best_params"]
    return md.refit_and_register(
        train, validate, dict(best), "card_fraud_gbt", "gbt validation", source=f"{sf}/events.parquet"
    )


@register("m12_refit")
def q_refit(spark: SparkSession, sf: str) -> DataFrame:
    """Refit with the best trial, score validation, log the run: the run row."""
    run_id = _refit(spark, sf)
    return trk.read_table(spark, "runs").where(F.col("run_id") == run_id)


def _run_sql() -> str:
    return f"""{_split_ctes()} SELECT 'gbt validation' AS name, 'FINISHED' AS status, 'boosted' AS kind, '42' AS seed, true AS has_metrics,
      (SELECT count(*) FROM inner_train) AS num_rows, true AS is_registered"""


@register("s6_run_summary", _run_sql())
def q_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The logged refit (M12, S6, S7, S8): its run, its training data and whether its model is registered."""
    run_id = _refit(spark, sf)
    run = trk.read_table(spark, "runs").where(F.col("run_id") == run_id)
    data = trk.read_table(spark, "datasets").select(F.col("digest").alias("dataset_digest"), "num_rows").distinct()
    models = trk.model_versions(spark).select("run_id", "version")
    return run.join(data, "dataset_digest").join(models, "run_id", "left").select(
        run["name"], "status", F.col("params")["kind"].alias("kind"), F.col("params")["seed"].alias("seed"),
        F.forall(F.array(*[F.lit(m) for m in ("accuracy", "f1", "precision", "recall")]), lambda m: F.col("metrics")[m].between(0, 1)).alias("has_metrics"),
        "num_rows", (F.col("version") >= 1).alias("is_registered"),
    )


@register("s7_model_registry")
def q_registry(spark: SparkSession, sf: str) -> DataFrame:
    run_id = _refit(spark, sf)
    return trk.model_versions(spark).where(F.col("run_id") == run_id)


@register("s7_registered_model_scores")
def q_registered_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The refitted model, read back from the registry, scores the raw feature rows of the test split."""
    _, _, test = _splits(spark, sf)
    run_id = _refit(spark, sf)
    path = trk.read_table(spark, "models").where(F.col("run_id") == run_id).first()["path"]
    return md.score(md.load_model(spark, path), test)


@register("e9_curve")
def q_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Loss, precision, recall and areas after every boosting round of the refitted model, on training and validation rows."""
    run_id = _refit(spark, sf)
    return trk.read_table(spark, "curves").where(F.col("run_id") == run_id)


def _curve_sql() -> str:
    named = ", ".join(f"('{d}_{m}')" for d in ("training", "validation") for m in md.ROUND_METRICS)
    return f"SELECT metric, 1 AS first_round, true AS is_whole FROM (VALUES {named}) AS m(metric)"


@register("e9_curve_grid", _curve_sql())
def q_curve_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Each curve of the refitted model: its first round, and whether it has a value for every round."""
    run_id = _refit(spark, sf)
    rounds = trk.read_table(spark, "runs").where(F.col("run_id") == run_id).first()["params"]["iterations"]
    curves = trk.read_table(spark, "curves").where(F.col("run_id") == run_id)
    whole = (F.count_distinct("iteration") == int(float(rounds))) & (F.count("value") == int(float(rounds)))
    return curves.groupBy("metric").agg(F.min("iteration").alias("first_round"), whole.alias("is_whole"))


def _rounds_sql() -> str:
    return f"""WITH {Q.TX_CTE},
  s AS (SELECT CASE WHEN TX_TIME_DAYS % 2 = 0 THEN 'training' ELSE 'validation' END AS dataset, CAST(round AS INTEGER) AS round,
               TX_FRAUD AS y, (TX_AMOUNT + 1) / (TX_AMOUNT + 1 + 100.0 * round) AS p
        FROM tx, range(1, {GIVEN_ROUNDS + 1}) AS r(round) WHERE TX_FRAUD IS NOT NULL AND TX_AMOUNT IS NOT NULL),
  c AS (SELECT dataset, round, CAST(round_even(p * 10000, 0) AS INTEGER) AS bucket, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY ALL),
  a AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS pa, coalesce(sum(neg) OVER w, 0) AS na FROM c
        WINDOW w AS (PARTITION BY dataset, round ORDER BY bucket DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  areas AS (SELECT dataset, round, sum(neg * (2 * pa + pos))::DOUBLE / (2.0 * sum(pos) * sum(neg)) AS roc_auc,
                   sum(pos * ((pa + pos)::DOUBLE / (pa + na + pos + neg) + CASE WHEN pa + na > 0 THEN pa::DOUBLE / (pa + na) ELSE 1.0 END) / 2) / sum(pos) AS pr_auc
            FROM a GROUP BY dataset, round),
  m AS (SELECT dataset, round, avg(-ln(CASE WHEN y = 1 THEN p ELSE 1 - p END)) AS loss,
               coalesce(sum(y) FILTER (p > 0.5)::DOUBLE / nullif(count(*) FILTER (p > 0.5), 0), 0) AS "precision",
               coalesce(sum(y) FILTER (p > 0.5), 0)::DOUBLE / sum(y) AS recall FROM s GROUP BY dataset, round)
  SELECT dataset, round, round(loss, 6) AS loss, round("precision", 6) AS "precision", round(recall, 6) AS recall,
         round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM m JOIN areas USING (dataset, round)"""


@register("e9_metrics_by_round", _rounds_sql())
def q_rounds(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of every round from given scores: odds of the amount, lower round by round."""
    tx = load_transactions(spark, sf).where(F.col(S.TX_FRAUD).isNotNull() & F.col(S.TX_AMOUNT).isNotNull())
    amount = F.col(S.TX_AMOUNT) + 1
    dataset = F.when(F.col(S.TX_TIME_DAYS) % 2 == 0, "training").otherwise("validation")
    rounds = F.explode(F.sequence(F.lit(1), F.lit(GIVEN_ROUNDS)))
    scored = tx.select(dataset.alias("dataset"), F.col(S.TX_FRAUD).alias("label"), amount.alias("a"), rounds.alias("round"))
    scored = scored.withColumn("score", F.col("a") / (F.col("a") + 100.0 * F.col("round")))
    out = bst.metrics_by_round(bst.scored_counts(scored))
    return out.select("dataset", "round", *[F.round(m, 6).alias(m) for m in md.ROUND_METRICS])


@register(
    "s8_profile",
    f"""WITH {Q.TX_CTE} SELECT 'transactions' AS name, count(*) AS num_rows, count(*) * 7 AS num_elements,
        'events' AS source, 'training' AS context FROM tx""",
)
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    p = trk.dataset_profile(tx, "transactions", "events", "training")
    trk.log_dataset(spark, p)
    return (
        trk.read_table(spark, "datasets")
        .where((F.col("digest") == p["digest"]) & (F.col("name") == "transactions"))
        .select("name", "num_rows", "num_elements", "source", "context")
        .distinct()  # the same profile may have been logged by earlier runs
    )


@register("s6_run_log")
def q_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The run table after a logged refit (its latest row)."""
    run_id = _refit(spark, sf)
    return trk.read_table(spark, "runs").where(F.col("run_id") == run_id).select(
        "run_id", "name", "status", "params", "metrics", "dataset_digest"
    )
