"""Registered evaluation queries.

Scored rows come from the transactions with a deterministic score
``least(TX_AMOUNT / 500, 1)`` (no model needed to check the relational
evaluation); ``dataset`` is "Training" before day 21 and "Test" after.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import evaluate as ev
from cardsight.operators import sampling as smp
from cardsight.plans import oracle_sql as Q
from cardsight.plans.catalog import register
from cardsight.sources.transactions import load_transactions

# The deterministic test score and its dataset cut.
SCORE_DIVISOR = 500.0
TEST_FROM_DAY = 21
RULE_DIVISORS = (250.0, 500.0, 1000.0)
#: Decimals of floating sums that are compared across engines.
DECIMALS = 9
METRICS = ("test_acc", "test_f1", "test_recall", "test_precision")


def scored_rows(tx: DataFrame, divisor: float = SCORE_DIVISOR) -> DataFrame:
    score = F.least(F.col(S.TX_AMOUNT) / F.lit(divisor), F.lit(1.0))
    return tx.select(
        F.col(S.TRANSACTION_ID).alias("id"),
        F.col(S.TX_FRAUD).alias("label"),
        score.alias("score"),
        (score > F.lit(0.5)).cast("int").alias("prediction"),
        F.when(F.col(S.TX_TIME_DAYS) < TEST_FROM_DAY, F.lit("Training")).otherwise(F.lit("Test")).alias("dataset"),
    )


SCORED_CTE = f"""scored AS (
  SELECT TRANSACTION_ID AS id, TX_FRAUD AS label, least(TX_AMOUNT / {SCORE_DIVISOR}, 1.0) AS score,
         CAST(least(TX_AMOUNT / {SCORE_DIVISOR}, 1.0) > 0.5 AS INTEGER) AS prediction,
         CASE WHEN TX_TIME_DAYS < {TEST_FROM_DAY} THEN 'Training' ELSE 'Test' END AS dataset
  FROM tx)"""
WITH_SCORED = f"WITH {Q.TX_CTE}, {SCORED_CTE}"


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return scored_rows(load_transactions(spark, sf))


def _d(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


@register(
    "e1_metrics",
    f"""{WITH_SCORED}, c AS (
      SELECT dataset,
             CAST(sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
             CAST(sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
             CAST(sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
             CAST(sum(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn
      FROM scored GROUP BY dataset)
    SELECT dataset, tp, fp, fn, tn,
           coalesce({_d('tp + tn')} / NULLIF(tp + fp + fn + tn, 0), 0.0) AS accuracy,
           coalesce({_d('tp')} / NULLIF(tp + fp, 0), 0.0) AS precision,
           coalesce({_d('tp')} / NULLIF(tp + fn, 0), 0.0) AS recall,
           coalesce({_d('2 * tp')} / NULLIF(2 * tp + fp + fn, 0), 0.0) AS f1
    FROM c""",
)
def q_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ev.binary_metrics(_scored(spark, sf), by=["dataset"])


def _report_sql() -> str:
    per = []
    for c in (0, 1):
        per.append(
            f"sum(CASE WHEN label = {c} AND prediction = {c} THEN 1 ELSE 0 END) AS tp{c}, "
            f"sum(CASE WHEN prediction = {c} THEN 1 ELSE 0 END) AS pred{c}, "
            f"sum(CASE WHEN label = {c} THEN 1 ELSE 0 END) AS sup{c}"
        )
    ratios = []
    for c in (0, 1):
        ratios.append(
            f"coalesce({_d(f'tp{c}')} / NULLIF(pred{c}, 0), 0.0) AS p{c}, "
            f"coalesce({_d(f'tp{c}')} / NULLIF(sup{c}, 0), 0.0) AS r{c}, "
            f"coalesce({_d(f'2 * tp{c}')} / NULLIF(pred{c} + sup{c}, 0), 0.0) AS f{c}"
        )
    return f"""{WITH_SCORED},
      w AS (SELECT count(*) AS total, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS correct,
                   {', '.join(per)} FROM scored WHERE dataset = 'Test'),
      m AS (SELECT *, {', '.join(ratios)}, coalesce({_d('correct')} / NULLIF(total, 0), 0.0) AS acc FROM w)
    SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, {_d('sup0')} AS support FROM m
    UNION ALL SELECT '1', p1, r1, f1, {_d('sup1')} FROM m
    UNION ALL SELECT 'accuracy', acc, acc, acc, acc FROM m
    UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, {_d('total')} FROM m
    UNION ALL SELECT 'weighted avg',
        coalesce((p0 * {_d('sup0')} + p1 * {_d('sup1')}) / NULLIF({_d('total')}, 0), 0.0),
        coalesce((r0 * {_d('sup0')} + r1 * {_d('sup1')}) / NULLIF({_d('total')}, 0), 0.0),
        coalesce((f0 * {_d('sup0')} + f1 * {_d('sup1')}) / NULLIF({_d('total')}, 0), 0.0),
        {_d('total')} FROM m"""


@register("e2_report", _report_sql())
def q_report(spark: SparkSession, sf: str) -> DataFrame:
    return ev.classification_report(_scored(spark, sf).where(F.col("dataset") == "Test"))


@register(
    "e3_confusion",
    f"""{WITH_SCORED}, c AS (
      SELECT label, CAST(sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END) AS BIGINT) AS pred_0,
             CAST(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pred_1
      FROM scored WHERE dataset = 'Test' GROUP BY label)
    SELECT label, pred_0, pred_1, {_d('pred_0')} / (pred_0 + pred_1) AS share_0,
           {_d('pred_1')} / (pred_0 + pred_1) AS share_1 FROM c""",
)
def q_confusion(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_scored(spark, sf).where(F.col("dataset") == "Test"))


CURVE_CTE = """c AS (
  SELECT dataset, score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
         sum(CASE WHEN label <> 1 THEN 1 ELSE 0 END) AS neg
  FROM scored WHERE score IS NOT NULL GROUP BY dataset, score),
r AS (
  SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, lead(pos) OVER o AS np, lead(neg) OVER o AS nn,
         row_number() OVER o AS rn, sum(pos) OVER (PARTITION BY dataset) AS P,
         sum(neg) OVER (PARTITION BY dataset) AS N
  FROM c
  WINDOW o AS (PARTITION BY dataset ORDER BY score DESC),
         w AS (PARTITION BY dataset ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register(
    "e4_roc",
    f"""{WITH_SCORED}, {CURVE_CTE}
    SELECT dataset, score AS threshold, {_d('cn')} / N * 100.0 AS fpr_pct, {_d('cp')} / P * 100.0 AS tpr_pct
    FROM r WHERE rn = 1 OR np IS NULL OR NOT (np = pos AND nn = neg)
    UNION ALL SELECT DISTINCT dataset, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM scored WHERE score IS NOT NULL""",
)
def q_roc(spark: SparkSession, sf: str) -> DataFrame:
    """ROC points per dataset in percent, collinear points dropped, origin added."""
    return ev.roc_curve(_scored(spark, sf), by=["dataset"])


@register(
    "e5_roc_auc",
    f"""{WITH_SCORED}, {CURVE_CTE}
    SELECT dataset, CAST(sum(CAST(pos AS HUGEINT) * (2 * (N - cn) + neg)) AS DOUBLE)
                    / (CAST(2 AS DOUBLE) * CAST(P AS DOUBLE) * CAST(N AS DOUBLE)) AS roc_auc
    FROM r GROUP BY dataset, P, N""",
)
def q_auc(spark: SparkSession, sf: str) -> DataFrame:
    return ev.roc_auc(_scored(spark, sf), by=["dataset"])


@register(
    "e6_pr_auc",
    f"""{WITH_SCORED}, {CURVE_CTE}, q AS (
      SELECT dataset, {_d('pos')} / P AS step, {_d('cp')} / (cp + cn) AS prec,
             coalesce({_d('cp - pos')} / NULLIF(cp - pos + cn - neg, 0), 1.0) AS before FROM r)
    SELECT dataset, round(sum(step * (prec + before) / 2.0), {DECIMALS}) AS pr_auc,
           round(sum(step * prec), {DECIMALS}) AS average_precision FROM q GROUP BY dataset""",
)
def q_pr_auc(spark: SparkSession, sf: str) -> DataFrame:
    """Area under the precision-recall curve per dataset (floating sums, rounded)."""
    areas = ev.pr_auc(_scored(spark, sf), by=["dataset"])
    return areas.select("dataset", *[F.round(c, DECIMALS).alias(c) for c in ("pr_auc", "average_precision")])


@register(
    "e7_histogram",
    f"""{WITH_SCORED}
    SELECT label, CAST(least(floor(score * 20), 19) AS INTEGER) AS bin,
           CAST(CAST(least(floor(score * 20), 19) AS INTEGER) AS DOUBLE) / 20.0 AS bin_start,
           count(*) AS count
    FROM scored WHERE score IS NOT NULL GROUP BY 1, 2, 3""",
)
def q_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return ev.score_histogram(_scored(spark, sf), nbins=20)


@register(
    "e7_quartiles",
    f"""{WITH_SCORED}, r AS (
      SELECT label, score, row_number() OVER (PARTITION BY label ORDER BY score, id) AS rn,
             count(*) OVER (PARTITION BY label) AS n
      FROM scored WHERE score IS NOT NULL)
    SELECT label, n,
           max(CASE WHEN rn = greatest(1, ceil(0.25 * n)) THEN score END) AS q25,
           max(CASE WHEN rn = greatest(1, ceil(0.5 * n)) THEN score END) AS q50,
           max(CASE WHEN rn = greatest(1, ceil(0.75 * n)) THEN score END) AS q75
    FROM r GROUP BY label, n""",
)
def q_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Box-plot quartiles per label (discrete), exact."""
    return ev.score_quartiles(_scored(spark, sf))


# --------------------------------------------------------------------------- E8 on rule scorers


def rule_fold_scores(tx: DataFrame) -> DataFrame:
    """Fold metrics of fixed amount-threshold scorers over 5 stratified folds:
    ``model_name, fold, test_acc, test_f1, test_recall, test_precision``."""
    folded = smp.stratified_folds(tx.select(S.TRANSACTION_ID, S.TX_FRAUD, S.TX_AMOUNT), 5)
    rules = F.array(*[F.struct(F.lit(f"amount/{int(d)}").alias("name"), F.lit(d).alias("d")) for d in RULE_DIVISORS])
    rows = folded.select("*", F.explode(rules).alias("rule")).select(
        F.col("rule.name").alias("model_name"),
        "fold",
        F.col(S.TX_FRAUD).alias("label"),
        (F.least(F.col(S.TX_AMOUNT) / F.col("rule.d"), F.lit(1.0)) > 0.5).cast("int").alias("prediction"),
    )
    m = ev.binary_metrics(rows, by=["model_name", "fold"])
    return m.select(
        "model_name",
        "fold",
        F.col("accuracy").alias("test_acc"),
        F.col("f1").alias("test_f1"),
        F.col("recall").alias("test_recall"),
        F.col("precision").alias("test_precision"),
    )


def _ranking_sql() -> str:
    from cardsight.plans.sampling_queries import folds_ctes

    rules = " UNION ALL ".join(f"SELECT 'amount/{int(d)}' AS name, {d} AS d" for d in RULE_DIVISORS)
    means = ", ".join(
        f"list_reduce(list({m} ORDER BY fold), lambda a, b: a + b) / count(*) AS mean_{m}" for m in METRICS
    )
    return f"""WITH {Q.TX_CTE}, {folds_ctes(5)},
      rules AS ({rules}),
      rows AS (SELECT rules.name AS model_name, f.fold, f.TX_FRAUD AS label,
                      CAST(least(tx.TX_AMOUNT / rules.d, 1.0) > 0.5 AS INTEGER) AS prediction
               FROM folded f JOIN tx USING (TRANSACTION_ID), rules),
      c AS (SELECT model_name, fold,
                   sum(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS tp,
                   sum(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS fp,
                   sum(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS fn,
                   sum(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS tn
            FROM rows GROUP BY model_name, fold),
      s AS (SELECT model_name, fold,
                   coalesce({_d('tp + tn')} / NULLIF(tp + fp + fn + tn, 0), 0.0) AS test_acc,
                   coalesce({_d('2 * tp')} / NULLIF(2 * tp + fp + fn, 0), 0.0) AS test_f1,
                   coalesce({_d('tp')} / NULLIF(tp + fn, 0), 0.0) AS test_recall,
                   coalesce({_d('tp')} / NULLIF(tp + fp, 0), 0.0) AS test_precision FROM c),
      g AS (SELECT model_name, {means} FROM s GROUP BY model_name)
    SELECT *, CAST(row_number() OVER (ORDER BY mean_test_f1 DESC, model_name ASC) AS INTEGER) AS rank FROM g"""


@register("e8_model_ranking", _ranking_sql())
def q_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Mean fold metrics per scorer, ranked by mean F1 (rank 1 is the winner)."""
    scores = rule_fold_scores(load_transactions(spark, sf))
    summary = ev.fold_metric_summary(scores, METRICS).select("model_name", *[f"mean_{m}" for m in METRICS])
    return ev.rank_models(summary, "mean_test_f1")


def _mean_std_sql() -> str:
    base = _ranking_sql()
    body = base[: base.rindex("g AS (SELECT model_name")].rstrip().rstrip(",")
    columns = ", ".join(
        f"round(avg({m}), {DECIMALS}) AS mean_{m}, round(stddev_pop({m}), {DECIMALS}) AS std_{m}" for m in METRICS
    )
    return f"{body} SELECT model_name, {columns} FROM s GROUP BY model_name"


@register("a5_fold_mean_std", _mean_std_sql())
def q_mean_std(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and population std of every fold metric per scorer, rounded."""
    summary = ev.fold_metric_summary(rule_fold_scores(load_transactions(spark, sf)), METRICS)
    names = [f"{kind}_{m}" for m in METRICS for kind in ("mean", "std")]
    return summary.select("model_name", *[F.round(c, DECIMALS).alias(c) for c in names])


def _best_rule_sql() -> str:
    base = _ranking_sql()
    body = base[: base.rindex("g AS (SELECT model_name")].rstrip().rstrip(",")
    return f"""{body}, t AS (SELECT *, row_number() OVER (ORDER BY model_name, fold) AS trial FROM s)
      SELECT CAST(fold AS DOUBLE) AS best_fold, test_recall AS best_value FROM t ORDER BY test_recall DESC, trial LIMIT 1"""


@register("a7_best_rule", _best_rule_sql())
def q_best_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Best value and its parameters over fixed trial rows (the rule scorers' folds)."""
    from cardsight.operators import models as md

    by_name = Window.orderBy("model_name", "fold")  # one row per scorer and fold
    trials = rule_fold_scores(load_transactions(spark, sf)).select(
        F.row_number().over(by_name).alias("trial"),
        F.create_map(F.lit("fold"), F.col("fold").cast("double")).alias("params"),
        F.col("test_recall").alias("value"),
    )
    return md.best_trial(trials).select(F.col("best_params")["fold"].alias("best_fold"), "best_value")


def _winners_sql() -> str:
    base = _ranking_sql()
    body = base[: base.rindex("SELECT *, CAST(row_number()")]
    unpivot = " UNION ALL ".join(f"SELECT model_name, '{m}' AS metric, mean_{m} AS mean FROM g" for m in METRICS)
    return f"""{body}, lg AS ({unpivot}),
      rk AS (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY mean DESC, model_name ASC) AS r FROM lg)
    SELECT model_name, metric, mean FROM rk WHERE r = 1"""


@register("e8_winners", _winners_sql())
def q_winners(spark: SparkSession, sf: str) -> DataFrame:
    """The winning scorer per mean metric."""
    scores = rule_fold_scores(load_transactions(spark, sf))
    return ev.winners(ev.fold_metric_summary(scores, METRICS), METRICS)


@register(
    "u3_labelled_roc_union",
    f"""{WITH_SCORED}, {CURVE_CTE}
    SELECT dataset AS "Dataset", {_d('cn')} / N * 100.0 AS "False Positive", {_d('cp')} / P * 100.0 AS "True Positive"
    FROM r WHERE rn = 1 OR np IS NULL OR NOT (np = pos AND nn = neg)
    UNION ALL SELECT DISTINCT dataset, 0.0, 0.0 FROM scored WHERE score IS NOT NULL""",
)
def q_roc_union(spark: SparkSession, sf: str) -> DataFrame:
    """ROC of the training and test rows computed separately, labelled and concatenated."""
    scored = _scored(spark, sf)
    parts = []
    for name in ("Training", "Test"):
        curve = ev.roc_curve(scored.where(F.col("dataset") == name), by=())
        parts.append(
            curve.select(
                F.lit(name).alias("Dataset"),
                F.col("fpr_pct").alias("False Positive"),
                F.col("tpr_pct").alias("True Positive"),
            )
        )
    return parts[0].unionByName(parts[1])
