"""Binary-classifier evaluation as relational aggregation.

Input: scored rows ``(id, label, score, prediction[, dataset])``. Everything
is computed from small aggregates (counts per class/prediction, per distinct
score) plus the distributed ordered scan for curves, so no step gathers the
rows of a dataset into one task. Ratios that are undefined are 0 (the
convention of the usual metric libraries).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight.operators.ordered import ordered_scan
from cardsight.operators.selection import kth_smallest
from cardsight.session import materialize


def _ratio0(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


# --------------------------------------------------------------------------- E1: headline metrics


def binary_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall, f1 for the positive class 1."""
    y, p = F.col(label), F.col(prediction)
    agg = df.groupBy(*by).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y != 1) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p != 1)).cast("long")).alias("fn"),
        F.sum(((y != 1) & (p != 1)).cast("long")).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return agg.select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        _ratio0(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, tp + fn).alias("recall"),
        _ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def metrics_map(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict[str, float]:
    """The four metrics as a dict (one small aggregate)."""
    row = binary_metrics(df, label, prediction).first()
    return {k: float(row[k]) for k in ("accuracy", "precision", "recall", "f1")}


# --------------------------------------------------------------------------- E2, E3


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    return df.groupBy(*by, label, prediction).agg(F.count("*").alias("n"))


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Rows ``0``, ``1``, ``accuracy``, ``macro avg``, ``weighted avg`` with
    precision, recall, f1_score and support; the accuracy row repeats the
    accuracy in every column (the layout of the transposed report)."""
    cc = confusion_counts(df, label, prediction)
    y, p, n = F.col(label), F.col(prediction), F.col("n")
    aggs = [F.sum(n).alias("total"), F.sum(F.when(y == p, n).otherwise(0)).alias("correct")]
    for c in classes:
        aggs += [
            F.sum(F.when((y == c) & (p == c), n).otherwise(0)).alias(f"tp{c}"),
            F.sum(F.when(p == c, n).otherwise(0)).alias(f"pred{c}"),
            F.sum(F.when(y == c, n).otherwise(0)).alias(f"sup{c}"),
        ]
    wide = cc.agg(*aggs)
    per_class = []
    for c in classes:
        prec = _ratio0(F.col(f"tp{c}"), F.col(f"pred{c}"))
        rec = _ratio0(F.col(f"tp{c}"), F.col(f"sup{c}"))
        f1 = _ratio0(2 * F.col(f"tp{c}"), F.col(f"pred{c}") + F.col(f"sup{c}"))
        per_class.append((prec, rec, f1, F.col(f"sup{c}").cast("double")))
    k = float(len(classes))
    total = F.col("total").cast("double")
    acc = _ratio0(F.col("correct"), F.col("total"))
    rows = [
        F.struct(F.lit(str(c)).alias("class"), pr.alias("precision"), rc.alias("recall"), f.alias("f1_score"), s.alias("support"))
        for c, (pr, rc, f, s) in zip(classes, per_class)
    ]
    rows.append(F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1_score"), acc.alias("support")))

    def macro(i: int) -> Column:
        out = per_class[0][i]
        for pc in per_class[1:]:
            out = out + pc[i]
        return out / F.lit(k)

    def weighted(i: int) -> Column:
        out = per_class[0][i] * per_class[0][3]
        for pc in per_class[1:]:
            out = out + pc[i] * pc[3]
        return _ratio0(out, total)

    rows.append(F.struct(F.lit("macro avg").alias("class"), macro(0).alias("precision"), macro(1).alias("recall"), macro(2).alias("f1_score"), total.alias("support")))
    rows.append(F.struct(F.lit("weighted avg").alias("class"), weighted(0).alias("precision"), weighted(1).alias("recall"), weighted(2).alias("f1_score"), total.alias("support")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Counts per (true, predicted) class and the rows normalised by true class."""
    wide = df.groupBy(label).pivot(prediction, list(classes)).agg(F.count(F.lit(1))).na.fill(0, [str(c) for c in classes])
    row_total = None
    for c in classes:
        row_total = F.col(str(c)) if row_total is None else row_total + F.col(str(c))
    return wide.select(
        label,
        *[F.col(str(c)).cast("long").alias(f"pred_{c}") for c in classes],
        *[F.try_divide(F.col(str(c)).cast("double"), row_total).alias(f"share_{c}") for c in classes],
    )


# --------------------------------------------------------------------------- E4-E6: curves


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (NULL scores dropped)."""
    y = F.col(label)
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(F.sum((y == 1).cast("long")).alias("pos"), F.sum((y != 1).cast("long")).alias("neg"))
    )


def _curve_points(df, label, score, by):
    """Per distinct score: pos, neg, running cum_pos/cum_neg (descending),
    the next score's pos/neg, and the group totals P and N. Counts and points
    are materialised: the scored rows are aggregated once for a curve."""
    counts = materialize(score_counts(df, label, score, by))
    scanned = ordered_scan(counts, score, ["pos", "neg"], ["pos", "neg"], descending=True, group_cols=by)
    return materialize(scanned.withColumnsRenamed({"total_pos": "P", "total_neg": "N"}))


def roc_curve(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = ("dataset",),
    drop_intermediate: bool = True,
) -> DataFrame:
    """ROC points in percent: ``by..., threshold, fpr_pct, tpr_pct``.

    One point per distinct score (descending) plus the origin at threshold
    +inf. With ``drop_intermediate`` a point is dropped when the next score
    adds the same (negatives, positives) as it did, i.e. it lies on the line
    through its neighbours; the first and last points are always kept.
    """
    by = list(by)
    pts = _curve_points(df, label, score, by)
    first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    last = F.col("next_pos").isNull()
    same_step = (F.col("next_pos") == F.col("pos")) & (F.col("next_neg") == F.col("neg"))
    keep = first | last | ~same_step if drop_intermediate else F.lit(True)
    curve = pts.where(keep).select(
        *by,
        F.col(score).cast("double").alias("threshold"),
        (F.try_divide(F.col("cum_neg").cast("double"), F.col("N")) * 100.0).alias("fpr_pct"),
        (F.try_divide(F.col("cum_pos").cast("double"), F.col("P")) * 100.0).alias("tpr_pct"),
    )
    origin = pts.where(first).select(  # one first point in each group
        *by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr_pct"), F.lit(0.0).alias("tpr_pct")
    )
    return curve.unionByName(origin)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Area under the ROC curve, ties counted half:
    ``sum(pos_s * (2 * neg_below_s + neg_s)) / (2 * P * N)``, with the sum in
    exact integer arithmetic."""
    by = list(by)
    pts = _curve_points(df, label, score, by)
    term = F.col("pos").cast("decimal(38,0)") * (
        (F.lit(2) * (F.col("N") - F.col("cum_neg")) + F.col("neg")).cast("decimal(38,0)")
    )
    agg = pts.groupBy(*by).agg(F.sum(term).alias("num"), F.first("P").alias("P"), F.first("N").alias("N"))
    return agg.select(
        *by,
        F.try_divide(F.col("num").cast("double"), F.lit(2.0) * F.col("P") * F.col("N")).alias("roc_auc"),
    )


def pr_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Area under the precision-recall curve: the trapezoid rule over recall,
    from recall 0 at precision 1, and the average precision beside it."""
    by = list(by)
    pts = _curve_points(df, label, score, by)
    precision = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg"))
    pos_before, neg_before = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    precision_before = F.coalesce(F.try_divide(pos_before.cast("double"), pos_before + neg_before), F.lit(1.0))
    step = F.try_divide(F.col("pos").cast("double"), F.col("P"))
    return pts.groupBy(*by).agg(
        F.sum(step * (precision + precision_before) / 2.0).alias("pr_auc"),
        F.sum(step * precision).alias("average_precision"),
    )


# --------------------------------------------------------------------------- E7: score distribution


def score_histogram(
    df: DataFrame, label: str = "label", score: str = "score", nbins: int = 20, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per (label, bin) with ``bin = floor(score * nbins)`` clipped to the last bin."""
    b = F.least(F.floor(F.col(score) * nbins), F.lit(nbins - 1)).cast("int")
    return (
        df.where(F.col(score).isNotNull())
        .groupBy(*by, label, b.alias("bin"))
        .agg(F.count("*").alias("count"))
        .select(*by, label, "bin", (F.col("bin") / float(nbins)).alias("bin_start"), "count")
    )


def score_quartiles(
    df: DataFrame, label: str = "label", score: str = "score", id_col: str = "id", qs=(0.25, 0.5, 0.75)
) -> DataFrame:
    """Discrete quartiles (box-plot marginal) per label: the k-th smallest
    score with ``k = ceil(q * n)``; exact, via distributed order statistics."""
    import math

    counts = {r[label]: r["n"] for r in df.where(F.col(score).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()}
    targets = [(lbl, max(1, math.ceil(q * n))) for lbl, n in counts.items() for q in qs]
    cuts = kth_smallest(df, label, score, id_col, targets)
    rows = []
    for lbl, n in sorted(counts.items(), key=lambda kv: (kv[0] is None, kv[0])):
        vals = [cuts[(lbl, max(1, math.ceil(q * n)))][0] for q in qs]
        rows.append((lbl, n, *vals))
    names = [f"q{int(round(q * 100))}" for q in qs]
    schema = f"{label} int, n long, " + ", ".join(f"{c} double" for c in names)
    return df.sparkSession.createDataFrame(rows, schema)


# --------------------------------------------------------------------------- E8: model ranking


def fold_metric_summary(
    scores: DataFrame,
    metrics: Sequence[str],
    model_col: str = "model_name",
    fold_col: str = "fold",
) -> DataFrame:
    """Per model: mean (summed in fold order, so deterministic) and population
    std of each metric over its folds; the folds of one model are few."""
    items = F.array_sort(F.collect_list(F.struct(F.col(fold_col).alias("f"), *[F.col(m).alias(m) for m in metrics])))
    agg = scores.groupBy(model_col).agg(items.alias("_items"), *[F.stddev_pop(m).alias(f"std_{m}") for m in metrics])
    def adder(m: str):
        return lambda acc, e: acc + e[m]

    means = {f"mean_{m}": F.aggregate("_items", F.lit(0.0), adder(m)) / F.size("_items") for m in metrics}
    return agg.withColumns(means).drop("_items")


def rank_models(summary: DataFrame, by: str = "mean_test_f1", model_col: str = "model_name") -> DataFrame:
    """Models ordered by a mean metric, descending (ties by name); rank 1 wins."""
    w = Window.orderBy(F.col(by).desc(), F.col(model_col).asc())  # one row per model
    return summary.withColumn("rank", F.row_number().over(w))


def winners(summary: DataFrame, metrics: Sequence[str], model_col: str = "model_name") -> DataFrame:
    """The best model per mean metric (name order breaks ties)."""
    long = summary.select(
        model_col,
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"mean_{m}").alias("mean")) for m in metrics])
        ).alias("kv"),
    ).select(model_col, "kv.metric", "kv.mean")
    w = Window.partitionBy("metric").orderBy(F.col("mean").desc(), F.col(model_col).asc())  # models per metric
    return long.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1).drop("_r")
