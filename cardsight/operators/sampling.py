"""Class rebalancing and sampling: scaling, exact seeded samples, weights, folds.

Randomness is a pure function of (seed, row id): the order key is the first
60 bits of ``md5('seed:id')`` with the id as tiebreak, so results are stable
under retries, executor loss and repartitioning, and reproducible in SQL.
Per-class cut points come from ``selection.kth_smallest``; applying them is a
filter, so no step gathers a class into one task. Only per-class counts and
per-feature moments (bounded by the number of classes and features) reach
the driver, the way a fitted Spark ML model carries its statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.hashing import seeded_key
from cardsight.operators.selection import kth_smallest

ORDER_KEY = "_order_key"


# --------------------------------------------------------------------------- counts, weights, prior


def class_counts(df: DataFrame, label: str = S.LABEL_COLUMN) -> DataFrame:
    """``label, count`` per class (partial aggregation map side)."""
    return df.groupBy(label).agg(F.count("*").alias("count"))


def class_count_map(df: DataFrame, label: str = S.LABEL_COLUMN) -> dict:
    """Class counts on the driver (one row per class)."""
    return {r[label]: r["count"] for r in class_counts(df, label).collect()}


def balanced_weight_column(counts: dict, label: str = S.LABEL_COLUMN, n_classes: int = 2) -> Column:
    """``total / (n_classes * count[label])`` as a CASE over the known classes."""
    total = sum(counts.values())
    expr = None
    for cls, n in sorted(counts.items(), key=lambda kv: (kv[0] is None, kv[0])):
        w = total / (n_classes * n)
        expr = (F.when(F.col(label) == F.lit(cls), F.lit(w)) if expr is None else expr.when(F.col(label) == F.lit(cls), F.lit(w)))
    return expr.otherwise(F.lit(None).cast("double"))


def with_class_weights(df: DataFrame, label: str = S.LABEL_COLUMN, name: str = "weight") -> DataFrame:
    """Balanced class weights attached as a column (feeds ``weightCol``)."""
    return df.withColumn(name, balanced_weight_column(class_count_map(df, label), label))


def class_weight_table(df: DataFrame, label: str = S.LABEL_COLUMN) -> DataFrame:
    """``label, count, weight`` with weight = total / (2 * count)."""
    counts = class_counts(df, label)
    total = F.sum("count").over(_whole())
    return counts.select(label, "count", (total / (F.lit(2.0) * F.col("count"))).alias("weight"))


def _whole():
    from pyspark.sql import Window

    # A window over the per-class table (one row per class), not over the data.
    return Window.partitionBy(F.lit(0))


def log_odds_prior(df: DataFrame, label: str = S.LABEL_COLUMN) -> DataFrame:
    """One row: positives, negatives and ``log(positives / negatives)``."""
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long")
    neg = F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).cast("long")
    agg = df.agg(pos.alias("n_fraud"), neg.alias("n_not_fraud"))
    return agg.withColumn("log_odds", F.log(F.try_divide(F.col("n_fraud").cast("double"), F.col("n_not_fraud"))))


# --------------------------------------------------------------------------- scaling


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Per column ``(mean, population std)``; one aggregate, 2 numbers per column."""
    aggs = []
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """``(x - mean) / std`` per column; a constant column (std 0) is divided by 1."""
    cols = {}
    for c, (mean, std) in stats.items():
        scale = std if std not in (None, 0.0) and not math.isnan(std) else 1.0
        cols[c] = (F.col(c).cast("double") - F.lit(mean if mean is not None else 0.0)) / F.lit(scale)
    return df.withColumns(cols)


# --------------------------------------------------------------------------- exact seeded samples


def order_key(seed: int, id_col: str = S.TRANSACTION_ID) -> Column:
    """First 60 bits of ``md5('seed:id')`` as a non-negative long."""
    return F.conv(F.substring(seeded_key(seed, id_col), 1, 15), 16, 10).cast("long")


def sample_per_class(
    df: DataFrame,
    quotas: dict,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    seed: int = 0,
    counts: dict | None = None,
) -> DataFrame:
    """Exactly ``min(quota, count)`` rows of each class, uniformly without
    replacement: the rows with the smallest seeded order keys. Classes absent
    from ``quotas`` are kept whole. ``counts`` (rows per class) skips a count
    job when the caller already knows them."""
    keyed = df.withColumn(ORDER_KEY, order_key(seed, id_col))
    counts = counts if counts is not None else class_count_map(df, label)
    targets = [(c, int(q)) for c, q in quotas.items() if 0 < q < counts.get(c, 0)]
    cuts = kth_smallest(keyed, label, ORDER_KEY, id_col, targets)
    keep = None
    for cls in counts:
        is_cls = F.col(label).isNull() if cls is None else (F.col(label) == F.lit(cls))
        q = quotas.get(cls)
        if q is None or q >= counts[cls]:
            cond = is_cls
        elif q <= 0:
            continue
        else:
            v, tb = cuts[(cls, int(q))]
            k = F.col(ORDER_KEY)
            cond = is_cls & ((k < F.lit(v)) | ((k == F.lit(v)) & (F.col(id_col) <= F.lit(tb))))
        keep = cond if keep is None else (keep | cond)
    if keep is None:
        return df.where(F.lit(False))
    return keyed.where(keep).drop(ORDER_KEY)


def undersample(
    df: DataFrame,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    ratio: float = 1.0,
    seed: int = 0,
    counts: dict | None = None,
) -> DataFrame:
    """Random undersampling of every majority class to ``n_minority / ratio`` rows."""
    counts = counts if counts is not None else class_count_map(df, label)
    n_min = min(counts.values())
    quotas = {c: (n if n == n_min else int(n_min / ratio)) for c, n in counts.items()}
    return sample_per_class(df, quotas, label, id_col, seed, counts)


# --------------------------------------------------------------------------- stratified folds


def fold_allocation(counts: dict, n_splits: int = 5) -> dict:
    """Per class, the rows each fold receives: classes in sorted order occupy
    consecutive positions and fold i takes the positions congruent to i."""
    out = {}
    start = 0
    for cls in sorted(counts):
        c = counts[cls]
        out[cls] = [_count_congruent(start, start + c, i, n_splits) for i in range(n_splits)]
        start += c
    return out


def _count_congruent(lo: int, hi: int, i: int, n: int) -> int:
    """#{p in [lo, hi) : p % n == i}."""
    return (hi - 1 - i) // n - (lo - 1 - i) // n


def stratified_folds(
    df: DataFrame,
    n_splits: int = 5,
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    name: str = "fold",
) -> DataFrame:
    """Contiguous, unshuffled stratified folds: within each class, rows in id
    order are cut into consecutive blocks whose sizes follow
    ``fold_allocation``. Block starts are order statistics found by
    ``kth_smallest``; the fold of a row is the number of block starts at or
    before its id."""
    counts = class_count_map(df, label)
    alloc = fold_allocation(counts, n_splits)
    targets = []
    starts = {}
    for cls, sizes in alloc.items():
        cum = 0
        starts[cls] = []
        for i in range(1, n_splits):
            cum += sizes[i - 1]
            if cum < counts[cls]:
                starts[cls].append(cum + 1)  # 1-based rank of the block's first row
                targets.append((cls, cum + 1))
    cuts = kth_smallest(df, label, id_col, id_col, targets)
    expr = None
    for cls, ranks in starts.items():
        fold = F.lit(0)
        for r in ranks:
            fold = fold + (F.col(id_col) >= F.lit(cuts[(cls, r)][0])).cast("int")
        expr = F.when(F.col(label) == F.lit(cls), fold) if expr is None else expr.when(F.col(label) == F.lit(cls), fold)
    return df.withColumn(name, expr)
