"""Registered sampling/rebalancing queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import features as feat
from cardsight.operators import sampling as smp
from cardsight.operators import split as sp
from cardsight.plans import oracle_sql as Q
from cardsight.plans.catalog import register
from cardsight.session import materialize
from cardsight.sources.transactions import load_transactions

SEED = 0
LBL = S.TX_FRAUD
ID = S.TRANSACTION_ID


def _hash_sql(seed: int = SEED) -> str:
    return f"substr(md5('{seed}:' || CAST(TRANSACTION_ID AS VARCHAR)), 1, 15)"


@register(
    "a3_class_counts",
    f"WITH {Q.TX_CTE} SELECT TX_FRAUD, count(*) AS count FROM tx GROUP BY TX_FRAUD",
)
def q_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return smp.class_counts(load_transactions(spark, sf), LBL)


@register(
    "b4_class_weights",
    f"""WITH {Q.TX_CTE}, c AS (SELECT TX_FRAUD, count(*) AS count FROM tx GROUP BY TX_FRAUD)
        SELECT TX_FRAUD, count, CAST(sum(count) OVER () AS BIGINT) / (2.0 * count) AS weight FROM c""",
)
def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return smp.class_weight_table(load_transactions(spark, sf), LBL)


@register(
    "b4_weighted_rows",
    f"""WITH {Q.TX_CTE}, c AS (SELECT TX_FRAUD, count(*) AS n FROM tx GROUP BY TX_FRAUD)
        SELECT TRANSACTION_ID, TX_FRAUD, CAST((SELECT sum(n) FROM c) AS BIGINT) / (2.0 * c.n) AS weight
        FROM tx JOIN c USING (TX_FRAUD)""",
)
def q_weighted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every row with its balanced class weight (the ``weightCol`` input)."""
    tx = load_transactions(spark, sf).select(ID, LBL)
    return smp.with_class_weights(tx, LBL)


@register(
    "b5_log_odds",
    f"""WITH {Q.TX_CTE} SELECT CAST(sum(CASE WHEN TX_FRAUD = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_fraud,
        CAST(sum(CASE WHEN TX_FRAUD = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_not_fraud,
        ln(CAST(sum(CASE WHEN TX_FRAUD = 1 THEN 1 ELSE 0 END) AS DOUBLE)
           / sum(CASE WHEN TX_FRAUD = 0 THEN 1 ELSE 0 END)) AS log_odds FROM tx""",
)
def q_log_odds(spark: SparkSession, sf: str) -> DataFrame:
    return smp.log_odds_prior(load_transactions(spark, sf), LBL)


@register(
    "b3_undersample",
    f"""WITH {Q.TX_CTE}, c AS (SELECT TX_FRAUD, count(*) AS n FROM tx GROUP BY TX_FRAUD),
        r AS (SELECT TRANSACTION_ID, TX_FRAUD,
                     row_number() OVER (PARTITION BY TX_FRAUD ORDER BY {_hash_sql()}, TRANSACTION_ID) AS rn
              FROM tx)
        SELECT TRANSACTION_ID, TX_FRAUD FROM r WHERE rn <= (SELECT min(n) FROM c)""",
)
def q_undersample(spark: SparkSession, sf: str) -> DataFrame:
    """Majority class undersampled to the minority count (ratio 1), seed 0."""
    tx = load_transactions(spark, sf).select(ID, LBL)
    return smp.undersample(tx, LBL, ID, ratio=1.0, seed=SEED)


@register(
    "b6_stratified_sample",
    f"""WITH {Q.TX_CTE}, r AS (SELECT TRANSACTION_ID, TX_FRAUD,
                     row_number() OVER (PARTITION BY TX_FRAUD ORDER BY {_hash_sql()}, TRANSACTION_ID) AS rn
              FROM tx)
        SELECT TRANSACTION_ID, TX_FRAUD FROM r
        WHERE (TX_FRAUD = 0 AND rn <= 5000) OR (TX_FRAUD = 1 AND rn <= 500)""",
)
def q_stratified(spark: SparkSession, sf: str) -> DataFrame:
    """Exact-n per class: 5,000 legitimate and 500 fraudulent rows (or all, if fewer)."""
    tx = load_transactions(spark, sf).select(ID, LBL)
    return smp.sample_per_class(tx, {0: 5000, 1: 500}, LBL, ID, seed=SEED)


def _alloc_sql(i: int, n: int = 5) -> str:
    return f"CAST(floor((st + n - 1 - {i}) / {n}.0) - floor((st - 1 - {i}) / {n}.0) AS BIGINT)"


def folds_ctes(n: int = 5) -> str:
    """CTEs ending in ``folded(TRANSACTION_ID, TX_FRAUD, fold)`` over ``tx``."""
    alloc = ", ".join(f"{_alloc_sql(i, n)} AS a{i}" for i in range(n))
    cum = [" + ".join(f"a{j}" for j in range(i)) for i in range(1, n)]
    fold = " + ".join(f"CAST(pos >= {c} AS INTEGER)" for c in cum)
    return f"""fc AS (SELECT TX_FRAUD, count(*) AS n FROM tx GROUP BY TX_FRAUD),
        fs AS (SELECT TX_FRAUD, n, coalesce(sum(n) OVER (ORDER BY TX_FRAUD ROWS BETWEEN UNBOUNDED PRECEDING
                                                     AND 1 PRECEDING), 0) AS st FROM fc),
        fa AS (SELECT TX_FRAUD, {alloc} FROM fs),
        fr AS (SELECT TRANSACTION_ID, TX_FRAUD,
                      row_number() OVER (PARTITION BY TX_FRAUD ORDER BY TRANSACTION_ID) - 1 AS pos FROM tx),
        folded AS (SELECT TRANSACTION_ID, TX_FRAUD, CAST({fold} AS INTEGER) AS fold
                   FROM fr JOIN fa USING (TX_FRAUD))"""


@register("b7_folds", f"WITH {Q.TX_CTE}, {folds_ctes(5)} SELECT * FROM folded")
def q_folds(spark: SparkSession, sf: str) -> DataFrame:
    """5 contiguous, unshuffled stratified folds in id order."""
    tx = load_transactions(spark, sf).select(ID, LBL)
    return smp.stratified_folds(tx, 5, LBL, ID)


DECIMALS = 6
START = "2024-01-01"


def _moments_ctes() -> str:
    """``tr``: the 7-day training rows; ``mom``: mean and population std per feature, one row."""
    numbers = {c: f"CAST({c} AS INTEGER)" if c in ("IS_WKD", "IS_NIGHT") else c for c in S.FEATURE_COLUMNS}
    columns = ", ".join(
        f"avg(CAST({x} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({x} AS DOUBLE)) AS s_{c}" for c, x in numbers.items()
    )
    return f"""{Q.WITH_FEATURES}, tr AS (SELECT * FROM features WHERE TX_DATETIME >= TIMESTAMP '{START}'
        AND TX_DATETIME < TIMESTAMP '{START}' + INTERVAL 7 DAY), mom AS (SELECT {columns} FROM tr)"""


def _moments_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(m_{c}, {DECIMALS}) AS mean, round(s_{c}, {DECIMALS}) AS std FROM mom"
        for c in S.FEATURE_COLUMNS
    )
    return f"{_moments_ctes()} {rows}"


def _scaled_sql() -> str:
    from cardsight.plans.split_queries import _test_sql

    numbers = {c: f"CAST({c} AS INTEGER)" if c in ("IS_WKD", "IS_NIGHT") else c for c in S.FEATURE_COLUMNS}
    columns = ", ".join(
        f"round((CAST({x} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, {DECIMALS}) + 0.0 AS {c}"
        for c, x in numbers.items()
    )
    return f"{_moments_ctes()}, {_test_sql('features', START, 7, 7, 7)} SELECT {columns}, TX_FRAUD FROM test, mom"


def _seven_day_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    # Read for the moments and for the rows: materialised once.
    features = materialize(feat.build_features(load_transactions(spark, sf)))
    return sp.prequential_split(features, START, 7, 7, 7)


@register("b1_scaled", _scaled_sql())
def q_scaled(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows of the 7-day split standardised with the training moments
    (population std, constant column divided by 1), rounded."""
    train, test = _seven_day_split(spark, sf)
    scaled = smp.apply_scaler(sp.field_trim(test), smp.fit_scaler(train, S.FEATURE_COLUMNS))
    return scaled.select(*[(F.round(c, DECIMALS) + 0.0).alias(c) for c in S.FEATURE_COLUMNS], S.TX_FRAUD)


@register("a6_feature_moments", _moments_sql())
def q_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Per-feature mean and population std of the training split, one row per
    feature: one wide aggregate, then its single row unpivoted."""
    train, _ = _seven_day_split(spark, sf)
    moments = [
        x.alias(f"{kind}_{c}")
        for c in S.FEATURE_COLUMNS
        for kind, x in (("m", F.avg(F.col(c).cast("double"))), ("s", F.stddev_pop(F.col(c).cast("double"))))
    ]
    rows = [
        F.struct(F.lit(c).alias("feature"), F.round(f"m_{c}", DECIMALS).alias("mean"), F.round(f"s_{c}", DECIMALS).alias("std"))
        for c in S.FEATURE_COLUMNS
    ]
    return train.agg(*moments).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
