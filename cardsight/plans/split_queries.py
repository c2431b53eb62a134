"""Registered split queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from cardsight import schema as S
from cardsight.operators import features as feat
from cardsight.operators import split as sp
from cardsight.operators import windows as win
from cardsight.plans import oracle_sql as Q
from cardsight.plans.catalog import register
from cardsight.session import materialize
from cardsight.sources.transactions import EVENTS_DAY_ORIGIN, load_transactions

START = "2024-01-01"
ORIGIN = dt.date.fromisoformat(EVENTS_DAY_ORIGIN)
SPLIT_COLS = [S.TRANSACTION_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS, S.TX_FRAUD]
_COLS = ", ".join(SPLIT_COLS)


def _train_sql(start: str, t: int) -> str:
    return (
        f"SELECT * FROM tx WHERE TX_DATETIME >= TIMESTAMP '{start}' "
        f"AND TX_DATETIME < TIMESTAMP '{start}' + INTERVAL {t} DAY"
    )


def _test_sql(src: str, start: str, t: int, d: int, n: int, p: str = "") -> str:
    """CTEs ``{p}train``, ``{p}s``, ``{p}test`` written straight from the day-loop
    definition of the known pool."""
    return f"""
{p}train AS (SELECT * FROM {src} WHERE TX_DATETIME >= TIMESTAMP '{start}'
             AND TX_DATETIME < TIMESTAMP '{start}' + INTERVAL {t} DAY),
{p}s AS (SELECT min(TX_TIME_DAYS) AS s FROM {p}train),
{p}test AS (
  SELECT x.* FROM {src} x, {p}s s
  WHERE x.TX_TIME_DAYS BETWEEN s.s + {t + d} AND s.s + {t + d + n - 1}
    AND NOT EXISTS (SELECT 1 FROM {p}train r
                    WHERE r.TX_FRAUD = 1 AND r.CUSTOMER_ID = x.CUSTOMER_ID)
    AND NOT EXISTS (SELECT 1 FROM {src} f
                    WHERE f.TX_FRAUD = 1 AND f.CUSTOMER_ID = x.CUSTOMER_ID
                      AND f.TX_TIME_DAYS >= s.s + {t - 1}
                      AND f.TX_TIME_DAYS <= x.TX_TIME_DAYS - {d + 1}))"""


@register("d2_split_train", f"WITH {Q.TX_CTE} SELECT {_COLS} FROM ({_train_sql(START, 7)})")
def q_split_train(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = sp.prequential_split(load_transactions(spark, sf), START, 7, 7, 7, ORIGIN)
    return train.select(*SPLIT_COLS)


@register("d2_split_test", f"WITH {Q.TX_CTE}, {_test_sql('tx', START, 7, 7, 7)} SELECT {_COLS} FROM test")
def q_split_test(spark: SparkSession, sf: str) -> DataFrame:
    _, test = sp.prequential_split(load_transactions(spark, sf), START, 7, 7, 7, ORIGIN)
    return test.select(*SPLIT_COLS)


@register("d2_split_test_14_7_7", f"WITH {Q.TX_CTE}, {_test_sql('tx', START, 14, 7, 7)} SELECT {_COLS} FROM test")
def q_split_test_14(spark: SparkSession, sf: str) -> DataFrame:
    _, test = sp.prequential_split(load_transactions(spark, sf), START, 14, 7, 7, ORIGIN)
    return test.select(*SPLIT_COLS)


@register("d2_split_test_delay1", f"WITH {Q.TX_CTE}, {_test_sql('tx', START, 7, 1, 7)} SELECT {_COLS} FROM test")
def q_split_test_delay1(spark: SparkSession, sf: str) -> DataFrame:
    _, test = sp.prequential_split(load_transactions(spark, sf), START, 7, 1, 7, ORIGIN)
    return test.select(*SPLIT_COLS)


@register("j2_day_loop_split_test", f"WITH {Q.TX_CTE}, {_test_sql('tx', START, 7, 1, 7)} SELECT {_COLS} FROM test")
def q_day_loop(spark: SparkSession, sf: str) -> DataFrame:
    """The test rows (delay 1) by set operations; must equal ``d2_split_test_delay1``."""
    return sp.rows_in_parts(load_transactions(spark, sf), START, 7, 1, 7, ORIGIN).select(*SPLIT_COLS)


@register(
    "a2_known_fraud_customers",
    f"WITH {Q.TX_CTE} SELECT DISTINCT CUSTOMER_ID FROM ({_train_sql(START, 7)}) WHERE TX_FRAUD = 1",
)
def q_known_customers(spark: SparkSession, sf: str) -> DataFrame:
    train = sp.training_window(load_transactions(spark, sf), START, 7)
    return sp.known_fraud_customers(train)


def _three_way_sql() -> str:
    feats = Q.FEATURE_LIST
    outer = _test_sql("features", START, 21, 7, 7, p="outer_")
    inner = _test_sql("outer_train", START, 7, 7, 7, p="inner_")
    return (
        f"{Q.WITH_FEATURES}, {outer}, {inner} "
        f"SELECT {feats}, TX_FRAUD, 'train' AS split FROM inner_train "
        f"UNION ALL SELECT {feats}, TX_FRAUD, 'validate' AS split FROM inner_test "
        f"UNION ALL SELECT {feats}, TX_FRAUD, 'test' AS split FROM outer_test"
    )


@register("d3_three_way_split", _three_way_sql())
def q_three_way(spark: SparkSession, sf: str) -> DataFrame:
    """Outer split with 21 training days, inner split of those with 7; trimmed to features + label."""
    # Materialised once: the split reads the feature table several times.
    features = materialize(feat.build_features(load_transactions(spark, sf)))
    train, validate, test = sp.three_way_split(features, START, 21, 7, 7, 7, ORIGIN)
    return sp.labelled_union(
        {"train": sp.field_trim(train), "validate": sp.field_trim(validate), "test": sp.field_trim(test)}
    )


@register(
    "j1_attach_feature",
    f"WITH {Q.TX_CTE}, {Q.BASE_CTE} SELECT {Q.RAW}, {Q.terminal_risk(30)} FROM base",
    timestamps=(S.TX_DATETIME,),
)
def q_attach(spark: SparkSession, sf: str) -> DataFrame:
    """Attach a feature computed on its own to the rows by a left join on the id."""
    tx = load_transactions(spark, sf)
    risk = win.fraud_risk(tx.select(S.TRANSACTION_ID, S.TERMINAL_ID, S.TX_DATETIME, S.TX_FRAUD),
                          "TERMINAL_FRAUD_RISK_30_DAY", n_days=30)
    return sp.attach_column(tx, risk, "TERMINAL_FRAUD_RISK_30_DAY").select(*S.RAW_COLUMNS, "TERMINAL_FRAUD_RISK_30_DAY")


@register(
    "o1_sorted_train_sink",
    f"WITH {Q.TX_CTE} SELECT {_COLS} FROM ({_train_sql(START, 7)})",
)
def q_sorted_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Training rows sorted by id and written as CSV (header, no index column), then re-read."""
    from cardsight.sources import files

    train, _ = sp.prequential_split(load_transactions(spark, sf), START, 7, 7, 7, ORIGIN)
    path = files.write_csv(train.select(*SPLIT_COLS).orderBy(S.TRANSACTION_ID), spark, "train_csv")
    return files.read_csv(spark, path, train.select(*SPLIT_COLS).schema)


# --------------------------------------------------------------------------- file sources and sinks


@register(
    "s1_merge_files",
    f"""WITH {Q.TX_CTE} SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID,
        CASE WHEN TX_TIME_DAYS BETWEEN 10 AND 19 THEN NULL ELSE TX_AMOUNT END AS TX_AMOUNT,
        TX_TIME_DAYS, TX_FRAUD FROM tx""",
    timestamps=(S.TX_DATETIME,),
)
def q_merge_files(spark: SparkSession, sf: str) -> DataFrame:
    """Three files merged by name in one read: one lacks a column, one has its
    columns in another order."""
    from pyspark.sql import functions as F

    from cardsight.sources import files
    from cardsight.session import scratch_path

    tx = load_transactions(spark, sf)
    day = F.col(S.TX_TIME_DAYS)
    folder = scratch_path(spark, "merge")
    files.write_parquet(tx.where(day < 10), spark, "", path=folder, mode="append")
    files.write_parquet(tx.where(day.between(10, 19)).drop(S.TX_AMOUNT), spark, "", path=folder, mode="append")
    files.write_parquet(tx.where(day >= 20).select(*reversed(S.RAW_COLUMNS)), spark, "", path=folder, mode="append")
    return files.merge_files(spark, folder, "parquet", schema=S.RAW_SCHEMA).select(*S.RAW_COLUMNS)


@register("s4_parquet_sink", Q.sql_features(), timestamps=(S.TX_DATETIME,))
def q_parquet_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table written as gzip Parquet and read back."""
    from cardsight.sources import files

    features = feat.build_features(load_transactions(spark, sf))
    path = files.write_parquet(features, spark, "features_gzip", compression="gzip")
    return files.read_parquet(spark, path, features.schema)


@register("s3_s5_csv_roundtrip", _three_way_sql())
def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """train/validate/test written as three header CSVs and read back with a declared schema."""
    from cardsight.sources import files

    features = materialize(feat.build_features(load_transactions(spark, sf)))
    parts = dict(zip(("train", "validate", "test"), sp.three_way_split(features, START, 21, 7, 7, 7, ORIGIN)))
    back = {}
    for name, part in parts.items():
        trimmed = sp.field_trim(part)
        path = files.write_csv(trimmed, spark, f"{name}_csv")
        back[name] = files.read_csv(spark, path, trimmed.schema)
    return sp.labelled_union(back)
