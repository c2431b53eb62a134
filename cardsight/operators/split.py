"""Prequential train/test split with label delay and known-fraud exclusion.

With ``s`` = first day index of the training rows, ``T`` = ``delta_train``,
``D`` = ``delta_delay``:

* train = rows with ``start <= TX_DATETIME < start + T days`` (exact day
  arithmetic, time of day kept);
* test = rows whose ``TX_TIME_DAYS`` lies in ``[s+T+D, s+T+D+delta_test-1]``,
  minus customers already known to be defrauded on that test day;
* a customer is known on test day ``d`` if it has a fraud among the training
  rows, or a fraud on a day in ``[s+T-1, d-D-1]``.

``prequential_split`` evaluates the exclusion as ONE anti join against a
per-customer table ``known_day = min(first day the customer is known)``
(pre-aggregated, one row per customer, so no key is hot on that side) with
the range condition ``known_day <= test_day - D - 1``. ``rows_in_parts``
gives the same test rows as the union of two parts: rows of customers that are
never known, and rows dated before their customer is known.

Given the date of day index 0 (``day_origin``), the day windows are also put
as bounds on ``TX_DATETIME``, which reach the Parquet scan; the day index
alone is a computed column and prunes nothing.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.time import in_half_open_range, to_timestamp_literal


def training_window(df: DataFrame, start: str | dt.datetime | dt.date, delta_train: int = 7) -> DataFrame:
    """Rows with ``start <= TX_DATETIME < start + delta_train days``."""
    return df.where(in_half_open_range(S.TX_DATETIME, to_timestamp_literal(start), delta_train))


def first_day(df: DataFrame) -> int | None:
    """``min(TX_TIME_DAYS)``: one scalar aggregate, the only value brought to the driver."""
    return df.agg(F.min(S.TX_TIME_DAYS).alias("s")).first()["s"]


def on_days(df: DataFrame, first: int, last: int, day_origin: dt.date | None = None) -> DataFrame:
    """Rows with ``first <= TX_TIME_DAYS <= last``; with the date of day 0 also
    as timestamp bounds for the scan."""
    rows = df.where(F.col(S.TX_TIME_DAYS).between(first, last))
    if day_origin is None:
        return rows
    return rows.where(
        in_half_open_range(S.TX_DATETIME, to_timestamp_literal(day_origin + dt.timedelta(days=first)), last - first + 1)
    )


def known_fraud_customers(df: DataFrame) -> DataFrame:
    """Distinct customers with at least one fraud."""
    return df.where(F.col(S.TX_FRAUD) == 1).select(S.CUSTOMER_ID).distinct()


def known_fraud_days(
    df: DataFrame,
    start: str | dt.datetime | dt.date,
    s: int,
    delta_train: int,
    delta_test: int,
    day_origin: dt.date | None = None,
) -> DataFrame:
    """Per customer, the first day index on which it is a known fraud victim.

    A fraud among the training rows counts from the start (``s+T-1``); any
    other fraud on day ``d >= s+T-1`` counts from ``d``. Frauds after the last
    day that can matter are pruned before the aggregation.
    """
    pool_open = s + delta_train - 1
    last_useful = s + delta_train + delta_test - 2
    in_train = in_half_open_range(S.TX_DATETIME, to_timestamp_literal(start), delta_train)
    day = F.col(S.TX_TIME_DAYS)
    known_from = F.when(in_train, F.lit(pool_open)).when(day >= pool_open, day)
    if day_origin is not None:  # all of it lies between the start and the last useful day
        df = on_days(df, s, max(last_useful, s + delta_train), day_origin)
    return (
        df.where((F.col(S.TX_FRAUD) == 1) & ((day <= last_useful) | in_train))
        .select(S.CUSTOMER_ID, known_from.alias("known_day"))
        .where(F.col("known_day").isNotNull())
        .groupBy(S.CUSTOMER_ID)
        .agg(F.min("known_day").alias("known_day"))
    )


def prequential_split(
    df: DataFrame,
    start: str | dt.datetime | dt.date,
    delta_train: int = 7,
    delta_delay: int = 7,
    delta_test: int = 7,
    day_origin: dt.date | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) as lazy DataFrames; an empty training set gives an empty test set."""
    train = training_window(df, start, delta_train)
    s = first_day(train)
    if s is None:
        return train, df.where(F.lit(False))
    first_test = s + delta_train + delta_delay
    test = on_days(df, first_test, first_test + delta_test - 1, day_origin)
    known = known_fraud_days(df, start, s, delta_train, delta_test, day_origin).withColumnRenamed(
        S.CUSTOMER_ID, "_known_customer"
    )
    cond = (F.col(S.CUSTOMER_ID) == F.col("_known_customer")) & (
        F.col("known_day") <= F.col(S.TX_TIME_DAYS) - F.lit(delta_delay + 1)
    )
    return train, test.join(known, cond, "left_anti")


def rows_in_parts(
    df: DataFrame,
    start: str | dt.datetime | dt.date,
    delta_train: int = 7,
    delta_delay: int = 7,
    delta_test: int = 7,
    day_origin: dt.date | None = None,
) -> DataFrame:
    """The test rows of ``prequential_split`` by set operations.

    The pool of (customer, day known) is the distinct union of the training
    victims and the later ones. Customers outside the pool keep all their test
    rows (anti join); those in it keep the rows up to the delay after their
    first day in it (inner join); both parts are put together.
    """
    train = training_window(df, start, delta_train)
    s = first_day(train)
    if s is None:
        return df.where(F.lit(False))
    opens = s + delta_train - 1
    fraud = F.col(S.TX_FRAUD) == 1
    later = on_days(df, opens, opens + delta_test - 1, day_origin).where(fraud)
    pool = (
        train.where(fraud).select(S.CUSTOMER_ID, F.lit(opens).alias("known_day"))
        .union(later.select(S.CUSTOMER_ID, F.col(S.TX_TIME_DAYS).alias("known_day")))
        .distinct()
        .groupBy(S.CUSTOMER_ID).agg(F.min("known_day").alias("known_day"))
    )
    first_test = s + delta_train + delta_delay
    rows = on_days(df, first_test, first_test + delta_test - 1, day_origin)
    never = rows.join(pool, S.CUSTOMER_ID, "left_anti")
    before = rows.join(pool, S.CUSTOMER_ID).where(F.col(S.TX_TIME_DAYS) - F.lit(delta_delay + 1) < F.col("known_day"))
    return never.select(*df.columns).unionByName(before.select(*df.columns))


def three_way_split(
    df: DataFrame,
    start: str | dt.datetime | dt.date,
    outer_train: int = 21,
    inner_train: int = 7,
    delta_delay: int = 7,
    delta_test: int = 7,
    day_origin: dt.date | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, validate, test): split once with ``outer_train`` days, then split
    that training part again from the same start with ``inner_train`` days."""
    outer, test = prequential_split(df, start, outer_train, delta_delay, delta_test, day_origin)
    train, validate = prequential_split(outer, start, inner_train, delta_delay, delta_test, day_origin)
    return train, validate, test


def field_trim(df: DataFrame, features: Sequence[str] = S.FEATURE_COLUMNS, label: str = S.LABEL_COLUMN) -> DataFrame:
    """Features then label, nothing else (no row-index column)."""
    return df.select(*features, label)


def attach_column(df: DataFrame, other: DataFrame, column: str, key: str = S.TRANSACTION_ID) -> DataFrame:
    """Left join one column of ``other`` onto ``df`` by a unique id."""
    return df.join(other.select(key, column), on=key, how="left")


def labelled_union(parts: dict[str, DataFrame], label_col: str = "split") -> DataFrame:
    """Concatenate frames, tagging each with its name; missing columns become NULL."""
    out = None
    for name, part in parts.items():
        tagged = part.withColumn(label_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out
