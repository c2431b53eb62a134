"""The transactions table, read with declared schemas.

The raw table has one row per card transaction (see ``cardsight.schema``).
On the driver's test data it is a view over ``events``; a second view over
``orders`` (every timestamp at midnight) exercises whole-day ties.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.time import day_index

# Mapping of the events table onto the transaction columns.
EVENTS_DAY_ORIGIN = "2024-01-01"
EVENTS_TERMINAL_JSON_PATH = "$.k"
EVENTS_FRAUD_TYPE = "error"
EVENTS_FRAUD_MIN_VALUE = 100.0
ORDERS_DAY_ORIGIN = "1992-01-01"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(table_path(sf_dir, name))


def transactions_from_events(events: DataFrame, day_origin: str = EVENTS_DAY_ORIGIN) -> DataFrame:
    """Project ``events`` onto the raw transaction schema (pure column mapping)."""
    ts = F.col("ts")
    return events.select(
        F.col("event_id").alias(S.TRANSACTION_ID),
        ts.alias(S.TX_DATETIME),
        F.col("user_id").alias(S.CUSTOMER_ID),
        F.get_json_object("props", EVENTS_TERMINAL_JSON_PATH).try_cast("long").alias(S.TERMINAL_ID),
        F.col("value").alias(S.TX_AMOUNT),
        day_index(ts, day_origin).alias(S.TX_TIME_DAYS),
        ((F.col("event_type") == F.lit(EVENTS_FRAUD_TYPE)) & (F.col("value") > F.lit(EVENTS_FRAUD_MIN_VALUE)))
        .cast("int")
        .alias(S.TX_FRAUD),
    )


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions over the ``events`` table of a scale-factor folder."""
    events = read_table(spark, sf_dir, "events", S.EVENTS_SCHEMA)
    return transactions_from_events(events)


def load_order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions over ``orders``: midnight timestamps, no terminal, no label."""
    orders = read_table(spark, sf_dir, "orders", S.ORDERS_SCHEMA)
    ts = F.col("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias(S.TRANSACTION_ID),
        ts.alias(S.TX_DATETIME),
        F.col("o_custkey").alias(S.CUSTOMER_ID),
        F.col("o_totalprice").alias(S.TX_AMOUNT),
        day_index(ts, ORDERS_DAY_ORIGIN).alias(S.TX_TIME_DAYS),
    )


# SQL text of the same views, for the DuckDB oracle.
EVENTS_TX_SQL = f"""
SELECT event_id AS TRANSACTION_ID,
       ts AS TX_DATETIME,
       user_id AS CUSTOMER_ID,
       TRY_CAST(json_extract_string(props, '{EVENTS_TERMINAL_JSON_PATH}') AS BIGINT) AS TERMINAL_ID,
       value AS TX_AMOUNT,
       CAST(date_diff('day', DATE '{EVENTS_DAY_ORIGIN}', CAST(ts AS DATE)) AS INTEGER) AS TX_TIME_DAYS,
       CAST(event_type = '{EVENTS_FRAUD_TYPE}' AND value > {EVENTS_FRAUD_MIN_VALUE} AS INTEGER) AS TX_FRAUD
FROM events
"""

ORDERS_TX_SQL = f"""
SELECT o_orderkey AS TRANSACTION_ID,
       o_orderdate AS TX_DATETIME,
       o_custkey AS CUSTOMER_ID,
       o_totalprice AS TX_AMOUNT,
       CAST(date_diff('day', DATE '{ORDERS_DAY_ORIGIN}', CAST(o_orderdate AS DATE)) AS INTEGER) AS TX_TIME_DAYS
FROM orders
"""
