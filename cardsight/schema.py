"""Declared schemas and column names of the transaction data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the raw table, the features and the label,
# in the order the train/validate/test files carry them.
TRANSACTION_ID = "TRANSACTION_ID"
TX_DATETIME = "TX_DATETIME"
CUSTOMER_ID = "CUSTOMER_ID"
TERMINAL_ID = "TERMINAL_ID"
TX_AMOUNT = "TX_AMOUNT"
TX_TIME_DAYS = "TX_TIME_DAYS"
TX_FRAUD = "TX_FRAUD"

RAW_COLUMNS = [
    TRANSACTION_ID,
    TX_DATETIME,
    CUSTOMER_ID,
    TERMINAL_ID,
    TX_AMOUNT,
    TX_TIME_DAYS,
    TX_FRAUD,
]

WINDOW_DAYS = (1, 7, 30)
RISK_DELAY_DAYS = 7

FEATURE_COLUMNS = [
    "TX_AMOUNT",
    "IS_WKD",
    "IS_NIGHT",
    "CUSTOMER_TX_COUNT_1_DAY",
    "CUSTOMER_TX_COUNT_7_DAY",
    "CUSTOMER_TX_COUNT_30_DAY",
    "CUSTOMER_TX_AVG_1_DAY",
    "CUSTOMER_TX_AVG_7_DAY",
    "CUSTOMER_TX_AVG_30_DAY",
    "TERMINAL_TX_COUNT_1_DAY",
    "TERMINAL_TX_COUNT_7_DAY",
    "TERMINAL_TX_COUNT_30_DAY",
    "TERMINAL_FRAUD_RISK_1_DAY",
    "TERMINAL_FRAUD_RISK_7_DAY",
    "TERMINAL_FRAUD_RISK_30_DAY",
]
LABEL_COLUMN = TX_FRAUD

RAW_SCHEMA = T.StructType(
    [
        T.StructField(TRANSACTION_ID, T.LongType(), False),
        T.StructField(TX_DATETIME, T.TimestampNTZType(), False),
        T.StructField(CUSTOMER_ID, T.LongType(), False),
        T.StructField(TERMINAL_ID, T.LongType(), False),
        T.StructField(TX_AMOUNT, T.DoubleType(), True),
        T.StructField(TX_TIME_DAYS, T.IntegerType(), False),
        T.StructField(TX_FRAUD, T.IntegerType(), True),
    ]
)

# Driver-provided tables used as inputs.
EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType(), True),
        T.StructField("ts", T.TimestampNTZType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("props", T.StringType(), True),
    ]
)

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), True),
        T.StructField("o_custkey", T.LongType(), True),
        T.StructField("o_orderstatus", T.StringType(), True),
        T.StructField("o_totalprice", T.DoubleType(), True),
        T.StructField("o_orderdate", T.TimestampNTZType(), True),
        T.StructField("o_orderpriority", T.StringType(), True),
    ]
)
