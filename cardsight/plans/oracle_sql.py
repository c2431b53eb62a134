"""Independent DuckDB SQL for each registered query.

Written directly against the driver's views (``events``, ``orders`` ...) with
the plain sliding-window form, so it checks the Spark plans rather than
restating them. Integer sums are cast to BIGINT (DuckDB sums are HUGEINT) and
money averages are ``sum(cents) / 100.0 / count``, which both engines evaluate
to the same double.
"""

from __future__ import annotations

from cardsight.sources.transactions import EVENTS_TX_SQL, ORDERS_TX_SQL

DAY = 86400
DAYS = (1, 7, 30)
DELAY = 7

RAW = "TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT, TX_TIME_DAYS, TX_FRAUD"


def frame(key: str, n: int, shift: int = 0) -> str:
    return (
        f"(PARTITION BY {key} ORDER BY sec RANGE BETWEEN {(n + shift) * DAY} PRECEDING "
        f"AND {shift * DAY} PRECEDING)"
    )


def customer_count(d: int) -> str:
    return f"count(TX_AMOUNT) OVER {frame('CUSTOMER_ID', d)} AS CUSTOMER_TX_COUNT_{d}_DAY"


def customer_avg(d: int) -> str:
    w = frame("CUSTOMER_ID", d)
    return (
        f"CAST(sum(cents) OVER {w} AS DOUBLE) / 100.0 / NULLIF(count(TX_AMOUNT) OVER {w}, 0) "
        f"AS CUSTOMER_TX_AVG_{d}_DAY"
    )


def terminal_count(d: int) -> str:
    return f"count(TX_AMOUNT) OVER {frame('TERMINAL_ID', d)} AS TERMINAL_TX_COUNT_{d}_DAY"


def terminal_risk(d: int, delay: int = DELAY) -> str:
    w = frame("TERMINAL_ID", d, delay)
    return (
        f"coalesce(CAST(sum(TX_FRAUD) OVER {w} AS DOUBLE) / NULLIF(count(TX_FRAUD) OVER {w}, 0), 0.0) "
        f"AS TERMINAL_FRAUD_RISK_{d}_DAY"
    )


FLAGS = "(dayofweek(TX_DATETIME) + 1 >= 6) AS IS_WKD, (hour(TX_DATETIME) <= 6) AS IS_NIGHT"

TX_CTE = f"tx AS ({EVENTS_TX_SQL})"
BASE_CTE = (
    "base AS (SELECT *, epoch_us(TX_DATETIME) // 1000000 AS sec, "
    "CAST(round(TX_AMOUNT * 100) AS BIGINT) AS cents FROM tx)"
)
FEATURE_COLUMNS_SQL = ", ".join(
    [FLAGS]
    + [customer_count(d) for d in DAYS]
    + [customer_avg(d) for d in DAYS]
    + [terminal_count(d) for d in DAYS]
    + [terminal_risk(d) for d in DAYS]
)
FEATURES_CTE = f"features AS (SELECT {RAW}, {FEATURE_COLUMNS_SQL} FROM base)"
WITH_FEATURES = f"WITH {TX_CTE}, {BASE_CTE}, {FEATURES_CTE}"

FEATURE_LIST = (
    "TX_AMOUNT, IS_WKD, IS_NIGHT, CUSTOMER_TX_COUNT_1_DAY, CUSTOMER_TX_COUNT_7_DAY, "
    "CUSTOMER_TX_COUNT_30_DAY, CUSTOMER_TX_AVG_1_DAY, CUSTOMER_TX_AVG_7_DAY, CUSTOMER_TX_AVG_30_DAY, "
    "TERMINAL_TX_COUNT_1_DAY, TERMINAL_TX_COUNT_7_DAY, TERMINAL_TX_COUNT_30_DAY, "
    "TERMINAL_FRAUD_RISK_1_DAY, TERMINAL_FRAUD_RISK_7_DAY, TERMINAL_FRAUD_RISK_30_DAY"
)


def sql_scan() -> str:
    return f"WITH {TX_CTE} SELECT {RAW}, epoch_us(TX_DATETIME) // 1000000 AS TX_EPOCH_SECONDS FROM tx"


def sql_text_timestamps() -> str:
    return (
        f"WITH {TX_CTE} SELECT TRANSACTION_ID, epoch_us(TX_DATETIME) // 1000000 AS second, "
        f"CAST(hour(TX_DATETIME) AS INTEGER) AS hour FROM tx"
    )


def sql_flags() -> str:
    return f"WITH {TX_CTE} SELECT TRANSACTION_ID, TX_DATETIME, {FLAGS} FROM tx"


def sql_customer_counts() -> str:
    cols = ", ".join(customer_count(d) for d in DAYS)
    return f"WITH {TX_CTE}, {BASE_CTE} SELECT {RAW}, {cols} FROM base"


def sql_customer_avgs() -> str:
    cols = ", ".join(customer_avg(d) for d in DAYS)
    return f"WITH {TX_CTE}, {BASE_CTE} SELECT TRANSACTION_ID, CUSTOMER_ID, {cols} FROM base"


def sql_terminal_counts() -> str:
    cols = ", ".join(terminal_count(d) for d in DAYS)
    return f"WITH {TX_CTE}, {BASE_CTE} SELECT TRANSACTION_ID, TERMINAL_ID, {cols} FROM base"


def sql_delayed_sums(d: int = 1, delay: int = DELAY) -> str:
    w = frame("TERMINAL_ID", d, delay)
    return (
        f"WITH {TX_CTE}, {BASE_CTE} SELECT TRANSACTION_ID, TERMINAL_ID, "
        f"CAST(sum(TX_FRAUD) OVER {w} AS DOUBLE) AS fraud_in_window, "
        f"count(TX_FRAUD) OVER {w} AS tx_in_window FROM base"
    )


def sql_terminal_risk(d: int = 7, delay: int = DELAY) -> str:
    return f"WITH {TX_CTE}, {BASE_CTE} SELECT TRANSACTION_ID, TERMINAL_ID, {terminal_risk(d, delay)} FROM base"


def sql_features() -> str:
    return f"{WITH_FEATURES} SELECT * FROM features"


def sql_riskiest(n: int = 20) -> str:
    return (
        f"{WITH_FEATURES} SELECT TRANSACTION_ID, TERMINAL_ID, TX_DATETIME, TX_FRAUD, "
        f"TERMINAL_FRAUD_RISK_1_DAY, TERMINAL_FRAUD_RISK_7_DAY, TERMINAL_FRAUD_RISK_30_DAY "
        f"FROM features ORDER BY TERMINAL_FRAUD_RISK_30_DAY DESC, TRANSACTION_ID ASC LIMIT {n}"
    )


def sql_fraud_preview(n: int = 20) -> str:
    return f"{WITH_FEATURES} SELECT * FROM features WHERE TX_FRAUD = 1 ORDER BY TRANSACTION_ID LIMIT {n}"


def sql_orders_customer_windows() -> str:
    counts = ", ".join(customer_count(d) for d in DAYS)
    avgs = ", ".join(customer_avg(d) for d in DAYS)
    return (
        f"WITH tx AS ({ORDERS_TX_SQL}), base AS (SELECT *, epoch_us(TX_DATETIME) // 1000000 AS sec, "
        f"CAST(round(TX_AMOUNT * 100) AS BIGINT) AS cents FROM tx) "
        f"SELECT TRANSACTION_ID, CUSTOMER_ID, TX_TIME_DAYS, {counts}, {avgs} FROM base"
    )


# Every seventh terminal unknown, amounts with three decimals.
ODD_TX_CTE = f"""odd AS (SELECT TRANSACTION_ID, TX_DATETIME, CUSTOMER_ID,
    CASE WHEN TERMINAL_ID % 7 = 0 THEN NULL ELSE TERMINAL_ID END AS TERMINAL_ID,
    (CAST(round(TX_AMOUNT * 100) AS BIGINT) * 10 + TRANSACTION_ID % 10) / 1000.0 AS TX_AMOUNT, TX_FRAUD,
    CAST(round(TX_AMOUNT * 100) AS BIGINT) * 10 + TRANSACTION_ID % 10 AS mills,
    epoch_us(TX_DATETIME) // 1000000 AS sec FROM tx)"""


def sql_odd_windows() -> str:
    """Exact averages and risks over unknown terminals and three-decimal amounts."""
    w = frame("TERMINAL_ID", 7)
    return (
        f"WITH {TX_CTE}, {ODD_TX_CTE} SELECT TRANSACTION_ID, coalesce(TERMINAL_ID, -1) AS TERMINAL_ID, count(TX_AMOUNT) OVER {w} AS n_7_day, "
        f"CAST(sum(mills) OVER {w} AS DOUBLE) / 1000.0 / NULLIF(count(TX_AMOUNT) OVER {w}, 0) AS avg_7_day, "
        f"max(TX_AMOUNT) OVER {w} AS max_7_day, {terminal_risk(30)} FROM odd"
    )
