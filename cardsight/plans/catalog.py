"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their oracle SQL.

Every query reads the scale-factor folder's tables (or data Spark derives
from them) in full; a LIMIT appears only where a top-k report is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.time import epoch_seconds_of
from cardsight.operators import features as feat
from cardsight.operators import windows as win
from cardsight.plans import oracle_sql as Q
from cardsight.sources.transactions import load_order_transactions, load_transactions

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


# The engine-neutral text form of timestamps in query outputs.
TS_FORMAT_SPARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TS_FORMAT_SQL = "%Y-%m-%d %H:%M:%S.%f"


def register(name: str, sql: str | None = None, timestamps: tuple[str, ...] = ()):
    """Register a query (and its oracle SQL).

    ``timestamps`` names output columns rendered as ISO-8601 text with
    microseconds on both sides, so the comparison does not depend on how
    each client library represents a timestamp; the library itself keeps
    real timestamp columns.
    """

    def wrap(fn: Query) -> Query:
        query, text = fn, sql
        if timestamps:

            def query(spark: SparkSession, sf: str, _fn: Query = fn) -> DataFrame:
                out = _fn(spark, sf)
                return out.withColumns({c: F.date_format(c, TS_FORMAT_SPARK) for c in timestamps})

            query.__doc__ = fn.__doc__
            if text is not None:
                repl = ", ".join(f"strftime({c}, '{TS_FORMAT_SQL}') AS {c}" for c in timestamps)
                text = f"SELECT * REPLACE ({repl}) FROM ({text})"
        _QUERIES[name] = query
        if text is not None:
            _ORACLE[name] = text
        return fn

    return wrap


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)


def _load_all() -> None:
    # Query modules register themselves on import.
    from cardsight.plans import evaluation_queries, model_queries, sampling_queries, split_queries  # noqa: F401


# --------------------------------------------------------------------------- scans, flags, windows


@register("s2_scan_transactions", Q.sql_scan(), timestamps=(S.TX_DATETIME,))
def q_scan(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    return tx.select(*S.RAW_COLUMNS, epoch_seconds_of(tx, S.TX_DATETIME).alias("TX_EPOCH_SECONDS"))


@register("f_flags", Q.sql_flags(), timestamps=(S.TX_DATETIME,))
def q_flags(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    return feat.add_calendar_flags(tx).select(S.TRANSACTION_ID, S.TX_DATETIME, "IS_WKD", "IS_NIGHT")


@register("f4_text_timestamps", Q.sql_text_timestamps())
def q_text_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Timestamps that come as text, cast: the epoch second and the hour."""
    tx = load_transactions(spark, sf)
    text = tx.select(S.TRANSACTION_ID, F.date_format(S.TX_DATETIME, TS_FORMAT_SPARK).alias("at"))
    return text.select(
        S.TRANSACTION_ID, epoch_seconds_of(text, "at").alias("second"), F.hour(F.col("at").cast("timestamp_ntz")).alias("hour")
    )


@register("w2_customer_counts", Q.sql_customer_counts(), timestamps=(S.TX_DATETIME,))
def q_customer_counts(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    specs = [s for s in feat.customer_specs() if s.func == "count"]
    return win.trailing_aggregates(tx, S.CUSTOMER_ID, specs)


@register("w3_customer_avgs", Q.sql_customer_avgs())
def q_customer_avgs(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf).select(S.TRANSACTION_ID, S.CUSTOMER_ID, S.TX_DATETIME, S.TX_AMOUNT)
    specs = [s for s in feat.customer_specs() if s.func == "avg"]
    out = win.trailing_aggregates(tx, S.CUSTOMER_ID, specs)
    return out.select(S.TRANSACTION_ID, S.CUSTOMER_ID, *[s.name for s in specs])


@register("w4_terminal_counts", Q.sql_terminal_counts())
def q_terminal_counts(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    out = feat.terminal_profile(tx, with_risk=False)
    return out.select(S.TRANSACTION_ID, S.TERMINAL_ID, *[s.name for s in feat.terminal_count_specs()])


@register("w5_w6_delayed_sums", Q.sql_delayed_sums())
def q_delayed_sums(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    out = win.delayed_sums(tx, delay=S.RISK_DELAY_DAYS, n_days=1)
    # The fraud sum is NULL on an empty frame; DOUBLE keeps NULL distinct from 0
    # through every client conversion.
    return out.select(
        S.TRANSACTION_ID, S.TERMINAL_ID, F.col("fraud_in_window").cast("double").alias("fraud_in_window"), "tx_in_window"
    )


@register("w7_terminal_risk_7d", Q.sql_terminal_risk(7))
def q_terminal_risk(spark: SparkSession, sf: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    out = win.fraud_risk(tx, "TERMINAL_FRAUD_RISK_7_DAY", delay=S.RISK_DELAY_DAYS, n_days=7)
    return out.select(S.TRANSACTION_ID, S.TERMINAL_ID, "TERMINAL_FRAUD_RISK_7_DAY")


@register("w1_sliding_features", Q.sql_features(), timestamps=(S.TX_DATETIME,))
def q_features_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table by the direct sliding-window strategy (cross-check of the block plan)."""
    return feat.build_features(load_transactions(spark, sf), strategy="sliding")


def _merged_sql() -> str:
    second = "floor(epoch(TX_DATETIME))"
    near = "(PARTITION BY TERMINAL_ID ORDER BY sec RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW)"
    late = "(PARTITION BY TERMINAL_ID ORDER BY sec RANGE BETWEEN 691200 PRECEDING AND 604800 PRECEDING)"
    return f"""WITH {Q.TX_CTE}, t AS (SELECT *, CAST({second} AS BIGINT) AS sec FROM tx)
      SELECT TRANSACTION_ID, min(TX_AMOUNT) OVER {near} AS min_7_day, max(TX_AMOUNT) OVER {near} AS max_7_day,
             round(stddev_pop(TX_AMOUNT) OVER {near}, 6) AS std_7_day, max(TX_AMOUNT) OVER {late} AS late_max,
             round(coalesce(stddev_samp(TX_AMOUNT) OVER {late}, -1), 5) AS late_std FROM t"""


@register("w1_merged_states", _merged_sql())
def q_merged_states(spark: SparkSession, sf: str) -> DataFrame:
    """Extremes and deviations of the amounts at each terminal, of the last 7 days and of a day a week before."""
    specs = [
        win.FrameAgg("min_7_day", "min", S.TX_AMOUNT, 7),
        win.FrameAgg("max_7_day", "max", S.TX_AMOUNT, 7),
        win.FrameAgg("std_7_day", "stddev_pop", S.TX_AMOUNT, 7),
        win.FrameAgg("late_max", "max", S.TX_AMOUNT, 1, 7),
        win.FrameAgg("late_std", "stddev_samp", S.TX_AMOUNT, 1, 7),
    ]
    out = win.trailing_aggregates(load_transactions(spark, sf), S.TERMINAL_ID, specs)
    late_std = F.round(F.coalesce("late_std", F.lit(-1.0)), 5).alias("late_std")
    return out.select(S.TRANSACTION_ID, "min_7_day", "max_7_day", F.round("std_7_day", 6).alias("std_7_day"), "late_max", late_std)


def _odd_windows(spark: SparkSession, sf: str, strategy: str) -> DataFrame:
    tx = load_transactions(spark, sf)
    mills = F.round(F.col(S.TX_AMOUNT) * 100).cast("long") * 10 + F.col(S.TRANSACTION_ID) % 10
    odd = tx.withColumns(
        {
            S.TERMINAL_ID: F.when(F.col(S.TERMINAL_ID) % 7 != 0, F.col(S.TERMINAL_ID)),
            S.TX_AMOUNT: mills.cast("double") / 1000.0,
        }
    )
    specs = [
        win.FrameAgg("n_7_day", "count", S.TX_AMOUNT, 7),
        win.FrameAgg("avg_7_day", "avg", S.TX_AMOUNT, 7),
        win.FrameAgg("max_7_day", F.max, S.TX_AMOUNT, 7),
        win.FrameAgg("TERMINAL_FRAUD_RISK_30_DAY", "risk", S.TX_FRAUD, 30, S.RISK_DELAY_DAYS),
    ]
    out = win.trailing_aggregates(odd, S.TERMINAL_ID, specs, strategy=strategy)
    terminal = F.coalesce(S.TERMINAL_ID, F.lit(-1)).alias(S.TERMINAL_ID)
    return out.select(S.TRANSACTION_ID, terminal, *[s.name for s in specs])


@register("w1_unknown_terminals_block", Q.sql_odd_windows())
def q_odd_block(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without terminal and three-decimal amounts, any aggregate, by blocks."""
    return _odd_windows(spark, sf, "block")


@register("w1_unknown_terminals_sliding", Q.sql_odd_windows())
def q_odd_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """The same by the direct sliding form."""
    return _odd_windows(spark, sf, "sliding")


@register("w1_orders_day_ties", Q.sql_orders_customer_windows())
def q_orders_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Customer windows over ``orders``: every timestamp at midnight, so frame edges tie exactly."""
    tx = load_order_transactions(spark, sf)
    out = win.trailing_aggregates(tx, S.CUSTOMER_ID, feat.customer_specs())
    names = [s.name for s in feat.customer_specs()]
    return out.select(S.TRANSACTION_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS, *names)


@register("d1_features", Q.sql_features(), timestamps=(S.TX_DATETIME,))
def q_features(spark: SparkSession, sf: str) -> DataFrame:
    return feat.build_features(load_transactions(spark, sf))


@register("o2_riskiest_terminals", Q.sql_riskiest(20), timestamps=(S.TX_DATETIME,))
def q_riskiest(spark: SparkSession, sf: str) -> DataFrame:
    top = feat.riskiest(feat.build_features(load_transactions(spark, sf)), 20)
    return top.select(
        S.TRANSACTION_ID,
        S.TERMINAL_ID,
        S.TX_DATETIME,
        S.TX_FRAUD,
        "TERMINAL_FRAUD_RISK_1_DAY",
        "TERMINAL_FRAUD_RISK_7_DAY",
        "TERMINAL_FRAUD_RISK_30_DAY",
    )


@register("o3_fraud_preview", Q.sql_fraud_preview(20), timestamps=(S.TX_DATETIME,))
def q_fraud_preview(spark: SparkSession, sf: str) -> DataFrame:
    f = feat.build_features(load_transactions(spark, sf))
    return f.where(F.col(S.TX_FRAUD) == 1).orderBy(S.TRANSACTION_ID).limit(20)
