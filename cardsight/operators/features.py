"""The feature pipeline: calendar flags plus customer and terminal windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.time import epoch_seconds_of, is_night, is_weekend
from cardsight.functions.numeric import DEFAULT_SCALE, WIDE_SCALE, fits_scale
from cardsight.operators.windows import SEC, FrameAgg, attach, heavy_entities, per_second_features, trailing_aggregates


def add_calendar_flags(df: DataFrame, weekend: str = "reference", time_col: str = S.TX_DATETIME) -> DataFrame:
    """``IS_WKD`` and ``IS_NIGHT`` (see ``cardsight.functions.time``)."""
    return df.withColumns(
        {"IS_WKD": is_weekend(time_col, weekend), "IS_NIGHT": is_night(time_col)}
    )


def customer_specs(days: Sequence[int] = S.WINDOW_DAYS) -> list[FrameAgg]:
    return [FrameAgg(f"CUSTOMER_TX_COUNT_{d}_DAY", "count", S.TX_AMOUNT, d) for d in days] + [
        FrameAgg(f"CUSTOMER_TX_AVG_{d}_DAY", "avg", S.TX_AMOUNT, d) for d in days
    ]


def terminal_count_specs(days: Sequence[int] = S.WINDOW_DAYS) -> list[FrameAgg]:
    return [FrameAgg(f"TERMINAL_TX_COUNT_{d}_DAY", "count", S.TX_AMOUNT, d) for d in days]


def terminal_risk_specs(days: Sequence[int] = S.WINDOW_DAYS, delay: int = S.RISK_DELAY_DAYS) -> list[FrameAgg]:
    return [FrameAgg(f"TERMINAL_FRAUD_RISK_{d}_DAY", "risk", S.TX_FRAUD, d, delay) for d in days]


def feature_names(days: Sequence[int] = S.WINDOW_DAYS) -> list[str]:
    specs = customer_specs(days) + terminal_count_specs(days) + terminal_risk_specs(days)
    return ["IS_WKD", "IS_NIGHT"] + [s.name for s in specs]


def build_features(
    tx: DataFrame,
    days: Sequence[int] = S.WINDOW_DAYS,
    delay: int = S.RISK_DELAY_DAYS,
    weekend: str = "reference",
    strategy: str = "measured",
    scale: int | None = None,
) -> DataFrame:
    """Input columns plus 2 flags and 4 x len(days) window features.

    The customer features share one window pass and the terminal counts and
    delayed risks share another; the risk is a window expression, never a
    self-join. Amounts are summed exactly in units of ``10**-scale``; without
    a scale, six decimals, or 18 where an amount needs more than six.
    ``measured`` and the choice of the scale take one aggregate of the rows.
    """
    n_rows = None
    if scale is None or strategy == "measured":
        fits = F.min(fits_scale(F.col(S.TX_AMOUNT).cast("double")))
        n_rows, six = tx.agg(F.count("*"), fits).first()
        scale = scale if scale is not None else DEFAULT_SCALE if six in (None, True) else WIDE_SCALE
    base = add_calendar_flags(tx.withColumn(SEC, epoch_seconds_of(tx, S.TX_DATETIME)), weekend)
    cust = customer_specs(days)
    term = terminal_count_specs(days) + terminal_risk_specs(days, delay)
    if strategy == "sliding":
        out = trailing_aggregates(base, S.CUSTOMER_ID, cust, strategy="sliding", seconds_col=SEC, scale=scale)
        out = trailing_aggregates(out, S.TERMINAL_ID, term, strategy="sliding", seconds_col=SEC, scale=scale)
    elif strategy == "measured":
        out = base
        for entity, specs in ((S.CUSTOMER_ID, cust), (S.TERMINAL_ID, term)):
            heavy = heavy_entities(tx, entity, n_rows)
            out = trailing_aggregates(out, entity, specs, strategy="measured", seconds_col=SEC, scale=scale, heavy=heavy)
    elif strategy == "block":
        # Both per-second tables aggregate straight from the (pruned) scan; the
        # wide rows are shuffled once per entity for the two joins.
        cust_f = per_second_features(base, S.CUSTOMER_ID, cust, SEC, scale)
        term_f = per_second_features(base, S.TERMINAL_ID, term, SEC, scale)
        out = attach(attach(base, cust_f, S.CUSTOMER_ID, SEC), term_f, S.TERMINAL_ID, SEC)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.select(*tx.columns, *feature_names(days))


def terminal_profile(
    tx: DataFrame,
    days: Sequence[int] = S.WINDOW_DAYS,
    delay: int = S.RISK_DELAY_DAYS,
    strategy: str = "block",
    with_risk: bool = True,
) -> DataFrame:
    specs = terminal_count_specs(days) + (terminal_risk_specs(days, delay) if with_risk else [])
    return trailing_aggregates(tx, S.TERMINAL_ID, specs, strategy=strategy)


def riskiest(features: DataFrame, n: int = 20, by: str = "TERMINAL_FRAUD_RISK_30_DAY") -> DataFrame:
    """Top-n rows by a risk column, ties broken by transaction id (a top-k report)."""
    return features.orderBy(F.col(by).desc(), F.col(S.TRANSACTION_ID).asc()).limit(n)
