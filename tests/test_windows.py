"""Hand-made edge rows for the trailing windows, both strategies, plus
property checks (block == sliding) and plan shape."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import features as feat
from cardsight.operators import windows as win

T0 = dt.datetime(2024, 3, 15, 12, 0, 0)
STRATEGIES = ["block", "sliding"]
RAW_DDL = (
    "TRANSACTION_ID long, TX_DATETIME timestamp_ntz, CUSTOMER_ID long, TERMINAL_ID long, "
    "TX_AMOUNT double, TX_TIME_DAYS int, TX_FRAUD int"
)


def _tx(spark, rows):
    out = []
    for i, (ts, cust, term, amount, fraud) in enumerate(rows):
        out.append((i, ts, cust, term, amount, (ts.date() - dt.date(2024, 1, 1)).days, fraud))
    return spark.createDataFrame(out, RAW_DDL)


def _by_id(df, col):
    return {r[S.TRANSACTION_ID]: r[col] for r in df.collect()}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_frame_edge_is_inclusive(spark, strategy):
    rows = [
        (T0, 1, 1, 10.0, 0),
        (T0 - dt.timedelta(seconds=86400), 1, 1, 20.0, 0),
        (T0 - dt.timedelta(seconds=86401), 1, 1, 30.0, 0),
    ]
    spec = win.FrameAgg("c1", "count", S.TX_AMOUNT, 1)
    got = _by_id(win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, [spec], strategy=strategy), "c1")
    assert got == {0: 2, 1: 2, 2: 1}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_same_second_rows_see_each_other(spark, strategy):
    rows = [
        (T0.replace(microsecond=100), 1, 1, 10.0, 0),
        (T0.replace(microsecond=900000), 1, 1, 20.0, 0),
    ]
    spec = win.FrameAgg("c1", "count", S.TX_AMOUNT, 1)
    got = _by_id(win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, [spec], strategy=strategy), "c1")
    assert got == {0: 2, 1: 2}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_delayed_risk_edges(spark, strategy):
    rows = [
        (T0, 1, 7, 10.0, 0),  # alone: empty delayed frame -> 0.0
        (T0 + dt.timedelta(days=30), 1, 8, 10.0, 1),  # fraud exactly 7 days before the next row
        (T0 + dt.timedelta(days=37), 1, 8, 10.0, 0),
        (T0 + dt.timedelta(days=60), 1, 9, 10.0, None),  # only a null label in the frame
        (T0 + dt.timedelta(days=67), 1, 9, 10.0, 0),
    ]
    spec = win.FrameAgg("risk", "risk", S.TX_FRAUD, 1, 7)
    got = _by_id(win.trailing_aggregates(_tx(spark, rows), S.TERMINAL_ID, [spec], strategy=strategy), "risk")
    assert got[0] == 0.0
    assert got[2] == 1.0
    assert got[4] == 0.0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_null_amount_is_not_counted(spark, strategy):
    rows = [(T0, 1, 1, None, 0), (T0 + dt.timedelta(hours=1), 1, 1, 12.5, 0)]
    specs = [win.FrameAgg("c", "count", S.TX_AMOUNT, 1), win.FrameAgg("a", "avg", S.TX_AMOUNT, 1)]
    out = win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, specs, strategy=strategy)
    got = {r[S.TRANSACTION_ID]: (r["c"], r["a"]) for r in out.collect()}
    assert got[0] == (0, None)
    assert got[1] == (1, 12.5)


def test_flags(spark):
    fri = dt.datetime(2024, 3, 15, 6, 59, 59)  # a Friday
    rows = [
        (fri, 1, 1, 1.0, 0),
        (fri + dt.timedelta(days=1, seconds=1), 1, 1, 1.0, 0),  # Saturday 07:00:00
        (fri + dt.timedelta(days=2), 1, 1, 1.0, 0),  # Sunday 06:59:59
    ]
    out = feat.add_calendar_flags(_tx(spark, rows))
    got = {r[S.TRANSACTION_ID]: (r["IS_WKD"], r["IS_NIGHT"]) for r in out.collect()}
    assert got == {0: (True, True), 1: (True, False), 2: (False, True)}
    fixed = feat.add_calendar_flags(_tx(spark, rows), weekend="sat_sun")
    assert [r["IS_WKD"] for r in fixed.orderBy(S.TRANSACTION_ID).collect()] == [False, True, True]


def test_block_equals_sliding_on_hot_keys(spark):
    """Random rows, one hot terminal and one hot customer, several blocks long."""
    rnd = random.Random(11)
    rows = []
    for _ in range(1500):
        hot = rnd.random() < 0.4
        ts = T0 + dt.timedelta(seconds=rnd.randrange(0, 120 * 86400))
        rows.append((ts, 1 if hot else rnd.randrange(2, 30), 5 if hot else rnd.randrange(6, 20),
                     round(rnd.uniform(1, 300), 2), int(rnd.random() < 0.1)))
    tx = _tx(spark, rows)
    block = feat.build_features(tx, strategy="block").collect()
    sliding = feat.build_features(tx, strategy="sliding").collect()
    key = lambda r: r[S.TRANSACTION_ID]
    assert sorted(block, key=key) == sorted(sliding, key=key)


def test_features_keep_every_row_and_column_order(spark):
    from tests.conftest import SF001
    from cardsight.sources.transactions import load_transactions

    tx = load_transactions(spark, SF001)
    out = feat.build_features(tx)
    assert out.columns == S.RAW_COLUMNS + feat.feature_names()
    assert out.count() == tx.count()
    risk = [r[0] for r in out.select("TERMINAL_FRAUD_RISK_30_DAY").collect()]
    assert all(0.0 <= x <= 1.0 for x in risk)
    c = out.select("CUSTOMER_TX_COUNT_1_DAY", "CUSTOMER_TX_COUNT_7_DAY", "CUSTOMER_TX_COUNT_30_DAY").collect()
    assert all(a <= b <= d for a, b, d in c)


def test_sliding_plan_has_two_exchanges_and_no_join(spark):
    from tests.conftest import SF001
    from cardsight.sources.transactions import load_transactions

    plan = feat.build_features(load_transactions(spark, SF001), strategy="sliding")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_block_plan_has_no_cartesian_and_pruned_aggregation_scan(spark):
    from tests.conftest import SF001
    from cardsight.sources.transactions import load_transactions

    df = feat.build_features(load_transactions(spark, SF001), strategy="block")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # The per-second customer aggregation reads only the three columns it needs.
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_any_aggregate_through_the_same_entry(spark, strategy):
    rnd = random.Random(3)
    rows = [(T0 + dt.timedelta(seconds=rnd.randrange(0, 40 * 86400)), rnd.choice([1, 1, 2, None]), 1, float(rnd.randrange(90)), 0)
            for _ in range(200)]
    specs = [
        win.FrameAgg("mx", F.max, S.TX_AMOUNT, 2),
        win.FrameAgg("n", "count", S.TX_AMOUNT, 1, 3),
        win.FrameAgg("mn", F.min, S.TX_AMOUNT, 1, 3),
    ]
    out = win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, specs, strategy=strategy)
    assert out.columns[-3:] == ["mx", "n", "mn"]
    for r in out.collect():
        ts, customer = r[S.TX_DATETIME], r[S.CUSTOMER_ID]
        day = dt.timedelta(days=1)
        near = [x[3] for x in rows if x[1] == customer and ts - 2 * day <= x[0] <= ts]
        late = [x[3] for x in rows if x[1] == customer and ts - 4 * day <= x[0] <= ts - 3 * day]
        assert (r["mx"], r["n"], r["mn"]) == (max(near), len(late), min(late) if late else None)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rows_without_entity_are_one_entity(spark, strategy):
    rows = [(T0, 1, None, 10.0, 1), (T0 + dt.timedelta(hours=1), 2, None, 20.0, 0), (T0, 3, 4, 1.0, 0)]
    specs = [win.FrameAgg("c", "count", S.TX_AMOUNT, 1), win.FrameAgg("r", "risk", S.TX_FRAUD, 1, 7)]
    out = win.trailing_aggregates(_tx(spark, rows), S.TERMINAL_ID, specs, strategy=strategy)
    assert {r[S.TRANSACTION_ID]: (r["c"], r["r"]) for r in out.collect()} == {0: (1, 0.0), 1: (2, 0.0), 2: (1, 0.0)}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_values_are_not_rounded(spark, strategy):
    rows = [(T0 + dt.timedelta(minutes=i), 1, 1, a, 0) for i, a in enumerate([1.005, 0.004, 0.004])]
    spec = win.FrameAgg("a", "avg", S.TX_AMOUNT, 1)
    got = _by_id(win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, [spec], strategy=strategy), "a")
    assert got == {0: 1.005, 1: 1.009 / 2, 2: 1.013 / 3}


def test_a_value_beyond_the_scale_raises(spark):
    rows = [(T0, 1, 1, 1.00000001, 0)]
    spec = win.FrameAgg("a", "avg", S.TX_AMOUNT, 1)
    with pytest.raises(Exception, match="needs more than 6 decimals"):
        win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, [spec]).collect()
    assert _by_id(win.trailing_aggregates(_tx(spark, rows), S.CUSTOMER_ID, [spec], scale=8), "a") == {0: 1.00000001}


@pytest.mark.parametrize("seed", [1, 2])
def test_mergeable_aggregates_equal_the_sliding_form(spark, seed):
    import math

    from pyspark.sql import types as T

    rnd = random.Random(seed)
    values = [1.5, -2.25, 1e9, 1e9 + 0.25, 0.0, None, float("nan")]
    rows = [(T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 40 * 86400), 5 * 86400, 5 * 86400 + 1])), rnd.choice([1, 1, 1, 2, None]), 1,
             rnd.choice(values[: rnd.choice([4, 6, 7])]), rnd.choice([0, 1, None])) for _ in range(300)]
    df = _tx(spark, rows).withColumn("whole", (F.col(S.TRANSACTION_ID) * 7919 % 13).cast("int"))
    specs = [win.FrameAgg(f"{f}_{field}_{n}_{shift}", f, field, n, shift)
             for f in ("min", "max", "stddev_pop", "var_samp") for field in (S.TX_AMOUNT, "whole") for n, shift in ((0, 0), (2, 0), (30, 3))]
    specs.append(win.FrameAgg("named", F.stddev, "whole", 7))
    block, sliding = (
        {r[S.TRANSACTION_ID]: r for r in win.trailing_aggregates(df, S.CUSTOMER_ID, specs, strategy=s).collect()} for s in ("block", "sliding")
    )
    out = win.trailing_aggregates(df, S.CUSTOMER_ID, specs)
    assert out.schema["min_whole_2_0"].dataType == T.IntegerType() and out.schema["max_TX_AMOUNT_2_0"].dataType == T.DoubleType()
    assert len(block) == len(rows)
    for i, want in sliding.items():
        for spec in specs:
            a, b = block[i][spec.name], want[spec.name]
            if a is None or b is None or math.isnan(b):
                assert a is b or (a is not None and b is not None and math.isnan(a) and math.isnan(b)), (spec.name, a, b)
            else:
                assert a == pytest.approx(b, rel=1e-9, abs=1e-3 if "TX_AMOUNT" in spec.name and "m" not in spec.name[:1] else 1e-9)


def test_frames_of_one_hot_entity_are_not_quadratic(spark):
    import time

    n = 40_000
    df = spark.range(n).select(
        F.col("id").alias(S.TRANSACTION_ID), F.lit(1).alias(S.TERMINAL_ID), ((F.col("id") * 7919) % 1009).cast("double").alias(S.TX_AMOUNT),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3).alias(S.TX_DATETIME),
    )
    specs = [win.FrameAgg(f, f, S.TX_AMOUNT, 1) for f in ("max", "min", "stddev_pop")]
    began = time.time()
    got = win.trailing_aggregates(df, S.TERMINAL_ID, specs).toPandas().sort_values(S.TRANSACTION_ID)
    assert time.time() - began < 30
    amounts = got[S.TX_AMOUNT].to_numpy()
    for i in (0, 1, 777, 28_800, 28_801, 39_999):
        frame = amounts[max(0, i - 28_800) : i + 1]
        row = got.iloc[i]
        assert (row["max"], row["min"]) == (frame.max(), frame.min()) and row["stddev_pop"] == pytest.approx(frame.std())


def test_sliding_sums_and_ends_have_no_moving_frame(spark):
    rnd = random.Random(5)
    rows = [(T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 20 * 86400), 5 * 86400])), rnd.choice([1, 1, 2, None]), 1,
             rnd.choice([1.5, -2.25, 7.0, None]), rnd.choice([0, 1, None])) for _ in range(200)]
    df = _tx(spark, rows).withColumn(S.TX_DATETIME, F.when(F.col(S.TRANSACTION_ID) % 17 != 0, F.col(S.TX_DATETIME)))
    df = df.withColumn(win.SEC, F.unix_timestamp(F.col(S.TX_DATETIME).cast("timestamp")))
    ways = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    specs = [win.FrameAgg(f"{f}_{n}_{a}", f, S.TX_AMOUNT, n, a) for f in ways for n, a in ((0, 0), (3, 0), (6, 2))]
    # A function without a name goes through Spark's own moving frames.
    plain = [win.FrameAgg(s.name, lambda c, f=s.func: ways[f](c), S.TX_AMOUNT, s.n_days, s.shift_days) for s in specs]
    out, want = (win.trailing_aggregates(df, S.CUSTOMER_ID, x, strategy="sliding", seconds_col=win.SEC) for x in (specs, plain))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    frames = [f for f in out._jdf.queryExecution().executedPlan().toString().split("specifiedwindowframe(")[1:]]
    assert frames and all("unboundedpreceding" in f.split(")")[0] for f in frames)


@pytest.mark.parametrize("heavy_rows", [10, 60, 10_000])
def test_heavy_entities_take_blocks_with_the_same_values(spark, monkeypatch, heavy_rows):
    rnd = random.Random(heavy_rows)
    rows = [(T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 60 * 86400), 5 * 86400])), rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice([7, 7, 8, 9, None]),
             rnd.choice([1.25, 1.2345678, 3.0, None]), rnd.choice([0, 1, None])) for _ in range(250)]
    tx = _tx(spark, rows)
    monkeypatch.setattr(win, "HEAVY_ROWS", heavy_rows)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(feat.build_features(tx)) == key(feat.build_features(tx, strategy="sliding"))
    assert key(feat.build_features(tx.limit(0))) == []


def test_features_of_light_entities_take_two_exchanges(spark):
    from cardsight.sources.transactions import load_transactions
    from tests.conftest import SF001

    plan = feat.build_features(load_transactions(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_amounts_of_more_than_six_decimals_have_features(spark):
    rows = [(T0 + dt.timedelta(minutes=i), 1, 1, a, 0) for i, a in enumerate([1.2345678, 0.1 + 0.2, 5.0])]
    got = _by_id(feat.build_features(_tx(spark, rows)), "CUSTOMER_TX_AVG_1_DAY")
    assert got == pytest.approx({0: 1.2345678, 1: (1.2345678 + 0.3) / 2, 2: 6.5345678 / 3}, rel=1e-15)
