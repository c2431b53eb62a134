"""Prequential split: the hand-made lag case, empty train, equality with a
day-by-day brute force in plain Python, and split properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import split as sp
from tests.conftest import SF01

DDL = (
    "TRANSACTION_ID long, TX_DATETIME timestamp_ntz, CUSTOMER_ID long, TERMINAL_ID long, "
    "TX_AMOUNT double, TX_TIME_DAYS int, TX_FRAUD int"
)
D0 = dt.datetime(2024, 1, 1)


def _rows(spark, spec):
    rows = [(i, D0 + dt.timedelta(days=d, hours=1), c, 1, 1.0, d, f) for i, (d, c, f) in enumerate(spec)]
    return spark.createDataFrame(rows, DDL)


def test_known_fraud_lag(spark):
    # s=0, T=1, D=7: customer 5 defrauded on day 1; its rows on days 8, 9, 10.
    df = _rows(spark, [(0, 1, 0), (1, 5, 1), (8, 5, 0), (9, 5, 0), (10, 5, 0)])
    for test in (sp.prequential_split(df, D0, 1, 7, 7)[1], sp.rows_in_parts(df, D0, 1, 7, 7)):
        assert sorted(r[S.TX_TIME_DAYS] for r in test.collect()) == [8]


def test_training_fraud_excludes_from_first_test_day(spark):
    df = _rows(spark, [(0, 5, 1), (3, 6, 0), (3, 5, 0), (4, 5, 0)])
    train, test = sp.prequential_split(df, D0, 1, 2, 7)
    assert train.count() == 1
    assert sorted(r[S.CUSTOMER_ID] for r in test.collect()) == [6]


def test_empty_training_set_gives_empty_test(spark):
    df = _rows(spark, [(0, 1, 0), (5, 1, 1)])
    train, test = sp.prequential_split(df, D0 + dt.timedelta(days=100), 7, 7, 7)
    assert train.count() == 0 and test.count() == 0


def _brute_test_ids(rows, start, t, d, n):
    """Ids of the test rows, one test day after the other."""
    train = [r for r in rows if start <= r[S.TX_DATETIME] < start + dt.timedelta(days=t)]
    s = min(r[S.TX_TIME_DAYS] for r in train)
    known = {r[S.CUSTOMER_ID] for r in train if r[S.TX_FRAUD] == 1}
    ids = set()
    for day in range(s + t + d, s + t + d + n):
        known |= {r[S.CUSTOMER_ID] for r in rows if r[S.TX_FRAUD] == 1 and r[S.TX_TIME_DAYS] == day - d - 1}
        ids |= {r[S.TRANSACTION_ID] for r in rows if r[S.TX_TIME_DAYS] == day and r[S.CUSTOMER_ID] not in known}
    return ids


@pytest.mark.parametrize("origin", [None, dt.date(2024, 1, 1)])
@pytest.mark.parametrize("t,d,n", [(7, 7, 7), (7, 1, 7), (14, 7, 7), (3, 2, 4), (3, 2, 1)])
def test_both_forms_equal_the_day_loop(spark, t, d, n, origin):
    from cardsight.sources.transactions import load_transactions

    tx = load_transactions(spark, SF01).select(S.TRANSACTION_ID, S.TX_DATETIME, S.CUSTOMER_ID, S.TX_TIME_DAYS, S.TX_FRAUD)
    for start in (D0, D0 + dt.timedelta(days=2, hours=9)):
        _, a = sp.prequential_split(tx, start, t, d, n, origin)
        b = sp.rows_in_parts(tx, start, t, d, n, origin)
        want = _brute_test_ids(tx.collect(), start, t, d, n)
        assert {r[0] for r in a.select(S.TRANSACTION_ID).collect()} == want
        assert sorted(r[0] for r in b.select(S.TRANSACTION_ID).collect()) == sorted(want)


def test_day_bounds_reach_the_scan(spark):
    from cardsight.sources.transactions import load_transactions

    _, test = sp.prequential_split(load_transactions(spark, SF01), "2024-01-01", 7, 7, 7, dt.date(2024, 1, 1))
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(ts,2024-01-15") >= 1 and plan.count("LessThan(ts,2024-01-22") >= 1


def test_split_properties(spark):
    from cardsight.sources.transactions import load_transactions

    tx = load_transactions(spark, SF01)
    train, test = sp.prequential_split(tx, "2024-01-01", 7, 7, 7)
    tr = {r[0] for r in train.select(S.TRANSACTION_ID).collect()}
    te = test.select(S.TRANSACTION_ID, S.CUSTOMER_ID, S.TX_TIME_DAYS).collect()
    assert tr.isdisjoint({r[0] for r in te})
    train_fraud = {r[0] for r in train.where(F.col(S.TX_FRAUD) == 1).select(S.CUSTOMER_ID).collect()}
    assert not train_fraud & {r[1] for r in te}
    assert (len(tr), len(te)) == (2348, 1327)


def test_three_way_split_sizes(spark):
    from cardsight.sources.transactions import load_transactions

    tx = load_transactions(spark, SF01)
    train, validate, test = sp.three_way_split(tx, "2024-01-01", 15, 7, 1, 7)
    assert train.count() > 0 and validate.count() > 0 and test.count() > 0
    days = {r[0] for r in validate.select(S.TX_TIME_DAYS).distinct().collect()}
    assert days <= set(range(8, 15))
