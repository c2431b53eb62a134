"""Plan guards over the registered queries: no cross joins anywhere, and the
entry point runs on the smoke tables."""

import pytest

from tests.conftest import SF001

MODEL_PREFIXES = ("m1", "m2", "m3", "m4", "m5", "m6", "m7", "m10", "m11", "m12", "a7", "e9", "s6", "s7",
                  "e8_competition", "b8")


def _cheap_queries():
    from cardsight.plans import catalog

    return sorted(n for n in catalog.queries() if not n.startswith(MODEL_PREFIXES))


@pytest.mark.parametrize("name", _cheap_queries())
def test_no_cross_join(spark, name):
    from cardsight.plans import catalog

    df = catalog.queries()[name](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 1000
    assert set(entry.oracle_sql()) <= set(entry.queries())
