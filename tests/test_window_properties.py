"""Property test: the block strategy equals a brute-force evaluation of the
frame definition on random tables with exact edges, ties and NULLs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardsight import schema as S
from cardsight.operators import windows as win

T0 = dt.datetime(2024, 2, 1)
DAY = 86400
# Offsets that land exactly on, just inside and just outside frame edges.
EDGE = [0, 1, DAY - 1, DAY, DAY + 1, 7 * DAY, 7 * DAY + 1, 8 * DAY, 8 * DAY + 1, 14 * DAY, 30 * DAY, 37 * DAY + 1]

row = st.tuples(
    st.integers(0, 2),  # entity
    st.one_of(st.sampled_from(EDGE), st.integers(0, 80 * DAY)),  # seconds after T0
    st.one_of(st.none(), st.integers(1, 50000).map(lambda c: c / 100)),  # amount
    st.one_of(st.none(), st.integers(0, 1)),  # label
)
SPECS = [
    win.FrameAgg("c1", "count", S.TX_AMOUNT, 1),
    win.FrameAgg("a7", "avg", S.TX_AMOUNT, 7),
    win.FrameAgg("s30", "sum", S.TX_FRAUD, 30),
    win.FrameAgg("r7", "risk", S.TX_FRAUD, 7, 7),
    win.FrameAgg("r1", "risk", S.TX_FRAUD, 1, 7),
]


def brute(rows, spec):
    out = {}
    for i, (k, t, amount, fraud) in enumerate(rows):
        lo, hi = t - spec.lower_offset, t - spec.upper_offset
        vals = [r[2] if spec.field == S.TX_AMOUNT else r[3] for r in rows if r[0] == k and lo <= r[1] <= hi]
        vals = [v for v in vals if v is not None]
        if spec.func == "count":
            out[i] = len(vals)
        elif spec.func == "sum":
            out[i] = sum(vals) if vals else None
        elif spec.func == "avg":
            out[i] = (sum(round(v * 100) for v in vals) / 100.0 / len(vals)) if vals else None
        else:
            out[i] = (sum(vals) / len(vals)) if vals else 0.0
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=40))
def test_block_matches_brute_force(spark, rows):
    data = [
        (i, T0 + dt.timedelta(seconds=t, microseconds=i), k, k, amount, 0, fraud)
        for i, (k, t, amount, fraud) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data,
        "TRANSACTION_ID long, TX_DATETIME timestamp_ntz, CUSTOMER_ID long, TERMINAL_ID long, "
        "TX_AMOUNT double, TX_TIME_DAYS int, TX_FRAUD int",
    )
    got = {r[S.TRANSACTION_ID]: r for r in win.trailing_aggregates(df, S.CUSTOMER_ID, SPECS).collect()}
    for spec in SPECS:
        want = brute(rows, spec)
        for i, w in want.items():
            g = got[i][spec.name]
            if w is None or g is None:
                assert g == w, (spec.name, i, g, w)
            else:
                assert abs(g - w) < 1e-9, (spec.name, i, g, w)
