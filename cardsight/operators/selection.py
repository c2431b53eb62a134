"""Exact order statistics per group without putting a group into one task.

``kth_smallest`` finds, for each target ``(group, k)``, the k-th smallest
``(value, tiebreak)`` pair among the rows of that group. The narrow rows are
materialised once; each round is one distributed
``groupBy(target, bucket).agg(count, min, max)`` over the rows still in play,
and only ``targets x num_buckets`` summary rows reach the driver, whatever the
size of the data. A target's candidate set is the chain of bucket predicates
chosen so far; a round narrows it to one of ``num_buckets`` parts of its range
until one value is left, and rows that share it are told apart by the
tiebreak in the same way. Callers then express "the first k rows in this
order" as a plain filter, so no window ever spans a whole class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsight.session import materialize

NUM_BUCKETS = 4096


@dataclass(eq=False)
class _Target:
    group: object
    k: int  # 1-based rank within the group
    cond: Column  # rows of the group still in play
    lo: object  # min value in play
    hi: object  # max value in play
    below: int  # rows of the group ordered before every row in play
    in_range: int  # rows in play


def _group_match(group_col: str, group: object) -> Column:
    return F.col(group_col).isNull() if group is None else (F.col(group_col) == F.lit(group))


def kth_smallest(
    df: DataFrame,
    group_col: str,
    value_col: str,
    tiebreak_col: str,
    targets: list[tuple[object, int]],
    num_buckets: int = NUM_BUCKETS,
) -> dict[tuple[object, int], tuple[object, object]]:
    """``{(group, k): (value, tiebreak)}`` of the k-th smallest pair per group.

    Rows whose value is NULL or NaN are ignored; infinite values are refused.
    Targets with ``k`` outside ``[1, count]`` are omitted from the result.
    """
    if not targets:
        return {}
    cols = [group_col, value_col] + ([tiebreak_col] if tiebreak_col != value_col else [])
    data = df.select(*cols).where(F.col(value_col).isNotNull())
    if isinstance(data.schema[value_col].dataType, (T.FloatType, T.DoubleType)):
        data = data.where(~F.isnan(value_col))
    return _select(materialize(data), group_col, value_col, tiebreak_col, targets, num_buckets)


def _select(data, group_col, value_col, tiebreak_col, targets, num_buckets) -> dict:
    integral = isinstance(data.schema[value_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    stats = {
        r["g"]: r
        for r in data.groupBy(F.col(group_col).alias("g"))
        .agg(F.min(value_col).alias("lo"), F.max(value_col).alias("hi"), F.count("*").alias("n"))
        .collect()
    }
    found: list[_Target] = []
    for group, k in targets:
        s = stats.get(group)
        if s is None or not 1 <= k <= s["n"]:
            continue
        if float("-inf") in (s["lo"], -s["hi"]):
            raise ValueError("infinite values have no place in a histogram")
        found.append(_Target(group, k, _group_match(group_col, group), s["lo"], s["hi"], 0, int(s["n"])))
    while open_ := [t for t in found if t.lo != t.hi]:
        _refine(data, value_col, open_, num_buckets, integral)

    result: dict[tuple[object, int], tuple[object, object]] = {}
    if tiebreak_col == value_col:
        return {(t.group, t.k): (t.lo, t.lo) for t in found}
    single = [t for t in found if t.in_range == 1]
    if single:
        row = data.agg(*[F.min(F.when(t.cond, F.col(tiebreak_col))).alias(f"t{i}") for i, t in enumerate(single)]).first()
        result |= {(t.group, t.k): (t.lo, row[f"t{i}"]) for i, t in enumerate(single)}
    for t in found:
        if t.in_range > 1:  # several rows share the value: select among them by the tiebreak
            key = (t.group, t.k - t.below)
            ties = _select(data.where(t.cond), group_col, tiebreak_col, tiebreak_col, [key], num_buckets)
            result[(t.group, t.k)] = (t.lo, ties[key][1])
    return result


def _bucket(t: _Target, num_buckets: int, integral: bool, value_col: str) -> Column:
    """Monotone bucket index of the value within the target's [lo, hi]."""
    if integral:
        width = max(1, -(-(int(t.hi) - int(t.lo) + 1) // num_buckets))
        # Exact integer arithmetic (values may exceed 2^53).
        return F.expr(f"(`{value_col}` - {int(t.lo)}L) div {width}L")
    width = max((float(t.hi) - float(t.lo)) / num_buckets, 5e-324)  # never zero
    return F.least(F.floor((F.col(value_col) - F.lit(float(t.lo))) / F.lit(width)), F.lit(num_buckets - 1))


def _refine(data, value_col, open_: list[_Target], num_buckets: int, integral: bool) -> None:
    flags = F.array(*[F.when(t.cond, F.lit(i)) for i, t in enumerate(open_)])
    exploded = data.select("*", F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("_t"))
    bucket = None
    for i, t in enumerate(open_):
        expr = _bucket(t, num_buckets, integral, value_col)
        bucket = F.when(F.col("_t") == i, expr) if bucket is None else bucket.when(F.col("_t") == i, expr)
    summary = (
        exploded.groupBy("_t", bucket.cast("long").alias("_b"))
        .agg(F.count("*").alias("n"), F.min(value_col).alias("lo"), F.max(value_col).alias("hi"))
        .collect()
    )
    per: dict[int, list] = {}
    for r in summary:
        per.setdefault(r["_t"], []).append((r["_b"], r["n"], r["lo"], r["hi"]))
    for i, t in enumerate(open_):
        need = t.k - t.below
        seen = 0
        for b, n, lo, hi in sorted(per.get(i, []), key=lambda x: x[0]):
            if seen + n >= need:
                expr = _bucket(t, num_buckets, integral, value_col)
                t.cond = t.cond & (expr.cast("long") == F.lit(b))
                t.below += seen
                t.lo, t.hi, t.in_range = lo, hi, n
                break
            seen += n
