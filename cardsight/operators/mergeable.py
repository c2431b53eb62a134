"""Trailing frames of aggregates that merge but do not subtract (minimum, maximum, moments).

Rows of one (entity, second) become one partial state with map-side
aggregation, so a hot entity is at most one row per second. States are cut
into blocks as for sums (``windows``), sorted by entity, block and second, and
streamed through tasks that hold one block at most. There a frame is a range
of places, and its length a sum of powers of two: states of ``2**j``
neighbours are merged level by level, and each frame takes the levels that
its length names, one after the other. That is ``O(n log n)`` for ``n`` seconds
and any frame, each value merged once, and moments are merged, never
subtracted, so nothing cancels.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGEABLE = ("min", "max", "stddev_pop", "stddev_samp", "var_pop", "var_samp")
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Bits of a second within its group, in the key that orders places.
_SECOND_BITS = 40

#: A state: rows with a value, least and greatest value, mean, squared distance from the mean.
_PARTS = ("n", "min", "max", "mean", "m2")


def can_merge(data_type: T.DataType) -> bool:
    return isinstance(data_type, (*INTEGRAL, T.FloatType, T.DoubleType))


def result_type(func: str, data_type: T.DataType) -> T.DataType:
    return data_type if func in ("min", "max") else T.DoubleType()


def state(field: str, data_type: T.DataType, name: str) -> list[Column]:
    """Aggregates that make the state of a group of rows."""
    wide = F.col(field).cast("long" if isinstance(data_type, INTEGRAL) else "double")
    n = F.count(field)
    return [
        n.alias(f"{name}_n"), F.min(wide).alias(f"{name}_min"), F.max(wide).alias(f"{name}_max"),
        F.avg(wide).alias(f"{name}_mean"), (F.var_pop(wide) * n).alias(f"{name}_m2"),
    ]


def merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """States of the rows of both, place by place."""
    n = a["n"] + b["n"]
    share = np.divide(b["n"], n, out=np.zeros(len(n)), where=n > 0)
    step = b["mean"] - a["mean"]
    only_a, only_b = b["n"] == 0, a["n"] == 0
    pick = lambda c, f: np.where(only_a, a[c], np.where(only_b, b[c], f(a[c], b[c])))
    return {
        "n": n,
        "min": pick("min", np.fmin if a["min"].dtype.kind == "f" else np.minimum),  # a missing number is the greatest
        "max": pick("max", np.maximum),
        "mean": pick("mean", lambda x, y: x + step * share),
        "m2": pick("m2", lambda x, y: x + y + step * step * a["n"] * share),
    }


def frame_states(states: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray) -> dict[str, np.ndarray]:
    """The merged states of the places ``low`` to ``high`` (exclusive) of each frame."""
    length, at = np.maximum(high - low, 0), low.copy()
    out = {c: np.zeros(len(low), states[c].dtype) for c in _PARTS}
    level = states
    for bit in range(int(length.max(initial=0)).bit_length()):
        takes = np.flatnonzero(length >> bit & 1)
        if len(takes):
            merged = merge({c: out[c][takes] for c in _PARTS}, {c: level[c][at[takes]] for c in _PARTS})
            for c in _PARTS:
                out[c][takes] = merged[c]
            at[takes] += 1 << bit
        half = 1 << bit
        if len(level["n"]) > half:
            level = merge({c: level[c][:-half] for c in _PARTS}, {c: level[c][half:] for c in _PARTS})
    return out


def value(func: str, s: dict[str, np.ndarray]) -> pa.Array:
    """The aggregate of each state; null without a row (``_samp``: without two)."""
    none = s["n"] < (2 if func.endswith("_samp") else 1)
    if func in ("min", "max"):
        return pa.array(s[func], mask=none)
    over = np.where(none, 1, s["n"] - (1 if func.endswith("_samp") else 0))
    out = s["m2"] / over
    return pa.array(np.sqrt(out) if func.startswith("stddev") else out, mask=none)


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    encoded = pc.dictionary_encode(column.combine_chunks(), null_encoding="encode")
    encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
    return encoded.indices.to_numpy()


def framed(blocked: DataFrame, entity: str, sec: str, specs: Sequence, fields: dict[str, tuple[str, T.DataType]]) -> DataFrame:
    """``entity``, ``sec`` and the frames of ``specs`` for the blocks' own rows of ``blocked``
    (``_blk``, ``_copy``, the states of ``fields``: field -> name, type)."""
    spark = blocked.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocked.repartition(tasks, entity, "_blk").sortWithinPartitions(entity, "_blk", sec)
    wide = lambda s: T.DoubleType() if s.func not in ("min", "max") or not isinstance(fields[s.field][1], INTEGRAL) else T.LongType()
    schema = T.StructType([blocked.schema[entity], blocked.schema[sec], *[T.StructField(s.name, wide(s)) for s in specs]])
    frames = [(s.name, s.func, fields[s.field][0], s.lower_offset, s.upper_offset) for s in specs]
    names = [entity, sec, *[s.name for s in specs]]

    def group_starts(rows: pa.Table) -> np.ndarray:
        entity_code, block = _codes(rows.column(entity)), rows.column("_blk").to_numpy()
        return np.flatnonzero(np.r_[True, (entity_code[1:] != entity_code[:-1]) | (block[1:] != block[:-1])])

    def solve(rows: pa.Table) -> pa.RecordBatch:
        start = group_starts(rows)
        group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, rows.num_rows]))
        second = rows.column(sec).to_numpy()
        second = second - second.min() + (1 << _SECOND_BITS - 2)
        key = group << _SECOND_BITS | second
        own = rows.column("_copy").to_numpy() == 0
        columns = [rows.column(c).filter(pa.array(own)).combine_chunks() for c in (entity, sec)]
        for _, func, name, lower, upper in frames:
            part = {c: rows.column(f"{name}_{c}") for c in _PARTS}
            states = {c: pc.fill_null(x, 0).to_numpy().astype(np.float64 if c in ("mean", "m2") else x.type.to_pandas_dtype()) for c, x in part.items()}
            low = np.searchsorted(key, key[own] - lower, side="left")
            high = np.searchsorted(key, key[own] - upper, side="right")
            first = start[group[own]]  # of the row's group: a frame does not reach before it
            columns.append(value(func, frame_states(states, np.maximum(low, first), np.maximum(high, first))))
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns], names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            before = [held[-1].slice(held[-1].num_rows - 1)] if held else []
            cut = int(group_starts(pa.Table.from_batches([*before, batch]))[-1]) - len(before)
            if cut > 0 or (cut == 0 and held):  # a group begins in this batch, and the last one may go on
                yield solve(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(max(cut, 0)))
        if held:
            yield solve(pa.Table.from_batches(held))

    out = ordered.mapInArrow(run, schema)
    back = [F.col(s.name).cast(result_type(s.func, fields[s.field][1])).alias(s.name) for s in specs]
    return out.select(entity, sec, *back)
