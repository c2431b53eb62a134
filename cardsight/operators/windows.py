"""Trailing event-time RANGE aggregates per entity (customer or terminal).

Semantics (for a row at whole epoch second ``t`` of entity ``k``): aggregate
``field`` over the rows of ``k`` whose second lies in the closed interval
``[t - (n_days + shift_days) * 86400, t - shift_days * 86400]``. With
``shift_days = 0`` the frame holds the row itself and every other row of the
same second. ``count`` ignores NULLs, ``sum``/``avg`` of an empty frame is
NULL, ``risk`` is ``sum / count`` with NULL (empty frame) replaced by 0.

Three physical strategies, same answers:

``"measured"``
    Entities of more than ``HEAVY_ROWS`` rows go through ``block``; the rows of all others
    are shuffled once, by entity, and their frames are differences of running
    sums over the rows themselves, a linear pass. One count finds out whether there can
    be heavy entities, and only then they are counted; they are at most the
    rows over ``HEAVY_ROWS``. This serves ``count``, ``sum``, ``avg`` and ``risk``.

``"block"`` (default, skew safe)
    1. Pre-aggregate to one row per (entity, second): partial aggregation runs
       map side, and a hot entity's rows collapse to at most one row per
       second, so no group grows with the data volume.
    2. Cut each entity's timeline into blocks of ``L`` seconds with
       ``L >= 2 * (longest lookback + 1)``; a row is also copied into the next
       block when it is within one lookback of that block's start. Every frame
       of a block's own rows is then inside that block's partition, and a
       window partition holds at most ``1.5 L`` distinct seconds.
    3. Frames are differences of running prefix sums,
       ``agg[t-b, t-a] = P(t-a) - P(t-b-1)``, computed by
       ``RANGE BETWEEN UNBOUNDED PRECEDING AND x PRECEDING`` frames, which Spark
       evaluates in one linear pass; sums are exact because values are
       integral (``to_fixed``: whole cents for money).
    4. Per-second results are joined back to the rows on (entity, second);
       hashing on the second spreads a hot entity's rows over all tasks. Rows
       without an entity are an entity of their own, as in a window.

    Minimum, maximum, variance and standard deviation (by name, or as ``F.max``
    and so on) have no prefix form, but states that merge: one per (entity,
    second) as above, merged by powers of two (``mergeable``).

    Any other aggregate, given as a function of a column, takes the rows
    themselves through the same blocks; Spark goes through its moving frame for
    every row, so it costs rows times rows of a frame.

``"sliding"``
    The direct form: frames over ``partitionBy(entity).orderBy(sec)``, a whole entity
    one window group. ``count``, ``sum``, ``avg`` and ``risk`` are differences of running
    sums over its rows; a minimum or maximum is the better of two running ones, over blocks as
    long as the frame (``_two_sided``). Any other aggregate is Spark's moving frame, which goes through
    the frame for every row, so that one serves as a cross-check.

Fractional values are summed as whole numbers of ``10**-scale`` (six decimals
by default); a value that needs more raises an error and asks for a larger
``scale``, so no sum or average is ever of rounded values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.numeric import DEFAULT_SCALE, from_fixed, ratio_or_zero, safe_ratio, to_fixed
from cardsight.functions.time import SECONDS_PER_DAY, epoch_seconds_of
from cardsight.operators.mergeable import MERGEABLE, can_merge, framed, state
from cardsight.session import materialize, ship_package

SEC = "_sec"
#: Rows of an entity from which its frames are cut into blocks; its rows would be one task's else.
HEAVY_ROWS = 200_000
#: Heavy entities that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
SUPPORTED = ("count", "sum", "avg", "risk", *MERGEABLE)
#: Spark's functions that have a name of their own here.
NAMED = {
    F.min: "min", F.max: "max", F.stddev_pop: "stddev_pop", F.stddev_samp: "stddev_samp", F.stddev: "stddev_samp",
    F.std: "stddev_samp", F.var_pop: "var_pop", F.var_samp: "var_samp", F.variance: "var_samp",
}


@dataclass(frozen=True)
class FrameAgg:
    """One trailing aggregate: ``func(field)`` over ``n_days`` ending ``shift_days`` ago.

    ``func`` is one of ``SUPPORTED``, or a function from a column name to an
    aggregate (``F.max``, ``F.stddev_pop``, ...)."""

    name: str
    func: str | Callable[[str], Column]
    field: str = S.TX_AMOUNT
    n_days: int = 1
    shift_days: int = 0

    def __post_init__(self) -> None:
        if not callable(self.func) and self.func not in SUPPORTED:
            raise ValueError(f"func must be one of {SUPPORTED}, got {self.func!r}")
        if self.n_days < 0 or self.shift_days < 0:
            raise ValueError("n_days and shift_days must be >= 0")

    @property
    def upper_offset(self) -> int:
        """Frame end, seconds before the current row (inclusive)."""
        return self.shift_days * SECONDS_PER_DAY

    @property
    def lower_offset(self) -> int:
        """Frame start, seconds before the current row (inclusive)."""
        return (self.n_days + self.shift_days) * SECONDS_PER_DAY

    @property
    def needs_sum(self) -> bool:
        return self.func in ("sum", "avg", "risk")


def _with_seconds(df: DataFrame, time_col: str, seconds_col: str | None) -> tuple[DataFrame, str, bool]:
    if seconds_col and seconds_col in df.columns:
        return df, seconds_col, False
    name = seconds_col or SEC
    return df.withColumn(name, epoch_seconds_of(df, time_col)), name, True


def attach(df: DataFrame, features: DataFrame, entity: str, sec: str) -> DataFrame:
    """``df`` with the columns of ``features`` (one row per entity and second).

    Null entities match each other. That table grows with the data, so it is
    never broadcast."""
    keyed = features.withColumnsRenamed({entity: "_entity", sec: "_second"}).hint("merge")
    same = F.col(entity).eqNullSafe(F.col("_entity")) & F.col(sec).eqNullSafe(F.col("_second"))
    return df.join(keyed, same, "left").drop("_entity", "_second")


def trailing_aggregates(
    df: DataFrame,
    entity: str,
    specs: Sequence[FrameAgg],
    time_col: str = S.TX_DATETIME,
    strategy: str = "block",
    seconds_col: str | None = None,
    scale: int = DEFAULT_SCALE,
    block_factor: int = 2,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Append one column per spec to ``df``; row count and order-free content kept.
    ``measured`` takes the entities in ``heavy`` (see ``heavy_entities``) through blocks."""
    if not specs:
        return df
    df, sec, added = _with_seconds(df, time_col, seconds_col)
    if strategy == "sliding":
        out = _sliding(df, entity, specs, sec, scale)
    elif strategy == "measured":
        if any(spec.func not in ("count", "sum", "avg", "risk") for spec in specs):
            raise ValueError("measured takes count, sum, avg and risk")
        if heavy is None:
            out = _running(df, entity, specs, sec, scale)
        else:
            marked = heavy.select(F.col(entity).alias("_entity"), F.lit(True).alias("_heavy"))
            rows = df.join(marked, F.col(entity).eqNullSafe(F.col("_entity")), "left").drop("_entity")
            light = rows.where("_heavy IS NULL").drop("_heavy")
            hot = rows.where("_heavy").drop("_heavy")
            blocks = attach(hot, per_second_features(hot, entity, specs, sec, scale, block_factor), entity, sec)
            out = _running(light, entity, specs, sec, scale).unionByName(blocks)
    elif strategy == "block":
        out = df
        kinds: dict[str, list[FrameAgg]] = {"sums": [], "merged": [], "rows": []}
        for spec in specs:
            func = spec.func if isinstance(spec.func, str) else NAMED.get(spec.func)
            mergeable = func in MERGEABLE and can_merge(df.schema[spec.field].dataType)
            kind = "merged" if mergeable else "sums" if func in SUPPORTED and func not in MERGEABLE else "rows"
            aggregate = getattr(F, func) if kind == "rows" and func in MERGEABLE else spec.func
            kinds[kind].append(replace(spec, func=func if kind == "merged" else aggregate))
        if kinds["sums"]:
            out = attach(out, per_second_features(df, entity, kinds["sums"], sec, scale, block_factor), entity, sec)
        if kinds["merged"]:
            out = attach(out, _merged(df, entity, kinds["merged"], sec, block_factor), entity, sec)
        if kinds["rows"]:
            out = _row_blocks(out, entity, kinds["rows"], sec, block_factor)
        out = out.select(*df.columns, *[spec.name for spec in specs])
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return out.drop(sec) if added else out


# --------------------------------------------------------------------------- sliding


def _sliding(df: DataFrame, entity: str, specs: Sequence[FrameAgg], sec: str, scale: int) -> DataFrame:
    kinds: dict[str, list[FrameAgg]] = {"sums": [], "ends": [], "frames": []}
    for spec in specs:
        func = spec.func if isinstance(spec.func, str) else NAMED.get(spec.func, spec.func)
        kind = "ends" if func in ("min", "max") else "sums" if func in SUPPORTED and func not in MERGEABLE else "frames"
        kinds[kind].append(replace(spec, func=func))
    out = df
    if kinds["sums"]:
        out = _running(out, entity, kinds["sums"], sec, scale, F.col(sec).isNull())
    if kinds["frames"]:
        base = Window.partitionBy(entity).orderBy(sec)
        frames = [(base.rangeBetween(-s.lower_offset, -s.upper_offset), s) for s in kinds["frames"]]
        aggregate = lambda s: s.func if callable(s.func) else getattr(F, s.func)
        out = out.select("*", *[aggregate(s)(s.field).over(w).alias(s.name) for w, s in frames])
    for spec in kinds["ends"]:
        out = _two_sided(out, entity, spec, sec)
    return out.select(*df.columns, *[spec.name for spec in specs])


def _two_sided(df: DataFrame, entity: str, spec: FrameAgg, sec: str) -> DataFrame:
    """A minimum or maximum from two running ones. With blocks as long as the frame, a frame that
    ends in a block is the block's rows up to its end and, from its start on, those of the block before."""
    length = spec.lower_offset - spec.upper_offset + 1
    block = lambda at: F.expr(f"({at} - pmod({at}, {length})) div {length}")
    end = f"({sec} - {spec.upper_offset})"
    value = F.col(spec.field)
    row = F.struct(*df.columns)
    no_row, no_value = F.lit(None).cast(df.select(row).schema[0].dataType), F.lit(None).cast(df.schema[spec.field].dataType)

    def part(own: Column, at: Column, up: Column, down: Column, last: Column, first: Column) -> Column:
        names = ("_row", "_at", "_up", "_down", "_last", "_first")
        return F.struct(*[c.alias(n) for c, n in zip((own, at, up, down, last, first), names)])

    second = F.col(sec)
    parts = F.array(
        part(row, block(end), F.expr(end), second - spec.lower_offset, no_value, no_value),
        part(no_row, block(sec), second, F.lit(None).cast("long"), value, no_value),
        part(no_row, block(sec) + 1, F.lit(None).cast("long"), second, no_value, value),
    )
    dealt = df.select(F.col(entity).alias("_entity"), F.explode(parts).alias("_p")).select("_entity", "_p.*")
    whole = Window.partitionBy("_entity", "_at")
    run = getattr(F, spec.func)
    last = run("_last").over(whole.orderBy(F.asc("_up")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    first = run("_first").over(whole.orderBy(F.desc("_down")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    either = (F.least if spec.func == "min" else F.greatest)(last, first)
    return dealt.withColumn("_value", either).where(F.col("_row").isNotNull()).select("_row.*", F.col("_value").alias(spec.name))


# --------------------------------------------------------------------------- measured


def heavy_entities(df: DataFrame, entity: str, n_rows: int, heavy_rows: int | None = None) -> DataFrame | None:
    """The entities of ``df`` (``n_rows`` rows) with more than ``heavy_rows`` rows, or None if there are none."""
    heavy_rows = HEAVY_ROWS if heavy_rows is None else heavy_rows
    if n_rows <= heavy_rows:
        return None
    found = materialize(df.groupBy(entity).agg(F.count("*").alias("_n")).where(F.col("_n") > heavy_rows).select(entity))
    n = found.count()
    if not n:
        return None
    return F.broadcast(found) if n <= MOST_BROADCAST else found


def _running(df: DataFrame, entity: str, specs: Sequence[FrameAgg], sec: str, scale: int, peers: Column | None = None) -> DataFrame:
    """Frames as differences of running sums over the rows of an entity. Where ``peers`` is true
    (rows without a second, as ``sliding`` treats them) the frame is the rows that tie with the row."""
    names = list(dict.fromkeys(spec.field for spec in specs))
    parts = {}
    for i, field in enumerate(names):
        parts[f"_c{i}"] = F.col(field).isNotNull().cast("long")
        if any(spec.field == field and spec.needs_sum for spec in specs):
            parts[f"_s{i}"] = to_fixed(field, df.schema[field].dataType, scale)
    w = Window.partitionBy(entity).orderBy(sec)
    return df.withColumns(parts).select(*df.columns, *_prefix_frames(w, specs, names, df.schema, scale, peers))


def _prefix_frames(w, specs: Sequence[FrameAgg], names: list[str], schema, scale: int, peers: Column | None = None) -> list[Column]:
    """Each spec as a difference of running sums of the counts ``_c{i}`` and sums ``_s{i}`` of field ``i``."""

    def prefix(col: str, offset: int) -> Column:
        frame = w.rangeBetween(Window.unboundedPreceding, -offset)
        return F.coalesce(F.sum(col).over(frame), F.lit(0))

    def between(col: str, spec: FrameAgg) -> Column:
        before = prefix(col, spec.lower_offset + 1)
        return prefix(col, spec.upper_offset) - (before if peers is None else F.when(peers, F.lit(0)).otherwise(before))

    out = []
    for spec in specs:
        i = names.index(spec.field)
        dtype = schema[spec.field].dataType
        cnt = between(f"_c{i}", spec)
        if spec.func == "count":
            expr = cnt
        else:
            total = F.when(cnt > 0, between(f"_s{i}", spec))
            if spec.func == "sum":
                expr = from_fixed(total, dtype, scale)
            elif spec.func == "avg":
                expr = safe_ratio(from_fixed(total, dtype, scale), cnt)
            else:  # risk
                expr = ratio_or_zero(total, cnt)
        out.append(expr.alias(spec.name))
    return out


# --------------------------------------------------------------------------- block


def _blocked(df: DataFrame, specs: Sequence[FrameAgg], sec: str, block_factor: int) -> DataFrame:
    """``df`` cut into blocks of ``L`` seconds (``_blk``); a row within one
    lookback of the next block's start is copied into it (``_copy`` = 1)."""
    lookback = max(spec.lower_offset for spec in specs) + 1
    length = max(block_factor, 2) * lookback
    start = F.col(sec) - F.pmod(F.col(sec), F.lit(length))
    block = F.expr(f"({sec} - pmod({sec}, {length})) div {length}")
    tail = F.col(sec) >= start + F.lit(length - lookback)
    copies = F.when(tail, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select("*", block.alias("_blk0"), F.explode(copies).alias("_copy")).withColumn(
        "_blk", F.col("_blk0") + F.col("_copy")
    )


def _merged(df: DataFrame, entity: str, specs: Sequence[FrameAgg], sec: str, block_factor: int) -> DataFrame:
    """One row per (entity, second) with the frames of aggregates whose states merge."""
    ship_package(df.sparkSession)
    fields = {f: (f"_state{i}", df.schema[f].dataType) for i, f in enumerate(dict.fromkeys(s.field for s in specs))}
    states = [part for f, (name, dtype) in fields.items() for part in state(f, dtype, name)]
    per_second = df.groupBy(entity, sec).agg(*states).where(F.col(sec).isNotNull())
    return framed(_blocked(per_second, specs, sec, block_factor), entity, sec, specs, fields)


def _row_blocks(df: DataFrame, entity: str, specs: Sequence[FrameAgg], sec: str, block_factor: int) -> DataFrame:
    """Any aggregate over the rows of a block and of the lookback before it."""
    w = Window.partitionBy(entity, "_blk").orderBy(sec)
    frames = [spec.func(spec.field).over(w.rangeBetween(-spec.lower_offset, -spec.upper_offset)) for spec in specs]
    blocked = _blocked(df, specs, sec, block_factor)
    out = blocked.select(*df.columns, "_copy", *[f.alias(spec.name) for f, spec in zip(frames, specs)])
    return out.where(F.col("_copy") == 0).drop("_copy")


def per_second_features(
    df: DataFrame,
    entity: str,
    specs: Sequence[FrameAgg],
    sec: str,
    scale: int = DEFAULT_SCALE,
    block_factor: int = 2,
) -> DataFrame:
    """One row per (entity, second) of ``df`` carrying every spec's frame value.

    Only ``entity``, ``sec`` and the spec fields are read from ``df``, so the
    scan under it is column-pruned.
    """
    fields: dict[str, bool] = {}
    for spec in specs:
        fields[spec.field] = fields.get(spec.field, False) or spec.needs_sum

    # 1. one row per (entity, second); partial aggregation happens map side.
    aggs = []
    for i, (field, need_sum) in enumerate(fields.items()):
        aggs.append(F.count(field).alias(f"_c{i}"))
        if need_sum:
            dtype = df.schema[field].dataType
            aggs.append(F.sum(to_fixed(field, dtype, scale)).alias(f"_s{i}"))
    per_second = df.groupBy(entity, sec).agg(*aggs)

    # 2. blocks of seconds
    blocked = _blocked(per_second, specs, sec, block_factor)

    # 3. frames as differences of running prefix sums.
    w = Window.partitionBy(entity, "_blk").orderBy(sec)
    frames = _prefix_frames(w, specs, list(fields), df.schema, scale)
    return blocked.select(entity, sec, "_copy", *frames).where(F.col("_copy") == 0).drop("_copy")


# --------------------------------------------------------------------------- fraud risk


def fraud_risk(
    df: DataFrame,
    col_name: str,
    delay: int = S.RISK_DELAY_DAYS,
    n_days: int = 1,
    entity: str = S.TERMINAL_ID,
    label: str = S.TX_FRAUD,
    strategy: str = "block",
) -> DataFrame:
    """Delayed fraud risk: frauds / labelled rows over ``n_days`` ending ``delay`` days ago.

    Computed as a window expression on the rows themselves (no self-join), so
    duplicate ids cannot multiply rows.
    """
    spec = FrameAgg(col_name, "risk", label, n_days, delay)
    return trailing_aggregates(df, entity, [spec], strategy=strategy)


def delayed_sums(
    df: DataFrame,
    delay: int = S.RISK_DELAY_DAYS,
    n_days: int = 1,
    entity: str = S.TERMINAL_ID,
    label: str = S.TX_FRAUD,
    strategy: str = "block",
) -> DataFrame:
    """The two halves of the risk ratio: ``fraud_in_window`` (sum) and ``tx_in_window`` (count)."""
    specs = [
        FrameAgg("fraud_in_window", "sum", label, n_days, delay),
        FrameAgg("tx_in_window", "count", label, n_days, delay),
    ]
    return trailing_aggregates(df, entity, specs, strategy=strategy)

