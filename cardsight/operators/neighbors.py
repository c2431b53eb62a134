"""Exact k-nearest-neighbour join, SMOTE oversampling and a k-NN classifier.

``knn_join`` is exact and never forms a cross join or a row per pair. It has
two rounds over a k-d partition of the reference rows:

1. Boxes are cut at the medians of a bounded, seeded sample, feature by
   feature along the widest side, until a box holds about ``box_rows`` rows; one
   aggregate gives the real bounds of each box. Any cuts give the same result.
2. In the first round each query meets one block of its own box, which gives
   it a bound of its own: the distance of its k-th nearest row there.
3. In the second round a query is sent to the boxes that its ball meets (found
   by walking down the tree of boxes) and no others, and takes the k best of
   each within its bound: a product of matrices finds the rows there, and only their
   distances are computed. A last window over ``k`` rows per block that it met keeps the k best.

Rows of a box are dealt to blocks of about ``block`` rows, so a box that no cut
divides (equal rows) is many blocks; queries of a box are dealt to chunks of
about ``chunk`` rows, one for all but hot boxes. A group of (box, block, chunk) is
streamed: its reference rows are held, its queries pass by.

Distances are Euclidean; ties are broken by reference id.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.functions.hashing import seeded_int, seeded_uniform
from cardsight.operators import sampling as smp
from cardsight.session import materialize, ship_package

SLACK = 1e-9
#: Bound of what a squared distance by a product of matrices loses, per feature and unit of squared length.
ROUNDING = 1e-14
#: Doubles of a distance block, and rows of a piece of candidates, held by a task.
BLOCK_DOUBLES = 4_000_000
PRODUCT_DOUBLES = 1 << 18
#: Parts of a block whose least distances bound the k-th.
CHUNKS = 64
PIECE_ROWS = 50_000


def _dist(X: np.ndarray, Y: np.ndarray, budget: int = BLOCK_DOUBLES) -> np.ndarray:
    """Exact pairwise Euclidean distances, ``len(X) x len(Y)``, in row blocks
    whose difference tensor holds at most ``budget`` doubles (~32 MB)."""
    out = np.empty((len(X), len(Y)))
    rows = max(1, budget // max(1, len(Y) * max(1, X.shape[1] if X.ndim == 2 else 1)))
    for s in range(0, len(X), rows):
        diff = X[s : s + rows, None, :] - Y[None, :, :]
        out[s : s + rows] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return out


def _shifted(R: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, int]:
    """The mean of ``R``; its rows from there with their squared lengths and ones, filled up with rows at no
    distance to whole parts, at most ``CHUNKS``; the largest of these lengths; the rows of a part."""
    center = R.mean(axis=0) if len(R) else np.zeros(R.shape[1])
    each = max(1, -(-len(R) // CHUNKS))
    r = R - center
    length = np.einsum("ij,ij->i", r, r)
    aside = np.zeros((R.shape[1] + 2, -(-len(R) // each) * each))
    aside[:-2, : len(R)], aside[-2], aside[-1] = r.T, np.inf, 1.0
    aside[-2, : len(R)] = length
    return center, aside, float(length.max(initial=0.0)), each


def _within(
    Q: np.ndarray, R: np.ndarray, theta: np.ndarray, k: int, shifted: tuple, same: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of pairs at most ``theta`` apart, the ``k`` nearest of each row of ``Q`` among them, and their
    distances. One product of matrices finds them: the ``k``-th least of the minima of ``CHUNKS`` parts of ``R``
    bounds the ``k``-th distance too. Bounds are widened by more than the product's rounding, and the
    distances are those of ``_dist``. ``same`` are ranges of ``R`` that a row does not meet. Squares must be finite."""
    center, aside, longest, each = shifted
    q = Q - center
    length = np.einsum("ij,ij->i", q, q)
    lost = ROUNDING * Q.shape[1] * (length + longest)
    limit = theta * theta * (1 + SLACK) + lost
    apart = np.c_[-2.0 * q, np.ones(len(q)), length] @ aside
    if same is not None:
        for i in np.flatnonzero(same[0] < same[1]):
            apart[i, same[0][i] : same[1][i]] = np.inf
    least = np.minimum.reduceat(apart, np.arange(0, apart.shape[1], each), axis=1) if len(R) else apart
    if least.shape[1] >= k:
        limit = np.minimum(limit, np.partition(least, k - 1, axis=1)[:, k - 1] * (1 + SLACK) + 2 * lost)
    row, chunk = np.nonzero(least <= limit[:, None])
    hit, place = np.nonzero(apart.reshape(len(Q), -1, each)[row, chunk] <= limit[row, None]) if len(R) else (row, row)
    row, at = row[hit], chunk[hit] * each + place
    d = np.empty(len(row))
    for s in range(0, len(row), PIECE_ROWS):
        part = slice(s, s + PIECE_ROWS)
        diff = Q[row[part]] - R[at[part]]
        d[part] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return row, at, d


def _points(df: DataFrame, features: list[str], id_col: str) -> DataFrame:
    """``_id`` and the features as doubles; a NULL or NaN feature has no distance and raises an error."""

    def sound(c: str) -> Column:
        x = F.col(c).cast("double")
        message = F.concat(F.lit(f"feature {c} has no value in row "), F.coalesce(F.col(id_col).cast("string"), F.lit("?")))
        return F.when(x.isNull() | F.isnan(x), F.raise_error(message).cast("double")).otherwise(x).alias(c)

    return df.select(F.col(id_col).alias("_id"), *[sound(c) for c in features])


# --------------------------------------------------------------------------- the tree of boxes


class Boxes:
    """A k-d tree of ``n`` leaves: node ``i`` asks ``x[feature[i]] > cut[i]`` and has the children
    ``2 i + 1`` and ``2 i + 2``; leaves come last. ``low`` and ``high`` are the bounds of each node's rows."""

    def __init__(self, depth: int, sample: np.ndarray):
        self.depth, inner = depth, (1 << depth) - 1
        self.feature, self.cut = np.zeros(inner, int), np.zeros(inner)
        parts = {0: sample}
        for i in range(inner):
            part = parts.pop(i)
            if len(part):
                self.feature[i] = np.argmax(part.max(axis=0) - part.min(axis=0))
                self.cut[i] = np.median(part[:, self.feature[i]])
            above = part[:, self.feature[i]] > self.cut[i]
            parts[2 * i + 1], parts[2 * i + 2] = part[~above], part[above]
        self.low = self.high = None

    def of(self, x: np.ndarray) -> np.ndarray:
        """The box of each row."""
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[np.arange(len(x)), self.feature[node]] > self.cut[node])
        return node - ((1 << self.depth) - 1)

    def bound(self, bounds: dict[int, tuple[list, list]], width: int) -> None:
        """Bounds of the boxes that hold rows (box -> lows, highs), and so of all nodes."""
        inner, n = (1 << self.depth) - 1, 1 << self.depth
        self.low, self.high = np.full((inner + n, width), np.inf), np.full((inner + n, width), -np.inf)
        for box, (low, high) in bounds.items():
            self.low[inner + box], self.high[inner + box] = low, high
        for i in range(inner - 1, -1, -1):
            self.low[i] = np.minimum(self.low[2 * i + 1], self.low[2 * i + 2])
            self.high[i] = np.maximum(self.high[2 * i + 1], self.high[2 * i + 2])

    def met(self, x: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of rows and the boxes that hold rows within ``theta`` of them."""
        row, node = np.arange(len(x)), np.zeros(len(x), int)
        for level in range(self.depth + 1):
            gap = np.maximum(np.maximum(self.low[node] - x[row], x[row] - self.high[node]), 0.0)
            near = np.sqrt((gap * gap).sum(axis=1)) <= theta[row] * (1 + SLACK) + SLACK
            near &= self.low[node, 0] <= self.high[node, 0]  # a box without rows is met by none
            row, node = row[near], node[near]
            if level < self.depth:
                row, node = np.r_[row, row], np.r_[2 * node + 1, 2 * node + 2]
        return row, node - ((1 << self.depth) - 1)


# --------------------------------------------------------------------------- groups of reference rows and queries

_BITS = 20  # of a block's and of a chunk's number


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """Pieces of one group and kind (``_g``, ``_query``) of a sorted stream."""
    for batch in batches:
        if batch.num_rows:
            g, kind = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_g", "_query"))
            start = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (kind[1:] != kind[:-1])])
            for s, e in zip(start, np.r_[start[1:], len(g)]):
                yield int(g[s]), bool(kind[s]), batch.slice(s, e - s)


def _meet(features: list[str], k: int, exclude_self: bool, bound: bool):
    """Task: groups sorted with their reference rows first -> for each query its distance bound
    (``_id``, features, ``_theta``), or its ``k`` nearest rows of the group (``q_id, r_id, distance``),
    of which those beyond the query's ``_theta``, if it has one, may be left out."""

    def values(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        return part.column("_id").to_numpy(), np.column_stack([part.column(c).to_numpy() for c in features])

    def apart(qid: np.ndarray, rid: np.ndarray, Q: np.ndarray, R: np.ndarray) -> np.ndarray:
        D = _dist(Q, R)
        if exclude_self:
            D[qid[:, None] == rid[None, :]] = np.inf
        return D

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, held = None, [], None
        for g, is_query, part in _runs(batches):
            if g != group:
                group, parts, held = g, [], None
            if not is_query:
                parts.append(values(part))
                continue
            if held is None:
                rid, R = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, int), np.empty((0, len(features))))
                order = np.argsort(rid, kind="stable")  # equal distances resolve by id
                held, parts = (rid[order], R[order], _shifted(R[order])), []
            rid, R, shifted = held
            rows = max(1, (BLOCK_DOUBLES if bound else PRODUCT_DOUBLES) // max(1, len(rid)))
            for s in range(0, part.num_rows, rows):
                piece = part.slice(s, rows)
                qid, Q = values(piece)
                if bound:
                    D = apart(qid, rid, Q, R)
                    take = min(k, D.shape[1])
                    theta = np.partition(D, k - 1, axis=1)[:, k - 1] if take == k else np.full(len(qid), np.inf)
                    yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in ["_id", *features]), pa.array(theta)], ["_id", *features, "_theta"])
                    continue
                theta = piece.column("_theta").to_numpy(zero_copy_only=False).astype(np.float64)
                known = np.isfinite(theta * theta) & np.isfinite((Q * Q).sum(axis=1)) & np.isfinite(shifted[2])
                pairs = []
                if known.any():
                    place = np.flatnonzero(known)
                    same = tuple(np.searchsorted(rid, qid[known], side) for side in ("left", "right")) if exclude_self else None
                    row, at, d = _within(Q[known], R, theta[known], k, shifted, same)
                    pairs.append((place[row], at, d))
                if not known.all() and len(rid):
                    place = np.flatnonzero(~known)
                    D = apart(qid[place], rid, Q[place], R)
                    take = min(k, D.shape[1])
                    least = np.partition(D, take - 1, axis=1)[:, take - 1]
                    row, at = np.nonzero((D <= least[:, None]) & np.isfinite(D))
                    pairs.append((place[row], at, D[row, at]))
                if pairs:
                    row, at, d = (np.concatenate(x) for x in zip(*pairs))
                    order = np.lexsort([at, d, row])
                    row, at, d = row[order], at[order], d[order]
                    first = np.searchsorted(row, np.arange(len(qid)))
                    best = np.arange(len(row)) - first[row] < k  # of equal distances the lowest ids
                    columns = [qid[row[best]], rid[at[best]], d[best]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q_id", "r_id", "distance"])

    return run


def _grouped(queries: DataFrame, reference: DataFrame, plan: dict[int, tuple[int, int]], columns: list[str], first_only: bool) -> DataFrame:
    """Queries and reference rows (``_box``, ``columns``) by group, reference rows first. ``plan``
    has the blocks and chunks of each box that has more than one of either."""
    spark = queries.sparkSession
    if list(plan) == [0]:
        only = {c: F.lit(n).cast("long") for c, n in zip(("_blocks", "_chunks"), plan[0])}
        sized = lambda df: df.withColumns(only)
    else:
        rows = [(box, *sizes) for box, sizes in plan.items() if sizes != (1, 1)] or [(-1, 1, 1)]
        sizes = F.broadcast(spark.createDataFrame(rows, "_box int, _blocks long, _chunks long"))  # at most a row per box
        sized = lambda df: df.join(sizes, "_box", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(1))
    all_of = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), n(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("_id"), n(c))
    q = sized(queries).withColumn("_chunk", own("_chunks"))
    q = q.withColumn("_block", F.lit(0).cast("long")) if first_only else q.withColumn("_block", all_of("_blocks"))
    r = sized(reference).withColumn("_block", own("_blocks"))
    r = (r.where("_block = 0") if first_only else r).withColumn("_chunk", all_of("_chunks"))
    g = F.shiftleft(F.shiftleft(F.col("_box").cast("long"), _BITS) + F.col("_block"), _BITS) + F.col("_chunk")
    both = r.select(g.alias("_g"), F.lit(False).alias("_query"), *columns).union(q.select(g.alias("_g"), F.lit(True).alias("_query"), *columns))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(tasks, "_g").sortWithinPartitions("_g", "_query")


def knn_join(
    queries: DataFrame,
    reference: DataFrame,
    features: Sequence[str],
    k: int = 5,
    id_col: str = S.TRANSACTION_ID,
    exclude_self: bool = True,
    box_rows: int = 4096,
    max_boxes: int = 1 << 16,
    chunk: int = 1_000_000,
    block: int = 16_384,
    seed: int = 0,
    n_ref: int | None = None,
) -> DataFrame:
    """``q_id, rank, r_id, distance``: the k nearest reference rows per query
    (rank 1 is nearest). With ``exclude_self`` a reference row with the
    query's id is skipped. ``n_ref`` (the reference row count, when known)
    only sizes the boxes. ``max_boxes`` bounds the tree that goes to all tasks;
    boxes beyond it are larger, and their blocks more."""
    features = list(features)
    spark = queries.sparkSession
    ship_package(spark)
    columns = ["_id", *features]
    q, r = _points(queries, features, id_col), _points(reference, features, id_col)
    n_ref = r.count() if n_ref is None else n_ref
    if n_ref == 0:
        return spark.createDataFrame([], "q_id long, rank int, r_id long, distance double")
    depth = max(0, min(math.ceil(math.log2(n_ref / box_rows)), int(math.log2(max_boxes))))
    spec = ", ".join(f"`{c}` {'long' if c == '_id' else 'double'}" for c in columns)
    q, r = (df.select(F.col("_id").cast("long").alias("_id"), *features) for df in (q, r))
    if depth == 0:
        counts = {0: n_ref}
        rboxed, met = r.withColumn("_box", F.lit(0)), q.withColumns({"_box": F.lit(0), "_theta": F.lit(None).cast("double")})
        # One box only: its few rows go to as many tasks as there are, each with a part of the queries.
        n_queries = n_ref if queries is reference else q.count()
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        chunks = {0: max(-(-n_queries // chunk), min(tasks, -(-n_queries // 256)))}
    else:
        # At most 64 rows a box: any cuts give the same neighbours.
        sample = r.withColumn("_ok", smp.order_key(seed, "_id")).orderBy("_ok", "_id").limit(64 << depth).select(*features)
        tree = Boxes(depth, sample.toPandas().to_numpy(float))
        cut = spark.sparkContext.broadcast(tree)

        def boxed(df: DataFrame) -> DataFrame:
            def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    x = np.column_stack([batch.column(c).to_numpy() for c in features])
                    yield batch.append_column("_box", pa.array(cut.value.of(x).astype(np.int32)))

            return df.mapInArrow(run, f"{spec}, _box int")

        rboxed = materialize(boxed(r))
        ends = [f(c).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("l", F.min), ("h", F.max))]
        found = rboxed.groupBy("_box").agg(F.count("*").alias("n"), *ends).collect()  # a row for each box
        counts = {x["_box"]: x["n"] for x in found}
        tree.bound({x["_box"]: tuple([x[f"{e}{i}"] for i in range(len(features))] for e in "lh") for x in found}, len(features))

        qboxed = materialize(boxed(q))
        n_queries = {x["_box"]: x["count"] for x in qboxed.groupBy("_box").count().collect()}  # a row for each box
        plan = {b: (-(-counts.get(b, 1) // block), -(-n // chunk)) for b, n in n_queries.items()}
        once = _grouped(qboxed, rboxed, plan, columns, first_only=True)
        bounded = once.mapInArrow(_meet(features, k, exclude_self, bound=True), f"{spec}, _theta double")
        shared = spark.sparkContext.broadcast(tree)

        def ship(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, PIECE_ROWS):
                    part = batch.slice(s, PIECE_ROWS)
                    x = np.column_stack([part.column(c).to_numpy() for c in features])
                    row, box = shared.value.met(x, part.column("_theta").to_numpy())
                    yield part.select([*columns, "_theta"]).take(pa.array(row)).append_column("_box", pa.array(box.astype(np.int32)))

        met = materialize(bounded.mapInArrow(ship, f"{spec}, _theta double, _box int"))
        chunks = {x["_box"]: -(-x["count"] // chunk) for x in met.groupBy("_box").count().collect()}  # a row for each box
    plan = {b: (-(-n // block), chunks.get(b, 1)) for b, n in counts.items()}
    rboxed = rboxed.withColumn("_theta", F.lit(None).cast("double"))
    near = _grouped(met, rboxed, plan, [*columns, "_theta"], first_only=False).mapInArrow(
        _meet(features, k, exclude_self, bound=False), "q_id long, r_id long, distance double"
    )
    w = Window.partitionBy("q_id").orderBy("distance", "r_id")  # at most k rows for each block that the query met
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "q_id", F.col("rank").cast("int"), "r_id", "distance"
    )


# --------------------------------------------------------------------------- SMOTE


def smote(
    rows: DataFrame,
    features: Sequence[str],
    label: str = S.LABEL_COLUMN,
    id_col: str = S.TRANSACTION_ID,
    ratio: float = 0.3,
    k: int = 5,
    seed: int = 42,
    minority: int = 1,
    counts: dict | None = None,
) -> DataFrame:
    """Append ``int(ratio * n_majority - n_minority)`` synthetic minority rows.

    Each synthetic row lies on the segment from a minority row towards one of
    its k nearest minority neighbours, at a seeded uniform position in [0, 1).
    The rows are spread evenly over the minority rows (the seeded order decides
    which rows make one extra). Synthetic rows carry a NULL id. Raises when the
    minority already exceeds the ratio, when it has no more than ``k`` rows,
    and when a feature is NULL.
    """
    features = list(features)
    counts = counts if counts is not None else smp.class_count_map(rows, label)
    n_min = counts.get(minority, 0)
    n_maj = max((n for c, n in counts.items() if c != minority), default=0)
    n_new = int(ratio * n_maj - n_min)
    if n_new < 0:
        raise ValueError("the minority class already exceeds the requested ratio")
    if n_new == 0:
        return rows
    if n_min <= k:
        raise ValueError(f"{n_min} minority rows do not have {k} neighbours each")
    mino = rows.where(F.col(label) == minority)
    nn = knn_join(mino, mino, features, k, id_col, exclude_self=True, seed=seed, n_ref=n_min)

    base, extra = divmod(n_new, n_min)
    copies = F.lit(base)
    if extra:
        keyed = mino.withColumn("_ok", smp.order_key(seed, id_col))
        from cardsight.operators.selection import kth_smallest

        v, tb = kth_smallest(keyed, label, "_ok", id_col, [(minority, extra)])[(minority, extra)]
        mino = keyed.withColumn(
            "_copies", copies + ((F.col("_ok") < v) | ((F.col("_ok") == v) & (F.col(id_col) <= tb))).cast("int")
        ).drop("_ok")
    else:
        mino = mino.withColumn("_copies", copies)
    seeds = mino.where(F.col("_copies") > 0).select(
        F.col(id_col).alias("_src"), *features, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")
    )
    seeds = seeds.withColumn("_rank", (seeded_int(seed, k, "_src", "_copy") + 1).cast("int"))
    seeds = seeds.withColumn("_u", seeded_uniform(seed + 1, "_src", "_copy"))
    picked = seeds.join(
        nn.select(F.col("q_id").alias("_src"), F.col("rank").alias("_rank"), F.col("r_id").alias("_nbr")),
        on=["_src", "_rank"],
        how="inner",
    )
    nbr = rows.where(F.col(label) == minority).select(F.col(id_col).alias("_nbr"), *[F.col(c).alias(f"_n_{c}") for c in features])
    joined = picked.join(nbr, on="_nbr", how="inner")
    synthetic = joined.select(
        F.lit(None).cast(rows.schema[id_col].dataType).alias(id_col),
        *[(F.col(c) + F.col("_u") * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in features],
        F.lit(minority).cast(rows.schema[label].dataType).alias(label),
    )
    return rows.unionByName(synthetic.select(*rows.columns), allowMissingColumns=False)


# --------------------------------------------------------------------------- k-NN classifier


class KnnModel:
    """k-NN vote: score = share of fraudulent labels among the k nearest
    training rows, prediction = score > 0.5."""

    def __init__(self, training: DataFrame, features: Sequence[str], id_col: str, k: int = 5):
        # Rows without an id, the synthetic ones, get negative numbers from their place in the
        # materialised rows: equal rows stay as many neighbours as they are.
        self.features = list(features)
        self.id_col = id_col
        self.k = k
        number = -1 - F.monotonically_increasing_id()
        self.training = materialize(training.withColumn("_rid", F.coalesce(F.col(id_col), number)))

    @classmethod
    def of(cls, training: DataFrame, features: Sequence[str], k: int = 5, id_col: str = S.TRANSACTION_ID) -> KnnModel:
        """A model over training rows that were saved with their ``_rid``."""
        model = cls.__new__(cls)
        model.features, model.id_col, model.k, model.training = list(features), id_col, k, training
        return model

    def transform(self, df: DataFrame) -> DataFrame:
        ref = self.training.select(F.col("_rid").alias(self.id_col), *self.features, "label")
        nn = knn_join(df, ref, self.features, self.k, self.id_col, exclude_self=False)
        votes = nn.join(ref.select(F.col(self.id_col).alias("r_id"), F.col("label").alias("_y")), "r_id").groupBy(
            "q_id"
        ).agg(F.avg("_y").alias("score"))
        out = df.join(votes.withColumnRenamed("q_id", self.id_col), self.id_col, "left")
        return out.withColumn("prediction", (F.col("score") > 0.5).cast("double"))
