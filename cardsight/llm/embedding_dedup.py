"""Embedding near-dedup by a pivot-permutation index (operator 8).

Every vector is described by its nearest reference points (pivots) in the
order of their nearness: near vectors see nearly the same ones first. The
``NEAREST`` first of this permutation are kept. The inverted lists are those of
pairs of pivots: a vector stands, with its permutation, in the list of each
pair of its pivots, so all that share ``MIN_SHARED`` = 2 pivots meet. In a list
the shared pivots of two vectors are counted, and the places they take in both
permutations are compared by Spearman's footrule (a pivot that one of them
lacks stands behind its last): pairs beyond ``MAX_FOOTRULE`` of the largest
value, which share their farthest pivots only, are no candidates. All others
are verified by their cosine in double precision, and a pair counts in the
list of its two first shared pivots. Links are never below the threshold; the
share of them that is found grows with ``NEAREST`` and is measured in the tests
(0.9 is asked for).

Pivots are a bounded, seeded choice of the vectors, about the square root of
their number and at most ``MAX_PIVOTS``, none very near another: pivots inside
one group of near vectors would come in any order to its members. Equal vectors are one class before
anything is compared. A list is compared as one matrix product per task; a
list beyond ``BLOCK_ROWS`` is cut into blocks whose pairs are dealt to
separate tasks. Tasks return a count of links for each vector and trees over
linked sets, never the pairs.

Defined cases: a null or empty vector, one of zeros, and one with null or
non-finite components link with nothing; vectors of different length do not
link; of pivots equally near the one of the smaller number comes first; a vector without id links with nothing and has no component; several
rows of one id are separate vectors; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import connected_components, key_runs, python_on, stored, tree_edges

THRESHOLD = 0.95
NEAREST = 6
MIN_SHARED = 2
#: Of the largest footrule, NEAREST * (NEAREST + 1). Links at the threshold that are found of vectors of
#: 64 dimensions: 0.997 with 128 pivots, 0.975 with 1,024, 0.937 with 8,192.
MAX_FOOTRULE = 0.8
MIN_PIVOTS = 32
MAX_PIVOTS = 8192
PIVOT_COSINE = 0.8
BLOCK_ROWS = 2048
SEED = 42
#: Vectors that are compared with all pivots at a time.
CHUNK = 1024
_PIVOT_BITS = 14


def n_pivots(n_vectors: int) -> int:
    """The next power of two from the square root of the number of vectors, within bounds."""
    return min(MAX_PIVOTS, max(MIN_PIVOTS, 1 << max(0, int(np.ceil(np.log2(max(1.0, np.sqrt(n_vectors))))))))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, without overflow."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def apart(candidates: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` unit vectors of which none is nearer than ``PIVOT_COSINE`` to one before."""
    kept = np.empty((min(most, len(candidates)), candidates.shape[1]))
    n = 0
    for v in candidates:
        if n < len(kept) and not (kept[:n] @ v > PIVOT_COSINE).any():
            kept[n] = v
            n += 1
    return kept[:n]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The first ``nearest`` numbers of each vector's permutation of the pivots."""
    k = min(nearest, len(pivots))
    far = -(unit(vectors) @ pivots.T)
    some = np.sort(np.argpartition(far, k - 1, axis=1)[:, :k], axis=1)
    order = np.argsort(np.take_along_axis(far, some, axis=1), axis=1, kind="stable")
    return np.take_along_axis(some, order, axis=1).astype(np.int32)


def _index(shared: Broadcast, dim: int, nearest: int):
    """Task: classes -> a row for each list that a class stands in, with its permutation."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                tops = nearest_pivots(_matrix(part.column(2)).astype(np.float64), pivots, nearest)
                k = tops.shape[1]
                in_order = pa.FixedSizeListArray.from_arrays(pa.array(tops.ravel()), k).cast(pa.list_(pa.int32()))
                numbers = np.sort(tops, axis=1).astype(np.int64)
                for a, b in list(combinations(range(k), 2)) or [(0, 0)]:
                    key = ((dim << _PIVOT_BITS | numbers[:, a]) << _PIVOT_BITS) | numbers[:, b]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), part.column(0), part.column(1), in_order, part.column(2)],
                        ["key", "rep", "copies", "tops", "v"],
                    )

    return run


def candidates(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of ``x`` and ``y`` (permutations cut to equal length) share
    ``MIN_SHARED`` pivots and are within ``MAX_FOOTRULE``."""
    k = x.shape[1]
    shared = np.zeros((len(x), len(y)), dtype=np.int16)
    alike = np.zeros_like(shared)
    for i in range(k):
        for j in range(k):
            same = x[:, i, None] == y[None, :, j]
            shared += same
            # Weights k, k-1, ... by place: the footrule is the sum of their differences.
            alike += same * np.int16(k - max(i, j))
    footrule = k * (k + 1) - 2 * alike
    return (shared >= min(MIN_SHARED, k)) & (footrule <= MAX_FOOTRULE * k * (k + 1))


def linked_sets(linked: np.ndarray) -> Iterator[np.ndarray]:
    """Index sets of two or more that a symmetric matrix of links connects."""
    rest = np.flatnonzero(linked.any(axis=1))
    while len(rest):
        found, front, rest = [rest[:1]], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = linked[np.ix_(front, rest)].any(axis=0)
            front, rest = rest[near], rest[~near]
            found.append(front)
        if len(found) > 1:
            yield np.concatenate(found)


class _List:
    """Rows of one inverted list."""

    def __init__(self, rep: np.ndarray, copies: np.ndarray, tops: np.ndarray, vectors: np.ndarray):
        self.rep, self.copies, self.tops, self.vectors = rep, copies, tops, vectors

    def packed(self) -> bytes:
        head = np.array([len(self.rep), self.tops.shape[1]], np.int64)
        return b"".join(x.tobytes() for x in (head, self.rep, self.copies, self.tops, self.vectors))

    @classmethod
    def of(cls, data: bytes) -> _List:
        n, k = np.frombuffer(data, np.int64, 2)
        at = 16 + 16 * n
        rep, copies = np.frombuffer(data, np.int64, 2 * n, 16).reshape(2, n)
        tops = np.frombuffer(data, np.int32, n * k, at).reshape(n, k)
        return cls(rep, copies, tops, np.frombuffer(data, np.float64, offset=at + 4 * n * k).reshape(n, -1))


def _compare(a: _List, b: _List | None, key: int, threshold: float) -> tuple[list, list]:
    """Links within a list, or across two blocks of one: (rep, links) arrays and (src, dst) arrays.

    A pair counts in the list of its two first shared pivots only.
    """
    mask = (1 << _PIVOT_BITS) - 1
    p, q = (key >> _PIVOT_BITS) & mask, key & mask
    other = b or a
    linked = np.zeros((len(a.rep), len(other.rep)), dtype=bool)
    for at in range(0, len(a.rep), 256):
        some = candidates(a.tops[at : at + 256], other.tops)
        if some.any():
            linked[at : at + 256] = some & (a.vectors[at : at + 256] @ other.vectors.T >= threshold)
    if b is None:
        np.fill_diagonal(linked, False)
    counts_a, counts_b = np.zeros(len(a.rep), np.int64), np.zeros(len(other.rep), np.int64)
    for at in range(0, len(a.rep), 256):
        i, j = np.nonzero(linked[at : at + 256])
        i = i + at
        if b is None:
            i, j = i[i < j], j[i < j]
        x, y = a.tops[i], other.tops[j]
        before = (x < q) & (x != p)
        elsewhere = ((x[:, :, None] == y[:, None, :]) & before[:, :, None]).any(axis=(1, 2))
        i, j = i[~elsewhere], j[~elsewhere]
        np.add.at(counts_a, i, other.copies[j])
        np.add.at(counts_b, j, a.copies[i])
    if b is None:
        counts = [(a.rep, counts_a + counts_b)]
        sets = [a.rep[s] for s in linked_sets(linked)]
    else:
        counts = [(a.rep, counts_a), (b.rep, counts_b)]
        n = len(a.rep)
        whole = np.zeros((n + len(b.rep),) * 2, dtype=bool)
        whole[:n, n:], whole[n:, :n] = linked, linked.T
        reps = np.concatenate([a.rep, b.rep])
        sets = [reps[s] for s in linked_sets(whole)]
    return [(r[c > 0], c[c > 0]) for r, c in counts], [tree_edges(s) for s in sets]


_FOUND = "rep long, links long, src long, dst long, key long, block int, members binary"
_FOUND_TYPES = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
_FOUND_NAMES = [c.split(" ")[0] for c in _FOUND.split(", ")]


def _found(counts: list, edges: list) -> Iterator[pa.RecordBatch]:
    for at, pairs in ((0, counts), (2, edges)):
        if pairs:
            a, b = (np.concatenate(x) for x in zip(*pairs))
            columns = [pa.nulls(len(a), t) for t in _FOUND_TYPES]
            columns[at : at + 2] = [pa.array(a), pa.array(b)]
            yield pa.RecordBatch.from_arrays(columns, _FOUND_NAMES)


def _verify(threshold: float, block_rows: int):
    """Task: lists sorted by key -> link counts, trees, and the blocks of long lists."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, long_key, block in key_runs(batches, block_rows):
            keys = rows.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            counts, edges = [], []
            for s, e in zip(starts, np.r_[starts[1:], len(keys)]):
                if e - s > 1 or long_key is not None:
                    part = rows.slice(s, e - s)
                    members = _List(
                        part.column(1).to_numpy(), part.column(2).to_numpy(),
                        _matrix(part.column(3)), unit(_matrix(part.column(4)).astype(np.float64)),
                    )
                    c, x = _compare(members, None, int(keys[s]), threshold)
                    counts += c
                    edges += x
                    if long_key is not None:
                        columns = [pa.nulls(1, t) for t in _FOUND_TYPES]
                        columns[4:] = [pa.array([long_key], pa.int64()), pa.array([block], pa.int32()), pa.array([members.packed()], pa.binary())]
                        yield pa.RecordBatch.from_arrays(columns, _FOUND_NAMES)
            yield from _found(counts, edges)

    return run


def _verify_blocks(threshold: float):
    """Task: pairs of blocks of one long list -> link counts and trees across them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, a, b in zip(*(c.to_pylist() for c in batch.columns)):
                yield from _found(*_compare(_List.of(a), _List.of(b), key, threshold))

    return run


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = THRESHOLD,
    nearest: int = NEAREST,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``id, n_links, component_id, kept``, one row per row of ``vectors``."""
    spark = vectors.sparkSession
    python_on(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    v = F.col(vector_col).cast("array<double>")
    sound = F.coalesce(F.forall(v, finite) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"),
        (sound & F.col(id_col).isNotNull()).alias("sound"),
        F.xxhash64(vector_col).alias("h1"), F.xxhash64(F.lit(seed), vector_col).alias("h2"),
    )
    # Equal vectors (by 128 bits of hash) are one class. Classes are numbered by their smallest
    # ids, which several classes may share, so a component's smallest number has its smallest id.
    classes = stored(
        rows.where("sound").groupBy("h1", "h2")
        .agg(F.min("id").alias("first"), F.count("*").alias("copies"), F.first("v").alias("v"))
        .orderBy("first", "h1", "h2").withColumn("rep", F.monotonically_increasing_id()),
        "embedding-classes",
    )
    listed = []
    for r in sorted(classes.groupBy(F.size("v").alias("dim")).count().collect()):
        of_dim = classes.where(F.size("v") == r["dim"])
        most = n_pivots(r["count"])
        chosen = of_dim.orderBy(F.xxhash64("first", F.lit(seed)), "first", "h1", "h2").limit(2 * most).select("v").toArrow()
        pivots = apart(unit(_matrix(chosen.column(0)).astype(np.float64)), most)
        element = dict(vectors.dtypes)[vector_col]
        listed.append(
            of_dim.select("rep", "copies", "v").mapInArrow(
                _index(spark.sparkContext.broadcast(pivots), r["dim"], nearest), f"key long, rep long, copies long, tops array<int>, v {element}"
            )
        )
    if not listed:
        alone = rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
        return alone.withColumn("kept", F.lit(True))
    lists = listed[0]
    for more in listed[1:]:
        lists = lists.union(more)
    found = stored(
        lists.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_verify(threshold, block_rows), _FOUND),
        "embedding-found",
    )
    blocks = found.where(F.col("members").isNotNull()).select("key", "block", "members")
    pairs = blocks.alias("a").join(blocks.alias("b"), F.expr("a.key = b.key AND a.block < b.block")).select(
        F.col("a.key").alias("key"), F.col("a.members").alias("a"), F.col("b.members").alias("b")
    )
    across = stored(pairs.repartition(n).mapInArrow(_verify_blocks(threshold), _FOUND), "embedding-across")
    every = found.unionByName(across)
    links = every.where(F.col("rep").isNotNull()).groupBy("rep").agg(F.sum("links").alias("links"))
    labels = connected_components(every.where(F.col("src").isNotNull()).select("src", "dst"))
    numbered = classes.select("h1", "h2", "rep", "first", "copies")
    smallest = classes.select(F.col("rep").alias("label"), F.col("first").alias("component"))
    by_class = stored(
        numbered.join(links, "rep", "left").join(labels, F.col("rep") == F.col("node"), "left").join(smallest, "label", "left")
        .select(
            "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "first").alias("label"),
        ),
        "embedding-by-class",
    )
    # Rows that are not sound find no class.
    own = rows.select("id", F.when(F.col("sound"), F.col("h1")).alias("h1"), F.when(F.col("sound"), F.col("h2")).alias("h2"), "sound")
    linked = own.where("sound").join(by_class, ["h1", "h2"]).select("id", F.col("links").alias("n_links"), F.col("label").alias("component_id"))
    alone = own.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
