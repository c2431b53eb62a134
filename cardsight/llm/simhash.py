"""SimHash near-dedup by deletion-variant signatures (operator 9).

A 64-bit fingerprint is cut into fewer segments than the distance would need
for an equal one: with ``max_bits // 2 + 1`` segments, two fingerprints at
most ``max_bits`` bits apart differ by at most one bit in some segment, so
they share a variant of that segment with one bit left out. Every distinct
fingerprint is indexed under its 64 variants, equal variants meet in an
equality shuffle, and the bit distance is then verified.

Equal fingerprints are one class before anything is compared. A group of one
variant emits a tree over each linked set, never its pairs; a group beyond
``BLOCK_ROWS`` is cut into blocks whose pairs are dealt to separate tasks.

Defined cases: a null or wordless text has fingerprint zero and links like
any other; repeated rows each get a row; a null id takes part in linking but
never is the smallest id of a component with other ids; a bit that is set in
exactly half of the hashes is 0; a text of any length is one row, whole. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardsight.llm.common import connected_components, key_runs, python_on, stored, tree_edges

BITS = 64
BLOCK_ROWS = 4096
#: Runs up to this size are compared by lag, all runs of a batch at once.
SMALL_RUN = 8
#: Shingles hashed at a time, so that a long text needs bounded memory.
CHUNK = 1 << 16


def simhash(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of a UTF-8 text as an unsigned 64-bit integer."""
    words = text.lower().split()  # on bytes both touch ASCII only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.r_[0, ends[:-1] + 1][: len(words) - k + 1].tolist()
    stops = ends[k - 1 :].tolist()
    n = len(starts)
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + CHUNK], stops[at : at + CHUNK])], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all of a row's columns that have one."""
    hashed = [f.name for f in docs.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{c}`") for c in hashed])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``id``, ``row_hash``, ``fp`` (the fingerprint's bits as a signed long), one row per row of ``docs``."""
    python_on(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [simhash(t or b"", shingle, seed) for t in batch.column(2).cast(pa.binary()).to_pylist()]
            signed = np.array(fps, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], ["id", "row_hash", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), row_hash(docs).alias("row_hash"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInArrow(run, "id long, row_hash long, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    if max_bits < 2:
        raise ValueError("deletion variants serve distances of two bits or more")
    n = max_bits // 2 + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """``key``, ``fp``: a row for each bit left out of each segment."""
    keys = []
    for low, width in segments(max_bits):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            without = value.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            keys.append(without + F.lit((low + bit) << 40))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _linked_sets(fps: np.ndarray, max_bits: int) -> Iterator[np.ndarray]:
    """Sets of two or more fingerprints that links connect, by breadth-first search."""
    rest = fps
    while len(rest):
        found, front, rest = [rest[:1]], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = np.zeros(len(rest), dtype=bool)
            for at in range(0, len(front), 256):
                near |= (np.bitwise_count(front[at : at + 256, None] ^ rest[None, :]) <= max_bits).any(axis=0)
            front, rest = rest[near], rest[~near]
            found.append(front)
        if len(found) > 1:
            yield np.concatenate(found)


def _edge_batch(src: list[np.ndarray], dst: list[np.ndarray], names: list[str], schema: pa.Schema) -> pa.RecordBatch:
    a = np.concatenate(src).view(np.int64) if src else np.empty(0, np.int64)
    b = np.concatenate(dst).view(np.int64) if dst else np.empty(0, np.int64)
    rest = [pa.nulls(len(a), schema.field(n).type) for n in names[2:]]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *rest], names)


_OUT = pa.schema([("src", pa.int64()), ("dst", pa.int64()), ("key", pa.int64()), ("block", pa.int32()), ("members", pa.binary())])


def _verify(max_bits: int, block_rows: int):
    """Task: rows sorted by key -> connecting edges, and the blocks of long runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, long_key, block in key_runs(batches, block_rows):
            fps = rows.column(1).to_numpy().view(np.uint64)
            src: list[np.ndarray] = []
            dst: list[np.ndarray] = []
            if long_key is not None:
                for found in _linked_sets(fps, max_bits):
                    a, b = tree_edges(found)
                    src.append(a), dst.append(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([long_key], pa.int64()),
                     pa.array([block], pa.int32()), pa.array([fps.tobytes()], pa.binary())], _OUT.names)
            else:
                keys = rows.column(0).to_numpy()
                starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                sizes = np.diff(np.r_[starts, len(keys)])
                small = np.repeat(sizes <= SMALL_RUN, sizes)
                for lag in range(1, min(SMALL_RUN, int(sizes.max()))):
                    pair = (keys[lag:] == keys[:-lag]) & small[lag:]
                    i = np.flatnonzero(pair)
                    i = i[np.bitwise_count(fps[i] ^ fps[i + lag]) <= max_bits]
                    src.append(fps[i]), dst.append(fps[i + lag])
                for s, n in zip(starts[sizes > SMALL_RUN], sizes[sizes > SMALL_RUN]):
                    for found in _linked_sets(fps[s : s + n], max_bits):
                        a, b = tree_edges(found)
                        src.append(a), dst.append(b)
            yield _edge_batch(src, dst, _OUT.names, _OUT)

    return run


def _verify_blocks(max_bits: int):
    """Task: two blocks of one long run -> edges that connect what is linked across them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                src: list[np.ndarray] = []
                dst: list[np.ndarray] = []
                for found in _linked_sets(np.frombuffer(a + b, dtype=np.uint64), max_bits):
                    x, y = tree_edges(found)
                    src.append(x), dst.append(y)
                yield _edge_batch(src, dst, ["src", "dst"], _OUT)

    return run


def fingerprint_links(fps: DataFrame, max_bits: int = 4, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``src``, ``dst``: edges that connect exactly the fingerprints that links
    connect, from a table of distinct ``fp``."""
    spark = fps.sparkSession
    python_on(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _variants(fps, max_bits).repartition(n, "key").sortWithinPartitions("key")
    found = stored(
        keyed.mapInArrow(_verify(max_bits, block_rows), "src long, dst long, key long, block int, members binary"),
        "simhash-links",
    )
    blocks = found.where(F.col("members").isNotNull()).select("key", "block", "members")
    pairs = (
        blocks.alias("a").join(blocks.alias("b"), F.expr("a.key = b.key AND a.block < b.block"))
        .select(F.col("a.members").alias("a"), F.col("b.members").alias("b"))
    )
    across = pairs.repartition(n).mapInArrow(_verify_blocks(max_bits), "src long, dst long")
    return found.where(F.col("src").isNotNull()).select("src", "dst").union(across)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, seed: int = 42
) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``row_hash``, ``fp`` (long), ``component_id``,
    the smallest id reachable over links of at most ``max_bits`` bits, and
    ``component``, a number of the component that is never null."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    classes = stored(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "simhash-classes")
    labels = connected_components(fingerprint_links(classes.select("fp"), max_bits))
    # A fingerprint without links is a component of its own.
    joined = classes.join(labels, classes.fp == labels.node, "left").select(
        "fp", "first_id", F.coalesce("label", "fp").alias("label")
    )
    joined = stored(joined, "simhash-labels")
    first = stored(joined.groupBy("label").agg(F.min("first_id").alias("component_id")), "simhash-components")
    by_print = joined.join(first, "label").select("fp", "component_id", F.col("label").alias("component"))
    return prints.join(stored(by_print, "simhash-by-print"), "fp").select(
        "id", "row_hash", "fp", "component_id", "component"
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (null
    ids last), and of several rows of that id the one of the smallest hash.

    Survivors are chosen on narrow rows. Whole rows are joined with them once;
    only survivors that stand in the table several times are grouped.
    """
    found = near_duplicates(docs, id_col, **options)
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row_hash").alias("row_hash"))
    alike = found.groupBy("component", order.alias("k")).agg(F.count("*").alias("copies"))
    first = alike.groupBy("component").agg(F.min(F.struct("k", "copies")).alias("first")).select(
        F.coalesce("first.k.id", F.lit(0)).alias("k1"), F.col("first.k.row_hash").alias("k2"), F.col("first.copies").alias("copies")
    )
    first = stored(first, "simhash-first")
    rows = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)).alias("k1"), row_hash(docs).alias("k2"), F.struct("*").alias("row")
    )
    single = rows.join(first.where("copies = 1"), ["k1", "k2"], "left_semi")
    several = rows.join(first.where("copies > 1"), ["k1", "k2"], "left_semi")
    one = several.groupBy("k1", "k2").agg(F.first("row").alias("row"))
    return single.select("row.*").union(one.select("row.*"))
