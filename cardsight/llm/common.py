"""Helpers shared by the training-data operators.

Tables that are read more than once, or that cut the lineage of an iteration,
are written as Parquet under the shared folder named by
``spark.checkpoint.dir`` and read back: every executor sees them, a lost
executor cannot lose them, and their size is known to the planner.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight.session import scratch_path, ship_package

#: Fixed value: the word of the contracts (everything but the ASCII white space).
WORD = r"[^\x20\x09-\x0D]+"
#: Most bytes of a batch of rows in a Python task.
BATCH_BYTES = 4 << 20
#: Whether the shuffle files of a query are deleted when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Fan-out of the trees that stand for a linked group (see ``tree_edges``).
FAN_OUT = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """``df`` written once to the shared folder and read back. Nothing reads the shuffles
    of that write again, so their files go with it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def freed(table: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def python_on(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, and
    bound the bytes of the batches they get, so long texts cannot fill memory."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: none)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def identity(key: Column, text: Column) -> Column:
    """What a seeded draw of a row hangs on: its id, or a checksum of its text where it has none."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))


def source_key(source: Column) -> Column:
    """A never-null key that sorts sources by code point with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def n_buckets(spark: SparkSession, n_rows: int, bucket_rows: int) -> int:
    """Buckets of at most about ``bucket_rows`` rows, and enough for all tasks of a shuffle."""
    return max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // bucket_rows))


# ------------------------------------------------------------------ groups of equal keys


def key_runs(
    batches: Iterable[pa.RecordBatch], block_rows: int
) -> Iterator[tuple[pa.Table, int | None, int]]:
    """Cut a stream sorted by its first column into pieces of whole key runs.

    Yields ``(rows, None, 0)`` for rows that hold only whole runs of at most
    ``block_rows`` rows, and ``(rows, key, block)`` for each block of a longer
    run. Memory is bounded by one batch and one block.
    """
    carry: pa.Table | None = None
    long_key, block = None, 0
    for batch in chain(batches, [None]):
        final = batch is None
        parts = [] if carry is None else [carry]
        parts += [] if final else [pa.Table.from_batches([batch])]
        rows = pa.concat_tables(parts).combine_chunks() if parts else None
        if rows is None or rows.num_rows == 0:
            continue
        keys, at, end = rows.column(0).to_numpy(), 0, rows.num_rows
        if long_key is not None:  # the first rows may go on with a long run
            n = end if keys[-1] == long_key else int(np.argmax(keys != long_key))
            ended = final or n < end
            while n >= block_rows:
                yield rows.slice(at, block_rows), long_key, block
                at, n, block = at + block_rows, n - block_rows, block + 1
            if not ended:
                carry = rows.slice(at)
                continue
            if n:
                yield rows.slice(at, n), long_key, block
            at, long_key = at + n, None
        starts = at + np.flatnonzero(np.r_[True, keys[at + 1 :] != keys[at : end - 1]]) if at < end else np.empty(0, int)
        stops = np.r_[starts[1:], end]
        whole = end if final or not len(starts) else int(starts[-1])
        for s, e in zip(starts.tolist(), stops.tolist()):
            if e - s <= block_rows or s >= whole:
                continue
            if s > at:
                yield rows.slice(at, s - at), None, 0
            for i, piece in enumerate(range(s, e, block_rows)):
                yield rows.slice(piece, min(block_rows, e - piece)), keys[s].item(), i
            at = e
        if whole > at:
            yield rows.slice(at, whole - at), None, 0
        at = max(at, whole)
        if end - at > block_rows:  # the last run is long already, and may go on
            long_key, block = keys[at].item(), 0
            while end - at >= block_rows:
                yield rows.slice(at, block_rows), long_key, block
                at, block = at + block_rows, block + 1
        carry = rows.slice(at) if not final else None


def tree_edges(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect ``members`` as a tree of bounded degree and depth."""
    child = np.arange(1, len(members))
    return members[child], members[(child - 1) // FAN_OUT]


# ------------------------------------------------------------------ connected components


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable, for each node of ``edges`` (``src``, ``dst`` longs).

    Each round every node takes the smallest label among its neighbours, then
    the label of its label (pointer jumping), so chains shorten by doubling.
    Rounds are written to the shared folder; only a count of the changed rows
    reaches the driver. Returns ``node``, ``label``; an empty input gives an
    empty result, self loops are kept as nodes.
    """
    both = edges.select("src", "dst").union(edges.select(F.col("dst"), F.col("src"))).distinct()
    both = stored(both, "cc-edges")
    labels = stored(
        both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m"))
        .select("node", F.least("node", "m").alias("label")),
        "cc-labels",
    )
    while True:
        seen = (
            both.join(labels, both.src == labels.node)
            .groupBy(F.col("dst").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        hooked = stored(
            labels.join(seen, "node", "left")
            .select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")),
            "cc-hook",
        )
        up = hooked.select(F.col("node").alias("up"), F.col("label").alias("top"))
        labels = stored(
            hooked.join(up, hooked.label == up.up).select("node", "old", F.col("top").alias("label")), "cc-jump"
        )
        if labels.where("old <> label").limit(1).count() == 0:
            return labels.select("node", "label")
