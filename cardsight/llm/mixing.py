"""Mixing sources to target weights by a splitting tree (operator 5).

1. Each source's size is the number of words of its documents. Targets share
   all words by weight; a target stops at ``MAX_EPOCHS`` times its source and
   the excess is shared again by weight (``source_targets``, water filling in
   two running sums).
2. Within a source, documents are permuted by a seeded md5 and cut into
   blocks of near equal words, the same for all sources. A source's blocks are
   permuted anew for each epoch; its exact quota is the number of blocks in
   that order whose words come nearest its target.
3. The quotas go down a binary tree over the output shards. A node draws the
   blocks of its left half without replacement from all that it has, so the
   counts by source are multivariate hypergeometric; shards get equal numbers
   of blocks, and no block of an epoch is given twice.
4. Each shard draws as many of a source's permuted blocks as the tree gave it,
   next to those of the shard before. The blocks drawn are the mix: a document
   is taken once for each draw of its block. Rows are shuffled within a shard
   by a seeded key.

Prefix sums over a source run in hash buckets with offsets from a table of
bucket totals, so a source with a third of all rows is spread over many
tasks. The tree sees one row per source, and draws one row per block (at most
``blocks_per_shard`` for each shard and one for each source); neither holds
documents.

Defined cases: a null or wordless text has size 0, and any copies of it take
no words; null sources are the last source; a source without words is drawn
once; a document of any length is whole in one block; rows without id are
permuted by their texts, and those of equal text are interchangeable; several
rows of one id or text are separate rows; an empty table gives an empty
result. All randomness is seeded: reruns agree. Columns of the input keep
their names in ``mixed_rows``; nothing of the operator's own is added to them.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight.llm.common import identity, n_buckets, n_words, python_on, source_key, stored

#: Fixed values of the contract.
WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3

SEED = 42
BUCKET_ROWS = 20_000
#: Blocks are this fine, so that the quota of a source of 1 % of the words is within 0.2 % of its target.
BLOCKS_PER_SHARD = 4096
#: Blocks that go to every task, some 60 bytes each; more are joined by a shuffle.
MAX_BROADCAST_BLOCKS = 250_000


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``stratum, source_size``: one row per source.

    A source is full when its weighted share reaches ``max_epochs`` times its
    size. Taken by ``max_epochs * size / weight``, the full sources come
    first, so running sums over the sources give the common level of the
    rest. The windows hold one row per source.
    """
    ordered = sizes.withColumn("nth", F.row_number().over(Window.orderBy("stratum")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = ordered.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(max_epochs)))
    rows = rows.withColumn("fills_at", F.col("most") / F.col("weight"))
    by_level = Window.orderBy("fills_at", "stratum").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumns(
        {
            "full_before": F.coalesce(F.sum("most").over(by_level), F.lit(0.0)),
            "weight_left": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(by_level), F.lit(0.0)),
            "words": F.sum("source_size").over(whole).cast("double"),
        }
    )
    level = (F.col("words") - F.col("full_before")) / F.col("weight_left")
    # The level at the first source that does not fill, the highest of those
    # that do not, holds for all after it.
    common = F.max(F.when(F.col("fills_at") > level, level)).over(whole)
    return rows.select(
        "stratum", "source_size", F.least("most", F.coalesce(common * F.col("weight"), F.col("most"))).alias("target")
    )


def split_quotas(quotas: np.ndarray, n_shards: int, seed: int, names: list[str] | None = None) -> np.ndarray:
    """``[shard, source]`` block counts: a binary tree of multivariate
    hypergeometric draws from the root's quotas; shard totals differ by at most one.

    A node puts its blocks in a seeded order (of the ``names`` of their sources
    and their numbers) and gives the first to its left half.
    """
    names = [str(i) for i in range(len(quotas))] if names is None else names
    out = np.zeros((n_shards, len(quotas)), dtype=np.int64)

    def walk(lo: int, hi: int, blocks: list[tuple[int, int]]) -> None:
        if hi - lo == 1:
            out[lo] = np.bincount([s for s, _ in blocks], minlength=len(quotas))
            return
        mid = (lo + hi) // 2
        each, more = divmod(len(blocks), hi - lo)
        take = each * (mid - lo) + min(more, mid - lo)
        drawn = sorted(blocks, key=lambda b: md5(f"{seed}:{lo}:{hi}:{names[b[0]]}:{b[1]}".encode()).digest())
        walk(lo, mid, drawn[:take])
        walk(mid, hi, drawn[take:])

    walk(0, n_shards, [(s, i) for s, quota in enumerate(quotas.tolist()) for i in range(quota)])
    return out


def _tree(n_shards: int, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("stratum", ignore_index=True)
        counts = split_quotas(pdf["quota"].to_numpy(), n_shards, seed, pdf["stratum"].tolist())
        upto = counts.cumsum(axis=0)
        shards = np.repeat(np.arange(n_shards), len(pdf))
        return pd.DataFrame(
            {
                "stratum": np.tile(pdf["stratum"].to_numpy(), n_shards),
                "shard": shards,
                "first": (upto - counts).ravel(),
                "upto": upto.ravel(),
            }
        )

    return run


def _unit(draw: Column) -> Column:
    return F.conv(F.substring(draw, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(
    docs: DataFrame,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    blocks_per_shard: int = BLOCKS_PER_SHARD,
    seed: int = SEED,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``id, size, source_size, target, copies`` and
    ``row`` (a struct of the columns ``carry``, none by default). ``copies`` is an
    array of ``(epoch, shard)``, empty when the mix leaves the document out."""
    spark = docs.sparkSession
    python_on(spark)
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"),
        source_key(F.col(source_col)).alias("stratum"),
        n_words(text).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).alias("crc"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), identity(F.col(id_col), text))).alias("draw"),
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row") if carry else F.struct(F.lit(0).alias("none")).alias("row"),
    )
    narrow = stored(rows.drop("row"), "mix-sizes")
    if not carry:
        rows = narrow.withColumn("row", F.struct(F.lit(0).alias("none")))
    buckets = n_buckets(spark, narrow.count(), BUCKET_ROWS)
    bucket = F.least(F.floor(_unit(F.col("draw")) * buckets), F.lit(buckets - 1)).cast("int")

    # One row per (source, bucket): words before the bucket, in permuted order.
    totals = narrow.groupBy("stratum", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("stratum").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("stratum", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    sizes = narrow.groupBy("stratum").agg(F.sum("size").alias("source_size"))
    sources = stored(source_targets(sizes, weights, max_epochs), "mix-sources")

    # Words of a block, the same for all sources.
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    block_words = max(1, words // (n_shards * blocks_per_shard))

    order = Window.partitionBy("stratum", "bucket").orderBy("draw", "id", "crc", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        rows.withColumn("bucket", bucket)
        .withColumn("at", F.sum("size").over(running) - F.col("size"))
        .join(offsets, ["stratum", "bucket"])
        .withColumn("at", F.col("at") + F.col("before"))
        .join(sources, "stratum")
    )
    placed = placed.withColumn("block", F.floor(F.col("at") / F.lit(block_words)).cast("long"))

    # A source's turns: all its blocks, permuted anew in each epoch. Its quota is
    # the number of turns that bring its words nearest the target.
    blocks = stored(placed.groupBy("stratum", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), "stratum", "epoch", "block"))
    by_turn = Window.partitionBy("stratum").orderBy("epoch", "permuted", "block")
    turns = (
        blocks.select("*", F.explode(F.sequence(F.lit(1), F.lit(max_epochs))).alias("epoch"))
        .withColumn("permuted", key)
        .withColumn("turn", (F.row_number().over(by_turn) - 1).cast("long"))
        .withColumn("given", F.sum("words").over(by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
        .join(sources, "stratum")
        .where((F.col("given") + F.col("words") / 2 <= F.col("target")) & ((F.col("source_size") > 0) | (F.col("epoch") == 1)))
        .select("stratum", "block", "epoch", "turn")
    )
    turns = stored(turns, "mix-turns")
    quotas = turns.groupBy("stratum").agg(F.count("*").alias("quota"))
    dealt = quotas.groupBy(F.lit(0).alias("all_sources")).applyInPandas(
        _tree(n_shards, seed), "stratum string, shard int, first long, upto long"
    )
    draws = stored(dealt, "mix-dealt").where("upto > first").select(
        "stratum", "shard", F.explode(F.expr("sequence(first, upto - 1)")).alias("turn")
    )
    drawn = (
        turns.join(draws, ["stratum", "turn"])
        .groupBy("stratum", "block")
        .agg(F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("copies"))  # at most max_epochs each
    )
    drawn = stored(drawn, "mix-drawn")
    small = drawn.count() <= MAX_BROADCAST_BLOCKS  # more only with as many sources
    out = placed.join(F.broadcast(drawn) if small else drawn, ["stratum", "block"], "left")
    none = F.array().cast("array<struct<epoch:int,shard:int>>")
    return out.select("id", "size", "source_size", "target", F.coalesce("copies", none).alias("copies"), "row")


def mixed_rows(docs: DataFrame, n_shards: int = 8, seed: int = SEED, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each copy, dealt to
    ``n_shards`` groups of rows and shuffled within each by a seeded key."""
    rows = mix(docs, n_shards, seed=seed, carry=docs.columns, **options)
    copies = rows.select("id", "row", F.explode("copies").alias("copy"))
    local = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("copy.shard"), F.col("copy.epoch"), F.col("id")))
    n = max(n_shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # A shard may span several partitions: deal by shard and by the local key's first digit.
    part = F.substring("local", 1, 2)
    dealt = copies.withColumn("local", local).repartition(n, F.col("copy.shard"), part)
    return dealt.sortWithinPartitions("copy.shard", "local").select("row.*")


def _split_sql(n_shards: int) -> str:
    """The nodes of each level of the tree over ``n_shards`` (a power of two), each a table of its blocks."""
    levels = ["node_1 AS (SELECT stratum, turn, 0 AS lo, %d AS hi FROM turns)" % n_shards]
    size = n_shards
    while size > 1:
        half = size // 2
        levels.append(f"""node_{2 * n_shards // size} AS (
  SELECT stratum, turn, CASE WHEN nth <= take THEN lo ELSE lo + {half} END AS lo,
    CASE WHEN nth <= take THEN lo + {half} ELSE hi END AS hi
  FROM (
    SELECT *, row_number() OVER (PARTITION BY lo ORDER BY md5('{SEED}:' || lo || ':' || hi || ':' || stratum || ':' || turn)) AS nth,
      count(*) OVER (PARTITION BY lo) // {size} * {half} + least(count(*) OVER (PARTITION BY lo) % {size}, {half}) AS take
    FROM node_{n_shards // size}
  )
)""")
        size = half
    return ", ".join(levels)


#: The same digest for eight shards in DuckDB SQL.
ORACLE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce('0' || source, '1') AS stratum,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS draw
  FROM documents
), sources AS (
  SELECT stratum, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * {MAX_EPOCHS} AS most,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY stratum) - 1) % 3 + 1)::INTEGER]::DOUBLE AS weight
  FROM sized GROUP BY stratum
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY most / weight, stratum ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT stratum, source_size,
    least(most, coalesce(max(CASE WHEN most / weight > level THEN level END) OVER () * weight, most)) AS target
  FROM levels
), placed AS (
  SELECT s.*, (sum(size) OVER (PARTITION BY stratum ORDER BY draw, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      - size)::BIGINT // (SELECT greatest(1, sum(source_size)::BIGINT // {8 * BLOCKS_PER_SHARD}) FROM sources) AS block
  FROM sized s
), turns AS (
  SELECT stratum, block, epoch, turn
  FROM (
    SELECT *, row_number() OVER by_turn - 1 AS turn, sum(words) OVER by_turn - words AS given
    FROM (
      SELECT stratum, block, epoch, sum(size) AS words, md5('{SEED}:' || stratum || ':' || epoch || ':' || block) AS permuted
      FROM placed, (SELECT unnest(range(1, {MAX_EPOCHS + 1})) AS epoch) GROUP BY stratum, block, epoch
    )
    WINDOW by_turn AS (PARTITION BY stratum ORDER BY epoch, permuted ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  ) JOIN targets USING (stratum)
  WHERE given + words / 2 <= target AND (source_size > 0 OR epoch = 1)
), {_split_sql(8)}, drawn AS (
  SELECT stratum, block, count(*) AS times, string_agg(shard::VARCHAR, ',' ORDER BY epoch) AS shards
  FROM turns JOIN (
    SELECT stratum, lo AS shard, row_number() OVER (PARTITION BY stratum ORDER BY lo) - 1 AS turn FROM node_8
  ) USING (stratum, turn)
  GROUP BY stratum, block
)
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * coalesce(times, 0))::BIGINT AS taken,
  coalesce(shards, '') AS shards
FROM placed JOIN targets USING (stratum) LEFT JOIN drawn USING (stratum, block)
"""
