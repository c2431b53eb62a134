"""Sharding by proportional stratified interleaving (operator 2, native).

Rows are shuffled within each source by a seeded md5, ranked, and sorted by
fractional rank ``(2 rank - 1) / (2 rows of the source)``. Any stretch of that
order holds every source in proportion, so cutting it into equal stretches
gives shards that match the mixture, with row counts at most one apart (law
``rows``).

No rank is taken over a whole source or the whole table in one task. The
shuffle key is uniform, so its leading digits deal each source's rows into
small buckets; the order within a bucket is a window of bounded size, and the
rows before a bucket come from a running sum over a table of bucket counts.
The fractional rank is dealt the same way. Texts never move: only ids, sizes
and checksums are shuffled, and everything is a DataFrame function.

Defined cases: null texts count as empty (size 1, checksum 0); null sources
are a source of their own; rows without id are drawn by a checksum of their
texts, and those of equal text are ordered by checksum and size; repeated rows are separate rows. Rows equal in all of these columns
are interchangeable; of a text only its size and checksum are kept, whatever its
length. An empty table gives an empty result, and other columns
of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight.llm.common import identity, n_buckets, source_key, stored

#: Rows of a bucket: one window group, sorted in one task.
BUCKET_ROWS = 20_000
SEED = 42


def _rank(rows: DataFrame, by: list[str], unit: Column, order: list[Column], buckets: int, name: str) -> DataFrame:
    """Add ``name``: the rank from 1 in ``order`` within ``by``, where ``unit``
    in [0, 1) rises with the order and deals rows to buckets."""
    keyed = rows.withColumn("bucket", F.least(F.floor(unit * buckets), F.lit(buckets - 1)).cast("int"))
    counts = keyed.groupBy(*by, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    local = keyed.withColumn("within", F.row_number().over(Window.partitionBy(*by, "bucket").orderBy(*order)))
    return local.join(offsets, [*by, "bucket"]).withColumn(name, F.col("before") + F.col("within")).drop(
        "bucket", "before", "within"
    )


def shard_documents(
    docs: DataFrame,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, source``, one row per row of ``docs``."""
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).cast("string").alias("source"),
            source_key(F.col(source_col)).alias("stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), identity(F.col(id_col), text))).alias("draw"),
        ),
        "shard-rows",
    )
    total = rows.count()
    buckets = n_buckets(docs.sparkSession, total, BUCKET_ROWS)
    totals = rows.groupBy("stratum").agg(F.count("*").alias("rows_of_source"))

    draw_unit = F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / float(1 << 32)
    order = [F.col(c) for c in ("draw", "doc_id", "text_crc32", "size")]
    ranked = _rank(rows, ["stratum"], draw_unit, order, buckets, "rank").join(totals, "stratum")
    ranked = ranked.withColumn(
        "fraction",
        (2 * F.col("rank") - 1).cast("double") / (2 * F.col("rows_of_source")).cast("double"),
    ).withColumn("all_rows", F.lit(0))
    ranked = stored(ranked, "shard-ranked")  # read for the counts and again for the ranks
    order = [F.col(c) for c in ("fraction", "stratum", "rank")]
    placed = _rank(ranked, ["all_rows"], F.col("fraction"), order, buckets, "place")

    place = F.col("place") - 1
    shard = F.expr(f"((place - 1) * {n_shards}L) div {max(total, 1)}L")
    start = F.expr(f"(shard * {max(total, 1)}L + {n_shards - 1}L) div {n_shards}L")
    return placed.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (place - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )


#: The same answer in DuckDB SQL; the checksum table follows from its polynomial.
ORACLE_SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), sized AS (
  SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
    xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
      list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS text_crc32,
    md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'text ' || md5(coalesce(text, '')))) AS draw
  FROM documents, crc_table
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id, text_crc32, size) AS r,
    count(*) OVER (PARTITION BY source) AS n
  FROM sized
), placed AS (
  SELECT *, row_number() OVER (ORDER BY (2 * r - 1)::DOUBLE / (2 * n)::DOUBLE, source NULLS LAST, r) - 1 AS place,
    count(*) OVER () AS total
  FROM ranked
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law,
  CAST((place * 8) // total AS INTEGER) AS shard,
  place - (((place * 8) // total) * total + 7) // 8 AS slot,
  CAST(NULL AS INTEGER) AS grown_shard, source
FROM placed
"""
