r"""Benchmark decontamination by a prefix-filtered set join (operator 13, native).

Every window of ``window`` consecutive item words (all words of a shorter
item) is a set of shingles, each with its offset; a window of a document, of
the same size, contains it if every shingle stands at its offset. Shingles
are ordered by rarity: a pass over all documents counts those of the items.
A set of ``s`` shingles that must be contained whole needs a prefix of
``s - s + 1`` tokens, so each window is looked up by its single rarest shingle,
and a window whose rarest shingle no document holds is left out. A second
pass joins the documents' shingles with these prefix tokens; where one meets,
its offset says where the document's window would begin, the bounds of
position and length say whether it fits into the document, and the words of
both windows are compared. Only windows that do occur leave the scan.

Words are maximal runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after A-Z is
lower-cased (``[0-9a-z]`` and everything beyond ASCII). Texts are never
shuffled. The items are the stated query set: their shingles and prefix
tokens go to all tasks in blocks of at most about ``BLOCK_ROWS`` rows, each
block one more pass over the documents (stored first where there is more than
one). Everything is a DataFrame function.

Defined cases: null and wordless texts have no words, no hits and the digest of
the empty string; wordless items have no windows; items without an id are one
item whose id reads as the empty string; rows of one item id are one item with
the windows of all; a window may overlap itself and others, each word counts
once; repeated document rows and rows without an id are separate documents; a
text of any length is one row; equally rare shingles are taken by their place
in the window; empty documents give an empty result, empty items no hits;
other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardsight.llm.common import stored

WINDOW = 10
SHINGLE = 3
#: Rows of a block of shingles or prefix tokens that goes to all tasks.
BLOCK_ROWS = 250_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what stands between words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in order (null: none)."""
    # lower() is the quicker way, and right where there is nothing but ASCII.
    ascii_only = F.octet_length(text) == F.length(text)
    folded = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(F.coalesce(folded, F.lit("")), SEPARATORS), "")


def _hash(words: str, at: Column, size: int) -> Column:
    """A number for the shingle of ``size`` words from the 0-based place ``at``."""
    return F.xxhash64(*(F.get(words, at + i) for i in range(size)))


def _blocks(rows: DataFrame, key: Column, n: int, block_rows: int) -> list[DataFrame]:
    blocks = max(1, -(-n // block_rows))
    return [rows.where(F.pmod(key, F.lit(blocks)) == b) for b in range(blocks)]


def _item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``window_id, window`` for each different window, and ``window_id, item``."""
    of_item = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words(F.col(text_col).cast("string")).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    each = of_item.select("item", "words", F.explode(starts).alias("start")).select(
        "item", F.slice("words", F.col("start"), window).alias("window")
    )
    # A window is named by 256 bits of its words, joined by a space, which no word holds.
    each = each.select(F.sha2(F.array_join("window", " "), 256).alias("window_id"), "window", "item")
    each = stored(each.dropDuplicates(["window_id", "item"]), "decontamination-windows")
    return each.select("window_id", "window").dropDuplicates(["window_id"]), each.select("window_id", "item")


def _tokens(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """A row for each word of ``docs`` and shingle size: ``token``, ``at``, the word's
    0-based place in ``words``, and ``kind``, the size's place in ``sizes``."""
    # The outer form keeps the planner from adding a filter that cuts the text into words once more.
    at_word = docs.select("*", F.posexplode_outer("words").alias("at", "word"))
    hashes = [_hash("words", F.col("at"), k) for k in sizes]
    if len(hashes) == 1:
        return at_word.withColumns({"kind": F.lit(0), "token": hashes[0]})
    return at_word.select("*", F.posexplode(F.array(*hashes)).alias("kind", "token"))


def _prefixes(docs: DataFrame, windows: DataFrame, sizes: list[int], shingle: int, block_rows: int) -> DataFrame:
    """``token, offset, size, window_id, window``: each window under the rarest of its shingles."""
    size = F.size("window")
    k = F.least(size, F.lit(shingle))
    places = windows.select("window_id", "window", F.explode(F.sequence(F.lit(0), size - k)).alias("offset"))
    token = reduce(lambda c, n: c.when(k == n, _hash("window", F.col("offset"), n)), sizes, F.when(F.lit(False), F.lit(0).cast("long")))
    places = stored(places.withColumn("token", token), "decontamination-shingles")
    wanted = stored(places.select("token").distinct(), "decontamination-tokens")
    counts = [
        _tokens(docs, sizes).join(F.broadcast(block), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
        for block in _blocks(wanted, F.col("token"), wanted.count(), block_rows)
    ]
    counted = stored(reduce(DataFrame.union, counts), "decontamination-counts")
    # A shingle without a count is in no document, nor is its window.
    rarity = places.join(counted, "token", "left").groupBy("window_id").agg(
        F.min_by(
            F.struct("token", "offset", F.coalesce("n", F.lit(0)).alias("n"), "window"),
            F.struct(F.coalesce("n", F.lit(0)), "offset"),
        ).alias("rarest")
    )
    return rarity.select("window_id", "rarest.*").where("n > 0").select(
        "token", F.col("offset").cast("int").alias("offset"), F.size("window").alias("size"), "window_id", "window"
    )


def occurrences(
    docs: DataFrame,
    windows: DataFrame,
    shingle: int = SHINGLE,
    text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Where the ``windows`` (``window_id, window``) occur in ``docs``.

    One row per occurrence: the document's columns, ``n_words``, ``first`` and
    ``last`` (places of its words, from 1) and ``window_id``; and one row per
    document without these three.
    """
    lengths = windows.select(F.least(F.size("window"), F.lit(shingle)).alias("k")).distinct()
    sizes = sorted(r["k"] for r in lengths.collect()) or [shingle]  # at most ``shingle`` rows
    own = [c for c in docs.columns if c != text_col]
    text = F.col(text_col).cast("string")
    counted = docs.select(words(text).alias("words"))
    prefixes = stored(_prefixes(counted, windows, sizes, shingle, block_rows), "decontamination-prefixes")
    blocks = _blocks(prefixes, F.col("token"), prefixes.count(), block_rows)
    if len(blocks) > 1:  # every pass must see the same rows under the same numbers
        docs = stored(docs, "decontamination-docs")
    # A first element that no shingle holds stands for the document itself.
    marked = docs.select(*own, F.concat(F.array(F.lit("")), words(text)).alias("words"))
    first = F.col("at") - F.col("offset")
    found = []
    for i, block in enumerate(blocks):
        tokens = _tokens(marked, sizes).withColumnRenamed("token", "doc_token")
        fits = (first >= 1) & (first + F.col("size") <= F.size("words"))
        same = F.slice("words", F.when(fits, first + 1).otherwise(1), F.col("size")) == F.col("window")
        joined = tokens.join(F.broadcast(block), (F.col("doc_token") == F.col("token")) & fits & same, "left")
        # The documents' own rows are taken once, from the first block and size.
        kept = F.col("window_id").isNotNull() | ((F.col("at") == 0) & (F.col("kind") == 0) & F.lit(i == 0))
        found.append(
            joined.where(kept).select(
                *own, (F.size("words") - 1).cast("long").alias("n_words"),
                first.alias("first"), (first + F.col("size") - 1).alias("last"), "window_id",
            )
        )
    return reduce(DataFrame.union, found)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id, n_words, n_hit, n_items, items_sha256, contaminated``, one row per row of ``docs``."""
    if min(window, shingle) < 1:
        raise ValueError("window and shingle must be positive")
    windows, of_items = _item_windows(items, window, item_id_col, item_text_col)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    found = stored(occurrences(rows, windows, min(shingle, window), "text", block_rows), "decontamination-found")
    hits = found.where("window_id IS NOT NULL")

    # Words of a span that no span before it covers; a document's spans are one small group.
    before = Window.partitionBy("row").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.greatest(F.coalesce(F.max("last").over(before), F.lit(0)), F.col("first") - 1)
    covered = (
        hits.select("row", "first", "last").distinct()
        .select("row", F.greatest(F.col("last") - reach, F.lit(0)).alias("fresh"))
        .groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        hits.select("row", "window_id").distinct().join(of_items, "window_id").select("row", "item").distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        found.where("window_id IS NULL").select("row", "id", "n_words")
        .join(covered.join(named, "row"), "row", "left")
        .select(
            "id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
            F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


#: The same columns in DuckDB SQL.
ORACLE_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), starts AS (
  SELECT item, words, unnest(range(1, greatest(len(words) - {WINDOW - 1}, 1) + 1)) AS s FROM items WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, array_to_string(list_slice(words, s, s + {WINDOW - 1}), ' ') AS w,
    least(len(words), {WINDOW}) AS size FROM starts
), places AS (
  SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS s
  FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
), spans AS (
  SELECT r, item, s, size FROM (SELECT r, s, size, array_to_string(list_slice(words, s, s + size - 1), ' ') AS w FROM places)
  JOIN windows USING (w, size)
), hit AS (
  SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(s, s + size)) AS place FROM spans) GROUP BY r
), named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM spans) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM texts LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
