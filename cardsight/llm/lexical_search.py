r"""Ranked lexical search over a length-stratified index (operator 11).

Terms are maximal runs of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]`` (digits,
letters and everything beyond ASCII) with A-Z lower-cased. A document of ``n``
terms has the normaliser ``m = 75 + (25 n N) div L``, and a term that it holds
``tf`` times has the impact ``(1000000000 tf) div (1000 tf + 12 m)``; a score sums
term weight times impact over the terms of an item, repeats included.

The index groups documents of equal ``m`` into a stratum. Within a stratum the
postings are kept by term and ``tf``, so an impact is computed once for each
``tf`` and serves all documents of the posting. A stratum beyond
``UNIT_POSTINGS`` postings is several units, to which its documents are dealt.
A unit is one row of the stored index, whatever stratum is hot.

A term's highest ``tf`` in a unit bounds its impact there, and their weighted
sum bounds the score of all its documents. The bounds order the visits: the
first visit goes to the units of the highest bounds, as many as hold
``FIRST_DOCS`` documents, and leaves each item with the score of its last place;
the second visits only units whose bound reaches that score, as ties go by
document id. Nothing is cut off: a unit that is not visited cannot enter the
result. Only the weights, the bounds of the first visit and the scores of the
last places pass the driver, one number for each term or item.

The items are the stated query set; they are dealt to blocks of about
``BLOCK_TERMS`` different (item, term) pairs, and the index of a block holds the
terms of its items, from every document. Texts are read once a block and are
never shuffled.

Defined cases: null texts and texts without terms have no terms, count
neither in ``N`` nor in ``L`` and are never returned; items without terms have no
result; a term in no document adds nothing; documents without an id count and
are returned, after all ids at equal scores; every row of the items is an item
of its own, and every row of the documents a document, repeated or not; terms
whose weight is 0 add nothing, and only scores above 0 are returned; a long text
is cut into terms in pieces, at blanks; empty documents or items give an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardsight.llm.common import key_runs, python_on, stored

TOP_K = 20
#: Postings of a unit, and different (item, term) pairs of a block of items.
UNIT_POSTINGS = 200_000
BLOCK_TERMS = 500_000
#: Documents that an item's first visit is to see.
FIRST_DOCS = 2_000
#: Products of a weight and an impact that are added up at a time.
PRODUCTS = 1 << 21
PIECE_BYTES = 1 << 20

#: Bytes to terms: A-Z lower-cased, all other ASCII but digits and a-z is a blank.
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c > 0x7F else 0x20 for c in range(256)
)


def term_counts(text: bytes | None) -> Counter[bytes]:
    """Occurrences of each term of a UTF-8 text."""
    folded, counts, at = (text or b"").translate(_FOLD), Counter(), 0
    while len(folded) - at > PIECE_BYTES and (end := folded.find(b" ", at + PIECE_BYTES)) >= 0:
        counts.update(folded[at:end].split())
        at = end
    counts.update(folded[at:].split())
    return counts


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int64), kind))


def _item_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, term, times = [], [], []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            for t, n in term_counts(text).items():
                at.append(item)
                term.append(t)
                times.append(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(term, pa.binary()), pa.array(times, pa.int64())], ["item", "term", "times"])


def _counted(vocabulary):
    """Task: documents -> number of terms, and the vocabulary terms with their counts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                counts = term_counts(text)
                found = [(number[t], c) for t, c in counts.items() if t in number]
                n.append(counts.total())
                both = np.array(found, np.int64).reshape(-1, 2)
                terms.append(both[:, 0])
                tfs.append(both[:, 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), _lists(terms, pa.int32()), _lists(tfs, pa.int64())], ["id", "n", "terms", "tfs"]
            )

    return run


# ------------------------------------------------------------------ index

#: A unit: its documents' ids (null last), and its postings, the places of the documents that hold
#: ``terms[i]`` exactly ``tfs[i]`` times, up to ``ends[i]`` in ``places``.
_UNIT = "m long, docs array<long>, terms array<int>, tfs array<long>, ends array<int>, places array<int>"
_UNIT_BITS = 23  # of a unit's number within its stratum
_UNIT_NAMES = [c.split(" ")[0] for c in _UNIT.split(", ")]


def _unit(rows: pa.Table) -> pa.RecordBatch:
    """The rows (``unit, m, id, terms, tfs``) of one unit as a row of the index."""
    rows = rows.take(pa.compute.sort_indices(rows.column("id"), null_placement="at_end")).combine_chunks()
    lists = [rows.column(c).combine_chunks() for c in ("terms", "tfs")]
    lists = [x if isinstance(x, pa.Array) else pa.concat_arrays(x.chunks) for x in lists]
    terms, tfs = (x.flatten().to_numpy().astype(np.int64) for x in lists)
    place = np.repeat(np.arange(rows.num_rows), pa.compute.list_value_length(lists[0]).to_numpy(zero_copy_only=False))
    order = np.lexsort([place, tfs, terms])
    terms, tfs, place = terms[order], tfs[order], place[order]
    first = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])])
    ids = pa.array(rows.column("id").to_pylist(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            rows.column("m").slice(0, 1).combine_chunks(), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            _lists([terms[first]], pa.int32()), _lists([tfs[first]], pa.int64()),
            _lists([np.r_[first[1:], len(terms)]], pa.int32()), _lists([place], pa.int32()),
        ],
        _UNIT_NAMES,
    )


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, _, _ in key_runs(batches, 1 << 62):
        keys = rows.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        for s, e in zip(starts, np.r_[starts[1:], len(keys)]):
            yield _unit(rows.slice(s, e - s))


def build_index(counted: DataFrame, n_docs: int, n_terms: int, unit_postings: int = UNIT_POSTINGS) -> DataFrame:
    """The index of documents with their counts (``id, n, terms, tfs``), for the
    number ``n_docs`` of documents with terms and ``n_terms`` of all terms."""
    m = F.expr(f"100 - 25 + ((25 * n * {n_docs}L) div {n_terms}L)")
    rows = counted.where(F.size("terms") > 0).select(
        m.alias("m"), F.monotonically_increasing_id().alias("row"), "id", "terms", "tfs"
    )
    strata = rows.groupBy("m").agg(F.sum(F.size("terms")).alias("postings"))
    units = F.least(F.ceil(F.col("postings") / unit_postings), F.lit(1 << _UNIT_BITS))
    strata = stored(strata.select("m", units.alias("units")), "lexical-strata")
    dealt = rows.join(strata, "m").select(
        (F.shiftleft("m", _UNIT_BITS) + F.pmod(F.xxhash64("row"), "units")).alias("unit"), "m", "id", "terms", "tfs"
    )
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = dealt.repartition(tasks, "unit").sortWithinPartitions("unit").mapInArrow(_units, _UNIT)
    return stored(units, "lexical-index")


# ------------------------------------------------------------------ visits


class Queries:
    """Items of a block by term: the items of term ``t`` and its weights in them are
    ``item[start[t]:start[t + 1]]`` and ``weight[...]`` (weight times occurrences)."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_vocabulary: int):
        order = np.argsort(term, kind="stable")
        self.item, self.weight = item[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange(n_vocabulary + 1))
        self.n_items = int(item.max(initial=-1)) + 1

    def products(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each term of ``terms`` each of its items: places in ``terms`` and in ``item``."""
        many = self.start[terms + 1] - self.start[terms]
        which = np.repeat(np.arange(len(terms)), many)
        return which, np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(self.start[terms], many)


def impact(tf: np.ndarray, m: int) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def bounds(queries: Queries, m: int, terms: np.ndarray, tfs: np.ndarray) -> np.ndarray:
    """The most that a document of the unit can score, for each item."""
    last = np.flatnonzero(np.r_[terms[1:] != terms[:-1], True])  # of each term the highest tf
    which, at = queries.products(terms[last])
    out = np.zeros(queries.n_items, np.int64)
    np.add.at(out, queries.item[at], queries.weight[at] * impact(tfs[last], m)[which])
    return out


class Top:
    """The ``k`` best (score, id) of each item among all that were added."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()  # the least score that still matters
        self.item, self.score, self.id, self.no_id = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))
        self.new = 0

    def add(self, item: np.ndarray, score: np.ndarray, id: np.ndarray, no_id: np.ndarray) -> None:
        self.item, self.score = np.r_[self.item, item], np.r_[self.score, score]
        self.id, self.no_id = np.r_[self.id, id], np.r_[self.no_id, no_id]
        self.new += len(item)
        if self.new >= 50_000:
            self.cut()

    def cut(self) -> None:
        order = np.lexsort([self.id, self.no_id, -self.score, self.item])
        item = self.item[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.empty(0, int)
        rank = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        kept = order[rank < self.k]
        full = order[rank == self.k - 1]
        self.least[self.item[full]] = np.maximum(self.least[self.item[full]], self.score[full])
        self.item, self.score, self.id, self.no_id = self.item[kept], self.score[kept], self.id[kept], self.no_id[kept]
        self.new = 0


def _places(column: pa.ChunkedArray | pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _visit(shared, k: int):
    """Task: units of the index -> the ``k`` best of each item, of scores from ``least`` on, in
    the units whose bound is at least ``low`` and below ``high``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, least, low, high = shared.value
        top = Top(k, least)
        for batch in batches:
            column = {c: batch.column(c) for c in _UNIT_NAMES}
            for row in range(batch.num_rows):
                m = column["m"][row].as_py()
                terms, tfs = _places(column["terms"], row), _places(column["tfs"], row)
                bound = bounds(queries, m, terms, tfs)
                visited = (bound >= np.maximum(low, top.least)) & (bound < high)
                items = np.flatnonzero(visited)
                if not len(items):
                    continue
                line = np.cumsum(visited) - 1
                ids = column["docs"][row].values
                starts_ends = np.r_[0, _places(column["ends"], row)]
                places = _places(column["places"], row)
                # Weight times impact once for each posting and item, then for its documents.
                which, at = queries.products(terms)
                of = visited[queries.item[at]]
                which, at = which[of], at[of]
                value = queries.weight[at] * impact(tfs, m)[which]
                base = line[queries.item[at]] * len(ids)
                long = np.diff(starts_ends)[which]
                scores = np.zeros(len(items) * len(ids), np.int64)
                cuts = np.searchsorted(np.cumsum(long), np.arange(PRODUCTS, long.sum(), PRODUCTS)) + 1
                for s, e in zip(np.r_[0, cuts], np.r_[cuts, len(long)]):
                    n = long[s:e]
                    begin = np.cumsum(n) - n
                    inside = np.arange(n.sum()) - np.repeat(begin, n) + np.repeat(starts_ends[which[s:e]], n)
                    np.add.at(scores, np.repeat(base[s:e], n) + places[inside], np.repeat(value[s:e], n))
                scores = scores.reshape(len(items), -1)
                matters = top.least[items]
                if scores.shape[1] > k:  # below the unit's own k-th score nothing enters
                    matters = np.maximum(matters, np.partition(scores, -k, axis=1)[:, -k])
                x, y = np.nonzero(scores >= matters[:, None])
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                top.add(items[x], scores[x, y], ids.fill_null(0).to_numpy()[y], no_id[y])
        top.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(top.item), pa.array(top.score), pa.array(top.id, mask=top.no_id)], ["item", "score", "id"]
        )

    return run


def _first_bounds(shared, docs: int):
    """Task: units -> for each item the units of the highest bounds, until they hold ``docs`` documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        found: list[tuple[np.ndarray, int]] = []

        def best() -> tuple[np.ndarray, ...]:
            bound, held = np.array([b for b, _ in found]), np.array([n for _, n in found], np.int64)
            order = np.argsort(-bound, axis=0, kind="stable")
            before = np.cumsum(held[order], axis=0) - held[order]
            x, item = np.nonzero((before < docs) & (np.take_along_axis(bound, order, axis=0) > 0))
            unit = order[x, item]
            return item, bound[unit, item], held[unit]

        def rows() -> pa.RecordBatch:
            item, bound, held = best()
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(item), pa.array(bound), pa.array(held)], ["item", "bound", "held"])

        for batch in batches:
            for row in range(batch.num_rows):
                terms, tfs = (_places(batch.column(c), row) for c in ("terms", "tfs"))
                found.append((bounds(queries, batch.column("m")[row].as_py(), terms, tfs), batch.column("held")[row].as_py()))
                if len(found) * max(1, queries.n_items) >= PRODUCTS:
                    yield rows()
        if found:
            yield rows()

    return run


def _search_block(docs: DataFrame, terms: DataFrame, k: int, unit_postings: int, first_docs: int) -> DataFrame:
    """``item, score, id``: the best documents of each item of a block (``item, term, times``)."""
    spark = docs.sparkSession
    tasks = spark.sparkContext
    pairs = terms.toArrow()  # at most about BLOCK_TERMS rows
    item_of, item = np.unique(pairs.column("item").to_numpy(), return_inverse=True)
    coded = pa.compute.dictionary_encode(pairs.column("term").combine_chunks())
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    words = coded.dictionary.to_pylist()
    term = coded.indices.to_numpy().astype(np.int64)

    vocabulary = tasks.broadcast({w: i for i, w in enumerate(words)})
    counted = stored(docs.mapInArrow(_counted(vocabulary), "id long, n long, terms array<int>, tfs array<long>"), "lexical-counts")
    n_docs, n_terms = counted.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(words), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
        df[r["term"]] = r["df"]  # a row for each term of the block
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    queries = Queries(item, term, weight[term] * pairs.column("times").to_numpy(), len(words))
    if not n_docs:
        return spark.createDataFrame([], "item long, score long, id long")

    index = build_index(counted, n_docs, n_terms, unit_postings)
    held = index.select("m", "terms", "tfs", F.size("docs").alias("held"))
    nearest = held.mapInArrow(_first_bounds(tasks.broadcast(queries), first_docs), "item long, bound long, held long")
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound")).rowsBetween(Window.unboundedPreceding, -1)
    nearest = nearest.withColumn("before", F.coalesce(F.sum("held").over(by_bound), F.lit(0))).where(F.col("before") < first_docs)
    cut = np.ones(queries.n_items, np.int64)  # the least bound of the first visit
    for r in nearest.groupBy("item").agg(F.min("bound").alias("bound")).collect():  # a row for each item
        cut[r["item"]] = r["bound"]

    one, none = np.ones(queries.n_items, np.int64), np.full(queries.n_items, np.iinfo(np.int64).max)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = "item long, score long, id long"
    once = index.mapInArrow(_visit(tasks.broadcast((queries, one, cut, none)), k), found)
    once = stored(once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "lexical-first")
    low = one.copy()
    for r in once.where(F.col("rank") == k).select("item", "score").collect():  # a row for each item
        low[r["item"]] = r["score"]
    rest = index.mapInArrow(_visit(tasks.broadcast((queries, low, low, cut)), k), found)
    names = spark.createDataFrame(pa.table({"item": np.arange(len(item_of)), "of_item": item_of}))
    every = once.drop("rank").union(rest).join(F.broadcast(names), "item")
    return every.select(F.col("of_item").alias("item"), "score", "id")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP_K,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    unit_postings: int = UNIT_POSTINGS,
    first_docs: int = FIRST_DOCS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``item_id, rank, id, score``: the ``k`` documents of the highest scores above 0 for each row of ``items``."""
    spark = docs.sparkSession
    python_on(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = stored(
        items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")),
        "lexical-items",
    )
    terms = stored(asked.select("item", "text").mapInArrow(_item_terms, "item long, term binary, times long"), "lexical-item-terms")
    blocks = max(1, -(-terms.count() // block_terms))
    parts = [
        _search_block(rows, terms.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b), k, unit_postings, first_docs)
        for b in range(blocks)
    ]
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "id", "score")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same ranks in DuckDB SQL.
ORACLE_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS terms FROM documents
), held AS (
  SELECT r, doc_id, len(terms)::BIGINT AS n, terms FROM d WHERE len(terms) > 0
), totals AS (
  SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS all_terms FROM held
), postings AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(terms) AS term FROM held) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, docs
), items AS (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_TERM}') AS terms
  FROM benchmark
), asked AS (
  SELECT q, item_id, term, count(*)::BIGINT AS times FROM (SELECT q, item_id, unnest(terms) AS term FROM items) GROUP BY q, item_id, term
), norms AS (
  SELECT r, doc_id, 100 - 25 + ((25 * n * docs) // all_terms) AS m FROM held, totals
), scores AS (
  SELECT q, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN norms USING (r) GROUP BY q, item_id, r, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= {TOP_K}
"""
