"""Cross-entropy difference scores of documents (operator 1).

Two bigram models, one of the target documents and one of all documents, are
matched: the same vocabulary (every word that occurs twice or more in all
texts; all others are one unknown word), the same order, smoothing and
weights. Every token has a loss under either; a document's score is the
mean of ``target loss - background loss``, so lower is more like the target.

    p(w | h) = BIGRAM_WEIGHT * c(h, w) / c(h) + (1 - BIGRAM_WEIGHT) * (c(w) + 1) / (N + V + 1)

where ``h`` is the word before (a begin mark for the first) and the first
term is zero, its weight left to the second, for a history the model has not
seen.

Texts are read once and are never shuffled: tasks cut them into chunks of
about ``CHUNK_TOKENS`` tokens, each with its own dictionary. The dictionaries
are counted and joined with the vocabulary, which is numbered by falling
count and has no bound, and go back to their chunks, whose tokens (one packed
row a document) become vocabulary numbers.

The counts take the same way. A chunk sends its different bigrams, histories
and words, each once and with its own counts, to the buckets of a hash; a
bucket adds up what all chunks sent and answers each of them with the totals
in the order it asked. A chunk then has all counts of its documents, whatever
the size of the vocabulary and however rare a bigram is. Keys and counts of a
chunk and a bucket travel as one packed row. A frequent bigram is in a bucket
at most once a chunk; buckets grow in number, not in size.

Defined cases: null and wordless texts have no tokens, losses and score null;
null ids are scored but are no targets; a target id that several rows have
makes all of them targets; a text of any length is one document, never cut;
words of equal count are numbered in the order of their bytes; repeated rows are separate rows; without targets
the target model is uniform; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsight.llm.common import freed, python_on, stored

#: Tokens of a chunk of documents with one dictionary (a document is never cut).
CHUNK_TOKENS = 1 << 19
#: Tokens for each bucket of counts.
BUCKET_TOKENS = 1 << 20
#: Sizes of shared tables that scoring no longer needs; kept for callers that give them.
HOT_WORDS = 1 << 18
HOT_BIGRAMS = 2_000_000
FILTER_BITS = 1 << 27
BIGRAM_WEIGHT = 0.7
#: Tokens that a task sorts at a time, and different bigrams that it holds.
SORTED_TOKENS = 1 << 18
HELD_BIGRAMS = 1 << 19

UNKNOWN, BEGIN, FIRST_WORD = 0, 1, 2
_NUMBER = np.uint32
_SHIFT = 31  # bits of a vocabulary number, and in a bigram's key
_LOW = (1 << _SHIFT) - 1
ANY = _LOW  # no vocabulary number: with it a key stands for a word or a history alone
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _coded(rows: DataFrame) -> DataFrame:
    """Rows of two kinds by ``chunk``: a document (``id``, ``code`` its place, ``tokens``
    the packed codes of its words) and a word of the chunk (``word``, ``code``, ``n``)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << _SHIFT
        codes: dict[bytes, int] = defaultdict(count().__next__)
        ids: list[int | None] = []
        tokens: list[np.ndarray] = []
        held = placed = 0
        counts = np.zeros(0, np.int64)

        def documents() -> pa.RecordBatch:
            nonlocal placed, counts
            all_tokens = np.concatenate(tokens)
            counts = np.r_[counts, np.zeros(len(codes) - len(counts), np.int64)] + np.bincount(all_tokens, minlength=len(codes))
            size = len(ids)
            columns = [
                pa.array(np.full(size, chunk)), pa.array(ids, pa.int64()), pa.array(np.arange(placed, placed + size)),
                pa.array([t.tobytes() for t in tokens], pa.binary()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64()),
            ]
            placed += size
            ids.clear()
            tokens.clear()
            return pa.RecordBatch.from_arrays(columns, _CODED)

        def dictionary() -> Iterator[pa.RecordBatch]:
            nonlocal chunk, held, placed, counts
            words = list(codes)  # in the order of their codes
            for at in range(0, len(words), 50_000):
                some = words[at : at + 50_000]
                size = len(some)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(size, chunk)), pa.nulls(size, pa.int64()), pa.array(np.arange(at, at + size)),
                    pa.nulls(size, pa.binary()), pa.array(some, pa.binary()), pa.array(counts[at : at + size]),
                ], _CODED)
            codes.clear()
            codes.default_factory = count().__next__
            chunk, held, placed, counts = chunk + 1, 0, 0, np.zeros(0, np.int64)

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(i)
                tokens.append(np.array([codes[w] for w in (text or b"").lower().split()], dtype=_NUMBER))
                held += len(tokens[-1])
                if held >= CHUNK_TOKENS:
                    yield documents()
                    yield from dictionary()
            if ids:
                yield documents()
        if placed:
            yield from dictionary()

    return rows.select("id", "text").mapInArrow(run, "chunk long, id long, code long, tokens binary, word binary, n long")


def _vocabulary(coded: DataFrame, size: int | None) -> DataFrame:
    """``word, number``: words that occur twice or more (at most the ``size`` most
    frequent, if given), numbered without gaps by falling count."""
    counts = coded.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")
    order = counts.orderBy(F.desc("n"), "word")
    order = order if size is None else order.limit(size)
    words = stored(order.select("word", F.monotonically_increasing_id().alias("at")), "lm-words")
    part = F.shiftright("at", 33)  # a partition's rows are numbered from 0 below these bits
    sizes = sorted((r["part"], r["count"]) for r in words.groupBy(part.alias("part")).count().collect())  # one per partition
    starts, start = [], FIRST_WORD
    for p, n in sizes:
        starts.append((p, start))
        start += n
    before = words.sparkSession.createDataFrame(starts, "part long, start long")
    rest = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        words.withColumn("part", part).join(F.broadcast(before), "part")
        .select("word", (F.col("start") + rest).alias("number"))
    )


def _codes(coded: DataFrame, words: DataFrame, of_target: DataFrame) -> DataFrame:
    """``of_chunk, of_code, number``: the vocabulary numbers of a chunk's codes, and with
    number 0, which no word has, the places of its target documents."""
    known = coded.where("word IS NOT NULL").select("chunk", "code", "word").join(words.hint("merge"), "word")
    marks = coded.where("word IS NULL").select("chunk", "code", "id").join(of_target.hint("merge"), "id")
    about = known.select("chunk", "code", "number").union(marks.select("chunk", "code", F.lit(0).cast("long")))
    return about.toDF("of_chunk", "of_code", "number")


def _numbered(coded: DataFrame, codes: DataFrame) -> DataFrame:
    """``chunk``, ``id``, ``n_tokens``, ``tokens`` (vocabulary numbers, packed as integers) and ``is_target`` of each document."""
    docs = coded.where("word IS NULL").select("chunk", "id", "code", "tokens")

    def run(docs: pa.Table, about: pa.Table) -> pa.Table:
        code, number = about.column("of_code").to_numpy(), about.column("number").to_numpy()
        is_word = number > 0
        of_code = np.full(1 + max([int(code[is_word].max(initial=0)), *(
            int(np.frombuffer(t, _NUMBER).max(initial=0)) for t in docs.column("tokens").to_pylist())]), UNKNOWN, _NUMBER)
        of_code[code[is_word]] = number[is_word]
        return pa.table({
            "chunk": docs.column("chunk"),
            "id": docs.column("id"),
            "n_tokens": pa.array([len(t) // _NUMBER().itemsize for t in docs.column("tokens").to_pylist()], pa.int64()),
            "tokens": pa.array([of_code[np.frombuffer(t, _NUMBER)].tobytes() for t in docs.column("tokens").to_pylist()], pa.binary()),
            "is_target": pa.array(np.isin(docs.column("code").to_numpy(), code[~is_word])),
        })

    return docs.groupBy("chunk").cogroup(codes.groupBy("of_chunk")).applyInArrow(
        run, "chunk long, id long, n_tokens long, tokens binary, is_target boolean"
    )


def _keys(tokens: bytes) -> np.ndarray:
    """A key for each token: the word before it and itself."""
    w = np.frombuffer(tokens, _NUMBER).astype(np.int64)
    return (np.r_[np.int64(BEGIN), w[:-1]] << _SHIFT | w) if len(w) else w


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order and their summed counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(counts[order], first)


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams, histories and words of a task with their counts in all and in target documents."""
    tokens: list[np.ndarray] = []  # keys, each with a last bit for target documents
    held: list[tuple[np.ndarray, np.ndarray]] = []
    n_tokens = 0

    def emit() -> Iterator[pa.RecordBatch]:
        marked, counts = _added(held)
        held.clear()
        keys = marked >> 1
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        key, n, n_target = keys[first], np.add.reduceat(counts, first), np.add.reduceat(counts * (marked & 1), first)
        for some in (key, key >> _SHIFT << _SHIFT | ANY, ANY << _SHIFT | key & _LOW):
            total, columns = _added([(some, n)]), _added([(some, n_target)])
            columns = (*total, columns[1])
            for at in range(0, len(total[0]), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + 100_000]) for c in columns], ["key", "n", "n_target"])

    def sort() -> None:
        if sum(map(len, tokens)):
            held.append(np.unique(np.concatenate(tokens), return_counts=True))
        tokens.clear()

    for batch in batches:
        for packed, is_target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens.append(_keys(packed) << 1 | int(is_target))
            n_tokens += len(tokens[-1])
            if n_tokens >= SORTED_TOKENS:
                sort()
                n_tokens = 0
                if sum(len(k) for k, _ in held) >= HELD_BIGRAMS:
                    held[:] = [_added(held)]
                    if len(held[0][0]) >= HELD_BIGRAMS // 2:
                        yield from emit()
    sort()
    if held:
        yield from emit()


def _loss(pair, history, word, total, n_words: int, weight: float) -> np.ndarray:
    """Losses of bigrams from the counts of pair, history, word and all tokens."""
    single = (word + 1) / (total + n_words + 1)
    after = np.divide(pair, history, out=np.zeros(len(history)), where=history > 0)
    return -np.log(np.where(history > 0, weight * after + (1 - weight) * single, single))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, byte by byte (the high bytes are mostly zero), compressed."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T for c in columns]
    return pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, size: int, *types: type) -> list[np.ndarray]:
    widths = [np.dtype(t).itemsize for t in types]
    flat = pa.decompress(packed, decompressed_size=size * sum(widths), codec="zstd", asbytes=True)
    planes = np.split(np.frombuffer(flat, np.uint8).reshape(-1, size), np.cumsum(widths)[:-1])
    return [np.ascontiguousarray(p.T).view(t).ravel() for p, t in zip(planes, types)]


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that puts sorted ``keys`` by their buckets, the buckets that have some, and where these start."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)
    bucket = (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=1)
    used = np.flatnonzero(sizes)
    return order, used, np.r_[0, np.cumsum(sizes[used])]


def _totals(marked: DataFrame, buckets: int) -> DataFrame:
    """``chunk``, ``bucket``, ``size`` and the packed totals, in all and in target
    documents, of the keys of the chunk that are in the bucket, in their order."""

    def ask(docs: pa.Table) -> pa.Table:
        counted = [[c.to_numpy() for c in b.columns] for b in _counted(docs.select(["tokens", "is_target"]).to_batches())]
        if not counted:
            return _ASKED.empty_table()
        keys, n, n_target = (np.concatenate(c) for c in zip(*counted))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])  # a key may have been emitted more than once
        keys, n, n_target = keys[first], np.add.reduceat(n[order], first), np.add.reduceat(n_target[order], first)
        order, used, at = _dealt(keys, buckets)
        keys, n, n_target = keys[order], n[order].astype(np.uint32), n_target[order].astype(np.uint32)
        packed = [_packed(np.diff(keys[s:e], prepend=0), n[s:e], n_target[s:e]) for s, e in zip(at, at[1:])]
        chunk = np.full(len(used), docs.column("chunk")[0].as_py())
        return pa.table([pa.array(chunk), pa.array(used.astype(np.int64)), pa.array(np.diff(at)), pa.array(packed, pa.binary())], schema=_ASKED)

    def answer(asked: pa.Table) -> pa.Table:
        sizes = asked.column("size").to_pylist()
        parts = [_unpacked(p, size, np.int64, np.uint32, np.uint32) for p, size in zip(asked.column("packed").to_pylist(), sizes)]
        keys = np.concatenate([np.cumsum(p[0]) for p in parts])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.r_[True, keys[1:] != keys[:-1]]
        first, place = np.flatnonzero(new), np.empty(len(keys), np.int64)
        place[order] = np.cumsum(new) - 1
        n, n_target = (np.add.reduceat(np.concatenate([p[i] for p in parts]).astype(np.int64)[order], first)[place] for i in (1, 2))
        at = np.cumsum([0, *sizes])
        packed = [_packed(n[s:e], n_target[s:e]) for s, e in zip(at, at[1:])]
        return asked.set_column(3, "packed", pa.array(packed, pa.binary()))

    columns = "chunk long, bucket long, size long, packed binary"
    asked = marked.select("chunk", "tokens", "is_target").groupBy("chunk").applyInArrow(ask, columns)
    return asked.groupBy("bucket").applyInArrow(answer, columns)


#: Multipliers of the bit set's hash: odd, below 2**31 so that no product overflows.
_FACTORS = 1_640_531_527, 1_013_904_223


def _place(history, word, bits: int):
    """The bit of a bigram, for columns and for arrays alike (``bits`` a power of two)."""
    mixed = history * _FACTORS[0] + word * _FACTORS[1]
    if isinstance(mixed, Column):
        return F.shiftright(mixed, 20).bitwiseAND(F.lit(bits - 1))
    return mixed >> 20 & bits - 1


def _bit_set(bigrams: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a set of ``bits`` bits with those of all ``bigrams`` set; at most that many reach the driver."""
    place = _place(F.shiftright("key", _SHIFT), F.col("key").bitwiseAND(F.lit(_LOW)), bits)
    words = (
        bigrams.select(place.alias("place"))
        .groupBy(F.shiftright("place", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    )
    out = np.zeros((max(1, bits >> 15), 1 << 12), dtype=np.uint8)
    for r in words.toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def cross_entropy_difference(
    docs: DataFrame,
    targets: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary_size: int | None = None,
    hot_bigrams: int = HOT_BIGRAMS,
    weight: float = BIGRAM_WEIGHT,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``id, n_tokens, target_loss, background_loss, score``, one row per row of
    ``docs``; ``targets`` holds the ids (``id_col``) of the target documents.
    ``vocabulary_size`` bounds the vocabulary to the most frequent words.
    ``hot_bigrams`` and ``filter_bits`` sized shared tables that are no longer needed; they change nothing."""
    spark = docs.sparkSession
    python_on(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    of_target = targets.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").distinct()
    coded = stored(_coded(rows), "lm-coded", "zstd")
    words = stored(_vocabulary(coded, vocabulary_size), "lm-vocabulary", "zstd")
    n_words = words.count()
    if n_words + FIRST_WORD >= ANY:
        raise ValueError("the vocabulary is too large for a bigram's key")

    # Stored, so that the shuffled words are gone before the texts' tokens are shuffled.
    codes = stored(_codes(coded, words, of_target), "lm-codes", "zstd")
    freed(words)
    marked = stored(_numbered(coded, codes), "lm-numbered", "zstd")
    freed(coded)
    freed(codes)
    n_all, n_of_target = marked.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("is_target"), F.col("n_tokens"))), F.lit(0))
    ).first()
    buckets = max(2 * spark.sparkContext.defaultParallelism, -(-n_all // BUCKET_TOKENS))
    totals = stored(_totals(marked, buckets), "lm-totals").toDF("of_chunk", "bucket", "size", "packed")

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """Sums of the losses of the tokens of each document of a chunk."""
        sums = np.zeros((2, docs.num_rows))
        if answers.num_rows:
            keys = np.concatenate([_keys(t) for t in docs.column("tokens").to_pylist()])
            of_doc = np.repeat(np.arange(docs.num_rows), docs.column("n_tokens").to_numpy())
            pairs, of_pair = np.unique(keys, return_inverse=True)
            histories, of_history = np.unique(pairs >> _SHIFT, return_inverse=True)
            words, of_word = np.unique(pairs & _LOW, return_inverse=True)
            asked = np.concatenate([pairs, histories << _SHIFT | ANY, ANY << _SHIFT | words])
            by_key = np.argsort(asked, kind="stable")
            by_bucket = by_key[_dealt(asked[by_key], buckets)[0]]  # the order in which the keys were asked
            answers = answers.sort_by("bucket")
            parts = [
                _unpacked(p, size, np.int64, np.int64)
                for p, size in zip(answers.column("packed").to_pylist(), answers.column("size").to_pylist())
            ]
            for at, side, total in ((0, 1, n_of_target), (1, 0, n_all)):
                n = np.empty(len(asked), np.int64)
                n[by_bucket] = np.concatenate([p[side] for p in parts])
                pair, history, word = np.split(n, [len(pairs), len(pairs) + len(histories)])
                loss = _loss(pair, history[of_history], word[of_word], total, n_words, weight)
                sums[at] = np.bincount(of_doc, loss[of_pair], docs.num_rows)
        return pa.table({"id": docs.column("id"), "n_tokens": docs.column("n_tokens"), "target": sums[0], "background": sums[1]})

    docs = marked.select("chunk", "id", "n_tokens", "tokens")
    sums = docs.groupBy("chunk").cogroup(totals.groupBy("of_chunk")).applyInArrow(
        run, "id long, n_tokens long, target double, background double"
    )
    mean = lambda c: F.when(F.col("n_tokens") > 0, F.col(c) / F.col("n_tokens"))
    return sums.select(
        "id", "n_tokens", mean("target").alias("target_loss"), mean("background").alias("background_loss"),
        (mean("target") - mean("background")).alias("score"),
    )


_CODED = ["chunk", "id", "code", "tokens", "word", "n"]
_ASKED = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("size", pa.int64()), ("packed", pa.binary())])

#: The same losses, rounded, in DuckDB SQL.
ORACLE_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS words,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), false) AS is_target
  FROM documents
), vocab AS (
  SELECT word FROM (SELECT unnest(words) AS word FROM texts) GROUP BY word
  HAVING count(*) >= 2
), tokens AS (
  SELECT r, is_target, unnest(words) AS word, unnest(range(len(words))) AS i FROM texts
), known AS (
  SELECT t.r, t.is_target, t.i, coalesce('w' || v.word, 'unknown') AS w FROM tokens t LEFT JOIN vocab v USING (word)
), pairs AS (
  SELECT r, is_target, w, coalesce(lag(w) OVER (PARTITION BY r ORDER BY i), 'begin') AS h FROM known
), bigrams AS (
  SELECT h, w, count(*) AS n, count(*) FILTER (is_target) AS t FROM pairs GROUP BY h, w
), histories AS (
  SELECT h, sum(n) AS hn, sum(t) AS ht FROM bigrams GROUP BY h
), singles AS (
  SELECT w, (sum(n) + 1)::DOUBLE / (sum(sum(n)) OVER () + size + 1) AS pn,
    (sum(t) + 1)::DOUBLE / (sum(sum(t)) OVER () + size + 1) AS pt
  FROM bigrams, (SELECT count(*) AS size FROM vocab) GROUP BY w, size
), losses AS (
  SELECT h, w,
    -ln(CASE WHEN ht > 0 THEN {BIGRAM_WEIGHT} * t / ht + (1 - {BIGRAM_WEIGHT}) * pt ELSE pt END) AS lt,
    -ln({BIGRAM_WEIGHT} * n / hn + (1 - {BIGRAM_WEIGHT}) * pn) AS lb
  FROM bigrams JOIN histories USING (h) JOIN singles USING (w)
), scored AS (
  SELECT r, count(*) AS n, avg(lt::DOUBLE) AS lt, avg(lb::DOUBLE) AS lb FROM pairs JOIN losses USING (h, w) GROUP BY r
)
SELECT doc_id, coalesce(n, 0) AS n_tokens, round(lt, 6) AS target_loss, round(lb, 6) AS background_loss,
  round(lt - lb, 6) AS score
FROM texts LEFT JOIN scored USING (r)
"""
