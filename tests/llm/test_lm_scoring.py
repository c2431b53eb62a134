import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cardsight.llm import lm_scoring as L


def brute(rows, targets, size, weight=L.BIGRAM_WEIGHT):
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    counts = Counter(w for _, t, _ in rows for w in words(t))
    vocab = {w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:size] if n >= 2}
    known = [[w if w in vocab else None for w in words(t)] for _, t, _ in rows]
    models = []
    for use in (lambda i: i in targets, lambda i: True):
        pair, history, single = Counter(), Counter(), Counter()
        for (i, _, _), ws in zip(rows, known):
            if use(i):
                for h, w in zip(["<begin>", *ws], ws):
                    pair[h, w] += 1
                    history[h] += 1
                    single[w] += 1
        total = sum(single.values())

        def loss(h, w, pair=pair, history=history, single=single, total=total):
            p = (single[w] + 1) / (total + len(vocab) + 1)
            return -math.log(weight * pair[h, w] / history[h] + (1 - weight) * p if history[h] else p)

        models.append(loss)
    out = []
    for (i, _, _), ws in zip(rows, known):
        sums = [sum(m(h, w) for h, w in zip(["<begin>", *ws], ws)) / len(ws) if ws else None for m in models]
        out.append((i, len(ws), *sums))
    return out


@pytest.mark.parametrize(("size", "hot"), [(1000, 10**6), (5, 3), (1000, 0)])
def test_odd_rows(odd_docs, odd_rows, spark, size, hot):
    ids = set(range(0, 60, 3)) | {103, 203, 999}
    targets = spark.createDataFrame([(i,) for i in [*ids, 0, None]], "doc_id long")
    got = L.cross_entropy_difference(odd_docs, targets, vocabulary_size=size, hot_bigrams=hot).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(brute(odd_rows, ids, size), key=order)
    got = sorted(((r["id"], r["n_tokens"], r["target_loss"], r["background_loss"], r["score"]) for r in got), key=order)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for g, w in zip(got, want):
        assert g[2:4] == pytest.approx(w[2:], rel=1e-9) if w[1] else g[2:] == (None, None, None)
        if w[1]:
            assert g[4] == pytest.approx(w[2] - w[3], abs=1e-9)


def test_target_like_documents_score_lower(spark):
    from conftest import make_docs

    rows = [(i, ("the river runs by the old mill " if i % 2 else "buy now click here best price ") * (1 + i % 5), "s") for i in range(60)]
    targets = spark.createDataFrame([(i,) for i in range(1, 30, 2)], "doc_id long")
    score = {r["id"]: r["score"] for r in L.cross_entropy_difference(make_docs(spark, rows), targets).collect()}
    assert max(score[i] for i in score if i % 2) < min(score[i] for i in score if not i % 2)


def test_counts_of_a_task_are_whole_whatever_it_holds(monkeypatch):
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 9, size=n).astype(L._NUMBER) for n in (0, 1, 50, 400, 30)]
    batch = pa.RecordBatch.from_arrays([pa.array([d.tobytes() for d in docs]), pa.array([True, False, True, False, True])], ["tokens", "is_target"])
    want = Counter()

    def count(into, d, t):
        for bigram in L._keys(d.tobytes()).tolist():
            for k in (bigram, bigram >> L._SHIFT << L._SHIFT | L.ANY, L.ANY << L._SHIFT | bigram & L.ANY):
                into[k, 0] += 1
                into[k, 1] += t

    for d, t in zip(docs, [1, 0, 1, 0, 1]):
        count(want, d, t)
    for tokens, held in ((1 << 21, 1 << 22), (3, 4), (100, 20)):
        monkeypatch.setattr(L, "SORTED_TOKENS", tokens)
        monkeypatch.setattr(L, "HELD_BIGRAMS", held)
        got = Counter()
        for out in L._counted(iter([batch, batch.slice(0, 0), batch.slice(2, 2)])):
            for k, n, t in zip(*(c.to_pylist() for c in out.columns)):
                got[k, 0] += n
                got[k, 1] += t
        twice = Counter(want)
        for d, t in ((docs[2], 1), (docs[3], 0)):
            count(twice, d, t)
        assert +got == +twice


def test_no_documents_and_no_targets(no_docs, odd_docs, spark):
    none = spark.createDataFrame([], "doc_id long")
    assert L.cross_entropy_difference(no_docs, none).collect() == []
    assert L.cross_entropy_difference(odd_docs, none).count() == odd_docs.count()


def test_every_word_that_occurs_twice_is_kept(spark, monkeypatch):
    from conftest import make_docs

    monkeypatch.setattr(L, "HOT_WORDS", 100)
    pairs = [f"w{i} v{i}" for i in range(8192)]
    rows = [(i, " ".join(pairs[i * 512 % len(pairs) :][:512]), "s") for i in range(32)]
    targets = spark.createDataFrame([(i,) for i in range(16)], "doc_id long")
    want = {i: (n, t, b) for i, n, t, b in brute(rows, set(range(16)), 10**6)}
    for r in L.cross_entropy_difference(make_docs(spark, rows), targets, hot_bigrams=50).collect():
        assert (r["n_tokens"], r["target_loss"], r["background_loss"]) == pytest.approx(want[r["id"]], rel=1e-9)


def test_chunks_make_no_difference(odd_docs, odd_rows, spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_TOKENS", 30)
    test_odd_rows(odd_docs, odd_rows, spark, 1000, 3)


def test_given_tables_equal_the_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    for name in ("documents", "labels"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    want = duckdb.sql(L.ORACLE_SQL).fetchall()
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    got = L.cross_entropy_difference(docs, labels.where("quality = 1").select("doc_id")).collect()
    assert len(got) == len(want)
    want = {r[0]: r for r in want}
    for r in got:
        assert tuple(r) == pytest.approx(want[r["id"]], abs=2e-6)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 27])
def test_bigrams_that_occur_once_or_seldom(spark, monkeypatch, bits):
    """Rare words and bigrams, few and many of them in a crowded bit set."""
    from conftest import make_docs

    monkeypatch.setattr(L, "HOT_WORDS", 200)
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{int(w)}" for w in rng.zipf(1.3, size=800) if w < 3000), "s") for i in range(60)]
    targets = spark.createDataFrame([(i,) for i in range(0, 60, 4)], "doc_id long")
    want = {i: (n, t, b) for i, n, t, b in brute(rows, set(range(0, 60, 4)), 10**6)}
    found = L.cross_entropy_difference(make_docs(spark, rows), targets, hot_bigrams=100, filter_bits=bits).collect()
    assert len(found) == 60
    for r in found:
        assert (r["n_tokens"], r["target_loss"], r["background_loss"]) == pytest.approx(want[r["id"]], rel=1e-9)


def test_the_bit_set_holds_every_bigram(spark):
    rng = np.random.default_rng(5)
    key = rng.integers(0, 1 << 62, size=2000)
    frame = spark.createDataFrame([(int(k),) for k in key], "key long")
    bits = L._bit_set(frame, 1 << 16)
    place = L._place(key >> L._SHIFT, key & L.ANY, 1 << 16)
    assert (bits[place >> 3] >> (place & 7) & 1).all()
    assert np.unpackbits(bits).sum() == len(set(place.tolist()))


def test_totals_come_back_as_packed_rows(spark):
    """Every key of a chunk gets the totals of all chunks; rows grow with chunks and buckets, not with bigrams."""
    rng = np.random.default_rng(6)
    docs = [(i % 3, rng.integers(0, 40, size=n).astype(L._NUMBER), i % 2 == 0) for i, n in enumerate((300, 0, 500, 1, 700, 20, 0))]
    marked = spark.createDataFrame([(c, bytearray(w.tobytes()), t) for c, w, t in docs], "chunk long, tokens binary, is_target boolean")
    want, of_chunk = Counter(), {}
    for c, w, t in docs:
        for bigram in L._keys(w.tobytes()).tolist():
            for k in (bigram, bigram >> L._SHIFT << L._SHIFT | L.ANY, L.ANY << L._SHIFT | bigram & L.ANY):
                want[k] += 1
                want[k, "target"] += t
                of_chunk.setdefault(c, set()).add(k)
    got = {}
    rows = L._totals(marked, 4).collect()
    assert len(rows) <= 3 * 4
    for r in rows:
        got[r["chunk"], r["bucket"]] = L._unpacked(bytes(r["packed"]), r["size"], np.int64, np.int64)
    for c, keys in of_chunk.items():
        keys = np.array(sorted(keys))
        order, used, at = L._dealt(keys, 4)
        for b, s, e in zip(used.tolist(), at, at[1:]):
            n, n_target = got.pop((c, b))
            assert n.tolist() == [want[k] for k in keys[order][s:e].tolist()]
            assert n_target.tolist() == [want[k, "target"] for k in keys[order][s:e].tolist()]
    assert not got


def test_words_are_not_shuffled_beside_the_tokens(odd_docs, spark):
    rows = odd_docs.select("doc_id", "text").toDF("id", "text")
    coded = L.stored(L._coded(rows), "lm-coded")
    words = L.stored(L._vocabulary(coded, None), "lm-vocabulary")
    codes = L.stored(L._codes(coded, words, rows.select("id").where("id < 9").distinct()), "lm-codes")
    numbered = L._numbered(coded, codes)
    assert "Join" not in numbered._jdf.queryExecution().optimizedPlan().toString()
    assert numbered.count() == odd_docs.count()


def test_many_buckets_make_no_difference(odd_docs, odd_rows, spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK_TOKENS", 50)
    monkeypatch.setattr(L, "BUCKET_TOKENS", 10)
    test_odd_rows(odd_docs, odd_rows, spark, 1000, 3)
