import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from cardsight.llm import lexical_search as L

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return [t.translate(FOLD) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, k=20):
    have = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(have), sum(n for *_, n in have)
    df = Counter(t for _, c, _ in have for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in have:
            m = 100 - 25 + (25 * n * n_docs) // n_terms
            w = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            s = sum(w(t) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def make_items(spark, items):
    return spark.createDataFrame([(i, t, 5, "r") for i, t in items], "item_id long, text string, rank int, id string")


ITEMS = [
    (1, "The of und"), (2, "hält SEÑOR señor a1 a1 a1"), (3, None), (4, ""), (5, " .,-"), (6, "nothing known here"),
    (7, "the same text of several rows, repeated row"), (None, "x😀 don't"), (7, "idiot b 2"), (8, "x" * 30_000), (9, "1 2 3 4 10 300"),
]


@pytest.mark.parametrize(("unit", "first", "block"), [(200_000, 2000, 500_000), (9, 1, 500_000), (60, 5, 6)])
def test_odd_rows(odd_docs, odd_rows, spark, unit, first, block):
    out = L.search(odd_docs, make_items(spark, ITEMS), unit_postings=unit, first_docs=first, block_terms=block)
    assert out.columns == ["item_id", "rank", "id", "score"]
    assert got(out) == brute([(i, t) for i, t, _ in odd_rows], ITEMS)


def test_many_ties_hot_strata_and_small_k(spark):
    from conftest import make_docs

    rnd = random.Random(5)
    rows = [(i, "copy of one text", "s") for i in range(300, 0, -1)]
    rows += [(1000 + i, " ".join(rnd.choice("abcdefghij") for _ in range(rnd.choice([3, 3, 3, 40, 400]))), "s") for i in range(300)]
    items = [(1, "one text"), (2, "a b c c"), (3, "j copy"), (4, "k")]
    for k, unit in ((3, 50), (20, 1000)):
        out = L.search(make_docs(spark, rows).repartition(5), make_items(spark, items), k=k, unit_postings=unit, first_docs=30)
        assert got(out) == brute([(i, t) for i, t, _ in rows], items, k)


def test_no_documents_and_no_items(odd_docs, no_docs, spark):
    assert L.search(no_docs, make_items(spark, ITEMS)).collect() == []
    assert L.search(odd_docs, make_items(spark, [])).collect() == []
    assert L.search(odd_docs, make_items(spark, [(1, None), (2, "?")])).collect() == []


def test_long_texts_and_small_sums(monkeypatch):
    text = " ".join(f"W{i % 50}.é{i % 7}" for i in range(5000)).encode()
    whole = L.term_counts(text)
    assert whole == Counter(t.encode() for t in terms(text.decode()))
    monkeypatch.setattr(L, "PIECE_BYTES", 100)
    assert L.term_counts(text) == whole


def test_products_in_pieces(odd_docs, odd_rows, spark, monkeypatch):
    monkeypatch.setattr(L, "PRODUCTS", 7)
    assert got(L.search(odd_docs, make_items(spark, ITEMS), first_docs=10)) == brute([(i, t) for i, t, _ in odd_rows], ITEMS)


def test_bound_holds_for_every_document_of_a_unit():
    rng = np.random.default_rng(3)
    queries = L.Queries(rng.integers(0, 6, 40), rng.integers(0, 12, 40), rng.integers(0, 9000, 40), 12)
    tf = rng.integers(0, 6, (30, 12))
    doc, term = np.nonzero(tf)
    order = np.lexsort([doc, tf[doc, term], term])
    doc, term, times = doc[order], term[order], tf[doc, term][order]
    bound = L.bounds(queries, 90, term, times)
    for d in range(30):
        which, at = queries.products(term[doc == d])
        score = np.zeros(6, np.int64)
        np.add.at(score, queries.item[at], queries.weight[at] * L.impact(times[doc == d], 90)[which])
        assert (score <= bound).all()
