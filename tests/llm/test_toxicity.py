import itertools
import random

import pytest
from conftest import make_docs

from cardsight.llm import toxicity as X


def distance(a, b):
    """Edits with swaps of neighbours, by the plain table."""
    d = {(i, j): i or j for i in range(len(a) + 1) for j in range(len(b) + 1) if not (i and j)}
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_automaton_meets_exactly_the_near_terms():
    rnd = random.Random(1)
    terms = {"".join(rnd.choice("abc") for _ in range(rnd.randint(1, 7))) for _ in range(150)}
    trie = X.build_trie(terms)
    for _ in range(300):
        word = "".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 8)))
        for edits in (0, 1, 2):
            near = X.intersect(X.LevenshteinAutomaton(word, edits), trie)
            assert near == sorted(t for t in terms if distance(word, t) <= edits)


def test_matcher_finds_every_misspelling():
    terms = ["stupid", "worthless", "idiot"]
    match = X.Matcher(X.Lexicon(dict.fromkeys(terms, 3.0), {"achl": 2.0}, frozenset(terms)))
    for term in terms:
        for i in range(len(term)):
            for bad in (term[:i] + term[i + 1 :], term[:i] + "x" + term[i + 1 :], term[:i] + "x" + term[i:], term[:i] + term[i : i + 2][::-1] + term[i + 2 :]):
                assert bad == term or match(bad) == (term, X.FUZZY)
    assert match("idiot") == ("idiot", X.EXACT)
    assert match("achlich") == ("achl", X.STEM)
    assert match("table") is None


def test_quotation_is_told_from_abuse():
    match = X.Matcher(X.Lexicon({"idiot": 3.0}, {}, frozenset(["idiot"])))
    hits, _ = X.hits_of('you idiot. the word "idiot" is rude', match)
    assert [h.quoted for h in hits][1] is True
    plain, _ = X.hits_of("you are such an idiot today", match)
    assert [h.quoted for h in plain] == [False]
    assert X.features("you are an idiot", match, {})[0] > X.features('"idiot" is here', match, {})[0] == 0


def corpus(n=600):
    rnd = random.Random(4)
    plain = ["lorem", "ipsum", "dolor", "amet", "casa", "haus", "maison", "tree", "river", "stone"]
    docs, labels = [], []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(rnd.randint(8, 60))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rnd.randint(2, 5)):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["stupid", "worthless", "moron"]))
        docs.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def trained(spark):
    docs, labels = corpus()
    return make_docs(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_rows_are_told_apart(trained):
    docs, labels = trained
    rows = X.score(docs, labels).collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(truth) and 60 < len(held) < 200
    assert sum(r["predicted"] == truth[r["id"]] for r in held) >= 0.97 * len(held)
    assert all(0.0 <= r["score"] <= 1.0 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_held_out_labels_are_never_learned(trained):
    docs, labels = trained
    from pyspark.sql import functions as F

    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    same = [sorted(map(str, X.score(docs, x).collect())) for x in (labels, flipped)]
    assert same[0] == same[1]


def test_misspelled_abuse_is_caught_and_clean_text_left(trained, spark):
    docs, labels = trained
    rows = [(1, "you are stupd and worthles and a mornn tree river", "s"), (2, "tree river stone casa haus " * 5, "s"), (3, "moron", "s")]
    extra = make_docs(spark, rows)
    model = X.fit(docs, labels)
    score = X.score_column(spark, model)
    got = {r["doc_id"]: r["s"] for r in extra.select("doc_id", score(extra["text"]).alias("s")).collect()}
    assert got[1] > 0.5 > got[2]


def test_odd_rows_and_missing_labels(odd_docs, no_docs, trained, spark):
    _, labels = trained
    assert X.score(odd_docs, labels).count() == odd_docs.count()
    assert X.score(no_docs, labels).collect() == []
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in X.score(odd_docs, none).collect()} == {0.0}
    kept = X.without_toxic(odd_docs, labels)
    assert kept.columns == odd_docs.columns


def test_given_labels_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["predicted"], truth[r["id"]]) for r in X.score(docs, labels).collect() if r["held_out"] and r["id"] in truth]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)


def test_short_words_and_stems_are_met_misspelled():
    match = X.Matcher(X.Lexicon({"scum": 3.0, "zyx": 2.0}, {"worthl": 2.0, "idio": 2.0}, frozenset(["scum", "worthl*", "idio*"])))
    assert [match(w) for w in ("scumm", "scm", "csum", "sxum")] == [("scum", X.FUZZY)] * 4
    assert [match(w) for w in ("wrothless", "orthless", "wworthless", "worhtless", "wxrthless")] == [("worthl", X.FUZZY)] * 5
    assert match("zyxx") is None and match("table") is None
    rnd = random.Random(2)
    for _ in range(3000):
        word = "".join(rnd.choice("idowrthlescumx") for _ in range(rnd.randint(3, 9)))
        near = [t for t in ("scum",) if distance(word, t) <= 1]
        near += [s + "*" for s in ("idio", "worthl") if any(distance(word[:k], s) <= 1 for k in range(len(word) + 1))]
        assert match.near(word) == near


def test_every_term_of_a_large_lexicon_may_be_misspelled(spark):
    rnd = random.Random(6)
    insults = ["".join(rnd.choice("bcdfghjkl") for _ in range(6)) for _ in range(150)]
    docs = [(i, " ".join(["lorem ipsum dolor"] + ([insults[i // 2 % 150], "scum"] if i % 2 else ["amet"])), "s") for i in range(1800)]
    model = X.fit(make_docs(spark, docs), spark.createDataFrame([(i, i % 2) for i in range(1800)], "doc_id long, toxic int"))
    assert len(model.lexicon.fuzzy) > 100
    match = X.Matcher(model.lexicon)
    assert all(match(w[:2] + "z" + w[2:]) for w in [*insults, "scum"])
