import hashlib

from cardsight.llm import fingerprint as P


def test_equal_roots_only_for_equal_texts():
    texts = ["", " ", "a", "a ", "a\n", "\na", "a b", "a  b", "a\nb", "a\n\nb", "a\n\n\nb", "a b c d e f g h i j", "a b c d e f g h i  j"]
    texts += ["\n".join("abc"[: i % 3]) for i in range(1)] + ["p\n" * 40, "p\n" * 41]
    roots = [P.fingerprint(t).partition(":")[0] for t in texts]
    assert len(set(roots)) == len(set(texts))
    assert P.fingerprint("same text") == P.fingerprint("same text")


def test_likeness():
    text = "\n".join(f"line {i} has some words of its own, as {i * 7} shows" for i in range(40))
    other = "\n".join(f"quite another row {i * 3} without any of them" for i in range(40))
    same = P.fingerprint(text)
    assert P.likeness(same, P.fingerprint(text)) == 1.0
    half = P.likeness(same, P.fingerprint(P.edited(text, other)))
    assert 0.65 < half < 0.85
    assert P.likeness(same, P.fingerprint(other)) < 0.1
    assert P.likeness(same, P.fingerprint("")) == 0.0
    assert P.likeness(P.fingerprint(""), P.fingerprint("")) == 1.0
    assert P.likeness(P.fingerprint(text[:-5]), same) == P.likeness(same, P.fingerprint(text[:-5])) > 0.95


def test_edits_locate_the_changed_paragraphs():
    lines = [f"paragraph number {i}" for i in range(50)]
    changed = [*lines]
    changed[3], changed[40] = "another third", "another fortieth"
    assert P.edits(P.fingerprint("\n".join(lines)), P.fingerprint("\n".join(changed))) == [(0, 3), (2, 8)]
    assert P.edits(P.fingerprint("x"), P.fingerprint("x")) == []


def brute(rows):
    """Results by sorting the rows in one list."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for (i, t, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1]):
        t, following = t or "", following or ""
        k = len(t) // 4
        new = t[: len(t) - k] + following[:k]
        a, b, c = map(P.fingerprint, (t, new, following))
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, P.likeness(a, b), P.likeness(a, c)))
    return sorted(map(str, out))


def test_odd_rows_whatever_the_buckets(odd_docs, odd_rows):
    for size in (1 << 24, 500):
        got = P.fingerprints(odd_docs, bucket_bytes=size).collect()
        assert sorted(str(tuple(r)) for r in got) == brute(odd_rows)


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = P.fingerprints(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_one_row_and_no_rows(spark, no_docs):
    from conftest import make_docs

    one = P.fingerprints(make_docs(spark, [(5, "only one row here", "s")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert P.fingerprints(no_docs).collect() == []
