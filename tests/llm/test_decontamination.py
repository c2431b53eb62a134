import hashlib
import random
import re

import pytest

from cardsight.llm import decontamination as D

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM_SCHEMA = "item_id long, text string, row string, window string, at int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(docs, items, window):
    out = []
    for i, text in docs:
        have, hit, names = words(text), set(), set()
        for item, item_text in items:
            want = words(item_text)
            for s in range(max(1, len(want) - window + 1)) if want else ():
                w = want[s : s + window]
                for at in range(len(have) - len(w) + 1):
                    if have[at : at + len(w)] == w:
                        hit |= set(range(at, at + len(w)))
                        names.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(have), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


def make_items(spark, items):
    return spark.createDataFrame([(i, t, "r", "w", 3) for i, t in items], ITEM_SCHEMA)


def odd_items(rows):
    texts = [t for _, t, _ in rows if t and 12 < len(words(t)) < 60]
    rnd = random.Random(3)
    items = [(1, "The"), (2, "the OF"), (3, "und, que"), (4, "no such words here at all"), (5, None), (6, " .,; "), (7, "")]
    items += [(8, "same text of several"), (None, "a repeated"), (None, "zzz"), (9, "hält señor"), (9, "the the the")]
    for k in range(12):
        w = words(texts[k])
        at = rnd.randrange(len(w) - 11)
        items.append((10 + k, " - ".join(w[at : at + rnd.choice([4, 9, 10, 11, 12])]).upper().replace("Ä", "ä").replace("Ñ", "ñ")))
    return items + [(30, items[-1][1]), (31, " ".join(["x"] * 14))]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("window", "shingle", "block_rows"), [(10, 3, 250_000), (10, 3, 7), (4, 1, 250_000), (3, 5, 40)])
def test_odd_rows(odd_docs, odd_rows, spark, window, shingle, block_rows):
    items = odd_items(odd_rows)
    out = D.decontaminate(odd_docs, make_items(spark, items), window, shingle, block_rows=block_rows)
    want = brute([(i, t) for i, t, _ in odd_rows], items, window)
    assert out.columns == ["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got(out) == want
    assert sum(r[5] for r in want) > 10


def test_windows_that_overlap_count_each_word_once(spark):
    from conftest import make_docs

    rows = [(1, "x " * 40, "s"), (2, "x " * 9, "s"), (3, "a b c d e f g h i j k l m", "s"), (4, "b c d e f g h i j k", "s"), (5, "a b c d e f g h i k j", "s")]
    items = [(1, "x " * 12), (2, "A B C D E F G H I J K")]
    want = brute([(i, t) for i, t, _ in rows], items, 10)
    assert got(D.decontaminate(make_docs(spark, rows), make_items(spark, items))) == want
    assert [r[2] for r in want] == [40, 0, 11, 10, 0]


def test_no_documents_and_no_items(odd_docs, no_docs, odd_rows, spark):
    none = make_items(spark, [])
    assert D.decontaminate(no_docs, make_items(spark, odd_items(odd_rows))).collect() == []
    clean = D.decontaminate(odd_docs, none).collect()
    assert len(clean) == len(odd_rows) and {(r["n_hit"], r["n_items"], r["contaminated"]) for r in clean} == {(0, 0, False)}
    assert {r["items_sha256"] for r in clean} == {hashlib.sha256(b"").hexdigest()}


def test_plan_has_no_python_and_broadcasts_only_the_items(odd_docs, odd_rows, spark, capsys):
    windows, _ = D._item_windows(make_items(spark, odd_items(odd_rows)), 10, "item_id", "text")
    D.occurrences(odd_docs.select("doc_id", "text"), windows).explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
