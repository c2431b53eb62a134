import random
import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest

from cardsight.llm import filter_audit as A


def text_fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {
        *("A" if len(words) < 100 else ""),
        *("B" if 100 * len(set(words)) < 80 * len(words) else ""),
        *("C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""),
        *("D" if set(text) & set("#$%&*|") else ""),
    }


def brute(docs, labels):
    """Every order applied document by document."""
    fails = []
    for i, text, part in docs:
        own = text_fails(text or "")
        if i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, _ in docs):
            own.add("E")
        held = [any(k == i and i is not None and x[w] == 1 for k, *x in labels) for w in (0, 1)]
        fails.append((part or "", own, *held))
    out, shapley = [], Counter()
    for part in {f[0] for f in fails}:
        rows = [f for f in fails if f[0] == part]
        for order in permutations("ABCDE"):
            left = rows
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                gone_before = [r for r in rows if name in r[1] and not any(r is x for x in left)]
                left = [r for r in left if name not in r[1]]
                shapley[part, name] += len(gone)
                only = sum(r[1] == {name} for r in rows)
                out.append((part, "".join(order), step, len(left), len(gone), len(gone_before), only, sum(r[2] for r in gone), sum(r[3] for r in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def odd(seed=2):
    rnd = random.Random(seed)
    vocabulary = ["word", "Und", "ABC", "é", "x#y", "señor", "😀", "\x85", "a b"] + [f"w{i}" for i in range(200)]

    def text(n, pool):
        return "".join(rnd.choice(pool) + rnd.choice([" ", "\n", "\x0b ", "\t"]) for _ in range(n))

    docs = [(i, text(rnd.choice([5, 99, 100, 150]), vocabulary[: rnd.choice([3, 60, 209])]), rnd.choice(["en", "en", "de", None, ""])) for i in range(40)]
    docs += [(i, docs[i % 7][1], rnd.choice(["en", "fr"])) for i in range(40, 60)]  # copies
    docs += [(100, None, "en"), (101, "", "de"), (None, "", "en"), (None, docs[0][1], None), (None, None, None), (102, " \n ", "xx")]
    docs += [(103, "the same row", "en")] * 3 + [(104, "y " * 3000 + "$", "en")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 60, 2)] + [(4, 1, 1), (None, 1, 1), (103, 1, 0), (999, 1, 1)]
    return docs, labels


def frames(spark, docs, labels):
    schema = "doc_id long, text string, lang string, part string, mask int, n string, id string"
    return (
        spark.createDataFrame([(*d, "p", 3, "n", "i") for d in docs], schema).repartition(3),
        spark.createDataFrame([(*x, "l") for x in labels], "doc_id long, quality int, toxic int, lang string"),
    )


def test_odd_rows(spark):
    docs, labels = odd()
    got = A.audit(*frames(spark, docs, labels))
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, labels)


def test_no_documents_and_no_labels(spark):
    docs, labels = odd()
    assert A.audit(*frames(spark, [], labels)).collect() == []
    assert sorted(tuple(r) for r in A.audit(*frames(spark, docs, [])).collect()) == brute(docs, [])


def test_long_texts_are_cut_at_white_space_only(monkeypatch):
    text = "".join(f"w{i % 300}" + " \n\t"[i % 3] for i in range(2000)).encode() + b"\xe2\x80\x83" * 50
    whole = A.text_mask(text)
    for size in (1, 7, 64):
        monkeypatch.setattr(A, "PIECE_BYTES", size)
        assert b"".join(A.pieces(text)) == text
        assert A.text_mask(text) == whole
    assert A.text_mask(b"") == 1


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_swaps_visit_every_order_and_keep_the_function(n):
    rnd = random.Random(n)
    counts = {m: (rnd.choice([0, 0, 1, 5]), rnd.randrange(3)) for m in range(1 << n)}
    diagram = A.Diagram(counts, n, 2)
    seen = {tuple(diagram.order)}
    for place in A.plain_changes(n):
        diagram.swap(place)
        seen.add(tuple(diagram.order))
        for mask in range(1 << n):
            node = diagram.root
            for v, level in zip(diagram.order, diagram.levels):
                node = level[node][mask >> v & 1]
            assert node == counts[mask]
        for level in diagram.levels:
            assert len(set(level.values())) == len(level)  # no two nodes are equal
        assert diagram.weight(diagram.root) == tuple(map(sum, zip(*counts.values())))
    assert len(seen) == factorial(n)


def test_equal_parts_of_a_diagram_are_one_node():
    diagram = A.Diagram({0: (1,)}, 5, 1)
    assert [len(level) for level in diagram.levels] == [1, 2, 2, 2, 2]
