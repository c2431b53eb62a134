import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cardsight.llm import mixing


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), most=3):
    """Targets by handing out and taking back: the contract's own words."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] > most * sizes[s]}
        if not full:
            return target | share
        for s in full:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= full
    return target


def check(rows, found):
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size_of(t)
    want = brute_targets(sizes)
    by_id = {i: (size_of(t), s) for i, t, s in rows}
    taken = Counter()
    for r in found:
        if r["id"] is None:
            continue
        size, source = by_id[r["id"]]
        assert (r["size"], r["source_size"]) == (size, sizes[source])
        assert r["target"] == pytest.approx(want[source], rel=1e-9)
        assert len(r["copies"]) <= 3
        taken[source] += size * len(r["copies"])
    return sizes, want, taken


def test_targets_and_words_taken(spark):
    from conftest import make_docs

    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 30))), ["a", "b", "c", "d", None][min(4, int(rng.exponential(1)))]) for i in range(3000)]
    docs = make_docs(spark, rows)
    found = mixing.mix(docs).collect()
    sizes, want, taken = check(rows, found)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 30
    assert len(found) == len(rows)
    again = mixing.mix(docs.repartition(9)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_odd_rows(odd_docs, odd_rows):
    found = mixing.mix(odd_docs).collect()
    check(odd_rows, found)
    assert len(found) == len(odd_rows)


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).collect() == []
    assert mixing.mixed_rows(no_docs).collect() == []


def test_tree_deals_every_block_once_and_evenly():
    quotas = np.array([100, 0, 37, 1, 512])
    counts = mixing.split_quotas(quotas, 6, seed=1)
    assert (counts.sum(axis=0) == quotas).all() and (counts >= 0).all()
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1
    assert (counts == mixing.split_quotas(quotas, 6, seed=1)).all()
    # Means over seeds are the quotas' shares.
    mean = np.mean([mixing.split_quotas(quotas, 6, seed=s) for s in range(300)], axis=0)
    assert np.abs(mean - quotas / 6).max() < 1.0


def test_mixed_rows_repeat_documents_and_keep_columns(odd_docs):
    out = mixing.mixed_rows(odd_docs)
    assert out.columns == odd_docs.columns
    copies = {str(r["id"]): len(r["copies"]) for r in mixing.mix(odd_docs).where("id < 200").collect()}
    got = Counter(str(r["doc_id"]) for r in out.where("doc_id < 200").collect())
    assert got == Counter({i: n for i, n in copies.items() if n})


def test_shards_get_near_equal_words(spark):
    from conftest import make_docs

    rows = [(i, "w " * 20, "abc"[i % 3]) for i in range(6000)]
    words = defaultdict(int)
    for r in mixing.mix(make_docs(spark, rows), n_shards=4).collect():
        for c in r["copies"]:
            words[c["shard"]] += r["size"]
    assert len(words) == 4 and max(words.values()) < 1.1 * min(words.values())


def digest(docs):
    rows = mixing.mix(docs, n_shards=8).collect()
    return sorted(str((r["id"], r["size"], [c["shard"] for c in r["copies"]])) for r in rows)


def test_the_tree_decides_what_is_taken_and_where(spark, odd_docs, monkeypatch):
    right = digest(odd_docs)
    whole = mixing.split_quotas
    zero = lambda *a: np.where(np.arange(8)[:, None] == 0, whole(*a).sum(axis=0), 0)
    less = lambda *a: np.maximum(whole(*a) - 1, 0)
    for broken, same_taken in ((zero, True), (less, False)):
        monkeypatch.setattr(mixing, "split_quotas", broken)
        monkeypatch.setattr(mixing, "_tree", tree_here(broken))
        found = digest(odd_docs)
        assert found != right
        taken = lambda rows: [r.split("[")[0] + str(r.count(",")) for r in rows]
        assert (taken(found) == taken(right)) == same_taken


def tree_here(split):
    """``mixing._tree`` with another way to split."""

    def tree(n_shards, seed):
        def run(pdf):
            import pandas as pd

            pdf = pdf.sort_values("stratum", ignore_index=True)
            out = []
            counts = split(pdf["quota"].to_numpy(), n_shards, seed, pdf["stratum"].tolist())
            upto = counts.cumsum(axis=0)
            for shard in range(n_shards):
                for i, name in enumerate(pdf["stratum"]):
                    out.append((name, shard, int(upto[shard, i] - counts[shard, i]), int(upto[shard, i])))
            return pd.DataFrame(out, columns=["stratum", "shard", "first", "upto"])

        return run

    return tree


def test_a_third_of_the_rows_without_id(spark):
    from conftest import make_docs

    rows = [(None if i % 3 == 0 else i, f"w{i} " * (1 + i % 9), "abc"[i % 2]) for i in range(900)]
    docs = make_docs(spark, rows)
    found = mixing.mix(docs).collect()
    check(rows, found)
    taken = Counter()
    for r in found:
        taken[r["source_size"], r["target"]] += r["size"] * len(r["copies"])
    assert len(taken) == 2 and all(abs(n - target) <= 9 for (_, target), n in taken.items())
    assert digest(docs) == digest(docs.repartition(7))
    draws = docs.select(mixing.identity(mixing.F.col("doc_id"), mixing.F.col("text")).alias("i")).distinct().count()
    assert draws == 900
