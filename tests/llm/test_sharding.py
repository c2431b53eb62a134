from collections import Counter
from fractions import Fraction
from hashlib import md5
from zlib import crc32

from cardsight.llm import sharding

COLUMNS = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "source"]


def brute(rows, n=8):
    """(id, size, crc, shard, slot, source) by plain sorting."""
    sized = []
    for i, t, s in rows:
        data = (t or "").encode()
        unit = f"text {md5(data).hexdigest()}" if i is None else i  # rows without id are drawn by their texts
        sized.append((s, md5(f"42:{unit}".encode()).hexdigest(), (i is not None, i or 0), crc32(data), len(data) + 1, i))
    placed = []
    for source in {r[0] for r in sized}:
        own = sorted((r for r in sized if r[0] == source), key=lambda r: r[1:5])
        key = (source is None, (source or "").encode())
        placed += [((2 * k + 1) / (2 * len(own)), key, k, r) for k, r in enumerate(own)]
    out, total = [], len(placed)
    for place, (*_, r) in enumerate(sorted(placed, key=lambda p: p[:3])):
        shard = place * n // total
        out.append((r[5], r[4], r[3], shard, place - -(-shard * total // n), r[0]))
    return out


def test_matches_brute_force(odd_docs, odd_rows):
    got = sharding.shard_documents(odd_docs)
    assert got.columns == COLUMNS
    rows = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["source"]) for r in got.collect()]
    assert sorted(map(str, rows)) == sorted(map(str, brute(odd_rows)))


def test_shards_match_the_mixture(odd_docs, odd_rows):
    rows = sharding.shard_documents(odd_docs, n_shards=5).collect()
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == 5
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    sources = Counter(s for _, _, s in odd_rows)
    for (shard, source), n in Counter((r["shard"], r["source"]) for r in rows).items():
        assert abs(n - Fraction(sources[source] * sizes[shard], len(rows))) <= 2


def test_reruns_agree_whatever_the_partitions(odd_docs):
    first = sorted(map(str, sharding.shard_documents(odd_docs).collect()))
    assert first == sorted(map(str, sharding.shard_documents(odd_docs.repartition(7)).collect()))


def test_empty_table(no_docs):
    assert sharding.shard_documents(no_docs).collect() == []


def test_plan_is_native(odd_docs, capsys):
    sharding.shard_documents(odd_docs).explain("formatted")
    assert not any(word in capsys.readouterr().out for word in ("Python", "Pandas", "Arrow", "Cartesian"))


def test_a_third_of_the_rows_without_id(spark):
    from conftest import make_docs

    rows = [(None if i % 3 == 0 else i, f"text {i}", "ab"[i % 2]) for i in range(600)]
    got = sharding.shard_documents(make_docs(spark, rows)).collect()
    found = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["source"]) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, brute(rows)))
    nulls = [r for r in got if r["doc_id"] is None]
    per_shard = [sum(r["shard"] == s for r in nulls) for s in range(8)]
    assert max(per_shard) < 50  # not side by side in the order
