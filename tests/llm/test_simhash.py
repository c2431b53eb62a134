import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from cardsight.llm import simhash as S
from cardsight.llm.common import connected_components, key_runs

SF001 = "/root/testdata/sf0.001"


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, bits=4):
    """Component number of each fingerprint in the list."""
    a = np.array(prints, dtype=np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= bits
    label = np.arange(len(a))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(a))])
        if (new == label).all():
            return label
        label = new


def check(rows, found):
    prints = [brute_print(t) for _, t, _ in rows]
    label = brute_components(prints)
    smallest = {}
    for (i, _, _), at in zip(rows, label):
        if i is not None:
            smallest[at] = min(i, smallest.get(at, i))
    want = sorted((str(i), np.uint64(p).astype(np.int64), str(smallest.get(at))) for (i, _, _), p, at in zip(rows, prints, label))
    assert sorted((str(r["id"]), r["fp"], str(r["component_id"])) for r in found) == want


def test_odd_rows(odd_docs, odd_rows):
    check(odd_rows, S.near_duplicates(odd_docs).collect())


def test_empty_table(no_docs):
    assert S.near_duplicates(no_docs).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    check(rows, S.near_duplicates(docs).collect())


@pytest.mark.parametrize("block_rows", [3, 10, 4096])
def test_dense_group_in_blocks(spark, block_rows):
    """A large group of near fingerprints, chains and far ones, whatever the block size."""
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    near = [int(centre) ^ sum(1 << int(b) for b in rng.choice(64, size=2, replace=False)) for _ in range(60)]
    chain = [int(centre) ^ (0xFF << 20)]
    for b in range(0, 64, 4):
        chain.append(chain[-1] ^ (0xF << b))
    prints = sorted(set(near + chain + [int(x) for x in rng.integers(0, 2**63, size=200, dtype=np.uint64)]))
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    labels = {r["node"]: r["label"] for r in connected_components(S.fingerprint_links(frame, 4, block_rows)).collect()}
    want = {}
    groups = brute_components(prints)
    for g in set(groups):
        members = [s for s, x in zip(signed, groups) if x == g]
        if len(members) > 1:
            want |= dict.fromkeys(members, min(members))
    assert labels == want


def test_key_runs_cut_whole_runs():
    rng = np.random.default_rng(0)
    for _ in range(200):
        keys = np.sort(rng.integers(0, rng.integers(1, 6), size=rng.integers(0, 60)))
        cuts = np.sort(rng.integers(0, len(keys) + 1, size=4))
        batches = [
            pa.RecordBatch.from_arrays([pa.array(k), pa.array(v)], ["k", "v"])
            for k, v in zip(np.split(keys, cuts), np.split(np.arange(len(keys)), cuts))
        ]
        size = int(rng.integers(2, 8))
        pieces = list(key_runs(batches, size))
        assert [v for rows, _, _ in pieces for v in rows.column(1).to_pylist()] == list(range(len(keys)))
        for rows, long_key, _ in pieces:
            found = rows.column(0).to_pylist()
            if long_key is None:
                assert all(found.count(k) == (keys == k).sum() <= size for k in set(found))
            else:
                assert set(found) == {long_key} and len(found) <= size < (keys == long_key).sum()


def test_first_of_each_keeps_one_row_and_all_columns(odd_docs, odd_rows):
    kept = S.first_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = odd_rows
    label = brute_components([brute_print(t) for _, t, _ in rows])
    assert kept.count() == len(set(label))
    assert kept.where("doc_id in (201, 202)").count() == 0
    assert kept.where("doc_id = 203").count() == 1
