import numpy as np
import pytest

from cardsight.llm import embedding_dedup as D

SCHEMA = "vec_id long, embedding array<float>, label int, key string, rep string"


def frame(spark, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, "k", "r") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def brute(vectors, threshold=0.95):
    """n_links and component of each (id, vector), by all pairs."""
    sound = lambda v: v is not None and len(v) and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(v)
    n = len(vectors)
    links = np.zeros((n, n), dtype=bool)
    unit = [np.float32(v).astype(float) / np.linalg.norm(np.float32(v).astype(float)) if i is not None and sound(v) else None for i, v in vectors]
    for a in range(n):
        for b in range(n):
            if a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]):
                links[a, b] = unit[a] @ unit[b] >= threshold
    label = np.arange(n)
    while True:
        new = np.array([min([label[i], *label[links[i]]]) for i in range(n)])
        if (new == label).all():
            break
        label = new
    smallest = {}
    for (i, _), at in zip(vectors, label):
        smallest[at] = min(i, smallest.get(at, i)) if i is not None else smallest.get(at)
    return [(i, int(links[k].sum()), smallest[label[k]]) for k, (i, _) in enumerate(vectors)]


def rows_of(found):
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in found)
    return sorted(str((r["id"], r["n_links"], r["component_id"])) for r in found)


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_groups_copies_and_odd_vectors(spark, block_rows):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    vectors = [(i, rng.normal(size=16)) for i in range(60)]
    vectors += [(100 + i, centre + rng.normal(size=16) * 0.02) for i in range(40)]
    vectors += [(200 + i, vectors[3][1]) for i in range(10)] + [(220, vectors[3][1] * 4)]
    inf, nan = float("inf"), float("nan")
    vectors += [(300, None), (301, []), (302, [0.0] * 16), (303, [nan] * 16), (304, [inf] + [1.0] * 15), (305, [None] + [1.0] * 15)]
    vectors += [(None, centre), (400, [1.0, 2.0]), (401, [2.0, 4.1]), (402, [-1.0, 2.0]), (403, [1.0])]
    vectors += [(200, vectors[3][1])]
    assert rows_of(D.near_duplicates(frame(spark, vectors), block_rows=block_rows).collect()) == sorted(map(str, brute(vectors)))


def test_empty_tables(spark):
    assert D.near_duplicates(frame(spark, [])).collect() == []
    assert rows_of(D.near_duplicates(frame(spark, [(1, None)])).collect()) == ["(1, 0, 1)"]


def test_recall_near_the_threshold(spark):
    """Pairs spread evenly from the threshold up: at least 0.9 of the links, none below."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    cosine = rng.uniform(0.94, 1.0, size=(1500, 1))
    vectors = np.float32(np.vstack([base, cosine * base + np.sqrt(1 - cosine**2) * aside])).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.95).sum(axis=1) - 1
    got = {r["id"]: r["n_links"] for r in D.near_duplicates(frame(spark, list(enumerate(vectors)))).collect()}
    assert all(got[i] <= links[i] for i in range(len(links)))
    assert sum(got.values()) >= 0.9 * links.sum()


def test_whole_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    assert rows_of(D.near_duplicates(vectors).collect()) == sorted(map(str, brute(rows)))


def test_number_of_pivots_grows_within_bounds():
    assert [D.n_pivots(n) for n in (0, 1, 10_000, 10**6, 10**12)] == [32, 32, 128, 1024, 8192]


def test_rows_of_one_id_are_separate_vectors(spark):
    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(2, 16))
    near = lambda v: v + rng.normal(size=16) * 0.01
    vectors = [(1, a), (1, b), (2, near(a)), (3, near(a)), (4, near(b)), (-5, near(b)), (9, rng.normal(size=16)), (9, a), (9, a)]
    assert rows_of(D.near_duplicates(frame(spark, vectors)).collect()) == sorted(map(str, brute(vectors)))


def test_candidates_count_shared_pivots_and_compare_places():
    def brute(x, y):
        k = len(x)
        place = lambda t, p: list(t).index(p) if p in t else k
        rule = sum(abs(place(x, p) - place(y, p)) for p in set(x) | set(y))
        return len(set(x) & set(y)) >= D.MIN_SHARED and rule <= D.MAX_FOOTRULE * k * (k + 1)

    rng = np.random.default_rng(1)
    x, y = (np.array([rng.permutation(12)[:6] for _ in range(80)], np.int32) for _ in range(2))
    want = np.array([[brute(a, b) for b in y.tolist()] for a in x.tolist()])
    assert (D.candidates(x, y) == want).all() and 0 < want.sum() < want.size
    # Equal sets in other orders: the places alone decide.
    first, last = np.int32([[1, 2, 3, 4, 5, 6]]), np.int32([[7, 8, 9, 10, 1, 2]])
    assert not D.candidates(last, np.int32([[11, 12, 13, 14, 1, 2]])).any()
    assert D.candidates(first, np.int32([[1, 2, 11, 12, 13, 14]])).all()


def test_permutations_are_in_the_order_of_nearness():
    rng = np.random.default_rng(3)
    pivots, vectors = (D.unit(rng.normal(size=(n, 8))) for n in (40, 25))
    want = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :6]
    assert (D.nearest_pivots(vectors, pivots, 6) == want).all()
    assert D.nearest_pivots(vectors, pivots[:1], 6).tolist() == [[0]] * 25
