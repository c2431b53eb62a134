import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, size string, shard int, key string, row string"


def make_docs(spark, rows):
    """Documents with extra columns whose names clash with those the operators use."""
    full = [(i, t, "en", s, None if t is None else len(t), "x", 7, "k", "r") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def some_rows(seed=1, n=60):
    """Nulls, empty and long texts, ties, repeated rows and hot sources."""
    rnd = random.Random(seed)
    words = "the of und que hält señor a1 b-2 x😀 don't idiot 4111111111111111 a@b.co +1(555)123-4567 10.0.0.300 1.2.3.4".split()
    text = lambda k: " ".join(rnd.choice(words) + rnd.choice(["", "", ",", ".\n"]) for _ in range(k))
    rows = [(i, text(rnd.randint(1, 40)), rnd.choice(["s1", "s1", "s2", "é", None])) for i in range(n)]
    rows += [(100, None, "s1"), (101, "", "s2"), (102, " \n\t ", None), (None, "no id here", "s1"), (None, None, None)]
    rows += [(103, text(6000), "s3"), (104, "x" * 30_000, "s1"), (105, "1" * 20_000, "s1"), (106, " " * 5_000, "s2")]
    rows += [(i, "the same text of several rows", "s2") for i in (200, 201, 202)]
    return rows + [(203, "a repeated row", "s1")] * 3


@pytest.fixture(scope="session")
def odd_rows():
    return some_rows()


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return make_docs(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
