import hashlib
import os
import shutil
import subprocess
import sys

import corpus_pipeline
import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as entry
from cardsight.llm import pii, queries, simhash

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NAMES = [s[0] for s in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage of the pipeline over the small table."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SF001), f"test-{name}")
        out.append(docs.collect())
    return out


def test_stages_in_order_keep_the_columns_of_documents(stages, spark):
    assert NAMES == ["toxicity", "simhash_near_dedup", "pii", "mixing", "sentencepiece"]
    columns = spark.read.parquet(f"{SF001}/documents.parquet").columns
    for rows in stages[1:-1]:
        assert list(rows[0].asDict()) == columns


def test_toxicity_drops_few_clean_documents(stages):
    labels = dict(pd.read_parquet(f"{SF001}/labels.parquet")[["doc_id", "toxic"]].itertuples(index=False))
    gone = {r["doc_id"] for r in stages[0]} - {r["doc_id"] for r in stages[1]}
    assert len(gone) < 0.2 * len(stages[0])
    assert sum(labels.get(i) == 0 for i in gone) <= 0.05 * len(stages[0])


def test_near_copies_leave_the_smallest_id_of_each_group(stages):
    prints = np.array([simhash.simhash(r["text"].encode()) for r in stages[1]], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    ids = np.array([r["doc_id"] for r in stages[1]])
    label = ids.copy()
    while True:
        new = np.array([label[near[i]].min() for i in range(len(ids))])
        if (new == label).all():
            break
        label = new
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(set(label.tolist()))


def test_personal_data_is_gone(stages):
    before = {r["doc_id"]: r["text"] for r in stages[2]}
    for r in stages[3]:
        assert r["text"] == pii.redacted(before[r["doc_id"]]) and r["n_chars"] == len(r["text"])


def test_mix_and_encoding(stages):
    texts = {r["doc_id"]: r["text"] for r in stages[3]}
    assert all(r["text"] == texts[r["doc_id"]] for r in stages[4])
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in stages[4]:
        ids = sp.encode(r["text"], add_bos=True, add_eos=True)
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(tuple(r) for r in stages[5]) == sorted(want)


def test_run_gives_the_last_stage(stages, spark):
    got = corpus_pipeline.run(spark, SF001)
    assert sorted(map(str, got.collect())) == sorted(map(str, stages[5]))


def test_every_stage_takes_odd_and_empty_tables(odd_docs, no_docs, spark):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            if name != "sentencepiece":
                assert out.columns == docs.columns
            docs = corpus_pipeline.stored(out, f"odd-{name}")
        assert (docs.count() == 0) == (no_docs is docs or docs.count() == 0)


def test_every_query_is_registered():
    found = [n for n in entry.queries() if n == "pipeline" or (n.startswith("op") and n[2].isdigit())]
    assert len(found) == 1 + 13 and {int(n[2:].split("_")[0]) for n in found if n != "pipeline"} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF01}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).df()
    got = queries.queries()[name](spark, SF01).toPandas()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    text = lambda df: sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))
    assert text(got) == text(want)


def test_entry_without_the_operators(tmp_path):
    """The entry point and the other queries stand without this subpackage."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(os.path.join(root, "cardsight"), tmp_path / "cardsight", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, any(n.startswith('op') for n in q), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) >= 64 and said[1:3] == ["False", "False"]
