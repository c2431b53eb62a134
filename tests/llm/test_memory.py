"""What workers hold and what a stored table leaves on disk."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cardsight.llm import lm_scoring
from cardsight.llm.common import CLEANUP, stored


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    before, setting = _shuffles(spark), spark.conf.get(CLEANUP, None)
    counted = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))
    table = stored(counted.orderBy("k"), "test-stored")
    assert _shuffles(spark) <= before
    assert spark.conf.get(CLEANUP, None) == setting
    assert [tuple(r) for r in table.orderBy("k").collect()] == [(k, 100) for k in range(100)]


def test_counting_bigrams_holds_a_bounded_part_of_a_batch():
    draw = np.random.default_rng(0)
    texts = [draw.integers(2, 1 << 30, 20_000).astype(np.uint32).tobytes() for _ in range(150)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary()), pa.array([i % 2 == 0 for i in range(150)])], ["tokens", "is_target"])
    tracemalloc.start()
    n = n_target = 0
    for out in lm_scoring._counted([batch]):
        key = out.column(0).to_numpy()
        pair = (key >> 31 != lm_scoring.ANY) & (key & lm_scoring.ANY != lm_scoring.ANY)
        n, n_target = n + out.column(1).to_numpy()[pair].sum(), n_target + out.column(2).to_numpy()[pair].sum()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n, n_target) == (3_000_000, 1_500_000)
    assert peak < 130 << 20
