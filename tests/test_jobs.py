"""The three command-line jobs end to end on the sf0.01 transactions."""

import os

from pyspark.sql import functions as F

from cardsight import schema as S
from cardsight.operators import tracking as trk
from cardsight.plans import jobs
from tests.conftest import SF01


def test_preprocess_split_train(spark, tmp_path):
    from cardsight.sources.transactions import load_transactions

    raw = str(tmp_path / "raw")
    load_transactions(spark, SF01).write.parquet(raw)
    feats = jobs.preprocess(spark, raw, str(tmp_path / "features"))
    fdf = spark.read.parquet(feats)
    assert fdf.count() == 10000 and "IS_WKD" in fdf.columns
    assert sorted(os.listdir(feats))[0].startswith("TX_TIME_DAYS=") or "TX_TIME_DAYS=0" in os.listdir(feats)
    test_days = fdf.where(F.col("TX_TIME_DAYS").between(23, 29))
    plan = test_days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionfilters" in plan.lower()
    out = jobs.split(spark, feats, str(tmp_path / "splits"), "2024-01-01", 15, 7, 1, 7)
    counts = {}
    for name in jobs.SPLITS:
        df = jobs.read_split(spark, str(tmp_path / "splits"), name)
        counts[name] = df.count()
        header = open([os.path.join(out[name], f) for f in sorted(os.listdir(out[name])) if f.endswith(".csv")][0]).readline()
        assert header.strip().split(",") == [S.TRANSACTION_ID, *S.FEATURE_COLUMNS, S.TX_FRAUD]
        assert df.where(F.col("TX_FRAUD").isNull()).count() == 0
    assert all(n > 0 for n in counts.values())
    run_id = jobs.train(spark, str(tmp_path / "splits"), "job-test", 2, "job_model",
                        space={"iterations": ("int", 2, 3), "depth": ("int", 2, 3)})
    models = trk.read_table(spark, "models").where(F.col("run_id") == run_id).collect()
    assert len(models) == 1 and models[0]["name"] == "job_model"
