"""Sources and sinks: merge by column name, CSV without an index column, gzip Parquet."""

import os

from pyspark.sql import types as T

from cardsight.session import scratch_path
from cardsight.sources import files


def test_parquet_merge_by_name(spark):
    folder = scratch_path(spark, "merge-test")
    spark.createDataFrame([(1, 2.0)], "id long, a double").write.mode("append").parquet(folder)
    spark.createDataFrame([(3.5, 2)], "b double, id long").write.mode("append").parquet(folder)
    inferred = {r["id"]: (r["a"], r["b"]) for r in files.merge_files(spark, folder).collect()}
    assert inferred == {1: (2.0, None), 2: (None, 3.5)}
    declared = T.StructType([T.StructField("id", T.LongType()), T.StructField("b", T.DoubleType())])
    got = {r["id"]: r["b"] for r in files.merge_files(spark, folder, schema=declared).collect()}
    assert got == {1: None, 2: 3.5}


def test_json_merge_and_csv_roundtrip(spark):
    folder = scratch_path(spark, "json-test")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "a.json"), "w") as fh:
        fh.write('{"id": 1, "a": 2.0}\n')
    with open(os.path.join(folder, "b.json"), "w") as fh:
        fh.write('{"id": 2, "c": "x"}\n')
    rows = {r["id"]: (r["a"], r["c"]) for r in files.merge_files(spark, folder, "json").collect()}
    assert rows == {1: (2.0, None), 2: (None, "x")}

    df = spark.createDataFrame([(1, True, 0.5), (2, False, None)], "k long, flag boolean, v double")
    path = files.write_csv(df.orderBy("k"), spark, "csv-test")
    part = [f for f in sorted(os.listdir(path)) if f.endswith(".csv")][0]
    assert open(os.path.join(path, part)).readline().strip() == "k,flag,v"
    back = files.read_csv(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_gzip_parquet_sink(spark):
    df = spark.range(10).withColumnRenamed("id", "x")
    path = files.write_parquet(df, spark, "gz-test")
    assert any(f.endswith(".gz.parquet") for f in os.listdir(path))
    assert files.read_parquet(spark, path).count() == 10
