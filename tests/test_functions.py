"""Column functions: epoch seconds, day arithmetic, seeded hashes."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from cardsight.functions import hashing, numeric
from cardsight.functions import time as tf


def test_epoch_seconds_floor_and_types(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 0, 7, 999999),), (dt.datetime(1969, 12, 31, 23, 59, 59, 500000),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(tf.epoch_seconds_of(df, "ts")).collect()]
    assert got == [1704067207, -1]  # floored, also before 1970
    ltz = df.select(F.col("ts").cast("timestamp").alias("ts"))
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        assert [r[0] for r in ltz.select(tf.epoch_seconds_of(ltz, "ts")).collect()] == [1704067207, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_exact_day_arithmetic_keeps_time(spark):
    start = tf.to_timestamp_literal(dt.datetime(2024, 1, 1, 18, 30))
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 8, 18, 29, 59),), (dt.datetime(2024, 1, 8, 18, 30),)], "ts timestamp_ntz"
    )
    got = [r[0] for r in df.select(tf.in_half_open_range("ts", start, 7)).collect()]
    assert got == [True, False]
    assert df.select(tf.day_index("ts", "2024-01-01")).first()[0] == 7


def test_seeded_hashes_match_md5(spark):
    df = spark.createDataFrame([(12345,)], "id long")
    row = df.select(
        hashing.seeded_key(7, "id").alias("k"),
        hashing.seeded_uniform(7, "id").alias("u"),
        hashing.seeded_int(7, 5, "id").alias("i"),
    ).first()
    want = hashlib.md5(b"7:12345").hexdigest()
    assert row["k"] == want
    assert row["u"] == int(want[:8], 16) / 2**32 and 0.0 <= row["u"] < 1.0
    assert row["i"] == int(want[:8], 16) % 5


def test_ratios_are_ansi_safe(spark):
    df = spark.createDataFrame([(1, 0), (None, 2), (3, 4)], "a int, b int")
    got = [tuple(r) for r in df.select(numeric.safe_ratio("a", "b"), numeric.ratio_or_zero("a", "b")).collect()]
    assert got == [(None, 0.0), (None, 0.0), (0.75, 0.75)]
    assert [r[0] for r in spark.range(3).select(numeric.hard_label(F.col("id") / 2.0 + 0.0)).collect()] == [0, 0, 1]
