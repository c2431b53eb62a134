"""The three batch jobs of the workflow, runnable from the command line.

``preprocess``  raw transactions (Parquet) -> feature table (gzip Parquet)
``split``       feature table -> train / validate / test header CSVs (id, features, label)
``train``       CSV splits -> seeded search, refit, run log, model registry

    python -m cardsight.plans.jobs preprocess --input raw/ --output features/
    python -m cardsight.plans.jobs split --input features/ --output splits/ --start 2018-07-25
    python -m cardsight.plans.jobs train --input splits/ --trials 100
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cardsight import schema as S
from cardsight.operators import features as feat
from cardsight.operators import models as md
from cardsight.operators import split as sp
from cardsight.sources import files
from cardsight.session import materialize

SPLITS = ("train", "validate", "test")
# The id goes along: samples are a function of (seed, id), not of file order.
SPLIT_COLUMNS = [S.TRANSACTION_ID, *S.FEATURE_COLUMNS, S.LABEL_COLUMN]
ROWS_PER_FILE = 2_000_000


def split_schema() -> T.StructType:
    """Declared schema of the split CSVs: the id, the features, the label."""
    types = {"IS_WKD": T.BooleanType(), "IS_NIGHT": T.BooleanType(), S.TX_FRAUD: T.IntegerType()}
    for c in S.FEATURE_COLUMNS:
        if "COUNT" in c:
            types[c] = T.LongType()
    types[S.TRANSACTION_ID] = T.LongType()
    return T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in SPLIT_COLUMNS])


def preprocess(spark: SparkSession, input_path: str, output_path: str, weekend: str = "reference",
               strategy: str = "block") -> str:
    """Read raw transactions, append the 14 features, write gzip Parquet."""
    raw = spark.read.parquet(input_path)
    missing = set(S.RAW_COLUMNS) - set(raw.columns)
    if missing:
        raise ValueError(f"raw table lacks columns {sorted(missing)}")
    out = feat.build_features(raw, weekend=weekend, strategy=strategy)
    # Day-partitioned output: the split's day filters prune whole folders.
    # Range partitioning on (day, time) keeps each task's files contiguous in
    # time, and the time key splits a heavy day over many tasks.
    # Its bounds take a pass of their own, so the features are written first.
    out = materialize(out)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-out.count() // ROWS_PER_FILE))
    laid_out = out.repartitionByRange(n, S.TX_TIME_DAYS, S.TX_DATETIME)
    return files.write_parquet(laid_out, spark, "features", compression="gzip", path=output_path,
                               partition_by=[S.TX_TIME_DAYS])


def split(spark: SparkSession, input_path: str, output_dir: str, start: str, outer_train: int = 21,
          inner_train: int = 7, delta_delay: int = 7, delta_test: int = 7) -> dict[str, str]:
    """Three-way prequential split written as header CSVs (rows in id order;
    id, features, label, no index column)."""
    features = spark.read.parquet(input_path)
    parts = dict(zip(SPLITS, sp.three_way_split(features, start, outer_train, inner_train, delta_delay, delta_test)))
    out = {}
    for name, part in parts.items():
        ordered = part.orderBy(S.TRANSACTION_ID).select(*SPLIT_COLUMNS)
        out[name] = files.write_csv(ordered, spark, name, path=os.path.join(output_dir, name))
    return out


def read_split(spark: SparkSession, split_dir: str, name: str) -> DataFrame:
    """A split CSV with its declared schema."""
    return files.read_csv(spark, os.path.join(split_dir, name), split_schema())


def train(spark: SparkSession, split_dir: str, study: str = "card_fraud", n_trials: int = 100,
          model_name: str = "card_fraud_gbt", space: dict | None = None) -> str:
    """Seeded search maximising validation recall, then refit with the best
    parameters, log the run and register the model; returns the run id."""
    tr = materialize(read_split(spark, split_dir, "train"))
    va = materialize(read_split(spark, split_dir, "validate"))
    trials = md.random_search(tr, va, study, n_trials, space or md.REFERENCE_SPACE)
    best = dict(md.best_trial(trials).first()["best_params"])
    return md.refit_and_register(tr, va, best, model_name, "gbt validation", source=split_dir)


def main(argv: list[str] | None = None) -> None:
    from cardsight import get_spark

    ap = argparse.ArgumentParser(prog="python -m cardsight.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("preprocess")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--weekend", default="reference", choices=["reference", "sat_sun"])
    s = sub.add_parser("split")
    s.add_argument("--input", required=True)
    s.add_argument("--output", required=True)
    s.add_argument("--start", required=True)
    s.add_argument("--outer-train", type=int, default=21)
    s.add_argument("--inner-train", type=int, default=7)
    s.add_argument("--delay", type=int, default=7)
    s.add_argument("--test", type=int, default=7)
    t = sub.add_parser("train")
    t.add_argument("--input", required=True)
    t.add_argument("--study", default="card_fraud")
    t.add_argument("--trials", type=int, default=100)
    t.add_argument("--model-name", default="card_fraud_gbt")
    args = ap.parse_args(argv)
    spark = get_spark()
    if args.job == "preprocess":
        print(preprocess(spark, args.input, args.output, args.weekend))
    elif args.job == "split":
        print(split(spark, args.input, args.output, args.start, args.outer_train, args.inner_train, args.delay,
                    args.test))
    else:
        print(train(spark, args.input, args.study, args.trials, args.model_name))


if __name__ == "__main__":
    main()
