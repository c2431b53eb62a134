"""Feed-forward nets: sigmoid layers and a softmax on top, fitted by L-BFGS.

Net, first weights, loss, blocks, steps and stopping rule are those of Spark ML's
``MultilayerPerceptronClassifier``, whose products of a pass run on the JVM. Here
each pass over the rows (one loss and its gradient) is a Spark job whose tasks
multiply many rows at once with numpy; sums come together in a tree, and the
driver holds a few vectors of the net's size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardsight.session import materialize, ship_package

#: Rows of a block: the loss is the mean over blocks of the mean over their rows, as in Spark.
BLOCK_ROWS = 128
#: Rows stored together, multiplied at once, and rows of a task.
CHUNK_ROWS = 64 * BLOCK_ROWS
SLICE_ROWS = 8 * BLOCK_ROWS
TASK_ROWS = 2 * CHUNK_ROWS

#: Up to so many rows Spark's own estimator fits the net; both fits differ in rounding only.
SMALL_ROWS = 8192

#: Steps that the search remembers, and the tolerance at which it stops.
MEMORY = 10
TOLERANCE = 1e-6


class Stuck(Exception):
    """No step along the search direction lowers the loss."""


class PerceptronModel:
    """Weights of a net over ``features`` vectors. ``transform`` adds ``score`` (the
    probability of label 1) and ``prediction`` (whether label 1 is the likelier)."""

    def __init__(self, layers: Sequence[int], weights: np.ndarray, history: Sequence[float] = ()):
        self.layers, self.weights, self.history = list(layers), np.asarray(weights, np.float64), list(history)

    def transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        layers, shared = self.layers, df.sparkSession.sparkContext.broadcast(self.weights)

        @F.pandas_udf("score double, prediction double")
        def scored(features: pd.Series) -> pd.DataFrame:
            x = np.stack(features.to_numpy()) if len(features) else np.empty((0, layers[0]))
            top = [_forward(_unpacked(shared.value, layers), x[at : at + SLICE_ROWS])[-1] for at in range(0, len(x), SLICE_ROWS)]
            z = np.concatenate(top) if top else np.empty((0, layers[-1]))
            return pd.DataFrame({"score": _softmax(z)[:, 1], "prediction": np.where(np.isnan(z).any(axis=1), 0, z.argmax(axis=1)).astype(float)})

        out = df.withColumn("_scored", scored(vector_to_array("features")))
        # Not a number comes back from pandas as null.
        known = F.coalesce(F.col("_scored")["score"], F.lit(math.nan))
        return out.withColumns({"score": known, "prediction": F.col("_scored")["prediction"]}).drop("_scored")

    def save(self, path: str) -> None:
        rows = [(self.layers, self.weights.tobytes(), self.history)]
        SparkSession.active().createDataFrame(rows, self.SCHEMA).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, path: str) -> PerceptronModel:
        row = SparkSession.active().read.schema(cls.SCHEMA).parquet(path).first()
        return cls(row["layers"], np.frombuffer(row["weights"]), row["history"])

    SCHEMA = "layers array<int>, weights binary, history array<double>"


# --------------------------------------------------------------------------- the net


def _unpacked(weights: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(matrix inputs x outputs, bias)`` of each layer: views of the vector."""
    out, at = [], 0
    for n_in, n_out in zip(layers, layers[1:]):
        out.append((weights[at : at + n_in * n_out].reshape(n_in, n_out), weights[at + n_in * n_out : at + (n_in + 1) * n_out]))
        at += (n_in + 1) * n_out
    return out


def _forward(net: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """``x``, each hidden layer's values and the top layer before its softmax."""
    values = [x]
    for i, (matrix, bias) in enumerate(net):
        z = values[-1] @ matrix
        z += bias
        if i < len(net) - 1:
            with np.errstate(over="ignore"):  # exp of a large number: the value is 0
                np.exp(np.negative(z, out=z), out=z)
            z += 1.0
            np.reciprocal(z, out=z)
        values.append(z)
    return values


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _add_slice(total: np.ndarray, weights: np.ndarray, layers: Sequence[int], x: np.ndarray, y: np.ndarray, share: np.ndarray) -> None:
    """Add to ``total`` the loss of the rows (first place) and its gradient, each row by its share."""
    net, sums = _unpacked(weights, layers), _unpacked(total[1:], layers)
    values = _forward(net, x)
    rows, top = np.arange(len(x)), values.pop()
    top -= top.max(axis=1, keepdims=True)
    total[0] += share @ (np.log(np.exp(top).sum(axis=1)) - top[rows, y])
    delta = _softmax(top)
    delta[rows, y] -= 1.0
    delta *= share[:, None]
    for (matrix, _), (matrix_sum, bias_sum), value in zip(net[::-1], sums[::-1], values[::-1]):
        matrix_sum += value.T @ delta
        bias_sum += delta.sum(axis=0)
        if value is not x:
            delta = delta @ matrix.T
            delta *= value
            delta *= np.subtract(1.0, value, out=value)


# --------------------------------------------------------------------------- passes over the rows


def _pack(n_in: int, n_out: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of a partition as chunks of whole blocks, only its last block may be short."""

    def chunk(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"x": x.tobytes(), "y": y.astype(np.int32).tobytes(), "n": len(y)}])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y = np.empty((0, n_in)), np.empty(0)
        for batch in batches:
            flat = batch.column("features").flatten().to_numpy(zero_copy_only=False)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            if len(flat) != n_in * len(labels) or not np.isfinite(flat.astype(np.float64)).all():
                raise ValueError(f"every row must have {n_in} finite features")
            if not np.isin(labels.astype(np.float64), np.arange(n_out)).all():
                raise ValueError(f"labels must be whole numbers from 0 to {n_out - 1}")
            x, y = np.concatenate([x, flat.reshape(-1, n_in)]), np.concatenate([y, labels])
            while len(y) >= CHUNK_ROWS:
                yield chunk(x[:CHUNK_ROWS], y[:CHUNK_ROWS])
                x, y = x[CHUNK_ROWS:], y[CHUNK_ROWS:]
        if len(y):
            yield chunk(x, y)

    return pack


def _pass(weights, layers: Sequence[int]) -> Callable[[Iterator], Iterator[np.ndarray]]:
    """Sums of loss and gradient over the blocks of a partition, for broadcast weights."""

    def partial(chunks: Iterator) -> Iterator[np.ndarray]:
        total = None
        for packed_x, packed_y in chunks:
            x, y = np.frombuffer(packed_x).reshape(-1, layers[0]), np.frombuffer(packed_y, np.int32)
            total = np.zeros(len(weights.value) + 1) if total is None else total
            whole = len(y) - len(y) % BLOCK_ROWS
            share = np.where(np.arange(len(y)) < whole, 1.0 / BLOCK_ROWS, 1.0 / max(1, len(y) - whole))
            for at in range(0, len(y), SLICE_ROWS):
                part = slice(at, at + SLICE_ROWS)
                _add_slice(total, weights.value, layers, x[part], y[part], share[part])
        if total is not None:
            yield total

    return partial


def fit_perceptron(rows: DataFrame, layers: Sequence[int], max_iter: int, seed: int) -> PerceptronModel:
    """Fit a net on ``features`` vectors and whole ``label``s, all rows in every pass."""
    spark, layers = rows.sparkSession, [int(n) for n in layers]
    ship_package(spark)
    if rows.count() <= SMALL_ROWS:
        fitted = MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed).fit(rows)
        return PerceptronModel(layers, fitted.weights.toArray(), fitted.summary().objectiveHistory)
    # Spark's seeded start: its own estimator without a step, on a single row.
    start = spark.createDataFrame([(Vectors.dense([0.0] * layers[0]), 0.0)], ["features", "label"])
    weights = MultilayerPerceptronClassifier(layers=layers, maxIter=0, seed=seed).fit(start).weights.toArray()
    plain = rows.select(vector_to_array("features").alias("features"), F.col("label").cast("double").alias("label"))
    chunks = materialize(plain.mapInArrow(_pack(layers[0], layers[-1]), "x binary, y binary, n long"))
    sizes = chunks.agg(F.sum("n").alias("n"), F.sum(F.ceil(F.col("n") / BLOCK_ROWS)).alias("blocks")).first()
    # Dealt out one by one, so that tasks are alike.
    tasks = -(-sizes["n"] // TASK_ROWS)
    dealt = chunks.rdd.zipWithIndex().map(lambda p: (p[1], (p[0]["x"], p[0]["y"]))).partitionBy(tasks, lambda i: i % tasks)
    dealt = dealt.values().persist(StorageLevel.MEMORY_AND_DISK)

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        shared = spark.sparkContext.broadcast(w)
        total = dealt.mapPartitions(_pass(shared, layers)).treeReduce(np.add) / sizes["blocks"]
        shared.destroy()
        return float(total[0]), total[1:]

    model = PerceptronModel(layers, *minimize(loss, weights, max_iter))
    dealt.unpersist()
    return model


# --------------------------------------------------------------------------- L-BFGS


def _direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the inverse Hessian times the gradient; ``steps`` holds (step, change of gradient), the latest first."""
    d, pulls = gradient.copy(), []
    for s, g in steps:
        pulls.append((s @ d) / (s @ g))
        d -= pulls[-1] * g
    if steps:
        s, g = steps[0]
        d *= (s @ g) / (g @ g)
    for (s, g), pull in reversed([*zip(steps, pulls)]):
        d += (pull - (g @ d) / (s @ g)) * s
    return -d


def _between(a: tuple, b: tuple) -> float:
    """Where the cubic through two points (place, value, slope) is least, kept off both ends."""
    (ta, fa, ga), (tb, fb, gb) = sorted([a, b], key=lambda p: p[0])
    d1 = ga + gb - 3 * (fa - fb) / (ta - tb)
    inner = d1 * d1 - ga * gb
    d2 = math.sqrt(inner) if inner >= 0 else math.nan
    t = tb - (tb - ta) * (gb + d2 - d1) / (gb - ga + 2 * d2)
    low, high = ta + 0.1 * (tb - ta), ta + 0.9 * (tb - ta)
    return low if t < low else high if t > high else t


def _line_search(phi: Callable[[float], tuple], start: tuple, t: float, tries: int = 10) -> float:
    """A step that meets the strong Wolfe conditions; ``phi`` gives (place, value, slope)."""
    _, f0, g0 = start
    if g0 > 0:
        raise Stuck("not a direction of descent")
    enough = lambda p: p[1] <= f0 + 1e-4 * p[0] * g0
    flat = lambda p: abs(p[2]) <= 0.9 * abs(g0)

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(tries):
            p = phi(_between(low, high))
            if not enough(p) or p[1] >= low[1]:
                high = p
                continue
            if flat(p):
                return p[0]
            if p[2] * (high[0] - low[0]) >= 0:
                high = low
            low = p
        raise Stuck("no step found in the bracket")

    low = start
    for i in range(tries):
        p = phi(t)
        if not math.isfinite(p[1]):
            t /= 2.0
            continue
        if not enough(p) or (i > 0 and p[1] >= low[1]):
            return zoom(low, p)
        if flat(p):
            return p[0]
        if p[2] >= 0:
            return zoom(p, low)
        low, t = p, t * 1.5
    raise Stuck("no step found")


def minimize(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int) -> tuple[np.ndarray, list[float]]:
    """Weights after at most ``max_iter`` steps of L-BFGS, and the losses from the first on."""
    value, gradient = loss(x)
    history, steps, first, failed = [value], [], abs(value), False
    recent = [math.inf]
    while len(history) <= max_iter and not np.linalg.norm(gradient) <= max(TOLERANCE * value, 1e-8):
        if len(recent) > 1 and abs(value - max(recent)) <= TOLERANCE * first:
            break
        seen: dict[float, tuple[float, np.ndarray]] = {}

        def phi(t: float) -> tuple[float, float, float]:
            seen.clear()  # a step taken is the last one tried
            seen[t] = loss(x + t * d)
            return t, seen[t][0], float(seen[t][1] @ d)

        try:
            d = _direction(gradient, steps)
            t = _line_search(phi, (0.0, value, float(gradient @ d)), 1.0 if len(history) > 1 else 1.0 / np.linalg.norm(d))
            if t * np.linalg.norm(gradient) < 1e-10:
                raise Stuck("the step is too small")
        except Stuck:
            if failed:
                break
            failed, steps = True, []  # once more, along the gradient
            continue
        failed = False
        new_value, new_gradient = seen[t]
        steps = [(t * d, new_gradient - gradient), *steps][:MEMORY]
        x, value, gradient = x + t * d, new_value, new_gradient
        history.append(value)
        recent = [*recent, value][-20:]
    return x, history
