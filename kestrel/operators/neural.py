"""Feed-forward classifier with ReLU layers, trained by Adam with early stopping (ML-08).

Training is data-parallel.  A hash of a row's key says whether it is held out and, if
not, which mini-batch of the epoch it belongs to, so what a step sees does not depend on
how rows are stored.  In a step every task turns its rows of the batch into one partial
gradient; partial gradients are added up in a tree of tasks (`tree_sum`), and the driver
holds nothing but parameters, their Adam state and one gradient.  Training stops when the
accuracy on the held-out rows has not risen for ``patience`` epochs and goes back to the
best parameters.

Rows are encoded once (`encoding.level_dictionary`, `encoding.scaling`) and written as sparse
rows by batch.  The fitted model carries the dictionary, which has a row for each level,
like the parameters, and encodes what it scores itself; unseen levels count as no level.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import encoding
from kestrel.session import scratch_dir

#: Layers, L2 penalty, step size, rows of a mini-batch if that makes no more than BATCHES of them, epochs, patience, least
#: rise that counts, share held out.
HIDDEN, PENALTY, RATE, ROWS, BATCHES, EPOCHS, PATIENCE, RISE, HELD_OUT = (64, 32), 1e-3, 1e-3, 200, 4, 400, 20, 1e-4, 0.15
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8
#: Partial gradients added up by one task; rows turned dense at once.
FAN, CHUNK = 16, 2048


def initial(sizes: Sequence[int], seed: int) -> np.ndarray:
    """Parameters drawn evenly within the bound of each layer's fan-in and fan-out, as one vector."""
    r, parts = np.random.default_rng(seed), []
    for a, b in zip(sizes, sizes[1:]):
        bound = math.sqrt(6.0 / (a + b))
        parts += [r.uniform(-bound, bound, a * b), r.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def layers(flat: np.ndarray, sizes: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Weights and biases of each layer, as views."""
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


def forward(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray) -> list[np.ndarray]:
    """Activations of all layers; the last is the log odds."""
    out = [x]
    stack = layers(flat, sizes)
    for i, (w, b) in enumerate(stack):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0.0) if i + 1 < len(stack) else z)
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))


def partial_gradient(flat: np.ndarray, sizes: Sequence[int], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Sum over rows of the gradient of the log loss, without the penalty, and of the loss."""
    acts = forward(flat, sizes, x)
    z = acts[-1][:, 0]
    loss = float((np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))).sum())
    delta, grad = (_sigmoid(z) - y)[:, None], []
    stack = layers(flat, sizes)
    for i in range(len(stack) - 1, -1, -1):
        grad.append(np.concatenate([(acts[i].T @ delta).reshape(-1), delta.sum(0)]))
        if i:
            delta = (delta @ stack[i][0].T) * (acts[i] > 0)
    return np.concatenate(grad[::-1]), loss


def penalised(grad: np.ndarray, flat: np.ndarray, sizes: Sequence[int], n: float, penalty: float) -> np.ndarray:
    """Mean gradient of n rows with the L2 penalty on weights, biases left alone."""
    mask = np.concatenate([np.concatenate([np.ones(a * b), np.zeros(b)]) for a, b in zip(sizes, sizes[1:])])
    return (grad + penalty * mask * flat) / max(n, 1.0)


class Adam:
    """First and second moments of the gradient, and the step that they give."""

    def __init__(self, size: int, rate: float):
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, grad: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = BETA1 * self.m + (1 - BETA1) * grad
        self.v = BETA2 * self.v + (1 - BETA2) * grad * grad
        rate = self.rate * math.sqrt(1 - BETA2 ** self.t) / (1 - BETA1 ** self.t)
        return -rate * self.m / (np.sqrt(self.v) + EPSILON)


@dataclass
class NetworkModel:
    """A fitted network: its encoder, parameters and how training went."""
    categorical: list[str]
    numeric: list[str]
    columns: dict[str, dict[str, int]]           # feature -> level -> column
    scales: dict[str, tuple[int, float, float]]  # feature -> column, mean, scale
    sizes: list[int]
    params: np.ndarray
    losses: list[float] = field(default_factory=list)
    accuracies: list[float] = field(default_factory=list)

    def sparse(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of all non-zero entries of a batch that has the feature columns."""
        rows, cols, values = [], [], []
        for c in self.categorical:
            table = self.columns[c]
            at = np.array([table.get(v, -1) for v in batch.column(batch.schema.get_field_index(c)).cast(pa.string()).to_pylist()], dtype=np.int64)
            some = np.flatnonzero(at >= 0)
            rows.append(some)
            cols.append(at[some])
            values.append(np.ones(len(some)))
        for c in self.numeric:
            col, mean, scale = self.scales[c]
            v = batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).to_numpy(zero_copy_only=False)
            some = np.flatnonzero(np.isfinite(v))
            rows.append(some)
            cols.append(np.full(len(some), col))
            values.append((v[some] - mean) / scale)
        return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)

    def probabilities(self, batch: pa.RecordBatch) -> np.ndarray:
        out = np.empty(batch.num_rows)
        for lo in range(0, batch.num_rows, CHUNK):
            part = batch.slice(lo, CHUNK)
            x = np.zeros((part.num_rows, self.sizes[0]))
            r, c, v = self.sparse(part)
            x[r, c] = v
            out[lo:lo + part.num_rows] = _sigmoid(forward(self.params, self.sizes, x)[-1][:, 0])
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """The rows with ``probability``: of no and of yes."""
        sent = df.sparkSession.sparkContext.broadcast(self)
        schema = T.StructType([*df.schema.fields, T.StructField("probability", T.ArrayType(T.DoubleType()))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                p = sent.value.probabilities(b)
                both = pa.array(np.stack([1 - p, p], axis=1).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*b.columns, both], [*b.schema.names, "probability"])
        return df.mapInArrow(run, schema)

    def write(self, spark: SparkSession, folder: str) -> None:
        """Store the model as one line of JSON; numbers keep all their digits."""
        said = {**self.__dict__, "params": self.params.tolist()}
        spark.createDataFrame([(json.dumps(said),)], "value string").coalesce(1).write.text(folder)

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> NetworkModel:
        said = json.loads(spark.read.text(folder).first()["value"])
        said["params"] = np.array(said["params"])
        said["scales"] = {k: (int(v[0]), v[1], v[2]) for k, v in said["scales"].items()}
        return cls(**said)


def tree_sum(parts: DataFrame, tasks: int, fan: int = FAN) -> DataFrame:
    """Add up rows of (slot, vector: doubles as bytes) in a tree, until ``fan`` are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slot = None, 0
        for b in batches:
            for s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = np.frombuffer(v, dtype="<f8")
                total, slot = (v.copy(), s) if total is None else (total + v, min(slot, s))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slot", "vector"])
    while tasks > fan:
        tasks = -(-tasks // fan)
        parts = parts.repartition(tasks, (F.col("slot") % tasks)).mapInArrow(run, "slot int, vector binary")
    return parts


def _stored(model: NetworkModel, train: DataFrame, key: str, label: str, batches: int, held_out: float, seed: int) -> str:
    """Encode the rows and write them by batch; batch -1 is held out."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    batch = F.when(unit < held_out, F.lit(-1)).otherwise(F.pmod(F.xxhash64(F.lit(seed + 1), F.col(key)), F.lit(batches)))
    sent = train.sparkSession.sparkContext.broadcast(model)
    src = train.select(batch.cast("int").alias("__batch"), F.col(label).cast("double").alias("__y"), *model.categorical, *model.numeric)

    def run(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in groups:
            r, c, v = sent.value.sparse(b)
            order = np.argsort(r, kind="stable")
            ends = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=b.num_rows))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(c[order].astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(v[order]))], ["batch", "y", "at", "value"])
    folder = f"{scratch_dir(train.sparkSession, 'network')}/rows"
    src.mapInArrow(run, "batch int, y double, at array<int>, value array<double>").write.partitionBy("batch").parquet(folder)
    return folder


def _summed(rows: DataFrame, tasks: int, params: np.ndarray, sizes: Sequence[int]) -> np.ndarray:
    """Gradient, loss and count of the rows, which are in so many tasks, and right answers and count of those held out."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(params)

    def run(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        flat, total = sent.value, np.zeros(len(sent.value) + 4)
        for b in groups:
            for lo in range(0, b.num_rows, CHUNK):
                part = b.slice(lo, CHUNK)
                ys = part.column(0).to_numpy()
                at, value = part.column(1), part.column(2)
                x = np.zeros((part.num_rows, sizes[0]))
                row = np.repeat(np.arange(part.num_rows), np.diff(at.offsets.to_numpy()))
                x[row, at.flatten().to_numpy()] = value.flatten().to_numpy()
                held = part.column(3).to_numpy() < 0
                if held.any():
                    z = forward(flat, sizes, x[held])[-1][:, 0]
                    total[-2:] += ((z > 0) == (ys[held] > 0.5)).sum(), held.sum()
                if not held.all():
                    grad, loss = partial_gradient(flat, sizes, x[~held], ys[~held])
                    total[:-4] += grad
                    total[-4:-2] += loss, (~held).sum()
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["slot", "vector"])
    parts = rows.select("y", "at", "value", "batch").mapInArrow(run, "slot int, vector binary")
    found = [np.frombuffer(r["vector"], dtype="<f8") for r in sorted(tree_sum(parts, tasks).collect(), key=lambda r: r["slot"])]
    sent.unpersist()
    return np.sum(found, axis=0) if found else np.zeros(len(params) + 4)


class _Stop:
    """The best parameters so far, and whether the held-out accuracy has stood still for ``patience`` epochs."""

    def __init__(self, patience: int, rise: float):
        self.patience, self.rise = patience, rise
        self.best, self.waited, self.params, self.accuracies = -math.inf, 0, np.zeros(0), []

    def after(self, right: float, n: float, params: np.ndarray) -> bool:
        if not n:                       # nothing is held out: the last parameters count
            self.params = params.copy()
            return False
        accuracy = float(right / n)
        self.accuracies.append(accuracy)
        self.waited = 0 if accuracy > self.best + self.rise else self.waited + 1
        if accuracy > self.best:
            self.best, self.params = accuracy, params.copy()
        return self.waited >= self.patience


def fit(train: DataFrame, categorical: Sequence[str], numeric: Sequence[str], key: str, label: str, hidden: Sequence[int] = HIDDEN,
        penalty: float = PENALTY, rate: float = RATE, rows: int = ROWS, most_batches: int = BATCHES, epochs: int = EPOCHS,
        patience: int = PATIENCE, rise: float = RISE, held_out: float = HELD_OUT, seed: int = 42) -> NetworkModel:
    """Train on all rows of ``train``; ``key`` names a row."""
    spark = train.sparkSession
    terms = sorted((r["feature"], r["level"]) for r in encoding.level_dictionary(train, categorical).collect())     # a row for each parameter row
    columns: dict[str, dict[str, int]] = {c: {} for c in categorical}
    for at, (feature, level) in enumerate(terms):
        columns[feature][level] = at
    known = {r["feature"]: r for r in encoding.scaling(train, numeric).collect()}
    scales = {c: (len(terms) + i, known[c]["mean"] or 0.0, known[c]["scale"]) for i, c in enumerate(numeric)}
    sizes = [len(terms) + len(numeric), *hidden, 1]
    model = NetworkModel(list(categorical), list(numeric), columns, scales, sizes, initial(sizes, seed))
    batches = int(min(most_batches, max(1, train.count() // rows)))
    folder = _stored(model, train, key, label, batches, held_out, seed)
    stored = spark.read.schema("y double, at array<int>, value array<double>, batch int").parquet(folder)
    # the held-out rows are judged in the same pass as the first batch, before its step
    tables = [stored.where(F.col("batch") == b) if b else stored.where(F.col("batch").isin(0, -1)) for b in range(batches)]
    tasks = [t.rdd.getNumPartitions() for t in tables]
    params, adam, stop = model.params.copy(), Adam(len(model.params), rate), _Stop(patience, rise)
    for epoch in range(epochs + 1):
        loss = n = 0.0
        for b, table in enumerate(tables):
            total = _summed(table, tasks[b], params, sizes)
            if b == 0 and epoch:        # what the epochs before have reached
                over = stop.after(total[-2], total[-1], params)
                if over or epoch == epochs:
                    model.params, model.accuracies = stop.params, stop.accuracies
                    return model
            loss, n = loss + total[-4], n + total[-3]
            params = params + adam.step(penalised(total[:-4], params, sizes, total[-3], penalty))
        model.losses.append(float(loss / max(n, 1.0)))
    raise AssertionError("epochs end inside the loop")
