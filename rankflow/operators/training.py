"""Data-parallel training of a softmax model.

The model is small (``classes * (width + 1)`` numbers) and lives on the driver. The data never
does: rows are numbered and written once, an epoch's order is arithmetic on their numbers, a step reads only the
ranges that hold its rows, and each task returns one vector of sums, added up by Spark. The same vector
carries the step's loss, hits and histogram of predicted probabilities.
"""

from __future__ import annotations

import copy
import re
import time
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from rankflow.functions.hashing import uniform
from rankflow.functions.vectors import linear_scores, list_matrix
from rankflow.operators.feed import Feed, feed, stripe_rows
from rankflow.operators.metrics import (
    PREDICTION, PREDICTION_BUCKETS, accuracy, append_metrics, prediction_buckets,
)
from rankflow.session import scratch
from rankflow.sources.files import publish, published, published_names, withdraw

# Defaults of the training programs.
BATCH_SIZE = 100
LEARNING_RATE = 0.01
EPOCHS = 6
MOMENTUM_DEFAULT = {"learning_rate": 0.02, "momentum": 0.9}
SAVE_EVERY = 100

# Tasks that sum the other tasks' vectors: as many vectors reach the driver.
FOLD_TASKS = 4
# A step with so few numbers for each of that many tasks is read by them alone: one stage, nothing to shuffle.
TASK_CELLS = 1 << 22

SUMS_SCHEMA = StructType([StructField("sums", ArrayType(DoubleType()))])
MODEL_SCHEMA = "step bigint, name string, row int, col int, value double"

Params = dict[str, np.ndarray]


def zero_params(width: int, classes: int) -> Params:
    return {"weights": np.zeros((width, classes)), "biases": np.zeros(classes)}


def normal(cell: Column, stddev: float, seed: int = 0) -> Column:
    """A normally distributed number for each integer ``cell``, the same in any order and on any machine."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(cell, 2 * seed)))
    return F.lit(float(stddev)) * radius * F.cos(F.lit(2 * np.pi) * uniform(cell, 2 * seed + 1))


def with_initial_weights(cells: DataFrame, row: str, col: str, classes: int, stddev: float = 0.01, seed: int = 0) -> DataFrame:
    """``cells`` of a weight matrix with a normally distributed ``value`` each."""
    return cells.withColumn("value", normal(F.col(row) * F.lit(classes) + F.col(col), stddev, seed))


def random_params(
    spark: SparkSession, width: int, classes: int, stddev: float = 0.01, bias: float = 0.0, seed: int = 0
) -> Params:
    """Normally distributed weights, drawn cell by cell in Spark, and constant biases."""
    cells = spark.range(width * classes).select(F.expr(f"id div {classes}").alias("row"), (F.col("id") % classes).alias("col"))
    drawn = with_initial_weights(cells, "row", "col", classes, stddev, seed).toArrow()
    weights = np.zeros((width, classes))
    weights[drawn.column("row").to_numpy(), drawn.column("col").to_numpy()] = drawn.column("value").to_numpy()
    return {"weights": weights, "biases": np.full(classes, float(bias))}


# --- gradients -------------------------------------------------------------------------------


@dataclass
class Sums:
    """Sums over labelled rows: gradients, loss, rows, hits, and rows per histogram bucket of all probabilities."""

    dw: np.ndarray
    db: np.ndarray
    loss: float
    rows: int
    correct: int
    histogram: np.ndarray

    @staticmethod
    def size(params: Params) -> int:
        return params["weights"].size + params["biases"].size + 3 + PREDICTION_BUCKETS

    @staticmethod
    def of(flat: np.ndarray, params: Params) -> Sums:
        weights, classes = params["weights"], len(params["biases"])
        tail = weights.size + classes
        return Sums(
            flat[: weights.size].reshape(weights.shape), flat[weights.size : tail], float(flat[tail]),
            int(flat[tail + 1]), int(flat[tail + 2]), flat[tail + 3 :].astype(np.int64),
        )

    def mean(self) -> Params:
        if not self.rows:
            raise ValueError("a training step has no rows")
        return {"weights": self.dw / self.rows, "biases": self.db / self.rows}


def _block_sums(x: np.ndarray, labels: np.ndarray, w: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The flat sums of one block of rows: those with a label of the model."""
    known = (labels >= 0) & (labels < len(b))
    x, labels = x[known], labels[known]
    scores = x @ w + b
    rows = np.arange(len(labels))
    hits = int((scores.argmax(axis=1) == labels).sum()) if len(labels) else 0
    scores -= scores.max(axis=1, keepdims=True, initial=-np.inf)
    log_p = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    loss = -log_p[rows, labels].sum()
    delta = np.exp(log_p)
    histogram = np.bincount(prediction_buckets(delta.ravel()), minlength=PREDICTION_BUCKETS)
    delta[rows, labels] -= 1.0
    return np.concatenate([(x.T @ delta).ravel(), delta.sum(axis=0), [loss, len(labels), hits], histogram])


def _labels(column: pa.Array) -> np.ndarray:
    """Labels as integers; a null is no label."""
    return pc.fill_null(column.cast(pa.int64()), -1).to_numpy(zero_copy_only=False)


def partial_sums(df: DataFrame, models: list[Params], features: str, label: str, tag: str | None = None) -> DataFrame:
    """``sums`` per task: the flat sums of every model, one after the other.

    Without a ``tag`` every model sees all rows; else a row's tag is the number of the only model that sees it.
    """
    width = models[0]["weights"].shape[0]
    sizes = [Sums.size(model) for model in models]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen = [np.zeros(size) for size in sizes], False
        for batch in batches:
            if not batch.num_rows:
                continue
            x, labels, seen = list_matrix(batch.column(0), width), _labels(batch.column(1)), True
            tags = batch.column(2).to_numpy() if tag is not None else None
            for i, model in enumerate(models):
                own = slice(None) if tags is None else tags == i
                if tags is None or own.any():
                    sums[i] += _block_sums(x[own], labels[own], model["weights"], model["biases"])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(sums).tolist()])], names=["sums"])

    named = [features, label] + ([tag] if tag is not None else [])
    return df.select(*named).mapInArrow(fold, SUMS_SCHEMA)


def step_sums(
    df: DataFrame, models: list[Params], features: str = "features", label: str = "label", tag: str | None = None,
    tasks: int | None = None,
) -> list[Sums]:
    """The sums of every model over all rows, in one job.

    With ``tasks`` that many tasks read the rows and send their vectors to the driver, in one stage. Without it, rows are
    read by as many tasks as they need, whose vectors ``FOLD_TASKS`` others add up first, so that a few vectors
    reach the driver however many tasks there are.
    """
    sizes = [Sums.size(model) for model in models]
    size = sum(sizes)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                total, seen = total + list_matrix(batch.column(0), size).sum(axis=0), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], names=["sums"])

    parts = partial_sums(df if tasks is None else df.coalesce(tasks), models, features, label, tag)
    if tasks is None:
        parts = parts.repartition(FOLD_TASKS).mapInArrow(fold, SUMS_SCHEMA)
    total = np.zeros(size)
    for row in parts.toArrow().column(0).to_pylist():
        total += np.asarray(row)
    cuts = np.cumsum([0, *sizes])
    return [Sums.of(total[low:high], model) for low, high, model in zip(cuts, cuts[1:], models)]


def step_tasks(rows: int, params: Params) -> int | None:
    """How many tasks read a step of so many rows; None beyond ``FOLD_TASKS``."""
    tasks = -(-rows * params["weights"].shape[0] // TASK_CELLS)
    return max(1, tasks) if tasks <= FOLD_TASKS else None


def mean_gradient(
    df: DataFrame,
    params: Params,
    features: str = "features",
    label: str = "label",
    tasks: int | None = None,
) -> tuple[Params, float, int]:
    """Mean gradient, mean loss and count of the labelled rows; for ``tasks`` see :func:`step_sums`."""
    (sums,) = step_sums(df, [params], features, label, tasks=tasks)
    return sums.mean(), sums.loss / sums.rows, sums.rows


# --- optimizers ------------------------------------------------------------------------------


@dataclass
class GradientDescent:
    learning_rate: float | Callable[[int], float] = LEARNING_RATE

    def update(self, params: Params, grads: Params, step: int) -> Params:
        rate = _at(self.learning_rate, step)
        return {name: value - rate * grads[name] for name, value in params.items()}


@dataclass
class Momentum:
    """Momentum whose rates are picked per variable by exact name, else first matching pattern."""

    groups: dict[str, dict] = field(default_factory=dict)
    nesterov: bool = False
    velocity: Params = field(default_factory=dict)

    def rates(self, name: str) -> dict:
        groups = {**self.groups}
        groups.setdefault("default", MOMENTUM_DEFAULT)
        if name in groups:
            return groups[name]
        hits = (group for pattern, group in groups.items() if re.search(pattern, name))
        return next(hits, groups["default"])

    def update(self, params: Params, grads: Params, step: int) -> Params:
        moved = {}
        for name, value in params.items():
            group = self.rates(name)
            rate, momentum = _at(group["learning_rate"], step), _at(group["momentum"], step)
            speed = momentum * self.velocity.get(name, np.zeros_like(value)) + grads[name]
            self.velocity[name] = speed
            moved[name] = value - rate * (grads[name] + momentum * speed if self.nesterov else speed)
        return moved


def _at(setting: float | Callable[[int], float], step: int) -> float:
    return setting(step) if callable(setting) else setting


# --- training loops --------------------------------------------------------------------------


@dataclass
class Run:
    """A trained model, its metrics (rows of ``METRICS_SCHEMA``) and last velocity."""

    params: Params
    metrics: list[tuple]
    steps: int
    velocity: Params = field(default_factory=dict)


class Learner:
    """A model on its way: what a step's sums change, and the metrics they leave."""

    def __init__(self, params: Params, optimizer, weight_decay: float, run: str, step: int, batch: int = 0):
        # A copy: velocity belongs to this run, not to the caller's object.
        self.params, self.optimizer = params, copy.deepcopy(optimizer) if optimizer else GradientDescent()
        self.weight_decay, self.run, self.step, self.batch = weight_decay, run, step, batch
        self.metrics: list[tuple] = []
        self.flushed = 0
        self.started = time.monotonic()

    def note(self, epoch: int, name: str, value: float, bucket: int | None = None, step: int | None = None) -> None:
        step = self.step if step is None else step
        self.metrics.append((self.run, step, epoch, name, float(value), time.monotonic() - self.started, bucket))

    def update(self, sums: Sums, at: Params, epoch: int) -> None:
        """One step by the gradient that was taken at the model ``at``."""
        grads, loss = sums.mean(), sums.loss / sums.rows
        if self.weight_decay:
            loss += self.weight_decay * float((at["weights"] ** 2).sum()) / 2
            grads["weights"] = grads["weights"] + self.weight_decay * at["weights"]
        self.note(epoch, "loss", loss)
        self.note(epoch, "accuracy", sums.correct / sums.rows)
        for bucket in np.flatnonzero(sums.histogram):
            self.note(epoch, PREDICTION, sums.histogram[bucket], int(bucket))
        self.params = self.optimizer.update(self.params, grads, self.step)
        self.step += 1

    def end_epoch(self, spark: SparkSession, epoch: int, test: DataFrame | None, metrics_path: str | None) -> None:
        if test is not None:
            self.note(epoch, "test_accuracy", evaluate(test, self.params), step=self.step - 1)
        if metrics_path is not None:
            append_metrics(spark, self.metrics[self.flushed :], metrics_path)
            self.flushed = len(self.metrics)


def train(
    df: DataFrame,
    id_col: str,
    params: Params,
    batch_size: int = BATCH_SIZE,
    epochs: int = EPOCHS,
    optimizer: GradientDescent | Momentum | None = None,
    workers: int = 1,
    shard_batches: bool = True,
    reshuffle: bool = True,
    weight_decay: float = 0.0,
    test: DataFrame | None = None,
    model_path: str | None = None,
    save_every: int = SAVE_EVERY,
    run: str = "train",
    first_step: int = 0,
    first_epoch: int = 0,
    velocity: Params | None = None,
    delay: int = 0,
    metrics_path: str | None = None,
    stripe: int | None = None,
) -> Run:
    """Mini-batch training; ``workers > 1`` is the synchronous data-parallel form.

    The gradients of equal batches are averaged before one update, which equals one step on
    the union of the batches: a step simply reads all their rows, and partitions play the
    workers. Choose ``batch_size`` so that a step is worth a Spark job. With ``shard_batches`` the workers take every
    n-th batch of one order, so a step is ``workers`` consecutive batches. Without it each worker walks all batches
    in an order of its own, and a step unites one batch of each.

    With a ``delay`` of ``d`` updates are stale: a step's gradient is taken at the model of ``d`` steps ago (the first one, in
    the first steps) and applied to the present one, always in the order of the steps. ``d + 1`` steps then need nothing
    from each other, and one job takes all their gradients.

    Every step leaves its loss, its accuracy and the histogram of its predicted probabilities, every epoch the accuracy on ``test``;
    with a ``metrics_path`` they are appended there at the end of each epoch.

    To resume, give the restored ``params`` and ``velocity``, and the ``first_step`` and ``first_epoch`` to go on
    with; steps, epochs and their orders of rows then follow those of the run before.
    """
    spark = df.sparkSession
    data = df.select(F.col(id_col).alias("id"), "features", "label")
    learner = Learner(params, optimizer, weight_decay, run, first_step)
    if velocity and isinstance(learner.optimizer, Momentum):
        learner.optimizer.velocity = {name: value.copy() for name, value in velocity.items()}
    # The models of the last steps, the present one last.
    past = deque([params], maxlen=delay + 1)
    with scratch(spark):
        rows = feed(data, "id", stripe or stripe_rows(batch_size))
        steps = rows.total // batch_size // (workers if shard_batches else 1)
        tasks = step_tasks(batch_size * workers * (delay + 1), params)
        for epoch in range(first_epoch, first_epoch + epochs):
            order = epoch if reshuffle else 0
            for first in range(0, steps, delay + 1):
                group = range(first, min(first + delay + 1, steps))
                # Before ``delay`` steps are done, the oldest model there is has to do.
                at = [past[max(0, len(past) - 1 - delay + i)] for i in range(len(group))]
                parts = [_step_rows(rows, step, order, batch_size, workers, shard_batches) for step in group]
                for step, model, sums in zip(group, at, _grouped_sums(parts, at, tasks)):
                    learner.update(sums, model, epoch)
                    past.append(learner.params)
                    last = epoch == first_epoch + epochs - 1 and step == steps - 1
                    if model_path and ((learner.step - 1) % save_every == 0 or last):
                        kept = getattr(learner.optimizer, "velocity", None)
                        save_model(spark, learner.params, learner.step - 1, model_path, kept)
            learner.end_epoch(spark, epoch, test, metrics_path)
    return Run(learner.params, learner.metrics, learner.step, getattr(learner.optimizer, "velocity", {}))


def _step_rows(rows: Feed, step: int, order: int, batch_size: int, workers: int, shard_batches: bool) -> DataFrame:
    if shard_batches:
        size = batch_size * workers
        return rows.slice(step * size, (step + 1) * size, order)
    first, *others = [
        rows.slice(step * batch_size, (step + 1) * batch_size, order * workers + worker) for worker in range(workers)
    ]
    for other in others:
        first = first.unionByName(other)
    return first


def _grouped_sums(parts: list[DataFrame], at: list[Params], tasks: int | None) -> list[Sums]:
    """The sums of several steps, each at a model of its own, in one job."""
    if len(parts) == 1:
        return step_sums(parts[0], at, tasks=tasks)
    tagged = [part.withColumn("_tag", F.lit(i)) for i, part in enumerate(parts)]
    united = tagged[0]
    for other in tagged[1:]:
        united = united.unionByName(other)
    return step_sums(united, at, tag="_tag", tasks=tasks)


def sweep(
    df: DataFrame,
    id_col: str,
    params: Params,
    batch_sizes: list[int],
    epochs: int = EPOCHS,
    optimizer: GradientDescent | Momentum | None = None,
    weight_decay: float = 0.0,
    test: DataFrame | None = None,
    metrics_path: str | None = None,
    stripe: int | None = None,
) -> list[Run]:
    """One run for each batch size, all in one pass over the rows of an epoch.

    Rows are read up to the next end of any model's batch, once for all models, whose sums travel in one vector. The runs
    equal those of :func:`train` with the same ``stripe``.
    """
    spark = df.sparkSession
    data = df.select(F.col(id_col).alias("id"), "features", "label")
    learners = [Learner(params, optimizer, weight_decay, f"batch_{size}", 0, size) for size in batch_sizes]
    with scratch(spark):
        rows = feed(data, "id", stripe or stripe_rows(*batch_sizes))
        ends = sorted({end for size in batch_sizes for end in range(size, rows.total + 1, size)})
        for epoch in range(epochs):
            held: list[Sums | None] = [None] * len(learners)
            for low, high in zip([0, *ends], ends):
                going = [i for i, learner in enumerate(learners) if high <= rows.total // learner.batch * learner.batch]
                models = [learners[i].params for i in going]
                sums = step_sums(rows.slice(low, high, epoch), models, tasks=step_tasks(high - low, params))
                for i, own in zip(going, sums):
                    held[i] = own if held[i] is None else _added(held[i], own)
                    if high % learners[i].batch == 0:
                        learners[i].update(held[i], learners[i].params, epoch)
                        held[i] = None
            for learner in learners:
                learner.end_epoch(spark, epoch, test, metrics_path)
    return [
        Run(learner.params, learner.metrics, learner.step, getattr(learner.optimizer, "velocity", {})) for learner in learners
    ]


def _added(a: Sums, b: Sums) -> Sums:
    return Sums(*(getattr(a, name) + getattr(b, name) for name in ("dw", "db", "loss", "rows", "correct", "histogram")))


def train_local(
    df: DataFrame,
    id_col: str,
    params: Params,
    batch_size: int = BATCH_SIZE,
    epochs: int = EPOCHS,
    learning_rate: float = LEARNING_RATE,
    workers: int | None = None,
    test: DataFrame | None = None,
    run: str = "local",
    stripe: int | None = None,
) -> Run:
    """Workers step on their own batches and the models are averaged after every epoch.

    Batch ``b`` goes to worker ``b mod workers``; there are as many workers as the cluster has cores unless given. A
    task streams its batches in order and holds one Arrow block at a time, however large a batch, so an epoch is one job whatever
    the number of steps.
    """
    spark = df.sparkSession
    data = df.select(F.col(id_col).alias("id"), "features", "label")
    workers = workers or spark.sparkContext.defaultParallelism
    learner = Learner(params, None, 0.0, run, 0)
    with scratch(spark):
        rows = feed(data, "id", stripe or stripe_rows(batch_size))
        batches = rows.total // batch_size
        for epoch in range(epochs):
            placed = rows.placed(epoch).withColumn("batch", F.floor(F.col("place") / batch_size))
            used = placed.filter(F.col("batch") < batches).withColumn(
                "worker", F.pmod(F.col("batch"), F.lit(workers)).cast("int")
            )
            streams = (
                used.repartitionById(workers, F.col("worker"))
                .sortWithinPartitions("batch", "place")
                .select("batch", "features", "label")
            )
            models = streams.mapInArrow(_walk(learner.params, learning_rate), "params array<double>")
            learner.params = _average(models, learner.params)
            learner.step += -(-batches // workers)
            learner.end_epoch(spark, epoch, test, None)
    return Run(learner.params, learner.metrics, learner.step)


def _walk(params: Params, rate: float):
    """Stochastic descent over a stream of rows in batch order."""
    start_w, start_b = params["weights"], params["biases"]

    def walk(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = {"weights": start_w.copy(), "biases": start_b.copy()}
        # The model stays the same within a batch, so its sums are added block by block.
        total, current, moved = np.zeros(Sums.size(model)), None, False

        def apply() -> None:
            nonlocal model, total, moved
            sums = Sums.of(total, model)
            if sums.rows:
                grads, moved = sums.mean(), True
                model = {name: value - rate * grads[name] for name, value in model.items()}
            total = np.zeros(len(total))

        for block in blocks:
            if not block.num_rows:
                continue
            batch = block.column(0).to_numpy(zero_copy_only=False)
            x = list_matrix(block.column(1), start_w.shape[0])
            labels = _labels(block.column(2))
            edges = np.flatnonzero(np.diff(batch)) + 1
            for low, high in zip([0, *edges], [*edges, len(batch)]):
                if batch[low] != current:
                    apply()
                current = batch[low]
                total += _block_sums(x[low:high], labels[low:high], model["weights"], model["biases"])
        apply()
        if moved:
            values = np.concatenate([model["weights"].ravel(), model["biases"]]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([values])], names=["params"])

    return walk


def _average(models: DataFrame, params: Params) -> Params:
    """Mean of the workers' models, cell by cell."""
    cells = models.select(F.posexplode("params").alias("cell", "value"))
    flat = np.concatenate([params["weights"].ravel(), params["biases"]])
    for cell, value in cells.groupBy("cell").agg(F.avg("value")).collect():
        flat[cell] = value
    size = params["weights"].size
    return {"weights": flat[:size].reshape(params["weights"].shape), "biases": flat[size:]}


# --- evaluation and model tables -------------------------------------------------------------


def scored(df: DataFrame, params: Params, features: str = "features") -> DataFrame:
    """``df`` with ``scores``."""
    scores = linear_scores(F.col(features), params["weights"], params["biases"])
    return df.withColumn("scores", scores)


def evaluate(df: DataFrame, params: Params) -> float:
    return accuracy(scored(df, params), "scores", "label").first()[0]


def model_rows(params: Params, step: int = 0, suffix: str = "") -> list[tuple]:
    rows = []
    for name, value in params.items():
        for (row, col), cell in np.ndenumerate(np.atleast_2d(value)):
            rows.append((step, name + suffix, row, col, float(cell)))
    return rows


def model_table(spark: SparkSession, params: Params, step: int = 0) -> DataFrame:
    """The model in long form ``(step, name, row, col, value)``."""
    return spark.createDataFrame(model_rows(params, step), MODEL_SCHEMA)


def save_model(
    spark: SparkSession, params: Params, step: int, path: str, velocity: Params | None = None
) -> None:
    """Save one checkpoint in a model table partitioned by step; a step that is saved again is replaced.

    Its manifest is written last, so a checkpoint that was written in part is never restored.
    """
    rows = model_rows(params, step) + model_rows(velocity or {}, step, "/velocity")
    table = spark.createDataFrame(rows, MODEL_SCHEMA)
    withdraw(spark, path, f"step={step}")
    table.coalesce(1).drop("step").write.mode("overwrite").parquet(f"{path}/step={step}")
    publish(spark, path, f"step={step}")


def latest_checkpoint(models: DataFrame) -> DataFrame:
    """The rows of the newest step. The newest step is one row, joined by broadcast."""
    newest = models.agg(F.max("step").alias("step"))
    return models.join(F.broadcast(newest), "step", "left_semi")


def restore_model(spark: SparkSession, path: str, velocity: bool = False) -> Params | None:
    """The newest saved model, or ``None`` where nothing was saved."""
    steps = [int(name.removeprefix("step=")) for name in published_names(spark, path) if name.startswith("step=")]
    files = None
    while steps and files is None:
        # A checkpoint whose files are gone or cut short does not count either.
        newest = steps.pop(steps.index(max(steps)))
        files = published(spark, path, f"step={newest}")
    if files is None:
        return None
    cells: dict[str, list] = {}
    for row in spark.read.parquet(*files).collect():
        cells.setdefault(row["name"], []).append((row["row"], row["col"], row["value"]))
    params = {}
    for name, entries in cells.items():
        if name.endswith("/velocity") != velocity:
            continue
        shape = max(e[0] for e in entries) + 1, max(e[1] for e in entries) + 1
        matrix = np.zeros(shape)
        for row, col, value in entries:
            matrix[row, col] = value
        name = name.removesuffix("/velocity")
        params[name] = matrix[0] if name == "biases" else matrix
    return params
