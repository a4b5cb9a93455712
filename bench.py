"""Time the registered queries and training at the recorded shape, and print one line of JSON.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the cores. Every query runs over its whole
tables and its result is consumed in full. ``value`` is the total of the headline queries; ``queries`` has all of them.
``training`` has steps and rows per second on rows of 784 cells, as the recorded runs have them, and accuracy per epoch.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rankflow.operators import training as R  # noqa: E402
from rankflow.operators.pagerank import pagerank  # noqa: E402
from rankflow.plans import graph, learning, tables  # noqa: E402
from rankflow.session import cut, local_session, scratch  # noqa: E402

HEADLINES = [
    "pagerank_naive",
    "pagerank_adjacency",
    "pagerank_hash_partition",
    "pagerank_range_partition",
    "pagerank_cached",
    "pagerank_hash_edges",
    "pagerank_keep_zero",
    "adjacency",
    "parse_edges",
    "sort_two_keys",
    "sort_positional",
    "epoch_batches",
    "shard_assign",
    "class_ids",
    "standardize_rows",
    "crop_or_pad",
    "histogram",
    "predict",
    "softmax_loss",
    "running_precision",
    "gradient_step",
    "train_minibatch",
    "train_sync",
    "train_local_sgd",
]

# The recorded runs: 784 cells a row, 550 batches of 100 rows an epoch.
WIDTH, SMALL_BATCH, LARGE_BATCH, ROWS = 784, 100, 10_000, 55_000
EPOCHS, STEPS = 5, 20


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def wide_rows(spark, sf_dir: str):
    """``(id, features, label)``: the vectors, repeated in turned copies until there are enough, and laid end to end."""
    vectors = tables.vectors(spark, sf_dir)
    turns = -(-ROWS // max(1, vectors.count()))
    turned = vectors.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    at = F.col("turn") % tables.WIDTH
    rotated = F.concat(F.slice("features", at + 1, tables.WIDTH), F.slice("features", F.lit(1), at))
    wide = F.slice(F.flatten(F.array_repeat(rotated, -(-WIDTH // tables.WIDTH))), 1, WIDTH)
    return turned.select((F.col("vec_id") * turns + F.col("turn")).alias("id"), wide.alias("features"), "label").limit(ROWS)


def timed_training(spark, sf_dir: str) -> tuple[dict, dict]:
    """Seconds and rates of training with small and large batches; each run writes its rows first, which is in its time."""
    seconds, rates = {}, {}
    with scratch(spark):
        rows = cut(wide_rows(spark, sf_dir), "wide")
        n_rows = rows.count()

        def note(name: str, started: float, steps: int, batch: int, metrics: list) -> None:
            seconds[name] = round(time.perf_counter() - started, 3)
            rates[name] = {
                "batch": batch, "steps": steps, "steps_per_s": round(steps / seconds[name], 2),
                "rows_per_s": round(steps * batch / seconds[name]),
                "accuracy_per_epoch": [round(m[4], 4) for m in metrics if m[3] == "test_accuracy"],
            }

        zero = R.zero_params(WIDTH, tables.CLASSES)
        for name, workers in (("train_local_784_1_worker", 1), ("train_local_784_all_workers", None)):
            started = time.perf_counter()
            run = R.train_local(rows, "id", zero, SMALL_BATCH, EPOCHS, workers=workers, test=rows)
            batches = n_rows // SMALL_BATCH * EPOCHS
            note(name, started, batches, SMALL_BATCH, run.metrics)
        for name, batch, delay in (
            ("train_784_batch_100", SMALL_BATCH, 0), ("train_784_batch_100_delay_9", SMALL_BATCH, 9),
            ("train_784_batch_10000", LARGE_BATCH, 0),
        ):
            started = time.perf_counter()
            some = rows.filter(F.col("id") < STEPS * batch) if STEPS * batch < n_rows else rows
            run = R.train(some, "id", zero, batch, 1, R.GradientDescent(0.01), delay=delay)
            note(name, started, run.steps, batch, run.metrics)
    return seconds, rates


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, app="bench", **{"spark.sql.shuffle.partitions": cpus})
    queries = {**graph.QUERIES, **learning.QUERIES}
    consume(pagerank(tables.trade_edges(spark, sf_dir), n_iter=1, partitioning="hash"))  # warm up
    seconds = {}
    for name in [*HEADLINES, *(name for name in queries if name not in HEADLINES)]:
        started = time.perf_counter()
        consume(queries[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    total = round(sum(seconds[name] for name in HEADLINES), 3)
    trained, rates = timed_training(spark, sf_dir)
    result = {
        "metric": "headline queries, total time",
        "value": total,
        "unit": "sec",
        "queries": {**seconds, **trained},
        "training": rates,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
