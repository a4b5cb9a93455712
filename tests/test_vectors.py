"""Vector expressions, metrics, labels and training."""

import math
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rankflow.functions import vectors as V
from rankflow.functions.permutation import Permutation
from rankflow.operators import feed as FD
from rankflow.operators import labels as L
from rankflow.operators import metrics as M
from rankflow.operators import training as R
from rankflow.session import shared_dir


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values))
    return row.select(column.alias("x")).first()["x"]


def rows_of(spark, n=240, width=5, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32)
    labels = (x @ rng.normal(size=(width, classes))).argmax(axis=1)
    data = [(i, x[i].tolist(), int(labels[i])) for i in range(n)]
    df = spark.createDataFrame(data, "id bigint, features array<float>, label int")
    return df, x.astype(float), labels


def plain_gradient(x, labels, w, b):
    z = x @ w + b
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    loss = -np.log(p[np.arange(len(x)), labels]).mean()
    d = p - np.eye(w.shape[1])[labels]
    return x.T @ d / len(x), d.mean(axis=0), loss


def shuffled(n, seed, stripe=1):
    from test_ordering import key_of

    base = sorted(range(n), key=lambda i: (key_of(i), i))
    stripes = Permutation.of(n // stripe).numbers(np.arange(n // stripe), seed)
    return [i for stripe_number in stripes for i in base[stripe_number * stripe : (stripe_number + 1) * stripe]]


def plain_run(x, labels, batches, rate, classes=3):
    w, b = np.zeros((x.shape[1], classes)), np.zeros(classes)
    for batch in batches:
        dw, db, _ = plain_gradient(x[batch], labels[batch], w, b)
        w, b = w - rate * dw, b - rate * db
    return w, b


# --- expressions -----------------------------------------------------------------------------


def test_softmax_survives_large_scores(spark):
    p = one(spark, V.softmax(F.col("z")), z=[1000.0, 1000.0, 0.0])
    assert p == pytest.approx([0.5, 0.5, 0.0])


def test_argmax_takes_the_first(spark):
    assert one(spark, V.argmax(F.col("z")), z=[1.0, 3.0, 3.0]) == 1


def test_one_hot(spark):
    assert one(spark, V.one_hot(F.col("k"), 4), k=2) == [0, 0, 1, 0]


@pytest.mark.parametrize(
    "p, expected", [([0.5, 0.5], math.log(2)), ([0.0, 1.0], math.nan), ([1.0, 0.0], math.nan)]
)
def test_unclipped_loss(spark, p, expected):
    label = 0
    got = one(spark, V.cross_entropy(F.col("p"), F.lit(label)), p=p)
    if p == [0.0, 1.0]:
        assert got == math.inf
    else:
        assert got == pytest.approx(expected, nan_ok=True)


def test_score_loss_is_stable(spark):
    got = one(spark, V.score_cross_entropy(F.col("z"), F.lit(1)), z=[1000.0, 0.0])
    assert got == pytest.approx(1000.0)


@pytest.mark.parametrize(
    "z, k, hit",
    [([3.0, 2.0, 1.0], 1, False), ([3.0, 2.0, 1.0], 2, True), ([2.0, 2.0, 2.0], 1, True),
     ([math.nan, 2.0, 1.0], 3, False), ([math.inf, 2.0, 1.0], 3, False)],
)
def test_top_k(spark, z, k, hit):
    assert one(spark, V.in_top_k(F.col("z"), F.lit(1), k), z=z) is hit


def test_standardize(spark):
    x = np.array([1.0, 2.0, 4.0, 9.0])
    assert one(spark, V.standardize(F.col("x")), x=x.tolist()) == pytest.approx(
        ((x - x.mean()) / x.std()).tolist()
    )
    assert one(spark, V.standardize(F.col("x")), x=[5.0] * 4) == [0.0] * 4


@pytest.mark.parametrize("shape", [(5, 3), (2, 7), (4, 4), (3, 5), (1, 8)])
def test_crop_or_pad(spark, shape):
    height, width, channels = 4, 4, 2
    image = np.arange(1.0, height * width * channels + 1).reshape(height, width, channels)
    target = np.zeros((*shape, channels))
    crops, pads = [], []
    for size, wanted in zip((height, width), shape):
        crops.append(max(-(wanted - size) // 2, 0))
        pads.append(max((wanted - size) // 2, 0))
    part = image[crops[0] : crops[0] + shape[0], crops[1] : crops[1] + shape[1]]
    target[pads[0] : pads[0] + part.shape[0], pads[1] : pads[1] + part.shape[1]] = part
    got = one(
        spark,
        V.crop_or_pad(F.col("x"), F.col("h"), F.col("w"), channels, *shape),
        x=image.ravel().tolist(), h=height, w=width,
    )
    assert got == target.ravel().tolist()


def test_staircase(spark):
    rates = [V.staircase_rate(step, 0.001, 250, 4, 300) for step in range(301)]
    drops = [step for step in range(1, 301) if rates[step] < rates[step - 1]]
    assert drops == [100, 200, 300] and rates[-1] == pytest.approx(0.001 / 250)
    got = spark.range(301).select(V.staircase_decay(F.col("id"), 0.001, 250, 4, 300)).collect()
    assert [row[0] for row in got] == pytest.approx(rates)


# --- metrics ---------------------------------------------------------------------------------


def test_summary_histogram_and_l2(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (0, 1, 2, 9)] + [("b", 10.0)], "m string, v double")
    summary = M.variable_summary(df, "v").first()
    assert tuple(summary) == pytest.approx((4.4, np.std([0, 1, 2, 9, 10]), 10.0, 0.0))
    counts = {r["bucket"]: r["rows"] for r in M.histogram(df, "v", 5).collect()}
    assert counts == {0: 2, 1: 1, 4: 2}
    same = M.histogram(df.filter("v = 9"), "v", 5).collect()
    assert [(r["bucket"], r["rows"]) for r in same] == [(0, 1)]
    assert M.histogram(df.filter("v < 0"), "v", 5).collect() == []
    assert dict(M.l2_terms(df, "m", "v", 0.5).collect()) == {"a": 0.25 * 86, "b": 25.0}


def test_running_precision(spark):
    data = [(i // 2, [0.0, 1.0], int(i % 3 > 0)) for i in range(8)]
    df = spark.createDataFrame(data, "batch bigint, scores array<double>, label int")
    got = sorted(tuple(r) for r in M.running_precision(df, "batch", "scores", "label").collect())
    hits = [int(i % 3 > 0) for i in range(8)]
    expected = [(b, sum(hits[2 * b : 2 * b + 2]), 2, sum(hits[: 2 * b + 2]) / (2 * b + 2)) for b in range(4)]
    assert got == expected


def test_reports(spark, fresh_dir):
    M.append_metrics(spark, [("r", 0, 0, "loss", 2.0, 1.0), ("r", 1, 0, "loss", 1.0, 3.0)], fresh_dir + "/m")
    M.append_metrics(spark, [("r", 2, 1, "loss", 0.5, 4.0)], fresh_dir + "/m")
    report = M.epoch_report(spark.read.parquet(fresh_dir + "/m"))
    assert sorted(tuple(r) for r in report.collect()) == [(0, 1.0, 3.0), (1, 0.5, 4.0)]
    seconds = spark.createDataFrame([(1.0,), (4.0,)], "s double")
    assert tuple(M.throughput(seconds, "s", 8).first()) == (5.0, 2.5)


# --- labels ----------------------------------------------------------------------------------


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_label_map_lines(spark):
    parsed = L.parse_label_map(lines(spark, "0:a:b", "", "1:c"))
    assert dict(parsed.collect()) == {0: "a:b", 1: "c"}
    assert sorted(r[0] for r in L.label_map_lines(parsed).collect()) == ["0:a:b", "1:c"]
    for bad in ("nothing", "x:y"):
        with pytest.raises(PySparkException):
            L.parse_label_map(lines(spark, bad)).collect()


def test_dictionary(spark):
    names = L.parse_names(lines(spark, "n2\tfox, red", " n1\tcat \n", "n3\tdog"))
    ids = spark.createDataFrame([("n1",), ("n3",)], "id string")
    assert dict(L.dictionary(ids, names).collect()) == {0: "background", 1: "cat", 2: "dog"}
    with pytest.raises(PySparkException):
        L.dictionary(spark.createDataFrame([("n9",)], "id string"), names).collect()


def test_dictionary_in_file_order(spark, fresh_dir):
    spark.createDataFrame([("n2",), ("n1",), ("n3",)], "value string").coalesce(1).write.text(f"{fresh_dir}/ids")
    names = spark.createDataFrame([("n1", "cat"), ("n2", "dog"), ("n3", "eel")], "id string, name string")
    built = dict(L.dictionary(L.read_ids(spark, f"{fresh_dir}/ids"), names).collect())
    assert built == {0: "background", 1: "dog", 2: "cat", 3: "eel"}


def test_rows_without_a_class_keep_their_row(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, c string")
    got = {r["id"]: r["class_id"] for r in L.with_class_id(df, "c").collect()}
    assert got == {1: 1, 2: None, 3: 0, 4: 1}


def test_unlabelled_rows_are_left_out_alike(spark):
    rows = [([1.0, 0.0], 0), ([0.0, 2.0], 1), ([5.0, 5.0], -1), ([3.0, 1.0], 2), ([4.0, 4.0], None)]
    df = spark.createDataFrame(rows, "features array<float>, label int")
    params = R.random_params(spark, 2, 2, stddev=1.0)
    some = R.mean_gradient(df, params)
    known = R.mean_gradient(df.filter("label IN (0, 1)"), params)
    assert some[2] == known[2] == 2 and some[1] == pytest.approx(known[1])
    assert some[0]["weights"] == pytest.approx(known[0]["weights"])
    scored = R.scored(df, params)
    hits = M.precision_at_k(scored, "scores", "label", 2).first()
    assert (hits["correct"], hits["rows"]) == (2, 2)
    assert M.mean_score_loss(scored, "scores", "label").first()[0] == pytest.approx(known[1])
    hit = scored.select(V.in_top_k(F.col("scores"), F.col("label"), 2)).collect()
    assert [r[0] for r in hit] == [True, True, False, False, False]


def test_a_sweep_does_not_carry_velocity_over(spark):
    df, _, _ = rows_of(spark)
    optimizer = R.Momentum({"default": {"learning_rate": 0.1, "momentum": 0.9}})
    both = R.sweep(df, "id", R.zero_params(5, 3), [60, 60], epochs=1, optimizer=optimizer)
    losses = [[m[4] for m in run.metrics if m[3] == "loss"] for run in both]
    assert losses[0] == pytest.approx(losses[1])
    assert optimizer.velocity == {}
    with pytest.raises(PySparkException):
        L.parse_names(lines(spark, "n1\ta\tb")).collect()


def test_class_ids(spark):
    df = spark.createDataFrame([("tulip", 1), ("daisy", 2), ("tulip", 3), ("rose", 4)], "c string, i int")
    assert dict(L.class_ids(df, "c").collect()) == {"daisy": 0, "rose": 1, "tulip": 2}
    assert {(r["i"], r["class_id"]) for r in L.with_class_id(df, "c").collect()} == {(1, 2), (2, 0), (3, 2), (4, 1)}


# --- training --------------------------------------------------------------------------------


def test_first_gradient_by_hand(spark):
    df = spark.createDataFrame([([1.0, 0.0], 0), ([0.0, 2.0], 1)], "features array<float>, label int")
    grads, loss, count = R.mean_gradient(df, R.zero_params(2, 2))
    assert loss == pytest.approx(math.log(2)) and count == 2
    assert grads["weights"].tolist() == [[-0.25, 0.25], [0.5, -0.5]]
    assert grads["biases"].tolist() == [0.0, 0.0]


def test_sums_of_many_tasks(spark):
    df, x, labels = rows_of(spark)
    start = R.random_params(spark, 5, 3, stddev=0.5)
    dw, db, loss = plain_gradient(x, labels, start["weights"], start["biases"])
    for tasks in (1, 9):
        grads, got, count = R.mean_gradient(df.repartition(tasks), start)
        assert count == 240 and got == pytest.approx(loss)
        assert grads["weights"] == pytest.approx(dw) and grads["biases"] == pytest.approx(db)


def test_gradient_of_an_empty_step(spark):
    df = spark.createDataFrame([], "features array<float>, label int")
    with pytest.raises(ValueError):
        R.mean_gradient(df, R.zero_params(2, 2))


def test_ragged_vectors_are_refused(spark):
    df = spark.createDataFrame([([1.0], 0), ([1.0, 2.0, 3.0], 1)], "features array<float>, label int")
    with pytest.raises(PySparkException):
        R.mean_gradient(df, R.zero_params(3, 2))


def test_minibatch_run(spark):
    df, x, labels = rows_of(spark)
    run = R.train(df, "id", R.zero_params(5, 3), batch_size=70, epochs=2, optimizer=R.GradientDescent(0.5), test=df)
    batches = [shuffled(240, epoch)[i * 70 : (i + 1) * 70] for epoch in range(2) for i in range(3)]
    w, b = plain_run(x, labels, batches, 0.5)
    assert run.steps == 6
    assert run.params["weights"] == pytest.approx(w) and run.params["biases"] == pytest.approx(b)
    accuracy = [m[4] for m in run.metrics if m[3] == "test_accuracy"]
    losses = [m[4] for m in run.metrics if m[3] == "loss"]
    assert accuracy[-1] > np.bincount(labels).max() / len(labels) and losses[-1] < losses[0]


def test_synchronous_steps_equal_steps_on_the_union(spark):
    df, x, labels = rows_of(spark)
    sync = R.train(df, "id", R.zero_params(5, 3), 30, 1, R.GradientDescent(0.5), workers=2)
    union = R.train(df, "id", R.zero_params(5, 3), 60, 1, R.GradientDescent(0.5))
    assert sync.params["weights"] == pytest.approx(union.params["weights"])
    assert sync.steps == union.steps == 4


def test_full_pass_workers_have_their_own_order(spark):
    df, x, labels = rows_of(spark)
    run = R.train(df, "id", R.zero_params(5, 3), 60, 1, R.GradientDescent(0.5), workers=2, shard_batches=False)
    batches = [
        shuffled(240, 0)[i * 60 : (i + 1) * 60] + shuffled(240, 1)[i * 60 : (i + 1) * 60] for i in range(4)
    ]
    w, _ = plain_run(x, labels, batches, 0.5)
    assert run.steps == 4 and run.params["weights"] == pytest.approx(w)


def test_local_descent_averages_workers(spark):
    df, x, labels = rows_of(spark)
    run = R.train_local(df, "id", R.zero_params(5, 3), 25, 1, 0.5, workers=3)
    order = shuffled(240, 0)
    batches = [order[i * 25 : (i + 1) * 25] for i in range(9)]
    models = [plain_run(x, labels, batches[worker::3], 0.5) for worker in range(3)]
    assert run.params["weights"] == pytest.approx(np.mean([m[0] for m in models], axis=0))
    assert run.params["biases"] == pytest.approx(np.mean([m[1] for m in models], axis=0))


def test_local_descent_with_small_arrow_batches(spark):
    df, x, labels = rows_of(spark)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "7")
    try:
        run = R.train_local(df, "id", R.zero_params(5, 3), 25, 1, 0.5, workers=1)
    finally:
        spark.conf.set(setting, before)
    order = shuffled(240, 0)
    w, _ = plain_run(x, labels, [order[i * 25 : (i + 1) * 25] for i in range(9)], 0.5)
    assert run.params["weights"] == pytest.approx(w)


@pytest.mark.parametrize("nesterov", [False, True])
def test_momentum(nesterov):
    groups = {"weights": {"learning_rate": lambda step: 0.1 / (step + 1), "momentum": 0.9}}
    optimizer = R.Momentum(groups, nesterov)
    params = {"weights": np.array([1.0]), "biases": np.array([2.0])}
    speed = {"weights": 0.0, "biases": 0.0}
    expected = {"weights": 1.0, "biases": 2.0}
    for step in range(3):
        grads = {"weights": np.array([0.5]), "biases": np.array([-1.0])}
        params = optimizer.update(params, grads, step)
        for name, rate in (("weights", 0.1 / (step + 1)), ("biases", 0.02)):
            g = grads[name][0]
            speed[name] = 0.9 * speed[name] + g
            expected[name] -= rate * (g + 0.9 * speed[name] if nesterov else speed[name])
    assert {k: v[0] for k, v in params.items()} == pytest.approx(expected)


def test_rates_by_exact_name_then_pattern_then_default():
    groups = {"fc": {"learning_rate": 1, "momentum": 0}, "fc1/weights": {"learning_rate": 2, "momentum": 0}}
    optimizer = R.Momentum(groups)
    assert optimizer.rates("fc1/weights")["learning_rate"] == 2
    assert optimizer.rates("fc2/weights")["learning_rate"] == 1
    assert optimizer.rates("conv")["learning_rate"] == 0.02


def test_weight_decay_counts_once(spark):
    df, x, labels = rows_of(spark)
    start = R.random_params(spark, 5, 3, stddev=0.5, bias=0.25, seed=7)
    assert start["biases"].tolist() == [0.25] * 3
    run = R.train(df, "id", start, 240, 1, R.GradientDescent(0.5), weight_decay=0.1)
    dw, db, loss = plain_gradient(x, labels, start["weights"], start["biases"])
    assert run.params["weights"] == pytest.approx(start["weights"] - 0.5 * (dw + 0.1 * start["weights"]))
    assert run.metrics[0][4] == pytest.approx(loss + 0.05 * (start["weights"] ** 2).sum())


def test_checkpoints(spark, fresh_dir):
    path = fresh_dir + "/model"
    assert R.restore_model(spark, path) is None
    df, _, _ = rows_of(spark)
    optimizer = R.Momentum({"default": {"learning_rate": 0.5, "momentum": 0.9}})
    run = R.train(df, "id", R.zero_params(5, 3), 60, 1, optimizer, model_path=path, save_every=3)
    steps = {row[0] for row in spark.read.parquet(path).select("step").distinct().collect()}
    assert steps == {0, 3}
    restored = R.restore_model(spark, path)
    assert restored["weights"] == pytest.approx(run.params["weights"])
    assert restored["biases"] == pytest.approx(run.params["biases"])
    # A later step that was written in part is not there.
    R.model_table(spark, R.zero_params(5, 3)).drop("step").write.parquet(path + "/step=9")
    assert R.restore_model(spark, path)["weights"] == pytest.approx(run.params["weights"])
    speed = R.restore_model(spark, path, velocity=True)
    assert speed["weights"] == pytest.approx(run.velocity["weights"])
    assert R.evaluate(df, restored) == pytest.approx(R.evaluate(df, run.params))


def test_half_a_run_and_its_rest_equal_the_whole(spark):
    df, _, _ = rows_of(spark)
    optimizer = R.Momentum({"default": {"learning_rate": 0.2, "momentum": 0.9}})
    whole = R.train(df, "id", R.zero_params(5, 3), 120, 2, optimizer)
    half = R.train(df, "id", R.zero_params(5, 3), 120, 1, optimizer)
    rest = R.train(df, "id", half.params, 120, 1, optimizer, first_step=half.steps, first_epoch=1, velocity=half.velocity)
    assert rest.steps == whole.steps
    assert rest.params["weights"] == pytest.approx(whole.params["weights"])


def test_training_leaves_no_epoch_tables(spark):
    df, _, _ = rows_of(spark, n=60)
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = set(folder.glob("rankflow-*"))
    R.train(df, "id", R.zero_params(5, 3), 20, 3)
    R.train_local(df, "id", R.zero_params(5, 3), 20, 2)
    R.sweep(df, "id", R.zero_params(5, 3), [20, 30], epochs=2)
    assert set(folder.glob("rankflow-*")) == before


@pytest.mark.parametrize("sizes", [[10, 30], [20, 50, 7]])
def test_a_sweep_in_one_pass_equals_separate_runs(spark, sizes):
    df, _, _ = rows_of(spark, n=62)
    optimizer = R.Momentum({"default": {"learning_rate": 0.3, "momentum": 0.5}})
    runs = R.sweep(df, "id", R.zero_params(5, 3), sizes, epochs=2, optimizer=optimizer, weight_decay=0.1, test=df)
    for size, run in zip(sizes, runs):
        alone = R.train(
            df, "id", R.zero_params(5, 3), size, 2, optimizer, weight_decay=0.1, test=df, run=f"batch_{size}", stripe=1
        )
        assert run.steps == alone.steps == 2 * (62 // size)
        assert run.params["weights"] == pytest.approx(alone.params["weights"])
        assert run.velocity["biases"] == pytest.approx(alone.velocity["biases"])
        assert [m[:4] for m in run.metrics] == [m[:4] for m in alone.metrics]
        assert [m[4] for m in run.metrics] == pytest.approx([m[4] for m in alone.metrics])


@pytest.mark.parametrize("delay", [1, 3, 50])
def test_delayed_updates_use_old_models_in_order(spark, delay):
    df, x, labels = rows_of(spark)
    run = R.train(df, "id", R.zero_params(5, 3), 40, 2, R.GradientDescent(0.5), delay=delay)
    models, step = [(np.zeros((5, 3)), np.zeros(3))], 0
    for epoch in range(2):
        order = shuffled(240, epoch)
        for i in range(6):
            own = order[i * 40 : (i + 1) * 40]
            dw, db, _ = plain_gradient(x[own], labels[own], *models[max(0, step - delay)])
            models.append((models[-1][0] - 0.5 * dw, models[-1][1] - 0.5 * db))
            step += 1
    assert run.steps == 12 and run.params["weights"] == pytest.approx(models[-1][0])
    assert run.params["biases"] == pytest.approx(models[-1][1])


def test_metrics_of_a_run_are_appended_each_epoch(spark, fresh_dir):
    df, x, labels = rows_of(spark)
    path = fresh_dir + "/metrics"
    run = R.train(df, "id", R.zero_params(5, 3), 80, 2, R.GradientDescent(0.5), test=df, metrics_path=path)
    table = spark.read.parquet(path)
    assert sorted(map(str, map(tuple, table.collect()))) == sorted(map(str, run.metrics))
    order = shuffled(240, 0)
    w, b = plain_run(x, labels, [order[:80]], 0.5)
    own = order[80:160]
    z = x[own] @ w + b
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    rows = {(m[3], m[6]): m[4] for m in run.metrics if m[1] == 1 and m[2] == 0}
    assert rows["accuracy", None] == pytest.approx((z.argmax(axis=1) == labels[own]).mean())
    counts = np.bincount(M.prediction_buckets(p.ravel()))
    assert {key[1]: value for key, value in rows.items() if key[0] == "prediction"} == {
        int(i): counts[i] for i in np.flatnonzero(counts)
    }
    assert sum(counts) == 240


def test_buckets_grow_and_hold_everything():
    p = np.array([0.0, 1e-300, 1e-12, 2e-12, 0.1, 0.5, 1.0])
    buckets = M.prediction_buckets(p)
    assert buckets[0] == buckets[1] == buckets[2] == 0 and buckets[-1] == M.PREDICTION_BUCKETS - 1
    assert (np.diff(buckets) >= 0).all() and buckets[3] == int(math.log(2) / math.log(1.1))


def test_epochs_share_one_table_and_read_few_ranges(spark):
    df, _, _ = rows_of(spark, n=1000)
    rows = FD.feed(df.select("id", "label"), "id", stripe=8)
    assert rows.total == 1000 and FD.stripe_rows(640) == 10 and FD.stripe_rows(10) == 1
    for epoch in (0, 5):
        order = shuffled(1000, epoch, 8)
        steps = [rows.slice(low, low + 200, epoch) for low in range(0, 1000, 200)]
        for i, step in enumerate(steps):
            assert sorted(r["id"] for r in step.collect()) == sorted(order[i * 200 : (i + 1) * 200])
        placed = {r["place"]: r["id"] for r in rows.placed(epoch).collect()}
        assert placed == dict(enumerate(order))
    assert steps[0].inputFiles() == steps[1].inputFiles()
    text = steps[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "_row" in text
    rows.drop()


def test_small_steps_are_one_stage(spark):
    assert R.step_tasks(100, R.zero_params(784, 10)) == 1
    assert R.step_tasks(10**9, R.zero_params(784, 10)) is None
    df, x, labels = rows_of(spark)
    whole, _, _ = R.mean_gradient(df, R.zero_params(5, 3))
    few, _, _ = R.mean_gradient(df.repartition(9), R.zero_params(5, 3), tasks=2)
    assert few["weights"] == pytest.approx(whole["weights"])


def test_initial_weights_are_normal_and_repeatable(spark):
    params = R.random_params(spark, 200, 50, stddev=0.5, bias=0.1, seed=4)
    values = params["weights"].ravel()
    assert abs(values.mean()) < 0.02 and values.std() == pytest.approx(0.5, rel=0.03)
    assert (np.abs(values) < 0.5).mean() == pytest.approx(0.683, abs=0.02) and params["biases"].tolist() == [0.1] * 50
    again = R.random_params(spark, 200, 50, stddev=0.5, bias=0.1, seed=4)
    other = R.random_params(spark, 200, 50, stddev=0.5, seed=5)
    assert (again["weights"] == params["weights"]).all() and abs(np.corrcoef(values, other["weights"].ravel())[0, 1]) < 0.05


def test_local_descent_holds_no_whole_batch():
    rng = np.random.default_rng(0)

    def blocks():
        for _ in range(60):
            x = pa.FixedSizeListArray.from_arrays(pa.array(rng.normal(size=1000 * 64)), 64).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([0] * 1000), x, pa.array([1] * 1000)], names=["batch", "x", "label"])

    tracemalloc.start()
    try:
        models = list(R._walk(R.zero_params(64, 3), 0.5)(blocks()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(models) == 1 and peak < 12_000_000
