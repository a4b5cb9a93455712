"""Queries on splits, labels, vectors, losses and training."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.functions import vectors as V
from rankflow.operators import batching as B
from rankflow.operators import labels as L
from rankflow.operators import metrics as M
from rankflow.operators import training as R
from rankflow.plans import tables as T
from rankflow.session import scratch_path
from rankflow.sources import records
from rankflow.sources.labels import load_or_build, read_label_map, write_label_map

DECAY = 0.0005
LEARNING_RATE = 0.5
QUERY_STEPS = 4
LOCAL_WORKERS, LOCAL_STEPS = 4, 3
DELAY = 2
SWEEP_FACTORS = (1, 2)
INIT_STDDEV, INIT_SEED = 0.01, 3
# Start, factor and stairs of the two learning rates' schedules.
WEIGHTS_SCHEDULE, BIASES_SCHEDULE = (0.001, 250, 4), (0.002, 10, 2)
PRECISION_K = 3
PRECISION_BATCH = 50
HISTOGRAM_BUCKETS = 30
BOXES = 16
FOLDER_FILE_ROWS = 200
CROP = (6, 11)


def _round(name: str, digits: int = 6):
    """Rounded, without a negative zero."""
    return (F.round(name, digits) + F.lit(0.0)).alias(name)


# --- splits and batches ----------------------------------------------------------------------


def train_valid_split(spark, sf_dir):
    labels = T.table(spark, sf_dir, "labels").select("doc_id")
    return B.train_valid_split(labels, "doc_id")


def epoch_batches(spark, sf_dir):
    return B.epoch_batches(T.vectors(spark, sf_dir).select("vec_id"), "vec_id", 64, 3)


def batch_shard(spark, sf_dir):
    documents = T.table(spark, sf_dir, "documents").select("doc_id")
    batches = B.assign_batches(documents, "doc_id", 64)
    n_batches = documents.count() // 64
    sharded = B.shard_batches(batches, 4, n_batches, truncate=True)
    return B.split_over_replicas(sharded, 64, 4)


def shard_assign(spark, sf_dir):
    documents = T.table(spark, sf_dir, "documents").select("doc_id")
    return B.assign_shards(B.train_valid_split(documents, "doc_id"), "doc_id")


def _record_table(spark, sf_dir) -> DataFrame:
    return T.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("text").cast("binary").alias("content"),
        F.nullif(F.col("lang"), F.lit("en")).alias("format"),
        F.nullif(F.col("doc_id") % 5, F.lit(0)).alias("label"),
    )


def split_read(spark, sf_dir):
    split = B.train_valid_split(_record_table(spark, sf_dir), "doc_id")
    path = scratch_path(spark, "records")
    records.write_splits(B.assign_shards(split, "doc_id").drop("shard_file"), path)
    rows = records.read_split(spark, path, "validation")
    return rows.select("doc_id", F.col("content").cast("string").alias("content"), "format", "label", "shard")


def split_counts(spark, sf_dir):
    documents = T.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return B.split_counts(B.train_valid_split(documents, "doc_id"), "lang")


# --- labels ----------------------------------------------------------------------------------


def class_ids(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return L.with_class_id(orders, "o_orderpriority")


def dictionary_build(spark, sf_dir):
    parts = T.table(spark, sf_dir, "part")
    code = F.concat(F.lit("n"), F.lpad(F.col("p_partkey").cast("string"), 12, "0"))
    names = L.parse_names(parts.select(F.concat(code, F.lit("\t"), "p_name").alias("value")))
    ids = parts.filter(F.col("p_size") <= 25).select(code.alias("id"))
    return L.dictionary(ids, names)


def _part_labels(spark, sf_dir) -> DataFrame:
    parts = T.table(spark, sf_dir, "part")
    return parts.select(
        F.col("p_partkey").alias("label"), F.concat_ws(":", "p_brand", "p_type").alias("name")
    )


def label_map_format(spark, sf_dir):
    return L.label_map_lines(_part_labels(spark, sf_dir))


def label_map_read(spark, sf_dir):
    folder = scratch_path(spark, "labels")
    write_label_map(_part_labels(spark, sf_dir), folder)
    return read_label_map(spark, folder)


# --- vectors ---------------------------------------------------------------------------------


def zip_boxes(spark, sf_dir):
    lists = [F.slice("features", 1 + i * BOXES, BOXES) for i in range(4)]
    boxes = T.vectors(spark, sf_dir).select(
        "vec_id", F.posexplode(records.zip_boxes(*lists)).alias("object", "box")
    )
    fields = [F.col(f"box.{name}").cast("double").alias(name) for name in ("ymin", "xmin", "ymax", "xmax")]
    flat = boxes.select("vec_id", "object", *fields)
    return flat.select("vec_id", "object", *[_round(name) for name in ("ymin", "xmin", "ymax", "xmax")])


def one_hot(spark, sf_dir):
    hot = V.one_hot(F.col("label"), T.CLASSES).cast("array<string>")
    return T.vectors(spark, sf_dir).select("vec_id", "label", F.concat_ws(",", hot).alias("one_hot"))


def _cells(df: DataFrame, values) -> DataFrame:
    cells = df.select("vec_id", F.posexplode(values).alias("cell", "value"))
    return cells.select("vec_id", "cell", (F.round(F.col("value").cast("double"), 6) + F.lit(0.0)).alias("value"))


def standardize_rows(spark, sf_dir):
    return _cells(T.vectors(spark, sf_dir), V.standardize(F.col("features")))


def crop_or_pad(spark, sf_dir):
    image = V.crop_or_pad(F.col("features"), T.SIDE, T.SIDE, 1, *CROP)
    return _cells(T.vectors(spark, sf_dir), image)


def variable_summary(spark, sf_dir):
    summary = M.variable_summary(T.vector_values(spark, sf_dir), "value")
    return summary.select(*[_round(name) for name in summary.columns])


def histogram(spark, sf_dir):
    counts = M.histogram(T.vector_values(spark, sf_dir), "value", HISTOGRAM_BUCKETS)
    return counts.select("bucket", _round("low"), _round("high"), "rows")


def l2_term(spark, sf_dir):
    terms = M.l2_terms(T.vector_values(spark, sf_dir), "label", "value", DECAY)
    return terms.select("label", _round("l2"))


def _scored(spark, sf_dir) -> DataFrame:
    return R.scored(T.vectors(spark, sf_dir), T.fixed_params()).select("vec_id", "label", "scores")


def predict(spark, sf_dir):
    probabilities = _scored(spark, sf_dir).withColumn("p", V.softmax(F.col("scores")))
    return probabilities.select(
        "vec_id",
        V.argmax(F.col("p")).alias("predicted"),
        F.round(F.array_max("p"), 6).alias("probability"),
    )


def softmax_loss(spark, sf_dir):
    probabilities = _scored(spark, sf_dir).withColumn("p", V.softmax(F.col("scores")))
    return M.mean_cross_entropy(probabilities, "p", "label").select(_round("loss"))


def softmax_loss_l2(spark, sf_dir):
    penalty = DECAY * float((T.fixed_params()["weights"] ** 2).sum()) / 2
    return M.mean_score_loss(_scored(spark, sf_dir), "scores", "label", penalty).select(_round("loss"))


def accuracy(spark, sf_dir):
    return M.accuracy(_scored(spark, sf_dir), "scores", "label").select(_round("accuracy"))


def precision_at_k(spark, sf_dir):
    result = M.precision_at_k(_scored(spark, sf_dir), "scores", "label", PRECISION_K)
    return result.select("correct", "rows", _round("precision"))


def running_precision(spark, sf_dir):
    batches = _scored(spark, sf_dir).withColumn("batch", F.floor(F.col("vec_id") / PRECISION_BATCH))
    result = M.running_precision(batches, "batch", "scores", "label")
    return result.select("batch", "correct", "rows", _round("precision"))


# --- training --------------------------------------------------------------------------------


def _model(spark, params) -> DataFrame:
    cells = R.model_table(spark, params)
    return cells.select("name", "row", "col", _round("value"))


def gradient_step(spark, sf_dir):
    grads, _, _ = R.mean_gradient(T.vectors(spark, sf_dir), T.fixed_params())
    return _model(spark, grads)


def _trained(spark, sf_dir, workers: int, optimizer, **options) -> DataFrame:
    data = T.vectors(spark, sf_dir)
    run = R.train(
        data,
        "vec_id",
        R.zero_params(T.WIDTH, T.CLASSES),
        batch_size=data.count() // (QUERY_STEPS * workers),
        epochs=1,
        optimizer=optimizer,
        workers=workers,
        **options,
    )
    return _model(spark, run.params)


def train_minibatch(spark, sf_dir):
    return _trained(spark, sf_dir, 1, R.GradientDescent(LEARNING_RATE))


def train_sync(spark, sf_dir):
    return _trained(spark, sf_dir, 2, R.GradientDescent(LEARNING_RATE))


def train_sync_full_pass(spark, sf_dir):
    data = T.vectors(spark, sf_dir)
    run = R.train(
        data, "vec_id", R.zero_params(T.WIDTH, T.CLASSES), batch_size=data.count() // QUERY_STEPS,
        epochs=1, optimizer=R.GradientDescent(LEARNING_RATE), workers=2, shard_batches=False,
    )
    return _model(spark, run.params)


def train_momentum(spark, sf_dir):
    def rate(start, factor, stairs):
        return lambda step: V.staircase_rate(step, start, factor, stairs, QUERY_STEPS)

    groups = {
        "weights": {"learning_rate": rate(LEARNING_RATE, *WEIGHTS_SCHEDULE[1:]), "momentum": 0.9},
        "biases": {"learning_rate": rate(2 * LEARNING_RATE, *BIASES_SCHEDULE[1:]), "momentum": 0.9},
    }
    return _trained(spark, sf_dir, 1, R.Momentum(groups), weight_decay=DECAY)


def train_local_sgd(spark, sf_dir):
    data = T.vectors(spark, sf_dir)
    run = R.train_local(
        data, "vec_id", R.zero_params(T.WIDTH, T.CLASSES),
        batch_size=data.count() // (LOCAL_STEPS * LOCAL_WORKERS), epochs=1, learning_rate=LEARNING_RATE,
        workers=LOCAL_WORKERS,
    )
    return _model(spark, run.params)


def train_delayed(spark, sf_dir):
    """Stale updates: every gradient is two models old when it is applied."""
    data = T.vectors(spark, sf_dir)
    run = R.train(
        data, "vec_id", R.zero_params(T.WIDTH, T.CLASSES), batch_size=data.count() // (2 * QUERY_STEPS), epochs=1,
        optimizer=R.GradientDescent(LEARNING_RATE), delay=DELAY,
    )
    return _model(spark, run.params)


def train_sweep(spark, sf_dir):
    """The models of two batch sizes, trained in one pass."""
    data = T.vectors(spark, sf_dir)
    size = data.count() // QUERY_STEPS
    runs = R.sweep(
        data, "vec_id", R.zero_params(T.WIDTH, T.CLASSES), [factor * size for factor in SWEEP_FACTORS], epochs=1,
        optimizer=R.GradientDescent(LEARNING_RATE), stripe=R.stripe_rows(size),
    )
    models = [
        _model(spark, run.params).withColumn("run", F.lit(f"batch_{factor * size}"))
        for factor, run in zip(SWEEP_FACTORS, runs)
    ]
    return models[0].unionByName(models[1])


def random_init(spark, sf_dir):
    """A weight for every dimension of the vectors and every label that occurs."""
    cells = T.vectors(spark, sf_dir).select(F.posexplode("features").alias("row", "cell"), F.col("label").alias("col"))
    cells = cells.select("row", "col").distinct()
    return R.with_initial_weights(cells, "row", "col", T.CLASSES, INIT_STDDEV, INIT_SEED).select("row", "col", _round("value"))


# --- unlabelled rows, saved models and files ---


def _partly_labelled(spark, sf_dir) -> DataFrame:
    """Vectors of which every fifth has no label and every seventh label -1."""
    label = F.when(F.col("vec_id") % 5 == 0, F.lit(None)).when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label"))
    return T.vectors(spark, sf_dir).withColumn("label", label.cast("int"))


def unlabelled_metrics(spark, sf_dir):
    """Loss, accuracy and precision over the labelled rows."""
    scored = R.scored(_partly_labelled(spark, sf_dir), T.fixed_params())
    loss = M.mean_score_loss(scored, "scores", "label").select(F.lit("loss").alias("name"), _round("loss").alias("value"))
    hits = M.accuracy(scored, "scores", "label").select(F.lit("accuracy").alias("name"), _round("accuracy").alias("value"))
    top = M.precision_at_k(scored, "scores", "label", PRECISION_K)
    return loss.unionByName(hits).unionByName(
        top.select(F.lit("precision").alias("name"), _round("precision").alias("value"))
    ).unionByName(top.select(F.lit("rows").alias("name"), F.col("rows").cast("double").alias("value")))


def unlabelled_gradient(spark, sf_dir):
    grads, _, _ = R.mean_gradient(_partly_labelled(spark, sf_dir), T.fixed_params())
    return _model(spark, grads)


def class_ids_null(spark, sf_dir):
    """Orders of which some have no priority."""
    orders = T.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("o_orderpriority")
    )
    return L.with_class_id(orders, "o_orderpriority")


def checkpoint_precision(spark, sf_dir):
    """A model saved, restored, and scored on all vectors."""
    path = scratch_path(spark, "model")
    R.save_model(spark, {name: value * 0 for name, value in T.fixed_params().items()}, 3, path)
    R.save_model(spark, T.fixed_params(), 7, path)
    scored = R.scored(T.vectors(spark, sf_dir), R.restore_model(spark, path))
    result = M.precision_at_k(scored, "scores", "label", 1)
    return result.select("correct", "rows", _round("precision"))


def metrics_table(spark, sf_dir):
    """What a run appends for each step: loss, accuracy and the histogram of its predicted probabilities."""
    data, path = T.vectors(spark, sf_dir), scratch_path(spark, "metrics")
    R.train(
        data, "vec_id", R.zero_params(T.WIDTH, T.CLASSES), batch_size=data.count() // QUERY_STEPS, epochs=1,
        optimizer=R.GradientDescent(LEARNING_RATE), metrics_path=path,
    )
    return spark.read.parquet(path).select("step", "epoch", "name", "bucket", _round("value"))


def label_map_fallback(spark, sf_dir):
    """A label map that is built and written where there is none, and read where there is."""
    folder = scratch_path(spark, "labels")
    built = load_or_build(spark, folder, lambda: _part_labels(spark, sf_dir))
    again = load_or_build(spark, folder, lambda: _part_labels(spark, sf_dir).filter("false"))
    return built.join(again, ["label", "name"])


def class_folders(spark, sf_dir):
    """Whole documents written as files of bounded size below a folder per language, read back with their class."""
    root = scratch_path(spark, "folders")
    docs = T.table(spark, sf_dir, "documents").select(F.col("text").alias("value"), F.col("lang").alias("class"))
    docs.write.option("maxRecordsPerFile", FOLDER_FILE_ROWS).partitionBy("class").text(root)
    read = records.read_class_folders(spark, root, "class")
    # Every line ends in a line feed, so the last piece of a file is empty.
    lines = F.split(F.col("content").cast("string"), "\n")
    digest = F.conv(F.substring(F.md5("line"), 1, 8), 16, 10).cast("bigint")
    each = read.select("class", F.explode(F.slice(lines, 1, F.size(lines) - 1)).alias("line"))
    return each.groupBy("class").agg(
        F.sum(F.octet_length("line") + 1).alias("bytes"), F.count("*").alias("lines"), F.sum(digest).alias("digest")
    )


# --- schedules and reports -------------------------------------------------------------------


def lr_schedule(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select(F.col("event_id").alias("step"))
    steps = events.count()
    rates = events.select(
        "step",
        V.staircase_decay(F.col("step"), *WEIGHTS_SCHEDULE, steps).alias("weights_rate"),
        V.staircase_decay(F.col("step"), *BIASES_SCHEDULE, steps).alias("biases_rate"),
    )
    return rates.select("step", _round("weights_rate", 9), _round("biases_rate", 9))


def throughput(spark, sf_dir):
    seconds = T.step_metrics(spark, sf_dir).select((F.col("value") + 1).alias("seconds"))
    return M.throughput(seconds, "seconds", 128).select(_round("examples_per_s"), _round("s_per_batch"))


def epoch_report(spark, sf_dir):
    return M.epoch_report(T.step_metrics(spark, sf_dir))


def latest_checkpoint(spark, sf_dir):
    events = T.table(spark, sf_dir, "events")
    models = events.select(
        (F.floor(F.col("event_id") / 97) * 100).alias("step"),
        F.concat(F.lit("w"), F.col("user_id").cast("string")).alias("name"),
        (F.col("event_id") % 97).cast("int").alias("row"),
        "value",
    )
    return R.latest_checkpoint(models)


QUERIES = {
    query.__name__: query
    for query in (
        train_valid_split, epoch_batches, batch_shard, shard_assign, split_read, split_counts,
        class_ids, dictionary_build, label_map_format, label_map_read,
        zip_boxes, one_hot, standardize_rows, crop_or_pad, variable_summary, histogram, l2_term,
        predict, softmax_loss, softmax_loss_l2, accuracy, precision_at_k, running_precision,
        gradient_step, train_minibatch, train_sync, train_sync_full_pass, train_momentum,
        unlabelled_metrics, unlabelled_gradient, class_ids_null, checkpoint_precision, metrics_table,
        label_map_fallback, class_folders, random_init, train_sweep, train_delayed,
        train_local_sgd, lr_schedule, throughput, epoch_report, latest_checkpoint,
    )
}
