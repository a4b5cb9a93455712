"""Losses, accuracy, summaries and reports over prediction and metric tables.

One rule for labels: a row whose label is null or names no class is unlabelled. Losses, accuracy,
precision and gradients are over labelled rows, so that all of them are means over the same rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.vectors import argmax, cross_entropy, has_label, in_top_k, score_cross_entropy
from rankflow.operators.ordering import running_totals

# A metric of a step, or the rows in one bucket of a step's histogram.
METRICS_SCHEMA = "run string, step bigint, epoch int, name string, value double, elapsed_s double, bucket int"

# Predicted probabilities fall into exponential buckets: each is ``PREDICTION_GROWTH`` times as wide as the one before, the first
# one also holds what is smaller, so histograms of any parts add up bucket by bucket.
PREDICTION = "prediction"
PREDICTION_LEAST, PREDICTION_GROWTH = 1e-12, 1.1
PREDICTION_BUCKETS = 1 + int(math.log(1 / PREDICTION_LEAST) / math.log(PREDICTION_GROWTH))


def prediction_buckets(p: np.ndarray) -> np.ndarray:
    steps = np.log(np.maximum(p, PREDICTION_LEAST) / PREDICTION_LEAST) / math.log(PREDICTION_GROWTH)
    return np.clip(np.floor(steps), 0, PREDICTION_BUCKETS - 1).astype(np.int64)


def labelled(df: DataFrame, values: str, label: str) -> DataFrame:
    """Rows whose label names one of the ``values``' classes."""
    return df.filter(has_label(F.col(label), F.size(values)))


def mean_cross_entropy(df: DataFrame, probabilities: str, label: str) -> DataFrame:
    return labelled(df, probabilities, label).agg(F.avg(cross_entropy(F.col(probabilities), F.col(label))).alias("loss"))


def mean_score_loss(df: DataFrame, scores: str, label: str, penalty: float = 0.0) -> DataFrame:
    """Mean cross-entropy from scores plus a fixed weight-decay term."""
    loss = F.avg(score_cross_entropy(F.col(scores), F.col(label))) + F.lit(float(penalty))
    return labelled(df, scores, label).agg(loss.alias("loss"))


def accuracy(df: DataFrame, scores: str, label: str) -> DataFrame:
    hit = argmax(F.col(scores)) == F.col(label)
    return labelled(df, scores, label).agg(F.avg(hit.cast("double")).alias("accuracy"))


def precision_at_k(df: DataFrame, scores: str, label: str, k: int = 1) -> DataFrame:
    hit = in_top_k(F.col(scores), F.col(label), k).cast("bigint")
    counts = labelled(df, scores, label).agg(F.sum(hit).alias("correct"), F.count("*").alias("rows"))
    return counts.withColumn("precision", F.col("correct") / F.col("rows"))


def running_precision(df: DataFrame, batch: str, scores: str, label: str, k: int = 1) -> DataFrame:
    """Precision over all batches seen so far, one row per batch."""
    hit = in_top_k(F.col(scores), F.col(label), k).cast("bigint")
    batches = labelled(df, scores, label).groupBy(batch).agg(F.sum(hit).alias("correct"), F.count("*").alias("rows"))
    seen = running_totals(batches, [batch], {"_correct": "correct", "_rows": "rows"})
    return seen.select(
        batch, "correct", "rows", (F.col("_correct") / F.col("_rows")).alias("precision")
    )


def variable_summary(df: DataFrame, value: str) -> DataFrame:
    """Mean, population standard deviation, maximum and minimum."""
    return df.agg(
        F.avg(value).alias("mean"),
        F.stddev_pop(value).alias("stddev"),
        F.max(value).alias("max"),
        F.min(value).alias("min"),
    )


def histogram(df: DataFrame, value: str, buckets: int = 30) -> DataFrame:
    """``(bucket, low, high, rows)`` of non-empty equal-width buckets from minimum to maximum."""
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bucket int, low double, high double, rows bigint")
    width = (high - low) / buckets or 1.0
    bucket = F.least(F.floor((F.col(value) - low) / width), F.lit(buckets - 1)).cast("int")
    counts = df.filter(F.col(value).isNotNull()).groupBy(bucket.alias("bucket"))
    return counts.agg(F.count("*").alias("rows")).select(
        "bucket",
        (low + F.col("bucket") * width).alias("low"),
        (low + (F.col("bucket") + 1) * width).alias("high"),
        "rows",
    )


def l2_terms(df: DataFrame, by: str, value: str, decay: float) -> DataFrame:
    """``decay * sum(w**2) / 2`` of each weight matrix in long form."""
    half = F.sum(F.col(value) * F.col(value)) / 2
    return df.groupBy(by).agg((F.lit(float(decay)) * half).alias("l2"))


def throughput(df: DataFrame, seconds: str, batch_size: int) -> DataFrame:
    """Mean of the steps' examples per second, and mean seconds per batch."""
    return df.agg(
        F.avg(F.lit(float(batch_size)) / F.col(seconds)).alias("examples_per_s"),
        F.avg(seconds).alias("s_per_batch"),
    )


def epoch_report(df: DataFrame) -> DataFrame:
    """Last value and elapsed seconds of each epoch."""
    return df.groupBy("epoch").agg(
        F.max_by("value", "step").alias("value"), F.max("elapsed_s").alias("elapsed_s")
    )


def append_metrics(spark: SparkSession, rows: list[tuple], path: str) -> None:
    """Append one epoch's metrics to the metrics table; rows without a bucket may leave it out."""
    whole = [(*row, None)[:7] for row in rows]
    spark.createDataFrame(whole, METRICS_SCHEMA).coalesce(1).write.mode("append").parquet(path)
