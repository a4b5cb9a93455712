"""Expressions on array columns: scores, losses, standardisation, crops."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def array_sum(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda total, value: total + value)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    Inside a lambda a plain expression is computed anew for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def one_hot(label: Column, classes: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(classes - 1)), lambda k: (k == label).cast("int")
    )


def linear_scores(features: Column, weights: np.ndarray, biases: np.ndarray) -> Column:
    """``features @ weights + biases`` per row, as one matrix product per Arrow batch."""
    weights = np.asarray(weights, dtype=np.float64)
    biases = np.asarray(biases, dtype=np.float64)
    width, classes = weights.shape

    @F.arrow_udf("array<double>")
    def scores(rows: pa.Array) -> pa.Array:
        matrix = list_matrix(rows, width)
        result = matrix @ weights + biases
        offsets = np.arange(0, len(rows) * classes + 1, classes, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(result.ravel()))

    return scores(features)


def list_matrix(rows: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column of equal-length rows as a float64 matrix."""
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    if flat.size != len(rows) * width:
        raise ValueError(f"every vector must have {width} values")
    return flat.astype(np.float64).reshape(len(rows), width)


def softmax(scores: Column) -> Column:
    """Probabilities from scores, shifted by the maximum so that exp cannot overflow."""

    def shares(weights: Column) -> Column:
        return bind(array_sum(weights), lambda total: F.transform(weights, lambda e: e / total))

    return bind(
        F.array_max(scores),
        lambda top: bind(F.transform(scores, lambda z: F.exp(z - top)), shares),
    )


def argmax(vector: Column) -> Column:
    """Zero-based index of the first maximum."""
    return (F.array_position(vector, F.array_max(vector)) - 1).cast("int")


def value_at(vector: Column, index: Column) -> Column:
    return F.get(vector, index)


def cross_entropy(probabilities: Column, label: Column) -> Column:
    """``-sum_k y_k * log(p_k)`` for a one-hot label, without clipping.

    A zero probability of the label gives infinity, and one of another class gives NaN, since
    zero times minus infinity is NaN.
    """
    own = value_at(probabilities, label)
    zeros = F.size(F.filter(probabilities, lambda p: p == 0.0))
    other_zeros = zeros - (own == 0.0).cast("int")
    return (
        F.when(other_zeros > 0, F.lit(float("nan")))
        .when(own == 0.0, F.lit(INF))
        .otherwise(-F.log(own))
    )


def score_cross_entropy(scores: Column, label: Column) -> Column:
    """Cross-entropy straight from scores, in its numerically stable form."""

    def loss(top: Column) -> Column:
        total = array_sum(F.transform(scores, lambda z: F.exp(z - top)))
        return F.log(total) + top - value_at(scores, label)

    return bind(F.array_max(scores), loss)


def in_top_k(scores: Column, label: Column, k: int) -> Column:
    """Whether fewer than ``k`` scores are strictly greater than the label's score.

    Ties count in the label's favour. A row with a score that is not finite never hits, nor does one
    whose label is null or names no score.
    """
    finite = F.forall(scores, lambda z: (F.abs(z) < INF) & ~F.isnan(z))
    greater = bind(
        value_at(scores, label), lambda own: F.size(F.filter(scores, lambda z: z > own))
    )
    return F.coalesce(has_label(label, F.size(scores)) & finite & (greater < k), F.lit(False))


def has_label(label: Column, classes: Column | int) -> Column:
    """Whether a label is a class: not null, and from 0 up to the number of classes."""
    return F.coalesce((label >= 0) & (label < classes), F.lit(False))


def standardize(vector: Column) -> Column:
    """``(x - mean) / max(std, 1/sqrt(n))`` within one record."""

    def centred(values: Column) -> Column:
        mean = array_sum(values) / F.size(values)
        return bind(mean, lambda m: F.transform(values, lambda x: x - m))

    def scaled(centre: Column) -> Column:
        count = F.size(centre).cast("double")
        spread = F.aggregate(centre, F.lit(0.0), lambda total, x: total + x * x)
        scale = F.greatest(F.sqrt(spread / count), 1.0 / F.sqrt(count))
        return bind(scale, lambda s: F.transform(centre, lambda x: x / s))

    return bind(bind(doubles(vector), centred), scaled)


def crop_or_pad(
    vector: Column,
    height: Column | int,
    width: Column | int,
    channels: int,
    target_height: int,
    target_width: int,
) -> Column:
    """Centre crop or zero-pad a row-major image to a fixed size."""
    height = (F.lit(height) if isinstance(height, int) else height).cast("int")
    width = (F.lit(width) if isinstance(width, int) else width).cast("int")
    row_shift = _source_shift(height, target_height)
    column_shift = _source_shift(width, target_width)
    row_cells = target_width * channels

    # A row of the result is a run of one source row between two runs of zeros.
    kind = F.lit(0.0)
    left = F.greatest(-column_shift, F.lit(0))
    first = F.greatest(column_shift, F.lit(0))
    kept = F.greatest(F.least(width - first, F.lit(target_width) - left), F.lit(0))
    before = F.array_repeat(kind, left * channels)
    after = F.array_repeat(kind, (F.lit(target_width) - left - kept) * channels)
    empty = F.array_repeat(kind, F.lit(row_cells))

    def source_row(place: Column) -> Column:
        row = place + row_shift
        run = F.slice(vector, (row * width + first) * channels + 1, kept * channels)
        return F.when((row >= 0) & (row < height), F.concat(before, run, after)).otherwise(empty)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(target_height - 1)), source_row))


def _source_shift(size: Column, target: int) -> Column:
    """Offset from an output index to its source index along one axis."""
    crop = F.floor(F.greatest(size - target, F.lit(0)) / 2)
    pad = F.floor(F.greatest(F.lit(target) - size, F.lit(0)) / 2)
    return (crop - pad).cast("int")


def staircase_decay(step: Column, start: float, factor: float, stairs: int, steps) -> Column:
    """Learning rate that falls from ``start`` to ``start/factor`` in ``stairs - 1`` drops."""
    steps = F.lit(float(steps)) if isinstance(steps, (int, float)) else steps.cast("double")
    rate = _stair(factor, stairs)
    return F.lit(float(start)) * F.pow(F.lit(rate), F.floor(step / (steps / (stairs - 1))))


def _stair(factor: float, stairs: int) -> float:
    return (1.0 / factor) ** (1.0 / (stairs - 1))


def staircase_rate(step: int, start: float, factor: float, stairs: int, steps: float) -> float:
    """The same schedule for the driver's training loop."""
    rate = _stair(factor, stairs)
    return start * rate ** math.floor(step / (steps / (stairs - 1)))
