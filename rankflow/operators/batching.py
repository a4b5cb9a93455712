"""Splits, mini-batches, shards and replicas, all by exact positions in a seeded order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.functions.hashing import MODULUS, shuffle_key
from rankflow.operators.feed import feed
from rankflow.operators.ordering import global_index, nth_key

# The dataset conversion's hold-out size, seed, shard count and file name.
VALIDATION_ROWS = 350
SPLIT_SEED = 0
SHARDS = 5
SHARD_NAME = "flowers_%s_%05d-of-%05d"


def train_valid_split(
    df: DataFrame, id_col: str, n_valid: int = VALIDATION_ROWS, seed: int = SPLIT_SEED
) -> DataFrame:
    """``df`` with a ``split``: the first ``n_valid`` rows in shuffled order are validation.

    Only the key of the last validation row has to be known, so the rows are not shuffled.
    ``id_col`` must be unique.
    """
    key, tie = shuffle_key(F.col(id_col), seed), F.col(id_col)
    last = nth_key(df, key, tie, n_valid, MODULUS) if n_valid else None
    if n_valid == 0:
        valid = F.lit(False)
    elif last is None:
        valid = F.lit(True)
    else:
        valid = (key < last["key"]) | ((key == last["key"]) & (tie <= last["tie"]))
    return df.withColumn("split", _split_name(valid))


def _split_name(valid: Column) -> Column:
    return F.when(valid, F.lit("validation")).otherwise(F.lit("train"))


def assign_batches(df: DataFrame, id_col: str, batch_size: int, epoch: int = 0) -> DataFrame:
    """``position`` and ``batch`` of each row in one epoch's order.

    An epoch has ``floor(n / batch_size)`` batches; the rows left over are dropped.
    """
    rows = feed(df, id_col)
    return _with_batch(rows.placed(epoch), batch_size, rows.total)


def _with_batch(placed: DataFrame, batch_size: int, total: int) -> DataFrame:
    batched = placed.withColumnRenamed("place", "position").withColumn("batch", F.floor(F.col("position") / batch_size))
    return batched.filter(F.col("batch") < total // batch_size)


def epochs_needed(batch_num: int, batch_size: int, n_rows: int) -> int:
    """Passes over the data that ``batch_num`` batches take."""
    return -(-batch_num * batch_size // n_rows)


def epoch_batches(df: DataFrame, id_col: str, batch_size: int, n_epochs: int) -> DataFrame:
    """``epoch``, ``position`` and ``batch`` for several epochs, each in an order of its own.

    Rows are sorted and written once, whatever the number of epochs; an epoch's order is arithmetic on
    their numbers, so repeating them shuffles nothing.
    """
    rows = feed(df, id_col)
    numbered = rows.rows.table.withColumn("_number", rows.rows.position())
    repeated = numbered.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n_epochs - 1))))
    return _with_batch(rows.with_places(repeated, "epoch"), batch_size, rows.total)


def shard_batches(df: DataFrame, n_workers: int, n_batches: int, truncate: bool = False) -> DataFrame:
    """Give batch ``b`` to ``worker = b mod n``; ``truncate`` keeps whole rounds only."""
    if truncate:
        df = df.filter(F.col("batch") < n_batches // n_workers * n_workers)
    return df.withColumn("worker", F.pmod(F.col("batch"), F.lit(n_workers)).cast("int"))


def split_over_replicas(df: DataFrame, batch_size: int, replicas: int) -> DataFrame:
    """Cut every batch into equal contiguous parts."""
    if batch_size % replicas:
        raise ValueError(f"a batch of {batch_size} rows does not split into {replicas} equal parts")
    within = F.pmod(F.col("position"), F.lit(batch_size))
    return df.withColumn("replica", F.floor(within / (batch_size // replicas)).cast("int"))


def assign_shards(
    df: DataFrame, id_col: str, n_shards: int = SHARDS, seed: int = SPLIT_SEED, name: str = SHARD_NAME
) -> DataFrame:
    """``shard`` and ``shard_file``: contiguous ranges of ``ceil(n/N)`` rows in each split.

    Only the sizes of the splits, one row each, go to the rows: dealt by split, nearly all rows would be in one task.
    """
    indexed = global_index(df, ["split", shuffle_key(F.col(id_col), seed), F.col(id_col)], "_place")
    sizes = indexed.groupBy("split").agg(
        F.count("*").alias("_rows"), F.min("_place").alias("_first")
    )
    placed = indexed.join(F.broadcast(sizes), "split")
    shard = F.floor((F.col("_place") - F.col("_first")) / F.ceil(F.col("_rows") / n_shards))
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("shard_file", F.format_string(name, "split", "shard", F.lit(n_shards)))
        .drop("_place", "_rows", "_first")
    )


def split_counts(df: DataFrame, class_col: str) -> DataFrame:
    """Rows and classes of each split.

    Distinct classes are found by a partial aggregation on ``(split, class)``, so one large
    split is not gathered in a single task.
    """
    pairs = df.groupBy("split", class_col).agg(F.count("*").alias("_rows"))
    return pairs.groupBy("split").agg(
        F.sum("_rows").alias("rows"), F.count(class_col).alias("classes")
    )
