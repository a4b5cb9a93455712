"""Global order, positions, selections, batches and splits."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import operators
from rankflow.functions.hashing import INCREMENT, MIXERS, MODULUS, MULTIPLIER, shuffle_key
from rankflow.functions.permutation import Permutation
from rankflow.operators import batching as B
from rankflow.operators.lookups import lookup_join
from rankflow.operators.ordering import (
    global_index,
    nth_key,
    ordered_rows,
    running_totals,
    sort_by,
    sort_by_position,
)
from rankflow.session import session_settings


def key_of(value, seed=0):
    key = (value % MODULUS * (MULTIPLIER * (2 * seed + 1) % MODULUS) + INCREMENT) % MODULUS
    for mixer in MIXERS:
        key = ((key ^ (key >> 16)) * mixer) % MODULUS
    return key ^ (key >> 15)


def skewed(spark, n=3000):
    """A third of the rows share the leading key."""
    rng = random.Random(5)
    rows = [(0 if i % 3 == 0 else rng.randrange(50), i) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k int, id bigint").repartition(7)


def test_positions_with_a_hot_key(spark):
    rows, df = skewed(spark)
    indexed = global_index(df, ["k", "id"])
    got = {(r["k"], r["id"]): r["position"] for r in indexed.collect()}
    assert got == {row: i for i, row in enumerate(sorted(rows))}
    parts = ordered_rows(df, ["k", "id"]).table.groupBy("_part").count().collect()
    assert max(row["count"] for row in parts) < len(rows) / 2


def test_index_of_nothing(spark):
    assert global_index(spark.createDataFrame([], "k int"), ["k"]).collect() == []


def test_slice_reads_only_its_partitions(spark):
    rows, df = skewed(spark)
    ordered = ordered_rows(df, ["k", "id"])
    border = ordered.starts[2]
    for low, high in ((border + 3, border + 9), (border - 10, border + 10), (0, 3000), (3000, 3010)):
        piece = ordered.slice(low, high)
        assert sorted((r["k"], r["id"]) for r in piece.collect()) == sorted(rows)[low:high]
    plan = ordered.slice(border - 10, border + 10)._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan).group(1)
    assert "_part" in filters


def test_running_totals_cross_partitions(spark):
    rows, df = skewed(spark)
    got = {r["id"]: r["total"] for r in running_totals(df, ["k", "id"], {"total": "k"}).collect()}
    total = 0
    for k, i in sorted(rows):
        total += k
        assert got[i] == total


@pytest.mark.parametrize("n", [1, 17, 1500, 3000])
def test_nth_key(spark, n):
    rows, df = skewed(spark)
    got = nth_key(df, shuffle_key(F.col("id")), F.col("id"), n, MODULUS)
    assert (got["key"], got["tie"]) == sorted((key_of(i), i) for _, i in rows)[n - 1]
    assert nth_key(df, shuffle_key(F.col("id")), F.col("id"), 3001, MODULUS) is None


def test_nth_key_among_many_equal_keys(spark):
    df = spark.range(100).select(F.lit(5).alias("key"), "id")
    got = nth_key(df, F.col("key"), F.col("id"), 42, 4096)
    assert (got["key"], got["tie"]) == (5, 41)


def test_sorts(spark):
    df = spark.createDataFrame([("b", "2"), (None, "9"), ("a", "3"), ("b", "1")], "x string, y string")
    expected = [(None, "9"), ("a", "3"), ("b", "1"), ("b", "2")]
    assert [tuple(r) for r in sort_by(df, "x", "y").collect()] == expected
    assert [tuple(r) for r in sort_by_position(df, 0, 1).collect()] == expected


@pytest.mark.parametrize("copies", [False, True])
def test_a_hot_key_is_spread_over_the_sorted_partitions(spark, copies):
    rows = [("hot", "same" if copies else f"{i:04d}") for i in range(1000)]
    rows += [(f"k{i:04d}", "x") for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, v string").repartition(6)
    ordered = sort_by(df, "k", copies=copies)
    assert sorted(map(tuple, ordered.collect())) == sorted(rows)
    assert [r["k"] for r in ordered.collect()] == sorted(k for k, _ in rows)
    parts = ordered.withColumn("p", F.spark_partition_id())
    sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert max(sizes) < 800


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_join(spark, how):
    rows, df = skewed(spark)
    lookup = spark.createDataFrame([(k, f"name{k}") for k in range(40)], "k int, name string")
    joined = lookup_join(df, lookup, "k", how)
    got = sorted((r["id"], r["name"]) for r in joined.collect() if r["name"])
    assert got == sorted((i, f"name{k}") for k, i in rows if k < 40)
    assert joined.count() == (len(rows) if how == "left" else len(got))


def test_split_takes_the_head_of_the_shuffled_order(spark):
    df = spark.range(1000).withColumnRenamed("id", "i")
    got = {r["i"] for r in B.train_valid_split(df, "i", 350).collect() if r["split"] == "validation"}
    assert got == set(sorted(range(1000), key=key_of)[:350])
    splits = {r[0] for r in B.train_valid_split(df, "i", 0).select("split").distinct().collect()}
    assert splits == {"train"}
    splits = {r[0] for r in B.train_valid_split(df, "i", 1001).select("split").distinct().collect()}
    assert splits == {"validation"}


def test_batches_leave_the_rest_out(spark):
    df = spark.range(10).withColumnRenamed("id", "i")
    batches = B.assign_batches(df, "i", 3)
    assert sorted(r["batch"] for r in batches.collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    sharded = B.shard_batches(batches, 2, 3, truncate=True)
    assert sorted({(r["batch"], r["worker"]) for r in sharded.collect()}) == [(0, 0), (1, 1)]
    untruncated = B.shard_batches(batches, 2, 3)
    assert sorted({(r["batch"], r["worker"]) for r in untruncated.collect()}) == [(0, 0), (1, 1), (2, 0)]


def test_epochs_have_their_own_order(spark):
    df = spark.range(11).withColumnRenamed("id", "i")
    rows = B.epoch_batches(df, "i", 4, 3).collect()
    for epoch in range(3):
        base = sorted(range(11), key=lambda i: (key_of(i), i))
        order = [base[i] for i in Permutation.of(11).numbers(np.arange(11), epoch)]
        got = {r["position"]: r["i"] for r in rows if r["epoch"] == epoch}
        assert got == dict(enumerate(order[:8]))
        assert all(r["batch"] == r["position"] // 4 for r in rows)
    assert B.epochs_needed(7, 100, 350) == 2 and B.epochs_needed(8, 100, 400) == 2


@pytest.mark.parametrize("n", [1, 2, 3, 7, 500, 997, 4099])
def test_permutations_by_arithmetic(spark, n):
    order = Permutation.of(n)
    df = spark.range(n).repartition(3).withColumn("epoch", F.explode(F.array(F.lit(2), F.lit(9))))
    rows = order.with_places(df, "id", "place", "epoch").collect()
    for seed in (2, 9):
        places = [r["place"] for r in sorted((r for r in rows if r["epoch"] == seed), key=lambda r: r["id"])]
        assert places == order.places(np.arange(n), seed).tolist() and sorted(places) == list(range(n))
        assert order.numbers(np.array(places), seed).tolist() == list(range(n))
    single = order.with_places(spark.range(n), "id", "place", 9).collect()
    assert [r["place"] for r in sorted(single)] == order.places(np.arange(n), 9).tolist()


def test_shuffled_ids_have_no_stride(spark):
    keys = [key_of(i, 3) for i in range(2000)]
    got = [r[0] for r in spark.range(2000).select(shuffle_key(F.col("id"), 3)).collect()]
    assert got == keys and len(set(keys)) == 2000
    # A batch of consecutive places holds each remainder of the id about equally often.
    batch = sorted(range(2000), key=keys.__getitem__)[:200]
    steps = np.diff(sorted(batch))
    assert len(np.unique(steps)) > 15
    assert max(np.bincount(np.array(batch) % 8)) < 45


def test_replicas_take_equal_parts(spark):
    df = B.assign_batches(spark.range(24).withColumnRenamed("id", "i"), "i", 12)
    counts = B.split_over_replicas(df, 12, 3).groupBy("batch", "replica").count().collect()
    assert sorted(tuple(r) for r in counts) == [(b, r, 4) for b in range(2) for r in range(3)]
    with pytest.raises(ValueError):
        B.split_over_replicas(df, 12, 5)


def test_shards_are_contiguous_ranges(spark):
    df = B.train_valid_split(spark.range(103).withColumnRenamed("id", "i"), "i", 20)
    rows = B.assign_shards(df, "i").collect()
    for split, size in (("validation", 20), ("train", 83)):
        order = sorted((r["i"] for r in rows if r["split"] == split), key=key_of)
        shard = {r["i"]: r["shard"] for r in rows}
        assert [shard[i] for i in order] == [p // -(-size // 5) for p in range(size)]
    assert "flowers_train_00004-of-00005" in {r["shard_file"] for r in rows}


def test_shards_move_no_rows_by_split(spark):
    df = B.train_valid_split(spark.range(200).withColumnRenamed("id", "i"), "i", 20)
    # As for a table too large to be broadcast by its own size.
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = operators(B.assign_shards(df, "i"))
    exchanges = [line for line in plan if line.startswith("Exchange")]
    assert sum("BroadcastHashJoin" in line for line in plan) == 1 and not any("SortMergeJoin" in line for line in plan)
    # The sizes' own aggregation.
    assert len(exchanges) == 1


def test_split_counts(spark):
    df = spark.createDataFrame(
        [("train", "a"), ("train", "a"), ("train", "b"), ("validation", None)], "split string, c string"
    )
    assert sorted(tuple(r) for r in B.split_counts(df, "c").collect()) == [
        ("train", 3, 2), ("validation", 1, 0),
    ]
