import math
import os

import numpy as np
import pytest
from cases import CLASHES, tuples
from pyspark.sql import functions as F
from rankflow.llm import kdtree
from rankflow.session import shared_dir

NAN, INF = float("nan"), float("inf")


def table(spark, rows, kind="float"):
    made = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>").repartition(4)
    return made.select("*", *[F.lit("clash").alias(name) for name in CLASHES if name not in ("id", "vector")])


def brute(rows, is_query, k=20, width=8, single=True):
    whole = []
    for i, v in rows:
        if i is None or v is None or any(x is None for x in v) or len(v) != width:
            continue
        v = [float(np.float32(x)) if single else x for x in v]
        if all(math.isfinite(64 * x) for x in v):
            whole.append((i, tuple(math.floor(64 * x) for x in v)))
    whole = sorted(set(whole))
    answers = []
    for q, x in whole:
        if is_query(q):
            scored = sorted(
                (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(x, v)))), i)
                for i, v in whole if (i, v) != (q, x)
            )
            answers += [(q, place + 1, i, -minus) for place, (minus, i) in enumerate(scored[:k])]
    return sorted(answers)


def found(spark, rows, is_query, k=20, kind="float"):
    got = kdtree.largest_products(table(spark, rows, kind), is_query, k)
    return sorted(tuples(got, "query_id", "rank", "id", "score"))


def test_awkward_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 2)]) for i in range(150)]
    # A vector that very many rows share, repeated rows, repeated ids, and rows that take no part.
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [rows[5], rows[5], (6, rows[9][1]), (9, rows[6][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [NAN] * 8), (306, [INF] + [1.0] * 7),
             (309, [None] + [1.0] * 7), (312, [1.0, 2.0]), (None, rows[0][1]), (315, [-0.0] * 8)]
    want = brute(rows, lambda i: i % 3 == 0)
    assert found(spark, rows, F.col("id") % 3 == 0) == want and want


def test_many_cells_shards_and_leaves(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(kdtree, "MAX_CELLS", 9)
    monkeypatch.setattr(kdtree, "FIT_ROWS", 60)
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    monkeypatch.setattr(kdtree, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 8))
    rows = [(i, [float(np.float32(x)) for x in np.round(centres[i % 12] + rng.normal(size=8) * 0.2, 1)]) for i in range(900)]
    want = brute(rows, lambda i: i % 10 == 0, k=7)
    assert found(spark, rows, F.col("id") % 10 == 0, 7) == want


def test_products_beyond_64_bits(spark):
    big = [[1e30, -1e30], [1e30, 1e30], [3.0, 1e17], [-2e17, 5.0], [1e16 + 3, 7.0], [1e308, 1.0], [0.25, 0.5], [1e8, 1e8]]
    rows = [(i, v) for i, v in enumerate(big)]
    assert found(spark, rows, F.lit(True), 4, "double") == brute(rows, lambda i: True, 4, width=2, single=False)


def test_few_none_and_empty_vectors(spark):
    assert found(spark, [(0, [1.0, 0.5]), (1, [1.0, 1.0])], F.col("id") == 0) == [(0, 1, 1, 64 * 64 + 32 * 64)]
    assert found(spark, [(0, [1.0])], F.lit(True)) == [] and found(spark, [], F.lit(True)) == []
    assert found(spark, [(0, [1.0]), (1, [2.0])], F.lit(False)) == []
    assert found(spark, [(0, []), (1, []), (2, [])], F.col("id") == 1) == [(1, 1, 0, 0), (1, 2, 2, 0)]


def test_trees_skip_boxes_that_cannot_answer():
    rng = np.random.default_rng(2)
    x = np.floor(64 * np.concatenate([rng.normal(loc=c, scale=0.05, size=(500, 4)) for c in (-3, 0, 1, 3)]))
    ids = np.arange(len(x))
    tree = kdtree.build_tree(x, ids)
    order = tree["order"]
    assert sorted(order.tolist()) == ids.tolist()
    for (start, end), low, high in zip(tree["bounds"], tree["low"], tree["high"]):
        own = x[order[start:end]]
        assert (own.min(axis=0) == low).all() and (own.max(axis=0) == high).all()
    read = []

    class Spy(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, slice):
                read.append(key.stop - key.start)
            return np.asarray(super().__getitem__(key))

    query = np.full((1, 4), 100.0)
    ((_, hits),) = kdtree.search_tree(tree, x[order].view(Spy), ids[order], query, [None], 5)
    score = x @ query[0]
    assert [(s, i) for s, i, _ in hits] == sorted(zip(score.tolist(), (-ids).tolist()), reverse=True)[:5]
    # All leaves of the three lower groups are left out, and a floor beyond reach leaves out everything.
    assert sum(read) <= 700
    assert list(kdtree.search_tree(tree, x[order], ids[order], query, [10**9], 5)) == []


def test_only_the_result_stays_on_disk(spark):
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    result = kdtree.largest_products(table(spark, [(i, [i / 3, 1.0]) for i in range(30)]), F.lit(True), 2)
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("rankflow-")]) == 1 and result.count() == 60


@pytest.mark.parametrize("cells", [1, 5, 64])
def test_splits_place_every_row(cells):
    rng = np.random.default_rng(3)
    sample = np.floor(rng.normal(size=(500, 3)) * 4)
    splits = kdtree.Splits(sample, cells)
    counts = np.bincount(splits.cell(sample))
    assert (counts > 0).sum() == cells and counts.max() < 4 * 500 / cells + 30
