import numpy as np
from cases import CLASHES, tuples
from pyspark.sql import functions as F
from rankflow.llm import ann

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(4)
    return made.select("*", *[F.lit("clash").alias(name) for name in CLASHES if name not in ("id", "vector")])


def brute(rows, ids, k=5):
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if i is not None and v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any() and len(v) == 8]
    answers = {}
    for q, x in good:
        if q in ids:
            scored = sorted((-(x @ v) / np.sqrt((x @ x) * (v @ v)), i) for i, v in good if i != q)[:k]
            answers[q] = scored
    return answers


def test_small_table_with_copies_and_bad_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8), 2)]) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [NAN] * 8), (304, [INF] + [1.0] * 7), (305, [None] + [1.0] * 7),
             (306, [1.0, 2.0]), (None, rows[0][1])]
    got = tuples(ann.nearest(table(spark, rows), F.col("id") % 3 == 0), "query_id", "rank", "id", "score")
    want = brute(rows, {i for i, _ in rows if i is not None and i % 3 == 0})
    assert {q for q, *_ in got} == set(want)
    for q, answers in want.items():
        own = sorted((rank, i, score) for query, rank, i, score in got if query == q)
        assert [rank for rank, *_ in own] == [1, 2, 3, 4, 5]
        assert np.allclose([s for *_, s in own], [-s for s, _ in answers], atol=1e-12)
        assert [i for _, i, _ in own] == [i for _, i in answers]


def test_few_and_none(spark):
    two = [(0, [1.0, 0.0]), (3, [1.0, 1.0])]
    got = tuples(ann.nearest(table(spark, two), F.col("id") == 0), "query_id", "rank", "id")
    assert got == [(0, 1, 3)]
    assert ann.nearest(table(spark, two).filter("false"), F.lit(True)).count() == 0


def test_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "TILE_ROWS", 50)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] + rng.normal(size=8) * 0.4]) for i in range(1500)]
    got = tuples(ann.nearest(table(spark, rows), F.col("id") % 10 == 0, list_rows=25), "query_id", "id")
    want = brute(rows, set(range(0, 1500, 10)))
    hits = sum(len({i for q, i in got if q == query} & {i for _, i in answers}) for query, answers in want.items())
    assert hits / (5 * len(want)) > 0.9


def test_graph_search_finds_near_centroids():
    rng = np.random.default_rng(2)
    sample = ann._unit(rng.normal(size=(3000, 16)))
    index = ann.build_index(sample, 300)
    sizes = np.bincount((sample @ index.centroids.T).argmax(axis=1), minlength=300)
    assert len(index.centroids) == 300 and sizes.max() < 20 * max(1, np.median(sizes))
    ids, distance = ann.search_graph(index, sample[:200], 10)
    exact = np.argsort(-(sample[:200] @ index.centroids.T), axis=1)[:, :10]
    assert (np.diff(distance, axis=1) >= 0).all()
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids.tolist(), exact.tolist())]) > 0.9


def test_queries_read_all_lists_within_the_ratio_and_enough_of_them(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(1600)]
    want = brute(rows, set(range(0, 1600, 20)))

    def answers(**settings):
        got = tuples(ann.nearest(table(spark, rows), F.col("id") % 20 == 0, list_rows=1, **settings), "query_id", "rank", "id")
        return {q: [i for _, i in sorted((rank, i) for query, rank, i in got if query == q)] for q in want}

    exact = {q: [i for _, i in found] for q, found in want.items()}
    assert answers(search_ratio=1e9) == exact
    # Lists of one vector each: a query's own list alone would give none.
    monkeypatch.setattr(ann, "SHELF_LISTS", 1)
    assert all(len(found) == 5 for found in answers(search_ratio=1.0).values())


def test_queries_find_their_lists_through_the_graph():
    rng = np.random.default_rng(5)
    sample = ann._unit(rng.normal(size=(4000, 16)))
    index = ann.build_index(sample, 400)
    homes = np.bincount((sample @ index.centroids.T).argmax(axis=1), minlength=400)
    asked = sample[:100]
    rows, lists = ann.lists_to_read(index, asked, 1.1, homes, 6)
    distance = np.sqrt(np.maximum(0, 2 - 2 * asked @ index.centroids.T))
    wanted = distance <= distance.min(axis=1, keepdims=True) * 1.1
    found = np.zeros_like(wanted)
    found[rows, lists] = True
    assert (found & wanted).sum() > 0.95 * wanted.sum() and found.sum() < 1.3 * wanted.sum() + 300
    rows, lists = ann.lists_to_read(index, asked[:3], 1e9, homes, 6)
    assert sorted(zip(rows.tolist(), lists.tolist())) == [(r, c) for r in range(3) for c in range(400)]


def test_lists_that_outgrow_their_length_are_bisected(spark, monkeypatch):
    monkeypatch.setattr(ann, "MAX_LISTS", 4)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 60] + rng.normal(size=8) * 0.2]) for i in range(3000)]
    got = tuples(ann.nearest(table(spark, rows), F.col("id") % 30 == 0, list_rows=32), "query_id", "id")
    want = brute(rows, set(range(0, 3000, 30)))
    hits = sum(len({i for q, i in got if q == query} & {i for _, i in answers}) for query, answers in want.items())
    assert hits / (5 * len(want)) > 0.9 and len(got) == 5 * len(want)
    x = ann._unit(np.array([v for _, v in rows]))
    read = sum(len(a) * len(b) for a, b in ann._parts(x, x[:100], 32, 1.2, 6))
    assert read < 0.4 * len(x) * 100
