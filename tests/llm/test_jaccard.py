import os
import random
from collections import Counter

import numpy as np
import pytest
from cases import ROWS, documents, prose, tuples, words
from rankflow.llm import jaccard
from rankflow.llm.components import components
from rankflow.session import scratch, shared_dir


def brute(rows, n=5):
    sets = []
    for _, text, *_ in rows:
        own = words(text)
        sets.append({tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1))} if own else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[find(i)] = min(least.get(find(i), row[0]), row[0])
    return [(row[0], len(sets[i]), least.get(find(i)) if sets[i] else row[0]) for i, row in enumerate(rows)]


def family(seed, copies, length=80):
    """Copies of one text with some words changed: a large group of which only some pairs are similar."""
    own = random.Random(seed)
    base = prose(seed, length, 10_000).split(" ")
    made = []
    for _ in range(copies):
        text = list(base)
        for _ in range(own.randrange(4)):
            text[own.randrange(length)] = f"n{own.randrange(10**6)}"
        made.append(" ".join(text))
    return made


@pytest.mark.parametrize("tile", [1024, 16])
def test_components_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "LARGE_TILE", tile)
    passage = prose(99, 30)
    texts = family(1, 90) + family(2, 20, 30) + [prose(i, 40) + " " + passage for i in range(60)]
    texts += [prose(1000 + i, 60) for i in range(30)]
    rows = [*ROWS, *[(100 + i, text, None, None, None) for i, text in enumerate(texts)]]
    random.Random(5).shuffle(rows)
    got = tuples(jaccard.similarity_components(documents(spark, rows)), "id", "n_shingles", "component_id")
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_a_large_family_of_which_some_pairs_link(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 128)
    monkeypatch.setattr(jaccard, "LARGE_TILE", 512)
    own = random.Random(8)
    base = prose(77, 40, 10_000).split(" ")
    rows = []
    for i in range(2000):
        text = list(base)
        for _ in range(own.randrange(7)):
            text[own.randrange(len(text))] = f"n{own.randrange(10**6)}"
        rows.append((i, " ".join(text), None, None, None))
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    result = jaccard.similarity_components(documents(spark, rows))
    assert len([x for x in set(os.listdir(folder)) - before if x.startswith("rankflow-")]) == 1
    want = brute(rows)
    assert sorted(tuples(result, "id", "n_shingles", "component_id")) == sorted(want)
    sizes = Counter(component for *_, component in want)
    assert max(sizes.values()) > 300 and len(sizes) > 1000


def test_texts_that_meet_in_passages_are_no_candidates(spark):
    passages = [prose(500 + i, 14, 10_000) for i in range(8)]
    unlike = [f"{prose(i, 150, 10**6)} {passages[i % 8]} {prose(900 + i, 150, 10**6)}" for i in range(80)]
    alike = family(3, 4, 300)
    rows = [(i, text, None, None, None) for i, text in enumerate(unlike + alike)]
    with scratch(spark) as own:
        classes, *_ = jaccard._classes(jaccard._keyed(documents(spark, rows), "doc_id", "text"), 5)
        nothing = spark.sparkContext.broadcast(np.zeros(0, dtype=np.uint64))
        groups = jaccard._groups(own, jaccard._postings(classes, 5, nothing))
        found = {text for (text,) in tuples(groups.select("cid").distinct().join(classes, "cid"), "text")}
    assert found == set(alike)


def test_links_at_the_limit(spark):
    # A text with k more words than one of n n-grams is similar up to k = n / 4.
    texts = []
    for n in [*range(1, 45), 120, 401, 1203]:
        own = [f"t{n}x{i}" for i in range(n + 4 + n // 4 + 1)]
        texts += [" ".join(own[: n + 4]), " ".join(own[:-1]) if n % 2 else " ".join(own)]
        own = [f"u{n}x{i}" for i in range(n + 4 + n // 4 + 1)]
        texts += [" ".join(own[-n - 4 :]), " ".join(own), " ".join(own[1:])]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    got = tuples(jaccard.similarity_components(documents(spark, rows)), "id", "n_shingles", "component_id")
    assert sorted(got) == sorted(brute(rows))


@pytest.mark.parametrize("sent", [0, 500_000])
def test_rows_that_may_go_are_broadcast_or_shuffled(spark, monkeypatch, sent):
    monkeypatch.setattr(jaccard, "DOUBTFUL_SENT", sent)
    got = jaccard.without_near_duplicates(documents(spark))
    ids = sorted((row[0] is None, row[0] or 0) for row in tuples(got, "doc_id"))
    assert ids == [(False, i) for i in (1, 4, 5, 6, 7, 9, 10, 12, 13, 14, 15)] + [(True, 0)]


def test_empty_table(spark):
    assert jaccard.similarity_components(documents(spark).filter("false")).count() == 0


def test_one_row_of_each_component_stays(spark):
    docs = documents(spark)
    got = jaccard.without_near_duplicates(docs)
    assert got.columns == docs.columns
    ids = sorted((row[0] is None, row[0] or 0) for row in tuples(got, "doc_id"))
    assert ids == [(False, i) for i in (1, 4, 5, 6, 7, 9, 10, 12, 13, 14, 15)] + [(True, 0)]


def test_bitmaps_bound_the_overlap():
    rng = np.random.default_rng(1)
    for size in (3, 50, 700):
        pool = rng.integers(0, 2**63, size * 2, dtype=np.uint64)
        a, b = rng.choice(pool, size, replace=False), rng.choice(pool, size, replace=False)
        for bits in (64, 256, 4096):
            x, y = jaccard.bitmap(a, 4096), jaccard.bitmap(b, bits)
            x = jaccard.fold(x, len(y))
            differ = int(np.bitwise_count(x ^ y).sum())
            assert (len(a) + len(b) - differ) // 2 >= len(np.intersect1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    own = random.Random(0)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 301), (301, 300)]
    own.shuffle(links)
    got = dict(tuples(components(spark.createDataFrame(links, "a bigint, b bigint")), "node", "label"))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
