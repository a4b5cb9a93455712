import itertools
import os
from collections import defaultdict

import numpy as np
from cases import ROWS, SCHEMA, documents, tuples, words
from compare import operators
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rankflow.llm import mixing
from rankflow.session import shared_dir

FIELDS = ("id", "size", "source", "source_size", "target", "copies")


def water_filling(sizes, weights=(1.0, 2.0, 3.0), cap=3):
    """Targets by sharing the excess again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > cap * sizes[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: cap * sizes[s] for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def check(rows, got):
    sizes = defaultdict(int)
    for _, text, _, source, _ in rows:
        sizes[source] += len(words(text))
    want = water_filling(sizes)
    taken = defaultdict(int)
    for _, size, source, source_size, target, copies in got:
        assert source_size == sizes[source] and abs(target - want[source]) < 1e-6 * max(1, want[source])
        assert 0 <= copies <= 3
        taken[source] += copies * size
    assert len(got) == len(rows)
    return taken, want


def test_awkward_rows(spark):
    got = tuples(mixing.mix(documents(spark)), *FIELDS)
    check(ROWS, got)
    assert sorted(map(str, got)) == sorted(map(str, tuples(mixing.mix(documents(spark)), *FIELDS)))
    assert mixing.mix(documents(spark).filter("false")).count() == 0


def test_targets_are_met(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), None, f"s{min(i % 11, 4)}", None) for i in range(1500)]
    docs = documents(spark, rows)
    taken, want = check(rows, tuples(mixing.mix(docs), *FIELDS))
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    chosen = tuples(mixing.mixed_documents(docs), "doc_id", "text", "source")
    assert sum(len(words(text)) for _, text, _ in chosen) == sum(taken.values())


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3), min_size=1, max_size=5), st.integers(0, 300))
def test_knapsack_is_the_best_subset_sum(counts, budget):
    lengths, numbers = np.array(list(counts)), np.array(list(counts.values()))
    take = mixing.bounded_knapsack(lengths, numbers, budget)
    assert (take >= 0).all() and (take <= numbers).all()
    sums = {sum(c * n for c, n in zip(chosen, counts)) for chosen in itertools.product(*[range(v + 1) for v in counts.values()])}
    assert int((take * lengths).sum()) == max(s for s in sums if s <= budget)


def test_hot_length_is_split_by_hash(spark):
    rows = [(i, "one two three", None, "a" if i % 3 else "b", None) for i in range(3000)]
    taken, want = check(rows, tuples(mixing.mix(documents(spark, rows)), *FIELDS))
    assert all(abs(taken[s] - want[s]) < 3 for s in want)


def test_all_lengths_take_part():
    lengths = np.array([*range(2, 4002, 2), 3001])
    counts = np.ones(len(lengths), dtype=np.int64)
    take = mixing.fit_lengths(lengths, counts, 7001)
    assert (take <= counts).all() and int((take * lengths).sum()) == 7001


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 60_000), st.integers(1, 9), min_size=1, max_size=8), st.integers(0, 400_000))
def test_the_miss_is_smaller_than_any_document_left(counts, budget):
    lengths, numbers = np.array(list(counts)), np.array(list(counts.values()))
    take = mixing.fit_lengths(lengths, numbers, budget)
    missed = budget - int((take * lengths).sum())
    assert (take >= 0).all() and (take <= numbers).all() and missed >= 0
    assert all(length > missed for length in lengths[take < numbers])


def test_one_row_repeated_very_often(spark):
    rows = [(1, "one two three", "en", "a", 5)] * 100_000 + [(2 + i, "x y", "en", "b", 1) for i in range(500)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    mixed = mixing.mix(docs)
    got = {(r["id"], r["copies"]): r["n"] for r in mixed.groupBy("id", "copies").agg(F.count("*").alias("n")).collect()}
    words = 3 * 100_000 + 2 * 500
    taken = 3 * sum(copies * n for (i, copies), n in got.items() if i == 1)
    # Source b is at its cap of three times its 1,000 words; a gets the rest.
    assert abs(taken - (words - 3000)) < 3 and {c for i, c in got if i != 1} == {3}
    assert mixing.mixed_documents(docs).filter("doc_id = 1").count() * 3 == taken


def test_texts_are_not_shuffled_and_only_small_tables_stay(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), None, f"s{min(i % 11, 4)}", None) for i in range(1500)]
    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder))
    docs = documents(spark, rows)
    result = mixing.mixed_documents(docs)
    lines = operators(result)
    # The way from the result down to the first table read, that of the texts: the fixture's own repartitioning is all.
    way = lines[: next(i for i, line in enumerate(lines) if "Scan" in line)]
    assert not any("hashpartitioning" in line or "SortMergeJoin" in line for line in way)
    assert any("BroadcastHashJoin" in line for line in way)
    left = [x for x in set(os.listdir(folder)) - before if x.startswith("rankflow-")]
    assert len(left) <= 3


def test_texts_without_words_are_never_taken(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), None, "a" if i % 2 else "b", None) for i in range(60)]
    blank = [(100 + i, text, None, source, None) for i, (text, source) in enumerate(
        itertools.product([None, "", " \t\n"], ["a", "b"])
    )]
    docs = documents(spark, rows + blank)
    got = tuples(mixing.mix(docs), *FIELDS)
    taken, want = check(rows + blank, got)
    # Both sources are below their caps, and neither target is a number of whole rounds.
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    assert {copies for id, *_, copies in got if id >= 100} == {0}
    assert all(words(text) for _, text in tuples(mixing.mixed_documents(docs), "doc_id", "text"))
    lengths, counts = np.array([0, 9000, 20_000]), np.array([5, 2, 1])
    assert mixing.fit_lengths(lengths, counts, 20_000).tolist()[0] == 0
    assert mixing.fit_lengths(lengths, counts, 38_000).tolist() == [0, 2, 1]
