"""Link cleaning, graph preparation and ranking against hand-made and brute-force results."""

import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from compare import operators
from rankflow.operators import blocks
from rankflow.operators import edges as E
from rankflow.operators.pagerank import CO_PARTITION, Ranges, _iterate, _links, _place, pagerank
from rankflow.session import cut, session_settings, shared_dir


def graph(spark, pairs):
    return spark.createDataFrame(pairs, "src string, dst string")


def ranks(df):
    return {row["node"]: row["rank"] for row in df.collect()}


def brute_force(pairs, n_iter=10, damping=0.85, only_left=False, keep=False):
    degree = Counter(src for src, _ in pairs)
    current = {src: 1.0 for src in degree}
    for _ in range(n_iter):
        received = defaultdict(float)
        for src, dst in pairs:
            if src in current:
                received[dst] += current[src] / degree[src]
                if keep:
                    received[src] += 0.0
        current = {node: 1 - damping + damping * total for node, total in received.items()}
    return {n: r for n, r in current.items() if not only_left or n in degree}


def skewed_pairs(seed=3):
    """A third of the edges leave one node, a third enter one node, and some are copies."""
    rng = random.Random(seed)
    pairs = [("hub", f"n{rng.randrange(400)}") for _ in range(600)]
    pairs += [(f"n{rng.randrange(400)}", "sink") for _ in range(500)]
    pairs += [(f"n{rng.randrange(60)}", f"n{rng.randrange(60)}") for _ in range(500)]
    pairs += [("n1", "hub"), ("sink", "n2")] + [("n5", "n6")] * 300
    return pairs


LAYOUTS = [
    dict(),
    dict(layout="adjacency", row_entries=16),
    dict(partitioning="hash"),
    dict(partitioning="hash", layout="adjacency", row_entries=16),
    dict(partitioning="range"),
    dict(partitioning="range", layout="adjacency"),
    dict(cache=True),
    dict(cache=True, layout="adjacency", partitioning="hash"),
]


def test_parse_edges_keeps_only_clean_pairs(spark):
    lines = [
        "#c\td", " A \t\t B ", "\ta\tb", "a\tb\tc", "a\t", "a b", "File:x\ty", "Category:X\ty",
        "x\r\ty", "", "\t", "a\tTalk:b", " #x\ty",
    ]
    got = E.parse_edges(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert sorted(map(tuple, got)) == [
        ("#x", "y"), ("a", "b"), ("a", "b"), ("category:x", "y"), ("x", "y"),
    ]


def test_degrees_count_copies(spark):
    edges = graph(spark, [("a", "b"), ("a", "b"), ("a", "c"), ("b", "a")])
    assert {(r[0], r[1]) for r in E.out_degree(edges).collect()} == {("a", 3), ("b", 1)}
    assert ranks(E.initial_ranks(edges)) == {"a": 1.0, "b": 1.0}


def test_chain_vanishes(spark):
    edges = graph(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    assert ranks(pagerank(edges, 1)) == pytest.approx({"b": 1.0, "c": 1.0, "d": 1.0})
    assert set(ranks(pagerank(edges, 3))) == {"d"}
    assert ranks(pagerank(edges, 4)) == {}
    kept = ranks(pagerank(edges, 4, ignore_zero_incoming=False))
    assert kept == pytest.approx(brute_force([("a", "b"), ("b", "c"), ("c", "d")], 4, keep=True))


def test_two_cycle_with_tail(spark):
    edges = graph(spark, [("a", "b"), ("b", "a"), ("b", "c")])
    assert ranks(pagerank(edges, 1)) == pytest.approx({"a": 0.575, "b": 1.0, "c": 0.575})
    assert set(ranks(pagerank(edges, 1, only_left=True))) == {"a", "b"}


def test_duplicate_edges_and_self_loop(spark):
    pairs = [("a", "b"), ("a", "b"), ("a", "c"), ("b", "a"), ("c", "a")]
    assert ranks(pagerank(graph(spark, pairs), 1)) == pytest.approx(
        {"a": 0.15 + 0.85 * 2, "b": 0.15 + 0.85 * 2 / 3, "c": 0.15 + 0.85 / 3}
    )
    assert ranks(pagerank(graph(spark, [("a", "a")]))) == pytest.approx({"a": 1.0})


def test_no_edges(spark):
    assert ranks(pagerank(graph(spark, []), 2)) == {}


def test_zero_iterations_give_initial_ranks(spark):
    assert ranks(pagerank(graph(spark, [("a", "b")]), 0)) == {"a": 1.0}


def test_one_way_bipartite_graph_is_empty_after_two(spark):
    pairs = [(f"s{i % 7}", f"p{i % 20}") for i in range(200)]
    assert len(ranks(pagerank(graph(spark, pairs), 1))) == 20
    assert ranks(pagerank(graph(spark, pairs), 2)) == {}
    assert len(ranks(pagerank(graph(spark, pairs), 2, ignore_zero_incoming=False))) == 27


@pytest.mark.parametrize("options", LAYOUTS, ids=str)
@pytest.mark.parametrize("split_rows", [20, 100_000])
def test_all_layouts_match_brute_force(spark, options, split_rows):
    pairs = skewed_pairs()
    got = ranks(pagerank(graph(spark, pairs), 4, split_rows=split_rows, checkpoint_every=2, **options))
    assert got == pytest.approx(brute_force(pairs, 4))


@pytest.mark.parametrize("options", [dict(), dict(partitioning="hash", layout="adjacency")], ids=str)
def test_options_match_brute_force_with_a_split_hub(spark, options):
    pairs = skewed_pairs()
    edges = graph(spark, pairs)
    left = pagerank(edges, 3, only_left=True, split_rows=20, **options)
    assert ranks(left) == pytest.approx(brute_force(pairs, 3, only_left=True))
    kept = pagerank(edges, 3, ignore_zero_incoming=False, split_rows=20, **options)
    assert ranks(kept) == pytest.approx(brute_force(pairs, 3, keep=True))


def test_result_does_not_depend_on_input_order(spark):
    pairs = skewed_pairs()
    shuffled = random.Random(1).sample(pairs, len(pairs))
    assert ranks(pagerank(graph(spark, shuffled), 3)) == pytest.approx(
        ranks(pagerank(graph(spark, pairs), 3))
    )


def test_hub_is_split_and_others_are_not(spark):
    built = E.build_graph(graph(spark, skewed_pairs()), partitions=8, split_rows=20)
    assert [row["src"] for row in built.hubs.collect()] == ["hub"]
    sizes = built.edges.groupBy("src", "salt").count().collect()
    assert len({row["salt"] for row in sizes if row["src"] == "hub"}) > 1
    assert {row["salt"] for row in sizes if row["src"] != "hub"} == {0}
    assert built.edges.agg(F.sum("w")).first()[0] == len(skewed_pairs())


def test_adjacency_rows_are_bounded_and_whole(spark):
    pairs = skewed_pairs()
    rows = E.adjacency(graph(spark, pairs), entries=10).collect()
    assert max(len(row["entries"]) for row in rows) <= 10
    whole = Counter()
    for row in rows:
        for dst, w in row["entries"]:
            whole[row["src"], dst] += w
        assert row["size"] == sum(entry["w"] for entry in row["entries"])
    assert whole == Counter(pairs)
    again = E.adjacency(graph(spark, pairs).repartition(2), entries=10).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


@pytest.mark.parametrize("layout", ["edges", "adjacency"])
@pytest.mark.parametrize("cache", [False, True])
def test_a_placed_iteration_shuffles_only_contributions(spark, layout, cache):
    pairs = [(f"n{i % 50}", f"n{(i * 7) % 50}") for i in range(500)]
    built = E.build_graph(graph(spark, pairs))
    links = _place(_links(built, layout, 100), built, cache)
    first = _iterate(None, links, built, layout, 0.85)
    second = _iterate(first, links, built, layout, 0.85)
    plan = operators(second)
    exchanges = [line for line in plan if "Exchange" in line]
    assert sum("ShuffledHashJoin" in line for line in plan) == 1 and not any(line.startswith("Sort ") for line in plan)
    assert len(exchanges) == 2 and all("hashpartitioning(dst" in line for line in exchanges)


@pytest.mark.parametrize("layout", ["edges", "adjacency"])
def test_a_split_hub_moves_ranks_but_no_links(spark, layout):
    built = E.build_graph(graph(spark, skewed_pairs()), split_rows=20)
    assert built.hubs is not None
    links = _place(_links(built, layout, 100), built, False)
    first = _iterate(None, links, built, layout, 0.85)
    plan = operators(_iterate(first, links, built, layout, 0.85))
    hashed = [line for line in plan if "Exchange hashpartitioning" in line]
    assert sum("hashpartitioning(dst" in line for line in hashed) == 2
    assert sum("hashpartitioning(src" in line and "salt" in line for line in hashed) == 1
    assert len(hashed) == 3 and sum("ShuffledHashJoin" in line for line in plan) == 1


@pytest.mark.parametrize("layout", ["edges", "adjacency"])
@pytest.mark.parametrize("split_rows", [20, 100_000])
def test_stored_ranges_survive_iterations(spark, layout, split_rows):
    built = E.build_graph(graph(spark, skewed_pairs()), partitions=8, split_rows=split_rows)
    ranges = Ranges.of(built)
    with session_settings(spark, {CO_PARTITION: "false"}):
        links = _place(_links(built, layout, 100, ranges), built, False, ranges)
        first = _iterate(None, links, built, layout, 0.85, ranges)
        plan = operators(_iterate(first, links, built, layout, 0.85, ranges))
    hashed = [line for line in plan if "Exchange" in line and "Broadcast" not in line]
    # Contributions of two steps, and the ranks between them; never the links.
    assert sum("hashpartitioning(dst" in line for line in hashed) == 2
    assert sum("hashpartitioning(place" in line for line in hashed) == 1 and len(hashed) == 3
    if split_rows > 20:
        # A file holds one range: its names lie between two bounds.
        rows = links.groupBy(F.input_file_name().alias("file")).agg(F.min("src").alias("low"), F.max("src").alias("high")).collect()
        spans = sorted((row["low"], row["high"]) for row in rows)
        assert len(spans) > 3 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("options", [dict(), dict(layout="adjacency"), dict(partitioning="range")], ids=str)
def test_an_iteration_moves_only_values(spark, options, monkeypatch):
    """A block sends another one number for each node; names and links stay."""
    sent = []

    def noted(df, name, *more):
        written = cut(df, name, *more)
        if name == "sent":
            sent.append((operators(df), sum(len(row["data"]) // 8 for row in written.collect())))
        return written

    monkeypatch.setattr(blocks, "cut", noted)
    pairs = skewed_pairs()
    got = ranks(pagerank(graph(spark, pairs), 3, checkpoint_every=1, num_partitions=5, **options))
    assert got == pytest.approx(brute_force(pairs, 3)) and len(sent) == 2
    plan, values = sent[1]
    moved = [line for line in plan if "Exchange" in line]
    assert len(moved) == 1 and "hashpartitioning(place" in moved[0]
    # At most a sum for each target and a share of each far source in each block.
    assert values <= 5 * len({node for pair in pairs for node in pair})
    assert values < len(set(pairs))


def test_nodes_of_one_hash_are_told_apart(spark, monkeypatch):
    pairs = skewed_pairs()
    ids = blocks.Placement.ids
    # The first numbers give two nodes one hash.
    monkeypatch.setattr(
        blocks.Placement, "ids",
        lambda self, name: ids(self, F.when((name == "n1") & F.lit(self.seed == 0), "n2").otherwise(name)),
    )
    assert ranks(pagerank(graph(spark, pairs), 3)) == pytest.approx(brute_force(pairs, 3))


@pytest.mark.parametrize("options", LAYOUTS[::3], ids=str)
def test_null_names_hold_no_rank_as_sources(spark, options):
    pairs = [("a", "b"), ("b", "a"), ("a", None), (None, "b"), (None, None), ("b", "c"), ("b", "c")]
    for more in (dict(), dict(only_left=True), dict(ignore_zero_incoming=False), dict(n_iter=0)):
        edges = graph(spark, pairs)
        assert ranks(pagerank(edges, **options, **more)) == pytest.approx(ranks(pagerank(edges, blocks=False, **options, **more)))


@pytest.mark.parametrize("options", LAYOUTS, ids=str)
def test_rows_and_blocks_agree(spark, options):
    edges = graph(spark, skewed_pairs())
    rows = ranks(pagerank(edges, 4, split_rows=20, checkpoint_every=2, blocks=False, **options))
    assert rows == pytest.approx(ranks(pagerank(edges, 4, checkpoint_every=2, **options)))


def test_ranking_leaves_only_its_result(spark):
    folder = shared_dir(spark).removeprefix("file://")
    for options in LAYOUTS:
        before = set(os.listdir(folder))
        result = pagerank(graph(spark, skewed_pairs()), 3, checkpoint_every=2, **options)
        assert len(set(os.listdir(folder)) - before) == 1 and result.count()


def test_adjacency_lists_across_partition_borders(spark):
    rng = random.Random(9)
    pairs = [("hub", f"t{i:05d}") for i in range(3000)] + [("hub2", f"t{i:05d}") for i in range(64)]
    pairs += [(f"s{rng.randrange(300)}", f"t{rng.randrange(50):05d}") for _ in range(2000)]
    rows = E.adjacency(graph(spark, pairs), entries=32).collect()
    lists, counts = defaultdict(dict), Counter(pairs)
    for row in rows:
        lists[row["src"]][row["chunk"]] = [(entry["dst"], entry["w"]) for entry in row["entries"]]
    degrees = Counter(src for src, _ in pairs)
    for src, chunks in lists.items():
        targets = sorted((dst, w) for (own, dst), w in counts.items() if own == src)
        assert [entry for i in range(len(chunks)) for entry in chunks[i]] == targets
        assert all(len(chunks[i]) == 32 for i in range(len(chunks) - 1))
    assert set(lists) == set(degrees) and {row["src"]: row["out_degree"] for row in rows} == dict(degrees)
    assert E.adjacency(graph(spark, []), entries=4).count() == 0


def test_unknown_layout_is_refused(spark):
    with pytest.raises(ValueError):
        pagerank(graph(spark, [("a", "b")]), layout="matrix")


def test_partitions_follow_the_graph_and_the_setting_is_restored(spark, monkeypatch):
    monkeypatch.setattr(E, "PARTITION_EDGES", 10)
    edges = graph(spark, [(f"n{i % 50}", f"n{(i * 7) % 50}") for i in range(300)])
    distinct = E.weighted_edges(edges).count()
    assert E.build_graph(edges).partitions == max(8, -(-distinct // 10))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    pagerank(edges, 1, num_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
