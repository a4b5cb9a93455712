"""Iterative ranking with unnormalised damping.

``rank'(v) = (1 - damping) + damping * sum over edges (u, v) of rank(u) / out_degree(u)``

Only sources start with a rank. A node without in-links therefore gives its rank once and then
vanishes together with everything it alone kept alive, unless such sources are kept.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, replace
from itertools import accumulate

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.blocks import block_count, block_ranks, bucket_places, node_table
from rankflow.operators.edges import (
    ADJACENCY_ROW_ENTRIES,
    MIN_SPLIT_ROWS,
    Graph,
    build_graph,
    copy_to_salts,
    initial_ranks,
    split_adjacency,
)
from rankflow.session import SHUFFLE_PARTITIONS, Scope, cut, cut_bucketed, scratch, session_settings

# Defaults of the ranking programs.
ITERATIONS = 10
DAMPING = 0.85

PARTITIONINGS = (None, "hash", "range")
LAYOUTS = ("edges", "adjacency")


def pagerank(
    edges: DataFrame,
    n_iter: int = ITERATIONS,
    damping: float = DAMPING,
    only_left: bool = False,
    ignore_zero_incoming: bool = True,
    layout: str = "edges",
    partitioning: str | None = None,
    num_partitions: int | None = None,
    cache: bool = False,
    checkpoint_every: int = 5,
    split_rows: int = MIN_SPLIT_ROWS,
    row_entries: int = ADJACENCY_ROW_ENTRIES,
    blocks: bool = True,
) -> DataFrame:
    """``(node, rank)`` after ``n_iter`` iterations.

    Nodes lie in blocks of arrays (see :mod:`~rankflow.operators.blocks`), by hash, or with ``partitioning="range"`` by ranges of
    names; an iteration shuffles only values that one block sends another. The ``adjacency`` layout stores the length
    of each source's list instead of the source of each link. Edges are read twice and have to be the same then; write them first
    if their plan is not repeatable. ``num_partitions`` follows from the size of the graph unless given. ``only_left`` reports
    only nodes that occur as a source; ``ignore_zero_incoming=False`` keeps sources that nothing links to.

    With ``blocks=False`` links and ranks are rows that are joined: links are bucketed by source once, after which an iteration
    shuffles contributions, combined map-side, and ranks. Only this way splits large sources at ``split_rows`` and lists at ``row_entries``.
    """
    if layout not in LAYOUTS or partitioning not in PARTITIONINGS:
        raise ValueError(f"layout must be in {LAYOUTS} and partitioning in {PARTITIONINGS}")
    spark = edges.sparkSession
    if blocks:
        with scratch(spark) as own:
            return own.result(
                _block_ranks(
                    own, edges, n_iter, damping, only_left, not ignore_zero_incoming, layout == "adjacency",
                    partitioning == "range", num_partitions, cache, checkpoint_every,
                )
            )
    with scratch(spark) as own:
        graph = build_graph(edges, num_partitions, split_rows, keep_sources=not ignore_zero_incoming)
        settings = {SHUFFLE_PARTITIONS: str(graph.partitions)}
        ranges = None
        if partitioning == "range":
            ranges = Ranges.of(graph)
            settings[CO_PARTITION] = "false"
        ranks = None
        with session_settings(spark, settings):
            links = _place(_links(graph, layout, row_entries, ranges), graph, cache, ranges)
            try:
                for step in range(1, n_iter + 1):
                    ranks = _iterate(ranks, links, graph, layout, damping, ranges)
                    if step % checkpoint_every == 0 or step == n_iter:
                        ranks = cut(ranks, "ranks")
            finally:
                if cache:
                    links.unpersist()
        sources = graph.sources.select(F.col("src").alias("node"))
        if ranks is None:
            ranks = sources.withColumn("rank", F.lit(1.0))
        if only_left:
            ranks = ranks.join(sources, "node", "left_semi")
        return own.result(ranks.select("node", "rank"))


def _block_ranks(
    own: Scope, edges: DataFrame, n_iter: int, damping: float, only_left: bool, keep: bool, lists: bool, ranged: bool,
    num_partitions: int | None, cache: bool, checkpoint_every: int,
) -> DataFrame:
    if n_iter == 0:
        ranks = initial_ranks(edges)
        return cut(ranks.filter("node IS NOT NULL") if only_left else ranks, "ranks")
    nodes = node_table(edges)
    count = num_partitions or block_count(nodes)
    number = Ranges.of_nodes(nodes, count).number if ranged else None
    places = bucket_places(edges.sparkSession, count)
    with session_settings(edges.sparkSession, {SHUFFLE_PARTITIONS: str(count)}):
        ranks = block_ranks(own, edges, nodes, places, number, n_iter, damping, keep, lists, cache, checkpoint_every)
        if only_left:
            ranks = ranks.filter("out_degree > 0")
        return cut(ranks.select("node", "rank"), "ranks")


# Joins on a place and a name may use a placement by the place alone.
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"
# Names sampled for each range.
RANGE_SAMPLE = 50


@dataclass(frozen=True)
class Ranges:
    """Bounds of ranges of names, and the number that lands in each of as many buckets.

    Both have one entry per partition. A range's place is the number whose hash names the range's own bucket, so
    that stored buckets are ranges, and joins on the place know where they lie.
    """

    bounds: list[str]
    places: list[int]

    @staticmethod
    def of(graph: Graph) -> Ranges:
        """Ranges that hold about equal numbers of links, by a bounded sample of their sources."""
        count, spark = graph.partitions, graph.weighted.sparkSession
        sample = graph.weighted.orderBy(F.xxhash64("src", "dst"), "src", "dst").limit(RANGE_SAMPLE * count)
        # Code points and UTF-8 bytes have the same order.
        names = sorted(row["src"] for row in sample.select("src").collect())
        bounds = sorted({names[i * len(names) // count] for i in range(1, count)}) if names else []
        return Ranges(bounds, bucket_places(spark, count))

    @staticmethod
    def of_nodes(nodes: DataFrame, count: int) -> Ranges:
        """Ranges that hold about equal numbers of nodes and their links, by a bounded sample of ``nodes (node, out_degree)``."""
        named = nodes.filter("node IS NOT NULL")
        sample = named.orderBy(F.xxhash64("node"), "node").limit(RANGE_SAMPLE * count).collect()
        rows = sorted((row["node"], 1 + min(row["out_degree"], 2 * count)) for row in sample)
        ends = list(accumulate(weight for _, weight in rows))
        picked = {rows[bisect_right(ends, i * ends[-1] // count)][0] for i in range(1, count)} if rows else set()
        return Ranges(sorted(picked), [])

    def number(self, name: Column) -> Column:
        """The range of each name; names like a bound begin the range above it, and null lies in the first."""
        bounds = self.bounds

        @F.arrow_udf("int")
        def found(names: pa.Array) -> pa.Array:
            distinct = names.dictionary_encode()
            numbers = pa.array([bisect_right(bounds, own) for own in distinct.dictionary.to_pylist()], pa.int32())
            return numbers.take(distinct.indices)

        return found(F.coalesce(name, F.lit("")))

    def place(self, number: Column, salt: Column) -> Column:
        """Where a range's rows lie; the salts of a source that is split lie one after the other."""
        places = F.split(F.lit(",".join(map(str, self.places))), ",").cast("array<int>")
        return F.get(places, F.pmod(number + salt, F.lit(len(self.places))))


def _links(graph: Graph, layout: str, row_entries: int, ranges: Ranges | None = None) -> DataFrame:
    """What a source sends, per unit of its rank: one row per edge, or lists of targets."""
    more, beside = [], []
    if ranges is not None:
        numbered = graph.edges.withColumn("dst_range", ranges.number(F.col("dst")))
        placed = numbered.withColumn("place", ranges.place(ranges.number(F.col("src")), F.col("salt")))
        graph, more, beside = replace(graph, edges=placed), ["dst_range"], ["place"]
    if layout == "adjacency":
        part = 1.0 / F.col("out_degree")
        rows = split_adjacency(graph, row_entries)
        return rows.select(*beside, "src", "salt", "chunk", "entries", part.alias("part"))
    return graph.edges.select(*beside, "src", "salt", "dst", *more, (F.col("w") / F.col("out_degree")).alias("part"))


def _keys(graph: Graph, ranges: Ranges | None) -> list[str]:
    return graph.keys if ranges is None else ["place", *graph.keys]


def _place(links: DataFrame, graph: Graph, cache: bool, ranges: Ranges | None = None) -> DataFrame:
    """Write the links once, before the loop, in buckets by source or by range, and hold them if asked for."""
    if ranges is not None:
        links = links.repartition(graph.partitions, "place")
    links = cut_bucketed(links, "links", graph.partitions, ["place"] if ranges is not None else graph.keys)
    if cache:
        links = links.persist(StorageLevel.MEMORY_AND_DISK)
        links.count()  # the partitioning of a held table is known once it is filled
    return links


def _iterate(
    ranks: DataFrame | None,
    links: DataFrame,
    graph: Graph,
    layout: str,
    damping: float,
    ranges: Ranges | None = None,
) -> DataFrame:
    """One step: every source sends its rank along its links, and each node sums what arrives.

    In the first step every source holds rank 1.0, so nothing has to be looked up. Links
    already lie where their ranks come to; the ranks, the smaller side, are hashed
    there, so that links are neither shuffled nor sorted.
    """
    if ranks is None:
        held = links.withColumn("rank", F.lit(1.0))
    else:
        holders = ranks.withColumnRenamed("node", "src")
        if graph.hubs is not None:
            holders = copy_to_salts(holders, graph.hubs)
        if ranges is not None:
            salt = F.col("salt") if graph.hubs is not None else F.lit(0)
            holders = holders.withColumn("place", ranges.place(F.col("dst_range"), salt)).drop("dst_range")
        held = links.join(holders.hint("shuffle_hash"), _keys(graph, ranges))
    sent = F.col("rank") * F.col("part")
    more = ["dst_range"] if ranges is not None else []
    if layout == "adjacency":
        sends = held.select(sent.alias("sent"), F.inline("entries"))
        received = F.sum(F.col("sent") * F.col("w"))
    else:
        sends = held.select(sent.alias("sent"), "dst", *more)
        received = F.sum("sent")
    return sends.groupBy(F.col("dst").alias("node"), *more).agg(
        (F.lit(1.0 - damping) + F.lit(damping) * received).alias("rank")
    )
