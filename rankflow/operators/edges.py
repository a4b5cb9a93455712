"""From raw link lines to edges, degrees and adjacency rows.

Edges form a multiset. They are reduced to ``(src, dst, w)`` with ``w`` counting the copies as
early as possible: the partial aggregation runs before the shuffle, so repeated links cost
little however often they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.functions.hashing import text_bucket
from rankflow.functions.text import COMMENT_PREFIX, clean_fields, in_main_namespace
from rankflow.session import cut, scratch

# Below this many distinct targets a source is never split. Splits are internal: no result shows them.
MIN_SPLIT_ROWS = 100_000
ADJACENCY_ROW_ENTRIES = 4096

# Distinct edges per partition.
PARTITION_EDGES = 4_000_000


def parse_edges(lines: DataFrame) -> DataFrame:
    """``(src, dst)`` for every line that holds exactly two usable fields."""
    pairs = F.filter(
        F.array(clean_fields(F.col("value"))),
        lambda fields: (F.size(fields) == 2) & F.forall(fields, in_main_namespace),
    )
    # A generator keeps the optimizer from repeating the cleaning for every use of its result.
    kept = lines.filter(~F.col("value").startswith(COMMENT_PREFIX)).select(
        F.explode(pairs).alias("fields")
    )
    return kept.select(F.get("fields", F.lit(0)).alias("src"), F.get("fields", F.lit(1)).alias("dst"))


def weighted_edges(edges: DataFrame) -> DataFrame:
    """Distinct edges with the number of copies of each."""
    return edges.groupBy("src", "dst").agg(F.count("*").alias("w"))


def out_degree(edges: DataFrame) -> DataFrame:
    """Edges per source, copies counted."""
    return edges.groupBy("src").agg(F.count("*").alias("out_degree"))


def initial_ranks(edges: DataFrame) -> DataFrame:
    """Rank 1.0 for every node that occurs as a source."""
    return edges.select(F.col("src").alias("node")).distinct().withColumn("rank", F.lit(1.0))


@dataclass(frozen=True)
class Graph:
    """Edges ``(src, salt, dst, w, out_degree)`` and the placement of their sources.

    Only sources with more distinct targets than an average partition holds are split over
    several salts, so there are at most as many of them as partitions: ``hubs`` is
    ``(src, salts)``, or ``None`` where no source is that large.
    """

    edges: DataFrame
    sources: DataFrame
    hubs: DataFrame | None
    partitions: int
    weighted: DataFrame

    @property
    def keys(self) -> list[str]:
        return ["src"] if self.hubs is None else ["src", "salt"]


def build_graph(
    edges: DataFrame,
    partitions: int | None = None,
    split_rows: int = MIN_SPLIT_ROWS,
    keep_sources: bool = False,
) -> Graph:
    """Aggregate the edge multiset, split the largest sources and attach out-degrees.

    ``partitions`` follows from the number of distinct edges unless given.
    ``keep_sources`` adds a self-edge of weight zero to each source. It carries no rank, yet
    keeps the source among the destinations.
    """
    spark = edges.sparkSession
    weighted = cut(weighted_edges(edges), "weighted")
    degrees = cut(
        weighted.groupBy("src").agg(
            F.sum("w").alias("out_degree"), F.count("*").alias("targets")
        ),
        "degrees",
    )
    total, largest = degrees.agg(F.sum("targets"), F.max("targets")).first()
    if partitions is None:
        wanted = -(-(total or 0) // PARTITION_EDGES)
        partitions = max(spark.sparkContext.defaultParallelism, wanted)
    limit = max(split_rows, -(-(total or 0) // partitions))
    sources = degrees.select("src", "out_degree")
    if keep_sources:
        loops = sources.select("src", F.col("src").alias("dst"), F.lit(0).cast("bigint").alias("w"))
        weighted = weighted.unionByName(loops)
    if (largest or 0) <= limit:
        hubs, keys = None, ["src"]
        salted, placed = weighted.withColumn("salt", F.lit(0)), sources
    else:
        hubs, keys = _hubs(degrees, limit), ["src", "salt"]
        spread = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(
            text_bucket(F.col("dst"), F.col("salts")).cast("int")
        )
        salted = (
            weighted.join(F.broadcast(hubs), "src", "left").withColumn("salt", spread).drop("salts")
        )
        placed = copy_to_salts(sources, hubs)
    placed_edges = salted.repartition(partitions, *keys).join(placed, keys)
    return Graph(
        placed_edges.select("src", "salt", "dst", "w", "out_degree"), sources, hubs, partitions, weighted
    )


def _hubs(degrees: DataFrame, limit: int) -> DataFrame:
    """At most ``total / limit`` rows, and ``limit`` is no less than an average partition."""
    salts = F.ceil(F.col("targets") / limit).cast("int")
    return degrees.filter(F.col("targets") > limit).select("src", salts.alias("salts"))


def copy_to_salts(nodes: DataFrame, hubs: DataFrame) -> DataFrame:
    """``nodes`` with one row per ``(src, salt)``; only hubs have more than one."""
    last = F.coalesce(F.col("salts"), F.lit(1)) - 1
    joined = nodes.join(F.broadcast(hubs), "src", "left")
    return joined.withColumn("salt", F.explode(F.sequence(F.lit(0), last))).drop("salts")


def adjacency(edges: DataFrame, entries: int = ADJACENCY_ROW_ENTRIES) -> DataFrame:
    """Target lists ``(src, chunk, entries, size, out_degree)`` with at most ``entries`` targets a row.

    ``entries`` lists ``(dst, w)`` in target order, and chunks follow each other in that order; ``size`` counts
    edge copies. Rows are the same for any number of partitions, and a hub's list never meets in one task.

    Edges are sorted once by ranges of source and target, and lists are cut while the sorted rows stream by. A source that
    fills one row is done at that. Of longer ones only the out-degree is looked up. A list that goes on in the next
    partition, at most two in each, has the number of its entries in the partitions before carried over, and
    is cut anew.
    """
    spark = edges.sparkSession
    with scratch(spark) as own:
        ordered = weighted_edges(edges).repartitionByRange("src", "dst").sortWithinPartitions("src", "dst")
        cuts = cut(ordered.select("src", "dst", "w").mapInArrow(_cut_lists(entries), CUT_SCHEMA), "cuts", ("kind",))
        whole, marks, parts = (cuts.filter(F.col("kind") == kind) for kind in (WHOLE, MARK, PART))
        before = Window.partitionBy("src").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        # At most two rows for each partition.
        carried = marks.select(
            "src", "part", F.coalesce(F.sum("start").over(before), F.lit(0)).alias("carry"),
            F.count("*").over(Window.partitionBy("src")).alias("parts"),
        ).filter("parts > 1").drop("parts")
        met = parts.select("src", "part", "start", "entries", "size").join(carried, ["src", "part"], "left")
        chunk = F.expr(f"(start + carry + place) div {entries}").cast("int").alias("chunk")
        crossing = met.filter("carry IS NOT NULL").select("src", "start", "carry", F.posexplode("entries").alias("place", "entry"))
        again = crossing.select("src", chunk, "entry").groupBy("src", "chunk").agg(
            F.array_sort(F.collect_list("entry")).alias("entries"), F.sum("entry.w").alias("size")
        )
        kept = met.filter("carry IS NULL").select("src", F.expr(f"start div {entries}").cast("int").alias("chunk"), "entries", "size")
        totals = parts.groupBy("src").agg(F.sum("size").alias("out_degree"))
        longer = kept.unionByName(again).join(totals, "src")
        done = whole.select("src", F.lit(0).alias("chunk"), "entries", "size", F.col("size").alias("out_degree"))
        return own.result(done.unionByName(cut(longer, "longer")))


# Rows of a cut table: the whole list of a source, part of one, or how many entries a list that meets a partition's
# border has there (in ``start``).
WHOLE, PART, MARK = range(3)
CUT_SCHEMA = (
    "kind int, src string, part int, start bigint, entries array<struct<dst: string, w: bigint>>, size bigint"
)


def _cut_lists(entries: int):
    """Cuts the lists of one sorted partition into rows of at most ``entries``, holding one batch and one row's entries."""
    entry_type = pa.struct([("dst", pa.string()), ("w", pa.int64())])

    def rows(kind, src, part, starts, lists, sizes) -> pa.RecordBatch:
        columns = [
            pa.array(np.asarray(kind, dtype=np.int32)), src.cast(pa.string()), pa.array([part] * len(src), pa.int32()),
            pa.array(np.asarray(starts, dtype=np.int64)), lists, pa.array(np.asarray(sizes, dtype=np.int64)),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "src", "part", "start", "entries", "size"])

    def mark(src: str, part: int, count: int) -> pa.RecordBatch:
        return rows([MARK], pa.array([src]), part, [count], pa.nulls(1, pa.list_(entry_type)), [0])

    def emit(table: pa.RecordBatch, low: np.ndarray, high: np.ndarray, skipped: np.ndarray, border: np.ndarray, part: int):
        """Runs of one source each, of which ``skipped`` entries were written before."""
        pieces = -(-(high - low) // entries)
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = np.repeat(low, pieces) + (np.arange(pieces.sum()) - first) * entries
        end = np.minimum(start + entries, np.repeat(high, pieces))
        longer = border | (skipped + high - low > entries)
        w = table.column(2).to_numpy()
        total = np.concatenate([[0], np.cumsum(w)])
        items = pa.StructArray.from_arrays([table.column(1).cast(pa.string()), pa.array(w)], fields=list(entry_type))
        # Pieces follow each other, so their borders are the list's offsets.
        offsets = pa.array(np.append(start, end[-1:]).astype(np.int32))
        return rows(
            np.where(np.repeat(longer, pieces), PART, WHOLE), table.column(0).take(pa.array(start)), part,
            start - np.repeat(low - skipped, pieces), pa.ListArray.from_arrays(offsets, items), total[end] - total[start],
        )

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, open_, done, first = TaskContext.get().partitionId(), None, 0, True
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch if open_ is None else pa.concat_batches([open_, batch])
            src = table.column(0)
            starts = np.concatenate([[0], 1 + np.flatnonzero(pc.not_equal(src[1:], src[:-1]).to_numpy(zero_copy_only=False))])
            last = int(starts[-1])
            if last:
                low, high = starts[:-1], starts[1:]
                skipped, border = np.zeros(len(low), dtype=np.int64), np.zeros(len(low), dtype=bool)
                skipped[0], border[0] = done, first
                yield emit(table.slice(0, last), low, high, skipped, border, part)
                if first:
                    yield mark(src[0].as_py(), part, done + int(starts[1]))
                done, first = 0, False
            # The last source may go on: whole rows of its list are written, the rest waits.
            held = table.num_rows - last
            ready = held // entries * entries
            if ready:
                bounds = np.array([0]), np.array([ready]), np.array([done]), np.array([True])
                yield emit(table.slice(last, ready), *bounds, part)
            open_, done = table.slice(last + ready), done + ready
            if not open_.num_rows:
                # Its name is needed if the partition ends here.
                name = src[len(src) - 1].as_py()
            else:
                name = open_.column(0)[0].as_py()
        if open_ is None:
            return
        if open_.num_rows:
            yield emit(open_, np.array([0]), np.array([open_.num_rows]), np.array([done]), np.array([True]), part)
        yield mark(name, part, done + open_.num_rows)

    return walk


def split_adjacency(graph: Graph, entries: int = ADJACENCY_ROW_ENTRIES) -> DataFrame:
    """The same per ``(src, salt)`` of a graph whose largest sources are split: the ranking's own layout.

    Further columns of the graph's edges stay: those of a target in its entry, those of a source beside it.
    """
    place = Window.partitionBy("src", "salt").orderBy("dst")
    numbered = graph.edges.withColumn(
        "chunk", F.floor((F.row_number().over(place) - 1) / entries).cast("int")
    )
    fields = [name for name in ("dst", "w", "dst_range") if name in numbered.columns]
    beside = [F.first(name).alias(name) for name in ("out_degree", "place") if name in numbered.columns]
    return numbered.groupBy("src", "salt", "chunk").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("entries"), F.sum("w").alias("size"), *beside
    )
