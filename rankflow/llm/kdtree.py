"""Exact search for the largest integer inner products, by KD-trees per shard.

Components are brought to integers, ``floor(scale * x)``. A bounded sample gives the splits of at most ``MAX_CELLS``
cells; every vector falls into one cell, and a cell with more than ``SHARD_ROWS`` vectors is dealt over several shards. A
shard is one KD-tree: median splits of the widest dimension down to ``LEAF_ROWS`` vectors, each node with the tight
box of its vectors, written once as a row of numbers.

The product of a query with anything inside a box is at most ``sum(max(q * low, q * high))``. A query visits cells in the
order of that bound, in waves of 1, 2, 4, ... cells, and goes on only while a cell's bound reaches the ``k``-th score that
it holds by then. That score travels with the query into every tree, where nodes are taken best bound first until
none can add to the answer. Cells, shards and waves only order the work: every vector is either scored or lies in a
box that cannot hold an answer, so results are exact for any data. Where boxes rule nothing out (spread-out vectors in many
dimensions), the work is queries times vectors, in tasks of one tree and at most ``BLOCK_ROWS`` queries.

Equal integer vectors are one entry with the smallest ids that any answer can need, so a vector shared by very many
rows is no hot shard, and queries that share a vector are searched once.

Defined results: a vector that is null or holds a null or non-finite component takes no part, nor does a row with a null id
or, where lengths differ, with another length than most (the smaller on a tie). Empty vectors are all equal, with
score 0. Components that leave the range of doubles when scaled count as non-finite. Products are exact; one beyond
64 bits counts as the 64-bit number nearest to it. Ids are integers. Rows that repeat an id and its vector count once; those
that repeat an id with another vector are queries and candidates of their own. Ties go to the smaller id. A query with
fewer than ``k`` others gets all of them; an empty table gives none. Further columns are ignored.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import cut, scratch

FIT_ROWS = 20_000
MAX_CELLS = 2048
SHARD_ROWS = 8192
LEAF_ROWS = 128
BLOCK_ROWS = 2048
# Sums of products below this are exact in double precision.
EXACT = float(1 << 53)
LEAST, MOST = -(1 << 63), (1 << 63) - 1


# --- trees -------------------------------------------------------------------------------------


def _halves(x: np.ndarray) -> tuple[int, float] | None:
    """The widest dimension and a value: rows below it and the others are both some; the median if it is possible."""
    if not len(x) or not x.shape[1]:
        return None
    low, high = x.min(axis=0), x.max(axis=0)
    width = high / 2 - low / 2
    dim = int(width.argmax())
    if not high[dim] > low[dim]:
        return None
    own = x[:, dim]
    value = np.partition(own, len(own) // 2)[len(own) // 2]
    return dim, float(value if value > low[dim] else own[own > low[dim]].min())


class Splits:
    """The upper part of a KD-tree, fitted on a sample: ``cell(x)`` gives the cell of each row."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.dims, self.values, self.children = [-1], [0.0], [(-1, -1)]
        open_ = [(-len(sample), 0, sample)]
        leaves = 1
        while open_ and leaves < cells:
            _, node, own = heapq.heappop(open_)
            split = _halves(own)
            if split is None:
                continue
            dim, value = split
            left = len(self.dims)
            self.dims[node], self.values[node], self.children[node] = dim, value, (left, left + 1)
            below = own[:, dim] < value
            for rows in (own[below], own[~below]):
                heapq.heappush(open_, (-len(rows), len(self.dims), rows))
                self.dims.append(-1)
                self.values.append(0.0)
                self.children.append((-1, -1))
            leaves += 1

    def cell(self, x: np.ndarray) -> np.ndarray:
        dims, values, children = np.array(self.dims), np.array(self.values), np.array(self.children)
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            live = np.flatnonzero(dims[node] >= 0)
            if not len(live):
                return node
            at = node[live]
            right = x[live, dims[at]] >= values[at]
            node[live] = children[at, right.astype(np.int64)]


def build_tree(x: np.ndarray, low_id: np.ndarray) -> dict[str, np.ndarray]:
    """Nodes of a KD-tree over the rows of ``x``: row ranges, children, tight boxes and smallest ids."""
    order, bounds, children, lows, highs, least = np.arange(len(x)), [], [], [], [], []
    waiting = [(0, len(x), -1)]
    while waiting:
        start, end, parent = waiting.pop()
        own = order[start:end]
        node = len(bounds)
        if parent >= 0:
            children[parent] = children[parent][1:] + (node,)
        bounds.append((start, end))
        children.append((-1, -1))
        lows.append(x[own].min(axis=0))
        highs.append(x[own].max(axis=0))
        least.append(low_id[own].min())
        split = _halves(x[own]) if end - start > LEAF_ROWS else None
        if split is not None:
            below = x[own, split[0]] < split[1]
            order[start:end] = np.concatenate([own[below], own[~below]])
            middle = start + int(below.sum())
            waiting += [(middle, end, node), (start, middle, node)]
    return {
        "order": order, "bounds": np.array(bounds), "children": np.array(children), "low": np.array(lows),
        "high": np.array(highs), "least": np.array(least),
    }


def _exact_type(*parts: np.ndarray):
    """Doubles where every sum of products stays exact, else Python's integers."""
    width = parts[0].shape[1]
    biggest = [float(np.abs(x).max()) if x.size else 0.0 for x in parts]
    return np.float64 if max(1, width) * biggest[0] * biggest[1] < EXACT else object


def _as_type(x: np.ndarray, kind) -> np.ndarray:
    if kind is np.float64:
        return x
    made = np.empty(x.shape, dtype=object)
    made[...] = [[int(v) for v in row] for row in x]
    return made


def box_bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that any vector of a box can score, for each query and box."""
    kind = _exact_type(queries, np.concatenate([low, high]))
    q, low, high = (_as_type(x, kind) for x in (queries, low, high))
    zero = np.zeros((), dtype=kind)
    return _clipped(np.maximum(q, zero) @ high.T + np.minimum(q, zero) @ low.T)


def _clipped(score: np.ndarray) -> np.ndarray:
    return np.clip(score, LEAST, MOST) if score.dtype == object else score


def search_tree(
    tree: dict[str, np.ndarray], rows: np.ndarray, low_id: np.ndarray, queries: np.ndarray, floor: list, k: int
) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
    """For each query ``(number, [(score, -low_id, row)])``: up to ``k`` best rows that reach its ``floor`` score.

    ``rows`` and ``low_id`` are in the tree's order. A floor of None lets every row in.
    """
    kind = _exact_type(queries, rows)
    bounds = box_bounds(queries, tree["low"], tree["high"])
    x, q = _as_type(rows, kind), _as_type(queries, kind)
    children, spans, least = tree["children"].tolist(), tree["bounds"].tolist(), tree["least"].tolist()
    for i in range(len(q)):
        bound, best = bounds[i].tolist(), []
        limit = (floor[i], MOST) if floor[i] is not None else None
        heap = [(-bound[0], 0)]
        while heap:
            top, node = heapq.heappop(heap)
            if limit is not None and -top < limit[0]:
                break
            # A box whose best score ties is of use only if it holds a smaller id.
            if limit is not None and -top == limit[0] and least[node] > limit[1]:
                continue
            if children[node][0] >= 0:
                for child in children[node]:
                    heapq.heappush(heap, (-bound[child], child))
                continue
            start, end = spans[node]
            score = _clipped(x[start:end] @ q[i])
            hits = np.flatnonzero(score >= limit[0]) if limit is not None else np.arange(end - start)
            if not len(hits):
                continue
            best += [(int(score[j]), -int(low_id[start + j]), start + int(j)) for j in hits]
            if len(best) >= k:
                best = heapq.nlargest(k, best)
                limit = (best[-1][0], -best[-1][1])
        if best:
            yield i, heapq.nlargest(k, best)


def _packed(**arrays: np.ndarray) -> bytes:
    buffer = io.BytesIO()
    np.savez(buffer, **arrays)
    return buffer.getvalue()


def _unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return dict(found)


# --- tables ------------------------------------------------------------------------------------


def integers(vector: Column, scale: float) -> Column:
    """Components as whole doubles; minus zero is zero."""
    return F.transform(vector, lambda x: F.expr("0D") + _floor(x.cast("double") * F.lit(float(scale))))


def _floor(x: Column) -> Column:
    # Beyond 2 ** 53 doubles are whole, and Spark's own floor would leave the range of its integers.
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)


def usable(vector: Column, scale: float) -> Column:
    """Whether all components are finite, after scaling too."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * float(scale)) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return _shaped(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), len(column))


def _shaped(flat: np.ndarray, rows: int) -> np.ndarray:
    return flat.reshape(rows, flat.size // max(1, rows))


def _placed(rows: DataFrame, splits) -> DataFrame:
    """``(key, vector, low_id, cell)``: the cell of each entry."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = splits.value.cell(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])

    kind = dict(rows.dtypes)["low_id"]
    chosen = rows.select("key", "vector", "low_id")
    return chosen.mapInArrow(place, f"key binary, vector array<double>, low_id {kind}, cell bigint")


def _trees(entries: DataFrame, splits) -> DataFrame:
    """``(cell, shard, tree, low, high)``: one row per shard, with its entries inside the tree."""
    placed = cut(_placed(entries, splits), "placed")
    shards = placed.groupBy("cell").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("shards"))
    dealt = placed.join(shards, "cell").withColumn("shard", F.pmod(F.xxhash64("key"), F.col("shards")).cast("int"))

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        x, low_id = _matrix(rows.column("vector")), rows.column("low_id").to_numpy()
        tree = build_tree(x, low_id)
        order = tree.pop("order")
        names = b"".join(rows.column("key").take(pa.array(order)).to_pylist())
        packed = _packed(rows=x[order], low_id=low_id[order], names=np.frombuffer(names, np.uint8), **tree)
        return pa.table({
            "cell": pa.array([key[0].as_py()], pa.int64()), "shard": pa.array([key[1].as_py()], pa.int32()),
            "tree": pa.array([packed], pa.binary()),
            "low": pa.array([tree["low"][0].tolist()], pa.list_(pa.float64())),
            "high": pa.array([tree["high"][0].tolist()], pa.list_(pa.float64())),
        })

    schema = "cell bigint, shard int, tree binary, low array<double>, high array<double>"
    grouped = dealt.select("cell", "shard", "key", "vector", "low_id").groupBy("cell", "shard")
    return cut(grouped.applyInArrow(build, schema), "trees")


def _cell_boxes(trees: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells and the boxes around their shards; there are at most ``MAX_CELLS``."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = np.stack(rows["low"].to_numpy()), np.stack(rows["high"].to_numpy())
        return pd.DataFrame({"cell": rows["cell"].iloc[:1], "low": [low.min(axis=0)], "high": [high.max(axis=0)]})

    boxes = trees.select("cell", "low", "high").groupBy("cell").applyInPandas(
        merge, "cell bigint, low array<double>, high array<double>"
    )
    rows = boxes.orderBy("cell").collect()
    return (
        np.array([row["cell"] for row in rows], dtype=np.int64),
        _shaped(np.array([row["low"] for row in rows], dtype=np.float64), len(rows)),
        _shaped(np.array([row["high"] for row in rows], dtype=np.float64), len(rows)),
    )


def _visits(asked: DataFrame, boxes, first: int, last: int) -> DataFrame:
    """``(cell, query, vector, floor)``: the cells at places ``first`` to ``last`` of a query's order that may help it."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, low, high = boxes.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                bounds = box_bounds(_matrix(part.column(1)), low, high)
                order = np.argsort(-bounds, axis=1, kind="stable")[:, first:last]
                bound = np.take_along_axis(bounds, order, axis=1)
                floors = [LEAST if v is None else v for v in part.column(2).to_pylist()]
                floors = np.array(floors, dtype=bounds.dtype)
                rows, places = np.nonzero(bound >= floors[:, None])
                taken = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells[order[rows, places]]), *taken.columns], names=["cell", "query", "vector", "floor"]
                )

    schema = "cell bigint, query binary, vector array<double>, floor bigint"
    return asked.select("query", "vector", "floor").mapInArrow(choose, schema)


def _search(visits: DataFrame, trees: DataFrame, k: int, id_kind: str) -> DataFrame:
    """``(query, key, score, low_id)``: the best entries of each visited tree."""
    blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    dealt = visits.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int"))
    shards = trees.groupBy("cell").agg(F.count("*").cast("int").alias("shards"))
    asked = dealt.join(shards, "cell").select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "block", "query", "vector", "floor"
    )
    held = trees.select("cell", "shard", "tree").join(blocks, "cell").select(
        "cell", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "tree"
    )
    keys = ["cell", "shard", "block"]
    id_type = pa.int64() if id_kind == "bigint" else pa.int32()

    def look(queries: pa.Table, held: pa.Table) -> pa.Table:
        query, key, score, low = [], [], [], []
        if queries.num_rows and held.num_rows:
            tree = _unpacked(held.column("tree")[0].as_py())
            rows, low_id = tree["rows"], tree["low_id"]
            names = tree["names"].reshape(len(rows), -1)
            asked = queries.column("query").to_pylist()
            found = search_tree(
                tree, rows, low_id, _matrix(queries.column("vector")), queries.column("floor").to_pylist(), k
            )
            for i, hits in found:
                for points, minus_id, at in hits:
                    query.append(asked[i])
                    key.append(names[at].tobytes())
                    score.append(points)
                    low.append(-minus_id)
        return pa.table({
            "query": pa.array(query, pa.binary()), "key": pa.array(key, pa.binary()),
            "score": pa.array(score, pa.int64()), "low_id": pa.array(low, id_type),
        })

    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(
        look, f"query binary, key binary, score bigint, low_id {id_kind}"
    )


def largest_products(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: float = 64.0,
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``k`` largest products of each row for which ``is_query``.

    ``is_query`` is an expression over the integer ``id``.
    """
    spark = vectors.sparkSession
    named = picked(vectors, id=id_col, vector=vector_col)
    id_kind = dict(named.dtypes)["id"]
    valid = named.filter(F.col("id").isNotNull() & usable(F.col("vector"), scale))
    width = valid.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).first()
    if width is None:
        return spark.createDataFrame([], f"query_id {id_kind}, rank int, id {id_kind}, score bigint")
    valid = valid.filter(F.size("vector") == width["size"]).withColumn("vector", integers(F.col("vector"), scale))
    key = F.unhex(F.substring(F.sha2(F.array_join(F.col("vector").cast("array<string>"), ","), 256), 1, 32))
    with scratch(spark) as own:
        rows = cut(valid.withColumn("key", key).dropDuplicates(["id", "key"]), "rows")
        entries = cut(rows.groupBy("key").agg(F.first("vector").alias("vector"), F.min("id").alias("low_id")), "entries")
        ids = _smallest_ids(rows, k)
        total = entries.count()
        sample = entries.orderBy(F.xxhash64("key"), "key").limit(FIT_ROWS).select("vector").toArrow()
        cells = min(MAX_CELLS, -(-total // SHARD_ROWS))
        trees = _trees(entries, spark.sparkContext.broadcast(Splits(_matrix(sample.column(0)), cells)))
        boxes = _cell_boxes(trees)
        shared = spark.sparkContext.broadcast(boxes)
        queries = rows.filter(is_query).select(F.col("id").alias("query_id"), F.col("key").alias("query"))
        asked = cut(
            rows.filter(is_query).groupBy(F.col("key").alias("query")).agg(F.first("vector").alias("vector")), "asked"
        )
        best = _waves(own, asked, trees, shared, len(boxes[0]), k + 1, id_kind)
        answers = _answers(best, ids, k)
        itself = lambda x: (x["id"] == F.col("query_id")) & (x["key"] == F.col("query"))
        others = F.slice(F.filter("all", lambda x: ~itself(x)), 1, k)
        ranked = cut(
            queries.join(answers, "query").select("query_id", F.posexplode(others).alias("place", "hit")).select(
                "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("id"),
                F.col("hit.score").alias("score"),
            ),
            "ranked",
        )
        return own.result(ranked)


def _smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """``(key, ids)``: the ``k + 1`` smallest ids of each entry."""
    order = Window.partitionBy("key").orderBy("id")
    few = rows.select("key", "id").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    return cut(few.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ids")


def _waves(own, asked: DataFrame, trees: DataFrame, boxes, cells: int, k: int, id_kind: str) -> DataFrame:
    """``(query, key, score, low_id)``: the ``k`` best entries of each query over all cells."""
    top = Window.partitionBy("query").orderBy(F.desc("score"), "low_id")
    best, first, size = None, 0, 1
    pending = asked.withColumn("floor", F.lit(None).cast("bigint"))
    while first < cells:
        visits = cut(_visits(pending, boxes, first, first + size), "visits")
        first, size = first + size, size * 2
        if visits.isEmpty():
            own.drop(visits)
            break
        found = cut(_search(visits, trees, k, id_kind), "found")
        merged = found if best is None else best.unionByName(found)
        ranked = merged.withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k).drop("place")
        after = cut(ranked, "best")
        own.drop(visits, found, *([best] if best is not None else []))
        best = after
        held = best.groupBy("query").agg(F.min("score").alias("low"), F.count("*").alias("held"))
        pending = asked.join(held, "query", "left").select(
            "query", "vector", F.when(F.col("held") >= k, F.col("low")).alias("floor")
        )
    if best is None:
        schema = f"query binary, key binary, score bigint, low_id {id_kind}"
        return asked.sparkSession.createDataFrame([], schema)
    return best


def _answers(best: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """``(query, all)``: the ids and keys of a query's best entries with their scores, best first."""
    # Scores are negated bitwise, which turns their order without leaving 64 bits.
    pairs = F.transform("ids", lambda i: F.struct(F.bitwise_not("score").alias("minus"), i.alias("id"), "key"))
    grouped = best.join(ids, "key").groupBy("query").agg(F.sort_array(F.flatten(F.collect_list(pairs))).alias("all"))
    restored = F.transform("all", lambda x: x.withField("score", F.bitwise_not(x["minus"])))
    return grouped.select("query", restored.alias("all"))
