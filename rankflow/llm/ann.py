"""Approximate nearest neighbours by cosine over balanced posting lists.

Centroids come from a balanced bisection of a bounded sample, so lists hold about the same number of
vectors. Every vector goes into its nearest list, and into further ones whose centroids are hardly farther away:
vectors at a border are found from either side. Lists are found through a graph of the centroids,
held in memory, for vectors and queries alike. A query's walk through the graph goes on until its frontier lies beyond a ratio of
the nearest centroid's distance; it reads every list within, however many, and further ones in order of distance until they are
home to ``k`` other vectors. Candidates are scored exactly, in double precision, on the original vectors.

``SHELF_LISTS`` neighbouring lists are stored together. A vector or query is sent to a shelf once, with the numbers of the lists
it is in or reads there, and only these lists are compared. The number of centroids held in memory is at most ``MAX_LISTS``;
where lists grow beyond twice ``LIST_ROWS``, the task that holds one bisects it further and chooses among its parts
by the same rules, so what a query reads follows its neighbourhood and not the table.

Equal vectors are one entry with the smallest ids that any answer can need, so a vector that very many rows share is
no hot list. Shelves that grow beyond a tile are split into tiles, by vectors and by queries, so that a task holds
one tile of each whatever the size of the table. Every vector is indexed; only the centroids are fitted on a
sample of ``FIT_ROWS``.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, as query
or candidate, nor do rows with a null id or, where lengths differ, with another length than most. Rows that
repeat an id with another vector are candidates of their own. A query with fewer than ``k`` others in the
whole table gets all of them. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import cut, scratch

FIT_ROWS = 20_000
LIST_ROWS = 256
MAX_LISTS = 4096
SHELF_LISTS = 16
TILE_ROWS = 8192
DEGREE = 16
BEAM = 32
BLOCK_SCORES = 1_000_000
# How far beyond the nearest centroid a vector is replicated, and a query reads, as ratios of distances.
REPLICATE_RATIO = 1.06
REPLICAS = 4
SEARCH_RATIO = 1.2


@dataclass(frozen=True)
class Index:
    """Unit centroids, the neighbours of each in the graph, and the nodes where a search starts."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray


def bisect(sample: np.ndarray, leaves: int, seed: int = 0) -> np.ndarray:
    """Centroids of ``leaves`` groups of equal size: each group is cut at the median along its two means' line."""
    rng = np.random.default_rng(seed)
    groups = [("", np.arange(len(sample)))]
    while len(groups) < min(leaves, len(sample)):
        groups.sort(key=lambda group: len(group[1]))
        path, own = groups.pop()
        if len(own) < 2:
            groups.append((path, own))
            break
        x = sample[own]
        a, b = x[rng.choice(len(own), 2, replace=False)]
        for _ in range(8):
            side = x @ (a - b) > (a @ a - b @ b) / 2
            if side.all() or not side.any():
                break
            a, b = x[side].mean(axis=0), x[~side].mean(axis=0)
        order = np.argsort(x @ (a - b), kind="stable")
        half = len(own) // 2
        groups += [(path + "0", own[order[:half]]), (path + "1", own[order[half:]])]
    # In the order of the cuts, neighbours come next to each other.
    means = np.stack([sample[own].mean(axis=0) for _, own in sorted(groups, key=lambda group: group[0])])
    return means / np.maximum(np.linalg.norm(means, axis=1, keepdims=True), 1e-12)


def build_index(sample: np.ndarray, lists: int) -> Index:
    centroids = bisect(sample, lists)
    n, near = len(centroids), []
    for low in range(0, n, 1024):
        score = centroids[low : low + 1024] @ centroids.T
        score[np.arange(len(score)), low + np.arange(len(score))] = -2
        near.append(np.argsort(-score, axis=1)[:, : min(DEGREE, max(1, n - 1))])
    graph = np.concatenate(near)
    # Some links to anywhere shorten walks, and a ring keeps the graph in one piece.
    rng = np.random.default_rng(1)
    ring = (np.arange(n)[:, None] + 1) % n
    graph = np.concatenate([graph, rng.integers(0, n, (n, 4)), ring], axis=1)
    entries = np.unique(np.linspace(0, n - 1, max(1, int(np.sqrt(n)))).astype(int))
    return Index(centroids, graph, entries)


def search_graph(index: Index, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` nearest centroids that a best-first walk finds for each unit row of ``x``, and distances."""
    centroids, graph = index.centroids, index.graph
    rows, n = len(x), len(centroids)
    width = min(width, n)
    seen = np.zeros((rows, n), dtype=bool)
    seen[:, index.entries] = True
    ids = np.repeat(index.entries[None, :], rows, axis=0)
    score = x @ centroids[index.entries].T
    open_ = np.ones(ids.shape, dtype=bool)
    live = np.arange(rows)
    step = 4
    pad = max(0, width - ids.shape[1])
    ids = np.pad(ids, ((0, 0), (0, pad)))
    score = np.pad(score, ((0, 0), (0, pad)), constant_values=-9.0)
    open_ = np.pad(open_, ((0, 0), (0, pad)))
    while len(live):
        best = np.argsort(-np.where(open_[live], score[live], -10.0), axis=1, kind="stable")[:, :step]
        chosen = np.take_along_axis(open_[live], best, axis=1)
        going = chosen.any(axis=1)
        live, best, chosen = live[going], best[going], chosen[going]
        if not len(live):
            break
        open_[live[:, None], best] = False
        nodes = np.where(chosen, ids[live[:, None], best], ids[live, best[:, 0]][:, None])
        near = np.sort(graph[nodes].reshape(len(live), -1), axis=1)
        fresh = ~seen[live[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        seen[live[:, None], near] = True
        found = np.where(fresh, np.einsum("rd,rnd->rn", x[live], centroids[near]), -9.0)
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_score = np.concatenate([score[live], found], axis=1)
        all_open = np.concatenate([open_[live], fresh], axis=1)
        keep = np.argsort(-all_score, axis=1, kind="stable")[:, : ids.shape[1]]
        ids[live] = np.take_along_axis(all_ids, keep, axis=1)
        score[live] = np.take_along_axis(all_score, keep, axis=1)
        open_[live] = np.take_along_axis(all_open, keep, axis=1)
    order = np.argsort(-score, axis=1, kind="stable")[:, :width]
    ids, score = np.take_along_axis(ids, order, axis=1), np.take_along_axis(score, order, axis=1)
    return ids, np.where(score < -2, np.inf, np.sqrt(np.maximum(0.0, 2 - 2 * score)))


def list_choice(index: Index, x: np.ndarray, ratio: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and lists: those within ``ratio`` of the nearest centroid's distance, up to ``most``."""
    ids, distance = search_graph(index, x, max(most, BEAM))
    near = distance <= np.maximum(distance[:, :1] * ratio, 1e-9)
    near[:, most:] = False
    near[:, 0] = True
    rows, places = np.nonzero(near)
    return rows, ids[rows, places]


def lists_to_read(index: Index, x: np.ndarray, ratio: float, homes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and lists: all within ``ratio`` of the nearest centroid's distance, and more until ``least`` vectors
    have their home there, of which list ``i`` has ``homes[i]``.

    The walk is made wider for rows that want all it found, until the last list found is not wanted.
    """
    live, width, n = np.arange(len(x)), BEAM, len(index.centroids)
    rows, lists = [live[:0]], [live[:0]]
    while len(live):
        ids, distance = search_graph(index, x[live], width)
        held = homes[ids]
        before = np.cumsum(held, axis=1) - held
        wanted = (distance <= np.maximum(distance[:, :1] * ratio, 1e-9)) | (before < least)
        wanted &= np.isfinite(distance)
        done = ~wanted[:, -1] | (width >= n)
        at, places = np.nonzero(wanted & done[:, None])
        rows.append(live[at])
        lists.append(ids[at, places])
        live, width = live[~done], width * 4
    return np.concatenate(rows), np.concatenate(lists)


# --- tables ------------------------------------------------------------------------------------


def usable(vector: Column) -> Column:
    """Whether a vector has only finite components, not all of them zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _entries(vectors: DataFrame, k: int) -> DataFrame:
    """Distinct vectors ``(uid, vector, ids)`` with the ``k + 1`` smallest ids of each."""
    order = Window.partitionBy("vector").orderBy("id")
    few = vectors.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    grouped = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    return cut(grouped.withColumn("uid", F.monotonically_increasing_id()), "entries")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _placed(entries: DataFrame, shared, lists_of) -> DataFrame:
    """``(shelf, uid, vector, low, lists, home)``: a row for each shelf with some of the lists that ``lists_of`` gives an entry.

    ``low`` is the entry's smallest id; one of its rows has its nearest list as ``home``, the others -1.
    """
    per_shelf = SHELF_LISTS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                x = _unit(_matrix(part.column(1)))
                rows, lists = lists_of(index, x)
                order = np.lexsort((lists, rows))
                rows, lists = rows[order], lists[order]
                distance = -(x[rows] * index.centroids[lists]).sum(axis=1)
                nearest = np.lexsort((lists, distance, rows))
                nearest = lists[nearest[np.flatnonzero(np.diff(rows[nearest], prepend=-1))]]
                first = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(lists // per_shelf, prepend=-1) != 0))
                offsets = pa.array(np.append(first, len(rows)).astype(np.int32))
                taken = part.take(pa.array(rows[first]))
                shelf = lists[first] // per_shelf
                home = np.where(nearest[rows[first]] // per_shelf == shelf, nearest[rows[first]], -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shelf.astype(np.int32)), *taken.columns,
                     pa.ListArray.from_arrays(offsets, pa.array(lists.astype(np.int32))), pa.array(home.astype(np.int32))],
                    names=["shelf", "uid", "vector", "low", "lists", "home"],
                )

    kind = dict(entries.dtypes)
    chosen = entries.select("uid", "vector", F.get("ids", F.lit(0)).alias("low"))
    schema = f"shelf int, uid bigint, vector {kind['vector']}, low bigint, lists array<int>, home int"
    return chosen.mapInArrow(place, schema)


def _tiles(placed: DataFrame, own: str, other: str, parts: DataFrame) -> DataFrame:
    """Deals a shelf's rows over its ``own`` parts and copies them to all of the ``other`` side's parts."""
    return placed.join(parts, "shelf").select(
        "shelf", F.pmod(F.xxhash64("uid"), F.col(own)).cast("int").alias(own),
        F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), "uid", "vector", "low", "lists",
    )


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
    list_rows: int = LIST_ROWS, search_ratio: float = SEARCH_RATIO,
) -> DataFrame:
    """``(query_id, rank, id, score)``: up to ``k`` nearest others of each row for which ``is_query``.

    ``is_query`` is an expression over ``id`` and ``vector``.
    """
    spark = vectors.sparkSession
    named = picked(vectors, id=id_col, vector=vector_col)
    valid = named.filter(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = valid.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").limit(1)
    width = sizes.first()
    if width is None:
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score double")
    valid = valid.filter(F.size("vector") == width["size"])
    with scratch(spark) as own:
        entries = _entries(valid, k)
        total = entries.count()
        sample = entries.select("vector", F.xxhash64("vector").alias("place")).orderBy("place").limit(FIT_ROWS)
        fitted = _unit(np.array([row[0] for row in sample.select("vector").collect()], dtype=np.float64))
        lists = max(1, min(MAX_LISTS, total // list_rows))
        index = build_index(fitted, lists)
        shared = spark.sparkContext.broadcast((index.centroids, index.graph, index.entries))
        asking = valid.filter(is_query).select(F.col("id").alias("query_id"), F.col("vector").alias("asked"))
        queries = cut(
            asking.join(entries.select("uid", "vector"), F.col("asked") == F.col("vector")).select("query_id", "uid"),
            "queries",
        )
        replicas = lambda own, x: list_choice(own, x, REPLICATE_RATIO, REPLICAS)
        stored = cut(_placed(entries, shared, replicas), "lists")
        homes = np.zeros(len(index.centroids), dtype=np.int64)
        for row in stored.filter("home >= 0").groupBy("home").count().collect():
            homes[row["home"]] = row["count"]
        asked = entries.join(queries.select("uid").distinct(), "uid", "left_semi")
        reading = lambda own, x: lists_to_read(own, x, search_ratio, homes, k + 1)
        asked = cut(_placed(asked, shared, reading), "asked")
        best = _compared(stored, asked, k, list_rows, search_ratio)
        named_ids = cut(best.join(entries.select("uid", "ids"), "uid"), "best")
        pairs = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("id")))
        answers = named_ids.groupBy("query").agg(F.sort_array(F.flatten(F.collect_list(pairs))).alias("all"))
        others = F.slice(F.filter("all", lambda x: x["id"] != F.col("query_id")), 1, k)
        ranked = queries.join(answers, F.col("uid") == F.col("query")).select(
            "query_id", F.posexplode(others).alias("place", "hit")
        )
        named = ranked.select(
            "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.id").alias("id"),
            (-F.col("hit.minus")).alias("score"),
        )
        return own.result(cut(named, "nearest"))


def _compared(stored: DataFrame, asked: DataFrame, k: int, list_rows: int, ratio: float) -> DataFrame:
    """``(query, uid, score, low)``: the ``k + 1`` best entries of each asked one, among the lists that it reads."""
    count = lambda rows, name: rows.groupBy("shelf").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias(name))
    parts = cut(count(stored, "part").join(count(asked, "query_part"), "shelf"), "parts")
    keys = ["shelf", "part", "query_part"]
    left = _tiles(stored, "part", "query_part", parts).groupBy(*keys)
    right = _tiles(asked, "query_part", "part", parts).groupBy(*keys)

    def compare(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"query": [], "uid": [], "score": [], "low": []})
        return _best(rows, queries, k + 1, list_rows, ratio)

    kind = "query bigint, uid bigint, score double, low bigint"
    found = left.cogroup(right).applyInPandas(compare, kind)
    top = Window.partitionBy("query").orderBy(F.desc("score"), "low")
    return found.distinct().withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k + 1)


def _by_list(lists: pd.Series) -> dict[int, np.ndarray]:
    """The rows of each list."""
    rows = np.repeat(np.arange(len(lists)), [len(own) for own in lists])
    numbers = np.concatenate(lists.to_numpy())
    order = np.argsort(numbers, kind="stable")
    numbers, rows = numbers[order], rows[order]
    first = np.flatnonzero(np.diff(numbers, prepend=-1))
    return dict(zip(numbers[first].tolist(), np.split(rows, first[1:])))


def _parts(x: np.ndarray, q: np.ndarray, list_rows: int, ratio: float, least: int):
    """Rows and queries to compare of one list: all, or those of its parts where it has outgrown its length."""
    if len(x) <= 2 * list_rows:
        yield np.arange(len(x)), np.arange(len(q))
        return
    centroids = bisect(x, -(-len(x) // list_rows))
    distance = np.sqrt(np.maximum(0.0, 2 - 2 * x @ centroids.T))
    inside = distance <= np.maximum(distance.min(axis=1, keepdims=True) * REPLICATE_RATIO, 1e-9)
    away = np.sqrt(np.maximum(0.0, 2 - 2 * q @ centroids.T))
    order = np.argsort(away, axis=1, kind="stable")
    held = np.bincount(distance.argmin(axis=1), minlength=len(centroids))[order]
    near = np.take_along_axis(away, order, axis=1) <= np.maximum(away.min(axis=1, keepdims=True) * ratio, 1e-9)
    wanted = np.zeros_like(near)
    np.put_along_axis(wanted, order, near | (np.cumsum(held, axis=1) - held < least), axis=1)
    for part in range(len(centroids)):
        rows, queries = np.flatnonzero(inside[:, part]), np.flatnonzero(wanted[:, part])
        if len(rows) and len(queries):
            yield rows, queries


def _best(rows: pd.DataFrame, queries: pd.DataFrame, k: int, list_rows: int, ratio: float) -> pd.DataFrame:
    """The ``k`` best rows of a tile for each of its queries, by exact cosine, among the lists that a query reads."""
    x = np.array(rows["vector"].tolist(), dtype=np.float64)
    q = np.array(queries["vector"].tolist(), dtype=np.float64)
    uid, low, asked = rows["uid"].to_numpy(), rows["low"].to_numpy(), queries["uid"].to_numpy()
    unit, norms = _unit(x), np.sqrt((x * x).sum(axis=1))
    q_unit, q_norms = _unit(q), np.sqrt((q * q).sum(axis=1))
    held, found = _by_list(rows["lists"]), []
    for number, askers in _by_list(queries["lists"]).items():
        members = held.get(number)
        if members is None:
            continue
        for own_rows, own_queries in _parts(unit[members], q_unit[askers], list_rows, ratio, k):
            found.append(_nearest_rows(x, unit, norms, low, members[own_rows], q, q_unit, q_norms, askers[own_queries], k))
    if not found:
        return pd.DataFrame({"query": [], "uid": [], "score": [], "low": []})
    query, row, score = (np.concatenate(column) for column in zip(*found))
    # A row that two lists hold counts once.
    _, once = np.unique(query * len(x) + row, return_index=True)
    query, row, score = query[once], row[once], score[once]
    order = np.lexsort((low[row], -score, query))
    query, row, score = query[order], row[order], score[order]
    first = np.flatnonzero(np.diff(query, prepend=-1))
    place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
    kept = place < k
    return pd.DataFrame({"query": asked[query[kept]], "uid": uid[row[kept]], "score": score[kept], "low": low[row[kept]]})


def _nearest_rows(x, unit, norms, low, members, q, q_unit, q_norms, askers, k: int):
    """Queries, rows and scores of the ``k`` best ``members`` for each of ``askers``."""
    # Rounding can swap near ties, so a few more rows than needed are scored exactly.
    most = min(len(members), k + 16)
    parts = []
    step = max(1, BLOCK_SCORES // len(members))
    for start in range(0, len(askers), step):
        own = askers[start : start + step]
        near = members[np.argpartition(-(q_unit[own] @ unit[members].T), most - 1, axis=1)[:, :most]]
        score = (x[near] * q[own][:, None, :]).sum(axis=2) / (norms[near] * q_norms[own][:, None])
        order = np.lexsort((low[near], -score), axis=1)[:, :k]
        near, score = np.take_along_axis(near, order, axis=1), np.take_along_axis(score, order, axis=1)
        parts.append((np.repeat(own, near.shape[1]), near.ravel(), score.ravel()))
    return tuple(np.concatenate(column) for column in zip(*parts))
