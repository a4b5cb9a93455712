"""Ranking over blocks of nodes: arrays instead of rows.

Nodes are dealt to blocks, by hash or by ranges of names. A link lies in the block of its source, which sends one sum for each
distinct target to the targets' blocks. Sources with very many links are *far*: their links lie in the blocks of their targets, and each
such block is sent the source's share once. So neither a source with very many targets nor a target with very many
sources fills one block. What a block sends to another is the same list of nodes in every iteration. Both sides know
it once the blocks are built, and an iteration shuffles values only: 8 bytes each, no names.

Nodes are 62-bit hashes of their names, which name the block too. Two names of one hash are found when the blocks are built, and
other hashes are taken then.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.session import SHUFFLE_PARTITIONS, Scope, cut, cut_bucketed, session_settings

# Links of a block, copies counted.
BLOCK_EDGES = 6_000_000
# Far sources are listed and broadcast, at most so many.
FAR_KEPT = 1_000_000
# Links that a task packs at once.
PACKED = 2_000_000
ID_BITS = 62
HASHES = 5

# Rows of a built block. Those from REQUESTED_SUMS on have the other block's number beside them.
IDS, DEGREE, COLLISION, SUM_FROM, SUM_AT, SUM_W, SUMS, FAR_AT, FAR_TO, FAR_W, SHARES = range(11)
REQUESTED_SUMS, REQUESTED_SHARES, ROUTED_SUMS, ROUTED_SHARES = range(20, 24)
BLOCK_SCHEMA = "place int, kind int, other int, data binary"
_ARROW = pa.schema([("place", pa.int32()), ("kind", pa.int32()), ("other", pa.int32()), ("data", pa.binary())])


@dataclass(frozen=True)
class Placement:
    """The numbers of nodes and the places of their blocks, of which there is one for each partition."""

    places: list[int]
    number: object
    seed: int

    def ids(self, name: Column) -> Column:
        """The node's number; its remainder by the number of blocks is the block."""
        count, hashed = len(self.places), F.xxhash64(F.lit(self.seed), name)
        if self.number is None:
            return hashed.bitwiseAND((1 << ID_BITS) - 1)
        return hashed.bitwiseAND((1 << (ID_BITS - count.bit_length())) - 1) * count + self.number(name)


def node_table(edges: DataFrame) -> DataFrame:
    """``(node, out_degree)`` of all nodes, written; links without a source's name take no part, as none can hold a rank for them."""
    ends = [F.struct(F.col(name).alias("node"), F.lit(sent).alias("sent")) for name, sent in (("src", 1), ("dst", 0))]
    found = edges.filter("src IS NOT NULL").select(F.inline(F.array(*ends)))
    return cut(found.groupBy("node").agg(F.sum("sent").alias("out_degree")), "nodes")


def block_count(nodes: DataFrame) -> int:
    total = nodes.agg(F.sum("out_degree")).first()[0] or 0
    return max(nodes.sparkSession.sparkContext.defaultParallelism, -(-total // BLOCK_EDGES))


def bucket_places(spark, count: int) -> list[int]:
    """Numbers of which the ``i``-th lands in bucket ``i`` of ``count``."""
    places: dict[int, int] = {}
    tried = 16 * count
    while len(places) < count:
        numbers = spark.range(tried).select(F.col("id").cast("int").alias("n"))
        rows = numbers.groupBy(F.pmod(F.hash("n"), F.lit(count)).alias("bucket")).agg(F.min("n").alias("n")).collect()
        places, tried = {row["bucket"]: row["n"] for row in rows}, 4 * tried
    return [places[i] for i in range(count)]


def _far_from(nodes: DataFrame, count: int) -> float | None:
    """From how many links on a source is far: so that its shares are fewer than its sums, and ``FAR_KEPT`` at most are."""
    step = F.floor(F.log2("out_degree") * 4).cast("int")
    many = nodes.filter(F.col("out_degree") >= 2 * count)
    least, kept = None, 0
    for row in sorted(many.groupBy(step.alias("step")).count().collect(), reverse=True):
        kept += row["count"]
        if kept > FAR_KEPT:
            break
        least = row["step"]
    return None if least is None else max(2 * count, 2 ** (least / 4) * (1 - 1e-9))


def block_ranks(
    own: Scope, edges: DataFrame, nodes: DataFrame, places: list[int], number, n_iter: int, damping: float, keep: bool,
    lists: bool, cache: bool, checkpoint_every: int,
) -> DataFrame:
    """``(node, out_degree, rank)`` after ``n_iter`` iterations, at least one.

    ``places`` has one entry per block, and ``number`` gives the block of a name unless blocks are by hash. ``lists`` stores
    one length per source instead of the source of each link.
    """
    spark, count = edges.sparkSession, len(places)
    far_from = _far_from(nodes, count)
    for seed in range(HASHES):
        placement = Placement(places, number, seed)
        built = _built(edges, nodes, placement, far_from, lists)
        if built.filter(F.col("kind") == COLLISION).isEmpty():
            break
        own.drop(built)
    else:
        raise ValueError("node names have equal hashes")
    links = _routed(built, places)
    own.drop(built)
    if cache:
        links = links.persist(StorageLevel.MEMORY_AND_DISK)
        links.count()  # the partitioning of a held table is known once it is filled
    try:
        send, receive = _sender(places), _receiver(places, damping, keep)
        sent = links.groupBy("place").applyInArrow(lambda rows: send(_arrays(rows), None), BLOCK_SCHEMA)
        for step in range(1, n_iter):
            sent = _met(links, sent, count, lambda rows, values: send(rows, receive(rows, values)), BLOCK_SCHEMA)
            if step % checkpoint_every == 0:
                sent = cut(sent, "sent")
        # Written before links that are held in memory go.
        ranks = cut(_met(links, sent, count, lambda rows, values: _ranked(rows, receive(rows, values)), "id bigint, rank double"), "ranks")
    finally:
        if cache:
            links.unpersist()
    return nodes.withColumn("id", placement.ids(F.col("node"))).join(ranks, "id").select("node", "out_degree", "rank")


# --- building ------------------------------------------------------------------------------------


def _built(edges: DataFrame, nodes: DataFrame, placement: Placement, far_from: float | None, lists: bool) -> DataFrame:
    """Blocks with their nodes, their links, and what they will send and want, written in buckets by place."""
    places, count = placement.places, len(placement.places)
    links = edges.filter("src IS NOT NULL").select(placement.ids(F.col("src")).alias("x"), placement.ids(F.col("dst")).alias("y"))
    if far_from is None:
        links = links.withColumn("far", F.lit(False))
    else:
        far = nodes.filter(F.col("out_degree") >= far_from).select(placement.ids(F.col("node")).alias("far_x"))
        links = links.join(F.broadcast(far), F.col("x") == F.col("far_x"), "left")
        links = links.select("x", "y", F.col("far_x").isNotNull().alias("far"))
    # A node's degree, below zero, stands where a link has its target.
    held = nodes.select(placement.ids(F.col("node")).alias("x"), (-1 - F.col("out_degree")).alias("y"), F.lit(False).alias("far"))
    packed = links.unionByName(held).mapInArrow(_packer(places), "place int, x binary, y binary, w binary")
    built = packed.repartition(count, "place").mapInArrow(_builder(places, lists), BLOCK_SCHEMA)
    return cut_bucketed(built, "built", count, ["place"])


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where rows differ from the row before, of sorted columns."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def _packer(places: list[int]):
    """Links of one block side by side in one row, sorted, copies counted."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        x, y, far = (np.concatenate([batch.column(i).to_numpy(zero_copy_only=False) for batch in held]) for i in range(3))
        block = np.where(far & (y >= 0), y, x) % len(places)
        # One number to sort by, of the block and the high bits of both ends: only copies have to be side by side, and
        # those that another link comes between are counted when the block is built.
        high = [(end.view(np.uint64) >> np.uint64(ID_BITS - 25)) & np.uint64((1 << 25) - 1) for end in (x, y)]
        order = np.argsort((block.astype(np.uint64) << np.uint64(50)) | (high[0] << np.uint64(25)) | high[1])
        block, x, y = block[order], x[order], y[order]
        at = _runs(block, x, y)
        w = np.diff(at, append=len(x))
        # Two nodes of one hash and degree are no copies; they have to be seen as two.
        w_node = np.repeat(y[at] < 0, w)
        if (w[y[at] < 0] > 1).any():
            at = np.flatnonzero(w_node | np.isin(np.arange(len(x)), at))
            w = np.where(y[at] < 0, 1, np.diff(at, append=len(x)))
        block, x, y = block[at], x[at], y[at]
        low = _runs(block)
        high = np.append(low[1:], len(block))
        columns = [
            # Differences of sorted numbers compress better.
            [places[block[i]] for i in low], [np.diff(x[i:j], prepend=0).tobytes() for i, j in zip(low, high)],
            [y[i:j].tobytes() for i, j in zip(low, high)],
            [None if (w[i:j] == 1).all() else w[i:j].astype(np.int64).tobytes() for i, j in zip(low, high)],
        ]
        types = pa.int32(), pa.binary(), pa.binary(), pa.binary()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["place", "x", "y", "w"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= PACKED:
                yield pack(held)
                held, rows = [], 0
        if held:
            yield pack(held)

    return packed


def _builder(places: list[int], lists: bool):
    count, numbers = len(places), {place: i for i, place in enumerate(places)}

    def build(place: int, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> list[tuple]:
        own, node = numbers[place], y < 0
        ids, degree = x[node], -1 - y[node]
        order = np.argsort(ids)
        ids, degree = ids[order], degree[order]
        if (ids[1:] == ids[:-1]).any():
            return [(place, COLLISION, 0, b"")]
        x, y, w = x[~node], y[~node], w[~node]
        near = x % count == own
        rows = [(place, IDS, 0, ids.tobytes()), (place, DEGREE, 0, degree.tobytes())]
        for here, there, w, known, kinds in (
            (x[near], y[near], w[near], "x", (SUM_FROM, SUM_AT, SUM_W, SUMS, REQUESTED_SUMS)),
            (y[~near], x[~near], w[~near], "y", (FAR_TO, FAR_AT, FAR_W, SHARES, REQUESTED_SHARES)),
        ):
            at = np.searchsorted(ids, here)
            if len(here) and (at.max() >= len(ids) or (ids[at] != here).any()):
                raise ValueError("links differ from one reading to the next")
            # Nodes of other blocks, by block.
            others, slot = np.unique(there, return_inverse=True)
            by_block = np.argsort(others % count, kind="stable")
            new = np.empty(len(others), dtype=np.int64)
            new[by_block] = np.arange(len(others))
            others = others[by_block]
            sizes = np.bincount(others % count, minlength=count)
            # The link's source leads: the own node of sums, the other one of shares.
            source, target = (at, new[slot]) if known == "x" else (new[slot], at)
            many = max(1, len(others) if known == "x" else len(ids))
            code = source * many + target
            if (w == 1).all():
                code.sort()
                first = _runs(code)
                total = np.diff(first, append=len(code))
            else:
                order = np.argsort(code)
                code = code[order]
                first = _runs(code)
                total = np.add.reduceat(w[order], first)
            code = code[first]
            source, target = code // many, code % many
            if lists:
                source = np.bincount(source, minlength=len(ids) if known == "x" else len(others))
            ends = (source, target) if known == "x" else (target, source)
            rows += [(place, kind, int(lists and (kind in (SUM_FROM, FAR_AT))), end.astype(np.int32).tobytes()) for kind, end in zip(kinds, ends)]
            if (total != 1).any():
                rows.append((place, kinds[2], 0, total.astype(np.int64).tobytes()))
            rows.append((place, kinds[3], 0, sizes.tobytes()))
            ends = np.cumsum(sizes)
            rows += [(place, kinds[4], i, others[ends[i] - sizes[i] : ends[i]].tobytes()) for i in np.flatnonzero(sizes).tolist()]
        return rows

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for batch in batches:
            for place, x, y, w in zip(*(batch.column(i).to_pylist() for i in range(4))):
                x, y = np.cumsum(np.frombuffer(x, np.int64)), np.frombuffer(y, np.int64)
                held[place].append((x, y, np.ones(len(x), np.int64) if w is None else np.frombuffer(w, np.int64)))
        while held:
            place, parts = held.popitem()
            rows = build(place, *(np.concatenate(column) for column in zip(*parts)))
            yield from _table(rows).to_batches()

    return built


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(_ARROW)
    return pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _routed(built: DataFrame, places: list[int]) -> DataFrame:
    """Blocks that know which of their nodes others send sums for or want shares of, written in buckets by place."""
    count = len(places)
    asked = built.filter(F.col("kind").isin(REQUESTED_SUMS, REQUESTED_SHARES))
    numbers, wanted = (F.split(F.lit(",".join(map(str, x))), ",").cast("array<int>") for x in (range(count), places))
    by_place = F.map_from_arrays(wanted, numbers)
    asked = asked.select(
        F.get(wanted, F.col("other")).alias("place"), "kind", F.element_at(by_place, F.col("place")).alias("other"), "data"
    )
    held = built.filter(~F.col("kind").isin(REQUESTED_SUMS, REQUESTED_SHARES))

    def route(block: pa.Table, asked: pa.Table) -> pa.Table:
        ids = next(np.frombuffer(d, np.int64) for k, d in zip(block["kind"].to_pylist(), block["data"].to_pylist()) if k == IDS)
        rows = []
        for place, kind, other, data in zip(*(asked[name].to_pylist() for name in _ARROW.names)):
            data = np.frombuffer(data, np.int64)
            at = np.searchsorted(ids, data)
            if at.max() >= len(ids) or (ids[at] != data).any():
                raise ValueError("links differ from one reading to the next")
            rows.append((place, kind + ROUTED_SUMS - REQUESTED_SUMS, other, at.astype(np.int32).tobytes()))
        return pa.concat_tables([block.cast(_ARROW), _table(rows)])

    with session_settings(built.sparkSession, {SHUFFLE_PARTITIONS: str(count)}):
        routed = held.groupBy("place").cogroup(asked.repartition(count, "place").groupBy("place")).applyInArrow(route, BLOCK_SCHEMA)
        # A task holds one block, so it writes to one bucket.
        return cut_bucketed(routed, "links", count, ["place"])


# --- iterations ----------------------------------------------------------------------------------


@dataclass
class _Block:
    """The arrays of one block."""

    place: int
    single: dict[int, np.ndarray]
    sums: dict[int, np.ndarray]
    shares: dict[int, np.ndarray]

    def links(self, source: int, target: int, weight: int) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
        return self.single[source], self.single[target], self.single.get(weight)


_WIDE = (IDS, DEGREE, SUM_W, SUMS, FAR_W, SHARES)


def _arrays(rows: pa.Table) -> _Block:
    single, sums, shares = {}, {}, {}
    for kind, other, data in zip(rows["kind"].to_pylist(), rows["other"].to_pylist(), rows["data"]):
        data = np.frombuffer(data.as_buffer(), np.int64 if kind in _WIDE else np.int32)
        if kind == ROUTED_SUMS:
            sums[other] = data
        elif kind == ROUTED_SHARES:
            shares[other] = data
        elif other:
            # One length per source.
            single[kind] = np.repeat(np.arange(len(data)), data)
        else:
            single[kind] = data
    return _Block(rows["place"][0].as_py(), single, sums, shares)


def _summed(values: np.ndarray, source, target, weight, size: int, all_linked: bool) -> np.ndarray:
    """What each of ``size`` targets gets from the sources' values; not a number if no source has any."""
    sent = values[source]
    if weight is not None:
        sent = sent * weight
    got = ~np.isnan(sent)
    whole = bool(got.all())
    if not whole:
        sent, target = sent[got], target[got]
    total = np.bincount(target, weights=sent, minlength=size).astype(np.float64)
    if not (whole and all_linked):
        total[np.bincount(target, minlength=size) == 0] = np.nan
    return total


def _sender(places: list[int]):
    """Rows for other blocks from a block whose nodes hold ``ranks``; at the start sources hold 1."""
    numbers = {place: i for i, place in enumerate(places)}

    def send(block: _Block, ranks: np.ndarray | None) -> pa.Table:
        degree, own = block.single[DEGREE], numbers[block.place]
        share = np.full(len(degree), np.nan)
        np.divide(1.0 if ranks is None else ranks, degree, out=share, where=degree > 0)
        sizes = block.single[SUMS]
        sums = _summed(share, *block.links(SUM_FROM, SUM_AT, SUM_W), int(sizes.sum()), True)
        ends = np.cumsum(sizes)
        rows = [
            (places[i], ROUTED_SUMS, own, sums[ends[i] - sizes[i] : ends[i]].tobytes()) for i in np.flatnonzero(sizes).tolist()
        ]
        rows += [(places[i], ROUTED_SHARES, own, share[at].tobytes()) for i, at in block.shares.items()]
        return _table(rows)

    return send


def _receiver(places: list[int], damping: float, keep: bool):
    """New ranks from what other blocks sent; not a number where a node has none."""

    def receive(block: _Block, values: pa.Table) -> np.ndarray:
        degree, sizes = block.single[DEGREE], block.single[SHARES]
        total, held = np.zeros(len(degree)), np.zeros(len(degree), dtype=bool)
        far, ends = np.full(int(sizes.sum()), np.nan), np.cumsum(sizes)
        sent = sorted(zip(values["kind"].to_pylist(), values["other"].to_pylist(), range(len(values))))
        for kind, other, i in sent:
            data = np.frombuffer(values["data"][i].as_buffer(), np.float64)
            if kind == ROUTED_SHARES:
                far[ends[other] - sizes[other] : ends[other]] = data
                continue
            at, got = block.sums[other], ~np.isnan(data)
            if not got.all():
                at, data = at[got], data[got]
            total[at] += data
            held[at] = True
        if len(far):
            more = _summed(far, *block.links(FAR_AT, FAR_TO, FAR_W), len(degree), False)
            got = ~np.isnan(more)
            total[got] += more[got]
            held |= got
        if keep:
            held |= degree > 0
        return np.where(held, (1.0 - damping) + damping * total, np.nan)

    return receive


def _ranked(block: _Block, ranks: np.ndarray) -> pa.Table:
    held = ~np.isnan(ranks)
    return pa.table({"id": pa.array(block.single[IDS][held], pa.int64()), "rank": pa.array(ranks[held], pa.float64())})


def _met(links: DataFrame, sent: DataFrame, count: int, work, schema: str) -> DataFrame:
    """``work`` on each block and what was sent to it; only the latter moves."""
    values = sent.repartition(count, "place")
    return links.groupBy("place").cogroup(values.groupBy("place")).applyInArrow(lambda rows, values: work(_arrays(rows), values), schema)
