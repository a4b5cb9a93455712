"""Ranked lexical search with a pipeline of term owners.

Documents are indexed in slices of at most ``SLICE_DOCS``, each written by the task that reads them: per slice and term
of any item, the documents and their counts. Every term has one owning stage, rare terms first. A bundle holds the
items of a block and, for one slice, their sparse accumulators, document by document. It passes through the stages in
turn: in each one a cogroup brings it together with the postings that the stage owns in its slice, whose integer
contributions are added, and the bundle goes on to the next owner. After the last stage, the best documents are selected.

Contributions are never negative, so partial scores only grow. After a stage an item's ``k``-th best partial score over
all slices is a floor under its ``k``-th final score; an accumulator that cannot reach it with all that later owners may
add is left out of the bundle. Such a document may come back with a smaller sum, still below the floor. Answers are
therefore exact; nothing is capped.

No group is larger than a block of items times a slice, however frequent a term is, and a frequent term's postings are spread
over all slices. Which terms the index keeps is decided by a set of ``2 ** SIEVE_BITS`` bits, the only thing that is
broadcast to all documents; a term that passes by chance finds no item and is dropped by the join that follows.

Defined results: terms are maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Null and
empty texts have no terms: such documents count nowhere, such items get no rows. Rows of ``items`` that share an id are one item
with the terms of all; a null id is an id. Every row of ``docs`` is a document of its own, also with a repeated or null
id; equal scores go by ascending id, null last. Ids of documents are integers. Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import picked
from rankflow.session import cut, scratch

STAGES = 4
SLICE_DOCS = 4096
SLICE_POSTINGS = 1_000_000
BLOCK_ITEMS = 128
SIEVE_BITS = 24
PIECE_BYTES = 1 << 20
WORDS_KNOWN = 500_000
# Fixed values of the score.
SCALE, COUNT, LENGTH, BASE, SHARE = 1_000_000_000, 1000, 20, 100, 50
SEED = 42  # of Spark's own xxhash64

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def count_terms(text: bytes) -> Counter:
    """How often each term occurs in a text in UTF-8, piece by piece, so that a long text is not held as words."""
    folded, counts, start = text.translate(_FOLD), Counter(), 0
    while start < len(folded):
        end = folded.find(b" ", start + PIECE_BYTES)
        end = len(folded) if end < 0 else end
        counts.update(folded[start:end].split())
        start = end
    return counts


def contribution(weight: int, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a term adds to documents in which it occurs ``counts`` times."""
    return weight * ((SCALE * counts) // (COUNT * counts + LENGTH * lengths))


def length_norm(size: int, documents: int, words: int) -> int:
    return BASE - SHARE + (SHARE * size * documents) // words


# --- items and the index -----------------------------------------------------------------------


def _utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary())


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``(item_id, term)``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms = [], []
            for i, text in enumerate(_utf8(batch.column(1))):
                own = count_terms(text.as_py() or b"")
                rows += [i] * len(own)
                terms += own
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(terms, pa.binary()).cast(pa.string())], names=["item_id", "term"])

    kind = dict(items.dtypes)["item_id"]
    return items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, term string").distinct()


def _numbered(terms: DataFrame) -> tuple[DataFrame, int]:
    """``(item_id, block, place)``, in blocks of about ``BLOCK_ITEMS`` items, and the number of blocks."""
    ids = cut(terms.select("item_id").distinct(), "items")
    blocks = max(1, -(-ids.count() // BLOCK_ITEMS))
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    place = F.row_number().over(Window.partitionBy("block").orderBy("item_id")) - 1
    return cut(ids.withColumn("block", block).withColumn("place", place), "numbered"), blocks


def _sieve(terms: DataFrame) -> np.ndarray:
    """``2 ** SIEVE_BITS`` bits with one for the hash of every term."""
    low = F.xxhash64("term").bitwiseAND((1 << SIEVE_BITS) - 1)
    bit = F.expr("shiftleft(1L, cast(low & 63 AS int))")
    rows = terms.select(low.alias("low")).groupBy(F.shiftright("low", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bits = np.zeros(1 << (SIEVE_BITS - 6), dtype=np.int64)
    found = rows.toArrow()
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint64)


class _Slice:
    """Documents and their postings until they are written."""

    def __init__(self):
        self.ids, self.sizes, self.found, self.postings = [], [], [], 0

    def add(self, doc_id, size: int, found: list[tuple[bytes, int]]) -> None:
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.found.append(found)
        self.postings += len(found)

    def full(self) -> bool:
        return len(self.ids) >= SLICE_DOCS or self.postings >= SLICE_POSTINGS

    def batch(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        """Documents stand in the order of their ids, so their places break ties."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i]))
        docs, counts = defaultdict(list), defaultdict(list)
        for place, i in enumerate(order):
            for term, times in self.found[i]:
                docs[term].append(place)
                counts[term].append(times)
        sizes = [self.sizes[i] for i in order]
        terms = list(docs)
        columns = [
            pa.array([True] + [False] * len(terms), pa.bool_()),
            pa.array([number] * (1 + len(terms)), pa.int64()),
            pa.array([None, *terms], pa.binary()).cast(pa.string()),
            pa.array([None, *docs.values()], pa.list_(pa.int32())),
            pa.array([sizes, *counts.values()], pa.list_(pa.int32())),
            pa.array([[self.ids[i] for i in order]] + [None] * len(terms), pa.list_(id_type)),
            pa.array([None, *(min(sizes[at] for at in own) for own in docs.values())], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["whole", "slice", "term", "docs", "counts", "ids", "shortest"])


def _index(docs: DataFrame, sieve) -> tuple[DataFrame, DataFrame]:
    """Written tables ``(slice, ids, sizes)`` and ``(slice, term, docs, counts, shortest)``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = sieve.value, {}
        number, own, id_type = TaskContext.get().partitionId() << 32, _Slice(), None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), _utf8(batch.column(1))):
                counts = count_terms(text.as_py() or b"")
                if not counts:
                    continue
                if len(known) > WORDS_KNOWN:
                    known.clear()
                found = []
                for term, times in counts.items():
                    kept = known.get(term)
                    if kept is None:
                        low = xxhash.xxh64_intdigest(term, SEED) & ((1 << SIEVE_BITS) - 1)
                        kept = known[term] = bool(int(bits[low >> 6]) >> (low & 63) & 1)
                    if kept:
                        found.append((term, times))
                own.add(doc_id, sum(counts.values()), found)
                if own.full():
                    yield own.batch(number, id_type)
                    number, own = number + 1, _Slice()
        if own.ids:
            yield own.batch(number, id_type)

    kind = dict(docs.dtypes)["doc_id"]
    schema = (
        "whole boolean, slice bigint, term string, docs array<int>, counts array<int>, "
        f"ids array<{kind}>, shortest int"
    )
    table = cut(docs.select("doc_id", "text").mapInArrow(read, schema), "index", partition_by=("whole",))
    slices = table.filter("whole = true").select("slice", "ids", F.col("counts").alias("sizes"))
    # Both come from one table and meet in a cogroup, so one side's columns get names of their own.
    postings = table.filter("whole = false").select(
        *[F.col(name).alias(name) for name in ("slice", "term", "docs", "counts", "shortest")]
    )
    return slices, postings


# --- owners ------------------------------------------------------------------------------------


def _owned(postings: DataFrame, terms: DataFrame, documents: int, words: int) -> DataFrame:
    """``(term, weight, most, stage)``: the most that a term can add, and the stage that owns it."""
    seen = postings.groupBy("term").agg(
        F.sum(F.size("docs")).alias("df"), F.max(F.array_max("counts")).cast("bigint").alias("times"),
        F.min("shortest").cast("bigint").alias("shortest"),
    )
    ratio = F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weight = F.floor(F.lit(1000.0) * F.log(ratio)).cast("bigint")
    # Products of a size and two totals can pass 64 bits before they are divided.
    norm = (BASE - SHARE) + F.floor(F.lit(float(SHARE)) * F.col("shortest") * F.lit(documents / max(1, words)))
    most = F.expr(f"({SCALE} * times) div greatest(1, {COUNT} * times + {LENGTH} * (norm - 1))")
    known = seen.join(terms.select("term").distinct(), "term", "left_semi").withColumn("weight", weight)
    known = known.withColumn("norm", norm).withColumn("most", F.col("weight") * most)
    step = F.floor(F.log2("df") * 2).cast("int")
    known = cut(known.select("term", "df", "weight", "most", step.alias("step")), "terms")
    # Stages own about equal numbers of postings: steps of document frequency, at most some hundred, in order.
    stage_of, before = {}, 0
    rows = sorted((row["step"], row["df"]) for row in known.groupBy("step").agg(F.sum("df").alias("df")).collect())
    total = sum(df for _, df in rows)
    for number, df in rows:
        stage_of[number] = min(STAGES - 1, (2 * before + df) * STAGES // max(1, 2 * total))
        before += df
    stages = [stage_of.get(number, 0) for number in range(max(stage_of, default=0) + 1)]
    owner = F.get(F.array(*[F.lit(stage) for stage in stages]), F.col("step"))
    return known.select("term", "weight", "most", owner.alias("stage"))


def _later(numbered: DataFrame, owned_items: DataFrame, stage: int) -> DataFrame:
    """``(block, place, rest)``: the most that owners after ``stage`` can add to an item's score."""
    rest = owned_items.filter(F.col("stage") > stage).groupBy("block", "place").agg(F.sum("most").alias("rest"))
    whole = numbered.select("block", "place").join(rest, ["block", "place"], "left")
    return whole.withColumn("rest", F.coalesce("rest", F.lit(0).cast("bigint")))


def _limits(later: DataFrame, floors: DataFrame | None) -> DataFrame:
    """``(block, rests, floors)``: per block two arrays by an item's place."""
    floor = F.lit(0).cast("bigint")
    if floors is not None:
        later, floor = later.join(floors, ["block", "place"], "left"), F.coalesce("floor", F.lit(0))
    listed = later.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "rest", floor.alias("floor")))).alias("own"))
    return listed.select("block", F.col("own.rest").alias("rests"), F.col("own.floor").alias("floors"))


def _numbers(column: pa.ChunkedArray, row: int = 0, kind=np.int64) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(kind)


def _listed(values: np.ndarray, kind) -> pa.Array:
    """One row with all values."""
    flat = pa.array(values.astype(kind))
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _tops(dense: np.ndarray, floors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Items and their ``k`` largest scores that reach the item's floor."""
    if dense.shape[1] > k:
        dense = np.partition(dense, dense.shape[1] - k, axis=1)[:, dense.shape[1] - k :]
    places, at = np.nonzero((dense > 0) & (dense >= floors[:, None]))
    return places, dense[places, at]


def _started(slices: DataFrame, blocks: int) -> DataFrame:
    """One bundle without accumulators for every slice and block of items."""
    empty = {"items": "array<int>", "docs": "array<int>", "scores": "array<bigint>"}
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    return slices.select(
        "slice", block.alias("block"), "ids", "sizes", *[F.array().cast(kind).alias(name) for name, kind in empty.items()]
    )


def _pass_stage(
    bundles: DataFrame, postings: DataFrame, limits: DataFrame, id_kind: str, documents: int, words: int, k: int
) -> DataFrame:
    """The bundles after one owner added what its postings give."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        sizes = left.column("sizes")[0].as_py()
        norms = np.array([length_norm(size, documents, words) for size in sizes], dtype=np.int64)
        rests, floors = _numbers(left.column("rests")), _numbers(left.column("floors"))
        dense = np.zeros((len(rests), len(sizes)), dtype=np.int64)
        dense[_numbers(left.column("items")), _numbers(left.column("docs"))] = _numbers(left.column("scores"))
        weights = right.column("weight").to_pylist()
        for row, weight in enumerate(weights):
            docs, counts = _numbers(right.column("docs"), row), _numbers(right.column("counts"), row)
            added = contribution(weight, counts, norms[docs])
            dense[np.ix_(_numbers(right.column("places"), row), docs)] += added
        items, docs = np.nonzero((dense > 0) & (dense + rests[:, None] >= floors[:, None]))
        top_items, top_scores = _tops(dense, floors, k)
        return pa.table({
            "slice": left.column("slice"), "block": left.column("block"), "ids": left.column("ids"),
            "sizes": left.column("sizes"), "items": _listed(items, np.int32), "docs": _listed(docs, np.int32),
            "scores": _listed(dense[items, docs], np.int64),
            "top_items": _listed(top_items, np.int32), "top_scores": _listed(top_scores, np.int64),
        })

    schema = (
        f"slice bigint, block int, ids array<{id_kind}>, sizes array<int>, items array<int>, docs array<int>, "
        "scores array<bigint>, top_items array<int>, top_scores array<bigint>"
    )
    left = bundles.drop("top_items", "top_scores").join(limits, "block").groupBy("slice", "block")
    right = postings.groupBy("slice", "block")
    return cut(left.cogroup(right).applyInArrow(add, schema), "bundles")


def _floors(bundles: DataFrame, k: int) -> DataFrame:
    """``(block, place, floor)``: the ``k``-th largest partial score of an item, where it has so many."""
    tops = bundles.select("block", F.explode(F.arrays_zip("top_items", "top_scores")).alias("top"))
    rows = tops.select("block", F.col("top.top_items").alias("place"), F.col("top.top_scores").alias("floor"))
    order = Window.partitionBy("block", "place").orderBy(F.desc("floor"))
    ranked = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k)
    return cut(ranked.filter(F.col("n") == k).drop("n"), "floors")


def _selected(bundles: DataFrame, floors: DataFrame, id_kind: str, k: int) -> DataFrame:
    """``(block, place, doc_id, score)``: of each slice the ``k`` best documents of an item that reach its floor."""

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                items, docs = _numbers(batch.column(2), row), _numbers(batch.column(3), row)
                scores, least = _numbers(batch.column(4), row), _numbers(batch.column(5), row)
                kept = scores >= least[items]
                items, docs, scores = items[kept], docs[kept], scores[kept]
                order = np.lexsort((docs, -scores, items))
                items, docs, scores = items[order], docs[order], scores[order]
                first = np.flatnonzero(np.diff(items, prepend=-1))
                place = np.arange(len(items)) - np.repeat(first, np.diff(np.append(first, len(items))))
                kept = place < k
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * int(kept.sum()), pa.int32()),
                     pa.array(items[kept].astype(np.int32)), batch.column(1)[row].values.take(pa.array(docs[kept])),
                     pa.array(scores[kept])],
                    names=["block", "place", "doc_id", "score"],
                )

    held = bundles.join(floors, "block").select("block", "ids", "items", "docs", "scores", "floors")
    return held.mapInArrow(select, f"block int, place int, doc_id {id_kind}, score bigint")


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    docs = picked(docs, doc_id=id_col, text=text_col)
    asked = picked(items, item_id=item_col, text=item_text_col)
    id_kind, item_kind = dict(docs.dtypes)["doc_id"], dict(asked.dtypes)["item_id"]
    with scratch(spark) as own:
        terms = cut(_item_terms(asked), "item_terms")
        numbered, blocks = _numbered(terms)
        slices, postings = _index(docs, spark.sparkContext.broadcast(_sieve(terms.select("term").distinct())))
        sizes = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda total, size: total + size)
        totals = slices.agg(F.sum(F.size("sizes")).alias("documents"), F.sum(sizes).alias("words")).first()
        documents, words = totals["documents"] or 0, totals["words"] or 0
        owned = _owned(postings, terms, documents, words)
        same = terms["item_id"].eqNullSafe(numbered["item_id"])
        owned_items = cut(
            terms.join(numbered, same).select("block", "place", "term").join(owned, "term"), "owned"
        )
        by_term = owned_items.groupBy("block", "term", "weight", "stage").agg(F.collect_list("place").alias("places"))
        by_term = cut(by_term, "by_term")
        bundles, floors = _started(slices, blocks), None
        for stage in range(STAGES):
            mine = postings.join(by_term.filter(F.col("stage") == stage), "term").select(
                "slice", "block", "weight", "places", "docs", "counts"
            )
            limits = _limits(_later(numbered, owned_items, stage), floors)
            after = _pass_stage(bundles, mine, limits, id_kind, documents, words, k)
            if stage:
                own.drop(bundles)
            bundles, floors = after, _floors(after, k)
        found = cut(_selected(bundles, _limits(_later(numbered, owned_items, STAGES), floors), id_kind, k), "found")
        order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        named = ranked.join(numbered, ["block", "place"]).select("item_id", "rank", "doc_id", "score")
        return own.result(cut(named, "ranked"))
