"""Exact similarity join of word n-gram sets under Jaccard similarity.

Equal texts form a class, whose set stands for all copies. Sets that may be similar
share one of their first elements in any common order (the prefix filter); the order is by hash,
with frequent n-grams last, so a passage that many texts share brings few candidates. Each further element of a prefix
is one more that similar sets must share there, so prefixes are somewhat longer, and a set that shares fewer elements than that with
all others together goes: that is most of those that meet others by chance or in a short passage. Groups of sets that share
such an element, one of each kind if several elements are shared by the same sets, are put into bins by the largest component
that a group holds so far: the groups of one family of near copies hold the same component, so each set is in their
bin once. A bin is a tile; one that is too large is cut into tiles by size band, as similar sets lie in the same band or in
two that adjoin, and by number. In a tile, hashed bitmaps bound the overlap from above: bits that differ count elements that
only one set has. What passes is compared exactly, as sorted arrays of 64-bit n-gram hashes.

Links inside a component that is already known need no second proof. A first round deals each row of a bin to one tile and
proves a spanning forest of what the bitmaps let through, so it gives fewer pairs than it takes rows. If all of a bin's forest
is proved, there is nothing else to find in it. Only groups of bins in which a pair was refuted, or that have several
tiles, go on: to another forest while bins have several tiles, dealt anew each time, and to a last round, which
proves every pair between different components that bitmaps let through. There, rows of a bin's largest component are never compared with each other, so each of them goes to one tile, and
only the others go to all tiles of the bin. Nothing is capped: forests, bins, the
list of frequent n-grams and the sieves only save work, and results are the same without them.

Tables are deleted as soon as nothing reads them; what stays is small: one row per class or per row that may have to go.

Defined results: words are split at spaces, tabs and line ends, A-Z lower-cased. A text with fewer words than
an n-gram is one element; a null text or one without words has no set and links with nothing. Rows with equal
texts are linked. A row with a null id takes its component's smallest id, and null where no id is known. Rows
that share an id are separate documents. An empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import LOWER, UPPER, picked
from rankflow.llm.components import components
from rankflow.llm.lattice import mix64
from rankflow.session import SHUFFLE_PARTITIONS, Scope, cut, cut_bucketed, scratch

NGRAM = 5
# Similarity as a fraction: links have NUMERATOR * union <= DENOMINATOR * intersection.
NUMERATOR, DENOMINATOR = 80, 100

# Elements that similar sets have to share in their prefixes: so many, and one more for each so many of the set.
SHARED, SHARED_EACH = 8, 50
# From so many sets an n-gram counts as frequent; as many as this are listed.
FREQUENT = 32
FREQUENT_KEPT = 1_000_000
OFTEN_IN_TASK = 4
# Rows of a tile: of several bins, and of a bin that is too large for one.
TILE = 4096
LARGE_TILE = 16_384
SIEVE_BITS = 24
HASHES_HELD = 2_000_000
WORDS_KNOWN = 200_000
# Bits of a bitmap per element, and pairs of rows compared at once.
MARK_BITS = 4
PAIRS_HELD = 400_000

# So many rows that may have to go are broadcast (their keys and ids); more meet the texts in a shuffle.
DOUBTFUL_SENT = 500_000

# Rounds that look for forests at most, as long as bins have several tiles.
FOREST_ROUNDS = 3

_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


class _WordHashes(dict):
    """Hashes of words, each computed when it is first looked up."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word n-grams, for texts in UTF-8."""

    def __init__(self, n: int):
        self.n, self.known = n, _WordHashes()
        self.factors = mix64(np.arange(n, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, text: bytes) -> np.ndarray:
        known = self.known
        if len(known) > WORDS_KNOWN:
            known.clear()
        # Bytes are split at the ASCII white space that separates words, and nowhere else.
        words = text.translate(_LOWER_BYTES).split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        own = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        width = min(self.n, len(own))
        count = len(own) - width + 1
        rolled = np.full(count, width, dtype=np.uint64)
        for i in range(width):
            rolled += own[i : i + count] * self.factors[i]
        return np.unique(mix64(rolled))


def needed_overlap(sizes: np.ndarray) -> np.ndarray:
    """The least overlap with any similar set."""
    return -(-sizes * NUMERATOR // DENOMINATOR)


def prefix_overlap(size):
    """The least overlap of a set's prefix with that of any similar one as large or larger, if both overlap so much."""
    return SHARED + size // SHARED_EACH


def linked(overlap, size_a, size_b):
    """Whether the overlap makes two sets similar, in integers."""
    return DENOMINATOR * overlap >= NUMERATOR * (size_a + size_b - overlap)


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    """A set bit for each element's hash, ``bits`` a power of two of at least 64."""
    words = np.zeros(bits // 8, dtype=np.uint8)
    at = (mix64(hashes) & np.uint64(bits - 1)).astype(np.int64)
    np.bitwise_or.at(words, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return words.view(np.uint64)


def fold(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap brought to ``size`` words by laying its parts over each other."""
    return np.bitwise_or.reduce(words.reshape(-1, size), axis=0) if len(words) > size else words


def bitmap_bits(size: int, per_element: int, most: int = 1 << 16) -> int:
    return min(most, max(64, 1 << (max(1, size * per_element) - 1).bit_length()))


def band(size: Column) -> Column:
    """Similar sets lie in the same size band or in two that adjoin."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(DENOMINATOR / NUMERATOR)) + 1e-9).cast("int")


# --- classes and their prefixes ----------------------------------------------------------------


def _utf8(column: pa.Array) -> pa.Array:
    return column.cast(pa.binary())


def _classes(rows: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables: classes ``(cid, key, size, text)``, n-grams seen often, and each key's smallest id.

    Only texts that seem to occur twice are shuffled, after partial aggregation.
    """
    firsts = cut(
        rows.groupBy("key").agg(F.min("id").alias("first_id"), F.count("*").alias("copies")), "firsts"
    )
    repeated = firsts.filter("copies > 1").select(F.xxhash64("key").alias("value"))
    sifted = _sifted(rows.select("key", "text"), F.xxhash64("key"), repeated)
    once = sifted.filter("maybe").groupBy("key").agg(F.first("text").alias("text"))
    grouped = sifted.filter("NOT maybe").select("key", "text").unionByName(once)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, total = Shingler(n), [], 0

        def often() -> pa.RecordBatch:
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            kept = counts >= OFTEN_IN_TASK
            rows = int(kept.sum())
            columns = [
                pa.array([True] * rows, pa.bool_()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int32()),
                pa.nulls(rows, pa.string()),
                pa.array(values[kept].view(np.int64)), pa.array(counts[kept].astype(np.int64)),
            ]
            return pa.RecordBatch.from_arrays(columns, names=_NAMES)

        for batch in batches:
            sizes = []
            for text in _utf8(batch.column(1)):
                own = shingles(text.as_py())
                sizes.append(len(own))
                held.append(own)
                total += len(own)
                if total > HASHES_HELD:
                    yield often()
                    held, total = [], 0
            nothing = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * len(sizes), pa.bool_()), batch.column(0), pa.array(sizes, pa.int32()),
                 batch.column(1), nothing, nothing],
                names=_NAMES,
            )
        if held:
            yield often()

    schema = "hint boolean, key binary, size int, text string, token bigint, seen bigint"
    signed = grouped.select("key", "text").mapInArrow(sign, schema)
    table = cut(
        signed.withColumn("cid", F.monotonically_increasing_id()), "classes", partition_by=("hint",)
    )
    return table.filter("hint = false"), table.filter("hint = true").select("token", "seen"), firsts


_NAMES = ["hint", "key", "size", "text", "token", "seen"]


def _marks(classes: DataFrame, n: int) -> DataFrame:
    """``(cid, mark)``: bitmaps of the sets of ``classes (cid, text)``."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in batches:
            sets = (shingles(text.as_py()) for text in _utf8(batch.column(1)))
            marks = [bitmap(own, bitmap_bits(len(own), MARK_BITS)).tobytes() for own in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.binary())], names=["cid", "mark"])

    return classes.mapInArrow(mark, "cid bigint, mark binary")


def _frequent(hints: DataFrame) -> np.ndarray:
    """Sorted hashes of the most frequent n-grams, at most ``FREQUENT_KEPT`` of them."""
    totals = hints.groupBy("token").agg(F.sum("seen").alias("seen")).filter(F.col("seen") >= FREQUENT)
    step = F.floor(F.log2("seen") * 4).cast("int")
    counts = sorted(totals.groupBy(step.alias("step")).count().collect(), reverse=True)
    least, kept = None, 0
    for row in counts:
        kept += row["count"]
        if kept > FREQUENT_KEPT:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    listed = totals.filter(step >= least).select("token").toPandas()["token"].to_numpy(np.int64)
    return np.sort(listed.view(np.uint64))


def _postings(classes: DataFrame, n: int, frequent) -> DataFrame:
    """``(token, cid, size)``: the first n-grams of each class in the common order.

    Of what two similar sets share, the j-th lies among the first ``size - needed_overlap(size) + j`` of each.
    """

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, rare_last = Shingler(n), frequent.value
        for batch in batches:
            tokens, owners, sizes = [], [], []
            for cid, text in zip(batch.column(0).to_numpy(), _utf8(batch.column(1))):
                own = shingles(text.as_py())
                if len(rare_last):
                    at = np.minimum(np.searchsorted(rare_last, own), len(rare_last) - 1)
                    often = rare_last[at] == own
                    own = np.concatenate([own[~often], own[often]])
                prefix = own[: len(own) - int(needed_overlap(np.int64(len(own)))) + prefix_overlap(len(own))]
                tokens.append(prefix.view(np.int64))
                owners.append(np.full(len(prefix), cid))
                sizes.append(np.full(len(prefix), len(own), dtype=np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in (tokens, owners, sizes)], names=["token", "cid", "size"],
                )

    schema = "token bigint, cid bigint, size int"
    return classes.filter("size > 0").select("cid", "text").mapInArrow(first, schema)


def _sieve_rows(values: DataFrame) -> DataFrame:
    """``(word, bits)``: a set of ``2 ** SIEVE_BITS`` bits that has the low bits of every ``value``."""
    low = F.col("value").bitwiseAND((1 << SIEVE_BITS) - 1)
    shifted = F.expr("shiftleft(1L, cast(low & 63 AS int))")
    return values.select(low.alias("low")).groupBy(F.shiftright("low", 6).alias("word")).agg(
        F.bit_or(shifted).alias("bits")
    )


def _sifted(table: DataFrame, value: Column, wanted: DataFrame) -> DataFrame:
    """``table`` with ``maybe``: false only where ``value`` is not among those of ``wanted (value)``.

    The set of bits that is broadcast has at most ``2 ** (SIEVE_BITS - 6)`` rows of two numbers, whatever the data.
    """
    low = value.bitwiseAND((1 << SIEVE_BITS) - 1)
    met = table.withColumn("_low", low).join(
        F.broadcast(_sieve_rows(wanted)), F.shiftright("_low", 6) == F.col("word"), "left"
    )
    maybe = F.expr("coalesce((shiftright(bits, cast(_low & 63 AS int)) & 1) = 1, false)")
    return met.withColumn("maybe", maybe).drop("_low", "word", "bits")


def _only(table: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``table`` whose ``key`` may be in ``wanted (cid)``, which spares the others the shuffle of a join."""
    kept = _sifted(table, F.xxhash64(key), wanted.select(F.xxhash64("cid").alias("value"))).filter("maybe")
    return kept.select(*table.columns)


# --- candidates and proofs ---------------------------------------------------------------------


def _prove(pairs: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """Those of the written ``pairs (a, b)`` that are similar."""
    texts = _only(classes.select("cid", "text"), "cid", pairs.select(F.explode(F.array("a", "b")).alias("cid")))
    both = pairs.join(
        texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a"
    ).join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(n)
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            keep = np.zeros(len(a), dtype=bool)
            for i, (x, y) in enumerate(zip(_utf8(batch.column(2)), _utf8(batch.column(3)))):
                x, y = shingles(x.as_py()), shingles(y.as_py())
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = linked(overlap, len(x), len(y))
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return cut(both.select("a", "b", "text_a", "text_b").mapInArrow(exact, "a bigint, b bigint"), "links")


def _groups(own: Scope, postings: DataFrame) -> DataFrame:
    """``(token, cid, size)`` of tokens that several classes have, one token for each set of classes.

    Classes that share too few tokens for any link have no rows, but for some that a sieve lets through.
    """
    members = F.count("*").over(Window.partitionBy("token"))
    buckets = int(own.spark.conf.get(SHUFFLE_PARTITIONS))
    # Postings are dealt by token once, so each bucket is written by one task.
    met = cut_bucketed(postings.withColumn("members", members).filter("members > 1"), "met", buckets, ["token"])
    sign = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "cid"))
    signed = met.groupBy("token").agg(F.first("members").alias("members"), sign(1).alias("one"), sign(2).alias("two"))
    alone = signed.groupBy("members", "one", "two").agg(F.min("token").alias("token"), F.count("*").alias("tokens"))
    groups = cut(met.join(alone.select("token", "tokens"), "token").select("token", "cid", "size", "tokens"), "groups")
    own.drop(met)
    shared = groups.groupBy("cid").agg(F.sum("tokens").alias("shared"), F.first("size").alias("size"))
    overlap = F.ceil(F.col("size") * NUMERATOR / DENOMINATOR)
    # The other set may be smaller, but not than this overlap.
    least = F.least(F.lit(SHARED) + F.floor(overlap / SHARED_EACH), overlap)
    able = cut(shared.filter(F.col("shared") >= least).select("cid"), "able")
    kept = cut(_only(groups.select("token", "cid", "size"), "cid", able), "groups")
    own.drop(groups, able)
    return kept


def _bins(own: Scope, groups: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """``(bin, cid, size, label)``, distinct, and ``(token, bin)``: a group's rows are in the bin of its largest component.

    Groups of one component have none. Without ``labels`` every class is a component.
    """
    if labels is None:
        named = groups.withColumn("label", F.col("cid"))
    else:
        named = groups.join(labels.withColumnRenamed("node", "cid"), "cid", "left")
        named = cut(named.withColumn("label", F.coalesce("label", "cid")), "labelled")
    sizes = named.groupBy("token", "label").agg(F.count("*").alias("rows"))
    top = sizes.groupBy("token").agg(F.max(F.struct("rows", "label")).alias("top"), F.count("*").alias("labels"))
    mixed = cut(top.filter("labels > 1").select("token", F.col("top.label").alias("bin")), "mixed")
    bins = cut(named.join(mixed, "token").select("bin", "cid", "size", "label").distinct(), "rows")
    if labels is not None:
        own.drop(named)
    kept = cut(_with_partners(bins), "bins")
    own.drop(bins)
    return kept, mixed


def _with_partners(bins: DataFrame) -> DataFrame:
    """Rows of ``bins`` that another row of their bin is near enough in size to: by their bands and those that adjoin."""
    placed = bins.withColumn("band", band(F.col("size")))
    counts = placed.groupBy("bin", "band").agg(F.count("*").alias("rows"))
    reached = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band")
    near = counts.select("bin", reached, "rows").groupBy("bin", "band").agg(F.sum("rows").alias("rows"))
    return placed.join(near.filter("rows > 1").select("bin", "band"), ["bin", "band"]).select(*bins.columns)


_TILE = ["tile", "band", "part"]


def _banded(bins: DataFrame) -> DataFrame:
    """Rows of large ``bins`` in their own band and the one below, with a number of ``parts``.

    A row stays in a band only if some row there is of a size that can be similar.
    """
    own = bins.withColumn("band", band(F.col("size"))).withColumn("upper", F.lit(False))
    below = own.withColumn("band", F.col("band") - 1).withColumn("upper", F.lit(True))
    placed = own.unionByName(below)
    own_size = F.when(~F.col("upper"), F.col("size"))
    counts = placed.groupBy("bin", "band").agg(
        F.ceil(F.count("*") / LARGE_TILE).cast("int").alias("parts"),
        F.min(own_size).alias("least"), F.max(own_size).alias("most"),
    )
    partner = F.greatest(F.col("least"), F.ceil(F.col("size") * NUMERATOR / DENOMINATOR))
    useful = partner <= F.when(F.col("upper"), F.col("most")).otherwise(partner)
    return placed.join(counts.filter("least IS NOT NULL"), ["bin", "band"]).filter(useful)


def _forest_tiles(banded: DataFrame, number: int) -> DataFrame:
    """Every row of a large bin in one tile, dealt anew in each round."""
    part = F.pmod(F.xxhash64("cid", F.lit(number)), F.col("parts")).cast("int")
    return banded.withColumn("part", part).withColumn("home", F.lit(True))


def _all_tiles(banded: DataFrame) -> DataFrame:
    """Every two rows of a large bin that are not both in its largest component in some tile.

    A row of the largest component, which names the bin, is in one tile, its home, others are in all: two rows
    meet in the home of one.
    """
    dealt = banded.withColumn("own", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("parts") - 1)
    part = F.explode(F.when(F.col("label") == F.col("bin"), F.array("own")).otherwise(everywhere))
    return dealt.withColumn("part", part).withColumn("home", F.col("part") == F.col("own"))


def _tiles(bins: DataFrame, deal) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ``bins`` in tiles, and the bins that have several, if any; ``deal`` places the rows of such bins.

    Bins that fit share tiles, so a tile is never much smaller than ``TILE`` rows.
    """
    counts = bins.groupBy("bin").agg(F.count("*").alias("rows"))
    fits = F.col("rows") <= LARGE_TILE
    rows, large = counts.agg(F.sum(F.when(fits, F.col("rows"))), F.count(F.when(~fits, 1))).first()
    shared = -1 - F.pmod(F.xxhash64("bin"), F.lit(max(1, -(-(rows or 0) // TILE))))
    columns = ["bin", "cid", "size", "label", "upper", "home", *_TILE]
    if not large:
        sized, several = bins, None
    else:
        sized = bins.join(counts, "bin")
        several = deal(_banded(sized.filter(~fits).select("bin", "cid", "size", "label"))).withColumn("tile", F.col("bin"))
        sized = sized.filter(fits)
    single = sized.withColumns({
        "upper": F.lit(False), "home": F.lit(True), "tile": shared, "band": F.lit(0), "part": F.lit(0)
    }).select(*columns)
    if several is None:
        return single, None
    return single.unionByName(several.select(*columns)), counts.filter(~fits).select("bin")


def _tile_pairs(tiles: DataFrame, marks: DataFrame, forest: bool) -> DataFrame:
    """``(bin, a, b)``: pairs of components that the bitmaps let through, or a spanning forest of them per bin and tile."""

    def tile(rows: pd.DataFrame) -> pd.DataFrame:
        numbers = [rows[name].to_numpy() for name in ("bin", "cid", "size", "label", "upper", "home")]
        order = np.argsort(numbers[0], kind="stable")
        bins, *columns = (column[order] for column in numbers)
        marks = [np.frombuffer(x, np.uint64) for x in rows["mark"].to_numpy()[order]]
        first = np.flatnonzero(np.diff(bins, prepend=bins[0] - 1))
        found = [
            _through(*(column[low:high] for column in columns), marks[low:high], forest)
            for low, high in zip(first, [*first[1:], len(bins)])
        ]
        of = np.repeat(bins[first], [len(a) for a, _ in found])
        a, b = (np.concatenate(column) for column in zip(*found))
        return pd.DataFrame({"bin": of, "a": np.minimum(a, b), "b": np.maximum(a, b)})

    marked = tiles.join(marks, "cid").select(*_TILE, "bin", "cid", "size", "label", "upper", "home", "mark")
    return marked.groupBy(*_TILE).applyInPandas(tile, "bin bigint, a bigint, b bigint")


def _through(
    cid: np.ndarray, size: np.ndarray, labels: np.ndarray, upper: np.ndarray, home: np.ndarray, raw: list[np.ndarray],
    forest: bool,
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one bin's rows in different components whose bitmaps do not rule them out."""
    names, label, counts = np.unique(labels, return_inverse=True, return_counts=True)
    # Rows of the most frequent label come last: between them there is nothing to find.
    last = label == counts.argmax()
    order = np.argsort(last, kind="stable")
    firsts = int((~last).sum())
    cid, size, label, upper, home = cid[order], size[order].astype(np.int64), label[order], upper[order], home[order]
    root = np.arange(len(names))
    found_a, found_b = [cid[:0]], [cid[:0]]
    # Similar sets are so near in size that their bitmaps are equally long, or one is twice as long as the other.
    widths = np.array([len(raw[i]) for i in order])
    for width in np.unique(widths):
        rows = np.flatnonzero((widths == width) | (widths == 2 * width))
        marks = np.stack([fold(raw[order[i]], width) for i in rows])
        short = widths[rows] == width
        before = int(np.searchsorted(rows, firsts))
        step = max(1, PAIRS_HELD // max(1, len(rows) * int(width)))
        for low in range(0, before, step):
            first, second = np.arange(low, min(low + step, before)), np.arange(low + 1, len(rows))
            i, j = rows[first][:, None], rows[second][None, :]
            # Each pair once: the second is a later row, and not both are from the band above.
            open_ = (i < j) & (short[first][:, None] | short[second][None, :]) & ~(upper[i] & upper[j])
            open_ &= (label[i] != label[j]) & (home[i] | home[j])
            open_ &= linked(np.minimum(size[i], size[j]), size[i], size[j])
            x, y = np.nonzero(open_)
            x, y = first[x], second[y]
            differ = np.bitwise_count(marks[x] ^ marks[y]).sum(axis=1, dtype=np.int64)
            x, y = rows[x], rows[y]
            through = linked((size[x] + size[y] - differ) // 2, size[x], size[y])
            x, y = x[through], y[through]
            if forest:
                # Pairs that differ least are the likeliest links.
                likely = np.argsort(differ[through], kind="stable")
                x, y = x[likely], y[likely]
                kept = _grow(root, label[x], label[y])
                x, y = x[kept], y[kept]
            found_a.append(cid[x])
            found_b.append(cid[y])
    return np.concatenate(found_a), np.concatenate(found_b)


def _grow(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[int]:
    """Which of the edges join two trees of the forest kept in ``root``."""

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    kept = []
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
            kept.append(k)
    return kept


def _labelled(own: Scope, rows: DataFrame, n: int) -> DataFrame:
    """``(key, size, first_id, label)`` for every class of ``rows (id, key, text)``; nothing else stays written."""
    context = rows.sparkSession.sparkContext
    classes, hints, firsts = _classes(rows, n)
    groups = _groups(own, _postings(classes, n, context.broadcast(_frequent(hints))))
    labels = _components(own, _all_links(own, groups, classes, n))
    slim = cut(classes.select("key", "cid", "size"), "slim")
    own.drop(classes)
    known = slim.join(labels.withColumnRenamed("node", "cid"), "cid", "left").join(firsts.select("key", "first_id"), "key")
    known = cut(known.select("key", "size", "first_id", F.coalesce("label", "cid").alias("label")), "known")
    own.drop(slim, labels, firsts)
    return known


def _components(own: Scope, links: DataFrame) -> DataFrame:
    """Labels of the nodes of ``links``, written once; the tables on the way to them go."""
    with scratch(own.spark) as inner:
        return inner.result(cut(components(links), "labels"))


def _all_links(own: Scope, groups: DataFrame, classes: DataFrame, n: int) -> DataFrame:
    """Proven links that connect whatever is similar."""
    wanted = cut(groups.select("cid").distinct(), "wanted")
    marks = cut(_marks(_only(classes.select("cid", "text"), "cid", wanted), n), "marks")
    links, labels = None, None
    for number in range(FOREST_ROUNDS):
        bins, mixed = _bins(own, groups, labels)
        tiles, several = _tiles(bins, lambda banded: _forest_tiles(banded, number))  # noqa: B023
        found = cut(_tile_pairs(tiles, marks, forest=True), "forest")
        pairs = cut(found.select("a", "b").distinct(), "pairs")
        proven = _prove(pairs, classes, n)
        links = proven if links is None else links.unionByName(proven)
        labels = _components(own, links)
        # Bins that may hold more: those with a refuted pair, and those whose tiles have not all met.
        refuted = pairs.join(proven, ["a", "b"], "left_anti")
        again = found.join(refuted, ["a", "b"], "left_semi").select("bin")
        again = (again if several is None else again.unionByName(several)).distinct()
        fewer = cut(groups.join(mixed.join(again, "bin", "left_semi").select("token"), "token", "left_semi"), "groups")
        own.drop(groups, bins, mixed, found, pairs)
        groups = fewer
        if several is None:
            break
    bins, mixed = _bins(own, groups, labels)
    tiles, _ = _tiles(bins, _all_tiles)
    few = _only(marks, "cid", bins.select("cid"))
    pairs = cut(_tile_pairs(tiles, few, forest=False).select("a", "b").distinct(), "across")
    links = links.unionByName(_prove(pairs, classes, n))
    own.drop(wanted, marks, groups, bins, mixed, pairs)
    return links


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    whole = F.coalesce("text", F.lit(""))
    return picked(docs, id=id_col, text=text_col).select("id", whole.alias("text"), class_key(whole).alias("key"))


def class_key(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def similarity_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM
) -> DataFrame:
    """``(id, n_shingles, component_id)`` per row of ``docs``."""
    rows = _keyed(docs, id_col, text_col)
    with scratch(docs.sparkSession) as own:
        known = _labelled(own, rows, n)
        least = known.groupBy("label").agg(F.min("first_id").alias("component_id"))
        found = cut(known.join(least, "label").select("key", "size", "component_id"), "found")
        return own.result(
            rows.select("id", "key").join(found, "key").select(
                "id", F.col("size").cast("bigint").alias("n_shingles"),
                F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
            )
        )


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM
) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, known ids first.

    Rows without words stay. Rows are shuffled with their texts only if they share text and id with others, or if
    more than ``DOUBTFUL_SENT`` may have to go: then those.
    """
    with scratch(docs.sparkSession) as own:
        return own.result(_one_of_each(own, docs, id_col, text_col, n))


def _one_of_each(own: Scope, docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    rows = _keyed(docs, id_col, text_col)
    known = _labelled(own, rows, n).filter("size > 0")
    best = known.groupBy("label").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("unknown"), "first_id", "key")).alias("best")
    )
    chosen = cut(
        known.join(best, "label").select(
            F.col("key").alias("c_key"), (F.col("key") == F.col("best.key")).alias("leads"), "first_id"
        ),
        "chosen",
    )
    judged = rows.select("id", "key").join(chosen, F.col("key") == F.col("c_key")).withColumn(
        "kept", F.col("leads") & F.col("id").eqNullSafe(F.col("first_id"))
    )
    doubtful = judged.groupBy("key", "id", "kept").agg(F.count("*").alias("copies")).filter("NOT kept OR copies > 1")
    doubtful = cut(doubtful.select(F.col("key").alias("d_key"), F.col("id").alias("d_id"), "kept"), "doubtful")
    sent = F.broadcast(doubtful) if doubtful.count() <= DOUBTFUL_SENT else doubtful
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    key = class_key(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    keyed = docs.select(row.alias("row"), key.alias("key"), F.col(f"`{id_col}`").alias("id"))
    sifted = _sifted(keyed, F.xxhash64("key", "id"), doubtful.select(F.xxhash64("d_key", "d_id").alias("value")))
    met = sifted.filter("maybe").join(
        sent, (F.col("key") == F.col("d_key")) & F.col("id").eqNullSafe(F.col("d_id")), "left"
    )
    sure = met.filter(F.col("d_key").isNull()).select("row")
    once = met.filter("kept").groupBy("key", "id").agg(F.first("row").alias("row")).select("row")
    rest = sifted.filter("NOT maybe").select("row")
    return rest.unionByName(sure).unionByName(once).select("row.*")
