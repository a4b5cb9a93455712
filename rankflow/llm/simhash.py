"""SimHash fingerprints of documents, and tables of permuted blocks that find near ones.

A document's terms are runs of words; a term weighs one plus the logarithm of its count. Every term's
64-bit hash votes with its weight on each bit, for or against, and the signs of the sums are the
fingerprint, so the share of equal bits estimates the angle between two documents' term vectors.

Near fingerprints are found by blocks: the bits are cut into blocks, and two fingerprints within the radius agree on
all but ``radius`` of them at least. Each choice of blocks that may agree is a table, keyed by those blocks, in which
they lie next to each other whatever their place in the fingerprint. All tables together miss none.

Defined results: a null or empty text, or one without words, has no terms and fingerprint 0. Equal texts have
equal fingerprints. A text with fewer words than a term's is one term. Rows with the same id keep their
rows. Every character counts, however long the text.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from rankflow.llm.common import LOWER, UPPER, WORD, picked
from rankflow.session import cut

BITS = 64
TERM_WORDS = 2
RADIUS = 3
# Fingerprints within RADIUS agree on at least this many of RADIUS + AGREEING blocks.
AGREEING = 2
TERMS_HELD = 1 << 14

_WORD = re.compile(WORD)
_LOWER = str.maketrans(UPPER, LOWER)


def terms(text: str, words: int = TERM_WORDS) -> Iterator[str]:
    """Runs of ``words`` words in lower case; a shorter text is one term."""
    found = _WORD.findall(text.translate(_LOWER))
    if not found:
        return iter(())
    if len(found) <= words:
        return iter((" ".join(found),))
    return (" ".join(run) for run in zip(*[found[i:] for i in range(words)]))


def fingerprint(text: str | None, words: int = TERM_WORDS) -> int:
    """The signs of the weighed votes of all terms, as an unsigned integer."""
    counts = Counter(terms(text or "", words))
    if not counts:
        return 0
    votes = np.zeros(BITS)
    items = iter(counts.items())
    while held := list(itertools.islice(items, TERMS_HELD)):
        hashes = np.array([xxhash.xxh3_64_intdigest(term) for term, _ in held], dtype=">u8")
        weights = 1.0 + np.log(np.array([n for _, n in held], dtype=np.float64))
        bits = np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS)
        votes += weights @ bits * 2.0 - weights.sum()
    return int.from_bytes(np.packbits(votes > 0).tobytes(), "big")


def as_signed(value: int) -> int:
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


@F.pandas_udf(LongType())
def fingerprint_of(texts: pd.Series) -> pd.Series:
    """The fingerprint as a signed 64-bit number."""
    return pd.Series([as_signed(fingerprint(text)) for text in texts], dtype="int64")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits, 0 to 1."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# --- tables of permuted blocks -----------------------------------------------------------------


def block_masks(radius: int = RADIUS, agreeing: int = AGREEING) -> list[int]:
    """A mask per table: the bits of the blocks that agree there."""
    count = radius + agreeing
    edges = [round(i * BITS / count) for i in range(count + 1)]
    blocks = [((1 << high) - 1) ^ ((1 << low) - 1) for low, high in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in itertools.combinations(blocks, agreeing)]


def block_tables(fingerprints: DataFrame, radius: int = RADIUS, agreeing: int = AGREEING) -> DataFrame:
    """``(table, key, fingerprint)``: a row per distinct fingerprint and table."""
    masks = [F.lit(as_signed(m)) for m in block_masks(radius, agreeing)]
    named = picked(fingerprints, fingerprint="fingerprint").filter("fingerprint IS NOT NULL").distinct()
    return named.select("fingerprint", F.posexplode(F.array(*masks)).alias("table", "mask")).select(
        "table", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key"), "fingerprint"
    )


def find_near(
    queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, agreeing: int = AGREEING
) -> DataFrame:
    """``(query, fingerprint, distance)``: for each query all other distinct fingerprints within ``radius``.

    Both inputs have a column ``fingerprint``. A pair that agrees in several tables is given once, by the first.
    """
    left = block_tables(queries, radius, agreeing).withColumnRenamed("fingerprint", "query")
    met = left.join(block_tables(fingerprints, radius, agreeing), ["table", "key"])
    differ = F.col("query").bitwiseXOR(F.col("fingerprint"))
    masks = F.array(*[F.lit(as_signed(m)) for m in block_masks(radius, agreeing)])
    first = F.array_position(F.transform(masks, lambda m: differ.bitwiseAND(m) == 0), True) - 1
    near = met.filter((F.bit_count(differ) <= radius) & (differ != 0)).filter(first == F.col("table"))
    return near.select("query", "fingerprint", F.bit_count(differ).alias("distance"))


def count_near(
    queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS, agreeing: int = AGREEING
) -> DataFrame:
    """``(query, rows)``: for each distinct query the rows of ``fingerprints`` within ``radius``, equal ones included.

    Rows are counted per fingerprint before the tables meet, so copies make no pairs.
    """
    named = picked(fingerprints, fingerprint="fingerprint").filter("fingerprint IS NOT NULL")
    counts = cut(named.groupBy("fingerprint").agg(F.count("*").alias("rows")), "prints")
    near = find_near(queries, counts, radius, agreeing).select("query", "fingerprint")
    own = picked(queries, query="fingerprint").filter("query IS NOT NULL").distinct()
    same = own.withColumn("fingerprint", F.col("query"))
    met = near.unionByName(same).join(counts, "fingerprint", "left")
    return met.groupBy("query").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
