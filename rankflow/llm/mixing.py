"""Mixing sources to target weights by fitting word budgets as subset sums.

A source's target is its share by weight, at most ``max_repeats`` times its size; what is cut
off is shared again by weight. Each source then takes as many whole rounds of all its documents as
fit, and the rest of its target is a subset sum: documents are counted by exact length, every
length gives its proportional number, and a bounded-knapsack dynamic program over the lengths
left fits what remains, so a source misses its target by less than its shortest document that could be
taken once more. Which documents of a length go in is decided by a seeded hash: those below a threshold per source and
length, which meets the texts where they lie, by broadcast while there are at most ``BROADCAST_ROWS`` of them, and by
a shuffled join beyond.

Defined results: a null, empty or blank text has size 0 and is never taken. A very long text counts whole. A null source
is a source of its own, last in the order. Rows with the same id are separate documents; where id and text agree too,
any of them may be the ones taken, and the result is the same; only if they tie at the threshold are they numbered,
over many tasks however often one row is repeated. An empty table gives no rows, and a source
without words has target 0. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import picked, word_count
from rankflow.operators.ordering import global_index, running_totals
from rankflow.session import Scope, cut, scratch

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEATS = 3
# Above so many words left, the longest documents that leave as many go in before the dynamic program begins.
FIT_WORDS = 8192
HASH_BUCKETS = 4096
# A threshold is a source's name and seven numbers.
BROADCAST_ROWS = 500_000


def source_targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``(source, source_size, target)`` of ``(source, source_size)``.

    With caps ``c = max_repeats * size`` the targets are ``min(c, level * weight)`` for the one
    level at which they sum to all words. Ordered by ``c / weight``, capped sources come first, so
    running totals of caps and weights give the level.
    """
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    numbered = global_index(sources, order, "place")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))).cast("int"))
    weighed = numbered.select(
        "source", "source_size", "place", weight.alias("weight"),
        (F.col("source_size") * float(max_repeats)).alias("cap"),
    )
    ranked = weighed.withColumn("ratio", F.col("cap") / F.col("weight"))
    sums = cut(running_totals(ranked, ["ratio", "place"], {"caps": "cap", "weights": "weight"}), "targets")
    words, all_weights = sums.agg(F.sum("source_size"), F.sum("weight")).first()
    # A source is below its cap if the level, were it the first such source, is under its ratio.
    level = (F.lit(words) - F.col("caps") + F.col("cap")) / (
        F.lit(all_weights) - F.col("weights") + F.col("weight")
    )
    tested = sums.withColumn("level", level).filter("level <= ratio")
    found = tested.agg(F.min_by("level", F.struct("ratio", "place"))).first()[0]
    uncapped = F.lit(found).cast("double") * F.col("weight")
    return sums.select(
        "source", "source_size", F.least("cap", F.coalesce(uncapped, F.col("cap"))).alias("target")
    )


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come close to ``budget``.

    Proportional numbers first; then the largest lengths that leave at least ``FIT_WORDS``; what is left then is
    fitted as closely as any choice of the documents left can, by dynamic programming. If it is more than twice
    ``FIT_WORDS``, every document left is longer than half of it, and the longest that fits is the answer.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    # Texts without words fill no budget.
    counts = np.where(lengths > 0, counts, 0)
    total = int((lengths * counts).sum())
    if total <= 0 or budget <= 0:
        return take
    if budget >= total:
        return counts.copy()
    take += [int(c) * budget // total for c in counts]
    left = budget - int((take * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if left <= FIT_WORDS:
            break
        if counts[i] == take[i]:
            continue
        more = min(int(counts[i] - take[i]), (left - FIT_WORDS) // int(lengths[i]))
        if more > 0:
            take[i] += more
            left -= more * int(lengths[i])
    return take + bounded_knapsack(lengths, counts - take, left)


def bounded_knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """The numbers per length, within ``counts``, whose sum is the largest up to ``budget``.

    Sums that can be reached are bits of one integer per item; an item is a power of two of one length.
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    usable = np.flatnonzero((lengths > 0) & (lengths <= budget) & (counts > 0))
    if len(usable) and 2 * int(lengths[usable].min()) > budget:
        take[usable[lengths[usable].argmax()]] = 1
        return take
    items, reached, mask = [], [1], (1 << (budget + 1)) - 1
    for i in usable:
        left, part = min(int(counts[i]), budget // int(lengths[i])), 1
        while left > 0:
            part = min(part, left)
            items.append((i, part))
            reached.append((reached[-1] | reached[-1] << (part * int(lengths[i]))) & mask)
            left, part = left - part, part * 2
        if reached[-1] >> budget & 1:
            break
    best = reached[-1].bit_length() - 1
    for (i, part), before in zip(reversed(items), reversed(reached[:-1])):
        if not before >> best & 1:
            best -= part * int(lengths[i])
            take[i] += part
    return take


def _fit(groups: pd.DataFrame) -> pd.DataFrame:
    groups = groups.sort_values("size")
    lengths, counts = groups["size"].to_numpy(np.int64), groups["docs"].to_numpy(np.int64)
    groups["take"] = fit_lengths(lengths, counts, int(groups["budget"].iloc[0]))
    return groups[["source", "size", "docs", "rounds", "take"]]


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``(id, key, size, source, source_size, target, copies)`` per document; ``copies`` is 0 to ``max_repeats``."""
    named = picked(docs, id=id_col, text=text_col, source=source_col)
    with scratch(docs.sparkSession) as own:
        rows = cut(named.select("id", *_keyed(seed)), "sizes")
        targets, thresholds = _thresholds(own, rows, weights, max_repeats)
        back = targets.withColumnRenamed("source", "of")
        chosen = _copies(rows, thresholds).join(back, F.col("source").eqNullSafe(F.col("of")))
        result = chosen.select("id", "key", "size", "source", "source_size", "target", "copies")
        return own.result(cut(result, "mixed"))


def mixed_documents(
    docs: DataFrame, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
) -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it has copies. Texts are not shuffled for it."""
    named = picked(docs, id=id_col, text=text_col, source=source_col)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    whole = docs.select(
        row, F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source")
    ).select("row", *_keyed(seed))
    with scratch(docs.sparkSession) as own:
        slim = cut(named.select("id", *_keyed(seed)), "sizes")
        _, thresholds = _thresholds(own, slim, weights, max_repeats)
        counted = _copies(whole, thresholds)
        taken = counted.filter("copies > 0").withColumn("one", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        return own.result(taken.select("row.*"))


def _keyed(seed: int) -> list[str | Column]:
    """Columns ``source``, ``size``, and ``key``, the seeded hash of id and text."""
    key = F.xxhash64(F.lit(seed), "id", "text").alias("key")
    return ["source", word_count(F.col("text")).alias("size"), key]


def _thresholds(own: Scope, rows: DataFrame, weights: tuple[float, ...], max_repeats: int) -> tuple[DataFrame, DataFrame]:
    """``(source, source_size, target)``, and per source and length what its documents are measured by.

    Keys are ordered by their bucket, then by value. ``bucket`` and ``limit`` are those of the last key that is
    taken once more, which ``alike`` rows have, of which ``room`` are taken. One task sees the distinct document
    lengths of one source, never its documents.
    """
    lengths = cut(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "lengths")
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = cut(source_targets(sources, weights, max_repeats), "targets")
    whole = F.least(F.lit(max_repeats), F.floor(F.col("target") / F.col("source_size") + 1e-9)).cast("int")
    rounds = F.when(F.col("source_size") > 0, whole).otherwise(0)
    budgets = targets.select(
        F.col("source").alias("of"), rounds.alias("rounds"),
        F.greatest(F.round(F.col("target") - rounds * F.col("source_size")), F.lit(0)).cast("bigint").alias("budget"),
    )
    fitted = cut(
        lengths.join(budgets, F.col("source").eqNullSafe(F.col("of")))
        .select("source", "size", "docs", "rounds", "budget")
        .groupBy("source")
        .applyInPandas(_fit, "source string, size bigint, docs bigint, rounds int, take bigint"),
        "fitted",
    )
    limits = fitted.select(*[F.col(c).alias(f"f_{c}") for c in _GROUP], "rounds", "take")
    same = _alike("f_")
    counts = rows.groupBy(*_GROUP, _bucket().alias("bucket")).agg(F.count("*").alias("docs"))
    before = Window.partitionBy(*_GROUP).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    border = counts.withColumn("before", F.coalesce(F.sum("docs").over(before), F.lit(0))).join(limits, same)
    border = border.filter("before < take AND take <= before + docs").select(
        *[F.col(c).alias(f"b_{c}") for c in _GROUP], F.col("bucket").alias("b_bucket"), (F.col("take") - F.col("before")).alias("left")
    )
    # Only keys of the one bucket at the border are ranked, however many documents of the same length a source has.
    inside = rows.withColumn("bucket", _bucket()).join(border, [*_alike("b_"), F.col("bucket") == F.col("b_bucket")])
    keys = inside.groupBy(*_GROUP, "bucket", "key", "left").agg(F.count("*").alias("alike"))
    ordered = Window.partitionBy(*_GROUP).orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    last = keys.withColumn("before", F.coalesce(F.sum("alike").over(ordered), F.lit(0))).filter(
        "before < left AND left <= before + alike"
    )
    last = last.select(
        *[F.col(c).alias(f"l_{c}") for c in _GROUP], "bucket", F.col("key").alias("limit"), "alike",
        (F.col("left") - F.col("before")).alias("room"),
    )
    found = fitted.join(last, _alike("l_"), "left").select(
        *[F.col(c).alias(f"t_{c}") for c in _GROUP], "rounds",
        F.coalesce("bucket", F.lit(-1)).alias("bucket"), "limit", "alike", "room",
    )
    return targets, cut(found, "thresholds")


_GROUP = ["source", "size"]


def _bucket() -> Column:
    return F.pmod("key", F.lit(HASH_BUCKETS))


def _alike(prefix: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in _GROUP]


def _copies(rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``rows (source, size, key, ..)`` with ``copies``: whole rounds for all with words, and one more up to the threshold."""
    named = rows.columns
    own = _bucket()
    near = F.broadcast if thresholds.count() <= BROADCAST_ROWS else lambda table: table
    met = rows.join(near(thresholds), _alike("t_"))
    at_limit = (own == F.col("bucket")) & (F.col("key") == F.col("limit"))
    below = (own < F.col("bucket")) | ((own == F.col("bucket")) & (F.col("key") <= F.col("limit")))
    copies = F.when(F.col("size") > 0, F.col("rounds") + F.col("more")).otherwise(0).alias("copies")
    shared = thresholds.filter("room < alike")
    if shared.isEmpty():
        return met.withColumn("more", F.coalesce(below, F.lit(False)).cast("int")).select(*named, copies)
    doubtful = F.coalesce(at_limit & (F.col("room") < F.col("alike")), F.lit(False))
    sure = met.filter(~doubtful).withColumn("more", F.coalesce(below, F.lit(False)).cast("int"))
    # Rows that share the last key are numbered, by where they lie in a written table.
    ties = cut(rows.join(near(shared), _alike("t_")).filter(doubtful), "ties").withColumn("_tie", F.monotonically_increasing_id())
    numbered = global_index(ties.select("key", "_tie", *_GROUP), [*_GROUP, "key", "_tie"], "_position")
    starts = numbered.groupBy(*_GROUP).agg(F.min("_position").alias("_start")).select(
        *[F.col(c).alias(f"n_{c}") for c in _GROUP], "_start"
    )
    places = numbered.join(starts, _alike("n_")).select("_tie", (F.col("_position") - F.col("_start")).alias("_place"))
    tied = ties.join(places, "_tie").withColumn("more", (F.col("_place") < F.col("room")).cast("int"))
    return sure.select(*named, copies).unionByName(tied.select(*named, copies))
